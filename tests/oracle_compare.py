"""Compare a Spark DataFrame with a DuckDB query on the same parquet tables."""

from __future__ import annotations

import math

import duckdb
import pandas as pd

from anchorwise.sources.tables import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            return v
    if isinstance(v, pd.Timestamp):
        return v.date()
    return v


def rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v) for v in rec))
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


_SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                  "boolean": "BOOLEAN", "date": "DATE", "smallint": "SMALLINT", "tinyint": "TINYINT",
                  "float": "FLOAT", "timestamp": "TIMESTAMP WITH TIME ZONE", "timestamp_ntz": "TIMESTAMP"}


def type_diffs(spark_df, sql: str, con) -> list[str]:
    rel = con.sql(sql)
    duck_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    out = []
    for c, t in spark_df.dtypes:
        want = _SPARK_TO_DUCK.get(t, t.upper())
        if duck_types.get(c) != want:
            out.append(f"{c}: spark={t} duck={duck_types.get(c)}")
    return out


def compare(spark_df, sql: str, con, check_types: bool = True) -> tuple[bool, str]:
    if check_types:
        diffs = type_diffs(spark_df, sql, con)
        if diffs:
            return False, "types differ: " + "; ".join(diffs)
    s = spark_df.toPandas()
    d = con.execute(sql).fetchdf()
    if sorted(s.columns) != sorted(d.columns):
        return False, f"columns differ: spark={sorted(s.columns)} duck={sorted(d.columns)}"
    if len(s) != len(d):
        return False, f"row count differs: spark={len(s)} duck={len(d)}"
    rs, rd = rows(s), rows(d)
    for a, b in zip(rs, rd):
        if a != b:
            return False, f"first differing row (cols {sorted(s.columns)}):\n spark={a}\n duck ={b}"
    return True, f"{len(s)} rows equal"
