"""CSV readers with a reject table.

A file is read once, as text by its header's names. The pass adds the issues of every row - a record with too few or too many
fields, a key that is absent or no number, a date that cannot be parsed - counts them with ``observe`` and writes rows
and issues to the shared folder. Typed rows and rejects are both read from there, so the source is parsed one time.
Rows without a key and corrupt records are dropped; a bad date becomes null and the row stays, as without this module.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..functions.cleaning import (DELIVERY_SPEC, MATCHSTAT_SPEC, VENUE_SPEC, clean_key, clean_name, conform,
                                  first_present, normalize_result, parse_date, require_columns)
from .fixtures import Datasets
from .readers import INNINGS_REQUIRED, INNINGS_SCHEMA, MATCH_KEY, typed_by_name
from .sinks import output_path

CORRUPT = "_corrupt_record"
ISSUES = "array<struct<column:string,value:string,reason:string,dropped:boolean>>"
# The file names of the data folder.
FILES = {"innings": "playerInningStat_merged.csv", "profiles": "ipl_player_profiles_2024-2025.csv",
         "venue_stats": "venueStats_merged.csv", "deliveries": "deliveries_combined_2008_2025.csv",
         "matchstat": "matchStat_merged.csv"}


@dataclass(frozen=True)
class Checked:
    """Text rows that stay, the rejects (table, column, value, reason, dropped), and counts: rows, dropped, bad_dates."""

    rows: DataFrame
    rejects: DataFrame
    metrics: dict[str, int]


def _issue(when: Column, column: str, value: Column, reason: str, dropped: bool) -> Column:
    return F.when(when, F.struct(F.lit(column).alias("column"), value.alias("value"), F.lit(reason).alias("reason"),
                                 F.lit(dropped).alias("dropped")))


def read_checked(spark: SparkSession, path: str, table: str, keys: Sequence[str] = (), dates: Sequence[str] = (),
                 required: Sequence[str] = ()) -> Checked:
    """One pass over a CSV file or folder; raises if a required column is missing."""
    names = spark.read.option("header", True).csv(path).columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in (*names, CORRUPT)])
    raw = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").option(
        "columnNameOfCorruptRecord", CORRUPT).csv(path)
    require_columns(raw, required, table)
    whole, text = F.col(CORRUPT).isNull(), lambda c: F.col(f"`{c}`")
    found = [_issue(~whole, "", F.col(CORRUPT), "corrupt record", True)]
    for k in keys:
        empty = text(k).isNull() | (F.trim(text(k)) == "")
        found += [_issue(whole & empty, k, text(k), "no key", True),
                  _issue(whole & ~empty & clean_key(text(k)).isNull(), k, text(k), "bad key", True)]
    for d in dates:
        found.append(_issue(whole & text(d).isNotNull() & parse_date(text(d)).isNull(), d, text(d), "bad date", False))
    seen = Observation(f"{table}-issues")
    dropped = F.exists("_issues", lambda i: i["dropped"])
    bad_date = F.exists("_issues", lambda i: i["reason"] == "bad date")
    checked = raw.withColumn("_issues", F.array_compact(F.array(*found)).cast(ISSUES)).withColumn("_dropped", dropped).observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count_if("_dropped").alias("dropped"), F.count_if(bad_date).alias("bad_dates"))
    stage = output_path(spark, f"checked-{table}")
    checked.write.parquet(stage)
    stored = spark.read.parquet(stage)
    rejects = stored.where(F.size("_issues") > 0).select(F.lit(table).alias("table"), F.inline("_issues"))
    return Checked(stored.where(~F.col("_dropped")).select(*[text(n) for n in names]), rejects, dict(seen.get))


def _named(spark: SparkSession, path: str, names: Sequence[str]) -> list[str]:
    """The first of the names that the file has, as a list."""
    name = first_present(spark.read.option("header", True).csv(path), names)
    return [name] if name else []


def load_checked_dir(spark: SparkSession, data_dir: str) -> tuple[Datasets, DataFrame, dict[str, dict[str, int]]]:
    """S6 with rejects: the datasets of a folder of CSVs, the rejects of all of them, and the counts of each table.

    Innings and profiles must be there; an absent optional table is None (S3-S5)."""
    path = {t: f"{data_dir.rstrip('/')}/{f}" for t, f in FILES.items()}
    parts: dict[str, Checked] = {
        "innings": read_checked(spark, path["innings"], "innings", ["player_id"], ["match_date"], INNINGS_REQUIRED),
        "profiles": read_checked(spark, path["profiles"], "profiles", ["player_id"], required=["player_id"]),
    }
    for table, key, dates in (("venue_stats", ("venue_id", *VENUE_SPEC["venue_id"][0]), ()),
                              ("deliveries", ("batter_id", *DELIVERY_SPEC["batter_id"][0]), ("match_date",)),
                              ("matchstat", (), ("match_date",))):
        try:
            parts[table] = read_checked(spark, path[table], table, _named(spark, path[table], key), dates)
        except AnalysisException:
            continue  # not there
    inn, prof = parts["innings"].rows, parts["profiles"].rows
    inn = typed_by_name(inn.withColumn("player_id", clean_key(F.col("player_id")).cast("string")), INNINGS_SCHEMA)
    prof = prof.withColumn("player_id", clean_key(F.col("player_id")))
    for c in ("name", "player_name", "full_name"):
        prof = prof.withColumn(c, clean_name(F.col(c))) if c in prof.columns else prof
    dated = lambda df: df.withColumn("match_date", parse_date(F.col("match_date")))
    optional = lambda t, make: make(parts[t].rows) if t in parts else None
    data = Datasets(
        innings=dated(inn), profiles=prof,
        venue_stats=optional("venue_stats", lambda d: conform(d, VENUE_SPEC)),
        deliveries=optional("deliveries", lambda d: dated(conform(d, DELIVERY_SPEC))),
        matchstat=optional("matchstat", lambda d: dated(conform(typed_by_name(d, MATCH_KEY), MATCHSTAT_SPEC)).withColumn(
            "result", normalize_result(F.col("result")))))
    rejects = reduce(DataFrame.unionByName, [p.rejects for p in parts.values()])
    return data, rejects, {t: p.metrics for t, p in parts.items()}
