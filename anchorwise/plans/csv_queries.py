"""Registered CSV queries: the tables written as raw CSV files, read back through the checked readers.

``_write_raw`` renders the domain views the way raw files carry them: alias column names, dates as yyyyMMdd numbers or ISO text,
dirty profile keys. ``csv_rejects`` plants faults by a rule on the row's ids, which its SQL restates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import anchors as A
from ..operators import features as FE
from ..sources import checked as C
from ..sources import fixtures as fx
from ..sources import readers as RD
from ..sources.sinks import output_path
from ..sources.tables import read_table
from . import feature_queries as FQ
from . import oracle_features as OF
from . import prep_queries as PQ
from .views_sql import with_views

# Alias column names of raw files.
ALIASES = {
    "venue_stats": {"venue_id": "ground_id", "total_matches_venue": "matches_played", "highest_score_venue": "highest_score",
                    "lowest_score_venue": "min_score", "total_boundaries_venue": "boundaries"},
    "deliveries": {"batter_id": "batter", "batsman_runs": "runs", "over": "over_number"},
    "matchstat": {"team_id": "team", "result": "match_result"},
}


def _lines(df: DataFrame, path: str, more: Column | None = None) -> None:
    """Plain CSV lines with a header in every file; ``more`` is put behind a line as it is."""
    fields = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in df.columns]
    line = F.concat_ws(",", *fields)
    # one column whose name is the header; a separator that no line holds, so nothing is quoted
    line = line if more is None else F.concat(line, more)
    df.select(line.alias(",".join(df.columns))).write.option("header", True).option("sep", "\u0001").csv(path)


def _raw_date(day: Column, compact: Column) -> Column:
    return F.when(compact, F.date_format(day, "yyyyMMdd")).otherwise(F.date_format(day, "yyyy-MM-dd"))


def _write_raw(spark: SparkSession, sf: str, faults: bool = False) -> str:
    """A fresh folder of raw CSVs in the shared folder; with ``faults`` in the innings."""
    folder = output_path(spark, "csv")
    inn = fx.innings(spark, sf)
    key, day = F.col("player_id").cast("string"), _raw_date(F.col("match_date"), F.col("match_id") % 2 == 0)
    k = (F.col("match_id") * 31 + F.col("player_id")) % 100
    more = None
    if faults:
        key = F.when(k == 1, F.concat(F.lit("x"), key)).when(k == 2, F.lit("")).otherwise(key)
        day = F.when(k == 3, F.lit("20240132")).otherwise(day)
        more = F.when((F.col("_k") == 0), F.lit(",surplus")).otherwise(F.lit(""))
    raw = inn.withColumns({"player_id": key, "match_date": day, "_k": k})
    if more is None:
        _lines(raw.drop("_k"), f"{folder}/{C.FILES['innings']}")
    else:  # the fault number goes along as the last column
        _lines(raw, f"{folder}/{C.FILES['innings']}", more)
    _lines(fx.profiles(spark, sf), f"{folder}/{C.FILES['profiles']}")
    for table in ("venue_stats", "deliveries", "matchstat"):
        df = getattr(fx, table)(spark, sf)
        if "match_date" in df.columns:
            df = df.withColumn("match_date", _raw_date(F.col("match_date"), F.lit(True)))
        _lines(df.withColumnsRenamed(ALIASES[table]), f"{folder}/{C.FILES[table]}")
    return folder


def csv_features(spark: SparkSession, sf: str) -> DataFrame:
    """All features built from a folder of raw CSVs equal those built from the parquet views."""
    ds, _, _ = C.load_checked_dir(spark, _write_raw(spark, sf))
    return FQ.all_features(ds, A.training_anchors(ds.innings))


def csv_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Issues by table, column and reason, and the rows that each pass saw, dropped and kept."""
    _, rejects, metrics = C.load_checked_dir(spark, _write_raw(spark, sf, faults=True))
    found = rejects.groupBy("table", "column", "reason", "dropped").agg(F.count(F.lit(1)).alias("n"))
    seen = [(t, "", what, False, n) for t, m in metrics.items()
            for what, n in (("rows read", m["rows"]), ("rows dropped", m["dropped"]), ("bad dates", m["bad_dates"]))]
    return found.unionByName(spark.createDataFrame(seen, found.schema))  # three rows a table


def csv_crosswalk(spark: SparkSession, sf: str) -> DataFrame:
    """S9 + J15: the crosswalk as a CSV file with quoted names and blank-padded cities, read back and joined."""
    path = output_path(spark, "crosswalk")
    PQ.crosswalk_table(spark, sf).write.option("header", True).option("ignoreLeadingWhiteSpace", False).csv(path)
    return PQ.crosswalk_joined(spark, sf, RD.read_crosswalk(spark, path))


def csv_dates(spark: SparkSession, sf: str) -> DataFrame:
    """A table of dates in mixed forms through CSV: what was parsed, and what was not."""
    path = output_path(spark, "dates")
    orders = read_table(spark, sf, "orders").select(F.col("o_orderkey").alias("player_id"), PQ.raw_date().alias("match_date"))
    _lines(orders, path)
    got = C.read_checked(spark, path, "orders", ["player_id"], ["match_date"])
    bad = got.rejects.where("reason = 'bad date'").select(F.col("value").alias("raw_date"))
    return bad.groupBy("raw_date").agg(F.count(F.lit(1)).alias("n")).withColumn("of", F.lit(got.metrics["rows"]).cast("long"))


QUERIES = {"csv_features": csv_features, "csv_rejects": csv_rejects, "csv_crosswalk": csv_crosswalk, "csv_dates": csv_dates}


def oracles() -> dict[str, str]:
    rejects = with_views("innings", "deliveries", "matchstat", "venue_stats", "profiles", extra="""f AS (
   SELECT (match_id * 31 + player_id) % 100 AS k FROM innings),
i AS (SELECT CASE k WHEN 0 THEN '' WHEN 3 THEN 'match_date' ELSE 'player_id' END AS "column",
   CASE k WHEN 0 THEN 'corrupt record' WHEN 1 THEN 'bad key' WHEN 2 THEN 'no key' ELSE 'bad date' END AS reason,
   k <> 3 AS dropped FROM f WHERE k < 4),
p AS (SELECT * FROM profiles WHERE TRY_CAST(TRIM(player_id) AS DOUBLE) IS NULL OR TRIM(player_id) = 'nan'),
s AS (SELECT 'innings' AS "table", COUNT(*) AS n, COUNT(CASE WHEN k < 3 THEN 1 END) AS d, COUNT(CASE WHEN k = 3 THEN 1 END) AS b FROM f
   UNION ALL SELECT 'profiles', (SELECT COUNT(*) FROM profiles), (SELECT COUNT(*) FROM p), 0
   UNION ALL SELECT 'venue_stats', COUNT(*), 0, 0 FROM venue_stats
   UNION ALL SELECT 'deliveries', COUNT(*), 0, 0 FROM deliveries
   UNION ALL SELECT 'matchstat', COUNT(*), 0, 0 FROM matchstat)""") + """SELECT 'innings' AS "table", "column", reason, dropped, COUNT(*) AS n
FROM i GROUP BY ALL
UNION ALL SELECT 'profiles', 'player_id', 'bad key', TRUE, COUNT(*) FROM p HAVING COUNT(*) > 0
UNION ALL SELECT "table", '', 'rows read', FALSE, n FROM s
UNION ALL SELECT "table", '', 'rows dropped', FALSE, d FROM s
UNION ALL SELECT "table", '', 'bad dates', FALSE, b FROM s"""
    return {
        "csv_features": OF.oracles()["features_all"],
        "csv_crosswalk": PQ.oracles()["venue_crosswalk"],
        "csv_rejects": rejects,
        "csv_dates": """SELECT '20240132' AS raw_date, COUNT(*) AS n, (SELECT COUNT(*) FROM orders) AS "of" FROM orders
WHERE o_orderkey % 4 = 3 AND o_orderkey % 3 = 0 HAVING COUNT(*) > 0""",
    }
