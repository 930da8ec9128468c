"""File readers for the engine's inputs (S1-S9): explicit schemas, cleaning, optional tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..functions.cleaning import (DELIVERY_SPEC, MATCHSTAT_SPEC, VENUE_SPEC, clean_key, clean_name, conform,
                                  normalize_result, number, parse_date, require_columns)
from .fixtures import Datasets

INNINGS_REQUIRED = ["player_id", "match_date", "fantasy_points"]

INNINGS_SCHEMA = T.StructType([
    T.StructField("player_id", T.LongType(), False),
    T.StructField("match_id", T.LongType()),
    T.StructField("match_date", T.StringType()),   # yyyyMMdd or ISO text; parsed by P1
    T.StructField("team_id", T.LongType()),
    T.StructField("opposition_id", T.LongType()),
    T.StructField("ground_id", T.LongType()),
    T.StructField("runs_batting", T.DoubleType()),
    T.StructField("fours", T.DoubleType()),
    T.StructField("sixes", T.DoubleType()),
    T.StructField("balls_faced", T.DoubleType()),
    T.StructField("out", T.StringType()),
    T.StructField("wickets_taken", T.DoubleType()),
    T.StructField("runs_conceded", T.DoubleType()),
    T.StructField("innings_bowling", T.IntegerType()),
    T.StructField("fantasy_points", T.DoubleType()),
])
MATCH_KEY = T.StructType([T.StructField("match_id", T.LongType())])
CROSSWALK_SCHEMA = T.StructType([
    T.StructField("ground_name_howstat", T.StringType()),
    T.StructField("ground_id_howstat", T.LongType()),
    T.StructField("ground_id_espn", T.LongType()),
    T.StructField("ground_name_espn", T.StringType()),
    T.StructField("City", T.StringType()),
])


def _csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, in one pass; the readers give them their types by name."""
    return spark.read.option("header", True).option("mode", "PERMISSIVE").csv(path)


def typed_by_name(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast the schema's columns *by name* (a CSV schema would be applied by position); '1.0' from
    float-typed writers is a whole number, junk, NaN and infinities are null; other columns are kept."""
    names = {f.name for f in schema}
    cols = []
    for f in schema:
        if f.name not in df.columns:
            continue
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.LongType, T.IntegerType, T.DoubleType)):
            c = number(c, f.dataType.simpleString())
        elif not isinstance(f.dataType, T.StringType):
            c = c.try_cast(f.dataType)
        cols.append(c.alias(f.name))
    return df.select(*cols, *[F.col(f"`{c}`") for c in df.columns if c not in names])


def read_innings(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Fact table, typed by column name, with the required-column check (S7) and polymorphic
    date parsing (P1)."""
    raw = spark.read.option("header", True).csv(path) if fmt == "csv" else spark.read.format(fmt).load(path)
    require_columns(raw, INNINGS_REQUIRED, "player_innings")
    return typed_by_name(raw, INNINGS_SCHEMA).withColumn("match_date", parse_date(F.col("match_date")))


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    """Profiles with dirty text keys cleaned (P5) and names normalised (P20)."""
    df = _csv(spark, path)
    out = df.withColumn("player_id", clean_key(F.col("player_id"))).where(F.col("player_id").isNotNull())
    for c in ("name", "player_name", "full_name"):
        if c in out.columns:
            out = out.withColumn(c, clean_name(F.col(c)))
    return out


def read_optional(spark: SparkSession, path: str) -> DataFrame | None:
    """An absent optional table is ``None``; features then fall back to defaults."""
    try:
        return _csv(spark, path)
    except AnalysisException:
        return None


def read_venue_stats(spark: SparkSession, path: str) -> DataFrame | None:
    """S3: venue dimension conformed to canonical names with defaults."""
    df = read_optional(spark, path)
    return None if df is None else conform(df, VENUE_SPEC)


def read_deliveries(spark: SparkSession, path: str) -> DataFrame | None:
    df = read_optional(spark, path)
    if df is None:
        return None
    return conform(df, DELIVERY_SPEC).withColumn("match_date", parse_date(F.col("match_date")))


def read_matchstat(spark: SparkSession, path: str) -> DataFrame | None:
    df = read_optional(spark, path)
    if df is None:
        return None
    df = typed_by_name(df, MATCH_KEY)
    df = conform(df, MATCHSTAT_SPEC).withColumn("match_date", parse_date(F.col("match_date")))
    return df.withColumn("result", normalize_result(F.col("result")))


def read_crosswalk(spark: SparkSession, path: str) -> DataFrame:
    """Venue id crosswalk (quoted names with commas, blank-padded city)."""
    df = typed_by_name(_csv(spark, path), CROSSWALK_SCHEMA)
    return df.select(*[F.trim(F.col(c)).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes])


def load_csv_dir(spark: SparkSession, data_dir: str) -> Datasets:
    """Catalog load of a folder of CSVs; lazy, no count is run."""
    d = data_dir.rstrip("/")
    return Datasets(
        innings=read_innings(spark, f"{d}/playerInningStat_merged.csv"),
        profiles=read_profiles(spark, f"{d}/ipl_player_profiles_2024-2025.csv"),
        venue_stats=read_venue_stats(spark, f"{d}/venueStats_merged.csv"),
        deliveries=read_deliveries(spark, f"{d}/deliveries_combined_2008_2025.csv"),
        matchstat=read_matchstat(spark, f"{d}/matchStat_merged.csv"),
    )
