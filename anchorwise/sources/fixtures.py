"""Domain views derived from the generic test tables.

The test folders hold TPC-H-like tables plus an ``events`` stream. These
builders turn them into the tables the engine works on: player innings,
ball-level deliveries, team results, profiles, venue statistics, prediction
requests, candidate predictions and full stat lines. Every view is a lazy
DataFrame over the parquet scans, so its size grows with the scale factor.
"""

from __future__ import annotations

import functools
import os
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir
from .tables import read_table

# Derived views are written once per session and folder as parquet under the
# shared folder (spark.checkpoint.dir) and read back: every query then scans a
# stored table instead of re-deriving it from raw events in each plan branch,
# and the lineage is cut (a lost executor re-reads files, not the derivation).
MATERIALIZE = os.environ.get("ANCHORWISE_MATERIALIZE", "1") != "0"
_STORED: dict[tuple[str, str, str], DataFrame] = {}  # the stored view, read back once (a lazy plan)


def _stored(builder):
    """Serve the view from its stored copy when called without explicit upstream frames."""

    @functools.wraps(builder)
    def wrapper(spark: SparkSession, sf_dir: str, *upstream):
        if not MATERIALIZE or any(u is not None for u in upstream):
            return builder(spark, sf_dir, *upstream)
        key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir), builder.__name__)
        if key not in _STORED:
            path = f"{shared_dir(spark).rstrip('/')}/views/{builder.__name__}-{uuid.uuid4().hex}"
            builder(spark, sf_dir).write.mode("overwrite").parquet(path)
            _STORED[key] = spark.read.parquet(path)
        return _STORED[key]

    wrapper.derive = builder  # the lazy derivation itself
    return wrapper


EPOCH_DAY = "2021-11-01"  # day of match 0 in the derived calendar
SALTS = 16  # join-key salts for the low-cardinality squad join


def _match_date(match_id: Column) -> Column:
    offset = (match_id * 3 - (match_id % 2) * 2).cast("int")
    return F.date_add(F.lit(EPOCH_DAY).cast("date"), offset)


def ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    return e.select(
        "event_id",
        F.col("user_id").alias("player_id"),
        "event_type",
        F.round(F.col("value") * 100).cast("long").alias("cents"),
        ((F.dayofmonth("ts") - 1) * 4 + F.floor(F.hour("ts") / F.lit(6.0))).cast("long").alias("match_id"),
    )


@_stored
def innings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (player, match): the fact table of the feature engine."""
    e = ev(spark, sf_dir)
    bat = F.col("event_type").isin("click", "view")
    buy = F.col("event_type") == "purchase"
    g = e.groupBy("match_id", "player_id").agg(
        F.sum(F.when(bat, F.col("cents"))).alias("_bat_cents"),
        F.count(F.when(F.col("event_type") == "click", 1)).alias("fours"),
        F.count(F.when(F.col("event_type") == "view", 1)).alias("sixes"),
        (F.count(F.lit(1)) * 7).alias("balls_faced"),
        F.max(F.when(F.col("event_type") == "error", F.lit("caught"))).alias("out"),
        F.count(F.when(buy, 1)).alias("wickets_taken"),
        F.max(F.when(buy, F.lit(1))).alias("innings_bowling"),
        F.sum(F.when(buy, F.col("cents") % 60)).alias("_conceded"),
        F.sum("cents").alias("_cents"),
    )
    m, p = F.col("match_id"), F.col("player_id")
    return g.select(
        m,
        p,
        _match_date(m).alias("match_date"),
        (p % 8).alias("team_id"),
        ((p + 1 + m % 7) % 8).alias("opposition_id"),
        (m % 28).alias("ground_id"),
        (F.col("_bat_cents") % 120).cast("double").alias("runs_batting"),
        "fours",
        "sixes",
        "balls_faced",
        "out",
        "wickets_taken",
        "innings_bowling",
        F.col("_conceded").cast("double").alias("runs_conceded"),
        F.when((p % 17 == 3) & (m % 5 == 0), F.lit(None).cast("double"))
        .otherwise((F.col("_cents") % 1300).cast("double") / 10)
        .alias("fantasy_points"),
    )


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ball-level detail; players with id % 5 == 0 have none (proxy path)."""
    e = ev(spark, sf_dir)
    return e.where(F.col("player_id") % 5 != 0).select(
        F.col("player_id").alias("batter_id"),
        _match_date(F.col("match_id")).alias("match_date"),
        (F.col("event_id") % 20 + 1).alias("over"),
        (F.col("cents") % 7).alias("batsman_runs"),
    )


@_stored
def matchstat(spark: SparkSession, sf_dir: str, inn: DataFrame | None = None) -> DataFrame:
    """Team x match results with raw (dirty) result labels."""
    inn = inn if inn is not None else innings(spark, sf_dir)
    code = (F.col("team_id") * 3 + F.col("match_id")) % 6
    label = (
        F.when(code == 0, "Win").when(code == 1, "loss").when(code == 2, "W")
        .when(code == 3, "defeat").when(code == 4, "tie").otherwise("victory")
    )
    return inn.select("team_id", "match_id", "match_date").distinct().select(
        "team_id", "match_id", "match_date", label.alias("result"))


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Player profiles with dirty text keys ('nan', padded blanks)."""
    c = read_table(spark, sf_dir, "customer")
    seg = F.col("c_mktsegment")
    role = (
        F.when(seg == "BUILDING", "Top-order").when(seg == "HOUSEHOLD", "Wicketkeeper-batsman")
        .when(seg == "MACHINERY", "All-rounder").when(seg == "FURNITURE", "Bowler").otherwise("Batter")
    )
    key = F.when(F.col("c_custkey") % 50 == 49, F.lit("nan")).otherwise(
        F.concat(F.lit(" "), F.col("c_custkey").cast("string"), F.lit(" ")))
    return c.select(key.alias("player_id"), F.col("c_name").alias("name"), role.alias("role"))


@_stored
def venue_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Venue dimension: one row per nation key (grounds 25-27 have none)."""
    n = read_table(spark, sf_dir, "nation")
    c = read_table(spark, sf_dir, "customer")
    k = F.col("n_nationkey")
    g = n.join(c, F.col("c_nationkey") == k, "left").groupBy(k).agg(F.count("c_custkey").alias("total_matches_venue"))
    return g.select(
        k.cast("long").alias("venue_id"),
        "total_matches_venue",
        (120 + (k * 37) % 150).cast("double").alias("highest_score_venue"),
        F.when(k % 8 == 5, F.lit(None).cast("double")).otherwise((60 + (k * 13) % 60).cast("double"))
        .alias("lowest_score_venue"),
        F.lit(800).alias("total_boundaries_venue"),
    )


@_stored
def requests(spark: SparkSession, sf_dir: str, inn: DataFrame | None = None) -> DataFrame:
    """Prediction requests: every match is a request for the squads of its two teams.

    A squad is every player whose id maps to the team; players below 8 are
    listed twice (duplicate squad entries, kept through scoring).
    """
    inn = inn if inn is not None else innings(spark, sf_dir)
    m = inn.select("match_id", "match_date").distinct()
    pl = inn.select("player_id").distinct()
    p = pl.unionByName(pl.where(F.col("player_id") < 8))
    # squads: join on the team key (player % 8) for each of the two teams. The key has only 8
    # values, so the join is salted: players carry a salt independent of the key ((id div 8) %
    # SALTS) and every match row is replicated once per salt, spreading each team key over SALTS
    # join keys (same output).
    team1 = m.select("match_id", "match_date", (F.col("match_id") % 8).alias("tkey"), F.lit(1).alias("team_no"))
    team2 = m.select("match_id", "match_date", ((F.col("match_id") + 1) % 8).alias("tkey"), F.lit(2).alias("team_no"))
    teams = team1.unionByName(team2).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    squads = p.select("player_id", (F.col("player_id") % 8).alias("tkey"), (F.floor(F.col("player_id") / 8) % SALTS).cast("int").alias("salt"))  # sequence() yields int too
    r = teams.join(squads, ["tkey", "salt"])
    return r.select(
        F.col("match_id").alias("request_id"),
        F.col("match_date").alias("cutoff_date"),
        (F.col("match_id") % 28).alias("venue_id"),
        "player_id",
        "team_no",
    )


@_stored
def predictions(spark: SparkSession, sf_dir: str, req: DataFrame | None = None) -> DataFrame:
    """Deterministic candidate scores per request (with ties, duplicates, null roles)."""
    req = req if req is not None else requests(spark, sf_dir)
    p, r = F.col("player_id"), F.col("request_id")
    role = (
        F.when(p % 5 == 0, "Top-order").when(p % 5 == 1, "Wicketkeeper-batsman")
        .when(p % 5 == 2, "All-rounder").when(p % 5 == 3, "Bowler")
    )
    return req.select(
        "request_id",
        "player_id",
        "team_no",
        ((p * 7919 + r * 104729) % 881).cast("double").alias("_fp") ,
        ((p * 31 + r * 17) % 11).cast("double").alias("_sp"),
        role.alias("role"),
    ).select(
        "request_id", "player_id", "team_no",
        (F.col("_fp") / 10).alias("fp_pred"),
        (F.col("_sp") / 10).alias("starting_probability"),
        "role",
    )


def stat_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full stat lines (one per lineitem row) for rule-table scoring."""
    li = read_table(spark, sf_dir, "lineitem")
    ln, pk, sk, ok = F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_orderkey")
    role = F.when(ln % 4 == 0, "Wicketkeeper").when(ln % 4 == 1, "Batter").when(ln % 4 == 2, "Allrounder").otherwise("Bowler")
    return li.select(
        ok.alias("match_id"), pk.alias("player_id"), ln.alias("line_no"), role.alias("role_std"),
        (pk % 131).alias("runs_batting"), (1 + sk % 60).alias("balls_faced"), (pk % 7).alias("fours"),
        (sk % 5).alias("sixes"), (F.col("l_returnflag") == "R").alias("is_out"), (ln % 6).alias("wickets_taken"),
        (sk % 3).alias("maidens"), (pk % 19).alias("dot_balls_bowled"), (ln % 3).alias("bowled_lbw_dismissals"),
        (sk % 5).alias("overs_bowled"), (pk % 61).alias("runs_conceded"), (ok % 5).alias("catches_taken"),
        (ok % 2).alias("stumpings_made"), (sk % 2).alias("run_outs"),
    )


@dataclass(frozen=True)
class Datasets:
    """The engine's inputs. Optional members may be None (features degrade to defaults)."""

    innings: DataFrame
    profiles: DataFrame | None = None
    venue_stats: DataFrame | None = None
    deliveries: DataFrame | None = None
    matchstat: DataFrame | None = None


def materialize_views(spark: SparkSession, sf_dir: str) -> None:
    """Store the derived views up front, in dependency waves; views of a wave are independent Spark
    jobs and run concurrently (the scheduler interleaves their stages on the executors)."""
    from concurrent.futures import ThreadPoolExecutor

    waves = [(innings, venue_stats), (matchstat, requests), (predictions,)]
    with ThreadPoolExecutor(max_workers=2) as pool:
        for wave in waves:
            list(pool.map(lambda view: view(spark, sf_dir), wave))


def reset_views(spark: SparkSession) -> None:
    """Forget this session's stored views and delete their folders: call it after the input folder changed, and
    at the end of a run. Frames built on the views before can't be read afterwards."""
    jvm = spark.sparkContext._jvm
    for key in [k for k in _STORED if k[0] == spark.sparkContext.applicationId]:
        for file in _STORED.pop(key).inputFiles()[:1]:
            folder = jvm.org.apache.hadoop.fs.Path(file).getParent()
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def load_datasets(spark: SparkSession, sf_dir: str) -> Datasets:
    """All domain views of a scale-factor folder; lazy, no action is run."""
    inn = innings(spark, sf_dir)
    return Datasets(
        innings=inn,
        profiles=profiles(spark, sf_dir),
        venue_stats=venue_stats(spark, sf_dir),
        deliveries=deliveries(spark, sf_dir),
        matchstat=matchstat(spark, sf_dir),
    )
