"""Anchors: the (player, match) rows that features are built for."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lookup import left_lookup

ID_BYTES = 16  # upper estimate of an id in a squad, for the check of what is broadcast


def training_anchors(innings: DataFrame, cutoff: str | None = None, gap_days: int = 1) -> DataFrame:
    """Innings before ``cutoff`` with a target; history ends ``gap_days`` before the match (Q1)."""
    cond = F.col("fantasy_points").isNotNull() & F.col("match_date").isNotNull()
    if cutoff is not None:
        cond = cond & (F.col("match_date") < F.lit(cutoff).cast("date"))
    return _as_anchor(innings.where(cond), gap_days)


def test_anchors(innings: DataFrame, start: str, end: str, gap_days: int = 1) -> DataFrame:
    """Innings in the half-open interval [start, end) with a target."""
    d = F.col("match_date")
    cond = (d >= F.lit(start).cast("date")) & (d < F.lit(end).cast("date")) & F.col("fantasy_points").isNotNull()
    return _as_anchor(innings.where(cond), gap_days)


def _as_anchor(rows: DataFrame, gap_days: int) -> DataFrame:
    return rows.select(
        "match_id",
        "player_id",
        "match_date",
        "team_id",
        "fantasy_points",
        F.date_sub("match_date", gap_days).alias("cutoff_date"),
        F.col("ground_id").alias("venue_id"),
        "opposition_id",
    )


def sample_anchors(anchors: DataFrame, n: int, seed: int = 42, key: tuple[str, ...] = ("match_id", "player_id")) -> DataFrame:
    """Exactly ``n`` anchors (all when fewer), chosen by a seeded hash of the key.

    Unlike ``DataFrame.sample`` this is exact in size and independent of the
    partitioning. The limit is the feature here; Spark plans it as a
    distributed top-n (TakeOrderedAndProject).
    """
    h = F.md5(F.concat_ws(":", *[F.col(c).cast("string") for c in key], F.lit(str(seed))))
    return anchors.orderBy(h, *key).limit(n)


def prediction_anchors(requests: DataFrame) -> DataFrame:
    """Requests -> anchors: one per request row, duplicates kept.

    The mock match is the day after the cutoff; the opposition is unknown
    unless the request carries it (then the real opposition path is used).
    """
    opp = F.col("opposition_id") if "opposition_id" in requests.columns else F.lit(None).cast("long")
    return requests.select(
        "request_id",
        "player_id",
        "team_no",
        F.col("cutoff_date").cast("date").alias("cutoff_date"),
        F.date_add(F.col("cutoff_date").cast("date"), 1).alias("match_date"),
        "venue_id",
        opp.alias("opposition_id"),
    )


def opponent_squads(requests: DataFrame, shown: Mapping[str, Callable[[Column], Column]] | None = None) -> DataFrame:
    """Attach the other team's squad (sorted ids, duplicates kept) to each request row.

    ``shown`` names the columns wanted and makes each from the squad, an array: once a squad, not once a row (default: the
    array as ``opponent_squad``). A row whose other team has nobody gets them made from an empty array.
    """
    shown = shown or {"opponent_squad": lambda squad: squad}
    squads = requests.groupBy("request_id", "team_no").agg(F.sort_array(F.collect_list("player_id")).alias("_squad"))
    other = squads.select(_team_key(F.lit(3) - F.col("team_no")), *[make(F.col("_squad")).alias(f"_of_{c}") for c, make in shown.items()])
    keyed = requests.select("request_id", "player_id", "team_no", _team_key(F.col("team_no")))
    out = left_lookup(keyed, other.where(F.col("_team").isNotNull()), "_team", requests.count() * ID_BYTES * len(shown), ["player_id"])
    nobody = F.array().cast("array<long>")
    return out.select("request_id", "player_id", "team_no",
                      *[F.coalesce(F.col(f"_of_{c}"), make(nobody)).alias(c) for c, make in shown.items()])


def _team_key(team_no: Column) -> Column:
    """One side of a request as a join key: null, which joins nothing, unless both parts are known."""
    known = F.col("request_id").isNotNull() & team_no.isNotNull()
    return F.when(known, F.struct(F.col("request_id").alias("request_id"), team_no.alias("team_no"))).alias("_team")
