"""Report tables (A7-A17, M13, M14, M16, G7): grouped aggregates, one row per request (or group).

Std follows the reference: numpy population std where it used numpy
(distribution report), pandas sample std elsewhere (Q20).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.roles import range_quality, system_quality, variance_quality
from .hot_groups import HOT_ROWS, group_quantiles

# Fixed values of the report rules.
DIST_QUANTILES = (0.10, 0.25, 0.50, 0.75, 0.90)
TIER_QUANTILES = (0.85, 0.60, 0.40, 0.15)
VARIANCE_THRESHOLD = 10.0
LOW, MID, HIGH, VERY_HIGH = 20.0, 50.0, 50.0, 70.0


def group_stats(df: DataFrame, keys: list[str], score: str = "fp_pred", minmax: bool = True) -> DataFrame:
    """Mean, sample std, count (and min, max) of the score per group."""
    aggs = [F.avg(score).alias("mean"), F.stddev_samp(score).alias("std"), F.count(score).alias("count")]
    if minmax:
        aggs += [F.min(score).alias("min"), F.max(score).alias("max")]
    return df.groupBy(*keys).agg(*aggs)


def level_report(df: DataFrame, levels: dict[str, str], score: str = "fp_pred", part: str = "request_id") -> DataFrame:
    """A7 + A8 + A10 + F11 in one pass: a row for each request (level ``request``) and for each value of every column of
    ``levels`` (level name -> column) within it, by grouping sets, so that one shuffle of partial aggregates serves all
    reports. ``item`` is the value as text, null in the request's row and where the value itself is null (``level``
    tells). Requests without a score have null figures and count 0. The request's row has the system quality label."""
    s = F.col(score)
    cols = list(levels.values())
    ids = {c: F.grouping(c) for c in cols}
    g = df.groupingSets([[part], *[[part, c] for c in cols]], part, *cols).agg(
        F.avg(s).alias("mean"), F.stddev_samp(s).alias("std"), F.count(s).alias("count"), F.min(s).alias("min"), F.max(s).alias("max"),
        F.count(F.when(s < LOW, 1)).alias("low_scores"),
        F.count(F.when((s >= LOW) & (s < MID), 1)).alias("medium_scores"),
        F.count(F.when(s >= HIGH, 1)).alias("high_scores"),
        F.count(F.when(s >= VERY_HIGH, 1)).alias("very_high_scores"),
        *[ids[c].alias(f"_g{i}") for i, c in enumerate(cols)])
    level, item = F, F
    for i, (name, c) in enumerate(levels.items()):
        here = F.col(f"_g{i}") == 0
        level, item = level.when(here, name), item.when(here, F.col(c).cast("string"))
    level = level.otherwise("request")
    stats = ["mean", "std", "count", "min", "max", "low_scores", "medium_scores", "high_scores", "very_high_scores"]
    return g.select(part, level.alias("level"), item.alias("item"), *stats,
                    F.when(level == "request", system_quality(F.col("std"))).alias("system_quality"))


def frequency(df: DataFrame, col: str, part: str = "request_id") -> DataFrame:
    """Value counts and share within the partition (request)."""
    c = df.groupBy(part, col).agg(F.count(F.lit(1)).alias("n"))
    return c.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(part)))


def distribution_report(df: DataFrame, score: str = "fp_pred", part: str = "request_id", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Spread, quantiles, score buckets, coefficient of variation."""
    s = F.col(score)
    g = df.groupBy(part).agg(
        F.count(s).alias("total_predictions"),
        F.avg(s).alias("mean"),
        F.stddev_pop(s).alias("std"),
        F.min(s).alias("min"),
        F.max(s).alias("max"),
        F.count(F.when(s < LOW, 1)).alias("low_scores"),
        F.count(F.when((s >= LOW) & (s < MID), 1)).alias("medium_scores"),
        F.count(F.when(s >= HIGH, 1)).alias("high_scores"),
        F.count(F.when(s >= VERY_HIGH, 1)).alias("very_high_scores"),
    )
    g = g.join(group_quantiles(df, part, score, DIST_QUANTILES, hot_rows), part, "left")
    return g.select(
        part, "total_predictions", "mean", "std", "min", "max",
        (F.col("max") - F.col("min")).alias("range"),
        *[F.col("_q")[i].alias(f"p{int(round(x * 100))}") for i, x in enumerate(DIST_QUANTILES)],
        "low_scores", "medium_scores", "high_scores", "very_high_scores",
        (F.col("std") >= VARIANCE_THRESHOLD).alias("sufficient_spread"),
        F.when(F.col("mean") > 0, F.col("std") / F.col("mean")).otherwise(F.lit(0.0)).alias("coefficient_of_variation"),
    )


def quality_report(df: DataFrame, score: str = "fp_pred", part: str = "request_id", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Variety, labels, flags and quantile tiers per request."""
    s = F.col(score)
    stats = df.groupBy(part).agg(
        F.count(s).alias("total_players"),
        F.avg(s).alias("avg_prediction"),
        F.min(s).alias("min_prediction"),
        F.max(s).alias("max_prediction"),
        F.stddev_samp(s).alias("prediction_std"),
        F.count_distinct(s).alias("unique_predictions"),
    )
    j = df.select(part, s).join(group_quantiles(df, part, score, TIER_QUANTILES, hot_rows), part, "left")
    q85, q60, q40, q15 = (F.col("_q")[i] for i in range(4))
    tiers = j.groupBy(part).agg(
        F.count(F.when(s >= q85, 1)).alias("tier_high_variance"),
        F.count(F.when((s >= q60) & (s < q85), 1)).alias("tier_above_average"),
        F.count(F.when((s >= q40) & (s < q60), 1)).alias("tier_average"),
        F.count(F.when((s >= q15) & (s < q40), 1)).alias("tier_below_average"),
        F.count(F.when(s < q15, 1)).alias("tier_low_variance"),
    )
    out = stats.join(tiers, part)
    std, rng = F.col("prediction_std"), F.col("max_prediction") - F.col("min_prediction")
    return out.select(
        part, "total_players", "avg_prediction", "min_prediction", "max_prediction", "prediction_std",
        "unique_predictions",
        (F.col("unique_predictions") / F.col("total_players")).alias("prediction_variety"),
        (std >= VARIANCE_THRESHOLD).alias("variance_maintained"),
        variance_quality(std).alias("variance_quality"),
        rng.alias("prediction_range_span"),
        range_quality(rng).alias("range_quality"),
        (std / F.lit(25.0)).alias("variance_score"),
        (F.col("unique_predictions") < F.col("total_players") * F.lit(0.8)).alias("many_duplicates"),
        (rng < F.lit(20)).alias("narrow_range"),
        "tier_high_variance", "tier_above_average", "tier_average", "tier_below_average", "tier_low_variance",
    )


# Columns the feature groups read from the innings table (P6 reports absent ones).
EXPECTED_INNINGS_COLUMNS = ["player_id", "match_id", "match_date", "team_id", "opposition_id", "ground_id",
                            "runs_batting", "fours", "sixes", "balls_faced", "out", "wickets_taken",
                            "runs_conceded", "innings_bowling", "fantasy_points"]


def dataset_profile(innings: DataFrame) -> DataFrame:
    """Rows, players, matches, date range and null counts per year (null dates in their own
    row), plus the expected columns the table lacks."""
    missing = ",".join(c for c in EXPECTED_INNINGS_COLUMNS if c not in innings.columns)
    return innings.groupBy(F.year("match_date").alias("year")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("player_id").alias("n_players"),
        F.count_distinct("match_id").alias("n_matches"),
        F.min("match_date").alias("first_date"),
        F.max("match_date").alias("last_date"),
        F.count(F.when(F.col("fantasy_points").isNull(), 1)).alias("null_points"),
        F.count(F.when(F.col("runs_batting").isNull(), 1)).alias("null_runs"),
    ).withColumn("missing_expected_columns", F.lit(missing))
