"""Per-request enrichment of predictions.

Every statistic the reference computes over "the" prediction list is computed
per ``request_id``: request-level aggregates come from one grouped aggregate
(partial aggregation, one row per request) joined back on the key. Quantiles and
ranks of requests too large for one task are those of ``hot_groups``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cleaning import clean_key, clean_name, first_present
from ..functions.roles import credit_role_bonus, standardize_role
from .hot_groups import HOT_ROWS, group_quantiles, with_positions

# Fixed values of the confidence, credit and category rules.
CONF_STD_BANDS = ((5.0, 0.3), (15.0, 0.6))   # std < 5 -> .3, < 15 -> .6, else .8
CONF_HIGH, CONF_TANH_W, CONF_EPS, CONF_CLIP = 0.8, 0.2, 1e-8, (0.2, 0.95)
CREDIT_BASE, CREDIT_SCALE, CREDIT_TOP_PCT, CREDIT_TOP_BONUS, CREDIT_STD = 9.0, 3.0, 0.8, 0.5, 15.0
CREDIT_CLIP = (7.0, 12.5)
CATEGORY_QUANTILES = (0.25, 0.5, 0.75, 0.9)
DEFAULT_ROLE = "Batter"


def request_stats(preds: DataFrame, score: str = "fp_pred") -> DataFrame:
    """One row per request: mean and sample std of the score."""
    return preds.groupBy("request_id").agg(F.avg(score).alias("_mean"), F.stddev_samp(score).alias("_std"))


def profile_lookup(profiles: DataFrame) -> DataFrame:
    """Cleaned profile keys, one row per player (first by name order)."""
    name_col = first_present(profiles, ["name", "player_name", "full_name"])
    p = profiles.select(
        clean_key(F.col("player_id")).alias("player_id"),
        F.col("role").alias("profile_role") if "role" in profiles.columns else F.lit(None).cast("string").alias("profile_role"),
        (clean_name(F.col(name_col)) if name_col else F.lit(None).cast("string")).alias("profile_name"),
    ).where(F.col("player_id").isNotNull())
    w = Window.partitionBy("player_id").orderBy(F.col("profile_name").asc_nulls_last(), F.col("profile_role").asc_nulls_last())
    return p.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def with_profiles(preds: DataFrame, profiles: DataFrame | None, role_from_profile: bool = False) -> DataFrame:
    """J8 + P18: attach name (and optionally role); missing role -> Batter, missing name -> Player_<id>."""
    if profiles is not None:
        preds = preds.join(profile_lookup(profiles), "player_id", "left")
    else:
        preds = preds.withColumn("profile_name", F.lit(None).cast("string")).withColumn(
            "profile_role", F.lit(None).cast("string"))
    role = F.col("profile_role") if role_from_profile or "role" not in preds.columns else F.col("role")
    out = preds.withColumn("role", F.coalesce(role, F.lit(DEFAULT_ROLE))).withColumn(
        "name", F.coalesce(F.col("profile_name"), F.concat(F.lit("Player_"), F.col("player_id").cast("string"))))
    return out.drop("profile_name", "profile_role")


def confidence(score: Column, mean: Column, std: Column) -> Column:
    """Base by std band + .2 tanh(|z|), clipped."""
    base = F.when(std < CONF_STD_BANDS[0][0], CONF_STD_BANDS[0][1]).when(std < CONF_STD_BANDS[1][0], CONF_STD_BANDS[1][1]) \
        .otherwise(CONF_HIGH)
    z = F.abs(score - mean) / (std + F.lit(CONF_EPS))
    return F.least(F.greatest(base + F.lit(CONF_TANH_W) * F.tanh(z), F.lit(CONF_CLIP[0])), F.lit(CONF_CLIP[1]))


def average_rank_pct() -> Column:
    """Pandas ``rank(pct=True)`` (average rank of ties / n); not percent_rank or cume_dist."""
    return (F.col("_low") + (F.col("_ties") - 1) / F.lit(2.0)) / F.col("_n")


def enrich_predictions(preds: DataFrame, profiles: DataFrame | None = None, score: str = "fp_pred",
                       hot_rows: int = HOT_ROWS) -> DataFrame:
    """Profile join, confidence, credits, rank, percentile, variance category per request."""
    p = with_profiles(preds, profiles)
    quantiles = group_quantiles(preds, "request_id", score, CATEGORY_QUANTILES, hot_rows)
    p = with_positions(p, "request_id", score, "player_id", hot_rows)
    p = p.join(request_stats(preds, score).join(quantiles, "request_id"), "request_id")
    s = F.col(score)
    pct = average_rank_pct()
    credits = F.lit(CREDIT_BASE) + pct * F.lit(CREDIT_SCALE) + credit_role_bonus(F.col("role"))
    credits = F.when((F.col("_std") > CREDIT_STD) & (pct >= CREDIT_TOP_PCT), credits + F.lit(CREDIT_TOP_BONUS)).otherwise(credits)
    q = F.col("_q")
    category = (F.when(s >= q[3], "High Variance").when(s >= q[2], "Above Average").when(s >= q[1], "Average")
                .when(s >= q[0], "Below Average").when(s < q[0], "Low Variance").otherwise("Medium"))
    out = p.select(
        "*",
        confidence(s, F.col("_mean"), F.col("_std")).alias("prediction_confidence"),
        F.least(F.greatest(credits, F.lit(CREDIT_CLIP[0])), F.lit(CREDIT_CLIP[1])).alias("credits"),
        F.col("_rank").alias("predicted_rank"),
        category.alias("variance_category"),
    )
    out = out.withColumn("percentile", (F.lit(1.0) - (F.col("predicted_rank") - 1) / F.col("_n")) * 100)
    return out.drop("_n", "_mean", "_std", "_q", "_rank", "_low", "_ties")


def with_role_std(df: DataFrame, role: str = "role") -> DataFrame:
    return df.withColumn("role_std", standardize_role(F.col(role)))


def dedupe_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Keep the first row per key under an explicit order (``dropDuplicates`` picks arbitrarily)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def top_n(df: DataFrame, n: int, score: str = "fp_pred", part: str = "request_id") -> DataFrame:
    """Top ``n`` per request; Spark plans a WindowGroupLimit below the window, so a task passes on n rows a request."""
    w = Window.partitionBy(part).orderBy(F.col(score).desc(), F.col("player_id").asc())
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
