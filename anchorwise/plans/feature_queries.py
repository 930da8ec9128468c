"""Registered feature queries over the training anchors of the innings view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import anchors as A
from ..operators import features as FE
from ..sources import fixtures as fx

KEY = ["match_id", "player_id"]


def _anchors(spark: SparkSession, sf: str):
    ds = fx.load_datasets(spark, sf)
    return ds, A.training_anchors(ds.innings)


def recent_form(spark: SparkSession, sf: str) -> DataFrame:
    ds, a = _anchors(spark, sf)
    h = FE.player_history(ds.innings, a, parts=())
    return h.select(*KEY, *FE.recent_form_columns())


def season_archetype(spark: SparkSession, sf: str) -> DataFrame:
    ds, a = _anchors(spark, sf)
    h = FE.player_history(ds.innings, a, parts=("season",))
    return h.select(*KEY, *FE.archetype_columns()).drop("src_archetype")


def ball_phase_last_match(spark: SparkSession, sf: str) -> DataFrame:
    ds, a = _anchors(spark, sf)
    h = FE.with_ball_phase(FE.player_history(ds.innings, a, parts=(), deliveries=ds.deliveries))
    return h.select(*KEY, *FE.FEATURES[15:20], F.col("_ball_ok").alias("ball_valid"))


def _opposition(spark: SparkSession, sf: str) -> DataFrame:
    ds, a = _anchors(spark, sf)
    return FE.with_opposition(a, ds.innings, ds.matchstat)


def opposition_last_match(spark: SparkSession, sf: str) -> DataFrame:
    return _opposition(spark, sf).select(*KEY, *FE.FEATURES[20:22])


def opposition_bowlers_recent(spark: SparkSession, sf: str) -> DataFrame:
    return _opposition(spark, sf).select(*KEY, FE.FEATURES[22])


def opposition_wins_last5(spark: SparkSession, sf: str) -> DataFrame:
    return _opposition(spark, sf).select(*KEY, FE.FEATURES[23])


def venue_context(spark: SparkSession, sf: str) -> DataFrame:
    ds, a = _anchors(spark, sf)
    v = FE.with_venue(a, ds.venue_stats)
    return v.select(*KEY, *FE.FEATURES[24:29], F.col("_venue_ok").alias("venue_valid"))


def venue_experience(spark: SparkSession, sf: str) -> DataFrame:
    ds, a = _anchors(spark, sf)
    h = FE.player_history(ds.innings, a, parts=("venue",))
    return h.select(
        *KEY,
        F.coalesce(F.col("_venue_career"), F.lit(0)).cast("int").alias("player_career_matches_at_venue"),
        F.col("_venue_prior").cast("int").alias("prior_matches_at_venue"),
    )


def features_all(spark: SparkSession, sf: str) -> DataFrame:
    return all_features(*_anchors(spark, sf))


def all_features(ds: fx.Datasets, a: DataFrame) -> DataFrame:
    f = FE.build_features(a, ds.innings, ds.deliveries, ds.matchstat, ds.venue_stats,
                          keep=[*KEY, "match_date", "cutoff_date"])
    return f.drop("src_recent", "src_archetype", "src_ball", "src_opposition", "src_venue")


def features_valid(spark: SparkSession, sf: str) -> DataFrame:
    return features_all(spark, sf).where("is_valid").drop("is_valid")


def feature_provenance(spark: SparkSession, sf: str) -> DataFrame:
    """How many anchors used real data, proxies or defaults, per feature group."""
    ds, a = _anchors(spark, sf)
    f = FE.build_features(a, ds.innings, ds.deliveries, ds.matchstat, ds.venue_stats, keep=KEY)
    groups = ["src_recent", "src_archetype", "src_ball", "src_opposition", "src_venue"]
    stacked = f.select(F.explode(F.array(*[
        F.struct(F.lit(g[4:]).alias("feature_group"), F.col(g).alias("source")) for g in groups])).alias("s"))
    return stacked.groupBy("s.feature_group", "s.source").agg(F.count(F.lit(1)).alias("n_anchors"))


QUERIES = {
    "recent_form": recent_form,
    "season_archetype": season_archetype,
    "ball_phase_last_match": ball_phase_last_match,
    "opposition_last_match": opposition_last_match,
    "opposition_bowlers_recent": opposition_bowlers_recent,
    "opposition_wins_last5": opposition_wins_last5,
    "venue_context": venue_context,
    "venue_experience": venue_experience,
    "features_all": features_all,
    "features_valid": features_valid,
    "feature_provenance": feature_provenance,
}
