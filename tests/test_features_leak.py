"""Leak tests: facts on or after the cutoff never change as-of features; the career count does (Q18)."""

from pyspark.sql import functions as F

from anchorwise.operators import anchors as A
from anchorwise.operators import features as FE
from anchorwise.sources import fixtures as fx
from tests.conftest import SF0001

SPLIT = "2022-06-01"


def test_future_rows_do_not_change_features(spark):
    ds = fx.load_datasets(spark, SF0001)
    anc = A.training_anchors(ds.innings, SPLIT)
    past = ds.innings.where(F.col("match_date") < F.lit(SPLIT).cast("date"))
    full = FE.build_features(anc, ds.innings, ds.deliveries, fx.matchstat(spark, SF0001, ds.innings), ds.venue_stats,
                             keep=["match_id", "player_id"])
    cut = FE.build_features(anc, past, ds.deliveries, fx.matchstat(spark, SF0001, past), ds.venue_stats,
                            keep=["match_id", "player_id"])
    asof_cols = [c for c in FE.FEATURES if c != "player_career_matches_at_venue"] + ["prior_matches_at_venue", "is_valid"]
    a = full.select("match_id", "player_id", *asof_cols)
    b = cut.select("match_id", "player_id", *asof_cols)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    career = full.select("match_id", "player_id", "player_career_matches_at_venue").exceptAll(
        cut.select("match_id", "player_id", "player_career_matches_at_venue"))
    assert career.count() > 0  # the reference's venue count sees the future


def test_defaults_for_players_without_history(spark):
    ds = fx.load_datasets(spark, SF0001)
    anc = spark.createDataFrame([(10 ** 9, "2022-05-01", 3, 0)], "player_id long, cutoff_date string, venue_id long, opposition_id long") \
        .withColumn("cutoff_date", F.col("cutoff_date").cast("date"))
    f = FE.build_features(anc, ds.innings, ds.deliveries, ds.matchstat, ds.venue_stats).collect()[0]
    assert f["runs_match_1_ago"] == 20.0 and f["was_out_match_3_ago"] == 1 and f["data_availability"] == 0
    assert f["max_fantasy_score_current_year"] == 50.0 and f["total_matches_current_year"] == 0
    assert f["powerplay_boundaries_last_match"] == 2 and f["total_boundaries_last_match"] == 3
    assert f["opposition_runs_conceded_last_match"] == 160 and f["opposition_matches_won_last_5"] == 2
    assert f["player_career_matches_at_venue"] == 0 and f["is_valid"]


def test_bucket_granularity_does_not_change_results(spark):
    """Month buckets (hot players split finer) and season buckets give the same history."""
    ds = fx.load_datasets(spark, SF0001)
    anc = A.training_anchors(ds.innings)
    cols = ["match_id", "player_id", "_n", "_hist", "_cur_rows", "_cur_pts", "_cur_max", "_cur_min", "_cur_over",
            "_cur_under", "_prev_rows", "_prev_pts", "_venue_prior", "_venue_career"]
    m = FE.player_history(ds.innings, anc, bucket="month").select(*cols)
    s = FE.player_history(ds.innings, anc, bucket="season").select(*cols)
    assert m.exceptAll(s).count() == 0 and s.exceptAll(m).count() == 0


def test_absent_optional_tables_give_defaults(spark):
    """No deliveries, results or venue table -> those feature groups use their defaults."""
    ds = fx.load_datasets(spark, SF0001)
    anc = A.training_anchors(ds.innings)
    f = FE.build_features(anc, ds.innings, None, None, None, keep=["match_id", "player_id"])
    bad = f.where(
        (F.col("powerplay_boundaries_last_match") != 2) | (F.col("total_balls_faced_last_match") != 20)
        | (F.col("venue_total_matches") != 50) | (F.col("venue_highest_score") != 200)
        | (F.col("high_scoring_venue") != 0) | ~F.col("is_valid")
        | ((F.col("opposition_matches_won_last_5") != 2) & (F.col("src_opposition") == "used_real_data")))
    assert f.count() > 0 and bad.count() == 0


def test_hot_player_is_split_across_window_partitions(spark):
    """A player holding half of all rows: month buckets spread it over many window partitions,
    with the same results as one partition per season."""
    ds = fx.load_datasets(spark, SF0001)
    hot = ds.innings.withColumn("match_id", F.col("match_id") * 1000 + F.col("player_id")).withColumn(
        "player_id", F.lit(10 ** 6).cast("long"))
    inn = ds.innings.unionByName(hot)
    assert hot.count() * 2 == inn.count()
    buckets = hot.select((F.year("match_date") * 12 + F.month("match_date")).alias("b")).distinct().count()
    assert buckets >= 10  # the hot player's rows land in >= 10 (player, month) window partitions
    anc = A.training_anchors(hot)
    cols = ["match_id", "player_id", "_n", "_hist", "_cur_rows", "_cur_pts", "_cur_max", "_cur_min", "_prev_rows",
            "_venue_prior", "_venue_career"]
    m = FE.player_history(inn, anc, bucket="month").select(*cols)
    s = FE.player_history(inn, anc, bucket="season").select(*cols)
    assert m.exceptAll(s).count() == 0 and s.exceptAll(m).count() == 0
