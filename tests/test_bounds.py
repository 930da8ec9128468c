"""Hot team-days, empty requests and stored views."""

import datetime as dt

from pyspark.sql import functions as F

from anchorwise.operators import features as FE
from anchorwise.operators import selection as SEL
from anchorwise.plans.registry import queries
from anchorwise.sources import fixtures as fx
from tests.conftest import SF0001


def test_hot_team_day_uses_its_last_rows(spark):
    """100,000 rows of one team on one day: bowlers are counted over the last 20 by (match, player)."""
    inn = spark.range(100_000).select(
        F.lit(3).cast("long").alias("team_id"), F.lit(dt.date(2022, 1, 5)).alias("match_date"),
        (F.col("id") % 1000).alias("match_id"), F.col("id").alias("player_id"),
        F.when(F.col("id") % 2 == 1, 1).alias("innings_bowling"), F.lit(1.0).alias("runs_conceded"), F.lit(1).alias("wickets_taken"))
    keys = spark.createDataFrame([(3, dt.date(2022, 1, 6))], "opposition_id long, cutoff_date date")
    got = FE.team_context(inn, None, keys).collect()[0]["_opp_last"]
    last = sorted((i % 1000, i) for i in range(100_000))[-FE.BOWLER_ROWS:]
    assert got["bowlers"] == sum(p % 2 for _, p in last) and got["nb"] == 50_000 and got["rc"] == 50_000.0


def test_feasibility_reports_requests_without_candidates(spark):
    preds = fx.predictions(spark, SF0001)
    low = preds.withColumn("starting_probability", F.when(F.col("request_id") > 5, F.col("starting_probability")).otherwise(F.lit(0.1)))
    rows = SEL.feasibility(SEL.selection_candidates(low), preds).collect()
    assert len(rows) == preds.select("request_id").distinct().count()
    empty = [r for r in rows if r["request_id"] <= 5]
    assert len(empty) == 6 and all(r["n_candidates"] == 0 and not r["feasible"] and r["likely_starters_warning"] for r in empty)


def test_request_queries_read_the_stored_requests(spark):
    for name in ("prediction_features", "starting_probability"):
        plan = queries()[name](spark, SF0001)._jdf.queryExecution().optimizedPlan().toString()
        assert "tkey" not in plan, name
