"""Quantiles and ranks of a group that holds half of all rows: the plain forms' rows, spread over tasks."""

import pytest
from pyspark.sql import functions as F

from anchorwise.operators import enrich as EN
from anchorwise.operators import hot_groups as H
from anchorwise.operators import reports as R
from anchorwise.sources import fixtures as fx
from tests.conftest import SF001

PROBS = [0.0, 0.1, 0.25, 1 / 3, 0.5, 0.9, 1.0]


def _mixed(spark, n):
    """Request 1 holds half of the rows, and a third of those have one score."""
    v = F.xxhash64("id")
    score = F.when((F.col("id") % 2 == 0) & (F.col("id") % 3 == 0), F.lit(7.25)).when(
        F.col("id") % 1001 == 5, F.lit(None)).otherwise(F.pmod(v, F.lit(99_991)) / 7.0 - 500.0)
    request = F.when(F.col("id") % 2 == 0, F.lit(1)).otherwise(F.pmod(v, F.lit(40)) + 2)
    return spark.range(n).select(request.cast("long").alias("request_id"), F.col("id").alias("player_id"), score.alias("fp_pred"))


def test_quantiles_of_a_million_rows_are_those_of_percentile(spark):
    rows = _mixed(spark, 1_000_000).where("request_id = 1 or player_id < 20000")
    got = H.group_quantiles(rows, "request_id", "fp_pred", PROBS, hot_rows=100_000)
    want = rows.groupBy("request_id").agg(F.percentile("fp_pred", F.array(*map(F.lit, PROBS))).alias("_q"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    plan = H.exact_quantiles(rows.where("request_id = 1"), "request_id", "fp_pred", PROBS)._jdf.queryExecution().toString()
    assert "partial_count" in plan and "percentile" not in plan.lower().replace("exact_quantiles", "")


@pytest.mark.parametrize("values", [[5.0], [1.0, 1.0, 1.0], [1.0, 2.0], [0.0, 1e-9, 1e9, 1e9], [None, 3.0], [-1e300, 1e-300, 2.0, 1e300]])
def test_quantiles_of_odd_values(spark, values):
    rows = spark.createDataFrame([(1, v) for v in values], "g int, v double")
    got = H.exact_quantiles(rows, "g", "v", PROBS, bins=4).collect()
    want = rows.groupBy("g").agg(F.percentile("v", F.array(*map(F.lit, PROBS))).alias("_q")).collect()
    assert list(map(tuple, got)) == list(map(tuple, want))


def test_ranks_of_a_hot_request_are_the_windows_and_spread(spark):
    rows = _mixed(spark, 60_000)
    got = H.with_positions(rows, "request_id", "fp_pred", "player_id", hot_rows=5000)
    want = H._windowed(rows, "request_id", "fp_pred", "player_id")
    assert got.schema.simpleString() == want.schema.simpleString()
    assert got.exceptAll(want).count() == 0 and got.count() == 60_000
    hot = rows.where("request_id = 1").repartitionByRange(8, "request_id", F.desc("fp_pred"), "player_id")
    sizes = [r[1] for r in hot.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 30_000 / 4  # also the score that a third of them share is split


def test_reports_and_enrichment_do_not_depend_on_the_limit(spark):
    preds, profiles = fx.predictions(spark, SF001), fx.profiles(spark, SF001)
    for make in (lambda hot: EN.enrich_predictions(preds, profiles, hot_rows=hot), lambda hot: R.distribution_report(preds, hot_rows=hot), lambda hot: R.quality_report(preds, hot_rows=hot)):
        rows = [sorted(map(str, make(hot).select(*sorted(make(10**9).columns)).collect())) for hot in (10, 10**9)]
        assert rows[0] == rows[1]
