"""Plan shape: the properties the design relies on at scale, asserted on the physical plans."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF0001


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["features_all", "prediction_features", "starting_probability", "select_team",
                                  "enrich_rank", "report_quality", "score_explained", "ts_folds"])
def test_no_cartesian_or_nested_loop(spark, name):
    p = _plan(E.queries()[name](spark, SF0001))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_asof_pass_shuffles_on_player_and_bucket(spark):
    p = _plan(E.queries()["recent_form"](spark, SF0001))
    assert "hashpartitioning(player_id" in p and "_b" in p.split("hashpartitioning(player_id", 1)[1].split(")")[0]


def test_scoring_is_one_projection(spark):
    p = _plan(E.queries()["score_total"](spark, SF0001))
    assert "Exchange" not in p and "Join" not in p


def test_scan_prunes_columns_and_pushes_filters(spark):
    from pyspark.sql import functions as F

    from anchorwise.sources.tables import read_table

    df = read_table(spark, SF0001, "lineitem").where(F.col("l_quantity") > 10).select("l_orderkey")
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,10.0)]" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in p
