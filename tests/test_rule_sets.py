"""Rule sets as data give the compiled rules' points; odd rows have defined results."""

import random

import pytest
from pyspark.sql import functions as F

from anchorwise.operators import rule_sets as RS
from anchorwise.operators import scoring as S
from anchorwise.plans.scoring_queries import KEY, OTHER_RULES
from anchorwise.sources import fixtures as fx
from tests.conftest import SF0001


@pytest.mark.parametrize("doc", [S.SCORING_RULES, OTHER_RULES])
@pytest.mark.parametrize("limit", [RS.BROADCAST_BYTES, 0])
def test_equals_compiled_rules(spark, doc, limit):
    lines = fx.stat_lines(spark, SF0001).withColumn("rule_set", F.lit("s")).withColumn(
        "runs_conceded", F.when(F.col("player_id") % 7 != 0, F.col("runs_conceded")))
    rules = S.rules_frame(spark, doc).withColumn("rule_set", F.lit("s"))
    want = S.score_components(lines, S.flatten_rules(doc)).select(*KEY, F.col("total_points").cast("double"))
    got = RS.score_rule_sets(lines, rules, broadcast_bytes=limit).select(*KEY, "total_points")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    explained = RS.explain_rule_sets(lines, rules, KEY, broadcast_bytes=limit).groupBy(*KEY).agg(F.sum("points").alias("total_points"))
    nonzero = want.groupBy(*KEY).agg(F.sum("total_points").alias("total_points")).where("total_points <> 0")
    assert nonzero.exceptAll(explained).count() == 0


def _brute(bands, stacked, v):
    hit = [p for lo, hi, p in bands if (lo is None or v >= lo) and (stacked or hi is None or v <= hi)]
    return float(sum(hit) if stacked else hit[0] if hit else 0)


def test_cells_against_brute_force(spark):
    """Random bands: overlapping, touching, single points, unbounded, empty (low above high)."""
    rnd, rules, lines, want = random.Random(7), [], [], {}
    edges = [None, 0.0, 1.0, 2.0, 3.0, 4.0, 5.0]
    for k in range(60):
        bands = [(rnd.choice(edges), rnd.choice(edges), float(rnd.randrange(-5, 9))) for _ in range(rnd.randrange(1, 7))]
        stacked = k % 2 == 1
        rules += [("x", "band", "g", f"b{i}", "v", lo, hi, p, i, stacked, f"s{k}") for i, (lo, hi, p) in enumerate(bands)]
        for j in range(-2, 14):
            lines.append((f"s{k}", j / 2, "Batter"))
            want[f"s{k}", j / 2] = _brute(bands, stacked, j / 2)
    frame = spark.createDataFrame(rules, "section string, kind string, rule_group string, name string, column string, min double, max double,"
                                  " points double, priority int, stacked boolean, rule_set string")
    for f in S.RULE_SCHEMA:
        if f.name not in frame.columns:
            frame = frame.withColumn(f.name, F.lit(None).cast(f.dataType))
    table = spark.createDataFrame(lines, "rule_set string, v double, role_std string").withColumn("is_out", F.lit(True))
    got = {(r["rule_set"], r["v"]): r["total_points"] for r in RS.score_rule_sets(table, frame).collect()}
    assert got == want


def test_odd_rows(spark):
    rules = S.rules_frame(spark).withColumn("rule_set", F.lit("s"))
    lines = spark.createDataFrame(
        [("s", 1, 60.0, 3), ("s", 1, 60.0, 3), ("s", 2, None, None), (None, 3, 60.0, 3), ("none", 4, 60.0, 3)],
        "rule_set string, id long, runs_batting double, catches_taken int").withColumn("role_std", F.lit(None).cast("string")) \
        .withColumn("_steps", F.lit("clash")).withColumn("is_out", F.lit(None).cast("boolean"))
    out = sorted(((r["id"], r["total_points"]) for r in RS.score_rule_sets(lines, rules).collect()))
    assert out == [(1, 60 + 8 + 24 + 4), (1, 60 + 8 + 24 + 4), (2, 0.0), (3, None), (4, None)]
    assert RS.score_rule_sets(lines.limit(0), rules).count() == 0
    assert {r["total_points"] for r in RS.score_rule_sets(lines, rules.limit(0)).collect()} == {None}
    lacking = {r["column"] for r in RS.unknown_columns(lines, rules).collect()}
    assert {"fours", "balls_faced", "overs_bowled"} <= lacking and not lacking & {"runs_batting", "catches_taken", "is_out"}


def test_a_hot_rule_set_is_salted(spark):
    lines = fx.stat_lines(spark, SF0001).withColumn("rule_set", F.lit("s"))
    rules = S.rules_frame(spark).withColumn("rule_set", F.lit("s"))
    plan = RS.score_rule_sets(lines, rules, broadcast_bytes=0)._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_flags_of_the_document():
    doc = {"batting": {"strike_rate": {"column_balls": "b", "min_balls": 1, "negative_points_below_sr": 50,
                                       "ranges": [{"min": 40, "max": 90, "points": -2}, {"min": None, "max": None, "points": 1}]}}}
    rules = S.flatten_rules(doc)
    assert [(r.column, r.denominator, r.scale, r.max) for r in rules] == [("runs_batting", "b", 100.0, 50.0),
                                                                          ("runs_batting", "b", 100.0, None)]
    assert all(r.stacked for r in S.flatten_rules(OTHER_RULES) if r.kind == "band")
    assert not any(r.stacked for r in S.flatten_rules(S.SCORING_RULES))
