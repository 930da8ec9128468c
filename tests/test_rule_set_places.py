"""Rule-set steps: names are resolved once a rule set, values taken once a line, and every place of a long list of edges is found."""

import re

import pytest
from pyspark.sql import functions as F

from anchorwise.operators import rule_sets as RS
from anchorwise.operators import scoring as S
from anchorwise.sources import fixtures as fx
from tests.conftest import SF0001


def _above_the_join(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString().split("Join LeftOuter")[0]


@pytest.mark.parametrize("how", [RS.score_rule_sets, lambda lines, rules: RS.explain_rule_sets(lines, rules, ["match_id"])])
def test_a_line_looks_no_name_up(spark, how):
    lines = fx.stat_lines(spark, SF0001).withColumn("rule_set", F.lit("s"))
    top = _above_the_join(how(lines, S.rules_frame(spark).withColumn("rule_set", F.lit("s"))))
    assert not re.search(r"\bmap\(", top) and top.count(" / ") + top.count("try_divide") <= 1


@pytest.mark.parametrize("how", [RS.score_rule_sets, lambda lines, rules: RS.explain_rule_sets(lines, rules, ["match_id"])])
def test_a_step_is_searched_once(spark, how):
    lines = fx.stat_lines(spark, SF0001).withColumn("rule_set", F.lit("s"))
    top = _above_the_join(how(lines, S.rules_frame(spark).withColumn("rule_set", F.lit("s"))))
    assert top.count(".strides") == 1


def test_long_lists_of_edges_and_odd_values(spark):
    step = {f.name: None for f in S.RULE_SCHEMA}
    bands = [{**step, "section": "x", "kind": "band", "rule_group": "g", "name": f"b{i}", "column": "v", "min": float(i), "max": i + 0.5,
              "points": float(i + 1), "priority": i, "stacked": False} for i in range(37)]
    unit = {**step, "section": "y", "kind": "linear", "rule_group": "u", "name": "u", "column": "w", "points": 2.0, "priority": 0, "stacked": False}
    lacking = {**unit, "section": "z", "name": "lacks", "column": "nowhere"}
    guarded = {**unit, "section": "z", "name": "guarded", "guard_column": "v", "guard_min": 30.0}
    rules = spark.createDataFrame([tuple(r[f.name] for f in S.RULE_SCHEMA) for r in [*bands, unit, lacking, guarded]], S.RULE_SCHEMA)
    values = [k / 4 for k in range(-4, 160)] + [float("nan"), float("inf"), float("-inf"), None]
    lines = spark.createDataFrame([(v, 3) for v in values], "v double, w int").withColumn("rule_set", F.lit("s")) \
        .withColumn("role_std", F.lit("Batter")).withColumn("is_out", F.lit(True))
    got = RS.score_rule_sets(lines, rules.withColumn("rule_set", F.lit("s"))).select("v", "section_points", "total_points").collect()
    assert len(got) == len(values)
    for r in got:
        v = r["v"]
        band = v + 1 if v is not None and v >= 0 and v < 37 and v == int(v) else None
        if band is None:
            band = next((i + 1.0 for i in range(37) if v is not None and i <= v <= i + 0.5), 0.0)
        guard = 6.0 if v is not None and (v >= 30 or v != v) else 0.0  # NaN lies above all
        assert r["section_points"] == {"x": band, "y": 6.0, "z": guard} and r["total_points"] == band + 6.0 + guard, r
