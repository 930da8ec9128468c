"""A step of a rule set does no more work a line than its points need; quotients, conditions and roles keep their results."""

import pytest
from pyspark.sql import functions as F

from anchorwise.operators import rule_sets as RS
from anchorwise.operators import scoring as S
from anchorwise.sources import fixtures as fx
from tests.conftest import SF0001


def _explained(lines, rules):
    return RS.explain_rule_sets(lines, rules, ["match_id"])


@pytest.mark.parametrize("how", [RS.score_rule_sets, _explained])
def test_no_slow_calls_a_line(spark, how):
    """array_contains leaves its loop by an exception, slice copies by way of a collection, and rows given by a lambda are not compiled."""
    lines = fx.stat_lines(spark, SF0001).withColumn("rule_set", F.lit("s"))
    plan = how(lines, S.rules_frame(spark).withColumn("rule_set", F.lit("s")))._jdf.queryExecution().optimizedPlan().toString()
    top = plan.split("Join LeftOuter")[0]
    assert not [f for f in ("array_contains(", "slice(", "inline(filter(") if f in top]


def test_quotients_conditions_and_roles(spark):
    step = {f.name: None for f in S.RULE_SCHEMA}
    rate = {**step, "section": "x", "kind": "band", "column": "v", "denominator": "d", "scale": 10.0, "points": 1.0, "priority": 0, "min": 5.0,
            "stacked": False}
    unit = {**step, "section": "y", "kind": "linear", "rule_group": "u", "column": "v", "points": 2.0, "priority": 0, "stacked": False}
    rules = [{**rate, "rule_group": "r1", "name": "r1"}, {**rate, "rule_group": "r2", "name": "r2", "points": 10.0},
             {**rate, "rule_group": "r3", "name": "r3", "scale": 100.0, "points": 100.0},
             {**rate, "rule_group": "r4", "name": "r4", "denominator": "lacks", "points": 1000.0},
             {**unit, "name": "per", "denominator": "d", "scale": 0.0}, {**unit, "name": "roles", "roles": ["A", "B"], "points": 0.5},
             {**unit, "name": "guard", "guard_column": "d", "guard_min": 2.0, "points": 0.25}]
    frame = spark.createDataFrame([tuple(r[f.name] for f in S.RULE_SCHEMA) for r in rules], S.RULE_SCHEMA).withColumn("rule_set", F.lit("s"))
    rows = [(v, d, role) for v in (None, 0.0, 1.0, 4.0) for d in (None, 0.0, 1.0, 2.0) for role in ("A", "C", None)]
    lines = spark.createDataFrame(rows, "v double, d double, role_std string").withColumn("rule_set", F.lit("s")).withColumn("is_out", F.lit(True))
    points = RS.score_rule_sets(lines, frame).collect()
    given = {}
    for r in RS.explain_rule_sets(lines, frame, ["v", "d", "role_std"]).collect():
        given.setdefault((r["v"], r["d"], r["role_std"]), {})[r["rule"]] = r["points"]
    assert len(points) == len(rows)
    for r in points:
        v, d, role = r["v"], r["d"], r["role_std"]
        want = {}
        if v is not None:
            q = v / d if d else None
            want = {"r1": 1.0 * (q is not None and 10 * q >= 5), "r2": 10.0 * (q is not None and 10 * q >= 5),
                    "r3": 100.0 * (q is not None and 100 * q >= 5), "per": 2 * v if q is not None else 0.0,
                    "roles": v / 2 if role == "A" else 0.0, "guard": v / 4 if d is not None and d >= 2 else 0.0}
        want = {k: p for k, p in want.items() if p}
        assert given.get((v, d, role), {}) == want and r["total_points"] == sum(want.values()), r
        assert r["section_points"] == {"x": sum(want.get(k, 0.0) for k in ("r1", "r2", "r3", "r4")),
                                       "y": sum(want.get(k, 0.0) for k in ("per", "roles", "guard"))}
