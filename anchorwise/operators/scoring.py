"""Rule-table scoring of stat lines.

A nested rule document is flattened into a small rules table (one row per
rule or band). Scoring compiles that table into ONE Column expression tree
(sums and CASE chains), so scoring stays inside whole-stage codegen with no
join and no UDF; the explained score unpivots the per-rule points.

Band evaluation (our decision, the reference has no code): bounds inclusive,
null = unbounded, first listed band wins, no band = 0 points.

The document drives all of it: stat columns, the two columns and the scale of a rate
(``column_runs``, ``column_balls`` and ``scale``; ``columns`` of the economy rate), the value and the
dismissal flag of the duck, and its flags. A ``special_rules`` flag set to false
makes the group's bands add up (every band whose lower bound is reached counts);
``negative_points_below_sr`` ends negative bands at that rate.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.roles import ROLE_KEYWORDS

# The scoring rule document, as the reference ships it (natural order).
SCORING_RULES = {
    "batting": {
        "direct": [
            {"name": "Run", "column": "runs_batting", "points_per_unit": 1},
            {"name": "Boundary Bonus", "column": "fours", "points_per_unit": 4},
            {"name": "Six Bonus", "column": "sixes", "points_per_unit": 6},
        ],
        "milestones": [
            {"name": "Century Bonus", "column": "runs_batting", "min": 100, "max": None, "points": 16},
            {"name": "75 Run Bonus", "column": "runs_batting", "min": 75, "max": 99, "points": 12},
            {"name": "Half-Century Bonus", "column": "runs_batting", "min": 50, "max": 74, "points": 8},
            {"name": "25 Run Bonus", "column": "runs_batting", "min": 25, "max": 49, "points": 4},
        ],
        "strike_rate": {
            "column_sr": "strike_rate_batting",
            "column_balls": "balls_faced",
            "min_balls": 10,
            "ranges": [
                {"min": 170.01, "max": None, "points": 6},
                {"min": 150.01, "max": 170.0, "points": 4},
                {"min": 130.0, "max": 150.0, "points": 2},
                {"min": 60.0, "max": 70.0, "points": -2},
                {"min": 50.0, "max": 59.99, "points": -4},
                {"min": None, "max": 50.0, "points": -6},
            ],
            "negative_points_below_sr": 70,
        },
        "duck": {
            "column_runs": "runs_batting",
            "column_out": "out",
            "condition_runs": 0,
            "condition_out": True,
            "points": -2,
            "player_types": ["Batter", "Wicket-Keeper", "All-Rounder"],
        },
        "special_rules": {"century_overrides_lower_bonuses": True},
    },
    "bowling": {
        "direct": [
            {"name": "Maiden Over", "column": "maidens", "points_per_unit": 12},
            {"name": "Wicket", "column": "wickets_taken", "points_per_unit": 30},
            {"name": "Dot Ball", "column": "dot_balls_bowled", "points_per_unit": 1},
            {"name": "Bonus (LBW/Bowled)", "column": "bowled_lbw_dismissals", "points_per_unit": 8},
        ],
        "wicket_bonuses": [
            {"name": "3 Wicket Bonus", "column": "wickets_taken", "min": 3, "max": 3, "points": 4},
            {"name": "4 Wicket Bonus", "column": "wickets_taken", "min": 4, "max": 4, "points": 8},
            {"name": "5 Wicket Bonus", "column": "wickets_taken", "min": 5, "max": None, "points": 12},
        ],
        "economy_rate": {
            "columns": {"overs_bowled": "overs_bowled", "runs_conceded": "runs_conceded", "economy_rate": "economy_rate"},
            "min_overs": 2.0,
            "ranges": [
                {"min": None, "max": 5.0, "points": 6},
                {"min": 5.0, "max": 5.99, "points": 4},
                {"min": 6.0, "max": 7.0, "points": 2},
                {"min": 10.0, "max": 11.0, "points": -2},
                {"min": 11.01, "max": 12.0, "points": -4},
                {"min": 12.01, "max": None, "points": -6},
            ],
        },
        "special_rules": {"wicket_bonus_highest_only": True},
    },
    "fielding": {
        "direct": [
            {"name": "Catch", "column": "catches_taken", "points_per_unit": 8},
            {"name": "Stumping", "column": "stumpings_made", "points_per_unit": 12},
            {"name": "Run out (Direct hit)", "column": "run_outs", "points_per_unit": 12},
        ],
        "catch_bonus": {"column": "catches_taken", "min_catches": 3, "points": 4},
    },
}

RULE_SCHEMA = T.StructType([
    T.StructField("section", T.StringType()),
    T.StructField("kind", T.StringType()),     # linear | band | rate_band | duck | threshold
    T.StructField("rule_group", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("column", T.StringType()),
    T.StructField("min", T.DoubleType()),
    T.StructField("max", T.DoubleType()),
    T.StructField("points", T.DoubleType()),
    T.StructField("guard_column", T.StringType()),
    T.StructField("guard_min", T.DoubleType()),
    T.StructField("roles", T.ArrayType(T.StringType())),
    T.StructField("priority", T.IntegerType()),
    T.StructField("denominator", T.StringType()),  # rates: scale * column / denominator
    T.StructField("scale", T.DoubleType()),
    T.StructField("out_column", T.StringType()),
    T.StructField("out_value", T.BooleanType()),
    T.StructField("stacked", T.BooleanType()),     # bands reached add up
])

DISMISSED = "out"  # the document's name for the dismissal flag; lines carry it as ``out_col``
# Flags that say a band group is exclusive (set to false: its bands add up).
EXCLUSIVE_FLAGS = {"milestones": "century_overrides_lower_bonuses", "wicket_bonuses": "wicket_bonus_highest_only"}


def _std_role(text: str) -> str:
    up = text.upper()
    for role, keys in ROLE_KEYWORDS:
        if any(k in up for k in keys):
            return role
    return "Batter"


@dataclass(frozen=True)
class Rule:
    section: str
    kind: str
    rule_group: str
    name: str
    column: str
    min: float | None = None
    max: float | None = None
    points: float = 0.0
    guard_column: str | None = None
    guard_min: float | None = None
    roles: tuple[str, ...] | None = None
    priority: int = 0
    denominator: str | None = None
    scale: float | None = None
    out_column: str | None = None
    out_value: bool | None = None
    stacked: bool = False


def _num(x) -> float | None:
    return None if x is None else float(x)


def _rate_rules(section: str, group: str, name: str, body: dict, columns: tuple[str, str], scale: float, guard: float,
                negative_below: float | None = None) -> list[Rule]:
    """The bands of a rate, whose two columns, scale and smallest denominator the document gives."""
    out = []
    for i, r in enumerate(body["ranges"]):
        high = _num(r.get("max"))
        if negative_below is not None and r["points"] < 0:
            high = negative_below if high is None else min(high, negative_below)
        out.append(Rule(section, "rate_band", group, name, columns[0], _num(r.get("min")), high, float(r["points"]), columns[1], guard,
                        priority=i, denominator=columns[1], scale=scale))
    return out


def flatten_rules(doc: dict) -> list[Rule]:
    """Nested rule document -> flat rule list, in document order."""
    out: list[Rule] = []
    for section, body in doc.items():
        flags = body.get("special_rules", {})
        for r in body.get("direct", []):
            out.append(Rule(section, "linear", f"{section}_direct", r["name"], r["column"], points=float(r["points_per_unit"])))
        for grp, flag in EXCLUSIVE_FLAGS.items():
            for i, r in enumerate(body.get(grp, [])):
                out.append(Rule(section, "band", grp, r["name"], r["column"], _num(r.get("min")), _num(r.get("max")), float(r["points"]),
                                priority=i, stacked=not flags.get(flag, True)))
        if "strike_rate" in body:
            sr = body["strike_rate"]
            out += _rate_rules(section, "strike_rate", "Strike Rate", sr, (sr.get("column_runs", "runs_batting"), sr["column_balls"]),
                               float(sr.get("scale", 100)), float(sr["min_balls"]), _num(sr.get("negative_points_below_sr")))
        if "economy_rate" in body:
            er = body["economy_rate"]
            out += _rate_rules(section, "economy_rate", "Economy Rate", er,
                               (er["columns"]["runs_conceded"], er["columns"]["overs_bowled"]),
                               float(er.get("scale", 1)), float(er["min_overs"]))
        if "duck" in body:
            d = body["duck"]
            roles = tuple(sorted({_std_role(t) for t in d["player_types"]}))
            runs = float(d.get("condition_runs", 0))
            out.append(Rule(section, "duck", "duck", "Duck", d["column_runs"], runs, runs, float(d["points"]), roles=roles,
                            out_column=d.get("column_out", DISMISSED), out_value=d.get("condition_out", True)))
        if "catch_bonus" in body:
            c = body["catch_bonus"]
            out.append(Rule(section, "threshold", "catch_bonus", "Catch Bonus", c["column"], min=float(c["min_catches"]),
                            points=float(c["points"])))
    return out


def rules_frame(spark: SparkSession, doc: dict | None = None) -> DataFrame:
    """The flat rules table (a handful of rows; broadcast-safe by construction)."""
    rules = flatten_rules(doc or SCORING_RULES)
    return spark.createDataFrame([(r.section, r.kind, r.rule_group, r.name, r.column, r.min, r.max, r.points,
                                   r.guard_column, r.guard_min, list(r.roles) if r.roles else None, r.priority,
                                   r.denominator, r.scale, r.out_column, r.out_value, r.stacked)
                                  for r in rules], RULE_SCHEMA)


def read_rules_json(spark: SparkSession, path: str) -> DataFrame:
    """Read a nested rule document with Spark's JSON reader and flatten it to the rules table."""
    raw = spark.read.option("multiLine", True).json(path)
    doc = json.loads(raw.toJSON().first())  # one small document, bounded by construction
    return rules_frame(spark, doc)


def rules_from_frame(rules: DataFrame) -> list[Rule]:
    """The rules table back as compile-time rules (a rule document is small by construction)."""
    out = []
    for r in rules.orderBy("section", "rule_group", "priority").collect():
        out.append(Rule(r["section"], r["kind"], r["rule_group"], r["name"], r["column"], r["min"], r["max"],
                        r["points"], r["guard_column"], r["guard_min"],
                        tuple(r["roles"]) if r["roles"] is not None else None, r["priority"],
                        r["denominator"], r["scale"], r["out_column"], r["out_value"], bool(r["stacked"])))
    return out


def _value(rule: Rule) -> Column:
    """What a rule's bounds are held against: its column, or the rate of its two columns."""
    v = F.col(rule.column).cast("double")
    return v if rule.denominator is None else F.try_divide(v * F.lit(rule.scale), F.col(rule.denominator))


def _in_band(v: Column, lo: float | None, hi: float | None) -> Column:
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (v >= F.lit(float(lo)))
    if hi is not None:
        cond = cond & (v <= F.lit(float(hi)))
    return cond


def points_type(rules: list[Rule]) -> str:
    """Whole points stay long; one fractional rule makes all points double."""
    return "long" if all(r.points.is_integer() for r in rules) else "double"


def _points(rule: Rule, dtype: str) -> Column:
    return F.lit(int(rule.points) if dtype == "long" else rule.points)


def _linear(rule: Rule, dtype: str) -> Column:
    """Points of one per-unit rule, in the total and the explanation alike: a null stat scores nothing."""
    return F.coalesce((F.col(rule.column) * _points(rule, dtype)).cast(dtype), F.lit(0).cast(dtype))


def _reached(v: Column, rule: Rule, dtype: str) -> Column:
    """Points of a band that adds to the others: its lower bound is reached."""
    return F.when(_in_band(v, rule.min, None), _points(rule, dtype)).otherwise(F.lit(0)).cast(dtype)


def compile_rules(rules: list[Rule], role_col: str = "role_std", out_col: str = "is_out",
                  dtype: str | None = None) -> dict[str, Column]:
    """Rules -> {component name: points Column}. Components are the rule groups."""
    dtype = dtype or points_type(rules)
    groups: dict[str, list[Rule]] = {}
    for r in rules:
        groups.setdefault(r.rule_group, []).append(r)
    comps: dict[str, Column] = {}
    for g, rs in groups.items():
        kind = rs[0].kind
        if kind == "linear":
            expr = F.lit(0)
            for r in rs:
                expr = expr + _linear(r, dtype)
        elif kind in ("band", "rate_band"):
            v = _value(rs[0])
            if rs[0].stacked:
                expr = sum((_reached(v, r, dtype) for r in rs), F.lit(0))
            else:
                chain = F
                for r in sorted(rs, key=lambda r: r.priority):
                    chain = chain.when(_in_band(v, r.min, r.max), _points(r, dtype))
                expr = chain.otherwise(F.lit(0))
            if kind == "rate_band":
                expr = F.when(F.col(rs[0].guard_column) >= F.lit(rs[0].guard_min), expr).otherwise(F.lit(0))
        elif kind == "duck":
            r = rs[0]
            cond = _in_band(F.col(r.column), r.min, r.max) & F.col(role_col).isin(*r.roles)
            if r.out_value is not None:
                cond = cond & (F.col(out_col if r.out_column == DISMISSED else r.out_column) == F.lit(r.out_value))
            expr = F.when(cond, _points(r, dtype)).otherwise(F.lit(0))
        elif kind == "threshold":
            r = rs[0]
            expr = F.when(F.col(r.column) >= F.lit(r.min), _points(r, dtype)).otherwise(F.lit(0))
        else:  # pragma: no cover
            raise ValueError(kind)
        comps[g] = F.coalesce(expr, F.lit(0)).cast(dtype)
    return comps


def score_components(lines: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """Adds one points column per rule group plus section totals and the total (K1-K6)."""
    rules = rules or flatten_rules(SCORING_RULES)
    comps = compile_rules(rules)
    zero = F.lit(0).cast(points_type(rules))
    sections: dict[str, list[str]] = {}
    for r in rules:
        sections.setdefault(r.section, [])
        if r.rule_group not in sections[r.section]:
            sections[r.section].append(r.rule_group)
    out = lines.select("*", *[c.alias(n) for n, c in comps.items()])
    totals = [sum((F.col(g) for g in gs), zero).alias(f"{s}_points") for s, gs in sections.items()]
    out = out.select("*", *totals)
    return out.withColumn("total_points", sum((F.col(f"{s}_points") for s in sections), zero))


def explain_scores(lines: DataFrame, keys: list[str], rules: list[Rule] | None = None) -> DataFrame:
    """K7: one row per (line, firing rule) with its points; rules named as in the document."""
    rules = rules or flatten_rules(SCORING_RULES)
    dtype = points_type(rules)
    items = []
    for r in rules:
        if r.kind == "linear":
            items.append(F.struct(F.lit(r.name).alias("rule"), _linear(r, dtype).alias("points")))
        elif r.stacked:
            items.append(F.struct(F.lit(r.name).alias("rule"), _reached(_value(r), r, dtype).alias("points")))
    grouped = [r for r in rules if r.kind != "linear" and not r.stacked]
    comps = compile_rules(grouped, dtype=dtype)
    names = {r.rule_group: r for r in grouped}
    for g, expr in comps.items():
        r = names[g]
        if r.kind == "band":  # name the band that fired
            chain = None
            for b in sorted((x for x in rules if x.rule_group == g), key=lambda x: x.priority):
                cond = _in_band(F.col(b.column).cast("double"), b.min, b.max)
                chain = F.when(cond, F.lit(b.name)) if chain is None else chain.when(cond, F.lit(b.name))
            label = chain
        else:
            label = F.lit(r.name)
        items.append(F.struct(label.alias("rule"), expr.alias("points")))
    exploded = lines.select(*keys, F.explode(F.array(*items)).alias("_r"))
    return exploded.select(*keys, "_r.rule", "_r.points").where(F.col("points") != 0)
