"""Registered rule-scoring queries over every stat line, with hand-written oracles."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import rule_sets as RS
from ..operators import scoring as S
from ..sources import fixtures as fx
from ..sources.tables import read_table
from .views_sql import with_views

KEY = ["match_id", "player_id", "line_no"]


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    return S.score_components(fx.stat_lines(spark, sf))


def score_linear(spark: SparkSession, sf: str) -> DataFrame:
    return _scored(spark, sf).select(*KEY, "batting_direct", "bowling_direct", "fielding_direct")


def score_bands(spark: SparkSession, sf: str) -> DataFrame:
    return _scored(spark, sf).select(*KEY, "milestones", "strike_rate", "duck", "wicket_bonuses", "economy_rate",
                                     "catch_bonus")


def score_total(spark: SparkSession, sf: str) -> DataFrame:
    return _scored(spark, sf).select(*KEY, "batting_points", "bowling_points", "fielding_points", "total_points")


def score_explained(spark: SparkSession, sf: str) -> DataFrame:
    return S.explain_scores(fx.stat_lines(spark, sf), KEY)


def score_fractional(spark: SparkSession, sf: str) -> DataFrame:
    """K1 + K7 over stat lines with null stats and a rule set with a fractional rule: total and explained points of a
    key agree (a few keys have several lines)."""
    lines = fx.stat_lines(spark, sf).withColumn("fours", F.when(F.col("player_id") % 11 != 0, F.col("fours")))
    rules = [replace(r, points=0.5) if r.name == "Run" else r for r in S.flatten_rules(S.SCORING_RULES)]
    total = S.score_components(lines, rules).groupBy(*KEY).agg(F.sum("total_points").alias("total_points"))
    explained = S.explain_scores(lines, KEY, rules).groupBy(*KEY).agg(F.sum("points").alias("_explained"))
    return total.join(explained, KEY, "left").select(
        *KEY, "total_points", (F.coalesce("_explained", F.lit(0.0)) == F.col("total_points")).alias("explained"))


def score_rule_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Lines and points per rule over all stat lines, with the rules read from a JSON document."""
    import json

    from ..sources.sinks import output_path

    path = output_path(spark, "rules")
    spark.createDataFrame([(json.dumps(S.SCORING_RULES),)], "value string").coalesce(1).write.text(path)
    rules = S.rules_from_frame(S.read_rules_json(spark, path))
    ex = S.explain_scores(fx.stat_lines(spark, sf), KEY, rules)
    agg = ex.groupBy("rule").agg(F.count(F.lit(1)).alias("n_lines"), F.sum("points").alias("points"))
    return agg


# A second rule document: other stat columns, scales and conditions, and flags that the first one does not set.
OTHER_RULES = {
    "batting": {
        "direct": [{"name": "Run", "column": "runs_batting", "points_per_unit": 1},
                   {"name": "Boundary Bonus", "column": "fours", "points_per_unit": 0.5}],
        "milestones": [{"name": "Century Bonus", "column": "runs_batting", "min": 100, "max": None, "points": 16},
                       {"name": "Half-Century Bonus", "column": "runs_batting", "min": 50, "max": 99, "points": 8},
                       {"name": "25 Run Bonus", "column": "runs_batting", "min": 25, "max": 49, "points": 4}],
        "strike_rate": {"column_runs": "sixes", "column_balls": "balls_faced", "scale": 200, "min_balls": 20,
                        "ranges": [{"min": 15.0, "max": None, "points": 5}, {"min": 3.0, "max": 12.0, "points": -3},
                                   {"min": None, "max": 3.0, "points": -1}],
                        "negative_points_below_sr": 8},
        "duck": {"column_runs": "runs_batting", "column_out": "out", "condition_runs": 1, "condition_out": False,
                 "points": -7, "player_types": ["Bowler"]},
        "special_rules": {"century_overrides_lower_bonuses": False},
    },
    "bowling": {
        "direct": [{"name": "Wicket", "column": "wickets_taken", "points_per_unit": 20}],
        "wicket_bonuses": [{"name": "3 Wicket Bonus", "column": "wickets_taken", "min": 3, "max": 3, "points": 4},
                           {"name": "5 Wicket Bonus", "column": "wickets_taken", "min": 5, "max": None, "points": 12}],
        "economy_rate": {"columns": {"overs_bowled": "maidens", "runs_conceded": "dot_balls_bowled"}, "min_overs": 1,
                         "ranges": [{"min": None, "max": 4.0, "points": 6}, {"min": 9.0, "max": None, "points": -6}]},
        "special_rules": {"wicket_bonus_highest_only": False},
    },
    "fielding": {
        "direct": [{"name": "Catch", "column": "catches_taken", "points_per_unit": 8}],
        "catch_bonus": {"column": "stumpings_made", "min_catches": 1, "points": 3},
    },
}


def score_document(spark: SparkSession, sf: str) -> DataFrame:
    """K2, K3, K5: the columns, scales, conditions and flags come from the document, read as JSON."""
    import json

    from ..sources.sinks import output_path

    path = output_path(spark, "rules")
    spark.createDataFrame([(json.dumps(OTHER_RULES),)], "value string").coalesce(1).write.text(path)
    rules = S.rules_from_frame(S.read_rules_json(spark, path))
    return S.score_components(fx.stat_lines(spark, sf), rules).select(
        *KEY, "batting_direct", "milestones", "strike_rate", "duck", "wicket_bonuses", "economy_rate", "catch_bonus", "total_points")


def _season_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Stat lines with their season and format; each of the two names a rule set."""
    orders = read_table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("match_id"), F.year("o_orderdate").alias("season"), F.col("o_orderpriority").alias("format"))
    return fx.stat_lines(spark, sf).join(orders, "match_id").withColumn("rule_set", F.concat_ws("/", "season", "format"))


def _season_rules(spark: SparkSession, sf: str) -> DataFrame:
    """A rule set for each season and format of the table: odd seasons follow the second document, and points grow by a
    quarter for each season after one divisible by four."""
    orders = read_table(spark, sf, "orders")
    sets = orders.select(F.year("o_orderdate").alias("season"), F.col("o_orderpriority").alias("format")).distinct()
    docs = S.rules_frame(spark, S.SCORING_RULES).withColumn("_odd", F.lit(0)).unionByName(
        S.rules_frame(spark, OTHER_RULES).withColumn("_odd", F.lit(1)))
    return sets.withColumn("_odd", F.col("season") % 2).join(docs, "_odd").select(
        F.concat_ws("/", "season", "format").alias("rule_set"), *[c for c in docs.columns if c not in ("_odd", "points")],
        (F.col("points") * (1 + F.col("season") % 4 / 4)).alias("points"))


def score_season_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Each line under the rule set of its season and format, all rule sets in one job."""
    scored = RS.score_rule_sets(_season_lines(spark, sf), _season_rules(spark, sf))
    return scored.select(*KEY, "rule_set", *[F.col("section_points")[s].alias(f"{s}_points") for s in S.SCORING_RULES], "total_points")


def score_season_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Lines and points per rule set and rule."""
    explained = RS.explain_rule_sets(_season_lines(spark, sf), _season_rules(spark, sf), KEY)
    return explained.groupBy("rule_set", "rule").agg(F.count(F.lit(1)).alias("n_lines"), F.sum("points").alias("points"))


QUERIES = {
    "score_document": score_document,
    "score_season_rules": score_season_rules,
    "score_season_summary": score_season_summary,
    "score_linear": score_linear,
    "score_bands": score_bands,
    "score_total": score_total,
    "score_explained": score_explained,
    "score_rule_summary": score_rule_summary,
    "score_fractional": score_fractional,
}

_SR = "CAST(runs_batting AS DOUBLE) * 100 / balls_faced"
_ECON = "CAST(runs_conceded AS DOUBLE) / overs_bowled"
_PARTS = f"""sc AS (SELECT match_id, player_id, line_no,
  CAST(runs_batting * 1 + fours * 4 + sixes * 6 AS BIGINT) AS batting_direct,
  CAST(maidens * 12 + wickets_taken * 30 + dot_balls_bowled * 1 + bowled_lbw_dismissals * 8 AS BIGINT) AS bowling_direct,
  CAST(catches_taken * 8 + stumpings_made * 12 + run_outs * 12 AS BIGINT) AS fielding_direct,
  CAST(CASE WHEN runs_batting >= 100 THEN 16 WHEN runs_batting BETWEEN 75 AND 99 THEN 12
       WHEN runs_batting BETWEEN 50 AND 74 THEN 8 WHEN runs_batting BETWEEN 25 AND 49 THEN 4 ELSE 0 END AS BIGINT) AS milestones,
  CAST(CASE WHEN balls_faced < 10 THEN 0
       WHEN {_SR} >= CAST(170.01 AS DOUBLE) THEN 6
       WHEN {_SR} >= CAST(150.01 AS DOUBLE) AND {_SR} <= CAST(170.0 AS DOUBLE) THEN 4
       WHEN {_SR} >= CAST(130.0 AS DOUBLE) AND {_SR} <= CAST(150.0 AS DOUBLE) THEN 2
       WHEN {_SR} >= CAST(60.0 AS DOUBLE) AND {_SR} <= CAST(70.0 AS DOUBLE) THEN -2
       WHEN {_SR} >= CAST(50.0 AS DOUBLE) AND {_SR} <= CAST(59.99 AS DOUBLE) THEN -4
       WHEN {_SR} <= CAST(50.0 AS DOUBLE) THEN -6 ELSE 0 END AS BIGINT) AS strike_rate,
  CAST(CASE WHEN runs_batting = 0 AND is_out AND role_std IN ('Batter', 'Wicketkeeper', 'Allrounder') THEN -2 ELSE 0 END
       AS BIGINT) AS duck,
  CAST(CASE WHEN wickets_taken = 3 THEN 4 WHEN wickets_taken = 4 THEN 8 WHEN wickets_taken >= 5 THEN 12 ELSE 0 END
       AS BIGINT) AS wicket_bonuses,
  CAST(CASE WHEN overs_bowled < 2 THEN 0
       WHEN {_ECON} <= CAST(5.0 AS DOUBLE) THEN 6
       WHEN {_ECON} >= CAST(5.0 AS DOUBLE) AND {_ECON} <= CAST(5.99 AS DOUBLE) THEN 4
       WHEN {_ECON} >= CAST(6.0 AS DOUBLE) AND {_ECON} <= CAST(7.0 AS DOUBLE) THEN 2
       WHEN {_ECON} >= CAST(10.0 AS DOUBLE) AND {_ECON} <= CAST(11.0 AS DOUBLE) THEN -2
       WHEN {_ECON} >= CAST(11.01 AS DOUBLE) AND {_ECON} <= CAST(12.0 AS DOUBLE) THEN -4
       WHEN {_ECON} >= CAST(12.01 AS DOUBLE) THEN -6 ELSE 0 END AS BIGINT) AS economy_rate,
  CAST(CASE WHEN catches_taken >= 3 THEN 4 ELSE 0 END AS BIGINT) AS catch_bonus,
  CASE WHEN runs_batting >= 100 THEN 'Century Bonus' WHEN runs_batting BETWEEN 75 AND 99 THEN '75 Run Bonus'
       WHEN runs_batting BETWEEN 50 AND 74 THEN 'Half-Century Bonus' WHEN runs_batting BETWEEN 25 AND 49 THEN '25 Run Bonus'
  END AS milestone_label,
  CASE WHEN wickets_taken = 3 THEN '3 Wicket Bonus' WHEN wickets_taken = 4 THEN '4 Wicket Bonus'
       WHEN wickets_taken >= 5 THEN '5 Wicket Bonus' END AS wicket_label
FROM stat_lines)"""

# The second document as SQL, and both documents' bands as rows for a range join.
_OTHER = """oc AS (SELECT match_id, player_id, line_no,
  CAST(runs_batting + fours / CAST(2 AS DOUBLE) AS DOUBLE) AS batting_direct,
  CAST((CASE WHEN runs_batting >= 100 THEN 16 ELSE 0 END) + (CASE WHEN runs_batting >= 50 THEN 8 ELSE 0 END)
     + (CASE WHEN runs_batting >= 25 THEN 4 ELSE 0 END) AS DOUBLE) AS milestones,
  CAST(CASE WHEN balls_faced < 20 THEN 0 WHEN sixes * CAST(200 AS DOUBLE) / balls_faced >= 15 THEN 5
     WHEN sixes * CAST(200 AS DOUBLE) / balls_faced BETWEEN 3 AND 8 THEN -3
     WHEN sixes * CAST(200 AS DOUBLE) / balls_faced <= 3 THEN -1 ELSE 0 END AS DOUBLE) AS strike_rate,
  CAST(CASE WHEN runs_batting = 1 AND NOT is_out AND role_std = 'Bowler' THEN -7 ELSE 0 END AS DOUBLE) AS duck,
  CAST(wickets_taken * 20 AS DOUBLE) AS bowling_direct,
  CAST((CASE WHEN wickets_taken >= 3 THEN 4 ELSE 0 END) + (CASE WHEN wickets_taken >= 5 THEN 12 ELSE 0 END) AS DOUBLE) AS wicket_bonuses,
  CAST(CASE WHEN maidens < 1 THEN 0 WHEN CAST(dot_balls_bowled AS DOUBLE) / maidens <= 4 THEN 6
     WHEN CAST(dot_balls_bowled AS DOUBLE) / maidens >= 9 THEN -6 ELSE 0 END AS DOUBLE) AS economy_rate,
  CAST(catches_taken * 8 AS DOUBLE) AS fielding_direct,
  CAST(CASE WHEN stumpings_made >= 1 THEN 3 ELSE 0 END AS DOUBLE) AS catch_bonus
FROM stat_lines)"""
_OTHER_TOTAL = """batting_direct + milestones + strike_rate + duck + bowling_direct + wicket_bonuses + economy_rate
  + fielding_direct + catch_bonus"""


def _season_sql() -> str:
    """Range join: every step's value of a line (long form) against the bands of its document. Of exclusive bands the
    first listed counts, of others all whose lower bound is reached."""
    def val(x: float | None) -> str:
        return "NULL" if x is None else repr(float(x))

    rows = []
    for odd, doc in enumerate((S.SCORING_RULES, OTHER_RULES)):
        for r in S.flatten_rules(doc):
            if r.kind != "linear":
                step = r.name if r.stacked else r.rule_group
                high = None if r.stacked else r.max
                label = r.name if r.stacked or r.kind != "band" else r.rule_group
                rows.append(f"({odd}, '{r.section}', '{step}', '{label}', {r.priority}, {val(r.min)}, {val(high)}, {r.points!r})")
    values = [("milestones", "runs_batting", "0 = 0"), ("wicket_bonuses", "wickets_taken", "0 = 0")]
    even = [*values, ("strike_rate", _SR, "balls_faced >= 10"), ("economy_rate", _ECON, "overs_bowled >= 2"),
            ("duck", "runs_batting", "is_out AND role_std IN ('Batter', 'Wicketkeeper', 'Allrounder')"),
            ("catch_bonus", "catches_taken", "0 = 0")]
    stacked = [(n, c, "0 = 0") for n, c in (("Century Bonus", "runs_batting"), ("Half-Century Bonus", "runs_batting"),
               ("25 Run Bonus", "runs_batting"), ("3 Wicket Bonus", "wickets_taken"), ("5 Wicket Bonus", "wickets_taken"))]
    odd_steps = [*stacked, ("strike_rate", "sixes * CAST(200 AS DOUBLE) / balls_faced", "balls_faced >= 20"),
                 ("economy_rate", "CAST(dot_balls_bowled AS DOUBLE) / maidens", "maidens >= 1"),
                 ("duck", "runs_batting", "NOT is_out AND role_std = 'Bowler'"), ("catch_bonus", "stumpings_made", "0 = 0")]
    unit = [(0, "batting", "Run", "runs_batting"), (0, "batting", "Boundary Bonus", "fours * 4"), (0, "batting", "Six Bonus", "sixes * 6"),
            (0, "bowling", "Maiden Over", "maidens * 12"), (0, "bowling", "Wicket", "wickets_taken * 30"),
            (0, "bowling", "Dot Ball", "dot_balls_bowled"), (0, "bowling", "Bonus (LBW/Bowled)", "bowled_lbw_dismissals * 8"),
            (0, "fielding", "Catch", "catches_taken * 8"), (0, "fielding", "Stumping", "stumpings_made * 12"),
            (0, "fielding", "Run out (Direct hit)", "run_outs * 12"), (1, "batting", "Run", "runs_batting"),
            (1, "batting", "Boundary Bonus", "fours / CAST(2 AS DOUBLE)"), (1, "bowling", "Wicket", "wickets_taken * 20"),
            (1, "fielding", "Catch", "catches_taken * 8")]
    longs = "\nUNION ALL ".join(f"SELECT _i, season, '{n}' AS step, CAST({e} AS DOUBLE) AS v FROM sl WHERE season % 2 = {odd} AND {c}"
                                for odd, steps in enumerate((even, odd_steps)) for n, e, c in steps)
    units = "\nUNION ALL ".join(f"SELECT _i, season, '{s}' AS section, '{n}' AS rule, CAST({e} AS DOUBLE) AS p FROM sl WHERE season % 2 = {odd}"
                                for odd, s, n, e in unit)
    return f"""sl AS MATERIALIZED (SELECT ROW_NUMBER() OVER () AS _i, s.*, YEAR(o_orderdate) AS season,
  YEAR(o_orderdate) || '/' || o_orderpriority AS rule_set FROM stat_lines s JOIN orders ON o_orderkey = match_id),
bands(odd, section, step, rule, priority, lo, hi, points) AS (VALUES {", ".join(rows)}),
pts AS MATERIALIZED (SELECT _i, section, rule, points * (1 + season % 4 / CAST(4 AS DOUBLE)) AS p FROM (
  SELECT l._i, l.season, b.section, b.rule, CAST(b.points AS DOUBLE) AS points,
    ROW_NUMBER() OVER (PARTITION BY l._i, b.step ORDER BY b.priority) AS rn
  FROM ({longs}) l JOIN bands b ON b.odd = l.season % 2 AND b.step = l.step
    AND (b.lo IS NULL OR l.v >= b.lo) AND (b.hi IS NULL OR l.v <= b.hi)) WHERE rn = 1
UNION ALL SELECT _i, section, rule, p * (1 + season % 4 / CAST(4 AS DOUBLE)) FROM ({units}))"""


_EXPLAINED = """SELECT match_id, player_id, line_no, rule, points FROM (
  SELECT match_id, player_id, line_no, 'Run' AS rule, CAST(runs_batting AS BIGINT) AS points FROM stat_lines
  UNION ALL SELECT match_id, player_id, line_no, 'Boundary Bonus', CAST(fours * 4 AS BIGINT) FROM stat_lines
  UNION ALL SELECT match_id, player_id, line_no, 'Six Bonus', CAST(sixes * 6 AS BIGINT) FROM stat_lines
  UNION ALL SELECT match_id, player_id, line_no, 'Maiden Over', CAST(maidens * 12 AS BIGINT) FROM stat_lines
  UNION ALL SELECT match_id, player_id, line_no, 'Wicket', CAST(wickets_taken * 30 AS BIGINT) FROM stat_lines
  UNION ALL SELECT match_id, player_id, line_no, 'Dot Ball', CAST(dot_balls_bowled AS BIGINT) FROM stat_lines
  UNION ALL SELECT match_id, player_id, line_no, 'Bonus (LBW/Bowled)', CAST(bowled_lbw_dismissals * 8 AS BIGINT) FROM stat_lines
  UNION ALL SELECT match_id, player_id, line_no, 'Catch', CAST(catches_taken * 8 AS BIGINT) FROM stat_lines
  UNION ALL SELECT match_id, player_id, line_no, 'Stumping', CAST(stumpings_made * 12 AS BIGINT) FROM stat_lines
  UNION ALL SELECT match_id, player_id, line_no, 'Run out (Direct hit)', CAST(run_outs * 12 AS BIGINT) FROM stat_lines
  UNION ALL SELECT match_id, player_id, line_no, milestone_label, milestones FROM sc
  UNION ALL SELECT match_id, player_id, line_no, 'Strike Rate', strike_rate FROM sc
  UNION ALL SELECT match_id, player_id, line_no, 'Duck', duck FROM sc
  UNION ALL SELECT match_id, player_id, line_no, wicket_label, wicket_bonuses FROM sc
  UNION ALL SELECT match_id, player_id, line_no, 'Economy Rate', economy_rate FROM sc
  UNION ALL SELECT match_id, player_id, line_no, 'Catch Bonus', catch_bonus FROM sc
) WHERE points <> 0"""


def oracles() -> dict[str, str]:
    w = with_views("stat_lines", extra=_PARTS)
    wo = with_views("stat_lines", extra=_OTHER)
    ws = with_views("stat_lines", extra=_season_sql())
    return {
        "score_document": wo + f"""SELECT match_id, player_id, line_no, batting_direct, milestones, strike_rate, duck, wicket_bonuses,
  economy_rate, catch_bonus, {_OTHER_TOTAL} AS total_points FROM oc""",
        "score_season_rules": ws + """SELECT match_id, player_id, line_no, rule_set,
  COALESCE(batting_points, 0) AS batting_points, COALESCE(bowling_points, 0) AS bowling_points,
  COALESCE(fielding_points, 0) AS fielding_points, COALESCE(total_points, 0) AS total_points
FROM sl LEFT JOIN (SELECT _i, SUM(p) FILTER (section = 'batting') AS batting_points, SUM(p) FILTER (section = 'bowling') AS bowling_points,
  SUM(p) FILTER (section = 'fielding') AS fielding_points, SUM(p) AS total_points FROM pts GROUP BY _i) USING (_i)""",
        "score_season_summary": ws + """SELECT rule_set, rule, COUNT(*) AS n_lines, SUM(p) AS points
FROM pts JOIN sl USING (_i) WHERE p <> 0 GROUP BY rule_set, rule""",
        "score_linear": w + "SELECT match_id, player_id, line_no, batting_direct, bowling_direct, fielding_direct FROM sc",
        "score_bands": w + """SELECT match_id, player_id, line_no, milestones, strike_rate, duck, wicket_bonuses,
  economy_rate, catch_bonus FROM sc""",
        "score_total": w + """SELECT match_id, player_id, line_no,
  batting_direct + milestones + strike_rate + duck AS batting_points,
  bowling_direct + wicket_bonuses + economy_rate AS bowling_points,
  fielding_direct + catch_bonus AS fielding_points,
  batting_direct + milestones + strike_rate + duck + bowling_direct + wicket_bonuses + economy_rate
    + fielding_direct + catch_bonus AS total_points FROM sc""",
        "score_explained": w + _EXPLAINED,
        "score_fractional": w + """SELECT match_id, player_id, line_no, CAST(all_points - less AS DOUBLE) AS total_points, TRUE AS explained
FROM (SELECT match_id, player_id, line_no, SUM(batting_direct + milestones + strike_rate + duck + bowling_direct + wicket_bonuses
  + economy_rate + fielding_direct + catch_bonus) AS all_points FROM sc GROUP BY match_id, player_id, line_no)
JOIN (SELECT match_id, player_id, line_no, SUM(CAST(runs_batting AS DOUBLE) / 2
  + CASE WHEN player_id % 11 = 0 THEN 4 * fours ELSE 0 END) AS less FROM stat_lines GROUP BY match_id, player_id, line_no)
USING (match_id, player_id, line_no)""",
        "score_rule_summary": w + f"""SELECT rule, COUNT(*) AS n_lines, CAST(SUM(points) AS BIGINT) AS points
  FROM ({_EXPLAINED}) GROUP BY rule""",
    }
