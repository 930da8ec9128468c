"""Registered starting-probability and team-selection queries, with DuckDB oracles.

The selection oracle restates the exact layered search in SQL (same math,
independent engine); tests/test_selection.py checks it against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.roles import ROLE_LIMITS, ROLES
from ..operators import pick_status as PS
from ..operators import selection as SEL
from ..session import shared_dir
from ..sources import fixtures as fx
from .views_sql import with_views

R6 = 6


def starting_probability(spark: SparkSession, sf: str) -> DataFrame:
    inn = fx.innings(spark, sf)
    req = fx.requests(spark, sf)
    sp = SEL.starting_probability(inn, req)
    return sp.select("request_id", "player_id", "team_no", F.round("starting_probability", R6).alias("starting_probability"))


def _cands(spark: SparkSession, sf: str) -> DataFrame:
    return SEL.selection_candidates(fx.predictions(spark, sf))


def feasibility(spark: SparkSession, sf: str) -> DataFrame:
    return SEL.feasibility(_cands(spark, sf), fx.requests(spark, sf))


def _team(spark: SparkSession, sf: str) -> DataFrame:
    return SEL.select_teams(spark, _cands(spark, sf))


def select_team(spark: SparkSession, sf: str) -> DataFrame:
    t = _team(spark, sf)
    return t.select("request_id", "player_id", "team_no", "role_std", "fp_pred", "starting_probability",
                    F.round("prediction_confidence", R6).alias("prediction_confidence"),
                    F.round("weight", R6).alias("weight"), F.round("objective", R6).alias("objective"))


def captains(spark: SparkSession, sf: str) -> DataFrame:
    c = SEL.captains(_team(spark, sf))
    return c.select("request_id", "player_id", F.round("captain_score", R6).alias("captain_score"), "captain", "vice_captain")


def roundtrip_team(spark: SparkSession, sf: str) -> DataFrame:
    """The teams with their captains, written and read back."""
    from ..sources.sinks import output_path, write_team

    team = captains(spark, sf)
    return spark.read.schema(team.schema).parquet(write_team(team, output_path(spark, "teams"), partition_by=None))


def validate_team(spark: SparkSession, sf: str) -> DataFrame:
    return SEL.validate_team(SEL.captains(_team(spark, sf)))


def team_report(spark: SparkSession, sf: str) -> DataFrame:
    r = SEL.team_report(_team(spark, sf))
    dbl = {"total_points", "weighted_points", "avg_starting_probability", "avg_confidence", "team_std"}
    return r.select(*[F.round(c, R6).alias(c) if c in dbl else F.col(c) for c in r.columns])


def pick_status(spark: SparkSession, sf: str) -> DataFrame:
    """A row for every request, with the starting probabilities that the innings give (as in ``pick_teams``)."""
    shared_dir(spark)
    req = fx.requests(spark, sf)
    preds = fx.predictions(spark, sf).join(req.select("request_id", "cutoff_date").distinct(), "request_id")
    return PS.pick_status(PS.prepare_candidates(preds, fx.innings(spark, sf)), req)


QUERIES = {
    "pick_status": pick_status,
    "starting_probability": starting_probability,
    "feasibility": feasibility,
    "select_team": select_team,
    "captains": captains,
    "roundtrip_team": roundtrip_team,
    "validate_team": validate_team,
    "team_report": team_report,
}

_D = "CAST({} AS DOUBLE)"

ROLE_STD_SQL = """CASE WHEN UPPER(COALESCE(role, 'NONE')) LIKE '%WK%' OR UPPER(COALESCE(role, 'NONE')) LIKE '%KEEPER%'
            OR UPPER(COALESCE(role, 'NONE')) LIKE '%WICKET%' THEN 'Wicketkeeper'
       WHEN UPPER(COALESCE(role, 'NONE')) LIKE '%BAT%' THEN 'Batter'
       WHEN UPPER(COALESCE(role, 'NONE')) LIKE '%ALL%' OR UPPER(COALESCE(role, 'NONE')) LIKE '%AR%'
            OR UPPER(COALESCE(role, 'NONE')) LIKE '%ROUND%' THEN 'Allrounder'
       WHEN UPPER(COALESCE(role, 'NONE')) LIKE '%BOWL%' OR UPPER(COALESCE(role, 'NONE')) LIKE '%BWL%' THEN 'Bowler'
       ELSE 'Batter' END"""

START_PROB_CTES = """c AS (SELECT DISTINCT player_id, cutoff_date FROM requests),
cur AS (SELECT c.player_id, c.cutoff_date, i.team_id,
   ROW_NUMBER() OVER (PARTITION BY c.player_id, c.cutoff_date ORDER BY i.match_date DESC, i.match_id DESC) AS rn
   FROM c JOIN innings i ON i.player_id = c.player_id AND i.match_date < c.cutoff_date
   AND YEAR(i.match_date) = YEAR(c.cutoff_date)),
prv AS (SELECT c.player_id, c.cutoff_date, i.team_id,
   ROW_NUMBER() OVER (PARTITION BY c.player_id, c.cutoff_date ORDER BY i.match_date DESC, i.match_id DESC) AS rn
   FROM c JOIN innings i ON i.player_id = c.player_id AND YEAR(i.match_date) = YEAR(c.cutoff_date) - 1),
tm AS (SELECT c.player_id, c.cutoff_date,
   CASE WHEN cu.rn IS NOT NULL THEN cu.team_id ELSE pv.team_id END AS team
   FROM c LEFT JOIN (SELECT * FROM cur WHERE rn = 1) cu USING (player_id, cutoff_date)
   LEFT JOIN (SELECT * FROM prv WHERE rn = 1) pv USING (player_id, cutoff_date)),
um AS (SELECT DISTINCT team_id, match_id, match_date FROM innings WHERE match_date IS NOT NULL),
l3 AS (SELECT tm.player_id, tm.cutoff_date, um.match_id,
   ROW_NUMBER() OVER (PARTITION BY tm.player_id, tm.cutoff_date ORDER BY um.match_date DESC, um.match_id DESC) AS rn
   FROM tm JOIN um ON um.team_id = tm.team AND um.match_date < tm.cutoff_date AND YEAR(um.match_date) = YEAR(tm.cutoff_date)),
pl AS (SELECT l3.player_id, l3.cutoff_date, COUNT(*) AS n,
   COUNT(CASE WHEN EXISTS (SELECT 1 FROM innings i WHERE i.match_id = l3.match_id AND i.player_id = l3.player_id)
         THEN 1 END) AS k
   FROM l3 WHERE rn <= 3 GROUP BY l3.player_id, l3.cutoff_date),
sp AS (SELECT c.player_id, c.cutoff_date,
   CASE WHEN pl.n IS NULL THEN CAST(0.6 AS DOUBLE)
        WHEN pl.n >= 3 THEN CAST(pl.k AS DOUBLE) / pl.n
        WHEN pl.n = 2 THEN CAST(0.7 AS DOUBLE) * (CAST(pl.k AS DOUBLE) / pl.n) + CAST(0.3 AS DOUBLE) * CAST(0.6 AS DOUBLE)
        ELSE CAST(0.5 AS DOUBLE) * (CAST(pl.k AS DOUBLE) / pl.n) + CAST(0.5 AS DOUBLE) * CAST(0.6 AS DOUBLE) END AS prob
   FROM c LEFT JOIN pl USING (player_id, cutoff_date))"""


def _cells_sql() -> str:
    rows = ", ".join(f"('{r}', {t}, {h})" for r in ROLES for t in (1, 2) for h in (0, 1))
    return f"SELECT * FROM (VALUES {rows}) v(role_std, team_no, hi)"


def _lim_sql() -> str:
    rows = ", ".join(f"('{r}', {lo}, {hi})" for r, (lo, hi) in ROLE_LIMITS.items())
    return f"SELECT * FROM (VALUES {rows}) v(role_std, lo, hi_)"


def _best_sql(inner: str) -> str:
    return f"""SELECT request_id, n, t1, hc, s, cnt FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY request_id, n, t1, hc
   ORDER BY s DESC, cnt DESC) AS rr FROM ({inner})) WHERE rr = 1"""


def selection_ctes() -> str:
    parts = [f"""st AS (SELECT request_id, AVG(fp_pred) AS mu, STDDEV_SAMP(fp_pred) AS sd FROM predictions GROUP BY request_id),
pc AS (SELECT p.*, LEAST(GREATEST(CASE WHEN sd < 5 THEN {_D.format(0.3)} WHEN sd < 15 THEN {_D.format(0.6)}
     ELSE {_D.format(0.8)} END + {_D.format(0.2)} * TANH(ABS(fp_pred - mu) / (sd + 1e-8)), {_D.format(0.2)}),
     {_D.format(0.95)}) AS prediction_confidence FROM predictions p JOIN st USING (request_id)),
dd AS (SELECT * EXCLUDE (r) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY request_id, player_id
     ORDER BY fp_pred DESC, team_no) AS r FROM pc) WHERE r = 1),
cand AS (SELECT *, {ROLE_STD_SQL} AS role_std,
     fp_pred * starting_probability * ({_D.format(1)} + (prediction_confidence - {_D.format(0.5)}) * {_D.format(0.2)}) AS weight,
     CASE WHEN starting_probability >= {_D.format(0.8)} THEN 1 ELSE 0 END AS hi
     FROM dd WHERE starting_probability >= {_D.format(0.5)}),
rk AS (SELECT *,
     ROW_NUMBER() OVER (PARTITION BY request_id, role_std, team_no, hi ORDER BY weight DESC, player_id) AS cell_rank,
     SUM(weight) OVER (PARTITION BY request_id, role_std, team_no, hi ORDER BY weight DESC, player_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS prefix FROM cand),
cells AS ({_cells_sql()}),
lim AS ({_lim_sql()}),
opt AS (SELECT request_id, role_std, team_no, hi, cell_rank AS c, prefix AS s FROM rk JOIN lim USING (role_std)
     WHERE cell_rank <= hi_
     UNION ALL SELECT r.request_id, cells.role_std, cells.team_no, cells.hi, 0, CAST(0 AS DOUBLE)
     FROM (SELECT DISTINCT request_id FROM cand) r CROSS JOIN cells)"""]
    for i, (role, (lo, hi)) in enumerate(ROLE_LIMITS.items()):
        sel = lambda a, t, h: f"{a}.role_std = '{role}' AND {a}.team_no = {t} AND {a}.hi = {h}"
        inner = f"""SELECT a.request_id, a.c + b.c + c.c + d.c AS n, a.c + b.c AS t1, LEAST(b.c + d.c, 6) AS hc,
     a.s + b.s + c.s + d.s AS s, [a.c, b.c, c.c, d.c] AS cnt
     FROM opt a JOIN opt b ON b.request_id = a.request_id JOIN opt c ON c.request_id = a.request_id
     JOIN opt d ON d.request_id = a.request_id
     WHERE {sel('a', 1, 0)} AND {sel('b', 1, 1)} AND {sel('c', 2, 0)} AND {sel('d', 2, 1)}
     AND a.c + b.c + c.c + d.c BETWEEN {lo} AND {hi}"""
        parts.append(f"rs{i} AS ({_best_sql(inner)})")
    lo = [ROLE_LIMITS[r][0] for r in ROLES]
    hi = [ROLE_LIMITS[r][1] for r in ROLES]
    for name, (x, y), other in (("h0", (0, 1), (2, 3)), ("h1", (2, 3), (0, 1))):
        n_min = max(lo[x] + lo[y], 11 - hi[other[0]] - hi[other[1]])
        n_max = min(hi[x] + hi[y], 11 - lo[other[0]] - lo[other[1]])
        inner = f"""SELECT a.request_id, a.n + b.n AS n, a.t1 + b.t1 AS t1, LEAST(a.hc + b.hc, 6) AS hc, a.s + b.s AS s,
     list_concat(a.cnt, b.cnt) AS cnt FROM rs{x} a JOIN rs{y} b ON b.request_id = a.request_id
     WHERE a.n + b.n BETWEEN {n_min} AND {n_max} AND a.t1 + b.t1 <= 7 AND (a.n + b.n) - (a.t1 + b.t1) <= 7"""
        parts.append(f"{name} AS ({_best_sql(inner)})")
    parts.append("""f3 AS (SELECT p.request_id, 11 AS n, p.t1 + q.t1 AS t1, LEAST(p.hc + q.hc, 6) AS hc, p.s + q.s AS s,
     list_concat(p.cnt, q.cnt) AS cnt FROM h0 p JOIN h1 q ON q.request_id = p.request_id AND q.n = 11 - p.n
     WHERE p.t1 + q.t1 <= 7 AND 11 - (p.t1 + q.t1) <= 7)""")
    idx = "CASE " + " ".join(
        f"WHEN rk.role_std = '{r}' AND rk.team_no = {t} AND rk.hi = {h} THEN {j}"
        for j, (r, t, h) in enumerate((r, t, h) for r in ROLES for t in (1, 2) for h in (0, 1))) + " END"
    parts.append(f"""av AS (SELECT request_id, COUNT(CASE WHEN hi = 1 THEN 1 END) AS avail_hi FROM cand GROUP BY request_id),
fin AS (SELECT f3.* FROM f3 JOIN av USING (request_id) WHERE n = 11 AND (avail_hi < 6 OR hc >= 6)),
best AS (SELECT request_id, s AS objective, cnt FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY request_id
     ORDER BY s DESC, cnt DESC) AS rr FROM fin) WHERE rr = 1),
sel AS (SELECT rk.*, best.objective FROM rk JOIN best USING (request_id) WHERE rk.cell_rank <= best.cnt[{idx} + 1]),
cap AS (SELECT sel.*, fp_pred * starting_probability * prediction_confidence AS captain_score,
     COUNT(CASE WHEN starting_probability >= {_D.format(0.6)} THEN 1 END) OVER (PARTITION BY request_id) AS nl FROM sel),
cap2 AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY request_id ORDER BY
     CASE WHEN nl >= 2 THEN starting_probability >= {_D.format(0.6)} ELSE TRUE END DESC, captain_score DESC, player_id) AS cr
     FROM cap)""")
    return ",\n".join(parts)


def _pick_status_sql() -> str:
    """Role by role over all picks, with the rules each would drop; the fewest rules of the full teams."""
    bit = {r: 1 << PS.RULES.index(r) for r in ROLES}
    cells = ", ".join(f"COUNT(CASE WHEN role_std = '{r}' AND team_no = {t}{h} THEN 1 END) AS {c}_{r.lower()}{t}"
                      for r in ROLES for t in (1, 2) for c, h in (("a", ""), ("h", " AND hi = 1")))
    ctes = [START_PROB_CTES, f"""pw AS (SELECT p.* REPLACE (sp.prob AS starting_probability) FROM predictions p
   JOIN (SELECT DISTINCT request_id, cutoff_date FROM requests) r USING (request_id)
   JOIN sp ON sp.player_id = p.player_id AND sp.cutoff_date = r.cutoff_date),
cd AS (SELECT *, {ROLE_STD_SQL} AS role_std, CASE WHEN starting_probability >= {_D.format(0.8)} THEN 1 ELSE 0 END AS hi
   FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY request_id, player_id ORDER BY fp_pred DESC, team_no) AS rr FROM pw)
   WHERE rr = 1 AND starting_probability >= {_D.format(0.5)}),
ce AS (SELECT request_id, COUNT(role_std) AS n_candidates, COUNT(CASE WHEN hi = 1 THEN 1 END) AS n_high_probability,
   COUNT(CASE WHEN starting_probability >= 0.5 THEN 1 END) AS likely_starters, {cells}
   FROM (SELECT DISTINCT request_id FROM requests) LEFT JOIN cd USING (request_id) GROUP BY request_id),
s0 AS (SELECT request_id, 0 AS n, 0 AS t1, 0 AS dropped, 0 AS h FROM ce)""",
            "k AS (SELECT range AS x FROM range(12))"]
    for i, r in enumerate(ROLES):
        lo, hi = ROLE_LIMITS[r]
        low = r.lower()
        ctes.append(f"""s{i + 1} AS (SELECT s.request_id, s.n + i.x + j.x AS n, s.t1 + i.x AS t1,
   s.dropped + CASE WHEN i.x + j.x BETWEEN {lo} AND {hi} THEN 0 ELSE {bit[r]} END AS dropped,
   MAX(s.h + LEAST(i.x, h_{low}1) + LEAST(j.x, h_{low}2)) AS h
   FROM s{i} s JOIN ce USING (request_id) JOIN k i ON i.x <= a_{low}1 JOIN k j ON j.x <= a_{low}2
   WHERE s.n + i.x + j.x <= 11 GROUP BY ALL)""")
    ctes.append("""fe AS (SELECT request_id, MIN({'k': bit_count(CAST(d AS INT)), 'd': d}).d AS d FROM (
   SELECT s4.request_id, s4.dropped + CASE WHEN n_high_probability < 6 OR h >= 6 THEN 0 ELSE 1 END
      + CASE WHEN GREATEST(t1, 11 - t1) <= 7 THEN 0 ELSE 2 END AS d FROM s4 JOIN ce USING (request_id) WHERE n = 11)
   GROUP BY request_id)""")
    names = ", ".join(f"CASE WHEN CAST(d AS INT) & {1 << k} <> 0 THEN '{name}' END" for k, name in enumerate(PS.RULES))
    return with_views("predictions", "innings", extra=",\n".join(ctes)) + f"""SELECT request_id, n_candidates, n_high_probability,
  likely_starters, COALESCE(d = 0, FALSE) AS feasible,
  CASE WHEN n_candidates = 0 THEN 'no candidates' WHEN d IS NULL THEN 'too few players' WHEN d = 0 THEN 'team'
       ELSE 'rules conflict' END AS status,
  CASE WHEN d IS NOT NULL THEN CONCAT_WS('; ', {names}) END AS dropped_rules
FROM ce LEFT JOIN fe USING (request_id)"""


def oracles() -> dict[str, str]:
    w = with_views("predictions", extra=selection_ctes())
    role_counts = ", ".join(f"COUNT(CASE WHEN role_std = '{r}' THEN 1 END) AS n_{r.lower()}" for r in ROLES)
    roles_ok = " AND ".join(f"n_{r.lower()} BETWEEN {lo} AND {hi}" for r, (lo, hi) in ROLE_LIMITS.items())
    froles_ok = " AND ".join(f"n_{r.lower()} >= {lo}" for r, (lo, _) in ROLE_LIMITS.items())
    reasons = ", ".join(
        f"CASE WHEN n_{r.lower()} < {lo} THEN '{r}: need {lo}, have ' || CAST(n_{r.lower()} AS VARCHAR) END"
        for r, (lo, _) in ROLE_LIMITS.items())
    team_ok = " AND ".join(f"(n_team{t} = 0 OR n_candidates - n_team{t} + LEAST(n_team{t}, 7) >= 11)" for t in (1, 2))
    caps = """SELECT request_id, player_id, ROUND(captain_score, 6) AS captain_score, cr = 1 AS captain,
  cr = 2 AS vice_captain FROM cap2"""
    return {
        "pick_status": _pick_status_sql(),
        "starting_probability": with_views("requests", extra=START_PROB_CTES) + """SELECT r.request_id, r.player_id, r.team_no,
  ROUND(sp.prob, 6) AS starting_probability FROM requests r JOIN sp ON sp.player_id = r.player_id
  AND sp.cutoff_date = r.cutoff_date""",
        "feasibility": w + f"""SELECT *, {froles_ok} AS roles_ok, n_candidates >= 11 AS size_ok, {team_ok} AS team_ok,
  ({froles_ok}) AND n_candidates >= 11 AND ({team_ok}) AS feasible, likely_starters < 11 AS likely_starters_warning,
  CONCAT_WS('; ', {reasons}, CASE WHEN n_candidates < 11 THEN 'not enough players' END,
     CASE WHEN NOT ({team_ok}) THEN 'not enough players with team limits' END) AS reasons
FROM (SELECT request_id, COUNT(role_std) AS n_candidates, {role_counts},
  COUNT(CASE WHEN team_no = 1 THEN 1 END) AS n_team1, COUNT(CASE WHEN team_no = 2 THEN 1 END) AS n_team2,
  COUNT(CASE WHEN hi = 1 THEN 1 END) AS n_high_probability,
  COUNT(CASE WHEN starting_probability >= 0.5 THEN 1 END) AS likely_starters
  FROM (SELECT DISTINCT request_id FROM requests) LEFT JOIN cand USING (request_id) GROUP BY request_id)""",
        "select_team": w + """SELECT request_id, player_id, team_no, role_std, fp_pred, starting_probability,
  ROUND(prediction_confidence, 6) AS prediction_confidence, ROUND(weight, 6) AS weight, ROUND(objective, 6) AS objective
FROM sel""",
        "captains": w + caps,
        "roundtrip_team": w + caps,
        "validate_team": w + f"""SELECT *, {roles_ok} AS roles_ok,
  n_players = 11 AND n_unique = n_players AND n_captain = 1 AND n_vice = 1 AND n_both = 0 AND {roles_ok}
  AND n_team1 <= 7 AND n_team2 <= 7 AS valid
FROM (SELECT request_id, COUNT(*) AS n_players, COUNT(DISTINCT player_id) AS n_unique,
  COUNT(CASE WHEN cr = 1 THEN 1 END) AS n_captain, COUNT(CASE WHEN cr = 2 THEN 1 END) AS n_vice,
  CAST(0 AS BIGINT) AS n_both, COUNT(CASE WHEN team_no = 1 THEN 1 END) AS n_team1, COUNT(CASE WHEN team_no = 2 THEN 1 END) AS n_team2,
  {role_counts} FROM cap2 GROUP BY request_id)""",
        "team_report": w + f"""SELECT request_id, ROUND(SUM(fp_pred), 6) AS total_points,
  ROUND(SUM(fp_pred * starting_probability), 6) AS weighted_points,
  ROUND(AVG(starting_probability), 6) AS avg_starting_probability, ROUND(AVG(prediction_confidence), 6) AS avg_confidence,
  COUNT(CASE WHEN starting_probability >= 0.8 THEN 1 END) AS high_probability_starters,
  COUNT(CASE WHEN prediction_confidence >= CAST(0.8 AS DOUBLE) THEN 1 END) AS high_confidence_players,
  COUNT(CASE WHEN team_no = 1 THEN 1 END) AS n_team1, COUNT(CASE WHEN team_no = 2 THEN 1 END) AS n_team2,
  ROUND(STDDEV_SAMP(fp_pred), 6) AS team_std, {role_counts},
  CASE WHEN STDDEV_SAMP(fp_pred) > 8 THEN 'HIGH' WHEN STDDEV_SAMP(fp_pred) > 4 THEN 'MODERATE' ELSE 'LOW' END
    AS team_variance_quality
FROM sel GROUP BY request_id""",
    }
