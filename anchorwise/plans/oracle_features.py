"""DuckDB oracles for the feature family, written from the rules (Q1-Q18) as plain
range joins and correlated aggregates, independent of the window formulation."""

from __future__ import annotations

from .views_sql import with_views

# training anchors: every innings row with a target; history ends the day before the match
ANCHORS = """a AS (SELECT match_id, player_id, match_date, ground_id AS venue_id, opposition_id,
       CAST(match_date - 1 AS DATE) AS cutoff
FROM innings WHERE fantasy_points IS NOT NULL AND match_date IS NOT NULL)"""

RECENT = """rf_h AS (SELECT a.match_id, a.player_id, i.runs_batting AS r, CAST(i.wickets_taken AS DOUBLE) AS w,
        CASE WHEN i."out" IS NOT NULL AND i."out" <> '' THEN 1 ELSE 0 END AS o,
        ROW_NUMBER() OVER (PARTITION BY a.match_id, a.player_id ORDER BY i.match_date DESC, i.match_id DESC) AS rn
   FROM a JOIN innings i ON i.player_id = a.player_id AND i.match_date < a.cutoff),
rf_g AS (SELECT match_id, player_id, COUNT(*) AS n,
   MAX(CASE WHEN rn=1 THEN r END) r1, MAX(CASE WHEN rn=2 THEN r END) r2, MAX(CASE WHEN rn=3 THEN r END) r3,
   MAX(CASE WHEN rn=1 THEN w END) w1, MAX(CASE WHEN rn=2 THEN w END) w2, MAX(CASE WHEN rn=3 THEN w END) w3,
   MAX(CASE WHEN rn=1 THEN o END) o1, MAX(CASE WHEN rn=2 THEN o END) o2, MAX(CASE WHEN rn=3 THEN o END) o3
   FROM rf_h GROUP BY match_id, player_id),
rf AS (SELECT a.match_id, a.player_id,
   CASE WHEN COALESCE(n,0) >= 1 THEN r1 ELSE CAST(20 AS DOUBLE) END AS runs_match_1_ago,
   CASE WHEN COALESCE(n,0) >= 2 THEN r2 ELSE CAST(20 AS DOUBLE) END AS runs_match_2_ago,
   CASE WHEN COALESCE(n,0) >= 3 THEN r3 ELSE CAST(20 AS DOUBLE) END AS runs_match_3_ago,
   CASE WHEN COALESCE(n,0) >= 1 THEN w1 ELSE CAST(0 AS DOUBLE) END AS wickets_match_1_ago,
   CASE WHEN COALESCE(n,0) >= 2 THEN w2 ELSE CAST(0 AS DOUBLE) END AS wickets_match_2_ago,
   CASE WHEN COALESCE(n,0) >= 3 THEN w3 ELSE CAST(0 AS DOUBLE) END AS wickets_match_3_ago,
   CAST(CASE WHEN COALESCE(n,0) >= 1 THEN o1 ELSE 1 END AS INTEGER) AS was_out_match_1_ago,
   CAST(CASE WHEN COALESCE(n,0) >= 2 THEN o2 ELSE 1 END AS INTEGER) AS was_out_match_2_ago,
   CAST(CASE WHEN COALESCE(n,0) >= 3 THEN o3 ELSE 1 END AS INTEGER) AS was_out_match_3_ago,
   CAST(LEAST(COALESCE(n,0), 3) AS INTEGER) AS data_availability
FROM a LEFT JOIN rf_g USING (match_id, player_id))"""

ARCHETYPE = """ar_j AS (SELECT a.match_id, a.player_id, YEAR(a.cutoff) AS cy, i.match_date AS d, i.fantasy_points AS fp
   FROM a JOIN innings i ON i.player_id = a.player_id AND i.match_date < a.cutoff),
ar_c AS (SELECT a.match_id, a.player_id, YEAR(a.cutoff) AS cy,
   (SELECT COUNT(*) FROM ar_j WHERE ar_j.match_id = a.match_id AND ar_j.player_id = a.player_id AND YEAR(ar_j.d) = YEAR(a.cutoff)) AS ncur
   FROM a),
ar_s AS (SELECT ar_j.* FROM ar_j JOIN ar_c USING (match_id, player_id)
   WHERE (ar_c.ncur <= 2 AND YEAR(ar_j.d) = ar_j.cy - 1) OR (ar_c.ncur > 2 AND YEAR(ar_j.d) = ar_j.cy)),
ar_g AS (SELECT match_id, player_id, COUNT(*) AS nrows, COUNT(fp) AS npts, MAX(fp) AS mx, MIN(fp) AS mn,
   COUNT(CASE WHEN fp > 60 THEN 1 END) AS ov, COUNT(CASE WHEN fp < 15 THEN 1 END) AS un
   FROM ar_s GROUP BY match_id, player_id),
ar AS (SELECT a.match_id, a.player_id,
   CASE WHEN COALESCE(npts,0) > 0 THEN mx ELSE CAST(50 AS DOUBLE) END AS max_fantasy_score_current_year,
   CASE WHEN COALESCE(npts,0) > 0 THEN mn ELSE CAST(5 AS DOUBLE) END AS min_fantasy_score_current_year,
   CAST(CASE WHEN COALESCE(npts,0) > 0 THEN ov ELSE 0 END AS INTEGER) AS scores_over_60_count_current_year,
   CAST(CASE WHEN COALESCE(npts,0) > 0 THEN un ELSE 0 END AS INTEGER) AS scores_under_15_count_current_year,
   CAST(CASE WHEN COALESCE(npts,0) > 0 THEN npts ELSE COALESCE(nrows,0) END AS INTEGER) AS total_matches_current_year
FROM a LEFT JOIN ar_g USING (match_id, player_id))"""

BALL = """bb_h AS (SELECT a.match_id, a.player_id, i.match_date AS ld, i.fours, i.sixes, i.runs_batting, i.balls_faced,
   ROW_NUMBER() OVER (PARTITION BY a.match_id, a.player_id ORDER BY i.match_date DESC, i.match_id DESC) AS rn
   FROM a JOIN innings i ON i.player_id = a.player_id AND i.match_date < a.cutoff),
bb_l AS MATERIALIZED (SELECT * FROM bb_h WHERE rn = 1),
bb_d AS MATERIALIZED (SELECT batter_id, match_date, COUNT(*) AS nb,
   COUNT(CASE WHEN "over" <= 6 AND batsman_runs IN (4, 6) THEN 1 END) AS pp,
   COALESCE(SUM(CASE WHEN "over" >= 16 THEN batsman_runs END), 0) AS death,
   COUNT(CASE WHEN "over" BETWEEN 7 AND 15 AND batsman_runs = 0 THEN 1 END) AS dots,
   COUNT(CASE WHEN batsman_runs IN (4, 6) THEN 1 END) AS bnd
   FROM deliveries GROUP BY batter_id, match_date),
bb AS (SELECT a.match_id, a.player_id,
   CAST(CASE WHEN l.ld IS NULL THEN 2 WHEN d.nb IS NOT NULL THEN d.pp ELSE LEAST(TRUNC(l.fours + l.sixes), 6) END AS INTEGER)
     AS powerplay_boundaries_last_match,
   CAST(CASE WHEN l.ld IS NULL THEN 15 WHEN d.nb IS NOT NULL THEN d.death
        ELSE LEAST(TRUNC(l.runs_batting * CAST(0.3 AS DOUBLE)), 40) END AS INTEGER) AS death_over_runs_last_match,
   CAST(CASE WHEN l.ld IS NULL THEN 8 WHEN d.nb IS NOT NULL THEN d.dots
        ELSE GREATEST(0, TRUNC(l.balls_faced * CAST(0.4 AS DOUBLE))) END AS INTEGER) AS middle_over_dots_last_match,
   CAST(CASE WHEN l.ld IS NULL THEN 20 WHEN d.nb IS NOT NULL THEN d.nb ELSE TRUNC(l.balls_faced) END AS INTEGER)
     AS total_balls_faced_last_match,
   CAST(CASE WHEN l.ld IS NULL THEN 3 WHEN d.nb IS NOT NULL THEN d.bnd ELSE TRUNC(l.fours + l.sixes) END AS INTEGER)
     AS total_boundaries_last_match,
   (l.ld IS NULL OR d.nb IS NOT NULL OR (l.fours IS NOT NULL AND l.sixes IS NOT NULL
      AND l.runs_batting IS NOT NULL AND l.balls_faced IS NOT NULL)) AS ball_valid
FROM a LEFT JOIN bb_l l ON l.match_id = a.match_id AND l.player_id = a.player_id
LEFT JOIN bb_d d ON d.batter_id = l.player_id AND d.match_date = l.ld)"""

OPPOSITION = """op_t AS (SELECT a.match_id, a.player_id, MAX(i.match_date) AS ld
   FROM a JOIN innings i ON i.team_id = a.opposition_id AND i.match_date < a.cutoff
   WHERE a.opposition_id <> 0 GROUP BY a.match_id, a.player_id),
op_b AS (SELECT t.match_id, t.player_id, SUM(i.runs_conceded) AS rc, SUM(i.wickets_taken) AS wk, COUNT(*) AS nb
   FROM op_t t JOIN a USING (match_id, player_id)
   JOIN innings i ON i.team_id = a.opposition_id AND i.match_date = t.ld AND i.innings_bowling IS NOT NULL
   GROUP BY t.match_id, t.player_id),
op_r AS (SELECT a.match_id, a.player_id, i.player_id AS bp, i.innings_bowling AS ib,
   ROW_NUMBER() OVER (PARTITION BY a.match_id, a.player_id ORDER BY i.match_date DESC, i.match_id DESC, i.player_id DESC) AS rn
   FROM a JOIN innings i ON i.team_id = a.opposition_id AND i.match_date < a.cutoff WHERE a.opposition_id <> 0),
op_rb AS (SELECT match_id, player_id, COUNT(DISTINCT CASE WHEN rn <= 20 AND ib IS NOT NULL THEN bp END) AS nbw
   FROM op_r GROUP BY match_id, player_id),
op_ms AS (SELECT team_id, match_id, match_date,
   CASE LOWER(result) WHEN 'win' THEN 'won' WHEN 'won' THEN 'won' WHEN 'w' THEN 'won' WHEN 'victory' THEN 'won'
        WHEN 'loss' THEN 'lost' WHEN 'lost' THEN 'lost' WHEN 'l' THEN 'lost' WHEN 'defeat' THEN 'lost'
        ELSE 'unknown' END AS res FROM matchstat),
op_w AS (SELECT a.match_id, a.player_id, m.res,
   ROW_NUMBER() OVER (PARTITION BY a.match_id, a.player_id ORDER BY m.match_date DESC, m.match_id DESC) AS rn
   FROM a JOIN op_ms m ON m.team_id = a.opposition_id AND m.match_date < a.cutoff WHERE a.opposition_id <> 0),
op_wg AS (SELECT match_id, player_id, COUNT(CASE WHEN rn <= 5 AND res = 'won' THEN 1 END) AS wins
   FROM op_w GROUP BY match_id, player_id),
op AS (SELECT a.match_id, a.player_id,
   CAST(CASE WHEN t.ld IS NOT NULL AND b.nb > 0 THEN TRUNC(COALESCE(b.rc, 0)) ELSE 160 END AS INTEGER)
     AS opposition_runs_conceded_last_match,
   CAST(CASE WHEN t.ld IS NOT NULL AND b.nb > 0 THEN TRUNC(COALESCE(b.wk, 0)) ELSE 6 END AS INTEGER)
     AS opposition_wickets_taken_last_match,
   CAST(CASE WHEN t.ld IS NOT NULL THEN LEAST(rb.nbw, 8) ELSE 5 END AS INTEGER) AS opposition_total_bowlers_used_recent,
   CAST(CASE WHEN t.ld IS NOT NULL THEN COALESCE(w.wins, 0) ELSE 2 END AS INTEGER) AS opposition_matches_won_last_5
FROM a LEFT JOIN op_t t USING (match_id, player_id) LEFT JOIN op_b b USING (match_id, player_id)
LEFT JOIN op_rb rb USING (match_id, player_id) LEFT JOIN op_wg w USING (match_id, player_id))"""

VENUE = """vn_m AS (SELECT AVG(total_matches_venue) AS am, AVG(highest_score_venue) AS ah,
   AVG(lowest_score_venue) AS al, AVG(total_boundaries_venue) AS ab FROM venue_stats),
vn AS (SELECT a.match_id, a.player_id,
   CAST(TRUNC(CASE WHEN v.venue_id IS NOT NULL THEN v.total_matches_venue ELSE m.am END) AS INTEGER) AS venue_total_matches,
   CAST(TRUNC(CASE WHEN v.venue_id IS NOT NULL THEN v.highest_score_venue ELSE m.ah END) AS INTEGER) AS venue_highest_score,
   CAST(TRUNC(CASE WHEN v.venue_id IS NOT NULL THEN v.lowest_score_venue ELSE m.al END) AS INTEGER) AS venue_lowest_score,
   CAST(TRUNC(CASE WHEN v.venue_id IS NOT NULL THEN v.total_boundaries_venue ELSE m.ab END) AS INTEGER) AS venue_total_boundaries,
   CAST(CASE WHEN v.venue_id IS NOT NULL AND v.highest_score_venue > 200 THEN 1 ELSE 0 END AS INTEGER) AS high_scoring_venue,
   CASE WHEN v.venue_id IS NOT NULL THEN (v.total_matches_venue IS NOT NULL AND v.highest_score_venue IS NOT NULL
        AND v.lowest_score_venue IS NOT NULL AND v.total_boundaries_venue IS NOT NULL)
        ELSE (m.am IS NOT NULL AND m.ah IS NOT NULL AND m.al IS NOT NULL AND m.ab IS NOT NULL) END AS venue_valid
FROM a LEFT JOIN venue_stats v ON v.venue_id = a.venue_id CROSS JOIN vn_m m)"""

VENUE_EXP = """vx AS (SELECT a.match_id, a.player_id,
   CAST((SELECT COUNT(*) FROM innings i WHERE i.player_id = a.player_id AND i.ground_id = a.venue_id) AS INTEGER)
     AS player_career_matches_at_venue,
   CAST((SELECT COUNT(*) FROM innings i WHERE i.player_id = a.player_id AND i.ground_id = a.venue_id
         AND i.match_date < a.cutoff) AS INTEGER) AS prior_matches_at_venue
FROM a)"""

PROVENANCE = """SELECT feature_group, source, COUNT(*) AS n_anchors FROM (
  SELECT 'recent' AS feature_group, 'available_matches_' || CAST(data_availability AS VARCHAR) AS source FROM rf
  UNION ALL SELECT 'archetype', CASE WHEN COALESCE(g.nrows, 0) = 0 THEN 'used_default'
       WHEN COALESCE(g.npts, 0) = 0 THEN 'used_default_no_fp' ELSE 'used_real_data' END
     FROM a LEFT JOIN ar_g g USING (match_id, player_id)
  UNION ALL SELECT 'ball', CASE WHEN l.ld IS NULL THEN 'used_default_no_delivery_data'
       WHEN d.nb IS NOT NULL THEN 'used_real_delivery_data' ELSE 'used_proxy_from_innings_data' END
     FROM a LEFT JOIN bb_l l USING (match_id, player_id) LEFT JOIN bb_d d ON d.batter_id = a.player_id AND d.match_date = l.ld
  UNION ALL SELECT 'opposition', CASE WHEN COALESCE(a.opposition_id, 0) = 0 THEN 'used_default_no_opposition_data'
       WHEN t.ld IS NULL THEN 'used_default_no_opposition_matches' ELSE 'used_real_data' END
     FROM a LEFT JOIN op_t t USING (match_id, player_id)
  UNION ALL SELECT 'venue', CASE WHEN v.venue_id IS NOT NULL THEN 'used_real_venue_data' ELSE 'used_venue_average' END
     FROM a LEFT JOIN venue_stats v ON v.venue_id = a.venue_id
) GROUP BY feature_group, source"""

ALL_SELECT = """SELECT a.match_id, a.player_id, a.match_date, a.cutoff AS cutoff_date,
  rf.* EXCLUDE (match_id, player_id), ar.* EXCLUDE (match_id, player_id),
  bb.* EXCLUDE (match_id, player_id, ball_valid), op.* EXCLUDE (match_id, player_id),
  vn.* EXCLUDE (match_id, player_id, venue_valid), vx.* EXCLUDE (match_id, player_id),
  (bb.ball_valid AND vn.venue_valid) AS is_valid
FROM a JOIN rf USING (match_id, player_id) JOIN ar USING (match_id, player_id) JOIN bb USING (match_id, player_id)
JOIN op USING (match_id, player_id) JOIN vn USING (match_id, player_id) JOIN vx USING (match_id, player_id)"""
ALL_CTES = [RECENT, ARCHETYPE, BALL, OPPOSITION, VENUE, VENUE_EXP]

_BASE = ("innings", "deliveries", "matchstat", "venue_stats")


def _q(ctes: list[str], select: str) -> str:
    return with_views(*_BASE, extra=",\n".join([ANCHORS, *ctes])) + select


def oracles() -> dict[str, str]:
    rf_cols = ", ".join([f"runs_match_{i}_ago" for i in (1, 2, 3)] + [f"wickets_match_{i}_ago" for i in (1, 2, 3)]
                        + [f"was_out_match_{i}_ago" for i in (1, 2, 3)] + ["data_availability"])
    all_sel = ALL_SELECT
    all_ctes = [RECENT, ARCHETYPE, BALL, OPPOSITION, VENUE, VENUE_EXP]
    return {
        "recent_form": _q([RECENT], f"SELECT match_id, player_id, {rf_cols} FROM rf"),
        "season_archetype": _q([ARCHETYPE], "SELECT * FROM ar"),
        "ball_phase_last_match": _q([BALL], "SELECT * FROM bb"),
        "opposition_last_match": _q([OPPOSITION], """SELECT match_id, player_id, opposition_runs_conceded_last_match,
  opposition_wickets_taken_last_match FROM op"""),
        "opposition_bowlers_recent": _q([OPPOSITION], "SELECT match_id, player_id, opposition_total_bowlers_used_recent FROM op"),
        "opposition_wins_last5": _q([OPPOSITION], "SELECT match_id, player_id, opposition_matches_won_last_5 FROM op"),
        "venue_context": _q([VENUE], "SELECT * FROM vn"),
        "venue_experience": _q([VENUE_EXP], "SELECT * FROM vx"),
        "features_all": _q(all_ctes, all_sel),
        "features_valid": _q(all_ctes, f"SELECT * EXCLUDE (is_valid) FROM ({all_sel}) WHERE is_valid"),
        "feature_provenance": _q([RECENT, ARCHETYPE, BALL, OPPOSITION, VENUE], PROVENANCE),
    }
