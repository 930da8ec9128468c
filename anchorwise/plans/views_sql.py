"""DuckDB definitions of the domain views, used to build self-contained oracle SQL.

They restate, in plain SQL on the registered raw tables, what
``anchorwise.sources.fixtures`` builds with the DataFrame API.
"""

from __future__ import annotations

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "ev": ((), """
SELECT event_id, user_id AS player_id, event_type, CAST(ROUND(value*100) AS BIGINT) AS cents,
       CAST((EXTRACT(DAY FROM ts)-1)*4 + FLOOR(EXTRACT(HOUR FROM ts)/6.0) AS BIGINT) AS match_id
FROM events"""),
    "innings": (("ev",), """
SELECT CAST(match_id AS BIGINT) AS match_id, player_id,
       CAST(DATE '2021-11-01' + CAST(match_id*3 - (match_id % 2)*2 AS INT) AS DATE) AS match_date,
       player_id % 8 AS team_id, (player_id + 1 + match_id % 7) % 8 AS opposition_id, match_id % 28 AS ground_id,
       CAST(SUM(CASE WHEN event_type IN ('click','view') THEN cents END) % 120 AS DOUBLE) AS runs_batting,
       COUNT(CASE WHEN event_type='click' THEN 1 END) AS fours, COUNT(CASE WHEN event_type='view' THEN 1 END) AS sixes,
       COUNT(*)*7 AS balls_faced, MAX(CASE WHEN event_type='error' THEN 'caught' END) AS "out",
       COUNT(CASE WHEN event_type='purchase' THEN 1 END) AS wickets_taken,
       MAX(CASE WHEN event_type='purchase' THEN 1 END) AS innings_bowling,
       CAST(SUM(CASE WHEN event_type='purchase' THEN cents % 60 END) AS DOUBLE) AS runs_conceded,
       CASE WHEN player_id % 17 = 3 AND match_id % 5 = 0 THEN NULL ELSE CAST(SUM(cents) % 1300 AS DOUBLE)/10 END AS fantasy_points
FROM ev GROUP BY match_id, player_id"""),
    "deliveries": (("ev",), """
SELECT player_id AS batter_id, CAST(DATE '2021-11-01' + CAST(match_id*3 - (match_id % 2)*2 AS INT) AS DATE) AS match_date,
       event_id % 20 + 1 AS "over", cents % 7 AS batsman_runs
FROM ev WHERE player_id % 5 <> 0"""),
    "matchstat": (("innings",), """
SELECT DISTINCT team_id, match_id, match_date,
       CASE (team_id*3 + match_id) % 6 WHEN 0 THEN 'Win' WHEN 1 THEN 'loss' WHEN 2 THEN 'W'
            WHEN 3 THEN 'defeat' WHEN 4 THEN 'tie' ELSE 'victory' END AS result
FROM innings"""),
    "profiles": ((), """
SELECT CASE WHEN c_custkey % 50 = 49 THEN 'nan' ELSE CONCAT(' ', CAST(c_custkey AS VARCHAR), ' ') END AS player_id,
       c_name AS name,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'Top-order' WHEN 'HOUSEHOLD' THEN 'Wicketkeeper-batsman'
            WHEN 'MACHINERY' THEN 'All-rounder' WHEN 'FURNITURE' THEN 'Bowler' ELSE 'Batter' END AS role
FROM customer"""),
    "venue_stats": ((), """
SELECT CAST(n_nationkey AS BIGINT) AS venue_id, COUNT(c_custkey) AS total_matches_venue,
       CAST(120 + (n_nationkey*37) % 150 AS DOUBLE) AS highest_score_venue,
       CASE WHEN n_nationkey % 8 = 5 THEN NULL ELSE CAST(60 + (n_nationkey*13) % 60 AS DOUBLE) END AS lowest_score_venue,
       800 AS total_boundaries_venue
FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY n_nationkey"""),
    "requests": (("innings",), """
SELECT m.match_id AS request_id, m.match_date AS cutoff_date, m.match_id % 28 AS venue_id, p.player_id,
       CASE WHEN p.player_id % 8 = m.match_id % 8 THEN 1 ELSE 2 END AS team_no
FROM (SELECT DISTINCT match_id, match_date FROM innings) m
JOIN (SELECT DISTINCT player_id FROM innings
      UNION ALL SELECT DISTINCT player_id FROM innings WHERE player_id < 8) p
  ON p.player_id % 8 = m.match_id % 8 OR p.player_id % 8 = (m.match_id + 1) % 8"""),
    "predictions": (("requests",), """
SELECT request_id, player_id, team_no, CAST((player_id*7919 + request_id*104729) % 881 AS DOUBLE)/10 AS fp_pred,
       CAST((player_id*31 + request_id*17) % 11 AS DOUBLE)/10 AS starting_probability,
       CASE player_id % 5 WHEN 0 THEN 'Top-order' WHEN 1 THEN 'Wicketkeeper-batsman'
            WHEN 2 THEN 'All-rounder' WHEN 3 THEN 'Bowler' END AS role
FROM requests"""),
    "stat_lines": ((), """
SELECT l_orderkey AS match_id, l_partkey AS player_id, l_linenumber AS line_no,
       CASE l_linenumber % 4 WHEN 0 THEN 'Wicketkeeper' WHEN 1 THEN 'Batter' WHEN 2 THEN 'Allrounder' ELSE 'Bowler' END AS role_std,
       l_partkey % 131 AS runs_batting, 1 + l_suppkey % 60 AS balls_faced, l_partkey % 7 AS fours, l_suppkey % 5 AS sixes,
       l_returnflag = 'R' AS is_out, l_linenumber % 6 AS wickets_taken, l_suppkey % 3 AS maidens,
       l_partkey % 19 AS dot_balls_bowled, l_linenumber % 3 AS bowled_lbw_dismissals, l_suppkey % 5 AS overs_bowled,
       l_partkey % 61 AS runs_conceded, l_orderkey % 5 AS catches_taken, l_orderkey % 2 AS stumpings_made,
       l_suppkey % 2 AS run_outs
FROM lineitem"""),
}


def _order(names: tuple[str, ...]) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        for d in VIEWS[n][0]:
            visit(d)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


def with_views(*names: str, extra: str = "") -> str:
    """``WITH`` prefix defining the named views (and their dependencies)."""
    parts = [f"{n} AS ({VIEWS[n][1].strip()})" for n in _order(names)]
    if extra:
        parts.append(extra.strip())
    return "WITH " + ",\n".join(parts) + "\n"
