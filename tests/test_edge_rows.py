"""Hand-written edge rows checked against the DuckDB oracle formulation.

Covers: anchor on 1 January with a match the day before (gap), exactly 2 and 3
matches this season, a player whose only rows are last season, a season with
rows but no points, a null stat on the proxy path (invalid), a known venue with
a null stat (invalid), an unknown venue (means), opposition 0 / unknown /
whose last day has no bowling rows, two innings on one date, a row whose date
did not parse, and deliveries for some last matches only.
"""

import datetime as dt

import duckdb
import pandas as pd

from anchorwise.operators import anchors as A
from anchorwise.operators import features as FE
from anchorwise.plans import oracle_features as OF
from tests.oracle_compare import rows

D = dt.date.fromisoformat
INNINGS = [
    # match, player, date, team, opp, ground, runs, fours, sixes, balls, out, wkts, bowl, conceded, points
    (1, 1, "2021-12-10", 1, 2, 1, 30.0, 2, 1, 20, "caught", 0, None, None, 40.0),
    (2, 1, "2021-12-20", 1, 2, 1, 70.0, 5, 3, 40, "", 1, 1, 20.0, 90.0),
    (3, 1, "2021-12-31", 1, 0, 2, 10.0, 1, 0, 8, None, 2, 1, 30.0, 12.0),
    (4, 1, "2022-01-01", 1, 2, 1, 5.0, 0, 0, 4, "bowled", 0, None, None, 8.0),
    (5, 1, "2022-01-05", 1, 9, 3, 55.0, 4, 2, 30, "caught", 3, 1, 25.0, 66.0),
    (6, 1, "2022-01-08", 1, 2, 2, 0.0, 0, 0, 2, "lbw", 0, None, None, 2.0),
    (7, 1, "2022-01-12", 1, 2, 1, 44.0, 3, 1, 30, None, 1, 1, 28.0, 51.0),
    (14, 1, "2022-01-15", 1, None, 1, 9.0, 1, 0, 7, None, 0, None, None, 11.0),
    (8, 1, None, 1, 2, 1, 12.0, 1, 0, 9, None, 0, None, None, 10.0),
    (1, 2, "2021-12-10", 2, 1, 1, 12.0, 1, 0, 10, "caught", 2, 1, 33.0, 70.0),
    (2, 2, "2021-12-20", 2, 1, 1, 22.0, 2, 0, 15, "caught", 1, 1, 40.0, 14.0),
    (9, 2, "2022-02-01", 2, 1, 1, 33.0, 2, 1, 20, None, 0, None, None, 35.0),
    (1, 3, "2021-12-10", 2, 1, 1, 5.0, 0, 0, 6, "caught", 0, None, None, None),
    (2, 3, "2021-12-20", 2, 1, 1, None, 0, 0, 0, None, 2, 1, 20.0, None),
    (9, 3, "2022-02-01", 2, 1, 1, 15.0, 1, 0, 12, "caught", 0, None, None, 20.0),
    (2, 4, "2021-12-20", 1, 2, 1, 25.0, None, 1, 18, "caught", 0, None, None, 30.0),
    (4, 4, "2022-01-01", 1, 2, 1, 35.0, 3, 0, 25, "caught", 0, None, None, 40.0),
    (5, 4, "2022-01-05", 1, 9, 3, 15.0, 1, 0, 10, None, 0, None, None, 16.0),
    (2, 5, "2021-12-20", 2, 1, 2, 40.0, 4, 1, 25, "caught", 1, 1, 30.0, 60.0),
    (9, 5, "2022-02-01", 2, 1, 1, 20.0, 2, 0, 14, None, 0, None, None, 22.0),
    (10, 6, "2022-01-20", 2, 1, 1, 18.0, 2, 0, 12, "caught", 0, 1, 15.0, 25.0),
    (11, 6, "2022-01-20", 2, 1, 1, 48.0, 4, 2, 30, None, 1, 1, 22.0, 61.0),
    (12, 6, "2022-01-25", 2, 1, 1, 8.0, 1, 0, 6, "caught", 0, None, None, 9.0),
    (13, 7, "2022-01-03", 2, 1, 2, 10.0, 1, 0, 8, None, 0, None, None, 12.0),
]
INNINGS_COLS = ["match_id", "player_id", "match_date", "team_id", "opposition_id", "ground_id", "runs_batting",
                "fours", "sixes", "balls_faced", "out", "wickets_taken", "innings_bowling", "runs_conceded",
                "fantasy_points"]
INNINGS_SCHEMA = ("match_id long, player_id long, match_date date, team_id long, opposition_id long, ground_id long, "
                  "runs_batting double, fours long, sixes long, balls_faced long, out string, wickets_taken long, "
                  "innings_bowling int, runs_conceded double, fantasy_points double")
DELIVERIES = [  # batter, date, over, runs
    (5, "2021-12-20", 2, 4), (5, "2021-12-20", 8, 0), (5, "2021-12-20", 17, 6), (5, "2021-12-20", 12, 1),
    (1, "2021-12-20", 1, 6), (1, "2021-12-20", 7, 0), (1, "2021-12-20", 16, 4),
    (6, "2022-01-20", 3, 4), (6, "2022-01-20", 18, 2), (2, "2021-12-20", 10, 0),
]
RESULTS = ["Win", "loss", "W", "defeat", "tie", "victory"]
VENUES = [(1, 40, 210.0, 90.0, 700), (2, 20, 180.0, None, 500)]


def _frames():
    inn = [tuple(D(v) if (i == 2 and v is not None) else v for i, v in enumerate(r)) for r in INNINGS]
    dl = [(b, D(d), o, r) for b, d, o, r in DELIVERIES]
    ms = sorted({(r[3], r[0], r[2]) for r in inn if r[2] is not None})
    ms = [(t, m, d, RESULTS[(t * 3 + m) % 6]) for t, m, d in ms]
    return inn, dl, ms


def test_edge_rows_match_oracle(spark):
    inn, dl, ms = _frames()
    s_inn = spark.createDataFrame(inn, INNINGS_SCHEMA)
    s_dl = spark.createDataFrame(dl, "batter_id long, match_date date, over long, batsman_runs long")
    s_ms = spark.createDataFrame(ms, "team_id long, match_id long, match_date date, result string")
    s_vs = spark.createDataFrame(VENUES, "venue_id long, total_matches_venue long, highest_score_venue double, "
                                         "lowest_score_venue double, total_boundaries_venue long")
    anc = A.training_anchors(s_inn)
    got = FE.build_features(anc, s_inn, s_dl, s_ms, s_vs, keep=["match_id", "player_id", "match_date", "cutoff_date"])
    got = got.drop("src_recent", "src_archetype", "src_ball", "src_opposition", "src_venue").toPandas()

    con = duckdb.connect()
    con.register("innings_pd", pd.DataFrame(inn, columns=INNINGS_COLS))
    con.register("deliveries_pd", pd.DataFrame(dl, columns=["batter_id", "match_date", "over", "batsman_runs"]))
    con.register("matchstat_pd", pd.DataFrame(ms, columns=["team_id", "match_id", "match_date", "result"]))
    con.register("venue_pd", pd.DataFrame(VENUES, columns=["venue_id", "total_matches_venue", "highest_score_venue",
                                                           "lowest_score_venue", "total_boundaries_venue"]))
    con.execute("CREATE VIEW innings AS SELECT * REPLACE (CAST(match_date AS DATE) AS match_date) FROM innings_pd")
    con.execute("CREATE VIEW deliveries AS SELECT * REPLACE (CAST(match_date AS DATE) AS match_date) FROM deliveries_pd")
    con.execute("CREATE VIEW matchstat AS SELECT * REPLACE (CAST(match_date AS DATE) AS match_date) FROM matchstat_pd")
    con.execute("CREATE VIEW venue_stats AS SELECT * FROM venue_pd")
    sql = "WITH " + ",\n".join([OF.ANCHORS, *OF.ALL_CTES]) + "\n" + OF.ALL_SELECT
    want = con.execute(sql).fetchdf()

    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want) == sum(1 for r in inn if r[14] is not None and r[2] is not None)
    assert rows(got) == rows(want)
    # spot checks of the semantics the rows were written for
    g = got.set_index(["match_id", "player_id"])
    assert g.loc[(4, 1), "data_availability"] == 2          # 1 Jan: the 31 Dec match is inside the one-day gap
    assert not g.loc[(4, 4), "is_valid"]                     # proxy path with a null stat
    assert not g.loc[(6, 1), "is_valid"]                     # known venue with a null lowest score
    assert g.loc[(6, 1), "opposition_runs_conceded_last_match"] == 160  # team 2's last day had no bowling
    assert g.loc[(9, 3), "min_fantasy_score_current_year"] == 5.0        # last season: rows but no points
    assert g.loc[(9, 3), "total_matches_current_year"] == 2
    assert g.loc[(7, 1), "player_career_matches_at_venue"] == 6          # includes the undated row and the future
