"""Readers (S1-S9) and sinks: raw CSVs with dirty keys, alias columns and mixed date formats load
into the same datasets as the parquet views, and features built from them are identical."""

import os
import tempfile

from pyspark.sql import functions as F

from anchorwise.operators import anchors as A
from anchorwise.operators import features as FE
from anchorwise.sources import fixtures as fx
from anchorwise.sources import readers as RD
from anchorwise.sources import sinks as SK
from tests.conftest import SF0001


def _write_csvs(spark, folder):
    inn = fx.innings(spark, SF0001).toPandas()
    raw = inn.copy()
    # half the dates as yyyyMMdd numbers, half as ISO text
    raw["match_date"] = [d.strftime("%Y%m%d") if i % 2 else d.isoformat() for i, d in enumerate(raw["match_date"])]
    raw.to_csv(f"{folder}/playerInningStat_merged.csv", index=False)
    fx.profiles(spark, SF0001).toPandas().to_csv(f"{folder}/ipl_player_profiles_2024-2025.csv", index=False)
    v = fx.venue_stats(spark, SF0001).toPandas().rename(columns={
        "venue_id": "ground_id", "total_matches_venue": "matches_played", "highest_score_venue": "highest_score",
        "lowest_score_venue": "min_score", "total_boundaries_venue": "boundaries"})
    v.to_csv(f"{folder}/venueStats_merged.csv", index=False)
    d = fx.deliveries(spark, SF0001).toPandas().rename(columns={"batter_id": "batter", "batsman_runs": "runs",
                                                                  "over": "over_number"})
    d["match_date"] = [x.strftime("%Y%m%d") for x in d["match_date"]]
    d.to_csv(f"{folder}/deliveries_combined_2008_2025.csv", index=False)
    m = fx.matchstat(spark, SF0001).toPandas().rename(columns={"team_id": "team", "result": "match_result"})
    m.to_csv(f"{folder}/matchStat_merged.csv", index=False)
    with open(f"{folder}/crosswalk.csv", "w") as fh:
        fh.write('ground_name_howstat,ground_id_howstat,ground_id_espn,ground_name_espn,City\n'
                 'Ground A,22,1,"Ground A, Town",Town\nGround B,3,2,"Ground B, City", City\n')
    return inn


def test_csv_folder_loads_to_the_same_features(spark):
    folder = tempfile.mkdtemp(prefix="anchorwise-csv-")
    _write_csvs(spark, folder)
    csv = RD.load_csv_dir(spark, folder)
    pq = fx.load_datasets(spark, SF0001)
    assert csv.innings.count() == pq.innings.count()
    assert csv.innings.where(F.col("match_date").isNull()).count() == 0
    assert set(csv.venue_stats.columns) >= {"venue_id", "total_matches_venue", "highest_score_venue",
                                           "lowest_score_venue", "total_boundaries_venue", "average_runs_venue"}
    assert {r["result"] for r in csv.matchstat.select("result").distinct().collect()} <= {"won", "lost", "unknown"}
    assert csv.profiles.where(F.col("player_id").isNull()).count() == 0
    cols = ["match_id", "player_id", *FE.FEATURES, "prior_matches_at_venue", "is_valid"]
    a = FE.build_features(A.training_anchors(csv.innings), csv.innings, csv.deliveries, csv.matchstat,
                          csv.venue_stats).select(*cols)
    b = FE.build_features(A.training_anchors(pq.innings), pq.innings, pq.deliveries, pq.matchstat,
                          pq.venue_stats).select(*cols)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_absent_optional_csv_is_none_and_crosswalk_is_trimmed(spark):
    folder = tempfile.mkdtemp(prefix="anchorwise-csv-")
    _write_csvs(spark, folder)
    assert RD.read_optional(spark, f"{folder}/no_such_file.csv") is None
    cw = RD.read_crosswalk(spark, f"{folder}/crosswalk.csv").collect()
    assert [r["City"] for r in cw] == ["Town", "City"] and cw[0]["ground_name_espn"] == "Ground A, Town"


def test_team_sink_roundtrip(spark):
    team = spark.createDataFrame([(1, 10, True, False), (1, 11, False, True), (2, 12, True, False)],
                                 "request_id long, player_id long, captain boolean, vice_captain boolean")
    path = SK.write_team(team, SK.output_path(spark, "team"))
    back = spark.read.parquet(path)
    assert back.count() == 3 and os.path.isdir(f"{path}/request_id=1")


def test_nan_infinity_and_junk_text_are_null(spark):
    folder = tempfile.mkdtemp(prefix="anchorwise-csv-")
    with open(f"{folder}/innings.csv", "w") as fh:
        fh.write("player_id,match_date,fantasy_points,fours,match_id\n"
                 "1.0,20240101,nan,inf,7\nNaN,2024-01-02,12.5,2,x\n9007199254740993,2024-01-03,Infinity,1,8\n")
    rows = RD.read_innings(spark, f"{folder}/innings.csv").collect()
    assert [r["player_id"] for r in rows] == [1, None, 9007199254740993]
    assert [r["fantasy_points"] for r in rows] == [None, 12.5, None]
    assert [r["fours"] for r in rows] == [None, 2.0, 1.0] and [r["match_id"] for r in rows] == [7, None, 8]
    keys = spark.createDataFrame([("inf",), ("nan",), (" 5 ",)], "k string")
    assert [r[0] for r in keys.select(RD.clean_key(F.col("k"))).collect()] == [None, None, 5]
