"""Checked CSV readers: every issue in the reject table, the rows that stay, and the counts of the one pass."""

import pytest
from pyspark.sql import functions as F

from anchorwise.plans import csv_queries as Q
from anchorwise.sources import checked as C


def _file(tmp_path, text):
    path = tmp_path / "t.csv"
    path.write_text(text)
    return str(path)


def test_issues_of_every_kind(spark, tmp_path):
    path = _file(tmp_path, "player_id,match_date,x\n1,20240101,a\nx7,20240101,b\n,20240101,c\n nan ,2024-01-01,d\n2,20240132,e\n3,,f\n4,2024/02/03,g,h\n5,20240101\n6.0,2024-13-01,\n")
    got = C.read_checked(spark, path, "t", ["player_id"], ["match_date"], ["x"])
    rejects = [(r["column"], r["value"], r["reason"], r["dropped"]) for r in got.rejects.collect()]
    assert len(rejects) == 7 and set(rejects) == {
        ("", "4,2024/02/03,g,h", "corrupt record", True), ("", "5,20240101", "corrupt record", True),
        ("player_id", "x7", "bad key", True), ("player_id", None, "no key", True), ("player_id", " nan ", "bad key", True),
        ("match_date", "20240132", "bad date", False), ("match_date", "2024-13-01", "bad date", False)}
    assert got.metrics == {"rows": 9, "dropped": 5, "bad_dates": 2}
    assert sorted(r["player_id"] for r in got.rows.collect()) == ["1", "2", "3", "6.0"] and got.rows.columns == ["player_id", "match_date", "x"]
    with pytest.raises(ValueError, match="fantasy_points"):
        C.read_checked(spark, path, "t", required=["x", "fantasy_points"])


def test_header_only_file_has_no_rows(spark, tmp_path):
    got = C.read_checked(spark, _file(tmp_path, "player_id,match_date\n"), "t", ["player_id"], ["match_date"])
    assert got.rows.count() == 0 and got.rejects.count() == 0 and got.metrics["rows"] == 0


def test_absent_optional_tables_are_none(spark, tmp_path):
    for t in ("innings", "profiles"):
        (tmp_path / C.FILES[t]).write_text("player_id,match_id,match_date,fantasy_points\n1,2,20240101,3.5\n")
    data, rejects, metrics = C.load_checked_dir(spark, str(tmp_path))
    assert data.deliveries is None and data.venue_stats is None and data.matchstat is None
    assert rejects.count() == 0 and set(metrics) == {"innings", "profiles"}
    r = data.innings.collect()[0]
    assert (r["player_id"], r["match_id"], str(r["match_date"]), r["fantasy_points"]) == (1, 2, "2024-01-01", 3.5)
    with pytest.raises(Exception, match="(?i)path"):
        C.load_checked_dir(spark, str(tmp_path / "nowhere"))


def test_the_source_is_parsed_once(spark):
    """Rows and rejects are read from the stored pass, not from the CSV files."""
    folder = Q._write_raw(spark, "/root/testdata/sf0.001", faults=True)
    data, rejects, metrics = C.load_checked_dir(spark, folder)
    for df in (data.innings, rejects):
        assert "csv" not in df._jdf.queryExecution().executedPlan().toString().lower().replace("/csv-", "")
    assert metrics["innings"]["rows"] - metrics["innings"]["dropped"] == data.innings.count()
    assert data.innings.where(F.col("match_date").isNull()).count() == metrics["innings"]["bad_dates"] > 0
