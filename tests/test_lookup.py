"""Lookups without a shuffle of the anchors: same rows broadcast and salted, plans, as-of search, parts of the history."""

import bisect
import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from anchorwise.operators import anchors as A
from anchorwise.operators import features as FE
from anchorwise.operators import lookup
from anchorwise.sources import fixtures as fx
from tests.conftest import SF0001

OPPOSITION = [*FE.FEATURES[20:24], "src_opposition"]


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _anchors(spark):
    """Training anchors, their copies without an opposition, and with a team that never played."""
    ds = fx.load_datasets(spark, SF0001)
    a = A.training_anchors(ds.innings)
    none = a.withColumn("opposition_id", F.lit(None).cast("long"))
    return ds, a.unionByName(none).unionByName(a.withColumn("opposition_id", F.lit(0).cast("long"))).unionByName(
        a.withColumn("opposition_id", F.lit(10 ** 6).cast("long")))


def test_salted_opposition_equals_broadcast(spark):
    ds, a = _anchors(spark)
    cols = ["match_id", "player_id", "cutoff_date", "opposition_id", *OPPOSITION]
    small = FE.with_opposition(a, ds.innings, ds.matchstat).select(*cols)
    large = FE.with_opposition(a, ds.innings, ds.matchstat, broadcast_bytes=0).select(*cols)
    assert small.count() == a.count() and _same(small, large)
    plan = large._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan and "broadcast" not in plan


def test_null_keys_and_hot_keys_are_spread(spark):
    """All rows on a null or on one key: the salted join deals them over many tasks and keeps each."""
    rows = spark.range(4000).select(F.col("id").alias("r"), F.when(F.col("id") % 2 == 0, F.lit(7).cast("long")).alias("k"))
    table = spark.createDataFrame([(7, "x")], "k long, v string")
    got = lookup.left_lookup(rows, table, "k", 1000, ["r"], broadcast_bytes=0)
    assert got.count() == 4000 and got.where("v = 'x'").count() == 2000
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tasks = got.withColumn("p", F.spark_partition_id()).groupBy("p", F.col("k").isNull().alias("n")).count()
        by_kind = {n: c for n, c in tasks.groupBy("n").agg(F.count(F.lit(1))).collect()}
        assert by_kind[True] == 8 and by_kind[False] >= 6
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_salted_table_is_never_broadcast(spark):
    """Spark takes a table of a few long texts for small; its copies must not go through the driver all the same."""
    rows = spark.range(400).select(F.col("id").alias("r"), (F.col("id") % 5).alias("k"))
    table = spark.range(4).groupBy(F.col("id").alias("k")).agg(F.first(F.lit("x" * 1000)).alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100m")
    try:
        got = lookup.left_lookup(rows, table, "k", 1000, ["r"], broadcast_bytes=0)
        assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()
        assert got.count() == 400 and got.where("length(v) = 1000").count() == 320 and got.where("v is null").count() == 80
        squads = A.opponent_squads(fx.requests(spark, SF0001))
        assert "Broadcast" in squads._jdf.queryExecution().executedPlan().toString()  # a small table still is
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("days", [[], [3], [3, 5], list(range(0, 40, 3))])
def test_latest_before_equals_bisection(spark, days):
    start = dt.date(2022, 1, 1)
    at = [start + dt.timedelta(d) for d in days]
    rows = [(at, start + dt.timedelta(c)) for c in range(-1, 45)] + [(at, None), (None, start)]
    df = spark.createDataFrame([([(d,) for d in s] if s is not None else None, c) for s, c in rows],
                               "s array<struct<d: date>>, c date")
    got = df.select("c", "s", lookup.latest_before(F.col("s"), "d", F.col("c"))["d"].alias("g")).collect()
    for r in got:
        n = bisect.bisect_left(at, r["c"]) if r["s"] is not None and r["c"] is not None else 0
        assert r["g"] == (at[n - 1] if n else None)


def test_empty_tables(spark):
    ds, a = _anchors(spark)
    none = FE.with_opposition(a, ds.innings.limit(0), ds.matchstat.limit(0)).select(*OPPOSITION).distinct().collect()
    assert {r["src_opposition"] for r in none} == {"used_default_no_opposition_data", "used_default_no_opposition_matches"}
    assert FE.with_opposition(a.limit(0), ds.innings, ds.matchstat).count() == 0


def _exchanges(df) -> list[str]:
    return [line.split("hashpartitioning(", 1)[1] for line in df._jdf.queryExecution().executedPlan().toString().splitlines()
            if "Exchange hashpartitioning(" in line]


def test_no_anchor_shuffle_after_the_pass(spark):
    """features_all: no exchange on the opposition, its cutoff or the last match's day, also where nothing is broadcast
    by Spark's own estimate."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("features_all", "prediction_features"):
            keys = _exchanges(E.queries()[name](spark, SF0001))
            assert keys and not [k for k in keys if k.startswith("opposition_id") or "_last_d" in k], name
        assert not [k for k in _exchanges(E.queries()["features_all"](spark, SF0001)) if "cutoff_date" in k]
        form = _exchanges(E.queries()["recent_form"](spark, SF0001))
        assert not [k for k in form if "_g#" in k or "_yr#" in k]  # no venue or season tables for the last matches
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_parts_of_the_history_equal_the_whole(spark):
    ds = fx.load_datasets(spark, SF0001)
    a = A.training_anchors(ds.innings)
    whole = FE.player_history(ds.innings, a, deliveries=ds.deliveries)
    bare = FE.player_history(ds.innings, a, parts=())
    assert not [c for c in bare.columns if c.startswith(("_cur", "_prev", "_venue"))]
    plain = whole.withColumn("_hist", F.transform("_hist", lambda r: r.dropFields("balls_of_day")))
    assert _same(plain.select("match_id", "player_id", "_n", "_hist"), bare.select("match_id", "player_id", "_n", "_hist"))
    for part, prefixes in (("season", ("_cur", "_prev")), ("venue", ("_venue",))):
        one = FE.player_history(ds.innings, a, parts=(part,))
        cols = ["match_id", "player_id", *[c for c in one.columns if c.startswith(prefixes)]]
        assert len(cols) > 2 and _same(whole.select(*cols), one.select(*cols))
    with pytest.raises(ValueError, match="parts"):
        FE.player_history(ds.innings, a, parts=("weather",))
