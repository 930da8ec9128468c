"""Explicit exchanges get tasks by their rows, and work on a group is done once a group."""

from __future__ import annotations

import math
import re

import pytest
from pyspark.sql import functions as F

from anchorwise.operators import anchors as A
from anchorwise.operators import features as FE
from anchorwise.operators import model as M
from anchorwise.operators import tasks as T


def test_task_count_follows_rows_beyond_the_cores(spark):
    cores = spark.sparkContext.defaultParallelism
    assert T.task_count(spark, 0, 1000) == T.task_count(spark, 1, 1000) == 1
    assert T.task_count(spark, T.SMALL_TASK * cores * 10, 10 * T.SMALL_TASK * cores) == cores
    assert T.task_count(spark, T.SMALL_TASK * cores * 10, 10 * T.SMALL_TASK * cores, share=0.5) == math.ceil(cores / 2)
    assert T.task_count(spark, 10**9, 10**6) == 1000


def test_opponent_squads_are_shown_once_a_squad(spark):
    rows = [(1, 10, 1), (1, 11, 1), (1, 11, 1), (1, 12, 2), (2, 13, 1), (None, 14, 1), (None, 15, 2), (3, 16, None), (1, None, 2)]
    req = spark.createDataFrame(rows, "request_id long, player_id long, team_no int")
    made = spark.sparkContext.accumulator(0)

    def text(squad):
        @F.udf("string")
        def joined(ids):
            made.add(1)
            return ",".join(map(str, ids))
        return joined(squad)

    got = A.opponent_squads(req, {"squad": text}).collect()
    assert sorted((r.request_id or 0, r.player_id or 0, r.team_no or 0, r.squad) for r in got) == [
        (0, 14, 1, ""), (0, 15, 2, ""), (1, 0, 2, "10,11,11"), (1, 10, 1, "12"), (1, 11, 1, "12"), (1, 11, 1, "12"),
        (1, 12, 2, "10,11,11"), (2, 13, 1, ""), (3, 16, 0, "")]
    plain = A.opponent_squads(req)
    assert plain.columns == ["request_id", "player_id", "team_no", "opponent_squad"]
    assert {tuple(r.opponent_squad) for r in plain.collect()} == {(), (12,), (10, 11, 11)}
    # a hundred rows of one side: its text is made once, and once for nobody in each row without an opponent
    made.value = 0
    many = spark.createDataFrame([(1, i, 1) for i in range(100)] + [(1, 200, 2)], "request_id long, player_id long, team_no int")
    A.opponent_squads(many, {"squad": text}).write.format("noop").mode("overwrite").save()
    assert made.value < 100 + 20


def test_as_of_pass_is_dealt_by_rows(spark, monkeypatch):
    monkeypatch.setattr(FE, "PASS_ROWS", 10)
    monkeypatch.setattr(T, "SMALL_TASK", 10)
    inn = spark.createDataFrame(
        [(m, p, f"2022-0{1 + m % 6}-1{m % 9}", 1, 2, 3, 1.0, 1, 1, 1, None, 0, None, 0.0, 1.0) for m in range(12) for p in range(30)],
        "match_id long, player_id long, d string, team_id long, opposition_id long, ground_id long, runs_batting double, fours long,"
        " sixes long, balls_faced long, out string, wickets_taken long, innings_bowling int, runs_conceded double, fantasy_points double",
    ).withColumn("match_date", F.to_date("d")).drop("d")
    h = FE.player_history(inn, A.training_anchors(inn))
    assert h.rdd.getNumPartitions() >= 100  # 360 facts and three rows an anchor, ten rows a task
    assert h.count() == 360


@pytest.mark.parametrize("rows", [30, 3000])
def test_folds_are_dealt_by_rows_and_keep_their_order(spark, monkeypatch, rows):
    monkeypatch.setattr(M, "MATCH_ROWS", 10)
    monkeypatch.setattr(T, "SMALL_TASK", 10)
    df = spark.range(rows).select((F.col("id") % 30).alias("match_id"), F.floor(F.col("id") / 30).alias("player_id"),
                                  F.expr("date_add(DATE'2021-12-25', cast(id % 30 as int))").alias("match_date"))
    got = M.time_series_folds(df)
    if rows == 3000:  # the exchange before the rank has a task for ten rows, and adaptive execution leaves it as it is
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"hashpartitioning\(match_date#\d+, match_id#\d+L?, 300\), REPARTITION_BY_NUM", plan)
    placed = got.orderBy("pos").collect()
    assert [r.pos for r in placed] == list(range(rows))
    assert [(r.match_date, r.match_id, r.player_id) for r in placed] == sorted((r.match_date, r.match_id, r.player_id) for r in placed)


def test_training_uses_no_more_tasks_than_the_fits_need(spark, monkeypatch):
    monkeypatch.setattr(T, "SMALL_TASK", 10)
    seen = []
    whole = M.build_pipeline

    def noted(**kw):
        pipe = whole(**kw)
        fit = pipe.fit
        pipe.fit = lambda df: (seen.append(df.rdd.getNumPartitions()), fit(df))[1]
        return pipe

    monkeypatch.setattr(M, "build_pipeline", noted)
    rows = spark.range(600).select((F.col("id") % 30).alias("match_id"), F.floor(F.col("id") / 30).alias("player_id"),
                                   F.expr("date_add(DATE'2021-12-25', cast(id % 30 as int))").alias("match_date"),
                                   (F.col("id") % 50).cast("double").alias("fantasy_points"),
                                   *[(F.col("id") % (3 + i)).cast("double").alias(c) for i, c in enumerate(M.FEATURES)])
    M.train(spark, rows, cv=False, maxIter=1, maxDepth=2)
    assert seen == [math.ceil(spark.sparkContext.defaultParallelism / 2)]
