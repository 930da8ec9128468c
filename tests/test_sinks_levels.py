"""Repeatable, bounded sinks; all report levels from one shuffle."""

import glob

from pyspark.sql import functions as F

from anchorwise.operators import enrich as EN
from anchorwise.operators import reports as R
from anchorwise.sources import fixtures as fx
from anchorwise.sources import sinks as SK
from tests.conftest import SF0001


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_writing_twice_gives_the_same_table(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).alias("request_id"), "id",
                                  F.expr("date_add(date'2024-01-01', cast(id % 3 = 0 or id % 7 = 0 as int) * 2)").alias("cutoff_date"))
    path = SK.store_by_date(df, SK.output_path(spark, "dates"), partitions=6)
    one = spark.read.schema(df.schema).parquet(path).select(*df.columns).checkpoint()
    assert _same(one, df)
    SK.store_by_date(df, path, partitions=6)
    assert _same(spark.read.schema(df.schema).parquet(path).select(*df.columns), df)
    part = df.where("cutoff_date = date'2024-01-01'").withColumn("id", -F.col("id"))
    SK.store_by_date(part, path, partitions=6)
    assert _same(spark.read.schema(df.schema).parquet(path).select(*df.columns), df.where("cutoff_date > date'2024-01-01'").unionAll(part))
    SK.store_by_date(df.limit(0), path, partitions=6)
    assert spark.read.parquet(path).count() == 5000


def test_files_are_bounded_and_a_hot_request_spreads(spark):
    df = spark.range(20000).select(F.lit(1).alias("request_id"), "id", F.expr("date_add(date'2024-01-01', cast(id % 5 as int))").alias("cutoff_date"))
    path = SK.store_by_date(df, SK.output_path(spark, "hot"), partitions=20)
    files = glob.glob(f"{path}/*/*.parquet")
    assert 20 <= len(files) <= 25


def test_levels_equal_the_single_reports(spark):
    preds = EN.with_profiles(fx.predictions(spark, SF0001), None)
    levels = R.level_report(preds, {"team": "team_no", "role": "role"}).drop("system_quality")
    for level, key in (("team", "team_no"), ("role", "role")):
        want = R.group_stats(preds, ["request_id", key]).select(
            "request_id", F.col(key).cast("string").alias("item"), "count", "min", "max")
        assert _same(levels.where(F.col("level") == level).select("request_id", "item", "count", "min", "max"), want)
    whole = R.distribution_report(fx.predictions(spark, SF0001)).select("request_id", F.col("total_predictions").alias("count"), "min", "max",
                                                                        "low_scores", "medium_scores", "high_scores", "very_high_scores")
    assert _same(levels.where("level = 'request'").select(*whole.columns), whole)
    plan = levels._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") - _exchanges(preds) == 1


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_levels_of_odd_rows(spark):
    df = spark.createDataFrame([(1, None, "a", 10.0), (1, 2, None, None), (None, 2, "a", 30.0)],
                               "request_id long, team_no int, role string, fp_pred double")
    rows = {(r["request_id"], r["level"], r["item"]): r["count"] for r in R.level_report(df, {"team": "team_no", "role": "role"}).collect()}
    assert rows == {(1, "request", None): 1, (1, "team", None): 1, (1, "team", "2"): 0, (1, "role", "a"): 1, (1, "role", None): 0,
                    (None, "request", None): 1, (None, "team", "2"): 1, (None, "role", "a"): 1}
    assert R.level_report(df.limit(0), {"team": "team_no"}).count() == 0
