"""Tables in the folder that the cluster shares: written once, read by path, so lost executors cost no lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir

BROADCAST_ROWS = 500_000  # of at most 64 bytes; beyond, the join is shuffled


def fresh(spark: SparkSession, name: str) -> str:
    """A new path below spark.checkpoint.dir."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once and read back."""
    path = fresh(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sized(df: DataFrame) -> DataFrame:
    """A stored table of narrow rows: broadcast if its count is within the limit, else joined by shuffle."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df
