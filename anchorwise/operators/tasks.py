"""How many tasks an explicit exchange gets, from a count of its rows.

Adaptive execution sizes tasks by compressed shuffle bytes, so a task's sort buffers grow with how well the rows compress. Where a stage
holds several sorts of wide rows, or runs thousands of times, its tasks are counted in rows instead.
"""

from __future__ import annotations

import math

from pyspark.sql import SparkSession

SMALL_TASK = 20_000  # rows: fewer cost more to start than to run


def task_count(spark: SparkSession, rows: int, rows_per_task: int, share: float = 1.0) -> int:
    """Tasks of ``SMALL_TASK`` rows until ``share`` of the cores have one each, then larger ones up to ``rows_per_task`` rows, and
    from there on as many as the rows need."""
    busy = min(math.ceil(rows / SMALL_TASK), math.ceil(share * spark.sparkContext.defaultParallelism))
    return max(1, busy, math.ceil(rows / rows_per_task))
