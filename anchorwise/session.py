"""Session helpers: a tuned local session for tests/bench, and the shared folder."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "anchorwise") -> SparkSession:
    """Session for tests and bench. On a cluster, use the cluster's own session."""
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster shares for checkpoints and written tables.

    Read from ``spark.checkpoint.dir``; only in a local master's session, where it
    may be unset, a scratch folder is created and registered. Elsewhere it must be set.
    """
    conf = spark.sparkContext.getConf()
    path = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext._jsc.sc().getCheckpointDir()
        path = path.get() if path.isDefined() else None
    if not path:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the cluster shares")
        path = tempfile.mkdtemp(prefix="anchorwise-ckpt-")
    spark.sparkContext.setCheckpointDir(path)
    return path
