"""Spark session and cluster-aware helpers shared by every operator."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Limit for an explicit broadcast hint on an estimated size: Spark's own
# default.  Anything bigger is left to the planner (sort-merge join; AQE may
# still turn it into a broadcast once the real size is known).
BROADCAST_LIMIT_BYTES = 10 * 1024 * 1024

# Estimated size up to which an exact quantile may sit in one task.
ONE_TASK_BYTES = 64 * 1024 * 1024


def get_session(master: str | None = None, partitions: int | None = None,
                app: str = "countpanel") -> SparkSession:
    """Build (or reuse) a session configured for the panel workloads.

    On a cluster the master, memory and checkpoint folder come from the
    submit configuration; here we only set what is safe everywhere.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
    }
    if partitions:
        conf["spark.sql.shuffle.partitions"] = str(partitions)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster decides the folder.  Only a local session without the setting
    (tests) gets a scratch folder of its own; elsewhere a folder of one machine
    would lose data, so the missing setting is an error.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="countpanel-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def estimated_size(df: DataFrame) -> int | None:
    """Optimizer's size estimate of ``df`` in bytes (no job is run)."""
    try:
        stats = df._jdf.queryExecution().optimizedPlan().stats()
        return int(str(stats.sizeInBytes()))
    except Exception:  # noqa: BLE001 - estimate is advisory only
        return None


def small(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Broadcast ``df`` only when its estimated size is provably small.

    Beyond the limit the frame is returned untouched, so the planner falls
    back to a shuffle join (and AQE can still switch at runtime).
    """
    from pyspark.sql import functions as F

    size = estimated_size(df)
    if size is not None and size <= limit:
        return F.broadcast(df)
    return df


def bounded(df: DataFrame) -> DataFrame:
    """Broadcast a side whose size is bounded by construction.

    Use only for literal tables (bin edges, rates, calendars of fixed length,
    hour lists) or one-row aggregates; their size never grows with the data.
    """
    from pyspark.sql import functions as F

    return F.broadcast(df)
