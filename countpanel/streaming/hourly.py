"""Streaming operators (T1-T3) and an ``availableNow`` runner.

Event time in the tables is ``timestamp_ntz``; watermarks need
``timestamp``, so streams cast on the way in and back on the way out.
Sinks and checkpoints live under the cluster's shared checkpoint folder
(``spark.checkpoint.dir``), so a restarted query resumes where it stopped.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from countpanel.session import ensure_checkpoint_dir, small

STATE = "spark.sql.streaming.stateStore"
# one state row per open window or reading: on local disk, with memory that one limit bounds for all stores of an
# executor (500 MB by default); the store in memory holds every row in the heap, in a local session in the driver's
STATE_ON_DISK = {f"{STATE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
                 f"{STATE}.rocksdb.boundedMemoryUsage": "true"}


def read_stream(spark: SparkSession, folder: str, name: str, schema: str) -> DataFrame:
    """File stream of one table (``name.parquet``) inside ``folder``."""
    return (spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
            .option("maxFilesPerTrigger", 1).parquet(folder))


def with_event_time(df: DataFrame, ts: str, out: str = "event_time") -> DataFrame:
    return df.withColumn(out, F.col(ts).cast("timestamp"))


# T1 ---------------------------------------------------------------------
def stream_hourly(df: DataFrame, key: str, ts: str, value: str, delay: str = "2 hours") -> DataFrame:
    """Tumbling hourly sum and count per key with a watermark.

    In append mode a window is emitted once the watermark (latest event
    time - ``delay``) passes its end, and its state is dropped; rows for a
    window that was already emitted are discarded as late.  Rows behind the
    watermark whose window is still open may still count (Spark's
    one-sided guarantee)."""
    d = with_event_time(df, ts).withWatermark("event_time", delay)
    return (d.groupBy(key, F.window("event_time", "1 hour").alias("w"))
            .agg(F.sum(value).alias("total_count"), F.count(value).alias("n_obs"))
            .select(key, F.col("w.start").cast("timestamp_ntz").alias("window_start"), "total_count", "n_obs"))


# T2 ---------------------------------------------------------------------
def stream_alerts(df: DataFrame, expected: DataFrame, key: str, value: str, hi: float, lo: float) -> DataFrame:
    """Stream-static join with a prediction table, then surge / blockage filter."""
    e = F.col(value) - F.col("expected")
    return (df.join(small(expected), key)
            .withColumn("error", e)
            .filter((e > F.lit(hi)) | (e < F.lit(lo)))
            .withColumn("status", F.when(e > F.lit(hi), "surge").otherwise("blockage")))


def stream_hourly_alerts(df: DataFrame, expected: DataFrame, key: str, ts: str, value: str, hi: float, lo: float,
                         delay: str = "2 hours") -> DataFrame:
    """T1 into T2: closed hourly windows joined to the expected total of their
    (key, hour of day), surges and blockages out.

    ``expected`` has the columns ``key``, hour, expected.  In append mode a
    window is judged once, when the watermark closes it, so a late reading can
    neither raise nor withdraw an alert; windows without an expectation raise
    none.  The windows come from the state, in a trigger without new rows too:
    the planner would take them for empty there and collect every closed window
    in the driver for a broadcast, so the join is a merge of both sides unless
    ``expected`` is small."""
    h = stream_hourly(df, key, ts, value, delay).withColumn("hour", F.hour("window_start"))
    error = F.col("total_count") - F.col("expected")
    static = small(expected)
    if static is expected:
        static = expected.hint("merge")
    return (h.join(static, [key, "hour"]).withColumn("error", error)
            .filter((error > F.lit(hi)) | (error < F.lit(lo)))
            .withColumn("status", F.when(error > F.lit(hi), "surge").otherwise("blockage")))


# T3 ---------------------------------------------------------------------
def stream_dedupe(df: DataFrame, keys: list[str], ts: str, delay: str = "1 hour") -> DataFrame:
    """Drop re-delivered readings: same keys within the watermark delay."""
    d = with_event_time(df, ts).withWatermark("event_time", delay)
    return d.dropDuplicatesWithinWatermark(keys).drop("event_time")


# runner -----------------------------------------------------------------
@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, unless the session
    names a store itself or the checkpoint was written by another one.  A stream
    copies the session's settings when it starts, so they are put back after."""
    named = spark.conf.get(f"{STATE}.providerClass", None)
    missing = {} if named else {k: v for k, v in STATE_ON_DISK.items() if spark.conf.get(k, None) is None}
    for k, v in missing.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k in missing:
            spark.conf.unset(k)


def run_available_now(df: DataFrame, mode: str = "append", name: str = "stream",
                      root: str | None = None, keys: list[str] | None = None) -> DataFrame:
    """Process everything available, then stop; return the sink as a table.

    append: rows go to a Parquet sink.  update: every micro-batch writes the
    rows that it changed under its own number (a repeated batch overwrites
    itself), and the last version of each ``keys`` is the answer; state stays
    bounded by the watermark, as windows behind it are dropped.
    Passing the same ``root`` again resumes from its checkpoint (a later
    trigger of the same query).
    """
    spark = df.sparkSession
    root = root or f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}-{uuid.uuid4().hex[:12]}"
    out, ckpt = f"{root}/data", f"{root}/checkpoint"
    w = df.writeStream.option("checkpointLocation", ckpt).trigger(availableNow=True).outputMode(mode)
    with state_on_disk(spark):
        if mode == "update":
            q = w.foreachBatch(lambda b, n: b.write.mode("overwrite").parquet(f"{out}/batch={n}")).start()
        else:
            q = w.format("parquet").option("path", out).start()
    q.awaitTermination()
    if mode == "update":
        columns = df.columns
        versions = spark.read.schema(StructType([*df.schema.fields, StructField("batch", LongType())])).parquet(out)
        last = versions.groupBy(*keys).agg(F.max_by(F.struct(*columns), "batch").alias("row"))
        return last.select("row.*")
    return spark.read.schema(df.schema).parquet(out)
