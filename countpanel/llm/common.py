"""Helpers shared by the corpus operators."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from countpanel.session import ensure_checkpoint_dir


#: Spark setting: remove an execution's shuffle files when it ends.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def ship(module: str) -> None:
    """Send this module's task functions by value, so executors need not have
    the package on their own path."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it
    back: later jobs reuse the rows and survive the loss of any executor.  The
    job's own shuffle files go once it has ended."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    before = spark.conf.get(DROP_SHUFFLES, "false")
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        # a new plan: the setting holds for plans made from here on
        df.select("*").write.parquet(path)
    finally:
        spark.conf.set(DROP_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def byte_texts(column: pa.Array, step: int = 256) -> Iterator[tuple[int, bytes]]:
    """(row, UTF-8 bytes) of a string column, null as empty; only ``step``
    rows are held as Python objects at a time."""
    column = column.cast(pa.large_binary())
    for lo in range(0, len(column), step):
        for i, b in enumerate(column.slice(lo, step).to_pylist(), lo):
            yield i, b or b""


def str_texts(column: pa.Array, step: int = 256) -> Iterator[tuple[int, str]]:
    """(row, text) of a string column, null as empty."""
    for lo in range(0, len(column), step):
        for i, s in enumerate(column.slice(lo, step).to_pylist(), lo):
            yield i, s or ""


def blocks(column: pa.Array, limit: int) -> Iterator[tuple[int, int]]:
    """(first row, number of rows) of runs of rows with at most ``limit``
    bytes of text, one row at least."""
    n = len(column)
    ends = np.append(0, np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)))
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + limit, side="right")) - 1)
        yield lo, hi - lo
        lo = hi


ship(__name__)
