"""Sorts, top-k, set operations and reshaping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countpanel.session import bounded


# K2 / K3 / K4 -------------------------------------------------------------
def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """Sort + limit; Spark plans it as TakeOrderedAndProject (each task keeps
    its own k best rows, the driver merges k x tasks rows).  Include a
    unique tiebreak in ``order`` so the result is deterministic."""
    return df.orderBy(*order).limit(k)


# K5 ---------------------------------------------------------------------
def order_by_list(df: DataFrame, col: str, values: Sequence[str], pos: str = "pos") -> DataFrame:
    """Re-index to a fixed category order; categories absent from ``df``
    appear with nulls.  The category list is a literal of fixed length."""
    spark = df.sparkSession
    cats = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"{pos} int, {col} string")
    return bounded(cats).join(df, col, "left").select(pos, col, *[c for c in df.columns if c != col])


# U1 / U2 / U3 -------------------------------------------------------------
def union_all(dfs: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), dfs)


def tagged_union(parts: Mapping[str, DataFrame], tag: str = "tag") -> DataFrame:
    return union_all([d.withColumn(tag, F.lit(name)) for name, d in parts.items()])


def intersect(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b)


def except_(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.subtract(b)


# U4 / U5 / U6 -------------------------------------------------------------
def melt(df: DataFrame, ids: Sequence[str], cols: Sequence[str], var: str = "variable",
         value: str = "value") -> DataFrame:
    return df.unpivot(list(ids), list(cols), var, value)


def stack_metrics(pairs: DataFrame, variables: Sequence[str], a_sfx: str, f_sfx: str, d: int = 6) -> DataFrame:
    """Per-variable error metrics as columns of one aggregate row."""
    aggs = []
    for v in variables:
        aggs.append(F.round(F.avg(F.abs(F.col(v + a_sfx) - F.col(v + f_sfx))), d).alias(f"{v}_mae"))
    for v in variables:
        aggs.append(F.round(F.max(F.abs(F.col(v + a_sfx) - F.col(v + f_sfx))), d).alias(f"{v}_max_err"))
    return pairs.agg(*aggs)
