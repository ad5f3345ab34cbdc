"""Anomaly detection."""

from __future__ import annotations

import sys
import zlib
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from countpanel.operators import windows as W
from countpanel.operators.aggs import exact_quantiles
from countpanel.session import cut_lineage, small

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # task functions travel by value


# N1 ---------------------------------------------------------------------
# A daily calendar bounds a series (36,525 rows a century), whatever the number
# of raw readings, so here a series is one window partition: all steps of N1 and
# N2 share one shuffle on the key.  Series of unbounded length go through the
# chunked windows of ``operators.windows`` instead.
def _refill(d: DataFrame, key: str, ds: str, col: str, limit: int, k: int) -> DataFrame:
    """Linear interpolation of up to ``limit`` rows after a known value, then
    the value k rows before, else k rows after (W14, W15) on a calendar with
    positions ``_pos``."""
    p, w = F.col("_pos"), Window.partitionBy(key).orderBy(ds)
    known = F.when(F.col(col).isNotNull(), F.struct(p.alias("p"), F.col(col).alias("y")))
    # the next known value as a running frame over the reversed order
    after = Window.partitionBy(key).orderBy(F.col(ds).desc()).rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumns({"_prev": F.last(known, ignorenulls=True).over(w.rowsBetween(-limit, 0)), "_next": F.last(known, ignorenulls=True).over(after)})
    line = F.col("_prev.y") + (F.col("_next.y") - F.col("_prev.y")) * (p - F.col("_prev.p")) / (F.col("_next.p") - F.col("_prev.p"))
    filled = F.when(F.col(col).isNotNull() | F.col("_prev").isNull(), F.col(col)).when(F.col("_next").isNull(), F.col("_prev.y")).otherwise(line)
    d = d.withColumn(col, filled).drop("_prev", "_next")
    return d.withColumn(col, F.coalesce(F.col(col), F.lag(col, k).over(w), F.lead(col, k).over(w)))


def continuous_daily(df: DataFrame, key: str = "unique_id", ds: str = "ds", col: str = "y",
                     limit: int = 3, k: int = 7, keep_pos: bool = False) -> DataFrame:
    """Gap-free daily series: calendar reindex, linear interpolation of up
    to ``limit`` days, then the value k days before / after.

    ``df`` has one row per key and day (as an aggregate gives it).  The calendar
    comes from each row's next day, without a join; rows without a day drop
    out.  ``keep_pos`` keeps the days since the key's first for further steps."""
    w = Window.partitionBy(key).orderBy(ds)
    until = F.greatest(F.col(ds), F.coalesce(F.date_sub(F.lead(ds, 1).over(w), 1), F.col(ds)))
    d = df.select(key, F.col(ds).cast("date").alias(ds), col).where(F.col(ds).isNotNull()).withColumns(
        {"_until": until, "_first": F.min(ds).over(Window.partitionBy(key))})
    d = d.select(key, F.explode(F.sequence(ds, "_until", F.expr("INTERVAL 1 DAY"))).alias("_day"), F.col(ds).alias("_own"), col, "_first")
    d = d.select(key, F.col("_day").alias(ds), F.when(F.col("_day") == F.col("_own"), F.col(col)).alias(col),
                 F.datediff("_day", "_first").cast("long").alias("_pos"))
    out = _refill(d, key, ds, col, limit, k)
    return out if keep_pos else out.drop("_pos")


# N2 ---------------------------------------------------------------------
def rolling_outliers(df: DataFrame, key: str = "unique_id", ds: str = "ds", col: str = "y", factor: float = 4.0, window: int = 30,
                     min_periods: int = 7, positioned: bool = False, limit: int = 3, k: int = 7) -> DataFrame:
    """Flag values above ``factor`` x the centred rolling median, blank them
    and refill (interpolation + seasonal fill); ``y_observed`` keeps the
    value before cleaning.  ``df`` is a gap-free daily series; ``positioned``:
    it carries ``_pos``.  Shares the shuffle of :func:`continuous_daily`."""
    w = Window.partitionBy(key).orderBy(ds)
    d = df if positioned else df.withColumn("_pos", F.datediff(ds, F.min(ds).over(Window.partitionBy(key))).cast("long"))
    frame = w.rowsBetween(-(window // 2), window - 1 - window // 2)
    d = d.withColumn("_med", F.when(F.count(col).over(frame) >= min_periods, F.percentile(F.col(col), F.lit(0.5)).over(frame)))
    flag = (F.col(col) > F.lit(factor) * F.col("_med")) & F.col("_med").isNotNull()
    d = (d.withColumn("rolling_outlier", F.coalesce(flag, F.lit(False)).cast("int"))
         .withColumn("y_observed", F.col(col))
         .withColumn(col, F.when(F.col("rolling_outlier") == 1, F.lit(None)).otherwise(F.col(col)))
         .drop("_med"))
    return _refill(d, key, ds, col, limit, k).drop("_pos")


# N3 ---------------------------------------------------------------------
FOREST = "nodes array<int>, features array<int>, cuts array<double>, paths array<double>, roots array<int>"


def _c_factor(n: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search among n rows (1 up to one row)."""
    n = np.asarray(n, float)
    return np.where(n <= 1, 1.0, 2.0 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2.0 * (n - 1) / np.maximum(n, 1))


def grow_forest(x: np.ndarray, trees: int, sample: int, rng: np.random.Generator) -> tuple[np.ndarray, ...]:
    """(left child or -1, feature, cut, path length of a leaf, roots) of an
    isolation forest over the rows of ``x``; all trees grow level by level.

    A node splits on a random feature among those that differ inside it, at a
    random place between its smallest and largest value.  The places follow
    every change of scale, so the features need no standardising."""
    n, m = x.shape
    psi = min(sample, n)
    rows = np.concatenate([rng.permutation(n)[:psi] for _ in range(trees)])
    node = np.repeat(np.arange(trees), psi)
    left, feature, cut, path = (np.full(trees, v) for v in (-1, 0, 0.0, 0.0))
    for depth in range(int(np.ceil(np.log2(max(psi, 2)))) + 1):
        order = np.argsort(node, kind="stable")
        rows, node = rows[order], node[order]
        at, starts, counts = np.unique(node, return_index=True, return_counts=True)
        path[at] = depth + _c_factor(counts)
        lo, hi = (f.reduceat(x[rows], starts, axis=0) for f in (np.minimum, np.maximum))
        varies = hi > lo
        f = np.argmax(varies * (rng.random(varies.shape) + 1e-9), axis=1)
        u = rng.random(len(at))
        split = varies.any(1) & (counts > 1) & (depth < int(np.ceil(np.log2(max(psi, 2)))))
        if not split.any():
            break
        pick = np.arange(len(at))
        place = lo[pick, f] + u * (hi[pick, f] - lo[pick, f])
        child = len(left) + 2 * (np.cumsum(split) - 1)
        feature[at[split]], cut[at[split]], left[at[split]] = f[split], place[split], child[split]
        grown = 2 * int(split.sum())
        left, feature, cut, path = (np.concatenate([v, np.full(grown, fill)]) for v, fill in ((left, -1), (feature, 0), (cut, 0.0), (path, 0.0)))
        stays = np.repeat(split, counts)
        rows, node = rows[stays], node[stays]
        node = left[node] + (x[rows, feature[node]] >= cut[node])
    return left, feature, cut, path, np.arange(trees)


def path_lengths(x: np.ndarray, forest: tuple[np.ndarray, ...], step: int = 2048) -> np.ndarray:
    """Mean path length of every row: all (row, tree) pairs take a step at once."""
    left, feature, cut, path, roots = forest
    out = np.zeros(len(x))
    for lo in range(0, len(x), step):
        part = x[lo:lo + step]
        at, rows = np.broadcast_to(roots, (len(part), len(roots))), np.arange(len(part))[:, None]
        while True:
            into = np.where(left[at] < 0, at, left[at] + (part[rows, feature[at]] >= cut[at]))
            if (into == at).all():
                break
            at = into
        out[lo:lo + step] = path[at].mean(1)
    return out


def isolation_scores(df: DataFrame, key: str, ds: str, feats: list[str], trees: int = 200, min_rows: int = 60, seed: int = 42,
                     sample: int = 256, pool: int = 4096, chunk_rows: int = 20_000) -> DataFrame:
    """(key, ds, iso_score) of the rows with all features, of series with at
    least ``min_rows`` such rows (others: null score).

    A series' forest grows from at most ``pool`` of its rows, the first by the
    hash of their values (series no longer than that give all), and is one row of
    node arrays.  Rows meet their forest in chunks of about ``chunk_rows`` per
    series, so a long series is scored by many tasks.  Neither the choice of rows
    nor the scores depend on how rows are partitioned."""
    ok = reduce(lambda a, b: a & b, [F.col(f).isNotNull() & ~F.isnan(F.col(f).cast("double")) for f in feats])
    d = df.select(F.col(key), F.col(ds), *[F.col(f).cast("double").alias(f) for f in feats]).withColumn("_ok", ok)
    rest = d.where(~F.col("_ok")).select(key, ds, F.lit(None).cast("double").alias("iso_score"))
    d = d.where("_ok").drop("_ok")
    n = d.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    order = [F.xxhash64(ds, *feats, F.lit(seed)), F.col(ds), *[F.col(f) for f in feats]]
    drawn = W.head_per_group(W.join_null_safe(d, small(n.where(F.col("_n") >= min_rows)), [key]), [key], order, pool)

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([ds, *feats], kind="stable", ignore_index=True)
        rng = np.random.default_rng([seed, zlib.crc32(str(pdf[key].iloc[0]).encode())])
        found = grow_forest(pdf[feats].to_numpy(float), trees, sample, rng)
        return pd.DataFrame({key: pdf[key].iloc[:1], "_n": pdf["_n"].iloc[:1], **{
            c: [v.tolist()] for c, v in zip(("nodes", "features", "cuts", "paths", "roots"), found)}})

    key_type = d.schema[key].dataType.simpleString()
    forests = cut_lineage(drawn.groupBy(key).applyInPandas(grow, f"{key} {key_type}, _n long, {FOREST}"))
    chunks = F.ceil(F.col("_n") / F.lit(chunk_rows)).cast("int")
    asked = W.join_null_safe(d, small(n), [key]).withColumn("_chunk", F.pmod(F.xxhash64(ds, *feats), chunks).cast("int")).drop("_n")
    sent = forests.withColumn("_chunk", F.explode(F.sequence(F.lit(0), chunks - 1))).drop("_n")

    def walk(rows: pd.DataFrame, forest: pd.DataFrame) -> pd.DataFrame:
        out = rows[[key, ds]].copy()
        out["iso_score"] = np.nan
        if len(forest) and len(rows):
            arrays = tuple(np.asarray(forest[c].iloc[0]) for c in ("nodes", "features", "cuts", "paths", "roots"))
            used = min(sample, forest["_used"].iloc[0])
            out["iso_score"] = 2.0 ** (-path_lengths(rows[feats].to_numpy(float), arrays) / _c_factor(used))
        return out

    sent = W.join_null_safe(sent, small(n.select(key, F.least("_n", F.lit(pool)).alias("_used"))), [key])
    schema = f"{key} {key_type}, {ds} {d.schema[ds].dataType.simpleString()}, iso_score double"
    scored = asked.groupBy(key, "_chunk").cogroup(sent.groupBy(key, "_chunk")).applyInPandas(walk, schema)
    return scored.withColumn("iso_score", F.when(~F.isnan("iso_score"), F.col("iso_score"))).unionByName(rest)


def isolation_flags(df: DataFrame, key: str, ds: str, feats: list[str], trees: int = 200,
                    share: float = 0.03, min_rows: int = 60, seed: int = 42, sample: int = 256, **kw) -> DataFrame:
    """Per-series multivariate isolation forest; the top ``share`` of scores
    in each series is flagged as ``sensor_fault``.  Rows without a score (a
    missing feature, a short series) get no flag."""
    d = cut_lineage(isolation_scores(df, key, ds, feats, trees, min_rows, seed, sample, **kw))
    limit = exact_quantiles(d, "iso_score", [1.0 - share], [key], ["_limit"])
    out = W.join_null_safe(d, small(limit), [key], "left")
    return out.withColumn("sensor_fault", F.coalesce(F.col("iso_score") >= F.col("_limit"), F.lit(False)).cast("int")).drop("_limit")


# N4 ---------------------------------------------------------------------
def combine_flags(df: DataFrame, a: str = "rolling_outlier", b: str = "sensor_fault") -> DataFrame:
    """Counts per layer and for both layers (one aggregate)."""
    return df.agg(F.count_if(F.col(a) == 1).alias(f"n_{a}"), F.count_if(F.col(b) == 1).alias(f"n_{b}"),
                  F.count_if((F.col(a) == 1) & (F.col(b) == 1)).alias("n_both"),
                  F.count_if((F.col(a) == 1) | (F.col(b) == 1)).alias("n_any"))


# N5 ---------------------------------------------------------------------
def hour_kpis(df: DataFrame, hour: str, err: str, actual: str, hi: float, lo: float) -> DataFrame:
    """Per hour: mean signed error, surges, blockages, mean actual - all
    hours in one aggregate (the dashboard slider is just a filter on it)."""
    e = F.col(err)
    return df.groupBy(hour).agg(F.avg(e).alias("mean_error"), F.count_if(e > F.lit(hi)).alias("n_surges"),
                                F.count_if(e < F.lit(lo)).alias("n_blockages"), F.avg(actual).alias("mean_actual"),
                                F.count(F.lit(1)).alias("n_rows"))


# N6 ---------------------------------------------------------------------
def investigation_queue(df: DataFrame, err: str, hi: float, lo: float, key: str | None = None,
                        tiebreak: list[str] | None = None, k: int | None = None) -> DataFrame:
    """Alerts with a status label, largest absolute error first; optionally
    one row per ``key`` (its worst alert) and only the first ``k``."""
    from countpanel.operators.clean import alerts, keep_extreme

    a = alerts(df, err, hi, lo).withColumn(
        "status", F.when(F.col(err) > F.lit(hi), F.lit("surge")).otherwise(F.lit("blockage")))
    if key:
        a = keep_extreme(a, key, err, tiebreak or [])
    if k:
        a = a.orderBy(F.abs(F.col(err)).desc(), *[F.col(t) for t in (tiebreak or [])]).limit(k)
    return a
