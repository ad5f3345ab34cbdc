"""Order-dependent operators.

Skew-safe positional windows
----------------------------
A plain ``Window.partitionBy(site)`` sends every row of a site to one task;
if one site holds a third of the data, that task holds a third of the data.
All positional operators here therefore run through :func:`with_positions`
and :func:`framed`:

1. each row gets its 0-based position inside its key without a whole-key
   window: rows are counted per (key, time bucket) - a partial aggregate -
   the small count table gets running offsets, and a window partitioned by
   (key, bucket) numbers the rows;
2. positions are cut into chunks of ``chunk_rows``; a row is copied into the
   neighbouring chunk when a frame there reaches it (at most ``span`` rows
   per chunk edge), windows run per (key, chunk), and only the home copy of
   each row is kept.

The result is exactly the whole-key window; no task holds more than
``chunk_rows + span`` rows of a key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from countpanel.session import bounded, small

DEFAULT_CHUNK_ROWS = 1_000_000
DEFAULT_BUCKET_DAYS = 7


def _epoch_days(c: Column) -> Column:
    """Days since epoch of a date / timestamp / numeric order column."""
    return F.unix_date(c.cast("date"))


DEFAULT_HOT_ROWS = 1_000_000
NULL_BUCKET = 1 << 62  # rows without an order value form the last bucket of their key


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys match each other; ``right``'s keys drop out."""
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    same = reduce(lambda a, b: a & b, [left[k].eqNullSafe(r[f"_r_{k}"]) for k in keys])
    return left.join(r, same, how).drop(*[f"_r_{k}" for k in keys])


def with_positions(df: DataFrame, keys: list[str], order: str, tiebreak: list[str] | None = None,
                   bucket_days: int = DEFAULT_BUCKET_DAYS, pos: str = "_pos",
                   total: str | None = None, fine_seconds: int | None = 60,
                   hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """Add the 0-based row position within ``keys`` ordered by ``order``.

    ``order`` must be a date or timestamp column.  Rows are counted per
    (key, week) - a partial aggregate - and the small per-key table of
    weekly counts gives running offsets; the rows are then numbered per
    (key, week).  A week holding more than ``hot_rows`` rows of one key (a
    hot key) is split further for timestamp orders: only its rows are
    counted per minute, offsets inside the week come from a window over at
    most 10080 minute counts, and numbering runs per (key, week, minute).
    Normal weeks pay nothing for this; hot ones are numbered in bounded
    pieces.  With ``total`` the number of rows of the key is added too.

    No row is lost: rows with a null key form a group of their own, rows with
    a null order come last in their key.
    """
    tiebreak = tiebreak or []
    t = F.col(order)
    b = df.withColumn("_bkt", F.coalesce(F.floor(_epoch_days(t) / F.lit(bucket_days)), F.lit(NULL_BUCKET)))
    split = bool(fine_seconds) and dict(df.dtypes)[order].startswith("timestamp")
    cnt = b.groupBy(*keys, "_bkt").agg(F.count(F.lit(1)).alias("_cnt"))
    wk = Window.partitionBy(*keys).orderBy("_bkt")
    off = cnt.withColumn("_off", F.coalesce(
        F.sum("_cnt").over(wk.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    if total:
        off = off.withColumn(total, F.sum("_cnt").over(Window.partitionBy(*keys)))
    off = off.withColumn("_hot", F.col("_cnt") > F.lit(hot_rows) if split else F.lit(False)).drop("_cnt")
    out = join_null_safe(b, small(off), [*keys, "_bkt"])
    if split:
        fine = F.floor(F.unix_micros(t.cast("timestamp")) / F.lit(fine_seconds * 1_000_000))
        out = out.withColumn("_fine", F.when(F.col("_hot"), F.coalesce(fine, F.lit(0))).otherwise(F.lit(0)))
        cnt2 = out.filter("_hot").groupBy(*keys, "_bkt", "_fine").agg(F.count(F.lit(1)).alias("_cnt"))
        w2 = Window.partitionBy(*keys, "_bkt").orderBy("_fine").rowsBetween(Window.unboundedPreceding, -1)
        off2 = cnt2.select(*keys, "_bkt", "_fine", F.coalesce(F.sum("_cnt").over(w2), F.lit(0)).alias("_off2"))
        out = (join_null_safe(out, small(off2), [*keys, "_bkt", "_fine"], "left")
               .withColumn("_off", F.col("_off") + F.coalesce(F.col("_off2"), F.lit(0))).drop("_off2"))
        parts = [*keys, "_bkt", "_fine"]
    else:
        parts = [*keys, "_bkt"]
    w = Window.partitionBy(*parts).orderBy(t.asc_nulls_last(), *[F.col(c) for c in tiebreak])
    out = out.withColumn(pos, F.col("_off") + F.row_number().over(w) - 1)
    return out.drop("_bkt", "_off", "_hot", *(["_fine"] if split else []))


def framed(df: DataFrame, keys: list[str], order: str, exprs, lo: int, hi: int,
           tiebreak: list[str] | None = None, chunk_rows: int = DEFAULT_CHUNK_ROWS,
           bucket_days: int = DEFAULT_BUCKET_DAYS, positioned: bool = False,
           fine_seconds: int | None = 60, bounded_series: bool = False) -> DataFrame:
    """Evaluate window expressions whose frames stay within rows [lo, hi].

    ``exprs`` is a function ``(window_spec) -> dict[name, Column]`` so that
    every column uses the same (key, chunk) partitioning and one sort.
    ``positioned=True`` means ``df`` already has a ``_pos`` column;
    ``fine_seconds=None`` says that no (key, week) can be hot, as in a panel
    with one row per key and hour.  ``bounded_series`` says that a calendar
    bounds every series (a daily or hourly aggregate): each is then one window
    partition, behind a single shuffle.
    """
    assert lo <= 0 <= hi
    if bounded_series:
        by = [F.col(c).asc_nulls_last() for c in (["_pos"] if positioned else [order, *(tiebreak or [])])]
        return df.withColumns(exprs(Window.partitionBy(*keys).orderBy(*by)))
    d = df if positioned else with_positions(df, keys, order, tiebreak, bucket_days, fine_seconds=fine_seconds)
    p = F.col("_pos")
    home = F.floor(p / F.lit(chunk_rows))
    first = F.floor((p - F.lit(hi)) / F.lit(chunk_rows))
    last = F.floor((p - F.lit(lo)) / F.lit(chunk_rows))
    d = (d.withColumn("_home", home)
         .withColumn("_chunk", F.explode(F.sequence(F.greatest(first, F.lit(0)), last))))
    w = Window.partitionBy(*keys, "_chunk").orderBy("_pos")
    cols = exprs(w)
    out = d.withColumns(cols).filter(F.col("_chunk") == F.col("_home"))
    drop = ["_home", "_chunk"] + ([] if positioned else ["_pos"])
    return out.drop(*drop)


# W1 ---------------------------------------------------------------------
def add_lags(df: DataFrame, keys: list[str], order: str, col: str, ns: list[int],
             prefix: str = "lag_", **kw) -> DataFrame:
    """Positional lags (row n before, within the key)."""
    return framed(df, keys, order, lambda w: {f"{prefix}{n}": F.lag(col, n).over(w) for n in ns},
                  -max(ns), 0, **kw)


# W2 ---------------------------------------------------------------------
def add_time_lags(df: DataFrame, keys: list[str], ts: str, col: str, hours: list[int],
                  prefix: str = "tlag_") -> DataFrame:
    """Time-true lags: the value exactly k hours earlier, null when absent.

    An equi-join on (key, ts - k hours): no window, so no hot-key task.  A
    (key, hour) with several rows lends the smallest of its values, so that no
    left row is multiplied.
    """
    out = df
    for h in hours:
        right = df.groupBy(*keys, (F.col(ts) + F.make_dt_interval(hours=F.lit(h))).alias(ts)).agg(
            F.min(col).alias(f"{prefix}{h}"))
        out = out.join(right, [*keys, ts], "left")
    return out


# W3 ---------------------------------------------------------------------
def lead_flag(df: DataFrame, keys: list[str], order: str, col: str, out: str, **kw) -> DataFrame:
    """True when the next row of the key has ``col > 0`` (false at the end)."""
    return framed(df, keys, order,
                  lambda w: {out: F.coalesce(F.lead(col, 1).over(w) > 0, F.lit(False))}, 0, 1, **kw)


# W4 / W5 -----------------------------------------------------------------
def rolling_stats(df: DataFrame, keys: list[str], order: str, col: str, n: int,
                  min_periods: int = 1, include_current: bool = False, stats=("mean",),
                  prefix: str = "rolling", **kw) -> DataFrame:
    """Trailing mean / sample std of the previous ``n`` rows (current row
    excluded unless ``include_current``), null below ``min_periods``."""
    lo, hi = (-(n - 1), 0) if include_current else (-n, -1)

    def exprs(w):
        fw = w.rowsBetween(lo, hi)
        ok = F.count(col).over(fw) >= min_periods
        res = {}
        if "mean" in stats:
            res[f"{prefix}_{n}_mean"] = F.when(ok, F.avg(col).over(fw))
        if "std" in stats:
            res[f"{prefix}_{n}_std"] = F.when(ok, F.stddev_samp(col).over(fw))
        return res

    return framed(df, keys, order, exprs, lo, 0, **kw)


# W6 ---------------------------------------------------------------------
def rolling_median(df: DataFrame, keys: list[str], order: str, col: str, n: int = 30,
                   min_periods: int = 7, out: str = "rolling_med", **kw) -> DataFrame:
    """Centred rolling median (pandas ``center=True``: rows i-n/2 .. i+(n-1)/2)."""
    before = n // 2
    after = n - 1 - before

    def exprs(w):
        fw = w.rowsBetween(-before, after)
        return {out: F.when(F.count(col).over(fw) >= min_periods,
                            F.percentile(F.col(col), F.lit(0.5)).over(fw))}

    return framed(df, keys, order, exprs, -before, after, **kw)


# W7 ---------------------------------------------------------------------
def group_transform(df: DataFrame, keys: list[str], col: str, how: str = "mean",
                    out: str | None = None) -> DataFrame:
    """Broadcast a group statistic back to the rows (aggregate + join, so a
    hot group is combined map-side instead of sitting in one window task)."""
    out = out or f"{col}_{how}"
    if how == "median":
        from countpanel.operators.aggs import exact_quantiles
        stats = exact_quantiles(df, col, [0.5], keys, [out])
        return join_null_safe(df, small(stats), keys, "left")
    agg = {"mean": F.avg(col), "sum": F.sum(col), "max": F.max(col), "min": F.min(col), "count": F.count(col)}[how]
    stats = df.groupBy(*keys).agg(agg.alias(out))
    return join_null_safe(df, small(stats), keys, "left")


# W8 ---------------------------------------------------------------------
def add_rank(df: DataFrame, order: list[Column], out: str = "rank",
             partition: list[str] | None = None) -> DataFrame:
    """1..n after sorting, per partition or over the whole frame (global
    ranks go through :func:`global_row_number`, never one task)."""
    if not partition:
        return global_row_number(df, order, out)
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*partition).orderBy(*order)))


# W9 / W10 ---------------------------------------------------------------
def tail_per_group(df: DataFrame, keys: list[str], order: str, n: int,
                   tiebreak: list[str] | None = None, **kw) -> DataFrame:
    """The newest ``n`` rows of each key (positions, not a whole-key sort)."""
    d = with_positions(df, keys, order, tiebreak, total="_total", **kw)
    return d.filter(F.col("_pos") >= F.col("_total") - n).drop("_pos", "_total")


def head_per_group(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """First ``n`` rows of each group after sorting (a per-group top-k).

    Spark plans ``row_number <= n`` with a group limit (WindowGroupLimit),
    so each task keeps only n rows per group before the final window.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


# W11 --------------------------------------------------------------------
def zscore_stats(df: DataFrame, cols: list[str], by: list[str] | None = None) -> DataFrame:
    """Fitted scaler: mean and population std per column (and group)."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}_mean"), F.stddev_pop(c).alias(f"{c}_std")]
    return df.groupBy(*(by or [])).agg(*aggs)


def zscore(df: DataFrame, cols: list[str], by: list[str] | None = None,
           stats: DataFrame | None = None, suffix: str = "") -> DataFrame:
    stats = stats if stats is not None else zscore_stats(df, cols, by)
    out = join_null_safe(df, small(stats), by, "left") if by else df.crossJoin(bounded(stats))
    out = out.withColumns({f"{c}{suffix}": F.try_divide(F.col(c) - F.col(f"{c}_mean"), F.col(f"{c}_std"))
                           for c in cols})
    return out.drop(*[f"{c}_{s}" for c in cols for s in ("mean", "std")])


def inverse_zscore(df: DataFrame, cols: list[str], stats: DataFrame, by: list[str] | None = None) -> DataFrame:
    out = join_null_safe(df, small(stats), by, "left") if by else df.crossJoin(bounded(stats))
    out = out.withColumns({c: F.col(c) * F.col(f"{c}_std") + F.col(f"{c}_mean") for c in cols})
    return out.drop(*[f"{c}_{s}" for c in cols for s in ("mean", "std")])


# W12 --------------------------------------------------------------------
def minmax(df: DataFrame, col: str, out: str, eps: float = 0.0, by: list[str] | None = None) -> DataFrame:
    """(x - min) / (max - min + eps); min / max from a one-row (or per
    group) aggregate joined back, never a global window."""
    st = df.groupBy(*(by or [])).agg(F.min(col).alias("_mn"), F.max(col).alias("_mx"))
    d = join_null_safe(df, small(st), by, "left") if by else df.crossJoin(bounded(st))
    den = F.col("_mx") - F.col("_mn") + F.lit(eps)
    return d.withColumn(out, F.try_divide(F.col(col) - F.col("_mn"), den)).drop("_mn", "_mx")


# W13 --------------------------------------------------------------------
def standardise_profile(df: DataFrame, key: str, col: str, out: str) -> DataFrame:
    """Row-wise standardisation of a long-form profile (population std)."""
    st = df.groupBy(key).agg(F.avg(col).alias("_m"), F.stddev_pop(col).alias("_s"))
    return (join_null_safe(df, small(st), [key], "left")
            .withColumn(out, F.try_divide(F.col(col) - F.col("_m"), F.col("_s"))).drop("_m", "_s"))


# J12 --------------------------------------------------------------------
def reindex_daily(df: DataFrame, key: str, ds: str, cols: list[str] | None = None,
                  with_pos: bool = False) -> DataFrame:
    """Complete daily calendar per key from its first to its last day,
    left-joined to the facts (missing days become null rows).

    With ``with_pos`` the row position ``_pos`` (days since the key's first
    day) is added: on a complete calendar it is exact, so later positional
    windows need no counting pass.
    """
    span = df.groupBy(key).agg(F.min(ds).alias("_lo"), F.max(ds).alias("_hi"))
    cal = span.select(key, "_lo", F.explode(F.sequence("_lo", "_hi", F.expr("INTERVAL 1 DAY"))).alias(ds))
    cal = cal.withColumn("_pos", F.datediff(F.col(ds), F.col("_lo")).cast("long")) if with_pos else cal
    facts = df.select(key, ds, *(cols or [c for c in df.columns if c not in (key, ds)]))
    return cal.drop("_lo").join(facts, [key, ds], "left")


# W14 --------------------------------------------------------------------
def interpolate(df: DataFrame, key: str, order: str, col: str, limit: int = 3, out: str | None = None,
                chunk_rows: int = DEFAULT_CHUNK_ROWS, bucket_days: int = DEFAULT_BUCKET_DAYS,
                positioned: bool = False) -> DataFrame:
    """pandas ``interpolate('linear', limit=n)`` on positions.

    A missing value at position p is filled when the previous known value
    (yp at pp) is at most ``limit`` rows back: linearly towards the next
    known value (yn at pn) when there is one, else yp.  Leading gaps stay
    null.  The previous known value is in the chunk (copied rows cover
    ``limit`` back); the next known value may be any distance ahead, so
    each chunk also learns the first known value after it from a per-chunk
    summary (one row per key and chunk).
    """
    out = out or col
    d = df if positioned else with_positions(df, [key], order, None, bucket_days)
    p = F.col("_pos")
    d = (d.withColumn("_home", F.floor(p / F.lit(chunk_rows)))
         .withColumn("_chunk", F.explode(F.sequence(F.col("_home"),
                                                    F.floor((p + F.lit(limit)) / F.lit(chunk_rows))))))
    known = F.when(F.col(col).isNotNull(), F.struct(p.alias("p"), F.col(col).alias("y")))
    # first known value per home chunk, then the first one after each chunk
    firsts = (d.filter(F.col("_chunk") == F.col("_home")).groupBy(key, "_home")
              .agg(F.min(known).alias("_fk")))
    nxt = firsts.select(key, F.col("_home").alias("_chunk"),
                        F.last("_fk", ignorenulls=True).over(
                            Window.partitionBy(key).orderBy(F.col("_home").desc())
                            .rowsBetween(Window.unboundedPreceding, -1)).alias("_after"))
    w = Window.partitionBy(key, "_chunk").orderBy("_pos")
    prev = F.last(known, ignorenulls=True).over(w.rowsBetween(-limit, 0))
    # "first known at or after this row" as a running frame over the reversed
    # order: linear, where an unbounded-following frame would be quadratic
    wr = Window.partitionBy(key, "_chunk").orderBy(F.col("_pos").desc())
    nextk = F.coalesce(F.last(known, ignorenulls=True).over(wr.rowsBetween(Window.unboundedPreceding, 0)),
                       F.col("_after"))
    d = (join_null_safe(d, small(nxt), [key, "_chunk"], "left")
         .withColumns({"_prev": prev, "_next": nextk})
         .filter(F.col("_chunk") == F.col("_home")))
    gap = p - F.col("_prev.p")
    interp = F.col("_prev.y") + (F.col("_next.y") - F.col("_prev.y")) * (p - F.col("_prev.p")) / (
        F.col("_next.p") - F.col("_prev.p"))
    filled = (F.when(F.col(col).isNotNull(), F.col(col))
              .when(F.col("_prev").isNull() | (gap > limit), F.lit(None))
              .when(F.col("_next").isNull(), F.col("_prev.y"))
              .otherwise(interp))
    d = d.withColumn(out, filled).drop("_home", "_chunk", "_prev", "_next", "_after")
    return d if positioned else d.drop("_pos")


# W15 --------------------------------------------------------------------
def seasonal_fill(df: DataFrame, key: str, order: str, col: str, k: int = 7,
                  out: str | None = None, **kw) -> DataFrame:
    """Fill a missing value from k rows before, else k rows after."""
    out = out or col
    return framed(df, [key], order, lambda w: {
        out: F.coalesce(F.col(col), F.lag(col, k).over(w), F.lead(col, k).over(w))}, -k, k, **kw)


# W16 --------------------------------------------------------------------
def iso_features(df: DataFrame, key: str, order: str, col: str = "y", **kw) -> DataFrame:
    """Deviation from the centred 30-row median, change vs 7 and 28 rows
    ago, with one (key, chunk) sort shared by all columns."""
    def exprs(w):
        fw = w.rowsBetween(-15, 14)
        med = F.when(F.count(col).over(fw) >= 7, F.percentile(F.col(col), F.lit(0.5)).over(fw))
        return {
            "rolling_med": med,
            "deviation": F.col(col) - med,
            "lag_7": F.lag(col, 7).over(w),
            "lag_28": F.lag(col, 28).over(w),
            "change_7": F.col(col) - F.lag(col, 7).over(w),
            "change_28": F.col(col) - F.lag(col, 28).over(w),
        }
    return framed(df, [key], order, exprs, -28, 14, **kw)


# Global row numbers without a one-partition window ---------------------------
def global_row_number(df: DataFrame, order: list[Column], out: str = "rank",
                      partitions: int | None = None) -> DataFrame:
    """1..n over the whole frame in ``order`` (deterministic when ``order``
    ends with a unique column).

    Rows are range-partitioned on the order, numbered inside each range
    partition, and shifted by the sizes of the preceding partitions.  The
    partitioned frame is checkpointed at once (this call runs a job), so both
    passes see the same partition boundaries.
    """
    from countpanel.session import cut_lineage

    spark = df.sparkSession
    n = partitions or max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    d = df.repartitionByRange(n, *order).withColumn("_p", F.spark_partition_id())
    d = d.withColumn("_local", F.row_number().over(Window.partitionBy("_p").orderBy(*order)))
    d = cut_lineage(d)
    sizes = d.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    off = sizes.select("_p", F.coalesce(F.sum("_n").over(
        Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    return d.join(bounded(off), "_p").withColumn(out, (F.col("_off") + F.col("_local")).cast("long")) \
        .drop("_p", "_local", "_off")
