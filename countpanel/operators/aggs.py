"""Aggregations.

Every grouping is one ``groupBy().agg()`` so Spark does a partial
(map-side) aggregate before the shuffle: a hot key is pre-combined in every
task and only one row per key and task crosses the network.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from countpanel.functions.dates import floor_to, is_rush_hour, weekday0
from countpanel.operators.windows import join_null_safe
from countpanel.session import ONE_TASK_BYTES, bounded, estimated_size, small


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# A1 / A2 ----------------------------------------------------------------
def rollup_counts(df: DataFrame, keys: list[str], ts: str, value: str, every: str = "hour",
                  bucket: str = "bucket", total: str = "total_count", n: str = "n_obs") -> DataFrame:
    """Sum and non-null count of readings per key and time bucket."""
    return df.groupBy(*keys, floor_to(ts, every).alias(bucket)).agg(
        F.sum(value).alias(total), F.count(value).alias(n))


def complete_only(df: DataFrame, n: int, col: str = "n_obs") -> DataFrame:
    """Keep buckets with exactly the expected number of readings."""
    return df.filter(F.col(col) == n)


# A3 / A4 / A5 -------------------------------------------------------------
def daily_totals(df: DataFrame, key: str, ts: str, value: str, out: str = "y") -> DataFrame:
    """Daily sum per key; a day whose readings are all missing sums to 0."""
    return df.groupBy(key, F.to_date(F.col(ts)).alias("ds")).agg(
        F.coalesce(F.sum(value), F.lit(0.0)).alias(out))


def hourly_panel(df: DataFrame, key: str, ts: str, value: str, carry: Sequence[str] = (),
                 out: str = "count") -> DataFrame:
    """Hourly sum per key; descriptive columns carried from the earliest row
    of the hour (deterministic, unlike ``first``)."""
    return df.groupBy(key, floor_to(ts, "hour").alias("datetime_hour")).agg(
        F.sum(value).alias(out), *[F.min_by(c, F.col(ts)).alias(c) for c in carry])


def weather_daily(df: DataFrame, key: str, ts: str, spec: Mapping[str, str]) -> DataFrame:
    """Hourly weather to daily values; ``spec`` maps column -> max / sum / avg / min."""
    fns = {"max": F.max, "sum": F.sum, "avg": F.avg, "mean": F.avg, "min": F.min}
    return df.groupBy(key, F.to_date(F.col(ts)).alias("ds")).agg(
        *[fns[how](c).alias(f"{c}_{how}") for c, how in spec.items()])


# A6 / A7 / A8 / A9 --------------------------------------------------------
def profile_by(df: DataFrame, value: str, parts: Mapping[str, Column], out: str = "mean_value",
               extra: Mapping[str, Column] | None = None) -> DataFrame:
    """Mean of ``value`` by one or more derived parts (hour, weekday, ...)."""
    aggs = [F.avg(value).alias(out)] + [e.alias(n) for n, e in (extra or {}).items()]
    return df.groupBy(*[e.alias(n) for n, e in parts.items()]).agg(*aggs)


def pick_one_per_group(df: DataFrame, group: str, entity: str) -> DataFrame:
    """One entity per group: the one with most rows (ties: smallest id)."""
    n = df.groupBy(group, entity).agg(F.count(F.lit(1)).alias("_n"))
    return n.groupBy(group).agg(F.min_by(F.col(entity), F.struct(-F.col("_n"), F.col(entity))).alias(entity))


def category_means(df: DataFrame, cat: str, value: str, attrs: Sequence[str] = (),
                   out: str = "mean_value") -> DataFrame:
    return df.groupBy(cat).agg(F.avg(value).alias(out), F.count(F.lit(1)).alias("n_rows"),
                               *[F.avg(a).alias(f"mean_{a}") for a in attrs])


# A10 / A11 / A12 / A13 ----------------------------------------------------
def site_profile(df: DataFrame, key: str, value: str, ts: str, hour: str | None = None) -> DataFrame:
    """Per-entity profile: mean, exact median, max, sample std, and the
    weekday / weekend / rush-hour conditional means."""
    v = F.col(value)
    wk = weekday0(ts) >= 5
    h = F.col(hour) if hour else F.hour(F.col(ts))
    med = exact_quantiles(df, value, [0.5], [key], ["median_count"])
    found = df.groupBy(key).agg(
        F.avg(v).alias("mean_count"),
        F.max(v).alias("max_count"),
        F.stddev_samp(v).alias("std_count"),
        F.avg(F.when(~wk, v)).alias("weekday_mean"),
        F.avg(F.when(wk, v)).alias("weekend_mean"),
        F.avg(F.when(is_rush_hour(h), v)).alias("rush_mean"),
        F.count(v).alias("n_obs"),
    )
    return join_null_safe(found, med, [key], "left")


def profile_ratios(df: DataFrame, eps: float = 1e-6) -> DataFrame:
    return df.withColumns({
        "weekend_weekday_ratio": F.col("weekend_mean") / (F.col("weekday_mean") + F.lit(eps)),
        "rush_ratio": F.col("rush_mean") / (F.col("mean_count") + F.lit(eps)),
        "cv": F.col("std_count") / (F.col("mean_count") + F.lit(eps)),
    })


def active_only(df: DataFrame, mean: str = "mean_count", mx: str = "max_count") -> DataFrame:
    return df.filter((F.col(mean) > 0) & (F.col(mx) > 0))


# A14 / A15 ----------------------------------------------------------------
def bin_expr(x, edges: Sequence[float], include_lowest: bool = True) -> Column:
    """Index of the right-closed bin (e_i, e_i+1] holding x; null outside.
    ``include_lowest`` also puts x == e_0 into bin 0 (pandas ``cut``)."""
    c = _c(x)
    e = None
    for i in range(len(edges) - 1):
        lo, hi = float(edges[i]), float(edges[i + 1])
        cond = (c > lo) & (c <= hi)
        if i == 0 and include_lowest:
            cond = (c >= lo) & (c <= hi)
        e = F.when(cond, F.lit(i)) if e is None else e.when(cond, F.lit(i))
    return e


def bin_labels(edges: Sequence[float], labels: Sequence[str] | None = None) -> list[str]:
    if labels:
        return list(labels)
    return [f"({edges[i]:g}, {edges[i + 1]:g}]" for i in range(len(edges) - 1)]


def binned_mean(df: DataFrame, x: str, value: str, edges: Sequence[float], by: Sequence[str] = (),
                keep_empty: bool = True, labels: Sequence[str] | None = None,
                include_lowest: bool = True) -> DataFrame:
    """Mean of ``value`` per right-closed bin of ``x`` (and optional groups).

    With ``keep_empty`` every bin appears, empty ones with a null mean and
    0 rows: the aggregate is right-joined to the literal bin list.
    """
    labs = bin_labels(edges, labels)
    spark = df.sparkSession
    agg = (df.withColumn("bin", bin_expr(x, edges, include_lowest)).where(F.col("bin").isNotNull())
           .groupBy(*by, "bin").agg(F.avg(value).alias("mean_value"), F.count(F.lit(1)).alias("n_rows")))
    bins = spark.createDataFrame([(i, lab) for i, lab in enumerate(labs)], "bin int, bin_label string")
    if not keep_empty:
        return agg.join(bounded(bins), "bin")
    if by:
        groups = agg.select(*by).distinct()
        grid = groups.crossJoin(bounded(bins))
        return grid.join(agg, [*by, "bin"], "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))
    return bounded(bins).join(agg, "bin", "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))


# A16 / A17 / A18 / A19 / A20 ------------------------------------------------
def mean_by_flag(df: DataFrame, flag: Column, value: str, name: str = "flag") -> DataFrame:
    return df.groupBy(F.coalesce(flag, F.lit(False)).alias(name)).agg(
        F.avg(value).alias("mean_value"), F.count(F.lit(1)).alias("n_rows"))


def cardinality(df: DataFrame, cols: Sequence[str], approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """Distinct counts of several columns in one pass; ``approx`` uses the
    mergeable HyperLogLog++ sketch (relative error ``rsd``), whose state per
    task is fixed-size however many distinct values there are."""
    if approx:
        return df.agg(*[F.approx_count_distinct(c, rsd).alias(f"n_{c}") for c in cols])
    return df.agg(*[F.count_distinct(c).alias(f"n_{c}") for c in cols])


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def describe_exact(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, mean, sample std, min, exact quartiles, max per column, long
    form.  One aggregate pass for the moments plus the exact quantiles of all
    columns together."""
    mom = df.agg(*[e for c in cols for e in (
        F.count(c).alias(f"{c}__count"), F.avg(c).alias(f"{c}__mean"), F.stddev_samp(c).alias(f"{c}__std"),
        F.min(F.col(c).cast("double")).alias(f"{c}__min"), F.max(F.col(c).cast("double")).alias(f"{c}__max"))])
    stats = [F.struct(F.lit(c).alias("column"), *[F.col(f"{c}__{k}").alias(k) for k in ("count", "mean", "std", "min", "max")])
             for c in cols]
    quartiles = quantiles_of_columns(df, cols, [0.25, 0.5, 0.75], [], ["q25", "q50", "q75"])
    return mom.select(F.inline(F.array(*stats))).join(bounded(quartiles), "column", "left").select(
        "column", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def kpis(df: DataFrame, value: str, site: str, city: str | None, ts: str) -> DataFrame:
    aggs = [F.sum(value).alias("total"), F.count_distinct(site).alias("n_sites"),
            F.to_date(F.min(ts)).alias("first_day"), F.to_date(F.max(ts)).alias("last_day"),
            (F.datediff(F.max(ts), F.min(ts)) + 1).alias("n_days"),
            (F.lit(100.0) * F.avg(F.col(value).isNull().cast("double"))).alias("pct_missing"),
            F.count(F.lit(1)).alias("n_rows")]
    if city:
        aggs.append(F.count_distinct(city).alias("n_cities"))
    return df.agg(*aggs)


# A21 / A22 / A23 ----------------------------------------------------------
def pivot_mean(df: DataFrame, row: str, col: str, values: Sequence, value: str,
               fill: float | None = None, agg: str = "avg") -> DataFrame:
    """Wide matrix; the value list is explicit so no extra job runs."""
    fn = {"avg": F.avg, "sum": F.sum, "count": F.count}[agg]
    out = df.groupBy(row).pivot(col, list(values)).agg(fn(value))
    return out.fillna(fill) if fill is not None else out


def crosstab(df: DataFrame, a: str, b: str, values: Sequence) -> DataFrame:
    return df.groupBy(a).pivot(b, list(values)).agg(F.count(F.lit(1))).fillna(0)


def crosstab_margins(df: DataFrame, a: str, b: str, total: str = "All") -> DataFrame:
    """Contingency counts with row, column and grand totals (CUBE)."""
    return (df.cube(a, b).agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("_g"))
            .select(F.when(F.col("_g").bitwiseAND(2) > 0, F.lit(total))
                    .otherwise(F.col(a).cast("string")).alias(a),
                    F.when(F.col("_g").bitwiseAND(1) > 0, F.lit(total))
                    .otherwise(F.col(b).cast("string")).alias(b), "n"))


# A24 / A25 / A26 ----------------------------------------------------------
def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlations of all pairs in one aggregate, long form."""
    pairs = [(x, y) for x in cols for y in cols]
    return df.agg(F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"),
                                     F.corr(x, y).alias("r")) for x, y in pairs]).alias("_s")) \
             .select(F.inline("_s"))


def corr_by(df: DataFrame, key: str, x: str, y: str, split: Column | None = None,
            split_name: str = "split") -> DataFrame:
    keys = [key] + ([split.alias(split_name)] if split is not None else [])
    return df.groupBy(*keys).agg(F.corr(x, y).alias("r"), F.count(F.lit(1)).alias("n"))


def pearsonr(df: DataFrame, x: str, y: str) -> DataFrame:
    """r and its two-sided p-value (t-test with n-2 degrees of freedom), from
    one aggregate; rows with a missing value take no part, the p-value is null
    for fewer than three rows."""
    from countpanel.functions.stats import betainc

    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    r = df.agg(F.corr(x, y).alias("r"), F.count_if(both).alias("n"))
    # df / (df + t^2) = 1 - r^2
    p = betainc((F.col("n") - 2).cast("double") / 2, F.lit(0.5), 1.0 - F.col("r") * F.col("r"))
    return r.withColumn("p_value", p)


# A27 / A28 / A29 / A30 / A31 / A32 / A33 -----------------------------------
def quantiles(df: DataFrame, col: str, qs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    return exact_quantiles(df, col, qs, by)


def argmax(df: DataFrame, by: Sequence[str], label: str, value: str, out: str = "argmax") -> DataFrame:
    """Label of the largest value per group; ties go to the smallest label."""
    return df.groupBy(*by).agg(F.min_by(label, F.struct(-F.col(value), F.col(label))).alias(out))


def histogram(df: DataFrame, col: str, n: int) -> DataFrame:
    """Equal-width bins between min and max, last bin closed; every bin
    listed.  Min / max come from a one-row aggregate."""
    st = df.agg(F.min(col).alias("_mn"), F.max(col).alias("_mx"))
    w = (F.col("_mx") - F.col("_mn")) / F.lit(float(n))
    b = F.least(F.floor((F.col(col) - F.col("_mn")) / w), F.lit(n - 1))
    b = F.when(w == 0, F.lit(0)).otherwise(b).cast("int")
    cnt = (df.where(F.col(col).isNotNull()).crossJoin(bounded(st)).groupBy(b.alias("bin"))
           .agg(F.count(F.lit(1)).alias("n")))
    bins = df.sparkSession.range(n).select(F.col("id").cast("int").alias("bin"))
    edges = bins.crossJoin(bounded(st)).select(
        "bin", (F.col("_mn") + F.col("bin") * (F.col("_mx") - F.col("_mn")) / F.lit(float(n))).alias("lo"),
        (F.col("_mn") + (F.col("bin") + 1) * (F.col("_mx") - F.col("_mn")) / F.lit(float(n))).alias("hi"))
    return edges.join(cnt, "bin", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def box_stats(df: DataFrame, by: Sequence[str], col: str) -> DataFrame:
    """Quartiles, 1.5-IQR whiskers (most extreme value inside the fence)
    and outlier count per group: one aggregate for the quartiles, one for
    the fenced extremes."""
    q = exact_quantiles(df, col, [0.25, 0.5, 0.75], by, ["q1", "median", "q3"])
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    x = F.col(col)
    lo_f = F.col("q1") - 1.5 * F.col("iqr")
    hi_f = F.col("q3") + 1.5 * F.col("iqr")
    j = join_null_safe(df, small(q), list(by))
    f = j.groupBy(*by).agg(F.min(F.when(x >= lo_f, x)).alias("whisker_lo"),
                           F.max(F.when(x <= hi_f, x)).alias("whisker_hi"),
                           F.count_if((x < lo_f) | (x > hi_f)).alias("n_outliers"))
    return join_null_safe(q, f, list(by))


def daily_average(df: DataFrame, key: str, value: str, ts: str, k: int = 15) -> DataFrame:
    """Total per key divided by the number of distinct days in the data; top k."""
    days = df.agg(F.count_distinct(F.to_date(F.col(ts))).alias("_days"))
    tot = df.groupBy(key).agg(F.sum(value).alias("total"))
    return (tot.crossJoin(bounded(days)).select(key, (F.col("total") / F.col("_days")).alias("daily_avg"))
            .orderBy(F.col("daily_avg").desc(), F.col(key)).limit(k))


def row_mean(cols: Sequence[str]) -> Column:
    """Mean across columns, nulls skipped (null when all are null)."""
    arr = F.filter(F.array(*[F.col(c).cast("double") for c in cols]), lambda v: v.isNotNull())
    return F.try_divide(F.aggregate(arr, F.lit(0.0), lambda a, v: a + v), F.size(arr))


def group_means(df: DataFrame, by: Sequence[str], cols: Sequence[str], d: int = 2) -> DataFrame:
    return df.groupBy(*by).agg(*[F.round(F.avg(c), d).alias(c) for c in cols])


# Exact quantiles without a whole group in one task --------------------------
def exact_quantiles(df: DataFrame, col: str, qs: Sequence[float], by: Sequence[str] = (),
                    names: Sequence[str] | None = None, accuracy: int = 100_000,
                    distributed: bool | None = None) -> DataFrame:
    """Exact linearly interpolated quantiles (the definition of Spark's
    ``percentile`` / DuckDB's ``quantile_cont``) for groups of any size.

    ``percentile`` merges every distinct value of a group in one task, which
    fails for a group holding a large share of the data.  Here a mergeable
    sketch (``percentile_approx``, rank error <= n / accuracy) brackets the
    wanted ranks; rows below the bracket are only counted, and rows inside
    it are aggregated by distinct value - at most ~6 n / accuracy values per
    group and quantile - before the exact rank is located with a running sum.
    Groups smaller than ``accuracy`` rows skip the bracket (their whole band
    is at most ``accuracy`` values).

    ``distributed=None`` decides by the optimizer's size estimate: an input
    small enough to sit in one task uses the single-pass ``percentile``.  Both
    ways return the same rows: a null key is a group, and a group without
    values has null quantiles.
    """
    by = list(by)
    names = list(names or [f"q{int(round(q * 100))}" for q in qs])
    if distributed is None:
        size = estimated_size(df)
        distributed = size is None or size > ONE_TASK_BYTES
    if not distributed:
        all_q = F.percentile(F.col(col).cast("double"), F.array(*[F.lit(float(q)) for q in qs])).alias("_q")
        return df.groupBy(*by).agg(all_q).select(*by, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])
    eps = 3.0 / accuracy
    d = df.select(*by, F.col(col).cast("double").alias("_x"))
    bounds = []
    for q in qs:
        bounds += [max(0.0, q - eps), min(1.0, q + eps)]
    st = d.groupBy(*by).agg(F.count("_x").alias("_n"),
                            F.percentile_approx("_x", F.array(*[F.lit(b) for b in bounds]), accuracy).alias("_b"))
    big = F.col("_n") >= accuracy
    qa = F.array(*[F.struct(F.lit(i).alias("_qi"), F.lit(float(q)).alias("_q"),
                            F.when(big, F.col("_b")[2 * i]).alias("_lo"),
                            F.when(big, F.col("_b")[2 * i + 1]).alias("_hi")) for i, q in enumerate(qs)])
    per = (st.select(*by, "_n", F.explode(qa).alias("_s")).select(*by, "_n", "_s.*")
           .withColumn("_pos", F.col("_q") * (F.col("_n") - 1))
           .withColumn("_f", F.floor("_pos")).withColumn("_c", F.ceil("_pos")))
    j = join_null_safe(d, small(per), by) if by else d.crossJoin(bounded(per))
    # all rows below the bracket share one null value, which comes first in the running sum;
    # rows without a value join them uncounted, so a group of such rows stays
    value = F.when(F.coalesce(F.col("_x") >= F.col("_lo"), F.lit(True)), F.col("_x")).alias("_v")
    keys = [*by, "_qi"]
    band = (j.filter(F.coalesce(F.col("_x") <= F.col("_hi"), F.lit(True)))
            .groupBy(*keys, value).agg(F.count("_x").alias("_k"), *[F.max(c).alias(c) for c in ("_pos", "_f", "_c")]))
    w = Window.partitionBy(*keys).orderBy(F.col("_v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    band = band.withColumn("_end", F.sum("_k").over(w)).withColumn("_start", F.col("_end") - F.col("_k"))
    hit = lambda r: (F.col("_start") <= F.col(r)) & (F.col(r) < F.col("_end"))
    v = band.groupBy(*keys).agg(F.min(F.when(hit("_f"), F.col("_v"))).alias("_vf"), F.min(F.when(hit("_c"), F.col("_v"))).alias("_vc"),
                                *[F.max(c).alias(c) for c in ("_pos", "_f", "_c")])
    val = F.when(F.col("_f") == F.col("_c"), F.col("_vf")).otherwise(
        (F.col("_c") - F.col("_pos")) * F.col("_vf") + (F.col("_pos") - F.col("_f")) * F.col("_vc"))
    v = v.withColumn("_v", val)
    return v.groupBy(*by).agg(*[F.max(F.when(F.col("_qi") == i, F.col("_v"))).alias(n) for i, n in enumerate(names)])


def quantiles_of_columns(df: DataFrame, cols: Sequence[str], qs: Sequence[float], by: Sequence[str] = (),
                         names: Sequence[str] | None = None, accuracy: int = 100_000, distributed: bool | None = None) -> DataFrame:
    """Exact quantiles of many columns: one row per (group, column), ``by`` +
    ``column`` + one column per quantile.

    The columns are unpivoted into (group, column, value), so one scan feeds
    the sketches of all columns and a second one their bands, however many
    columns there are.  Inputs that fit in a task take one aggregate."""
    by, names = list(by), list(names or [f"q{int(round(q * 100))}" for q in qs])
    if distributed is None:
        size = estimated_size(df)
        distributed = size is None or size > ONE_TASK_BYTES
    wanted = F.array(*[F.lit(float(q)) for q in qs])
    if not distributed:
        each = [F.struct(F.lit(c).alias("column"), F.percentile(F.col(c).cast("double"), wanted).alias("_q")) for c in cols]
        long = df.groupBy(*by).agg(F.array(*each).alias("_a")).select(*by, F.inline("_a"))
        return long.select(*by, "column", *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])
    each = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("_value")) for c in cols]
    return exact_quantiles(df.select(*by, F.inline(F.array(*each))), "_value", qs, [*by, "column"], names, accuracy, True)


def quantiles_wide(df: DataFrame, cols: Mapping[str, str], q: float, by: Sequence[str] = (), distributed: bool | None = None) -> DataFrame:
    """One row per group with the same quantile of many columns, named by
    ``cols`` (column -> name).  Without groups there is always one row."""
    long = quantiles_of_columns(df, list(cols), [q], by, ["_q"], distributed=distributed)
    return long.groupBy(*by).agg(*[F.max(F.when(F.col("column") == c, F.col("_q"))).alias(n) for c, n in cols.items()])
