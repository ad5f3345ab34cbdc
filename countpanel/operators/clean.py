"""Projections, filters and cleaning.

All functions are lazy ``DataFrame -> DataFrame`` transforms built from
built-in expressions, so Catalyst can push filters and prune columns.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from countpanel.session import bounded, small


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# P1 -----------------------------------------------------------------------
def select_existing(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    have = set(df.columns)
    return df.select(*[c for c in cols if c in have])


def drop_existing(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    have = set(df.columns)
    return df.drop(*[c for c in cols if c in have])


# P2 -----------------------------------------------------------------------
def rename_aliases(df: DataFrame, aliases: Mapping[str, str]) -> DataFrame:
    """Rename the alias columns that exist; an alias whose target already
    exists is dropped (first one kept), like a rename followed by P3."""
    have = list(df.columns)
    out = []
    seen = set()
    for c in have:
        name = aliases.get(c, c)
        if name in seen:
            continue
        seen.add(name)
        out.append(F.col(f"`{c}`").alias(name))
    return df.select(*out)


# P3 -----------------------------------------------------------------------
def dedupe_columns(df: DataFrame) -> DataFrame:
    """Keep the first of several columns sharing a name."""
    names = df.columns
    if len(set(names)) == len(names):
        return df
    tmp = [f"_c{i}" for i in range(len(names))]
    keep, seen = [], set()
    for i, n in enumerate(names):
        if n not in seen:
            seen.add(n)
            keep.append(F.col(tmp[i]).alias(n))
    return df.toDF(*tmp).select(*keep)


# P4 -----------------------------------------------------------------------
def coerce(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Casts where a bad value becomes null instead of failing the job."""
    exprs = {}
    for c, t in types.items():
        if t in ("timestamp", "timestamp_ntz"):
            exprs[c] = F.try_to_timestamp(F.col(c).cast("string")).cast(t)
        else:
            exprs[c] = F.col(c).try_cast(t)
    return df.withColumns(exprs)


# P5 / P6 / P7 -------------------------------------------------------------
def filter_type(df: DataFrame, col: str, value) -> DataFrame:
    return df.filter(F.col(col) == F.lit(value))


def between_dates(df: DataFrame, ts: str, lo: str, hi: str) -> DataFrame:
    """Half-open day range [lo, hi + 1 day) on the raw column (pushdown-able)."""
    t = F.col(ts)
    return df.filter((t >= F.to_timestamp_ntz(F.lit(lo))) &
                     (t < F.to_timestamp_ntz(F.date_add(F.lit(hi).cast("date"), 1).cast("string"))))


def in_hourly_range(df: DataFrame, ts: str, lo: str, hi: str) -> DataFrame:
    t = F.col(ts)
    return df.filter((t >= F.to_timestamp_ntz(F.lit(lo))) & (t <= F.to_timestamp_ntz(F.lit(hi)))
                     & (t == F.date_trunc("hour", t).cast("timestamp_ntz")))


# P8 / P9 ------------------------------------------------------------------
def semi_filter(df: DataFrame, ids, key: str, ids_key: str | None = None) -> DataFrame:
    """Keep rows whose key is in a literal list or in another table's keys."""
    if isinstance(ids, DataFrame):
        k = ids.select(F.col(ids_key or key).alias(key)).distinct()
        return df.join(small(k), key, "left_semi")
    return df.filter(F.col(key).isin(list(ids)))


def anti_filter(df: DataFrame, ids, key: str, ids_key: str | None = None) -> DataFrame:
    if isinstance(ids, DataFrame):
        k = ids.select(F.col(ids_key or key).alias(key)).distinct()
        return df.join(small(k), key, "left_anti")
    return df.filter(~F.col(key).isin(list(ids)) | F.col(key).isNull())


# P10 ----------------------------------------------------------------------
def alerts(df: DataFrame, err: str, hi: float, lo: float) -> DataFrame:
    """Surge (error above ``hi``) or blockage (error below ``lo``)."""
    e = F.col(err)
    return df.filter((e > F.lit(hi)) | (e < F.lit(lo)))


# P11 / P12 / P13 ------------------------------------------------------------
def require(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.dropna(subset=cols)


def fill_const(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.fillna(dict(values))


def coalesce_cols(df: DataFrame, out: str, *cols: str) -> DataFrame:
    return df.withColumn(out, F.coalesce(*[F.col(c) for c in cols]))


# P14 / P15 / P16 ------------------------------------------------------------
def fill_group_median(df: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Fill nulls with the group's exact median, then the global median.

    Medians come from the distributed exact quantile (no group's values are
    gathered in one task); both stats tables are one row per group.
    """
    from countpanel.operators.aggs import quantiles_wide
    from countpanel.operators.windows import join_null_safe

    grp = quantiles_wide(df, {c: f"_gm_{c}" for c in cols}, 0.5, [key])
    glob = median_stats(df, cols).select(*[F.col(c).alias(f"_all_{c}") for c in cols])
    out = join_null_safe(df, small(grp), [key], "left").crossJoin(bounded(glob))
    out = out.withColumns({c: F.coalesce(F.col(c), F.col(f"_gm_{c}"), F.col(f"_all_{c}")) for c in cols})
    return out.drop(*[f"_gm_{c}" for c in cols], *[f"_all_{c}" for c in cols])


def median_stats(df: DataFrame, cols: list[str], distributed: bool | None = None) -> DataFrame:
    """One-row table of exact column medians (the fitted imputer).

    ``distributed=False`` states that the input is entity-sized (one row per
    site): all medians are then taken in one aggregate pass."""
    from countpanel.operators.aggs import quantiles_wide

    return quantiles_wide(df, {c: c for c in cols}, 0.5, distributed=distributed)


def fill_median(df: DataFrame, cols: list[str], stats: DataFrame | None = None) -> DataFrame:
    stats = stats if stats is not None else median_stats(df, cols)
    st = stats.select(*[F.col(c).alias(f"_med_{c}") for c in cols])
    out = df.crossJoin(bounded(st))
    return out.withColumns({c: F.coalesce(F.col(c), F.col(f"_med_{c}")) for c in cols}) \
              .drop(*[f"_med_{c}" for c in cols])


def mode_stats(df: DataFrame, cols: list[str]) -> DataFrame:
    """Most frequent value per column; ties go to the smallest value."""
    parts = []
    for c in cols:
        cnt = df.where(F.col(c).isNotNull()).groupBy(c).count()
        parts.append(cnt.agg(F.min_by(F.col(c), F.struct(-F.col("count"), F.col(c))).alias(c)))
    out = parts[0]
    for p in parts[1:]:
        out = out.crossJoin(bounded(p))
    return out


def fill_mode(df: DataFrame, cols: list[str]) -> DataFrame:
    st = mode_stats(df, cols).select(*[F.col(c).alias(f"_mode_{c}") for c in cols])
    out = df.crossJoin(bounded(st))
    return out.withColumns({c: F.coalesce(F.col(c), F.col(f"_mode_{c}")) for c in cols}) \
              .drop(*[f"_mode_{c}" for c in cols])


# P17 / P18 ----------------------------------------------------------------
def clean_infinite(df: DataFrame, cols: list[str]) -> DataFrame:
    from countpanel.functions.numeric import finite
    return df.withColumns({c: finite(c) for c in cols})


def clip(df: DataFrame, col: str, lo=None, hi=None, out: str | None = None) -> DataFrame:
    from countpanel.functions.numeric import clip as clip_expr
    return df.withColumn(out or col, clip_expr(col, lo, hi))


# P19 / P20 ----------------------------------------------------------------
def dedupe(df: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """One row per key.  With ``order`` the first row in that order is kept
    (deterministic); without it any row is kept (``dropDuplicates``)."""
    if not order:
        return df.dropDuplicates(keys)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def keep_extreme(df: DataFrame, key: str, col: str, tiebreak: list[str]) -> DataFrame:
    """Per key, the row with the largest absolute value of ``col``."""
    return dedupe(df, [key], [F.abs(F.col(col)).desc(), *[F.col(t) for t in tiebreak]])


# P21 ----------------------------------------------------------------------
def sample_n(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Seeded sample of exactly ``n`` rows (a sampling operator: the limit is
    the feature).  Rows are ranked by a hash of key and seed, so the result
    does not depend on partitioning; Spark plans it as a top-k."""
    return (df.withColumn("_h", F.xxhash64(F.col(key), F.lit(seed)))
            .orderBy("_h", key).limit(n).drop("_h"))


# P22 / P23 / P24 ------------------------------------------------------------
def map_values(df: DataFrame, col: str, mapping: Mapping, out: str | None = None, default=None) -> DataFrame:
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    val = m[F.col(col)]
    if default is not None:
        val = F.coalesce(val, F.lit(default))
    return df.withColumn(out or col, val)


def first_match_label(df: DataFrame, rules: list[tuple[Column, str]], out: str, default: str) -> DataFrame:
    """First rule that holds gives the label (``when`` chain, no UDF)."""
    expr = None
    for cond, label in rules:
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return df.withColumn(out, expr.otherwise(F.lit(default)))


def poi_group(df: DataFrame, out: str = "poi_group") -> DataFrame:
    """Station > school > park > other, from the POI count columns."""
    return first_match_label(df, [
        (F.col("station_count") > 0, "station"),
        (F.col("school_count") > 0, "school"),
        (F.col("park_count") > 0, "park"),
    ], out, "other")


def mask(df: DataFrame, cond: Column, col: str, out: str) -> DataFrame:
    return df.withColumn(out, F.when(cond, F.col(col)))


# P25 / P26 / P27 / P28 ------------------------------------------------------
def ratio(df: DataFrame, a: str, b: str, out: str, eps: float | None = 1e-6) -> DataFrame:
    from countpanel.functions.numeric import ratio as ratio_expr
    return df.withColumn(out, ratio_expr(a, b, eps))


def interaction(df: DataFrame, flag: str, x: str, out: str) -> DataFrame:
    return df.withColumn(out, F.col(x) * F.col(flag).cast("int"))


def extract_pair(df: DataFrame, col: str, pattern: str, outs: tuple[str, str]) -> DataFrame:
    return df.withColumns({outs[0]: F.regexp_extract(F.col(col), pattern, 1),
                           outs[1]: F.regexp_extract(F.col(col), pattern, 2)})


def concat_key(df: DataFrame, cols: list[str], out: str, sep: str = "_") -> DataFrame:
    from countpanel.functions.text import concat_key as ck
    return df.withColumn(out, ck(*cols, sep=sep))
