"""Joins (J1-J17).

Dimension sides go through :func:`countpanel.session.small`, which adds a
broadcast hint only when the optimizer's size estimate is under the limit;
larger sides stay shuffle joins (AQE skew-join splits hot partitions).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countpanel.operators import near
from countpanel.operators.clean import dedupe
from countpanel.session import bounded, small


# J1 ---------------------------------------------------------------------
def join_weather(facts: DataFrame, weather: DataFrame, keys: Sequence[str] = ("site_id", "time"),
                 cols: Sequence[str] | None = None) -> DataFrame:
    """Facts left-joined to hourly weather on (site, hour).  The weather side
    is deduplicated on the key first so the fact row count cannot grow; of
    differing duplicates the smallest row (column by column) is kept."""
    keys = list(keys)
    w = weather.select(*keys, *(cols or [c for c in weather.columns if c not in keys]))
    return facts.join(join_unique_side(w, keys), keys, "left")


def join_unique_side(df: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """One row per key: the first in ``order``, then by all other columns, so
    the kept row does not depend on partitioning."""
    rest = [F.col(c) for c in df.columns if c not in keys]
    return dedupe(df, keys, [*(order or []), *rest]) if order or rest else df.distinct()


# J2 / J3 ----------------------------------------------------------------
def join_suffix(left: DataFrame, right: DataFrame, left_on: Sequence[str], right_on: Sequence[str] | None = None,
                how: str = "left", suffixes: tuple[str, str] = ("_x", "_y"), suffix_all: bool = False,
                broadcast_right: bool = True) -> DataFrame:
    """Join with different key names; clashing (or all, with ``suffix_all``)
    non-key columns get suffixes, as pandas ``merge`` does."""
    left_on = list(left_on)
    right_on = list(right_on or left_on)
    lcols = [c for c in left.columns if c not in left_on]
    rcols = [c for c in right.columns if c not in right_on]
    clash = set(lcols) & set(rcols)
    ren_l = {c: (c + suffixes[0] if (suffix_all or c in clash) else c) for c in lcols}
    ren_r = {c: (c + suffixes[1] if (suffix_all or c in clash) else c) for c in rcols}
    lk = [f"_lk{i}" for i in range(len(left_on))]
    rk = [f"_rk{i}" for i in range(len(right_on))]
    L = left.select(*[F.col(k).alias(a) for k, a in zip(left_on, lk)], *[F.col(c).alias(n) for c, n in ren_l.items()])
    R = right.select(*[F.col(k).alias(a) for k, a in zip(right_on, rk)], *[F.col(c).alias(n) for c, n in ren_r.items()])
    if broadcast_right:
        R = small(R)
    cond = reduce(lambda a, b: a & b, [F.col(a) == F.col(b) for a, b in zip(lk, rk)])
    out = L.join(R, cond, how)
    keys_out = [F.coalesce(F.col(a), F.col(b)).alias(n) if how in ("full", "outer", "right")
                else F.col(a).alias(n) for a, b, n in zip(lk, rk, left_on)]
    extra_rk = [F.col(b).alias(n) for b, n in zip(rk, right_on) if n not in left_on]
    return out.select(*keys_out, *extra_rk, *ren_l.values(), *ren_r.values())


def pair(actual: DataFrame, forecast: DataFrame, keys: Sequence[str], suffixes=("_act", "_fc")) -> DataFrame:
    """Inner join of two measurement sets, every measurement suffixed."""
    return join_suffix(actual, forecast, keys, keys, "inner", suffixes, suffix_all=True, broadcast_right=False)


# J4 / J9 ----------------------------------------------------------------
def join_unique(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left",
                order: list[Column] | None = None) -> DataFrame:
    """Deduplicate the right side on the key, then join: row-count safe.  Of
    rows that share a key the first in ``order`` counts, by default in that of
    all other columns, so the choice does not depend on partitioning."""
    order = order or [F.col(f"`{c}`") for c in right.columns if c not in keys]
    return left.join(small(dedupe(right, list(keys), order)), list(keys), how)


def attach_attr(df: DataFrame, dim: DataFrame, key: str, cols: Sequence[str], how: str = "left",
                dim_key: str | None = None) -> DataFrame:
    d = dim.select(F.col(dim_key or key).alias(key), *cols)
    return join_unique(df, d, [key], how, order=[F.col(c) for c in cols])


# J5 ---------------------------------------------------------------------
def join_global(facts: DataFrame, weather: DataFrame, ts: str, cols: Sequence[str]) -> DataFrame:
    """No site key on the right: average the right per hour, join on hour."""
    per_hour = weather.groupBy(ts).agg(*[F.avg(c).alias(c) for c in cols])
    return facts.join(small(per_hour), ts, "left")


# J6 / J7 / J8 -----------------------------------------------------------
def join_all(dfs: Sequence[DataFrame], on: Sequence[str], how: str = "inner") -> DataFrame:
    """Fold of joins on the same keys: Spark keeps the hash partitioning of
    the first join, so later joins on the same keys add no new exchange
    for the already-joined side."""
    return reduce(lambda a, b: a.join(b, list(on), how), dfs)


def align_keys(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    common = a.select(*keys).intersect(b.select(*keys))
    return a.join(common, list(keys), "left_semi"), b.join(common, list(keys), "left_semi")


def key_overlap(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Counts of keys in both, only left, only right (distinct keys)."""
    ka = a.select(F.col(key).alias("_k")).distinct().withColumn("_a", F.lit(True))
    kb = b.select(F.col(key).alias("_k")).distinct().withColumn("_b", F.lit(True))
    j = ka.join(kb, "_k", "full")
    return j.agg(F.count_if(F.col("_a") & F.col("_b")).alias("n_common"),
                 F.count_if(F.col("_a") & F.col("_b").isNull()).alias("n_only_left"),
                 F.count_if(F.col("_a").isNull() & F.col("_b")).alias("n_only_right"))


# J10 / J11 --------------------------------------------------------------
def apply_fallback(df: DataFrame, table: DataFrame, keys: Sequence[str], col: str, fallback: Column) -> DataFrame:
    """Left join a learned lookup table; misses take ``fallback``."""
    return df.join(small(table), list(keys), "left").withColumn(col, F.coalesce(F.col(col), fallback))


# J13 / J14 --------------------------------------------------------------
def join_names(left: DataFrame, right: DataFrame, lcol: str, rcol: str,
               corrections: Mapping[str, str] | None = None, how: str = "left") -> DataFrame:
    """Join on normalised names, after applying a correction map to the left."""
    from countpanel.functions.text import normalise_name

    ln = normalise_name(lcol)
    if corrections:
        m = F.create_map(*[x for k, v in corrections.items() for x in (F.lit(k), F.lit(v))])
        ln = F.coalesce(m[ln], ln)
    L = left.withColumn("name_norm", ln)
    R = right.withColumn("name_norm", normalise_name(rcol))
    return L.join(small(R), "name_norm", how)


def unmatched(left: DataFrame, right: DataFrame, lcol: str, rcol: str,
              corrections: Mapping[str, str] | None = None) -> DataFrame:
    from countpanel.functions.text import normalise_name

    ln = normalise_name(lcol)
    if corrections:
        m = F.create_map(*[x for k, v in corrections.items() for x in (F.lit(k), F.lit(v))])
        ln = F.coalesce(m[ln], ln)
    L = left.select(lcol, ln.alias("name_norm")).distinct()
    R = right.select(normalise_name(rcol).alias("name_norm")).distinct()
    return L.join(small(R), "name_norm", "left_anti").select(lcol)


# J15 / J16 --------------------------------------------------------------
def distance_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column, metric: str = "haversine") -> Column:
    if metric == "flat":
        # degrees x 111320 (no longitude shrink): parity option
        return F.sqrt((lat1 - lat2) ** 2 + (lon1 - lon2) ** 2) * F.lit(near.EARTH_M_PER_DEG)
    r = 6371008.8
    p1, p2 = F.radians(lat1), F.radians(lat2)
    dp, dl = p2 - p1, F.radians(lon2) - F.radians(lon1)
    a = F.sin(dp / 2) ** 2 + F.cos(p1) * F.cos(p2) * F.sin(dl / 2) ** 2
    return F.lit(2 * r) * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def _of_sites(sites: DataFrame, found: DataFrame) -> DataFrame:
    """(site_id, columns of ``found``) of the sites at its positions (lat, lon)."""
    at = sites.select("site_id", *[F.col(c).cast("double").alias(c) for c in ("lat", "lon")])
    return at.join(found, ["lat", "lon"])


def count_within(sites: DataFrame, poi: DataFrame, metres: float, kinds: Sequence[str],
                 metric: str = "haversine") -> DataFrame:
    """Per site, the number of POIs of each kind within ``metres``: counted per
    position (:mod:`countpanel.operators.near`), then brought to the sites."""
    found = _of_sites(sites, near.counts_at(sites, poi, metres, kinds, metric))
    cnt = found.groupBy("site_id").agg(*[F.sum(k).alias(k) for k in kinds])
    out = sites.select("site_id").join(cnt, "site_id", "left")
    return out.fillna(0, subset=list(kinds)).select(
        "site_id", *[F.col(k).cast("long").alias(f"{k}_count") for k in kinds])


def nearest(sites: DataFrame, poi: DataFrame, kind: str, max_m: float, metric: str = "haversine") -> DataFrame:
    """Distance to the nearest POI of ``kind``; null when none within max_m."""
    found = near.nearest_at(sites, poi.filter(F.col("kind") == kind), max_m, metric)
    found = found.withColumn("dist_m", distance_m(F.col("lat"), F.col("lon"), F.col("p_lat"), F.col("p_lon"), metric))
    found = found.filter(F.col("dist_m") <= F.lit(max_m)).groupBy("lat", "lon").agg(F.min("dist_m").alias("dist_m"))
    best = _of_sites(sites, found).groupBy("site_id").agg(F.min("dist_m").alias(f"dist_nearest_{kind}"))
    return sites.select("site_id").join(best, "site_id", "left")


# J17 --------------------------------------------------------------------
def cross_scenarios(df: DataFrame, values: Sequence, name: str) -> DataFrame:
    """Every row of ``df`` (a small table of totals) under every scenario
    value; the scenario list is a literal of fixed length."""
    spark = df.sparkSession
    sc = spark.createDataFrame([(float(v),) for v in values], f"{name} double")
    return df.crossJoin(bounded(sc))
