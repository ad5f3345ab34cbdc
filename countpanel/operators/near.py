"""Counts and nearest neighbours of positions within a radius.

Both sides come as distinct positions.  A grid brings together what may be in
reach, and a crowded cell is dealt into pairs of groups of at most about
``GROUP`` positions, so no task holds a whole cell and no pair of positions is
ever a row.  Within a group pair, positions are packed into blocks of
neighbours: a block has a centre and a radius, and by the triangle inequality
two blocks are wholly in reach, wholly out of it, or at the edge.  Only blocks
at the edge are compared position by position.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countpanel.session import bounded, cut_lineage

# task functions travel by value: executors need not have the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

EARTH_M_PER_DEG = 111320.0
RADIUS_M = 6371008.8
GROUP = 32768  # positions of one side that a task holds at a time
BLOCK = 64
CELLS = 128  # cells are widened while more than these are in use, so that groups are worth a call
MARGIN_M = 1.0  # blocks this close to the radius count as at the edge: far above rounding


def far(lat1: np.ndarray, lon1: np.ndarray, lat2: np.ndarray, lon2: np.ndarray, metric: str) -> np.ndarray:
    """Metres between positions, as :func:`joins.distance_m` has it."""
    if metric == "flat":
        return np.sqrt((lat1 - lat2) ** 2 + (lon1 - lon2) ** 2) * EARTH_M_PER_DEG
    p1, p2 = np.radians(lat1), np.radians(lat2)
    a = np.sin((p2 - p1) / 2) ** 2 + np.cos(p1) * np.cos(p2) * np.sin((np.radians(lon2) - np.radians(lon1)) / 2) ** 2
    return 2 * RADIUS_M * np.arcsin(np.minimum(1.0, np.sqrt(a)))


def columns_of_band(band: Column, deg: float, metres: float, metric: str) -> Column:
    """Number of longitude columns in a latitude band: each at least as wide
    as ``metres`` reach anywhere in the band or its neighbours."""
    if metric == "flat":
        return F.floor(F.lit(360.0 / deg)).cast("long")
    reach = F.least(F.lit(90.0), F.greatest(F.abs(band * deg), F.abs((band + 1) * deg)) + F.lit(deg))
    shrink = F.greatest(F.cos(F.radians(reach)), F.lit(1e-9))
    half = F.asin(F.least(F.lit(1.0), F.lit(math.sin(min(metres / (2 * RADIUS_M), math.pi / 2))) / shrink))
    return F.greatest(F.lit(1), F.floor(F.lit(2 * math.pi) / (2 * half * 1.001))).cast("long")


def gridded(sites: DataFrame, poi: DataFrame, metres: float, metric: str) -> tuple[DataFrame, DataFrame]:
    """Both sides with their cell (_cy, _cx), the POIs also in all neighbours.

    The earth is cut into latitude bands at least ``metres`` high, and every
    band into its own number of longitude columns, as wide as ``metres`` reach
    at the band's latitude; columns wrap around at 180 degrees (haversine).
    Every partner of a site lies in the site's band or a neighbouring one, and
    in its column or a neighbouring one."""
    deg = metres / EARTH_M_PER_DEG
    if metric == "haversine":
        deg = metres / (2 * math.pi * RADIUS_M / 360.0) * 1.001  # a degree of latitude on the sphere, with margin

    def column(lon: Column, n: Column) -> Column:
        return F.floor((lon + F.lit(180.0)) / F.lit(360.0) * n).cast("long")

    n = columns_of_band(F.col("_cy"), deg, metres, metric)
    own = column(F.col("lon"), n)
    s = sites.withColumn("_cy", F.floor(F.col("lat") / F.lit(deg)).cast("long"))
    s = s.withColumn("_cx", own if metric == "flat" else F.pmod(own, n))
    p = (poi.withColumn("_b", F.floor(F.col("lat") / F.lit(deg)).cast("long"))
         .withColumn("_cy", F.explode(F.array(F.col("_b") - 1, F.col("_b"), F.col("_b") + 1))).drop("_b"))
    near = [own - 1, own, own + 1] if metric == "flat" else [F.pmod(own + d, n) for d in (-1, 0, 1)]
    return s, p.withColumn("_cx", F.explode(F.array_distinct(F.array(*near))))


def positions(df: DataFrame, *aggregates: Column) -> DataFrame:
    """One row per position; a position has finite coordinates."""
    finite = [F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(F.col(c)) < F.lit(math.inf)) for c in ("lat", "lon")]
    d = df.withColumns({c: F.col(c).cast("double") for c in ("lat", "lon")}).where(finite[0] & finite[1])
    return d.groupBy("lat", "lon").agg(*aggregates) if aggregates else d.select("lat", "lon").distinct()


def blocks(lat: np.ndarray, lon: np.ndarray, metric: str, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(order, starts, centres, radii): in ``order`` every run of ``size`` is a
    block of neighbours; its centre is one of its members."""
    n = len(lat)
    strips = math.ceil(math.sqrt(n / size))
    strip = np.empty(n, np.int64)
    strip[np.argsort(lat, kind="stable")] = np.arange(n) * strips // n
    order = np.lexsort((lon, strip))
    starts = np.arange(0, n, size)
    centres = order[np.minimum(starts + size // 2, (starts + np.minimum(starts + size, n) - 1) // 2)]
    of = np.arange(n) // size
    away = far(lat[centres][of], lon[centres][of], lat[order], lon[order], metric)
    return order, starts, centres, np.maximum.reduceat(away, starts)


def _members(starts: np.ndarray, order: np.ndarray, chosen: np.ndarray, size: int) -> np.ndarray:
    return np.concatenate([order[starts[b]:starts[b] + size] for b in chosen])


def count_group(s: np.ndarray, p: np.ndarray, weight: np.ndarray, metres: float, metric: str, size: int = BLOCK) -> np.ndarray:
    """Sums of the rows of ``weight`` over the positions ``p`` (lat, lon) within
    ``metres`` of every position of ``s``."""
    so, ss, sc, sr = blocks(*s, metric, size)
    po, ps, pc, pr = blocks(*p, metric, size)
    between = far(s[0][sc][:, None], s[1][sc][:, None], p[0][pc], p[1][pc], metric)
    slack = sr[:, None] + pr
    inside = between + slack <= metres - MARGIN_M
    edge = ~inside & (between - slack <= metres + MARGIN_M)
    whole = inside.astype(float) @ np.add.reduceat(weight[po], ps, axis=0)
    out = np.empty((len(so), weight.shape[1]))
    for i, at in enumerate(ss):
        rows = so[at:at + size]
        out[rows] = whole[i]
        if edge[i].any():
            take = _members(ps, po, np.flatnonzero(edge[i]), size)
            out[rows] += (far(s[0][rows][:, None], s[1][rows][:, None], p[0][take], p[1][take], metric) <= metres).astype(float) @ weight[take]
    return out


def nearest_group(s: np.ndarray, p: np.ndarray, metres: float, metric: str, size: int = BLOCK) -> np.ndarray:
    """Number of the nearest position of ``p`` for every position of ``s``; -1
    where the blocks already show that none is within ``metres``."""
    so, ss, sc, sr = blocks(*s, metric, size)
    po, ps, pc, pr = blocks(*p, metric, size)
    between = far(s[0][sc][:, None], s[1][sc][:, None], p[0][pc], p[1][pc], metric)
    slack = sr[:, None] + pr
    reach = between - slack <= np.minimum((between + slack).min(1), metres)[:, None] + MARGIN_M
    out = np.full(len(so), -1)
    for i, at in enumerate(ss):
        if reach[i].any():
            rows, take = so[at:at + size], _members(ps, po, np.flatnonzero(reach[i]), size)
            out[rows] = take[far(s[0][rows][:, None], s[1][rows][:, None], p[0][take], p[1][take], metric).argmin(1)]
    return out


def _group_pairs(s: DataFrame, p: DataFrame, metres: float, metric: str, run: Callable, schema: str, group: int) -> DataFrame:
    """``run`` over every pair of groups (tables of positions) in reach."""
    s, p = cut_lineage(s), cut_lineage(p)
    own, _ = gridded(s, p, metres, metric)
    n, cells = own.agg(F.count("*"), F.approx_count_distinct(F.struct("_cy", "_cx"))).first()
    s, p = gridded(s, p, metres * max(1, math.isqrt(cells // CELLS)), metric)
    cell = ["_cy", "_cx"]
    # one row per cell, few by the widening: broadcast, as a join by cell would bring a crowded one to a single task
    deal = s.groupBy(*cell).agg(F.ceil(F.count("*") / group).cast("int").alias("_ns")).join(
        p.groupBy(*cell).agg(F.ceil(F.count("*") / group).cast("int").alias("_np")), cell)
    deal = bounded(deal)
    mine = lambda number, salt: F.pmod(F.xxhash64("lat", "lon", F.lit(salt)), F.col(number)).cast("int")
    every = lambda number: F.explode(F.sequence(F.lit(0), F.col(number) - 1))
    pair = [*cell, "_i", "_j"]
    # as many partitions as the data has groups, not as few as its bytes would fill
    parts = max(2 * s.sparkSession.sparkContext.defaultParallelism, math.ceil(n / group))
    left = s.join(deal, cell).withColumns({"_i": mine("_ns", "s"), "_j": every("_np")}).drop("_ns", "_np").repartition(parts, *pair)
    right = p.join(deal, cell).withColumns({"_j": mine("_np", "p"), "_i": every("_ns")}).drop("_ns", "_np").repartition(parts, *pair)
    return left.groupBy(*pair).cogroup(right.groupBy(*pair)).applyInArrow(run, schema)


def _points(t: pa.Table) -> np.ndarray:
    return np.array([t.column(c).to_numpy() for c in ("lat", "lon")])


def counts_at(sites: DataFrame, poi: DataFrame, metres: float, kinds: Sequence[str], metric: str, group: int = GROUP) -> DataFrame:
    """(lat, lon, one count per kind) of the sites' positions that have a POI
    of any kind in reach."""
    names = [f"n{j}" for j in range(len(kinds))]
    p = positions(poi.where(F.col("kind").isin(list(kinds))), *[F.count_if(F.col("kind") == k).alias(c) for c, k in zip(names, kinds)])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return pa.table({c: pa.array([], pa.float64() if c in ("lat", "lon") else pa.int64()) for c in ("lat", "lon", *names)})
        weight = np.stack([right.column(c).to_numpy() for c in names], 1).astype(float)
        found = count_group(_points(left), _points(right), weight, metres, metric).astype(np.int64)
        return pa.table([left.column("lat"), left.column("lon"), *map(pa.array, found.T)], names=["lat", "lon", *names])

    schema = "lat double, lon double" + "".join(f", {c} long" for c in names)
    found = _group_pairs(positions(sites), p, metres, metric, run, schema, group)
    return found.groupBy("lat", "lon").agg(*[F.sum(c).alias(k) for c, k in zip(names, kinds)])


def nearest_at(sites: DataFrame, poi: DataFrame, metres: float, metric: str, group: int = GROUP) -> DataFrame:
    """(lat, lon, p_lat, p_lon): the nearest POI's position for the sites'
    positions, one row per group of POIs; it may be beyond ``metres``."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return pa.table({c: pa.array([], pa.float64()) for c in ("lat", "lon", "p_lat", "p_lon")})
        s, p = _points(left), _points(right)
        found = nearest_group(s, p, metres, metric)
        hit = found >= 0
        return pa.table([pa.array(c) for c in (*s[:, hit], *p[:, found[hit]])], names=["lat", "lon", "p_lat", "p_lon"])

    return _group_pairs(positions(sites), positions(poi), metres, metric, run, "lat double, lon double, p_lat double, p_lon double", group)
