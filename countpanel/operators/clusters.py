"""Clustering with repeated starts (C1-C3) and the exact silhouette.

Restarts and cluster counts share their passes: one map over the rows moves the
centres of every model that has not settled, so scanning six values of k with
twenty starts each takes as many jobs as the slowest single run has steps.
Sums are whole multiples of 2^-24, hence the same for any partitioning.

The silhouette needs each row's summed distance to every cluster.  Equal vectors
count once, with the number of their rows in every cluster.  Vectors are dealt
into blocks of bounded size; a task gets a pair of blocks, and walks it tile by
tile: one distance matrix, multiplied by the cluster counts of all labellings at
once, leaves one row of sums per vector.  A vector is copied once per block, not
once per tile, and no pair of rows is ever written.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countpanel.session import bounded, cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

UNIT = 2.0 ** -24
BLOCK_ROWS = 131_072  # most vectors, about, of one side of a block pair
SMALL_BLOCK = 512  # blocks are made smaller, down to this, to give every core some pairs
CLOSE = 1e-4  # squared distances below this share of the squared norms are taken from the differences
MOVE_ROWS = 2048  # rows worth a task of their own in a k-means step
INIT_ROWS = 4096  # rows, by hash of their id, among which first centres are drawn


def vectors(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def first_centres(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k-means++: each next centre is drawn by squared distance to the nearest
    one so far."""
    centres = [x[rng.integers(len(x))]]
    near = np.full(len(x), np.inf)
    for _ in range(k - 1):
        near = np.minimum(near, ((x - centres[-1]) ** 2).sum(1))
        total = near.sum()
        centres.append(x[rng.choice(len(x), p=near / total) if total > 0 else rng.integers(len(x))])
    return np.array(centres)


def distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, rows by centres."""
    return np.maximum((x ** 2).sum(1)[:, None] + (centres ** 2).sum(1) - 2 * (x @ centres.T), 0.0)


def _step(df: DataFrame, models: Mapping[int, np.ndarray], width: int) -> dict[int, tuple[np.ndarray, np.ndarray, float]]:
    """(rows, vector sums) per cluster and the inertia of every model, from one
    pass over the rows."""
    sent = {m: np.array(c) for m, c in models.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {m: (np.zeros(len(c), np.int64), np.zeros((len(c), width), np.int64), np.zeros(len(c), np.int64)) for m, c in sent.items()}
        for batch in batches:
            x = vectors(batch.column(0), width)
            units = np.rint(x / UNIT).astype(np.int64)
            for m, centres in sent.items():
                d = distances(x, centres)
                at = d.argmin(1)
                n, total, cost = found[m]
                order = np.argsort(at.astype(np.int16 if len(centres) < 32768 else np.int64), kind="stable")
                sizes = np.bincount(at, minlength=len(centres))
                met = np.flatnonzero(sizes)
                first = np.cumsum(sizes[met]) - sizes[met]
                n += sizes
                if len(met):
                    total[met] += np.add.reduceat(units[order], first, axis=0)
                    cost[met] += np.add.reduceat(np.rint(d[np.arange(len(x)), at] / UNIT).astype(np.int64)[order], first)
        rows = [(m, c, int(n[c]), int(cost[c]), *total[c].tolist()) for m, (n, total, cost) in found.items() for c in np.flatnonzero(n)]
        yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], pa.int32() if j < 2 else pa.int64()) for j in range(4 + width)],
                                         ["model", "cluster", "n", "cost", *(f"s{j}" for j in range(width))])

    sums = [f"s{j}" for j in range(width)]
    schema = "model int, cluster int, n long, cost long" + "".join(f", {s} long" for s in sums)
    out = {m: [np.zeros(len(c), np.int64), np.zeros((len(c), width)), 0.0] for m, c in sent.items()}
    # as many rows as there are centres
    for r in df.select("x").mapInArrow(run, schema).groupBy("model", "cluster").agg(*[F.sum(c).alias(c) for c in ("n", "cost", *sums)]).collect():
        n, total, _ = out[r["model"]]
        n[r["cluster"]], total[r["cluster"]] = r["n"], np.array([r[s] for s in sums], float) * UNIT
        out[r["model"]][2] += r["cost"] * UNIT
    return {m: tuple(v) for m, v in out.items()}


def kmeans_scan(df: DataFrame, key: str, x: str, ks: Sequence[int], n_init: int = 20, max_iter: int = 100, tol: float = 1e-9,
                seed: int = 42) -> dict[int, tuple[np.ndarray, float]]:
    """Per k the centres and inertia of the best of ``n_init`` starts over the
    array column ``x``.  Rows with a null vector take no part; k is at most the
    number of rows; without rows there is no model."""
    d = cut_lineage(df.select(F.col(key).alias("id"), F.col(x).alias("x")).where("x is not null"))
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = min(2 * cores, math.ceil(d.count() / MOVE_ROWS))
    if tasks > d.rdd.getNumPartitions():  # few bytes, but much work on each row
        d = cut_lineage(d.repartition(tasks, "id"))
    pool = d.orderBy(F.xxhash64("id"), "id").limit(INIT_ROWS).collect()
    if not pool:
        return {}
    start = np.array([r["x"] for r in pool], float)
    specs = [(k, r) for k in ks for r in range(n_init)]
    centres = {m: first_centres(start, min(k, len(start)), np.random.default_rng([seed, k, r])) for m, (k, r) in enumerate(specs)}
    inertia, moving = {}, dict(centres)
    for _ in range(max_iter):
        found = _step(d, moving, start.shape[1])
        still = {}
        for m, (n, total, cost) in found.items():
            inertia[m] = cost
            new = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centres[m])  # an empty cluster stays
            if np.abs(new - centres[m]).max() > tol:
                still[m] = new
            centres[m] = new
        moving = still
        if not moving:
            break
    if moving:  # stopped on the way: the inertia of the last centres
        inertia |= {m: cost for m, (_, _, cost) in _step(d, moving, start.shape[1]).items()}
    best = {}
    for m, (k, _) in enumerate(specs):
        if k not in best or inertia[m] < best[k][1]:
            best[k] = (centres[m], inertia[m])
    return best


def assign(df: DataFrame, x: str, centres: Mapping[str, np.ndarray]) -> DataFrame:
    """One column per entry of ``centres``: the nearest centre's number (null
    for a null vector)."""
    def far(row: np.ndarray):
        gaps = F.zip_with(F.col(x), F.array(*[F.lit(float(q)) for q in row]), lambda v, q: (v - q) * (v - q))
        return F.aggregate(gaps, F.lit(0.0), lambda a, v: a + v)

    def nearest(c: np.ndarray):
        each = [far(row) for row in c]
        d = F.array(*each)
        return F.when(F.col(x).isNotNull(), (F.array_position(d, F.array_min(d)) - 1).cast("int"))

    return df.withColumns({name: nearest(c) for name, c in centres.items()})


def apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances, rows by rows.  Matrix products give the squares;
    where these have lost digits, the differences do."""
    p, q = (a ** 2).sum(1)[:, None], (b ** 2).sum(1)
    out = a @ (-2.0 * b.T)
    out += p
    out += q
    i, j = np.nonzero(~(out > CLOSE * (p + q)))  # NaN too
    for lo in range(0, len(i), 65536):
        r, c = i[lo:lo + 65536], j[lo:lo + 65536]
        out[r, c] = ((a[r] - b[c]) ** 2).sum(1)
    return np.sqrt(out, out=out)


def block_sums(a: np.ndarray, b: np.ndarray, of_a: np.ndarray, of_b: np.ndarray, same: bool, tile: int) -> tuple[np.ndarray, np.ndarray]:
    """Distances of the vectors ``a`` to those of ``b`` summed with the weights
    ``of_b`` (vectors by clusters), and the other way round unless ``same``."""
    to_b, to_a = np.zeros((len(a), of_b.shape[1])), np.zeros((len(b), of_a.shape[1]))
    for i in range(0, len(a), tile):
        for j in range(0, len(b), tile):
            d = apart(a[i:i + tile], b[j:j + tile])
            to_b[i:i + tile] += d @ of_b[j:j + tile]
            if not same:
                to_a[j:j + tile] += d.T @ of_a[i:i + tile]
    return to_b, to_a


def distance_sums(points: DataFrame, names: Sequence[str], tile: int, block: int) -> DataFrame:
    """(p, one sum per name): the distances of every vector ``x`` (number ``p``)
    to all vectors, each as often as its column ``w`` says for that name."""
    n = points.count()
    if not n:
        return points.sparkSession.createDataFrame([], "p long" + "".join(f", {s} double" for s in names))
    cores = points.sparkSession.sparkContext.defaultParallelism
    count = max(math.ceil(n / block), min(math.ceil(math.sqrt(16 * cores)), math.ceil(n / SMALL_BLOCK)))
    dealt = points.withColumn("_b", F.pmod(F.xxhash64("p"), F.lit(count)).cast("int"))
    pairs = count * (count + 1) // 2
    last = F.lit(count - 1)
    left = dealt.select(F.col("_b").alias("i"), F.explode(F.sequence("_b", last)).alias("j"), "p", "x", "w").repartition(4 * pairs, "i", "j")
    right = dealt.select(F.explode(F.sequence(F.lit(0), "_b")).alias("i"), F.col("_b").alias("j"), *[
        F.col(c).alias(c) for c in ("p", "x", "w")]).repartition(4 * pairs, "i", "j")  # columns apart from those on the left

    def run(key: tuple, mine: pa.Table, theirs: pa.Table) -> pa.Table:
        if not len(mine) or not len(theirs):
            return pa.table([pa.array([], t) for t in (pa.int64(), *[pa.float64()] * len(names))], names=["p", *names])
        (a, of_a), (b, of_b) = ([np.concatenate([vectors(c, len(c[0])) for c in t.column(k).chunks if len(c)]) for k in ("x", "w")]
                                for t in (mine, theirs))
        same = key[0].as_py() == key[1].as_py()
        middle = a.mean(0)  # small numbers lose fewer digits
        to_b, to_a = block_sums(a - middle, b - middle, of_a, of_b, same, tile)
        sums = to_b if same else np.concatenate([to_b, to_a])
        ids = np.concatenate([t.column("p").to_numpy() for t in ((mine,) if same else (mine, theirs))])
        return pa.table([pa.array(ids), *map(pa.array, sums.T)], names=["p", *names])

    found = left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInArrow(run, "p long" + "".join(f", {s} double" for s in names))
    return found.groupBy("p").agg(*[F.sum(s).alias(s) for s in names])


def silhouette_rows(df: DataFrame, key: str, x: str, labels: Sequence[str], tile: int = 256, block: int = BLOCK_ROWS) -> DataFrame:
    """(key, one silhouette per label column) of every row: Euclidean
    distances, 0 for the only row of a cluster, null with a single cluster.
    Rows with a null vector or a null label take no part.  ``key`` is unique.
    A task holds a pair of blocks of about ``block`` vectors at most."""
    d = df.select(F.col(key).alias("id"), F.col(x).alias("x"), F.array(*[F.col(c).cast("int") for c in labels]).alias("l")).where(
        F.col("x").isNotNull() & F.forall("l", lambda c: c.isNotNull()))
    d = cut_lineage(d)
    sizes = d.select(F.posexplode("l").alias("label", "cluster")).groupBy("label", "cluster").agg(F.count("*").alias("n")).collect()
    slots = sorted((r["label"], r["cluster"]) for r in sizes)  # clusters are few
    count = {(r["label"], r["cluster"]): r["n"] for r in sizes}
    names = [f"s{j}" for j in range(len(slots))]
    member = [F.count_if(F.element_at("l", label + 1) == cluster) for label, cluster in slots]
    points = d.groupBy("x").agg((F.array(*member) if member else F.array().cast("array<long>")).alias("w"))
    points = cut_lineage(points.withColumn("p", F.monotonically_increasing_id()))
    total = points.select("p", "x").join(distance_sums(points, names, tile, block), "p").drop("p")
    out = d.where("id is not null").join(total, "x")  # a row without a key counts for the others, and has no row of its own
    scores = []
    for label, name in enumerate(labels):
        of = [(c, names[j], count[label, c]) for j, (i, c) in enumerate(slots) if i == label]
        own = F.element_at("l", label + 1)
        a = F.coalesce(*[F.when(own == c, F.col(s) / (n - 1)) for c, s, n in of if n > 1], F.lit(None).cast("double"))
        b = F.array_min(F.array(*[F.when(own != c, F.col(s) / n) for c, s, n in of]))
        value = F.when(a.isNull(), F.lit(0.0)).otherwise(F.coalesce(F.try_divide(b - a, F.greatest(a, b)), F.lit(0.0)))
        scores.append((value if len(of) > 1 else F.lit(None).cast("double")).alias(name))
    return out.select(F.col("id").alias(key), *scores)


def cluster_means(df: DataFrame, label: str, feats: Sequence[str]) -> DataFrame:
    """(label, feature, n, mean, scaled_mean) in long form: the cluster's mean
    and the mean of the features' z-scores over all rows (0 for a constant
    feature).  Rows without a label count towards the scale only; a missing
    value counts nowhere."""
    x = {c: F.col(c).cast("double") for c in feats}
    scale = df.agg(*[f(v).alias(f"{name}_{c}") for c, v in x.items() for name, f in (("m", F.avg), ("s", F.stddev_pop))])
    groups = df.where(F.col(label).isNotNull()).groupBy(label).agg(*[f(v).alias(f"{name}_of_{c}") for c, v in x.items() for name, f in (
        ("n", F.count), ("mean", F.avg))])
    each = [F.struct(F.lit(c).alias("feature"), F.col(f"n_of_{c}").alias("n"), F.col(f"mean_of_{c}").alias("mean"), F.when(
        F.col(f"s_{c}") > 0, (F.col(f"mean_of_{c}") - F.col(f"m_{c}")) / F.col(f"s_{c}")).otherwise(
        F.when(F.col(f"n_of_{c}") > 0, F.lit(0.0))).alias("scaled_mean")) for c in feats]
    return groups.crossJoin(bounded(scale)).select(label, F.inline(F.array(*each)))


def cluster_profiles(df: DataFrame, label: str, value: str, parts: Mapping[str, Column]) -> DataFrame:
    """(label, dimension, level, mean_value, n) for every dimension of
    ``parts`` in one aggregate; levels that do not occur, or are null, have no
    row."""
    each = [F.struct(F.lit(name).alias("dimension"), c.cast("string").alias("level")) for name, c in parts.items()]
    d = df.select(label, F.col(value).alias("_value"), F.inline(F.array(*each))).where(F.col("level").isNotNull())
    return d.groupBy(label, "dimension", "level").agg(F.avg("_value").alias("mean_value"), F.count("_value").alias("n"))


def scan_k(df: DataFrame, key: str, x: str, ks: Sequence[int] = range(2, 8), n_init: int = 20, seed: int = 42) -> DataFrame:
    """(k, inertia, silhouette): the best of ``n_init`` starts for every k."""
    found = kmeans_scan(df, key, x, ks, n_init, seed=seed)
    spark = df.sparkSession
    if not found:
        return spark.createDataFrame([], "k int, inertia double, silhouette double")
    labelled = assign(df.select(key, x), x, {f"k{k}": c for k, (c, _) in found.items()})
    means = silhouette_rows(labelled, key, x, [f"k{k}" for k in found]).agg(*[F.avg(f"k{k}").alias(f"k{k}") for k in found]).first()
    return spark.createDataFrame([(int(k), float(i), means[f"k{k}"]) for k, (_, i) in found.items()], "k int, inertia double, silhouette double")
