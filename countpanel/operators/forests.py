"""Deep regression forests on many rows.

What is learned is what Spark's forest learns: features are cut into 32 bins
once, a tree sees each row a Poisson(1) number of times, a node splits on the
best of its own random 60 % of the features by the drop of the squared error,
and a prediction is the mean of the trees.  Spark adds up all nodes of a level
over all rows, in passes of 256 MB of sums per task; deep levels have more nodes
than one pass holds, and every row hits a distant part of these sums.

Here rows are kept in blocks of binned bytes.  Only nodes with more than
``LOCAL_ROWS`` rows are split by sums over all blocks, level by level.  A node
with fewer rows is grown to its end in one task that gets just these rows, so a
task's memory has a bound and the rows of a tree move once.  Trees are grown in
batches, so that about ``MOVED_ROWS`` rows are moved at a time.

Defined results: a null or NaN label is an error, as in Spark; a feature with
one value is never split on.
"""

from __future__ import annotations

import math
import pickle
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countpanel.session import cut_lineage

# task functions travel by value: executors need not have the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BINS = 32  # Spark's default
BLOCK_ROWS = 1 << 17
LOCAL_ROWS = 1 << 20
MOVED_ROWS = 1 << 28
EDGE_ROWS = 200_000  # rows that the bins are taken from (Spark: 10,000)

# Poisson(1) by 16 random bits
POISSON = np.searchsorted(np.cumsum([math.exp(-1) / math.factorial(k) for k in range(9)]), (np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.uint8)


@dataclass
class Tree:
    """Nodes of one tree; the right child stands next to the left one, bins up to
    ``cut`` go left.  A leaf is its own left child, and all bins go left."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray
    gain: np.ndarray  # drop of the sum of squared errors

    def step(self, x: np.ndarray, start: np.ndarray, at: np.ndarray) -> np.ndarray:
        """One level down, for rows that begin at ``start`` of the flat bins ``x``."""
        return self.left.take(at) + (x.take(start + self.feature.take(at)) > self.cut.take(at))

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        x, start, at = bins.ravel(), np.arange(len(bins)) * bins.shape[1], np.zeros(len(bins), np.int32)
        while True:
            into = self.step(x, start, at)
            if (into == at).all():
                return at
            at = into

    def reach(self, bins: np.ndarray, rows: np.ndarray, nodes: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """The ``rows`` whose leaf is one of ``nodes``, and that leaf; the others
        are let go as soon as they leave the way there."""
        on = np.zeros(len(self.left), bool)
        on[nodes] = True
        for v in range(len(on) - 1, -1, -1):  # children stand behind their parent
            if self.left[v] != v:
                on[v] = on[self.left[v]] or on[self.left[v] + 1]
        x, at = bins.ravel(), np.zeros(len(rows), np.int32)
        if not on[0]:
            return rows[:0], at[:0]
        while True:
            into = self.step(x, rows * bins.shape[1], at)
            if (into == at).all():
                return rows, at
            keep = on.take(into)
            rows, at = rows[keep], into[keep]


class Nodes:
    """A tree that is being grown."""

    def __init__(self) -> None:
        self.feature, self.cut, self.left, self.value, self.gain = ([] for _ in range(5))
        self.add(np.zeros(1))

    def add(self, value: np.ndarray) -> int:
        at, n = len(self.left), len(value)
        for column, new in ((self.feature, [0] * n), (self.cut, [255] * n), (self.left, range(at, at + n)), (self.value, value.tolist()), (self.gain, [0.0] * n)):
            column.extend(new)
        return at

    def graft(self, at: int, sub: Tree) -> None:
        """``sub``'s root becomes node ``at``, its other nodes the last ones."""
        base = len(self.left) - 1
        left = np.where(sub.left == np.arange(len(sub.left)), np.arange(len(sub.left)), sub.left) + base
        if sub.left[0] == 0:
            left[0] = at
        for column, new in ((self.feature, sub.feature), (self.cut, sub.cut), (self.left, left), (self.value, sub.value), (self.gain, sub.gain)):
            column[at] = new[0].item()
            column.extend(new[1:].tolist())

    def tree(self) -> Tree:
        return Tree(np.array(self.feature, np.int16), np.array(self.cut, np.uint8), np.array(self.left, np.int32), np.array(self.value), np.array(self.gain))


def find_edges(x: np.ndarray, bins: int = BINS) -> list[np.ndarray]:
    """Per feature the values between bins: between all distinct values, or at
    about equal numbers of rows."""
    out = []
    for column in x.T:
        values, n = np.unique(column, return_counts=True)
        between = (values[1:] + values[:-1]) / 2
        if len(between) >= bins:
            below = np.cumsum(n)[:-1]
            between = between[np.unique(np.abs(below[None] - len(column) * np.arange(1, bins)[:, None] / bins).argmin(1))]
        out.append(between)
    return out


def to_bins(column: pa.Array, edges: list[np.ndarray]) -> np.ndarray:
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(edges))
    return np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], 1).astype(np.uint8)


def block_table(rows: DataFrame, label: str, edges: list[np.ndarray], mean: float) -> DataFrame:
    """(block, x, y): bins and centred labels of up to ``BLOCK_ROWS`` rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count, number = [], 0, TaskContext.get().partitionId() << 32

        def block() -> pa.RecordBatch:
            x, y = (np.concatenate(part) for part in zip(*held))
            return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([x.tobytes()], pa.binary()), pa.array([y.tobytes()], pa.binary())], ["block", "x", "y"])

        for batch in batches:
            y = batch.column(1).to_numpy(zero_copy_only=False)
            held.append((to_bins(batch.column(0), edges), y - mean))
            count += len(y)
            if count >= BLOCK_ROWS:
                yield block()
                held, count, number = [], 0, number + 1
        if held:
            yield block()

    return rows.select(vector_to_array("features").alias("x"), F.col(label).cast("double").alias("y")).mapInArrow(run, "block long, x binary, y binary")


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for batch in batches:
        for block, x, y in zip(*(batch.column(k) for k in range(3))):
            yield block.as_py(), np.frombuffer(x.as_buffer(), np.uint8).reshape(-1, width), np.frombuffer(y.as_buffer(), np.float64)


def times_seen(seed: int, tree: int, block: int, n: int) -> np.ndarray:
    """How often the tree sees each row of the block."""
    return POISSON[np.random.default_rng((seed, tree, block)).integers(0, 1 << 16, n, np.uint16)]


def _places(tops: dict[int, Tree], wanted: dict[int, list[int]], seed: int, block: int, x: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For every tree: rows in the wanted nodes, their place in ``wanted`` and
    how often they are seen."""
    for tree, nodes in wanted.items():
        seen = times_seen(seed, tree, block, len(x))
        rows, at = tops[tree].reach(x, np.flatnonzero(seen), nodes)
        where = np.zeros(len(tops[tree].left), np.int64)
        where[nodes] = np.arange(len(nodes))
        yield tree, rows, where[at], seen[rows]


def _subset(rng: np.random.Generator, nodes: int, width: int, used: int) -> np.ndarray:
    return np.sort(rng.random((nodes, width)).argsort(1)[:, :used], 1)


def best_splits(n: np.ndarray, s: np.ndarray, features: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """(gain, feature, cut, rows and sum left) per node from its sums
    (nodes x its features x bins); gain 0 where no split is worth it."""
    rows, total = n[:, :1].sum(2), s[:, :1].sum(2)
    nl, sl = np.cumsum(n, 2)[:, :, :-1], np.cumsum(s, 2)[:, :, :-1]
    nr, sr = rows[:, :, None] - nl, total[:, :, None] - sl
    whole = total ** 2 / np.maximum(rows, 1)
    gain = sl ** 2 / np.maximum(nl, 1) + sr ** 2 / np.maximum(nr, 1) - whole[:, :, None]
    gain = np.where((nl >= max(least, 1)) & (nr >= max(least, 1)), gain, 0.0).reshape(len(n), -1)
    k, i = gain.argmax(1), np.arange(len(n))
    top = gain[i, k]
    j, cut = np.divmod(k, n.shape[2] - 1)
    # rows of one label differ by rounding only
    return np.where(top > 1e-12 * np.maximum(whole[:, 0], 1e-300), top, 0.0), features[i, j], cut, nl[i, j, cut], sl[i, j, cut]


def grow(x: np.ndarray, y: np.ndarray, seen: np.ndarray, levels: int, least: int, used: int, rng: np.random.Generator) -> Tree:
    """A tree of at most ``levels`` levels of splits over rows that one task holds."""
    out, width = Nodes(), x.shape[1]
    w, wy = seen.astype(np.float64), seen * y
    n, s = np.array([w.sum()]), np.array([wy.sum()])
    out.value[0] = s[0] / n[0]
    at, frontier = np.zeros(len(x), np.int64), np.zeros(1, np.int64)
    for _ in range(levels):
        k = len(frontier)
        features = _subset(rng, k, width, used)
        flat, start = x.ravel(), np.arange(len(x)) * width
        sums = np.empty((2, k, used, BINS))
        for j in range(used):
            slot = at * BINS + flat.take(start + features[:, j].take(at))
            sums[0, :, j] = np.bincount(slot, w, k * BINS).reshape(k, BINS)
            sums[1, :, j] = np.bincount(slot, wy, k * BINS).reshape(k, BINS)
        gain, feature, cut, nl, sl = best_splits(*sums, features, least)
        split = np.flatnonzero(gain > 0)
        if not len(split):
            break
        children = np.stack([nl[split], n[split] - nl[split], sl[split], s[split] - sl[split]], 1)
        n, s = children[:, :2].ravel(), children[:, 2:].ravel()
        first = out.add(s / n)
        for i, node in enumerate(split.tolist()):
            v = int(frontier[node])
            out.feature[v], out.cut[v], out.left[v], out.gain[v] = int(feature[node]), int(cut[node]), first + 2 * i, float(gain[node])
        into = np.full(k, -1)
        into[split] = 2 * np.arange(len(split))
        goes = into[at] + (flat.take(start + feature.take(at)) > cut.take(at))
        keep = into[at] >= 0
        at, x, w, wy = goes[keep], x[keep], w[keep], wy[keep]
        frontier = first + np.arange(2 * len(split))
    return out.tree()


def _split_large(blocks: DataFrame, tops: dict[int, Tree], wanted: dict[int, list[int]], heap: dict[int, list[int]], width: int, used: int, least: int, seed: int) -> pd.DataFrame:
    """The best split of every wanted node over all rows that its tree sees."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {tree: np.zeros((2, width, len(nodes) * BINS)) for tree, nodes in wanted.items()}
        for block, x, y in _blocks(batches, width):
            for tree, rows, at, seen in _places(tops, wanted, seed, block, x):
                w, wy, part = seen.astype(np.float64), seen * y[rows], x[rows]
                for j in range(width):
                    slot = at * BINS + part[:, j]
                    sums[tree][0, j] += np.bincount(slot, w, sums[tree].shape[2])
                    sums[tree][1, j] += np.bincount(slot, wy, sums[tree].shape[2])
        for tree, nodes in wanted.items():
            by_node = sums[tree].reshape(2, width, len(nodes), BINS).transpose(2, 0, 1, 3)
            yield pa.RecordBatch.from_arrays([pa.array([tree] * len(nodes), pa.int32()), pa.array(range(len(nodes)), pa.int32()),
                                              pa.array([h.tobytes() for h in by_node], pa.binary())], ["tree", "place", "sums"])

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        tree, place = int(pdf["tree"].iloc[0]), int(pdf["place"].iloc[0])
        n, s = sum(np.frombuffer(b, np.float64) for b in pdf["sums"]).reshape(2, 1, width, BINS)
        features = _subset(np.random.default_rng((seed, tree, heap[tree][place])), 1, width, used)
        gain, feature, cut, nl, sl = best_splits(n[:, features[0]], s[:, features[0]], features, least)
        return pd.DataFrame({"tree": tree, "place": place, "n": n[0, 0].sum(), "s": s[0, 0].sum(), "gain": gain, "feature": feature, "cut": cut, "nl": nl, "sl": sl})

    sums = blocks.mapInArrow(add, "tree int, place int, sums binary").groupBy("tree", "place")
    return sums.applyInPandas(choose, "tree int, place int, n double, s double, gain double, feature int, cut int, nl double, sl double").toPandas()


def _grow_small(blocks: DataFrame, tops: dict[int, Tree], wanted: dict[int, list[int]], heap: dict[int, list[int]], width: int, used: int, least: int, depth: int, seed: int) -> Iterator[tuple[int, int, Tree]]:
    """The trees below the wanted nodes, each grown by one task."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, x, y in _blocks(batches, width):
            for tree, rows, at, seen in _places(tops, wanted, seed, block, x):
                order = np.argsort(at, kind="stable")
                rows, seen = rows[order], seen[order]
                met, start = np.unique(at[order], return_index=True)
                parts = [(x[rows[a:b]].tobytes(), y[rows[a:b]].tobytes(), seen[a:b].tobytes()) for a, b in zip(start, [*start[1:], len(rows)])]
                yield pa.RecordBatch.from_arrays([pa.array([tree] * len(met), pa.int32()), pa.array(met, pa.int32()), pa.array([block] * len(met), pa.int64()),
                                                  *(pa.array([p[k] for p in parts], pa.binary()) for k in range(3))], ["tree", "place", "block", "x", "y", "seen"])

    def finish(pdf: pd.DataFrame) -> pd.DataFrame:
        tree, place = int(pdf["tree"].iloc[0]), int(pdf["place"].iloc[0])
        pdf = pdf.sort_values("block")
        x, y, seen = (np.frombuffer(b"".join(pdf[c]), t) for c, t in (("x", np.uint8), ("y", np.float64), ("seen", np.uint8)))
        at = heap[tree][place]
        sub = grow(x.reshape(-1, width), y, seen, depth - at.bit_length() + 1, least, used, np.random.default_rng((seed, tree, at)))
        return pd.DataFrame({"tree": [tree], "place": [place], "sub": [pickle.dumps([sub.feature, sub.cut, sub.left, sub.value, sub.gain])]})

    sent = blocks.mapInArrow(send, "tree int, place int, block long, x binary, y binary, seen binary").groupBy("tree", "place")
    for row in sent.applyInPandas(finish, "tree int, place int, sub binary").toArrow().to_batches(1):
        yield row["tree"][0].as_py(), row["place"][0].as_py(), Tree(*pickle.loads(row["sub"][0].as_buffer()))


@dataclass
class Forest:
    """Bin edges and trees, with what the models of Spark offer here."""

    edges: list[np.ndarray]
    base: float
    trees: list[Tree]

    def predict(self, bins: np.ndarray) -> np.ndarray:
        return self.base + sum(t.value[t.leaves(bins)] for t in self.trees) / len(self.trees)

    def transform(self, df: DataFrame) -> DataFrame:
        model = Forest(self.edges, self.base, [Tree(t.feature, t.cut, t.left, t.value, t.gain[:0]) for t in self.trees])

        @F.arrow_udf("double")
        def predict(x: pa.Array) -> pa.Array:
            return pa.array(model.predict(to_bins(x, model.edges)))

        return df.withColumn("prediction", predict(vector_to_array("features")))

    @property
    def featureImportances(self):
        """Gain by feature, each tree with the same weight, of sum 1."""
        from pyspark.ml.linalg import Vectors

        total = np.zeros(len(self.edges))
        for t in self.trees:
            gain = np.bincount(t.feature, t.gain, len(total))
            total += gain / (gain.sum() or 1.0)
        return Vectors.dense(total / (total.sum() or 1.0))


def fit(rows: DataFrame, label: str, count: int, trees: int, depth: int, share: float, min_instances: int, seed: int) -> Forest:
    """A forest on ``rows`` (stored: they are read several times) with the columns
    features and ``label``; ``count`` is their number."""
    bad, mean = rows.agg(F.count_if(F.col(label).isNull() | F.isnan(label)), F.avg(label)).first()
    if bad:
        raise ValueError(f"{bad} labels are null or NaN")
    some = rows.sample(False, min(1.0, EDGE_ROWS / count), seed).select(vector_to_array("features").alias("x")).toArrow().column(0).combine_chunks()
    width = len(rows.select("features").first()[0])
    edges = find_edges(some.flatten().to_numpy(zero_copy_only=False).reshape(-1, width))
    used = max(1, math.ceil(share * width))
    blocks = cut_lineage(block_table(rows, label, edges, mean))
    grown: list[Tree] = []
    step = max(1, MOVED_ROWS // count)
    for first in range(0, trees, step):
        batch = {t: Nodes() for t in range(first, min(trees, first + step))}
        # nodes with many rows (node, heap number) by tree, and those left to one task
        large, small = {t: [(0, 1)] for t in batch}, {t: [] for t in batch}
        for level in range(depth):
            large = {t: nodes for t, nodes in large.items() if nodes}
            if not large:
                break
            tops = {t: batch[t].tree() for t in large}
            found = _split_large(blocks, tops, {t: [v for v, _ in nodes] for t, nodes in large.items()}, {t: [h for _, h in nodes] for t, nodes in large.items()},
                                 width, used, min_instances, seed)
            after: dict[int, list[tuple[int, int]]] = {t: [] for t in batch}
            for r in found.sort_values(["tree", "place"]).itertuples():
                nodes, (node, heap) = batch[r.tree], large[r.tree][r.place]
                nodes.value[node] = r.s / r.n if r.n else 0.0
                if r.gain <= 0:
                    continue
                rest = r.n - r.nl
                left = nodes.add(np.array([r.sl / r.nl, (r.s - r.sl) / rest]))
                nodes.feature[node], nodes.cut[node], nodes.left[node], nodes.gain[node] = int(r.feature), int(r.cut), left, float(r.gain)
                if level + 1 < depth:
                    for side, n in enumerate((r.nl, rest)):
                        (after if n > LOCAL_ROWS else small)[r.tree].append((left + side, 2 * heap + side))
            large = after
        small = {t: nodes for t, nodes in small.items() if nodes}
        if small:
            tops = {t: batch[t].tree() for t in small}
            for t, place, sub in _grow_small(blocks, tops, {t: [v for v, _ in nodes] for t, nodes in small.items()}, {t: [h for _, h in nodes] for t, nodes in small.items()},
                                             width, used, min_instances, depth, seed):
                batch[t].graft(small[t][place][0], sub)
        grown += [nodes.tree() for nodes in batch.values()]
    return Forest(edges, mean, grown)
