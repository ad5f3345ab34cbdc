"""Leaf-wise histogram boosting over DataFrames.

Features are cut into bins once, at quantiles of a bounded sample (``edge_rows``
rows, chosen by the hash of their key) or, where it has few distinct values,
between these; a row then carries one byte per feature.  A tree grows best
first: a queue holds the leaves by the gain of their best split, and the leaf
on top is split next until the tree has ``leaves`` leaves.  What a round needs
from the data is one aggregate, the sum of residuals and the number of rows per
(leaf, feature, bin): tasks add up their rows, the shuffle carries at most
leaves x features x bins rows a task, and only the summed table (bounded alike)
reaches the driver.  A round prepares the children of every leaf that may still
be split, so the greedy order is exact; with ``batch`` it is exact but for the
leaves split in one round.

Residuals are rounded to multiples of 2^-20 and added as whole numbers.  Trees
are therefore the same for any partitioning.  Predictions of finished trees are
folded into the table every ``rewrite`` trees by a checkpoint in the shared
folder; later trees are walked in the map task.

Defined results: a null feature has a bin of its own (0) below all others; rows
with a null target are not learned from; without a row to learn from the model
predicts 0; a feature with one value is never split on.
"""

from __future__ import annotations

import heapq
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from countpanel.session import cut_lineage

# task functions travel by value: executors need not have the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

UNIT = 2.0 ** -20  # residuals are whole multiples of it
MAX_BINS = 255  # one byte, 0 for null


@dataclass
class Tree:
    """Nodes of one tree; a leaf is its own left child, the right child stands
    next to the left one."""

    feature: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)  # bins up to the cut go left
    left: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    n: list[int] = field(default_factory=list)
    total: list[int] = field(default_factory=list)  # sum of residuals, in UNITs
    gain: list[float] = field(default_factory=list)

    def add(self) -> int:
        at = len(self.left)
        for column, first in ((self.feature, 0), (self.cut, 0), (self.left, at), (self.value, 0.0), (self.n, 0), (self.total, 0),
                              (self.gain, 0.0)):
            column.append(first)
        return at

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """Leaf of every row of ``bins`` (rows x features)."""
        feature, cut, left = (np.asarray(c) for c in (self.feature, self.cut, self.left))
        at, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
        while True:
            into = np.where(left[at] == at, at, left[at] + (bins[rows, feature[at]] > cut[at]))
            if (into == at).all():
                return at
            at = into


@dataclass
class Booster:
    """Bin edges and trees; ``predict`` is a map over rows."""

    features: list[str]
    edges: list[list[float]]
    base: float
    rate: float
    trees: list[Tree] = field(default_factory=list)
    losses: list[float] = field(default_factory=list)  # validation loss before each tree
    target: str = "identity"

    def margin(self, bins: np.ndarray, trees: Sequence[Tree] | None = None) -> np.ndarray:
        out = np.zeros(len(bins))
        for tree in self.trees if trees is None else trees:
            out += self.rate * np.asarray(tree.value)[tree.leaves(bins)]
        return out

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """``df`` with a prediction column (expm1, at least 0, for a log1p
        target)."""
        model = self

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                p = model.base + model.margin(to_bins(batch.column(1), model.edges))
                if model.target == "log1p":
                    p = np.maximum(np.expm1(p), 0.0)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p)], ["row", out])

        rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), feature_array(self.features))
        found = rows.mapInArrow(run, T.StructType([rows.schema["row"], T.StructField(out, T.DoubleType())]))
        return found.select(*[F.col("row").getField(c).alias(c) for c in df.columns if c != out], out)

    def nodes(self, spark: SparkSession) -> DataFrame:
        """(tree, node, feature, cut, edge, left, value, n, total, gain): the
        model as a table."""
        rows = [(k, i, self.features[t.feature[i]] if t.left[i] != i else None, t.cut[i] if t.left[i] != i else None,
                 self.upper(t.feature[i], t.cut[i]) if t.left[i] != i else None, t.left[i] if t.left[i] != i else None,
                 float(t.value[i]), t.n[i], t.total[i] * UNIT, float(t.gain[i])) for k, t in enumerate(self.trees) for i in range(len(t.left))]
        return spark.createDataFrame(rows, "tree int, node int, feature string, cut int, edge double, left int, value double, n long, "
                                           "total double, gain double")

    def upper(self, feature: int, cut: int) -> float | None:
        """Largest value that goes left (None: only nulls do)."""
        return float(self.edges[feature][cut - 1]) if cut else None

    def importances(self, spark: SparkSession) -> DataFrame:
        """Gain and number of splits per feature."""
        gain, splits = [0.0] * len(self.features), [0] * len(self.features)
        for t in self.trees:
            for i, j in enumerate(t.feature):
                if t.left[i] != i:
                    gain[j] += t.gain[i]
                    splits[j] += 1
        return spark.createDataFrame(list(zip(self.features, gain, splits)), "feature string, gain double, splits int")


def number(c: str) -> Column:
    """The feature as a double, NaN as null."""
    x = F.col(f"`{c}`").cast("double")
    return F.when(~F.isnan(x), x)


def feature_array(features: Sequence[str]) -> Column:
    return F.array(*map(number, features)).alias("x")


def to_bins(column: pa.Array, edges: list[list[float]]) -> np.ndarray:
    """Bins of an array column: 0 for null, else 1 + number of edges below."""
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(edges))
    return np.stack([np.where(np.isnan(x[:, j]), 0, 1 + np.searchsorted(e, x[:, j], "left")) for j, e in enumerate(edges)], 1).astype(np.uint8)


def fit_edges(df: DataFrame, features: Sequence[str], bins: int, key: Sequence[str], edge_rows: int = 200_000) -> list[list[float]]:
    """Upper edges of all bins but the last, per feature: quantiles of about
    ``edge_rows`` rows, without repeats.  One count, one aggregate."""
    if not 2 <= bins <= MAX_BINS:
        raise ValueError(f"2 to {MAX_BINS} bins")
    share = min(1.0, edge_rows / max(1, df.count()))
    deal = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in key], F.lit("edges")), F.lit(1 << 20))
    shares = F.array(*[F.lit(k / bins) for k in range(1, bins)])
    distinct = [F.sort_array(F.collect_set(number(c))) for c in features]
    row = df.where(deal < F.lit(int(share * (1 << 20)))).agg(*[
        F.when(F.size(d) <= bins, F.slice(d, 1, F.greatest(F.size(d) - 1, F.lit(0)))).otherwise(F.percentile(number(c), shares)).alias(str(j))
        for j, (c, d) in enumerate(zip(features, distinct))]).first()
    return [sorted({float(q) for q in row[j] or []}) for j in range(len(features))]


def bin_table(df: DataFrame, y: Column, features: Sequence[str], edges: list[list[float]], key: Sequence[str], valid: Column | None) -> DataFrame:
    """(id, valid, y, pred, bins) of the rows with a target."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = to_bins(batch.column(3), edges)
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(3)), pa.array(np.zeros(len(found))),
                                              pa.array([r.tobytes() for r in found], pa.binary())], ["id", "valid", "y", "pred", "bins"])

    rows = df.where(y.isNotNull()).select(
        F.xxhash64(*[F.col(f"`{c}`") for c in key]).alias("id"), (F.lit(False) if valid is None else F.coalesce(valid, F.lit(False))).alias("valid"),
        y.cast("double").alias("y"), feature_array(features))
    return rows.mapInArrow(run, "id long, valid boolean, y double, pred double, bins binary")


def _unpack(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, ...]:
    columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(4)]
    return *columns, np.frombuffer(b"".join(batch.column(4).to_pylist()), np.uint8).reshape(len(batch), width)


def chance(ids: np.ndarray, number: int) -> np.ndarray:
    """A hash of (id, number) in [0, 1): which rows a tree sees."""
    h = ids.astype(np.uint64) ^ np.uint64((number * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2 ** 64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return (h ^ (h >> np.uint64(31))) / 2.0 ** 64


def sums(table: DataFrame, model: Booster, pending: list[Tree], tree: Tree, wanted: list[int], used: list[int], number: int, subsample: float,
         loss: bool) -> pa.Table:
    """(node, feature, bin, total, n) of the wanted leaves of ``tree`` over the
    rows that it sees; with ``loss`` also the validation loss as node -1."""
    width, last = len(model.features), MAX_BINS + 1
    place = {node: k for k, node in enumerate(wanted)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((2, len(wanted) * len(used) * last))
        squares, held = 0, 0
        where = np.full(len(tree.left), -1)
        for node, k in place.items():
            where[node] = k
        for batch in batches:
            ids, valid, y, pred, bins = _unpack(batch, width)
            residual = np.rint((y - model.base - pred - model.margin(bins, pending)) / UNIT)
            if loss:
                squares += int(((residual[valid] * 2.0 ** -8).astype(np.int64) ** 2).sum())
                held += int(valid.sum())
            seen = ~valid
            if subsample < 1:
                seen &= chance(ids, number) < subsample
            at = where[tree.leaves(bins)]
            seen &= at >= 0
            slot = (at[seen, None] * len(used) + np.arange(len(used))) * last + bins[seen][:, used]
            total += np.bincount(slot.ravel(), np.repeat(residual[seen], len(used)), len(total))
            n += np.bincount(slot.ravel(), minlength=len(n))
        met = np.flatnonzero(n)
        node, rest = np.divmod(met, len(used) * last)
        columns = [np.array(wanted)[node], np.array(used)[rest // last], rest % last, total[met].astype(np.int64), n[met].astype(np.int64)]
        if loss:
            columns = [np.append(c, v) for c, v in zip(columns, (-1, 0, 0, squares, held))]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(),) * 3 + (pa.int64(),) * 2)],
                                         ["node", "feature", "bin", "total", "n"])

    found = table.mapInArrow(run, "node int, feature int, bin int, total long, n long")
    return found.groupBy("node", "feature", "bin").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).toArrow()


def best_split(total: np.ndarray, n: np.ndarray, l2: float, min_rows: int) -> tuple[float, int, int] | None:
    """(gain, feature, cut) of the best split of a leaf from its sums by
    (feature, bin); ties go to the smaller feature, then cut."""
    if not total.size:
        return None
    s, c = np.cumsum(total, 1)[:, :-1], np.cumsum(n, 1)[:, :-1]
    whole, rows = total[0].sum(), n[0].sum()
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = s ** 2 / (c + l2) + (whole - s) ** 2 / (rows - c + l2) - whole ** 2 / (rows + l2)
    gain = np.where((c >= min_rows) & (rows - c >= min_rows), gain * UNIT ** 2, -np.inf)
    k = int(np.argmax(gain))
    return (float(gain.flat[k]), *divmod(k, gain.shape[1])) if gain.flat[k] > 1e-12 else None


def grow(table: DataFrame, model: Booster, pending: list[Tree], number: int, leaves: int, l2: float, min_rows: int, subsample: float,
         used: list[int], batch: int | None) -> tuple[Tree, float | None]:
    """One tree, the best split first, and the validation loss before it."""
    virtual = Tree()  # every node whose sums are known or asked for
    virtual.add()
    splits: dict[int, tuple[float, int, int] | None] = {}
    loss = None

    def resolve(wanted: list[int]) -> None:
        nonlocal loss
        first = 0 in wanted
        found = {c: v.to_numpy() for c, v in zip(("node", "feature", "bin", "total", "n"), sums(
            table, model, pending, virtual, wanted, used, number, subsample, first).columns)}
        if first and (at := found["node"] == -1).any() and found["n"][at].sum():
            loss = float(found["total"][at].sum() * (UNIT * 2.0 ** 8) ** 2 / found["n"][at].sum())
        slot = {j: k for k, j in enumerate(used)}
        for node in wanted:
            rows = found["node"] == node
            total, n = np.zeros((len(used), MAX_BINS + 1)), np.zeros((len(used), MAX_BINS + 1))
            f = np.array([slot[j] for j in found["feature"][rows].tolist()], int)
            total[f, found["bin"][rows]], n[f, found["bin"][rows]] = found["total"][rows], found["n"][rows]
            virtual.total[node], virtual.n[node] = (int(a[0].sum()) if len(used) else 0 for a in (total, n))
            virtual.value[node] = virtual.total[node] * UNIT / (virtual.n[node] + l2) if virtual.n[node] else 0.0
            best = best_split(total, n, l2, min_rows)
            splits[node] = best and (best[0], used[best[1]], best[2])

    def children(node: int) -> list[int]:
        """The node's children, asked for if need be."""
        if virtual.left[node] == node:
            virtual.gain[node], virtual.feature[node], virtual.cut[node] = splits[node]
            left = virtual.add()
            virtual.add()
            virtual.left[node] = left
        return [virtual.left[node], virtual.left[node] + 1]

    resolve([0])
    queue, taken = [(-splits[0][0], 0)] if splits[0] else [], []
    while queue and len(taken) < leaves - 1:
        if batch is not None:
            now = [heapq.heappop(queue)[1] for _ in range(min(batch, len(queue), leaves - 1 - len(taken)))]
            resolve([c for v in now for c in children(v)])
            taken += now
            for c in (c for v in now for c in children(v) if splits[c]):
                heapq.heappush(queue, (-splits[c][0], c))
            continue
        node = queue[0][1]
        if not all(c in splits for c in children(node)):
            near = [v for _, v in heapq.nsmallest(leaves - 1 - len(taken), queue)]
            resolve([c for v in near for c in children(v) if c not in splits])
        heapq.heappop(queue)
        taken.append(node)
        for c in children(node):
            if splits[c]:
                heapq.heappush(queue, (-splits[c][0], c))
    return prune(virtual, set(taken)), loss


def prune(virtual: Tree, taken: set[int]) -> Tree:
    """The tree whose inner nodes are ``taken``, numbered breadth first."""
    out, todo = Tree(), [(0, 0)]
    out.add()
    for node, at in todo:
        out.value[at], out.n[at], out.total[at] = virtual.value[node], virtual.n[node], virtual.total[node]
        if node in taken:
            out.feature[at], out.cut[at], out.gain[at] = virtual.feature[node], virtual.cut[node], virtual.gain[node]
            out.left[at] = out.add()
            out.add()
            todo += [(virtual.left[node] + side, out.left[at] + side) for side in (0, 1)]
    return out


def fit_leafwise(df: DataFrame, y: str, features: Sequence[str], key: Sequence[str], valid: Column | None = None, target: str = "identity",
                 trees: int = 100, leaves: int = 64, rate: float = 0.1, bins: int = 64, l2: float = 0.0, min_rows: int = 20, subsample: float = 1.0,
                 colsample: float = 1.0, patience: int | None = 10, batch: int | None = None, rewrite: int = 10, edge_rows: int = 200_000, seed: int = 42) -> Booster:
    """Least squares boosting of ``y`` (or log1p of it) by leaf-wise trees.

    ``key`` names the columns whose hash decides which rows a tree sees
    (``subsample``); ``colsample`` is the share of features a tree may use.
    With ``batch`` a round splits that many of the best leaves, without waiting
    for what their children would gain: fewer rounds, not quite the same order.
    ``valid`` marks rows that are not learned from; when their loss has not
    improved for ``patience`` trees, the fit ends and the best number of trees
    is kept."""
    goal = F.log1p(F.col(y)) if target == "log1p" else F.col(y).cast("double")
    edges = fit_edges(df.where(goal.isNotNull()), features, bins, key, edge_rows)
    table = cut_lineage(bin_table(df, goal, features, edges, key, valid))
    # the mean as a sum of whole units: the same for any partitioning
    units = F.sum(F.when(~F.col("valid"), F.round(F.col("y") / UNIT).cast("decimal(20,0)")))
    total, n = table.agg(units, F.count_if(~F.col("valid"))).first()
    model = Booster(list(features), edges, float(total) * UNIT / n if n else 0.0, rate, target=target)
    if not n:
        return model
    rng = np.random.default_rng(seed)
    best, pending = (np.inf, 0), []
    for number in range(trees):
        count = max(1, round(colsample * len(features)))
        used = sorted(rng.choice(len(features), count, replace=False).tolist())
        tree, loss = grow(table, model, pending, seed * 1_000_003 + number, leaves, l2, min_rows, subsample, used, batch)
        if loss is not None:
            model.losses.append(loss)
            if loss < best[0]:
                best = (loss, len(model.trees))
            elif patience is not None and len(model.trees) - best[1] >= patience:
                break
        if len(tree.left) == 1:
            break
        model.trees.append(tree)
        pending.append(tree)
        if len(pending) == rewrite and number + 1 < trees:
            table = cut_lineage(_fold_in(table, model, pending))
            pending = []
    if patience is not None and best[0] < np.inf:
        # the loss is known before each tree: that of the last one is not
        model.trees = model.trees[:best[1] or None] if len(model.trees) - best[1] >= patience else model.trees
    return model


def _fold_in(table: DataFrame, model: Booster, pending: list[Tree]) -> DataFrame:
    """The table with the pending trees' predictions added."""
    width, done = len(model.features), list(pending)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, _, _, pred, bins = _unpack(batch, width)
            yield batch.set_column(3, "pred", pa.array(pred + model.margin(bins, done)))

    return table.mapInArrow(run, table.schema)
