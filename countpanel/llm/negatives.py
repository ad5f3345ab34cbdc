"""Hard-negative mining by a vertical scan of vector columns (BOND).

Components become integers, floor(scale * x).  Every batch of rows is held by
columns: one contiguous array per dimension with its smallest and largest
value.  An anchor reads the dimensions in descending magnitude of its own
components.  After each few dimensions a row's final score lies between its
partial score plus the least and plus the most that the unread dimensions can
still contribute; rows whose range misses what is asked for leave the
candidate bitmap, and the scan goes on with what is left until scores are exact.

Two scans over all rows: the first finds each anchor's best rows of the same
label (positives), the second the best rows of other labels inside each
positive's score window.  A task carries the best rows found so far from batch
to batch, which raises the bar for later ones, and emits no more than these;
a limited window merges the tasks.  Anchors, a stated share of the rows, are
taken in blocks of ``block`` with a pass over the rows each, so a task holds
one block of anchors and one batch of rows whatever the input's size.

Defined results: rows with a null id, label or vector, or with a null or
non-finite component, take no part; a shorter vector counts as padded with
zeros, an empty one is all zeros; integers saturate at the limits of long, and
so do scores; a row with the anchor's own id is never its positive or negative;
otherwise repeated rows each take part, and ties of score and id are equal in
every column; of anchors that share an id, the one with the smallest label,
then vector, is taken; an anchor without positives, or a positive without
negatives, gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from countpanel.llm.common import materialize, ship
from countpanel.operators.windows import global_row_number

STEP = 8  # dimensions read between two looks at the bitmap
FEW = 64  # candidates so few that they are simply finished
LONG = 2 ** 63 - 1


def quantize(rows: DataFrame, id_col: str, vector: str, label: str, scale: float) -> DataFrame:
    """(id, label, v): the rows that take part, with integer vectors."""
    x = F.transform(F.col(f"`{vector}`"), lambda c: c.cast("double"))
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    d = rows.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label}`").alias("label"), x.alias("x"), finite.alias("ok"))
    return d.where("id is not null and label is not null and x is not null and ok").select(
        "id", "label", F.transform("x", lambda c: F.floor(F.lit(float(scale)) * c)).alias("v"))


def matrix(column: pa.Array) -> np.ndarray:
    """Dimensions x rows of a list column, shorter rows padded with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    wide = int(sizes.max(initial=0))
    if len(sizes) and (sizes == wide).all():
        return np.ascontiguousarray(flat.reshape(len(sizes), wide).T)
    out = np.zeros((len(sizes), wide), np.int64)
    out[np.arange(wide) < sizes[:, None]] = flat
    return np.ascontiguousarray(out.T)


def held(x: np.ndarray) -> np.ndarray:
    """Scores within the limits of long (only Python integers can leave them)."""
    return np.maximum(np.minimum(x, LONG), -LONG - 1) if x.dtype == object else x


def exact(limit: int) -> type:
    """A number type in which sums up to ``limit`` are exact."""
    return np.float64 if limit < 2 ** 53 else np.int64 if limit < 2 ** 63 else object


class Columns:
    """One batch of rows by dimension."""

    def __init__(self, columns: np.ndarray):
        self.columns = columns
        self.least = columns.min(1) if columns.size else np.zeros(len(columns), np.int64)
        self.most = columns.max(1) if columns.size else np.zeros(len(columns), np.int64)
        self.typed: dict[type, np.ndarray] = {}

    def of(self, kind: type) -> np.ndarray:
        if kind not in self.typed:
            self.typed[kind] = self.columns.astype(kind)
        return self.typed[kind]

    def scan(self, anchor: np.ndarray, rows: np.ndarray, narrow) -> tuple[np.ndarray, np.ndarray]:
        """(rows left, their exact scores): ``narrow(low, high)`` tells which
        rows stay, given the range of every row's score."""
        d = min(len(anchor), len(self.columns))
        a = anchor[:d]
        order = np.argsort(-np.abs(a.astype(np.float64)), kind="stable")
        order = order[a[order] != 0]
        reach = sum(abs(int(a[j])) * max(abs(int(self.least[j])), abs(int(self.most[j]))) for j in order)
        kind = exact(reach)
        a, data = a.astype(kind), self.of(kind)
        ends = np.stack([a[order] * self.least[order].astype(kind), a[order] * self.most[order].astype(kind)])
        low, high = (np.append(np.cumsum(e[::-1])[::-1], kind(0) if kind is not object else 0) for e in (ends.min(0), ends.max(0)))
        partial = np.zeros(len(rows), kind)
        for k in range(0, len(order), STEP):
            part = order[k:k + STEP]
            if 2 * len(rows) > data.shape[1]:
                partial = partial + (a[part] @ data[part])[rows]
            else:
                partial = partial + a[part] @ data[np.ix_(part, rows)]
            left = min(k + STEP, len(order))
            if left < len(order) and len(rows) > FEW:
                stay = narrow(held(partial + low[left]), held(partial + high[left]))
                if stay.sum() < 0.9 * len(rows):
                    rows, partial = rows[stay], partial[stay]
        partial = held(partial)
        stay = narrow(partial, partial)
        return rows[stay], partial[stay]


class Best:
    """The first ``k`` (score, id) found so far, higher scores and then
    smaller ids first."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, [], []

    @property
    def bar(self):
        """Score below which no row can enter."""
        return self.scores[-1] if len(self.scores) == self.k else None

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(scores) > self.k:
            stay = np.flatnonzero(scores >= _kth(scores, self.k))  # with all ties of the k-th
            stay = stay[np.lexsort((ids[stay], -scores[stay]))[:self.k]]
            scores, ids = scores[stay], ids[stay]
        found = [*zip(self.scores, self.ids), *zip(map(int, scores.tolist()), ids.tolist())]
        found.sort(key=lambda f: (-f[0], f[1]))
        self.scores, self.ids = map(list, zip(*found[:self.k])) if found else ([], [])


def _kth(values: np.ndarray, k: int):
    return np.partition(values, len(values) - k)[len(values) - k] if values.dtype != object else sorted(values)[-k]


def _positives(columns: Columns, ids: np.ndarray, asked: np.ndarray, anchor: dict, best: Best) -> None:
    def narrow(low, high):
        bar = best.bar
        if len(low) >= best.k:
            sure = _kth(low, best.k)
            bar = sure if bar is None else max(bar, sure)
        return np.ones(len(low), bool) if bar is None else np.asarray(high >= bar, bool)

    rows = np.flatnonzero(asked & (ids != anchor["id"]))
    if len(rows):
        rows, scores = columns.scan(anchor["v"], rows, narrow)
        best.add(scores, ids[rows])


def _negatives(columns: Columns, ids: np.ndarray, asked: np.ndarray, anchor: dict, best: list[Best]) -> None:
    windows = anchor["windows"]

    def bars(low, high):
        for (least, most), found in zip(windows, best):
            bar = least if found.bar is None else max(least, found.bar)
            sure = low[np.asarray((low >= bar) & (high <= most), bool)]
            yield (max(bar, _kth(sure, found.k)) if len(sure) >= found.k else bar), most

    def narrow(low, high):
        return reduce(np.logical_or, (np.asarray((high >= bar) & (low <= most), bool) for bar, most in bars(low, high)), np.zeros(len(low), bool))

    rows = np.flatnonzero(asked & (ids != anchor["id"]))
    if len(rows) and windows:
        rows, scores = columns.scan(anchor["v"], rows, narrow)
        for (least, most), found in zip(windows, best):
            inside = np.asarray((scores >= least) & (scores <= most), bool)
            found.add(scores[inside], ids[rows[inside]])


def _scan_task(anchors: list[dict], k: int, negatives: bool):
    """Task: rows (id, label, v) -> the best (anchor, slot, score, found) of
    all its batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [[Best(k) for _ in (a["windows"] if negatives else (0,))] for a in anchors]
        for batch in batches:
            columns = Columns(matrix(batch.column(2)))
            ids, coded = batch.column(0).to_numpy(), batch.column(1).dictionary_encode()
            labels, code = coded.indices.to_numpy(), {v: i for i, v in enumerate(coded.dictionary.to_pylist())}
            for anchor, found in zip(anchors, best):
                own = labels == code.get(anchor["label"], -1)
                if negatives:
                    _negatives(columns, ids, ~own, anchor, found)
                else:
                    _positives(columns, ids, own, anchor, found[0])
        out = [(i, slot, s, r) for i, found in enumerate(best) for slot, b in enumerate(found) for s, r in zip(b.scores, b.ids)]
        yield pa.RecordBatch.from_arrays([pa.array([o[j] for o in out], t) for j, t in enumerate((pa.int32(), pa.int32(), pa.int64(), pa.int64()))],
                                         ["anchor", "slot", "score", "found"])

    return run


def first_of(rows: DataFrame, anchors: list[dict], k: int, negatives: bool) -> DataFrame:
    """The first ``k`` rows of every (anchor, slot) with their place from 1."""
    found = rows.mapInArrow(_scan_task(anchors, k, negatives), "anchor int, slot int, score long, found long")
    place = F.row_number().over(Window.partitionBy("anchor", "slot").orderBy(F.col("score").desc(), "found"))
    return found.withColumn("place", place).where(F.col("place") <= k)


def mine(vectors: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector: str = "embedding", label: str = "label", scale: float = 256.0,
         positives: int = 5, negatives: int = 5, window: tuple[int, int] = (80, 100), block: int = 2048) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score): of each anchor (``is_anchor``, over a column ``id``) and
    each of its first ``positives`` rows of the same label, the first
    ``negatives`` rows of other labels whose score is at least window[0] and at
    most window[1] per cent of the positive's.  Ids are whole numbers."""
    spark = vectors.sparkSession
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # every anchor meets every row: the work, not the bytes, asks for many tasks
    whole = quantize(vectors, id_col, vector, label, scale)
    rows = materialize(whole.select(F.col("id").cast("long"), F.col("label").cast("string"), "v").repartition(spread), "vectors")
    asked = rows.where(is_anchor).groupBy("id").agg(F.min(F.struct("label", "v")).alias("a")).select("id", "a.*")
    asked = materialize(global_row_number(asked, [F.col("id")]), "anchors")
    n = asked.count()
    parts = []
    for lo in range(0, n, block):
        anchors = [{"id": r["id"], "label": r["label"], "v": np.array(r["v"], np.int64), "windows": []} for r in
                   asked.where((F.col("rank") > lo) & (F.col("rank") <= lo + block)).orderBy("rank").collect()]
        near: list[list] = [[] for _ in anchors]
        for r in first_of(rows, anchors, positives, False).collect():  # at most ``positives`` of each anchor
            near[r["anchor"]].append((r["place"], r["score"], r["found"]))
        names = []
        for i, (anchor, found) in enumerate(zip(anchors, near)):
            for _, s, r in sorted(found):
                # per cents of a negative score leave no whole number between them
                least, most = -((-window[0] * s) // 100), (window[1] * s) // 100
                if least <= most:
                    names.append((i, len(anchor["windows"]), anchor["id"], r, s))
                    anchor["windows"].append((least, most))
        if not names:
            continue
        of = spark.createDataFrame(names, "anchor int, slot int, anchor_id long, positive_id long, positive_score long")
        found = first_of(rows, anchors, negatives, True).join(F.broadcast(of), ["anchor", "slot"])
        parts.append(materialize(found.select("anchor_id", "positive_id", F.col("place").alias("rank"), F.col("found").alias("negative_id"),
                                              "positive_score", F.col("score").alias("negative_score")), "negatives"))
    if not parts:
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, parts)


ship(__name__)
