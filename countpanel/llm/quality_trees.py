"""Quality classifier: histogram gradient-boosted trees over document statistics.

One map pass turns a whole text into some thirty statistics (shares of
character classes, word lengths, repetition, lines, byte entropy).  Boosting
works on statistics cut into at most 255 bins at quantiles of the sample: every
leaf sums gradients and curvatures per (statistic, bin), the best split over all
leaves is taken next (best first), the sibling's histogram is the parent's less
the child's.  The finished trees are flattened into five arrays (statistic, cut,
left child, value, root of each tree), and a batch of documents walks all trees
at once: one numpy step per level moves every (document, tree) pair.

The model is fitted on a bounded sample of labelled documents: those whose
hashed doc_id falls under a threshold chosen so that about ``max_train`` are
expected.  Their statistics, a few dozen numbers each, are all that reaches the
driver.  Scoring is one map pass without a shuffle.

Defined results: null and empty texts have the statistics of an empty text and
get a score like any other; a null doc_id is never a training row; repeated
label rows count as one (good if any says so); rows without a label are not
learned from; with labels of one class only every score is that class, without
any label 0; each input row gives one output row.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from countpanel.llm.common import byte_texts, materialize, ship
from countpanel.llm.quality import repeat_words

BINS = 255
CLASSES = {  # bytes of each character class
    "upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "blank": b" \t\r\x0b\x0c", "newline": b"\n",
    "stop": b".,;:", "call": b"!?", "symbol": b"#*$%&|<>", "bracket": b"()[]{}", "quote": b"'\"`-_/\\@+=~^", "high": range(0x80, 0x100)}
CLASS_OF = np.full(256, len(CLASSES))
for _k, _bytes in enumerate(CLASSES.values()):
    CLASS_OF[list(_bytes)] = _k
STATS = [*(f"share_{c}" for c in CLASSES), "share_other", "log_bytes", "log_words", "entropy", "mean_word", "sd_word", "longest_word",
         "distinct_words", "top_word", "repeated_words", "capital_words", "shout_words", "symbol_words", "short_words", "log_lines",
         "dup_lines", "words_a_line", "end_stop", "distinct_new"]


def statistics(raw: bytes) -> list[float]:
    """The statistics of one text, in the order of STATS."""
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    size = max(1, len(raw))
    shares = np.bincount(CLASS_OF, weights=counts, minlength=len(CLASSES) + 1) / size
    p = counts[counts > 0] / size
    words = raw.split()
    numbers: dict[bytes, int] = {}
    codes = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    n, per_word = len(words), np.bincount(codes, minlength=1)
    distinct = list(numbers)
    lengths = np.array([len(w) for w in distinct] or [0])
    weights = per_word if n else np.array([1])
    mean = float((lengths * weights).sum() / weights.sum())

    def share(test: Callable[[bytes], bool]) -> float:
        return float(sum(c for w, c in zip(distinct, per_word.tolist()) if test(w)) / max(1, n))

    lines = [line for line in raw.split(b"\n") if line and not line.isspace()]
    repeated = sum(c - 1 for c in Counter(lines).values())
    return [*shares.tolist(), float(np.log1p(len(raw))), float(np.log1p(n)), float(-(p * np.log(p)).sum()), mean,
            float(np.sqrt((weights * (lengths - mean) ** 2).sum() / weights.sum())), float(lengths.max()), len(distinct) / max(1, n),
            float(per_word.max() / max(1, n)), repeat_words(codes) / max(1, n), share(lambda w: w[:1].isupper()),
            share(lambda w: len(w) > 1 and w.isupper()), share(lambda w: w[-1] in b"#*$%&|<>!" or w[0] in b"#*$%&|<>!"),
            share(lambda w: len(w) == 1), float(np.log1p(len(lines))), repeated / max(1, len(lines)), n / max(1, len(lines)),
            sum(line.rstrip()[-1:] in (b".", b"!", b"?") for line in lines) / max(1, len(lines)),
            len(distinct) / max(1.0, n ** 0.8)]


@dataclass
class Trees:
    """All trees in one row of arrays; a leaf's left child is itself."""

    edges: list[np.ndarray]  # per statistic: upper edges of its bins but the last
    stat: np.ndarray
    cut: np.ndarray  # goes right if the bin is above
    left: np.ndarray  # the right child stands next to the left one
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(self.edges)], 1).astype(np.int16)

    def margin(self, bins: np.ndarray) -> np.ndarray:
        """Log-odds of binned rows: every (row, tree) pair takes a step a level."""
        at = np.broadcast_to(self.roots, (len(bins), len(self.roots))).copy()
        rows = np.arange(len(bins))[:, None]
        for _ in range(self.depth):
            left = self.left[at]
            at = np.where(left == at, at, left + (bins[rows, self.stat[at]] > self.cut[at]))
        return self.base + self.value[at].sum(1)

    def probability(self, x: np.ndarray) -> np.ndarray:
        if not len(self.roots):
            return np.full(len(x), self.base)
        return 1 / (1 + np.exp(-self.margin(self.bins(x))))


def constant(probability: float) -> Trees:
    none = np.zeros(0, np.int32)
    return Trees([], none, none, none, np.zeros(0), none, 0, probability)


def grow(bins: np.ndarray, grad: np.ndarray, hess: np.ndarray, leaves: int, min_rows: int, l2: float) -> tuple[list[list[float]], np.ndarray]:
    """One tree, best split first: its nodes [stat, cut, left, value] and each
    row's leaf value."""
    m = bins.shape[1]
    flat = bins + np.arange(m) * BINS

    def histogram(rows: np.ndarray) -> np.ndarray:
        at = flat[rows].ravel()
        return np.stack([np.bincount(at, np.repeat(v[rows], m), m * BINS).reshape(m, BINS) for v in (grad, hess, np.ones(len(grad)))])

    def best(h: np.ndarray) -> tuple[float, int, int]:
        g, c, n = np.cumsum(h, 2)[:, :, :-1]
        gt, ct, nt = h[:, :1].sum(2)
        gain = g ** 2 / (c + l2) + (gt - g) ** 2 / (ct - c + l2) - gt ** 2 / (ct + l2)
        gain = np.where((n >= min_rows) & (nt - n >= min_rows), gain, -np.inf)
        k = int(np.argmax(gain))
        return float(gain.flat[k]), *divmod(k, BINS - 1)

    nodes, value = [[0, 0, 0, 0.0]], np.zeros(len(bins))
    rows = np.arange(len(bins))
    h = histogram(rows)
    open_leaves = [(best(h), 0, rows, h)]
    for _ in range(leaves - 1):
        k = max(range(len(open_leaves)), key=lambda i: open_leaves[i][0][0])
        (gain, stat, cut), node, rows, h = open_leaves[k]
        if not gain > 1e-9:
            break
        del open_leaves[k]
        right = bins[rows, stat] > cut
        small_right = right.sum() * 2 < len(rows)
        small = histogram(rows[right] if small_right else rows[~right])
        parts = (h - small, small) if small_right else (small, h - small)
        nodes[node][:3] = [stat, cut, len(nodes)]
        for side, part in zip((~right, right), parts):
            open_leaves.append((best(part), len(nodes), rows[side], part))
            nodes.append([0, 0, len(nodes), 0.0])
    for _, node, rows, h in open_leaves:
        g, c, _ = h[:, 0].sum(1)
        nodes[node][2], nodes[node][3] = node, float(-g / (c + l2))
        value[rows] = nodes[node][3]
    return nodes, value


def train(x: np.ndarray, y: np.ndarray, trees: int = 80, leaves: int = 12, rate: float = 0.1, min_rows: int = 20, l2: float = 1.0) -> Trees:
    """Boosted trees for labels ``y`` (0 or 1) of the rows of ``x``."""
    if not len(y) or y.min() == y.max():
        return constant(float(y[0]) if len(y) else 0.0)
    edges = []
    for column in x.T:
        distinct = np.unique(column)
        if len(distinct) > BINS:
            distinct = np.unique(np.quantile(column, np.arange(1, BINS + 1) / BINS, method="higher"))
        edges.append((distinct[:-1] + distinct[1:]) / 2)
    model = Trees(edges, *(np.zeros(0, np.int32),) * 3, np.zeros(0), np.zeros(0, np.int32), 0, float(np.log(y.mean() / (1 - y.mean()))))
    bins = model.bins(x)
    margin, nodes, roots = np.full(len(y), model.base), [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        tree, value = grow(bins, p - y, p * (1 - p), leaves, min_rows, l2)
        margin += rate * value
        roots.append(len(nodes))
        nodes += [[s, c, at + roots[-1], rate * v] for s, c, at, v in tree]
    stat, cut, left, value = (np.array(a) for a in zip(*nodes))
    # children stand after their parent: a level more than the parent's
    level = np.zeros(len(nodes), int)
    for i, at in enumerate(left.tolist()):
        if at != i:
            level[at:at + 2] = level[i] + 1
    model.stat, model.cut, model.left = stat.astype(np.int32), cut.astype(np.int16), left.astype(np.int32)
    model.value, model.roots, model.depth = value.astype(float), np.array(roots, np.int32), int(level.max())
    return model


def fit(docs: DataFrame, labels: DataFrame, may_learn: Callable[[Column], Column] | None = None, max_train: int = 12_000,
        text: str = "text", label: str = "quality", **options) -> Trees:
    """Trees from ``labels`` (doc_id, ``label``) and the texts of ``docs``;
    ``may_learn(doc_id)`` tells which rows may be learned from."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    if may_learn is not None:
        usable = usable.where(may_learn(F.col("doc_id")))
    usable = usable.groupBy("doc_id").agg(F.max(F.when(F.col(label) > 0, 1).otherwise(0)).alias("y"))
    n = usable.count()
    if n == 0:
        return constant(0.0)
    deal = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
    taken = usable.where(deal < F.lit(int(min(1.0, max_train / n) * (1 << 20)))).select(F.col("doc_id").alias("__id"), "y")
    # about max_train pairs of numbers, whatever the input's size
    rows = docs.select("doc_id", F.col(f"`{text}`").alias("text")).join(F.broadcast(taken), F.col("doc_id") == F.col("__id"))
    measured = materialize(measure(rows.select("doc_id", "y", "text")).select("row.doc_id", "row.y", "stats"), "quality-sample")
    # rows that share an id share a label: no more than max_train of them are learned from
    sample = measured.orderBy(F.xxhash64("doc_id", "stats")).limit(max_train).collect()
    sample.sort(key=lambda r: (r["doc_id"], r["stats"]))
    return train(np.array([r["stats"] for r in sample], float).reshape(-1, len(STATS)), np.array([r["y"] for r in sample], float), **options)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """(row: the input row, stats) per input row."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = batch.column(0)
            found = [statistics(raw) for _, raw in byte_texts(row.field(text))]
            yield pa.RecordBatch.from_arrays([row, pa.array(found, pa.list_(pa.float64()))], ["row", "stats"])

    return rows.mapInArrow(run, T.StructType([rows.schema["row"], T.StructField("stats", T.ArrayType(T.DoubleType()))]))


def score(docs: DataFrame, model: Trees, text: str = "text") -> DataFrame:
    """(row: the input row, score) per input row."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = batch.column(0)
            x = np.array([statistics(raw) for _, raw in byte_texts(row.field(text))], float).reshape(-1, len(STATS))
            yield pa.RecordBatch.from_arrays([row, pa.array(model.probability(x))], ["row", "score"])

    return rows.mapInArrow(run, T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType())]))


ship(__name__)
