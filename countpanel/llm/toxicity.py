"""Toxicity by maximum-scoring segments of token log-odds.

Every word gets a log-odds score, toxic against clean documents, smoothed by
an informative Dirichlet prior (the pooled corpus).  A word that is itself too
rare takes the score of its longest significant prefix, so inflected and
compounded words count.  With a negative drift per word, a linear-time scan
(Ruzzo and Tompa) finds every maximal scoring segment: the toxic passages.

Segment scores S of a clean text of N words follow an extreme-value law,
P(max >= S) = 1 - exp(-K N exp(-lambda S)).  lambda solves
sum p0(s) exp(lambda s) = 1 over the word scores of clean documents and K fits
their best segments.  A document's evidence is the -log of its best segment's
expected count plus the log of the sum over all segments below one; a monotone
(isotonic) curve turns it into a probability, stretched so that the evidence
which divides the classes best (by F1) scores 0.3.  Law and curve are fitted on cross-fitted evidence: the
labelled documents are dealt into folds, and each fold is scored by log-odds
counted on the others, so no document calibrates scores that it has shaped.

The model is fitted on a bounded sample of labelled documents: those whose
hashed doc_id falls under a threshold chosen so that about ``max_train`` are
expected.  The scores of its significant features, whose number that sample
bounds, travel to the tasks.  Scoring is one map pass over whole texts, without
a shuffle.

Defined results: null and empty texts have no segment and get the score of a
document without evidence; a null doc_id is never a training row; repeated
label rows count as one (toxic if any says so); without labels of both classes
every score is 0; each input row gives one output row.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from countpanel.llm.common import materialize, ship, str_texts

WORD = re.compile(r"[^\W\d_]+")
#: Scripts written without spaces; there a word is one character.
UNSPACED = ("\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff"
            "\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff")
HAS_UNSPACED = re.compile(f"[{UNSPACED}]")
MIXED_WORD = re.compile(rf"(?=[{UNSPACED}])[^\W\d_]|[^\W\d_{UNSPACED}]+")
PREFIXES = (7, 6, 5, 4)
DRIFT = 0.25  # taken from every word's score, so that clean text scores below zero
PRIOR = 50.0  # pseudo-words of the Dirichlet prior, spread as in the pooled corpus,
FLAT = 0.5  # and as many for every feature, seen or not
BIN, LOW, BINS = 0.25, -6.0, 96  # histogram of word scores
CACHE = 400_000  # words whose score a task remembers
EVIDENCE_FLOOR = -6.0
FOLDS = 4  # of the cross-fitting
DECISION = 0.3  # score of the evidence that divides the classes best


def words_of(text: str) -> list[str]:
    text = text.lower()
    if text.isascii() or not HAS_UNSPACED.search(text):
        return WORD.findall(text)
    return MIXED_WORD.findall(text)


def features(word: str) -> list[str]:
    """The word and its prefixes, the most specific first."""
    return [word, *("^" + word[:k] for k in PREFIXES if len(word) > k)]


@dataclass
class Model:
    """Word scores, the extreme-value law and the calibration."""

    scores: dict[str, float] = field(default_factory=dict)
    lam: float = 1.0
    k: float = 1.0
    curve: tuple[np.ndarray, np.ndarray] | None = None  # evidence, probability
    cut: float = 0.0  # evidence from which a document counts as toxic

    def probability(self, best: np.ndarray, total: np.ndarray) -> np.ndarray:
        if self.curve is None:
            return np.zeros(len(best))
        t = best + np.log1p(total)
        # a fiftieth follows the evidence itself and orders what the curve holds equal
        p = 0.98 * np.interp(t, *self.curve) + 0.02 / (1 + np.exp(-t / 4))
        # stretched so that the evidence with the best F1 scores DECISION
        at = 0.98 * np.interp(self.cut, *self.curve) + 0.02 / (1 + np.exp(-self.cut / 4))
        return np.where(t < self.cut, DECISION * p / at, DECISION + (1 - DECISION) * (p - at) / max(1 - at, 1e-9))


def word_scores(words: list[str], scores: dict[str, float], cache: dict[str, float]) -> np.ndarray:
    """Score of each word: its own, else its longest scored prefix's, else 0."""
    out = list(map(cache.get, words))
    if None in out:
        for i, s in enumerate(out):
            if s is None:
                word = words[i]
                if word not in cache:
                    if len(cache) >= CACHE:
                        cache.clear()
                    cache[word] = next((scores[f] for f in features(word) if f in scores), 0.0)
                out[i] = cache[word]
    return np.array(out, np.float64)


def segments(score: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), in linear time."""
    total = np.append(0.0, np.cumsum(score))
    first, last, low, high, before = [], [], [], [], []  # the candidates, and each one's last with a lower start
    for i in np.flatnonzero(score > 0).tolist():
        a, b, lo, hi = i, i + 1, float(total[i]), float(total[i + 1])
        j = len(first) - 1
        while True:
            while j >= 0 and low[j] >= lo:
                j = before[j]
            if j < 0 or high[j] >= hi:
                break
            # grows to the left over candidate j, which then ends here
            a, lo = first[j], low[j]
            del first[j:], last[j:], low[j:], high[j:]
            nxt = before[j]
            del before[j:]
            j = nxt
        first.append(a)
        last.append(b)
        low.append(lo)
        high.append(hi)
        before.append(j)
    return [(a, b, hi - lo) for a, b, lo, hi in zip(first, last, low, high)]


def _count_task():
    """Task: (y, fold, text) -> (feature, part, n) of each batch; part is
    2 * fold + y."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [2 * f + y for y, f in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            counts: dict[int, Counter] = {}
            for i, content in str_texts(batch.column(2)):
                words = Counter(words_of(content))
                into = counts.setdefault(parts[i], Counter())
                into[""] += sum(words.values())  # the empty feature counts all words
                for word, n in words.items():
                    for f in features(word):
                        into[f] += n
            for part, into in counts.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(into), pa.string()), pa.array([part] * len(into), pa.int32()),
                     pa.array(list(into.values()), pa.int64())], ["feature", "part", "n"])

    return run


def count_features(sample: DataFrame, min_count: int) -> DataFrame:
    """(feature, p0, p1, ...): counts by part of ``sample`` (y, fold, text)."""
    parts = [F.sum(F.when(F.col("part") == k, F.col("n")).otherwise(0)).alias(f"p{k}") for k in range(2 * FOLDS)]
    counted = (sample.select("y", "fold", "text").mapInArrow(_count_task(), "feature string, part int, n long")
               .groupBy("feature").agg(*parts))
    total = sum((F.col(f"p{k}") for k in range(2 * FOLDS)), F.lit(0))
    return materialize(counted.where((total >= min_count) | (F.col("feature") == "")), "toxic-counts")


def fit_scores(counted: DataFrame, without: int | None, min_count: int, min_z: float) -> dict[str, float]:
    """Dirichlet-smoothed log-odds of the significant features, counted on all
    folds but ``without``."""
    of = lambda y: sum((F.col(f"p{2 * f + y}") for f in range(FOLDS) if f != without), F.lit(0))
    counted = counted.select("feature", of(0).alias("n0"), of(1).alias("n1")).where(
        (F.col("n0") + F.col("n1") >= min_count) | (F.col("feature") == ""))
    all_words = counted.where("feature = ''").first()
    if all_words is None or not all_words["n0"] or not all_words["n1"]:
        return {}
    t0, t1 = all_words["n0"], all_words["n1"]
    prior = F.lit(PRIOR) * (F.col("n0") + F.col("n1")) / (t0 + t1) + FLAT
    odds = [F.log((F.col(n) + prior) / (F.lit(t + PRIOR) - F.col(n) - prior)) for n, t in (("n1", t1), ("n0", t0))]
    scored = (counted.where("feature != ''")
              .withColumn("score", odds[0] - odds[1])
              .withColumn("z", F.col("score") / F.sqrt(1 / (F.col("n0") + prior) + 1 / (F.col("n1") + prior)))
              .where(F.abs("z") >= min_z))
    return {r["feature"]: float(r["score"]) for r in scored.select("feature", "score").collect()}


EVIDENCE = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("scores", T.ArrayType(T.DoubleType())),
                         T.StructField("bins", T.ArrayType(T.IntegerType()))])
PASSAGE = pa.struct([("first_word", pa.int32()), ("end_word", pa.int32()), ("score", pa.float64()),
                     ("expected", pa.float64())])


def _calibration_task(scores: list[dict[str, float]]):
    """Task: (y, fold, text) -> (y, n_words, segment scores, histogram of word
    scores); each fold is scored by its own table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        caches: list[dict[str, float]] = [{} for _ in scores]
        for batch in batches:
            folds = batch.column(1).to_pylist()
            n_words, found, bins = [], [], []
            for i, content in str_texts(batch.column(2)):
                s = word_scores(words_of(content), scores[folds[i]], caches[folds[i]]) - DRIFT
                n_words.append(len(s))
                found.append([x for _, _, x in segments(s)])
                at = np.clip(((s - LOW) / BIN).astype(int), 0, BINS - 1)
                bins.append(np.bincount(at, minlength=BINS).tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(found, pa.list_(pa.float64())),
                 pa.array(bins, pa.list_(pa.int32()))], ["y", "n_words", "scores", "bins"])

    return run


def evidence(found: list[float], n_words: int, lam: float, k: float) -> tuple[float, float]:
    """(-log expected count of the best segment, sum over segments expected
    less than once)."""
    if not len(found):
        return EVIDENCE_FLOOR, 0.0
    surprise = lam * np.asarray(found) - np.log(max(k * n_words, 1e-12))
    best = max(EVIDENCE_FLOOR, float(surprise.max()))
    return best, float(surprise[surprise > 0].sum())


def solve_lambda(counts: np.ndarray) -> float:
    """lambda > 0 with sum p(s) exp(lambda s) = 1 (1 if the scores allow none)."""
    s = LOW + BIN * (np.arange(BINS) + 0.5)
    p = counts / max(1, counts.sum())
    if not (p[s > 0] > 0).any() or (p * s).sum() >= 0:
        return 1.0
    lo, hi = 1e-4, 20.0
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (lo, mid) if (p * np.exp(mid * s)).sum() > 1 else (mid, hi)
    return lo


def isotonic(t: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(knots, probabilities) of the best non-decreasing curve through the
    labels by evidence (pooled adjacent violators; equal evidence is pooled
    first, every pool is drawn a little towards the base rate)."""
    knots, where = np.unique(t, return_inverse=True)
    n, ones = np.bincount(where).astype(float), np.bincount(where, weights=y)
    pools: list[list[float]] = []  # ones, rows, first and last knot
    for k in range(len(knots)):
        pools.append([ones[k], n[k], knots[k], knots[k]])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            o, m, _, last = pools.pop()
            pools[-1] = [pools[-1][0] + o, pools[-1][1] + m, pools[-1][2], last]
    base = float(y.mean())
    p = np.maximum.accumulate([(o + base) / (m + 1) for o, m, _, _ in pools])
    return (np.array([v for _, _, first, last in pools for v in (first, last)]), np.repeat(p, 2))


def best_cut(t: np.ndarray, y: np.ndarray) -> float:
    """The evidence from which on calling a document toxic has the best F1."""
    order = np.argsort(-t, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(t) + 1) + y.sum())
    f1[:-1][t[order][:-1] == t[order][1:]] = -1  # equal evidence stays together
    return float(t[order][int(np.argmax(f1))])


def fit(docs: DataFrame, labels: DataFrame, may_learn: Callable[[Column], Column] | None = None,
        max_train: int = 12_000, min_count: int = 3, min_z: float = 2.4) -> Model:
    """Model from ``labels`` (doc_id, toxic) and the texts of ``docs``;
    ``may_learn(doc_id)`` tells which rows may be learned from."""
    usable = labels.where("doc_id is not null and toxic is not null")
    if may_learn is not None:
        usable = usable.where(may_learn(F.col("doc_id")))
    usable = usable.groupBy("doc_id").agg(F.max(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("y"))
    n = usable.count()
    if n == 0:
        return Model()
    share = min(1.0, max_train / n)
    deal = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
    taken = usable.where(deal < F.lit(int(share * (1 << 20)))).select(F.col("doc_id").alias("__id"), "y")
    # about max_train pairs of numbers, whatever the input's size
    sample = docs.select("doc_id", "text").join(F.broadcast(taken), F.col("doc_id") == F.col("__id"))
    fold = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)).cast("int")
    sample = materialize(sample.select("y", fold.alias("fold"), "text"), "toxic-sample")
    counted = count_features(sample, min_count)
    scores = fit_scores(counted, None, min_count, min_z)
    if not scores:
        return Model()
    others = [fit_scores(counted, k, min_count, min_z) for k in range(FOLDS)]
    # a bounded number of rows: the sample's
    rows = sample.mapInArrow(_calibration_task(others), T.StructType(
        [T.StructField("y", T.IntegerType()), *EVIDENCE.fields])).collect()
    model = Model(scores)
    clean = [r for r in rows if r["y"] == 0 and r["n_words"]]
    if not clean or len(clean) == len(rows):
        return Model()
    model.lam = solve_lambda(np.sum([r["bins"] for r in clean], axis=0))
    tails = [r["n_words"] * np.exp(-model.lam * max(r["scores"])) if r["scores"] else r["n_words"] for r in clean]
    model.k = float(1 / np.mean(tails))
    x = np.array([evidence(r["scores"], r["n_words"], model.lam, model.k) for r in rows])
    x[:, 1] = np.log1p(x[:, 1])
    t, y = x[:, 0] + x[:, 1], np.array([r["y"] for r in rows], float)
    model.curve, model.cut = isotonic(t, y), best_cut(t, y)
    return model


def score(docs: DataFrame, model: Model, text: str = "text", max_expected: float = 0.05) -> DataFrame:
    """(row: the input row, score, passages) per input row: the passages are
    the segments that clean text would hold less than ``max_expected`` times."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, float] = {}
        for batch in batches:
            row = batch.column(0)
            x, passages = np.zeros((len(row), 2)), []
            for i, content in str_texts(row.field(text)):
                s = word_scores(words_of(content), model.scores, cache) - DRIFT
                found = segments(s)
                x[i] = evidence([v for _, _, v in found], len(s), model.lam, model.k)
                expected = [model.k * len(s) * float(np.exp(-model.lam * v)) for _, _, v in found]
                passages.append([{"first_word": a, "end_word": b, "score": v, "expected": e}
                                 for (a, b, v), e in zip(found, expected) if e < max_expected])
            yield pa.RecordBatch.from_arrays(
                [row, pa.array(model.probability(x[:, 0], x[:, 1])), pa.array(passages, pa.list_(PASSAGE))],
                ["row", "score", "passages"])

    schema = T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType()), T.StructField(
        "passages", T.ArrayType(T.StructType([
            T.StructField("first_word", T.IntegerType()), T.StructField("end_word", T.IntegerType()),
            T.StructField("score", T.DoubleType()), T.StructField("expected", T.DoubleType())])))])
    return rows.mapInArrow(run, schema)


ship(__name__)
