"""Language identification by multilingual mixture inference.

Every language has a smoothed distribution over hashed character trigrams.  A
document is a mixture of languages: expectation-maximisation over its trigram
counts estimates the proportions, and the set of languages is the one with the
best penalised likelihood (BIC: half the log of the number of trigrams per
language).  Sets are searched backwards from all languages.  A step drops the
smallest proportion, and with it all next larger ones as long as they hold no
more than ``NEGLIGIBLE`` of the text together; the rule is the same for any
number of languages.  As a mixture of all languages bounds every subset's
likelihood, most texts settle at one language after the first run.

The trigram counts come from a sample of about ``per_language`` documents of
each language (by hashed doc_id); every language is learned.  The model holds
only the trigrams seen of each language, as the others have their pooled share
times the language's rest.  Prediction is one map pass over whole texts.

Defined results: ``und`` and score 0 for null texts, texts without a letter,
and when nothing could be learned; documents without a lang are predicted but
not learned from; each input row gives one output row.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from countpanel.llm.common import materialize, ship, str_texts

BUCKETS = 1 << 14
SMOOTHING = 200.0  # pseudo-trigrams per language, spread as in the pooled sample
NOT_LETTERS = re.compile(r"[\W\d_]+")
LETTER = re.compile(r"[^\W\d_]")
ITERATIONS = 12
PIECE = 1 << 20  # characters counted at a time
NEGLIGIBLE = 0.02  # share of a text that languages dropped in one step may hold together


def trigram_counts(text: str) -> np.ndarray | None:
    """Counts of hashed trigrams of letters (runs of others as one space);
    None without a letter."""
    if not LETTER.search(text):
        return None
    counts = np.zeros(BUCKETS, np.int64)
    plain = " " + NOT_LETTERS.sub(" ", text.lower()).strip() + " "
    for lo in range(0, len(plain) - 2, PIECE):
        c = np.frombuffer(plain[lo:lo + PIECE + 2].encode("utf-32-le", "surrogatepass"), np.uint32)
        h = c[:-2] * np.uint32(0x9E3779B1) + c[1:-1] * np.uint32(0x85EBCA77) + c[2:] * np.uint32(0xC2B2AE3D)
        h ^= h >> np.uint32(15)
        counts += np.bincount((h * np.uint32(0x2C1B3C6D)) >> np.uint32(18), minlength=BUCKETS)
    return counts


def proportions(p: np.ndarray, c: np.ndarray, iterations: int = ITERATIONS) -> tuple[np.ndarray, float]:
    """(mixture weights, log-likelihood) of counts c under languages p."""
    if len(p) == 1:
        return np.ones(1), float(c @ np.log(p[0]))
    n = c.sum()
    w = np.full(len(p), 1 / len(p), p.dtype)
    for _ in range(iterations):
        w = w * (p @ (c / (w @ p))) / n
        w /= w.sum()
    return w, float(c @ np.log(w @ p))


class Shares(NamedTuple):
    """Trigram distributions of all languages: by bucket, the languages that
    have it and their shares; any other language has ``rest`` of ``pooled``."""

    rest: np.ndarray
    pooled: np.ndarray
    ends: np.ndarray
    lang: np.ndarray
    share: np.ndarray

    def of(self, seen: np.ndarray) -> np.ndarray:
        """Shares of these buckets, languages x buckets."""
        p = np.outer(self.rest, self.pooled[seen]).astype(np.float32)
        lo, hi = self.ends[seen], self.ends[seen + 1]
        size = hi - lo
        entry = np.arange(size.sum()) + np.repeat(lo - (np.cumsum(size) - size), size)
        p[self.lang[entry], np.repeat(np.arange(len(seen)), size)] = self.share[entry]
        return p

    def __eq__(self, other) -> np.ndarray:
        return np.array([np.array_equal(a, b) for a, b in zip(self, other)])

    __hash__ = None


def shares(counts: list[tuple[np.ndarray, np.ndarray]]) -> Shares:
    """Smoothed distributions from (buckets, counts) of each language."""
    total, n = np.zeros(BUCKETS), np.array([float(c.sum()) for _, c in counts])
    for at, c in counts:
        total[at] += c
    pooled = (total + 0.5) / (total.sum() + 0.5 * BUCKETS)
    at = np.concatenate([np.zeros(0, np.int32), *(a for a, _ in counts)])
    lang = np.repeat(np.arange(len(counts), dtype=np.int32), [len(a) for a, _ in counts])
    share = np.concatenate([np.zeros(0, np.float32), *(((c + SMOOTHING * pooled[a]) / (m + SMOOTHING)).astype(np.float32)
                                                       for (a, c), m in zip(counts, n))])
    order = np.argsort(at, kind="stable")
    ends = np.append(0, np.cumsum(np.bincount(at, minlength=BUCKETS)))
    return Shares(SMOOTHING / (n + SMOOTHING), pooled, ends, lang[order], share[order])


def infer(p: Shares, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(languages of the best penalised set, their proportions)."""
    seen = np.flatnonzero(counts)
    p = p.of(seen)
    c = counts[seen].astype(p.dtype)
    price = 0.5 * np.log(c.sum() + 1)
    langs = np.arange(len(p))
    w, fit = proportions(p, c)
    bound = fit
    best = (fit - price * len(langs), langs, w)
    alone = np.log(p) @ c
    top = int(np.argmax(alone))
    if alone[top] - price > best[0]:
        best = (float(alone[top]) - price, langs[[top]], np.ones(1))
    # a set of two or more is bounded by the full mixture's fit
    while len(langs) > 2 and bound - 2 * price > best[0]:
        ascending = np.argsort(w, kind="stable")
        gone = max(1, int((np.cumsum(w[ascending]) <= NEGLIGIBLE).sum()))
        keep = np.sort(ascending[min(gone, len(langs) - 2):])
        langs = langs[keep]
        w, fit = proportions(p[langs], c)
        if fit - price * len(langs) > best[0]:
            best = (fit - price * len(langs), langs, w)
    return best[1], best[2]


def _count_task():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(0).to_pylist()
            sums: dict[str, np.ndarray] = {}
            for i, content in str_texts(batch.column(1)):
                counts = trigram_counts(content)
                if counts is not None:
                    sums[langs[i]] = sums.get(langs[i], 0) + counts
            for lang, counts in sums.items():
                at = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int64()),
                                                  pa.array(counts[at])], ["lang", "bucket", "n"])

    return run


def fit(docs: DataFrame, may_learn: Callable[[Column], Column] | None = None,
        per_language: int = 1500) -> tuple[list[str], Shares]:
    """(languages, their trigram distributions) from text and lang of ``docs``."""
    usable = docs.select("doc_id", "text", "lang").where("lang is not null and text is not null and doc_id is not null")
    if may_learn is not None:
        usable = usable.where(may_learn(F.col("doc_id")))
    sizes = usable.groupBy("lang").agg(F.count("*").alias("n"))
    below = sizes.select(F.col("lang").alias("of"), (F.lit(per_language * (1 << 20)) / F.col("n")).alias("below"))
    deal = F.pmod(F.xxhash64("doc_id", F.lit("lang")), F.lit(1 << 20))
    sample = usable.join(F.broadcast(below), (F.col("lang") == F.col("of")) & (deal < F.col("below")))
    counted = materialize(sample.select("lang", "text").mapInArrow(_count_task(), "lang string, bucket long, n long")
                          .groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "language-counts")
    # languages x BUCKETS numbers at most, packed here a language at a time
    rows = counted.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("bucket", "n"))).alias("counts")).select(
        "lang", F.col("counts.bucket").alias("at"), F.col("counts.n").alias("n"))
    learned = sorted(((r["lang"], np.array(r["at"], np.int32), np.array(r["n"])) for r in rows.toLocalIterator()),
                     key=lambda x: x[0])
    return [x[0] for x in learned], shares([x[1:] for x in learned])


def identify(docs: DataFrame, model: tuple[list[str], Shares], text: str = "text") -> DataFrame:
    """(row: the input row, lang_pred, score: its proportion, languages: the
    set chosen, largest first) per input row."""
    names, p = model
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = batch.column(0)
            langs, scores, sets = [], [], []
            for _, content in str_texts(row.field(text)):
                counts = trigram_counts(content) if names else None
                if counts is None:
                    langs.append("und")
                    scores.append(0.0)
                    sets.append([])
                    continue
                chosen, w = infer(p, counts)
                order = np.argsort(-w, kind="stable")
                langs.append(names[chosen[order[0]]])
                scores.append(min(1.0, float(w[order[0]])))
                sets.append([names[k] for k in chosen[order]])
            yield pa.RecordBatch.from_arrays([row, pa.array(langs, pa.string()), pa.array(scores, pa.float64()),
                                              pa.array(sets, pa.list_(pa.string()))],
                                             ["row", "lang_pred", "score", "languages"])

    return rows.mapInArrow(run, T.StructType([
        rows.schema["row"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
        T.StructField("languages", T.ArrayType(T.StringType()))]))


ship(__name__)
