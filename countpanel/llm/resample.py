"""Target-distribution importance resampling.

Texts are bags of hashed n-grams: runs of 1 to ``max_n`` consecutive words,
each in the bucket crc32 modulo ``buckets``.  Two passes count the buckets of
the whole corpus and of the whole target; a bucket's gain is the smoothed
log-ratio of the two.  A document's weight is the mean gain of its features,
and Gumbel noise from a hash of its id turns "the highest scores" into a draw
without replacement in proportion to the weights' exponentials.

Features are taken batch by batch: the texts of a batch are joined with a
separator that no word holds, one pass of the pattern finds the words of all of
them, searchsorted over the document offsets tells whose word it is, n-grams
whose first and last word differ in that are masked, and bincount adds up.

The counting tasks emit one row per bucket and batch of their own; the two
arrays that scoring needs have ``buckets`` entries.  The order of the draw
comes from range partitions, so no task sees all scores.

Defined results: null and empty texts hold no word, hence no feature and weight
0; a null doc_id is hashed as an empty one and loses every tie; rows repeated
with one id get the same noise and, if their weights tie too, follow their
number of features; an empty target or corpus counts zero everywhere; every
input row gives one output row.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from countpanel.llm.common import blocks, materialize, ship
from countpanel.operators.windows import global_row_number

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
SEPARATOR = b"\n"
BATCH_BYTES = 4 << 20  # texts joined at once (one text at least)
CACHE = 1 << 18  # words whose bucket a task remembers


def bucket(feature: bytes, buckets: int) -> int:
    return zlib.crc32(feature) % buckets


def features(texts: list[bytes], max_n: int, buckets: int, known: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document of each feature, its bucket, words of each document) of a
    batch of texts."""
    joined = SEPARATOR.join(texts).translate(LOWER)
    begins = np.cumsum([0, *(len(t) + len(SEPARATOR) for t in texts[:-1])])
    found = list(WORD.finditer(joined))
    words = [m[0] for m in found]
    owner = np.searchsorted(begins, np.fromiter((m.start() for m in found), np.int64, len(found)), "right") - 1
    n_words = np.bincount(owner, minlength=len(texts))
    if len(known) > CACHE:
        known.clear()
    for word in set(words).difference(known):
        known[word] = bucket(word, buckets)
    whose, where = [owner], [np.fromiter(map(known.__getitem__, words), np.int64, len(words))]
    spaced = b" ".join(words) if max_n > 1 else b""
    ends = np.cumsum([len(w) + 1 for w in words]) - 1  # of each word among the spaced ones
    for n in range(2, max_n + 1):
        first = np.flatnonzero(owner[:len(owner) - n + 1] == owner[n - 1:])  # not across documents
        starts = np.append(0, ends + 1)
        where.append(np.fromiter((bucket(spaced[starts[i]:ends[i + n - 1]], buckets) for i in first.tolist()), np.int64, len(first)))
        whose.append(owner[first])
    return np.concatenate(whose), np.concatenate(where), n_words


def _batches(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    for lo, n in blocks(column, BATCH_BYTES):
        yield lo, [t or b"" for t in column.slice(lo, n).cast(pa.large_binary()).to_pylist()]


def counts(texts: DataFrame, text: str, max_n: int, buckets: int) -> np.ndarray:
    """Features per bucket over all rows.  Tasks add up their batches and send
    one row per bucket that they met; at most ``buckets`` rows come back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, known = np.zeros(buckets, np.int64), {}
        for batch in batches:
            for _, part in _batches(batch.column(0)):
                total += np.bincount(features(part, max_n, buckets, known)[1], minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int32()), pa.array(total[met])], ["bucket", "n"])

    per_task = texts.select(F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(run, "bucket int, n long")
    out = np.zeros(buckets, np.int64)
    for row in per_task.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln ratio) per bucket, one added to every count."""
    buckets, s_all, t_all = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + buckets) / ((s + 1) * (t_all + buckets))))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, text: str = "text", max_n: int = 1) -> DataFrame:
    """(row: the input row, n_words, n_features, weight) per input row."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    buckets = len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            row, done = batch.column(0), []
            for lo, part in _batches(pc.struct_field(row, text)):
                whose, where, n_words = features(part, max_n, buckets, known)
                n = np.bincount(whose, minlength=len(part))
                total = np.zeros(len(part), np.int64)
                np.add.at(total, whose, gain[where])
                done.append((n_words, n, np.where(n > 0, total // np.maximum(n, 1), 0)))
            columns = [pa.array(np.concatenate(x).astype(np.int64)) if done else pa.array([], pa.int64()) for x in (zip(*done) if done else [()] * 3)]
            yield pa.RecordBatch.from_arrays([row, *columns], ["row", "n_words", "n_features", "weight"])

    schema = T.StructType([rows.schema["row"], *(T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight"))])
    return rows.mapInArrow(run, schema)


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text: str = "text", target_text: str = "text", max_n: int = 1,
             buckets: int = 10_000, min_words: int = 20, share: tuple[int, int] = (10, 100), seed: int = 2024) -> DataFrame:
    """(``id_col``, n_features, weight, score, rank) of every row of ``docs``;
    rank is null for rows that are not drawn.  Of the N rows with at least
    ``min_words`` words, floor(N * share) are drawn."""
    gain = gains(counts(docs, text, max_n, buckets), counts(target, target_text, max_n, buckets))
    key = F.col("row").getField(id_col)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    wanted = docs.select(*[F.col(f"`{c}`") for c in (id_col, text)])
    scored = materialize(weigh(wanted, gain, text, max_n).select(
        key.alias("id"), "n_words", "n_features", "weight", (F.col("weight") + noise).alias("score")), "resample-scores")
    able = scored.where(F.col("n_words") >= min_words)
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("n_features")]
    drawn = able.count() * share[0] // share[1]
    placed = global_row_number(able, order)
    rank = F.when(F.col("rank") <= drawn, F.col("rank"))
    rest = scored.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    return placed.withColumn("rank", rank).unionByName(rest).select(F.col("id").alias(id_col), "n_features", "weight", "score", "rank")


ship(__name__)
