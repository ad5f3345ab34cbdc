"""Substring deduplication with difference-cover anchors.

Two equal stretches of ``window`` words can start anywhere in their texts.  A
difference cover D modulo P has, for any two starts i and j, a shift s < P
with both i + s and j + s in D (mod P).  So it is enough to hash the stretches
of ``window - P + 1`` words that start at positions in D modulo P: any two
equal windows share such an aligned anchor.  With P = 21 and |D| = 5, under a
quarter of the positions are hashed and shuffled.

1. Anchors: every block of documents (an Arrow batch) hashes its anchors.
   Anchors that repeat within the block are settled there; one row per hash
   and block goes to the shuffle, so a hash that stands in a third of all
   documents costs its group one row per block.
2. Extension: a window can only repeat if one of its |D| anchors does, so
   each repeated anchor is extended by up to P - 1 words to either side.  The
   windows so reached are hashed in full (64 + 32 bits), again settled within
   a block first, and counted.
3. Every word under a window that occurs twice or more is removed.

Windows are judged on the input.  The places found by each pass are written to
the shared folder; the pass's shuffle files then go, so the disk holds one
pass at a time.

Defined results: null text has no words; texts of fewer than ``window`` words
lose nothing; rows that repeat a doc_id are documents of their own (told apart
by the text's hash; rows equal in both are copies of each other); each input
row gives one output row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from countpanel.llm.common import byte_texts, materialize, ship

#: Perfect difference covers, period -> residues.
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16)}
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2^64
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
NO_PLACE = (1 << 30) - 1  # position of rows that only count


def cover_for(window: int) -> tuple[int, tuple[int, ...]]:
    """Largest period whose anchors keep over a third of the window."""
    period = max(p for p in COVERS if p == 1 or 3 * (window - p + 1) > window)
    return period, COVERS[period]


class Roller:
    """Hashes of all stretches of a word sequence, by prefix sums."""

    def __init__(self) -> None:
        self.power = np.ones(1, np.uint64)
        self.inverse = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        while len(self.power) <= n:
            step = np.uint64(pow(int(BASE), len(self.power), 1 << 64))
            back = np.uint64(pow(int(BASE_INVERSE), len(self.inverse), 1 << 64))
            self.power = np.concatenate([self.power, self.power * step])
            self.inverse = np.concatenate([self.inverse, self.inverse * back])

    def prefix(self, words: list[bytes]) -> np.ndarray:
        n = len(words)
        self.grow(n)
        codes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, n)
        return np.append(np.zeros(1, np.uint64), np.cumsum(codes * self.power[:n]))

    def stretches(self, prefix: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
        h = (prefix[at + size] - prefix[at]) * self.inverse[at]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(32))


def _settle(hashes: np.ndarray, extra: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of a block's hashes: (whether each repeats in the block, whether it is
    the first of a repeated hash)."""
    order = np.lexsort((extra, hashes)) if len(extra) else np.argsort(hashes, kind="stable")
    same = hashes[order][1:] == hashes[order][:-1]
    if len(extra):
        same &= extra[order][1:] == extra[order][:-1]
    again, first = np.zeros(len(hashes), bool), np.zeros(len(hashes), bool)
    again[order] = np.append(False, same) | np.append(same, False)
    first[order] = np.append(True, ~same)
    return again, again & first


def _block_rows(hashes: list[np.ndarray], extra: list[np.ndarray], doc: list[int], positions: list[np.ndarray],
                ids: pa.Array, text_hashes: pa.Array) -> pa.RecordBatch | None:
    """Rows (hash, doc_id, text_hash, tail) of one block, in document order
    (neighbours compress well); tail packs 32 more bits of hash, the position
    (-1 as all ones) and times.

    A hash that stands once: its place, times 1.  A repeated hash: one row
    without a place, times 2, for the other blocks; and its places under hashes
    of their own, times 2, as they are settled."""
    if not hashes:
        return None
    h = np.concatenate(hashes)
    if not len(h):
        return None
    e = np.concatenate(extra) if extra else np.zeros(len(h), np.uint64)
    owner = np.repeat(np.array(doc, np.int64), [len(x) for x in hashes])
    pos = np.concatenate(positions).astype(np.uint64)
    again, first = _settle(h, e if extra else e[:0])
    own = (h ^ (owner.astype(np.uint64) << np.uint64(33)) ^ pos) * np.uint64(0x94D049BB133111EB)
    key = np.where(again, own, h)
    tail = e << np.uint64(32) | pos << np.uint64(2) | np.where(again, np.uint64(2), np.uint64(1))
    spread = e[first] << np.uint64(32) | np.uint64(NO_PLACE << 2 | 2)
    n = int(first.sum())
    owners = pa.array(owner)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate([key, h[first]]).view(np.int64)),
         pa.concat_arrays([ids.take(owners), pa.nulls(n, pa.int64())]),
         pa.concat_arrays([text_hashes.take(owners), pa.nulls(n, pa.int64())]),
         pa.array(np.concatenate([tail, spread]).view(np.int64))],
        ["hash", "doc_id", "text_hash", "tail"])


ROWS = "hash long, doc_id long, text_hash long, tail long"


def _anchors(window: int, period: int, cover: tuple[int, ...]):
    """Task: (doc_id, text_hash, text) -> anchor rows."""
    size = window - period + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller = Roller()
        for batch in batches:
            hashes, doc, positions = [], [], []
            for i, raw in byte_texts(batch.column(2)):
                words = raw.split()
                if len(words) < window:
                    continue
                at = np.arange(len(words) - size + 1)
                at = at[np.isin(at % period, cover)]
                hashes.append(roller.stretches(roller.prefix(words), at, size))
                doc.append(i)
                positions.append(at)
            rows = _block_rows(hashes, [], doc, positions, batch.column(0), batch.column(1))
            if rows is not None:
                yield rows

    return run


def _windows(window: int, period: int):
    """Task: (doc_id, text_hash, text, anchor places that repeat) -> rows of
    the windows with an anchor that repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller = Roller()
        for batch in batches:
            places = batch.column(3)
            hashes, extra, doc, positions = [], [], [], []
            for i, raw in byte_texts(batch.column(2)):
                words = raw.split()
                n = len(words) - window + 1
                if n < 1:
                    continue
                hit = np.zeros(len(words) + 1, np.int32)
                hit[places[i].values.to_numpy()] = 1
                count = np.append(0, np.cumsum(hit))
                at = np.flatnonzero(count[period:period + n] > count[:n])
                if not len(at):
                    continue
                prefix = roller.prefix(words)
                hashes.append(roller.stretches(prefix, at, window))
                half = roller.stretches(prefix, at, window // 2 + 1)
                extra.append(half >> np.uint64(32))
                doc.append(i)
                positions.append(at)
            rows = _block_rows(hashes, extra, doc, positions, batch.column(0), batch.column(1))
            if rows is not None:
                yield rows

    return run


def _repeated(rows: DataFrame) -> DataFrame:
    """(doc_id, text_hash, places) of the rows whose hash occurs twice or more."""
    extra = F.shiftrightunsigned("tail", 32)
    place = F.shiftrightunsigned("tail", 2).bitwiseAND(F.lit(NO_PLACE)).cast("int")
    times = F.sum(F.col("tail").bitwiseAND(F.lit(3))).over(Window.partitionBy("hash", "extra"))
    return (rows.repartition("hash").withColumns({"extra": extra, "pos": place}).withColumn("total", times)
            .where((F.col("total") >= 2) & (F.col("pos") != NO_PLACE))
            .groupBy("doc_id", "text_hash").agg(F.collect_list("pos").alias("places")))


def _kept(window: int):
    """Task: documents with the places of their repeated windows -> kept words."""
    names = ["doc_id", "n_words", "n_removed", "kept_text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column(3)
            total, removed, kept = [], [], []
            for i, raw in byte_texts(batch.column(2)):
                words = raw.split()
                total.append(len(words))
                at = places[i].values
                if at is not None and len(at):
                    step = np.zeros(len(words) + 1, np.int64)
                    at = np.unique(at.to_numpy())
                    step[at] += 1
                    step[at + window] -= 1
                    gone = np.cumsum(step)[:-1] > 0
                    removed.append(int(gone.sum()))
                    words = [words[k] for k in np.flatnonzero(~gone)]
                else:
                    removed.append(0)
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string())], names)

    return run


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = 35) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text) of every row."""
    period, cover = cover_for(window)
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.xxhash64(F.col(f"`{text}`")).alias("text_hash"),
                       F.col(f"`{text}`").alias("text"))
    anchors = materialize(_repeated(rows.mapInArrow(_anchors(window, period, cover), ROWS)), "substring-anchors")

    def with_places(places: DataFrame, how: str) -> DataFrame:
        p = places.select(F.col("doc_id").alias("p_id"), F.col("text_hash").alias("p_hash"), "places")
        same = F.col("doc_id").eqNullSafe(F.col("p_id")) & (F.col("text_hash") == F.col("p_hash"))
        return rows.join(p, same, how).select("doc_id", "text_hash", "text", "places")

    windows = materialize(_repeated(with_places(anchors, "inner").mapInArrow(_windows(window, period), ROWS)),
                          "substring-windows")
    return with_places(windows, "left").mapInArrow(
        _kept(window), "doc_id long, n_words long, n_removed long, kept_text string")


ship(__name__)
