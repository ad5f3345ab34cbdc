"""Benchmark decontamination by spaced-seed hashing.

A seed mask samples five words out of a short span and ignores the words
between, so a substitution at an ignored place does not lose the hit.  The
masked hashes of the benchmark items are joined with those of every position
of every document; around each hit the two word sequences are laid on the same
diagonal, and the longest stretch in which at least ``identity`` of the words
agree is taken.  A document leaks an item if that stretch has ``min_words``
words (or covers the whole item, if that is shorter).  Where an item is so
short that some allowed substitutions hit no mask, every such pattern gets a
mask of its own over the whole item; under five words that is the item itself.

A word is a run of letters and digits, or one character of a script written
without spaces (Han, Kana, Thai, Lao, Khmer, Burmese, ...).

Neither side passes the driver.  Only two things of fixed size do: which item
lengths occur among the short ones, and a bitmap of the items' hashes, with
which a document's task drops the positions that no item can share.  What is
left is joined on the hash.  Hashes are salted by the text, so a passage of a
third of all texts is spread; equal texts count once; of hits that follow one
another on a diagonal, only the first leaves the join.  Texts with hits are then
read again, each with parts of at most about ``PART`` items, and verified.

Defined results: null and empty texts leak nothing, nor do items without a
word; repeated items are reported by their own
item_id each (null if it is null), equal (item_id, text) rows once; every
input row of the documents gives one output row, extra columns stay inside ``row``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from countpanel.llm.common import materialize, ship, str_texts

#: Word offsets that each mask samples (five words); the rest is ignored.
MASKS = ((0, 1, 2, 3, 4), (0, 1, 3, 5, 6), (0, 1, 2, 5, 6), (0, 2, 3, 6, 8))
MAX_MASK = 13  # items of up to so many words are to be found whole
TOKENS_AT_ONCE = 1 << 17
CACHE = 1 << 16  # words whose code a task remembers
FILTER_BITS = 25  # of the bitmap of the items' hashes (4 MB)
SALTS = 8  # a hash's texts are dealt to so many groups
PART = 512  # items that a text is verified against at once
WORD = re.compile(r"\w+")
#: Scripts written without spaces between words.
UNSPACED = ("\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u1950-\u19df\u1a20-\u1aaf\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff"
            "\u3400-\u4dbf\u4e00-\u9fff\ua980-\ua9ff\uaa60-\uaa7f\uf900-\ufaff\uff66-\uff9f"
            "\U0001b000-\U0001b16f\U00020000-\U0003ffff")
HAS_UNSPACED = re.compile(f"[{UNSPACED}]")
MIXED_WORD = re.compile(rf"(?=[{UNSPACED}])\w|[^\W{UNSPACED}]+")
HIT = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("first_word", T.IntegerType()),
                    T.StructField("n_words", T.IntegerType()), T.StructField("n_equal", T.IntegerType()),
                    T.StructField("item_words", T.IntegerType())])
ARROW_HIT = pa.struct([("item_id", pa.int64()), ("first_word", pa.int32()), ("n_words", pa.int32()),
                       ("n_equal", pa.int32()), ("item_words", pa.int32())])


def words_of(text: str) -> list[str]:
    text = text.lower()
    if text.isascii() or not HAS_UNSPACED.search(text):
        return WORD.findall(text)
    return MIXED_WORD.findall(text)


def whole_masks(n: int, identity: float, masks=MASKS) -> list[tuple[int, ...]]:
    """Masks over whole items of ``n`` words, one for each pattern of as many
    substitutions as ``identity`` allows that no place of ``masks`` avoids."""
    placed = [{p + offset for offset in mask} for mask in masks for p in range(n - mask[-1])]
    patterns = combinations(range(n), min(n - 1, int(n * (1 - identity) + 1e-9)))
    return [tuple(k for k in range(n) if k not in lost) for lost in patterns
            if all(not place.isdisjoint(lost) for place in placed)]


class Seeds:
    """The masks in use and their hashes; equal for items and documents."""

    def __init__(self, short: list[int], identity: float = 0.8, masks=MASKS):
        self.general = len(masks)
        self.whole = {n: whole_masks(n, identity, masks) for n in sorted(short)}
        self.masks = list(dict.fromkeys([*masks, *(m for own in self.whole.values() for m in own)]))
        self.number = {m: k for k, m in enumerate(self.masks)}
        self.gap = max(m[-1] for m in self.masks) + 1
        # of items that are only found whole and unchanged, one place per document is enough
        loose = {m for n, own in self.whole.items() for m in own if int(n * (1 - identity) + 1e-9)}
        self.once = [k >= len(masks) and m not in loose for k, m in enumerate(self.masks)]
        rng = np.random.default_rng(1)
        self.weights = [rng.integers(1, 1 << 62, len(m), dtype=np.uint64) * np.uint64(2) + np.uint64(1) for m in self.masks]
        self.codes: dict[str, int] = {}

    def tokens(self, words: list[str]) -> np.ndarray:
        """Codes of the words, never 0."""
        codes = self.codes
        if len(codes) > CACHE:
            codes.clear()
        for word in set(words).difference(codes):
            codes[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "replace")) | 1
        return np.fromiter(map(codes.__getitem__, words), np.uint64, len(words))

    def hashes(self, tokens: np.ndarray, mask: int) -> np.ndarray:
        """Hash of one mask at every start where it fits."""
        n = max(0, len(tokens) - self.masks[mask][-1])
        h = np.zeros(n, np.uint64)
        for offset, weight in zip(self.masks[mask], self.weights[mask]):
            h += tokens[offset:offset + n] * weight
            h ^= h >> np.uint64(31)
        return h * np.uint64(0x9E3779B97F4A7C15)

    def of_item(self, tokens: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(mask, hashes by place) of an item."""
        for m in range(self.general):
            yield m, self.hashes(tokens, m)
        for mask in self.whole.get(len(tokens), ()):
            if self.number[mask] >= self.general:  # hashed already if among the others
                yield self.number[mask], self.hashes(tokens, self.number[mask])[:1]


def bit_of(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def before_of(h: np.ndarray) -> np.ndarray:
    """The hash one place earlier (0 at the first)."""
    return np.append(np.zeros(min(1, len(h)), np.uint64), h[:-1])


def longest_stretch(equal: np.ndarray, identity: float) -> tuple[int, int]:
    """(start, length) of the longest stretch with at least this share of True."""
    score = np.append(0, np.cumsum(np.where(equal, 1 - identity, -identity)))
    low = np.minimum.accumulate(score)
    start = np.searchsorted(-low, -(score + 1e-9), side="left")
    length = np.arange(len(score)) - start
    end = int(np.argmax(length))
    return int(start[end]), int(length[end])


def best_leak(tokens: np.ndarray, own: np.ndarray, diagonals: list[int], min_words: int, identity: float) -> tuple[int, int, int] | None:
    """(first word, words, equal words) of the item's best stretch over its
    diagonals in a text, the first among equals; None if none is long enough."""
    best = None
    for offset in sorted(diagonals):
        lo, hi = max(0, -offset), min(len(own), len(tokens) - offset)
        equal = tokens[lo + offset:hi + offset] == own[lo:hi]
        start, length = longest_stretch(equal, identity)
        n_equal = int(equal[start:start + length].sum())
        if length >= min(min_words, len(own)) and (best is None or n_equal > best[2]):
            best = (lo + offset + start, length, n_equal)
    return best


def _item_task(seeds: Seeds | None):
    """Task: (item, text) -> its number of words and codes, or (h, before,
    item, place) of all its seeds."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coder = Seeds([])
            codes = [coder.tokens(words_of(t)) for _, t in str_texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(c) for c in codes], pa.int32()),
                                              pa.array([c.tobytes() for c in codes], pa.binary())], ["item", "n_words", "codes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, raw in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                for _, h in seeds.of_item(np.frombuffer(raw, np.uint64)):
                    if len(h):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(h.view(np.int64)), pa.array(before_of(h).view(np.int64)), pa.array(np.full(len(h), item)),
                             pa.array(np.arange(len(h), dtype=np.int32)), pa.array(bit_of(h) + 1)], ["h", "before", "item", "place", "bit"])

    return words if seeds is None else run


def _text_task(seeds: Seeds, bits: np.ndarray):
    """Task: (k1, k2, text) -> (h, before, k1, k2, place) of the places whose
    hash may be an item's."""

    def found(tokens: np.ndarray, starts: np.ndarray, known: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        for m in range(len(seeds.masks)):
            h = seeds.hashes(tokens, m)
            span = seeds.masks[m][-1]
            bit = bit_of(h)
            may = (bits[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 > 0
            at = np.flatnonzero(may & known[:len(h)] & known[span:span + len(h)])
            doc = np.searchsorted(starts, at, "right") - 1
            if span:  # both ends known, and no end of text between
                inside = np.searchsorted(starts, at + span, "right") - 1 == doc
                at, doc = at[inside], doc[inside]
            if seeds.once[m] and len(at):
                first = np.unique(np.stack([doc.astype(np.uint64), h[at]]), axis=1, return_index=True)[1]
                at, doc = at[first], doc[first]
            before = np.where(at > starts[doc], h[np.maximum(at - 1, 0)], np.uint64(0))
            yield h[at], before if not seeds.once[m] else np.zeros(len(at), np.uint64), doc, at - starts[doc]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gap = np.zeros(seeds.gap, np.uint64)
        for batch in batches:
            parts, starts, numbers, size = [], [], [], 0

            def flush() -> Iterator[pa.RecordBatch]:
                if not parts:
                    return
                tokens, at = np.concatenate(parts), np.array(numbers)
                for h, before, doc, place in found(tokens, np.array(starts), tokens > 0):
                    row = pa.array(at[doc])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h.view(np.int64)), pa.array(before.view(np.int64)), batch.column(0).take(row), batch.column(1).take(row),
                         pa.array(place.astype(np.int32))], ["h", "before", "k1", "k2", "place"])

            for i, content in str_texts(batch.column(2)):
                codes = seeds.tokens(words_of(content))
                if not len(codes):
                    continue
                parts += [codes, gap]
                starts.append(size)
                numbers.append(i)
                size += len(codes) + len(gap)
                if size >= TOKENS_AT_ONCE:
                    yield from flush()
                    parts, starts, numbers, size = [], [], [], 0
            yield from flush()

    return run


def _verify_task(min_words: int, identity: float):
    """Task: (k1, k2, text, asked) -> (k1, k2, item, hit) of the leaks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Seeds([])
        for batch in batches:
            out = []
            for n, content in str_texts(batch.column(2), 16):
                tokens = coder.tokens(words_of(content))
                for asked in batch.column(3)[n].as_py():
                    own = np.frombuffer(asked["codes"], np.uint64)
                    best = best_leak(tokens, own, asked["diagonals"], min_words, identity)
                    if best:
                        out.append((n, asked["item"], *best, len(own)))
            row = pa.array([o[0] for o in out], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(row), batch.column(1).take(row), *(pa.array([o[j] for o in out], t) for j, t in enumerate(
                    (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32()), 1))],
                ["k1", "k2", "item", "first_word", "n_words", "n_equal", "item_words"])

    return run


def keys_of(text: Column) -> list[Column]:
    """Two 64-bit hashes that stand for a text."""
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit("decontaminate"), text).alias("k2")]


def leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", min_words: int = 13,
          identity: float = 0.8) -> DataFrame:
    """(k1, k2, hits) of the distinct texts that leak an item."""
    rows = benchmark.select(F.col(f"`{item_id}`").alias("item_id"), F.col(f"`{item_text}`").alias("text")).where("text is not null").distinct()
    items = materialize(rows.withColumn("item", F.monotonically_increasing_id()), "items")
    coded = materialize(items.select("item", "text").mapInArrow(_item_task(None), "item long, n_words int, codes binary").where("n_words > 0"), "codes")
    # at most MAX_MASK lengths
    short = [r[0] for r in coded.where(F.col("n_words") <= min(min_words, MAX_MASK)).select("n_words").distinct().collect()]
    seeds = Seeds(short, identity)
    of_items = materialize(coded.mapInArrow(_item_task(seeds), "h long, before long, item long, place int, bit long"), "item-seeds")
    bits = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    maps = of_items.groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    # Spark's bitmaps count bits from 1; 4 KB each, 4 MB in all
    for r in maps.toLocalIterator():
        part = np.frombuffer(bytes(r["bits"]), np.uint8)
        bits_at = (r["bucket"] - 1) * len(part)
        wanted = bits[bits_at:bits_at + len(part)]
        wanted |= part[:len(wanted)]
    texts = docs.select(*keys_of(F.col(f"`{text}`")), F.col(f"`{text}`").alias("text")).where("text is not null")
    of_texts = texts.mapInArrow(_text_task(seeds, bits), "h long, before long, k1 long, k2 long, place int").distinct()
    salt = F.pmod(F.col("k1"), F.lit(SALTS)).cast("int").alias("salt")
    i = of_items.select(F.col("h"), F.col("before").alias("item_before"), "item", F.col("place").alias("item_place"),
                        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    # a hit right after another one of the same mask lies on the same diagonal
    fresh = (F.col("before") == 0) | (F.col("before") != F.col("item_before"))
    pairs = of_texts.select("*", salt).join(i, ["h", "salt"]).where(fresh)
    pairs = pairs.groupBy("k1", "k2", "item").agg(F.collect_set((F.col("place") - F.col("item_place")).cast("int")).alias("diagonals"))
    pairs = materialize(pairs, "diagonals")
    sizes = pairs.groupBy("k1", "k2").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
    asked = (pairs.join(sizes, ["k1", "k2"]).join(coded, "item")
             .groupBy("k1", "k2", F.pmod(F.xxhash64("item"), F.col("parts")).alias("part"))
             .agg(F.collect_list(F.struct("item", "diagonals", "codes")).alias("asked")))
    once = texts.join(sizes.select("k1", "k2"), ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"])
    sure = once.join(asked, ["k1", "k2"]).select("k1", "k2", "text", "asked").mapInArrow(
        _verify_task(min_words, identity), "k1 long, k2 long, item long, first_word int, n_words int, n_equal int, item_words int")
    named = sure.join(items.select("item", F.col("item_id").cast("long").alias("item_id")), "item")
    order = F.struct(F.col("item_id").isNull().alias("last"), "item_id", "item", F.struct(*[f.name for f in HIT]).alias("hit"))
    return materialize(named.groupBy("k1", "k2").agg(F.transform(F.array_sort(F.collect_list(order)), lambda h: h["hit"]).alias("hits")), "leaks")


def scan(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", min_words: int = 13,
         identity: float = 0.8) -> DataFrame:
    """(row: the input row, hits: its leaks as item_id, first_word, n_words,
    n_equal, item_words) per input row of ``docs``."""
    found = leaks(docs, benchmark, text, item_id, item_text, min_words, identity)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *keys_of(F.col(f"`{text}`")))
    none = F.array().cast(T.ArrayType(HIT))
    return rows.join(found, ["k1", "k2"], "left").select("row", F.coalesce("hits", none).alias("hits"))


ship(__name__)
