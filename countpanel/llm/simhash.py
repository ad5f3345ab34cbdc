"""SimHash near-duplicates: byte-position inverted index with count filtering.

A fingerprint is eight bytes.  Two fingerprints at Hamming distance d or less
(d <= 5) differ in at most d bytes, so they share at least 8 - d positional
bytes.  The inverted index posts each distinct fingerprint under (set of byte
positions, their values).  Single positions would give lists of 1/256 of all
fingerprints, so a posting takes three positions; the sets of three are chosen
such that any 8 - d shared positions contain one of them (20 sets for d = 4).
Within one list, the shared positional bytes of each pair are tallied, pairs
under the guaranteed minimum drop out and the rest is verified by its bits.

Lists are read in sorted order.  A list is walked from fingerprint to
fingerprint over the ones not yet reached, so it yields a spanning forest of
its links (at most one link per member) and never all pairs; links between
members already joined are implied.  A list longer than ``CHUNK`` is cut into
chunks, and every two chunks of it are walked in a task of their own.

Copies never meet: fingerprints are made distinct first, with partial
aggregation.  Components come from the links by star contraction on Spark.

Defined results: null text counts as empty; a text without words has
fingerprint zero, linked like any other; fewer than ``shingle`` words make one
shingle; a null doc_id is never the smallest, and a component of null ids only
has a null component_id; each input row gives one output row.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from countpanel.llm.common import byte_texts, materialize, ship
from countpanel.llm.components import connected

CHUNK = 32768  # most fingerprints of one index list that a task holds at a time
SMALL = 8  # lists up to this length are compared in one vectorised sweep


def fingerprint(text: bytes, shingle: int = 4) -> int:
    """64-bit SimHash of the lower-cased word shingles (XXH64, seed 42)."""
    words = text.lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, 42)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes)
    starts = (ends - sizes)[:len(words) - shingle + 1].tolist()
    stops = (ends[shingle - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts, stops)), np.uint64, len(starts))
    ones = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), 65536):
        bits = np.unpackbits(hashes[lo:lo + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    value = np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0]
    return int(value)


def fingerprints(docs: DataFrame, key: list[str], text: str = "text", shingle: int = 4) -> DataFrame:
    """(key columns, fp: the fingerprint as a signed long) per input row."""
    source = docs.select(*[F.col(f"`{k}`") for k in key], F.col(f"`{text}`").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            fps = np.zeros(len(column), np.uint64)
            for i, raw in byte_texts(column):
                fps[i] = fingerprint(raw, shingle)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(fps.view(np.int64))], [*key, "fp"])

    schema = source.drop("__text").schema.add("fp", "long")
    return source.mapInArrow(run, schema)


def position_sets(max_bits: int) -> list[tuple[int, int, int]]:
    """Sets of three byte positions of which any 8 - max_bits positions
    contain one (for at least four, a cyclic three-group design does it)."""
    if not 0 <= max_bits <= 5:
        raise ValueError("three shared byte positions are only guaranteed up to 5 differing bits")
    if max_bits == 5:
        return list(combinations(range(8), 3))
    groups = [(0, 1, 2), (3, 4, 5), (6, 7)]
    sets = [c for g in groups for c in combinations(g, 3)]
    for g, after in zip(groups, groups[1:] + groups[:1]):
        sets += [(*two, one) for two, one in product(combinations(g, 2), after)]
    return sets


def _posting(fp: Column, number: int, positions: tuple[int, int, int]) -> Column:
    byte = [F.shiftrightunsigned(fp, 8 * p).bitwiseAND(F.lit(255)) for p in positions]
    return (F.lit(number << 24) + F.shiftleft(byte[0], 16) + F.shiftleft(byte[1], 8) + byte[2]).cast("long")


def _near(x: np.ndarray, max_bits: int) -> np.ndarray:
    """Which differences x = a ^ b are within max_bits: tally of the shared
    positional bytes first, bit count of the rest."""
    tally = (x.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1, dtype=np.int8)
    near = tally >= 8 - max_bits
    near[near] = np.bitwise_count(x[near]) <= max_bits
    return near


def forest(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links among distinct fingerprints: each one
    taken up links itself to those not reached yet, which are then taken up."""
    left, right, rest, queue = [], [], fps, []
    while len(rest):
        if queue:
            at = queue.pop()
        else:
            at, rest = rest[0], rest[1:]
            if not len(rest):
                break
        near = _near(rest ^ at, max_bits)
        if near.any():
            hit = rest[near]
            left.append(np.full(len(hit), at))
            right.append(hit)
            queue.extend(hit)
            rest = rest[~near]
    none = np.zeros(0, np.uint64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def _list_links(max_bits: int, chunk: int, small: int):
    """Task: index rows (posting, fp) sorted by posting -> links of each list;
    lists over ``chunk`` come out as numbered chunks instead."""
    names = ["u", "v", "posting", "chunk", "fps"]

    def links(left: np.ndarray, right: np.ndarray) -> pa.RecordBatch:
        n = len(left)
        return pa.RecordBatch.from_arrays(
            [pa.array(left.view(np.int64)), pa.array(right.view(np.int64)), pa.nulls(n, pa.int64()),
             pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names)

    def chunk_row(posting: int, number: int, fps: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([posting], pa.int64()),
             pa.array([number], pa.int32()), pa.array([fps.tobytes()], pa.binary())], names)

    def whole_lists(post: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        starts = np.flatnonzero(np.append(True, post[1:] != post[:-1]))
        sizes = np.diff(np.append(starts, len(post)))
        few = np.repeat(sizes <= small, sizes)
        p, f = post[few], fps[few]
        for gap in range(1, small):
            a, b = f[:-gap], f[gap:]
            same = p[:-gap] == p[gap:]
            a, b = a[same], b[same]
            near = _near(a ^ b, max_bits)
            if near.any():
                yield links(a[near], b[near])
        for i in np.flatnonzero(sizes > small):
            left, right = forest(fps[starts[i]:starts[i] + sizes[i]], max_bits)
            if len(left):
                yield links(left, right)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        post, fps = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        number = 0  # chunks of the open list that are out already
        for batch in batches:
            post = np.concatenate([post, batch.column(0).to_numpy()])
            fps = np.concatenate([fps, batch.column(1).to_numpy().view(np.uint64)])
            if not len(post):
                continue
            last = int(np.searchsorted(post, post[-1]))  # the last list may go on
            if number and last:  # the open list has ended within this batch
                end = int(np.searchsorted(post, post[0], side="right"))
                yield chunk_row(int(post[0]), number, fps[:end])
                post, fps, last, number = post[end:], fps[end:], last - end, 0
            if last:
                yield from whole_lists(post[:last], fps[:last])
                post, fps = post[last:], fps[last:]
            while len(post) > chunk:  # more of the list is left: it has two chunks at least
                yield chunk_row(int(post[0]), number, fps[:chunk])
                post, fps, number = post[chunk:], fps[chunk:], number + 1
        if number:
            yield chunk_row(int(post[0]), number, fps)
        elif len(post):
            yield from whole_lists(post, fps)

    return run


def _chunk_links(max_bits: int):
    """Task: two chunks of one list -> spanning forest of their links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                both = b"".join(batch.column(c)[i].as_py() or b"" for c in (0, 1))
                left, right = forest(np.frombuffer(both, np.uint64), max_bits)
                yield pa.RecordBatch.from_arrays([pa.array(left.view(np.int64)), pa.array(right.view(np.int64))],
                                                 ["u", "v"])

    return run


def near_links(distinct: DataFrame, max_bits: int = 4, chunk: int = CHUNK, small: int = SMALL) -> DataFrame:
    """(u, v) links between distinct fingerprints (column fp, signed long)
    whose components equal those of all pairs within max_bits."""
    postings = [_posting(F.col("fp"), k, s) for k, s in enumerate(position_sets(max_bits))]
    index = distinct.select(F.explode(F.array(*postings)).alias("posting"), "fp")
    found = materialize(
        index.repartition("posting").sortWithinPartitions("posting")
        .mapInArrow(_list_links(max_bits, chunk, small), "u long, v long, posting long, chunk int, fps binary"),
        "simhash-lists")
    links = found.where("u is not null").select("u", "v")
    a = found.where("posting is not null")
    b = a.select("posting", F.col("chunk").alias("other"), F.col("fps").alias("other_fps"))
    tasks = (a.join(b, "posting").where("other > chunk")
             .repartition("posting", "chunk", "other").select("fps", "other_fps"))
    return links.unionByName(tasks.mapInArrow(_chunk_links(max_bits), "u long, v long"))


def components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4,
               max_bits: int = 4, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id) of every row: component_id
    is the smallest doc_id reachable over links of at most max_bits bits, root
    the smallest such fingerprint.

    ``text_hash`` (XXH64 of the text) tells rows of one doc_id apart."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    marked = materialize(fingerprints(rows, ["doc_id", "text_hash"], "text", shingle), "simhash-docs")
    distinct = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    roots = connected(near_links(distinct, max_bits, chunk))
    member = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    smallest = member.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_fp = member.join(smallest, "root").select("fp", "root", "component_id")
    return marked.join(of_fp, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def hex_digits(fp: Column) -> Column:
    """The fingerprint as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4,
               max_bits: int = 4) -> DataFrame:
    """The rows of ``docs`` with one row left of each component: the smallest
    doc_id (nulls last; of repeated rows of that id, the one with the smallest
    text hash; of equal rows, one)."""
    sizes = components(docs, doc_id, text, shingle, max_bits).groupBy("root", "doc_id", "text_hash").agg(
        F.count("*").alias("copies"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "copies"))
    firsts = sizes.groupBy("root").agg(first.alias("f")).select(
        F.col("f.doc_id").alias("__id"), F.col("f.text_hash").alias("__hash"), F.col("f.copies").alias("__copies"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = rows.withColumn("__h", F.xxhash64(F.col("row").getField(text)))
    hit = rows.join(firsts, F.col("row").getField(doc_id).eqNullSafe(F.col("__id"))
                    & (F.col("__h") == F.col("__hash")))
    once = hit.where("__copies = 1").select("row")
    again = hit.where("__copies > 1").withColumn(
        "__n", F.row_number().over(Window.partitionBy("__id", "__h").orderBy("__copies"))).where("__n = 1").select("row")
    return once.unionByName(again).select("row.*")


ship(__name__)
