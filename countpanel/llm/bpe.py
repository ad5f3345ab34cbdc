"""Byte-level BPE encoding and decoding by corpus-level merge replay.

The corpus is not encoded word by word.  Each task takes its block of
documents (rows of an Arrow batch up to
``BLOCK_BYTES`` of text), cuts the texts into pieces with the tokenizer's
pattern and keeps every distinct piece once.  All distinct pieces lie in one
flat array of tokens, with an inverted index from merge rank (token pair) to
the positions where that pair stands.  The merges are replayed over the whole
block in rank order; a merge only touches the two neighbours of each place it
changes, whose new pairs are put into the index.  The documents' ids are then
gathered from the encoded pieces.

No shuffle: blocks are independent because a piece's encoding does not depend
on its neighbours.  Memory is bounded by one batch.

Defined results: null text encodes like the empty text, to no ids; null ids
decode to empty bytes; every input row gives one output row in ``row`` (so
repeated rows and repeated doc_ids are kept) whatever other columns it has.
"""

from __future__ import annotations

import base64
import heapq
import os
import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from countpanel.llm.common import blocks, ship, str_texts

#: A vocabulary is broadcast to every executor; larger files are refused.
MAX_VOCAB_BYTES = 64 << 20
#: Texts replayed together; bounds a task's memory (a longer text is a block alone).
BLOCK_BYTES = 6 << 20
NONE = np.iinfo(np.int32).max  # rank of a pair that does not merge


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a tiktoken file: one base64 token and its rank per line."""
    if os.path.getsize(path) > MAX_VOCAB_BYTES:
        raise ValueError(f"{path}: a vocabulary over {MAX_VOCAB_BYTES} bytes is not broadcast")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    missing = [b for b in range(256) if bytes([b]) not in ranks]
    if missing:
        raise ValueError(f"{path}: not byte-level, {len(missing)} single bytes have no rank")
    return ranks


class Merges:
    """Lookup tables of one vocabulary.  They are built once, on the driver;
    ``vars`` of them is broadcast."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        keys, merged = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    merged.append(rank)
        order = np.argsort(np.array(keys, dtype=np.int64))
        self.keys = np.append(np.array(keys, dtype=np.int64)[order], np.iinfo(np.int64).max)
        self.merged = np.append(np.array(merged, dtype=np.int64)[order], NONE).astype(np.int32)

    @classmethod
    def of(cls, tables: dict) -> Merges:
        merges = cls.__new__(cls)
        vars(merges).update(tables)
        return merges

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token that each pair merges into, else NONE."""
        key = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.merged[at], NONE)


def _ascending(places: np.ndarray) -> np.ndarray:
    """Distinct places in order."""
    places = np.sort(places)
    return places[np.append(True, places[1:] != places[:-1])] if len(places) else places


def replay(pieces: list[bytes], merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """Encode distinct pieces: (ids of all pieces in a row, ids per piece)."""
    whole = np.fromiter((merges.ranks.get(p, -1) for p in pieces), np.int32, len(pieces))
    flat = [p for p, w in zip(pieces, whole.tolist()) if w < 0]
    sizes = np.fromiter(map(len, flat), np.int64, len(flat))
    n = int(sizes.sum())
    counts = np.ones(len(pieces), np.int64)
    if n == 0:
        return whole, counts
    tok = merges.byte_ids[np.frombuffer(b"".join(flat), np.uint8)]
    nxt = np.arange(1, n + 1, dtype=np.int32)
    prv = np.arange(-1, n - 1, dtype=np.int32)
    ends = np.cumsum(sizes)
    nxt[ends - 1] = -1
    prv[ends - sizes] = -1
    rank = np.full(n, NONE, np.int32)
    inner = np.flatnonzero(nxt >= 0).astype(np.int32)
    rank[inner] = merges.pair_ranks(tok[inner], tok[inner + 1])
    alive = np.ones(n, bool)
    index: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []

    def post(places: np.ndarray) -> None:
        """Add places to the inverted index under the rank of their pair."""
        ranks = rank[places]
        places, ranks = places[ranks < NONE], ranks[ranks < NONE]
        if not len(places):
            return
        order = np.argsort(ranks, kind="stable")
        places, ranks = places[order], ranks[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        starts = [0, *cuts.tolist(), len(places)]
        for lo, hi in zip(starts, starts[1:]):
            r = int(ranks[lo])
            if r in index:
                index[r].append(places[lo:hi])
            else:
                index[r] = [places[lo:hi]]
                heapq.heappush(heap, r)

    post(inner)
    while heap:
        r = heapq.heappop(heap)
        lists = index.pop(r)
        at = lists[0] if len(lists) == 1 else _ascending(np.concatenate(lists))
        at = at[rank[at] == r]  # places whose pair has changed since are stale
        if not len(at):
            continue
        linked = nxt[at[:-1]] == at[1:]
        if linked.any():  # overlapping places (aaa): from the left, every other one
            starts = np.flatnonzero(np.append(True, ~linked))
            offset = np.arange(len(at)) - np.repeat(starts, np.diff(np.append(starts, len(at))))
            at = at[offset % 2 == 0]
        right = nxt[at]
        after = nxt[right]
        tok[at] = r
        nxt[at] = after
        alive[right] = False
        rank[right] = NONE
        rank[at] = NONE
        has = after >= 0
        prv[after[has]] = at[has]
        before = prv[at]
        touched = _ascending(np.concatenate([at[has], before[before >= 0]]))
        rank[touched] = merges.pair_ranks(tok[touched], tok[nxt[touched]])
        post(touched)
    left = np.add.reduceat(alive, ends - sizes, dtype=np.int64)
    counts[whole < 0] = left
    ids = np.empty(int(counts.sum()), np.int32)
    owner = np.repeat(whole, counts)
    ids[owner >= 0] = owner[owner >= 0]
    ids[owner < 0] = tok[alive]
    return ids, counts


class _Numbers(dict):
    """Distinct string -> its number, given on first sight."""

    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        return n


#: A space before more white space or at the end is not sure to begin a piece.
UNSURE_SPACE = re.compile(r" (?=\s|\Z)")


def _chunks(text: str) -> list[str]:
    """Cut before spaces that begin a piece in any case: those followed by
    something other than white space.  Each chunk but the first stands for
    itself after one space."""
    parts = text.split(" ")
    if not UNSURE_SPACE.search(text):
        return parts
    chunks = parts[:1]
    for part in parts[1:]:
        if part == "" or part[0].isspace():
            chunks[-1] += " " + part
        else:
            chunks.append(part)
    return chunks


def _gather(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices of the ranges [start, start + size), one after the other."""
    ends = np.cumsum(sizes)
    if not len(ends) or not ends[-1]:
        return np.zeros(0, np.int64)
    return np.arange(ends[-1]) + np.repeat(starts - (ends - sizes), sizes)


def encode_texts(column: pa.Array, merges: Merges, pattern: regex.Pattern) -> pa.Array:
    """Ids of every text of a string column.

    Texts are cut into chunks at sure piece borders, so the pattern runs once
    over each distinct chunk and the merges once over each distinct piece."""
    first, later = _Numbers(), _Numbers()
    per_text, found = np.zeros(len(column), np.int64), []
    for i, text in str_texts(column):
        chunks = _chunks(text)
        numbers = np.array([-1 - first[chunks[0]], *map(later.__getitem__, chunks[1:])], np.int32)
        per_text[i] = len(numbers)
        found.append(numbers)
    where = np.concatenate(found) if found else np.zeros(0, np.int32)
    where = np.where(where < 0, -1 - where, where + np.int32(len(first)))
    pieces, n_pieces, cut = _Numbers(), array("q"), array("i")
    for chunk in chain(first, (" " + c for c in later)):
        here = pattern.findall(chunk)
        n_pieces.append(len(here))
        cut.extend(map(pieces.__getitem__, here))
    del first, later
    of_chunk = np.frombuffer(cut, np.int32)
    ids, n_ids = replay([p.encode() for p in pieces], merges)
    # ids of each distinct chunk, then of each text
    sizes = n_ids[of_chunk]
    chunk_ids = ids[_gather((np.cumsum(n_ids) - n_ids)[of_chunk], sizes)].astype(np.int32)
    ends = np.append(0, np.cumsum(sizes))[np.append(0, np.cumsum(np.frombuffer(n_pieces, np.int64)))]
    sizes = np.diff(ends)[where]
    offsets = np.append(0, np.cumsum(sizes))[np.append(0, np.cumsum(per_text))]
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)),
                                    pa.array(chunk_ids[_gather(ends[:-1][where], sizes)]))


def token_table(ranks: dict[bytes, int]) -> pa.Array:
    """The bytes of every token at the place of its rank, null where no token
    has the rank."""
    tokens: list[bytes | None] = [None] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return pa.array(tokens, pa.binary())


def decode_ids(column: pa.Array, tokens: pa.Array) -> pa.Array:
    """The bytes that every list of ids stands for (null: none).  The tokens
    taken for all lists lie in one buffer already; only the cuts between lists
    are put in their place."""
    taken = tokens.take(column.flatten())
    if taken.null_count:
        raise ValueError("an id has no token in the vocabulary")
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    cuts = np.append(0, np.cumsum(sizes, dtype=np.int64))
    _, offsets, data = taken.buffers()
    ends = np.frombuffer(offsets, np.int32, len(taken) + 1, 4 * taken.offset) if len(taken) else np.zeros(1, np.int32)
    return pa.Array.from_buffers(pa.binary(), len(column), [None, pa.py_buffer(ends[cuts].astype(np.int32)), data])


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", out: str = "ids",
           decoded: str | None = None) -> DataFrame:
    """(row: the input row as a struct, ``out``: array of ids) per input row.
    With ``decoded``, the ids are decoded again by the same task into a binary
    column of that name."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    shared = docs.sparkSession.sparkContext.broadcast(vars(Merges(ranks)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges, compiled = Merges.of(shared.value), regex.compile(pattern)
        tokens = token_table(merges.ranks) if decoded else None
        for batch in batches:
            for lo, size in blocks(batch.column(0).field(text), BLOCK_BYTES):
                row = batch.column(0).slice(lo, size)
                ids = encode_texts(row.field(text), merges, compiled)
                more = [decode_ids(ids, tokens)] if decoded else []
                yield pa.RecordBatch.from_arrays([row, ids, *more], ["row", out, *([decoded] if decoded else [])])

    schema = T.StructType([rows.schema["row"], T.StructField(out, T.ArrayType(T.IntegerType())),
                           *([T.StructField(decoded, T.BinaryType())] if decoded else [])])
    return rows.mapInArrow(run, schema)


def decode(encoded: DataFrame, ranks: dict[bytes, int], ids: str = "ids", out: str = "decoded") -> DataFrame:
    """The input with a binary column: the bytes that the ids stand for."""
    shared = encoded.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = token_table(shared.value)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids))
            yield pa.RecordBatch.from_arrays([*batch.columns, decode_ids(column, tokens)], [*batch.schema.names, out])

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField(out, T.BinaryType())]))


def ids_sha256(ids: Column) -> Column:
    """SHA-256 of the decimal ids joined by one space."""
    return F.sha2(F.array_join(ids.cast("array<string>"), " "), 256)


ship(__name__)
