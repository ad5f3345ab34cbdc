"""Byte-level BPE against the tiktoken library, and the round trip."""

import random

import public_tokenizers
import pytest
import tiktoken
from llm_cases import by_row, documents, edge_docs, edge_rows, empty_docs

from countpanel.llm import bpe


@pytest.fixture(scope="module")
def ranks():
    return bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts():
    rnd = random.Random(3)
    letters = "aaab  \n\t\x1c\x85é日🙂  's1!"
    return [(100 + k, "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 200)))) for k in range(400)] + [
        (1, "a" * 50_000), (2, "ab" * 9_999), (3, " " * 5000 + "x"), (4, "<|endoftext|>")]


def test_equal_to_library(spark, ranks, library):
    rows = [*edge_rows(), *odd_texts(), *documents()]
    out = bpe.encode(edge_docs(spark, rows).repartition(3), ranks, public_tokenizers.PATTERN, decoded="decoded")
    got = by_row((r.row.doc_id, r.row.text, tuple(r.ids), bytes(r.decoded)) for r in out.collect())
    assert got == by_row((i, t, tuple(library.encode_ordinary(t or "")), (t or "").encode()) for i, t in rows)


def test_decode_alone(spark, ranks):
    enc = bpe.encode(edge_docs(spark), ranks, public_tokenizers.PATTERN).select("row.text", "ids")
    rows = bpe.decode(enc, ranks).collect()
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in rows) and len(rows) == len(edge_rows())
    null = spark.createDataFrame([(None,)], "ids array<int>")
    assert bytes(bpe.decode(null, ranks).first().decoded) == b""


def test_decode_slices_and_unknown_ids(ranks):
    import pyarrow as pa
    tokens = bpe.token_table(ranks)
    names = {rank: token for token, rank in ranks.items()}
    lists = [[5, 6], None, [], [70, 80, 90], [300], None, [4000, 7]]
    column = pa.array(lists, pa.list_(pa.int32()))
    for lo in range(len(lists) + 1):
        got = bpe.decode_ids(column.slice(lo, 4), tokens).to_pylist()
        assert got == [b"".join(names[i] for i in x or ()) for x in lists[lo:lo + 4]]
    with pytest.raises((ValueError, IndexError)):
        bpe.decode_ids(pa.array([[len(tokens) + 5]], pa.list_(pa.int32())), tokens)
    with pytest.raises(ValueError):
        bpe.decode_ids(pa.array([[1, None]], pa.list_(pa.int32())), tokens)


def test_every_code_point(ranks, library):
    import pyarrow as pa
    import regex
    chars = [chr(c) for c in range(0, 0x3000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f" a{c}1{c}!{c} {c}{c}\n" for c in chars[k:k + 500]) for k in range(0, len(chars), 500)]
    merges = bpe.Merges(ranks)
    got = bpe.encode_texts(pa.array(texts), merges, regex.compile(public_tokenizers.PATTERN)).to_pylist()
    assert got == [library.encode_ordinary(t) for t in texts]


def test_small_blocks_give_the_same(spark, ranks, library, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK_BYTES", 100)
    rows = documents()[:60]
    out = bpe.encode(edge_docs(spark, rows), ranks, public_tokenizers.PATTERN)
    assert {r.row.doc_id: r.ids for r in out.collect()} == {i: library.encode_ordinary(t) for i, t in rows}


def test_empty(spark, ranks):
    assert bpe.encode(empty_docs(spark), ranks, public_tokenizers.PATTERN).count() == 0


def test_digest(spark, ranks):
    import hashlib

    from pyspark.sql import functions as F
    d = spark.createDataFrame([([1, 20, 300],), ([],)], "ids array<int>").select(bpe.ids_sha256(F.col("ids")).alias("h"))
    assert [r.h for r in d.collect()] == [hashlib.sha256(x).hexdigest() for x in (b"1 20 300", b"")]
