"""Importance resampling against brute force."""

import hashlib
import math
import re
import zlib

import pytest
from llm_cases import SF, by_row, documents, edge_docs, edge_rows, empty_docs, lower_ascii

from countpanel.llm import resample
from countpanel.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(text, max_n):
    words = WORD.findall(lower_ascii(text))
    return len(words), [" ".join(words[i:i + n]) for n in range(1, max_n + 1) for i in range(len(words) - n + 1)]


def brute(docs, target, max_n=1, buckets=10_000, min_words=20, percent=10, seed=2024):
    def tally(texts):
        out = [0] * buckets
        for t in texts:
            for g in grams(t, max_n)[1]:
                out[zlib.crc32(g.encode()) % buckets] += 1
        return out

    s, t = tally(x for _, x in docs), tally(target)
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t)]
    rows = []
    for i, text in docs:
        n_words, g = grams(text, max_n)
        weight = sum(gain[zlib.crc32(x.encode()) % buckets] for x in g) // len(g) if g else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n_words))
    able = sorted((r for r in rows if r[4] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    drawn = able[:percent * len(able) // 100]
    rest = able[len(drawn):] + [r for r in rows if r[4] < min_words]
    return by_row([(*r[:4], k) for k, r in enumerate(drawn, 1)] + [(*r[:4], None) for r in rest])


@pytest.mark.parametrize("max_n,percent", [(1, 10), (2, 50), (3, 100)])
def test_edge_rows(spark, max_n, percent):
    rows = edge_rows()
    target = ["the quick brown", None, "", "kalo mi su", "the quick brown"]
    items = spark.createDataFrame([(t,) for t in target], "text string")
    for batch in (resample.BATCH_BYTES, 64):
        resample.BATCH_BYTES, kept = batch, resample.BATCH_BYTES
        try:
            found = resample.resample(edge_docs(spark, rows), items, max_n=max_n, buckets=97, share=(percent, 100), min_words=5)
            assert by_row(found.collect()) == brute(rows, target, max_n, 97, 5, percent)
        finally:
            resample.BATCH_BYTES = kept


def test_empty_tables(spark):
    rows = edge_rows()
    none = spark.createDataFrame([], "text string")
    assert by_row(resample.resample(edge_docs(spark, rows), none).collect()) == brute(rows, [])
    assert resample.resample(empty_docs(spark), none).collect() == []


def test_no_gram_crosses_documents():
    whose, where, n = resample.features([b"a b", b"", b"c", b"D e!f"], 2, 1 << 30, {})
    want = [(0, "a"), (0, "b"), (2, "c"), (3, "d"), (3, "e"), (3, "f"), (0, "a b"), (3, "d e"), (3, "e f")]
    assert list(zip(whose.tolist(), where.tolist())) == [(d, zlib.crc32(g.encode()) % (1 << 30)) for d, g in want]
    assert n.tolist() == [2, 0, 1, 3]


def test_query_equals_brute_force(spark, duck):
    items = [t for t, in duck.sql(f"select text from '{SF}/benchmark.parquet'").fetchall()]
    assert by_row(QUERIES["op13_resample"](spark, SF).collect()) == brute(documents(), items)
