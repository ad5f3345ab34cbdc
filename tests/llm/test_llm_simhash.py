"""SimHash: fingerprints, links and components against brute force."""

import numpy as np
import xxhash
from llm_cases import WORDS, documents, edge_docs, edge_rows, empty_docs, lower_ascii
from pyspark.sql import functions as F

from countpanel.llm import simhash


def brute_fingerprint(text, k=4):
    words = WORDS.findall(lower_ascii(text))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    counts = np.zeros(64, int)
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        counts += [(h >> b) & 1 for b in range(64)]
    return sum(1 << b for b in range(64) if counts[b] * 2 > len(shingles))


def brute_components(fps, bits=4):
    parent = list(range(len(fps)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a
    for a in range(len(fps)):
        for b in range(a):
            if bin(fps[a] ^ fps[b]).count("1") <= bits:
                parent[find(a)] = find(b)
    return [find(a) for a in range(len(fps))]


def check(spark, rows, bits=4, **kw):
    docs = edge_docs(spark, rows)
    got = sorted(((r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in simhash.components(
        docs, max_bits=bits, **kw).collect()), key=repr)
    fps = [brute_fingerprint(t) for _, t in rows]
    comp = brute_components(fps, bits)
    least = {}
    for (i, _), c in zip(rows, comp):
        if i is not None:
            least[c] = min(i, least.get(c, i))
    assert got == sorted(((i, f, least.get(c)) for (i, _), f, c in zip(rows, fps, comp)), key=repr)
    return docs, comp


def test_edge_rows_and_one_kept_per_component(spark):
    docs, comp = check(spark, edge_rows())
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert len(rows) == len(set(comp))
    assert simhash.keep_first(docs.limit(0)).count() == 0


def test_documents(spark):
    check(spark, documents())


def test_empty(spark):
    assert simhash.components(empty_docs(spark)).count() == 0


def test_position_sets_meet_every_guaranteed_match():
    from itertools import combinations
    for bits in range(6):
        sets = [set(s) for s in simhash.position_sets(bits)]
        for shared in combinations(range(8), 8 - bits):
            assert any(s <= set(shared) for s in sets)
    assert len(simhash.position_sets(4)) == 20


def test_dense_lists_are_chunked_without_losing_links(spark):
    """A cloud of fingerprints around few centres, lists cut into tiny chunks."""
    rng = np.random.default_rng(5)
    fps = set()
    for centre in rng.integers(0, 1 << 63, 6, dtype=np.uint64):
        for _ in range(120):
            x = int(centre)
            for b in rng.integers(0, 64, rng.integers(0, 7)):
                x ^= 1 << int(b)
            fps.add(x)
    fps = sorted(fps)
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    comp = brute_components(fps)
    for chunk, small in ((7, 3), (32768, 8)):
        links = simhash.near_links(spark.createDataFrame([(f,) for f in signed], "fp long"), 4, chunk, small)
        edges = [(r.u, r.v) for r in links.distinct().collect()]
        parent = {f: f for f in signed}

        def find(a):
            while parent[a] != a:
                a = parent[a]
            return a
        for u, v in edges:
            assert bin((u ^ v) & (2**64 - 1)).count("1") <= 4
            parent[find(u)] = find(v)
        groups = {}
        for f, c in zip(signed, comp):
            groups.setdefault(c, set()).add(find(f))
        assert all(len(g) == 1 for g in groups.values()) and len(set().union(*groups.values())) == len(groups)


def test_connected_long_chain_and_star(spark):
    from countpanel.llm.components import connected
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + k) for k in range(1, 300)] + [(5, 5)]
    got = {r.node: r.root for r in connected(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, 201)}, **{1000 + k: 1000 for k in range(1, 300)}}
    assert connected(spark.createDataFrame([], "u long, v long")).count() == 0


def test_hex_digits(spark):
    row = spark.createDataFrame([(-1,), (10,)], "fp long").select(simhash.hex_digits(F.col("fp")).alias("h")).collect()
    assert [r.h for r in row] == ["f" * 16, "0" * 15 + "a"]
