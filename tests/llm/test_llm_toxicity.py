"""Toxicity: segments against brute force, the extreme-value law, held-out quality."""

import math
import re
import zlib

import numpy as np
from llm_cases import CLASH, edge_docs, edge_rows, empty_docs, sentence

from countpanel.llm import toxicity

SF1 = "/root/testdata/sf0.1"  # 120 toxic held-out documents; sf0.01 has 14


def brute_segments(score):
    """Ruzzo and Tompa by definition: the best-scoring segment (shortest of
    equal ones, then the first), then the same to its left and right."""
    def split(lo, hi):
        best = None
        for a in range(lo, hi):
            total = 0.0
            for b in range(a, hi):
                total += score[b]
                if total > 0 and (best is None or total > best[0] + 1e-9
                                  or abs(total - best[0]) <= 1e-9 and b + 1 - a < best[2] - best[1]):
                    best = (total, a, b + 1)
        return [] if best is None else [*split(lo, best[1]), best, *split(best[2], hi)]
    return [(a, b, round(t, 6)) for t, a, b in split(0, len(score))]


def test_segments_equal_definition():
    rng = np.random.default_rng(1)
    for n in [0, 1, 2, *([12] * 150), *([40] * 30)]:
        score = np.round(rng.normal(-0.2, 1.0, n), 3)
        assert [(a, b, round(t, 6)) for a, b, t in toxicity.segments(score)] == brute_segments(score)


def test_segments_are_linear():
    score = np.where(np.arange(400_000) % 3 == 0, 1.0, -0.6)
    assert toxicity.segments(score)
    assert len(toxicity.segments(np.where(np.arange(200_000) % 2 == 0, 1.0, -2.0))) == 100_000


def test_lambda_solves_the_law():
    counts = np.zeros(toxicity.BINS)
    counts[20], counts[40] = 95, 5
    s = toxicity.LOW + toxicity.BIN * (np.arange(toxicity.BINS) + 0.5)
    lam = toxicity.solve_lambda(counts)
    assert abs((counts / 100 * np.exp(lam * s)).sum() - 1) < 1e-6
    assert toxicity.solve_lambda(np.zeros(toxicity.BINS)) == 1.0


def test_isotonic_curve():
    t, y = np.array([1.0, 2.0, 2.0, 3.0, 4.0, 5.0]), np.array([0.0, 1.0, 0.0, 0.0, 1.0, 1.0])
    knots, p = toxicity.isotonic(t, y)
    assert (np.diff(knots) >= 0).all() and (np.diff(p) >= 0).all()
    # pools: {1}, {2, 2, 3}, {4, 5}, each drawn to the base rate by one row
    assert np.allclose(np.interp([1, 2, 3, 4, 5], knots, p), [0.5 / 2, 1.5 / 4, 1.5 / 4, 2.5 / 3, 2.5 / 3])
    rng = np.random.default_rng(7)
    for wide in (1.0, 30.0, 3000.0):  # separable evidence of any width keeps the base rate and the order
        y = (rng.random(5000) < 0.1).astype(float)
        t = np.where(y == 1, wide * rng.random(5000) + 3, -6 + 5 * rng.random(5000))
        p = np.interp(t, *toxicity.isotonic(t, y))
        assert abs(p.mean() - y.mean()) < 1e-3 and ((p >= 0.3) == (y == 1)).all()


def planted(n=900):
    rows, labels = [], []
    for k in range(n):
        toxic = k % 5 == 0
        words = sentence(k, 60).split()
        if toxic:
            words[10:10] = ["vilest", "scoundrel", "vilely"]
        rows.append((k, " ".join(words)))
        labels.append((k, 1, int(toxic)))
    return rows, labels


def test_planted_passages_on_rows_never_learned_from(spark):
    rows, labels = planted()
    docs = edge_docs(spark, rows)
    table = spark.createDataFrame([*labels, *labels[:20], (None, 1, 1), (1, None, None)],
                                  "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, table, lambda i: i % 4 != 2)
    got = {r.row.doc_id: r for r in toxicity.score(docs, model).collect()}
    held = [i for i, _ in rows if i % 4 == 2]
    assert all((got[i].score >= 0.3) == (i % 5 == 0) for i in held)
    for i in held:
        if i % 5 == 0:
            p = max(got[i].passages, key=lambda p: p.score)
            assert p.first_word <= 10 and p.end_word >= 13 and p.expected < 0.05


def test_edges(spark):
    rows, labels = planted(300)
    docs = edge_docs(spark, [*rows, *[(None if i is None else i + 10_000, t) for i, t in edge_rows()]])
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, table)
    out = toxicity.score(docs, model)
    assert out.select("row.*").columns == ["doc_id", "text", *CLASH]
    got = out.collect()
    assert len(got) == 300 + len(edge_rows()) and all(0 <= r.score <= 1 for r in got)
    assert all(not r.passages for r in got if not r.row.text)
    assert toxicity.score(empty_docs(spark), model).count() == 0
    one_class = table.where("toxic = 0")
    for bare in (one_class, table.limit(0)):
        assert {r.score for r in toxicity.score(docs, toxicity.fit(docs, bare)).collect()} == {0.0}


def test_held_out_quality(spark):
    import duckdb

    from countpanel.llm.queries import QUERIES
    got = {r.doc_id: r for r in QUERIES["op2_toxicity"](spark, SF1).collect()}
    label = dict(duckdb.sql(f"select doc_id, toxic from '{SF1}/labels.parquet'").fetchall())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    held = [(got[i].predicted, t) for i, t in label.items() if got[i].held_out]
    tp = sum(p == t == 1 for p, t in held)
    assert 2 * tp / (2 * tp + sum(p != t for p, t in held)) >= 0.8


def test_scores_do_not_depend_on_other_columns(spark):
    rows, labels = planted(200)
    model = toxicity.fit(edge_docs(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    a = {r.row.text: r.score for r in toxicity.score(edge_docs(spark, rows), model).collect()}
    moved = [(i + 77, t) for i, t in rows]
    assert a == {r.row.text: r.score for r in toxicity.score(edge_docs(spark, moved).repartition(5), model).collect()}


def best_first(score, lo, hi):
    """All maximal scoring segments by definition: the best one (the leftmost,
    then the shortest), then those on either side of it."""
    total = np.append(0.0, np.cumsum(score[lo:hi]))
    found = max(((round(total[b] - total[a], 9), -a, a - b) for a in range(hi - lo) for b in range(a + 1, hi - lo + 1)), default=None)
    if found is None or found[0] <= 0:
        return []
    a = lo - found[1]
    b = a - found[2]
    return best_first(score, lo, a) + [float(score[a:b].sum())] + best_first(score, b, hi)


def test_whole_score_equals_brute_force(spark):
    """Words, their scores, segments, the extreme-value law and the curve, step
    by step in plain Python, for texts with and without spaces."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    model = toxicity.fit(docs, spark.read.parquet("/root/testdata/sf0.01/labels.parquet"))
    texts = [r for r in docs.where("length(text) between 1 and 900").orderBy("doc_id").limit(60).collect()]
    rows = [(r.doc_id, r.text) for r in texts] + [(-1, ""), (-2, None), (-3, "你是一个讨厌的人，滚出去"), (-4, "42 _ 7")]
    got = {r.doc_id: r.score for r in toxicity.score(edge_docs(spark, rows), model).select("row.doc_id", "score").collect()}
    assert toxicity.words_of("你是 Bad人9") == ["你", "是", "bad", "人"]
    for i, text in rows:
        words = re.findall(r"[^\W\d_]+", (text or "").lower()) if i != -3 else [c for c in text if c.isalpha()]
        scores = [next((model.scores[f] for f in [w, *("^" + w[:k] for k in (7, 6, 5, 4) if len(w) > k)] if f in model.scores), 0.0) for w in words]
        found = best_first(np.array(scores) - toxicity.DRIFT, 0, len(words)) if words else []
        surprise = [model.lam * s - math.log(max(model.k * len(words), 1e-12)) for s in found]
        best = max([toxicity.EVIDENCE_FLOOR, *surprise])
        rest = sum(s for s in surprise if s > 0)
        t = best + math.log1p(rest)
        curve = lambda x: 0.98 * float(np.interp(x, *model.curve)) + 0.02 / (1 + math.exp(-x / 4))
        p, at = curve(t), curve(model.cut)
        want = 0.3 * p / at if t < model.cut else 0.3 + 0.7 * (p - at) / max(1 - at, 1e-9)
        assert abs(got[i] - want) < 1e-6, (i, got[i], want)
