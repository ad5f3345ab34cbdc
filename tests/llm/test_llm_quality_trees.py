"""Boosted quality trees: traversal and splits against plain loops, held-out
accuracy, defined cases."""

import zlib

import numpy as np
import pytest
from llm_cases import edge_docs, edge_rows, empty_docs, sentence

from countpanel.llm import quality_trees as q
from countpanel.llm.queries import QUERIES

SF1 = "/root/testdata/sf0.1"


def walk(model, row):
    """The margin of one row, node by node."""
    total = model.base
    for at in model.roots.tolist():
        while model.left[at] != at:
            at = model.left[at] + int(np.searchsorted(model.edges[model.stat[at]], row[model.stat[at]], "left") > model.cut[at])
        total += model.value[at]
    return total


def test_traversal_equals_walking():
    rng = np.random.default_rng(1)
    x = np.c_[rng.normal(size=(2000, 3)), rng.integers(0, 4, (2000, 2))]
    y = ((x[:, 0] * x[:, 3] > 0.5) ^ (rng.random(2000) < 0.1)).astype(float)
    model = q.train(x, y, trees=15, leaves=9)
    fresh = np.c_[rng.normal(size=(200, 3)) * 2, rng.integers(-1, 6, (200, 2))]
    assert np.allclose(model.margin(model.bins(fresh)), [walk(model, r) for r in fresh])
    p = model.probability(x)
    assert ((p > 0.5) == (x[:, 0] * x[:, 3] > 0.5)).mean() > 0.95


def test_best_split_equals_trying_all():
    rng = np.random.default_rng(2)
    bins = rng.integers(0, 12, (300, 4)).astype(np.int16)
    grad, hess = rng.normal(size=300), rng.uniform(0.1, 0.3, 300)
    nodes, value = q.grow(bins, grad, hess, leaves=2, min_rows=10, l2=1.0)
    gain = {}
    for j in range(4):
        for cut in range(11):
            left = bins[:, j] <= cut
            if min(left.sum(), (~left).sum()) >= 10:
                gain[j, cut] = sum(grad[s].sum() ** 2 / (hess[s].sum() + 1.0) for s in (left, ~left))
    j, cut = max(gain, key=gain.get)
    assert tuple(nodes[0][:2]) == (j, cut)
    left = bins[:, j] <= cut
    for s in (left, ~left):
        assert np.allclose(value[s], -grad[s].sum() / (hess[s].sum() + 1.0))


def test_statistics_of_odd_texts():
    for _, text in edge_rows():
        found = q.statistics((text or "").encode())
        assert len(found) == len(q.STATS) and np.isfinite(found).all()
    of = dict(zip(q.STATS, q.statistics(b"Ab cd# cd#\nAb cd# cd#\n\n.")))
    assert (of["share_symbol"], of["share_upper"], of["symbol_words"]) == (4 / 24, 2 / 24, 4 / 7)
    assert of["dup_lines"] == 1 / 3 and of["distinct_words"] == 3 / 7 and of["repeated_words"] == 6 / 7


def labelled(spark, n=400):
    texts = [(i, sentence(i, 40) if i % 3 else "### " * (i % 17 + 3)) for i in range(n)]
    labels = [(i, int(i % 3 > 0), "x") for i in range(n)] + [(None, 1, "x"), (5, None, "x"), (3, 0, "x"), (9999, 0, "x")]
    return edge_docs(spark, texts), spark.createDataFrame(labels, "doc_id long, quality int, stats string")


def test_defined_cases(spark):
    docs, labels = labelled(spark)
    model = q.fit(docs, labels, min_rows=5)
    rows = edge_rows()
    found = q.score(edge_docs(spark, rows), model).select("row.doc_id", "row.text", "row.score", "score").collect()
    assert sorted(((r[0], r[1]) for r in found), key=repr) == sorted(rows, key=repr)
    assert all(0 <= r[3] <= 1 for r in found) and len({r[3] for r in found if not r[1]}) == 1
    assert q.score(empty_docs(spark), model).collect() == []
    for given, want in ((labels.where("quality = 1"), 1.0), (labels.where("quality = 0"), 0.0), (labels.where("doc_id is null"), 0.0)):
        assert {r[0] for r in q.score(edge_docs(spark, rows), q.fit(docs, given)).select("score").collect()} == {want}
    assert {r[0] for r in q.score(docs, q.fit(empty_docs(spark), labels)).select("score").collect()} == {0.0}


def test_sample_is_bounded_and_repeatable(spark):
    docs, labels = labelled(spark)
    models = [q.fit(d, labels, max_train=100, min_rows=5) for d in (docs, docs.repartition(7))]
    assert all((getattr(models[0], a) == getattr(models[1], a)).all() for a in ("stat", "cut", "left", "value", "roots"))


@pytest.mark.parametrize("sf", [SF1])
def test_held_out(spark, duck, sf):
    """Documents whose labels were not learned are told apart."""
    truth = dict(duck.sql(f"select doc_id, quality from '{sf}/labels.parquet'").fetchall())
    rows = QUERIES["op11_quality_trees"](spark, sf).collect()
    assert len(rows) == duck.sql(f"select count(*) from '{sf}/documents.parquet'").fetchall()[0][0]
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert r["predicted"] == int(r["score"] >= 0.7)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    bad = [r for r in held if truth[r["doc_id"]] == 0]
    good = [r for r in held if truth[r["doc_id"]] == 1]
    assert sum(r["predicted"] for r in good) >= 0.98 * len(good)
    assert sum(r["predicted"] for r in bad) <= 0.05 * len(bad)
