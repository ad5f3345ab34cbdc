"""Deep forests on many rows: nodes split by sums over all blocks and grown by
one task are one tree, and the learner is Spark's."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from countpanel.operators import forests as R
from countpanel.operators import models as M

XS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    """y depends on a and b, hardly on c."""
    u = lambda k: F.pmod(F.xxhash64("id", F.lit(k)), F.lit(1000)) / 1000.0
    d = spark.range(6000).select("id", (u(1) * 24).cast("int").cast("double").alias("a"), u(2).alias("b"), u(3).alias("c"), (u(4) - 0.5).alias("noise"))
    return d.withColumn("y", F.col("a") * 2 + F.when(F.col("b") > 0.4, 30.0).otherwise(0.0) + F.col("noise")).cache()


def score(p):
    return p.agg(F.avg(F.abs(F.col("y") - F.col("prediction")))).first()[0]


def test_many_rows_take_the_blocks(rows, monkeypatch):
    """Above the number of rows the forest is grown by blocks, about as well as Spark's; below it is Spark's."""
    train, test = rows.filter("id % 5 > 0"), rows.filter("id % 5 = 0")
    fit = lambda depth: M.forest(train, test, "y", XS, trees=10, depth=depth, min_instances=1)
    small, few = fit(13)
    monkeypatch.setattr(M, "MANY_ROWS", 1000)
    for name, number in (("BLOCK_ROWS", 512), ("LOCAL_ROWS", 700), ("MOVED_ROWS", 20_000)):
        monkeypatch.setattr(R, name, number)
    large, many = fit(13)
    assert isinstance(large, R.Forest) and not isinstance(small, R.Forest) and not isinstance(fit(5)[0], R.Forest)
    assert many.columns == few.columns and many.count() == 1200
    assert score(many) < 1.1 * score(few)
    assert np.allclose(large.featureImportances.toArray(), small.featureImportances.toArray(), atol=0.05)
    assert len(large.trees) == 10 and len({len(t.left) for t in large.trees}) > 1


def test_split_and_grown_nodes_make_one_tree(rows, monkeypatch):
    """With every feature open to every node, the tree does not depend on where
    a node is split; every row is in the node that its value comes from."""
    monkeypatch.setattr(R, "BLOCK_ROWS", 512)
    d = M.cut_lineage(M.assemble(rows.select(*XS, "y"), XS).select("features", "y"))
    found = []
    for local in (200, 1500, 100_000):
        monkeypatch.setattr(R, "LOCAL_ROWS", local)
        found.append(R.fit(d, "y", 6000, 2, 8, 1.0, 1, 7))
    pdf = d.toPandas()
    x, y = np.stack([v.toArray() for v in pdf["features"]]), pdf["y"].to_numpy()
    bins = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(found[0].edges)], 1).astype(np.uint8)
    p = [m.predict(bins) for m in found]
    assert np.allclose(p[0], p[1]) and np.allclose(p[0], p[2]) and np.abs(p[0] - y).mean() < 1
    for t in found[0].trees:
        inner = t.left != np.arange(len(t.left))
        assert 255 > inner.sum() > 50 and (t.gain[inner] > 0).all() and (t.cut[~inner] == 255).all()
        depth = np.zeros(len(t.left), int)
        for v in np.flatnonzero(inner):
            depth[[t.left[v], t.left[v] + 1]] = depth[v] + 1
        assert depth.max() == 8


def test_single_tree_equals_brute_force():
    """Best split of the squared error by trying every one."""
    rng = np.random.default_rng(3)
    x, y, seen = rng.integers(0, 6, (300, 2)).astype(np.uint8), rng.normal(size=300), R.times_seen(1, 2, 3, 300)
    tree = R.grow(x, y, seen, 1, 5, 2, rng)
    err = lambda m: ((y[m] - np.average(y[m], weights=seen[m])) ** 2 * seen[m]).sum() if seen[m].sum() else 0.0
    tried = {(j, c): err(x[:, j] >= 0) - err(x[:, j] <= c) - err(x[:, j] > c) for j in range(2) for c in range(5)
             if min(seen[x[:, j] <= c].sum(), seen[x[:, j] > c].sum()) >= 5}
    best = max(tried, key=tried.get)
    assert (tree.feature[0], tree.cut[0]) == best and tree.gain[0] == pytest.approx(tried[best])
    left = x[:, best[0]] <= best[1]
    assert tree.value[1:] == pytest.approx([np.average(y[m], weights=seen[m]) for m in (left, ~left)])


def test_edges_and_odd_labels(spark, rows):
    edges = R.find_edges(np.array([[1.0, 5.0, v] for v in range(100)]))
    assert [len(e) for e in edges] == [0, 0, 31] and edges[2][0] == 2.5
    assert R.find_edges(np.array([[1.0], [3.0], [3.0]]))[0].tolist() == [2.0]
    same = R.grow(np.arange(6, dtype=np.uint8).reshape(-1, 1), np.full(6, 0.1), np.ones(6, np.uint8), 5, 1, 1, np.random.default_rng(0))
    assert len(same.left) == 1 and same.value[0] == pytest.approx(0.1)
    assert R.times_seen(1, 1, 1, 100_000).mean() == pytest.approx(1, abs=0.02)
    bad = M.assemble(rows.select(*XS, F.when(F.col("id") > 0, F.col("y")).alias("y")), XS).select("features", "y")
    with pytest.raises(ValueError, match="1 labels"):
        R.fit(bad, "y", 6000, 2, 3, 1.0, 1, 7)
