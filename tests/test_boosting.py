"""Leaf-wise boosting: equal to a plain best-first tree, the same for any
partitioning, defined cases."""

import heapq

import numpy as np
import pytest
from pyspark.sql import functions as F

from countpanel.operators import boosting as B


def plain_tree(bins, residual, leaves, min_rows, l2=0.0):
    """{path: (feature, cut, n, total)} of the best-first tree, row by row."""
    def best(rows):
        found = None
        for j in range(bins.shape[1]):
            for cut in range(256):
                left = rows[bins[rows, j] <= cut]
                right = rows[bins[rows, j] > cut]
                if min(len(left), len(right)) < min_rows:
                    continue
                gain = sum(residual[r].sum() ** 2 / (len(r) + l2) for r in (left, right)) - residual[rows].sum() ** 2 / (len(rows) + l2)
                if gain > 1e-12 and (found is None or gain > found[0] + 1e-15):
                    found = (gain, j, cut, left, right)
        return found

    whole = np.arange(len(bins))
    out, queue, splits = {"": (len(whole), residual.sum())}, [], {"": best(whole)}
    if splits[""]:
        queue.append((-splits[""][0], ""))
    inner = {}
    while queue and len(inner) < leaves - 1:
        _, path = heapq.heappop(queue)
        gain, j, cut, left, right = splits[path]
        inner[path] = (j, cut)
        for side, rows in (("l", left), ("r", right)):
            out[path + side] = (len(rows), residual[rows].sum())
            splits[path + side] = best(rows)
            if splits[path + side]:
                heapq.heappush(queue, (-splits[path + side][0], path + side))
    return inner, out


def paths(tree):
    inner, out, todo = {}, {}, [(0, "")]
    for node, path in todo:
        out[path] = (tree.n[node], tree.total[node] * B.UNIT)
        if tree.left[node] != node:
            inner[path] = (tree.feature[node], tree.cut[node])
            todo += [(tree.left[node], path + "l"), (tree.left[node] + 1, path + "r")]
    return inner, out


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(7)
    n = 600
    x = np.c_[rng.integers(0, 24, n), rng.integers(0, 7, n), rng.normal(size=n), rng.integers(0, 2, n)]
    y = np.round(np.where(x[:, 0] > 11, 5, 1) * (1 + x[:, 3]) + (x[:, 1] > 4) * 3 + x[:, 2] + rng.normal(size=n) * 0.3, 3)
    rows = [(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))]
    rows[3] = (3, None, *rows[3][2:])
    rows[4] = (4, 1.0, float("nan"), *rows[4][3:])
    return rows, spark.createDataFrame(rows, "id long, hour double, dow double, z double, flag double, y double")


FEATURES = ["hour", "dow", "z", "flag"]


def test_first_tree_equals_plain_best_first(spark, data):
    rows, df = data
    model = B.fit_leafwise(df, "y", FEATURES, ["id"], trees=1, leaves=12, bins=16, min_rows=15)
    x = np.array([[np.nan if v is None else v for v in r[1:5]] for r in rows], float)
    import pyarrow as pa
    bins = B.to_bins(pa.array([[None if np.isnan(v) else v for v in r] for r in x], pa.list_(pa.float64())), model.edges)
    y = np.array([r[5] for r in rows])
    inner, sums = plain_tree(bins, y - model.base, 12, 15)
    got_inner, got_sums = paths(model.trees[0])
    assert got_inner == inner and len(inner) == 11
    assert {p: v[0] for p, v in got_sums.items()} == {p: v[0] for p, v in sums.items()}
    assert all(abs(got_sums[p][1] - v[1]) < 1e-3 for p, v in sums.items())
    # nodes as a table; the prediction is the leaf's mean
    nodes = {r["node"]: r for r in model.nodes(spark).collect()}
    assert nodes[0]["n"] == 600 and nodes[0]["feature"] == FEATURES[inner[""][0]]
    p = {r["id"]: r["prediction"] for r in model.predict(df).collect()}
    leaf = model.trees[0].leaves(bins)
    for at in set(leaf.tolist()):
        rows_at = np.flatnonzero(leaf == at)
        want = model.base + model.rate * (y[rows_at] - model.base).mean()
        assert all(abs(p[i] - want) < 1e-5 for i in rows_at.tolist())


def test_same_trees_for_any_partitioning(data):
    _, df = data
    options = dict(trees=5, leaves=8, bins=16, min_rows=10, subsample=0.8, colsample=0.75, rewrite=2, rate=0.3, valid=F.col("id") % 7 == 0)
    a, b, c = (B.fit_leafwise(d, "y", FEATURES, ["id"], **options) for d in (df, df.repartition(7), df.orderBy(F.col("z")).coalesce(1)))
    assert a.trees == b.trees == c.trees and a.losses == b.losses == c.losses and len(a.trees) == 5
    assert a.losses[-1] < 0.5 * a.losses[0]


def test_early_stop_keeps_the_best_trees(data):
    _, df = data
    model = B.fit_leafwise(df, "y", FEATURES, ["id"], trees=40, leaves=30, bins=32, min_rows=2, rate=1.0, patience=3, valid=F.col("id") % 3 == 0)
    best = int(np.argmin(model.losses))
    assert len(model.trees) == max(1, best) and len(model.losses) == best + 4


def test_defined_cases(spark, data):
    _, df = data
    none = B.fit_leafwise(df.where("false"), "y", FEATURES, ["id"], trees=3)
    assert {r.prediction for r in none.predict(df).select("prediction").collect()} == {0.0} and none.predict(df.where("false")).count() == 0
    nulls = df.withColumns({"y": F.lit(None).cast("double")})
    assert B.fit_leafwise(nulls, "y", FEATURES, ["id"], trees=3).trees == []
    same = df.withColumns({c: F.lit(1.0) for c in FEATURES})
    assert B.fit_leafwise(same, "y", FEATURES, ["id"], trees=3).trees == []
    # only the null bin tells the rows apart
    gap = spark.createDataFrame([(i, None if i % 2 else 1.0, float(i % 2)) for i in range(100)], "id long, x double, y double")
    model = B.fit_leafwise(gap, "y", ["x"], ["id"], trees=1, rate=1.0, min_rows=1)
    assert {(r.x, round(r.prediction, 4)) for r in model.predict(gap).collect()} == {(None, 1.0), (1.0, 0.0)}
    logged = B.fit_leafwise(gap, "y", ["x"], ["id"], trees=1, rate=1.0, min_rows=1, target="log1p")
    assert {(r.x, round(r.prediction, 4)) for r in logged.predict(gap).collect()} == {(None, 1.0), (1.0, 0.0)}


def test_batches_of_splits(data):
    """Every split of a batched tree is the best of its own leaf."""
    rows, df = data
    exact, batched = (B.fit_leafwise(df, "y", FEATURES, ["id"], trees=1, leaves=12, bins=16, min_rows=15, batch=b) for b in (None, 4))
    a, b = paths(exact.trees[0])[0], paths(batched.trees[0])[0]
    assert len(b) == 11 and all(b[p] == a[p] for p in set(a) & set(b)) and len(set(a) & set(b)) >= 8
