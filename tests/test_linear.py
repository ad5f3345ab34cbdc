"""Incomplete beta and t-tests against known values; Gram fits against numpy."""

import numpy as np
from pyspark.sql import functions as F

from countpanel.functions import stats as S
from countpanel.operators import linear as L


def test_beta_and_t_values(spark):
    """Closed forms: I_x(a, 1) = x^a, I_x(1, b) = 1 - (1-x)^b, I_.5(a, a) = .5;
    t with one and two degrees of freedom."""
    rows = [(a, 1.0, x, x ** a) for a in (0.5, 3.0, 40.0) for x in (0.01, 0.5, 0.99)]
    rows += [(1.0, b, x, 1 - (1 - x) ** b) for b in (0.5, 3.0, 40.0) for x in (0.01, 0.5, 0.99)]
    rows += [(a, a, 0.5, 0.5) for a in (0.5, 7.0, 500.0, 20000.0)] + [(2.0, 2.0, 0.0, 0.0), (2.0, 2.0, 1.0, 1.0)]
    d = spark.createDataFrame(rows, "a double, b double, x double, want double")
    got = d.select("*", S.betainc(F.col("a"), F.col("b"), F.col("x")).alias("got")).collect()
    off = [(r.a, r.b, r.x, r.got - r.want) for r in got if not abs(r.got - r.want) < 1e-11 * max(1.0, r.a)]
    assert not off
    t = spark.createDataFrame([(t, df) for t in (0.0, 0.3, -2.5, 40.0) for df in (1, 2)], "t double, df long")
    for r in t.select("t", "df", S.t_test_p(F.col("t"), F.col("df")).alias("p")).collect():
        want = 1 - 2 / np.pi * np.arctan(abs(r.t)) if r.df == 1 else 1 - abs(r.t) / np.sqrt(2 + r.t ** 2)
        assert abs(r.p - want) < 1e-11
    bad = spark.createDataFrame([(0.0, 1.0, 0.5), (1.0, 1.0, 1.5), (1.0, 1.0, None)], "a double, b double, x double")
    assert [r[0] for r in bad.select(S.betainc(F.col("a"), F.col("b"), F.col("x"))).collect()] == [None] * 3
    # a tail far below the resolution of 1 keeps its digits (normal tail at t = 12)
    p = spark.range(1).select(S.t_test_p(F.lit(12.0), F.lit(100000))).first()[0]
    assert 1e-33 < p < 1e-32


def _data(spark, n=400):
    rng = np.random.default_rng(0)
    x = np.c_[rng.normal(5, 2, n), rng.integers(0, 4, n), rng.normal(size=n)]
    y = 3 + x @ [1.5, -2.0, 0.0] + rng.normal(size=n)
    rows = [(f"2024-01-{1 + i * 28 // n:02d}", *map(float, v), float(w)) for i, (v, w) in enumerate(zip(x, y))]
    return x, y, spark.createDataFrame(rows + [("2024-01-01", None, 1.0, 1.0, 1.0), ("2024-01-01", 1.0, 1.0, 1.0, None)],
                                       "day string, a double, b double, c double, y double")


def test_ols_equals_numpy(spark):
    x, y, d = _data(spark)
    got = {r.term: r for r in L.ols(d, "y", ["a", "b", "c"]).collect()}
    full = np.c_[np.ones(len(x)), x]
    beta, sse = np.linalg.lstsq(full, y, rcond=None)[:2]
    se = np.sqrt(np.diag(np.linalg.inv(full.T @ full)) * sse[0] / (len(x) - 4))
    for j, name in enumerate(("intercept", "a", "b", "c")):
        assert np.allclose([got[name].coef, got[name].std_err, got[name].t], [beta[j], se[j], beta[j] / se[j]])
    assert got["a"].p_value < 1e-50 and got["c"].p_value > 0.001
    # the normal equations hold: residuals are orthogonal to every column
    assert np.abs(full.T @ (y - full @ [got[n].coef for n in ("intercept", "a", "b", "c")])).max() < 1e-6
    same = L.ols(d.withColumn("twice", 2 * F.col("a")), "y", ["a", "twice"]).collect()  # collinear: no error
    assert abs(sum(r.coef * {"a": 1, "twice": 2}.get(r.term, 0) for r in same) - np.polyfit(x[:, 0], y, 1)[0]) < 1e-6
    assert L.ols(d.where("false"), "y", ["a"]).collect() == []


def test_ridge_path_and_folds_equal_numpy(spark):
    x, y, d = _data(spark)
    z = (x - x.mean(0)) / x.std(0)
    got = {(r.alpha, r.term): r.coef for r in L.ridge_path(d, "y", ["a", "b", "c"], [0.0, 7.5]).collect()}
    for alpha in (0.0, 7.5):
        want = np.linalg.solve(z.T @ z + alpha * np.eye(3), z.T @ (y - y.mean()))
        assert np.allclose([got[alpha, n] for n in "abc"], want) and abs(got[alpha, "intercept"] - y.mean()) < 1e-9
    days = np.array([f"2024-01-{1 + i * 28 // len(x):02d}" for i in range(len(x))])
    spans = [("2024-01-08", "2024-01-08", "2024-01-15"), ("2024-01-15", "2024-01-20", "2024-01-28"), ("2024-01-01", "2024-01-08", "2024-01-15")]
    out = L.walk_forward(d, "y", ["a", "b", "c"], F.col("day"), spans).collect()
    for r, (until, first, last) in zip(out, spans):
        train, test = days < until, (days >= first) & (days < last)
        assert (r.n_train, r.n_test) == (train.sum(), test.sum())
        if train.any():
            beta = np.linalg.lstsq(np.c_[np.ones(train.sum()), x[train]], y[train], rcond=None)[0]
            err = y[test] - np.c_[np.ones(test.sum()), x[test]] @ beta
            assert np.allclose([r.rmse, r.r2], [np.sqrt((err ** 2).mean()), 1 - (err ** 2).sum() / ((y[test] - y[test].mean()) ** 2).sum()])
    assert out[2].rmse is None and out[2].r2 is None
