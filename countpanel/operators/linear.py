"""Least squares from sufficient statistics.

One aggregate yields the Gram matrix of (1, x, y) per time slice.  A fit over
any union of slices, such as the expanding folds of a walk-forward test, is a
sum of these small matrices and a p x p solve on the driver, so all folds and
penalties together need one scan.  The sums of squares of a test slice come from
the same matrices: errors of every fold are known without a second pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countpanel.functions.stats import t_test_p


@dataclass
class Gram:
    """Sums of products of the columns [1, x..., y] over some rows."""

    names: list[str]
    products: np.ndarray

    @property
    def n(self) -> int:
        return int(round(self.products[0, 0]))

    def __add__(self, other: Gram) -> Gram:
        return Gram(self.names, self.products + other.products)

    def solve(self, alpha: float = 0.0) -> np.ndarray:
        """Coefficients [intercept, x...] that minimise the squared error plus
        alpha times the squared coefficients (not the intercept's); columns that
        add nothing get the smallest coefficients."""
        p = len(self.products) - 1
        a, b = self.products[:p, :p].copy(), self.products[:p, p]
        a[np.arange(1, p), np.arange(1, p)] += alpha
        scale = np.sqrt(np.where(np.diag(a) > 0, np.diag(a), 1.0))
        return np.linalg.lstsq(a / np.outer(scale, scale), b / scale, rcond=1e-12)[0] / scale

    def squared_error(self, beta: np.ndarray) -> float:
        """Sum of squared errors of these rows under ``beta``."""
        v = np.append(beta, -1.0)
        return max(0.0, float(v @ self.products @ v))

    def total(self) -> float:
        """Sum of squares of y around its mean."""
        s = self.products
        return max(0.0, float(s[-1, -1] - s[0, -1] ** 2 / s[0, 0])) if self.n else 0.0


def grams(df: DataFrame, y: str, xs: Sequence[str], part: Column | None = None) -> dict[object, Gram]:
    """One Gram matrix per value of ``part`` (a bounded number of slices; one
    without it).  Rows with a missing y or x take no part."""
    names = ["1", *xs, y]
    cols = [F.lit(1.0), *[F.col(f"`{c}`").cast("double") for c in (*xs, y)]]
    d = df.select((F.lit(0) if part is None else part).alias("_part"), *[c.alias(f"c{j}") for j, c in enumerate(cols)]).dropna(
        subset=[f"c{j}" for j in range(len(cols))])
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    rows = d.groupBy("_part").agg(*[F.sum(F.col(f"c{i}") * F.col(f"c{j}")).alias(f"p{i}_{j}") for i, j in pairs]).collect()
    out = {}
    for r in rows:
        m = np.zeros((len(cols), len(cols)))
        for i, j in pairs:
            m[i, j] = m[j, i] = r[f"p{i}_{j}"]
        out[r["_part"]] = Gram(names, m)
    return out


def ols(df: DataFrame, y: str, xs: Sequence[str]) -> DataFrame:
    """(term, coef, std_err, t, p_value, r2), largest |t| first; p-values from
    a column expression.  One scan."""
    spark, found = df.sparkSession, grams(df, y, xs)
    schema = "term string, coef double, std_err double, t double, r2 double, df long"
    if not found:
        return spark.createDataFrame([], schema).withColumn("p_value", F.lit(None).cast("double")).drop("df")
    g = found[0]
    beta, p = g.solve(), len(xs) + 1
    free, sse = g.n - p, g.squared_error(g.solve())
    cov = np.linalg.pinv(g.products[:p, :p]) * sse / free if free > 0 else np.full((p, p), np.nan)
    se = np.sqrt(np.maximum(np.diag(cov), 0.0))
    r2 = 1 - sse / g.total() if g.total() else None
    rows = [(name, float(b), none(s), none(b / s if s else np.nan), r2, free) for name, b, s in zip(["intercept", *xs], beta, se)]
    out = spark.createDataFrame(rows, schema).withColumn("p_value", t_test_p(F.col("t"), F.col("df")))
    return out.select("term", "coef", "std_err", "t", "p_value", "r2").orderBy(F.abs("t").desc_nulls_last(), "term")


def none(v: float) -> float | None:
    return float(v) if np.isfinite(v) else None


def ridge_path(df: DataFrame, y: str, xs: Sequence[str], alphas: Sequence[float]) -> DataFrame:
    """(alpha, term, coef) of standardised predictors for every penalty, from
    one scan; an absent y or x leaves the row out."""
    found = grams(df, y, xs)
    if not found:
        return df.sparkSession.createDataFrame([], "alpha double, term string, coef double")
    scaled = standardised(found[0])
    rows = [(float(a), name, float(b)) for a in alphas for name, b in zip(["intercept", *xs], scaled.solve(a))]
    return df.sparkSession.createDataFrame(rows, "alpha double, term string, coef double")


def standardised(g: Gram) -> Gram:
    """The Gram matrix of the same rows with every x at mean 0 and population
    deviation 1 (constant columns become 0)."""
    s, n = g.products, max(g.n, 1)
    mean = s[0] / n
    std = np.sqrt(np.maximum(np.diag(s) / n - mean ** 2, 0.0))
    t = np.eye(len(s))
    for j in range(1, len(s) - 1):
        t[j, j] = 1 / std[j] if std[j] > 1e-12 * max(1.0, abs(mean[j])) else 0.0
        t[0, j] = -mean[j] * t[j, j]
    return Gram(g.names, t.T @ s @ t)


def walk_forward(df: DataFrame, y: str, xs: Sequence[str], day: Column, spans: Sequence[tuple[str, str, str]], alpha: float = 0.0) -> DataFrame:
    """(fold, n_train, n_test, rmse, r2) of a linear model per expanding fold
    (train_until, test_from, test_until; ISO days): all folds from one scan.

    ``day`` is the row's ISO day; the slices are the stretches between the
    folds' edges."""
    edges = sorted({e for span in spans for e in span})
    part = F.lit(-1)
    for k, e in enumerate(edges):
        part = F.when(day >= F.lit(e), F.lit(k)).otherwise(part)
    found = grams(df, y, xs, part)
    zero = Gram(["1", *xs, y], np.zeros((len(xs) + 2,) * 2))

    def over(lo: int, hi: int) -> Gram:
        return sum((found[k] for k in range(lo, hi) if k in found), zero)

    rows = []
    for i, (until, first, last) in enumerate(spans):
        train, test = over(-1, edges.index(until)), over(edges.index(first), edges.index(last))
        sse = test.squared_error(train.solve(alpha)) if train.n and test.n else np.nan
        rows.append((i, train.n, test.n, none(np.sqrt(sse / test.n)) if test.n else None, none(1 - sse / test.total()) if test.total() else None))
    return df.sparkSession.createDataFrame(rows, "fold int, n_train long, n_test long, rmse double, r2 double")

