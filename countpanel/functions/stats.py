"""Distribution functions as column expressions: no UDF, no driver pass."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TINY = 1e-300


def lgamma(x: Column) -> Column:
    """Natural logarithm of the gamma function for x > 0: Stirling's series
    after a shift by eight."""
    shifted = F.lit(0.0)
    for k in range(8):
        shifted = shifted + F.log(x + k)
    y = x + 8
    # fixed values: the Bernoulli terms of the series
    series = sum((F.lit(c) / F.pow(y, F.lit(float(p))) for c, p in ((1 / 12, 1), (-1 / 360, 3), (1 / 1260, 5), (-1 / 1680, 7), (1 / 1188, 9))), F.lit(0.0))
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - shifted


def _fraction(a: Column, b: Column, x: Column, terms: int) -> Column:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    away = lambda v: F.when(F.abs(v) < TINY, F.lit(TINY)).otherwise(v)
    d0 = 1.0 / away(1.0 - (a + b) * x / (a + 1.0))
    start = F.struct(F.lit(1.0).alias("c"), d0.alias("d"), d0.alias("h"))

    def step(s: Column, m: Column) -> Column:
        m = m.cast("double")
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        return _lentz(_lentz(s, even, away), odd, away)

    return F.aggregate(F.sequence(F.lit(1), F.lit(terms)), start, step, lambda s: s["h"])


def _lentz(s: Column, term: Column, away) -> Column:
    # one-element arrays bind the intermediate values, which are used twice
    made = F.transform(F.array(F.struct(away(1.0 + term / s["c"]).alias("c"), (1.0 / away(1.0 + term * s["d"])).alias("d"), s["h"].alias("h"))),
                       lambda t: F.struct(t["c"].alias("c"), t["d"].alias("d"), (t["h"] * t["c"] * t["d"]).alias("h")))
    return F.element_at(made, 1)


def betainc(a: Column, b: Column, x: Column, terms: int = 300) -> Column:
    """Regularised incomplete beta function I_x(a, b) for a, b > 0 and x in
    [0, 1]; null for other arguments.  ``terms`` of the continued fraction are
    enough for a, b up to about terms^2."""
    front = lambda a, b, x: F.exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * F.log(x) + b * F.log(1.0 - x)) / a
    left = x < (a + 1.0) / (a + b + 2.0)  # where the fraction converges fast
    p, q, z = F.when(left, a).otherwise(b), F.when(left, b).otherwise(a), F.when(left, x).otherwise(1.0 - x)
    tail = front(p, q, z) * _fraction(p, q, z, terms)
    inner = F.when(left, tail).otherwise(1.0 - tail)
    return F.when((a <= 0) | (b <= 0) | (x < 0) | (x > 1), F.lit(None).cast("double")).when(x == 0, F.lit(0.0)).when(x == 1, F.lit(1.0)).otherwise(inner)


def t_test_p(t: Column, df: Column) -> Column:
    """Two-sided p-value of a t statistic with ``df`` degrees of freedom."""
    df = df.cast("double")
    return betainc(df / 2, F.lit(0.5), df / (df + t * t))
