"""Math expressions (X4) and numeric cleaning helpers."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cyclic(x, period: float) -> tuple[Column, Column]:
    """(sin, cos) encoding of a cyclic value with the given period."""
    a = F.lit(2 * math.pi) * col(x) / F.lit(float(period))
    return F.sin(a), F.cos(a)


def clip(x, lo=None, hi=None) -> Column:
    c = col(x)
    if lo is not None:
        c = F.greatest(c, F.lit(lo))
    if hi is not None:
        c = F.least(c, F.lit(hi))
    return c


def finite(x) -> Column:
    """NaN and +-inf become null (pandas skips them; Spark would propagate)."""
    c = col(x)
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(None)).otherwise(c)


def ratio(a, b, eps: float | None = None) -> Column:
    """a / b; with ``eps`` the denominator gets +eps, else division by 0 is null."""
    if eps is not None:
        return col(a) / (col(b) + F.lit(eps))
    return F.try_divide(col(a), col(b))


def r6(x, d: int = 6) -> Column:
    """Round for engine-independent output (float noise << 1e-6)."""
    return F.round(col(x), d)


def r9(x) -> Column:
    """Snap a value with at most 7 exact decimals to its decimal value:
    no rounding ties, float noise removed."""
    return F.round(col(x), 9)
