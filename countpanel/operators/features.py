"""Model-input features (F4 panel features, F18 seasonal naive, F19 panel prep)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countpanel.functions import dates as D
from countpanel.functions import numeric as N
from countpanel.functions.encode import apply_codes, fit_codes
from countpanel.operators import windows as W


def panel_features(df: DataFrame, key: str, ts: str, col: str, holidays,
                   codes: DataFrame | None = None, lags=(1, 24, 168),
                   rolling=((24, 3), (168, 24)), exact_scale: int | None = None, hourly: bool = True, **kw) -> DataFrame:
    """Calendar parts, cyclic encodings, holiday flags, entity code, lags and
    trailing means (previous rows only) - every window column shares one
    partitioning and one sort.

    ``exact_scale``: the value is fixed-point with that many decimals (counts
    with 2 decimals); trailing sums are then exact DECIMAL sums, so means do
    not drift with summation order and are reproducible bit for bit.

    ``hourly``: ``df`` has one row per key and hour, as an hourly aggregate
    gives it.  The calendar then bounds a series (876,600 rows a century) and a
    series is one window partition.  Otherwise (several rows an hour, so a hot
    key may hold any number) windows run in (key, chunk) pieces, with ``kw`` for
    :func:`windows.framed`."""
    t = F.col(ts)
    d = df.withColumns({
        "hour": F.hour(t), "day_of_week": D.weekday0(t), "month": F.month(t), "year": F.year(t),
    }).withColumn("is_weekend", F.col("day_of_week").isin(5, 6).cast("int"))
    d = D.holiday_flags(d, ts, holidays)
    for name, period in (("hour", 24), ("dow", 7), ("month", 12)):
        src = "day_of_week" if name == "dow" else name
        s, c = N.cyclic(src, period)
        d = d.withColumns({f"{name}_sin": s, f"{name}_cos": c})
    codes = codes if codes is not None else fit_codes(df, key)
    d = apply_codes(d, codes, key)
    span = max(max(lags), max(n for n, _ in rolling))

    def exprs(w):
        out = {f"lag_{n}": F.lag(col, n).over(w) for n in lags}
        for n, m in rolling:
            fw = w.rowsBetween(-n, -1)
            if exact_scale is None:
                mean = F.avg(col).over(fw)
            else:
                exact = F.sum(F.col(col).cast(f"decimal(38,{exact_scale})")).over(fw)
                mean = exact.cast("double") / F.count(col).over(fw)
            out[f"rolling_{n}_mean"] = F.when(F.count(col).over(fw) >= m, mean)
        return out

    return W.framed(d, [key], ts, exprs, -span, 0, bounded_series=hourly, **kw)


def seasonal_naive(df: DataFrame, key: str, ds: str, col: str, k: int = 7, **kw) -> DataFrame:
    """Forecast = the value k rows earlier."""
    return W.framed(df, [key], ds, lambda w: {"y_naive": F.lag(col, k).over(w)}, -k, 0, **kw)
