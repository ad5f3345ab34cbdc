"""Wave 3: order-dependent operators (windows, gap filling, anomaly layers,
panel features) with DuckDB oracles over whole partitions."""

from __future__ import annotations

from pyspark.sql import functions as F

from countpanel.functions import dates as D
from countpanel.functions import numeric as N
from countpanel.operators import anomaly as NA
from countpanel.operators import features as FE
from countpanel.operators import windows as W
from countpanel.plans.core import HOLIDAY_SQL, HOLIDAYS
from countpanel.plans.registry import query

r6 = N.r6


def r4(c):
    """Daily totals reach 1e6: float noise ~1e-10, so compare at 4 decimals."""
    return F.round(F.col(c) if isinstance(c, str) else c, 4)


WIN = "PARTITION BY unique_id ORDER BY ds"
# Daily totals are snapped to their exact 2-decimal value first, so both
# engines start from the same doubles and the element-wise gap filling
# (interpolation, lag / lead fills) gives bit-identical results.
REINDEX_SQL = """
dy AS (SELECT unique_id, ds, ROUND(y, 2) AS y FROM v_daily),
span AS (SELECT unique_id, MIN(ds) AS lo, MAX(ds) AS hi FROM dy GROUP BY 1),
cal AS (SELECT unique_id, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS ds FROM span),
full_ AS (SELECT cal.unique_id, cal.ds, d.y FROM cal LEFT JOIN dy d ON cal.unique_id = d.unique_id AND cal.ds = d.ds)
"""


def interp_sql(src: str, name: str, limit: int = 3) -> str:
    return f"""
{name}_p AS (SELECT *, row_number() OVER ({WIN}) AS p FROM {src}),
{name}_k AS (SELECT *,
  last_value(CASE WHEN y IS NOT NULL THEN p END IGNORE NULLS) OVER ({WIN} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pp,
  last_value(y IGNORE NULLS) OVER ({WIN} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS yp,
  first_value(CASE WHEN y IS NOT NULL THEN p END IGNORE NULLS) OVER ({WIN} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS pn,
  first_value(y IGNORE NULLS) OVER ({WIN} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS yn
  FROM {name}_p),
{name} AS (SELECT * EXCLUDE (y, p, pp, yp, pn, yn),
  CASE WHEN y IS NOT NULL THEN y WHEN pp IS NULL OR p - pp > {limit} THEN NULL WHEN pn IS NULL THEN yp
       ELSE yp + (yn - yp) * (p - pp) / (pn - pp) END AS y FROM {name}_k)"""


def seasonal_sql(src: str, name: str, k: int = 7) -> str:
    return (f"{name} AS (SELECT * EXCLUDE (y), COALESCE(y, lag(y, {k}) OVER ({WIN}), lead(y, {k}) OVER ({WIN})) AS y "
            f"FROM {src})")


N1_SQL = REINDEX_SQL + "," + interp_sql("full_", "interp") + ",\n" + seasonal_sql("interp", "n1")


def _snapped(fx):
    return fx.daily.withColumn("y", F.round("y", 2))


def _n1(fx):
    return NA.continuous_daily(_snapped(fx), "unique_id", "ds", "y")


# ---------------------------------------------------------------- J12
@query("j12_reindex_daily", f"WITH {REINDEX_SQL} SELECT unique_id, ds, y FROM full_")
def j12(fx):
    """Complete daily calendar per series, facts left-joined (gaps -> null)."""
    return W.reindex_daily(_snapped(fx), "unique_id", "ds", ["y"])


# ---------------------------------------------------------------- W1-W16
@query("w1_add_lags", f"""
SELECT unique_id, ds, ROUND(lag(y, 1) OVER ({WIN}), 4) AS lag_1, ROUND(lag(y, 7) OVER ({WIN}), 4) AS lag_7 FROM v_daily
""")
def w1(fx):
    """Positional lags 1 and 7 per series."""
    d = W.add_lags(fx.daily, ["unique_id"], "ds", "y", [1, 7])
    return d.select("unique_id", "ds", r4("lag_1").alias("lag_1"), r4("lag_7").alias("lag_7"))


@query("w2_time_lags", """
SELECT w.site_id, w.time, a.temperature_2m AS tlag_1, b.temperature_2m AS tlag_24 FROM v_weather w
LEFT JOIN v_weather a ON a.site_id = w.site_id AND a.time = w.time - INTERVAL 1 HOUR
LEFT JOIN v_weather b ON b.site_id = w.site_id AND b.time = w.time - INTERVAL 24 HOUR
""")
def w2(fx):
    """Time-true lags: the value 1 and 24 hours earlier, null when absent."""
    d = W.add_time_lags(fx.weather.select("site_id", "time", "temperature_2m"), ["site_id"], "time",
                        "temperature_2m", [1, 24])
    return d.select("site_id", "time", "tlag_1", "tlag_24")


@query("w3_lead_flag", """
SELECT site_id, time, COALESCE(lead(precipitation, 1) OVER (PARTITION BY site_id ORDER BY time) > 0, false) AS rain_next
FROM v_weather
""")
def w3(fx):
    """Rain in the next step of the same site."""
    d = W.lead_flag(fx.weather, ["site_id"], "time", "precipitation", "rain_next")
    return d.select("site_id", "time", "rain_next")


@query("w4_rolling_mean", f"""
SELECT unique_id, ds, ROUND(CASE WHEN COUNT(y) OVER ({WIN} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) >= 3
       THEN AVG(y) OVER ({WIN} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) END, 4) AS rolling_7_mean FROM v_daily
""")
def w4(fx):
    """Mean of the previous 7 rows (current excluded), at least 3 present."""
    d = W.rolling_stats(fx.daily, ["unique_id"], "ds", "y", 7, min_periods=3)
    return d.select("unique_id", "ds", r4("rolling_7_mean").alias("rolling_7_mean"))


@query("w5_rolling_std", f"""
SELECT unique_id, ds,
  ROUND(CASE WHEN COUNT(y) OVER ({WIN} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) >= 2
        THEN AVG(y) OVER ({WIN} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) END, 4) AS rolling_7_mean,
  ROUND(CASE WHEN COUNT(y) OVER ({WIN} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) >= 2
        THEN stddev_samp(y) OVER ({WIN} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) END, 4) AS rolling_7_std
FROM v_daily
""")
def w5(fx):
    """Trailing 7-row mean and sample std (current row included)."""
    d = W.rolling_stats(fx.daily, ["unique_id"], "ds", "y", 7, min_periods=2, include_current=True,
                        stats=("mean", "std"))
    return d.select("unique_id", "ds", r4("rolling_7_mean").alias("rolling_7_mean"),
                    r4("rolling_7_std").alias("rolling_7_std"))


@query("w6_rolling_median", f"""
SELECT unique_id, ds, ROUND(CASE WHEN COUNT(y) OVER ({WIN} ROWS BETWEEN 15 PRECEDING AND 14 FOLLOWING) >= 7
       THEN quantile_cont(y, 0.5) OVER ({WIN} ROWS BETWEEN 15 PRECEDING AND 14 FOLLOWING) END, 4) AS rolling_med
FROM v_daily
""")
def w6(fx):
    """Centred 30-row rolling median, at least 7 values."""
    d = W.rolling_median(fx.daily, ["unique_id"], "ds", "y", 30, 7, bounded_series=True)
    return d.select("unique_id", "ds", r4("rolling_med").alias("rolling_med"))


@query("w7_group_transform", """
SELECT event_id, ROUND(AVG(cnt) OVER (PARTITION BY site_id), 6) AS site_mean,
       ROUND(quantile_cont(cnt, 0.5) OVER (PARTITION BY site_id), 6) AS site_median FROM v_counts
""")
def w7(fx):
    """Group mean and median broadcast back to the rows."""
    d = W.group_transform(fx.counts, ["site_id"], "cnt", "mean", "site_mean")
    d = W.group_transform(d, ["site_id"], "cnt", "median", "site_median")
    return d.select("event_id", r6("site_mean").alias("site_mean"), r6("site_median").alias("site_median"))


@query("w8_add_rank", """
WITH t AS (SELECT site_id, ROUND(SUM(cnt), 6) AS total FROM v_counts GROUP BY 1)
SELECT site_id, total, row_number() OVER (ORDER BY total DESC, site_id) AS rank FROM t
""")
def w8(fx):
    """Rank 1..n of sites by total (global rank on a small aggregate)."""
    t = fx.counts.groupBy("site_id").agg(r6(F.sum("cnt")).alias("total"))
    return W.add_rank(t, [F.col("total").desc(), F.col("site_id")])


@query("w9_tail_per_group", f"""
SELECT unique_id, ds, ROUND(y, 4) AS y FROM (
  SELECT *, row_number() OVER (PARTITION BY unique_id ORDER BY ds DESC) AS rn FROM v_daily) WHERE rn <= 30
""")
def w9(fx):
    """The newest 30 rows per series."""
    return W.tail_per_group(fx.daily, ["unique_id"], "ds", 30).withColumn("y", r4("y"))


@query("w10_head_per_group", """
SELECT site_id, event_id, cnt FROM (
  SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY cnt DESC, event_id) AS rn FROM v_counts) WHERE rn <= 3
""")
def w10(fx):
    """First 3 rows per site after sorting by count (per-group top-k)."""
    d = W.head_per_group(fx.counts, ["site_id"], [F.col("cnt").desc(), F.col("event_id")], 3)
    return d.select("site_id", "event_id", "cnt")


@query("w11_zscore", """
SELECT unique_id, ds, ROUND((y - AVG(y) OVER (PARTITION BY unique_id)) / NULLIF(stddev_pop(y) OVER (PARTITION BY unique_id), 0), 6)
       AS y FROM v_daily
""")
def w11(fx):
    """Per-series z-score (population std), fitted stats kept as a table."""
    return W.zscore(fx.daily, ["y"], ["unique_id"]).select("unique_id", "ds", r6("y").alias("y"))


@query("w12_minmax", """
SELECT o_orderkey, ROUND((actual - MIN(actual) OVER ()) / NULLIF(MAX(actual) OVER () - MIN(actual) OVER (), 0), 6)
       AS actual_norm FROM v_pred
""")
def w12(fx):
    """Min-max normalisation with a one-row min / max table."""
    return W.minmax(fx.pred, "actual", "actual_norm").select("o_orderkey", r6("actual_norm").alias("actual_norm"))


@query("w13_standardise_profile", """
WITH p AS (SELECT site_id, CAST(hour(start_time) AS INTEGER) AS hour, AVG(cnt) AS m FROM v_counts GROUP BY 1, 2)
SELECT site_id, hour, ROUND((m - AVG(m) OVER (PARTITION BY site_id)) / NULLIF(stddev_pop(m) OVER (PARTITION BY site_id), 0), 6)
       AS z FROM p
""")
def w13(fx):
    """Row-standardised hourly profile per site (long form)."""
    p = fx.counts.groupBy("site_id", F.hour("start_time").alias("hour")).agg(F.avg("cnt").alias("m"))
    return W.standardise_profile(p, "site_id", "m", "z").select("site_id", "hour", r6("z").alias("z"))


@query("w14_interpolate", f"WITH {REINDEX_SQL}, {interp_sql('full_', 'interp')} "
       "SELECT unique_id, ds, y FROM interp")
def w14(fx):
    """Linear interpolation of at most 3 consecutive missing days."""
    full = W.reindex_daily(_snapped(fx), "unique_id", "ds", ["y"], with_pos=True)
    return W.interpolate(full, "unique_id", "ds", "y", limit=3, positioned=True).drop("_pos")


@query("w15_seasonal_fill", f"WITH {REINDEX_SQL}, {seasonal_sql('full_', 'sf')} "
       "SELECT unique_id, ds, y FROM sf")
def w15(fx):
    """Missing day <- value 7 rows before, else 7 rows after."""
    full = W.reindex_daily(_snapped(fx), "unique_id", "ds", ["y"], with_pos=True)
    return W.seasonal_fill(full, "unique_id", "ds", "y", 7, positioned=True).drop("_pos")


ISO_COLS = ["rolling_med", "deviation", "lag_7", "lag_28", "change_7", "change_28"]


@query("w16_iso_features", f"""
WITH {N1_SQL},
f AS (SELECT unique_id, ds, y,
  CASE WHEN COUNT(y) OVER ({WIN} ROWS BETWEEN 15 PRECEDING AND 14 FOLLOWING) >= 7
       THEN quantile_cont(y, 0.5) OVER ({WIN} ROWS BETWEEN 15 PRECEDING AND 14 FOLLOWING) END AS rolling_med,
  lag(y, 7) OVER ({WIN}) AS lag_7, lag(y, 28) OVER ({WIN}) AS lag_28 FROM n1)
SELECT unique_id, ds, rolling_med, y - rolling_med AS deviation, lag_7, lag_28, y - lag_7 AS change_7,
       y - lag_28 AS change_28
FROM f
""")
def w16(fx):
    """Isolation features: deviation from the rolling median, 7 / 28-day change."""
    n1_ = NA.continuous_daily(_snapped(fx), "unique_id", "ds", "y", keep_pos=True)
    d = W.iso_features(n1_, "unique_id", "ds", "y", positioned=True)
    return d.select("unique_id", "ds", *ISO_COLS)


# ---------------------------------------------------------------- N1 / N2
@query("n1_continuous_daily", f"WITH {N1_SQL} SELECT unique_id, ds, y FROM n1")
def n1(fx):
    """Gap-free daily series: reindex + interpolation + seasonal fallback."""
    return _n1(fx)


@query("n2_rolling_outliers", f"""
WITH {N1_SQL},
m AS (SELECT *, CASE WHEN COUNT(y) OVER ({WIN} ROWS BETWEEN 15 PRECEDING AND 14 FOLLOWING) >= 7
       THEN quantile_cont(y, 0.5) OVER ({WIN} ROWS BETWEEN 15 PRECEDING AND 14 FOLLOWING) END AS med FROM n1),
fl AS (SELECT unique_id, ds, y AS y_observed, CAST(COALESCE(y > 4 * med AND med IS NOT NULL, false) AS INTEGER) AS rolling_outlier,
       CASE WHEN COALESCE(y > 4 * med AND med IS NOT NULL, false) THEN NULL ELSE y END AS y FROM m),
{interp_sql('fl', 'fi')},
{seasonal_sql('fi', 'fs')}
SELECT unique_id, ds, y, y_observed, rolling_outlier FROM fs
""")
def n2(fx):
    """Flag y > 4 x centred 30-day median, blank and refill, keep y_observed."""
    n1_ = NA.continuous_daily(_snapped(fx), "unique_id", "ds", "y", keep_pos=True)
    d = NA.rolling_outliers(n1_, "unique_id", "ds", "y", 4.0, positioned=True)
    return d.select("unique_id", "ds", "y", "y_observed", "rolling_outlier")


# ---------------------------------------------------------------- F4 / F18
PANEL_WIN = "PARTITION BY site_id ORDER BY datetime_hour"


@query("f4_panel_features", f"""
WITH {HOLIDAY_SQL},
h0 AS (SELECT site_id, date_trunc('hour', start_time) AS datetime_hour, SUM(cnt) AS count FROM v_counts GROUP BY 1, 2),
codes AS (SELECT site_id AS code_site, CAST(dense_rank() OVER (ORDER BY site_id) - 1 AS INTEGER) AS site_id_code
          FROM (SELECT DISTINCT site_id FROM h0)),
h AS (SELECT * FROM h0 JOIN codes ON h0.site_id = codes.code_site)
SELECT h.site_id, h.datetime_hour, ROUND(count, 6) AS count, CAST(hour(datetime_hour) AS INTEGER) AS hour,
  CAST(isodow(datetime_hour) - 1 AS INTEGER) AS day_of_week, CAST(month(datetime_hour) AS INTEGER) AS month,
  CAST(isodow(datetime_hour) >= 6 AS INTEGER) AS is_weekend,
  CAST(CAST(datetime_hour AS DATE) IN (SELECT holiday FROM holidays) AS INTEGER) AS is_holiday,
  CAST(CAST(datetime_hour AS DATE) + 1 IN (SELECT holiday FROM holidays WHERE isodow(holiday) <> 7) AS INTEGER) AS is_pre_holiday,
  ROUND(sin(2 * pi() * hour(datetime_hour) / 24e0), 6) + 0e0 AS hour_sin, ROUND(cos(2 * pi() * (isodow(datetime_hour) - 1) / 7e0), 6) + 0e0 AS dow_cos,
  site_id_code,
  ROUND(lag(count, 1) OVER ({PANEL_WIN}), 6) AS lag_1, ROUND(lag(count, 24) OVER ({PANEL_WIN}), 6) AS lag_24,
  ROUND(lag(count, 168) OVER ({PANEL_WIN}), 6) AS lag_168,
  CASE WHEN COUNT(count) OVER ({PANEL_WIN} ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) >= 3
       THEN CAST(SUM(CAST(count AS DECIMAL(38, 2))) OVER ({PANEL_WIN} ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS DOUBLE)
            / COUNT(count) OVER ({PANEL_WIN} ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) END AS rolling_24_mean,
  CASE WHEN COUNT(count) OVER ({PANEL_WIN} ROWS BETWEEN 168 PRECEDING AND 1 PRECEDING) >= 24
       THEN CAST(SUM(CAST(count AS DECIMAL(38, 2))) OVER ({PANEL_WIN} ROWS BETWEEN 168 PRECEDING AND 1 PRECEDING) AS DOUBLE)
            / COUNT(count) OVER ({PANEL_WIN} ROWS BETWEEN 168 PRECEDING AND 1 PRECEDING) END AS rolling_168_mean
FROM h
""")
def f4(fx):
    """Hourly panel features: calendar, cycles, holidays, code, lags, rolling means."""
    h = fx.counts.groupBy("site_id", D.floor_hour("start_time").alias("datetime_hour")).agg(F.sum("cnt").alias("count"))
    d = FE.panel_features(h, "site_id", "datetime_hour", "count", HOLIDAYS, exact_scale=2)
    return d.select("site_id", "datetime_hour", r6("count").alias("count"), "hour", "day_of_week", "month",
                    "is_weekend", "is_holiday", "is_pre_holiday", r6("hour_sin").alias("hour_sin"),
                    r6("dow_cos").alias("dow_cos"), "site_id_code",
                    *[r6(c).alias(c) for c in ("lag_1", "lag_24", "lag_168")], "rolling_24_mean", "rolling_168_mean")


@query("f18_seasonal_naive", f"""
WITH {N1_SQL},
p AS (SELECT unique_id, y, lag(y, 7) OVER ({WIN}) AS y_naive FROM n1)
SELECT unique_id, ROUND(AVG(abs(y - y_naive)), 4) AS mae, ROUND(sqrt(AVG(power(y - y_naive, 2))), 4) AS rmse,
       COUNT(*) AS n FROM p WHERE y IS NOT NULL AND y_naive IS NOT NULL GROUP BY unique_id
""")
def f18(fx):
    """Seasonal-naive baseline (value 7 days before): MAE and RMSE per series."""
    d = FE.seasonal_naive(_n1(fx), "unique_id", "ds", "y", 7).dropna(subset=["y", "y_naive"])
    e = F.col("y") - F.col("y_naive")
    return d.groupBy("unique_id").agg(r4(F.avg(F.abs(e))).alias("mae"), r4(F.sqrt(F.avg(e * e))).alias("rmse"),
                                      F.count(F.lit(1)).alias("n"))
