"""Wave 1: scans, cleaning, scalar functions, basic aggregates, joins,
top-k and reshaping, each registered with its DuckDB oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from countpanel.functions import dates as D
from countpanel.functions import numeric as N
from countpanel.functions import text as T
from countpanel.functions.encode import apply_codes, fit_codes
from countpanel.operators import aggs as A
from countpanel.operators import clean as P
from countpanel.operators import joins as J
from countpanel.operators import reshape as U
from countpanel.plans.registry import query
from countpanel.sources import io as S

r6 = N.r6

# Public holidays (Belgium) 2024-2026, the calendar the
# forecasting features use.
HOLIDAYS = [
    "2024-01-01", "2024-03-31", "2024-04-01", "2024-05-01", "2024-05-09", "2024-05-19", "2024-05-20",
    "2024-07-21", "2024-08-15", "2024-11-01", "2024-11-11", "2024-12-25",
    "2025-01-01", "2025-04-20", "2025-04-21", "2025-05-01", "2025-05-29", "2025-06-08", "2025-06-09",
    "2025-07-21", "2025-08-15", "2025-11-01", "2025-11-11", "2025-12-25",
    "2026-01-01", "2026-04-05", "2026-04-06", "2026-05-01", "2026-05-14", "2026-05-24", "2026-05-25",
    "2026-07-21", "2026-08-15", "2026-11-01", "2026-11-11", "2026-12-25",
]
HOLIDAY_SQL = "holidays AS (SELECT CAST(h AS DATE) AS holiday FROM (VALUES " + ", ".join(
    f"('{d}')" for d in HOLIDAYS) + ") t(h))"


def holiday_table(spark):
    return spark.createDataFrame([(d,) for d in HOLIDAYS], "h string").select(
        F.col("h").cast("date").alias("holiday"))


# ---------------------------------------------------------------- flagship
def integration(fx):
    """Counts -> complete (site, day) buckets -> daily weather -> site
    attributes -> mean daily count per municipality, top 10."""
    daily = A.rollup_counts(fx.counts, ["site_id"], "start_time", "cnt", every="day", bucket="day")
    complete = A.complete_only(daily, 4).withColumn("ds", F.to_date("day"))
    wd = A.weather_daily(fx.weather, "site_id", "time",
                         {"temperature_2m": "max", "precipitation": "sum", "wind_speed_10m": "max"})
    joined = complete.join(wd, ["site_id", "ds"], "left")
    joined = J.attach_attr(joined, fx.sites, "site_id", ["municipality"])
    by_city = joined.groupBy("municipality").agg(
        r6(F.avg("total_count")).alias("mean_count"),
        r6(F.avg("precipitation_sum")).alias("mean_precip"),
        F.count(F.lit(1)).alias("n_buckets"))
    return U.top_k(by_city, [F.col("mean_count").desc(), F.col("municipality")], 10)


INTEGRATION_SQL = """
WITH d AS (SELECT site_id, CAST(start_time AS DATE) AS ds, SUM(cnt) AS total_count, COUNT(cnt) AS n_obs
           FROM v_counts GROUP BY 1, 2 HAVING COUNT(cnt) = 4),
wd AS (SELECT site_id, CAST(time AS DATE) AS ds, MAX(temperature_2m) AS temperature_2m_max,
              SUM(precipitation) AS precipitation_sum, MAX(wind_speed_10m) AS wind_speed_10m_max
       FROM v_weather GROUP BY 1, 2)
SELECT s.municipality, ROUND(AVG(d.total_count), 6) AS mean_count, ROUND(AVG(wd.precipitation_sum), 6) AS mean_precip,
       COUNT(*) AS n_buckets
FROM d LEFT JOIN wd ON d.site_id = wd.site_id AND d.ds = wd.ds LEFT JOIN v_sites s ON d.site_id = s.site_id
GROUP BY s.municipality ORDER BY mean_count DESC, municipality LIMIT 10
"""
query("integration_top_cities", INTEGRATION_SQL)(integration)


# ---------------------------------------------------------------- S5 / S6
@query("s5_scan_parquet", """
SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '1996-04-01' AND l_quantity > 25
""")
def s5(fx):
    """Projected, filtered Parquet scan (filters reach the reader)."""
    return S.scan_parquet(fx.spark, f"{fx.sf_dir}/lineitem.parquet",
                          ["l_orderkey", "l_linenumber", "l_quantity", "l_shipdate"],
                          (F.col("l_shipdate") >= F.lit("1996-01-01").cast("timestamp_ntz"))
                          & (F.col("l_shipdate") < F.lit("1996-04-01").cast("timestamp_ntz"))
                          & (F.col("l_quantity") > 25))


@query("s6_dataset_filter", """
SELECT o_orderstatus, COUNT(*) AS n, ROUND(SUM(o_totalprice), 6) AS total FROM orders
WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-01-01'
GROUP BY o_orderstatus
""")
def s6(fx):
    """Year filter applied at the scan before any aggregation."""
    o = S.scan_parquet(fx.spark, f"{fx.sf_dir}/orders.parquet", ["o_orderstatus", "o_totalprice", "o_orderdate"],
                       None)
    o = P.between_dates(o, "o_orderdate", "1996-01-01", "1996-12-31")
    return o.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), r6(F.sum("o_totalprice")).alias("total"))


# ---------------------------------------------------------------- P1-P12
@query("p1_select_existing", "SELECT site_id, direction FROM v_counts")
def p1(fx):
    """Keep listed columns that exist, then drop listed ones if present."""
    d = P.select_existing(fx.counts, ["site_id", "direction", "cnt", "not_a_column"])
    return P.drop_existing(d, ["cnt", "also_missing"])


@query("p2_rename_aliases", """
SELECT site_id, time, temperature_2m AS temperature, precipitation AS precip, wind_speed_10m FROM v_weather
""")
def p2(fx):
    """Rename alias columns by a map."""
    return P.rename_aliases(fx.weather, {"temperature_2m": "temperature", "precipitation": "precip",
                                         "humidity": "relative_humidity_2m"})


@query("p3_dedupe_columns", "SELECT site_id, lat FROM v_sites")
def p3(fx):
    """Duplicate column names: keep the first."""
    d = fx.sites.select("site_id", "lat", F.col("lon").alias("lat"))
    return P.dedupe_columns(d)


@query("p4_coerce", """
SELECT event_id, TRY_CAST(regexp_extract(props, ': ([0-9]+)', 1) AS INTEGER) AS k,
       TRY_CAST(event_type AS INTEGER) AS event_type, TRY_CAST(CAST(value AS VARCHAR) AS DOUBLE) AS value
FROM events
""")
def p4(fx):
    """Coercing casts: unparsable values become null."""
    ev = fx.table("events").select(
        "event_id", F.regexp_extract("props", r": ([0-9]+)", 1).alias("k"), "event_type",
        F.col("value").cast("string").alias("value"))
    return P.coerce(ev, {"k": "int", "event_type": "int", "value": "double"})


@query("p5_filter_type", "SELECT event_id, site_id, cnt FROM v_counts WHERE type = 'click'")
def p5(fx):
    """Category filter."""
    return P.filter_type(fx.counts, "type", "click").select("event_id", "site_id", "cnt")


@query("p6_between_dates", """
SELECT event_id, start_time FROM v_counts
WHERE start_time >= TIMESTAMP '2024-01-05' AND start_time < TIMESTAMP '2024-01-08'
""")
def p6(fx):
    """Half-open date range [lo, hi + 1 day)."""
    return P.between_dates(fx.counts, "start_time", "2024-01-05", "2024-01-07").select("event_id", "start_time")


@query("p7_hourly_range", """
SELECT site_id, time FROM v_weather
WHERE time >= TIMESTAMP '2024-01-03 00:00:00' AND time <= TIMESTAMP '2024-01-04 12:00:00'
""")
def p7(fx):
    """Rows inside a generated hourly range."""
    return P.in_hourly_range(fx.weather, "time", "2024-01-03 00:00:00", "2024-01-04 12:00:00").select("site_id", "time")


@query("p8_semi_filter", """
SELECT event_id, site_id FROM v_counts WHERE site_id IN (SELECT site_id FROM v_sites WHERE station_count = 1)
""")
def p8(fx):
    """Membership in another table's id set (left semi join)."""
    ids = fx.sites.filter("station_count = 1")
    return P.semi_filter(fx.counts, ids, "site_id").select("event_id", "site_id")


@query("p9_anti_filter", """
SELECT event_id, site_id FROM v_counts WHERE site_id NOT IN (SELECT site_id FROM v_sites WHERE station_count = 1)
""")
def p9(fx):
    """Not in an id set (left anti join)."""
    ids = fx.sites.filter("station_count = 1")
    return P.anti_filter(fx.counts, ids, "site_id").select("event_id", "site_id")


@query("p10_alerts", """
SELECT o_orderkey, ROUND(actual - predicted, 9) AS err FROM v_pred
WHERE actual - predicted > 150e0 OR actual - predicted < -150e0
""")
def p10(fx):
    """Surge OR blockage predicate on the signed error."""
    d = fx.pred.withColumn("err", F.col("actual") - F.col("predicted"))
    return P.alerts(d, "err", 150.0, -150.0).select("o_orderkey", N.r9("err").alias("err"))


@query("p11_require", "SELECT site_id, dist_nearest_station FROM v_sites WHERE dist_nearest_station IS NOT NULL")
def p11(fx):
    """Drop rows with a null in the feature list."""
    return P.require(fx.sites, ["dist_nearest_station"]).select("site_id", "dist_nearest_station")


@query("p12_fill_const", "SELECT site_id, COALESCE(dist_nearest_station, 0e0) AS dist_nearest_station FROM v_sites")
def p12(fx):
    """Constant fill."""
    return P.fill_const(fx.sites, {"dist_nearest_station": 0.0}).select("site_id", "dist_nearest_station")


# ---------------------------------------------------------------- X1-X6
@query("x1_date_parts", """
SELECT event_id, CAST(year(start_time) AS INTEGER) AS year, CAST(month(start_time) AS INTEGER) AS month,
       CAST(day(start_time) AS INTEGER) AS day, CAST(hour(start_time) AS INTEGER) AS hour,
       CAST(minute(start_time) AS INTEGER) AS minute, CAST(isodow(start_time) - 1 AS INTEGER) AS day_of_week,
       dayname(start_time) AS day_name, CAST(start_time AS DATE) AS date FROM v_counts
""")
def x1(fx):
    """Calendar parts; weekday 0 = Monday."""
    t = F.col("start_time")
    return fx.counts.select("event_id", F.year(t).alias("year"), F.month(t).alias("month"),
                            F.dayofmonth(t).alias("day"), F.hour(t).alias("hour"), F.minute(t).alias("minute"),
                            D.weekday0(t).alias("day_of_week"), D.day_name(t).alias("day_name"),
                            F.to_date(t).alias("date"))


@query("x2_date_build", """
SELECT event_id, make_date(year(start_time), month(start_time), day(start_time)) AS d,
       CAST(date_trunc('hour', start_time) AS TIMESTAMP) AS hour_ts,
       CAST(start_time AS DATE) + INTERVAL 1 DAY AS next_day,
       start_time + INTERVAL 2 HOUR AS shifted,
       CAST(datediff('day', DATE '2024-01-01', CAST(start_time AS DATE)) AS INTEGER) AS day_index FROM v_counts
""")
def x2(fx):
    """Build a date, floor to hour, shift by a day / hours, day span."""
    t = F.col("start_time")
    return fx.counts.select(
        "event_id", F.make_date(F.year(t), F.month(t), F.dayofmonth(t)).alias("d"),
        D.floor_hour(t).alias("hour_ts"),
        F.date_add(F.to_date(t), 1).cast("timestamp_ntz").alias("next_day"),
        (t + F.make_dt_interval(hours=F.lit(2))).alias("shifted"),
        F.datediff(F.to_date(t), F.lit("2024-01-01").cast("date")).alias("day_index"))


@query("x3_calendar_flags", f"""
WITH {HOLIDAY_SQL}
SELECT event_id, CAST(isodow(start_time) >= 6 AS INTEGER) AS is_weekend,
       CAST(hour(start_time) IN (7, 8, 9, 16, 17, 18) AS INTEGER) AS is_rush_hour,
       CASE WHEN month(start_time) IN (12, 1, 2) THEN 'Winter' WHEN month(start_time) IN (3, 4, 5) THEN 'Spring'
            WHEN month(start_time) IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END AS season,
       CAST(CAST(start_time AS DATE) IN (SELECT holiday FROM holidays) AS INTEGER) AS is_holiday,
       CAST(CAST(start_time AS DATE) + 1 IN (SELECT holiday FROM holidays WHERE isodow(holiday) <> 7) AS INTEGER)
         AS is_pre_holiday
FROM v_counts
""")
def x3(fx):
    """Weekend, rush hour, season, public holiday and pre-holiday flags."""
    t = F.col("start_time")
    d = fx.counts.select("event_id", "start_time",
                         D.is_weekend(t).cast("int").alias("is_weekend"),
                         D.is_rush_hour(F.hour(t)).cast("int").alias("is_rush_hour"),
                         D.season(F.month(t)).alias("season"))
    return D.holiday_flags(d, "start_time", holiday_table(fx.spark)).drop("start_time")


@query("x4_math", """
SELECT event_id, ROUND(sin(2 * pi() * hour(start_time) / 24e0), 6) + 0e0 AS hour_sin,
       ROUND(cos(2 * pi() * hour(start_time) / 24e0), 6) + 0e0 AS hour_cos,
       ROUND(ln(1 + cnt), 6) AS log1p_cnt, ROUND(exp(ln(1 + cnt)) - 1, 6) AS back,
       ROUND(sqrt(cnt), 6) AS sqrt_cnt, ROUND(abs(cnt - 10), 6) AS abs_dev, ROUND(power(cnt - 10, 2), 6) AS sq_dev,
       LEAST(GREATEST(cnt, 2e0), 20e0) AS clipped
FROM v_counts
""")
def x4(fx):
    """Cyclic encodings, log1p / expm1, sqrt, abs, square, round, clip."""
    s, c = N.cyclic(F.hour("start_time"), 24)
    return fx.counts.select(
        "event_id", r6(s).alias("hour_sin"), r6(c).alias("hour_cos"),
        r6(F.log1p("cnt")).alias("log1p_cnt"), r6(F.expm1(F.log1p("cnt"))).alias("back"),
        r6(F.sqrt("cnt")).alias("sqrt_cnt"), r6(F.abs(F.col("cnt") - 10)).alias("abs_dev"),
        r6(F.pow(F.col("cnt") - 10, 2)).alias("sq_dev"),
        N.clip("cnt", 2.0, 20.0).alias("clipped"))


@query("x5_strings", """
SELECT site_id, lower(site_name) AS lower_name, replace(site_name, '#', '-') AS dashed,
       CAST(regexp_extract(site_name, '#([0-9]+)', 1) AS BIGINT) AS name_num,
       trim(regexp_replace(regexp_replace(strip_accents(lower(trim(municipality))), '[^a-z0-9]+', ' ', 'g'), '\\s+', ' ', 'g')) AS muni_norm,
       concat_ws('_', CAST(site_id AS VARCHAR), district) AS site_key
FROM v_sites
""")
def x5(fx):
    """lower, replace, regex extract, accent-folded normalised name, concat."""
    return fx.sites.select(
        "site_id", F.lower("site_name").alias("lower_name"), F.replace("site_name", F.lit("#"), F.lit("-")).alias("dashed"),
        F.regexp_extract("site_name", r"#([0-9]+)", 1).cast("bigint").alias("name_num"),
        T.normalise_name("municipality").alias("muni_norm"),
        T.concat_key("site_id", "district").alias("site_key"))


@query("x6_dictionary_encode", """
WITH fit AS (SELECT DISTINCT site_id FROM v_counts WHERE start_time < TIMESTAMP '2024-01-10' AND site_id % 4 <> 1),
codes AS (SELECT site_id, CAST(dense_rank() OVER (ORDER BY site_id) - 1 AS INTEGER) AS site_id_code FROM fit)
SELECT DISTINCT c.site_id, COALESCE(codes.site_id_code, -1) AS site_id_code
FROM v_counts c LEFT JOIN codes ON c.site_id = codes.site_id
""")
def x6(fx):
    """Sorted distinct keys -> 0..n-1 fitted on early rows of three quarters
    of the sites; unseen -> -1."""
    early = F.col("start_time") < F.lit("2024-01-10").cast("timestamp_ntz")
    codes = fit_codes(fx.counts.filter(early & (F.col("site_id") % 4 != 1)), "site_id")
    return apply_codes(fx.counts.select("site_id").distinct(), codes, "site_id")


# ---------------------------------------------------------------- A1-A9
@query("a1_rollup_hourly", """
SELECT site_id, direction, date_trunc('hour', start_time) AS bucket, ROUND(SUM(cnt), 6) AS total_count, COUNT(cnt) AS n_obs
FROM v_counts GROUP BY 1, 2, 3
""")
def a1(fx):
    """Readings to hourly buckets per site and direction: sum and count."""
    d = A.rollup_counts(fx.counts, ["site_id", "direction"], "start_time", "cnt", "hour")
    return d.withColumn("total_count", r6("total_count"))


@query("a2_complete_only", """
SELECT site_id, CAST(start_time AS DATE) AS ds, ROUND(SUM(cnt), 6) AS total_count, COUNT(cnt) AS n_obs
FROM v_counts GROUP BY 1, 2 HAVING COUNT(cnt) = 4
""")
def a2(fx):
    """Keep only complete (site, day) buckets with exactly 4 readings."""
    d = A.rollup_counts(fx.counts, ["site_id"], "start_time", "cnt", "day")
    return A.complete_only(d, 4).select("site_id", F.to_date("bucket").alias("ds"),
                                        r6("total_count").alias("total_count"), "n_obs")


@query("a3_daily_totals", """
SELECT site_id, CAST(start_time AS DATE) AS ds, ROUND(COALESCE(SUM(cnt), 0), 6) AS y FROM v_counts GROUP BY 1, 2
""")
def a3(fx):
    """Daily total per site (all-missing day sums to 0)."""
    return A.daily_totals(fx.counts, "site_id", "start_time", "cnt").withColumn("y", r6("y"))


@query("a4_hourly_panel", """
SELECT site_id, date_trunc('hour', start_time) AS datetime_hour, ROUND(SUM(cnt), 6) AS count,
       arg_min(type, start_time) AS type, arg_min(direction, start_time) AS direction
FROM v_counts GROUP BY 1, 2
""")
def a4(fx):
    """Hourly panel with descriptive columns carried from the first reading."""
    d = A.hourly_panel(fx.counts, "site_id", "start_time", "cnt", carry=["type", "direction"])
    return d.withColumn("count", r6("count"))


@query("a5_weather_daily", """
SELECT site_id, CAST(time AS DATE) AS ds, MAX(temperature_2m) AS temperature_2m_max,
       ROUND(SUM(precipitation), 6) AS precipitation_sum, MAX(wind_speed_10m) AS wind_speed_10m_max,
       ROUND(AVG(wind_speed_10m), 6) AS wind_speed_10m_avg
FROM v_weather GROUP BY 1, 2
""")
def a5(fx):
    """Hourly weather to daily max / sum / max / mean."""
    d = A.weather_daily(fx.weather, "site_id", "time",
                        {"temperature_2m": "max", "precipitation": "sum", "wind_speed_10m": "max"})
    w2 = A.weather_daily(fx.weather, "site_id", "time", {"wind_speed_10m": "avg"})
    return d.join(w2, ["site_id", "ds"]).withColumns(
        {"precipitation_sum": r6("precipitation_sum"), "wind_speed_10m_avg": r6("wind_speed_10m_avg")})


@query("a6_profile_hour", """
SELECT CAST(hour(start_time) AS INTEGER) AS hour, ROUND(AVG(cnt), 6) AS mean_value FROM v_counts GROUP BY 1
""")
def a6(fx):
    """Mean count by hour of day."""
    return A.profile_by(fx.counts, "cnt", {"hour": F.hour("start_time")}).withColumn("mean_value", r6("mean_value"))


@query("a7_profile_two_parts", """
SELECT CAST(hour(start_time) AS INTEGER) AS hour, CASE WHEN isodow(start_time) >= 6 THEN 'weekend' ELSE 'weekday' END AS daytype,
       direction, ROUND(AVG(cnt), 6) AS mean_value, COUNT(*) AS n
FROM v_counts GROUP BY 1, 2, 3
""")
def a7(fx):
    """Mean count by hour x day type x direction."""
    d = A.profile_by(fx.counts, "cnt", {
        "hour": F.hour("start_time"),
        "daytype": F.when(D.is_weekend("start_time"), "weekend").otherwise("weekday"),
        "direction": F.col("direction")}, extra={"n": F.count(F.lit(1))})
    return d.withColumn("mean_value", r6("mean_value"))


@query("a8_profile_sites", """
WITH j AS (SELECT c.*, s.municipality FROM v_counts c JOIN v_sites s ON c.site_id = s.site_id),
n AS (SELECT municipality, site_id, COUNT(*) AS n FROM j GROUP BY 1, 2),
pick AS (SELECT municipality, arg_min(site_id, (-n, site_id)) AS site_id FROM n GROUP BY 1)
SELECT j.municipality, j.site_id, CAST(hour(start_time) AS INTEGER) AS hour, direction, ROUND(AVG(cnt), 6) AS mean_value
FROM j JOIN pick ON j.site_id = pick.site_id AND j.municipality = pick.municipality GROUP BY 1, 2, 3, 4
""")
def a8(fx):
    """One site per municipality (most readings), its hour x direction profile."""
    j = J.attach_attr(fx.counts, fx.sites, "site_id", ["municipality"], how="inner")
    pick = A.pick_one_per_group(j, "municipality", "site_id")
    j = j.join(pick, ["municipality", "site_id"], "left_semi")
    d = A.profile_by(j, "cnt", {"municipality": F.col("municipality"), "site_id": F.col("site_id"),
                                "hour": F.hour("start_time"), "direction": F.col("direction")})
    return d.withColumn("mean_value", r6("mean_value"))


@query("a9_category_means", """
SELECT s.municipality, ROUND(AVG(c.cnt), 6) AS mean_value, COUNT(*) AS n_rows,
       ROUND(AVG(s.lat), 6) AS mean_lat, ROUND(AVG(s.school_count), 6) AS mean_school_count
FROM v_counts c JOIN v_sites s ON c.site_id = s.site_id GROUP BY 1
""")
def a9(fx):
    """Mean count per municipality with attribute means."""
    j = J.attach_attr(fx.counts, fx.sites, "site_id", ["municipality", "lat", "school_count"], how="inner")
    d = A.category_means(j, "municipality", "cnt", ["lat", "school_count"])
    return d.withColumns({c: r6(c) for c in ("mean_value", "mean_lat", "mean_school_count")})


# ---------------------------------------------------------------- J1-J4, J9
@query("j1_join_weather", """
SELECT c.event_id, w.temperature_2m, w.precipitation
FROM v_counts c LEFT JOIN v_weather w ON c.site_id = w.site_id AND date_trunc('hour', c.start_time) = w.time
""")
def j1(fx):
    """Readings left-joined to hourly weather on (site, hour)."""
    c = fx.counts.withColumn("time", D.floor_hour("start_time"))
    return J.join_weather(c, fx.weather, ["site_id", "time"], ["temperature_2m", "precipitation"]).select(
        "event_id", "temperature_2m", "precipitation")


@query("j2_join_suffix", """
SELECT w.site_id, w.time, w.temperature_2m AS temperature_2m_x, f.temperature_2m AS temperature_2m_y,
       w.precipitation AS precipitation_x, f.precipitation AS precipitation_y,
       w.wind_speed_10m AS wind_speed_10m_x, f.wind_speed_10m AS wind_speed_10m_y
FROM v_weather w LEFT JOIN v_weather_fcst f ON w.site_id = f.site_id AND w.time = f.time
""")
def j2(fx):
    """Left join with different key names; clashing columns get _x / _y."""
    right = fx.weather_fcst.withColumnsRenamed({"site_id": "sid", "time": "t"})
    return J.join_suffix(fx.weather, right, ["site_id", "time"], ["sid", "t"], "left").drop("sid", "t")


@query("j3_pair", """
SELECT w.site_id, w.time, w.temperature_2m AS temperature_2m_act, f.temperature_2m AS temperature_2m_fc,
       w.precipitation AS precipitation_act, f.precipitation AS precipitation_fc,
       w.wind_speed_10m AS wind_speed_10m_act, f.wind_speed_10m AS wind_speed_10m_fc
FROM v_weather w JOIN v_weather_fcst f ON w.site_id = f.site_id AND w.time = f.time
""")
def j3(fx):
    """Inner join of observed and forecast weather, all measures suffixed."""
    return J.pair(fx.weather, fx.weather_fcst, ["site_id", "time"])


@query("j4_join_unique", """
SELECT c.event_id, s.municipality FROM v_counts c LEFT JOIN v_sites s ON c.site_id = s.site_id
""")
def j4(fx):
    """Right side deduplicated on the key before the join (row-count safe)."""
    dup = fx.sites.unionByName(fx.sites).select("site_id", "municipality")
    return J.join_unique(fx.counts, dup, ["site_id"], order=[F.col("municipality")]).select("event_id", "municipality")


@query("j9_attach_attr", """
SELECT c.event_id, s.lat, s.lon FROM v_counts c JOIN v_sites s ON c.site_id = s.site_id
""")
def j9(fx):
    """One coordinate row per id attached (inner)."""
    return J.attach_attr(fx.counts, fx.sites, "site_id", ["lat", "lon"], how="inner").select("event_id", "lat", "lon")


# ---------------------------------------------------------------- K1-K5
@query("k1_multi_sort", "SELECT site_id, municipality, lat FROM v_sites ORDER BY municipality ASC, lat DESC, site_id")
def k1(fx):
    """Multi-key sort with mixed directions."""
    return fx.sites.select("site_id", "municipality", "lat").orderBy(
        F.col("municipality").asc(), F.col("lat").desc(), F.col("site_id"))


@query("k2_top_k", """
SELECT site_id, ROUND(SUM(cnt), 6) AS total FROM v_counts GROUP BY 1 ORDER BY total DESC, site_id LIMIT 10
""")
def k2(fx):
    """Top 10 sites by total count (ties by id)."""
    t = fx.counts.groupBy("site_id").agg(r6(F.sum("cnt")).alias("total"))
    return U.top_k(t, [F.col("total").desc(), F.col("site_id")], 10)


@query("k3_bottom_k", """
SELECT site_id, ROUND(AVG(cnt), 6) AS mean_cnt FROM v_counts GROUP BY 1 ORDER BY mean_cnt ASC, site_id LIMIT 10
""")
def k3(fx):
    """Bottom 10 sites by mean count."""
    t = fx.counts.groupBy("site_id").agg(r6(F.avg("cnt")).alias("mean_cnt"))
    return U.top_k(t, [F.col("mean_cnt").asc(), F.col("site_id")], 10)


@query("k4_order_abs", """
SELECT o_orderkey, ROUND(actual - predicted, 9) AS err FROM v_pred
ORDER BY abs(actual - predicted) DESC, o_orderkey LIMIT 20
""")
def k4(fx):
    """Largest absolute errors first."""
    d = fx.pred.withColumn("e", F.col("actual") - F.col("predicted"))
    return U.top_k(d, [F.abs("e").desc(), F.col("o_orderkey")], 20).select("o_orderkey", N.r9("e").alias("err"))


@query("k5_order_by_list", """
WITH cats(pos, type) AS (VALUES (0, 'view'), (1, 'click'), (2, 'purchase'), (3, 'refund'), (4, 'error'), (5, 'signup')),
m AS (SELECT type, ROUND(AVG(cnt), 6) AS mean_value FROM v_counts GROUP BY type)
SELECT cats.pos, cats.type, m.mean_value FROM cats LEFT JOIN m ON cats.type = m.type
""")
def k5(fx):
    """Re-index to a fixed category order; absent categories kept as null."""
    m = fx.counts.groupBy("type").agg(r6(F.avg("cnt")).alias("mean_value"))
    return U.order_by_list(m, "type", ["view", "click", "purchase", "refund", "error", "signup"])


# ---------------------------------------------------------------- U1-U6
@query("u1_union_all", """
SELECT site_id, time, temperature_2m, 'obs' AS src FROM v_weather
UNION ALL SELECT site_id, time, temperature_2m, 'fcst' AS src FROM v_weather_fcst
""")
def u1(fx):
    """Union by name of frames with different column order."""
    a = fx.weather.select("site_id", "time", "temperature_2m", F.lit("obs").alias("src"))
    b = fx.weather_fcst.select(F.lit("fcst").alias("src"), "temperature_2m", "time", "site_id")
    return U.union_all([a, b])


@query("u2_tagged_union", """
WITH m AS (SELECT site_id, ROUND(AVG(cnt), 6) AS mean_cnt FROM v_counts GROUP BY 1),
t AS (SELECT *, 'top' AS tag FROM m ORDER BY mean_cnt DESC, site_id LIMIT 10),
b AS (SELECT *, 'bottom' AS tag FROM m ORDER BY mean_cnt ASC, site_id LIMIT 10)
SELECT * FROM t UNION ALL SELECT * FROM b
""")
def u2(fx):
    """Top-10 and bottom-10 sites in one tagged table."""
    m = fx.counts.groupBy("site_id").agg(r6(F.avg("cnt")).alias("mean_cnt"))
    top = U.top_k(m, [F.col("mean_cnt").desc(), F.col("site_id")], 10)
    bot = U.top_k(m, [F.col("mean_cnt").asc(), F.col("site_id")], 10)
    return U.tagged_union({"top": top, "bottom": bot}, "tag")


@query("u3_intersect", """
SELECT site_id, 'both' AS part FROM (SELECT site_id FROM v_counts INTERSECT SELECT site_id FROM v_sites WHERE station_count = 1)
UNION ALL
SELECT site_id, 'counts_only' AS part FROM (SELECT site_id FROM v_counts EXCEPT SELECT site_id FROM v_sites WHERE station_count = 1)
""")
def u3(fx):
    """Intersection and difference of two key sets."""
    a = fx.counts.select("site_id")
    b = fx.sites.filter("station_count = 1").select("site_id")
    return U.tagged_union({"both": U.intersect(a, b), "counts_only": U.except_(a, b)}, "part")


@query("u4_melt", """
SELECT site_id, time, variable, value FROM v_weather
UNPIVOT (value FOR variable IN (temperature_2m, precipitation, wind_speed_10m))
""")
def u4(fx):
    """Wide to long."""
    return U.melt(fx.weather, ["site_id", "time"], ["temperature_2m", "precipitation", "wind_speed_10m"])


@query("u6_stack_metrics", """
SELECT ROUND(AVG(abs(w.temperature_2m - f.temperature_2m)), 6) AS temperature_2m_mae,
       ROUND(AVG(abs(w.precipitation - f.precipitation)), 6) AS precipitation_mae,
       ROUND(AVG(abs(w.wind_speed_10m - f.wind_speed_10m)), 6) AS wind_speed_10m_mae,
       ROUND(MAX(abs(w.temperature_2m - f.temperature_2m)), 6) AS temperature_2m_max_err,
       ROUND(MAX(abs(w.precipitation - f.precipitation)), 6) AS precipitation_max_err,
       ROUND(MAX(abs(w.wind_speed_10m - f.wind_speed_10m)), 6) AS wind_speed_10m_max_err
FROM v_weather w JOIN v_weather_fcst f ON w.site_id = f.site_id AND w.time = f.time
""")
def u6(fx):
    """Per-variable metric columns side by side from one aggregate."""
    p = J.pair(fx.weather, fx.weather_fcst, ["site_id", "time"])
    return U.stack_metrics(p, ["temperature_2m", "precipitation", "wind_speed_10m"], "_act", "_fc")


# ---------------------------------------------------------------- U5 / X7
@query("u5_long_to_wide", """
SELECT site_id, ROUND(SUM(cnt) FILTER (WHERE direction = 'IN'), 6) AS "IN",
       ROUND(SUM(cnt) FILTER (WHERE direction = 'OUT'), 6) AS "OUT" FROM v_counts GROUP BY site_id
""")
def u5(fx):
    """Long to wide: one column per direction (explicit value list)."""
    p = A.pivot_mean(fx.counts, "site_id", "direction", ["IN", "OUT"], "cnt", agg="sum")
    return p.select("site_id", r6("IN").alias("IN"), r6("OUT").alias("OUT"))


@query("x7_json_fields", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       CAST(json_extract_string(props, '$.k') AS INTEGER) % 10 AS k_digit FROM events
""")
def x7(fx):
    """JSON column parsed with a declared schema (from_json), fields as columns."""
    ev = fx.table("events").select("event_id", F.from_json("props", "k int").alias("j"))
    return ev.select("event_id", F.col("j.k").alias("k"), (F.col("j.k") % 10).alias("k_digit"))
