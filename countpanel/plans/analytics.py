"""Wave 2: cleaning helpers, profile aggregates, joins (incl. the spatial
grid join) with DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from countpanel.functions import dates as D
from countpanel.functions import numeric as N
from countpanel.operators import aggs as A
from countpanel.operators import clean as P
from countpanel.operators import joins as J
from countpanel.plans.registry import query

r6, r9 = N.r6, N.r9

NORM_SQL = ("trim(regexp_replace(regexp_replace(strip_accents(lower(trim({x}))), '[^a-z0-9]+', ' ', 'g'), "
            "'\\s+', ' ', 'g'))")


def _counts_weather(fx):
    c = fx.counts.withColumn("time", D.floor_hour("start_time"))
    return J.join_weather(c, fx.weather, ["site_id", "time"], ["temperature_2m", "precipitation", "wind_speed_10m"])


CW_SQL = ("cw AS (SELECT c.*, w.temperature_2m, w.precipitation, w.wind_speed_10m FROM v_counts c "
          "LEFT JOIN v_weather w ON c.site_id = w.site_id AND date_trunc('hour', c.start_time) = w.time)")


# ---------------------------------------------------------------- P13-P28
@query("p13_coalesce_cols", """
SELECT site_id, COALESCE(dist_nearest_station, school_count * 100e0) AS dist FROM v_sites
""")
def p13(fx):
    """Coalesce two sources of one column."""
    d = fx.sites.withColumn("_alt", F.col("school_count") * F.lit(100.0))
    return P.coalesce_cols(d, "dist", "dist_nearest_station", "_alt").select("site_id", "dist")


@query("p14_fill_group_median", """
WITH g AS (SELECT municipality, quantile_cont(dist_nearest_station, 0.5) AS gm FROM v_sites GROUP BY 1),
a AS (SELECT quantile_cont(dist_nearest_station, 0.5) AS am FROM v_sites)
SELECT s.site_id, ROUND(COALESCE(s.dist_nearest_station, g.gm, a.am), 6) AS dist_nearest_station
FROM v_sites s LEFT JOIN g ON s.municipality = g.municipality CROSS JOIN a
""")
def p14(fx):
    """Fill by municipality median, then by the global median."""
    d = P.fill_group_median(fx.sites, "municipality", ["dist_nearest_station"])
    return d.select("site_id", r6("dist_nearest_station").alias("dist_nearest_station"))


@query("p15_fill_median", """
WITH a AS (SELECT quantile_cont(dist_nearest_station, 0.5) AS am FROM v_sites)
SELECT s.site_id, ROUND(COALESCE(s.dist_nearest_station, a.am), 6) AS dist_nearest_station FROM v_sites s CROSS JOIN a
""")
def p15(fx):
    """Fill by the column's exact median (fitted imputer)."""
    d = P.fill_median(fx.sites, ["dist_nearest_station"])
    return d.select("site_id", r6("dist_nearest_station").alias("dist_nearest_station"))


@query("p16_fill_mode", """
WITH m AS (SELECT site_id, CASE WHEN site_id % 7 = 0 THEN NULL ELSE park_count + school_count END AS poi FROM v_sites),
n AS (SELECT poi, COUNT(*) AS n FROM m WHERE poi IS NOT NULL GROUP BY poi),
md AS (SELECT arg_min(poi, (-n, poi)) AS mode_poi FROM n)
SELECT m.site_id, COALESCE(m.poi, md.mode_poi) AS poi FROM m CROSS JOIN md
""")
def p16(fx):
    """Fill by the most frequent value (ties -> smallest value)."""
    d = P.mask(fx.sites, F.col("site_id") % 7 != 0, "park_count", "_p")
    d = d.withColumn("poi", F.col("_p") + F.col("school_count")).select("site_id", "poi")
    return P.fill_mode(d, ["poi"])


@query("p17_clean_infinite", """
SELECT site_id, park_count / NULLIF(school_count, 0) AS ratio FROM v_sites
""")
def p17(fx):
    """Bad ratios (x / 0) become null."""
    d = fx.sites.withColumn("ratio", N.ratio("park_count", "school_count"))
    return P.clean_infinite(d, ["ratio"]).select("site_id", "ratio")


@query("p18_clip", """
SELECT o_orderkey, ROUND(LEAST(GREATEST(predicted, 0e0), 200e0), 9) AS predicted FROM v_pred
""")
def p18(fx):
    """Clip predictions to [0, 200]."""
    return P.clip(fx.pred, "predicted", 0.0, 200.0).select("o_orderkey", r9("predicted").alias("predicted"))


@query("p19_dedupe", """
SELECT site_id, ds, event_id FROM (
  SELECT site_id, CAST(start_time AS DATE) AS ds, event_id,
         row_number() OVER (PARTITION BY site_id, CAST(start_time AS DATE) ORDER BY start_time, event_id) AS rn
  FROM v_counts) WHERE rn = 1
""")
def p19(fx):
    """First reading per (site, day) in time order."""
    d = fx.counts.withColumn("ds", F.to_date("start_time"))
    return P.dedupe(d, ["site_id", "ds"], [F.col("start_time"), F.col("event_id")]).select("site_id", "ds", "event_id")


@query("p20_keep_extreme", """
SELECT site_id, o_orderkey, ROUND(err, 9) AS err FROM (
  SELECT site_id, o_orderkey, actual - predicted AS err,
         row_number() OVER (PARTITION BY site_id ORDER BY abs(actual - predicted) DESC, o_orderkey) AS rn FROM v_pred)
WHERE rn = 1
""")
def p20(fx):
    """Per site, the row with the largest absolute error."""
    d = fx.pred.withColumn("err", F.col("actual") - F.col("predicted"))
    return P.keep_extreme(d, "site_id", "err", ["o_orderkey"]).select("site_id", "o_orderkey", r9("err").alias("err"))


@query("p21_sample_n")
def p21(fx):
    """Seeded sample of exactly 500 readings (hash-ranked, partition independent)."""
    return P.sample_n(fx.counts, "event_id", 500, seed=7).select("event_id", "site_id", "cnt")


@query("p22_map_values", """
SELECT event_id, COALESCE(CASE type WHEN 'click' THEN 'interaction' WHEN 'view' THEN 'exposure'
                                    WHEN 'purchase' THEN 'conversion' END, 'other') AS type_label FROM v_counts
""")
def p22(fx):
    """Value -> label map with a default."""
    m = {"click": "interaction", "view": "exposure", "purchase": "conversion"}
    return P.map_values(fx.counts, "type", m, out="type_label", default="other").select("event_id", "type_label")


@query("p23_poi_group", """
SELECT site_id, CASE WHEN station_count > 0 THEN 'station' WHEN school_count > 0 THEN 'school'
                     WHEN park_count > 0 THEN 'park' ELSE 'other' END AS poi_group FROM v_sites
""")
def p23(fx):
    """First-match POI group: station > school > park > other."""
    return P.poi_group(fx.sites).select("site_id", "poi_group")


@query("p24_mask", """
SELECT event_id, CASE WHEN hour(start_time) IN (7, 8, 9, 16, 17, 18) THEN cnt END AS rush_cnt FROM v_counts
""")
def p24(fx):
    """Condition column: the value in rush hours, null elsewhere."""
    return P.mask(fx.counts, D.is_rush_hour(F.hour("start_time")), "cnt", "rush_cnt").select("event_id", "rush_cnt")


@query("p25_ratio_eps", """
SELECT site_id, ROUND(park_count / (school_count + 1e-6), 6) AS park_per_school FROM v_sites
""")
def p25(fx):
    """Ratio with an epsilon in the denominator."""
    return P.ratio(fx.sites, "park_count", "school_count", "park_per_school", 1e-6).select(
        "site_id", r6("park_per_school").alias("park_per_school"))


@query("p26_interaction", """
SELECT site_id, time, temperature_2m * CAST(precipitation > 0 AS INTEGER) AS rain_x_temp FROM v_weather
""")
def p26(fx):
    """Boolean x number interaction."""
    d = fx.weather.withColumn("rainy", F.col("precipitation") > 0)
    return P.interaction(d, "rainy", "temperature_2m", "rain_x_temp").select("site_id", "time", "rain_x_temp")


@query("p27_extract_pair", """
SELECT site_id, regexp_extract(site_name, '([A-Za-z]+)#([0-9]+)', 1) AS prefix,
       regexp_extract(site_name, '([A-Za-z]+)#([0-9]+)', 2) AS number FROM v_sites
""")
def p27(fx):
    """Split a label into two columns with one regex."""
    return P.extract_pair(fx.sites, "site_name", r"([A-Za-z]+)#([0-9]+)", ("prefix", "number")).select(
        "site_id", "prefix", "number")


@query("p28_concat_key", """
SELECT event_id, concat_ws('_', CAST(site_id AS VARCHAR), direction, CAST(hour(start_time) AS VARCHAR)) AS key
FROM v_counts
""")
def p28(fx):
    """String key from several columns."""
    d = fx.counts.withColumn("h", F.hour("start_time"))
    return P.concat_key(d, ["site_id", "direction", "h"], "key").select("event_id", "key")


# ---------------------------------------------------------------- A10-A33
SITE_PROFILE_SQL = """
SELECT site_id, ROUND(AVG(cnt), 6) AS mean_count, ROUND(quantile_cont(cnt, 0.5), 6) AS median_count,
       MAX(cnt) AS max_count, ROUND(stddev_samp(cnt), 6) AS std_count,
       ROUND(AVG(CASE WHEN isodow(start_time) < 6 THEN cnt END), 6) AS weekday_mean,
       ROUND(AVG(CASE WHEN isodow(start_time) >= 6 THEN cnt END), 6) AS weekend_mean,
       ROUND(AVG(CASE WHEN hour(start_time) IN (7, 8, 9, 16, 17, 18) THEN cnt END), 6) AS rush_mean,
       COUNT(cnt) AS n_obs
FROM v_counts GROUP BY site_id
"""

PROFILE_COLS = ["mean_count", "median_count", "std_count", "weekday_mean", "weekend_mean", "rush_mean"]


@query("a10_site_profile", SITE_PROFILE_SQL)
def a10(fx):
    """Per-site mean, exact median, max, sample std, conditional means."""
    d = A.site_profile(fx.counts, "site_id", "cnt", "start_time")
    return d.withColumns({c: r6(c) for c in PROFILE_COLS})


@query("a11_conditional_sums", """
SELECT site_id, ROUND(SUM(CASE WHEN isodow(start_time) < 6 THEN cnt ELSE 0 END), 6) AS weekday_sum,
       ROUND(SUM(CASE WHEN isodow(start_time) >= 6 THEN cnt ELSE 0 END), 6) AS weekend_sum,
       ROUND(SUM(CASE WHEN hour(start_time) IN (7, 8, 9, 16, 17, 18) THEN cnt ELSE 0 END), 6) AS peak_sum
FROM v_counts GROUP BY site_id
""")
def a11(fx):
    """Conditional sums: weekday, weekend and peak-hour totals."""
    v = F.col("cnt")
    wk = D.is_weekend("start_time")
    return fx.counts.groupBy("site_id").agg(
        r6(F.sum(F.when(~wk, v).otherwise(0.0))).alias("weekday_sum"),
        r6(F.sum(F.when(wk, v).otherwise(0.0))).alias("weekend_sum"),
        r6(F.sum(F.when(D.is_rush_hour(F.hour("start_time")), v).otherwise(0.0))).alias("peak_sum"))


@query("a12_profile_ratios", f"""
WITH p AS ({SITE_PROFILE_SQL.replace('ROUND(', '(').replace(', 6)', ')')})
SELECT site_id, ROUND(weekend_mean / (weekday_mean + 1e-6), 6) AS weekend_weekday_ratio,
       ROUND(rush_mean / (mean_count + 1e-6), 6) AS rush_ratio, ROUND(std_count / (mean_count + 1e-6), 6) AS cv
FROM p
""")
def a12(fx):
    """Ratios from the profile: weekend / weekday, rush / mean, cv."""
    d = A.profile_ratios(A.site_profile(fx.counts, "site_id", "cnt", "start_time"))
    return d.select("site_id", *[r6(c).alias(c) for c in ("weekend_weekday_ratio", "rush_ratio", "cv")])


@query("a13_active_only", """
SELECT site_id, ROUND(AVG(cnt), 6) AS mean_count FROM v_counts GROUP BY site_id HAVING MAX(cnt) > 0
""")
def a13(fx):
    """Active entities only (max > 0)."""
    d = A.active_only(A.site_profile(fx.counts, "site_id", "cnt", "start_time"))
    return d.select("site_id", r6("mean_count").alias("mean_count"))


TEMP_EDGES = [-5, 0, 5, 10, 15, 20, 25, 30, 40]


@query("a14_binned_mean_keep_empty", f"""
WITH {CW_SQL},
b AS (SELECT CASE WHEN temperature_2m >= -5 AND temperature_2m <= 0 THEN 0
                  WHEN temperature_2m > 0 AND temperature_2m <= 5 THEN 1 WHEN temperature_2m > 5 AND temperature_2m <= 10 THEN 2
                  WHEN temperature_2m > 10 AND temperature_2m <= 15 THEN 3 WHEN temperature_2m > 15 AND temperature_2m <= 20 THEN 4
                  WHEN temperature_2m > 20 AND temperature_2m <= 25 THEN 5 WHEN temperature_2m > 25 AND temperature_2m <= 30 THEN 6
                  WHEN temperature_2m > 30 AND temperature_2m <= 40 THEN 7 END AS bin, cnt FROM cw),
g AS (SELECT bin, AVG(cnt) AS mean_value, COUNT(*) AS n_rows FROM b WHERE bin IS NOT NULL GROUP BY bin),
bins(bin, bin_label) AS (VALUES (0, '(-5, 0]'), (1, '(0, 5]'), (2, '(5, 10]'), (3, '(10, 15]'), (4, '(15, 20]'),
                                (5, '(20, 25]'), (6, '(25, 30]'), (7, '(30, 40]'))
SELECT bins.bin, bins.bin_label, ROUND(g.mean_value, 6) AS mean_value, COALESCE(g.n_rows, 0) AS n_rows
FROM bins LEFT JOIN g ON bins.bin = g.bin
""")
def a14(fx):
    """Right-closed temperature bins (lowest edge included), empty bins kept."""
    d = A.binned_mean(_counts_weather(fx), "temperature_2m", "cnt", TEMP_EDGES, keep_empty=True)
    return d.withColumn("mean_value", r6("mean_value"))


@query("a15_binned_by_group", f"""
WITH {CW_SQL},
b AS (SELECT direction, CASE WHEN precipitation >= 0 AND precipitation <= 0.5 THEN 0
                             WHEN precipitation > 0.5 AND precipitation <= 2 THEN 1
                             WHEN precipitation > 2 AND precipitation <= 5 THEN 2 END AS bin, cnt FROM cw),
bins(bin, bin_label) AS (VALUES (0, 'dry-light'), (1, 'moderate'), (2, 'heavy'))
SELECT b.direction, b.bin, bins.bin_label, ROUND(AVG(cnt), 6) AS mean_value, COUNT(*) AS n_rows
FROM b JOIN bins ON b.bin = bins.bin GROUP BY 1, 2, 3
""")
def a15(fx):
    """Labelled precipitation bins x direction, observed combinations only."""
    d = A.binned_mean(_counts_weather(fx), "precipitation", "cnt", [0, 0.5, 2, 5], by=["direction"],
                      keep_empty=False, labels=["dry-light", "moderate", "heavy"])
    return d.withColumn("mean_value", r6("mean_value"))


@query("a16_mean_by_flag", f"""
WITH {CW_SQL}
SELECT COALESCE(precipitation > 0, false) AS rainy, ROUND(AVG(cnt), 6) AS mean_value, COUNT(*) AS n_rows
FROM cw GROUP BY 1
""")
def a16(fx):
    """Mean count on rainy vs dry readings."""
    d = A.mean_by_flag(_counts_weather(fx), F.col("precipitation") > 0, "cnt", "rainy")
    return d.withColumn("mean_value", r6("mean_value"))


@query("a17_cardinality", """
SELECT COUNT(DISTINCT site_id) AS n_site_id, COUNT(DISTINCT type) AS n_type, COUNT(DISTINCT direction) AS n_direction
FROM v_counts
""")
def a17(fx):
    """Distinct counts of several columns in one pass."""
    return A.cardinality(fx.counts, ["site_id", "type", "direction"])


@query("a18_value_counts", "SELECT type, COUNT(*) AS n FROM v_counts GROUP BY type")
def a18(fx):
    """Value counts."""
    return A.value_counts(fx.counts, "type")


@query("a19_describe_exact", """
SELECT 'cnt' AS "column", COUNT(cnt) AS count, ROUND(AVG(cnt), 6) AS mean, ROUND(stddev_samp(cnt), 6) AS std,
       MIN(cnt) AS min, ROUND(quantile_cont(cnt, 0.25), 6) AS q25, ROUND(quantile_cont(cnt, 0.5), 6) AS q50,
       ROUND(quantile_cont(cnt, 0.75), 6) AS q75, MAX(cnt) AS max FROM v_counts
UNION ALL
SELECT 'site_id', COUNT(site_id), ROUND(AVG(site_id), 6), ROUND(stddev_samp(site_id), 6), CAST(MIN(site_id) AS DOUBLE),
       ROUND(quantile_cont(site_id, 0.25), 6), ROUND(quantile_cont(site_id, 0.5), 6),
       ROUND(quantile_cont(site_id, 0.75), 6), CAST(MAX(site_id) AS DOUBLE) FROM v_counts
""")
def a19(fx):
    """count, mean, std, min, quartiles, max per numeric column (long form)."""
    d = A.describe_exact(fx.counts, ["cnt", "site_id"])
    return d.withColumns({c: r6(c) for c in ("mean", "std", "q25", "q50", "q75")})


@query("a20_kpis", """
SELECT ROUND(SUM(c.cnt), 6) AS total, COUNT(DISTINCT c.site_id) AS n_sites, CAST(MIN(c.start_time) AS DATE) AS first_day,
       CAST(MAX(c.start_time) AS DATE) AS last_day,
       CAST(datediff('day', CAST(MIN(c.start_time) AS DATE), CAST(MAX(c.start_time) AS DATE)) + 1 AS INTEGER) AS n_days,
       ROUND(100 * AVG(CAST(c.cnt IS NULL AS DOUBLE)), 6) AS pct_missing, COUNT(*) AS n_rows,
       COUNT(DISTINCT s.municipality) AS n_cities
FROM v_counts c LEFT JOIN v_sites s ON c.site_id = s.site_id
""")
def a20(fx):
    """Headline KPIs: total, sites, cities, date span, % missing."""
    d = J.attach_attr(fx.counts, fx.sites, "site_id", ["municipality"])
    return A.kpis(d, "cnt", "site_id", "municipality", "start_time").withColumns(
        {"total": r6("total"), "pct_missing": r6("pct_missing")})


HOURS = list(range(24))


@query("a21_pivot_mean", "SELECT CAST(isodow(start_time) - 1 AS INTEGER) AS dow, " + ", ".join(
    f"ROUND(COALESCE(AVG(cnt) FILTER (WHERE hour(start_time) = {h}), 0), 6) AS \"{h}\"" for h in HOURS)
    + " FROM v_counts GROUP BY 1")
def a21(fx):
    """Weekday x hour mean matrix, missing cells -> 0 (explicit value list)."""
    d = fx.counts.withColumns({"dow": D.weekday0("start_time"), "hour": F.hour("start_time")})
    p = A.pivot_mean(d, "dow", "hour", HOURS, "cnt", fill=0.0)
    return p.select("dow", *[r6(F.col(str(h))).alias(str(h)) for h in HOURS])


TYPES = ["click", "error", "purchase", "signup", "view"]


@query("a22_crosstab", "SELECT direction, " + ", ".join(
    f"COUNT(*) FILTER (WHERE type = '{t}') AS {t}" for t in TYPES) + " FROM v_counts GROUP BY direction")
def a22(fx):
    """Contingency table direction x type."""
    return A.crosstab(fx.counts, "direction", "type", TYPES)


@query("a23_crosstab_margins", """
SELECT COALESCE(direction, 'All') AS direction, COALESCE(type, 'All') AS type, COUNT(*) AS n
FROM v_counts GROUP BY CUBE (direction, type)
""")
def a23(fx):
    """Contingency counts with row, column and grand totals (CUBE)."""
    return A.crosstab_margins(fx.counts, "direction", "type")


WVARS = ["temperature_2m", "precipitation", "wind_speed_10m"]


@query("a24_corr_matrix", "SELECT x, y, ROUND(r, 6) AS r FROM (" + " UNION ALL ".join(
    f"SELECT '{x}' AS x, '{y}' AS y, corr({x}, {y}) AS r FROM v_weather" for x in WVARS for y in WVARS) + ")")
def a24(fx):
    """Pearson correlation matrix in long form, one aggregate pass."""
    return A.corr_matrix(fx.weather, WVARS).withColumn("r", r6("r"))


@query("a25_corr_by", f"""
WITH {CW_SQL}
SELECT site_id, isodow(start_time) >= 6 AS weekend, ROUND(corr(temperature_2m, cnt), 6) AS r, COUNT(*) AS n
FROM cw GROUP BY 1, 2
""")
def a25(fx):
    """Correlation of temperature with counts per site and day type."""
    d = A.corr_by(_counts_weather(fx), "site_id", "temperature_2m", "cnt", D.is_weekend("start_time"), "weekend")
    return d.withColumn("r", r6("r"))


def t_test_sql(stats: str) -> str:
    """CTEs over ``stats`` (term, df, x = df / (df + t^2)) that end in
    p(term, p_value): the incomplete beta function by a recursive continued
    fraction."""
    return f"""
side AS (SELECT term, CASE WHEN x < (df / 2e0 + 1) / (df / 2e0 + 2.5e0) THEN df / 2e0 ELSE 0.5e0 END AS a,
                CASE WHEN x < (df / 2e0 + 1) / (df / 2e0 + 2.5e0) THEN 0.5e0 ELSE df / 2e0 END AS b,
                CASE WHEN x < (df / 2e0 + 1) / (df / 2e0 + 2.5e0) THEN x ELSE 1 - x END AS z,
                x < (df / 2e0 + 1) / (df / 2e0 + 2.5e0) AS direct FROM {stats}),
cf(term, a, b, z, direct, m, c, d, h) AS (
  SELECT term, a, b, z, direct, 0, 1e0, 1 / (1 - (a + b) * z / (a + 1)), 1 / (1 - (a + b) * z / (a + 1)) FROM side
  UNION ALL
  SELECT term, a, b, z, direct, m, 1 + odd / ce, 1 / (1 + odd * de), h * ce * de * (1 + odd / ce) / (1 + odd * de)
  FROM (SELECT term, a, b, z, direct, m + 1 AS m, h, 1 + (m + 1) * (b - m - 1) * z / ((a + 2 * m + 1) * (a + 2 * m + 2)) / c AS ce,
               1 / (1 + (m + 1) * (b - m - 1) * z / ((a + 2 * m + 1) * (a + 2 * m + 2)) * d) AS de,
               -(a + m + 1) * (a + b + m + 1) * z / ((a + 2 * m + 2) * (a + 2 * m + 3)) AS odd FROM cf WHERE m < 300) AS t),
p AS (SELECT term, CASE WHEN direct THEN tail ELSE 1 - tail END AS p_value FROM (
  SELECT term, direct, exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * ln(z) + b * ln(1 - z)) / a * h AS tail FROM cf WHERE m = 300) AS t)"""


@query("a26_pearsonr", f"""
WITH RECURSIVE r AS (SELECT 'r' AS term, corr(temperature_2m, wind_speed_10m) AS r, COUNT(*) AS n FROM v_weather),
stats AS (SELECT term, n - 2 AS df, 1 - r * r AS x FROM r),{t_test_sql("stats")}
SELECT ROUND(r, 9) AS r, n, ROUND(p_value, 9) AS p_value FROM r JOIN p ON r.term = p.term
""")
def a26(fx):
    """Correlation with a two-sided p-value from the t-test."""
    d = A.pearsonr(fx.weather, "temperature_2m", "wind_speed_10m")
    return d.withColumns({c: F.round(c, 9) for c in ("r", "p_value")})


@query("a26_pearson_r", """
SELECT ROUND(corr(temperature_2m, wind_speed_10m), 9) AS r, COUNT(*) AS n FROM v_weather
""")
def a26_r(fx):
    """The correlation itself, without its p-value."""
    d = A.pearsonr(fx.weather, "temperature_2m", "wind_speed_10m")
    return d.select(F.round("r", 9).alias("r"), "n")


@query("a27_quantiles", """
SELECT nation, ROUND(quantile_cont(actual - predicted, 0.1), 6) AS q10,
       ROUND(quantile_cont(actual - predicted, 0.5), 6) AS q50, ROUND(quantile_cont(actual - predicted, 0.9), 6) AS q90
FROM v_pred GROUP BY nation
""")
def a27(fx):
    """Exact (interpolated) error quantiles per nation."""
    d = fx.pred.withColumn("err", F.col("actual") - F.col("predicted"))
    q = A.quantiles(d, "err", [0.1, 0.5, 0.9], ["nation"])
    return q.withColumns({c: r6(c) for c in ("q10", "q50", "q90")})


@query("a28_argmax", """
WITH m AS (SELECT s.municipality, c.site_id, AVG(c.cnt) AS mean_cnt FROM v_counts c JOIN v_sites s ON c.site_id = s.site_id
           GROUP BY 1, 2)
SELECT municipality, arg_min(site_id, (-mean_cnt, site_id)) AS argmax FROM m GROUP BY 1
""")
def a28(fx):
    """Per municipality, the site with the highest mean count."""
    j = J.attach_attr(fx.counts, fx.sites, "site_id", ["municipality"], how="inner")
    m = j.groupBy("municipality", "site_id").agg(F.avg("cnt").alias("mean_cnt"))
    return A.argmax(m, ["municipality"], "site_id", "mean_cnt")


@query("a29_histogram", """
WITH st AS (SELECT MIN(cnt) AS mn, MAX(cnt) AS mx FROM v_counts),
b AS (SELECT CAST(LEAST(FLOOR((cnt - mn) / ((mx - mn) / 10e0)), 9) AS INTEGER) AS bin FROM v_counts, st
      WHERE cnt IS NOT NULL),
n AS (SELECT bin, COUNT(*) AS n FROM b GROUP BY bin),
bins AS (SELECT CAST(i AS INTEGER) AS bin FROM range(10) t(i))
SELECT bins.bin, ROUND(mn + bins.bin * (mx - mn) / 10e0, 6) AS lo, ROUND(mn + (bins.bin + 1) * (mx - mn) / 10e0, 6) AS hi,
       COALESCE(n.n, 0) AS n
FROM bins CROSS JOIN st LEFT JOIN n ON bins.bin = n.bin
""")
def a29(fx):
    """10 equal-width bins of the count, last bin closed."""
    return A.histogram(fx.counts, "cnt", 10).withColumns({"lo": r6("lo"), "hi": r6("hi")})


@query("a30_box_stats", """
WITH q AS (SELECT direction, quantile_cont(cnt, 0.25) AS q1, quantile_cont(cnt, 0.5) AS median,
                  quantile_cont(cnt, 0.75) AS q3 FROM v_counts GROUP BY 1)
SELECT q.direction, ROUND(q1, 6) AS q1, ROUND(median, 6) AS median, ROUND(q3, 6) AS q3, ROUND(q3 - q1, 6) AS iqr,
       MIN(CASE WHEN cnt >= q1 - 1.5 * (q3 - q1) THEN cnt END) AS whisker_lo,
       MAX(CASE WHEN cnt <= q3 + 1.5 * (q3 - q1) THEN cnt END) AS whisker_hi,
       COUNT(*) FILTER (WHERE cnt < q1 - 1.5 * (q3 - q1) OR cnt > q3 + 1.5 * (q3 - q1)) AS n_outliers
FROM v_counts c JOIN q ON c.direction = q.direction GROUP BY q.direction, q1, median, q3
""")
def a30(fx):
    """Box-plot numbers per direction (quartiles, 1.5 IQR whiskers, outliers)."""
    d = A.box_stats(fx.counts, ["direction"], "cnt")
    return d.withColumns({c: r6(c) for c in ("q1", "median", "q3", "iqr")})


@query("a31_daily_average", """
WITH days AS (SELECT COUNT(DISTINCT CAST(start_time AS DATE)) AS d FROM v_counts)
SELECT site_id, ROUND(SUM(cnt) / MAX(days.d), 6) AS daily_avg FROM v_counts CROSS JOIN days
GROUP BY site_id ORDER BY daily_avg DESC, site_id LIMIT 15
""")
def a31(fx):
    """Total per site / distinct days in the data; top 15."""
    return A.daily_average(fx.counts, "site_id", "cnt", "start_time", 15).withColumn("daily_avg", r6("daily_avg"))


@query("a32_row_mean", """
SELECT site_id, time, ROUND((temperature_2m + COALESCE(CASE WHEN precipitation > 0 THEN precipitation END, 0)
                            + wind_speed_10m) / (2 + CAST(precipitation > 0 AS INTEGER)), 6) + 0e0 AS row_mean
FROM v_weather
""")
def a32(fx):
    """Row mean across columns with nulls skipped."""
    d = fx.weather.withColumn("wet", F.when(F.col("precipitation") > 0, F.col("precipitation")))
    return d.select("site_id", "time", r6(A.row_mean(["temperature_2m", "wet", "wind_speed_10m"])).alias("row_mean"))


@query("a33_group_means", """
SELECT s.municipality, ROUND(AVG(c.cnt), 6) AS cnt, ROUND(AVG(s.lat), 6) AS lat, ROUND(AVG(s.park_count), 6) AS park_count
FROM v_counts c JOIN v_sites s ON c.site_id = s.site_id GROUP BY 1
""")
def a33(fx):
    """Rounded group means of many columns."""
    j = J.attach_attr(fx.counts, fx.sites, "site_id", ["municipality", "lat", "park_count"], how="inner")
    return A.group_means(j, ["municipality"], ["cnt", "lat", "park_count"], d=6)


# ---------------------------------------------------------------- J5-J8, J13-J17
@query("j5_join_global", """
WITH h AS (SELECT time, AVG(temperature_2m) AS temperature_2m FROM v_weather GROUP BY time)
SELECT c.event_id, ROUND(h.temperature_2m, 6) AS temperature_2m FROM v_counts c
LEFT JOIN h ON date_trunc('hour', c.start_time) = h.time
""")
def j5(fx):
    """No site key on the right: weather averaged per hour, joined on hour."""
    c = fx.counts.withColumn("time", D.floor_hour("start_time"))
    d = J.join_global(c, fx.weather, "time", ["temperature_2m"])
    return d.select("event_id", r6("temperature_2m").alias("temperature_2m"))


@query("j6_join_all", """
WITH h AS (SELECT site_id, date_trunc('hour', start_time) AS time, SUM(cnt) AS total FROM v_counts GROUP BY 1, 2)
SELECT h.site_id, h.time, ROUND(h.total, 6) AS total, w.temperature_2m AS t_obs, f.temperature_2m AS t_fc
FROM h JOIN v_weather w ON h.site_id = w.site_id AND h.time = w.time
JOIN v_weather_fcst f ON h.site_id = f.site_id AND h.time = f.time
""")
def j6(fx):
    """Fold of inner joins on the same (site, hour) keys."""
    h = fx.counts.groupBy("site_id", D.floor_hour("start_time").alias("time")).agg(r6(F.sum("cnt")).alias("total"))
    w = fx.weather.select("site_id", "time", F.col("temperature_2m").alias("t_obs"))
    f = fx.weather_fcst.select("site_id", "time", F.col("temperature_2m").alias("t_fc"))
    return J.join_all([h, w, f], ["site_id", "time"])


@query("j7_align_keys", """
WITH h AS (SELECT DISTINCT site_id, date_trunc('hour', start_time) AS time FROM v_counts WHERE type = 'click')
SELECT w.site_id, w.time, w.temperature_2m FROM v_weather w WHERE (w.site_id, w.time) IN (SELECT site_id, time FROM h)
""")
def j7(fx):
    """Restrict two tables to their common keys (weather side returned)."""
    h = fx.counts.filter("type = 'click'").select("site_id", D.floor_hour("start_time").alias("time"))
    a, _ = J.align_keys(fx.weather, h, ["site_id", "time"])
    return a.select("site_id", "time", "temperature_2m")


@query("j8_key_overlap", """
WITH a AS (SELECT DISTINCT site_id FROM v_counts), b AS (SELECT DISTINCT site_id FROM v_sites WHERE station_count = 1)
SELECT COUNT(*) FILTER (WHERE a.site_id IS NOT NULL AND b.site_id IS NOT NULL) AS n_common,
       COUNT(*) FILTER (WHERE b.site_id IS NULL) AS n_only_left, COUNT(*) FILTER (WHERE a.site_id IS NULL) AS n_only_right
FROM a FULL JOIN b ON a.site_id = b.site_id
""")
def j8(fx):
    """Key-set overlap report: common, only left, only right."""
    return J.key_overlap(fx.counts, fx.sites.filter("station_count = 1"), "site_id")


CORRECTIONS = {"district algeria": "algeria", "district brazil": "brazil", "district france": "france"}
LABEL_SQL = "CASE WHEN site_id % 11 = 0 THEN 'District ' || municipality ELSE municipality END"
CORR_SQL = ("CASE {n} WHEN 'district algeria' THEN 'algeria' WHEN 'district brazil' THEN 'brazil' "
            "WHEN 'district france' THEN 'france' ELSE {n} END")


def _labelled_sites(fx):
    return fx.sites.select("site_id", F.when(F.col("site_id") % 11 == 0, F.concat(F.lit("District "), F.col("municipality")))
                           .otherwise(F.col("municipality")).alias("label"))


@query("j13_join_names", f"""
WITH l AS (SELECT site_id, {LABEL_SQL} AS label FROM v_sites),
ln AS (SELECT site_id, label, {CORR_SQL.format(n=NORM_SQL.format(x='label'))} AS name_norm FROM l),
r AS (SELECT {NORM_SQL.format(x='municipality')} AS name_norm, population FROM v_pop)
SELECT ln.site_id, ln.label, ln.name_norm, r.population FROM ln LEFT JOIN r ON ln.name_norm = r.name_norm
""")
def j13(fx):
    """Normalised-name join with a correction map (population attached)."""
    d = J.join_names(_labelled_sites(fx), fx.pop, "label", "municipality", CORRECTIONS)
    return d.select("site_id", "label", "name_norm", "population")


@query("j14_unmatched", f"""
WITH l AS (SELECT site_id, {LABEL_SQL} AS label FROM v_sites),
ln AS (SELECT DISTINCT label, {CORR_SQL.format(n=NORM_SQL.format(x='label'))} AS name_norm FROM l),
r AS (SELECT {NORM_SQL.format(x='municipality')} AS name_norm FROM v_pop)
SELECT label FROM ln WHERE name_norm NOT IN (SELECT name_norm FROM r)
""")
def j14(fx):
    """Labels that found no population row after correction."""
    return J.unmatched(_labelled_sites(fx), fx.pop, "label", "municipality", CORRECTIONS)


FLAT_SQL = "sqrt(power(s.lat - p.lat, 2) + power(s.lon - p.lon, 2)) * 111320e0"


@query("j15_count_within", f"""
WITH pairs AS (SELECT s.site_id, p.kind FROM v_sites s, v_poi p WHERE {FLAT_SQL} <= 10000)
SELECT s.site_id, COUNT(*) FILTER (WHERE kind = 'school') AS school_count,
       COUNT(*) FILTER (WHERE kind = 'station') AS station_count, COUNT(*) FILTER (WHERE kind = 'park') AS park_count
FROM v_sites s LEFT JOIN pairs ON s.site_id = pairs.site_id GROUP BY s.site_id
""")
def j15(fx):
    """POIs of each kind within 10 km per site (grid equi-join, flat metric)."""
    return J.count_within(fx.sites, fx.poi, 10000.0, ["school", "station", "park"], metric="flat")


@query("j16_nearest", """
WITH pairs AS (
  SELECT s.site_id, 2 * 6371008.8 * asin(LEAST(1e0, sqrt(power(sin((radians(p.lat) - radians(s.lat)) / 2), 2)
         + cos(radians(s.lat)) * cos(radians(p.lat)) * power(sin((radians(p.lon) - radians(s.lon)) / 2), 2)))) AS d
  FROM v_sites s JOIN v_poi p ON p.kind = 'station')
SELECT s.site_id, ROUND(MIN(pairs.d), 6) AS dist_nearest_station
FROM v_sites s LEFT JOIN pairs ON s.site_id = pairs.site_id AND pairs.d <= 10000 GROUP BY s.site_id
""")
def j16(fx):
    """Distance to the nearest station within 10 km (haversine), else null."""
    d = J.nearest(fx.sites, fx.poi, "station", 10000.0, metric="haversine")
    return d.withColumn("dist_nearest_station", r6("dist_nearest_station"))


RATES = [0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5]


@query("j17_cross_scenarios", "WITH t AS (SELECT nation, SUM(predicted) AS total FROM v_pred GROUP BY nation), "
       "r(rate) AS (VALUES " + ", ".join(f"({x}e0)" for x in RATES) + ") "
       "SELECT nation, rate, ROUND(total * rate, 4) AS shifted FROM t CROSS JOIN r")
def j17(fx):
    """Per-nation totals under 8 modal-shift rates."""
    t = fx.pred.groupBy("nation").agg(F.sum("predicted").alias("total"))
    return J.cross_scenarios(t, RATES, "rate").select("nation", "rate", F.round(F.col("total") * F.col("rate"), 4).alias("shifted"))
