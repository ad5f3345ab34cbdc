"""Wave 4: audits, forecast verification, resilience, impact accounting,
alerting and routing, with DuckDB oracles."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from countpanel.functions import dates as D
from countpanel.functions import numeric as N
from countpanel.operators import anomaly as NA
from countpanel.operators import clean as P
from countpanel.operators import joins as J
from countpanel.operators import models_light as ML
from countpanel.operators import quality as Q
from countpanel.operators import resilience as R
from countpanel.plans.analytics import CW_SQL, _counts_weather
from countpanel.plans.registry import query
from countpanel.session import small

r6, r9 = N.r6, N.r9
VARS = ["temperature_2m", "precipitation", "wind_speed_10m"]
PAIRS_SQL = ("pairs AS (SELECT w.site_id, w.time, w.temperature_2m AS temperature_2m_act, f.temperature_2m AS temperature_2m_fc, "
             "w.precipitation AS precipitation_act, f.precipitation AS precipitation_fc, w.wind_speed_10m AS wind_speed_10m_act, "
             "f.wind_speed_10m AS wind_speed_10m_fc FROM v_weather w JOIN v_weather_fcst f ON w.site_id = f.site_id AND w.time = f.time)")


def _pairs(fx):
    return J.pair(fx.weather, fx.weather_fcst, ["site_id", "time"])


# ---------------------------------------------------------------- Q1-Q9
@query("q1_incomplete_days", """
SELECT site_id, CAST(time AS DATE) AS day, COUNT(*) AS n_records FROM v_weather GROUP BY 1, 2 HAVING COUNT(*) <> 24
""")
def q1(fx):
    """Site-days without exactly 24 hourly records."""
    return Q.incomplete_days(fx.weather, "site_id", "time", 24)


@query("q2_month_coverage", """
SELECT site_id, CAST(date_trunc('month', time) AS DATE) AS month, COUNT(DISTINCT CAST(time AS DATE)) AS days_present,
       CAST(MAX(day(last_day(CAST(time AS DATE)))) AS INTEGER) AS days_in_month,
       COUNT(DISTINCT CAST(time AS DATE)) = MAX(day(last_day(CAST(time AS DATE)))) AS complete
FROM v_weather GROUP BY 1, 2
""")
def q2(fx):
    """Days present per site and month against the calendar."""
    return Q.month_coverage(fx.weather, "site_id", "time")


@query("q3_is_balanced", """
WITH c AS (SELECT site_id, COUNT(*) AS n FROM v_weather GROUP BY 1)
SELECT COUNT(DISTINCT n) AS n_distinct_counts, MIN(n) AS min_records, MAX(n) AS max_records,
       COUNT(DISTINCT n) = 1 AS balanced FROM c
""")
def q3(fx):
    """Do all sites have the same number of records?"""
    return Q.is_balanced(fx.weather, "site_id")


@query("q4_missing_hours", """
WITH span AS (SELECT MIN(time) AS lo, MAX(time) AS hi FROM v_weather),
hours AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS time FROM span),
grid AS (SELECT s.site_id, h.time FROM (SELECT DISTINCT site_id FROM v_weather) s CROSS JOIN hours h)
SELECT site_id, time FROM grid WHERE NOT EXISTS (SELECT 1 FROM v_weather w WHERE w.site_id = grid.site_id AND w.time = grid.time)
""")
def q4(fx):
    """(site, hour) pairs missing from the global hourly range."""
    return Q.missing_hours(fx.weather, "site_id", "time")


@query("q5_null_report", "SELECT 'site_id' AS \"column\", COUNT(*) FILTER (WHERE site_id IS NULL) AS n_null FROM v_sites "
       + " ".join(f"UNION ALL SELECT '{c}', COUNT(*) FILTER (WHERE {c} IS NULL) FROM v_sites" for c in
                  ["site_name", "municipality", "district", "lat", "lon", "school_count", "station_count", "park_count",
                   "dist_nearest_station"]))
def q5(fx):
    """Nulls per column (long form)."""
    return Q.null_report(fx.sites)


@query("q5_dup_count", """
SELECT COUNT(*) AS n_rows, COUNT(*) - COUNT(DISTINCT (site_id, type, direction)) AS n_duplicates FROM v_counts
""")
def q5b(fx):
    """Duplicate rows over a column subset."""
    return Q.dup_count(fx.counts, ["site_id", "type", "direction"])


@query("q6_expected_rows", """
SELECT COUNT(DISTINCT CAST(time AS DATE)) AS n_days, COUNT(DISTINCT site_id) AS n_keys, COUNT(*) AS n_rows,
       COUNT(DISTINCT CAST(time AS DATE)) * 24 * COUNT(DISTINCT site_id) AS expected_rows,
       COUNT(DISTINCT CAST(time AS DATE)) * 24 * COUNT(DISTINCT site_id) - COUNT(*) AS missing_rows FROM v_weather
""")
def q6(fx):
    """Expected rows (days x 24 x sites) against actual."""
    return Q.expected_rows(fx.weather, "site_id", "time")


@query("q7_coverage", f"WITH {CW_SQL} SELECT ROUND(AVG(CAST(temperature_2m IS NOT NULL AS DOUBLE)), 6) AS coverage FROM cw")
def q7(fx):
    """Share of readings that found a weather row."""
    return Q.coverage(_counts_weather(fx), "temperature_2m").withColumn("coverage", r6("coverage"))


@query("q8_zero_share", """
SELECT district, ROUND(AVG(CAST(school_count = 0 AS DOUBLE)), 6) AS zero_share, COUNT(*) AS n FROM v_sites GROUP BY 1
""")
def q8(fx):
    """Share of zeros by tag."""
    return Q.zero_share(fx.sites, "school_count", ["district"]).withColumn("zero_share", r6("zero_share"))


@query("q9_min_history", """
SELECT unique_id, COUNT(y) AS n_history FROM v_daily WHERE ds < DATE '1998-01-01' GROUP BY 1 HAVING COUNT(y) >= 60
""")
def q9(fx):
    """Series with at least 60 observed days before 1998."""
    return Q.min_history(fx.daily, "unique_id", "ds", "y", 60, "1998-01-01")


# ---------------------------------------------------------------- V1-V13
VERIFY_SQL = f"WITH {PAIRS_SQL}, rng AS (SELECT " + ", ".join(
    f"MAX({v}_act) - MIN({v}_act) AS r_{v}" for v in VARS) + " FROM pairs)\n" + "\nUNION ALL\n".join(
    f"""SELECT '{v}' AS variable, ROUND(AVG(abs({v}_act - {v}_fc)), 6) AS mae, ROUND(sqrt(AVG(power({v}_act - {v}_fc, 2))), 6) AS rmse,
       ROUND(AVG(CASE WHEN {v}_act <> 0 THEN abs({v}_act - {v}_fc) / abs({v}_act) END) * 100, 6) AS mape,
       ROUND(AVG(abs({v}_act - {v}_fc)) * 100 / NULLIF(MAX(rng.r_{v}), 0), 6) AS nmae_pct,
       ROUND(sqrt(AVG(power({v}_act - {v}_fc, 2))) * 100 / NULLIF(MAX(rng.r_{v}), 0), 6) AS nrmse_pct, COUNT(*) AS n
FROM pairs CROSS JOIN rng""" for v in VARS)


def _round_verify(d):
    return d.withColumns({c: r6(c) for c in ("mae", "rmse", "mape", "nmae_pct", "nrmse_pct")})


@query("v1_verify", VERIFY_SQL)
def v1(fx):
    """MAE, RMSE, MAPE, range-normalised MAE / RMSE for each weather variable."""
    return _round_verify(Q.verify(_pairs(fx), VARS, mape="nonzero"))


@query("v2_verify_by_day", f"WITH {PAIRS_SQL}, rng AS (SELECT MAX(temperature_2m_act) - MIN(temperature_2m_act) AS r FROM pairs)\n"
       "SELECT CAST(time AS DATE) AS day, 'temperature_2m' AS variable, ROUND(AVG(abs(temperature_2m_act - temperature_2m_fc)), 6) AS mae, "
       "ROUND(sqrt(AVG(power(temperature_2m_act - temperature_2m_fc, 2))), 6) AS rmse, "
       "ROUND(AVG(CASE WHEN temperature_2m_act <> 0 THEN abs(temperature_2m_act - temperature_2m_fc) / abs(temperature_2m_act) END) * 100, 6) AS mape, "
       "ROUND(AVG(abs(temperature_2m_act - temperature_2m_fc)) * 100 / NULLIF(MAX(rng.r), 0), 6) AS nmae_pct, "
       "ROUND(sqrt(AVG(power(temperature_2m_act - temperature_2m_fc, 2))) * 100 / NULLIF(MAX(rng.r), 0), 6) AS nrmse_pct, COUNT(*) AS n "
       "FROM pairs CROSS JOIN rng GROUP BY 1")
def v2(fx):
    """The same metrics per day, the range taken over all rows."""
    return _round_verify(Q.verify(_pairs(fx), ["temperature_2m"], by=[F.to_date("time").alias("day")],
                                  mape="nonzero"))


@query("v3_rel_error_by", f"""WITH {PAIRS_SQL}
SELECT site_id, ROUND(AVG(CASE WHEN precipitation_act <> 0 THEN abs(precipitation_act - precipitation_fc) / abs(precipitation_act) END) * 100, 6)
       AS mean_rel_error_pct, COUNT(*) FILTER (WHERE precipitation_act <> 0) AS n_used FROM pairs GROUP BY 1
""")
def v3(fx):
    """Mean relative error % per site, zero actuals skipped."""
    d = Q.rel_error_by(_pairs(fx), "precipitation_act", "precipitation_fc", ["site_id"])
    return d.withColumn("mean_rel_error_pct", r6("mean_rel_error_pct"))


EVENT_SQL = """
SELECT {by} COUNT(*) FILTER (WHERE a > 0.1 AND f > 0.1) AS tp, COUNT(*) FILTER (WHERE a <= 0.1 AND f > 0.1) AS fp,
       COUNT(*) FILTER (WHERE a > 0.1 AND f <= 0.1) AS fn, COUNT(*) AS n FROM ev {group}"""


def _event_sql(by: str, empty: bool) -> str:
    g = EVENT_SQL.format(by=f"{by}," if by else "", group=f"GROUP BY {by}" if by else "")
    e = "tp + fp + fn = 0"
    p = "CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0e0 END"
    r = "CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0e0 END"
    f1 = f"CASE WHEN ({p}) + ({r}) > 0 THEN 2 * ({p}) * ({r}) / (({p}) + ({r})) ELSE 0e0 END"
    if empty:
        p, r, f1 = (f"CASE WHEN {e} THEN 1e0 ELSE {x} END" for x in (p, r, f1))
    cols = f"{by + ', ' if by else ''}tp, fp, fn, n, ROUND({p}, 6) AS precision, ROUND({r}, 6) AS recall, ROUND({f1}, 6) AS f1"
    return (f"WITH {PAIRS_SQL}, ev AS (SELECT CAST(time AS DATE) AS day, site_id, precipitation_act AS a, "
            f"precipitation_fc AS f FROM pairs), g AS ({g}) SELECT {cols} FROM g")


def _round_events(d):
    return d.withColumns({c: r6(c) for c in ("precision", "recall", "f1")})


@query("v4_event_scores", _event_sql("", False))
def v4(fx):
    """Rain detection precision / recall / F1 at 0.1 mm (zero division -> 0)."""
    return _round_events(Q.event_scores(_pairs(fx), "precipitation_act", "precipitation_fc", 0.1))


@query("v4_event_scores_by_site", _event_sql("site_id", True))
def v4b(fx):
    """Per site; a site with no event at all scores 1.0."""
    return _round_events(Q.event_scores(_pairs(fx), "precipitation_act", "precipitation_fc", 0.1,
                                        [F.col("site_id")], empty_score=1.0))


@query("v5_site_errors", f"""WITH {PAIRS_SQL},
m AS (SELECT site_id, AVG(abs(temperature_2m_act - temperature_2m_fc)) AS mae FROM pairs GROUP BY 1)
SELECT * FROM (SELECT site_id, ROUND(mae, 6) AS mae, 'best' AS rank_group FROM m ORDER BY mae ASC, site_id LIMIT 5)
UNION ALL SELECT * FROM (SELECT site_id, ROUND(mae, 6) AS mae, 'worst' AS rank_group FROM m ORDER BY mae DESC, site_id LIMIT 5)
""")
def v5(fx):
    """Best and worst 5 sites by temperature MAE."""
    return Q.site_errors(_pairs(fx), "site_id", "temperature_2m_act", "temperature_2m_fc", 5).withColumn("mae", r6("mae"))


@query("v6_largest_errors", f"""WITH {PAIRS_SQL}
SELECT site_id, time, ROUND(abs(wind_speed_10m_act - wind_speed_10m_fc), 6) AS abs_error FROM pairs
ORDER BY abs(wind_speed_10m_act - wind_speed_10m_fc) DESC, site_id, time LIMIT 10
""")
def v6(fx):
    """The 10 largest single wind errors."""
    d = Q.largest_errors(_pairs(fx), "wind_speed_10m_act", "wind_speed_10m_fc", 10, ["site_id", "time"])
    return d.select("site_id", "time", r6("abs_error").alias("abs_error"))


@query("v7_delta_features", f"WITH {PAIRS_SQL} SELECT site_id, time, " + ", ".join(
    f"ROUND({v}_fc - {v}_act, 6) AS delta_{v}" for v in VARS) + " FROM pairs")
def v7(fx):
    """Forecast minus observed for each variable."""
    d = Q.delta_features(_pairs(fx), VARS)
    return d.select("site_id", "time", *[r6(f"delta_{v}").alias(f"delta_{v}") for v in VARS])


EVAL_COLS = ("mae", "rmse", "r2", "explained_variance", "mae_over_mean")
EVAL_SQL = """SELECT {by} ROUND(AVG(abs(actual - {p})), 6) AS mae, ROUND(sqrt(AVG(power(actual - {p}, 2))), 6) AS rmse,
  ROUND(1 - SUM(power(actual - {p}, 2)) / NULLIF(var_pop(actual) * COUNT(*), 0), 6) AS r2,
  ROUND(1 - var_pop(actual - {p}) / NULLIF(var_pop(actual), 0), 6) AS explained_variance, COUNT(*) AS n,
  ROUND(AVG(abs(actual - {p})) / NULLIF(AVG(actual), 0), 6) AS mae_over_mean FROM {src} {group}"""


@query("v8_evaluate", EVAL_SQL.format(by="", p="predicted", src="v_pred", group=""))
def v8(fx):
    """MAE, RMSE, R^2, explained variance, MAE / mean observed."""
    return Q.evaluate(fx.pred, "actual", "predicted").withColumns({c: r6(c) for c in EVAL_COLS})


@query("v9_residuals", """
SELECT o_orderkey, ROUND(actual - predicted, 9) AS residual, ROUND(abs(actual - predicted), 9) AS abs_error,
       ROUND(predicted - actual, 9) AS signed_error FROM v_pred
""")
def v9(fx):
    """Residual, absolute and signed error columns."""
    d = Q.residuals(fx.pred, "actual", "predicted")
    return d.select("o_orderkey", *[r9(c).alias(c) for c in ("residual", "abs_error", "signed_error")])


@query("v10_error_by", """
SELECT nation, COUNT(*) AS n, ROUND(AVG(abs(actual - predicted)), 6) AS mae, ROUND(AVG(actual - predicted), 6) AS mean_error,
       ROUND(MAX(abs(actual - predicted)), 9) AS max_abs_error, ROUND(AVG(actual), 6) AS mean_actual,
       ROUND(AVG(predicted), 6) AS mean_pred FROM v_pred GROUP BY nation
""")
def v10(fx):
    """Error profile per nation."""
    d = Q.error_by(fx.pred, "actual", "predicted", [F.col("nation")])
    return d.withColumns({**{c: r6(c) for c in ("mae", "mean_error", "mean_actual", "mean_pred")},
                          "max_abs_error": r9("max_abs_error")})


@query("v11_under_prediction", """
SELECT nation, CAST(month(datetime_hour) AS INTEGER) AS month, ROUND(AVG(actual - predicted), 6) AS mean_under, COUNT(*) AS n_under
FROM v_pred WHERE actual - predicted > 0 GROUP BY 1, 2
""")
def v11(fx):
    """Under-prediction profile (positive residuals only) by nation x month."""
    d = Q.under_prediction(fx.pred, "actual", "predicted", [F.col("nation"), F.month("datetime_hour").alias("month")])
    return d.withColumn("mean_under", r6("mean_under"))


@query("v12_compare_models", "WITH p AS (SELECT *, predicted * 0.9e0 AS shrunk, AVG(actual) OVER (PARTITION BY nation) AS nation_mean FROM v_pred)\n"
       + "\nUNION ALL\n".join(EVAL_SQL.format(by=f"'{m}' AS model,", p=m, src="p", group="") for m in
                               ("predicted", "shrunk", "nation_mean")))
def v12(fx):
    """Metric table over three candidate predictions."""
    means = fx.pred.groupBy("nation").agg(F.avg("actual").alias("nation_mean"))
    d = fx.pred.withColumn("shrunk", F.col("predicted") * 0.9).join(means, "nation")
    return Q.compare_models(d, "actual", ["predicted", "shrunk", "nation_mean"]).withColumns(
        {c: r6(c) for c in EVAL_COLS})


# ---------------------------------------------------------------- R1-R11
SITE_POI_SQL = ("sp AS (SELECT site_id, municipality, CASE WHEN station_count > 0 THEN 'station' WHEN school_count > 0 THEN 'school' "
                "WHEN park_count > 0 THEN 'park' ELSE 'other' END AS poi_group FROM v_sites)")
RES_SQL = f"""{CW_SQL}, {SITE_POI_SQL},
cws AS (SELECT cw.*, sp.poi_group, sp.municipality FROM cw JOIN sp ON cw.site_id = sp.site_id),
res AS (SELECT site_id, AVG(CASE WHEN COALESCE(precipitation > 0, false) THEN cnt END) AS rainy_mean,
          AVG(CASE WHEN NOT COALESCE(precipitation > 0, false) THEN cnt END) AS clear_mean,
          COUNT(*) FILTER (WHERE COALESCE(precipitation > 0, false)) AS n_rainy,
          COUNT(*) FILTER (WHERE NOT COALESCE(precipitation > 0, false)) AS n_clear FROM cws GROUP BY site_id),
res2 AS (SELECT *, (clear_mean - rainy_mean) / NULLIF(clear_mean, 0) * 100 AS drop_pct,
                100 - (clear_mean - rainy_mean) / NULLIF(clear_mean, 0) * 100 AS resilience FROM res
         WHERE (clear_mean - rainy_mean) / NULLIF(clear_mean, 0) IS NOT NULL)"""


def _cws(fx):
    d = _counts_weather(fx)
    s = P.poi_group(fx.sites).select("site_id", "municipality", "poi_group")
    return d.join(s, "site_id")


def _rain():
    return F.col("precipitation") > 0


def _res(fx):
    return R.site_resilience(_cws(fx), "cnt", _rain())


@query("r1_rain_drop", f"""WITH {RES_SQL}
SELECT poi_group, ROUND(AVG(CASE WHEN COALESCE(precipitation > 0, false) THEN cnt END), 6) AS rainy_mean,
       ROUND(AVG(CASE WHEN NOT COALESCE(precipitation > 0, false) THEN cnt END), 6) AS clear_mean,
       COUNT(*) FILTER (WHERE COALESCE(precipitation > 0, false)) AS n_rainy,
       COUNT(*) FILTER (WHERE NOT COALESCE(precipitation > 0, false)) AS n_clear,
       ROUND((AVG(CASE WHEN NOT COALESCE(precipitation > 0, false) THEN cnt END) - AVG(CASE WHEN COALESCE(precipitation > 0, false) THEN cnt END))
             / AVG(CASE WHEN NOT COALESCE(precipitation > 0, false) THEN cnt END) * 100, 6) AS drop_pct
FROM cws GROUP BY poi_group
""")
def r1(fx):
    """Rainy / clear mean count and drop % per POI group."""
    d = R.rain_drop(_cws(fx), "cnt", _rain(), ["poi_group"])
    return d.withColumns({c: r6(c) for c in ("rainy_mean", "clear_mean", "drop_pct")})


RES_COLS = ("rainy_mean", "clear_mean", "drop_pct", "resilience")


@query("r2_site_resilience", f"WITH {RES_SQL} SELECT site_id, n_rainy, n_clear, " + ", ".join(
    f"ROUND({c}, 6) AS {c}" for c in RES_COLS) + " FROM res2")
def r2(fx):
    """Per-site drop % and resilience = 100 - drop (undefined removed)."""
    return _res(fx).withColumns({c: r6(c) for c in RES_COLS})


@query("r3_resilience_extremes", f"""WITH {RES_SQL}
SELECT * FROM (SELECT site_id, ROUND(resilience, 6) AS resilience, 'most' AS tag FROM res2 ORDER BY resilience DESC, site_id LIMIT 5)
UNION ALL SELECT * FROM (SELECT site_id, ROUND(resilience, 6) AS resilience, 'least' AS tag FROM res2 ORDER BY resilience ASC, site_id LIMIT 5)
""")
def r3(fx):
    """The 5 most and 5 least resilient sites."""
    res = _res(fx)
    most = res.orderBy(F.col("resilience").desc(), "site_id").limit(5).withColumn("tag", F.lit("most"))
    least = res.orderBy(F.col("resilience").asc(), "site_id").limit(5).withColumn("tag", F.lit("least"))
    return most.unionByName(least).select("site_id", r6("resilience").alias("resilience"), "tag")


@query("r4_priority_score", f"""WITH {RES_SQL},
t AS (SELECT site_id, AVG(cnt) AS traffic FROM cws GROUP BY 1),
j AS (SELECT sp.site_id, sp.poi_group, t.traffic, res2.drop_pct FROM sp JOIN t ON sp.site_id = t.site_id
      JOIN res2 ON sp.site_id = res2.site_id WHERE sp.poi_group IN ('station', 'school'))
SELECT site_id, poi_group, ROUND(((traffic - MIN(traffic) OVER ()) / NULLIF(MAX(traffic) OVER () - MIN(traffic) OVER (), 0) * 0.5
       + (drop_pct - MIN(drop_pct) OVER ()) / NULLIF(MAX(drop_pct) OVER () - MIN(drop_pct) OVER (), 0) * 0.5) * 100, 6) AS priority
FROM j
""")
def r4(fx):
    """Investment priority for essential sites: half traffic, half vulnerability."""
    cws = _cws(fx)
    t = cws.groupBy("site_id").agg(F.avg("cnt").alias("traffic"))
    dims = P.poi_group(fx.sites).filter(F.col("poi_group").isin("station", "school")).select("site_id", "poi_group")
    res = _res(fx).join(t, "site_id").select("site_id", "traffic", "drop_pct")
    d = R.priority_score(res, "site_id", "traffic", "drop_pct", how="inner", dims=dims)
    return d.select("site_id", "poi_group", r6("priority").alias("priority"))


@query("r5_priority_score_z", f"""WITH {RES_SQL},
t AS (SELECT site_id, AVG(cnt) AS traffic FROM cws GROUP BY 1),
j AS (SELECT res2.site_id, t.traffic, res2.drop_pct FROM res2 JOIN t ON res2.site_id = t.site_id)
SELECT site_id, ROUND(((traffic - AVG(traffic) OVER ()) / NULLIF(stddev_pop(traffic) OVER (), 0)
       + (drop_pct - AVG(drop_pct) OVER ()) / NULLIF(stddev_pop(drop_pct) OVER (), 0)) / 2, 6) AS priority_z FROM j
""")
def r5(fx):
    """Priority as the mean of two population z-scores."""
    t = _cws(fx).groupBy("site_id").agg(F.avg("cnt").alias("traffic"))
    res = _res(fx).join(t, "site_id").select("site_id", "traffic", "drop_pct")
    return R.priority_score_z(res, "traffic", "drop_pct").select("site_id", r6("priority_z").alias("priority_z"))


@query("r6_super_resilient", f"""WITH {RES_SQL},
top AS (SELECT site_id FROM res2 WHERE resilience > 100),
h AS (SELECT cws.site_id, CAST(hour(start_time) AS INTEGER) AS hour,
             AVG(CASE WHEN COALESCE(precipitation > 0, false) THEN cnt END) AS rainy_mean,
             AVG(CASE WHEN NOT COALESCE(precipitation > 0, false) THEN cnt END) AS clear_mean
      FROM cws JOIN top ON cws.site_id = top.site_id GROUP BY 1, 2),
h2 AS (SELECT site_id, hour, 100 - (clear_mean - rainy_mean) / NULLIF(clear_mean, 0) * 100 AS hourly_resilience FROM h),
best AS (SELECT site_id, arg_min(hour, (-hourly_resilience, hour)) AS best_hour FROM h2 WHERE hourly_resilience IS NOT NULL GROUP BY 1)
SELECT h2.site_id, h2.hour, ROUND(h2.hourly_resilience, 6) AS hourly_resilience, best.best_hour FROM h2 LEFT JOIN best ON h2.site_id = best.site_id
""")
def r6_super(fx):
    """Super-resilient sites (> 100), their hourly resilience and best hour."""
    d = R.super_resilient(_cws(fx), _res(fx), "cnt", _rain(), F.hour("start_time"))
    return d.select("site_id", "hour", r6_(F.col("hourly_resilience")).alias("hourly_resilience"), "best_hour")


def r6_(c):
    return F.round(c, 6)


@query("r7_phase_impact", f"""WITH {RES_SQL},
ph AS (SELECT poi_group, cnt, CASE WHEN precipitation > 0 THEN 'raining'
       WHEN COALESCE(lead(precipitation, 1) OVER (PARTITION BY site_id, direction ORDER BY start_time, event_id) > 0, false) THEN 'before_rain'
       ELSE 'clear' END AS phase FROM cws),
p AS (SELECT poi_group, AVG(cnt) FILTER (WHERE phase = 'raining') AS raining, AVG(cnt) FILTER (WHERE phase = 'before_rain') AS before_rain,
             AVG(cnt) FILTER (WHERE phase = 'clear') AS clear FROM ph GROUP BY 1)
SELECT poi_group, ROUND(raining, 6) AS raining, ROUND(before_rain, 6) AS before_rain, ROUND(clear, 6) AS clear,
       ROUND((raining - clear) / NULLIF(clear, 0) * 100, 6) AS raining_pct, ROUND((before_rain - clear) / NULLIF(clear, 0) * 100, 6) AS before_rain_pct
FROM p
""")
def r7(fx):
    """Raining / before-rain / clear means per POI group and % vs clear."""
    d = R.phase_impact(_cws(fx), "cnt", "precipitation", ["site_id", "direction"], "start_time", "poi_group",
                       tiebreak=["event_id"])
    return d.select("poi_group", *[r6(c).alias(c) for c in ("raining", "before_rain", "clear", "raining_pct",
                                                            "before_rain_pct")])


@query("r8_quadrants", f"""WITH {RES_SQL},
t AS (SELECT site_id, AVG(cnt) AS traffic FROM cws GROUP BY 1),
j AS (SELECT res2.site_id, t.traffic, res2.resilience FROM res2 JOIN t ON res2.site_id = t.site_id),
th AS (SELECT quantile_cont(traffic, 0.5) AS x0, quantile_cont(resilience, 0.5) AS y0 FROM j)
SELECT site_id, CASE WHEN traffic >= x0 AND resilience >= y0 THEN 'backbone' WHEN traffic >= x0 THEN 'at-risk'
                     WHEN resilience >= y0 THEN 'latent' ELSE 'greenway' END AS quadrant FROM j CROSS JOIN th
""")
def r8(fx):
    """Usage x resilience quadrants at the median thresholds."""
    t = _cws(fx).groupBy("site_id").agg(F.avg("cnt").alias("traffic"))
    d = _res(fx).join(t, "site_id").select("site_id", "traffic", "resilience")
    return R.quadrants(d, "traffic", "resilience").select("site_id", "quadrant")


ZONE_BASE = "z AS (SELECT nation, o_orderkey, predicted, 100 - abs(actual - predicted) / predicted * 100 AS res FROM v_pred)"


@query("r9_priority_zone", f"""WITH {ZONE_BASE},
t AS (SELECT nation, quantile_cont(predicted, 0.9) AS tp, quantile_cont(res, 0.8) AS tr FROM z GROUP BY 1),
s AS (SELECT z.*, 0.5 * (predicted - MIN(predicted) OVER w) / (MAX(predicted) OVER w - MIN(predicted) OVER w + 1e-9)
              + 0.5 * (res - MIN(res) OVER w) / (MAX(res) OVER w - MIN(res) OVER w + 1e-9) AS zone_score,
              predicted >= t.tp AND res >= t.tr AS in_zone
      FROM z JOIN t ON z.nation = t.nation WINDOW w AS (PARTITION BY z.nation)),
r AS (SELECT *, row_number() OVER (PARTITION BY nation ORDER BY zone_score DESC, o_orderkey) AS rn FROM s)
SELECT nation, o_orderkey, ROUND(zone_score, 6) AS zone_score, in_zone FROM r WHERE rn <= 5
""")
def r9_zone(fx):
    """Priority score per group (half normalised prediction, half
    resilience), top 5, flagged when inside the P90 / P80 zone."""
    z = fx.pred.withColumn("res", 100 - F.abs(F.col("actual") - F.col("predicted")) / F.col("predicted") * 100)
    d = R.priority_zone(z, "nation", "predicted", "res", k=5, tiebreak=["o_orderkey"])
    return d.select("nation", "o_orderkey", r6("zone_score").alias("zone_score"), "in_zone")


@query("r10_counterfactual_weather", """
SELECT site_id, time, 0e0 AS precipitation, 0e0 AS wind_speed_10m,
       ROUND(AVG(temperature_2m) OVER (PARTITION BY site_id), 9) AS temperature_2m FROM v_weather
""")
def r10(fx):
    """'Perfect weather': rain and wind 0, temperature = site mean."""
    d = R.counterfactual_weather(fx.weather, "site_id", ["temperature_2m"], ["precipitation", "wind_speed_10m"])
    return d.select("site_id", "time", "precipitation", "wind_speed_10m", F.round("temperature_2m", 9).alias("temperature_2m"))


@query("r11_resilience_composite", f"""WITH {CW_SQL},
g AS (SELECT site_id, regr_r2(cnt, temperature_2m) AS r2, abs(regr_slope(cnt, precipitation)) AS rain_slope,
             abs(regr_slope(cnt, wind_speed_10m)) AS wind_slope FROM cw GROUP BY 1),
n AS (SELECT *, (rain_slope - MIN(rain_slope) OVER ()) / NULLIF(MAX(rain_slope) OVER () - MIN(rain_slope) OVER (), 0) AS rain_sens,
             (wind_slope - MIN(wind_slope) OVER ()) / NULLIF(MAX(wind_slope) OVER () - MIN(wind_slope) OVER (), 0) AS wind_sens FROM g)
SELECT site_id, ROUND(1 - (0.5 * r2 + 0.3 * rain_sens + 0.2 * wind_sens), 4) AS composite FROM n
""")
def r11(fx):
    """Composite resilience from per-site regressions."""
    d = R.resilience_composite(_counts_weather(fx), "site_id", "cnt", "temperature_2m", "precipitation", "wind_speed_10m")
    return d.select("site_id", F.round("composite", 4).alias("composite"))


# ---------------------------------------------------------------- I1-I11
IMPACT_SQL = """
i0 AS (SELECT o_orderkey, site_id, nation, datetime_hour, CAST(predicted AS DECIMAL(20, 9)) AS p, CAST(4.0 AS DECIMAL(10, 3)) AS km FROM v_pred),
i1 AS (SELECT *, ROUND(p * 0.35, 2) AS car_trips_replaced FROM i0),
i2 AS (SELECT *, ROUND(car_trips_replaced * km, 2) AS km_not_driven FROM i1),
i3 AS (SELECT *, ROUND(km_not_driven * 120 * 0.001, 3) AS co2_saved_kg, ROUND(km_not_driven * 0.07, 3) AS fuel_saved_litres,
              ROUND(p * km * 40, 0) AS kcal_burned, ROUND(km_not_driven * 0.03, 3) AS health_cost_avoided_eur FROM i2),
i4 AS (SELECT *, ROUND(fuel_saved_litres * 1.75, 3) AS fuel_cost_saved_eur, ROUND(co2_saved_kg * 0.001 * 65, 4) AS carbon_value_eur FROM i3),
imp AS (SELECT *, ROUND(fuel_cost_saved_eur + carbon_value_eur + health_cost_avoided_eur, 3) AS total_value_eur FROM i4)"""
ICOLS = R.IMPACT_COLS


def _impact(fx):
    return R.impact(fx.pred, "predicted")


@query("i1_impact", f"WITH {IMPACT_SQL} SELECT o_orderkey, " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in ICOLS) + " FROM imp")
def i1(fx):
    """Nine impact columns with rounding at each step (exact decimals)."""
    return _impact(fx).select("o_orderkey", *[F.col(c).cast("double").alias(c) for c in ICOLS])


@query("i2_impact_v2", """
SELECT o_orderkey, CAST(ROUND(CAST(predicted AS DECIMAL(20, 9)) * 0.35 * 0.8 * 5.0 * 120 * 0.001, 6) AS DOUBLE) AS co2_saved_kg,
       CAST(ROUND(CAST(predicted AS DECIMAL(20, 9)) * 0.35 * 0.8 * 5.0 * 0.07 * 1.75
            + CAST(predicted AS DECIMAL(20, 9)) * 0.35 * 0.8 * 5.0 * 120 * 0.001 * 0.001 * 65
            + CAST(predicted AS DECIMAL(20, 9)) * 0.35 * 0.8 * 5.0 * 0.03, 6) AS DOUBLE) AS total_value_eur FROM v_pred
""")
def i2(fx):
    """Variant with a trip-correction factor, no intermediate rounding."""
    d = R.impact_v2(fx.pred, "predicted")
    return d.select("o_orderkey", F.round("co2_saved_kg", 6).cast("double").alias("co2_saved_kg"),
                    F.round("total_value_eur", 6).cast("double").alias("total_value_eur"))


IMPACT_TOTALS = ("car_trips_replaced", "co2_saved_kg", "total_value_eur")


def _register_impact_by(period, key_sql, key):
    @query(f"i3_impact_by_{period}", f"""WITH {IMPACT_SQL}
SELECT {key_sql} AS {period}, """ + ", ".join(f"CAST(SUM({c}) AS DOUBLE) AS {c}" for c in IMPACT_TOTALS) + """, COUNT(*) AS n
FROM imp GROUP BY 1
""")
    def i3_by(fx):
        """Impact totals by a calendar part of the hour."""
        d = R.impact_by(_impact(fx), key(F.col("datetime_hour")), period)
        return d.withColumns({c: F.col(c).cast("double") for c in IMPACT_TOTALS})


_register_impact_by("date", "CAST(CAST(datetime_hour AS DATE) AS TIMESTAMP)", F.to_date)
_register_impact_by("year", "CAST(year(datetime_hour) AS INTEGER)", F.year)
_register_impact_by("hour", "CAST(hour(datetime_hour) AS INTEGER)", F.hour)


@query("i3_impact_by_weekday", f"""WITH {IMPACT_SQL}
SELECT CAST(isodow(datetime_hour) - 1 AS INTEGER) AS weekday, CAST(SUM(car_trips_replaced) AS DOUBLE) AS car_trips_replaced,
       CAST(SUM(co2_saved_kg) AS DOUBLE) AS co2_saved_kg, CAST(SUM(total_value_eur) AS DOUBLE) AS total_value_eur, COUNT(*) AS n
FROM imp GROUP BY 1
""")
def i3(fx):
    """Impact totals by weekday."""
    d = R.impact_by(_impact(fx), D.weekday0("datetime_hour"), "weekday")
    return d.withColumns({c: F.col(c).cast("double") for c in ("car_trips_replaced", "co2_saved_kg", "total_value_eur")})


@query("i4_impact_sites", f"""WITH {IMPACT_SQL},
t AS (SELECT site_id, SUM(total_value_eur) AS v, SUM(co2_saved_kg) AS c FROM imp GROUP BY 1)
SELECT site_id, CAST(v AS DOUBLE) AS total_value_eur, CAST(c AS DOUBLE) AS co2_saved_kg, CAST(c * 0.001 AS DOUBLE) AS co2_saved_tonnes,
       row_number() OVER (ORDER BY v DESC, site_id) AS rank FROM t
""")
def i4(fx):
    """Site totals, tonnes and rank."""
    d = R.impact_sites(_impact(fx))
    return d.withColumns({c: F.col(c).cast("double") for c in ("total_value_eur", "co2_saved_kg", "co2_saved_tonnes")})


CITY_SQL = f"""{IMPACT_SQL},
ic AS (SELECT n.n_name AS municipality, imp.* FROM imp JOIN nation n ON imp.nation = n.n_nationkey),
city AS (SELECT municipality, COUNT(DISTINCT site_id) AS site_count, SUM(total_value_eur) AS total_value_eur,
         SUM(co2_saved_kg) AS co2_saved_kg,
         SUM(CASE WHEN isodow(datetime_hour) < 6 THEN total_value_eur ELSE 0 END) AS weekday_value,
         SUM(CASE WHEN isodow(datetime_hour) >= 6 THEN total_value_eur ELSE 0 END) AS weekend_value,
         SUM(CASE WHEN hour(datetime_hour) IN (7, 8, 9, 16, 17, 18) THEN total_value_eur ELSE 0 END) AS peak_value,
         SUM(car_trips_replaced) AS trips FROM ic GROUP BY 1),
cp AS (SELECT city.*, v_pop.population, CAST(total_value_eur AS DOUBLE) / population AS value_per_capita,
       CAST(co2_saved_kg AS DOUBLE) / population AS co2_saved_kg_per_capita,
       CAST(weekday_value AS DOUBLE) / (CAST(weekend_value AS DOUBLE) + 1e-9) AS weekday_weekend_ratio
       FROM city LEFT JOIN v_pop ON city.municipality = v_pop.municipality)"""


def _city(fx):
    imp = _impact(fx).join(small(fx.table("nation").select(F.col("n_nationkey").alias("nation"),
                                                           F.col("n_name").alias("municipality"))), "nation")
    return R.impact_city(imp, "municipality", fx.pop, D.is_weekend("datetime_hour"), D.is_rush_hour(F.hour("datetime_hour")))


@query("i5_impact_city", f"""WITH {CITY_SQL}
SELECT municipality, site_count, CAST(total_value_eur AS DOUBLE) AS total_value_eur, CAST(weekday_value AS DOUBLE) AS weekday_value,
       CAST(weekend_value AS DOUBLE) AS weekend_value, CAST(peak_value AS DOUBLE) AS peak_value, population,
       ROUND(value_per_capita, 9) AS value_per_capita, ROUND(co2_saved_kg_per_capita, 9) AS co2_saved_kg_per_capita,
       ROUND(weekday_weekend_ratio, 6) AS weekday_weekend_ratio FROM cp
""")
def i5(fx):
    """Municipality totals with population, per-capita value and day splits."""
    d = _city(fx)
    return d.select("municipality", "site_count", *[F.col(c).cast("double").alias(c) for c in
                                                    ("total_value_eur", "weekday_value", "weekend_value", "peak_value")],
                    "population", F.round("value_per_capita", 9).alias("value_per_capita"),
                    F.round("co2_saved_kg_per_capita", 9).alias("co2_saved_kg_per_capita"),
                    r6("weekday_weekend_ratio").alias("weekday_weekend_ratio"))


PRIORITY_TERMS = {"total_value_eur": 0.30, "value_per_capita": 0.25, "trips": 0.20, "peak_value": 0.15,
                  "population": 0.10}


@query("i6_impact_priority", f"""WITH {CITY_SQL},
x AS (SELECT municipality, CAST(total_value_eur AS DOUBLE) AS a, value_per_capita AS b, CAST(trips AS DOUBLE) AS c,
             CAST(peak_value AS DOUBLE) AS d, CAST(population AS DOUBLE) AS e FROM cp),
s AS (SELECT municipality, 0.3 * COALESCE((a - MIN(a) OVER ()) / NULLIF(MAX(a) OVER () - MIN(a) OVER (), 0), 0)
   + 0.25 * COALESCE((b - MIN(b) OVER ()) / NULLIF(MAX(b) OVER () - MIN(b) OVER (), 0), 0)
   + 0.2 * COALESCE((c - MIN(c) OVER ()) / NULLIF(MAX(c) OVER () - MIN(c) OVER (), 0), 0)
   + 0.15 * COALESCE((d - MIN(d) OVER ()) / NULLIF(MAX(d) OVER () - MIN(d) OVER (), 0), 0)
   + 0.1 * COALESCE((e - MIN(e) OVER ()) / NULLIF(MAX(e) OVER () - MIN(e) OVER (), 0), 0) AS priority FROM x)
SELECT municipality, ROUND(priority, 6) AS priority, row_number() OVER (ORDER BY priority DESC, municipality) AS rank FROM s
""")
def i6(fx):
    """Weighted priority of five min-max terms (.30 .25 .20 .15 .10), ranked."""
    d = _city(fx).select("municipality", *[F.col(c).cast("double").alias(c) for c in PRIORITY_TERMS])
    d = R.impact_priority(d, "municipality", PRIORITY_TERMS)
    return d.select("municipality", r6("priority").alias("priority"), "rank")


# The three documented scenarios (shift rate, trip km).
SCENARIOS = [("conservative", 0.2, 3.0), ("base", 0.35, 4.0), ("optimistic", 0.5, 5.0)]


@query("i8_scenarios", "WITH t AS (SELECT nation, SUM(CAST(predicted AS DECIMAL(20, 9))) AS p FROM v_pred GROUP BY 1), "
       "s(scenario, rate, km) AS (VALUES " + ", ".join(f"('{a}', {b}, {c})" for a, b, c in SCENARIOS) + ") "
       "SELECT nation, scenario, CAST(ROUND(p * rate * km, 4) AS DOUBLE) AS km_not_driven FROM t CROSS JOIN s")
def i8(fx):
    """Conservative / base / optimistic scenario totals per nation."""
    t = fx.pred.groupBy("nation").agg(F.sum(F.col("predicted").cast("decimal(20,9)")).alias("p"))
    sc = fx.spark.createDataFrame([(a, str(b), str(c)) for a, b, c in SCENARIOS], "scenario string, rate string, km string") \
        .select("scenario", F.col("rate").cast("decimal(4,2)").alias("rate"), F.col("km").cast("decimal(4,1)").alias("km"))
    d = t.crossJoin(F.broadcast(sc))
    return d.select("nation", "scenario", F.round(F.col("p") * F.col("rate") * F.col("km"), 4).cast("double").alias("km_not_driven"))


@query("i9_annualise", f"""WITH {IMPACT_SQL},
dow AS (SELECT isodow(datetime_hour) - 1 AS d, AVG(CAST(total_value_eur AS DOUBLE)) AS a FROM imp GROUP BY 1),
r AS (SELECT AVG(a) FILTER (WHERE d < 5) / AVG(a) FILTER (WHERE d >= 5) AS weekday_weekend_ratio FROM dow),
a AS (SELECT SUM(CAST(total_value_eur AS DOUBLE)) AS total,
             FLOOR((epoch(MAX(datetime_hour)) - epoch(MIN(datetime_hour))) / 86400) + 1 AS n_days,
             CAST(SUM(p) AS DOUBLE) AS predicted_trips FROM imp)
SELECT ROUND(total, 4) AS total, CAST(n_days AS BIGINT) AS n_days, ROUND(total / n_days, 6) AS per_day,
       ROUND(total / n_days * 365 * 1.4, 4) AS per_year, ROUND(total / predicted_trips, 9) AS value_per_trip,
       ROUND(total * 1000 / predicted_trips, 6) AS value_per_1000_trips, ROUND(weekday_weekend_ratio, 6) AS weekday_weekend_ratio
FROM a CROSS JOIN r
""")
def i9(fx):
    """Annualised value (x1.4 uplift), value per trip and per 1000 trips,
    weekday / weekend ratio of per-weekday means."""
    imp = _impact(fx).withColumn("p", F.col("predicted").cast("decimal(20,9)"))
    d = R.annualise(imp, "datetime_hour", "p", 1.4)
    return d.select(F.round("total", 4).alias("total"), F.col("n_days").cast("bigint").alias("n_days"),
                    r6("per_day").alias("per_day"), F.round("per_year", 4).alias("per_year"),
                    F.round("value_per_trip", 9).alias("value_per_trip"),
                    r6("value_per_1000_trips").alias("value_per_1000_trips"),
                    r6("weekday_weekend_ratio").alias("weekday_weekend_ratio"))


@query("i10_population", "SELECT municipality, population FROM v_pop")
def i10(fx):
    """Population per municipality summed from fine-grained census rows."""
    c = fx.table("customer").select("c_nationkey", F.lit(1000).cast("bigint").alias("persons"))
    n = small(fx.table("nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("municipality")))
    return R.population(c.join(n, "c_nationkey"), "municipality", "persons")


@query("i11_city_ranking", f"""WITH {CITY_SQL}
SELECT municipality, ROUND(AVG(value_per_capita) * 1000, 6) AS per_1000 FROM cp GROUP BY 1 ORDER BY per_1000 DESC, municipality LIMIT 10
""")
def i11(fx):
    """Top-10 municipalities by per-capita value, per 1000 inhabitants."""
    return R.city_ranking(_city(fx), "municipality", "value_per_capita").withColumn("per_1000", r6("per_1000"))


# ---------------------------------------------------------------- N4-N6
@query("n4_combine_flags", """
WITH f AS (SELECT CAST(actual - predicted > 150 AS INTEGER) AS rolling_outlier, CAST(actual - predicted < -150 AS INTEGER) AS sensor_fault FROM v_pred)
SELECT COUNT(*) FILTER (WHERE rolling_outlier = 1) AS n_rolling_outlier, COUNT(*) FILTER (WHERE sensor_fault = 1) AS n_sensor_fault,
       COUNT(*) FILTER (WHERE rolling_outlier = 1 AND sensor_fault = 1) AS n_both,
       COUNT(*) FILTER (WHERE rolling_outlier = 1 OR sensor_fault = 1) AS n_any FROM f
""")
def n4(fx):
    """Counts per flag layer, both, and either."""
    e = F.col("actual") - F.col("predicted")
    d = fx.pred.select((e > 150).cast("int").alias("rolling_outlier"), (e < -150).cast("int").alias("sensor_fault"))
    return NA.combine_flags(d)


@query("n5_hour_kpis", """
SELECT CAST(hour(datetime_hour) AS INTEGER) AS hour, ROUND(AVG(actual - predicted), 6) AS mean_error, COUNT(*) FILTER (WHERE actual - predicted > 140) AS n_surges,
       COUNT(*) FILTER (WHERE actual - predicted < -120) AS n_blockages, ROUND(AVG(actual), 6) AS mean_actual, COUNT(*) AS n_rows
FROM v_pred GROUP BY 1
""")
def n5(fx):
    """Alert KPIs for every hour at once (+140 / -120 thresholds)."""
    d = fx.pred.withColumns({"hour": F.hour("datetime_hour"), "err": F.col("actual") - F.col("predicted")})
    return NA.hour_kpis(d, "hour", "err", "actual", 140.0, -120.0).withColumns(
        {"mean_error": r6("mean_error"), "mean_actual": r6("mean_actual")})


@query("n6_investigation_queue", """
SELECT site_id, o_orderkey, ROUND(actual - predicted, 9) AS err,
       CASE WHEN actual - predicted > 140 THEN 'surge' ELSE 'blockage' END AS status
FROM v_pred WHERE actual - predicted > 140 OR actual - predicted < -120
""")
def n6(fx):
    """Every alert, largest absolute error first."""
    d = fx.pred.withColumn("err", F.col("actual") - F.col("predicted"))
    q = NA.investigation_queue(d, "err", 140.0, -120.0, tiebreak=["o_orderkey"])
    return q.select("site_id", "o_orderkey", r9("err").alias("err"), "status")


# ---------------------------------------------------------------- F5, F6, F10, F12-F14, C6, C7
FIT_CUT = "2024-01-16"
ENC_SQL = f"""
tr AS (SELECT site_id, direction, hour(start_time) AS hour, isodow(start_time) - 1 AS dow, cnt FROM v_counts WHERE start_time < TIMESTAMP '{FIT_CUT}'),
te AS (SELECT event_id, site_id, direction, hour(start_time) AS hour, isodow(start_time) - 1 AS dow FROM v_counts WHERE start_time >= TIMESTAMP '{FIT_CUT}'),
e_site AS (SELECT site_id, AVG(cnt) AS enc_site FROM tr GROUP BY 1),
e_sdh AS (SELECT site_id, direction, hour, AVG(cnt) AS enc_site_dir_hour FROM tr GROUP BY 1, 2, 3),
e_sdd AS (SELECT site_id, direction, dow, AVG(cnt) AS enc_site_dir_dow FROM tr GROUP BY 1, 2, 3),
e_sd AS (SELECT site_id, direction, AVG(cnt) AS enc_site_dir FROM tr GROUP BY 1, 2),
g AS (SELECT AVG(enc_site) AS gmean FROM e_site)"""


@query("f5_mean_encodings", f"""WITH {ENC_SQL}
SELECT te.event_id, ROUND(COALESCE(enc_site, gmean), 6) AS enc_site, ROUND(COALESCE(enc_site_dir_hour, gmean), 6) AS enc_site_dir_hour,
       ROUND(COALESCE(enc_site_dir_dow, gmean), 6) AS enc_site_dir_dow, ROUND(COALESCE(enc_site_dir, gmean), 6) AS enc_site_dir
FROM te LEFT JOIN e_site USING (site_id) LEFT JOIN e_sdh USING (site_id, direction, hour) LEFT JOIN e_sdd USING (site_id, direction, dow)
LEFT JOIN e_sd USING (site_id, direction) CROSS JOIN g
""")
def f5(fx):
    """Mean encodings fitted on early rows, applied later with global fallback."""
    c = fx.counts.withColumns({"hour": F.hour("start_time"), "dow": D.weekday0("start_time")})
    cut = F.lit(FIT_CUT).cast("timestamp_ntz")
    enc = ML.fit_encodings(c.filter(F.col("start_time") < cut), "cnt", {
        "enc_site": ["site_id"], "enc_site_dir_hour": ["site_id", "direction", "hour"],
        "enc_site_dir_dow": ["site_id", "direction", "dow"], "enc_site_dir": ["site_id", "direction"]})
    d = ML.apply_encodings(c.filter(F.col("start_time") >= cut), enc)
    return d.select("event_id", *[r6(n).alias(n) for n in ("enc_site", "enc_site_dir_hour", "enc_site_dir_dow", "enc_site_dir")])


@query("f6_historical_baseline", f"""
WITH tr AS (SELECT site_id, hour(start_time) AS hour, isodow(start_time) - 1 AS dow, cnt FROM v_counts WHERE start_time < TIMESTAMP '{FIT_CUT}'),
b AS (SELECT site_id, hour, dow, AVG(cnt) AS baseline FROM tr GROUP BY 1, 2, 3),
g AS (SELECT AVG(cnt) AS m FROM tr)
SELECT c.event_id, ROUND(COALESCE(b.baseline, g.m), 6) AS baseline FROM v_counts c
LEFT JOIN b ON c.site_id = b.site_id AND hour(c.start_time) = b.hour AND isodow(c.start_time) - 1 = b.dow CROSS JOIN g
WHERE c.start_time >= TIMESTAMP '{FIT_CUT}'
""")
def f6(fx):
    """Mean by (site, hour, weekday) with the overall mean as fallback."""
    c = fx.counts.withColumns({"hour": F.hour("start_time"), "dow": D.weekday0("start_time")})
    cut = F.lit(FIT_CUT).cast("timestamp_ntz")
    d = ML.historical_baseline(c.filter(F.col("start_time") < cut), c.filter(F.col("start_time") >= cut),
                               ["site_id", "hour", "dow"], "cnt")
    return d.select("event_id", r6("baseline").alias("baseline"))


@query("f10_best_blend", """
WITH p AS (SELECT actual, predicted, AVG(actual) OVER (PARTITION BY nation) AS p2 FROM v_pred),
w(w) AS (VALUES (0.1e0), (0.2e0), (0.3e0), (0.4e0), (0.5e0), (0.6e0), (0.7e0), (0.8e0), (0.9e0)),
m AS (SELECT w, AVG(abs(actual - (w * predicted + (1 - w) * p2))) AS mae FROM p CROSS JOIN w GROUP BY w)
SELECT w, ROUND(mae, 6) AS mae, w = (SELECT arg_min(w, mae) FROM m) AS best FROM m
""")
def f10(fx):
    """Blend weight 0.1..0.9 by MAE, best flagged."""
    means = fx.pred.groupBy("nation").agg(F.avg("actual").alias("p2"))
    d = fx.pred.join(means, "nation")
    return ML.best_blend(d, "actual", "predicted", "p2").withColumn("mae", r6("mae"))


@query("f12_temporal_split", """
SELECT unique_id, ds, CASE WHEN ds < DATE '1999-01-01' THEN 'train' WHEN ds < DATE '2000-01-01' THEN 'validation' ELSE 'test' END AS split
FROM v_daily
""")
def f12(fx):
    """Train / validation / test label by date."""
    return ML.temporal_split(fx.daily, "ds", ["1999-01-01", "2000-01-01"]).select("unique_id", "ds", "split")


@query("f13_ordered_split", """
SELECT unique_id, ds, CASE WHEN row_number() OVER (PARTITION BY unique_id ORDER BY ds) - 1
       >= CAST(FLOOR(0.85 * COUNT(*) OVER (PARTITION BY unique_id)) AS BIGINT) THEN 'inner_valid' ELSE 'inner_train' END AS part
FROM v_daily
""")
def f13(fx):
    """Per series, the last 15 % of rows in time order become inner validation."""
    return ML.ordered_split(fx.daily, ["unique_id"], "ds", 0.85).select("unique_id", "ds", "part")


@query("f14_route_known", f"""
WITH tr AS (SELECT site_id, AVG(cnt) AS m FROM v_counts WHERE start_time < TIMESTAMP '{FIT_CUT}' AND site_id % 5 <> 0 GROUP BY 1),
g AS (SELECT AVG(cnt) AS gm FROM v_counts WHERE start_time < TIMESTAMP '{FIT_CUT}' AND site_id % 5 <> 0)
SELECT c.event_id, CASE WHEN tr.m IS NOT NULL THEN 'known' ELSE 'unknown' END AS route, ROUND(COALESCE(tr.m, g.gm), 6) AS pred
FROM v_counts c LEFT JOIN tr ON c.site_id = tr.site_id CROSS JOIN g WHERE c.start_time >= TIMESTAMP '{FIT_CUT}'
""")
def f14(fx):
    """Known sites get their own model (site mean), unknown ones the fallback."""
    cut = F.lit(FIT_CUT).cast("timestamp_ntz")
    train = fx.counts.filter((F.col("start_time") < cut) & (F.col("site_id") % 5 != 0))
    test = fx.counts.filter(F.col("start_time") >= cut)
    d = ML.route_known(train, test, "site_id", "cnt")
    return d.select("event_id", "route", r6("pred").alias("pred"))


@query("c6_transitions", """
WITH a AS (SELECT site_id, AVG(cnt) AS m FROM v_counts WHERE start_time < TIMESTAMP '2024-01-16' GROUP BY 1),
b AS (SELECT site_id, AVG(cnt) AS m FROM v_counts WHERE start_time >= TIMESTAMP '2024-01-16' GROUP BY 1),
j AS (SELECT a.site_id, a.m AS ma, b.m AS mb, CASE WHEN a.m >= 10 THEN 'high' ELSE 'low' END AS label_a,
             CASE WHEN b.m >= 10 THEN 'high' ELSE 'low' END AS label_b FROM a JOIN b ON a.site_id = b.site_id)
SELECT site_id, label_a, label_b, CASE WHEN label_a = label_b THEN 'stable' WHEN label_b = 'high' THEN 'up' ELSE 'down' END AS shift,
       ROUND(mb - ma, 6) AS delta, ROUND((mb - ma) / (ma + 1e-6) * 100, 6) AS pct_change FROM j
""")
def c6(fx):
    """Label transitions between two periods: shift type, change and % change."""
    cut = F.lit("2024-01-16").cast("timestamp_ntz")
    a = fx.counts.filter(F.col("start_time") < cut).groupBy("site_id").agg(F.avg("cnt").alias("ma"))
    b = fx.counts.filter(F.col("start_time") >= cut).groupBy("site_id").agg(F.avg("cnt").alias("mb"))
    d = ML.transitions(a, b, "site_id", "ma", "mb", 10.0)
    return d.select("site_id", "label_a", "label_b", "shift", r6("delta").alias("delta"), r6("pct_change").alias("pct_change"))


@query("c6_transition_matrix", """
WITH a AS (SELECT site_id, AVG(cnt) AS m FROM v_counts WHERE start_time < TIMESTAMP '2024-01-16' GROUP BY 1),
b AS (SELECT site_id, AVG(cnt) AS m FROM v_counts WHERE start_time >= TIMESTAMP '2024-01-16' GROUP BY 1),
j AS (SELECT CASE WHEN a.m >= 10 THEN 'high' ELSE 'low' END AS label_a, CASE WHEN b.m >= 10 THEN 'high' ELSE 'low' END AS label_b
      FROM a JOIN b ON a.site_id = b.site_id)
SELECT label_a, COUNT(*) FILTER (WHERE label_b = 'high') AS to_high, COUNT(*) FILTER (WHERE label_b = 'low') AS to_low
FROM j GROUP BY 1
""")
def c6_matrix(fx):
    """Transition matrix: labels of the first period by labels of the second."""
    cut = F.lit("2024-01-16").cast("timestamp_ntz")
    a = fx.counts.filter(F.col("start_time") < cut).groupBy("site_id").agg(F.avg("cnt").alias("ma"))
    b = fx.counts.filter(F.col("start_time") >= cut).groupBy("site_id").agg(F.avg("cnt").alias("mb"))
    return ML.transition_matrix(ML.transitions(a, b, "site_id", "ma", "mb", 10.0), "label_a", "label_b", ["high", "low"])


@query("c7_label_agreement", """
WITH l AS (SELECT CASE WHEN station_count > 0 THEN 'station' WHEN school_count > 0 THEN 'school' WHEN park_count > 0 THEN 'park' ELSE 'other' END AS a,
                  district AS b FROM v_sites),
n AS (SELECT a, b, COUNT(*) AS n FROM l GROUP BY 1, 2),
ra AS (SELECT a, SUM(n) AS n FROM n GROUP BY 1), rb AS (SELECT b, SUM(n) AS n FROM n GROUP BY 1),
t AS (SELECT SUM(n) AS n FROM n),
s AS (SELECT (SELECT SUM(n * (n - 1) / 2) FROM n) AS sij, (SELECT SUM(n * (n - 1) / 2) FROM ra) AS sa,
             (SELECT SUM(n * (n - 1) / 2) FROM rb) AS sb, (SELECT n FROM t) AS tot),
mi AS (SELECT SUM(n.n / t.n * ln(n.n * t.n / (ra.n * rb.n))) AS mi FROM n JOIN ra ON n.a = ra.a JOIN rb ON n.b = rb.b CROSS JOIN t),
ha AS (SELECT -SUM(ra.n / t.n * ln(ra.n / t.n)) AS h FROM ra CROSS JOIN t),
hb AS (SELECT -SUM(rb.n / t.n * ln(rb.n / t.n)) AS h FROM rb CROSS JOIN t)
SELECT ROUND((sij - sa * sb / (tot * (tot - 1) / 2)) / (0.5 * (sa + sb) - sa * sb / (tot * (tot - 1) / 2)), 6) AS ari,
       ROUND(mi.mi / ((ha.h + hb.h) / 2), 6) AS nmi FROM s CROSS JOIN mi CROSS JOIN ha CROSS JOIN hb
""")
def c7(fx):
    """Adjusted Rand index and NMI between two labelings (contingency sums)."""
    d = P.poi_group(fx.sites).select(F.col("poi_group").alias("a"), F.col("district").alias("b"))
    return ML.label_agreement(d, "a", "b").select(r6("ari").alias("ari"), r6("nmi").alias("nmi"))


# ---------------------------------------------------------------- I7, J10, J11, V13
RATES_I7 = ["0.05", "0.10", "0.15", "0.20", "0.25", "0.30", "0.35", "0.40"]


@query("i7_modal_shift_sensitivity", "WITH r(rate) AS (VALUES " + ", ".join(f"({x})" for x in RATES_I7) + "), "
       "p AS (SELECT CAST(predicted AS DECIMAL(20, 9)) AS p FROM v_pred), "
       "c AS (SELECT rate, ROUND(p * rate, 2) AS trips FROM p CROSS JOIN r), "
       "k AS (SELECT rate, trips, ROUND(trips * 4.0, 2) AS km FROM c) "
       "SELECT CAST(rate AS DOUBLE) AS rate, CAST(SUM(trips) AS DOUBLE) AS car_trips_replaced, "
       "CAST(SUM(ROUND(km * 120 * 0.001, 3)) AS DOUBLE) AS co2_saved_kg FROM k GROUP BY rate")
def i7(fx):
    """Impact totals under 8 modal-shift rates (the cascade re-run per rate)."""
    d = fx.pred.select(F.col("predicted").cast("decimal(20,9)").alias("p"))
    totals = []
    for x in RATES_I7:  # one pass: a pair of sums per rate, turned into rows at the end
        trips = F.round(F.col("p") * F.lit(Decimal(x)).cast("decimal(4,2)"), 2)
        km = F.round(trips * F.lit(Decimal("4.0")), 2)
        co2 = F.round(km * F.lit(Decimal("120")) * F.lit(Decimal("0.001")), 3)
        totals.append(F.struct(F.lit(float(x)).alias("rate"), F.sum(trips).cast("double").alias("car_trips_replaced"),
                               F.sum(co2).cast("double").alias("co2_saved_kg")))
    return d.agg(F.array(*totals).alias("t")).select(F.explode("t").alias("t")).select("t.*")


@query("j10_apply_encodings", """
WITH tr AS (SELECT site_id, hour(start_time) AS hour, cnt FROM v_counts WHERE direction = 'IN'),
e1 AS (SELECT site_id, AVG(cnt) AS enc_site FROM tr GROUP BY 1),
e2 AS (SELECT site_id, hour, AVG(cnt) AS enc_site_hour FROM tr GROUP BY 1, 2),
g AS (SELECT AVG(enc_site) AS gm FROM e1)
SELECT c.event_id, ROUND(COALESCE(e1.enc_site, g.gm), 6) AS enc_site, ROUND(COALESCE(e2.enc_site_hour, g.gm), 6) AS enc_site_hour
FROM v_counts c LEFT JOIN e1 ON c.site_id = e1.site_id LEFT JOIN e2 ON c.site_id = e2.site_id AND hour(c.start_time) = e2.hour
CROSS JOIN g WHERE c.direction = 'OUT'
""")
def j10(fx):
    """Multi-key encoding lookup (fitted on one direction) applied to the
    other, missing keys falling back to the global value."""
    c = fx.counts.withColumn("hour", F.hour("start_time"))
    enc = ML.fit_encodings(c.filter("direction = 'IN'"), "cnt",
                           {"enc_site": ["site_id"], "enc_site_hour": ["site_id", "hour"]})
    d = ML.apply_encodings(c.filter("direction = 'OUT'"), enc)
    return d.select("event_id", r6("enc_site").alias("enc_site"), r6("enc_site_hour").alias("enc_site_hour"))


@query("j11_apply_baseline", """
WITH tr AS (SELECT nation, month(datetime_hour) AS month, actual FROM v_pred WHERE datetime_hour < TIMESTAMP '1999-01-01'),
b AS (SELECT nation, month, CAST(SUM(CAST(actual AS DECIMAL(38, 5))) AS DOUBLE) / COUNT(actual) AS baseline FROM tr GROUP BY 1, 2),
g AS (SELECT CAST(SUM(CAST(actual AS DECIMAL(38, 5))) AS DOUBLE) / COUNT(actual) AS m FROM tr)
SELECT p.o_orderkey, COALESCE(b.baseline, g.m) AS baseline FROM v_pred p
LEFT JOIN b ON p.nation = b.nation AND month(p.datetime_hour) = b.month CROSS JOIN g
WHERE p.datetime_hour >= TIMESTAMP '1999-01-01'
""")
def j11(fx):
    """Baseline table (nation x month) joined to later rows, mean fallback."""
    d = fx.pred.withColumn("month", F.month("datetime_hour"))
    cut = F.lit("1999-01-01").cast("timestamp_ntz")
    # actual has 5 exact decimals: exact sums keep the means reproducible
    out = ML.historical_baseline(d.filter(F.col("datetime_hour") < cut), d.filter(F.col("datetime_hour") >= cut),
                                 ["nation", "month"], "actual", exact_scale=5)
    return out.select("o_orderkey", "baseline")


@query("v13_mae_over_mean", """
SELECT nation, ROUND(AVG(abs(actual - predicted)) / AVG(actual), 6) AS mae_over_mean FROM v_pred GROUP BY nation
""")
def v13(fx):
    """MAE divided by the mean observed value, per nation."""
    d = Q.evaluate(fx.pred, "actual", "predicted", ["nation"])
    return d.select("nation", r6("mae_over_mean").alias("mae_over_mean"))
