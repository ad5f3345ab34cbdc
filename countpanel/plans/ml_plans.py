"""Wave 6: pyspark.ml operators (rows-only checks: no SQL equivalent)."""

from __future__ import annotations

import uuid

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from countpanel.functions import dates as D
from countpanel.functions.encode import one_hot
from countpanel.operators import aggs as A
from countpanel.operators import anomaly as NA
from countpanel.operators import artefact
from countpanel.operators import boosting as B
from countpanel.operators import clusters as C
from countpanel.operators import features as FE
from countpanel.operators import joins as J
from countpanel.operators import linear as L
from countpanel.operators import models as M
from countpanel.operators import quality as Q
from countpanel.operators import windows as W
from countpanel.plans.core import HOLIDAYS
from countpanel.plans.registry import query
from countpanel.session import cut_lineage, ensure_checkpoint_dir, small
from countpanel.sources import io as S

HOURS = [str(h) for h in range(24)]
# fixed values: the site features and which of them are skewed
SITE_FEATS = ["mean_count", "median_count", "max_count", "std_count", "weekday_mean", "weekend_mean", "rush_mean",
              "weekend_weekday_ratio", "rush_ratio", "cv", "park_count", "school_count", "station_count",
              "dist_nearest_station", "dist_nearest_school"]
LOG_COLS = ["mean_count", "median_count", "max_count", "std_count", "weekday_mean", "weekend_mean", "rush_mean"]
XS = ["hour", "day_of_week", "month", "temperature_2m", "precipitation", "wind_speed_10m", "lag_1", "rolling_24_mean"]


def _site_profiles(fx, lo=None, hi=None):
    """15 site features: count profile and ratios of the active sites, POI
    counts, distance to the nearest station and (grid join) school."""
    c = fx.counts
    if lo:
        c = c.filter(F.col("start_time") >= F.lit(lo).cast("timestamp_ntz"))
    if hi:
        c = c.filter(F.col("start_time") < F.lit(hi).cast("timestamp_ntz"))
    prof = A.active_only(A.profile_ratios(A.site_profile(c, "site_id", "cnt", "start_time")))
    attrs = fx.sites.select("site_id", "park_count", "school_count", "station_count", "dist_nearest_station")
    school = J.nearest(fx.sites, fx.poi, "school", 3000.0, metric="flat")
    return prof.join(attrs, "site_id", "left").join(school, "site_id", "left")


def _panel(fx):
    """Hourly counts per site with calendar, weather, lag and rolling features."""
    h = fx.counts.groupBy("site_id", D.floor_hour("start_time").alias("datetime_hour")).agg(F.sum("cnt").alias("count"))
    d = FE.panel_features(h, "site_id", "datetime_hour", "count", HOLIDAYS, exact_scale=2)
    w = fx.weather.withColumnRenamed("time", "datetime_hour")
    return d.join(w, ["site_id", "datetime_hour"], "left").withColumn("_y", F.col("count"))


X8_TYPES, X8_DIRECTIONS = ("click", "purchase", "signup", "view"), ("IN", "OUT")


@query("x8_one_hot", "SELECT event_id, " + ", ".join(
    f"CASE WHEN {c} = '{v}' THEN 1e0 ELSE 0e0 END AS {c}_{v.lower()}"
    for c, vs in (("type", X8_TYPES), ("direction", X8_DIRECTIONS)) for v in vs) + " FROM v_counts")
def x8(fx):
    """One-hot vectors of type and direction, one column per slot; fitted
    without the type 'error', which therefore becomes all zero."""
    model = one_hot(fx.counts.filter(F.col("type") != "error"), ["type", "direction"])
    d = model.transform(fx.counts).withColumns({c: vector_to_array(f"{c}_vec") for c in ("type", "direction")})
    return d.select("event_id", *[F.col(c)[k].alias(f"{c}_{v.lower()}") for c, vs in (
        ("type", X8_TYPES), ("direction", X8_DIRECTIONS)) for k, v in enumerate(vs)])


@query("c1_profile_clusters")
def c1(fx):
    """k=4 clusters on row-standardised site x hour mean profiles."""
    d = fx.counts.withColumn("hour", F.hour("start_time"))
    prof = A.pivot_mean(d, "site_id", "hour", list(range(24)), "cnt", fill=0.0)
    return M.profile_clusters(prof, "site_id", HOURS, k=4)


@query("c2_site_clusters")
def c2(fx):
    """k=2 clusters on site features: log1p, median impute, z-score."""
    out, _ = M.site_clusters(_site_profiles(fx), "site_id", SITE_FEATS, LOG_COLS, k=2)
    return out.select("site_id", "cluster")


@query("c3_scan_k")
def c3(fx):
    """Inertia and exact silhouette for k = 2..7, the best of 20 starts each."""
    d, _ = M.site_feature_matrix(_site_profiles(fx), SITE_FEATS, LOG_COLS)
    return M.scan_k(d, "site_id", range(2, 8), n_init=20)


@query("c4_order_labels")
def c4(fx):
    """Cluster labels re-numbered by increasing mean count."""
    out, _ = M.site_clusters(_site_profiles(fx), "site_id", SITE_FEATS, LOG_COLS, k=2)
    raw = _site_profiles(fx).select("site_id", F.col("mean_count").alias("raw_mean"))
    return M.order_labels(out.select("site_id", "cluster").join(raw, "site_id"), "cluster", "raw_mean").select(
        "site_id", "cluster", "label_ordered")


def _stored(fx, model):
    """The pipeline after a round trip through the shared folder."""
    path = f"{ensure_checkpoint_dir(fx.spark).rstrip('/')}/models/sites-{uuid.uuid4().hex[:12]}"
    artefact.save(model, path)
    return artefact.load(path)


@query("c5_assign_clusters")
def c5(fx):
    """Fit on the first half of the month, store imputer, scaler and model as
    one artefact, and score the second half's sites from what was stored."""
    _, model = M.site_clusters(_site_profiles(fx, hi="2024-01-16"), "site_id", SITE_FEATS, LOG_COLS, k=2)
    return _stored(fx, model).transform(_site_profiles(fx, lo="2024-01-16")).select("site_id", "cluster")


@query("c8_pca_space")
def c8(fx):
    """PCA to 2 components fitted on one period, the other projected into it."""
    fit, scaler = M.site_feature_matrix(_site_profiles(fx, hi="2024-01-16"), SITE_FEATS, LOG_COLS)
    other, _ = M.site_feature_matrix(_site_profiles(fx, lo="2024-01-16"), SITE_FEATS, LOG_COLS, scaler)
    proj, var = M.pca_space(fit, other, 2)
    return proj.select("site_id", "pc1", "pc2").withColumns({"var_pc1": F.lit(var[0]), "var_pc2": F.lit(var[1])})


@query("c9_representatives")
def c9(fx):
    """5 largest sites per cluster and the cluster mean profiles."""
    out, _ = M.site_clusters(_site_profiles(fx), "site_id", SITE_FEATS, LOG_COLS, k=2)
    raw = _site_profiles(fx).join(out.select("site_id", "cluster"), "site_id")
    top = W.head_per_group(raw, ["cluster"], [F.col("mean_count").desc(), F.col("site_id")], 5)
    means = A.group_means(raw, ["cluster"], ["mean_count", "weekend_weekday_ratio", "rush_ratio"], 3)
    return top.select("cluster", "site_id", F.round("mean_count", 3).alias("site_mean")).join(means, "cluster")


@query("c10_cluster_profiles")
def c10(fx):
    """Cluster x hour x day-type mean counts."""
    out, _ = M.site_clusters(_site_profiles(fx), "site_id", SITE_FEATS, LOG_COLS, k=2)
    d = fx.counts.join(small(out.select("site_id", "cluster")), "site_id")
    return A.profile_by(d, "cnt", {"cluster": F.col("cluster"), "hour": F.hour("start_time"),
                                   "daytype": F.when(D.is_weekend("start_time"), "weekend").otherwise("weekday")})


# fixed values: right-closed bins of the weather profiles
TEMP_EDGES, TEMP_LABELS = (-10, 0, 5, 10, 15, 20, 25, 35), ("<0", "0-5", "5-10", "10-15", "15-20", "20-25", "25+")
RAIN_EDGES, RAIN_LABELS = (-0.01, 0, 1, 3, 10, 100), ("No rain", "Light", "Moderate", "Heavy", "Very heavy")


def profile_parts(ts: str) -> dict:
    """Hour, day type, month, temperature bin and rain bin of a reading."""
    label = lambda c, edges, names: F.element_at(F.array(*map(F.lit, names)), A.bin_expr(c, edges, False) + 1)
    return {"hour": F.hour(ts), "daytype": F.when(D.is_weekend(ts), "weekend").otherwise("weekday"), "month": F.month(ts),
            "temperature": label("temperature_2m", TEMP_EDGES, TEMP_LABELS), "rain": label("precipitation", RAIN_EDGES, RAIN_LABELS)}


def with_weather(fx):
    """Readings with the weather of their site and hour."""
    w = fx.weather.withColumnRenamed("time", "_hour")
    return fx.counts.withColumn("_hour", D.floor_hour("start_time")).join(w, ["site_id", "_hour"], "left").drop("_hour")


@query("c9_cluster_means")
def c9_means(fx):
    """All 15 features' means by cluster, raw and on the clustering's scale
    (log1p, medians for missing values, z-scores)."""
    profiles = cut_lineage(_site_profiles(fx))
    rows, model = M.site_clusters(profiles, "site_id", SITE_FEATS, LOG_COLS, k=2)
    scaled = rows.withColumn("_z", vector_to_array("features")).select("cluster", *[F.col("_z")[j].alias(c) for j, c in enumerate(SITE_FEATS)])
    raw = C.cluster_means(rows, "cluster", SITE_FEATS).drop("scaled_mean")
    return raw.join(C.cluster_means(scaled, "cluster", SITE_FEATS).select("cluster", "feature", F.col("mean").alias("scaled_mean")),
                    ["cluster", "feature"])


@query("c10_cluster_profiles_by")
def c10_by(fx):
    """Mean counts of the clusters by hour, day type, month, temperature bin
    and rain bin."""
    out, _ = M.site_clusters(_site_profiles(fx), "site_id", SITE_FEATS, LOG_COLS, k=2)
    d = with_weather(fx).join(small(out.select("site_id", "cluster")), "site_id")
    return C.cluster_profiles(d, "cluster", "cnt", profile_parts("start_time"))


@query("f1_ols")
def f1(fx):
    """OLS of hourly counts on weather and calendar: coefficients, t, p, R^2."""
    return L.ols(_panel(fx), "count", ["hour", "temperature_2m", "precipitation", "wind_speed_10m", "is_weekend"])


@query("f1_ols_one_predictor", """
WITH r AS (SELECT regr_slope(temperature_2m, wind_speed_10m) AS b, regr_intercept(temperature_2m, wind_speed_10m) AS a,
                  regr_r2(temperature_2m, wind_speed_10m) AS r2 FROM v_weather)
SELECT 'wind_speed_10m' AS term, ROUND(b, 6) AS coef, ROUND(r2, 6) AS r2 FROM r
UNION ALL SELECT 'intercept', ROUND(a, 6), ROUND(r2, 6) FROM r
""")
def f1_one(fx):
    """Least squares on one predictor, where SQL has the closed form."""
    return L.ols(fx.weather, "temperature_2m", ["wind_speed_10m"]).select(
        "term", F.round("coef", 6).alias("coef"), F.round("r2", 6).alias("r2"))


@query("f2_ridge")
def f2(fx):
    """Ridge pipeline (impute, scale, one-hot), coefficients sorted."""
    d = _panel(fx).withColumn("dow_s", F.col("day_of_week").cast("string"))
    return M.ridge(d, "count", ["hour", "temperature_2m", "precipitation", "wind_speed_10m"], ["dow_s"], alpha=1.0)


def _eval(pred):
    return Q.evaluate(pred, "_y", "prediction")


@query("f3_rf_pipeline")
def f3(fx):
    """Random forest, 80/20 hash split: MAE, RMSE, R^2."""
    d = M.hash_split(_panel(fx).dropna(subset=XS), ["site_id", "datetime_hour"])
    _, p = M.forest(d.filter("is_train"), d.filter("NOT is_train"), "count", XS, trees=50, depth=15, min_instances=1)
    return _eval(p)


@query("f7_rf_log")
def f7(fx):
    """Forest on log1p target (expm1, clipped at 0), temporal split."""
    d = _panel(fx).dropna(subset=XS)
    cut = F.lit("2024-01-23").cast("timestamp_ntz")
    _, p = M.forest(d.filter(F.col("datetime_hour") < cut), d.filter(F.col("datetime_hour") >= cut), "count", XS,
                    log_target=True)
    return _eval(p)


@query("f8_gbt_log")
def f8(fx):
    """Boosted trees with early stopping on the last 15 % of training time."""
    d = _panel(fx).dropna(subset=XS)
    cut = F.lit("2024-01-23").cast("timestamp_ntz")
    _, p = M.boosted(d.filter(F.col("datetime_hour") < cut), d.filter(F.col("datetime_hour") >= cut), "count", XS,
                     "datetime_hour", depth=6, step=0.1)
    return _eval(p)


@query("f9_gbt_second")
def f9(fx):
    """Second boosted model for the blend: leaf-wise trees of 64 leaves on
    log1p counts, stopped early by the last 15 % of the training time."""
    d = cut_lineage(_panel(fx).dropna(subset=XS))
    cut, late = (F.lit(day).cast("timestamp_ntz") for day in ("2024-01-23", "2024-01-20"))
    model = B.fit_leafwise(d.filter(F.col("datetime_hour") < cut), "count", XS, ["site_id", "datetime_hour"], valid=F.col("datetime_hour") >= late,
                           target="log1p", trees=12, leaves=64, rate=0.25, subsample=0.85, colsample=0.85, patience=3, batch=16)
    return _eval(model.predict(d.filter(F.col("datetime_hour") >= cut)))


@query("f11_walk_forward")
def f11(fx):
    """Expanding walk-forward folds, one forest per fold."""
    d = _panel(fx).dropna(subset=XS)
    folds = [("2024-01-15", "2024-01-15", "2024-01-20"), ("2024-01-20", "2024-01-20", "2024-01-25"),
             ("2024-01-25", "2024-01-25", "2024-02-01")]
    return M.walk_forward(d, "datetime_hour", folds,
                          lambda tr, te: M.forest(tr, te, "count", XS, trees=20, depth=8)[1])


@query("f15_importances")
def f15(fx):
    """Top feature importances of the forest."""
    d = _panel(fx).dropna(subset=XS)
    m, _ = M.forest(d, d, "count", XS, trees=20, depth=8)
    return M.importances(m, XS, fx.spark, k=5)


@query("f16_compare_inputs")
def f16(fx):
    """Same model trained with observed vs with forecast weather (common keys)."""
    p = _panel(fx).drop("temperature_2m", "precipitation", "wind_speed_10m")
    obs = p.join(fx.weather.withColumnRenamed("time", "datetime_hour"), ["site_id", "datetime_hour"])
    fc = p.join(fx.weather_fcst.withColumnRenamed("time", "datetime_hour"), ["site_id", "datetime_hour"])
    cut = F.lit("2024-01-23").cast("timestamp_ntz")
    out = []
    for name, d in (("observed", obs), ("forecast", fc)):
        d = d.dropna(subset=XS)
        _, pr = M.forest(d.filter(F.col("datetime_hour") < cut), d.filter(F.col("datetime_hour") >= cut), "count", XS,
                         trees=20, depth=8)
        out.append(_eval(pr).withColumn("inputs", F.lit(name)))
    return out[0].unionByName(out[1])


@query("f17_score_day")
def f17(fx):
    """Score one day per site and direction, export it as CSV under the report's
    column names with the coordinates, and read the export back.  The signed
    error is actual less predicted."""
    h = fx.counts.groupBy("site_id", "direction", D.floor_hour("start_time").alias("datetime_hour")).agg(F.sum("cnt").alias("count"))
    h = h.withColumn("series", F.concat_ws("-", "site_id", "direction"))
    d = FE.panel_features(h, "series", "datetime_hour", "count", HOLIDAYS, exact_scale=2)
    w = fx.weather.withColumnRenamed("time", "datetime_hour")
    d = cut_lineage(d.join(w, ["site_id", "datetime_hour"], "left").dropna(subset=XS))
    day = F.to_date("datetime_hour") == F.lit("2024-01-29").cast("date")
    _, p = M.forest(d.filter(~day), d.filter(day), "count", XS, trees=20, depth=8)
    report = p.join(fx.sites.select("site_id", "lat", "lon"), "site_id", "left").select(
        "site_id", "direction", F.dayofmonth("datetime_hour").alias("day"), "hour", F.col("lat").alias("latitude"), F.col("lon").alias("longitude"),
        F.col("count").alias("actual_count"), F.col("prediction").alias("predicted_count"),
        (F.col("count") - F.col("prediction")).alias("signed_error"))
    path = f"{ensure_checkpoint_dir(fx.spark).rstrip('/')}/exports/day-{uuid.uuid4().hex[:12]}"
    S.write_csv(report, path)
    return fx.spark.read.schema(report.schema).option("header", True).csv(path)


@query("f19_forecast_panel", """
WITH y AS (SELECT unique_id, ds, ROUND(y, 2) AS y FROM v_daily),
keep AS (SELECT unique_id FROM y WHERE ds < DATE '2000-01-01' GROUP BY 1 HAVING COUNT(y) >= 365),
z AS (SELECT unique_id, AVG(y) AS m, stddev_pop(y) AS s FROM y WHERE ds < DATE '2000-01-01' GROUP BY 1),
w AS (SELECT site_id AS unique_id, CAST(time - INTERVAL 8766 DAY AS DATE) AS ds, MAX(temperature_2m) AS t, SUM(precipitation) AS p
      FROM v_weather_fcst GROUP BY 1, 2),
d AS (SELECT y.unique_id, y.ds, (y.y - m) / s AS y, t, p, CASE WHEN y.ds < DATE '2000-01-01' THEN 'train' WHEN y.ds < DATE '2000-07-01' THEN 'validation' ELSE 'test' END AS split
      FROM y JOIN keep ON y.unique_id = keep.unique_id JOIN z ON y.unique_id = z.unique_id LEFT JOIN w ON y.unique_id = w.unique_id AND y.ds = w.ds),
med AS (SELECT median(t) AS mt, median(p) AS mp FROM d WHERE split = 'train'),
f AS (SELECT unique_id, ds, y, split, CASE WHEN split = 'test' THEN t ELSE COALESCE(t, mt) END AS t, CASE WHEN split = 'test' THEN p ELSE COALESCE(p, mp) END AS p
      FROM d CROSS JOIN med),
sc AS (SELECT AVG(t) AS t_mean, stddev_pop(t) AS t_std, AVG(p) AS p_mean, stddev_pop(p) AS p_std FROM f WHERE split = 'train')
SELECT unique_id, ds, ROUND(y, 6) AS y, split, ROUND(COALESCE(CASE WHEN t_std > 0 THEN (t - t_mean) / t_std END, 0), 6) AS temperature_2m_max,
       ROUND(COALESCE(CASE WHEN p_std > 0 THEN (p - p_mean) / p_std END, 0), 6) AS precipitation_sum FROM f CROSS JOIN sc
""")
def f19(fx):
    """Daily panel for a global forecaster: train-fitted z, weather fill and
    scale, minimum history, three-way split, 0-filled future covariates."""
    daily = fx.daily.withColumn("y", F.round("y", 2))
    w = A.weather_daily(fx.weather_fcst.withColumn("time", F.col("time") - F.expr("INTERVAL 8766 DAYS")),
                        "site_id", "time", {"temperature_2m": "max", "precipitation": "sum"})
    w = w.withColumnRenamed("site_id", "unique_id")
    out = M.forecast_panel(daily, w, "unique_id", "ds", "y", ["temperature_2m_max", "precipitation_sum"],
                           "2000-01-01", 365, "2000-07-01")
    return out.select("unique_id", "ds", "split", *[F.round(c, 6).alias(c) for c in ("y", "temperature_2m_max", "precipitation_sum")])


ISO_FEATURES = ["deviation", "change_7", "change_28", "dow", "month", "rain_spike", "sun_zero"]


def _daily_weather(fx):
    """Daily weather on the dates of the daily panel (8766 days earlier);
    sunshine stands in as 60 s per degree above zero."""
    w = fx.weather.withColumns({"time": F.col("time") - F.expr("INTERVAL 8766 DAYS"),
                                "sunshine": F.greatest(F.lit(0.0), F.col("temperature_2m")) * 60})
    d = A.weather_daily(w, "site_id", "time", {"precipitation": "sum", "sunshine": "sum"})
    return d.withColumnRenamed("site_id", "unique_id")


def _iso_panel(fx, n1):
    """The seven features of the isolation layer; days without weather count
    as neither spike nor dark."""
    d = W.iso_features(n1, "unique_id", "ds", "y", positioned=True).join(_daily_weather(fx), ["unique_id", "ds"], "left")
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    return d.withColumns({"dow": D.weekday0("ds"), "month": F.month("ds"),
                          "rain_spike": flag(F.col("precipitation_sum") > 10), "sun_zero": flag(F.col("sunshine_sum") == 0)})


@query("n3_isolation_flags")
def n3(fx):
    """Per-series isolation forest over 7 daily features (3 % flagged)."""
    n1 = NA.continuous_daily(fx.daily.withColumn("y", F.round("y", 2)), "unique_id", "ds", "y", keep_pos=True)
    return NA.isolation_flags(_iso_panel(fx, n1), "unique_id", "ds", ISO_FEATURES, trees=200, share=0.03, min_rows=60)


@query("s13_save_load_model")
def s13_model(fx):
    """Imputer, scaler and clustering model stored as one artefact in the
    shared folder, reloaded, and used to score the sites."""
    profiles = _site_profiles(fx)
    _, model = M.site_clusters(profiles, "site_id", SITE_FEATS, LOG_COLS, k=2)
    return _stored(fx, model).transform(profiles).select("site_id", "cluster")


def _both_layers(fx):
    snapped = fx.daily.withColumn("y", F.round("y", 2))
    # both layers read the gap-filled panel: cut its lineage once
    n1 = cut_lineage(NA.continuous_daily(snapped, "unique_id", "ds", "y", keep_pos=True))
    layer1 = NA.rolling_outliers(n1, "unique_id", "ds", "y", 4.0, positioned=True)
    layer2 = NA.isolation_flags(_iso_panel(fx, n1), "unique_id", "ds", ISO_FEATURES, trees=200, share=0.03, min_rows=60)
    observed = snapped.select("unique_id", "ds", F.col("y").alias("y_observed"))
    return (layer1.select("unique_id", "ds", "rolling_outlier")
            .join(layer2.select("unique_id", "ds", "sensor_fault"), ["unique_id", "ds"], "left")
            .join(observed, ["unique_id", "ds"], "left").fillna(0, ["sensor_fault"]))


@query("n4_combine_anomaly_layers")
def n4_layers(fx):
    """The two anomaly layers of the daily panel - rolling-median outliers
    (N2) and isolation-forest faults (N3) - combined: counts per layer,
    flagged by both, by either."""
    return NA.combine_flags(_both_layers(fx))


@query("n4_anomaly_rows")
def n4_rows(fx):
    """Every site-day that either layer flags, with the value as recorded."""
    return _both_layers(fx).filter((F.col("rolling_outlier") == 1) | (F.col("sensor_fault") == 1)).select(
        "unique_id", "ds", "y_observed", "rolling_outlier", "sensor_fault")
