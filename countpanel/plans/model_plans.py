"""Wave 7: models whose inner sums SQL can check - leaf-wise splits, exact
silhouettes, routing with nested fallbacks, ordered labels, walk-forward folds."""

from __future__ import annotations

from pyspark.sql import functions as F

from countpanel.operators import boosting as B
from countpanel.operators import clusters as C
from countpanel.operators import linear as L
from countpanel.operators import models as M
from countpanel.operators import models_light as ML
from countpanel.plans.analytics import t_test_sql
from countpanel.plans.ml_plans import RAIN_EDGES, RAIN_LABELS, TEMP_EDGES, TEMP_LABELS, XS, _panel, profile_parts, with_weather
from countpanel.plans.registry import query

SPLIT_FEATURES = ["hour", "dow", "dom", "is_in"]
UNITS = 1048576  # residuals are whole multiples of 1 / UNITS


def _best_sql(name: str, rows: str, per: str) -> str:
    """CTEs for the best split of every leaf of ``rows`` (leaf, units and the
    features); ``per`` names the result."""
    return f"""
{name}_long AS (SELECT leaf, units, unnest([0, 1, 2, 3]) AS f, unnest([hour, dow, dom, is_in]) AS v FROM {rows}),
{name}_sums AS (SELECT leaf, f, v, SUM(units) AS s, COUNT(*) AS n FROM {name}_long GROUP BY leaf, f, v),
{name}_cum AS (
  SELECT leaf, f, v, CAST(SUM(s) OVER w AS DOUBLE) AS sl, CAST(SUM(n) OVER w AS DOUBLE) AS nl,
         CAST(SUM(s) OVER (PARTITION BY leaf, f) AS DOUBLE) AS sa, CAST(SUM(n) OVER (PARTITION BY leaf, f) AS DOUBLE) AS na
  FROM {name}_sums WINDOW w AS (PARTITION BY leaf, f ORDER BY v)),
{name}_gain AS (
  SELECT *, (sl * sl / nl + (sa - sl) * (sa - sl) / (na - nl) - sa * sa / na) / {UNITS}e0 / {UNITS}e0 AS gain
  FROM {name}_cum WHERE nl >= 20 AND na - nl >= 20),
{per} AS (SELECT * FROM {name}_gain QUALIFY row_number() OVER (PARTITION BY leaf ORDER BY gain DESC, f, v) = 1)"""


_SPLITS_SQL = f"""
WITH mean AS (SELECT CAST(SUM(CAST(round(cnt * {UNITS}) AS HUGEINT)) AS DOUBLE) / {UNITS} / COUNT(*) AS m FROM v_counts WHERE cnt IS NOT NULL),
x AS (
  SELECT 'root' AS leaf, CAST(round_even((cnt - m) * {UNITS}, 0) AS BIGINT) AS units, hour(start_time) AS hour, isodow(start_time) - 1 AS dow,
         day(start_time) AS dom, CASE WHEN direction = 'IN' THEN 1 ELSE 0 END AS is_in
  FROM v_counts CROSS JOIN mean WHERE cnt IS NOT NULL),
{_best_sql("a", "x", "first")},
y AS (SELECT CASE WHEN (CASE f WHEN 0 THEN x.hour WHEN 1 THEN x.dow WHEN 2 THEN x.dom ELSE x.is_in END) <= v THEN 'left' ELSE 'right' END AS leaf,
             x.units, x.hour, x.dow, x.dom, x.is_in FROM x CROSS JOIN first),
{_best_sql("b", "y", "second")},
picked AS (SELECT * FROM first UNION ALL SELECT * FROM (SELECT * FROM second ORDER BY gain DESC, leaf LIMIT 1) AS t)
SELECT leaf, ['hour', 'dow', 'dom', 'is_in'][f + 1] AS feature, CAST(v AS DOUBLE) AS edge, CAST(nl AS BIGINT) AS n_left, CAST(na - nl AS BIGINT) AS n_right,
       sl / {UNITS} AS total_left, (sa - sl) / {UNITS} AS total_right, ROUND(gain, 6) AS gain
FROM picked
"""


@query("f9_first_splits", _SPLITS_SQL)
def f9_splits(fx):
    """First two splits of a leaf-wise tree on the raw counts, with the rows
    and residual sums on either side: the sums every further split rests on."""
    t = F.col("start_time")
    d = fx.counts.select("event_id", "cnt", F.hour(t).alias("hour"), ((F.dayofweek(t) + 5) % 7).alias("dow"), F.dayofmonth(t).alias("dom"),
                         (F.col("direction") == "IN").cast("int").alias("is_in"))
    model = B.fit_leafwise(d, "cnt", SPLIT_FEATURES, ["event_id"], trees=1, leaves=3, min_rows=20, bins=64, patience=None)
    n = model.nodes(fx.spark)
    name = F.when(F.col("node") == 0, "root").when(F.col("node") == 1, "left").otherwise("right")
    inner = n.where("left is not null").select(name.alias("leaf"), "feature", "edge", "gain", "left")
    side = lambda which: n.select((F.col("node") - int(which == "right")).cast("int").alias("left"),
                                  F.col("n").alias(f"n_{which}"), F.col("total").alias(f"total_{which}"))
    return inner.join(side("left"), "left").join(side("right"), "left").select(
        "leaf", "feature", "edge", "n_left", "n_right", "total_left", "total_right", F.round("gain", 6).alias("gain"))


SHAPE = ["lat", "lon", "park_count", "school_count"]


@query("c3_silhouette_labels", """
WITH v AS (SELECT site_id, [lat, lon, CAST(park_count AS DOUBLE), CAST(school_count AS DOUBLE)] AS x, [site_id % 3, site_id % 5 // 2] AS l FROM v_sites),
d AS (SELECT a.site_id, a.l AS own, b.l AS other, sqrt(list_sum(list_transform(range(1, 5), lambda i: (a.x[i] - b.x[i]) * (a.x[i] - b.x[i])))) AS far
      FROM v a JOIN v b ON a.site_id <> b.site_id),
e AS (SELECT site_id, unnest([1, 2]) AS k, unnest(own) AS own, unnest(other) AS other, far FROM d),
m AS (SELECT site_id, k, own, other, AVG(far) AS far FROM e GROUP BY site_id, k, own, other),
s AS (SELECT site_id, k, MAX(CASE WHEN own = other THEN far END) AS a, MIN(CASE WHEN own <> other THEN far END) AS b FROM m GROUP BY site_id, k)
SELECT site_id, ROUND(MAX(CASE WHEN k = 1 THEN COALESCE((b - a) / greatest(a, b), 0) END), 6) AS three,
       ROUND(MAX(CASE WHEN k = 2 THEN COALESCE((b - a) / greatest(a, b), 0) END), 6) AS uneven
FROM s GROUP BY site_id
""")
def c3_labels(fx):
    """Exact silhouette of every site under two given labellings, from tiles."""
    d = fx.sites.select("site_id", F.array(*[F.col(c).cast("double") for c in SHAPE]).alias("x"),
                        (F.col("site_id") % 3).alias("three"), F.floor((F.col("site_id") % 5) / 2).alias("uneven"))
    out = C.silhouette_rows(d, "site_id", "x", ["three", "uneven"], tile=256)
    return out.select("site_id", F.round("three", 6).alias("three"), F.round("uneven", 6).alias("uneven"))


@query("c4_order_given_labels", """
WITH d AS (SELECT site_id, (site_id * 7) % 4 AS label, lat + lon AS score FROM v_sites),
m AS (SELECT label, dense_rank() OVER (ORDER BY AVG(score), label) - 1 AS place FROM d GROUP BY label)
SELECT site_id, d.label AS label, CAST(place AS INT) AS label_ordered FROM d JOIN m ON d.label = m.label
""")
def c4_given(fx):
    """Given labels re-numbered by increasing mean of a column."""
    d = fx.sites.select("site_id", ((F.col("site_id") * 7) % 4).alias("label"), (F.col("lat") + F.col("lon")).alias("score"))
    return M.order_labels(d, "label", "score").select("site_id", "label", F.col("label_ordered").cast("int").alias("label_ordered"))


ROUTE_CUT = "2024-01-23"
ROUTE_ROWS = 20


@query("f14_routes", f"""
WITH c AS (SELECT v_counts.*, municipality FROM v_counts LEFT JOIN v_sites ON v_counts.site_id = v_sites.site_id),
train AS (SELECT * FROM c WHERE start_time < TIMESTAMP '{ROUTE_CUT}' AND site_id % 5 <> 0 AND COALESCE(municipality, '') <> 'FRANCE'),
test AS (SELECT * FROM c WHERE start_time >= TIMESTAMP '{ROUTE_CUT}'),
k AS (SELECT site_id, AVG(cnt) AS m FROM train GROUP BY site_id HAVING COUNT(*) >= {ROUTE_ROWS}),
g AS (SELECT municipality, AVG(cnt) AS m FROM train GROUP BY municipality),
a AS (SELECT AVG(cnt) AS m FROM train)
SELECT event_id, CASE WHEN k.m IS NOT NULL THEN 'known' ELSE 'unknown' END AS route, ROUND(COALESCE(k.m, g.m, a.m), 6) AS fallback,
       CASE WHEN k.m IS NOT NULL THEN 'key' WHEN g.m IS NOT NULL THEN 'group' ELSE 'all' END AS level
FROM test LEFT JOIN k ON test.site_id = k.site_id LEFT JOIN g ON test.municipality IS NOT DISTINCT FROM g.municipality CROSS JOIN a
""")
def f14_routes(fx):
    """Route of every reading and its nested fallback: site, municipality, all."""
    c = fx.counts.join(fx.sites.select("site_id", "municipality"), "site_id", "left")
    cut = F.lit(ROUTE_CUT).cast("timestamp_ntz")
    train = c.filter((F.col("start_time") < cut) & (F.col("site_id") % 5 != 0) & (F.coalesce("municipality", F.lit("")) != "FRANCE"))
    d = ML.routes(train, c.filter(F.col("start_time") >= cut), "site_id", "cnt", "municipality", ROUTE_ROWS, exact_scale=2)
    return d.select("event_id", "route", F.round("fallback", 6).alias("fallback"), "level")


@query("f14_route_models")
def f14_models(fx):
    """Known sites by a leaf-wise booster on lags and calendar, unknown ones by
    a forest on calendar and weather, the rest by the nested fallback: error by
    route, beside the site mean's."""
    p = _panel(fx).join(fx.sites.select("site_id", "municipality"), "site_id", "left")
    cut = F.lit(ROUTE_CUT).cast("timestamp_ntz")
    train = p.filter((F.col("datetime_hour") < cut) & (F.col("site_id") % 5 != 0))
    test = p.filter(F.col("datetime_hour") >= cut)
    calendar = [x for x in XS if x not in ("lag_1", "rolling_24_mean")]
    there = lambda cols: F.concat(*[F.col(c).cast("string") for c in cols]).isNotNull()

    def known(d):
        return B.fit_leafwise(d.dropna(subset=XS), "count", XS, ["site_id", "datetime_hour"], target="log1p", trees=8, leaves=16, rate=0.35,
                              patience=None, batch=8).predict

    def unknown(d):
        return lambda rows: M.forest(d.dropna(subset=calendar), rows, "count", calendar, trees=10, depth=6, log_target=True)[1]

    d = ML.route_models(train, test, "site_id", "count", "municipality", known, unknown, there(XS), there(calendar), ROUTE_ROWS)
    both = d.unionByName(d.withColumn("route", F.lit("all")))
    err = lambda c: F.abs(F.col("count") - F.col(c))
    return both.groupBy("route").agg(F.count("*").alias("n"), F.avg(err("prediction")).alias("mae"), F.avg(err("fallback")).alias("mae_fallback"),
                                     F.count_if(F.col("level") != "model").alias("n_fallback"))


FOLDS = [("2024-01-15", "2024-01-15", "2024-01-20"), ("2024-01-20", "2024-01-20", "2024-01-25"), ("2024-01-25", "2024-01-25", "2024-02-01")]


@query("f11_fold_sizes", "\nUNION ALL\n".join(f"""
SELECT {i} AS fold, COUNT(*) FILTER (WHERE start_time < TIMESTAMP '{a}') AS n_train,
       COUNT(*) FILTER (WHERE start_time >= TIMESTAMP '{b}' AND start_time < TIMESTAMP '{c}') AS n_test,
       ROUND(AVG(cnt) FILTER (WHERE start_time < TIMESTAMP '{a}'), 6) AS train_mean FROM v_counts""" for i, (a, b, c) in enumerate(FOLDS)))
def f11_sizes(fx):
    """Rows of the walk-forward folds and the training mean each fold's model
    starts from; the test rows of the folds do not overlap."""
    def fit(train, test):
        mean = train.agg(F.count("*").alias("n_train"), F.round(F.avg("cnt"), 6).alias("train_mean"))
        return test.agg(F.count("*").alias("n_test")).crossJoin(F.broadcast(mean))

    parts = [fit(a, b).withColumn("fold", F.lit(i)) for i, (a, b) in enumerate(M.folds(fx.counts, "start_time", FOLDS))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select("fold", "n_train", "n_test", "train_mean")


_TWO = """
s AS (SELECT CAST(COUNT(*) AS DOUBLE) AS n, AVG(temperature_2m) AS my, AVG(wind_speed_10m) AS m1, AVG(precipitation) AS m2,
             COUNT(*) * covar_pop(wind_speed_10m, wind_speed_10m) AS s11, COUNT(*) * covar_pop(precipitation, precipitation) AS s22,
             COUNT(*) * covar_pop(wind_speed_10m, precipitation) AS s12, COUNT(*) * covar_pop(wind_speed_10m, temperature_2m) AS s1y,
             COUNT(*) * covar_pop(precipitation, temperature_2m) AS s2y, COUNT(*) * var_pop(temperature_2m) AS syy FROM v_weather)"""


@query("f1_ols_two_predictors", f"""
WITH RECURSIVE {_TWO},
b AS (SELECT *, s11 * s22 - s12 * s12 AS det, (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1, (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2 FROM s),
e AS (SELECT *, syy - b1 * s1y - b2 * s2y AS sse, (syy - b1 * s1y - b2 * s2y) / (n - 3) AS v FROM b),
c AS (SELECT 'wind_speed_10m' AS term, b1 AS coef, sqrt(v * s22 / det) AS se, n - 3 AS df, 1 - sse / syy AS r2 FROM e
      UNION ALL SELECT 'precipitation', b2, sqrt(v * s11 / det), n - 3, 1 - sse / syy FROM e
      UNION ALL SELECT 'intercept', my - b1 * m1 - b2 * m2, sqrt(v * (1 / n + (m1 * m1 * s22 + m2 * m2 * s11 - 2 * m1 * m2 * s12) / det)), n - 3, 1 - sse / syy FROM e),
stats AS (SELECT term, df, df / (df + (coef / se) * (coef / se)) AS x FROM c),{t_test_sql("stats")}
SELECT c.term, ROUND(coef, 6) AS coef, ROUND(se, 6) AS std_err, ROUND(coef / se, 5) AS t, ROUND(p_value, 6) AS p_value, ROUND(r2, 6) AS r2
FROM c JOIN p ON c.term = p.term
""")
def f1_two(fx):
    """Least squares on two predictors with t and p, against the closed form."""
    d = L.ols(fx.weather, "temperature_2m", ["wind_speed_10m", "precipitation"])
    return d.select("term", *[F.round(c, 5 if c == "t" else 6).alias(c) for c in ("coef", "std_err", "t", "p_value", "r2")])


@query("f2_ridge_path", f"""
WITH {_TWO},
z AS (SELECT n, my, s12 / sqrt(s11 * s22) AS r, s1y / sqrt(s11 / n) AS z1, s2y / sqrt(s22 / n) AS z2 FROM s),
a AS (SELECT z.*, unnest([0e0, 1e0, 100e0, 10000e0]) AS alpha FROM z),
b AS (SELECT *, (n + alpha) * (n + alpha) - n * r * n * r AS det FROM a)
SELECT alpha, 'wind_speed_10m' AS term, ROUND(((n + alpha) * z1 - n * r * z2) / det, 6) AS coef FROM b
UNION ALL SELECT alpha, 'precipitation', ROUND(((n + alpha) * z2 - n * r * z1) / det, 6) FROM b
UNION ALL SELECT alpha, 'intercept', ROUND(my, 6) FROM b
""")
def f2_path(fx):
    """Ridge coefficients of standardised predictors for four penalties, from
    one scan."""
    d = L.ridge_path(fx.weather, "temperature_2m", ["wind_speed_10m", "precipitation"], [0.0, 1.0, 100.0, 10000.0])
    return d.withColumn("coef", F.round("coef", 6))


@query("f11_linear_folds", "\nUNION ALL\n".join(f"""
SELECT {i} AS fold, MAX(n) AS n_train, COUNT(*) AS n_test, ROUND(sqrt(AVG((cnt - a - b * hour(start_time)) ** 2)), 6) AS rmse,
       ROUND(1 - SUM((cnt - a - b * hour(start_time)) ** 2) / (COUNT(*) * var_pop(cnt)), 6) AS r2
FROM v_counts CROSS JOIN (SELECT COUNT(*) AS n, regr_intercept(cnt, hour(start_time)) AS a, regr_slope(cnt, hour(start_time)) AS b
                          FROM v_counts WHERE start_time < TIMESTAMP '{a}') AS m{i}
WHERE start_time >= TIMESTAMP '{b}' AND start_time < TIMESTAMP '{c}'""" for i, (a, b, c) in enumerate(FOLDS)))
def f11_linear(fx):
    """Walk-forward folds of a linear model, all from one scan."""
    d = fx.counts.withColumn("hour", F.hour("start_time"))
    out = L.walk_forward(d, "cnt", ["hour"], F.date_format("start_time", "yyyy-MM-dd"), FOLDS)
    return out.select("fold", "n_train", "n_test", F.round("rmse", 6).alias("rmse"), F.round("r2", 6).alias("r2"))


MEANS = ["lat", "lon", "park_count", "school_count", "dist_nearest_station"]


@query("c9_means_given_labels", "\nUNION ALL\n".join(f"""
SELECT site_id % 3 AS label, '{c}' AS feature, COUNT({c}) AS n, ROUND(AVG({c}), 6) AS mean, ROUND((AVG({c}) - MAX(m)) / MAX(s), 6) AS scaled_mean
FROM v_sites CROSS JOIN (SELECT AVG({c}) AS m, stddev_pop({c}) AS s FROM v_sites) AS t_{c} GROUP BY site_id % 3""" for c in MEANS))
def c9_given(fx):
    """Raw and scaled feature means of given labels."""
    d = C.cluster_means(fx.sites.withColumn("label", F.col("site_id") % 3), "label", MEANS)
    return d.select("label", "feature", "n", F.round("mean", 6).alias("mean"), F.round("scaled_mean", 6).alias("scaled_mean"))


def _cut_sql(column: str, edges, labels) -> str:
    return "CASE " + " ".join(f"WHEN {column} > {a} AND {column} <= {b} THEN '{name}'" for a, b, name in zip(edges, edges[1:], labels)) + " END"


@query("c10_profiles_given_labels", f"""
WITH d AS (SELECT c.site_id % 2 AS label, cnt, hour(start_time) AS h, CASE WHEN isodow(start_time) >= 6 THEN 'weekend' ELSE 'weekday' END AS dt,
                  month(start_time) AS m, {_cut_sql("w.temperature_2m", TEMP_EDGES, TEMP_LABELS)} AS t, {_cut_sql("w.precipitation", RAIN_EDGES, RAIN_LABELS)} AS r
           FROM v_counts c LEFT JOIN v_weather w ON w.site_id = c.site_id AND w.time = date_trunc('hour', c.start_time)),
u AS (SELECT label, cnt, unnest(['hour', 'daytype', 'month', 'temperature', 'rain']) AS dimension,
             unnest([CAST(h AS VARCHAR), dt, CAST(m AS VARCHAR), t, r]) AS level FROM d)
SELECT label, dimension, level, ROUND(AVG(cnt), 6) AS mean_value, COUNT(cnt) AS n FROM u WHERE level IS NOT NULL GROUP BY label, dimension, level
""")
def c10_given(fx):
    """Profiles of given labels by hour, day type, month, temperature and rain."""
    d = C.cluster_profiles(with_weather(fx).withColumn("label", F.col("site_id") % 2), "label", "cnt", profile_parts("start_time"))
    return d.withColumn("mean_value", F.round("mean_value", 6))
