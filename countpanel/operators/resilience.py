"""Weather resilience and priorities (R1-R11) and impact accounting."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countpanel.operators import windows as W
from countpanel.session import bounded, small


# R1 / R2 / R3 -------------------------------------------------------------
def rain_drop(df: DataFrame, value: str, rain: Column, by: Sequence[str]) -> DataFrame:
    """Mean on rainy and on clear readings and the drop in % per group."""
    r = F.coalesce(rain, F.lit(False))
    g = df.groupBy(*by).agg(F.avg(F.when(r, F.col(value))).alias("rainy_mean"),
                            F.avg(F.when(~r, F.col(value))).alias("clear_mean"),
                            F.count_if(r).alias("n_rainy"), F.count_if(~r).alias("n_clear"))
    drop = F.try_divide(F.col("clear_mean") - F.col("rainy_mean"), F.col("clear_mean")) * 100
    return g.withColumn("drop_pct", drop)


def site_resilience(df: DataFrame, value: str, rain: Column, key: str = "site_id") -> DataFrame:
    """Per-entity drop % and resilience = 100 - drop; undefined ones removed."""
    d = rain_drop(df, value, rain, [key])
    return d.withColumn("resilience", 100 - F.col("drop_pct")).filter(F.col("resilience").isNotNull())


# R4 / R5 ------------------------------------------------------------------
def priority_score(res: DataFrame, key: str, traffic: str, vulnerability: str,
                   how: str = "inner", dims: DataFrame | None = None) -> DataFrame:
    """0.5 x min-max(traffic) + 0.5 x min-max(vulnerability), x 100."""
    d = res if dims is None else dims.join(res, key, how)
    d = W.minmax(d, traffic, "_t")
    d = W.minmax(d, vulnerability, "_v")
    return d.withColumn("priority", (0.5 * F.col("_t") + 0.5 * F.col("_v")) * 100).drop("_t", "_v")


def priority_score_z(res: DataFrame, traffic: str, vulnerability: str) -> DataFrame:
    """Mean of the two population z-scores."""
    d = W.zscore(res, [traffic, vulnerability], suffix="_z")
    return d.withColumn("priority_z", (F.col(f"{traffic}_z") + F.col(f"{vulnerability}_z")) / 2)


# R6 ---------------------------------------------------------------------
def super_resilient(df: DataFrame, res: DataFrame, value: str, rain: Column, hour: Column,
                    key: str = "site_id", floor: float = 100.0) -> DataFrame:
    """Sites with resilience above ``floor``, their resilience per hour, and
    the hour where it is highest."""
    top = res.filter(F.col("resilience") > floor).select(key)
    d = df.join(small(top), key, "left_semi").withColumn("hour", hour)
    by_hour = rain_drop(d, value, rain, [key, "hour"]).withColumn("hourly_resilience", 100 - F.col("drop_pct"))
    best = by_hour.filter(F.col("hourly_resilience").isNotNull()).groupBy(key).agg(
        F.min_by("hour", F.struct(-F.col("hourly_resilience"), F.col("hour"))).alias("best_hour"),
        F.max("hourly_resilience").alias("best_hourly_resilience"))
    return by_hour.join(best, key, "left")


# R7 ---------------------------------------------------------------------
def phase_impact(df: DataFrame, value: str, rain_col: str, keys: Sequence[str], order: str,
                 group: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Behaviour phase (raining / rain next step / clear) from a lead over
    each (site, direction) stream; mean per group and phase, % vs clear."""
    d = W.lead_flag(df, list(keys), order, rain_col, "_next_rain", tiebreak=list(tiebreak))
    phase = (F.when(F.col(rain_col) > 0, F.lit("raining"))
             .when(F.col("_next_rain"), F.lit("before_rain")).otherwise(F.lit("clear")))
    d = d.withColumn("phase", phase)
    p = d.groupBy(group).pivot("phase", ["raining", "before_rain", "clear"]).agg(F.avg(value))
    return p.withColumns({
        "raining_pct": F.try_divide(F.col("raining") - F.col("clear"), F.col("clear")) * 100,
        "before_rain_pct": F.try_divide(F.col("before_rain") - F.col("clear"), F.col("clear")) * 100,
    })


# R8 / R9 / R10 / R11 ------------------------------------------------------
def quadrants(df: DataFrame, x: str, y: str, x0: float | None = None, y0: float | None = None) -> DataFrame:
    """Usage x resilience quadrant; thresholds default to the medians."""
    from countpanel.operators.aggs import exact_quantiles

    t = exact_quantiles(df, x, [0.5], [], ["_x0"]).crossJoin(bounded(exact_quantiles(df, y, [0.5], [], ["_y0"])))
    if x0 is not None:
        t = t.withColumn("_x0", F.lit(float(x0)))
    if y0 is not None:
        t = t.withColumn("_y0", F.lit(float(y0)))
    d = df.crossJoin(bounded(t))
    hx, hy = F.col(x) >= F.col("_x0"), F.col(y) >= F.col("_y0")
    q = (F.when(hx & hy, "backbone").when(hx & ~hy, "at-risk").when(~hx & hy, "latent").otherwise("greenway"))
    return d.withColumn("quadrant", q).drop("_x0", "_y0")


def priority_zone(df: DataFrame, hour: str, pred: str, res: str, q_pred: float = 0.9, q_res: float = 0.8,
                  k: int = 5, tiebreak: Sequence[str] = (), eps: float = 1e-9) -> DataFrame:
    """Per hour: score = half min-max(predicted) + half min-max(resilience)
    over all rows of the hour (``eps`` in the denominators); ``in_zone``
    marks rows with predicted >= P90 and resilience >= P80 of the hour; the
    k highest scores of each hour are returned."""
    from countpanel.operators.aggs import exact_quantiles

    t = W.join_null_safe(exact_quantiles(df, pred, [q_pred], [hour], ["_tp"]),
                         exact_quantiles(df, res, [q_res], [hour], ["_tr"]), [hour])
    d = W.minmax(df, pred, "_np", eps=eps, by=[hour])
    d = W.minmax(d, res, "_nr", eps=eps, by=[hour])
    d = W.join_null_safe(d, small(t), [hour])
    d = d.withColumns({"zone_score": 0.5 * F.col("_np") + 0.5 * F.col("_nr"),
                       "in_zone": (F.col(pred) >= F.col("_tp")) & (F.col(res) >= F.col("_tr"))})
    d = W.head_per_group(d, [hour], [F.col("zone_score").desc(), *[F.col(c) for c in tiebreak]], k)
    return d.drop("_tp", "_tr", "_np", "_nr")


def counterfactual_weather(df: DataFrame, key: str, temps: Sequence[str], zero: Sequence[str]) -> DataFrame:
    """'Perfect weather': listed columns set to 0, temperatures to the site mean."""
    means = df.groupBy(key).agg(*[F.avg(c).alias(f"_m_{c}") for c in temps])
    d = W.join_null_safe(df, small(means), [key], "left")
    d = d.withColumns({**{c: F.lit(0.0) for c in zero}, **{c: F.col(f"_m_{c}") for c in temps}})
    return d.drop(*[f"_m_{c}" for c in temps])


def resilience_composite(df: DataFrame, key: str, y: str, temp: str, rain: str, wind: str) -> DataFrame:
    """1 - (0.5 R^2(temp) + 0.3 rain sensitivity + 0.2 wind sensitivity);
    sensitivities are min-max scaled absolute regression slopes."""
    g = df.groupBy(key).agg(F.regr_r2(y, temp).alias("r2"), F.abs(F.regr_slope(y, rain)).alias("rain_slope"),
                            F.abs(F.regr_slope(y, wind)).alias("wind_slope"))
    g = W.minmax(g, "rain_slope", "rain_sens")
    g = W.minmax(g, "wind_slope", "wind_sens")
    return g.withColumn("composite", 1 - (0.5 * F.col("r2") + 0.3 * F.col("rain_sens") + 0.2 * F.col("wind_sens")))


# I1 / I2 ----------------------------------------------------------------
# The impact constants of the forecasting study.
IMPACT_CONSTANTS = {
    "modal_shift_rate": "0.35", "avg_trip_km": "4.0", "co2_per_km_g": "120", "fuel_per_km_l": "0.07",
    "fuel_price_eur": "1.75", "kcal_per_km": "40", "health_cost_per_km_eur": "0.03",
    "co2_price_per_tonne_eur": "65",
}


def _d(v) -> Column:
    return F.lit(Decimal(str(v)))


def impact(df: DataFrame, pred: str, constants: Mapping[str, str] = IMPACT_CONSTANTS,
           site_km: DataFrame | None = None, key: str = "site_id") -> DataFrame:
    """Nine derived columns, each rounded before it feeds the next one.

    Exact DECIMAL arithmetic: the cascade of roundings then depends only on
    the values, never on float representation or engine.
    """
    c = {k: _d(v) for k, v in constants.items()}
    d = df.withColumn("_p", F.col(pred).cast("decimal(20,9)"))
    if site_km is not None:
        d = d.join(small(site_km), key, "left").withColumn(
            "avg_trip_km", F.coalesce(F.col("avg_trip_km").cast("decimal(10,3)"), c["avg_trip_km"]))
    else:
        d = d.withColumn("avg_trip_km", c["avg_trip_km"])
    km = F.col("avg_trip_km")
    steps = [
        ("car_trips_replaced", F.round(F.col("_p") * c["modal_shift_rate"], 2)),
        ("km_not_driven", F.round(F.col("car_trips_replaced") * km, 2)),
        ("co2_saved_kg", F.round(F.col("km_not_driven") * c["co2_per_km_g"] * _d("0.001"), 3)),
        ("fuel_saved_litres", F.round(F.col("km_not_driven") * c["fuel_per_km_l"], 3)),
        ("fuel_cost_saved_eur", F.round(F.col("fuel_saved_litres") * c["fuel_price_eur"], 3)),
        ("carbon_value_eur", F.round(F.col("co2_saved_kg") * _d("0.001") * c["co2_price_per_tonne_eur"], 4)),
        ("kcal_burned", F.round(F.col("_p") * km * c["kcal_per_km"], 0)),
        ("health_cost_avoided_eur", F.round(F.col("km_not_driven") * c["health_cost_per_km_eur"], 3)),
    ]
    for name, e in steps:
        d = d.withColumn(name, e)
    d = d.withColumn("total_value_eur", F.round(F.col("fuel_cost_saved_eur") + F.col("carbon_value_eur")
                                                + F.col("health_cost_avoided_eur"), 3))
    return d.drop("_p")


IMPACT_COLS = ["car_trips_replaced", "km_not_driven", "co2_saved_kg", "fuel_saved_litres", "fuel_cost_saved_eur",
               "carbon_value_eur", "kcal_burned", "health_cost_avoided_eur", "total_value_eur"]

# The second impact variant (trip-correction factor, 5 km).
IMPACT_V2 = {"modal_shift_rate": "0.35", "trip_correction": "0.8", "avg_trip_km": "5.0", "co2_per_km_g": "120",
             "fuel_per_km_l": "0.07", "fuel_price_eur": "1.75", "health_cost_per_km_eur": "0.03",
             "co2_price_per_tonne_eur": "65"}


def impact_v2(df: DataFrame, pred: str, constants: Mapping[str, str] = IMPACT_V2) -> DataFrame:
    """Variant with a trip-correction factor and no intermediate rounding."""
    c = {k: _d(v) for k, v in constants.items()}
    p = F.col(pred).cast("decimal(20,9)")
    trips = p * c["modal_shift_rate"] * c["trip_correction"]
    km = trips * c["avg_trip_km"]
    co2 = km * c["co2_per_km_g"] * _d("0.001")
    fuel = km * c["fuel_per_km_l"] * c["fuel_price_eur"]
    carbon = co2 * _d("0.001") * c["co2_price_per_tonne_eur"]
    health = km * c["health_cost_per_km_eur"]
    return df.withColumns({"car_trips_replaced": trips, "km_not_driven": km, "co2_saved_kg": co2,
                           "fuel_cost_saved_eur": fuel, "carbon_value_eur": carbon,
                           "health_cost_avoided_eur": health, "total_value_eur": fuel + carbon + health})


# I3 / I4 / I5 / I6 --------------------------------------------------------
def impact_by(df: DataFrame, part: Column, name: str, cols: Sequence[str] = ("car_trips_replaced",
              "co2_saved_kg", "total_value_eur")) -> DataFrame:
    return df.groupBy(part.alias(name)).agg(*[F.sum(c).alias(c) for c in cols], F.count(F.lit(1)).alias("n"))


def impact_sites(df: DataFrame, key: str = "site_id") -> DataFrame:
    t = df.groupBy(key).agg(F.sum("total_value_eur").alias("total_value_eur"),
                            F.sum("co2_saved_kg").alias("co2_saved_kg"))
    t = t.withColumn("co2_saved_tonnes", F.col("co2_saved_kg") * _d("0.001"))
    return W.global_row_number(t, [F.col("total_value_eur").desc(), F.col(key)], "rank")


def impact_city(df: DataFrame, city: str, pop: DataFrame, weekend: Column, peak: Column,
                key: str = "site_id") -> DataFrame:
    """Municipality totals with population: per-capita value and CO2,
    weekday / weekend / peak-hour value and the weekday / weekend ratio."""
    v = F.col("total_value_eur")
    g = df.groupBy(city).agg(F.count_distinct(key).alias("site_count"),
                             F.sum(v).alias("total_value_eur"), F.sum("co2_saved_kg").alias("co2_saved_kg"),
                             F.sum(F.when(~weekend, v).otherwise(_d(0))).alias("weekday_value"),
                             F.sum(F.when(weekend, v).otherwise(_d(0))).alias("weekend_value"),
                             F.sum(F.when(peak, v).otherwise(_d(0))).alias("peak_value"),
                             F.sum("car_trips_replaced").alias("trips"))
    g = g.join(small(pop), city, "left")
    return g.withColumns({
        "value_per_capita": F.col("total_value_eur").cast("double") / F.col("population"),
        "co2_saved_kg_per_capita": F.col("co2_saved_kg").cast("double") / F.col("population"),
        "weekday_weekend_ratio": F.col("weekday_value").cast("double")
        / (F.col("weekend_value").cast("double") + F.lit(1e-9)),
    })


def impact_priority(df: DataFrame, key: str, terms: Mapping[str, float]) -> DataFrame:
    """Weighted sum of min-max scaled terms, ranked (small per-city table)."""
    d = df
    score = F.lit(0.0)
    for t, w in terms.items():
        d = W.minmax(d, t, f"_n_{t}")
        score = score + F.lit(w) * F.coalesce(F.col(f"_n_{t}"), F.lit(0.0))
    d = d.withColumn("priority", score).drop(*[f"_n_{t}" for t in terms])
    return W.global_row_number(d, [F.col("priority").desc(), F.col(key)], "rank")


# I8 / I9 / I10 / I11 ------------------------------------------------------
def annualise(df: DataFrame, ts: str, pred: str, uplift: float = 1.4) -> DataFrame:
    """Total over the test span scaled to a year (x seasonal uplift), value
    per predicted trip and per 1000 trips, and weekday / weekend ratio of the
    per-weekday mean values.  The span is whole days between the first and
    last timestamp, plus one.  A DECIMAL ``pred`` column is summed exactly."""
    from countpanel.functions.dates import weekday0

    v = F.col("total_value_eur").cast("double")
    dow = df.groupBy(weekday0(ts).alias("_dow")).agg(F.avg(v).alias("_avg"))
    ratio = dow.agg((F.avg(F.when(F.col("_dow") < 5, F.col("_avg")))
                     / F.avg(F.when(F.col("_dow") >= 5, F.col("_avg")))).alias("weekday_weekend_ratio"))
    secs = F.unix_timestamp(F.max(F.col(ts)).cast("timestamp")) - F.unix_timestamp(F.min(F.col(ts)).cast("timestamp"))
    g = df.agg(F.sum(v).alias("total"), (F.floor(secs / 86400) + 1).alias("n_days"),
               F.sum(F.col(pred)).cast("double").alias("predicted_trips"))
    g = g.withColumns({
        "per_day": F.col("total") / F.col("n_days"),
        "per_year": F.col("total") / F.col("n_days") * 365 * F.lit(uplift),
        "value_per_trip": F.try_divide(F.col("total"), F.col("predicted_trips")),
        "value_per_1000_trips": F.try_divide(F.col("total") * 1000, F.col("predicted_trips")),
    })
    return g.crossJoin(bounded(ratio))


def population(census: DataFrame, key: str, value: str) -> DataFrame:
    return census.groupBy(key).agg(F.sum(value).alias("population"))


def city_ranking(df: DataFrame, city: str, col: str, k: int = 10, scale: float = 1000.0,
                 hour: int | None = None, hour_col: str = "hour") -> DataFrame:
    """Top-k cities by the mean of a per-capita column, optionally for one
    hour of the day, scaled to a unit (per 1000 inhabitants)."""
    if hour is not None:
        df = df.filter(F.col(hour_col) == hour)
    g = df.groupBy(city).agg((F.avg(col) * F.lit(scale)).alias("per_1000"))
    return g.orderBy(F.col("per_1000").desc(), F.col(city)).limit(k)
