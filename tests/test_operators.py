"""Operators against brute-force Python models on small literal frames."""

import datetime as dt
import math
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from countpanel.operators import aggs as A
from countpanel.operators import joins as J
from countpanel.operators import resilience as R
from countpanel.sources import io as S


def _points(spark, n, seed, prefix):
    rnd = random.Random(seed)
    rows = [(i, 50.7 + rnd.random() * 0.5, 2.6 + rnd.random() * 3.0) for i in range(n)]
    return rows


def _hav(lat1, lon1, lat2, lon2):
    r = 6371008.8
    p1, p2 = math.radians(lat1), math.radians(lat2)
    dp, dl = p2 - p1, math.radians(lon2) - math.radians(lon1)
    a = math.sin(dp / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(dl / 2) ** 2
    return 2 * r * math.asin(min(1.0, math.sqrt(a)))


def _flat(lat1, lon1, lat2, lon2):
    return math.sqrt((lat1 - lat2) ** 2 + (lon1 - lon2) ** 2) * 111320.0


@pytest.mark.parametrize("metric,radius", [("flat", 3000.0), ("flat", 12000.0), ("haversine", 5000.0),
                                           ("haversine", 20000.0)])
def test_grid_join_equals_brute_force(spark, metric, radius):
    sites = _points(spark, 120, 1, "s")
    kinds = ["school", "station", "park"]
    poi = [(i, kinds[i % 3], lat, lon) for i, lat, lon in _points(spark, 200, 2, "p")]
    sdf = spark.createDataFrame(sites, "site_id long, lat double, lon double")
    pdf = spark.createDataFrame(poi, "poi_id long, kind string, lat double, lon double")
    dist = _hav if metric == "haversine" else _flat
    got = {r["site_id"]: (r["school_count"], r["station_count"], r["park_count"])
           for r in J.count_within(sdf, pdf, radius, kinds, metric=metric).collect()}
    for sid, slat, slon in sites:
        exp = tuple(sum(1 for _, k, plat, plon in poi if k == kind and dist(slat, slon, plat, plon) <= radius)
                    for kind in kinds)
        assert got[sid] == exp
    near = {r["site_id"]: r["dist_nearest_station"]
            for r in J.nearest(sdf, pdf, "station", radius, metric=metric).collect()}
    for sid, slat, slon in sites:
        ds = [dist(slat, slon, plat, plon) for _, k, plat, plon in poi if k == "station"]
        ds = [d for d in ds if d <= radius]
        exp = min(ds) if ds else None
        assert (near[sid] is None and exp is None) or abs(near[sid] - exp) < 1e-6


def test_binned_mean_right_closed_with_lowest_and_empty_bins(spark):
    vals = [(0.0, 1.0), (5.0, 2.0), (5.0001, 3.0), (10.0, 4.0), (10.5, 5.0), (-1.0, 6.0)]
    df = spark.createDataFrame(vals, "x double, v double")
    out = {r["bin"]: (r["mean_value"], r["n_rows"]) for r in
           A.binned_mean(df, "x", "v", [0, 5, 10, 20, 30], keep_empty=True).collect()}
    # (0,5] with 0 included; (5,10]; (10,20]; (20,30] empty; -1 outside
    assert out == {0: (1.5, 2), 1: (3.5, 2), 2: (5.0, 1), 3: (None, 0)}


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(float(x),) for x in [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10]], "x double")
    out = {r["bin"]: r["n"] for r in A.histogram(df, "x", 5).collect()}
    assert out == {0: 2, 1: 2, 2: 2, 3: 2, 4: 3}


def _q(x, places):
    return x.quantize(Decimal(1).scaleb(-places), rounding=ROUND_HALF_UP)


def test_impact_cascade_matches_decimal_model(spark):
    preds = [0.0, 1.0, 3.3333333, 12.5, 99.99, 123.4567891, 7.1428571]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(preds)], "site_id long, predicted double")
    got = {r["site_id"]: r for r in R.impact(df, "predicted").collect()}
    c = {k: Decimal(v) for k, v in R.IMPACT_CONSTANTS.items()}
    for i, p in enumerate(preds):
        p = _q(Decimal(repr(p)), 9)
        trips = _q(p * c["modal_shift_rate"], 2)
        km = _q(trips * c["avg_trip_km"], 2)
        co2 = _q(km * c["co2_per_km_g"] * Decimal("0.001"), 3)
        fuel = _q(km * c["fuel_per_km_l"], 3)
        cost = _q(fuel * c["fuel_price_eur"], 3)
        carbon = _q(co2 * Decimal("0.001") * c["co2_price_per_tonne_eur"], 4)
        health = _q(km * c["health_cost_per_km_eur"], 3)
        total = _q(cost + carbon + health, 3)
        r = got[i]
        assert (r["car_trips_replaced"], r["km_not_driven"], r["co2_saved_kg"], r["total_value_eur"]) == \
            (trips, km, co2, total)


def test_explode_hourly_json(spark):
    doc = ('{"latitude": 50.9, "longitude": 4.4, "utc_offset_seconds": 3600, "hourly": '
           '{"time": ["2024-03-30T23:00", "2024-03-31T00:00", "2024-03-31T01:00"], '
           '"temperature_2m": [4.5, null, 3.9], "precipitation": [0.0, 0.2, 0.0]}}')
    df = spark.createDataFrame([(7, doc)], "site_id int, doc string")
    rows = S.explode_hourly_json(df, "doc", ["temperature_2m", "precipitation"], ["site_id"]).orderBy("time").collect()
    assert [(r["time"].hour, r["temperature_2m"], r["precipitation"]) for r in rows] == \
        [(23, 4.5, 0.0), (0, None, 0.2), (1, 3.9, 0.0)]
    assert {r["utc_offset_seconds"] for r in rows} == {3600}


def test_explode_time_axis_across_offset(spark):
    start = int(dt.datetime(2024, 3, 30, 22, tzinfo=dt.timezone.utc).timestamp())
    df = spark.createDataFrame([(1, start, start + 4 * 3600, 3600, 7200, [1.0, 2.0, 3.0, 4.0])],
                               "site_id int, s long, e long, st long, off long, v array<double>")
    rows = S.explode_time_axis(df, "s", "e", "st", "off", ["v"]).orderBy("time").collect()
    assert [(r["time"], r["v"]) for r in rows] == [
        (dt.datetime(2024, 3, 31, 0), 1.0), (dt.datetime(2024, 3, 31, 1), 2.0),
        (dt.datetime(2024, 3, 31, 2), 3.0), (dt.datetime(2024, 3, 31, 3), 4.0)]


def test_read_counts_and_sites_drop_bad_rows(spark, tmp_path):
    p = tmp_path / "sites.csv"
    p.write_text("12,12,4.4,50.9,Main,regional,R1,West,Ghent,15,2020-01-01\n"
                 "x7,7,4.1,50.1,Bad,regional,R2,East,Aalst,15,not-a-date\n"
                 "13,13,4.2,50.2,Side,local,R3,East,Aalst,15,bad\n")
    rows = S.read_sites(spark, str(p)).orderBy("site_id").collect()
    assert [(r["site_id"], r["municipality"], r["date_from"]) for r in rows] == [
        (12, "Ghent", dt.date(2020, 1, 1)), (13, "Aalst", None)]


def test_holiday_flags_literal_and_table_paths_agree(spark):
    from countpanel.functions.dates import holiday_flags
    from countpanel.plans.core import HOLIDAYS, holiday_table

    days = spark.range(0, 3 * 366).select(
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).cast("timestamp_ntz").alias("ts"))
    a = holiday_flags(days, "ts", HOLIDAYS).orderBy("ts").collect()
    b = holiday_flags(days, "ts", holiday_table(spark)).orderBy("ts").collect()
    assert [(r["ts"], r["is_holiday"], r["is_pre_holiday"]) for r in a] == \
        [(r["ts"], r["is_holiday"], r["is_pre_holiday"]) for r in b]
    assert sum(r["is_holiday"] for r in a) == len(HOLIDAYS)


def test_cardinality_exact_and_approx(spark, fx):
    exact = A.cardinality(fx.counts, ["site_id", "type"]).collect()[0]
    approx = A.cardinality(fx.counts, ["site_id", "type"], approx=True).collect()[0]
    assert exact["n_type"] == approx["n_type"]
    assert abs(exact["n_site_id"] - approx["n_site_id"]) <= max(2, 0.05 * exact["n_site_id"])


def test_verify_mape_modes_and_global_range(spark):
    from countpanel.operators import quality as Q

    rows = [(1, 0.0, 0.5, 10.0, 12.0), (1, 2.0, 1.0, 20.0, 18.0), (2, 4.0, 4.0, 30.0, 33.0)]
    d = spark.createDataFrame(rows, "g int, p_act double, p_fc double, t_act double, t_fc double")
    eps = {r["variable"]: r for r in Q.verify(d, ["p", "t"], mape="eps").collect()}
    nz = {r["variable"]: r for r in Q.verify(d, ["p", "t"], mape="nonzero").collect()}
    assert abs(eps["p"]["mae"] - 0.5) < 1e-12 and abs(eps["t"]["rmse"] - math.sqrt((4 + 4 + 9) / 3)) < 1e-12
    assert eps["p"]["mape"] > 1e15                                  # 0.5 / 2.2e-16 dominates
    assert abs(nz["p"]["mape"] - 25.0) < 1e-12                      # (0.5 + 0) / 2 nonzero rows
    assert abs(eps["t"]["nmae_pct"] - (7 / 3) * 100 / 20) < 1e-12   # range of t_act = 20
    by = {r["g"]: r for r in Q.verify(d, ["t"], by=[F.col("g")]).collect()}
    assert abs(by[2]["nmae_pct"] - 3 * 100 / 20) < 1e-12            # global range, not the group's


def test_compare_models_equals_evaluate(spark, fx):
    from countpanel.operators import quality as Q

    d = fx.pred.withColumn("shrunk", F.col("predicted") * 0.9)
    both = {r["model"]: r for r in Q.compare_models(d, "actual", ["predicted", "shrunk"]).collect()}
    for m in ("predicted", "shrunk"):
        e = Q.evaluate(d, "actual", m).collect()[0]
        for c in ("mae", "rmse", "r2", "explained_variance", "mae_over_mean"):
            assert abs(both[m][c] - e[c]) < 1e-9, (m, c)
