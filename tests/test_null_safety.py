"""Null keys, null orders, all-null groups; far latitudes; unseen categories;
repeatable isolation flags: no row is lost and no result depends on size or order."""

import datetime as dt
import math

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from countpanel.functions.encode import one_hot
from countpanel.operators import anomaly as NA
from countpanel.operators import joins as J
from countpanel.operators import windows as W
from countpanel.operators.aggs import exact_quantiles


def _rows(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [(k, base + dt.timedelta(hours=7 * i), i, float(i)) for k in ("a", None) for i in range(30)]
    rows += [(k, None, 100 + i, float(i)) for k in ("a", "b", None) for i in range(3)]
    return spark.createDataFrame(rows, "k string, ts timestamp_ntz, id int, y double")


def _key(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("hot_rows", [1_000_000, 5])
def test_positions_keep_null_keys_and_orders(spark, hot_rows):
    d = _rows(spark)
    got = W.with_positions(d, ["k"], "ts", ["id"], hot_rows=hot_rows).select("k", "id", "_pos")
    w = Window.partitionBy("k").orderBy(F.col("ts").asc_nulls_last(), "id")
    ref = d.select("k", "id", (F.row_number().over(w) - 1).alias("_pos"))
    assert _key(got.collect()) == _key(ref.collect())


@pytest.mark.parametrize("how", [{"chunk_rows": 4}, {"chunk_rows": 1_000_000}, {"bounded_series": True}])
def test_lags_and_rolling_equal_whole_key_windows(spark, how):
    d = _rows(spark)
    got = W.add_lags(d, ["k"], "ts", "y", [1, 2], tiebreak=["id"], **how).select("k", "id", "lag_1", "lag_2")
    w = Window.partitionBy("k").orderBy(F.col("ts").asc_nulls_last(), "id")
    ref = d.select("k", "id", F.lag("y", 1).over(w), F.lag("y", 2).over(w))
    assert _key(got.collect()) == _key(ref.collect())


@pytest.mark.parametrize("accuracy", [5, 1000])
def test_quantile_branches_return_the_same_rows(spark, accuracy):
    rows = [(g, float(i % 17)) for g in ("a", None) for i in range(40)] + [("none", None)] * 4 + [("one", 2.5)]
    d = spark.createDataFrame(rows, "g string, v double")
    both = [_key((r.g, r.q25, r.q50) for r in exact_quantiles(
        d, "v", [0.25, 0.5], ["g"], accuracy=accuracy, distributed=x).collect()) for x in (True, False)]
    assert both[0] == both[1] and len(both[0]) == 4


def test_time_lags_do_not_multiply_rows(spark):
    t = dt.datetime(2024, 1, 1)
    d = spark.createDataFrame([(1, t, 5.0), (1, t, 3.0), (1, t + dt.timedelta(hours=1), 7.0)],
                              "k int, ts timestamp_ntz, y double")
    got = W.add_time_lags(d, ["k"], "ts", "y", [1]).collect()
    assert _key((r.y, r.tlag_1) for r in got) == _key([(5.0, None), (3.0, None), (7.0, 3.0)])


@pytest.mark.parametrize("lat", [0.0, 51.0, 68.0, 89.9, -75.0])
@pytest.mark.parametrize("lon", [5.0, 179.99])
def test_grid_equals_brute_force_at_any_latitude(spark, lat, lon):
    import random
    rnd = random.Random(int(lat * 10 + lon))
    metres = 3000.0
    spread = 4 * metres / 111_320
    wide = min(60.0, spread / max(math.cos(math.radians(lat)), 1e-3))

    def points(n):
        out = []
        for k in range(n):
            x = lon + rnd.uniform(-wide, wide)
            out.append((k, max(-90.0, min(90.0, lat + rnd.uniform(-spread, spread))), (x + 180) % 360 - 180))
        return out
    a, b = points(60), points(60)
    sites = spark.createDataFrame(a, "site_id int, lat double, lon double")
    poi = spark.createDataFrame([(k, "park", y, x) for k, y, x in b], "poi_id int, kind string, lat double, lon double")

    def distance(p, q):
        y1, y2 = math.radians(p[1]), math.radians(q[1])
        h = math.sin((y2 - y1) / 2) ** 2 + math.cos(y1) * math.cos(y2) * math.sin(math.radians(q[2] - p[2]) / 2) ** 2
        return 2 * 6371008.8 * math.asin(min(1.0, math.sqrt(h)))
    expected = {p[0]: sum(distance(p, q) <= metres for q in b) for p in a}
    got = {r.site_id: r.park_count for r in J.count_within(sites, poi, metres, ["park"]).collect()}
    assert got == expected and sum(expected.values()) > 0


def test_unseen_category_is_the_zero_vector(spark):
    from pyspark.ml.functions import vector_to_array
    model = one_hot(spark.createDataFrame([("a",), ("b",)], "c string"), ["c"])
    d = spark.createDataFrame([("a",), ("b",), ("zzz",), (None,)], "c string")
    got = {r.c: r.v for r in model.transform(d).select("c", vector_to_array("c_vec").alias("v")).collect()}
    assert got == {"a": [1.0, 0.0], "b": [0.0, 1.0], "zzz": [0.0, 0.0], None: [0.0, 0.0]}


def test_isolation_flags_do_not_depend_on_row_order(spark):
    import numpy as np
    rng = np.random.default_rng(1)
    base = dt.date(2024, 1, 1)
    rows = [(k, base + dt.timedelta(days=i), *map(float, rng.normal(size=3))) for k in ("x", "y") for i in range(300)]
    schema = "k string, ds date, a double, b double, c double"
    runs = []
    for order in (rows, rows[::-1]):
        d = spark.createDataFrame(order, schema).repartition(5)
        runs.append(_key((r.k, r.ds, r.sensor_fault) for r in NA.isolation_flags(d, "k", "ds", ["a", "b", "c"], trees=30).collect()))
    assert runs[0] == runs[1] and sum(r[2] for r in runs[0]) > 0


def test_weather_duplicates_keep_the_same_row(spark):
    facts = spark.createDataFrame([(1, 1)], "site_id int, time int")
    rows = [(1, 1, 5.0), (1, 1, 2.0), (1, 1, 9.0)]
    got = {J.join_weather(facts, spark.createDataFrame(r, "site_id int, time int, t double")).first().t
           for r in (rows, rows[::-1])}
    assert got == {2.0}


def test_readers_drop_nan_and_show_corrupt_lines(spark, tmp_path):
    from countpanel.sources import io as S
    (tmp_path / "w.csv").write_text("a,b\n1.5,x\nNaN,y\nInfinity,z\n")
    got = {r.b: r.a for r in S.read_csv_typed(spark, str(tmp_path / "w.csv"), "a DOUBLE, b STRING").collect()}
    assert got == {"x": 1.5, "y": None, "z": None}
    (tmp_path / "c.csv").write_text("1,IN,bike,2024-01-01 00:00:00,2024-01-01 01:00:00,7\nx,IN,bike,bad,bad,y\n")
    rows = S.read_counts_csv(spark, str(tmp_path / "c.csv"), corrupt="line").select("cnt", "line").collect()
    assert {(r.cnt, r.line) for r in rows} == {(7, None), (None, "x,IN,bike,bad,bad,y")}


def test_update_mode_stream_keeps_the_last_version(spark, tmp_path):
    """Two triggers: a window that grows in the second shows its last value."""
    from countpanel.streaming import hourly as T
    schema = "site_id int, start_time timestamp_ntz, cnt double"
    src, root = str(tmp_path / "in"), str(tmp_path / "out")
    t = dt.datetime(2024, 1, 1, 5)

    def feed(rows, n):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{src}/{n}")
        s = T.stream_hourly(spark.readStream.schema(schema).parquet(f"{src}/*"), "site_id", "start_time", "cnt")
        return {(r.site_id, r.window_start): (r.total_count, r.n_obs) for r in T.run_available_now(
            s, "update", "t", root=root, keys=["site_id", "window_start"]).collect()}
    assert feed([(1, t, 2.0), (2, t, 1.0)], 0) == {(1, t): (2.0, 1), (2, t): (1.0, 1)}
    assert feed([(1, t, 3.0)], 1) == {(1, t): (5.0, 2), (2, t): (1.0, 1)}


def _grouped(spark):
    rows = [(k, float(i % 13), float(i % 7) if i % 5 else None, i) for k in (None, 1, 2) for i in range(40)]
    return spark.createDataFrame(rows, "k int, x double, y double, i int")


def test_group_statistics_keep_the_null_group(spark):
    """The null key is a group like any other."""
    from countpanel.operators import aggs as A
    from countpanel.operators import clean as P
    from countpanel.operators import models_light as ML
    from countpanel.operators import resilience as R

    d = _grouped(spark)
    pdf = d.toPandas()
    groups = {(None if key != key else int(key)): g for key, g in pdf.groupby("k", dropna=False)}
    box = {r.k: r for r in A.box_stats(d, ["k"], "x").collect()}
    assert set(box) == {None, 1, 2} and all(box[k].median == g.x.median() and box[k].whisker_hi == g.x.max() for k, g in groups.items())
    filled = {(r.k, r.i): r.y for r in P.fill_group_median(d, "k", ["x", "y"]).collect()}
    assert len(filled) == 120 and all(filled[k, 0] == g.y.median() for k, g in groups.items())
    for how in ("median", "mean"):
        got = {(r.k, r.i): r.s for r in W.group_transform(d, ["k"], "x", how, "s").collect()}
        assert all(abs(got[k, 3] - getattr(g.x, how)()) < 1e-12 for k, g in groups.items())
    z = {(r.k, r.i): r.x for r in W.zscore(d, ["x"], ["k"]).collect()}
    assert all(abs(z[k, 3] - (3 - g.x.mean()) / g.x.std(ddof=0)) < 1e-12 for k, g in groups.items())
    m = {(r.k, r.i): r.m for r in W.minmax(d, "x", "m", by=["k"]).collect()}
    assert all(m[k, 3] == 3 / 12 for k in groups)
    zone = R.priority_zone(d, "k", "x", "y", tiebreak=["i"], k=3).collect()
    assert sorted((str(r.k) for r in zone)) == ["1"] * 3 + ["2"] * 3 + ["None"] * 3
    base = {r.i: r.baseline for r in ML.historical_baseline(d, d.where("k is null"), ["k"], "x").collect()}
    assert set(base.values()) == {groups[None].x.mean()}
    t = dt.datetime(2024, 1, 1)
    prof = {r.k: r.median_count for r in A.site_profile(d.withColumn("ts", F.lit(t)), "k", "x", "ts").collect()}
    assert prof == {k: g.x.median() for k, g in groups.items()}


@pytest.mark.parametrize("by", [[], ["k"]])
def test_quantiles_of_many_columns(spark, by):
    from countpanel.operators.aggs import quantiles_of_columns
    d = _grouped(spark).withColumn("none", F.lit(None).cast("double"))
    runs = [_key(quantiles_of_columns(d, ["x", "y", "none"], [0.1, 0.5, 1.0], by, accuracy=a, distributed=x).collect())
            for a, x in ((100, False), (100, True), (5, True))]
    assert runs[0] == runs[1] == runs[2] and len(runs[0]) == (9 if by else 3)
    want = _key((*r[:len(by)], c, *r[len(by) + j]) for r in d.groupBy(*by).agg(
        *[F.percentile(c, F.array(F.lit(0.1), F.lit(0.5), F.lit(1.0))) for c in ("x", "y")]).collect() for j, c in enumerate(("x", "y")))
    assert [r for r in runs[0] if "none" not in r] == want


def test_quantile_plan_scans_twice(spark, tmp_path):
    """One scan for the sketches, one for the bands, for any number of columns."""
    from countpanel.operators.aggs import quantiles_of_columns
    _grouped(spark).write.parquet(str(tmp_path / "t"))
    q = quantiles_of_columns(spark.read.parquet(str(tmp_path / "t")), ["x", "y", "i"], [0.25, 0.5], ["k"], distributed=True)
    q.collect()
    plan = q._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 2, plan
