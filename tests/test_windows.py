"""Chunked (skew-safe) windows must equal whole-key windows exactly."""

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from countpanel.operators import windows as W


def _frame(spark, rows):
    return spark.createDataFrame(rows, "k int, ds date, y double")


def _series(spark):
    import datetime as dt

    rows = []
    base = dt.date(2024, 1, 1)
    # gaps of 1, 3, 4 and 9 days, a leading and a trailing gap
    missing = {0, 5, 9, 10, 11, 15, 16, 17, 18, 22, 23, 24, 25, 26, 27, 28, 29, 30, 38, 39}
    for k in (1, 2):
        for i in range(40):
            y = None if i in missing else float(10 * k + i % 7 + (i // 7))
            rows.append((k, base + dt.timedelta(days=i), y))
    return _frame(spark, rows)


def _pd(df, cols):
    return df.orderBy("k", "ds").select(*cols).toPandas().reset_index(drop=True)


@pytest.mark.parametrize("chunk", [3, 7, 1_000_000])
def test_lags_and_rolling_match_whole_key(spark, chunk):
    d = _series(spark)
    w = Window.partitionBy("k").orderBy("ds")
    ref = d.withColumns({
        "lag_1": F.lag("y", 1).over(w), "lag_7": F.lag("y", 7).over(w),
        "m": F.when(F.count("y").over(w.rowsBetween(-7, -1)) >= 3, F.avg("y").over(w.rowsBetween(-7, -1)))})
    got = W.add_lags(d, ["k"], "ds", "y", [1, 7], chunk_rows=chunk, bucket_days=3)
    got = W.rolling_stats(got, ["k"], "ds", "y", 7, min_periods=3, chunk_rows=max(chunk, 8), bucket_days=5)
    a = _pd(ref, ["k", "ds", "lag_1", "lag_7", "m"])
    b = _pd(got, ["k", "ds", "lag_1", "lag_7", "rolling_7_mean"]).rename(columns={"rolling_7_mean": "m"})
    pd.testing.assert_frame_equal(a, b)


def _pandas_interp(s: pd.Series, limit: int) -> pd.Series:
    return s.interpolate("linear", limit=limit, limit_direction="forward").where(
        s.ffill().notna())  # leading gap stays null


@pytest.mark.parametrize("chunk", [4, 11, 1_000_000])
def test_interpolate_matches_pandas(spark, chunk):
    d = _series(spark)
    got = W.interpolate(d, "k", "ds", "y", limit=3, out="yi", chunk_rows=chunk, bucket_days=2)
    g = _pd(got, ["k", "ds", "y", "yi"])
    for k, part in g.groupby("k"):
        exp = _pandas_interp(part["y"].reset_index(drop=True), 3)
        pd.testing.assert_series_equal(part["yi"].reset_index(drop=True), exp, check_names=False)


@pytest.mark.parametrize("chunk", [10, 1_000_000])
def test_rolling_median_centred(spark, chunk):
    d = _series(spark)
    got = _pd(W.rolling_median(d, ["k"], "ds", "y", 30, 7, chunk_rows=chunk), ["k", "y", "rolling_med"])
    for k, part in got.groupby("k"):
        exp = part["y"].rolling(30, min_periods=7, center=True).median()
        pd.testing.assert_series_equal(part["rolling_med"], exp, check_names=False)


@pytest.mark.parametrize("chunk", [5, 1_000_000])
def test_seasonal_fill(spark, chunk):
    d = _series(spark)
    got = _pd(W.seasonal_fill(d, "k", "ds", "y", 7, out="yf", chunk_rows=chunk), ["k", "y", "yf"])
    for k, part in got.groupby("k"):
        s = part["y"].reset_index(drop=True)
        exp = s.fillna(s.shift(7)).fillna(s.shift(-7))
        pd.testing.assert_series_equal(part["yf"].reset_index(drop=True), exp, check_names=False)


def test_tail_per_group(spark):
    d = _series(spark)
    got = W.tail_per_group(d, ["k"], "ds", 5, bucket_days=3)
    assert got.count() == 10
    import datetime as dt
    firsts = got.groupBy("k").agg(F.min("ds").alias("m")).collect()
    assert all(r["m"] == dt.date(2024, 2, 5) for r in firsts)


def test_positions_are_dense(spark):
    d = _series(spark)
    p = W.with_positions(d, ["k"], "ds", bucket_days=3, total="n")
    rows = p.groupBy("k").agg(F.min("_pos").alias("a"), F.max("_pos").alias("b"), F.max("n").alias("n")).collect()
    for r in rows:
        assert (r["a"], r["b"], r["n"]) == (0, 39, 40)


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_global_row_number_distributed(spark, parts):
    d = spark.range(0, 200).select(((F.col("id") * 37) % 200).alias("k"), (F.col("id") % 5).alias("g"))
    got = W.global_row_number(d, [F.col("g").desc(), F.col("k")], "r", partitions=parts)
    ref = d.withColumn("r", F.row_number().over(Window.orderBy(F.col("g").desc(), F.col("k"))))
    assert sorted(got.select("k", "g", "r").collect()) == sorted(ref.select("k", "g", "r").collect())


def test_two_level_positions_on_timestamps(spark):
    # readings at irregular times: positions must equal a whole-key row_number
    d = spark.range(0, 3000).select(
        (F.col("id") % 3).alias("k"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(
            secs=((F.col("id") * 7919) % 2_000_000).cast("decimal(18,6)"))).alias("ts"),
        F.col("id"))
    ref = d.withColumn("r", F.row_number().over(Window.partitionBy("k").orderBy("ts", "id")) - 1)
    b = {(r["id"], r["r"], 1000) for r in ref.collect()}
    for hot in (5, 40, 10_000):  # every day hot / some hot / none hot
        got = W.with_positions(d, ["k"], "ts", ["id"], bucket_days=1, fine_seconds=60, total="n", hot_rows=hot)
        assert {(r["id"], r["_pos"], r["n"]) for r in got.collect()} == b
    lagged = W.add_lags(d, ["k"], "ts", "id", [1, 5], tiebreak=["id"], chunk_rows=37, bucket_days=1)
    refl = d.withColumns({"lag_1": F.lag("id", 1).over(Window.partitionBy("k").orderBy("ts", "id")),
                          "lag_5": F.lag("id", 5).over(Window.partitionBy("k").orderBy("ts", "id"))})
    assert sorted(lagged.select("id", "lag_1", "lag_5").collect()) == sorted(refl.select("id", "lag_1", "lag_5").collect())


def test_daily_gap_filling_equals_the_chunked_steps(spark):
    """N1 and N2 against reindex, interpolate, median and seasonal fill in
    chunks, with long gaps, a null key, a series of one day, null values."""
    import datetime as dt
    import random

    from countpanel.operators import anomaly as NA

    rnd = random.Random(9)
    base = dt.date(2024, 1, 1)
    rows = [(k, base + dt.timedelta(days=i), None if rnd.random() < 0.1 else round(rnd.lognormvariate(2, 1.2), 2))
            for k in ("a", "b", None) for i in range(260) if rnd.random() < 0.6 and not 100 < i < 130]
    rows += [("one", base, 3.0), ("void", base, None), ("void", base + dt.timedelta(days=9), None), ("undated", None, 1.0)]
    d = spark.createDataFrame(rows, "unique_id string, ds date, y double")
    got = NA.rolling_outliers(NA.continuous_daily(d, keep_pos=True), positioned=True)
    kw = dict(chunk_rows=16, positioned=True)
    full = W.reindex_daily(d.where("unique_id is not null and ds is not null"), "unique_id", "ds", ["y"], with_pos=True)
    n1 = W.seasonal_fill(W.interpolate(full, "unique_id", "ds", "y", limit=3, **kw), "unique_id", "ds", "y", 7, **kw)
    med = W.rolling_median(n1, ["unique_id"], "ds", "y", 30, 7, out="m", **kw)
    hit = F.coalesce(F.col("y") > 4 * F.col("m"), F.lit(False))
    blank = med.select("unique_id", "ds", "_pos", F.when(~hit, F.col("y")).alias("y"), F.col("y").alias("seen"), hit.cast("int").alias("hit"))
    want = W.seasonal_fill(W.interpolate(blank, "unique_id", "ds", "y", limit=3, **kw), "unique_id", "ds", "y", 7, **kw)
    key = lambda rs: sorted((tuple(r) for r in rs), key=repr)
    rows_got = key(got.select("unique_id", "ds", "y", "y_observed", "rolling_outlier").collect())
    assert [r for r in rows_got if r[0] is not None] == key(want.select("unique_id", "ds", "y", "seen", "hit").collect())
    assert sum(r[4] for r in rows_got) > 3 and sum(r[0] is None for r in rows_got) > 200 and "undated" not in {r[0] for r in rows_got}


def test_panel_features_of_an_hourly_panel_equal_the_chunked_ones(spark):
    import datetime as dt

    from countpanel.operators.features import panel_features

    base = dt.datetime(2024, 1, 1)
    rows = [(k, base + dt.timedelta(hours=i), float((i * 37 + k * 11) % 101) / 4) for k in (1, 2) for i in range(400) if i % 9]
    d = spark.createDataFrame(rows, "site_id int, t timestamp_ntz, y double")
    runs = [panel_features(d, "site_id", "t", "y", [], exact_scale=2, **kw) for kw in ({}, {"hourly": False, "chunk_rows": 50})]
    cols = sorted(runs[0].columns)
    key = lambda df: sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)
    assert key(runs[0]) == key(runs[1]) and len(cols) > 15
