"""Randomised series (hypothesis) against pandas, and watermark behaviour."""

import datetime as dt

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from countpanel.operators import windows as W
from countpanel.streaming import hourly as T

series = st.lists(st.one_of(st.none(), st.integers(0, 500).map(lambda v: v / 4.0)), min_size=5, max_size=60)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ys=series, chunk=st.integers(3, 25))
def test_gap_filling_and_rolling_match_pandas(spark, ys, chunk):
    base = dt.date(2024, 1, 1)
    rows = [(1, base + dt.timedelta(days=i), y) for i, y in enumerate(ys)]
    d = spark.createDataFrame(rows, "k int, ds date, y double")
    out = W.interpolate(d, "k", "ds", "y", limit=3, out="yi", chunk_rows=chunk, bucket_days=2)
    out = W.seasonal_fill(out, "k", "ds", "y", 7, out="ys", chunk_rows=chunk, bucket_days=2)
    out = W.rolling_median(out, ["k"], "ds", "y", 30, 7, chunk_rows=max(chunk, 30), bucket_days=3)
    out = W.rolling_stats(out, ["k"], "ds", "y", 7, min_periods=3, chunk_rows=chunk, bucket_days=4)
    got = out.orderBy("ds").toPandas()
    s = pd.Series(ys, dtype="float64")
    interp = s.interpolate("linear", limit=3, limit_direction="forward").where(s.ffill().notna())
    pd.testing.assert_series_equal(got["yi"], interp, check_names=False, atol=1e-9, rtol=0)
    pd.testing.assert_series_equal(got["ys"], s.fillna(s.shift(7)).fillna(s.shift(-7)), check_names=False)
    pd.testing.assert_series_equal(got["rolling_med"], s.rolling(30, min_periods=7, center=True).median(),
                                   check_names=False, atol=1e-9, rtol=0)
    pd.testing.assert_series_equal(got["rolling_7_mean"], s.shift(1).rolling(7, min_periods=3).mean(),
                                   check_names=False, atol=1e-9, rtol=0)


def test_watermark_drops_late_rows_in_append_mode(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    schema = "site_id long, start_time timestamp_ntz, cnt double"

    def write(name, rows):
        import pyarrow as pa
        import pyarrow.parquet as pq

        tbl = pa.table({"site_id": pa.array([r[0] for r in rows], pa.int64()),
                        "start_time": pa.array([r[1] for r in rows], pa.timestamp("us")),
                        "cnt": pa.array([r[2] for r in rows], pa.float64())})
        pq.write_table(tbl, src / f"{name}.parquet")

    t = dt.datetime(2024, 1, 1, 10, 5)
    sink = str(tmp_path / "sink")

    def trigger():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(src))
        agg = T.stream_hourly(stream, "site_id", "start_time", "cnt", "2 hours")
        return T.run_available_now(agg, "append", "test_late", root=sink)

    write("a", [(1, t, 1.0), (1, t + dt.timedelta(hours=5), 2.0)])          # watermark -> 13:05
    trigger()                                                                # 10:00 window closes
    write("b", [(1, t + dt.timedelta(minutes=10), 4.0),                      # 10:15, behind the watermark
                (1, t + dt.timedelta(hours=9), 8.0)])                        # advances it to 17:05
    out = trigger()
    got = {(r["window_start"], r["total_count"]) for r in out.collect()}
    # the late 4.0 is dropped; 15:00 closes in the second trigger; 19:00 stays open
    assert got == {(dt.datetime(2024, 1, 1, 10), 1.0), (dt.datetime(2024, 1, 1, 15), 2.0)}
