"""Wave 5: readers and writers, as round trips through the shared folder.

Every query writes data derived from the given tables under the cluster's
checkpoint folder (``spark.checkpoint.dir``), reads it back with the
library reader and returns the result, compared to the original rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from countpanel.functions import dates as D
from countpanel.operators import models_light as ML
from countpanel.plans.registry import query
from countpanel.session import ensure_checkpoint_dir
from countpanel.sources import io as S

TS_FMT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
RAW_DDL = "site_id BIGINT, direction STRING, type STRING, start_time STRING, end_time STRING, cnt DOUBLE"


def _scratch(fx, name: str) -> str:
    return f"{ensure_checkpoint_dir(fx.spark).rstrip('/')}/io/{name}-{uuid.uuid4().hex[:12]}"


def _raw_counts(fx):
    t = F.date_format("start_time", TS_FMT)
    return fx.counts.select("site_id", "direction", "type", t.alias("start_time"),
                            F.date_format(F.col("start_time") + F.expr("INTERVAL 15 MINUTES"), TS_FMT).alias("end_time"),
                            "cnt")


COUNTS_SQL = "SELECT site_id, direction, type, start_time, start_time + INTERVAL 15 MINUTE AS end_time, cnt FROM v_counts"


@query("s1_read_counts_csv", COUNTS_SQL)
def s1(fx):
    """Headerless CSV with fixed names and types (written by the CSV sink, S11)."""
    path = _scratch(fx, "counts_csv")
    S.write_csv(_raw_counts(fx), path, header=False)
    return S.read_counts_csv(fx.spark, path, RAW_DDL, ts_format=TS_FMT)


@query("s2_read_monthly", COUNTS_SQL)
def s2(fx):
    """Monthly file set read as one table; a missing month is skipped."""
    root = _scratch(fx, "monthly")
    S.write_csv(_raw_counts(fx), f"{root}/2024-01", header=False)
    d = S.read_monthly(fx.spark, root, ["2023-12", "2024-01"], "{root}/{month}", RAW_DDL)
    return d.drop("source_file").withColumns({
        "start_time": F.try_to_timestamp(F.col("start_time").cast("string")).cast("timestamp_ntz"),
        "end_time": F.try_to_timestamp(F.col("end_time").cast("string")).cast("timestamp_ntz")}) \
        if dict(d.dtypes)["start_time"] == "string" else d.drop("source_file")


@query("s3_read_csv_typed", "SELECT site_id, site_name, municipality, lat, lon, dist_nearest_station FROM v_sites")
def s3(fx):
    """Headered CSV read with an explicit schema (ids kept as typed)."""
    path = _scratch(fx, "sites_csv")
    S.write_csv(fx.sites.select("site_id", "site_name", "municipality", "lat", "lon", "dist_nearest_station"), path)
    return S.read_csv_typed(fx.spark, path, "site_id BIGINT, site_name STRING, municipality STRING, lat DOUBLE, "
                                            "lon DOUBLE, dist_nearest_station DOUBLE")


@query("s4_read_sites", """
SELECT CAST(site_id AS INTEGER) AS site_id, CAST(site_id AS INTEGER) AS site_nr, lon, lat, site_name, 'regional' AS domain,
       'R' || CAST(site_id % 50 AS VARCHAR) AS road, district, municipality, 15 AS interval_min, DATE '2020-01-01' AS date_from
FROM v_sites WHERE site_id % 13 <> 0
""")
def s4(fx):
    """Headerless site dimension: rows whose id is not an integer are dropped."""
    s = fx.sites
    raw = s.select(
        F.when(F.col("site_id") % 13 == 0, F.concat(F.lit("bad"), F.col("site_id").cast("string")))
        .otherwise(F.col("site_id").cast("string")).alias("site_id"),
        F.col("site_id").cast("int").alias("site_nr"), "lon", "lat", "site_name", F.lit("regional").alias("domain"),
        F.concat(F.lit("R"), (F.col("site_id") % 50).cast("string")).alias("road"), "district", "municipality",
        F.lit(15).alias("interval_min"), F.lit("2020-01-01").alias("date_from"))
    path = _scratch(fx, "sites_raw")
    S.write_csv(raw, path, header=False)
    return S.read_sites(fx.spark, path)


@query("s7_read_weather", """
SELECT time, CAST(site_id AS INTEGER) AS site_id, temperature_2m, NULL::DOUBLE AS apparent_temperature,
       NULL::DOUBLE AS relative_humidity_2m, precipitation, precipitation AS rain, 0e0 AS snowfall, wind_speed_10m,
       NULL::DOUBLE AS shortwave_radiation, NULL::DOUBLE AS direct_normal_irradiance, NULL::DOUBLE AS sunshine_duration
FROM v_weather
""")
def s7(fx):
    """Weather CSV (12 columns) with the time column parsed."""
    w = fx.weather
    out = w.select(F.date_format("time", "yyyy-MM-dd HH:mm:ss").alias("time"), "site_id", "temperature_2m",
                   F.lit(None).cast("double").alias("apparent_temperature"),
                   F.lit(None).cast("double").alias("relative_humidity_2m"), "precipitation",
                   F.col("precipitation").alias("rain"), F.lit(0.0).alias("snowfall"), "wind_speed_10m",
                   *[F.lit(None).cast("double").alias(c) for c in
                     ("shortwave_radiation", "direct_normal_irradiance", "sunshine_duration")])
    path = _scratch(fx, "weather_csv")
    S.write_csv(out, path)
    return S.read_weather(fx.spark, path, fmt="csv")


@query("s8_resolve_event_time", """
SELECT 'start_time' AS layout, date_trunc('hour', start_time) AS datetime_hour FROM v_counts
UNION ALL SELECT 'date_hour', CAST(CAST(time AS DATE) AS TIMESTAMP) + hour(time) * INTERVAL 1 HOUR FROM v_weather
UNION ALL SELECT 'ymdh', make_timestamp(year(time), month(time), day(time), hour(time), 0, 0) FROM v_weather
""")
def s8(fx):
    """Event time from whichever layout a table has, floored to the hour."""
    a = D.resolve_event_time(fx.counts).select(F.lit("start_time").alias("layout"), "datetime_hour")
    w = fx.weather
    b = D.resolve_event_time(w.select(F.to_date("time").alias("date"), F.hour("time").alias("hour")))
    c = D.resolve_event_time(w.select(F.year("time").alias("year"), F.month("time").alias("month"),
                                      F.dayofmonth("time").alias("day"), F.hour("time").alias("hour")))
    return a.unionByName(b.select(F.lit("date_hour").alias("layout"), "datetime_hour")) \
            .unionByName(c.select(F.lit("ymdh").alias("layout"), "datetime_hour"))


@query("s9_explode_hourly_json", """
SELECT site_id, 50.7e0 + site_id / 1000e0 AS latitude, 3e0 AS longitude, 3600 AS utc_offset_seconds, time,
       temperature_2m, precipitation FROM v_weather
""")
def s9(fx):
    """JSON documents with parallel hourly arrays -> one row per hour.

    The documents are built per (site, day) from the weather table, so each
    holds at most 24 entries; they are exploded back with from_json +
    arrays_zip + inline."""
    w = fx.weather
    docs = (w.groupBy("site_id", F.to_date("time").alias("d"))
            .agg(F.sort_array(F.collect_list(F.struct(
                F.date_format("time", "yyyy-MM-dd'T'HH:mm").alias("t"), "temperature_2m", "precipitation"))).alias("h"))
            .select("site_id", F.to_json(F.struct(
                (F.lit(50.7) + F.col("site_id") / F.lit(1000.0)).alias("latitude"), F.lit(3.0).alias("longitude"),
                F.lit(3600).alias("utc_offset_seconds"),
                F.struct(F.col("h.t").alias("time"), F.col("h.temperature_2m").alias("temperature_2m"),
                         F.col("h.precipitation").alias("precipitation")).alias("hourly"))).alias("doc")))
    return S.explode_hourly_json(docs, "doc", ["temperature_2m", "precipitation"], ["site_id"])


@query("s10_explode_time_axis", """
SELECT site_id, time + INTERVAL 1 HOUR AS time, temperature_2m FROM v_weather
""")
def s10(fx):
    """Time axis rebuilt from (start, end, step) epoch seconds plus a UTC
    offset, values attached by position: one response per contiguous run of
    hours of a site-day."""
    day = Window.partitionBy("site_id", F.to_date("time")).orderBy("time")  # 24 rows at most
    w = fx.weather.withColumn("run", F.hour("time") - F.row_number().over(day))
    full = (w.groupBy("site_id", F.to_date("time").alias("d"), "run")
            .agg(F.count(F.lit(1)).alias("n"), F.min("time").alias("t0"),
                 F.sort_array(F.collect_list(F.struct("time", "temperature_2m"))).alias("v")))
    resp = full.select("site_id",
                       F.unix_timestamp(F.col("t0").cast("timestamp")).alias("start"),
                       (F.unix_timestamp(F.col("t0").cast("timestamp")) + F.col("n") * 3600).alias("end"),
                       F.lit(3600).cast("bigint").alias("step"), F.lit(3600).cast("bigint").alias("offset"),
                       F.col("v.temperature_2m").alias("temperature_2m"))
    return S.explode_time_axis(resp, "start", "end", "step", "offset", ["temperature_2m"]).drop("offset")


@query("s12_compact_years", """
SELECT unique_id, ds, ROUND(y, 2) AS y, CAST(year(ds) AS INTEGER) AS year FROM v_daily
""")
def s12(fx):
    """Yearly tables unioned and written partitioned by year, read back whole
    (a year filter would prune partitions)."""
    d = fx.daily.withColumn("y", F.round("y", 2))
    y96 = d.filter(F.year("ds") <= 1996)
    y97 = d.filter(F.year("ds") > 1996)
    path = _scratch(fx, "daily_by_year")
    S.compact_years([y96, y97], path, ts="ds")
    return fx.spark.read.parquet(path).select("unique_id", "ds", "y", "year")


@query("s13_save_load_encodings", """
WITH tr AS (SELECT site_id, cnt FROM v_counts WHERE start_time < TIMESTAMP '2024-01-16'),
e AS (SELECT site_id, AVG(cnt) AS enc_site FROM tr GROUP BY 1), g AS (SELECT AVG(enc_site) AS gm FROM e)
SELECT c.event_id, ROUND(COALESCE(e.enc_site, g.gm), 6) AS enc_site FROM v_counts c LEFT JOIN e ON c.site_id = e.site_id
CROSS JOIN g WHERE c.start_time >= TIMESTAMP '2024-01-16'
""")
def s13(fx):
    """Fitted encodings persisted as Parquet tables, reloaded and applied."""
    cut = F.lit("2024-01-16").cast("timestamp_ntz")
    enc = ML.fit_encodings(fx.counts.filter(F.col("start_time") < cut), "cnt", {"enc_site": ["site_id"]})
    root = _scratch(fx, "encodings")
    S.save_encodings({"enc_site": enc["enc_site"], "_global": enc["_global"]}, root)
    loaded = S.load_encodings(fx.spark, root, ["enc_site", "_global"])
    loaded["_keys"] = {"enc_site": ["site_id"]}
    d = ML.apply_encodings(fx.counts.filter(F.col("start_time") >= cut), loaded)
    return d.select("event_id", F.round("enc_site", 6).alias("enc_site"))


@query("s14_compare_schema", """
SELECT * FROM (VALUES ('event_id', 0, NULL, 'bigint', NULL, false, false), ('site_id', 1, 0, 'bigint', 'bigint', false, true),
  ('direction', 2, 1, 'string', 'string', false, true), ('type', 3, 2, 'string', 'string', false, true),
  ('start_time', 4, 3, 'timestamp_ntz', 'timestamp_ntz', false, true), ('cnt', 5, 5, 'double', 'double', true, true),
  ('end_time', NULL, 4, NULL, 'timestamp_ntz', false, false))
  AS t("column", pos_a, pos_b, type_a, type_b, same_pos, same_type)
""")
def s14(fx):
    """Schema comparison of the counts table and its CSV round trip."""
    path = _scratch(fx, "schema_csv")
    S.write_csv(_raw_counts(fx), path, header=False)
    back = S.read_counts_csv(fx.spark, path, RAW_DDL, ts_format=TS_FMT)
    return S.compare_schema(fx.counts, back)


@query("s11_write_csv", """
SELECT o_orderkey, site_id, nation, datetime_hour, actual, ROUND(predicted, 9) AS predicted FROM v_pred
""")
def s11(fx):
    """Result table written as headered CSV, read back with its schema."""
    path = _scratch(fx, "pred_csv")
    out = fx.pred.withColumn("predicted", F.round("predicted", 9)).withColumn(
        "datetime_hour", F.date_format("datetime_hour", "yyyy-MM-dd HH:mm:ss"))
    S.write_csv(out, path)
    back = S.read_csv_typed(fx.spark, path, "o_orderkey BIGINT, site_id BIGINT, nation INT, datetime_hour STRING, "
                                            "actual DOUBLE, predicted DOUBLE")
    return back.withColumn("datetime_hour", F.to_timestamp_ntz("datetime_hour"))
