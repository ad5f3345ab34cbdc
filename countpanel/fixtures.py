"""Fixture views: the panel shapes of the library, derived from the driver tables.

Each view exists twice: as a DataFrame builder (what the Spark queries use)
and as SQL text (what the DuckDB oracle prepends as a CTE).  Both express
the same deterministic rules, so the engines see identical inputs.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countpanel.session import bounded, small

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


class Fixtures:
    """Lazily built fixture views over one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        # event times are naive wall-clock values: evaluate every conversion
        # in UTC so no session zone (or DST gap) can shift them
        spark.conf.set("spark.sql.session.timeZone", "UTC")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # -- raw counts: one reading per event -------------------------------
    @cached_property
    def counts(self) -> DataFrame:
        ev = self.table("events")
        return ev.select(
            "event_id",
            F.col("user_id").alias("site_id"),
            F.when(F.col("event_id") % 2 == 0, F.lit("IN")).otherwise(F.lit("OUT")).alias("direction"),
            F.col("event_type").alias("type"),
            F.col("ts").alias("start_time"),
            F.col("value").alias("cnt"),
        )

    # -- enriched site dimension -----------------------------------------
    @cached_property
    def sites(self) -> DataFrame:
        c = self.table("customer")
        # nation / region have a fixed size by the schema's definition
        n = bounded(self.table("nation"))
        r = bounded(self.table("region"))
        k = F.col("c_custkey")
        return (
            c.join(n, c.c_nationkey == n.n_nationkey)
            .join(r, n.n_regionkey == r.r_regionkey)
            .select(
                k.alias("site_id"),
                F.col("c_name").alias("site_name"),
                F.col("n_name").alias("municipality"),
                F.col("r_name").alias("district"),
                (F.lit(50.7) + ((k * 7919) % 1000) / F.lit(1600.0)).alias("lat"),
                (F.lit(2.6) + ((k * 104729) % 1000) / F.lit(300.0)).alias("lon"),
                (k % 4).cast("int").alias("school_count"),
                F.when(k % 5 == 0, 1).otherwise(0).cast("int").alias("station_count"),
                ((k * 3) % 3 + k % 2).cast("int").alias("park_count"),
                F.when(k % 7 == 0, F.lit(None).cast("double"))
                .otherwise(((k * 37) % 3000) * F.lit(1.0)).alias("dist_nearest_station"),
            )
        )

    # -- points of interest ----------------------------------------------
    @cached_property
    def poi(self) -> DataFrame:
        s = self.table("supplier")
        k = F.col("s_suppkey")
        return s.select(
            k.alias("poi_id"),
            F.when(k % 3 == 0, "school").when(k % 3 == 1, "station").otherwise("park").alias("kind"),
            (F.lit(50.7) + ((k * 6151) % 1000) / F.lit(1600.0)).alias("lat"),
            (F.lit(2.6) + ((k * 3571) % 1000) / F.lit(300.0)).alias("lon"),
        )

    # -- observed hourly weather for every (site, hour) with readings ----
    @cached_property
    def weather(self) -> DataFrame:
        ev = self.table("events")
        hours = ev.select(
            F.col("user_id").alias("site_id"),
            F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("time"),
        ).distinct()
        sid, t = F.col("site_id"), F.col("time")
        dh = F.dayofmonth(t) * 24 + F.hour(t)
        return hours.select(
            "site_id", "time",
            ((sid * 31 + dh * 17) % 350 / F.lit(10.0) - F.lit(5.0)).alias("temperature_2m"),
            F.when((sid * 13 + dh * 7) % 10 < 3, (1 + (sid * 5 + F.hour(t) * 11) % 50) / F.lit(10.0))
            .otherwise(F.lit(0.0)).alias("precipitation"),
            (((sid * 3 + F.hour(t) * 29) % 150) / F.lit(10.0)).alias("wind_speed_10m"),
        )

    # -- forecast weather: biased, misses some rain ----------------------
    @cached_property
    def weather_fcst(self) -> DataFrame:
        w = self.weather
        sid, t = F.col("site_id"), F.col("time")
        return w.select(
            "site_id", "time",
            (F.col("temperature_2m") + ((sid + F.hour(t)) % 5 - 2) / F.lit(2.0)).alias("temperature_2m"),
            F.when((sid + F.hour(t)) % 4 == 0, F.lit(0.0)).otherwise(F.col("precipitation")).alias("precipitation"),
            (F.col("wind_speed_10m") + (sid % 3) * F.lit(1.0)).alias("wind_speed_10m"),
        )

    # -- daily panel with gaps -------------------------------------------
    @cached_property
    def daily(self) -> DataFrame:
        o = self.table("orders").select("o_custkey", "o_orderdate", "o_totalprice")
        c = self.table("customer").select("c_custkey", "c_nationkey")
        return (
            o.join(small(c), o.o_custkey == c.c_custkey)
            .groupBy(F.col("c_nationkey").alias("unique_id"),
                     F.col("o_orderdate").cast("date").alias("ds"))
            .agg(F.sum("o_totalprice").alias("y"))
        )

    # -- actual / predicted pairs ----------------------------------------
    @cached_property
    def pred(self) -> DataFrame:
        o = self.table("orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
        c = self.table("customer").select("c_custkey", "c_nationkey")
        li = self.table("lineitem").select("l_orderkey", "l_extendedprice", "l_discount")
        p = li.groupBy("l_orderkey").agg(
            F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("pred"))
        return (
            o.join(small(c), o.o_custkey == c.c_custkey)
            .join(p, p.l_orderkey == o.o_orderkey)
            .select(
                "o_orderkey",
                F.col("o_custkey").alias("site_id"),
                F.col("c_nationkey").alias("nation"),
                F.col("o_orderdate").alias("datetime_hour"),
                (F.col("o_totalprice") / F.lit(1000.0)).alias("actual"),
                (F.col("pred") / F.lit(1000.0)).alias("predicted"),
            )
        )

    # -- population by municipality --------------------------------------
    @cached_property
    def pop(self) -> DataFrame:
        c = self.table("customer").select("c_nationkey")
        n = bounded(self.table("nation"))
        return (
            c.join(n, c.c_nationkey == n.n_nationkey)
            .groupBy(F.col("n_name").alias("municipality"))
            .agg((F.count(F.lit(1)) * 1000).alias("population"))
        )


# ---------------------------------------------------------------------------
# SQL text of the same views, for the DuckDB oracle (fixed values: the view
# definitions are the shared contract of both engines).
VIEW_SQL: dict[str, str] = {
    "v_counts": "SELECT event_id, user_id AS site_id, CASE WHEN event_id % 2 = 0 THEN 'IN' ELSE 'OUT' END AS direction, event_type AS type, ts AS start_time, value AS cnt FROM events",
    "v_sites": "SELECT c.c_custkey AS site_id, c.c_name AS site_name, n.n_name AS municipality, r.r_name AS district, 50.7e0 + ((c.c_custkey * 7919) % 1000) / 1600e0 AS lat, 2.6e0 + ((c.c_custkey * 104729) % 1000) / 300e0 AS lon, CAST(c.c_custkey % 4 AS INT) AS school_count, CAST(CASE WHEN c.c_custkey % 5 = 0 THEN 1 ELSE 0 END AS INT) AS station_count, CAST((c.c_custkey * 3) % 3 + c.c_custkey % 2 AS INT) AS park_count, CASE WHEN c.c_custkey % 7 = 0 THEN NULL ELSE ((c.c_custkey * 37) % 3000) * 1e0 END AS dist_nearest_station FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey",
    "v_poi": "SELECT s_suppkey AS poi_id, CASE s_suppkey % 3 WHEN 0 THEN 'school' WHEN 1 THEN 'station' ELSE 'park' END AS kind, 50.7e0 + ((s_suppkey * 6151) % 1000) / 1600e0 AS lat, 2.6e0 + ((s_suppkey * 3571) % 1000) / 300e0 AS lon FROM supplier",
    "v_weather": "SELECT DISTINCT user_id AS site_id, date_trunc('hour', ts) AS time, ((user_id * 31 + (day(ts) * 24 + hour(ts)) * 17) % 350) / 10e0 - 5e0 AS temperature_2m, CASE WHEN (user_id * 13 + (day(ts) * 24 + hour(ts)) * 7) % 10 < 3 THEN (1 + (user_id * 5 + hour(ts) * 11) % 50) / 10e0 ELSE 0e0 END AS precipitation, ((user_id * 3 + hour(ts) * 29) % 150) / 10e0 AS wind_speed_10m FROM events",
    "v_weather_fcst": "SELECT site_id, time, temperature_2m + ((site_id + hour(time)) % 5 - 2) / 2e0 AS temperature_2m, CASE WHEN (site_id + hour(time)) % 4 = 0 THEN 0e0 ELSE precipitation END AS precipitation, wind_speed_10m + (site_id % 3) * 1e0 AS wind_speed_10m FROM v_weather",
    "v_daily": "SELECT c.c_nationkey AS unique_id, CAST(o.o_orderdate AS DATE) AS ds, SUM(o.o_totalprice) AS y FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY c.c_nationkey, CAST(o.o_orderdate AS DATE)",
    "v_pred": "SELECT o.o_orderkey, o.o_custkey AS site_id, c.c_nationkey AS nation, o.o_orderdate AS datetime_hour, o.o_totalprice / 1000e0 AS actual, p.pred / 1000e0 AS predicted FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN (SELECT l_orderkey, SUM(l_extendedprice * (1 - l_discount)) AS pred FROM lineitem GROUP BY l_orderkey) p ON p.l_orderkey = o.o_orderkey",
    "v_pop": "SELECT n.n_name AS municipality, COUNT(*) * 1000 AS population FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY n.n_name",
}

_VIEW_ORDER = list(VIEW_SQL)
_VIEW_RE = re.compile(r"\bv_[a-z_]+\b")


def with_views(body: str) -> str:
    """Prefix ``body`` with the CTEs of every fixture view it mentions."""
    needed: set[str] = set()
    todo = set(_VIEW_RE.findall(body)) & set(VIEW_SQL)
    while todo:
        v = todo.pop()
        needed.add(v)
        todo |= (set(_VIEW_RE.findall(VIEW_SQL[v])) & set(VIEW_SQL)) - needed
    if not needed:
        return body
    ctes = ",\n".join(f"{v} AS ({VIEW_SQL[v]})" for v in _VIEW_ORDER if v in needed)
    body = body.strip()
    if body[:14].upper() == "WITH RECURSIVE":
        return f"WITH RECURSIVE {ctes},\n{body[14:].lstrip()}"
    if body[:4].upper() == "WITH":
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"
