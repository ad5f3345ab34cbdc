"""Wave 7: streaming operators run with availableNow, compared to batch SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from countpanel.plans.registry import query
from countpanel.streaming import hourly as T

EVENTS_DDL = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def _counts_stream(fx):
    ev = T.read_stream(fx.spark, fx.sf_dir, "events", EVENTS_DDL)
    return ev.select("event_id", F.col("user_id").alias("site_id"),
                     F.when(F.col("event_id") % 2 == 0, "IN").otherwise("OUT").alias("direction"),
                     F.col("ts").alias("start_time"), F.col("value").alias("cnt"))


@query("t1_stream_hourly", """
SELECT site_id, date_trunc('hour', start_time) AS window_start, ROUND(SUM(cnt), 6) AS total_count, COUNT(cnt) AS n_obs
FROM v_counts GROUP BY 1, 2
""")
def t1(fx):
    """Tumbling hourly counts with a watermark, last version of each window."""
    s = T.stream_hourly(_counts_stream(fx), "site_id", "start_time", "cnt", "2 hours")
    out = T.run_available_now(s, "update", "t1", keys=["site_id", "window_start"])
    return out.withColumn("total_count", F.round("total_count", 6))


@query("t2_stream_alerts", """
WITH e AS (SELECT site_id, AVG(cnt) AS expected FROM v_counts GROUP BY 1)
SELECT c.event_id, c.site_id, ROUND(c.cnt - e.expected, 9) AS error,
       CASE WHEN c.cnt - e.expected > 15 THEN 'surge' ELSE 'blockage' END AS status
FROM v_counts c JOIN e ON c.site_id = e.site_id WHERE c.cnt - e.expected > 15 OR c.cnt - e.expected < -8
""")
def t2(fx):
    """Readings stream joined to a static expectation table; alerts out."""
    expected = fx.counts.groupBy("site_id").agg(F.avg("cnt").alias("expected"))
    s = T.stream_alerts(_counts_stream(fx), expected, "site_id", "cnt", 15.0, -8.0)
    out = T.run_available_now(s.select("event_id", "site_id", "error", "status"), "append", "t2")
    return out.withColumn("error", F.round("error", 9))


@query("t3_stream_dedupe", "SELECT event_id, site_id, start_time, cnt FROM v_counts")
def t3(fx):
    """Every reading delivered twice; duplicates dropped within the watermark."""
    s = _counts_stream(fx)
    twice = s.unionByName(_counts_stream(fx))
    d = T.stream_dedupe(twice, ["event_id"], "start_time", "1 hour")
    return T.run_available_now(d.select("event_id", "site_id", "start_time", "cnt"), "append", "t3")


@query("t1_stream_hourly_append", """
SELECT site_id, date_trunc('hour', start_time) AS window_start, ROUND(SUM(cnt), 6) AS total_count, COUNT(cnt) AS n_obs
FROM v_counts GROUP BY 1, 2
HAVING date_trunc('hour', start_time) + INTERVAL 1 HOUR <= (SELECT MAX(start_time) FROM v_counts) - INTERVAL 2 HOUR
""")
def t1_append(fx):
    """Append mode: a window is emitted once the watermark (latest event
    time - 2 hours) passes its end; state for closed windows is dropped."""
    s = T.stream_hourly(_counts_stream(fx), "site_id", "start_time", "cnt", "2 hours")
    out = T.run_available_now(s, "append", "t1_append")
    return out.withColumn("total_count", F.round("total_count", 6))


@query("t2_hourly_alerts", """
WITH h AS (SELECT site_id, date_trunc('hour', start_time) AS window_start, SUM(cnt) AS total_count, COUNT(cnt) AS n_obs FROM v_counts GROUP BY 1, 2),
e AS (SELECT site_id, hour(window_start) AS hour, AVG(total_count) AS expected FROM h GROUP BY 1, 2)
SELECT h.site_id, window_start, h.n_obs, ROUND(total_count, 6) AS total_count, ROUND(total_count - expected, 6) AS error,
       CASE WHEN total_count - expected > 15 THEN 'surge' ELSE 'blockage' END AS status
FROM h JOIN e ON h.site_id = e.site_id AND hour(window_start) = e.hour
WHERE (total_count - expected > 15 OR total_count - expected < -8)
  AND window_start + INTERVAL 1 HOUR <= (SELECT MAX(start_time) FROM v_counts) - INTERVAL 2 HOUR
""")
def t2_hourly(fx):
    """Hourly windows as they close, against the usual total of the hour."""
    hourly = fx.counts.groupBy("site_id", F.date_trunc("hour", "start_time").alias("w")).agg(F.sum("cnt").alias("total"))
    expected = hourly.groupBy("site_id", F.hour("w").alias("hour")).agg(F.avg("total").alias("expected"))
    s = T.stream_hourly_alerts(_counts_stream(fx), expected, "site_id", "start_time", "cnt", 15.0, -8.0)
    out = T.run_available_now(s.select("site_id", "window_start", "n_obs", "total_count", "error", "status"), "append", "t2_hourly")
    return out.withColumns({c: F.round(c, 6) for c in ("total_count", "error")})
