"""Chained streams over several triggers: the watermark moves, windows close,
late rows and re-delivered rows meet the state of earlier triggers."""

import datetime as dt

from countpanel.operators import anomaly as NA
from countpanel.streaming import hourly as T

SCHEMA = "id int, site_id int, start_time timestamp_ntz, cnt double"
DAY = dt.datetime(2024, 1, 1)


def at(hour, minute=0):
    return DAY + dt.timedelta(hours=hour, minutes=minute)


class Feed:
    """A folder that gets one file per trigger."""

    def __init__(self, spark, root, make):
        self.spark, self.src, self.root, self.make, self.n = spark, f"{root}/in", f"{root}/out", make, 0

    def __call__(self, rows):
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{self.src}/{self.n}")
        self.n += 1
        stream = self.make(self.spark.readStream.schema(SCHEMA).parquet(f"{self.src}/*"))
        return sorted(tuple(r) for r in T.run_available_now(stream, "append", "t", root=self.root).collect())


def test_hourly_alerts_over_triggers(spark, tmp_path):
    """Alerts come out when their window closes, once; late readings change nothing."""
    expected = spark.createDataFrame([(s, h, 10.0) for s in (1, 2) for h in range(24)] + [(3, 5, 10.0)], "site_id int, hour int, expected double")
    feed = Feed(spark, tmp_path, lambda s: T.stream_hourly_alerts(s, expected, "site_id", "start_time", "cnt", 15.0, -8.0, "1 hour").select(
        "site_id", "window_start", "total_count", "error", "status"))
    assert feed([(1, 1, at(5), 20.0), (2, 1, at(5, 30), 8.0), (3, 2, at(5, 10), 1.0), (4, 3, at(5), 99.0), (5, 4, at(5), 99.0)]) == []
    surge, low = (1, at(5), 28.0, 18.0, "surge"), (2, at(5), 1.0, -9.0, "blockage")
    unusual = (3, at(5), 99.0, 89.0, "surge")  # site 4 has no expectation
    # the watermark reaches 7:00: the windows of five o'clock close in this trigger
    closed = feed([(6, 1, at(8), 10.0), (7, 2, at(7, 40), 10.0)])
    assert closed == sorted([surge, low, unusual])
    # late for a closed window; a second window closes as the watermark reaches 10:00
    got = feed([(8, 2, at(5, 50), 500.0), (9, 1, at(11), 1.0)])
    assert got == sorted([surge, low, unusual])  # seven and eight o'clock are as expected
    everything = [(1, at(5), 28.0), (2, at(5), 1.0), (3, at(5), 99.0), (1, at(8), 10.0), (2, at(7), 10.0)]
    batch = spark.createDataFrame(everything, "site_id int, window_start timestamp_ntz, total_count double")
    batch = batch.withColumn("error", batch.total_count - 10.0)
    queue = NA.investigation_queue(batch, "error", 15.0, -8.0, tiebreak=["site_id"])
    assert sorted((r.site_id, r.window_start, r.total_count, r.error, r.status) for r in queue.collect()) == got


def test_redelivery_in_a_later_trigger(spark, tmp_path):
    """A repeat within the delay is dropped against the state of an earlier
    trigger; once the watermark has passed, the state is gone and the repeat is
    itself too late."""
    feed = Feed(spark, tmp_path, lambda s: T.stream_dedupe(s, ["id"], "start_time", "1 hour"))
    first = [(1, 1, at(5), 1.0), (2, 1, at(5, 10), 2.0)]
    assert feed(first) == first
    more = [(3, 1, at(5, 30), 3.0)]
    assert feed([first[1], *more]) == first + more  # delivered again within the delay
    last = [(4, 1, at(9), 4.0)]
    assert feed(last) == first + more + last
    assert feed([first[0], (5, 1, at(9, 1), 5.0)]) == first + more + last + [(5, 1, at(9, 1), 5.0)]


def test_closed_windows_are_not_broadcast(spark, tmp_path):
    """A trigger that only moves the watermark has no new rows, but gives out every closed window of the state."""
    rows = [(1, 1, at(5), 30.0), (2, 2, at(5), 1.0), (3, 1, at(9), 1.0)]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/in/0")
    stream = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in/*")
    hours = spark.range(2_000_000).selectExpr("cast(id div 24 as int) as site_id", "cast(id % 24 as int) as hour", "10.0D as expected")
    alerts = T.stream_hourly_alerts(stream, hours, "site_id", "start_time", "cnt", 15.0, -8.0, "1 hour")
    q = (alerts.writeStream.format("parquet").option("path", f"{tmp_path}/data").option("checkpointLocation", f"{tmp_path}/checkpoint")
         .trigger(availableNow=True).outputMode("append").start())
    q.awaitTermination()
    assert q.lastProgress["batchId"] == 1 and q.lastProgress["numInputRows"] == 0
    plan = q._jsq.explainInternal(False)
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    got = spark.read.parquet(f"{tmp_path}/data").select("site_id", "total_count", "status").collect()
    assert sorted(map(tuple, got)) == [(1, 30.0, "surge"), (2, 1.0, "blockage")]


def test_state_is_kept_on_disk(spark, tmp_path):
    """The runner's streams keep their state out of the heap; the session's settings stay as they were."""
    before = {k: spark.conf.get(k, None) for k in T.STATE_ON_DISK}
    feed = Feed(spark, tmp_path, lambda s: T.stream_hourly(s, "site_id", "start_time", "cnt", "1 hour"))
    assert feed([(1, 1, at(5), 30.0), (2, 1, at(9), 1.0)]) == [(1, at(5), 30.0, 1)]
    assert list((tmp_path / "out" / "checkpoint" / "state").glob("*/*/*.zip"))
    assert {k: spark.conf.get(k, None) for k in T.STATE_ON_DISK} == before
