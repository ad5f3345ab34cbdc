"""Counts within a radius and nearest positions: against brute force, in
crowded cells, among copies, and without a row per pair."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from countpanel.operators import joins as J
from countpanel.operators import near

KINDS = ["school", "park"]


def _town(seed, n, wide):
    rng = np.random.default_rng(seed)
    lat, lon = 50 + rng.normal(0, wide, n), 3 + rng.normal(0, wide, n)
    lat[: n // 4], lon[: n // 4] = 50.01, 3.01  # copies
    return np.round(lat, 4), np.round(lon, 4)


@pytest.mark.parametrize("metric", ["flat", "haversine"])
@pytest.mark.parametrize("group", [100])
def test_crowded_cell_is_dealt_and_equals_brute_force(spark, metric, group):
    (a, b), (y, x) = _town(1, 300, 0.03), _town(2, 400, 0.03)
    sites = spark.createDataFrame([(i, float(p), float(q)) for i, (p, q) in enumerate(zip(a, b))] + [(900, None, 3.0), (901, float("nan"), 3.0), (902, 80.0, 3.0)],
                                  "site_id long, lat double, lon double")
    poi = spark.createDataFrame([(i, KINDS[i % 2], float(p), float(q)) for i, (p, q) in enumerate(zip(y, x))] + [(900, None, 50.0, 3.0), (901, "park", None, 3.0)],
                                "poi_id long, kind string, lat double, lon double")
    apart = near.far(a[:, None], b[:, None], y, x, metric)
    found = near.counts_at(sites, poi, 3000.0, KINDS, metric, group)
    got = {r.site_id: (r.school, r.park) for r in sites.join(found, ["lat", "lon"]).collect()}
    for i in range(300):
        assert got.get(i, (0, 0)) == tuple((apart[i, k::2] <= 3000.0).sum() for k in range(2))
    assert not {900, 901, 902} & set(got)
    at = near.nearest_at(sites, poi.where("kind = 'park'"), 3000.0, metric, group)
    at = at.withColumn("d", J.distance_m(F.col("lat"), F.col("lon"), F.col("p_lat"), F.col("p_lon"), metric)).where("d <= 3000").groupBy("lat", "lon").agg(
        F.min("d").alias("d"))
    got = {r.site_id: r.d for r in sites.join(at, ["lat", "lon"]).collect()}
    best = apart[:, 1::2].min(1)
    assert set(got) == set(np.flatnonzero(best <= 3000.0).tolist()) and all(abs(d - best[i]) < 1e-6 for i, d in got.items())


@pytest.mark.parametrize("metric", ["flat", "haversine"])
def test_blocks_settle_most_pairs_of_distinct_positions(metric, monkeypatch):
    rng = np.random.default_rng(4)
    s, p = (np.array([50 + rng.random(4000) * 0.4, 3 + rng.random(4000) * 0.6]) for _ in range(2))
    apart = near.far(s[0][:, None], s[1][:, None], p[0], p[1], metric)
    seen, plain = [0], near.far

    def counted(*args):
        out = plain(*args)
        seen[0] += out.size
        return out

    monkeypatch.setattr(near, "far", counted)
    weight = np.stack([np.ones(4000), np.arange(4000.0)], 1)
    assert (near.count_group(s, p, weight, 15000.0, metric) == (apart <= 15000.0).astype(float) @ weight).all()
    assert seen[0] < 0.7 * apart.size
    seen[0] = 0
    assert (near.nearest_group(s, p, 15000.0, metric, 16) == apart.argmin(1)).all()
    assert seen[0] < 0.4 * apart.size


def _largest(node):
    """Most rows that any operator of an executed plan put out."""
    metric = node.metrics().get("numOutputRows")
    own = metric.get().value() if metric.isDefined() else 0
    inner = [node.executedPlan()] if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else []
    inner += [node.plan()] if node.getClass().getSimpleName().endswith("QueryStageExec") else []
    kids = node.children()
    return max([own, *map(_largest, inner), *[_largest(kids.apply(i)) for i in range(kids.size())]])


def test_no_row_per_pair(spark):
    """2,000 sites around 2,000 POIs: 4,000,000 pairs, of which none is a row."""
    lat, lon = F.col("id") % 50 / F.lit(1e4) + 50, F.floor(F.col("id") / 50) / F.lit(1e4) + 3
    sites = spark.range(2000).select(F.col("id").alias("site_id"), lat.alias("lat"), lon.alias("lon"))
    poi = spark.range(2000).select(F.col("id").alias("poi_id"), F.lit("park").alias("kind"), lat.alias("lat"), lon.alias("lon"))
    for df, want in ((J.count_within(sites, poi, 5000.0, ["park"]), 2000), (J.nearest(sites, poi, "park", 5000.0), 0.0)):
        assert {r[1] for r in df.collect()} == {want}
        assert _largest(df._jdf.queryExecution().executedPlan()) <= 20_000


def test_only_counts_are_exchanged_by_cell(spark):
    """All positions in one cell: an exchange by cell would bring them to one
    task.  Tables too large for a broadcast are played by the planner's limit."""
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    lat, lon = F.col("id") % 50 / F.lit(1e4) + 50, F.floor(F.col("id") / 50) / F.lit(1e4) + 3
    sites = spark.range(2000).select(F.col("id").alias("site_id"), lat.alias("lat"), lon.alias("lon"))
    poi = spark.range(2000).select(F.col("id").alias("poi_id"), F.lit("park").alias("kind"), lat.alias("lat"), lon.alias("lon"))
    try:
        found = near.counts_at(sites, poi, 5000.0, ["park"], "flat", 100), near.nearest_at(sites, poi, 5000.0, "haversine", 100)
        plans = [df._jdf.queryExecution().executedPlan().toString() for df in found]
    finally:
        spark.conf.set(limit, before)
    for plan in plans:
        lines = plan.split("\n")
        by_cell = [i for i, x in enumerate(lines) if re.search(r"Exchange hashpartitioning\(_cy#\d+L?, _cx#\d+L?, \d+\)", x)]
        assert by_cell and all("HashAggregate" in lines[i + 1] for i in by_cell)
