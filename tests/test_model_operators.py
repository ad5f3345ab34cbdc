"""Isolation forest over split series, exact silhouette and restarts, stored
artefacts, routed models: against plain versions, for any partitioning."""

import datetime as dt
import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from countpanel.operators import anomaly as NA
from countpanel.operators import artefact
from countpanel.operators import clusters as C
from countpanel.operators import models as M
from countpanel.operators import models_light as ML

SF01 = "/root/testdata/sf0.01"
REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _key(rows):
    return sorted((tuple(r) for r in rows), key=repr)


# N3 -----------------------------------------------------------------------
def _series(spark):
    rng = np.random.default_rng(5)
    base = dt.date(2024, 1, 1)
    rows = [(k, base + dt.timedelta(days=i), *map(float, rng.normal(size=3))) for k, n in (("x", 900), (None, 200), ("short", 59)) for i in range(n)]
    rows[10] = ("x", rows[10][1], 30.0, -30.0, 30.0)
    rows[11] = ("x", rows[11][1], None, 0.0, 0.0)
    rows[12] = ("x", rows[12][1], float("nan"), 0.0, 0.0)
    return rows, spark.createDataFrame(rows, "k string, ds date, a double, b double, c double")


def test_isolation_flags_for_split_series_and_any_partitioning(spark):
    rows, d = _series(spark)
    kw = dict(trees=40, sample=64, pool=256)
    runs = [_key(NA.isolation_flags(x, "k", "ds", ["a", "b", "c"], chunk_rows=n, **kw).collect()) for x, n in (
        (d, 20_000), (d.repartition(7), 100), (d.orderBy(F.col("a")).coalesce(1), 37))]
    assert runs[0] == runs[1] == runs[2] and len(runs[0]) == len(rows)
    flagged = {(r[0], r[1]) for r in runs[0] if r[3]}
    assert ("x", rows[10][1]) in flagged and 0 < len(flagged) < 0.05 * len(rows)
    assert not {k for k, _ in flagged} & {"short"} and (None in {k for k, _ in flagged})
    assert all(r[2] is None and r[3] == 0 for r in runs[0] if (r[0], r[1]) in {("x", rows[11][1]), ("x", rows[12][1])} or r[0] == "short")


def test_forest_equals_walking_node_by_node():
    rng = np.random.default_rng(3)
    x = np.c_[rng.normal(size=(300, 2)), np.ones(300), rng.integers(0, 3, 300)]
    left, feature, cut, path, roots = forest = NA.grow_forest(x, 20, 64, np.random.default_rng(1))
    assert 2 not in feature[left >= 0]  # a constant feature never splits

    def walk(v):
        out = []
        for at in roots:
            while left[at] >= 0:
                at = left[at] + (v[feature[at]] >= cut[at])
            out.append(path[at])
        return np.mean(out)
    assert np.allclose(NA.path_lengths(x, forest, step=7), [walk(v) for v in x])
    far = NA.path_lengths(np.array([[50.0, -50.0, 1.0, 2.0]]), forest)
    assert far[0] < NA.path_lengths(x, forest).mean() - 2
    assert NA.grow_forest(np.ones((5, 2)), 3, 256, rng)[0].tolist() == [-1, -1, -1]


# C3 -----------------------------------------------------------------------
def _silhouette(x, labels):
    far = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    out = []
    for i, c in enumerate(labels):
        own = labels == c
        if own.sum() == 1:
            out.append(0.0)
            continue
        a = far[i, own].sum() / (own.sum() - 1)
        b = min(far[i, labels == o].mean() for o in set(labels.tolist()) - {c})
        out.append((b - a) / max(a, b) if max(a, b) else 0.0)
    return np.array(out)


@pytest.mark.parametrize("tile", [3, 16, 1000])
def test_silhouette_equals_all_pairs(spark, tile):
    rng = np.random.default_rng(0)
    x = np.round(rng.normal(size=(60, 3)), 3)
    x[7] = x[8]
    labels = np.c_[rng.integers(0, 3, 60), np.r_[np.zeros(59), 1].astype(int), np.zeros(60, int)]
    d = spark.createDataFrame([(i, v.tolist(), *map(int, c)) for i, (v, c) in enumerate(zip(x, labels))] + [(99, None, 1, 1, 0), (98, [1.0, 1.0, 1.0], None, 1, 0)],
                              "id int, x array<double>, a int, b int, one int")
    got = {r.id: r for r in C.silhouette_rows(d, "id", "x", ["a", "b", "one"], tile).collect()}
    assert len(got) == 60 and {r.one for r in got.values()} == {None}
    for j, name in enumerate(("a", "b")):
        assert np.allclose([got[i][name] for i in range(60)], _silhouette(x, labels[:, j]))


def test_scan_finds_the_blobs_whatever_the_partitioning(spark):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(c, 0.2, (40, 2)) for c in ((0, 0), (5, 0), (0, 5), (5, 5))])
    d = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(999, None)], "id int, x array<double>")
    runs = [C.kmeans_scan(f, "id", "x", [2, 4, 200], n_init=5) for f in (d, d.repartition(9))]
    for k in (2, 4, 200):
        assert (runs[0][k][0] == runs[1][k][0]).all() and runs[0][k][1] == runs[1][k][1]
    centres, inertia = runs[0][4]
    assert abs(inertia - sum(((x[i * 40:i * 40 + 40] - x[i * 40:i * 40 + 40].mean(0)) ** 2).sum() for i in range(4))) < 1e-3
    table = {r.k: r for r in C.scan_k(d, "id", "x", [2, 3, 4], n_init=5).collect()}
    assert max(table, key=lambda k: table[k].silhouette) == 4 and table[4].inertia < table[3].inertia < table[2].inertia
    labels = np.array([r.c for r in C.assign(d.where("x is not null"), "x", {"c": centres}).orderBy("id").collect()])
    assert abs(table[4].silhouette - _silhouette(x, labels).mean()) < 1e-9
    assert C.scan_k(d.where("false"), "id", "x").collect() == []


# C9 / C10 -----------------------------------------------------------------
def test_cluster_means_and_profiles(spark):
    rows = [(i, i % 3 if i % 10 else None, float(i % 7), None if i % 4 else float(i), 5.0, None) for i in range(60)]
    d = spark.createDataFrame(rows, "i int, label int, a double, b double, same double, none double")
    pdf = d.toPandas()
    got = {(r.label, r.feature): r for r in C.cluster_means(d, "label", ["a", "b", "same", "none"]).collect()}
    assert set(k for k, _ in got) == {0, 1, 2}
    for (label, f), r in got.items():
        part, whole = pdf.loc[pdf.label == label, f].dropna(), pdf[f].dropna()
        assert r.n == len(part)
        if f == "none":
            assert r["mean"] is None and r.scaled_mean is None
        else:
            assert abs(r["mean"] - part.mean()) < 1e-9
            assert abs(r.scaled_mean - (0 if f == "same" else (part.mean() - whole.mean()) / whole.std(ddof=0))) < 1e-9
    prof = {(r.label, r.dimension, r.level): (r.mean_value, r.n) for r in C.cluster_profiles(
        d.where("label is not null"), "label", "a", {"odd": F.col("i") % 2, "b": F.when(F.col("b") > 30, "high")}).collect()}
    assert prof[0, "b", "high"][1] == ((pdf.label == 0) & (pdf.b > 30)).sum() and not [k for k in prof if k[2] is None]
    assert all(abs(v[0] - pdf[(pdf.label == k[0]) & (pdf.i % 2 == int(k[2]))].a.mean()) < 1e-9 for k, v in prof.items() if k[1] == "odd")


# S13 ----------------------------------------------------------------------
def _sites(spark, n=80):
    rng = np.random.default_rng(1)
    rows = [(i, float(rng.lognormal(3)), None if i % 9 == 0 else float(rng.normal()), 4) for i in range(n)]
    rows[5] = (5, float("nan"), 1.0, 4)
    return spark.createDataFrame(rows, "site_id int, size double, slope double, same int")


def test_scaler_equals_numpy(spark):
    d = _sites(spark)
    got = {r.site_id: r.v for r in artefact.SkewScaler(["size", "slope", "same"], ["size"]).fit(d).transform(d).select(
        "site_id", vector_to_array("features").alias("v")).collect()}
    rows = d.toPandas().sort_values("site_id")
    size, slope = np.log1p(rows["size"]), rows["slope"]
    want = [(v.fillna(v.median()) - v.fillna(v.median()).mean()) / v.fillna(v.median()).std(ddof=0) for v in (size, slope)]
    assert np.allclose([got[i] for i in rows.site_id], np.c_[want[0], want[1], np.zeros(len(rows))])


def test_fresh_session_scores_equal_rows_from_disk(spark, tmp_path):
    d = _sites(spark)
    out, model = M.site_clusters(d, "site_id", ["size", "slope", "same"], ["size"], k=3)
    want = sorted((r.site_id, r.cluster) for r in out.select("site_id", "cluster").collect())
    artefact.save(model, str(tmp_path / "model"))
    d.write.parquet(str(tmp_path / "rows"))
    code = f"""
import sys; sys.path.insert(0, {REPO!r})
from countpanel.session import get_session
from countpanel.operators import artefact
s = get_session("local[2]", 2)
rows = artefact.load({str(tmp_path / 'model')!r}).transform(s.read.parquet({str(tmp_path / 'rows')!r})).select("site_id", "cluster").collect()
print("ROWS", sorted((r.site_id, r.cluster) for r in rows))
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, check=True)
    assert f"ROWS {want}" in done.stdout


def test_stored_schema_and_format_are_checked(spark, tmp_path):
    d = _sites(spark)
    _, model = M.site_clusters(d, "site_id", ["size", "slope"], ["size"], k=2)
    with pytest.raises(ValueError, match="slope is missing"):
        model.transform(d.drop("slope"))
    with pytest.raises(ValueError, match="not a number"):
        model.transform(d.withColumn("slope", F.lit("x")))
    scaler = model.stages[0].copy()
    scaler._set(format=99)
    artefact.save(PipelineModel(stages=[scaler]), str(tmp_path / "m"))
    with pytest.raises(ValueError, match="format 99"):
        artefact.load(str(tmp_path / "m"))


# F14 / F9 ------------------------------------------------------------------
def test_routes_and_nested_fallback(spark):
    train = spark.createDataFrame([(1, "g", 2.0), (1, "g", 4.0), (2, "g", 9.0), (None, None, 7.0), (None, None, 5.0), (3, "h", None)],
                                  "k int, grp string, y double")
    test = spark.createDataFrame([(1, "g", 0), (2, "g", 1), (4, "g", 2), (5, "z", 3), (None, None, 4), (3, "h", 5), (6, None, 6)], "k int, grp string, i int")
    got = {r.i: (r.route, r.fallback, r.level) for r in ML.routes(train, test, "k", "y", "grp", min_rows=2).collect()}
    assert got == {0: ("known", 3.0, "key"), 1: ("unknown", 5.0, "group"), 2: ("unknown", 5.0, "group"), 3: ("unknown", 5.4, "all"),
                   4: ("known", 6.0, "key"), 5: ("unknown", 5.4, "all"), 6: ("unknown", 6.0, "group")}
    none = ML.routes(train.where("false"), test, "k", "y", "grp").collect()
    assert {(r.route, r.fallback, r.level) for r in none} == {("unknown", None, None)} and len(none) == 7


def test_models_behind_routes(spark):
    rng = np.random.default_rng(4)
    rows = [(k, "g", float(x), float(10 * k + 5 * x) + rng.normal() * 0.1) for k in range(4) for x in rng.uniform(0, 1, 60)]
    train = spark.createDataFrame(rows, "k int, grp string, x double, y double")
    test = spark.createDataFrame([(1, "g", 0.5, 12.5), (9, "g", 0.5, 17.5), (2, "g", None, 22.5)], "k int, grp string, x double, y double")
    mean = lambda d: (lambda rows: rows.withColumn("prediction", F.lit(100.0)))
    slope = lambda d: (lambda rows: rows.withColumn("prediction", 10.0 * F.col("k") + 5 * F.col("x")))
    got = {r.k: (r.route, r.level, round(r.prediction, 3)) for r in ML.route_models(
        train, test, "k", "y", "grp", slope, mean, F.col("x").isNotNull(), F.col("x").isNotNull(), 5).collect()}
    own = round(sum(r[3] for r in rows if r[0] == 2) / 60, 3)
    assert got == {1: ("known", "model", 12.5), 9: ("unknown", "model", 100.0), 2: ("known", "key", own)}


def test_registered_models_beat_their_baselines(spark):
    """Routed models against the site means; leaf-wise trees against the
    historical baseline of the same split (F6)."""
    from countpanel.fixtures import Fixtures
    from countpanel.plans.ml_plans import XS, _panel
    from countpanel.plans.registry import load_all

    fx, reg = Fixtures(spark, SF01), load_all()
    by = {r.route: r for r in reg["f14_route_models"].build(fx).collect()}
    assert by["all"].n == by["known"].n + by["unknown"].n and by["unknown"].n > 0
    assert by["known"].mae < by["known"].mae_fallback and by["all"].mae < by["all"].mae_fallback
    found = reg["f9_gbt_second"].build(fx).collect()[0].asDict()
    d = _panel(fx).dropna(subset=XS)
    cut = F.lit("2024-01-23").cast("timestamp_ntz")
    base = ML.historical_baseline(d.filter(F.col("datetime_hour") < cut), d.filter(F.col("datetime_hour") >= cut),
                                  ["site_id", "hour", "day_of_week"], "count")
    mae = base.agg(F.avg(F.abs(F.col("count") - F.col("baseline")))).first()[0]
    assert found["mae"] < mae


def test_silhouette_over_pairs_of_blocks(spark):
    """Many blocks, copies, and vectors that differ in the last digits only."""
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(size=(50, 9)), np.repeat(rng.normal(size=(3, 9)), 20, 0), np.full((9, 9), 1000.0) + rng.normal(size=(9, 9)) * 1e-7])
    labels = rng.integers(0, 3, len(x))
    d = spark.createDataFrame([(i, v.tolist(), int(c)) for i, (v, c) in enumerate(zip(x, labels))], "id int, x array<double>, c int")
    got = {r.id: r.c for r in C.silhouette_rows(d, "id", "x", ["c"], tile=4, block=30).collect()}
    assert np.allclose([got[i] for i in range(len(x))], _silhouette(x, labels), atol=1e-9)
    keyless = d.withColumn("id", F.when(F.col("id") != 7, F.col("id")))
    assert {r.id: r.c for r in C.silhouette_rows(keyless, "id", "x", ["c"], tile=4, block=30).collect()}.keys() == set(range(len(x))) - {7}
    a, b = x[:40], np.r_[x[100:], x[:5]]
    assert np.allclose(C.apart(a, b), np.sqrt(((a[:, None] - b) ** 2).sum(2)), rtol=1e-10, atol=0)
    assert C.silhouette_rows(d.where("false"), "id", "x", ["c"]).collect() == []
