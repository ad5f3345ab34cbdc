"""Hard-negative mining against brute force."""

import math
import random

import pytest
from llm_cases import SF, by_row
from pyspark.sql import functions as F

from countpanel.llm import negatives
from countpanel.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<double>, label int, score string, v string, x string, ok string, anchor string"


def brute(rows, every, k=5, low=80):
    """Every anchor against every row in plain integers."""
    usable = [(i, [max(-2**63, min(2**63 - 1, math.floor(256 * x))) for x in v], c) for i, v, c in rows if None not in (i, v, c)
              and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    anchors = {}
    for i, v, c in sorted(usable, key=lambda r: (r[0], str(r[2]), r[1])):
        if i % every == 0:
            anchors.setdefault(i, (v, c))
    for i, (v, c) in anchors.items():
        scored = [(max(-2**63, min(2**63 - 1, sum(x * y for x, y in zip(v, w)))), j, e == c) for j, w, e in usable if j != i]
        for s, j, _ in sorted((r for r in scored if r[2]), key=lambda r: (-r[0], r[1]))[:k]:
            inside = sorted((r for r in scored if not r[2] and low * s <= 100 * r[0] <= 100 * s), key=lambda r: (-r[0], r[1]))
            out += [(i, j, rank, r[1], s, r[0]) for rank, r in enumerate(inside[:k], 1)]
    return out


def frame(spark, rows):
    floats = lambda v: v if v is None else [x if x is None else float(x) for x in v]
    return spark.createDataFrame([(i, floats(v), c, *[None] * 5) for i, v, c in rows], SCHEMA)


def mined(spark, rows, every=5, **kw):
    found = negatives.mine(frame(spark, rows), F.col("id") % every == 0, **kw)
    return by_row(found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def random_rows(seed, n, dims, labels, grain=None):
    rnd = random.Random(seed)
    point = lambda: rnd.gauss(0.3, 0.4) if grain is None else rnd.randint(-grain, grain) / 256
    return [(i, [point() * (1 + 4 * (j % 5 == 0)) for j in range(dims)], rnd.randrange(labels)) for i in range(n)]


@pytest.mark.parametrize("seed,n,dims,labels,grain", [(1, 300, 40, 3, None), (2, 400, 9, 2, 1), (3, 250, 64, 10, 40)])
def test_equals_brute_force(spark, seed, n, dims, labels, grain):
    """Random vectors, few distinct scores (ties), blocks smaller than the anchors."""
    rows = random_rows(seed, n, dims, labels, grain)
    want = by_row(brute(rows, 5))
    assert want
    assert mined(spark, rows) == want
    assert mined(spark, rows, block=25) == want


def test_defined_cases(spark):
    """Nulls, non-finite components, uneven and empty vectors, negative and
    zero scores, labels alone, repeated rows."""
    rows = random_rows(4, 60, 6, 3) + [
        (100, None, 1), (101, [1.0] * 6, None), (None, [1.0] * 6, 1), (102, [1.0, None, 0, 0, 0, 0], 1), (103, [float("nan")] * 6, 1),
        (104, [float("inf")] + [0.0] * 5, 1), (105, [], 1), (110, [0.5, 0.5], 2), (111, [0.4, 0.5, 0.1, 9.0, 9.0, 9.0, 9.0], 0),
        (115, [-1.0] * 6, 7), (120, [-1.0] * 6, 8), (121, [1.0] * 6, 8), (125, [0.0] * 6, 1)]
    assert mined(spark, rows) == by_row(brute(rows, 5))
    again = rows + rows[:7]
    assert mined(spark, again) == by_row(brute(again, 5))


def test_large_components(spark):
    """Scores beyond doubles' whole numbers, and beyond long."""
    rows = [(i, [s * (10.0 ** e) + i, 3.0], i % 2) for i, (s, e) in enumerate([(1, 6), (1, 6), (3, 6), (1, 13), (2, 13), (1, 300), (1, 300), (1, 16)])]
    assert mined(spark, rows, every=1) == by_row(brute(rows, 1))


def test_empty(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 1)]) == []
    assert mined(spark, [(5, [1.0], 1)]) == []


def test_bitmap_shrinks():
    """Rows fall out of the candidates long before all dimensions are read."""
    import numpy as np

    rng = np.random.default_rng(0)
    data = np.floor(256 * rng.normal(0, 0.01, (64, 5000))).astype(np.int64)
    data[:3] = np.floor(256 * rng.normal(0, 1, (3, 5000)))
    looked = []

    def narrow(low, high):
        looked.append(len(low))
        return high >= np.sort(low)[-5]

    anchor = np.r_[[200, 180, 160], np.full(61, 2)]
    rows, scores = negatives.Columns(data).scan(anchor, np.arange(5000), narrow)
    assert looked[0] == 5000 and looked[1] < 100
    whole = anchor @ data
    assert sorted(scores.tolist())[-5:] == sorted(whole.tolist())[-5:] and (whole[rows] == scores).all()


def test_query_equals_brute_force(spark, duck):
    rows = [(i, v, (c + 1) % 10 if i % 7 == 0 else c) for i, v, c in duck.sql(
        f"select vec_id, embedding::double[], label from '{SF}/embeddings.parquet'").fetchall()]
    assert by_row(QUERIES["op12_negatives"](spark, SF).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                                                              "negative_score").collect()) == by_row(brute(rows, 100))
