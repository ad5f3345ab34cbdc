"""Distributed exact quantiles equal Spark's percentile (whole-group) result."""

import pytest
from pyspark.sql import functions as F

from countpanel.operators.aggs import exact_quantiles


@pytest.mark.parametrize("accuracy", [20, 100, 100_000])
def test_matches_percentile(spark, fx, accuracy):
    d = fx.pred.withColumn("err", F.col("actual") - F.col("predicted"))
    # one hot group (a third of the rows) next to many small ones
    d = d.withColumn("g", F.when(F.col("o_orderkey") % 3 == 0, F.lit(-1)).otherwise(F.col("nation")))
    qs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = exact_quantiles(d, "err", qs, ["g"], accuracy=accuracy, distributed=True)
    ref = d.groupBy("g").agg(*[F.percentile("err", q).alias(f"q{int(round(q * 100))}") for q in qs])
    cols = [f"q{int(round(q * 100))}" for q in qs]
    a = {r["g"]: [round(r[c], 6) for c in cols] for r in got.collect()}
    b = {r["g"]: [round(r[c], 6) for c in cols] for r in ref.collect()}
    assert a == b


def test_ties_and_no_groups(spark, fx):
    d = fx.counts.withColumn("v", F.floor(F.col("cnt") / 5))  # many duplicates
    got = exact_quantiles(d, "v", [0.3, 0.5, 0.77], [], accuracy=50, distributed=True).collect()[0]
    ref = d.agg(*[F.percentile("v", q).alias(n) for q, n in [(0.3, "q30"), (0.5, "q50"), (0.77, "q77")]]).collect()[0]
    assert [round(got[c], 9) for c in ("q30", "q50", "q77")] == [round(ref[c], 9) for c in ("q30", "q50", "q77")]
