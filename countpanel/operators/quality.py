"""Data-quality audits (Q1-Q9) and forecast verification."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countpanel.session import bounded


# Q1 / Q2 / Q3 -------------------------------------------------------------
def incomplete_days(df: DataFrame, key: str, ts: str, n: int = 24) -> DataFrame:
    """(key, day) pairs whose record count is not exactly ``n``."""
    return (df.groupBy(key, F.to_date(F.col(ts)).alias("day")).agg(F.count(F.lit(1)).alias("n_records"))
            .filter(F.col("n_records") != n))


def month_coverage(df: DataFrame, key: str, ts: str) -> DataFrame:
    """Days present per (key, month) against the days of the calendar month."""
    d = F.to_date(F.col(ts))
    return (df.groupBy(key, F.trunc(d, "month").alias("month"))
            .agg(F.count_distinct(d).alias("days_present"), F.max(F.dayofmonth(F.last_day(d))).alias("days_in_month"))
            .withColumn("complete", F.col("days_present") == F.col("days_in_month")))


def is_balanced(df: DataFrame, key: str) -> DataFrame:
    """Do all keys have the same number of records?  (count of counts)"""
    c = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return c.agg(F.count_distinct("n").alias("n_distinct_counts"), F.min("n").alias("min_records"),
                 F.max("n").alias("max_records"), (F.count_distinct("n") == 1).alias("balanced"))


# Q4 / Q5 / Q6 / Q7 / Q8 / Q9 -----------------------------------------------
def missing_hours(df: DataFrame, key: str, ts: str) -> DataFrame:
    """(key, hour) pairs absent from the global hourly range of the table.

    The one-row span is broadcast to the distinct keys and every key expands
    its own hourly sequence (a generator, not a product of two tables); the
    readings are then anti-joined on (key, hour).
    """
    span = df.agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))
    keys = df.select(key).distinct()
    grid = keys.crossJoin(bounded(span)).select(
        key, F.explode(F.sequence("_lo", "_hi", F.expr("INTERVAL 1 HOUR"))).alias(ts))
    return grid.join(df.select(key, ts), [key, ts], "left_anti")


def null_report(df: DataFrame) -> DataFrame:
    """Null count per column, long form, one aggregate pass."""
    s = [F.struct(F.lit(c).alias("column"), F.count_if(F.col(c).isNull()).alias("n_null")) for c in df.columns]
    return df.agg(F.array(*s).alias("_s")).select(F.inline("_s"))


def dup_count(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    cols = list(cols or df.columns)
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  (F.count(F.lit(1)) - F.count_distinct(F.struct(*cols))).alias("n_duplicates"))


def expected_rows(df: DataFrame, key: str, ts: str, per_day: int = 24) -> DataFrame:
    d = F.to_date(F.col(ts))
    return (df.agg(F.count_distinct(d).alias("n_days"), F.count_distinct(key).alias("n_keys"),
                   F.count(F.lit(1)).alias("n_rows"))
            .withColumn("expected_rows", F.col("n_days") * per_day * F.col("n_keys"))
            .withColumn("missing_rows", F.col("expected_rows") - F.col("n_rows")))


def coverage(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.avg(F.col(col).isNotNull().cast("double")).alias("coverage"))


def zero_share(df: DataFrame, col: str, by: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.avg((F.col(col) == 0).cast("double")).alias("zero_share"),
                               F.count(F.lit(1)).alias("n"))


def min_history(df: DataFrame, key: str, ts: str, col: str, n: int, until: str) -> DataFrame:
    """Keys with at least ``n`` non-null values before ``until``."""
    h = (df.filter(F.col(ts) < F.lit(until).cast("date")).groupBy(key)
         .agg(F.count(col).alias("n_history")).filter(F.col("n_history") >= n))
    return h


# V1 / V2 / V3 -------------------------------------------------------------
EPS = 2.220446049250313e-16


def verify(pairs: DataFrame, variables: Sequence[str], a_sfx: str = "_act", f_sfx: str = "_fc",
           by: Sequence[Column] = (), mape: str = "eps") -> DataFrame:
    """MAE, RMSE, MAPE, range-normalised MAE / RMSE per variable, long form.

    All variables are measured in one aggregate pass (a wide row per
    group, unpivoted with ``inline``); the range (max - min of the actual)
    is always global, even with ``by`` groups, from a one-row aggregate.
    """
    aggs = []
    for i, v in enumerate(variables):
        a, f = F.col(v + a_sfx), F.col(v + f_sfx)
        e = a - f
        ape = (F.abs(e) / F.greatest(F.abs(a), F.lit(EPS))) if mape == "eps" else F.when(a != 0, F.abs(e) / F.abs(a))
        aggs += [F.avg(F.abs(e)).alias(f"_mae{i}"), F.sqrt(F.avg(e * e)).alias(f"_rmse{i}"),
                 (F.avg(ape) * 100).alias(f"_mape{i}")]
    g = pairs.groupBy(*by).agg(*aggs, F.count(F.lit(1)).alias("_n"))
    keys = [c for c in g.columns if not c.startswith("_")]
    rng = pairs.agg(*[(F.max(v + a_sfx) - F.min(v + a_sfx)).alias(f"_r{i}") for i, v in enumerate(variables)])
    g = g.crossJoin(bounded(rng))
    rows = [F.struct(F.lit(v).alias("variable"), F.col(f"_mae{i}").alias("mae"), F.col(f"_rmse{i}").alias("rmse"),
                     F.col(f"_mape{i}").alias("mape"),
                     F.try_divide(F.col(f"_mae{i}") * 100, F.col(f"_r{i}")).alias("nmae_pct"),
                     F.try_divide(F.col(f"_rmse{i}") * 100, F.col(f"_r{i}")).alias("nrmse_pct"),
                     F.col("_n").alias("n")) for i, v in enumerate(variables)]
    return g.select(*keys, F.inline(F.array(*rows)))


def rel_error_by(pairs: DataFrame, a: str, f: str, by: Sequence[str]) -> DataFrame:
    """Mean relative error %, rows with a zero actual skipped."""
    rel = F.abs(F.col(a) - F.col(f)) / F.abs(F.col(a))
    return pairs.groupBy(*by).agg((F.avg(F.when(F.col(a) != 0, rel)) * 100).alias("mean_rel_error_pct"),
                                  F.count_if(F.col(a) != 0).alias("n_used"))


# V4 ---------------------------------------------------------------------
def event_scores(pairs: DataFrame, a: str, f: str, thr: float = 0.1, by: Sequence[Column] = (),
                 empty_score: float | None = None) -> DataFrame:
    """Precision / recall / F1 of "event above threshold" detection.

    Zero denominators give 0; with ``empty_score`` a group with no event
    at all (no actual and no forecast event) scores that value instead.
    """
    ea, ef = F.col(a) > thr, F.col(f) > thr
    g = pairs.groupBy(*by).agg(F.count_if(ea & ef).alias("tp"), F.count_if(~ea & ef).alias("fp"),
                               F.count_if(ea & ~ef).alias("fn"), F.count(F.lit(1)).alias("n"))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    p = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(0.0))
    r = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(F.lit(0.0))
    g = g.withColumns({"precision": p, "recall": r})
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(F.lit(0.0))
    g = g.withColumn("f1", f1)
    if empty_score is not None:
        empty = (tp + fp + fn) == 0
        g = g.withColumns({c: F.when(empty, F.lit(float(empty_score))).otherwise(F.col(c))
                           for c in ("precision", "recall", "f1")})
    return g


# V5 / V6 / V7 / V8 / V9 / V10 / V11 / V12 -----------------------------------
def site_errors(pairs: DataFrame, key: str, a: str, f: str, k: int = 5) -> DataFrame:
    """Per-entity MAE; the k best and k worst, tagged."""
    m = pairs.groupBy(key).agg(F.avg(F.abs(F.col(a) - F.col(f))).alias("mae"))
    best = m.orderBy(F.col("mae").asc(), F.col(key)).limit(k).withColumn("rank_group", F.lit("best"))
    worst = m.orderBy(F.col("mae").desc(), F.col(key)).limit(k).withColumn("rank_group", F.lit("worst"))
    return best.unionByName(worst)


def largest_errors(pairs: DataFrame, a: str, f: str, k: int, tiebreak: Sequence[str]) -> DataFrame:
    e = F.abs(F.col(a) - F.col(f))
    return pairs.withColumn("abs_error", e).orderBy(F.col("abs_error").desc(), *[F.col(t) for t in tiebreak]).limit(k)


def delta_features(pairs: DataFrame, variables: Sequence[str], a_sfx: str = "_act", f_sfx: str = "_fc") -> DataFrame:
    return pairs.withColumns({f"delta_{v}": F.col(v + f_sfx) - F.col(v + a_sfx) for v in variables})


def evaluate(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    """MAE, RMSE, R^2, explained variance, MAE / mean observed."""
    e = F.col(y) - F.col(p)
    g = df.groupBy(*by).agg(
        F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"),
        F.sum(e * e).alias("_sse"), F.var_pop(y).alias("_vy"), F.var_pop(e).alias("_ve"),
        F.count(F.lit(1)).alias("n"), F.avg(y).alias("_my"))
    return (g.withColumn("r2", 1 - F.try_divide(F.col("_sse"), F.col("_vy") * F.col("n")))
            .withColumn("explained_variance", 1 - F.try_divide(F.col("_ve"), F.col("_vy")))
            .withColumn("mae_over_mean", F.try_divide(F.col("mae"), F.col("_my")))
            .drop("_sse", "_vy", "_ve", "_my"))


def residuals(df: DataFrame, y: str, p: str) -> DataFrame:
    e = F.col(y) - F.col(p)
    return df.withColumns({"residual": e, "abs_error": F.abs(e), "signed_error": F.col(p) - F.col(y)})


def error_by(df: DataFrame, y: str, p: str, by: Sequence[Column]) -> DataFrame:
    e = F.col(y) - F.col(p)
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.avg(F.abs(e)).alias("mae"),
                               F.avg(e).alias("mean_error"), F.max(F.abs(e)).alias("max_abs_error"),
                               F.avg(y).alias("mean_actual"), F.avg(p).alias("mean_pred"))


def under_prediction(df: DataFrame, y: str, p: str, by: Sequence[Column]) -> DataFrame:
    """Profile of positive residuals (actual above prediction) only."""
    e = F.col(y) - F.col(p)
    return df.filter(e > 0).groupBy(*by).agg(F.avg(e).alias("mean_under"), F.count(F.lit(1)).alias("n_under"))


def compare_models(df: DataFrame, y: str, preds: Sequence[str]) -> DataFrame:
    """evaluate() for several prediction columns in one aggregate pass, one
    row per model (unpivoted with ``inline``)."""
    aggs = [F.count(F.lit(1)).alias("_n"), F.avg(y).alias("_my"), F.var_pop(y).alias("_vy")]
    for i, p in enumerate(preds):
        e = F.col(y) - F.col(p)
        aggs += [F.avg(F.abs(e)).alias(f"_mae{i}"), F.avg(e * e).alias(f"_mse{i}"), F.var_pop(e).alias(f"_ve{i}")]
    g = df.agg(*aggs)
    rows = [F.struct(F.col(f"_mae{i}").alias("mae"), F.sqrt(F.col(f"_mse{i}")).alias("rmse"),
                     (1 - F.try_divide(F.col(f"_mse{i}") * F.col("_n"), F.col("_vy") * F.col("_n"))).alias("r2"),
                     (1 - F.try_divide(F.col(f"_ve{i}"), F.col("_vy"))).alias("explained_variance"),
                     F.col("_n").alias("n"), F.try_divide(F.col(f"_mae{i}"), F.col("_my")).alias("mae_over_mean"),
                     F.lit(p).alias("model")) for i, p in enumerate(preds)]
    return g.select(F.inline(F.array(*rows)))
