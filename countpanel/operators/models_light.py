"""Model helpers that are plain DataFrame work: encodings (F5 + J10),
baselines (F6 + J11), blends (F10), splits (F12, F13), routing (F14),
label transitions and agreement (C6, C7)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countpanel.operators import windows as W
from countpanel.session import bounded, cut_lineage, small


# F5 / J10 ---------------------------------------------------------------
def fit_encodings(df: DataFrame, y: str, specs: Mapping[str, Sequence[str]]) -> dict[str, DataFrame]:
    """One mean table per key set; ``_global`` = mean of the first table's
    group means (mean of site means)."""
    tables = {name: df.groupBy(*keys).agg(F.avg(y).alias(name)) for name, keys in specs.items()}
    first = next(iter(specs))
    tables["_global"] = tables[first].agg(F.avg(first).alias("_global"))
    tables["_keys"] = {name: list(keys) for name, keys in specs.items()}  # type: ignore[assignment]
    return tables


def apply_encodings(df: DataFrame, enc: dict) -> DataFrame:
    """Left join every encoding table (broadcast when small), missing keys
    fall back to the global value."""
    out = df.crossJoin(bounded(enc["_global"]))
    for name, keys in enc["_keys"].items():
        out = W.join_null_safe(out, small(enc[name]), list(keys), "left").withColumn(name, F.coalesce(F.col(name), F.col("_global")))
    return out.drop("_global")


# F6 / J11 ---------------------------------------------------------------
def _mean(y: str, exact_scale: int | None):
    """Mean; with ``exact_scale`` (fixed-point input) an exact DECIMAL sum
    divided once, reproducible whatever the summation order."""
    if exact_scale is None:
        return F.avg(y)
    return F.sum(F.col(y).cast(f"decimal(38,{exact_scale})")).cast("double") / F.count(y)


def historical_baseline(train: DataFrame, score: DataFrame, keys: Sequence[str], y: str,
                        out: str = "baseline", exact_scale: int | None = None) -> DataFrame:
    table = train.groupBy(*keys).agg(_mean(y, exact_scale).alias(out))
    glob = train.agg(_mean(y, exact_scale).alias("_m"))
    return (W.join_null_safe(score, small(table), list(keys), "left").crossJoin(bounded(glob))
            .withColumn(out, F.coalesce(F.col(out), F.col("_m"))).drop("_m"))


# F10 --------------------------------------------------------------------
def best_blend(df: DataFrame, y: str, p1: str, p2: str,
               weights: Sequence[float] = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)) -> DataFrame:
    """MAE of w*p1 + (1-w)*p2 for every weight in one pass (one mean per
    weight, turned into rows at the end), best weight flagged."""
    mae = lambda w: F.avg(F.abs(F.col(y) - (F.lit(w) * F.col(p1) + (1 - F.lit(w)) * F.col(p2))))
    each = [F.struct(F.lit(float(w)).alias("w"), mae(float(w)).alias("mae")) for w in weights]
    m = df.agg(F.array(*each).alias("t")).select(F.explode("t").alias("t")).select("t.*")
    best = m.agg(F.min_by("w", F.struct("mae", "w")).alias("_best"))
    return m.crossJoin(bounded(best)).withColumn("best", F.col("w") == F.col("_best")).drop("_best")


# F12 / F13 --------------------------------------------------------------
def temporal_split(df: DataFrame, ts: str, cuts: Sequence[str], labels=("train", "validation", "test")) -> DataFrame:
    e = None
    for cut, lab in zip(cuts, labels):
        cond = F.col(ts) < F.lit(cut).cast(dict(df.dtypes)[ts])
        e = F.when(cond, F.lit(lab)) if e is None else e.when(cond, F.lit(lab))
    return df.withColumn("split", e.otherwise(F.lit(labels[len(cuts)])))


def ordered_split(df: DataFrame, keys: Sequence[str], order: str, share: float = 0.85, **kw) -> DataFrame:
    """Per key, rows at position >= floor(share * n) in time order are the
    inner validation set (positions come from the skew-safe counter)."""
    d = W.with_positions(df, list(keys), order, total="_n", **kw)
    part = F.when(F.col("_pos") >= F.floor(F.lit(share) * F.col("_n")), "inner_valid").otherwise("inner_train")
    return d.withColumn("part", part).drop("_pos", "_n")


# F14 --------------------------------------------------------------------
def route_known(train: DataFrame, test: DataFrame, key: str, y: str) -> DataFrame:
    """Entities seen in training get their own estimate; unseen ones the
    global fallback.  Known / unknown is a semi / anti split of one join."""
    per = train.groupBy(key).agg(F.avg(y).alias("_m"))
    glob = train.agg(F.avg(y).alias("_g"))
    d = W.join_null_safe(test, small(per), [key], "left").crossJoin(bounded(glob))
    return d.withColumns({"route": F.when(F.col("_m").isNotNull(), "known").otherwise("unknown"),
                          "pred": F.coalesce("_m", "_g")}).drop("_m", "_g")


def routes(train: DataFrame, test: DataFrame, key: str, y: str, group: str, min_rows: int = 1,
           exact_scale: int | None = None) -> DataFrame:
    """``test`` with route (known: at least ``min_rows`` training rows with a
    target; else unknown) and the nested fallback: the mean of the key, else of
    its group, else of all training rows, and the level it comes from."""
    d = train.where(F.col(y).isNotNull())
    known = d.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"), _mean(y, exact_scale).alias("_key_mean"))
    of_group = d.groupBy(group).agg(_mean(y, exact_scale).alias("_group_mean"))
    out = W.join_null_safe(W.join_null_safe(test, small(known), [key], "left"), small(of_group), [group], "left")
    out = out.crossJoin(bounded(d.agg(_mean(y, exact_scale).alias("_mean"))))
    is_known = F.coalesce(F.col("_rows") >= min_rows, F.lit(False))
    own = F.when(is_known, F.col("_key_mean"))
    return out.withColumns({
        "route": F.when(is_known, "known").otherwise("unknown"),
        "fallback": F.coalesce(own, "_group_mean", "_mean"),
        "level": F.when(own.isNotNull(), "key").when(F.col("_group_mean").isNotNull(), "group").when(F.col("_mean").isNotNull(), "all"),
    }).drop("_rows", "_key_mean", "_group_mean", "_mean")


def route_models(train: DataFrame, test: DataFrame, key: str, y: str, group: str, fit_known, fit_unknown, ready_known, ready_unknown,
                 min_rows: int = 1, out: str = "prediction") -> DataFrame:
    """Predictions of two models behind the routes, with the nested fallback.

    ``fit_known(train)`` and ``fit_unknown(train)`` return a function from a
    frame to the frame with ``out``; ``ready_*`` are conditions on a row (its
    route's features are there).  Known keys go to the first model, unknown ones
    to the second, and rows whose features are missing take the fallback.  The
    second model learns from all keys, without what only a known key has."""
    sent = routes(train, test, key, y, group, min_rows)
    known, unknown = F.col("route") == "known", F.col("route") == "unknown"
    ok = F.coalesce(F.when(known, ready_known).otherwise(ready_unknown), F.lit(False))
    sent = cut_lineage(sent.withColumn("_ok", ok))
    parts = [fit_known(train)(sent.where(known & F.col("_ok"))).withColumn("level", F.lit("model")),
             fit_unknown(train)(sent.where(unknown & F.col("_ok"))).withColumn("level", F.lit("model")),
             sent.where(~F.col("_ok")).withColumn(out, F.col("fallback"))]
    return reduce(DataFrame.unionByName, [p.select(*sent.columns, out) for p in parts]).drop("_ok")


# C6 / C7 ----------------------------------------------------------------
def transition_matrix(df: DataFrame, a: str, b: str, labels: Sequence[str]) -> DataFrame:
    """Rows: labels of the first period; one count column per later label."""
    return df.groupBy(a).agg(*[F.count_if(F.col(b) == x).alias(f"to_{x}") for x in labels])


def transitions(a: DataFrame, b: DataFrame, key: str, ma: str, mb: str, thr: float) -> DataFrame:
    d = a.join(b, key)
    la = F.when(F.col(ma) >= thr, "high").otherwise("low")
    lb = F.when(F.col(mb) >= thr, "high").otherwise("low")
    d = d.withColumns({"label_a": la, "label_b": lb})
    shift = (F.when(F.col("label_a") == F.col("label_b"), "stable")
             .when(F.col("label_b") == "high", "up").otherwise("down"))
    return d.withColumns({"shift": shift, "delta": F.col(mb) - F.col(ma),
                          "pct_change": (F.col(mb) - F.col(ma)) / (F.col(ma) + F.lit(1e-6)) * 100})


def label_agreement(df: DataFrame, a: str, b: str) -> DataFrame:
    """Adjusted Rand index and NMI (arithmetic normalisation) from the
    contingency table; only the (a, b) count table is materialised."""
    n = df.groupBy(a, b).agg(F.count(F.lit(1)).cast("double").alias("n"))
    ra = n.groupBy(a).agg(F.sum("n").alias("na"))
    rb = n.groupBy(b).agg(F.sum("n").alias("nb"))
    tot = n.agg(F.sum("n").alias("t"))
    c2 = lambda x: x * (x - 1) / 2
    sij = n.agg(F.sum(c2(F.col("n"))).alias("sij"))
    sa = ra.agg(F.sum(c2(F.col("na"))).alias("sa"), )
    sb = rb.agg(F.sum(c2(F.col("nb"))).alias("sb"))
    j = n.join(small(ra), a).join(small(rb), b).crossJoin(bounded(tot))
    mi = j.agg(F.sum(F.col("n") / F.col("t") * F.log(F.col("n") * F.col("t") / (F.col("na") * F.col("nb")))).alias("mi"))
    ha = ra.crossJoin(bounded(tot)).agg((-F.sum(F.col("na") / F.col("t") * F.log(F.col("na") / F.col("t")))).alias("ha"))
    hb = rb.crossJoin(bounded(tot)).agg((-F.sum(F.col("nb") / F.col("t") * F.log(F.col("nb") / F.col("t")))).alias("hb"))
    s = reduce(lambda x, y: x.crossJoin(bounded(y)), [sij, sa, sb, tot, mi, ha, hb])
    exp = F.col("sa") * F.col("sb") / (F.col("t") * (F.col("t") - 1) / 2)
    return s.select(((F.col("sij") - exp) / (0.5 * (F.col("sa") + F.col("sb")) - exp)).alias("ari"),
                    (F.col("mi") / ((F.col("ha") + F.col("hb")) / 2)).alias("nmi"))
