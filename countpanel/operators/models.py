"""pyspark.ml based operators: clustering (C1-C5, C8-C10), regression and
forest / boosted models (F1-F3, F7-F9, F11, F15-F17, F19), one-hot (X8).

Every fit is a distributed ML job; the few driver loops (k scan, folds)
loop over a handful of model fits, never over data rows or entities.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countpanel.operators import clusters, forests
from countpanel.operators import quality as Q
from countpanel.operators import windows as W
from countpanel.operators.artefact import SkewScaler, SkewScalerModel
from countpanel.operators.clean import fill_median, median_stats
from countpanel.session import cut_lineage, small

# deeper trees have more nodes than Spark's forest adds up in a pass; on this many rows it takes minutes
DEEP, MANY_ROWS = 12, 200_000


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="skip").transform(df)


# C1 / C2 / C3 / C4 / C5 ---------------------------------------------------
def profile_clusters(profile: DataFrame, key: str, hours: Sequence[str], k: int = 4, seed: int = 42) -> DataFrame:
    """K-means on row-standardised hourly profiles (wide: one column per hour)."""
    arr = F.array(*[F.col(h).cast("double") for h in hours])
    m = F.aggregate(arr, F.lit(0.0), lambda a, v: a + v) / len(hours)
    d = profile.withColumn("_m", m)
    sd = F.sqrt(F.aggregate(arr, F.lit(0.0), lambda a, v: a + (v - F.col("_m")) * (v - F.col("_m"))) / len(hours))
    d = d.withColumn("_s", sd)
    d = d.withColumns({f"z_{h}": F.try_divide(F.col(h) - F.col("_m"), F.col("_s")) for h in hours}).fillna(0.0)
    d = assemble(d, [f"z_{h}" for h in hours])
    model = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster").fit(d)
    return model.transform(d).select(key, "cluster")


def site_pipeline(df: DataFrame, feats: Sequence[str], log_cols: Sequence[str], k: int = 2, seed: int = 42) -> PipelineModel:
    """log1p on skewed columns, median imputation, population z-score and
    k-means as one storable model."""
    df = cut_lineage(df)  # read by both fits
    scaler = SkewScaler(feats, log_cols).fit(df)
    d = cut_lineage(scaler.transform(df))
    return PipelineModel(stages=[scaler, KMeans(k=k, seed=seed, initSteps=5, featuresCol="features", predictionCol="cluster").fit(d)])


def site_feature_matrix(df: DataFrame, feats: Sequence[str], log_cols: Sequence[str], scaler: SkewScalerModel | None = None):
    """The scaled matrix and the fitted scaler, for reuse on other entities."""
    scaler = scaler or SkewScaler(feats, log_cols).fit(df)
    return scaler.transform(df), scaler


def site_clusters(df: DataFrame, key: str, feats: Sequence[str], log_cols: Sequence[str], k: int = 2,
                  seed: int = 42):
    """(rows with their cluster, the fitted pipeline)."""
    df = cut_lineage(df)  # read by the fits and by transform
    model = site_pipeline(df, feats, log_cols, k, seed=seed)
    return model.transform(df), model


def scan_k(d: DataFrame, key: str, ks: Sequence[int] = range(2, 8), n_init: int = 20, seed: int = 42) -> DataFrame:
    """Inertia and exact silhouette for several k, the best of ``n_init`` starts each."""
    return clusters.scan_k(d.select(key, vector_to_array("features").alias("x")), key, "x", ks, n_init, seed)


def order_labels(df: DataFrame, label: str, col: str, out: str = "label_ordered") -> DataFrame:
    """Relabel clusters 0..k-1 by increasing mean of ``col`` (stable labels)."""
    from pyspark.sql import Window

    means = df.groupBy(label).agg(F.avg(col).alias("_m"))
    means = means.withColumn(out, F.dense_rank().over(Window.orderBy("_m", label)) - 1).drop("_m")
    return df.join(F.broadcast(means), label)


# C8 ---------------------------------------------------------------------
def pca_space(fit_df: DataFrame, other: DataFrame | None = None, k: int = 2):
    model = PCA(k=k, inputCol="features", outputCol="pcs").fit(fit_df)
    proj = model.transform(other if other is not None else fit_df)
    proj = proj.withColumn("_a", vector_to_array("pcs")).withColumns(
        {f"pc{i + 1}": F.col("_a")[i] for i in range(k)}).drop("_a")
    return proj, [float(x) for x in model.explainedVariance]


# F1 / F2 / F3 -----------------------------------------------------------
def ridge(df: DataFrame, y: str, num: Sequence[str], cats: Sequence[str], alpha: float = 1.0) -> DataFrame:
    """Impute (median), standardise, one-hot, L2-penalised least squares;
    coefficients sorted by magnitude."""
    from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer

    imp = Imputer(inputCols=list(num), outputCols=[f"{c}_i" for c in num], strategy="median")
    va = VectorAssembler(inputCols=[f"{c}_i" for c in num], outputCol="num_vec")
    sc = StandardScaler(inputCol="num_vec", outputCol="num_sc", withMean=True, withStd=True)
    idx = [StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep") for c in cats]
    ohe = OneHotEncoder(inputCols=[f"{c}_idx" for c in cats], outputCols=[f"{c}_oh" for c in cats], dropLast=True)
    va2 = VectorAssembler(inputCols=["num_sc"] + [f"{c}_oh" for c in cats], outputCol="features")
    # sum-of-squares ridge (alpha * |w|^2) in Spark's parametrisation: Spark
    # averages the loss over n and scales the penalty by the label's sample
    # std, so regParam = alpha * sd(y) / n (two scalars from one aggregate)
    st = df.agg(F.count(y).alias("n"), F.stddev_samp(y).alias("sd")).first()
    n, sd = max(int(st["n"]), 1), float(st["sd"] or 1.0)
    lr = LinearRegression(featuresCol="features", labelCol=y, elasticNetParam=0.0, standardization=False,
                          regParam=alpha * sd / n)
    model = Pipeline(stages=[imp, va, sc, *idx, ohe, va2, lr]).fit(df)
    coefs = [float(c) for c in model.stages[-1].coefficients]
    names = list(num) + [f"{c}={label}" for c, stage in zip(cats, model.stages[3:]) for label in stage.labels]
    out = df.sparkSession.createDataFrame(list(zip(names, coefs)), "term string, coef double")
    return out.orderBy(F.abs("coef").desc(), "term")


def hash_split(df: DataFrame, key: str | Sequence[str], share: float = 0.8, seed: int = 42) -> DataFrame:
    """Deterministic random split by a hash of the key (partition independent)."""
    u = F.pmod(F.xxhash64(*[F.col(k) for k in ([key] if isinstance(key, str) else key)], F.lit(seed)),
               F.lit(1000000)) / 1000000.0
    return df.withColumn("is_train", u < share)


def forest(train: DataFrame, test: DataFrame, y: str, xs: Sequence[str], trees: int = 50, depth: int = 12,
           log_target: bool = False, seed: int = 42, min_instances: int = 10):
    """Random forest; with ``log_target`` trained on log1p(y), predictions
    expm1 and clipped at 0.  The training rows are stored once; their nodes are
    kept from level to level, so no row walks its trees from the root again.
    Trees deeper than ``DEEP`` on more than ``MANY_ROWS`` rows are grown by
    :mod:`forests`: the same learner, other random numbers."""
    lab = "_lab"
    tr = assemble(train.withColumn(lab, F.log1p(y) if log_target else F.col(y)), xs)
    tr = cut_lineage(tr.select("features", lab))
    te = assemble(test, xs)
    if depth > DEEP and (rows := tr.count()) > MANY_ROWS:
        m = forests.fit(tr, lab, rows, trees, depth, 0.6, min_instances, seed)
    else:
        m = RandomForestRegressor(featuresCol="features", labelCol=lab, numTrees=trees, maxDepth=depth, seed=seed,
                                  minInstancesPerNode=min_instances, featureSubsetStrategy="0.6", cacheNodeIds=True).fit(tr)
    p = m.transform(te)
    if log_target:
        p = p.withColumn("prediction", F.greatest(F.expm1("prediction"), F.lit(0.0)))
    return m, p


def boosted(train: DataFrame, test: DataFrame, y: str, xs: Sequence[str], order: str, depth: int = 6,
            step: float = 0.1, iters: int = 60, seed: int = 42):
    """Gradient-boosted trees on log1p(y) with early stopping on the last
    15 % of the training rows in time order (validation indicator)."""
    lab = "_lab"
    cut = train.agg(F.percentile_approx(F.unix_timestamp(F.col(order).cast("timestamp")), 0.85, 10000).alias("c"))
    tr = train.crossJoin(F.broadcast(cut)).withColumn(
        "_val", F.unix_timestamp(F.col(order).cast("timestamp")) > F.col("c")).drop("c")
    tr = assemble(tr.withColumn(lab, F.log1p(y)), xs)
    m = GBTRegressor(featuresCol="features", labelCol=lab, maxDepth=depth, stepSize=step, maxIter=iters,
                     validationIndicatorCol="_val", seed=seed).fit(tr)
    p = m.transform(assemble(test, xs)).withColumn("prediction", F.greatest(F.expm1("prediction"), F.lit(0.0)))
    return m, p


def importances(model, names: Sequence[str], spark, k: int = 10) -> DataFrame:
    imp = [float(x) for x in model.featureImportances.toArray()]
    rows = sorted(zip(names, imp), key=lambda t: (-t[1], t[0]))[:k]
    return spark.createDataFrame(rows, "feature string, importance double")


def folds(df: DataFrame, ts: str, spans: Sequence[tuple[str, str, str]]) -> list[tuple[DataFrame, DataFrame]]:
    """(train, test) of every (train_until, test_from, test_until)."""
    t, at = F.col(ts), lambda day: F.lit(day).cast("timestamp_ntz")
    return [(df.filter(t < at(until)), df.filter((t >= at(first)) & (t < at(last)))) for until, first, last in spans]


def walk_forward(df: DataFrame, ts: str, spans: Sequence[tuple[str, str, str]], fit) -> DataFrame:
    """Expanding-window folds: (train_until, test_from, test_until) per fold;
    ``fit(train, test) -> predictions`` is called once per fold."""
    out = []
    df = cut_lineage(df)  # every fold filters the same panel
    for i, (train, test) in enumerate(folds(df, ts, spans)):
        pred = fit(train, test)
        out.append(Q.evaluate(pred, "_y", "prediction").withColumn("fold", F.lit(i)))
    from functools import reduce
    return reduce(lambda a, b: a.unionByName(b), out)


def forecast_panel(daily: DataFrame, weather: DataFrame, key: str, ds: str, y: str, wcols: Sequence[str],
                   train_until: str, min_days: int, valid_until: str | None = None) -> DataFrame:
    """Global daily panel for a neural forecaster.

    Dates before ``train_until`` are train, up to ``valid_until`` validation,
    the rest test.  Series with too little training history are dropped.  The
    per-series z-score, the weather medians and the weather scale come from
    training rows only; missing weather takes the median in train and
    validation and 0 (the scaled mean) in the future."""
    cut = F.lit(train_until).cast("date")
    end = F.lit(valid_until or train_until).cast("date")
    keep = Q.min_history(daily, key, ds, y, min_days, train_until).select(key)
    d = daily.join(small(keep), key, "left_semi")
    stats = W.zscore_stats(d.filter(F.col(ds) < cut), [y], [key])
    d = W.zscore(d, [y], [key], stats=stats)
    d = d.join(weather, [key, ds], "left")
    d = d.withColumn("split", F.when(F.col(ds) < cut, "train").when(F.col(ds) < end, "validation").otherwise("test"))
    medians = median_stats(d.filter(F.col("split") == "train"), list(wcols))
    past = fill_median(d.filter(F.col("split") != "test"), list(wcols), medians)
    scale = W.zscore_stats(past.filter(F.col("split") == "train"), list(wcols))
    d = W.zscore(past.unionByName(d.filter(F.col("split") == "test")), list(wcols), stats=scale)
    return d.fillna(0.0, subset=list(wcols))
