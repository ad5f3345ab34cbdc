"""One stored artefact of preprocessing and model.

``SkewScaler`` learns medians and, after log1p of the skewed columns and median
imputation, means and population deviations.  ``SkewScalerModel`` applies them
with built-in column functions only.  It writes and reads itself, so a
``PipelineModel`` of it and any model is one folder that a fresh session scores
from.  The folder carries a format version and the input schema; both are
checked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

FORMAT = 1


class _Columns(Params):
    inputCols = Param(Params._dummy(), "inputCols", "columns of the vector, in order", TypeConverters.toListString)
    logCols = Param(Params._dummy(), "logCols", "skewed columns: log1p first", TypeConverters.toListString)
    outputCol = Param(Params._dummy(), "outputCol", "the vector", TypeConverters.toString)

    def _logged(self, df: DataFrame) -> DataFrame:
        """Inputs as doubles, checked; NaN counts as missing."""
        logs = set(self.getOrDefault(self.logCols))
        for c in self.getOrDefault(self.inputCols):
            if c not in df.columns:
                raise ValueError(f"column {c} is missing")
            if not isinstance(df.schema[c].dataType, NumericType):
                raise ValueError(f"column {c} is {df.schema[c].dataType.simpleString()}, not a number")

        def number(c: str):
            x = F.col(f"`{c}`").cast("double")
            x = F.when(x > -1, F.log1p(x)) if c in logs else x
            return F.when(~F.isnan(x), x)

        return df.withColumns({f"_in_{c}": number(c) for c in self.getOrDefault(self.inputCols)})


class SkewScaler(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Fits medians, means and deviations in two aggregates.  The input is
    entity-sized (one row per site), as exact medians in one pass require."""

    def __init__(self, inputCols: Sequence[str] = (), logCols: Sequence[str] = (), outputCol: str = "features"):
        super().__init__()
        self._set(inputCols=list(inputCols), logCols=list(logCols), outputCol=outputCol)

    def _fit(self, df: DataFrame) -> SkewScalerModel:
        cols = self.getOrDefault(self.inputCols)
        d = self._logged(df)
        row = d.agg(*[F.percentile(f"_in_{c}", 0.5).alias(c) for c in cols]).first()
        medians = [0.0 if row[c] is None else float(row[c]) for c in cols]  # a column without values is all zeros
        full = [F.coalesce(F.col(f"_in_{c}"), F.lit(m)) for c, m in zip(cols, medians)]
        row = d.agg(*[f(x).alias(f"{name}{j}") for j, x in enumerate(full) for name, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
        means, stds = ([float(row[f"{name}{j}"] or 0.0) for j in range(len(cols))] for name in ("m", "s"))
        model = SkewScalerModel()
        model._set(inputCols=cols, logCols=self.getOrDefault(self.logCols), outputCol=self.getOrDefault(self.outputCol), medians=medians,
                   means=means, stds=stds, format=FORMAT)
        return model


class SkewScalerModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    medians = Param(Params._dummy(), "medians", "per input column", TypeConverters.toListFloat)
    means = Param(Params._dummy(), "means", "after imputation", TypeConverters.toListFloat)
    stds = Param(Params._dummy(), "stds", "population deviation after imputation", TypeConverters.toListFloat)
    format = Param(Params._dummy(), "format", "version of the stored form", TypeConverters.toInt)

    def _transform(self, df: DataFrame) -> DataFrame:
        cols, medians, means, stds = (self.getOrDefault(p) for p in (self.inputCols, self.medians, self.means, self.stds))
        d = self._logged(df)
        # a constant column scales to 0
        z = [(F.coalesce(F.col(f"_in_{c}"), F.lit(m)) - F.lit(mean)) / F.lit(std) if std else F.lit(0.0)
             for c, m, mean, std in zip(cols, medians, means, stds)]
        return d.withColumn(self.getOrDefault(self.outputCol), array_to_vector(F.array(*z))).drop(*[f"_in_{c}" for c in cols])


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    """The stored pipeline; an unknown format is an error."""
    model = PipelineModel.load(path)
    for stage in model.stages:
        if isinstance(stage, SkewScalerModel) and stage.getOrDefault(stage.format) != FORMAT:
            raise ValueError(f"stored in format {stage.getOrDefault(stage.format)}, this library reads {FORMAT}")
    return model
