"""Encodings (X6 dictionary codes, X8 one-hot)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countpanel.session import small


def fit_codes(df: DataFrame, key: str) -> DataFrame:
    """Sorted distinct keys -> 0..n-1 (the code table is kept and reused).

    Only the distinct key set is ranked; it is as large as the number of
    entities (sites), never as large as the fact table.
    """
    from countpanel.operators.windows import global_row_number

    keys = df.select(key).where(F.col(key).isNotNull()).distinct()
    coded = global_row_number(keys, [F.col(key)], "_rn")
    return coded.select(key, (F.col("_rn") - 1).cast("int").alias(f"{key}_code"))


def apply_codes(df: DataFrame, codes: DataFrame, key: str) -> DataFrame:
    """Attach codes; keys unseen at fit time get -1."""
    code = f"{key}_code"
    return (df.join(small(codes), key, "left")
            .withColumn(code, F.coalesce(F.col(code), F.lit(-1)).cast("int")))


def one_hot(df: DataFrame, cols: list[str], suffix: str = "_vec") -> DataFrame:
    """One-hot vectors; categories unseen at fit become the all-zero vector
    (the indexer gives them one slot past the known ones, which the encoder
    drops)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer

    idx = [StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep",
                         stringOrderType="alphabetAsc") for c in cols]
    ohe = OneHotEncoder(inputCols=[f"{c}_idx" for c in cols],
                        outputCols=[f"{c}{suffix}" for c in cols], dropLast=True)
    return Pipeline(stages=idx + [ohe]).fit(df)
