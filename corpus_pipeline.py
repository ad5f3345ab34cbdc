"""Pipeline over the documents: toxicity, SimHash near-duplicates, benchmark
decontamination, personal data, byte-level BPE.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept.  The first four return the columns of ``docs``; the last returns one row
per document with its token ids as digests.
"""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countpanel.llm import bpe, decontaminate, pii, simhash, toxicity
from countpanel.llm.common import materialize, table

TOXIC_SCORE = 0.3
SHINGLE, MAX_BITS = 4, 4
VOCABULARY = os.environ.get("COUNTPANEL_BPE", public_tokenizers.path("byte_bpe_50k.tiktoken"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under TOXIC_SCORE; the model learns from the
    labelled ones among ``docs``."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).where(F.col("score") < TOXIC_SCORE).select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints: the smallest doc_id."""
    return simhash.keep_first(docs, shingle=SHINGLE, max_bits=MAX_BITS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    found = decontaminate.scan(docs, table(spark, sf_dir, "benchmark"))
    return found.where(F.size("hits") == 0).select("row.*")


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; n_chars follows."""
    masked = pii.mask(docs)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document: their number and digest, and the digest of
    the bytes that they decode to."""
    ranks = bpe.load_ranks(VOCABULARY)
    return bpe.encode(docs.select("doc_id", "text"), ranks, public_tokenizers.PATTERN, decoded="decoded").select(
        F.col("row.doc_id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"), bpe.ids_sha256(F.col("ids")).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_copies),
    ("decontamination", drop_leaks),
    ("pii", mask_personal_data),
    ("bpe", encode),
]

#: The toxicity model and the fingerprints' hash are beyond SQL; tests compare
#: run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet in the shared
    folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
