"""Registered queries of the corpus operators: each applies one operator to
its whole table and derives the contract's columns from the real outputs."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from countpanel.llm import (
    bpe, decontaminate, language, licenses, negatives, oracles, pii, quality, quality_trees, resample, simhash, substrings, toxicity, urls)
from countpanel.llm.common import materialize, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return deco


@register("op1_urls", oracles.URLS)
def op1_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url, by the rules or its path template."""
    found = urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"))
    return found.select(F.col("row.page_id").alias("page_id"), "host", "path", "rule", "verdict", "template",
                        F.round("purity", 9).alias("purity"))


def held_out(doc_id: Column, of: int, part: int) -> Column:
    """Whether a document belongs to the fold that is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % of == part, F.lit(False))


@register("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; fold 2 of 4 is not learned from."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), lambda i: ~held_out(i, 4, 2))
    found = toxicity.score(docs, model)
    return found.select(F.col("row.doc_id").alias("doc_id"), held_out(F.col("row.doc_id"), 4, 2).alias("held_out"),
                        "score", (F.col("score") >= 0.3).cast("int").alias("predicted"),
                        F.size("passages").alias("n_passages"))


@register("op3_licenses", oracles.LICENSES)
def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and templates in every document."""
    return licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


@register("op4_pii")
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document, by kind and place."""
    found = pii.spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = pii.of_kind(F.col("spans"), *pii.BASE)
    counts = [F.size(pii.of_kind(F.col("spans"), k)).cast("long").alias(f"n_{k}") for k in pii.BASE]
    return found.select(F.col("row.doc_id").alias("doc_id"), *counts,
                        F.sha2(pii.written(base), 256).alias("base_sha256"), pii.written(F.col("spans")).alias("spans"))


@register("op5_quality", oracles.QUALITY)
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored ledger of every document, judged by the base policy and by v1;
    kept_without names the rule whose ablation alone would keep the document."""
    book = materialize(quality.ledger(table(spark, sf_dir, "documents"), keep=["doc_id"]), "quality-ledger")
    return book.select(F.col("row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                       "n_repeat_words", (~quality.kept(F.col("mask"), "base")).alias("base_failed"),
                       quality.kept(F.col("mask"), "v1").alias("kept"), "mask", quality.only_rule(F.col("mask"), "v1").alias("kept_without"))


@register("op6_simhash")
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document (4-word shingles, 4 bits)."""
    found = simhash.components(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


@register("op7_substrings", oracles.SUBSTRINGS)
def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without its repeated 35-word windows."""
    found = substrings.remove_repeats(table(spark, sf_dir, "documents"), window=35)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@register("op8_language")
def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; fold 1 of 3 is not learned from."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs, lambda i: ~held_out(i, 3, 1))
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select(F.col("row.doc_id").alias("doc_id"), held_out(F.col("row.doc_id"), 3, 1).alias("held_out"),
                        "lang_pred", "score", F.array_join("languages", ",").alias("languages"))


@register("op9_decontaminate")
def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark items that each leaking document holds, and where."""
    found = decontaminate.scan(table(spark, sf_dir, "documents").select("doc_id", "text"),
                               table(spark, sf_dir, "benchmark"))
    return found.select(F.col("row.doc_id").alias("doc_id"), F.explode("hits").alias("hit")).select("doc_id", "hit.*")


@register("op10_bpe")
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and the bytes they decode to, as digests."""
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode(docs, ranks, public_tokenizers.PATTERN, decoded="decoded").select(
        F.col("row.doc_id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"), bpe.ids_sha256(F.col("ids")).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@register("op11_quality_trees")
def op11_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by boosted trees; fold 2 of 4 is not learned
    from."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_trees.fit(docs, table(spark, sf_dir, "labels"), lambda i: ~held_out(i, 4, 2))
    found = quality_trees.score(docs, model)
    return found.select(F.col("row.doc_id").alias("doc_id"), held_out(F.col("row.doc_id"), 4, 2).alias("held_out"),
                        "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@register("op12_negatives", oracles.NEGATIVES)
def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector; every seventh has its label
    moved on by one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", moved.alias("label"))
    return negatives.mine(vectors, F.col("id") % 100 == 0, scale=256.0, positives=5, negatives=5, window=(80, 100))


@register("op13_resample")
def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Draw of a tenth of the documents towards the benchmark's words."""
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), max_n=1, buckets=10_000,
                             min_words=20, share=(10, 100), seed=2024)


register("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
