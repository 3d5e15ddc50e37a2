"""Registered queries: each applies one operator with production parameters to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiweave.llm import (
    divergence, fingerprint, hamming, langid, mixing, neardup, packing, quality, resampling, sharding, substrings, toxicity, urlfilter,
)
from kpiweave.session import prepare

RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, limit=2.0)
    return mixed.select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies"
    )


def op2_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).withColumnRenamed("id", "doc_id")


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return hamming.search(vectors, vectors.where("vec_id % 50 = 0"), k=10).withColumnsRenamed({"id": "vec_id"})


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80)
    return found.select(
        F.col("id").alias("doc_id"), "n_shingles", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("id"), quality.grade_of(F.col("quality"), F.col("toxic")).alias("grade")
    )


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.learn(docs.withColumnRenamed("doc_id", "id"), ratings(spark, sf_dir))
    return quality.scored(docs, model).drop("text")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urlfilter.judge(table(spark, sf_dir, "pages"), RULES)
    return judged.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digests(table(spark, sf_dir, "documents"), window=35).withColumnRenamed("id", "doc_id")


def op10_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    compared = fingerprint.compare_with_next(table(spark, sf_dir, "documents"))
    return compared.select(
        F.col("id").alias("doc_id"), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
        F.col("changed.start").alias("changed_start"), F.col("changed.end").alias("changed_end"),
    )


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned = sharding.assign(table(spark, sf_dir, "documents"), shards=16, carry=["doc_id"])
    return assigned.select(
        "doc_id", F.col("__size").alias("size"), F.col("__crc").alias("text_crc32"), F.lit(sharding.LAW).alias("law"),
        F.col("__shard").alias("shard"), F.col("__slot").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def op13_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resampling.draw(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=10)
    return drawn.withColumnRenamed("id", "doc_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    listed = [
        op1_mix_sources, op2_pack_sequences, op3_language_id, op4_toxicity, op5_url_filter, op6_exact_top_k, op7_near_duplicates,
        op8_quality, op9_substring_dedup, op10_merkle_fingerprints, op11_source_divergence, op12_shard_documents,
        op13_importance_resample,
    ]
    return {f.__name__: f for f in listed}
