"""The corpus pipeline: each stage takes (spark, docs, sf_dir) and returns what it keeps of ``docs``.

All stages but the last return the columns of ``documents``, whatever columns those are; they work on rows, so a row that
comes twice is handled as two documents unless a stage says otherwise. An empty table passes through all stages empty."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiweave.llm import mixing, neardup, packing, quality, substrings
from kpiweave.llm.queries import ratings, table
from kpiweave.llm.stage import own_columns, written


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of a good grade is at least one half, after the ratings in ``labels``. Null and empty
    texts are judged by the model's cuts alone, that is by how common good grades are."""
    model = quality.learn(docs.select(F.col("doc_id").alias("id"), "text"), ratings(spark, sf_dir))
    return quality.scored(docs, model, prefix="__").where("__keep").select(*own_columns(docs))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts that are alike in 80% of their shingles of five words: the one of the least id, null
    ids last. Texts without words stay. Where ids are repeated or null, rows are told apart by a number written beside them."""
    id = F.col("doc_id").cast("long").alias("id")
    if docs.select(id).groupBy("id").agg(F.count("*").alias("n")).where("n > 1 OR id IS NULL").isEmpty():
        found = neardup.near_duplicates(docs, words=5, percent=80)
        kept = written(found.where("id = component_id").select(F.col("id").alias("__id")), "pipeline-kept")
        return docs.join(kept, docs["doc_id"] == kept["__id"]).select(*own_columns(docs))
    rows = written(docs.withColumn("__row", F.monotonically_increasing_id()), "pipeline-rows")
    found = neardup.near_duplicates(rows, words=5, percent=80, id_column="__row")
    order = F.struct(F.col("id").isNull(), "id", F.xxhash64("text"), "__row")
    named = found.select(F.col("id").alias("__row"), "component_id").join(rows.select("__row", id, "text"), "__row")
    first = named.groupBy("component_id").agg(F.min(order)["__row"].alias("__row"))
    return rows.join(written(first.select("__row"), "pipeline-kept"), "__row").select(*own_columns(docs))


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of passages of 35 words and more that also start elsewhere, with their lengths set anew.
    Rows stay even where nothing of their text does."""
    rest = substrings.without_repeats(docs, window=35)
    if "n_chars" in docs.columns:
        rest = rest.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return rest


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: sources weigh 3, 1, 2 in turn and share 150% of all words."""
    return mixing.emit(docs, weights=(3, 1, 2), share=1.5, limit=2.0)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 tokens; a document that comes twice is packed twice."""
    return packing.pack(docs).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality classifier", good_quality),
    ("near duplicates", without_near_copies),
    ("substring dedup", without_repeated_passages),
    ("mixing", mixed),
    ("packing", packed),
]

# Training, hashing and tokenization have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
