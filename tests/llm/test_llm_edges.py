"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names, for every operator."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from kpiweave.llm import fingerprint, hamming, langid, mixing, neardup, packing, quality, substrings, toxicity, urlfilter

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, copies int, size int, component_id long, `set` string, "
    "key string, keep string, score double, leaf string, `range` int, label string, `odd.name` string"
)
LABELS = "doc_id long, quality int, toxic int, text string"


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("aeioubdfgklmnprst") for _ in range(rng.randint(2, 8))) for _ in range(n))


def document(doc_id, text, lang="en", source="s0"):
    return (doc_id, text, lang, source, len(text or ""), 7, 8, 9, "x", "y", "z", 0.5, "l", 3, "m", "o")


def frame(spark):
    long = prose(1, 60_000)
    rows = [
        document(1, None), document(2, ""), document(3, " \t\n "), document(4, "one"), document(5, "!!! 123 ???", None, None),
        document(None, "no id here", None), document(None, None, None, None), document(6, long), document(7, long + " and more"),
        document(8, prose(2, 80)), document(8, prose(2, 80)), document(8, prose(3, 80), "fr", "s1"), document(9, prose(2, 80).upper(), "en", "s1"),
        document(10, "x" * 50_000, "en", "s2"), document(11, "naïve café 東京 \U0001f600 " * 5, "fr", "s2"),
    ]
    rows += [document(100 + i, prose(50 + i, 40), "en" if i % 2 else "fr", f"s{i % 3}") for i in range(30)]
    return spark.createDataFrame(rows, SCHEMA)


def labels(spark):
    rows = [(100 + i, int(i % 3 > 0), int(i % 4 == 0), "t") for i in range(30)] + [(None, 1, 0, "t"), (5, None, None, "t"), (8, 0, 1, "t"), (8, 0, 1, "t")]
    return spark.createDataFrame(rows, LABELS)


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def ids(df, column="id"):
    return sorted((r[0] for r in df.select(column).collect()), key=lambda x: (x is None, x or 0))


def test_every_row_comes_out(spark, docs):
    expected = ids(docs, "doc_id")
    marked = labels(spark)
    model = quality.learn(docs.select(F.col("doc_id").alias("id"), "text"), marked.select(F.col("doc_id").alias("id"), F.col("quality").alias("grade")))
    for result in (
        mixing.mix(docs), langid.identify(docs), toxicity.judge(docs, marked), neardup.near_duplicates(docs),
        substrings.digests(docs), fingerprint.compare_with_next(docs), fingerprint.fingerprints(docs),
        quality.scored(docs, model).withColumnRenamed("doc_id", "id"),
    ):
        assert ids(result) == expected
    assert {r["id"] for r in packing.pack(docs).select("id").collect()} == set(expected)


def test_empty_tables(spark, none):
    no_labels = spark.createDataFrame([], LABELS)
    assert mixing.mix(none).count() == 0
    assert mixing.emit(none).columns == none.columns
    assert packing.pack(none).count() == 0
    assert langid.identify(none).count() == 0
    assert toxicity.judge(none, no_labels).count() == 0
    assert neardup.near_duplicates(none).count() == 0
    assert quality.scored(none, quality.learn(none.select(F.col("doc_id").alias("id"), "text"), no_labels.select(F.col("doc_id").alias("id"), F.col("quality").alias("grade")))).count() == 0
    assert substrings.digests(none).count() == 0
    assert fingerprint.compare_with_next(none).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert urlfilter.judge(pages, [("block", "net", "/")]).count() == 0
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert hamming.search(vectors, vectors).count() == 0


def test_nothing_to_learn_from(spark, docs):
    bare = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {tuple(r) for r in langid.identify(bare).select("lang_pred", "score").collect()} == {("und", 0.0)}
    no_labels = spark.createDataFrame([], LABELS)
    assert {r[0] for r in toxicity.judge(docs, no_labels).select("score").collect()} == {0.0}
    assert {r[0] for r in quality.scored(docs, None).select("tail").collect()} == {1.0}


def test_texts_without_letters_have_no_language(docs):
    found = {r["id"]: r["lang_pred"] for r in langid.identify(docs).where("id IN (1, 2, 3, 5)").collect()}
    assert set(found.values()) == {"und"}


def test_null_page_and_vector(spark):
    pages = spark.createDataFrame(
        [(1, None, None), (2, "no scheme", ""), (None, "http://A.net", None), (4, "http://A.net/?q", "<a href='//B.org/x'>"), (4, "http://A.net/?q", "<a href='//B.org/x'>")],
        "page_id long, url string, html string",
    ).withColumn("host", F.lit("clash")).withColumn("rule", F.lit(1))
    found = sorted(map(tuple, urlfilter.judge(pages, [("block", "net", "/")]).select("id", "host", "path", "rule", "verdict").collect()), key=str)
    assert found == sorted([
        (1, "", "", None, "allow"), (2, "", "", None, "allow"), (None, "a.net", "", None, "block"),
        (4, "a.net", "/", "net/", "block"), (4, "a.net", "/", "net/", "block"),
    ], key=str)
    vectors = spark.createDataFrame([(0, None), (1, []), (2, [1.0, -1.0]), (2, [1.0, -1.0]), (None, [1.0])], "vec_id long, embedding array<float>")
    found = hamming.search(vectors.withColumn("code", F.lit("clash")), vectors.where("vec_id = 1"), k=3)
    assert sorted(map(tuple, found.collect())) == [(1, 1, 2, 1), (1, 2, 2, 1)]


def test_pipeline_stages_keep_columns(spark, docs, tmp_path):
    labels(spark).write.parquet(str(tmp_path / "labels.parquet"))
    current = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        current = stage(spark, current, str(tmp_path))
        assert current.columns == docs.columns
        assert dict(current.dtypes) == dict(docs.dtypes)
    assert corpus_pipeline.STAGES[-1][1](spark, current, str(tmp_path)).count() > 0


def test_empty_pipeline(spark, none, tmp_path):
    spark.createDataFrame([], LABELS).write.parquet(str(tmp_path / "labels.parquet"))
    none.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
