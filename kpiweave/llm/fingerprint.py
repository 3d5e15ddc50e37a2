"""Merkle trees over paragraphs and sections of texts."""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiweave.llm.stage import parallelism, written

PIECE = 256
SECTION = 8
DIGITS = 16
ROWS_PER_RANGE = 100_000
BROADCAST_RANGES = 1_000_000  # of 12 bytes each; more are joined by a shuffle


def pieces(text: Column) -> Column:
    """Leaves: a paragraph (line), or its consecutive pieces of 256 code points; the line breaks are leaves as well, so
    that the leaves are the whole text."""
    return F.regexp_extract_all(text, F.lit(rf"[^\n]{{1,{PIECE}}}|\n+"), F.lit(0))


def leaves(text: Column) -> Column:
    """Digest and length of each leaf, as ``digest:length``."""
    return F.transform(
        pieces(text), lambda p: F.concat(F.substring(F.sha2(p, 256), 1, DIGITS), F.lit(":"), F.length(p).cast("string"))
    )


def sections(leaf: Column) -> Column:
    """Digest of each run of 8 leaves."""
    return F.transform(
        F.sequence(F.lit(0), F.floor(F.greatest(F.size(leaf) - 1, F.lit(0)) / SECTION).cast("int")),
        lambda i: F.substring(F.sha2(F.concat_ws(",", F.slice(leaf, i * SECTION + 1, F.lit(SECTION))), 256), 1, DIGITS),
    )


def root(section: Column) -> Column:
    return F.sha2(F.concat_ws(",", section), 256)


def tree(section: Column, leaf: Column) -> Column:
    """The tree as one string: ``root/section,section/leaf,leaf``. Equal roots mean equal texts; where roots differ, the
    sections and then the leaves that differ say where, as each leaf carries its length."""
    return F.concat_ws("/", root(section), F.concat_ws(",", section), F.concat_ws(",", leaf))


def weight(leaf: Column) -> Column:
    return F.aggregate(leaf, F.lit(0).cast("long"), lambda total, x: total + F.substring_index(x, ":", -1).cast("long"))


def likeness(a: Column, b: Column) -> Column:
    """Share of two trees' distinct leaves, by length, that are in both: 0 to 1, and 1 for two empty texts."""
    both = weight(F.array_intersect(a, b)) * 2
    all_ = weight(F.array_distinct(a)) + weight(F.array_distinct(b))
    return F.when(all_ == 0, 1.0).otherwise(both / all_)


def changed_spans(before: Column, after: Column) -> Column:
    """Where two leaf lists differ: (start, end) code points in the first text of what lies between the branches that
    agree from the front and those that agree from the back; null if equal."""
    n, m = F.size(before), F.size(after)
    same = lambda a, b: F.coalesce(
        F.array_position(F.transform(F.arrays_zip(a.alias("x"), b.alias("y")), lambda z: (~z["x"].eqNullSafe(z["y"])).cast("int")), 1), F.lit(0)
    ).cast("int")
    front = same(before, after)
    head = F.when(front == 0, F.least(n, m)).otherwise(front - 1)
    back = same(F.reverse(before), F.reverse(after))
    tail = F.least(F.when(back == 0, F.least(n, m)).otherwise(back - 1), F.least(n, m) - head)
    length = weight(before)
    return F.when(
        front > 0,
        F.struct(
            weight(F.slice(before, F.lit(1), head)).alias("start"),
            (length - weight(F.slice(before, n - tail + 1, tail))).alias("end"),
        ),
    )


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, fingerprint, root) of each text, whole. Null text is the empty text, which has one section without leaves."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    return (
        docs.select(F.col(id_column).alias("id"), leaves(text).alias("leaf"))
        .withColumn("section", sections(F.col("leaf")))
        .select("id", tree(F.col("section"), F.col("leaf")).alias("fingerprint"), root(F.col("section")).alias("root"))
    )


def id_ranges(ids: DataFrame, ranges: int) -> list[int]:
    """First id of each of about ``ranges`` ranges of like size, in descending order, without null.

    One number per range comes to the driver; Spark samples the bounds, and the ranges' heads are exact."""
    dealt = ids.where("id IS NOT NULL").repartitionByRange(ranges, F.col("id").desc())
    heads = dealt.groupBy(F.spark_partition_id().alias("range")).agg(F.max("id").alias("head"))
    return sorted({r["head"] for r in heads.collect()}, reverse=True)


def range_of(id_: Column, bounds: list[int]) -> Column:
    """Number of ``bounds`` (descending) that are at or above the id, by binary search; null ids come after all."""
    if not bounds:
        return F.when(id_.isNull(), 1).otherwise(0)
    array = F.array(*[F.lit(b).cast("long") for b in bounds])
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(bounds).bit_length()))])
    found = F.aggregate(
        steps, F.lit(0),
        lambda at, step: F.when((at + step <= len(bounds)) & (F.get(array, at + step - 1) >= id_), at + step).otherwise(at),
    )
    return F.when(id_.isNull(), len(bounds) + 1).otherwise(found)


def compare_with_next(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Each text's tree, that of the text with its second half overwritten by the next document, and how like they are.

    The next document is the one with the next lower id (null ids last; after the last comes the first). Of the text of n
    code points the last floor(n / 2) are replaced by the first as many of the next text, or all it has. Rows of one id
    follow one another by their texts, and so do equal rows; a document alone is its own next. Columns: id,
    n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, changed (span of the difference).

    Texts move once, into ranges of ids, where each finds its successor. The bounds come from the ids alone, one number
    for 100,000 rows. The first text of each range is fetched for the last row of the range before it."""
    base = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    ids = written(base.select("id"), "fingerprint-ids")
    count, nulls = ids.agg(F.count("*"), F.count_if(F.col("id").isNull())).first()
    bounds = id_ranges(ids, max(4 * parallelism(docs), math.ceil(count / ROWS_PER_RANGE)))
    ranges = [*enumerate(bounds, 1)] + [(len(bounds) + 1, None)] * (nulls > 0)
    pairs = [{"range": number, "id": ranges[(i + 1) % len(ranges)][1]} for i, (number, _) in enumerate(ranges)]
    listed = F.from_json(F.lit(json.dumps(pairs)), "array<struct<range: int, id: long>>")
    following = docs.sparkSession.range(1).select(F.inline(listed))
    following = F.broadcast(following) if len(ranges) <= BROADCAST_RANGES else following
    head_texts = (
        base.alias("b").join(following.alias("f"), F.col("b.id").eqNullSafe(F.col("f.id")))
        .groupBy("f.range").agg(F.min("b.text").alias("head_text"))
    )
    line = Window.partitionBy("range").orderBy(F.col("id").desc_nulls_last(), "text")
    joined = (
        base.withColumn("range", range_of(F.col("id"), bounds).cast("int")).repartition("range")
        .withColumn("leaf", leaves(F.col("text")))
        .withColumn("follower", F.lead(F.struct("text", "leaf")).over(line))
        .join(head_texts, "range", "left")
        .withColumn("next_text", F.when(F.col("follower").isNull(), F.col("head_text")).otherwise(F.col("follower.text")))
        .withColumn("next_leaf", F.when(F.col("follower").isNull(), leaves(F.col("head_text"))).otherwise(F.col("follower.leaf")))
        .withColumn("half", F.expr("cast(floor(length(text) / 2) as int)"))
        .withColumn("edited", F.expr("concat(substring(text, 1, length(text) - half), substring(next_text, 1, half))"))
        .withColumn("edited_leaf", leaves(F.col("edited")))
    )
    return joined.select(
        "id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        tree(sections(F.col("leaf")), F.col("leaf")).alias("fingerprint"),
        tree(sections(F.col("edited_leaf")), F.col("edited_leaf")).alias("edited_fingerprint"),
        likeness(F.col("leaf"), F.col("edited_leaf")).alias("near_edited"),
        likeness(F.col("leaf"), F.col("next_leaf")).alias("near_next"),
        changed_spans(F.col("leaf"), F.col("edited_leaf")).alias("changed"),
    )
