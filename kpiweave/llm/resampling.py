"""Importance resampling toward a target distribution.

Weights come from an array: the words of all documents and of all target texts are counted into hashed buckets, each
bucket's gain (log ratio of the target's share to the corpus's) goes into an array of fixed length, and each document is
scored by looking its words up there, inside Spark's own expressions. A Gumbel key per document turns the weights into a
draw without replacement: the k largest scores.

Those k are found without sorting the corpus: a weighted median of the partitions' medians, each weighed by the
partition's remaining size, splits the remaining keys; the side that cannot hold the cutoff (at least a quarter of them)
is dropped, until few enough remain to settle the exact cutoff key. Only the winners are sorted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiweave.llm.stage import on_workers, written

# Fixed values of the contract: word characters, buckets, seed text of the Gumbel key, the share drawn.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# What lies between words before A-Z are lowered. Splitting there takes a tenth of the time of extracting the words.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
BUCKETS = 10_000
SEED = "2024"
PERCENT = 10
MIN_WORDS = 20
# Remaining keys that the selection settles on the driver at the end (a bound, not a share of the data).
FINISH = 10_000
KEY = ["__k1", "__k2", "__k3", "__k4"]


def pieces(text: Column) -> Column:
    """The words of a text (null: none), letters as they are."""
    return F.array_remove(F.split(F.coalesce(text.cast("string"), F.lit("")), BETWEEN), "")


def lowered(word: Column) -> Column:
    """A-Z lowered only; ``lower`` does the same on ASCII words, much faster."""
    return F.when(F.octet_length(word) == F.length(word), F.lower(word)).otherwise(F.translate(word, UPPER, LOWER))


def words(text: Column) -> Column:
    return F.transform(pieces(text), lowered)


def bucket_of(word: Column) -> Column:
    return F.pmod(F.crc32(word.cast("binary")), F.lit(BUCKETS))


def buckets(text: Column) -> Column:
    """The bucket of each word of a text, in order."""
    return F.transform(pieces(text), lambda w: bucket_of(lowered(w)))


def bucket_counts(texts: DataFrame, text: str = "text") -> DataFrame:
    """(bucket, n): words of all texts per bucket; partial counts are summed before the shuffle."""
    return texts.select(F.explode(buckets(F.col(text))).alias("bucket")).groupBy("bucket").agg(
        F.count("*").alias("n")
    )


def gains(docs: DataFrame, target: DataFrame, text: str = "text", target_text: str = "text") -> list[int]:
    """floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B)))) per bucket, B buckets, in doubles, computed by Spark.

    The array has ``BUCKETS`` entries whatever the data, so it is collected and sent with the plan."""
    spark = docs.sparkSession
    every = spark.range(BUCKETS).select(F.col("id").alias("bucket"))
    s = bucket_counts(docs, text).withColumnRenamed("n", "s")
    t = bucket_counts(target, target_text).withColumnRenamed("n", "t")
    table = every.join(s, "bucket", "left").join(t, "bucket", "left").fillna(0, ["s", "t"])
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    gain = F.floor(F.lit(1000.0) * F.ln(
        ((F.col("t") + 1).cast("double") * (F.sum("s").over(whole) + BUCKETS).cast("double"))
        / ((F.col("s") + 1).cast("double") * (F.sum("t").over(whole) + BUCKETS).cast("double"))
    ))
    found = {r["bucket"]: r["gain"] for r in table.select("bucket", gain.alias("gain")).collect()}
    return [int(found[b]) for b in range(BUCKETS)]


def scored(docs: DataFrame, table: list[int], id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_features, weight, score, eligible): weight the floored mean gain of the document's words (none: 0), score
    weight plus the Gumbel key floor(-1000 ln(-ln((h + 0.5) / 2^32))), h the first 8 hex digits of sha256 of
    ``2024:<id>`` (a null id reads as ''), eligible at least ``MIN_WORDS`` words."""
    lookup = F.array(*[F.lit(g) for g in table]).cast("array<long>")
    # A projection of its own: the text is split once for both the number of its words and the sum of their gains.
    found = docs.select(F.col(id_column).alias("id"), buckets(F.col(text)).alias("__buckets"))
    total = F.aggregate("__buckets", F.lit(0).cast("long"), lambda a, x: a + F.element_at(lookup, (x + 1).cast("int")))
    n = F.size("__buckets").cast("long")
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(SEED + ":"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    gumbel = F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0))))
    return (
        found.select(F.col("id").cast("long"), n.alias("n_features"), total.alias("__total"), gumbel.alias("__gumbel"))
        .withColumn("weight", F.when(F.col("n_features") == 0, F.lit(0).cast("long")).otherwise(
            F.expr("(__total - pmod(__total, n_features)) div n_features")))
        .select("id", "n_features", "weight", (F.col("weight") + F.col("__gumbel")).cast("long").alias("score"),
                (F.col("n_features") >= MIN_WORDS).alias("eligible"))
    )


def _key(df: DataFrame) -> DataFrame:
    """Ascending key of the draw order: score descending, id ascending with nulls last, then the row's own number."""
    return df.select(
        (-F.col("score")).alias("__k1"), F.col("id").isNull().cast("long").alias("__k2"),
        F.coalesce(F.col("id"), F.lit(0)).alias("__k3"), F.col("__row").alias("__k4"),
    )


def _below(bound: tuple[int, ...]) -> Column:
    return F.struct(*KEY) < F.struct(*[F.lit(v).cast("long") for v in bound])


def _above(bound: tuple[int, ...]) -> Column:
    return F.struct(*KEY) > F.struct(*[F.lit(v).cast("long") for v in bound])


def _medians(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per partition: its remaining count and the key of its middle element."""
    frames = [b for b in batches if len(b)]
    if not frames:
        return
    keys = pd.concat(frames, ignore_index=True)[KEY].to_numpy(dtype=np.int64)
    order = np.lexsort(keys.T[::-1])
    middle = keys[order[(len(keys) - 1) // 2]]
    yield pd.DataFrame([[len(keys), *middle.tolist()]], columns=["__n", *KEY])


def cutoff(keys: DataFrame, k: int) -> tuple[int, ...] | None:
    """The k-th smallest key (1-based) of ``keys`` by weighted median of medians; None when k is 0."""
    if k <= 0:
        return None
    low: tuple[int, ...] | None = None
    high: tuple[int, ...] | None = None
    need = k
    on_workers(keys)
    while True:
        remaining = keys
        if low is not None:
            remaining = remaining.where(_above(low))
        if high is not None:
            remaining = remaining.where(_below(high))
        medians = remaining.mapInPandas(_medians, "__n long, __k1 long, __k2 long, __k3 long, __k4 long").collect()
        total = sum(r["__n"] for r in medians)
        if total <= FINISH:
            rest = sorted(tuple(r) for r in remaining.collect())
            return rest[need - 1]
        ranked = sorted((tuple(r[c] for c in KEY), r["__n"]) for r in medians)
        seen = 0
        for middle, n in ranked:
            seen += n
            if 2 * seen >= total:
                break
        less = remaining.where(_below(middle)).count()
        if need <= less:
            high = middle
        elif need == less + 1:
            return middle
        else:
            need -= less + 1
            low = middle


def _numbered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Place of each row within its partition, in the order the rows come."""
    seen = 0
    for batch in batches:
        batch = batch.copy()
        batch["__local"] = np.arange(seen, seen + len(batch), dtype=np.int64)
        seen += len(batch)
        yield batch


def draw(
    docs: DataFrame, target: DataFrame, id_column: str = "doc_id", text: str = "text", target_text: str = "text",
    percent: int = PERCENT,
) -> DataFrame:
    """Every row of ``docs``: (id, n_features, weight, score, rank), rank 1, 2, 3... for the floor(percent N / 100)
    highest scores among the N rows with at least ``MIN_WORDS`` words, ties to the smaller id (null ids last, then the
    row's place in the input), null for the others.

    Null or empty texts have no words: weight 0, never drawn. Repeated rows are drawn as separate rows. An empty table
    gives no rows; an empty target gives every bucket the same target share. Extra columns are ignored."""
    table = gains(docs, target, text, target_text)
    rows = written(scored(docs, table, id_column, text).withColumn("__row", F.monotonically_increasing_id()), "draw-scored")
    candidates = rows.where("eligible")
    k = (percent * candidates.count()) // 100
    keys = written(_key(candidates), "draw-keys")
    last = cutoff(keys, k)
    if last is None:
        return rows.select("id", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank"))
    winners = keys.where(~_above(last)).orderBy(*KEY)
    numbered = written(
        on_workers(winners).withColumn("__part", F.spark_partition_id()).mapInPandas(
            _numbered, "__k1 long, __k2 long, __k3 long, __k4 long, __part int, __local long"
        ),
        "draw-winners",
    )
    # One row per partition of the sorted winners: their offsets are a prefix sum in one task.
    offsets = numbered.groupBy("__part").agg(F.count("*").alias("__n")).select(
        "__part", F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__offset")
    )
    ranks = numbered.join(offsets, "__part").select(F.col("__k4").alias("__row"), (F.col("__offset") + F.col("__local") + 1).alias("rank"))
    return rows.join(ranks, "__row", "left").select("id", "n_features", "weight", "score", F.col("rank").cast("long"))
