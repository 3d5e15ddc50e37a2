"""Sharding by a two-pass external shuffle.

Pass one scatters every record into one of B buckets by a seeded hash of its row, B chosen from the row count so that a
bucket fits in a task's memory whatever the size of the corpus. Pass two puts each bucket in a random order by
Fisher-Yates, with a generator seeded by (seed, bucket), and numbers the records of the buckets one after the other. A
record's global place p then gives its shard (p mod n) and its slot there (p div n): law ``rows``, shard counts at most
one apart, slots gapless from 0.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiweave.llm.stage import on_workers, written

SHARDS = 16
SEED = 2024
# Records per bucket of the second pass: a bucket travels as one pandas frame of its records, so this bounds a task's
# memory; the number of buckets grows with the rows.
BUCKET_ROWS = 20_000
LAW = "rows"


def permutation(n: int, seed: int, bucket: int) -> np.ndarray:
    """Fisher-Yates: place of each of n records, read in their sorted order, after shuffling with the seeded generator.

    Swaps run from the last position down; the draw for position i is uniform on 0..i."""
    order = np.arange(n, dtype=np.int64)
    if n > 1:
        draws = np.random.Generator(np.random.PCG64([seed, bucket])).integers(0, np.arange(n - 1, 0, -1) + 1)
        for i, j in zip(range(n - 1, 0, -1), draws.tolist()):
            order[i], order[j] = order[j], order[i]
    place = np.empty(n, dtype=np.int64)
    place[order] = np.arange(n, dtype=np.int64)
    return place


def _shuffle_bucket(seed: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("__row", kind="stable").reset_index(drop=True)
        bucket = int(frame["__bucket"].iloc[0])
        frame["__place"] = permutation(len(frame), seed, bucket)
        return frame

    return run


def assign(
    docs: DataFrame, shards: int = SHARDS, seed: int = SEED, bucket_rows: int = BUCKET_ROWS, text: str = "text",
    carry: list[str] | None = None,
) -> DataFrame:
    """``carry`` columns of ``docs`` (default all) with ``__size`` (UTF-8 bytes of the text plus 1; null text has none),
    ``__crc`` (unsigned crc32 of the text's UTF-8 bytes; null text: of no bytes, 0), ``__shard`` (0 to shards - 1) and
    ``__slot`` (the record's place in its shard, gapless from 0).

    Every row is a record of its own: repeated rows and groups of equal texts are spread like any others, since the
    scatter hashes the row's own number, not its content. Null ids stay. An empty table gives an empty result. Columns
    of ``docs`` named like the added ones are replaced. The result depends on the seed, the rows and their order in the
    input, so reruns over the same files agree."""
    carried = [c for c in (docs.columns if carry is None else carry) if c not in ("__size", "__crc", "__shard", "__slot")]
    raw = F.encode(F.coalesce(F.col(text).cast("string"), F.lit("")), "UTF-8")
    # Records travel under plain names, whatever signs the given names hold.
    rows = written(
        docs.select(
            *[F.col("`" + c.replace("`", "``") + "`").alias(f"__c{i}") for i, c in enumerate(carried)],
            (F.octet_length(raw) + 1).cast("long").alias("__size"),
            F.crc32(raw).alias("__crc"),
            F.monotonically_increasing_id().alias("__row"),
        ),
        "shard-rows",
    )
    total = rows.count()
    buckets = max(1, -(-total // bucket_rows))
    scattered = rows.withColumn("__bucket", F.pmod(F.xxhash64(F.lit(seed), "__row"), F.lit(buckets)).cast("long"))
    schema = T.StructType(scattered.schema.fields + [T.StructField("__place", T.LongType(), False)])
    shuffled = written(
        on_workers(scattered).groupBy("__bucket").applyInPandas(_shuffle_bucket(seed), schema), "shard-shuffled"
    )
    # One row per bucket, a row count over BUCKET_ROWS records: the prefix sum runs in one task.
    sizes = shuffled.groupBy("__bucket").agg(F.count("*").alias("__n"))
    offsets = sizes.select(
        "__bucket",
        (F.sum("__n").over(Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1))).alias("__offset"),
    ).fillna(0, ["__offset"])
    placed = shuffled.join(offsets, "__bucket").withColumn("__global", F.col("__offset") + F.col("__place"))
    return placed.select(
        *[F.col(f"__c{i}").alias(c) for i, c in enumerate(carried)],
        "__size", "__crc",
        (F.col("__global") % shards).cast("int").alias("__shard"),
        F.expr(f"__global div {shards}").alias("__slot"),
    )


def write(assigned: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Write each shard as its own folder ``__shard=k`` with its records in slot order."""
    (
        assigned.repartition(shards, "__shard")
        .sortWithinPartitions("__shard", "__slot")
        .write.mode("overwrite")
        .partitionBy("__shard")
        .parquet(path)
    )
