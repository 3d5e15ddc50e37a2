"""Bounded, repeatable samples of labelled documents as sparse n-gram features on the driver."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiweave.llm.ngrams import sparse
from kpiweave.llm.stage import on_workers

FOLDS = 5


def held_out(id_: Column) -> Column:
    """Whether crc32 of the id as text is divisible by 5; false for null."""
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def learnable(id_: Column) -> Column:
    return id_.isNotNull() & ~held_out(id_)


def sample_ids(labelled: DataFrame, per_label: int) -> DataFrame:
    """Up to ``per_label`` distinct ids of each label from (id, label), those with the lowest hash."""
    first = Window.partitionBy("label").orderBy("h", "id")
    return (
        labelled.where("label IS NOT NULL").withColumn("h", F.xxhash64("id", F.lit("sample"))).dropDuplicates(["label", "h", "id"])
        .withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= per_label).select("id", "label")
    )


def features(
    docs: DataFrame, ids: DataFrame, normal: Callable[[str | None], bytes], sizes: tuple[int, ...], bits: int
) -> list[tuple[object, np.ndarray, np.ndarray]]:
    """(label, buckets, shares) of the sampled documents (id, text), in the order of their ids.

    ``ids`` is a bounded sample, so it is broadcast. Texts are read whole on the executors; at most 2**bits buckets of a
    document come to the driver."""

    def extract(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [sparse(normal(t), sizes, bits) for t in frame["text"]]
            yield pd.DataFrame({
                "id": frame["id"], "label": frame["label"],
                "buckets": [b.tobytes() for b, _ in found], "shares": [s.tobytes() for _, s in found],
            })

    label = ids.schema["label"].dataType.simpleString()
    rows = (
        on_workers(docs).join(F.broadcast(ids), "id").select("id", "label", "text")
        .mapInPandas(extract, f"id long, label {label}, buckets binary, shares binary")
        .collect()
    )
    rows.sort(key=lambda r: (r["id"], r["label"], bytes(r["buckets"]), bytes(r["shares"])))
    return [(r["label"], np.frombuffer(r["buckets"], np.int32), np.frombuffer(r["shares"], np.float32)) for r in rows]
