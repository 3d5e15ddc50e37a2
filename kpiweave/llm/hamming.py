"""Exact top-k search over binary codes by incremental multi-index hashing."""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiweave.llm.stage import on_workers, written

BITS = 64
CODES_PER_CELL = 8192
PROBES_PER_BATCH = 1 << 21


def sign_code(vector: Column, bits: int = BITS) -> Column:
    """Bit i is set where component i is above 0; null for a null vector. Missing components count as 0; a vector of more
    than ``bits`` components raises an error, as its code would be that of a prefix."""
    too_wide = F.concat(F.lit(f"a code has {bits} bits, a vector "), F.size(vector).cast("string"), F.lit(" components"))
    return F.when(F.size(vector) > bits, F.raise_error(too_wide).cast("long")).when(
        vector.isNotNull(),
        F.aggregate(
            F.sequence(F.lit(0), F.lit(bits - 1)), F.lit(0).cast("long"),
            lambda code, i: code.bitwiseOR(F.when(F.coalesce(F.get(vector, i), F.lit(0.0)) > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long"))),
        ),
    )


def segments(count: int, bits: int = BITS) -> list[tuple[int, int]]:
    """(lowest bit, width) of segments of about log2(count) bits: so wide that a value has about one code."""
    n = min(max(round(bits / math.log2(max(count, 16))), 2), 8)
    edges = [bits * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x.view(np.uint64))


def top_k(codes: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, id, distance): for each of ``queries`` (id, code) the ``k`` nearest of ``codes`` (id, code) but
    itself, by Hamming distance and then id. Rows with a null code take no part; with fewer rows, all are returned.

    Equal codes are searched once, and of each only the k + 1 lowest ids can matter. In round r, every segment of a query's
    code is probed at r flipped bits exactly; whatever differs in fewer bits than segments times (r + 1) has been seen
    then, so a query is finished once its kth candidate is nearer than that. Candidates are verified on the whole code
    inside tasks, each of which holds one cell of a segment's values and returns a query's k best, so no row is made for
    a candidate. Cells with too many codes are dealt out further, and each deal is probed."""
    codes, queries = codes.where("code IS NOT NULL"), queries.where("code IS NOT NULL")
    by_id = Window.partitionBy("code").orderBy("id")
    ids = codes.withColumn("n", F.row_number().over(by_id)).where(F.col("n") <= k + 1)
    ids = written(ids.select("code", "id"), "hamming-ids")
    index = written(ids.groupBy("code").agg(F.min("id").alias("first_id")), "hamming-codes")
    count = index.count()
    parts = segments(count)
    prefix = max(0, math.ceil(math.log2(max(count, 1) / CODES_PER_CELL)))
    prefix = min(prefix, min(w for _, w in parts) - 1)
    place = lambda code: F.explode(F.array(*[
        F.struct(F.lit(s).alias("segment"), F.shiftrightunsigned(code, low + width - prefix).bitwiseAND((1 << prefix) - 1).cast("int").alias("cell"))
        for s, (low, width) in enumerate(parts)
    ]))
    placed = index.select("code", "first_id", place(F.col("code")).alias("p")).select("code", "first_id", "p.segment", "p.cell")
    deals = placed.groupBy("segment", "cell").agg(F.ceil(F.count("*") / (4 * CODES_PER_CELL)).cast("int").alias("deals"))
    placed = placed.join(deals, ["segment", "cell"]).withColumn("deal", F.pmod(F.xxhash64("code"), F.col("deals")).cast("int")).drop("deals")
    placed = written(placed, "hamming-index")
    open_ = written(queries.select("code").distinct(), "hamming-queries")
    wanted = k + 1  # the query itself may be among them
    best: DataFrame | None = None
    done: list[DataFrame] = []
    for radius in range(max(w for _, w in parts) + 1):
        flips = [sum(1 << b for b in c) for n in range(min(radius, prefix) + 1) for c in combinations(range(prefix), n)]
        near = F.explode(F.array(*[F.lit(f) for f in flips]))
        probes = (
            open_.select("code", place(F.col("code")).alias("p")).select("code", "p.segment", "p.cell", near.alias("flip"))
            .withColumn("cell", F.col("cell").bitwiseXOR(F.col("flip"))).drop("flip")
            .join(deals, ["segment", "cell"]).withColumn("deal", F.explode(F.sequence(F.lit(0), F.col("deals") - 1))).drop("deals")
        )
        found = probes.groupBy("segment", "cell", "deal").cogroup(placed.groupBy("segment", "cell", "deal")).applyInPandas(
            _prober(parts, prefix, radius, wanted), "code long, other long, first_id long, distance int"
        )
        found = found.unionByName(best) if best is not None else found
        first = Window.partitionBy("code").orderBy("distance", "first_id")
        best = written(
            found.distinct().withColumn("n", F.row_number().over(first)).where(F.col("n") <= wanted).drop("n"), "hamming-best"
        )
        reached = len(parts) * (radius + 1) - 1
        settled = best.groupBy("code").agg(F.count("*").alias("n"), F.max("distance").alias("d")).where((F.col("n") >= min(wanted, count)) & (F.col("d") <= reached))
        settled = written(settled.select("code"), "hamming-settled")
        done.append(best.join(settled, "code", "left_semi"))
        best = written(best.join(settled, "code", "left_anti"), "hamming-open")
        open_ = written(open_.join(settled, "code", "left_anti"), "hamming-queries")
        if open_.isEmpty():
            break
    done.append(best)
    pairs = done[0]
    for more in done[1:]:
        pairs = pairs.unionByName(more)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "id")).alias("rank")
    return (
        queries.select(F.col("id").alias("query_id"), "code").join(pairs.drop("first_id"), "code")
        .join(ids.select(F.col("code").alias("other"), "id"), "other").where("id <> query_id")
        .select("query_id", rank, "id", "distance").where(F.col("rank") <= k)
    )


def _prober(parts: list[tuple[int, int]], prefix: int, radius: int, wanted: int):
    def probe(probes: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
        if not len(probes) or not len(index):
            return pd.DataFrame({c: [] for c in ("code", "other", "first_id", "distance")})
        low, width = parts[int(probes["segment"].iloc[0])]
        rest = width - prefix
        value = lambda code: (code.view(np.uint64) >> np.uint64(low)) & np.uint64((1 << width) - 1)
        codes = index["code"].to_numpy()
        order = np.argsort(value(codes), kind="stable")
        codes, firsts = codes[order], index["first_id"].to_numpy()[order]
        values, asked = value(codes), probes["code"].to_numpy()
        top = np.uint64(int(probes["cell"].iloc[0]) << rest)
        far = _popcount((value(asked) ^ top) >> np.uint64(rest))
        out = []
        for flipped in np.unique(far).tolist():
            if not 0 <= radius - flipped <= rest:
                continue
            masks = np.array([sum(1 << b for b in c) for c in combinations(range(rest), radius - flipped)], np.uint64)
            chosen = asked[far == flipped]
            step = max(1, PROBES_PER_BATCH // len(masks))
            for at in range(0, len(chosen), step):
                some = chosen[at : at + step]
                wanted_values = (((value(some) & np.uint64((1 << rest) - 1)) | top)[:, None] ^ masks).ravel()
                begin = np.searchsorted(values, wanted_values, "left")
                n = np.searchsorted(values, wanted_values, "right") - begin
                query = np.repeat(np.repeat(np.arange(len(some)), len(masks)), n)
                hit = np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())
                distance = _popcount(some[query] ^ codes[hit]).astype(np.int32)
                ranked = np.lexsort((firsts[hit], distance, query))
                query, hit, distance = query[ranked], hit[ranked], distance[ranked]
                place = np.arange(len(query)) - np.searchsorted(query, query, "left")
                keep = place < wanted
                out.append(pd.DataFrame({"code": some[query[keep]], "other": codes[hit[keep]], "first_id": firsts[hit[keep]], "distance": distance[keep]}))
        return pd.concat(out) if out else pd.DataFrame({c: [] for c in ("code", "other", "first_id", "distance")})

    return probe


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``top_k`` over the signs of vectors, for query vectors of the same columns. Null vectors and ids take no part."""
    coded = lambda df: on_workers(df).select(F.col(id_column).alias("id"), sign_code(F.col(vector_column)).alias("code")).where("id IS NOT NULL")
    return top_k(written(coded(vectors), "hamming-vectors"), written(coded(queries), "hamming-asked"), k)
