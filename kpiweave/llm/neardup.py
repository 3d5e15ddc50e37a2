"""Near-duplicates: banded MinHash candidates, sequential Bayesian pruning, exact verification of what survives."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiweave.llm.components import components
from kpiweave.llm.hashing import batches, encode, window_hashes, windows_inside, words_of
from kpiweave.llm.stage import on_workers, written

BANDS, ROWS = 24, 5  # a pair at 0.8 meets in some band but for 7 in 100,000
HASHES = BANDS * ROWS
STEP = 24
MISS = 1e-5
MEMBERS, SHINGLES = 1000, 2_000_000

_RNG = np.random.default_rng(20240229)
_FACTORS = _RNG.integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_TERMS = _RNG.integers(0, 1 << 32, HASHES, dtype=np.uint32)


def shingle_sets(texts: list[bytes], words: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text: runs of ``words`` words, A-Z as a-z; of a text with fewer words, the
    whole; empty without words."""
    for i, j in batches(texts, 1 << 22):
        hashes, offsets = words_of(texts[i:j], lower=True)
        windows = window_hashes(hashes, words)
        for start, end in zip(offsets.tolist(), offsets[1:].tolist()):
            count = end - start
            if count >= words:
                yield np.unique(windows[start : end - words + 1])
            else:
                yield window_hashes(hashes[start:end], count) if count else np.zeros(0, np.uint64)


def signature(shingles: np.ndarray) -> np.ndarray:
    """Least value of the set under each of the hash functions."""
    least = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(shingles), 4096):
        part = (shingles[at : at + 4096] >> np.uint64(32)).astype(np.uint32)
        np.minimum(least, (part[:, None] * _FACTORS + _TERMS).min(0), out=least)
    return least


def set_key(shingles: np.ndarray) -> bytes | None:
    """128-bit name of a set; null for the empty one."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def fewest_matches(threshold: float, miss: float) -> dict[int, int]:
    """By how many hashes were compared, the fewest matches with which a pair may still be similar: under a uniform
    prior, the similarity exceeds ``threshold`` with a probability of at least ``miss``."""
    least = {}
    for n in range(STEP, HASHES + 1, STEP):
        below, total = 0, 0.0
        for m in range(n + 1):  # P(similarity > t | m of n) = P(Binomial(n + 1, t) <= m)
            total += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if total >= miss:
                below = m
                break
        least[n] = below
    return least


def similar(a: np.ndarray, b: np.ndarray, least: dict[int, int]) -> np.ndarray:
    """Which rows of two arrays of signatures are not pruned; hashes are compared step by step."""
    alive, matches = np.arange(len(a)), np.zeros(len(a), np.int32)
    for n in range(STEP, HASHES + 1, STEP):
        matches[alive] += (a[alive, n - STEP : n] == b[alive, n - STEP : n]).sum(1)
        alive = alive[matches[alive] >= least[n]]
    kept = np.zeros(len(a), bool)
    kept[alive] = True
    return kept


def _signatures(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint32).reshape(-1, HASHES)


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text", miss: float = MISS,
) -> DataFrame:
    """(id, set, n_shingles, component_id) of each row.

    Texts are linked where 100 times the common shingles are at least ``percent`` times all of both. Texts with equal sets
    are one class, compared once. Classes whose signatures share a band are candidates: first each with the least class of
    its band; then, where a band still holds several components, all those of different components, block by block inside
    tasks, the likeliest first. A candidate goes on while the posterior of its signatures allows the similarity (``miss``: the probability
    below which it is pruned), and is a link if the full sets say so. What the signatures miss is a pair near the threshold
    in about one of 10,000; pairs that are more alike are found.

    component_id is the least id that can be reached over links. Rows with null, empty or blank text have a null set,
    no shingles, and are their own component. Rows of one id are rows of their own; null ids are linked, but a component
    takes its name from ids that are not null, and is null if it has none."""
    facts = written(_facts(docs, words, id_column, text_column), "near-facts")
    classes = written(
        facts.where("set IS NOT NULL").groupBy("set").agg(
            F.min("id").alias("least_id"), F.min(F.struct("id", "signature"))["signature"].alias("signature"),
            F.first("n_shingles").alias("n"),
        ),
        "near-classes",
    )
    bands = _bands(classes)
    heads = bands.groupBy("band").agg(F.min("set").alias("head"), F.count("*").alias("members")).where("members > 1")
    members = written(bands.join(heads, "band"), "near-members")
    full = written(_full_sets(docs, classes, members, words, id_column, text_column), "near-sets")
    least = fewest_matches(percent / 100, miss)
    first = members.where("set <> head").select(F.col("head").alias("a"), F.col("set").alias("b")).distinct()
    links = written(_verified(_pruned(first, classes, least), full, percent), "near-links")
    links = links.unionByName(_between(members, full, components(links), least, percent))
    roots = components(links)
    named = (
        classes.join(roots, classes["set"] == roots["node"], "left")
        .select("set", F.coalesce("root", "set").alias("root"), "least_id")
    )
    named = named.join(named.groupBy("root").agg(F.min("least_id").alias("component")), "root").select("set", "component")
    return facts.select("id", "set", "n_shingles").join(named, "set", "left").select(
        "id", "set", "n_shingles", F.when(F.col("set").isNull(), F.col("id")).otherwise(F.col("component")).alias("component_id")
    )


def _facts(docs: DataFrame, words: int, id_column: str, text_column: str) -> DataFrame:
    def describe(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            keys, counts, signatures = [], [], []
            for shingles in shingle_sets(encode(frame["text"]), words):
                keys.append(set_key(shingles))
                counts.append(len(shingles))
                signatures.append(signature(shingles).tobytes() if len(shingles) else None)
            yield pd.DataFrame({"id": frame["id"].array, "set": keys, "n_shingles": counts, "signature": signatures})

    picked = on_workers(docs).select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    return picked.mapInPandas(describe, "id long, set binary, n_shingles long, signature binary")


def _bands(classes: DataFrame) -> DataFrame:
    """(number, band, set, n): one row for each band of a class."""
    width = ROWS * 4
    key = lambda i: F.struct(F.lit(i).alias("number"), F.xxhash64(F.lit(i), F.substring("signature", i * width + 1, width)).alias("band"))
    return classes.select("set", "n", F.inline(F.array(*[key(i) for i in range(BANDS)])))


def _pruned(pairs: DataFrame, classes: DataFrame, least: dict[int, int]) -> DataFrame:
    """Pairs of classes whose signatures allow the similarity."""

    @F.pandas_udf("boolean")
    def allowed(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(similar(_signatures(a), _signatures(b), least))

    of = lambda name: classes.select(F.col("set").alias(name), F.col("signature").alias(f"signature_{name}"))
    return pairs.join(of("b"), "b").join(of("a"), "a").where(allowed("signature_a", "signature_b")).select("a", "b")


def _between(members: DataFrame, full: DataFrame, roots: DataFrame, least: dict[int, int], percent: int) -> DataFrame:
    """Links between components within bands that hold several, as (a, b): enough of them to connect what is connected.

    Each pair is looked at in the first band where it meets, unless it is connected by then, and is verified on the full
    sets at once: what comes out are links, at most one for each member. A band is dealt out in pairs of blocks of about
    1000 members or 2 million shingles, so that one of any size is many tasks."""

    def link(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("set", ignore_index=True)
        names, shingles, number = frame["set"].tolist(), frame["shingles"].tolist(), int(frame["number"].iloc[0])
        marks, label = _signatures(frame["signature"]), pd.factorize(frame["root"])[0]
        sizes, blocks = np.array([len(s) for s in shingles]), frame["block"].to_numpy()
        lefts, rights = (np.flatnonzero(blocks == int(frame[side].iloc[0])) for side in ("low", "high"))
        same_block, found = int(frame["low"].iloc[0]) == int(frame["high"].iloc[0]), []
        for i in lefts.tolist():
            js = rights[label[rights] != label[i]]
            js = js[js > i] if same_block else js
            js = js[np.minimum(sizes[js], sizes[i]) * 100 >= np.maximum(sizes[js], sizes[i]) * percent]
            js = js[similar(np.broadcast_to(marks[i], (len(js), HASHES)), marks[js], least)]
            equal = marks[js] == marks[i]
            here = equal.reshape(len(js), BANDS, ROWS).all(2).argmax(1) == number
            js, matches = js[here], equal[here].sum(1)
            for j in js[np.argsort(-matches, kind="stable")].tolist():
                if label[i] == label[j]:
                    continue
                common = len(np.intersect1d(shingles[i], shingles[j], assume_unique=True))
                if common * 100 >= (sizes[i] + sizes[j] - common) * percent:
                    found.append((names[i], names[j]))
                    label[label == label[j]] = label[i]
        return pd.DataFrame(found, columns=["a", "b"])

    placed = (
        members.where("members > 2").join(roots, members["set"] == roots["node"], "left")
        .select("number", "band", "set", "n", F.coalesce("root", "set").alias("root"))
    )
    several = placed.groupBy("band").agg(
        F.greatest(F.ceil(F.count("*") / MEMBERS), F.ceil(F.sum("n") / SHINGLES)).cast("int").alias("blocks"),
        F.min("root").alias("r0"), F.max("root").alias("r1"),
    ).where("r0 <> r1").select("band", "blocks")
    spread = (
        placed.join(several, "band")
        .withColumn("block", F.pmod(F.xxhash64("set"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("number", "band", "set", "root", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
        .join(full, "set")
    )
    return spread.groupBy("band", "low", "high").applyInPandas(link, "a binary, b binary")


def _full_sets(docs: DataFrame, classes: DataFrame, members: DataFrame, words: int, id_column: str, text_column: str) -> DataFrame:
    """(set, signature, shingles) of each class that shares a band with another; their texts are read again, once."""
    wanted = classes.join(members.select("set").distinct(), "set", "left_semi").select("set", "least_id", "signature")

    def sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = list(shingle_sets(encode(frame["text"]), words))
            same = np.array([set_key(f) == bytes(k) for f, k in zip(found, frame["set"])], bool)
            yield pd.DataFrame({
                "set": frame["set"][same].array, "signature": frame["signature"][same].array, "shingles": [f.view(np.int64) for f, ok in zip(found, same) if ok]
            })

    texts = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    return (
        texts.join(wanted, texts["id"].eqNullSafe(wanted["least_id"])).select("set", "signature", "text")
        .mapInPandas(sets, "set binary, signature binary, shingles array<long>").dropDuplicates(["set"])
    )


def _verified(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets reach the similarity, as (a, b)."""
    of = lambda name: full.select(F.col("set").alias(name), F.col("shingles").alias(f"shingles_{name}"))
    n_a, n_b, common = F.size("shingles_a"), F.size("shingles_b"), F.size(F.array_intersect("shingles_a", "shingles_b"))
    return (
        pairs.join(of("b"), "b").join(of("a"), "a")
        .where(F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * percent)
        .where(common * 100 >= (n_a + n_b - common) * percent)
        .select("a", "b")
    )
