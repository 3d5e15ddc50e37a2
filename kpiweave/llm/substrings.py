"""Repeated passages: fixed-block anchors, rolling probes, and exact repeats of a whole window."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from kpiweave.llm.hashing import BASES, batches, encode, window_hashes, windows_inside, words_of
from kpiweave.llm.stage import on_workers, own_columns, parallelism, written

WINDOW = 35
CHUNK_BYTES = 6 << 20
WORDS_PER_PART = 4_000_000
MESSAGE = "part int, chunk long, keys binary, places binary, marks binary, sets binary, hits binary"


@F.pandas_udf(StructType().add("key", StringType()).add("n_words", LongType()))
def word_key(texts: pd.Series) -> pd.DataFrame:
    """SHA-256 of the words of a text joined by single spaces, and their number."""
    return pd.DataFrame([_named(t) for t in encode(texts)], columns=["key", "n_words"])


def _named(text: bytes) -> tuple[str, int]:
    words = text.split()
    return hashlib.sha256(b" ".join(words)).hexdigest(), len(words)


def _packed(numbers: np.ndarray) -> bytes:
    """Ascending numbers as the byte planes of their differences, which compress well."""
    return np.diff(numbers, prepend=0).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(4, -1).T
    return np.cumsum(np.ascontiguousarray(planes).view("<u4").ravel(), dtype=np.int64)


def _spans(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Ascending, merged (start, end) rows that cover the given ones."""
    if not len(starts):
        return np.zeros((0, 2), np.int32)
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], starts[1:] > ends[:-1]])
    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(starts) - 1]])
    return np.stack([starts[new], ends[last]], axis=1).astype(np.int32)


def _inside(spans: bytes) -> np.ndarray:
    """All numbers within packed spans."""
    rows = np.frombuffer(spans, np.int32).reshape(-1, 2)
    return np.concatenate([np.arange(a, b) for a, b in rows]) if len(rows) else np.zeros(0, np.int64)


def _send(h: np.ndarray, keys: np.ndarray, parts: np.ndarray, places: np.ndarray, marks: np.ndarray, count: int, chunk: int) -> tuple[list[tuple], np.ndarray]:
    """Messages to the parts, each with its keys, where in the chunk they are, and a mark for each; and the places of what
    the chunk has more than once. Such a key is sent once, at its first place, with the mark of any."""
    order = np.argsort(h, kind="stable")
    new = np.ones(len(h), bool)
    new[1:] = h[order][1:] != h[order][:-1]
    runs = np.flatnonzero(new)
    alone = np.diff(runs, append=len(h)) == 1
    again = np.sort(places[order[np.repeat(~alone, np.diff(runs, append=len(h)))]]) if len(h) else places
    first = order[runs]
    marked = np.maximum.reduceat(marks[order], runs) if len(h) else marks
    dealt = np.argsort((parts[first] << 32) | places[first])
    keys, parts, places, marks = keys[first][dealt], parts[first][dealt], places[first][dealt], marked[dealt]
    edges = np.searchsorted(parts, np.arange(count + 1)).tolist()
    return [
        (part, chunk, keys[i:j].tobytes(), _packed(places[i:j]), np.packbits(marks[i:j]).tobytes(), None, None)
        for part, (i, j) in enumerate(zip(edges, edges[1:])) if j > i
    ], again


def _exchange(
    texts: DataFrame, parts: int, describe: Callable, decide: Callable, dtype: str, reach: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]],
) -> DataFrame:
    """(key, spans) of the texts (text, and key if there is one) that have hits.

    ``describe`` gives for a chunk of texts: offsets, and the place, hash, key, part and mark of each of its windows. Each
    window's key goes to the part that it names; there ``decide`` says which are hits. What a chunk can see to be
    repeated by itself is a hit at once, and the key is sent only once, so a very frequent passage costs each part one
    key a chunk and not one a document. Hits come back to the chunk, and ``reach`` turns them into spans of the text."""

    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        chunk = (TaskContext.get().partitionId() << 32) - 1
        for frame in frames:
            raw = encode(frame["text"])
            for i, j in batches(raw, CHUNK_BYTES):
                some = frame.iloc[i:j]
                some = some if "key" in some else some.assign(key=[_named(t)[0] for t in raw[i:j]])
                first = ~some["key"].duplicated().to_numpy()
                some, own = some[first], [t for t, ok in zip(raw[i:j], first) if ok]
                chunk += 1
                offsets, places, *sent = describe(some, own)
                rows, hits = _send(sent[0], sent[1], sent[2], places, sent[3], parts, chunk)
                sets = "\n".join(f"{k} {o}" for k, o in zip(some["key"], offsets.tolist())) + f"\n. {int(offsets[-1])}"
                rows.append((parts + chunk % parts, chunk, None, None, None, sets.encode(), _packed(hits)))
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in MESSAGE.split(", ")])

    def receive(frame: pd.DataFrame) -> pd.DataFrame:
        if int(frame["part"].iloc[0]) >= parts:
            return frame[["chunk", "sets", "hits"]]
        keys = [np.frombuffer(k, dtype) for k in frame["keys"]]
        sizes = [len(k) for k in keys]
        marks = np.concatenate([np.unpackbits(np.frombuffer(m, np.uint8), count=n) for m, n in zip(frame["marks"], sizes)])
        hit = decide(np.concatenate(keys), marks.astype(bool))
        ends = np.cumsum(sizes)
        found = [
            (chunk, None, _packed(_unpacked(places)[hit[end - n : end]]))
            for chunk, places, n, end in zip(frame["chunk"], frame["places"], sizes, ends.tolist()) if hit[end - n : end].any()
        ]
        return pd.DataFrame(found, columns=["chunk", "sets", "hits"])

    def back(frame: pd.DataFrame) -> pd.DataFrame:
        listed = [line.split() for s in frame["sets"] if s is not None for line in bytes(s).decode().split("\n")]
        offsets = np.array([int(o) for _, o in listed], np.int64)
        hits = np.unique(np.concatenate([_unpacked(h) for h in frame["hits"]]))
        owner = np.searchsorted(offsets, hits, "right") - 1
        found = []
        for text in np.unique(owner).tolist():
            n = int(offsets[text + 1] - offsets[text])
            spans = _spans(*reach(hits[owner == text] - offsets[text], n))
            if len(spans):
                found.append((listed[text][0], len(spans), spans.tobytes()))
        return pd.DataFrame(found, columns=["key", "n_spans", "spans"])

    returned = (
        on_workers(texts).mapInPandas(send, MESSAGE).groupBy("part").applyInPandas(receive, "chunk long, sets binary, hits binary")
    )
    return returned.groupBy("chunk").applyInPandas(back, "key string, n_spans int, spans binary")


def _parts(h: np.ndarray, parts: int) -> np.ndarray:
    return ((h >> np.uint64(33)) % np.uint64(parts)).astype(np.int64)


def repeats(docs: DataFrame, window: int = WINDOW, id_column: str = "doc_id", text_column: str = "text") -> tuple[DataFrame, DataFrame]:
    """(facts, spans): of each row of ``docs`` (id, key, n_words), and of each key with repeated windows (key, n_words,
    text, spans) with spans of words covered by windows of ``window`` words that also start elsewhere; the text and spans
    are null where all words are.

    Texts of equal words share a key; if there are several, all their words are covered (if they have a window). A window
    contains a whole block of half its length (rounded up) of any text laid out in blocks, so: each text's blocks are
    anchors, each rolling window of a block's length is a probe, and both occurrences of a repeated window hold a probe
    that meets an anchor of the other. Windows over such probes are then compared by 64 bits of hash within the part that
    further bits name; runs of windows found repeated are the maximal exact repeats. Anchors are compared by 32 bits and
    the part; what they hit by chance drops out with the windows."""
    block = (window + 1) // 2
    facts = written(
        on_workers(docs).select(F.col(id_column).alias("id"), word_key(F.col(text_column)).alias("w")).select("id", "w.key", "w.n_words"),
        "substring-facts",
    )
    classes = written(
        facts.where(F.col("n_words") >= window).groupBy("key", "n_words").agg(F.count("*").alias("copies"), F.min("id").alias("least_id")),
        "substring-classes",
    )
    total = facts.agg(F.sum("n_words")).first()[0] or 0
    parts = max(parallelism(docs), math.ceil(total / WORDS_PER_PART))
    texts = on_workers(docs).select(F.col(text_column).alias("text"), F.col(id_column).alias("id"))

    def anchors(frame: pd.DataFrame, raw: list[bytes]):
        words, offsets = words_of(raw)
        places = windows_inside(offsets, block)
        h = window_hashes(words, block)[places] if len(places) else np.zeros(0, np.uint64)
        start = np.repeat(offsets[:-1], np.maximum(np.diff(offsets) - block + 1, 0))
        return offsets, places, h, h.astype(np.uint32), _parts(h, parts), (places - start) % block == 0

    def met(keys: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        blocks, n = np.unique(keys[anchor], return_counts=True)
        if not len(blocks):
            return anchor
        at = np.minimum(np.searchsorted(blocks, keys), len(blocks) - 1)
        return (blocks[at] == keys) & (n[at] > anchor)

    def around(places: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        starts, ends = np.maximum(places - (window - block), 0), np.minimum(places + 1, n - window + 1)
        return starts[ends > starts], ends[ends > starts]

    candidates = _exchange(texts.select("text"), parts, anchors, met, "<u4", around)
    best = candidates.groupBy("key").agg(F.max_by("spans", "n_spans").alias("spans"))
    wanted = classes.join(best, "key")
    some = texts.join(wanted, texts["id"].eqNullSafe(wanted["least_id"])).select("key", "n_words", "copies", "spans", "text")
    some = written(some.where(_key(F.col("text")) == F.col("key")), "substring-candidates")

    def windows(frame: pd.DataFrame, raw: list[bytes]):
        words, offsets = words_of(raw)
        within = [_inside(s) + o for s, o in zip(frame["spans"], offsets.tolist())]
        places = np.concatenate(within)
        copied = np.repeat(frame["copies"].to_numpy() > 1, [len(w) for w in within])
        h = window_hashes(words, window)[places] if len(places) else np.zeros(0, np.uint64)
        second = window_hashes(words, window, BASES[1])[places] if len(places) else h
        return offsets, places, h, h, _parts(second, parts), copied

    def several(keys: np.ndarray, copied: np.ndarray) -> np.ndarray:
        _, place, n = np.unique(keys, return_inverse=True, return_counts=True)
        return (n + np.bincount(place, copied, len(n)) > 1)[place]

    def covered(places: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        return places, places + window

    exact = _exchange(some, parts, windows, several, "<u8", covered)
    exact = exact.groupBy("key").agg(F.max_by("spans", "n_spans").alias("spans"))
    single = classes.where("copies = 1").join(exact, "key").select("key", "spans")
    spans = some.select("key", "n_words", "text").dropDuplicates(["key"]).join(single, "key")
    whole = classes.where("copies > 1").select("key", "n_words", F.lit(None).cast("string").alias("text"), F.lit(None).cast("binary").alias("spans"))
    return facts, spans.select("key", "n_words", "text", "spans").unionByName(whole)


def _key(text: Column) -> Column:
    return word_key(text)["key"]


def kept_words(text: str, spans: bytes | None) -> list[bytes]:
    """Words of a text outside the spans; none where the spans are null."""
    if spans is None:
        return []
    words, kept, at = encode([text])[0].split(), [], 0
    for start, end in np.frombuffer(spans, np.int32).reshape(-1, 2).tolist():
        kept += words[at:start]
        at = end
    return kept + words[at:]


def digests(docs: DataFrame, window: int = WINDOW, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_words, n_removed, kept_sha256) of each row: what is left when all words covered by repeated windows go.

    Null, empty and blank texts have no words, and the digest of nothing; texts with fewer words than a window keep all.
    Repeated rows are copies of each other, so nothing of them is left."""

    @F.pandas_udf("n_kept long, sha string")
    def digest(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
        kept = [kept_words(t, s) for t, s in zip(texts, spans)]
        return pd.DataFrame({"n_kept": [len(k) for k in kept], "sha": [hashlib.sha256(b" ".join(k)).hexdigest() for k in kept]})

    facts, spans = repeats(docs, window, id_column, text_column)
    changed = spans.select("key", digest("text", "spans").alias("d")).select("key", "d.n_kept", "d.sha")
    return facts.join(changed, "key", "left").select(
        "id", "n_words", (F.col("n_words") - F.coalesce("n_kept", "n_words")).alias("n_removed"), F.coalesce("sha", "key").alias("kept_sha256")
    )


def without_repeats(docs: DataFrame, window: int = WINDOW, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with the words covered by repeated windows taken out of the text; what is left of a changed text is joined
    by single spaces, other texts stay as they are, and so do null ones. All rows and columns are kept."""

    @F.pandas_udf("string")
    def rest(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([b" ".join(kept_words(t, s)).decode("utf-8", "surrogatepass") for t, s in zip(texts, spans)], dtype=object)

    _, spans = repeats(docs, window, id_column, text_column)
    changed = spans.select(F.col("key").alias("__key"), rest("text", "spans").alias("__rest"))
    text = F.when(F.col("__rest").isNotNull(), F.col("__rest")).otherwise(F.col(text_column))
    return (
        docs.withColumn("__key", _key(F.col(text_column))).join(changed, "__key", "left")
        .withColumn(text_column, text).select(*own_columns(docs))
    )
