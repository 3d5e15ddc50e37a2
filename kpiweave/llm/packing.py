"""Packing token sequences into windows with little padding, by minimum bin slack."""

from __future__ import annotations

import base64
import math
import os
import re
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiweave.llm.stage import on_workers, written

CAPACITY = 2048
END_ID = 1
TOKENIZER = "byte_bpe_50k.json"
ROWS_PER_SHARD = 20_000

_LATIN = re.compile("[\\x00-\\u024f]*")


class Encoder:
    """Ids of a text as little-endian 32-bit numbers, as the ``tokenizers`` library gives them.

    Where the vocabulary also lies there as a file of ranks, texts of Latin letters alone are encoded by ``tiktoken``,
    which takes a quarter of the time and splits and merges them alike (a test compares both); all others, whose letters
    two Unicode tables might class differently, and those that hold the string of an added token go through ``tokenizers``."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added)) or "(?!)")  # a text that holds one has its id
        self.ranked = _ranked(Path(path).with_suffix(".tiktoken"))

    def encode(self, text: str) -> bytes:
        if not text.isascii() and not _LATIN.fullmatch(text):
            text = text.encode("utf-8", "replace").decode()  # a lone surrogate is no text
        elif self.ranked and not self.added.search(text):
            try:
                return np.array(self.ranked.encode_ordinary(text), "<u4").tobytes()
            except BaseException as error:  # noqa: BLE001
                # tiktoken's pattern overflows its stack on runs near a million blanks and panics; such texts go
                # through tokenizers, which gives the same ids.
                if type(error).__name__ != "PanicException":
                    raise
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4").tobytes()


def _ranked(path: Path):
    if not path.exists():
        return None
    import public_tokenizers
    import tiktoken

    ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, path.read_bytes().splitlines())}
    return tiktoken.Encoding(path.name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def pieces(docs: DataFrame, tokenizer: str | None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens) of (id, text): full windows, and what remains of each text."""

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer or default_tokenizer()).encode
        end = np.array([end_id], "<u4").tobytes()
        for frame in frames:
            rows: list[tuple[int, int, int, int, int]] = []
            for row, text in enumerate(frame["text"].tolist()):
                raw = (encode(text) if text else b"") + end
                total = len(raw) // 4
                for start in range(0, total, capacity):
                    piece = raw[4 * start : 4 * (start + capacity)]
                    rows.append((row, start, len(piece) // 4, zlib.crc32(piece), total))
            found = pd.DataFrame(rows, columns=["row", "start", "length", "ids_crc32", "doc_tokens"])
            found["row"] = frame["id"].array.take(found["row"].to_numpy())
            yield found.rename(columns={"row": "id"})

    schema = "id long, start long, length long, ids_crc32 long, doc_tokens long"
    return on_workers(docs).select(F.col("id").cast("long").alias("id"), "text").mapInPandas(cut, schema)


def padding(total: int, capacity: int) -> int:
    """A sequence is padded to the capacity, except at a power of two."""
    return 0 if total & (total - 1) == 0 else capacity - total


def fill(counts: np.ndarray, capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Windows for pieces of each length (``counts[length]`` of them), as ([(length, how many)], how often).

    Minimum bin slack: each window takes the longest piece left; a subset-sum over the lengths left, as bits of one
    integer, finds the sums that others can add, and the one with the least padding is traced back to counts. A window
    whose pattern can be repeated is, as often as its lengths last."""
    counts = counts.copy()
    windows = []
    longest = len(counts) - 1
    while True:
        while longest > 0 and counts[longest] == 0:
            longest -= 1
        if longest == 0:
            return windows
        counts[longest] -= 1
        room = capacity - longest
        mask = (1 << (room + 1)) - 1
        reach, trail = 1, []
        for length in range(min(longest, room), 0, -1):
            have = int(counts[length])
            if not have:
                continue
            have, size = min(have, room // length), 1
            while have > 0:  # counts as sums of powers of two
                size = min(size, have)
                trail.append((length, size, reach))
                reach |= (reach << (length * size)) & mask
                have -= size
                size *= 2
            if reach >> room & 1:
                break
        best = room if reach >> room & 1 else min(
            (s for s in range(room + 1) if reach >> s & 1), key=lambda s: (padding(longest + s, capacity), -s)
        )
        used: dict[int, int] = {longest: 1}
        for length, size, before in reversed(trail):
            if not before >> best & 1:
                best -= length * size
                used[length] = used.get(length, 0) + size
        counts[longest] += 1
        times = min(int(counts[length]) // n for length, n in used.items())
        for length, n in used.items():
            counts[length] -= n * times
        windows.append((sorted(used.items(), reverse=True), times))


def assign(frame: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """Sequence and offset of each piece of one shard (uid, length). A sequence is named by its first piece's uid."""
    frame = frame.sort_values(["length", "uid"], ignore_index=True)
    lengths, uids = frame["length"].to_numpy(), frame["uid"].to_numpy()
    counts = np.bincount(lengths, minlength=capacity + 1)
    next_of = np.searchsorted(lengths, np.arange(capacity + 1))
    sequence, offset = np.zeros(len(frame), np.int64), np.zeros(len(frame), np.int64)
    for used, times in fill(counts, capacity):
        for _ in range(times):
            at = 0
            name = uids[next_of[used[0][0]]]
            for length, n in used:
                for place in range(next_of[length], next_of[length] + n):
                    sequence[place], offset[place] = name, at
                    at += length
                next_of[length] += n
    frame["sequence_id"], frame["offset"] = sequence, offset
    return frame


def pack(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", tokenizer: str | None = None,
    capacity: int = CAPACITY, end_id: int = END_ID,
) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of each piece of each text.

    A text's ids and ``end_id`` are cut into full windows, which are sequences of their own, and a rest, which keeps
    together. The rests are dealt out at random into shards of about 20,000, each packed by itself, so padding beyond
    that of one shard's last windows is rare at any size. Null text is the empty text, which has only ``end_id``. Repeated
    rows are packed each. Ids come from the file ``tokenizer``, by default the given byte-level vocabulary."""
    cut = pieces(docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")), tokenizer, capacity, end_id)
    cut = written(cut.withColumn("uid", F.monotonically_increasing_id()), "pack-pieces")
    rests = cut.where(F.col("length") < capacity)
    shards = max(1, math.ceil(rests.count() / ROWS_PER_SHARD))

    def place(frame: pd.DataFrame) -> pd.DataFrame:
        return assign(frame, capacity)[names]

    names = [*cut.columns, "sequence_id", "offset"]
    schema = ", ".join(f"{c} long" for c in names)
    packed = (
        rests.withColumn("shard", F.pmod(F.xxhash64("uid"), F.lit(shards))).groupBy("shard")
        .applyInPandas(lambda frame: place(frame.drop(columns="shard")), schema)
    )
    whole = cut.where(F.col("length") == capacity).withColumn("sequence_id", F.col("uid")).withColumn("offset", F.lit(0).cast("long"))
    return packed.unionByName(whole).drop("uid")
