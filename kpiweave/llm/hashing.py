"""Hashes of words, word windows and byte n-grams of whole texts as numpy arrays.

A word is a run of bytes other than space and 0x09-0x0D, the same as ``[^\\x20\\x09-\\x0D]+`` on the text. A word's hash
is a polynomial of its bytes modulo 2**64, taken from prefix sums and then mixed; a window's hash is the same over the
hashes of its words. Texts are hashed in blocks of ``BLOCK`` bytes, cut between words, so that one very long text takes
no more working memory than many short ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BLOCK = 1 << 20
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
U64 = np.uint64

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class _Powers:
    """Powers of an odd number and of its inverse modulo 2**64, as many as were asked for yet."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, U64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1 << 16)
            self.up, self.down = (
                np.cumprod(np.concatenate([np.ones(1, U64), np.full(size - 1, x, U64)]), dtype=U64)
                for x in (self.base, self.inverse)
            )
        return self.up[:n], self.down[:n]


_POWERS = {base: _Powers(base) for base in BASES}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread a 64-bit value over all its bits."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _slices(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    up, down = _POWERS[base].get(len(values) + 1)
    sums = np.zeros(len(values) + 1, U64)
    np.cumsum(values * up[1:], dtype=U64, out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64))


def _bounds(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    solid = np.concatenate([[False], ~_SPACE[raw], [False]])
    edges = np.flatnonzero(solid[1:] != solid[:-1])
    return edges[::2], edges[1::2]


def word_hashes(raw: bytes, lower: bool = False) -> np.ndarray:
    """Hash of each word of one UTF-8 text; ``lower`` takes A-Z as a-z."""
    data = np.frombuffer(raw, np.uint8)
    found, at = [], 0
    while at < len(data):
        end = min(at + BLOCK, len(data))
        while end < len(data) and not _SPACE[data[end]]:
            end += 1
        part = data[at:end]
        starts, ends = _bounds(part)
        values = (_LOWER[part] if lower else part).astype(U64) + U64(1)
        found.append(_slices(values, starts, ends, BASES[0]))
        at = end
    return np.concatenate(found) if found else np.zeros(0, U64)


def batches(texts: list[bytes] | list[str], size: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` of about ``size`` bytes (characters) each; a longer text is alone."""
    at = total = 0
    for i, text in enumerate(texts):
        if i > at and total + len(text) > size:
            yield at, i
            at, total = i, 0
        total += len(text)
    if at < len(texts):
        yield at, len(texts)


def words_of(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in order, and the number of words before each text (one more at the end)."""
    hashes, counts = [], []
    for i, j in batches(texts):
        joined = b" ".join(texts[i:j])
        if j == i + 1:
            hashes.append(word_hashes(joined, lower))
            counts.append([len(hashes[-1])])
            continue
        data = np.frombuffer(joined, np.uint8)
        starts, ends = _bounds(data)
        values = (_LOWER[data] if lower else data).astype(U64) + U64(1)
        hashes.append(_slices(values, starts, ends, BASES[0]))
        stops = np.cumsum([len(t) + 1 for t in texts[i:j]])
        counts.append(np.diff(np.searchsorted(starts, stops), prepend=0))
    if not hashes:
        return np.zeros(0, U64), np.zeros(1, np.int64)
    return np.concatenate(hashes), np.concatenate([[0], np.cumsum(np.concatenate(counts))]).astype(np.int64)


def window_hashes(words: np.ndarray, length: int, base: int = BASES[0]) -> np.ndarray:
    """Hash of each window of ``length`` consecutive words; empty where there are fewer words."""
    if len(words) < length:
        return np.zeros(0, U64)
    starts = np.arange(len(words) - length + 1)
    return _slices(words, starts, starts + length, base)


def windows_inside(offsets: np.ndarray, length: int) -> np.ndarray:
    """Starts of the windows that lie within one text, for words laid end to end with these ``offsets``."""
    total = int(offsets[-1])
    if total < length:
        return np.zeros(0, np.int64)
    fits = np.zeros(total + 1, np.int32)
    last = np.maximum(offsets[1:] - length + 1, offsets[:-1])
    np.add.at(fits, offsets[:-1], 1)
    np.add.at(fits, last, -1)
    return np.flatnonzero(np.cumsum(fits[:-1]) > 0)


def encode(texts) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    return [t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"" for t in texts]
