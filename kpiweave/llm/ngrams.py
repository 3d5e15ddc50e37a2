"""Hashed byte n-grams of whole texts: sums of table rows for scoring, sparse counts for training.

An n-gram's bucket depends on its bytes alone and never reaches over the end of a text, so that a score does not depend
on the texts it is computed along with."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from kpiweave.llm.hashing import BLOCK, batches

FACTORS = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F], np.uint32)


def _buckets(data: np.ndarray, n: int, bits: int) -> np.ndarray:
    count = len(data) - n + 1
    h = np.full(max(count, 0), n, np.uint32)
    for k in range(n if count > 0 else 0):
        h = (h ^ data[k : k + count]) * FACTORS[k]
        h ^= h >> np.uint32(15)
    return h >> np.uint32(32 - bits)


def _runs(texts: list[bytes], size: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, one after the last, their bytes end to end, starts and end) in blocks of about ``size`` bytes."""
    for i, j in batches(texts, size):
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts[i:j]])])
        yield i, j, np.frombuffer(b"".join(texts[i:j]), np.uint8), offsets


def sums(texts: list[bytes], table: np.ndarray, sizes: tuple[int, ...], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """For each text the sum of ``table`` rows over its n-grams, and their number. ``table`` has 2**bits rows."""
    total = np.zeros((len(texts), table.shape[1]))
    counts = np.zeros(len(texts), np.int64)
    for i, j, data, offsets in _runs(texts, BLOCK):
        lengths = np.diff(offsets)
        for n in sizes:
            counts[i:j] += np.maximum(lengths - n + 1, 0)
            if j == i + 1:  # one text of any length, in pieces
                for at in range(0, max(len(data) - n + 1, 0), BLOCK):
                    total[i] += table[_buckets(data[at : at + BLOCK + n - 1], n, bits)].sum(0, dtype=np.float64)
                continue
            ids = _buckets(data, n, bits)
            rows = table[ids]
            for k in range(1, n):  # those that begin in one text and end in the next
                over = offsets[1:] - k
                over = over[(over >= offsets[:-1]) & (over < len(ids))]
                rows[over] = 0
            filled = np.flatnonzero(np.minimum(offsets[1:], len(ids)) > offsets[:-1])
            if len(filled):
                total[i + filled] += np.add.reduceat(rows, offsets[filled], axis=0, dtype=np.float64)
    return total, counts


def sparse(text: bytes, sizes: tuple[int, ...], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of one text and the share of its n-grams in each."""
    data = np.frombuffer(text, np.uint8)
    counts = np.zeros(1 << bits, np.int64)
    for n in sizes:
        for at in range(0, max(len(data) - n + 1, 0), BLOCK):
            counts += np.bincount(_buckets(data[at : at + BLOCK + n - 1], n, bits), minlength=1 << bits)
    found = np.flatnonzero(counts)
    return found.astype(np.int32), (counts[found] / max(counts.sum(), 1)).astype(np.float32)
