"""Language identification: averaged hashed subword embeddings under a linear softmax."""

from __future__ import annotations


from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiweave.llm import ngrams
from kpiweave.llm.training import features, held_out, learnable, sample_ids

SIZES = (1, 2, 3, 4)
BITS = 15
DIMENSIONS = 16
PER_LANGUAGE = 1000
EPOCHS = 6
RATE = 0.5
REJECTED = 0.01
UNKNOWN = "und"

_PLAIN = bytes(c if not (c < 128) or chr(c).isalpha() else 32 for c in range(256))
# A letter is a code point of Unicode category L; numbers such as ½, ② or ³ are none.
_LETTER = regex.compile(r"\p{L}")


def normal(text: str | None) -> bytes:
    """Lower-case text as UTF-8, with ASCII characters that are no letters as spaces, and a space at both ends."""
    return b" " + text.lower().encode("utf-8", "surrogatepass").translate(_PLAIN) + b" " if text else b""


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # embeddings times weights: a row of logits for each bucket
    bias: np.ndarray
    temperature: float
    least: float  # calibrated: accepted scores are not below

    def predict(self, texts: list[str | None]) -> pd.DataFrame:
        total, counts = ngrams.sums([normal(t) for t in texts], self.table, SIZES, BITS)
        logits = (total / np.maximum(counts, 1)[:, None] + self.bias) / self.temperature
        shares = softmax(logits)
        best = shares.argmax(1)
        lettered = np.array([bool(t) and _LETTER.search(t) is not None for t in texts], bool)
        score = np.where(lettered, shares[np.arange(len(texts)), best], 0.0)
        names = np.array(self.languages, object)[best]
        return pd.DataFrame({
            "lang_pred": np.where(lettered, names, UNKNOWN), "score": score, "accepted": lettered & (score >= self.least)
        })


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def fit(samples: list[tuple[str, np.ndarray, np.ndarray]], seed: int = 7) -> Model | None:
    """Train on four fifths of the samples, calibrate temperature and rejection on the rest. None without samples."""
    if not samples:
        return None
    languages = sorted({label for label, _, _ in samples})
    code = {x: i for i, x in enumerate(languages)}
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(samples))
    kept_back = set(order[: len(order) // 5].tolist()) if len(order) >= 50 else set()
    table = rng.normal(0, 0.1, (1 << BITS, DIMENSIONS))
    weights = rng.normal(0, 0.1, (DIMENSIONS, len(languages)))
    bias = np.zeros(len(languages))
    train = [i for i in order.tolist() if i not in kept_back]
    steps, step = max(EPOCHS * len(train), 1), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(train).tolist():
            label, buckets, shares = samples[i]
            rate = RATE * (1 - step / steps)
            step += 1
            mean = shares @ table[buckets]
            slope = softmax(mean @ weights + bias)
            slope[code[label]] -= 1
            back = weights @ slope
            weights -= rate * np.outer(mean, slope)
            bias -= rate * slope
            # a bucket's share of a text is small, so its step is scaled by the number of buckets
            table[buckets] -= rate * min(len(buckets), 200) * shares[:, None] * back
    logits_table = (table @ weights).astype(np.float32)
    held = [samples[i] for i in sorted(kept_back)] or samples
    logits = np.array([s @ logits_table[b] + bias for _, b, s in held])
    truth = np.array([code[x] for x, _, _ in held])
    at = np.arange(len(truth))
    temperature = min(
        np.geomspace(0.05, 50, 80), key=lambda t: -np.log(np.maximum(softmax(logits / t)[at, truth], 1e-12)).sum()
    )
    shares = softmax(logits / temperature)
    right = shares[at, truth][shares.argmax(1) == truth]
    least = float(np.quantile(right, REJECTED)) if len(right) else 0.0
    return Model(languages, logits_table, bias, float(temperature), least)


def identify(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang", per_language: int = PER_LANGUAGE,
) -> DataFrame:
    """(id, held_out, lang_pred, score, accepted) of each whole text.

    Learns from at most ``per_language`` documents of each non-null language, whose id's crc32 is not divisible by 5; the
    sample is the same on each run. Null text and text without a letter gives ``und`` with score 0, as does everything
    where there is nothing to learn from. ``score`` is the calibrated probability of the predicted language; ``accepted``
    is false where it is below what 99% of rightly predicted documents reach. Rows are judged one by one, so repeated
    rows and ties (first language by name) need no more rules."""
    picked = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"), F.col(lang_column).alias("label"))
    train = picked.where(learnable(F.col("id")))
    model = fit(features(train.drop("label"), sample_ids(train.select("id", "label"), per_language), normal, SIZES, BITS))

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if model is None:
                found = pd.DataFrame({"lang_pred": UNKNOWN, "score": 0.0, "accepted": False}, index=range(len(frame)))
            else:
                found = model.predict(frame["text"].tolist())
            yield pd.concat([frame[["id", "held_out"]].reset_index(drop=True), found], axis=1)

    return picked.select("id", held_out(F.col("id")).alias("held_out"), "text").mapInPandas(
        score, "id long, held_out boolean, lang_pred string, score double, accepted boolean"
    )
