"""Quality: cumulative-link ordinal regression over hashed text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from kpiweave.llm import ngrams
from kpiweave.llm.stage import on_workers, own_columns
from kpiweave.llm.training import features, learnable, sample_ids

SIZES = (1, 2, 3)
BITS = 15
PER_GRADE = 1000
EPOCHS = 12
RATE = 0.5
DECAY = 1e-5
GOOD = 1
KEEP = 0.5
REPEAT = b"\x01"


def normal(text: str | None) -> bytes:
    """The text in UTF-8, letter case and punctuation kept, as they tell quality; a word that repeats the one before it
    is written as one mark, so that runs of any word look alike."""
    if not text:
        return b""
    words = text.encode("utf-8", "surrogatepass").split(b" ")
    return b" ".join([words[0], *[REPEAT if a == b else b for a, b in zip(words, words[1:])]])


def sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * np.asarray(x, float)))


@dataclass
class Model:
    """P(grade > grades[k]) = sigmoid(weights . x - cuts[k]), with the weights shared and the cuts ascending."""

    grades: list[int]
    weights: np.ndarray
    cuts: np.ndarray

    def tails(self, texts: list[str | None]) -> np.ndarray:
        total, counts = ngrams.sums([normal(t) for t in texts], self.weights[:, None], SIZES, BITS)
        return sigmoid(total / np.maximum(counts, 1)[:, None] - self.cuts)

    def predict(self, texts: list[str | None], good: int = GOOD) -> pd.DataFrame:
        """Expected grade, and probability of a grade of ``good`` or more."""
        tails = self.tails(texts)
        expected = self.grades[0] + tails @ np.diff(self.grades)
        below = [k for k, g in enumerate(self.grades) if g < good]
        tail = tails[:, below[-1]] if below and below[-1] < tails.shape[1] else np.full(len(texts), float(not below))
        return pd.DataFrame({"expected_grade": expected, "tail": tail})


def fit(samples: list[tuple[int, np.ndarray, np.ndarray]], seed: int = 7) -> Model | None:
    """Maximum likelihood by Adagrad, one sample at a time. None without samples."""
    if not samples:
        return None
    grades = sorted({int(g) for g, _, _ in samples})
    place = {g: i for i, g in enumerate(grades)}
    counts = np.bincount([place[int(g)] for g, _, _ in samples], minlength=len(grades))
    above = 1 - np.cumsum(counts)[:-1] / counts.sum()
    # the first cut and the logarithms of the steps between cuts are free, so the cuts stay in order
    cuts = -np.log(above / (1 - above))
    first, steps = (cuts[0] if len(cuts) else 0.0), np.log(np.maximum(np.diff(cuts), 1e-3))
    weights = np.zeros(1 << BITS)
    seen = np.full(1 << BITS, 1e-8)
    seen_first, seen_steps = 1e-2, np.full(len(steps), 1e-2)
    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS if len(grades) > 1 else 0):
        for i in rng.permutation(len(samples)).tolist():
            grade, buckets, shares = samples[i]
            k = place[int(grade)]
            cuts = first + np.concatenate([[0.0], np.cumsum(np.exp(steps))])
            x = shares @ weights[buckets]
            tail = sigmoid(x - cuts)
            upper = tail[k - 1] if k else 1.0
            lower = tail[k] if k < len(cuts) else 0.0
            p = max(upper - lower, 1e-9)
            slope = tail * (1 - tail)
            d_upper = slope[k - 1] if k else 0.0
            d_lower = slope[k] if k < len(cuts) else 0.0
            g = -(d_upper - d_lower) / p
            d_cuts = np.zeros(len(cuts))
            if k:
                d_cuts[k - 1] += d_upper / p
            if k < len(cuts):
                d_cuts[k] -= d_lower / p
            grad = g * shares + DECAY * weights[buckets]
            seen[buckets] += grad * grad
            weights[buckets] -= RATE * grad / np.sqrt(seen[buckets])
            d_first = d_cuts.sum()
            seen_first += d_first * d_first
            first -= 0.05 * d_first / np.sqrt(seen_first)
            if len(steps):
                d_steps = np.cumsum(d_cuts[::-1])[::-1][1:] * np.exp(steps)
                seen_steps += d_steps * d_steps
                steps = steps - 0.05 * d_steps / np.sqrt(seen_steps)
    cuts = first + np.concatenate([[0.0], np.cumsum(np.exp(steps))]) if len(grades) > 1 else np.zeros(0)
    return Model(grades, weights.astype(np.float32), cuts)


def grade_of(quality: Column, toxic: Column) -> Column:
    """Ratings from the given labels: 0 poor, 1 good but toxic, 2 good; null where quality is."""
    return F.when(quality == 0, 0).when(quality == 1, F.when(toxic == 1, 1).otherwise(2))


def learn(docs: DataFrame, ratings: DataFrame, per_grade: int = PER_GRADE) -> Model | None:
    """Learn from at most ``per_grade`` documents (id, text) of each grade in ``ratings`` (id, grade), whose id's crc32 is
    not divisible by 5. The sample is the same on each run; several grades of one id are samples of their own."""
    labelled = ratings.where(learnable(F.col("id"))).select("id", F.col("grade").cast("int").alias("label"))
    return fit(features(docs.select("id", "text"), sample_ids(labelled, per_grade), normal, SIZES, BITS))


def scored(docs: DataFrame, model: Model | None, text_column: str = "text", good: int = GOOD, prefix: str = "") -> DataFrame:
    """``docs`` with expected_grade, tail (probability of a grade of ``good`` or more) and keep (tail at least 0.5) added,
    their names after ``prefix``; columns of the same names are replaced.

    Null and empty texts get the model's bare cuts. Without labels to learn from, grade is null, tail 1 and all is kept.
    Rows are judged one by one."""

    @F.pandas_udf(StructType().add("expected_grade", DoubleType()).add("tail", DoubleType()))
    def predict(texts: pd.Series) -> pd.DataFrame:
        if model is None:
            return pd.DataFrame({"expected_grade": [None] * len(texts), "tail": 1.0})
        return model.predict(texts.tolist(), good)

    added = {f"{prefix}{c}" for c in ("expected_grade", "tail", "keep")}
    names = [column for name, column in zip(docs.columns, own_columns(docs)) if name not in added]
    found = F.col("__quality")
    return (
        on_workers(docs).select(*names, predict(F.col(text_column)).alias("__quality"))
        .select(
            *names, found["expected_grade"].alias(f"{prefix}expected_grade"), found["tail"].alias(f"{prefix}tail"),
            (found["tail"] >= KEEP).alias(f"{prefix}keep"),
        )
    )
