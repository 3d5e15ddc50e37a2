"""Toxicity: two Kneser-Ney models of byte n-grams, one of toxic and one of ordinary texts, over one shared backoff."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kpiweave.llm import langid
from kpiweave.llm.hashing import BLOCK, batches
from kpiweave.llm.stage import on_workers
from kpiweave.llm.training import FOLDS, held_out, learnable

ORDER = 4
TABLE_BITS = 22
PER_CLASS = 1000
NORM = 0.75  # between the mean, which few words in a long text hardly move, and the root, which long texts' noise moves
CLASSES = (0, 1)

_SPACES = re.compile(rb"  +")


def normal(text: str | None) -> bytes:
    """Lower-case letters of the text, other characters as single spaces."""
    return _SPACES.sub(b" ", langid.normal(text))


def grams(data: np.ndarray, order: int = ORDER) -> np.ndarray:
    """Each ``order`` bytes in a row as a number."""
    count = max(len(data) - order + 1, 0)
    key = np.zeros(count, np.uint32)
    for k in range(order):
        key = (key << np.uint32(8)) | data[k : k + count]
    return key


def _slots(key: np.ndarray) -> np.ndarray:
    return (key * np.uint32(0x9E3779B1)) >> np.uint32(32 - TABLE_BITS)


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not keys:
        return np.zeros(0, np.uint32), np.zeros((0, 2 * len(CLASSES)))
    found, place = np.unique(np.concatenate(keys), return_inverse=True)
    every = np.concatenate(counts)
    return found, np.stack([np.bincount(place, every[:, k], len(found)) for k in range(every.shape[1])], axis=1)


def count_grams(labelled: DataFrame) -> DataFrame:
    """(gram, and its count for each fold and class as f0c0, f0c1, f1c0, f1c1) over all of (text, label, fold)."""
    columns = [f"f{f}c{c}" for f in (0, 1) for c in CLASSES]

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, counts = [], []
        for frame in frames:
            for kind, part in frame.groupby(frame["fold"] * len(CLASSES) + frame["label"]):
                texts = [normal(t) for t in part["text"]]
                for i, j in batches(texts):
                    data = np.frombuffer(b"\x00".join(texts[i:j]), np.uint8)
                    for at in range(0, max(len(data) - ORDER + 1, 0), 4 * BLOCK):
                        found, n = np.unique(grams(data[at : at + 4 * BLOCK + ORDER - 1]), return_counts=True)
                        table = np.zeros((len(found), len(columns)))
                        table[:, int(kind)] = n
                        keys.append(found)
                        counts.append(table)
                if len(keys) > 64:
                    merged = _merged(keys, counts)
                    keys, counts = [merged[0]], [merged[1]]
        found, table = _merged(keys, counts)
        bytes_ = found.view(np.uint8).reshape(-1, 4) if len(found) else np.zeros((0, 4), np.uint8)
        inside = (bytes_ != 0).all(1)  # those over the end of a text have the separator in them
        yield pd.DataFrame({"gram": found[inside].astype(np.int64), **{c: table[inside, k].astype(np.int64) for k, c in enumerate(columns)}})

    schema = "gram long, " + ", ".join(f"{c} long" for c in columns)
    return on_workers(labelled).select("text", "label", "fold").mapInPandas(count, schema).groupBy("gram").agg(*[F.sum(c).alias(c) for c in columns])


class Backoff:
    """Interpolated Kneser-Ney over one table of counts; the lower orders count the bytes seen before a gram."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, order: int, lower: Backoff | None):
        self.keys, self.order, self.lower = keys, order, lower
        self.counts = counts.astype(float)
        self.contexts, place = np.unique(keys >> np.uint32(8), return_inverse=True)
        self.totals = np.bincount(place, self.counts, len(self.contexts))
        self.kinds = np.bincount(place, self.counts > 0, len(self.contexts)).astype(float)
        once, twice = (self.counts == 1).sum(), (self.counts == 2).sum()
        self.discount = once / (once + 2 * twice) if once else 0.5

    @staticmethod
    def shared(types: np.ndarray, order: int) -> Backoff | None:
        """Continuation counts of orders below ``order`` from the distinct grams of both classes."""
        levels = []
        for k in range(order - 1, 0, -1):
            types, before = np.unique(types & np.uint32((1 << 8 * k) - 1), return_counts=True)
            levels.append((types, before, k))
        lower = None
        for keys, before, k in reversed(levels):
            lower = Backoff(keys, before, k, lower)
        return lower

    def backoff_weight(self, contexts: np.ndarray) -> np.ndarray:
        """The part of the lower orders' probability that a gram has which was not seen after its context."""
        total, kinds = _find(self.contexts, self.totals, contexts), _find(self.contexts, self.kinds, contexts)
        return np.where(total > 0, self.discount * kinds / np.maximum(total, 1), 1.0)

    def probability(self, grams_: np.ndarray) -> np.ndarray:
        """Probability of each gram's last byte after the ones before it."""
        key = grams_ & np.uint32((1 << 8 * self.order) - 1)
        below = self.lower.probability(grams_) if self.lower else np.full(len(key), 1 / 256)
        total, kinds = _find(self.contexts, self.totals, key >> np.uint32(8)), _find(self.contexts, self.kinds, key >> np.uint32(8))
        seen = np.maximum(_find(self.keys, self.counts, key) - self.discount, 0)
        return np.where(total > 0, (seen + self.discount * kinds * below) / np.maximum(total, 1), below)


def _find(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(wanted))
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0.0)


@dataclass
class Model:
    keys: np.ndarray  # sorted grams that were seen
    ratio: np.ndarray  # log-likelihood ratio of each
    contexts: np.ndarray  # sorted beginnings that were seen
    backoff: np.ndarray  # log ratio of the weights by which an unseen gram falls back to the shared lower orders, by beginning
    slots: np.ndarray  # by hash of a gram the place among the keys of the most frequent one there: a short cut to it
    slope: float = 1.0
    shift: float = 0.0

    def ratio_of(self, found: np.ndarray) -> np.ndarray:
        """Log-likelihood ratio of each gram. The lower orders are shared, so that of an unseen one is its backoff's."""
        at = self.slots[_slots(found)]
        values = self.ratio[at]
        missed = np.flatnonzero(self.keys[at] != found)
        if len(missed):
            rest = found[missed]
            at = np.minimum(np.searchsorted(self.keys, rest), len(self.keys) - 1)
            values[missed] = np.where(self.keys[at] == rest, self.ratio[at], _find(self.contexts, self.backoff, rest >> np.uint32(8)))
        return values

    def ratios(self, texts: list[str | None]) -> np.ndarray:
        """Log-likelihood of each text under the toxic less that under the ordinary model, over a power of its words."""
        raw = [normal(t) for t in texts]
        total, words = np.zeros(len(raw)), np.array([max(t.count(b" ") - 1, 1) for t in raw])
        for i, j in batches(raw):
            data = np.frombuffer(b"".join(raw[i:j]), np.uint8)
            if j == i + 1:
                for at in range(0, max(len(data) - ORDER + 1, 0), BLOCK):
                    total[i] += self.ratio_of(grams(data[at : at + BLOCK + ORDER - 1])).sum(dtype=np.float64)
                continue
            offsets = np.concatenate([[0], np.cumsum([len(t) for t in raw[i:j]])])
            values = np.concatenate([self.ratio_of(grams(data)), np.zeros(min(ORDER - 1, len(data)), np.float32)])
            for k in range(1, ORDER):
                over = offsets[1:] - k
                values[over[over >= offsets[:-1]]] = 0
            filled = np.flatnonzero(np.diff(offsets) > 0)
            if len(filled):
                total[i + filled] = np.add.reduceat(values, offsets[filled], dtype=np.float64)
        return total / words**NORM

    def score(self, texts: list[str | None]) -> np.ndarray:
        return 0.5 * (1 + np.tanh(0.5 * (self.slope * self.ratios(texts) + self.shift)))


def ratio_model(keys: np.ndarray, ordinary: np.ndarray, toxic: np.ndarray) -> Model:
    """The log-likelihood ratios of both classes, of sorted ``keys`` with their counts."""
    shared = Backoff.shared(keys, ORDER)
    models = [Backoff(keys[c > 0], c[c > 0], ORDER, shared) for c in (ordinary, toxic)]
    ratio = np.log(models[1].probability(keys) / models[0].probability(keys)).astype(np.float32)
    contexts = np.unique(keys >> np.uint32(8))
    weights = [np.log(m.backoff_weight(contexts)) for m in models]
    slots = np.zeros(1 << TABLE_BITS, np.int32)
    rare_first = np.argsort(ordinary + toxic, kind="stable")
    slots[_slots(keys[rare_first])] = rare_first
    return Model(keys, ratio, contexts, (weights[1] - weights[0]).astype(np.float32), slots)


def calibrate(model: Model, ratios: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> Model:
    """Score 0.5 where the weighted errors are fewest, midway between neighbours; the slope around it by logistic
    regression."""
    if len(set(labels.tolist())) < 2:
        return model
    order = np.argsort(ratios, kind="stable")
    x, y, w = ratios[order], labels[order], weights[order]
    missed = np.concatenate([[0.0], np.cumsum(w * y)])
    wrong = missed + np.concatenate([np.cumsum((w * (1 - y))[::-1])[::-1], [0.0]])
    edges = np.concatenate([[x[0] - 1], (x[1:] + x[:-1]) / 2, [x[-1] + 1]])
    fewest = np.flatnonzero(wrong <= wrong.min() + 1e-9)
    middle = edges[fewest[len(fewest) // 2]]
    slopes = np.geomspace(0.05, 50, 60)
    loss = [(w * np.logaddexp(0, np.where(y == 1, -1, 1) * k * (x - middle))).sum() for k in slopes]
    slope = float(slopes[int(np.argmin(loss))])
    return replace(model, slope=slope, shift=-slope * float(middle))


def learn(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model | None:
    """Both models from all labelled texts of (id, text) and (id, label), whose id's crc32 is not divisible by 5.

    Counts cover every such text. A fifth of them is counted apart: the models of the other four fifths score at most
    ``per_class`` texts of it in each class, which calibrates the score; the final models use all counts. The counted
    grams are of 4 bytes, so their number follows the alphabets and not the corpus; all of them are looked up exactly."""
    crc = F.crc32(F.col("id").cast("string").cast("binary"))
    labelled = (
        labels.where(learnable(F.col("id")) & F.col("label").isin(*CLASSES))
        .select("id", F.col("label").cast("int").alias("label"), (F.floor(crc / FOLDS) % FOLDS == 0).cast("int").alias("fold"))
    )
    counted = count_grams(docs.where(learnable(F.col("id"))).join(labelled.hint("merge"), "id")).toPandas().sort_values("gram")
    if not len(counted):
        return None
    keys = counted["gram"].to_numpy().astype(np.uint32)
    first = [counted[f"f0c{c}"].to_numpy() for c in CLASSES]
    both = [a + counted[f"f1c{c}"].to_numpy() for c, a in zip(CLASSES, first)]
    if not all(a.sum() for a in both):
        return None
    trial, model = ratio_model(keys, *(first if all(a.sum() for a in first) else both)), ratio_model(keys, *both)
    sample, totals = _calibration(docs, labelled, per_class, trial)
    if not len(sample):
        return model
    label = sample["label"].to_numpy()
    weights = np.array([totals[c] / (label == c).sum() for c in label])
    return calibrate(model, sample["ratio"].to_numpy(), label, weights)


def _calibration(docs: DataFrame, labelled: DataFrame, per_class: int, trial: Model) -> tuple[pd.DataFrame, dict[int, int]]:
    """(id, label, ratio) under ``trial`` of the sample, and how many each label has. Texts stay on the executors."""

    def rate(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"id": frame["id"], "label": frame["label"], "ratio": trial.ratios(frame["text"].tolist())})

    apart = labelled.where("fold = 1")
    totals = {r["label"]: r["n"] for r in apart.groupBy("label").agg(F.count("*").alias("n")).collect()}
    first = Window.partitionBy("label").orderBy(F.xxhash64("id"), "id")
    picked = apart.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= per_class).select("id", "label")
    sample = on_workers(docs).join(F.broadcast(picked), "id").select("id", "label", "text")
    id_type = docs.schema["id"].dataType.simpleString()
    sample = sample.mapInPandas(rate, f"id {id_type}, label int, ratio double").toPandas()
    return sample.sort_values(["id", "label", "ratio"], ignore_index=True), totals


def judge(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic", per_class: int = PER_CLASS,
) -> DataFrame:
    """(id, held_out, score, predicted) of each whole text; predicted is 1 from a score of 0.5 on.

    Null and empty texts have a ratio of 0 and so the score of a text that says nothing. Without labels of both classes
    the score is 0 throughout. Labels other than 0 and 1, of null ids or of ids without a document are not used; an id
    labelled twice counts twice. Rows are judged one by one."""
    picked = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    model = learn(picked, labels.select(F.col(id_column).alias("id"), F.col(label_column).alias("label")), per_class)

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = model.score(frame["text"].tolist()) if model else np.zeros(len(frame))
            yield pd.DataFrame({
                "id": frame["id"], "held_out": frame["held_out"], "score": found, "predicted": (found >= 0.5).astype(np.int32)
            })

    return picked.select("id", held_out(F.col("id")).alias("held_out"), "text").mapInPandas(
        score, "id long, held_out boolean, score double, predicted int"
    )
