"""Scores of single grams, and what calibration brings to the driver."""

import numpy as np

from kpiweave.llm import toxicity


def test_grams_are_scored_exactly_and_unseen_ones_by_backoff():
    rng = np.random.default_rng(3)
    every = np.unique(rng.integers(0x61616161, 0x7A7A7A7A, 60_000, dtype=np.uint32))
    order = np.argsort(toxicity._slots(every), kind="stable")
    same = np.flatnonzero(np.diff(toxicity._slots(every)[order].astype(np.int64)) == 0)
    assert len(same)  # grams in one slot
    left_out = np.zeros(len(every), bool)
    left_out[rng.integers(0, len(every), 500)] = True
    left_out[order[np.concatenate([same, same + 1])]] = False
    keys = every[~left_out]
    counts = [rng.integers(0, 4, len(keys)) for _ in range(2)]
    counts[0][(counts[0] + counts[1]) == 0] = 1
    model = toxicity.ratio_model(keys, *counts)
    shared = toxicity.Backoff.shared(keys, toxicity.ORDER)
    classes = [toxicity.Backoff(keys[c > 0], c[c > 0], toxicity.ORDER, shared) for c in counts]
    expected = np.log(classes[1].probability(every) / classes[0].probability(every))
    assert np.allclose(model.ratio_of(every), expected, atol=1e-5)


def test_calibration_brings_no_text_to_the_driver(spark):
    keys = np.unique(toxicity.grams(np.frombuffer(b" some words of no meaning ", np.uint8)))
    trial = toxicity.ratio_model(keys, np.ones(len(keys), int), np.arange(len(keys)))
    texts = ["some words", None, "meaning " * 50_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    labelled = spark.createDataFrame([(0, 0, 1), (1, 1, 1), (2, 1, 1)], "id long, label int, fold int")
    sample, totals = toxicity._calibration(docs, labelled, 10, trial)
    assert list(sample.columns) == ["id", "label", "ratio"] and totals == {0: 1, 1: 2}
    assert np.allclose(sample["ratio"], trial.ratios(texts))
