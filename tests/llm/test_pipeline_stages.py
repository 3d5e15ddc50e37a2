"""Each stage of the pipeline, and all of them, against a plain Python version on a small fixture."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from kpiweave.llm import packing, quality
from kpiweave.llm.queries import ratings
from test_llm_results import WORD, grouped, shingles

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path, rng = str(tmp_path_factory.mktemp("pipeline")), random.Random(11)
    word = lambda: "".join(rng.choice("aeioulmnrst") for _ in range(6))
    passage, rows, marks = [word() for _ in range(50)], [], []
    for i in range(120):
        words = [word() for _ in range(rng.randint(60, 120))]
        if i % 3 == 0:
            words[::4] = ["zzq"] * len(words[::4])  # what poor texts have
        if i % 7 == 1:
            words[20:20] = passage
        rows.append((i, " ".join(words), "en", f"s{i % 3}", 0))
        marks.append((i, int(i % 3 > 0), 0))
    rows += [(200 + i, rows[i][1] + " more", "en", f"s{i % 2}", 0) for i in range(0, 120, 10)]
    rows += [(300, None, "en", "s0", 0), (301, "", "en", None, 0), (302, "p " * 9000, "en", "s1", 0), (400, rows[1][1], "en", "s2", 0)]
    rows += [(400, rows[2][1] + " again", "en", "s2", 0), (None, rows[4][1], "en", "s2", 0), (None, "no id at all", "en", "s2", 0)]
    spark.createDataFrame([r[:4] + (len(r[1] or ""),) for r in rows], SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def rows_of(df):
    return [tuple(r) for r in df.select(*COLUMNS).collect()]


def good(spark, docs, folder):
    frame = spark.createDataFrame(docs, SCHEMA)
    model = quality.learn(frame.select(F.col("doc_id").alias("id"), "text"), ratings(spark, folder))
    return [r for r, tail in zip(docs, model.predict([r[1] for r in docs], quality.GOOD)["tail"]) if tail >= 0.5]


def heads(docs):
    order = sorted(range(len(docs)), key=lambda i: (docs[i][0] is None, docs[i][0] or 0))
    roots = grouped({k: shingles(docs[i][1], 5) for k, i in enumerate(order)}, 80)
    return [docs[i] for k, i in enumerate(order) if roots[k] == k]


def without_passages(docs, window=35):
    words = [WORD.findall(r[1] or "") for r in docs]
    seen = collections.Counter(tuple(w[s : s + window]) for w in words for s in range(len(w) - window + 1))
    result = []
    for r, own in zip(docs, words):
        gone = {k for s in range(len(own) - window + 1) if seen[tuple(own[s : s + window])] > 1 for k in range(s, s + window)}
        text = " ".join(w for k, w in enumerate(own) if k not in gone) if gone else r[1]
        result.append((r[0], text, r[2], r[3], None if text is None else len(text)))
    return result


def copies(docs):
    number = lambda text: int(hashlib.md5(text.encode()).hexdigest()[:8], 16)
    size = lambda r: len(WORD.findall(r[1] or ""))
    sources = sorted({r[3] for r in docs}, key=lambda s: (s is None, s or ""))
    total = {s: sum(size(r) for r in docs if r[3] == s) for s in sources}
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sources)}
    left, free, target = 1.5 * sum(total.values()), list(sources), {}
    while True:  # those that reach their limit of 2 give the rest to others
        full = [s for s in free if 2.0 * total[s] <= left * weight[s] / sum(weight[f] for f in free)]
        if not full:
            break
        for s in full:
            target[s] = 2.0 * total[s]
        left, free = left - sum(target[s] for s in full), [s for s in free if s not in full]
    target |= {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
    result = []
    for s in sources:
        def line(r):
            n = size(r)
            width = n.bit_length()
            kind = width * 8 + ((n * 8) >> (width - 1)) % 8 if n else 0
            return kind, number("" if r[0] is None else str(r[0])) % 256, n, r[0] is None, r[0] or 0, hashlib.md5((r[1] or "").encode()).hexdigest()

        rate, shift = (target[s] / total[s] if total[s] else 0.0), number(f"mix:{s or ''}") / 2**32
        for place, r in enumerate(sorted((r for r in docs if r[3] == s), key=line), 1):
            result += [r] * min(math.floor(shift + rate * place) - math.floor(shift + rate * (place - 1)), math.ceil(rate))
    return result


def pieces(docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    for r in docs:
        ids = np.array(tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [1], "<u4")
        for start in range(0, len(ids), 2048):
            own = ids[start : start + 2048]
            yield r[0], start, len(own), zlib.crc32(own.tobytes()), len(ids)


def same_pieces(df, docs):
    found, sequences = df.collect(), collections.defaultdict(list)
    assert collections.Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in found) == collections.Counter(pieces(docs))
    for r in found:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in sequences.values():
        own.sort()
        assert own[0][0] == 0 and sum(own[-1]) <= 2048 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:]))


PLAIN = [good, lambda spark, docs, folder: heads(docs), lambda spark, docs, folder: without_passages(docs), lambda spark, docs, folder: copies(docs)]


def test_stages_and_run_equal_plain_python(spark, folder):
    given = spark.read.parquet(f"{folder}/documents.parquet")
    docs = rows_of(given)
    for (name, stage), plain in zip(corpus_pipeline.STAGES, PLAIN):
        expected = plain(spark, docs, folder)
        found = rows_of(stage(spark, spark.createDataFrame(docs, SCHEMA).repartition(3), folder))
        assert collections.Counter(found) == collections.Counter(expected), name
        assert collections.Counter(expected) != collections.Counter(docs), name  # each has work
        docs = expected
    same_pieces(corpus_pipeline.packed(spark, spark.createDataFrame(docs, SCHEMA), folder), docs)
    same_pieces(corpus_pipeline.run(spark, folder), docs)
