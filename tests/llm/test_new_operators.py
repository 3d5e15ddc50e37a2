"""Source divergence audit, sharding and importance resampling against plain versions, with edge cases."""

import collections
import hashlib
import math
import random
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F

from kpiweave.llm import divergence, oracle, resampling, sharding
from test_llm_edges import SCHEMA, document, frame, prose


def corpus(spark, n=120, seed=7):
    rng = random.Random(seed)
    vocab = ["alpha", "Beta", "gamma", "Ünïcode", "δέλτα", "epsilon", "zeta", "eta", "theta", "iota", "kappa", "lambda"]
    rows = []
    for i in range(n):
        lang = rng.choice(["en", "fr", None])
        source = rng.choice(["s0", "s0", "s1", "s2", None])
        words = [rng.choice(vocab) + rng.choice(["", ",", "!", "42", "'s"]) for _ in range(rng.randint(0, 30))]
        rows.append(document(i, " ".join(words) if i % 17 else None, lang, source))
    rows += [document(500, "alpha beta", "en", "lonely"), document(501, "", "en", "lonely"), document(1, rows[1][1], rows[1][2], rows[1][3])]
    return spark.createDataFrame(rows, SCHEMA)


def sorted_rows(pdf, columns):
    def plain(v):
        return None if v is None or (isinstance(v, float) and math.isnan(v)) else v

    found = [tuple(plain(v) for v in r) for r in pdf[columns].itertuples(index=False)]
    return sorted(found, key=lambda t: tuple((True, 0) if v is None else (False, v) for v in t))


def test_divergence_equals_the_plain_sql(spark):
    docs = corpus(spark)
    got = divergence.audit(docs).toPandas()
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    want = con.execute(oracle.divergence_sql()).df()
    columns = ["lang", "source", "part", "item", "value", "rank"]
    assert len(got) > 20
    assert sorted_rows(got, columns) == sorted_rows(want, columns)
    # Every group has a pair row per other source of its lang, the lonely source included.
    assert set(got[(got.source == "lonely") & (got.part == "pair")].item) == {"s0", "s1", "s2", ""}
    assert got[got.part == "term"].groupby(["lang", "source"]).size().max() <= divergence.TOP_TERMS


def test_divergence_of_a_lang_without_kept_terms(spark):
    rows = [document(i, "word" if i < 3 else None, "xx", f"s{i % 2}") for i in range(6)]
    got = divergence.audit(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in got) == [
        ("s0", "pair", "s1", 0, 1), ("s1", "pair", "s0", 0, 1)
    ]


def test_divergence_shuffles_terms_once(spark):
    """Shuffling (document, chunk) pairs took the query over its disk budget."""
    plan = divergence.term_counts(corpus(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(") == 1 and "Exchange hashpartitioning(lang" in plan and "explode" not in plan.lower()
    got = {(r["lang"], r["source"], r["term"]): (r["count"], r["docs"]) for r in divergence.term_counts(corpus(spark)).collect()}
    assert got == plain_terms([(r["lang"], r["source"], r["text"]) for r in corpus(spark).collect()])


def plain_terms(rows):
    """Occurrences and documents of each (lang, source, term), in Python."""
    term, lower = regex.compile(divergence.TERM), str.maketrans(divergence.UPPER, divergence.LOWER)
    counts, docs = collections.Counter(), collections.Counter()
    for lang, source, text in rows:
        found = collections.Counter(term.findall((text or "").translate(lower)))
        for word, n in found.items():
            counts[lang or "", source or "", word] += n
            docs[lang or "", source or "", word] += 1
    return {k: (counts[k], docs[k]) for k in counts}


@pytest.mark.parametrize("block, chunks, pairs", [(4 << 20, 1 << 19, 1 << 22), (64, 1 << 19, 1 << 22), (1, 5, 1 << 22), (300, 1 << 19, 40)])
def test_divergence_counts_in_blocks(monkeypatch, block, chunks, pairs):
    """Whatever the bounds of a task, a document's terms count once, also where a long text is cut in parts."""
    for name, value in (("BLOCK", block), ("CHUNKS", chunks), ("PAIRS", pairs)):
        monkeypatch.setattr(divergence, name, value)
    rng = random.Random(5)
    vocab = ["Ab", "ab,", "ab-cd", "CD!ab", "É", "é", "x1y", "42", "\x00", "a\u00a0b", "İ", "...", "東京"]
    rows = [("", "", ""), ("en", "s0", "..."), ("en", "s0", " \t\x0b\x0c\r\n"), ("fr", "", "\u2003É\x1cÉ\x85")]
    rows += [(rng.choice(["en", "fr"]), rng.choice(["s0", "s1"]), rng.choice(" \t\n\x0b").join(rng.choice(vocab) for _ in range(rng.choice([1, 8, 300])))) for _ in range(60)]
    batches = [
        pa.RecordBatch.from_arrays([pa.array([r[0] for r in part]), pa.array([r[1] for r in part]), pa.array([r[2].encode() for r in part], pa.binary())], ["lang", "source", "text"])
        for part in (rows[:7], rows[7:8], rows[8:])
    ]
    found = collections.defaultdict(lambda: (0, 0))
    for batch in divergence._counted(iter(batches)):
        for r in batch.to_pylist():
            key = r["lang"], r["source"], r["term"].decode()
            found[key] = found[key][0] + r["count"], found[key][1] + r["docs"]
    assert found == plain_terms(rows)
    assert list(divergence._counted(iter([]))) == []


def test_p_values_are_exact_for_any_count(spark):
    counts = [0, 1, 2**33 - 1, 2**33, 2**33 + 1, 10**15 + 7]
    rows = spark.createDataFrame([(n, n + 10**9, v) for n in counts for v in (0, 1, 131_071)], "n long, total long, v long")
    for n, total, v, p in rows.withColumn("p", divergence.p_value("n", "total", "v")).collect():
        assert p == (1 + 10**9 * (n + 2) // (total + 2 * v) if v else None)


def test_divergence_of_nothing(spark, none):
    assert divergence.audit(none).count() == 0


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_permutation_is_fisher_yates():
    n, seed, bucket = 50, 3, 9
    items = list(range(n))
    draws = np.random.Generator(np.random.PCG64([seed, bucket])).integers(0, np.arange(n - 1, 0, -1) + 1).tolist()
    for i, j in zip(range(n - 1, 0, -1), draws):
        items[i], items[j] = items[j], items[i]
    place = sharding.permutation(n, seed, bucket)
    assert [items[p] for p in range(n)] == [int(np.flatnonzero(place == p)[0]) for p in range(n)]
    assert sorted(place.tolist()) == list(range(n))
    assert sharding.permutation(0, 1, 1).tolist() == [] and sharding.permutation(1, 1, 1).tolist() == [0]


def test_shards_hold_the_rows_law(spark):
    docs = frame(spark).unionByName(spark.createDataFrame([document(77, "same text")] * 300, SCHEMA))
    got = sharding.assign(docs, shards=16, bucket_rows=40).toPandas()
    assert len(got) == docs.count()
    counts = got.groupby("__shard").size()
    assert len(counts) == 16 and counts.max() - counts.min() <= 1
    for _, part in got.groupby("__shard"):
        assert sorted(part["__slot"]) == list(range(len(part)))
    # 300 equal rows are spread over all shards, not kept together.
    assert got[got.doc_id == 77]["__shard"].nunique() == 16
    sizes = sorted(
        (r["doc_id"] is None, r["doc_id"] or 0, len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode()))
        for r in docs.collect()
    )
    assert sizes == sorted((d is None, int(d or 0), s, c) for d, s, c in sorted_rows(got, ["doc_id", "__size", "__crc"]))
    again = sharding.assign(docs, shards=16, bucket_rows=40).toPandas()
    assert sorted_rows(got, ["doc_id", "__shard", "__slot"]) == sorted_rows(again, ["doc_id", "__shard", "__slot"])


def test_shard_places_follow_the_buckets(spark, tmp_path):
    docs = spark.createDataFrame([document(i, prose(i, 5)) for i in range(90)], SCHEMA)
    got = sharding.assign(docs, shards=4, bucket_rows=20, seed=5)
    shards = sorted_rows(got.toPandas(), ["__shard", "__slot"])
    assert shards == sorted((p % 4, p // 4) for p in range(90))
    sharding.write(got, str(tmp_path / "out"), shards=4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 90 and back.select("__shard").distinct().count() == 4


def test_shard_nothing(spark, none):
    assert sharding.assign(none).count() == 0


def plain_draw(docs, target, percent=10):
    """Brute force of the draw, in Python."""
    word = regex.compile(resampling.WORD)
    lower = str.maketrans(resampling.UPPER, resampling.LOWER)

    def split(text):
        return word.findall((text or "").translate(lower))

    def bucket(w):
        return zlib.crc32(w.encode()) % resampling.BUCKETS

    s, t = [0] * resampling.BUCKETS, [0] * resampling.BUCKETS
    for _, text in docs:
        for w in split(text):
            s[bucket(w)] += 1
    for text in target:
        for w in split(text):
            t[bucket(w)] += 1
    S, T = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000)))) for b in range(resampling.BUCKETS)]
    out = []
    for doc_id, text in docs:
        found = split(text)
        total = sum(gain[bucket(w)] for w in found)
        weight = total // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(found), weight, score, None])
    eligible = [r for r in out if r[1] >= resampling.MIN_WORDS]
    eligible.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for i, r in enumerate(eligible[: percent * len(eligible) // 100]):
        r[4] = i + 1
    return out


@pytest.mark.parametrize("finish", [10_000, 3])
def test_draw_equals_brute_force(spark, monkeypatch, finish):
    monkeypatch.setattr(resampling, "FINISH", finish)
    rng = random.Random(3)
    vocab = ["the", "Model", "data", "sky", "Über", "x1", "q", "ask", "answer", "42abc", "λόγος", "zz"]
    docs = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(0, 60)))) for i in range(300)]
    docs += [(None, " ".join(vocab * 3)), (5, docs[5][1]), (900, None), (901, "")]
    target = [" ".join(rng.choice(vocab[:4]) for _ in range(50)) for _ in range(5)] + [None]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame([(i, x) for i, x in enumerate(target)], "item_id long, text string")
    got = resampling.draw(d, b).orderBy("id", "rank").collect()
    want = plain_draw(docs, target)
    key = lambda r: (r[0] is None, r[0] or 0, r[4] is None, r[4] or 0)
    assert sorted((list(r) for r in got), key=key) == sorted(want, key=key)
    ranks = sorted(r["rank"] for r in got if r["rank"] is not None)
    assert ranks == list(range(1, len(ranks) + 1)) and len(ranks) == sum(1 for r in want if r[1] >= 20) // 10


def test_draw_of_nothing_and_of_short_texts(spark, none):
    assert resampling.draw(none, none).count() == 0
    short = spark.createDataFrame([document(i, "a b c") for i in range(5)], SCHEMA)
    got = resampling.draw(short, short).collect()
    assert len(got) == 5 and all(r["rank"] is None and r["n_features"] == 3 for r in got)


def test_draw_with_clashing_columns(spark):
    got = resampling.draw(frame(spark), frame(spark).select("text"))
    assert got.count() == frame(spark).count()
    assert got.where(F.col("rank").isNotNull()).count() == frame(spark).where(F.size(resampling.words(F.col("text"))) >= 20).count() // 10


def test_draw_splits_each_text_once(spark):
    """Extracting the words by a pattern, twice a document, took the query over its CPU budget."""
    plan = resampling.scored(frame(spark), [0] * resampling.BUCKETS)._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "regexp_extract_all" not in plan
    # Once in the plan: neither the number of words nor the sum of gains splits the text again.
    assert plan.count("split(") == 1


def test_draw_words_are_those_of_the_pattern(spark):
    signs = "".join(map(chr, range(128)))
    texts = ["", " ", "Ab", "-Ab- 1c--", "İstanbul \u212A Kelvin ÉÀ x", "ǅ z\u00a0y Ω", "\x00a\x7fb", "A\u0301B", None, signs, signs + "é" + signs, "😀A😀 b"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    word, lower = regex.compile(resampling.WORD), str.maketrans(resampling.UPPER, resampling.LOWER)
    got = rows.select("id", resampling.words(F.col("text")).alias("w"), resampling.buckets(F.col("text")).alias("b")).orderBy("id").collect()
    want = [word.findall((t or "").translate(lower)) for t in texts]
    assert [r["w"] for r in got] == want
    assert [r["b"] for r in got] == [[zlib.crc32(w.encode()) % resampling.BUCKETS for w in ws] for ws in want]


def test_langid_letters_are_unicode_letters():
    from kpiweave.llm import langid

    assert langid._LETTER.search("½ ② ³ 42 _ !") is None
    assert all(langid._LETTER.search(t) for t in ("é", "東", "Ω", "x"))


@pytest.mark.parametrize("text", [" " * 2_000_000, "\n" * 2_000_000, "\t" * 2_000_000, "7" * 2_000_000, "!" * 2_000_000, "x" * 2_000_000, "ab  \n\n 12 ,," * 200_000])
def test_packing_encodes_long_runs_like_tokenizers(text):
    from kpiweave.llm import packing

    enc = packing.encoder(packing.default_tokenizer())
    assert np.frombuffer(enc.encode(text), "<u4").tolist() == enc.tokenizer.encode(text, add_special_tokens=False).ids
