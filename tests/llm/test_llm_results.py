"""Results against brute force, held-out labels, exact round trips and the second engine."""

import collections
import hashlib
import os
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import connect, difference
from kpiweave.llm import components, hamming, hashing, mixing, neardup, ngrams, oracle, packing, queries, substrings, toxicity, urlfilter

SF_DIR = os.environ.get("KPIWEAVE_SF_DIR", "/root/testdata/sf0.001")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
given = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def documents(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


@given
@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_equals_sql(spark, name):
    assert difference(queries.queries()[name](spark, SF_DIR), connect(SF_DIR), oracle.oracle_sql()[name]) is None


def test_word_hashes_do_not_depend_on_their_place():
    texts = [b"one two  three", b"", b"two\nthree one", b" x" * 5]
    words, offsets = hashing.words_of(texts)
    assert offsets.tolist() == [0, 3, 3, 6, 11]
    assert words[1] == words[3] and words[2] == words[4] and words[0] == words[5]
    assert (hashing.word_hashes(b"one two  three") == words[:3]).all()
    assert hashing.windows_inside(offsets, 3).tolist() == [0, 3, 6, 7, 8]
    many = b" ".join(b"w%d" % i for i in range(400_000))  # several blocks
    assert len(set(hashing.word_hashes(many).tolist())) == 400_000


def test_ngram_sums_do_not_depend_on_the_batch():
    rng = np.random.default_rng(1)
    table = rng.normal(size=(1 << 10, 2)).astype(np.float32)
    texts = [b"abc", b"", b"a", bytes(rng.integers(97, 123, 500, dtype=np.uint8)), b"xy", bytes(rng.integers(97, 123, 2_500_000, dtype=np.uint8))]
    together = ngrams.sums(texts, table, (1, 2, 3), 10)
    for i, text in enumerate(texts):
        alone = ngrams.sums([text], table, (1, 2, 3), 10)
        assert alone[1][0] == together[1][i] and np.allclose(alone[0][0], together[0][i], atol=0.05)


@given
def test_mix_comes_near_its_targets(spark):
    rows = queries.op1_mix_sources(spark, SF_DIR).collect()
    assert all(r["taken"] <= 2 * r["size"] for r in rows)
    by_source = collections.defaultdict(list)
    for r in rows:
        by_source[(r["source_size"], r["target"])].append(r)
    for (_, target), own in by_source.items():
        assert abs(sum(r["taken"] for r in own) - target) <= 2 * max(r["size"] for r in own)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, queries.op1_mix_sources(spark, SF_DIR).collect()))


def test_targets_are_shared_by_weight_under_their_limit(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), (None, 100)], "source string, source_size long")
    found = {r["source"]: r["target"] for r in mixing.targets(sizes, (3, 1, 2), 1.5, 2.0).collect()}
    assert found == {"a": 20.0, None: 200.0, "b": pytest.approx(1665 - 220)}


@given
def test_packing_is_a_round_trip(spark, documents):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    tokenizer.encode_special_tokens = True
    ids = {d: tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for d, t in documents.items()}
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in queries.op2_pack_sequences(spark, SF_DIR).collect():
        own = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert (len(own), zlib.crc32(np.array(own, "<u4").tobytes()), len(ids[r["doc_id"]])) == (r["length"], r["ids_crc32"], r["doc_tokens"])
        pieces[r["doc_id"]].append((r["start"], r["length"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for doc_id, own in pieces.items():
        assert sum(n for _, n in own) == len(ids[doc_id]) and all(a + n == b for (a, n), (b, _) in zip(sorted(own), sorted(own)[1:]))
    assert set(pieces) == set(documents)
    for own in sequences.values():
        assert all(a + n == b for (a, n), (b, _) in zip(sorted(own), sorted(own)[1:])) and min(own)[0] == 0
    totals = [sum(n for _, n in own) for own in sequences.values()]
    assert max(totals) <= 2048 and sum(packing.padding(n, 2048) for n in totals) < 4096


def test_both_tokenizer_files_agree():
    from tokenizers import Tokenizer

    encoder = packing.encoder(packing.default_tokenizer())
    plain = Tokenizer.from_file(packing.default_tokenizer())
    plain.encode_special_tokens = True
    rng = random.Random(5)
    alphabet = "abcXYZ 019.,'!?\n\t\r\x0b\x0c\x1c\x85\xa0éßñÄ<|endoftext|>-_/" + "ɏ東\U0001f600"
    for _ in range(3000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def test_fill_takes_every_piece_once():
    rng = random.Random(3)
    counts = np.bincount([rng.randint(1, 99) for _ in range(500)], minlength=101)
    windows = packing.fill(counts, 100)
    used = np.zeros(101, int)
    for pattern, times in windows:
        assert sum(length * n for length, n in pattern) <= 100
        for length, n in pattern:
            used[length] += n * times
    assert (used == counts).all()
    first_fit = []
    for length in np.repeat(np.arange(101), counts)[::-1].tolist():
        room = next((i for i, b in enumerate(first_fit) if b + length <= 100), None)
        if room is None:
            first_fit.append(length)
        else:
            first_fit[room] += length
    assert sum(times for _, times in windows) <= len(first_fit)


@given
def test_language_of_held_out_documents(spark):
    found = queries.op3_language_id(spark, SF_DIR).join(spark.read.parquet(f"{SF_DIR}/documents.parquet"), "doc_id").where("held_out AND lang_pred <> 'und'")
    assert found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.9


def test_toxic_words_are_learnt(spark):
    rng = random.Random(9)
    plain = lambda: ["".join(rng.choice("aeioulmnrst") for _ in range(5)) for _ in range(80)]
    rows, marks = [], []
    for i in range(400):
        words, bad = plain(), i % 4 == 0
        if bad:
            words[::20] = ["vqx" + rng.choice("abcdef") for _ in words[::20]]
        rows.append((i, " ".join(words)))
        marks.append((i, int(bad)))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, toxic int")
    found = toxicity.judge(docs, labels).join(labels.withColumnRenamed("doc_id", "id"), "id").where("held_out").collect()
    wrong = [(r["id"], r["toxic"], r["score"]) for r in found if r["predicted"] != r["toxic"]]
    assert len(wrong) <= 0.05 * len(found), wrong


@given
def test_quality_of_held_out_documents(spark):
    folder = SF_DIR.replace("0.001", "0.01")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    found = queries.op8_quality(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where(held)
    assert found.agg(F.avg((F.col("keep") == (F.col("quality") == 1)).cast("int"))).first()[0] > 0.9


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 3), (200, 201), (201, 202), (202, 200)]
    random.Random(1).shuffle(links)
    found = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)} | {i: 200 for i in (200, 201, 202)}


def shingles(text, n):
    words = WORD.findall((text or "").translate(LOWER))
    return frozenset(zip(*[words[i:] for i in range(n)])) if len(words) >= n else frozenset([tuple(words)] if words else [])


def grouped(sets, percent):
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    names = sorted(sets)
    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


@given
@pytest.mark.parametrize("n", [2, 5])
def test_near_duplicates_equal_brute_force(spark, documents, n):
    found = neardup.near_duplicates(spark.read.parquet(f"{SF_DIR}/documents.parquet"), words=n).collect()
    sets = {i: shingles(t, n) for i, t in documents.items()}
    roots = grouped(sets, 80)
    assert {r["id"]: (r["n_shingles"], r["component_id"]) for r in found} == {i: (len(s), roots[i]) for i, s in sets.items()}


def test_large_groups_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(neardup, "MEMBERS", 20)
    rng = random.Random(2)
    base = [f"w{i}" for i in range(150)]
    texts = {}
    for i in range(90):
        words = list(base)
        for k in rng.sample(range(150), rng.randint(0, 14)):
            words[k] = f"x{rng.randint(0, 10**6)}"
        texts[i] = " ".join(words)
    roots = grouped({i: shingles(t, 2) for i, t in texts.items()}, 80)
    found = neardup.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), words=2).collect()
    assert {r["id"]: r["component_id"] for r in found} == roots


def test_pruning_bounds():
    least = neardup.fewest_matches(0.8, 1e-5)
    rng = np.random.default_rng(4)
    # of pairs right at the threshold, few have too few matches at any step
    assert all((rng.binomial(n, 0.8, 1_000_000) < m).mean() < 1e-4 for n, m in least.items())
    assert least[neardup.HASHES] > 0.6 * neardup.HASHES


def removed(texts, window):
    seen, words = collections.Counter(), {i: WORD.findall(t or "") for i, t in texts.items()}
    for own in words.values():
        seen.update(tuple(own[i : i + window]) for i in range(len(own) - window + 1))
    result = {}
    for i, own in words.items():
        gone = set()
        for s in range(len(own) - window + 1):
            if seen[tuple(own[s : s + window])] > 1:
                gone.update(range(s, s + window))
        kept = " ".join(w for k, w in enumerate(own) if k not in gone)
        result[i] = (len(own), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return result


@given
def test_substring_dedup_equals_brute_force(spark, documents):
    found = substrings.digests(spark.read.parquet(f"{SF_DIR}/documents.parquet")).collect()
    assert {r["id"]: tuple(r)[1:] for r in found} == removed(documents, 35)


@pytest.mark.parametrize("window", [3, 8, 35])
def test_repeats_at_any_alignment(spark, window):
    rng = random.Random(window)
    passage = [f"p{i}" for i in range(window + 2)]
    texts = {}
    for i in range(40):
        words = [f"u{i}x{k}" for k in range(rng.randint(0, 30))]
        cut = passage[: window - 1] if i % 4 == 0 else passage[rng.randint(0, 2) :]
        texts[i] = " ".join(words + (cut if i % 3 else cut + ["gap"] + cut) + [f"v{i}"] * rng.randint(0, window + 3))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    assert {r["id"]: tuple(r)[1:] for r in substrings.digests(docs, window).collect()} == removed(texts, window)


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(8)
    codes = rng.integers(-(2**63), 2**63, 300).tolist() + [5, 5, 5, 5, 7] + [int(x) for x in range(40)]
    rows = [(i, c) for i, c in enumerate(codes)]
    frame = spark.createDataFrame(rows, "id long, code long")
    found = hamming.top_k(frame, frame.where("id % 20 = 0"), k=4).collect()
    expected = set()
    for i, c in rows[::20]:
        near = sorted((bin((c ^ d) & (2**64 - 1)).count("1"), j) for j, d in rows if j != i)[:4]
        expected |= {(i, n, j, d) for n, (d, j) in enumerate(near, 1)}
    assert {tuple(r) for r in found} == expected


def test_trust_follows_links_and_distrust_goes_back(spark):
    page = lambda i, host, *to: (i, f"http://{host}/p{i}", "".join(f'<a href="http://{t}/x">' for t in to))
    pages = spark.createDataFrame(
        [page(1, "good.org", "liked.com"), page(2, "bad.net"), page(3, "farm.com", "bad.net"), page(4, "farm.com", "bad.net", "farm.com"),
         page(5, "liked.com"), page(6, "far.com", "farm.com"), page(7, "alone.com")],
        "page_id long, url string, html string",
    )
    rules = [("block", "net", "/"), ("allow", "good.org", "/")]
    found = {r["host"]: r for r in urlfilter.judge(pages, rules, threshold=0.3).collect()}
    assert {h for h, r in found.items() if r["verdict"] == "block"} == {"bad.net", "farm.com", "far.com"}
    assert found["liked.com"]["host_score"] < 0 < found["farm.com"]["host_score"] and found["alone.com"]["host_score"] == 0
    edges = spark.createDataFrame([("a", "b", 0.5), ("a", "c", 0.5), ("b", "a", 1.0)], "src string, dst string, part double")
    mass = {r["node"]: r["mass"] for r in urlfilter.propagate(edges, spark.createDataFrame([("a", 2.0)], "node string, share double")).collect()}
    d, a = urlfilter.DAMPING, 2.0
    for _ in range(urlfilter.ROUNDS // 2):  # a cycle of two steps through b
        b, a = a * d / 2, 2.0 + a * d * d / 2
    assert mass["a"] == pytest.approx(a) and mass["b"] == mass["c"]


def test_links_to_blocked_hosts_block_at_the_production_threshold(spark):
    page = lambda i, host, *to: (i, f"http://{host}/p{i}", "".join(f'<a href="http://{t}/x">' for t in to))
    rows = [page(1, "bad.net"), page(2, "far.com", "farm0.com"), page(3, "good.org", "both.com"), page(4, "both.com", "bad.net")]
    rows += [page(10 + 3 * k + i, f"farm{k}.com", "bad.net") for k in range(3) for i in range(3)]  # equal ones, of several pages
    rows += [page(100 + i, "hot.com", *(["bad.net"] if i < 2 else [])) for i in range(50)]
    rows += [page(200 + i, "news.com", "bad.net" if i == 0 else "else.com") for i in range(10)]
    rows += [page(300, "a.com", "b.com"), page(301, "b.com", "a.com", "a.com", "a.com", "bad.net")]  # a cycle
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r["host"]: (r["verdict"], r["host_score"]) for r in urlfilter.judge(pages, [("block", "net", "/"), ("allow", "good.org", "/")]).collect()}
    d = urlfilter.DAMPING
    b = d / 4 / (1 - d * d * 3 / 4)
    expected = {"farm0.com": d, "farm1.com": d, "farm2.com": d, "hot.com": d, "far.com": d * d, "news.com": d / 10, "both.com": 0.0, "a.com": d * b, "b.com": b}
    for host, score in expected.items():
        assert found[host] == ("block" if score >= urlfilter.THRESHOLD else "allow", pytest.approx(score, abs=2 * urlfilter.TOLERANCE)), host
