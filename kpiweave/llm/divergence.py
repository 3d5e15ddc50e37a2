"""Source divergence audit by chunk factorization.

Documents are cut at ASCII blanks into chunks. A task numbers the distinct chunks of its documents, tokenizes each of them
once and joins the terms back to the documents that hold the chunk, so that a document's distinct terms are known where the
document is. What is shuffled is one row per (lang, source, term) and task, with its occurrences and its documents; pairs of
documents and chunks never are. From these counts come each group's smoothed term distribution and, per (lang, source)
group, how far it lies from every other source of its lang (part ``pair``) and which terms it holds more of than its lang
(part ``term``).

All arithmetic is on integers: probabilities are scaled by 10^9 and floored, so the result does not depend on the order
of floating-point sums or on the engine.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiweave.llm.hashing import batches
from kpiweave.llm.stage import on_workers, written

# Fixed values of the contract: the characters that make a term, the blanks that cut chunks, the scale of p.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
BLANKS = r"[\x09-\x0D\x20]+"
# Both as patterns over UTF-8 bytes: every byte of a character beyond ASCII belongs to a term.
_TERM, _BLANKS = re.compile(TERM.encode()), re.compile(BLANKS.encode())
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
SCALE = 1_000_000_000
MIN_DOCS = 10
TOP_TERMS = 10
# What a task holds at once: bytes of text cut at a time; distinct chunks and (document, term) pairs until it hands on its sums; rows of those sums.
BLOCK = 4 << 20
CHUNKS = 1 << 19
PAIRS = 1 << 22
ROWS = 1 << 16
COUNTED = "lang string, source string, term binary, count long, docs long"


def p_value(count: str, total: str, kept: str) -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * kept)) in exact integer arithmetic, from column names or literals;
    null where ``kept`` is 0 (no distribution)."""
    exact = f"(CAST({count} + 2 AS DECIMAL(38,0)) * {SCALE}) div CAST({total} + 2 * {kept} AS DECIMAL(38,0))"
    # The product of a count below 2^33 stays below 2^63.
    fast = f"(CAST({count} + 2 AS BIGINT) * {SCALE}L) div CAST({total} + 2 * {kept} AS BIGINT)"
    return F.expr(f"CASE WHEN {kept} > 0 THEN 1 + CASE WHEN {count} < 8589934592 THEN {fast} ELSE {exact} END END")


def distance(p: str, q: str) -> Column:
    """floor((p - q)^2 / (p + q)) on longs; p, q are at most SCALE + 1, so the square stays below 2^63."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def top_per_group(df: DataFrame, keys: list[str], n: int, salts: int = 64) -> DataFrame:
    """The first ``n`` rows per ``keys`` by value descending, item ascending, numbered in ``rank``. Each group is first
    cut to its best ``n`` within ``salts`` slices by item, so a group with very many rows never sorts in one task."""
    order = [F.col("value").desc(), F.col("item").asc()]
    salt = F.pmod(F.xxhash64("item"), F.lit(salts))
    first = df.withColumn("__salt", salt).withColumn("__r", F.row_number().over(Window.partitionBy(*keys, "__salt").orderBy(*order)))
    best = first.where(F.col("__r") <= n).drop("__salt", "__r")
    return best.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= n)


def _parts(text: bytes) -> Iterator[bytes]:
    """A text in parts of about ``BLOCK`` bytes, cut at blanks."""
    at = 0
    while len(text) - at > BLOCK and (cut := _BLANKS.search(text, at + BLOCK)):
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def _summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys, how many rows each has, and the sums of the values."""
    order = np.argsort(keys, kind="stable") if values else None
    keys = np.sort(keys) if order is None else keys[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(len(keys), 1), bool), keys[1:] != keys[:-1]]))
    return keys[first], np.diff(first, append=len(keys)), *(np.add.reduceat(v[order], first) if len(first) else v for v in values)


def _numbers() -> defaultdict:
    """Numbers things from 0 in the order they are first looked up."""
    found: defaultdict = defaultdict()
    found.default_factory = found.__len__
    return found


class _Block:
    """Counts of some documents of one task. Keys hold a document's or group's number above 32 bits, a term's below."""

    def __init__(self):
        self.chunks, self.terms, self.groups = _numbers(), _numbers(), _numbers()
        # The terms of chunk c, repeats included: terms[starts[c]], ... of them sizes[c].
        self.chunk_terms = self.starts = self.sizes = np.zeros(0, np.int64)
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.pairs = 0

    def _tokenize(self) -> None:
        """The terms of the chunks that are new."""
        new = [*islice(reversed(self.chunks), len(self.chunks) - len(self.sizes))][::-1]
        found = [_TERM.findall(chunk.lower()) for chunk in new]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        terms = np.fromiter(map(self.terms.__getitem__, chain.from_iterable(found)), np.int64, int(sizes.sum()))
        self.starts = np.concatenate([self.starts, len(self.chunk_terms) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.chunk_terms = np.concatenate([self.chunk_terms, terms])

    def _held(self, texts: list[bytes]) -> tuple[np.ndarray, ...]:
        """(document, term) pairs of these texts and how often each occurs; documents are numbered from 0."""
        chunks = [np.fromiter(map(self.chunks.__getitem__, text.split()), np.int64) for text in texts]
        self._tokenize()
        doc = np.repeat(np.arange(len(texts)), [len(c) for c in chunks])
        chunk = np.concatenate(chunks)
        sizes = self.sizes[chunk]
        ends = np.cumsum(sizes)
        at = np.repeat(self.starts[chunk] - ends + sizes, sizes) + np.arange(sizes.sum())
        return _summed(np.repeat(doc, sizes) << 32 | self.chunk_terms[at])

    def add(self, groups: list[tuple[str, str]], texts: list[bytes]) -> None:
        if len(texts) > 1:
            keys, counts = self._held(texts)
        else:
            parts = [self._held([part]) for part in _parts(texts[0])]
            keys, _, counts = _summed(*map(np.concatenate, zip(*parts)))
        group = np.fromiter(map(self.groups.__getitem__, groups), np.int64, len(groups))
        self.keys.append(group[keys >> 32] << 32 | keys & 0xFFFFFFFF)
        self.counts.append(counts)
        self.pairs += len(keys)

    def sums(self) -> Iterator[pa.RecordBatch]:
        """One row per (group, term): occurrences and documents. Ends the block."""
        if not self.pairs:
            return
        keys, counts = np.concatenate(self.keys), np.concatenate(self.counts)
        self.keys.clear(), self.counts.clear()
        keys, docs, counts = _summed(keys, counts)
        langs, sources = (pa.array(names, pa.string()) for names in zip(*self.groups))
        terms = pa.array(list(self.terms), pa.binary())
        for at in range(0, len(keys), ROWS):
            some = slice(at, at + ROWS)
            group, term = pa.array(keys[some] >> 32), pa.array(keys[some] & 0xFFFFFFFF)
            columns = [langs.take(group), sources.take(group), terms.take(term), pa.array(counts[some]), pa.array(docs[some])]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "count", "docs"])


def _counted(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block = _Block()
    for batch in found:
        lang, source, text = (column.to_pylist() for column in batch.columns)
        groups = list(zip(lang, source))
        for i, j in batches(text, BLOCK):
            block.add(groups[i:j], text[i:j])
            if len(block.chunks) > CHUNKS or block.pairs > PAIRS:
                yield from block.sums()
                block = _Block()
    yield from block.sums()


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, term, count, docs): occurrences of each term in a (lang, source) group and the number of its
    documents that hold it, by chunk factorization. Null text, lang and source read as ''; every row is a document of
    its own, repeated rows included.

    A task tokenizes each distinct chunk of its documents once (``CHUNKS`` bounds how many it keeps before it hands on its
    sums and starts anew), and dedupes a document's terms before anything is shuffled. The one shuffle is by
    (lang, term), which also serves what is counted per lang afterwards."""
    rows = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    found = on_workers(rows).mapInArrow(_counted, COUNTED).withColumn("term", F.col("term").cast("string"))
    return found.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank) for every occurring (lang, source) group.

    A lang keeps the V terms held by at least ``MIN_DOCS`` of its documents. Every (lang, source) group and every lang
    has, for each kept term of the lang, p = 1 + floor(10^9 (count + 2) / (N + 2 V)), N the group's count over kept
    terms (0 counts included). f(p, q) = floor((p - q)^2 / (p + q)).

    * ``pair``: item each other source of the lang, value the sum of f over kept terms (0 if V is 0), all ranks.
    * ``term``: item each kept term with count > 0 in the group and p above the lang's p, value f, ranks 1 to 10.

    Ranks run from 1 per (lang, source, part) by value descending, then item ascending in UTF-8 order. Groups whose
    texts are null, empty or without terms still take part (all their counts are 0). Null lang or source is ''; extra
    columns are ignored. An empty table gives no rows.

    Sums over terms are never taken densely. With z a group's p of a term it lacks, f(p, q) over all V terms is V f(z, z')
    plus, for each group's held terms, f(p, z') - f(z, z'), plus, for terms that both hold, f(p, p') - f(p, z') - f(z, p')
    + f(z, z'). The middle part needs only how many terms of a group have which count, as p depends on nothing else; the
    last joins on (lang, term). What joins on lang alone holds one row per group, or per group and count.
    """
    base = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"),
        F.col(text).alias("text"),
    )
    of_term = Window.partitionBy("lang", "term")
    # Kept terms of each group. `first` marks one row per (lang, term).
    kept = written(
        term_counts(base)
        .withColumn("lang_docs", F.sum("docs").over(of_term))
        .withColumn("lang_count", F.sum("count").over(of_term))
        .withColumn("first", F.col("source") == F.min("source").over(of_term))
        .where(F.col("lang_docs") >= MIN_DOCS)
        .select("lang", "source", "term", "count", "lang_count", "first"),
        "divergence-kept",
    )
    totals = kept.groupBy("lang", "source").agg(F.sum("count").alias("total"), F.count_if("first").alias("firsts"))
    sizes = totals.groupBy("lang").agg(F.sum("firsts").alias("v"), F.sum("total").alias("lang_total"))
    # One row per (lang, source) group: its total over kept terms, V of its lang, the p of a term it lacks. Written, so
    # that its size is known and the large joins with it need no shuffle where it is small.
    summary = written(
        base.select("lang", "source").distinct()
        .join(totals.drop("firsts"), ["lang", "source"], "left")
        .join(sizes, "lang", "left")
        .select(
            "lang", "source",
            F.coalesce("total", F.lit(0)).alias("total"),
            F.coalesce("v", F.lit(0)).alias("v"),
            F.coalesce("lang_total", F.lit(0)).alias("lang_total"),
        )
        .withColumn("z", p_value("0", "total", "v")),
        "divergence-groups",
    )

    # Part pair: corrections from each group's held terms, then from terms that both groups hold.
    others = summary.select("lang", F.col("source").alias("other"), F.col("z").alias("z_other"))
    alone = (
        kept.groupBy("lang", "source", "count").agg(F.count("*").alias("m"))
        .join(summary, ["lang", "source"])
        .select("lang", "source", "z", "m", p_value("count", "total", "v").alias("p"))
        .join(others, "lang")
        .where(F.col("source") != F.col("other"))
        .groupBy("lang", "source", "other")
        .agg(F.sum(F.col("m") * (distance("p", "z_other") - distance("z", "z_other"))).alias("d"))
    )
    sparse = kept.join(summary, ["lang", "source"]).select("lang", "term", "source", "z", p_value("count", "total", "v").alias("p"))
    shared = (
        sparse.alias("a").join(sparse.alias("b"), ["lang", "term"])
        .where(F.col("a.source") < F.col("b.source"))
        .groupBy("lang", F.col("a.source").alias("source"), F.col("b.source").alias("other"))
        .agg(F.sum(distance("a.p", "b.p") - distance("a.p", "b.z") - distance("a.z", "b.p") + distance("a.z", "b.z")).alias("d"))
    )
    corrections = (
        alone.unionByName(shared)
        .select("lang", F.explode(F.array(F.struct("source", "other"), F.struct(F.col("other").alias("source"), F.col("source").alias("other")))).alias("g"), "d")
        .groupBy("lang", "g.source", "g.other")
        .agg(F.sum("d").alias("delta"))
    )
    pairs = (
        summary.select("lang", "source", "z", "v").join(others, "lang")
        .where(F.col("source") != F.col("other"))
        .join(corrections, ["lang", "source", "other"], "left")
        .select(
            "lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"),
            F.when(F.col("v") > 0, F.col("v") * distance("z", "z_other") + F.coalesce("delta", F.lit(0)))
            .otherwise(F.lit(0)).cast("long").alias("value"),
        )
    )

    # Part term: kept terms the group holds more of than its lang.
    over = (
        kept.join(summary, ["lang", "source"])
        .select("lang", "source", "term", p_value("count", "total", "v").alias("p"), p_value("lang_count", "lang_total", "v").alias("q"))
        .where(F.col("p") > F.col("q"))
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), distance("p", "q").cast("long").alias("value"))
    )
    order = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), F.col("item").asc())
    ranked_terms = top_per_group(over, ["lang", "source", "part"], TOP_TERMS)
    ranked_pairs = pairs.withColumn("rank", F.row_number().over(order))
    return ranked_pairs.unionByName(ranked_terms).withColumn("rank", F.col("rank").cast("int"))
