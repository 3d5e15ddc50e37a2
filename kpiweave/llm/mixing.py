"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiweave.llm.stage import own_columns, written

WORD = r"[^\x20\x09-\x0D]+"
SLOTS = 256


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...], share: float, limit: float) -> DataFrame:
    """Target of each source from (source, source_size): ``share`` of all sizes split by weight, nowhere above ``limit``
    times the source's size; what is above goes to the others by weight.

    Sources by code point, null last, take the weights in turn. With the sources ordered by (limit / weight), all up to
    some point get their limit and the rest one common amount per weight, so that prefix sums settle it at once. One
    row per source goes through this window."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy((F.col("room") / F.col("weight")).asc(), F.col("place"))
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = (
        sizes.withColumn("place", F.row_number().over(by_name))
        .withColumn(
            "weight",
            F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") - 1) % len(weights) + 1),
        )
        .withColumn("room", F.col("source_size") * F.lit(float(limit)))
        .withColumn("level", (
            F.sum("source_size").over(by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) * F.lit(float(share))
            - F.coalesce(F.sum("room").over(before), F.lit(0.0))
        ) / F.sum("weight").over(after))
        .withColumn("open", F.col("room") > F.col("level") * F.col("weight"))
    )
    common = F.min(F.when(F.col("open"), F.struct("place_by_ratio", "level"))).over(everything)["level"]
    return (
        ranked.withColumn("place_by_ratio", F.row_number().over(by_ratio))
        .withColumn("common", common)
        .select(
            "source", "source_size",
            F.least(F.col("room"), F.coalesce(F.col("common") * F.col("weight"), F.col("room"))).alias("target"),
        )
    )


def mix(
    docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, limit: float = 2.0, seed: str = "mix",
    id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
) -> DataFrame:
    """Copies of each document in the mix: (id, size, source, digest of the
    text, source_size, target, copies).

    A document's expected copies are target / source size of its source. Within a source the documents are laid out by
    size class, a slot from the id's digest, size, id and text digest; expected copies are summed along this line from
    one random offset, and a document is emitted once per whole number that its stretch crosses. As neighbours are of
    like size, the words taken stay within about one document of the target. The line is never sorted as a whole: counts
    of (source, size class, slot) give the place where each slot begins, and only a slot is sorted, so a source that
    holds most rows is spread over many tasks. The offset comes from ``seed`` and the source, so reruns agree.

    Null or empty text has size 0; a source without words has target 0, and documents without words are emitted like
    others of their source but add no words (0 copies where the target is 0). Repeated rows are documents of their own. A
    null source is a source, the last. No rows give no rows."""
    sized = written(
        docs.select(
            F.col(id_column).alias("id"), word_count(F.col(text_column)).alias("size"),
            F.col(source_column).cast("string").alias("source"),
            _digest(F.col(text_column)).alias("digest"),
        )
        .withColumn("bin", size_class(F.col("size")))
        .withColumn("slot", (_number(F.coalesce(F.col("id").cast("string"), F.lit(""))) % SLOTS).cast("int"))
        .withColumn("named", F.col("source").isNotNull())
        .withColumn("name", F.coalesce("source", F.lit(""))),
        "mix-sizes",
    )
    keys = ["named", "name"]
    slots = sized.groupBy(*keys, "bin", "slot").agg(F.count("*").alias("n"), F.sum("size").alias("words"))
    bins = slots.groupBy(*keys, "bin").agg(F.sum("n").alias("n"), F.sum("words").alias("words"))
    sources = (
        bins.groupBy(*keys).agg(F.sum("words").alias("source_size"))
        .withColumn("source", F.when(F.col("named"), F.col("name")))
    )
    goal = (
        targets(sources.select("source", "source_size"), weights, share, limit)
        .withColumn("named", F.col("source").isNotNull())
        .withColumn("name", F.coalesce("source", F.lit("")))
        .withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
        .withColumn("offset", _number(F.concat(F.lit(f"{seed}:"), "name")) / F.lit(float(2**32)))
    )
    earlier = lambda *by: Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)
    first_of_bin = bins.select(*keys, "bin", F.coalesce(F.sum("n").over(earlier(*keys, "bin")), F.lit(0)).alias("bin_start"))
    layout = (
        slots.withColumn("slot_start", F.coalesce(F.sum("n").over(earlier(*keys, "bin", "slot")), F.lit(0)))
        .join(first_of_bin, [*keys, "bin"])
        .join(goal.drop("source"), keys)
        .select(*keys, "bin", "slot", (F.col("bin_start") + F.col("slot_start")).alias("start"), "source_size", "target", "rate", "offset")
    )
    line = Window.partitionBy(*keys, "bin", "slot").orderBy("size", F.col("id").asc_nulls_last(), "digest")
    crossed = lambda place: F.floor(F.col("offset") + F.col("rate") * place.cast("double"))
    place = F.col("start") + F.col("rank")
    return (
        sized.withColumn("rank", F.row_number().over(line).cast("long"))
        .join(layout, [*keys, "bin", "slot"])
        .select(
            "id", "size", "source", "digest", "source_size", "target",
            F.least(crossed(place) - crossed(place - 1), F.ceil("rate")).cast("long").alias("copies"),
        )
    )


def emit(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", **options) -> DataFrame:
    """``docs`` with each row as often as the mix takes it, all columns kept; see ``mix``.

    The copies of rows with equal id, text and source are summed and dealt out among these rows evenly."""
    key = lambda id, digest, source: F.concat_ws(
        "/", F.coalesce(id.cast("string"), F.lit("null")), digest, F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("null"))
    )
    taken = mix(docs, id_column=id_column, text_column=text_column, source_column=source_column, **options)
    taken = (
        taken.groupBy(key(F.col("id"), F.col("digest"), F.col("source")).alias("__mix_key"))
        .agg(F.sum("copies").alias("__mix_copies"), F.count("*").alias("__mix_rows"))
        .where("__mix_copies > 0")
    )
    row = F.row_number().over(Window.partitionBy("__mix_key").orderBy("__mix_rows"))
    upto = lambda j: F.floor(j * F.col("__mix_copies") / F.col("__mix_rows"))
    return (
        docs.withColumn("__mix_key", key(F.col(id_column), _digest(F.col(text_column)), F.col(source_column)))
        .join(taken, "__mix_key")
        .withColumn("__mix_row", row)
        .withColumn("__mix_copies", (upto(F.col("__mix_row")) - upto(F.col("__mix_row") - 1)).cast("int"))
        .where("__mix_copies > 0")
        .withColumn("__mix_copy", F.explode(F.sequence(F.lit(1), F.col("__mix_copies"))))
        .select(*own_columns(docs))
    )


def _number(text: Column) -> Column:
    """A whole number below 2**32 from the digest of a text."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def _digest(text: Column) -> Column:
    return F.substring(F.md5(F.coalesce(text, F.lit(""))), 1, 16)


def size_class(size: Column) -> Column:
    """Eight classes an octave, from the highest four bits of the size."""
    bits = F.length(F.bin(size))
    return F.when(size > 0, bits * 8 + F.expr("shiftright(size * 8, length(bin(size)) - 1)").cast("int") % 8).otherwise(0).cast("int")
