"""What was delivered, what is missing, what to run again.

A manifest has one row per file with at least ``name``; ``mtime`` where the order matters. File names
read ``{type}_{yyyy-MM-dd}.csv_{market}.csv``.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

FILE_NAME = r"^(\w+)_(\d+-\d+-\d+)\.csv_(\w+)\.csv$"


def parse_names(manifest: DataFrame) -> DataFrame:
    """Type, date and market out of the name; names of another form are left out."""
    part = lambda i: F.regexp_extract("name", FILE_NAME, i)
    return manifest.filter(F.rlike("name", F.lit(FILE_NAME))).select(
        "*",
        part(1).alias("file_type"),
        F.try_to_date(part(2), "yyyy-MM-dd").alias("delivery_date"),
        part(3).alias("market"),
    )


def expected_deliveries(markets: DataFrame, file_types: Sequence[str], first: date, last: date) -> DataFrame:
    """Type by market by run date, generated on the market rows (columns market, stable)."""
    types = F.explode(F.array(*[F.lit(t) for t in file_types]))
    days = F.explode(F.sequence(F.lit(first), F.lit(last), F.expr("INTERVAL 1 DAY")))
    return markets.select("market", "stable", types.alias("file_type")).select("*", days.alias("delivery_date"))


_GRID = ["market", "file_type", "delivery_date"]


def missing_deliveries(parsed: DataFrame, expected: DataFrame) -> DataFrame:
    """Stable markets stop the run; an empty placeholder stands in for the others."""
    return expected.join(parsed.select(*_GRID), _GRID, "left_anti").withColumn(
        "action", F.when(F.col("stable"), "report").otherwise("placeholder")
    )


def run_verdict(parsed: DataFrame, expected: DataFrame) -> DataFrame:
    """Per run date the number of missing stable files and how the run goes on."""
    delivered = parsed.select(*_GRID).distinct().withColumn("_delivered", F.lit(1))
    missing = F.sum(F.when(F.col("_delivered").isNull(), 1).otherwise(0))
    return (
        expected.filter("stable")
        .join(delivered, _GRID, "left")
        .groupBy("delivery_date")
        .agg(missing.alias("missing_files"))
        .withColumn("next_step", F.when(F.col("missing_files") == 0, "check_files").otherwise("terminate"))
    )


def pending_files(parsed: DataFrame, markets: DataFrame, file_types: Sequence[str]) -> DataFrame:
    """D3: files of the watched types and markets that still wait, oldest first where known."""
    found = parsed.filter(F.col("file_type").isin(list(file_types))).join(
        markets.select("market"), "market", "left_semi"
    )
    return found.orderBy("mtime", "name") if "mtime" in found.columns else found


def delivery_counts(parsed: DataFrame) -> DataFrame:
    """Files per market and date; the first name stands for an incomplete delivery."""
    return parsed.groupBy("market", "delivery_date").agg(
        F.count(F.lit(1)).alias("files"), F.min("name").alias("first_file")
    )


def incomplete_deliveries(parsed: DataFrame, file_types: Sequence[str], needed: int | None = None) -> DataFrame:
    """Fewer than the needed files of the given types."""
    counted = delivery_counts(parsed.filter(F.col("file_type").isin(list(file_types))))
    return counted.filter(F.col("files") < (needed or len(file_types)))


def complete_deliveries(parsed: DataFrame, file_types: Sequence[str], needed: int | None = None) -> DataFrame:
    counted = delivery_counts(parsed.filter(F.col("file_type").isin(list(file_types))))
    return counted.filter(F.col("files") >= (needed or len(file_types)))


def reprocess_plan(parsed: DataFrame) -> DataFrame:
    """For each pending date an update of the day before, then the day itself."""
    day = F.col("delivery_date")
    runs = F.array(
        F.struct(F.lit(1).alias("step"), F.date_sub(day, 1).alias("run_date"), F.lit("update").alias("mode")),
        F.struct(F.lit(2).alias("step"), day.alias("run_date"), F.lit("daily").alias("mode")),
    )
    dated = parsed.filter(day.isNotNull()).select("market", "delivery_date").distinct()
    return dated.select("market", "delivery_date", F.inline(runs)).orderBy("market", "delivery_date", "step")


def run_dates(as_of: Column) -> dict[str, Column]:
    """Regular runs look two days back, updates three."""
    regular, update = F.date_sub(as_of, 2), F.date_sub(as_of, 3)
    return {
        "run_date": F.date_format(regular, "yyyy-MM-dd"),
        "output_date": F.date_format(regular, "yyyyMMdd"),
        "output_month": F.date_format(regular, "yyyyMM"),
        "output_year": F.date_format(regular, "yyyy"),
        "update_date": F.date_format(update, "yyyy-MM-dd"),
        "update_output_date": F.date_format(update, "yyyyMMdd"),
        "update_output_month": F.date_format(update, "yyyyMM"),
    }


def publishable(manifest: DataFrame, allow_list: DataFrame) -> DataFrame:
    """Only listed file names leave."""
    return manifest.join(allow_list.select("name"), "name", "left_semi")


def rejected_names(
    manifest: DataFrame, patterns: Sequence[str], as_of: date, date_format: str = "%Y%m%d"
) -> DataFrame:
    """names that match none of the patterns; ``{date}`` in a pattern stands for ``as_of``."""
    stamp = as_of.strftime(date_format)
    accepted = "|".join(f"(?:{p.replace('{date}', stamp)})" for p in patterns)
    return manifest.filter(~F.rlike("name", F.lit(f"^(?:{accepted})$")))


def report_recipients(files: DataFrame, recipients: DataFrame) -> DataFrame:
    """A report goes to every market whose code its name contains.

    Each name is cut into all parts as long as some market code, which makes the containment test an
    equi-join.
    """
    lengths = recipients.select(F.collect_set(F.length("market"))).scalar()
    sized = files.select("name", F.explode(lengths).alias("_n")).filter(F.col("_n") <= F.length("name"))
    starts = F.sequence(F.lit(1), F.length("name") - F.col("_n") + 1)
    parts = F.array_distinct(F.transform(starts, lambda i: F.substring(F.col("name"), i, F.col("_n"))))
    return sized.select("name", F.explode(parts).alias("market")).join(recipients, "market")
