"""Raw deliveries to typed rows with a business key.

Raw frames carry provenance beside the feed columns: ``Input_File``, ``Input_File_Time`` and, where
several deliveries are processed together, any sortable ``delivery`` column. Rows the feed rules drop
on purpose (comments, missing values, text that is no number) are gone after ``normalize_*``; rows
that would stop a run (unreadable date, unknown country) are returned by ``quarantine_*`` instead.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from kpiweave.functions import dates, keys
from kpiweave.functions.text import checked_number, is_number_text, or_text, upper_strip
from kpiweave.operators.grain import DAILY, MONTHLY, WEEKLY, Grain

PROVENANCE = ("Input_File", "Input_File_Time", "delivery")

DateFormats = str | Mapping[str, str]


def _provenance(raw: DataFrame) -> list[str]:
    return [c for c in PROVENANCE if c in raw.columns]


def _readable(rows: DataFrame, iso: Column) -> DataFrame:
    """Rows with a readable date, as column _day. The text rules are bound by a generator: a filter on
    the parsed date would be pushed below it and carry all of them out a second time."""
    bound = rows.select("*", F.explode(F.array(iso)).alias("_iso"))
    return bound.withColumn("_day", dates.from_iso(F.col("_iso"))).filter(F.col("_day").isNotNull())


def _unreadable(rows: DataFrame, iso: Column) -> DataFrame:
    return rows.filter(dates.from_iso(iso).isNull()).withColumn("reason", F.lit("unreadable date"))


def daily_lines(raw: DataFrame) -> DataFrame:
    """F1."""
    return raw.filter((F.col("Marker") == "L") & F.col("Value").isNotNull())


def comment_lines(raw: DataFrame) -> DataFrame:
    """F2."""
    return raw.filter(F.col("Marker") == "C")


def file_comments(raw: DataFrame, order_by: str | Column = "row_no") -> DataFrame:
    """The date field of the first comment line of each file; one row per file that has one. Files of
    one name in several folders are told apart by ``delivery``, where the frame has it."""
    order = F.col(order_by) if isinstance(order_by, str) else order_by
    return comment_lines(raw).groupBy(*_file(raw)).agg(F.min_by("DatumKPI", order).alias("CommentFileNew"))


def _file(rows: DataFrame) -> list[str]:
    return [c for c in ("Input_File", "delivery") if c in rows.columns]


def with_file_comment(rows: DataFrame, comments: DataFrame) -> DataFrame:
    """Attach the file comment; the text ``null`` where a file has no comment line."""
    return rows.join(comments, _file(comments), "left").withColumn(
        "CommentFileNew", or_text(F.col("CommentFileNew"), "null")
    )


def _daily_iso(formats: DateFormats) -> Column:
    stamp, market = F.col("DatumKPI"), F.col("Natco")
    if isinstance(formats, str):
        return dates.daily_iso(stamp, formats)
    iso = dates.daily_iso(stamp)
    for code, fmt in formats.items():
        iso = F.when(market == code, dates.daily_iso(stamp, fmt)).otherwise(iso)
    return iso


def _daily_numbers(raw: DataFrame) -> DataFrame:
    return daily_lines(raw).filter(is_number_text(F.col("Value")))


def normalize_daily(raw: DataFrame, date_formats: DateFormats = dates.DAILY_FORMAT) -> DataFrame:
    parsed = _readable(_daily_numbers(raw), _daily_iso(date_formats))
    day, kpi = dates.business_text(F.col("_day")), upper_strip(or_text(F.col("KPINameDaily"), "<NA>"))
    return parsed.select(
        keys.input_id(F.col("Natco"), kpi, day, DAILY.suffix).alias("Input_ID"),
        day.alias("Date"),
        "TimestampTo",
        F.col("Natco").alias("Region"),
        "SourceSystem",
        kpi.alias("KPI_ID"),
        "Denominator",
        "Numerator",
        checked_number(F.col("Value")).alias("Value"),
        *_provenance(raw),
    )


def quarantine_daily(raw: DataFrame, date_formats: DateFormats = dates.DAILY_FORMAT) -> DataFrame:
    return _unreadable(_daily_numbers(raw), _daily_iso(date_formats))


def with_remarks(raw: DataFrame) -> DataFrame:
    """An empty remark where the delivery has no such column."""
    return raw if "Remarks" in raw.columns else raw.withColumn("Remarks", F.lit(""))


def _period_numbers(raw: DataFrame, grain: Grain) -> DataFrame:
    rows = raw.filter(F.col("Value").isNotNull() & is_number_text(F.col("Value")))
    if grain is MONTHLY:
        rows = with_remarks(rows).filter(F.col("KPI name").isNotNull())
    return rows


def _period_iso(grain: Grain) -> Column:
    return (dates.weekly_iso if grain is WEEKLY else dates.period_iso)(F.col("Date"))


def normalize_period(raw: DataFrame, grain: Grain) -> DataFrame:
    """Weekly and monthly feeds; ``Region`` holds the market of the delivery."""
    parsed = _readable(_period_numbers(raw, grain), _period_iso(grain))
    day, kpi = dates.business_text(F.col("_day")), upper_strip(or_text(F.col("KPI name"), "nan"))
    return parsed.select(
        keys.input_id(F.col("Region"), kpi, day, grain.suffix).alias("Input_ID"),
        day.alias("Date"),
        kpi.alias("KPI name"),
        "Region",
        checked_number(F.col("Value")).alias("Value"),
        "Remarks",
        *_provenance(raw),
    )


def quarantine_period(raw: DataFrame, grain: Grain) -> DataFrame:
    return _unreadable(_period_numbers(raw, grain), _period_iso(grain))


def resolve_market(
    rows: DataFrame, market_map: DataFrame, code: str = "Region", compat: bool = False
) -> DataFrame:
    """Country code to market in place. Unknown codes are left out, or stop the run in ``compat``."""
    lookup = market_map.select(F.col("code").alias("_map_code"), F.col("market").alias("_map_market"))
    joined = rows.join(lookup, F.col(code) == F.col("_map_code"), "left" if compat else "inner")
    market = F.col("_map_market")
    if compat:
        unknown = F.raise_error(F.concat(F.lit("unknown country "), or_text(F.col(code), "nan")))
        market = F.when(market.isNull(), unknown.cast("string")).otherwise(market)
    return joined.withColumn(code, market).drop("_map_code", "_map_market")


def unknown_markets(rows: DataFrame, market_map: DataFrame, code: str = "Region") -> DataFrame:
    known = market_map.select(F.col("code").alias(code))
    return rows.join(known, code, "left_anti").withColumn("reason", F.lit("unknown country"))


def _dated_ims(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("Date").isNotNull() & (F.col("Date") != ""))


def quarantine_ims(raw: DataFrame) -> DataFrame:
    return _unreadable(_dated_ims(raw), dates.period_iso(F.col("Date")))


def normalize_ims(raw: DataFrame) -> DataFrame:
    """The value stays as delivered."""
    day, kpi = dates.business_text(F.col("_day")), F.upper(or_text(F.col("KPI name"), "nan"))
    return _readable(_dated_ims(raw), dates.period_iso(F.col("Date"))).select(
        day.alias("Date"),
        kpi.alias("KPI name"),
        "Value",
        "Region",
        keys.ims_id(F.col("Region"), kpi, day).alias("Input_ID"),
    )
