"""Requested figures by calendar against delivered ones.

The grid comes from exploding a date sequence on each registry row, so no cross join runs. What was
delivered is brought to one lookup row per key (more only where a key was delivered with differing
attributes) and joined once.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, functions as F

from kpiweave import schemas
from kpiweave.functions import dates, keys
from kpiweave.operators.calendar import period_dates
from kpiweave.operators.corrections import largest
from kpiweave.operators.grain import DAILY, WEEKLY, Grain
from kpiweave.operators.normalize import resolve_market

_COLUMNS = {"daily": schemas.MATRIX_DAILY, "weekly": schemas.MATRIX_WEEKLY, "monthly": schemas.MATRIX_MONTHLY}
_ATTRIBUTES = {
    "daily": ("Time", "Input_File", "was_corrected_Flag", "Denominator", "Numerator", "SourceSystem"),
    "weekly": ("Time", "Input_File", "was_corrected_Flag", "Remarks"),
    "monthly": ("Time", "Input_File", "was_corrected_Flag", "Remarks"),
}


def grid(
    flags: DataFrame, market_map: DataFrame, start: date, as_of: date, grain: Grain, compat: bool = False
) -> DataFrame:
    """Every requested-flag row on every period start, with its key KEY1."""
    rows = resolve_market(flags.withColumn("_market", F.col("Natco")), market_map, "_market", compat)
    kpi = F.upper(F.col("KPI_ID" if grain is DAILY else "KPI_Name"))
    requested = f"requested_{grain.name.capitalize()}"
    day = F.col("Date")
    rows = rows.select("*", F.explode(period_dates(start, as_of, grain)).alias("Date")).withColumn(
        "KEY1", keys.input_id(F.col("_market"), kpi, dates.business_text(day), grain.suffix)
    )
    extra = dates.calendar_columns(day, compat) if grain is DAILY else {}
    return rows.select(
        "Natco", "KPI_ID", "KPI_Name", requested, "Date", *[c.alias(n) for n, c in extra.items()], "KEY1"
    )


def attribute_variants(
    rows: DataFrame, attributes: Sequence[str], wanted: DataFrame | None = None, compat: bool = False
) -> DataFrame:
    """Per key the attribute values it was delivered with, one row for each tuple delivered; in
    ``compat`` every combination of them, also those that nobody delivered.

    In ``compat`` a key with one tuple keeps its own values; only keys with several take part in the chain
    of joins over distinct (key, attribute) pairs.
    """
    tuples = rows.select("Input_ID", *attributes).distinct()
    if wanted is not None:
        tuples = tuples.join(wanted, "Input_ID", "left_semi")
    if not compat:
        return tuples
    keys_ = tuples.groupBy("Input_ID").agg(
        (F.count(F.lit(1)) > 1).alias("_several"), *[F.max(a).alias(a) for a in attributes]
    )
    several = tuples.join(keys_.filter("_several").select("Input_ID"), "Input_ID", "left_semi")
    combined = keys_
    for attribute in attributes:
        pairs = several.select("Input_ID", F.col(attribute).alias(f"_{attribute}")).distinct()
        combined = combined.join(pairs, "Input_ID", "left")
    return combined.select(
        "Input_ID", *[F.when(F.col("_several"), F.col(f"_{a}")).otherwise(F.col(a)).alias(a) for a in attributes]
    )


def _delivered(output: DataFrame) -> DataFrame:
    return output.filter(F.col("Input_ID").isNotNull()).withColumnRenamed("Date", "Time")


def lookups(output: DataFrame, wanted: DataFrame, grain: Grain, compat: bool = False) -> DataFrame:
    """Value, delivered flag and attributes for the ``wanted`` keys, which are picked after the
    aggregation so that a hot key is combined before it is shuffled."""
    rows, wanted = _delivered(output), wanted.select("Input_ID")
    values = rows.groupBy("Input_ID").agg(largest(F.col("Value"), compat).alias("KPI_Value"))
    values = values.join(wanted, "Input_ID", "left_semi").withColumn(
        "IsDelivered", F.when(F.col("KPI_Value").isNull(), "0").otherwise("1")
    )
    return values.join(attribute_variants(rows, _ATTRIBUTES[grain.name], wanted, compat), "Input_ID")


def matrix(
    flags: DataFrame,
    market_map: DataFrame,
    output: DataFrame,
    start: date,
    as_of: date,
    grain: Grain,
    compat: bool = False,
) -> DataFrame:
    """C7. Undelivered keys get '0' as delivered flag (and denominator), or null in ``compat``."""
    requested = grid(flags, market_map, start, as_of, grain, compat)
    wanted = requested.select(F.col("KEY1").alias("Input_ID"))
    found = lookups(output, wanted, grain, compat).withColumnRenamed("Input_ID", "KEY1")
    joined = requested.join(found, "KEY1", "left")
    if not compat:
        filled = [c for c in ("IsDelivered", "Denominator") if c in joined.columns]
        joined = joined.fillna("0", filled)
    return joined.select(*_COLUMNS[grain.name])


def matrix_outer(
    flags: DataFrame,
    market_map: DataFrame,
    output: DataFrame,
    start: date,
    as_of: date,
    grain: Grain = WEEKLY,
    compat: bool = False,
) -> DataFrame:
    """The older variant. Deliveries nobody requested stay as rows, and every distinct value of a
    key is kept in place of the largest."""
    requested = grid(flags, market_map, start, as_of, grain)
    rows = _delivered(output).select(
        "*",
        F.col("Value").alias("KPI_Value"),
        F.when(F.col("Value").isNull(), 0).otherwise(1).alias("IsDelivered"),
    )
    found = attribute_variants(rows, ("KPI_Value", "IsDelivered", *_ATTRIBUTES[grain.name]), compat=compat)
    joined = requested.join(found.withColumnRenamed("Input_ID", "KEY1"), "KEY1", "full")
    return joined.select(*_COLUMNS[grain.name])
