"""Weekly and monthly means of daily values."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from kpiweave.functions import dates, keys
from kpiweave.functions.text import name_or_placeholder, nan_to_null, or_text
from kpiweave.operators.grain import WEEKLY, Grain
from kpiweave.operators.registry import id_names
from kpiweave.operators.upsert import without_keys

CALCULATED = "calculation"


@dataclass(frozen=True)
class RolledUp:
    averages: DataFrame  # every calculated row
    output: DataFrame  # the period table with calculated rows where nothing was delivered


def averages(daily_output: DataFrame, registry: DataFrame, grain: Grain) -> DataFrame:
    """Mean per market, period and KPI name; flagged only where every day was corrected.

    Rows are summed per KPI id before the registry join, so the join and the second aggregation see
    one row per market, period and id.
    """
    start = dates.week_start if grain is WEEKLY else dates.month_start
    per_id = (
        daily_output.select(
            "Region",
            start(F.col("Date")).alias("_start"),
            F.upper(or_text(F.col("KPI_ID"), "nan")).alias("KPI_ID"),
            nan_to_null(F.col("Value")).alias("Value"),
            or_text(F.col("was_corrected_Flag"), "").alias("_flag"),
        )
        .filter(F.col("_start").isNotNull() & F.col("Region").isNotNull())
        .groupBy("Region", "_start", "KPI_ID")
        .agg(F.sum("Value").alias("_sum"), F.count("Value").alias("_n"), F.min("_flag").alias("_flag"))
    )
    named = per_id.join(id_names(registry), "KPI_ID", "left").withColumn(
        "KPI name", name_or_placeholder(F.col("KPI_Name"), F.col("KPI_ID"))
    )
    means = named.groupBy("Region", "_start", "KPI name").agg(
        F.try_divide(F.sum("_sum"), F.sum("_n").cast("double")).alias("Value"),
        F.min("_flag").alias("_flag"),
    )
    day = dates.business_text(F.col("_start"))
    return means.select(
        keys.input_id(F.col("Region"), F.col("KPI name"), day, grain.suffix).alias("Input_ID"),
        day.alias("Date"),
        "KPI name",
        "Region",
        "Value",
        F.lit("").alias("Remarks"),
        F.lit(CALCULATED).alias("Input_File"),
        F.when(F.col("_flag") == "Correction", "Correction(s)").otherwise("").alias("was_corrected_Flag"),
    )


def merge_averages(calculated: DataFrame, period_output: DataFrame) -> DataFrame:
    """A delivered row wins over a calculated one, a new calculation over an old one."""
    delivered = period_output.filter(~F.col("Input_File").eqNullSafe(CALCULATED))
    fresh = without_keys(calculated, delivered)
    return fresh.unionByName(without_keys(period_output, fresh).select(*calculated.columns))


def roll_up(daily_output: DataFrame, registry: DataFrame, period_output: DataFrame, grain: Grain) -> RolledUp:
    calculated = averages(daily_output, registry, grain)
    return RolledUp(calculated, merge_averages(calculated, period_output))
