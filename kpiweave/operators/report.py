"""Status of last month's requested figures."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from kpiweave.functions.dates import month_label, months_before
from kpiweave.functions.text import number, strip
from kpiweave.operators.registry import country_thresholds


def meets_threshold(value: Column, threshold: Column, more: Column) -> Column:
    """At least the threshold where more is better, at most where less is; otherwise passed."""
    limit = number(threshold)
    return (
        F.when(limit.isNull(), True)
        .when(more == "yes", F.coalesce(limit <= value, F.lit(False)))
        .when(more == "no", F.coalesce(limit >= value, F.lit(False)))
        .otherwise(True)
    )


def status(requested: Column, delivered: Column, passed: Column) -> Column:
    """P27."""
    return (
        F.when(~requested, "Not requested")
        .when(~delivered, "MISSING")
        .when(passed, "OK")
        .otherwise("SLA Breach")
    )


def _month_values(matrix_monthly: DataFrame, first_day: date, label: str) -> DataFrame:
    """F13 / A11."""
    return (
        matrix_monthly.filter(F.col("Date") == F.lit(first_day))
        .select("Natco", "KPI_ID", F.col("KPI_Value").alias(label))
        .distinct()
    )


def status_report(
    matrix_monthly: DataFrame,
    registry: DataFrame,
    mapping: DataFrame,
    countries: Sequence[str],
    as_of: date,
    compat: bool = False,
    include_unrequested: bool = False,
) -> DataFrame:
    """One row per requested KPI and country (all countries at once, in column Natco)."""
    months = [months_before(as_of, n) for n in (1, 2, 3)]
    labels = [month_label(m) for m in months]
    current = matrix_monthly.filter(F.col("Date") == F.lit(months[0])).select(
        "Natco",
        "KPI_ID",
        "KPI_Name",
        F.coalesce(F.col("requested_Monthly").cast("string") == "1", F.lit(False)).alias("_requested"),
        F.coalesce(F.col("IsDelivered") == "1", F.lit(False)).alias("_delivered"),
        F.col("KPI_Value").alias(labels[0]),
    )
    if not include_unrequested:
        current = current.filter(F.col("_requested"))  # F14
    kpi = F.col("KPI_ID") if compat else strip(F.col("KPI_ID"))
    units = registry.select(kpi.alias("KPI_ID"), "Unit", "more")
    rows = (
        current.join(_month_values(matrix_monthly, months[1], labels[1]), ["Natco", "KPI_ID"], "left")
        .join(_month_values(matrix_monthly, months[2], labels[2]), ["Natco", "KPI_ID"], "left")
        .join(units, "KPI_ID", "left")
        .join(country_thresholds(mapping, countries, compat), ["Natco", "KPI_ID"], "left")
    )
    passed = meets_threshold(F.col(labels[0]), F.col("Threshold"), F.col("more"))
    result = status(F.col("_requested"), F.col("_delivered"), passed)
    return rows.select(
        "Natco", result.alias("Last Month Status"), "KPI_Name", *[F.col(f"`{c}`") for c in labels], "Unit", "Threshold"
    )


def last_three_months(matrix_monthly: DataFrame, as_of: date) -> DataFrame:
    """R2: values of the last three months as columns, one row per country and KPI."""
    months = [months_before(as_of, n) for n in (1, 2, 3)]
    value = lambda m: F.max(F.when(F.col("Date") == F.lit(m), F.col("KPI_Value")))
    return (
        matrix_monthly.filter(F.col("Date").isin(months))
        .groupBy("Natco", "KPI_ID", "KPI_Name")
        .agg(*[value(m).alias(month_label(m)) for m in months])
    )
