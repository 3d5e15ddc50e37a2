"""Date series by generator expression; nothing is joined to produce them."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from kpiweave.functions import dates
from kpiweave.operators.grain import DAILY, WEEKLY, Grain


def first_period(start: date, grain: Grain) -> date:
    """The first day, Monday or first of a month on or after ``start``."""
    if grain is DAILY:
        return start
    if grain is WEEKLY:
        return start + timedelta(days=-start.weekday() % 7)
    return start if start.day == 1 else dates.months_before(start, -1)


def period_dates(start: date, as_of: date, grain: Grain) -> Column:
    """Array of all period starts from ``start`` to the day before ``as_of``."""
    first, last = first_period(start, grain), as_of - timedelta(days=1)
    if first > last:
        return F.array().cast("array<date>")
    step = {"daily": "INTERVAL 1 DAY", "weekly": "INTERVAL 7 DAY", "monthly": "INTERVAL 1 MONTH"}[grain.name]
    return F.sequence(F.lit(first), F.lit(last), F.expr(step))


def series(bounds: DataFrame) -> DataFrame:
    """G1: every day of each row's ``start`` .. ``as_of`` minus one day, as column Date."""
    last = F.date_sub(F.col("as_of"), 1)
    days = F.when(F.col("start") <= last, F.sequence(F.col("start"), last, F.expr("INTERVAL 1 DAY")))
    return bounds.select("as_of", F.explode(days).alias("Date"))


def calendar(bounds: DataFrame, compat: bool = False) -> DataFrame:
    """The series with all calendar attributes and year flags."""
    day = F.col("Date")
    attributes = {**dates.calendar_columns(day, compat), **dates.year_flags(day, F.col("as_of"))}
    return series(bounds).select("Date", *[c.alias(n) for n, c in attributes.items()])


def week_starts(days: DataFrame) -> DataFrame:
    return days.filter(F.weekday("Date") == 0)


def month_starts(days: DataFrame) -> DataFrame:
    return days.filter(F.day("Date") == 1)
