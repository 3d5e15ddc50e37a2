"""Business-date parsing and calendar columns. Unparsable text gives null, never an error."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, functions as F

DAILY_FORMAT = "yyyyMMddHHmmss"
TWO_DIGIT_PIVOT = 69

# Text is first brought to yyyy-MM-dd, which Spark casts to a date without a formatter object and
# without an exception per bad row.
_STAMP = r"(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})(\d{2})"
_DAILY_STAMP = r"^(\d{4})(\d{2})(\d{2})([01]\d|2[0-3])[0-5]\d[0-5]\d$"
_DOTTED = r"^(\d{2})\.(\d{2})\.(\d{4})$"
_NAMED_MONTH = r"^\d{2}-\w{3}-\d{2}$"
_ISO = r"^\d{4}-\d{1,2}-\d{1,2}$"
_ANY_DELIMITED = r"(\d+)[./\-](\d+)[./\-](\d+)"
_MONTHS = ("JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC")


def business_text(day: Column) -> Column:
    """``dd.MM.yyyy``."""
    iso = day.cast("string")
    return F.concat_ws(".", F.substring(iso, 9, 2), F.substring(iso, 6, 2), F.substring(iso, 1, 4))


def from_iso(iso: Column) -> Column:
    """Date of ``yyyy-MM-dd`` text, null for other text."""
    return F.when(F.rlike(iso, F.lit(_ISO)), iso.try_cast("date"))


def daily_iso(value: Column, fmt: str = DAILY_FORMAT) -> Column:
    """The date part as ``yyyy-MM-dd``; null for text in another format."""
    if fmt == DAILY_FORMAT:
        return F.when(F.rlike(value, F.lit(_DAILY_STAMP)), F.regexp_replace(value, _DAILY_STAMP, "$1-$2-$3"))
    return F.to_date(F.try_to_timestamp(value, F.lit(fmt))).cast("string")


def _without_time(value: Column) -> Column:
    return F.split_part(value, F.lit(" "), F.lit(1))


def _dotted_to_iso(text: Column) -> Column:
    return F.regexp_replace(text, _DOTTED, "$3-$2-$1")


def _named_to_iso(text: Column) -> Column:
    """``dd-MMM-yy``; an unknown month name gives no date."""
    month = F.array_position(F.array(*[F.lit(m) for m in _MONTHS]), F.upper(F.substring(text, 4, 3)))
    year = F.substring(text, 8, 2)
    century = F.when(year.try_cast("int") >= TWO_DIGIT_PIVOT, "19").otherwise("20")
    return F.concat(century, year, F.lit("-"), month.cast("string"), F.lit("-"), F.substring(text, 1, 2))


def weekly_iso(value: Column) -> Column:
    """P10: ``dd.MM.yyyy``, ``dd-MMM-yy`` (years from 69 on are 19xx) or ``yyyy-MM-dd``."""
    text = _without_time(value)
    return F.when(F.rlike(text, F.lit(_NAMED_MONTH)), _named_to_iso(text)).otherwise(_dotted_to_iso(text))


def period_iso(value: Column) -> Column:
    """``dd.MM.yyyy`` or ``yyyy-MM-dd``."""
    return _dotted_to_iso(_without_time(value))


def daily_date(value: Column, fmt: str = DAILY_FORMAT) -> Column:
    return from_iso(daily_iso(value, fmt))


def weekly_date(value: Column) -> Column:
    return from_iso(weekly_iso(value))


def period_date(value: Column) -> Column:
    return from_iso(period_iso(value))


def _business_day(value: Column) -> Column:
    return F.when(F.rlike(value, F.lit(_DOTTED)), _dotted_to_iso(value).try_cast("date"))


def week_start(value: Column) -> Column:
    """Monday of a ``dd.MM.yyyy`` date; null for other text."""
    return F.date_sub(F.next_day(_business_day(value), "Mon"), 7)


def month_start(value: Column) -> Column:
    """First of the month of a ``dd.MM.yyyy`` date; null for other text."""
    return F.trunc(_business_day(value), "MM")


def month_code(value: Column) -> Column:
    """P36."""
    return F.concat(F.lit("00"), F.substring(value, 5, 2), F.substring(value, 1, 4))


def stamp_to_business(value: Column) -> Column:
    """P37."""
    part = lambda i: F.regexp_extract(value, _STAMP, i)
    return F.when(
        F.rlike(value, F.lit(_STAMP)), F.concat_ws(".", part(3), part(2), part(1))
    ).when(value.isNotNull(), F.lit("Unknown Format"))


def first_of_month_text(value: Column) -> Column:
    """P38."""
    part = lambda i: F.regexp_extract(value, _ANY_DELIMITED, i)
    return F.when(
        F.rlike(value, F.lit(_ANY_DELIMITED)), F.concat_ws(".", F.lit("01"), part(2), part(3))
    ).otherwise(value)


def dotted_text(value: Column) -> Column:
    """P39."""
    part = lambda i: F.regexp_extract(value, _ANY_DELIMITED, i)
    return F.when(
        F.rlike(value, F.lit(_ANY_DELIMITED)), F.concat_ws(".", part(1), part(2), part(3))
    ).when(value.isNotNull(), F.lit("Unknown Format"))


def year_week(day: Column, compat: bool = False) -> Column:
    """ISO week-year; ``compat`` takes the calendar year, less one in December."""
    if compat:
        year = F.year(day) - F.when(F.month(day) == 12, 1).otherwise(0)
    else:
        year = F.extract(F.lit("YEAROFWEEK"), day)
    return F.concat(year.cast("string"), F.lit("-cw"), F.weekofyear(day).cast("string"))


def calendar_columns(day: Column, compat: bool = False) -> dict[str, Column]:
    """The calendar attributes kept in the daily matrix."""
    return {
        "normDate": F.date_format(day, "yyyyMMdd"),
        "Week": F.weekofyear(day),
        "Month": F.month(day),
        "Year": F.year(day),
        "Day": F.day(day),
        "YearMonth": F.date_format(day, "yyyyMM"),
        "Quarter": F.concat(F.lit("Q"), F.quarter(day).cast("string")),
        "YearWeek": year_week(day, compat),
        "WeekDay": F.weekday(day),
    }


def year_flags(day: Column, as_of: Column) -> dict[str, Column]:
    """P33. The second flag looks at the year of the day before."""
    return {
        "CurYTDFlag": F.when(F.year(day) == F.year(as_of), 1).otherwise(0),
        "LastYTDFlag": F.when(F.year(F.date_sub(day, 1)) == F.year(as_of), 1).otherwise(0),
        "RC12": F.year(day) == F.year(F.add_months(as_of, -12)),
    }


def months_before(as_of: date, months: int) -> date:
    """First day of the month ``months`` before ``as_of``."""
    index = as_of.year * 12 + as_of.month - 1 - months
    return date(index // 12, index % 12 + 1, 1)


def month_label(first_day: date) -> str:
    """``yyyy-MMM`` with English month names."""
    return f"{first_day.year}-{_MONTHS[first_day.month - 1].capitalize()}"
