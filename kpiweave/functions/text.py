"""Text and number columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

BLANKS = " \t\n\r\x0b\x0c"

# Number text: sign, digits with single underscores between them, one dot, exponent; or inf / nan.
_DIGITS = r"\d+(_\d+)*"
NUMBER_TEXT = (
    rf"(?i)^[+-]?(inf(inity)?|nan|({_DIGITS}\.?({_DIGITS})?|\.{_DIGITS})(e[+-]?{_DIGITS})?)$"
)


def strip(value: Column) -> Column:
    return F.btrim(value, F.lit(BLANKS))


def upper_strip(value: Column) -> Column:
    """Name without surrounding blanks, upper case."""
    return strip(F.upper(value))


def _dotted(value: Column) -> Column:
    return strip(F.replace(value, F.lit(","), F.lit(".")))


def is_number_text(value: Column) -> Column:
    """true for text that is a number after the decimal comma became a dot; false for null."""
    return F.coalesce(F.rlike(_dotted(value), F.lit(NUMBER_TEXT)), F.lit(False))


def checked_number(value: Column) -> Column:
    """P8 for text that passed ``is_number_text``; ``nan`` gives null."""
    return nan_to_null(F.replace(_dotted(value), F.lit("_"), F.lit("")).try_cast("double"))


def number(value: Column) -> Column:
    """Decimal comma or dot text as double; anything that is no number gives null."""
    return F.when(is_number_text(value), checked_number(value))


def nan_to_null(value: Column) -> Column:
    return F.nanvl(value, F.lit(None).cast("double"))


def or_text(value: Column, null_text: str) -> Column:
    return F.coalesce(value, F.lit(null_text))


def contains_text(haystack: Column, needle: Column) -> Column:
    """Containment with a missing remark rendered as ``nan`` on both sides."""
    return F.contains(or_text(haystack, "nan"), or_text(needle, "nan"))


def name_or_placeholder(name: Column, kpi_id: Column, also_empty: bool = False) -> Column:
    """``*nonamefor_{ID}`` where the registry has no name."""
    missing = name.isNull()
    if also_empty:
        missing = missing | (F.length(name) == 0)
    return F.when(missing, F.concat(F.lit("*nonamefor_"), F.upper(or_text(kpi_id, "nan")))).otherwise(name)


def compare_value(new: Column, old: Column, empty_is_missing: bool = False) -> Column:
    """The old value, or the new one where there is no old one."""
    if empty_is_missing:
        return F.when(old.isNull() | (F.length(old) == 0), new).otherwise(old)
    return F.coalesce(old, new)


def has_update(new: Column, compare: Column) -> Column:
    """Blank-insensitive difference against the upper-cased compare text."""
    return strip(or_text(new, "nan")) != F.upper(strip(or_text(compare, "nan")))
