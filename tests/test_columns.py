"""Scalar rules against plain Python."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from kpiweave.functions import dates, text


def column(spark, values, *expressions):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [tuple(r)[1:] for r in df.select("i", *expressions).orderBy("i").collect()]


def test_numbers_agree_with_python(spark):
    texts = [
        "1,5", "1.5e3", "1d", "1f", "1_000", "_1", "1__0", "inf", "-Infinity", " 3 ", "\t4\n", "", "x", "0x10",
        "1.", ".5", ".", "+5", "-5,25", "1e", "1e+3", "1,2,3", "1 2", "١",
    ]
    def parse(t):
        try:
            return float(t.replace(",", "."))
        except ValueError:
            return None

    got = column(spark, texts, text.is_number_text(F.col("v")), text.number(F.col("v")))
    expected = [(parse(t) is not None, parse(t)) if t != "١" else (False, None) for t in texts]
    assert got == expected
    assert column(spark, ["nan", None], text.is_number_text(F.col("v")), text.number(F.col("v"))) == [(True, None), (False, None)]


def test_dates(spark):
    cases = {
        "05.01.2022": (date(2022, 1, 5), date(2022, 1, 5)),
        "05-Jan-95": (date(1995, 1, 5), None),
        "05-JUN-68": (date(2068, 6, 5), None),
        "29-feb-72": (date(1972, 2, 29), None),
        "05-Foo-95": (None, None),
        "2022-01-05 00:00:00": (date(2022, 1, 5), date(2022, 1, 5)),
        "2022-1-5": (date(2022, 1, 5), date(2022, 1, 5)),
        "31.02.2022": (None, None),
        "5.1.2022": (None, None),
        "2022-01": (None, None),
        "": (None, None),
        None: (None, None),
    }
    got = column(spark, list(cases), dates.weekly_date(F.col("v")), dates.period_date(F.col("v")))
    assert got == list(cases.values())
    stamps = ["20240131000000", "20240231000000", "2024013100000", "20240131250000"]
    assert column(spark, stamps, dates.daily_date(F.col("v"))) == [(date(2024, 1, 31),), (None,), (None,), (None,)]
    assert column(spark, ["31/01/24"], dates.daily_date(F.col("v"), "dd/MM/yy")) == [(date(2024, 1, 31),)]


def test_period_starts(spark):
    days = ["01.01.2024", "03.01.2024", "07.01.2024", "31.12.2023", "2024-01-03", None]
    got = column(spark, days, dates.week_start(F.col("v")), dates.month_start(F.col("v")))
    assert got == [
        (date(2024, 1, 1), date(2024, 1, 1)), (date(2024, 1, 1), date(2024, 1, 1)), (date(2024, 1, 1), date(2024, 1, 1)),
        (date(2023, 12, 25), date(2023, 12, 1)), (None, None), (None, None),
    ]


def test_year_week(spark):
    days = ["2024-12-30", "2023-01-01", "2024-06-03"]
    day = F.col("v").cast("date")
    assert column(spark, days, dates.year_week(day), dates.year_week(day, compat=True)) == [
        ("2025-cw1", "2023-cw1"), ("2022-cw52", "2023-cw52"), ("2024-cw23", "2024-cw23"),
    ]


def test_text_helpers(spark):
    v = F.col("v")
    assert column(spark, ["20240131120000", "x20240131120000", "31/1-2024", "x"],
                  dates.month_code(v), dates.stamp_to_business(v), dates.first_of_month_text(v), dates.dotted_text(v)) == [
        ("00012024", "31.01.2024", "20240131120000", "Unknown Format"),
        ("0040x202", "31.01.2024", "x20240131120000", "Unknown Format"),
        ("00-231/1", "Unknown Format", "01.1.2024", "31.1.2024"),
        ("00x", "Unknown Format", "x", "Unknown Format"),
    ]
    assert column(spark, ["a", "", None], text.name_or_placeholder(v, F.lit("k"), True), text.name_or_placeholder(v, F.lit("k")),
                  text.compare_value(F.lit("n"), v), text.compare_value(F.lit("n"), v, True)) == [
        ("a", "a", "a", "a"), ("*nonamefor_K", "", "", "n"), ("*nonamefor_K", "*nonamefor_K", "n", "n"),
    ]
    assert column(spark, [" A ", "b"], text.has_update(v, F.lit(" a"))) == [(False,), (True,)]


@pytest.mark.parametrize("as_of,months,expected", [(date(2024, 1, 31), 1, date(2023, 12, 1)), (date(2024, 3, 15), 3, date(2023, 12, 1))])
def test_months_before(as_of, months, expected):
    assert dates.months_before(as_of, months) == expected


def test_month_label():
    assert dates.month_label(date(2001, 7, 1)) == "2001-Jul"
