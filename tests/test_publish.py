"""Roll-ups, registry, matrix, facts, report and delivery monitoring."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from kpiweave import schemas
from kpiweave.operators import calendar, deliveries, facts, matrix, registry, report, rollup
from kpiweave.operators.grain import DAILY, MONTHLY, WEEKLY

REGISTRY = "KPI_ID string, KPI_Name string, Unit string, Vendor string, Service string, PM_Report string, more string, XA string, XA_1 string, XA_2 string"
GRID = ["XA", "XA_1", "XA_2"]


@pytest.fixture
def kpis(spark):
    return spark.createDataFrame(
        [
            (" k1 ", " one ", "u", "v", "s", "Y", "yes", "x", None, "x"),
            ("K2", "Two", "u", "v", "s", "y", "no", None, "x", "x"),
            ("K3", "Three", "u", None, "s", "Y", None, None, None, None),
            (None, "Four", "u", "v", "s", "N", "maybe", "x", "x", "x"),
            ("", "Five", "u", "v", "s", "Y", None, "x", "x", "x"),
        ],
        REGISTRY,
    )


@pytest.fixture
def market_map(spark):
    return spark.createDataFrame([("XA", "MA"), ("XB", "MB")], "code string, market string")


def daily_state(spark, items):
    rows = [(f"MA-{k}-{d}-d", d, "t", r, s, k, den, num, v, "f", flag) for k, d, v, flag, r, s, den, num in items]
    return spark.createDataFrame(rows, schemas.DAILY_OUTPUT_SCHEMA)


def got(df, *columns):
    return sorted((tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect()), key=str)


def test_averages(spark, kpis):
    nan = float("nan")
    state = daily_state(spark, [
        ("K1", "01.01.2024", 1.0, "Correction", "MA", "S", "1", "1"), ("k1", "07.01.2024", 2.0, "Correction", "MA", "S", "1", "1"),
        ("K1", "08.01.2024", nan, None, "MA", "S", "1", "1"), ("K9", "31.01.2024", 5.0, "Correction", "MA", "S", "1", "1"),
        ("K9", "29.01.2024", 6.0, None, "MA", "S", "1", "1"), ("K1", "2024-01-01", 9.0, None, "MA", "S", "1", "1"),
        ("K1", "01.01.2024", 9.0, None, None, "S", "1", "1"),
    ])
    assert got(rollup.averages(state, kpis, WEEKLY), "Input_ID", "Value", "was_corrected_Flag") == [
        ("MA-*nonamefor_K9-29.01.2024-w", 5.5, ""), ("MA-ONE-01.01.2024-w", 1.5, "Correction(s)"), ("MA-ONE-08.01.2024-w", None, ""),
    ]
    assert got(rollup.averages(state, kpis, MONTHLY), "Input_ID", "Value") == [("MA-*nonamefor_K9-01.01.2024-m", 5.5), ("MA-ONE-01.01.2024-m", 1.5)]


def test_delivered_wins_over_calculated(spark):
    def period(items):
        return spark.createDataFrame([(i, "d", "K", "M", v, None, f, None) for i, v, f in items], schemas.PERIOD_OUTPUT_SCHEMA)

    calculated = period([("a", 1.0, "calculation"), ("b", 2.0, "calculation"), ("c", 3.0, "calculation"), ("n", 5.0, "calculation")])
    before = period([("a", 10.0, "w.csv"), ("b", 20.0, "calculation"), ("d", 40.0, "w.csv"), ("n", 50.0, None), (None, 9.0, "w.csv")])
    assert got(rollup.merge_averages(calculated, before), "Input_ID", "Value") == sorted(
        [("a", 10.0), ("b", 2.0), ("c", 3.0), ("d", 40.0), ("n", 50.0), (None, 9.0)], key=str
    )


def test_request_flags(kpis):
    columns = ("KPI_ID", "KPI_Name", "Natco", "requested_Daily", "requested_Weekly", "requested_Monthly")
    flags = got(registry.request_flags(kpis, GRID), *columns)
    assert flags == [("K2", "Two", "XA", 0, 1, 1), ("K3", "Three", "XA", 0, 0, 0), ("k1", "one", "XA", 1, 0, 1)]
    literal = got(registry.request_flags(kpis, GRID, compat=True), *columns)
    assert ("nan", "Four", "XA", 1, 1, 1) in literal and len(literal) == 4


def test_period_dates(spark):
    days = lambda *a: spark.range(1).select(F.explode(calendar.period_dates(*a)).alias("d")).collect()
    assert [r.d.isoformat() for r in days(date(2024, 1, 2), date(2024, 1, 16), WEEKLY)] == ["2024-01-08", "2024-01-15"]
    assert [r.d.isoformat() for r in days(date(2023, 12, 2), date(2024, 2, 1), MONTHLY)] == ["2024-01-01"]
    assert len(days(date(2024, 1, 1), date(2025, 1, 1), DAILY)) == 366
    assert days(date(2024, 1, 2), date(2024, 1, 2), DAILY) == []


def test_calendar_flags(spark):
    bounds = spark.createDataFrame([(date(2022, 12, 31), date(2024, 1, 3))], "start date, as_of date")
    c = calendar.calendar(bounds).filter("Date in ('2023-12-31', '2024-01-01', '2024-01-02')")
    assert got(c, "Date", "CurYTDFlag", "LastYTDFlag", "RC12", "WeekDay", "Quarter") == [
        (date(2023, 12, 31), 0, 0, True, 6, "Q4"), (date(2024, 1, 1), 1, 0, False, 0, "Q1"), (date(2024, 1, 2), 1, 1, False, 1, "Q1"),
    ]


def test_matrix_daily(spark, kpis, market_map):
    state = daily_state(spark, [
        ("K1", "01.01.2024", 9.5, None, "MA", "S1", "1", "7"), ("K1", "01.01.2024", 10.0, None, "MA", "S2", "2", "7"),
        ("K2", "02.01.2024", None, "Correction", "MA", "S1", None, "7"), ("K9", "01.01.2024", 1.0, None, "MA", "S1", "1", "7"),
    ])
    flags = registry.request_flags(kpis, GRID)
    span = (date(2024, 1, 1), date(2024, 1, 11))
    built = matrix.matrix(flags, market_map, state, *span, DAILY)
    assert built.columns == schemas.MATRIX_DAILY
    unique = state.filter("SourceSystem = 'S1'")
    assert matrix.matrix(flags, market_map, unique, *span, DAILY).count() == 3 * 10
    delivered = built.filter("Time is not null")
    # the two deliveries as they came, each with the largest value
    assert got(delivered, "KEY1", "KPI_Value", "IsDelivered", "SourceSystem", "Denominator") == [
        ("MA-K1-01.01.2024-d", 10.0, "1", "S1", "1"), ("MA-K1-01.01.2024-d", 10.0, "1", "S2", "2"), ("MA-K2-02.01.2024-d", None, "0", "S1", "0"),
    ]
    assert built.count() == 3 * 10 + 1
    assert built.filter("Time is null").select("IsDelivered", "Denominator").distinct().collect() == [("0", "0")]
    literal = matrix.matrix(flags, market_map, state, *span, DAILY, compat=True)
    # the literal rule: two source systems by two denominators, every combination
    assert got(literal.filter("KEY1 = 'MA-K1-01.01.2024-d'"), "KPI_Value", "SourceSystem", "Denominator") == [
        (9.5, s, d) for s in ("S1", "S2") for d in ("1", "2")
    ]
    assert literal.filter("Time is null").select("IsDelivered", "Denominator").distinct().collect() == [(None, None)]


def test_matrix_outer_keeps_unrequested(spark, kpis, market_map):
    rows = [("MA-ONE-01.01.2024-w", "01.01.2024", "ONE", "MA", v, None, "f", None) for v in (1.0, 2.0)]
    rows.append(("MB-X-01.01.2024-w", "01.01.2024", "X", "MB", 3.0, None, "f", None))
    state = spark.createDataFrame(rows, schemas.PERIOD_OUTPUT_SCHEMA)
    built = matrix.matrix_outer(registry.request_flags(kpis, GRID), market_map, state, date(2024, 1, 1), date(2024, 1, 2))
    assert got(built, "KEY1", "KPI_Name", "KPI_Value", "IsDelivered") == [
        ("MA-ONE-01.01.2024-w", "one", 1.0, 1), ("MA-ONE-01.01.2024-w", "one", 2.0, 1),
        ("MA-THREE-01.01.2024-w", "Three", None, None), ("MA-TWO-01.01.2024-w", "Two", None, None), ("MB-X-01.01.2024-w", None, 3.0, 1),
    ]


def test_facts(spark, kpis):
    weekly = spark.createDataFrame([("w1", "d", "ONE", "M", 1.0, None, "f", None), ("w2", "d", "THREE", "M", 1.0, None, "f", None)], schemas.PERIOD_OUTPUT_SCHEMA)
    ims = spark.createDataFrame([("d", "TWO", "2,5", "M", "i1"), ("d", "FOUR", "2,5", "M", "i2")], schemas.IMS_FACTS_SCHEMA)
    built = facts.facts(weekly, ims, kpis)
    assert built.columns == schemas.FACTS
    assert got(built, "Input_ID", "Value", "Polarity", "%SVKPI_Key") == [("i1-w", 2.5, "less is better", "s-v-TWO"), ("w1", 1.0, "more is better", "s-v-ONE")]
    # untrimmed names meet trimmed ones in neither direction
    assert got(facts.facts(weekly, ims, kpis.filter("more <> 'maybe'"), compat=True), "Input_ID") == [("i1-w",)]
    with pytest.raises(Exception, match="unknown polarity maybe"):
        registry.facts_registry(kpis, compat=True).collect()


def test_report(spark):
    kpis = spark.createDataFrame([(f"K{i}", "u", m) for i, m in enumerate(["yes", "no", None, "yes", "yes", "yes"])], "KPI_ID string, Unit string, more string")
    mapping = spark.createDataFrame(
        [(f"K{i}", t, f, "x") for i, (t, f) in enumerate([("5", "T"), ("5", "T"), ("5", "T"), ("5", "F"), ("5", "T"), (None, "T")])],
        "KPI_ID string, Threshold string, Threshold_flag string, XA string",
    )
    jan, nov = date(2024, 1, 1), date(2023, 11, 1)
    rows = [("XA", f"K{i}", f"n{i}", r, jan, v, d) for i, (r, v, d) in enumerate(
        [(1, 4.0, "1"), (1, 6.0, "1"), (1, 4.0, "1"), (1, 4.0, "1"), (1, None, "0"), (0, 4.0, "1")])]
    rows += [("XA", "K0", "n0", 1, nov, 7.0, "1"), ("XA", "K0", "n0b", 1, nov, 8.0, "1")]
    m = spark.createDataFrame(rows, "Natco string, KPI_ID string, KPI_Name string, requested_Monthly int, Date date, KPI_Value double, IsDelivered string")
    built = report.status_report(m, kpis, mapping, ["XA"], date(2024, 2, 29))
    assert built.columns == ["Natco", "Last Month Status", "KPI_Name", "2024-Jan", "2023-Dec", "2023-Nov", "Unit", "Threshold"]
    assert got(built, "KPI_Name", "Last Month Status", "2023-Nov", "Threshold") == [
        ("n0", "SLA Breach", 7.0, "5"), ("n0", "SLA Breach", 8.0, "5"), ("n1", "SLA Breach", None, "5"),
        ("n2", "OK", None, "5"), ("n3", "OK", None, None), ("n4", "MISSING", None, "5"),
    ]
    every = report.status_report(m, kpis, mapping, ["XA"], date(2024, 2, 29), include_unrequested=True)
    assert got(every.filter("KPI_Name = 'n5'"), "Last Month Status") == [("Not requested",)]
    assert got(report.last_three_months(m, date(2024, 2, 29)).filter("KPI_ID = 'K0'"), "KPI_Name", "2024-Jan", "2023-Nov") == [("n0", 4.0, 7.0), ("n0b", None, 8.0)]


def test_deliveries(spark):
    names = ["a_2024-01-01.csv_m1.csv", "b_2024-01-01.csv_m1.csv", "a_2024-01-02.csv_m1.csv", "a_2024-01-01.csv_m2.csv", "odd.csv"]
    parsed = deliveries.parse_names(spark.createDataFrame([(n,) for n in names], "name string"))
    markets = spark.createDataFrame([("m1", True), ("m2", False)], "market string, stable boolean")
    expected = deliveries.expected_deliveries(markets, ["a", "b"], date(2024, 1, 1), date(2024, 1, 2))
    assert expected.count() == 8
    assert got(deliveries.missing_deliveries(parsed, expected).filter("delivery_date = '2024-01-01'"), "market", "file_type", "action") == [("m2", "b", "placeholder")]
    assert got(deliveries.run_verdict(parsed, expected), "delivery_date", "missing_files", "next_step") == [
        (date(2024, 1, 1), 0, "check_files"), (date(2024, 1, 2), 1, "terminate"),
    ]
    assert got(deliveries.incomplete_deliveries(parsed, ["a", "b"]), "market", "first_file") == [("m1", "a_2024-01-02.csv_m1.csv"), ("m2", "a_2024-01-01.csv_m2.csv")]
    assert got(deliveries.complete_deliveries(parsed, ["a", "b"]), "market", "files") == [("m1", 2)]
    plan = [(r.market, r.run_date.isoformat(), r["mode"]) for r in deliveries.reprocess_plan(parsed.filter("market = 'm1'")).collect()]
    assert plan == [("m1", "2023-12-31", "update"), ("m1", "2024-01-01", "daily"), ("m1", "2024-01-01", "update"), ("m1", "2024-01-02", "daily")]
    assert deliveries.pending_files(parsed, markets.filter("stable"), ["a"]).count() == 2


def test_names(spark):
    manifest = spark.createDataFrame([("X.20240105.CSV",), ("X.20240106.CSV",), ("XX.20240105.CSV",)], "name string")
    assert got(deliveries.rejected_names(manifest, [r"X\.{date}\.CSV"], date(2024, 1, 5)), "name") == [("X.20240106.CSV",), ("XX.20240105.CSV",)]
    allow = spark.createDataFrame([("X.20240105.CSV",), ("other",)], "name string")
    assert got(deliveries.publishable(manifest, allow), "name") == [("X.20240105.CSV",)]
    who = spark.createDataFrame([("XX", "a"), ("X", "b"), ("LONGER THAN ANY NAME", "c")], "market string, address string")
    assert got(deliveries.report_recipients(manifest, who).filter("name like '%0105%'"), "name", "address") == [
        ("X.20240105.CSV", "b"), ("XX.20240105.CSV", "a"), ("XX.20240105.CSV", "b"),
    ]
