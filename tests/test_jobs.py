"""Jobs and the stream on small files, end to end."""

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from kpiweave.operators.grain import DAILY, MONTHLY, WEEKLY
from kpiweave.plans import jobs
from kpiweave.sources import feeds
from kpiweave.sources.tables import RunConflict, Warehouse
from kpiweave.streaming.ingest import ingest_stream, read_daily_stream


def put(folder, name, lines, mtime):
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / name
    path.write_text("\n".join(lines) + "\n")
    os.utime(path, (mtime, mtime))


def daily_line(day, kpi, value, marker="L", trail="|"):
    return f"{marker}|{day}000000|{day}235959|file-market|SRC|{kpi}|10|5|{value}{trail}"


@pytest.fixture
def registry(spark):
    cols = "KPI_ID string, KPI_Name string, Unit string, Vendor string, Service string, PM_Report string, more string, XA string, XA_1 string, XA_2 string"
    return spark.createDataFrame(
        [(" k1 ", "kpi one", "u", "v", "s", "Y", "yes", "x", "x", "x"), ("K2", "Kpi Two", "u", "v", "s", "N", None, None, None, None)],
        cols,
    )


@pytest.fixture
def market_map(spark):
    return spark.createDataFrame([("XA", "MA")], "code string, market string")


def test_read_daily(spark, tmp_path, rows):
    put(tmp_path / "MA" / "daily", "a.csv", [daily_line("20240101", "k1", "1,5"), daily_line("20240102", "k1", "", "C")], 100)
    put(tmp_path / "MB" / "daily", "b.csv", [daily_line("20240101", "k1", "2.5", trail="")], 50)
    put(tmp_path / "MB" / "daily", "ignored.txt", ["x"], 50)
    raw = feeds.read_daily(spark, str(tmp_path))
    assert rows(raw, "Marker", "Natco", "Value", "Input_File", "Input_File_Time") == [
        ("C", "MA", None, "a.csv", "1970-01-01-00:01:40"),
        ("L", "MA", "1,5", "a.csv", "1970-01-01-00:01:40"),
        ("L", "MB", "2.5", "b.csv", "1970-01-01-00:00:50"),
    ]


def test_first_comment_of_a_file_in_several_splits(spark, tmp_path):
    from kpiweave.operators import normalize

    lines = [daily_line("20240101", "k1", i) for i in range(3000)]
    lines[2000] = daily_line("20240202", "k1", "", "C")
    lines[2500] = daily_line("20240101", "k1", "", "C")
    put(tmp_path / "MA" / "daily", "a.csv", lines, 100)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        raw = feeds.read_daily(spark, str(tmp_path))
        assert raw.rdd.getNumPartitions() > 3
        comments = normalize.file_comments(raw).select("Input_File", "CommentFileNew").collect()
        assert comments == [("a.csv", "20240202000000")]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_files_of_one_name_and_folders_with_blanks(spark, tmp_path, rows):
    from kpiweave.operators import normalize

    put(tmp_path / "M A+1" / "daily", "day.csv", [daily_line("20240203", "k1", "", "C"), daily_line("20240101", "k1", 1)], 100)
    put(tmp_path / "MB" / "daily", "day.csv", [daily_line("20240101", "k1", 2)], 101)
    raw = feeds.read_daily(spark, str(tmp_path))
    done = normalize.with_file_comment(normalize.normalize_daily(raw), normalize.file_comments(raw))
    assert rows(done, "Region", "Value", "CommentFileNew") == [("M A+1", 1.0, "20240203000000"), ("MB", 2.0, "null")]


def test_stamps_of_another_format_are_quarantined(spark):
    from kpiweave.operators import normalize

    raw = spark.createDataFrame(
        [("L", d, "t", "MA", "S", "k", "1", "1", "5", "f") for d in ("20240131000000", "2024-01-31", "20240131")],
        "Marker string, DatumKPI string, TimestampTo string, Natco string, SourceSystem string, KPINameDaily string, "
        "Denominator string, Numerator string, Value string, Input_File string",
    )
    assert [r["Date"] for r in normalize.normalize_daily(raw).collect()] == ["31.01.2024"]
    assert sorted(r["DatumKPI"] for r in normalize.quarantine_daily(raw).collect()) == ["2024-01-31", "20240131"]


def test_unreadable_ims_dates_and_unknown_codes_are_kept_apart(spark):
    from kpiweave.operators import normalize

    raw = spark.createDataFrame(
        [(d, "k", "1", "MA") for d in ("1/2/2024", "02.01.2024", None, "")], "Date string, `KPI name` string, Value string, Region string"
    )
    assert [r["Date"] for r in normalize.normalize_ims(raw).collect()] == ["02.01.2024"]
    assert [(r["Date"], r["reason"]) for r in normalize.quarantine_ims(raw).collect()] == [("1/2/2024", "unreadable date")]
    known = spark.createDataFrame([("AX", "MA")], "code string, market string")
    flags = spark.createDataFrame([("AX",), ("QX",)], "Natco string")
    assert [tuple(r) for r in normalize.unknown_markets(flags, known, "Natco").collect()] == [("QX", "unknown country")]


def test_read_period_without_remarks_column(spark, tmp_path, rows):
    put(tmp_path / "MA" / "monthly", "a.csv", ["Date|KPI name|Value|Remarks", "01.01.2024|k1|1|", "01.01.2024|k2|2|late"], 1)
    put(tmp_path / "MB" / "monthly", "b.csv", ["Date|KPI name|Value", "01.01.2024|k1|NaN"], 1)
    raw = feeds.read_period(spark, str(tmp_path), MONTHLY)
    assert rows(raw, "Region", "KPI name", "Value", "Remarks") == [
        ("MA", "k1", "1", None), ("MA", "k2", "2", "late"), ("MB", "k1", None, ""),
    ]


def test_read_period_export(spark, tmp_path, rows):
    folder = tmp_path / "MA" / "weekly"
    spark.createDataFrame(
        [("05-Jan-95", "k1", "3,5")], "Date string, `KPI name` string, Value string"
    ).write.parquet(str(folder))
    raw = feeds.read_period(spark, str(folder), WEEKLY, "parquet")
    assert rows(raw, "KPI name", "Value", "Remarks") == [("k1", "3,5", None)]


def test_read_dimension_headers(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text("EDWH KPI_ID|KPI name|[13] More is better|AT|AT.1\nK1|n|yes|x|\n")
    df = feeds.read_dimension(spark, str(path))
    assert df.columns == ["KPI_ID", "KPI_Name", "more", "AT", "AT_1"]
    assert df.collect() == [("K1", "n", "yes", "x", None)]


def test_ingest_in_two_runs_equals_one(spark, tmp_path, rows, registry, market_map):
    files = {
        "a.csv": ([daily_line("20240101", "k1", "1,5"), daily_line("20240201", "k1", "7")], 100),
        "b.csv": ([daily_line("20240101", "k1", "2,5"), daily_line("20240103", " K1 ", "5"), daily_line("2024", "k1", "5")], 200),
        "c.csv": ([daily_line("20240102", "", "", "C"), daily_line("20240101", "k1", "2,5"), daily_line("20240103", "k1", "6")], 300),
    }
    together, apart = Warehouse(spark, str(tmp_path / "w1")), Warehouse(spark, str(tmp_path / "w2"))
    for name, (lines, mtime) in files.items():
        put(tmp_path / "all" / "MA" / "daily", name, lines, mtime)
        put(tmp_path / ("first" if name == "a.csv" else "second") / "MA" / "daily", name, lines, mtime)
    jobs.run_inputs(together, registry, 1.0, daily=feeds.read_daily(spark, str(tmp_path / "all")))
    for name in ("first", "second"):
        jobs.run_inputs(apart, registry, 1.0, daily=feeds.read_daily(spark, str(tmp_path / name)))
    for grain in (DAILY, WEEKLY, MONTHLY):
        assert rows(together.state(grain)) == rows(apart.state(grain))
    assert rows(together.log()) == rows(apart.log())
    assert rows(together.state(DAILY), "Input_ID", "Value", "was_corrected_Flag") == [
        ("MA-K1-01.01.2024-d", 2.5, "Correction"), ("MA-K1-01.02.2024-d", 7.0, None), ("MA-K1-03.01.2024-d", 6.0, "Correction"),
    ]
    assert rows(together.state(WEEKLY), "Input_ID", "Value", "was_corrected_Flag") == [
        ("MA-KPI ONE-01.01.2024-w", 4.25, "Correction(s)"), ("MA-KPI ONE-29.01.2024-w", 7.0, ""),
    ]
    assert rows(together.log(), "Key_Corr", "KPIValueOld", "KPIValueNew", "CommentFileNew", "FileOld", "FileNew") == [
        ("MA-K1-01.01.2024-d", 1.5, 2.5, "null", "a.csv", "b.csv"),
        ("MA-K1-03.01.2024-d", 5.0, 6.0, "20240102000000", "b.csv", "c.csv"),
    ]
    quarantine = spark.read.parquet(str(tmp_path / "w1" / "quarantine"))
    assert rows(quarantine, "Input_File", "reason") == [("b.csv", "unreadable date")]


def test_a_run_reads_only_the_partitions_it_touches(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    for month in ("01", "02", "03"):
        put(tmp_path / month / "MA" / "daily", f"{month}.csv", [daily_line(f"2024{month}01", "k1", "1")], 10)
        jobs.run_ingest(warehouse, feeds.read_daily(spark, str(tmp_path / month)), DAILY, 1.0)
    parts = spark.createDataFrame([("MA", "202402")], "part_market string, part_month string")
    state = warehouse.state(DAILY, parts)
    assert [r.Date for r in state.collect()] == ["01.02.2024"]
    assert "dynamicpruning" in state._jdf.queryExecution().executedPlan().toString().lower()


def test_unpublished_run_is_not_read_and_holds_the_warehouse(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    put(tmp_path / "in" / "MA" / "daily", "a.csv", [daily_line("20240101", "k1", "1")], 10)
    jobs.run_ingest(warehouse, feeds.read_daily(spark, str(tmp_path / "in")), DAILY, 1.0)
    run = warehouse.begin("first")
    warehouse.stage(run, "daily", warehouse.state(DAILY).withColumn("Value", F.lit(9.0)))
    assert [r.Value for r in warehouse.state(DAILY).collect()] == [1.0]
    # An overlapping run fails when it claims; the same run id resumes the claim.
    with pytest.raises(RunConflict):
        warehouse.begin("second")
    assert warehouse.begin("first") == run
    warehouse.publish(run, ["daily"])
    assert [r.Value for r in warehouse.state(DAILY).collect()] == [9.0]
    assert warehouse.has_run("first") and not warehouse.has_run("second")
    # A run that died can be dropped by the next one.
    dead = warehouse.begin("dead")
    warehouse.stage(dead, "daily", warehouse.state(DAILY).withColumn("Value", F.lit(5.0)))
    taken = warehouse.begin("next", take_over=True)
    assert taken.number == dead.number + 1 and [r.Value for r in warehouse.state(DAILY).collect()] == [9.0]


def test_overlapping_runs_do_not_lose_rows(spark, tmp_path, rows):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    for name, day in (("a.csv", "20240101"), ("b.csv", "20240102")):
        put(tmp_path / name / "MA" / "daily", name, [daily_line(day, "k1", "1")], 10)
    first = feeds.read_daily(spark, str(tmp_path / "a.csv"))
    claim = warehouse.begin("other")
    with pytest.raises(RunConflict):
        jobs.run_ingest(warehouse, first, DAILY, 1.0)
    warehouse.publish(claim, [])
    jobs.run_ingest(warehouse, first, DAILY, 1.0)
    jobs.run_ingest(warehouse, feeds.read_daily(spark, str(tmp_path / "b.csv")), DAILY, 1.0)
    assert rows(warehouse.state(DAILY), "Date") == [("01.01.2024",), ("02.01.2024",)]


def test_only_the_last_two_runs_keep_staged_folders(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    for month in ("01", "02", "03", "04"):
        put(tmp_path / month / "MA" / "daily", f"{month}.csv", [daily_line(f"2024{month}01", "k1", "1")], 10)
        jobs.run_ingest(warehouse, feeds.read_daily(spark, str(tmp_path / month)), DAILY, 1.0)
    staged = sorted(p.name for p in (tmp_path / "w" / "_runs").iterdir() if p.is_dir())
    assert staged == ["000000000003", "000000000004"]
    assert warehouse.state(DAILY).count() == 4


def test_publishing(spark, tmp_path, rows, registry, market_map):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    put(tmp_path / "d" / "MA" / "daily", "a.csv", [daily_line("20240101", "k1", "1,5"), daily_line("20240102", "k1", "2")], 10)
    put(tmp_path / "w_in" / "MA" / "weekly", "w.csv", ["Date|Service|KPI name|Vendor|Region|Value|Unit|Remarks", "01.01.2024|s|kpi one|v|r|9|u|ok"], 10)
    put(tmp_path / "m" / "x" / "monthly", "m.csv", ["Date|KPI name|Region|Value|Remarks", "2024-01-01|kpi one|XA|4|", "2024-01-01|kpi one|ZZ|4|"], 20)
    put(tmp_path / "i" / "x" / "ims", "i.csv", ["Date|KPI name|Value|Region", "02.01.2024|kpi one|3|MA"], 10)
    jobs.run_inputs(
        warehouse, registry, 1.0,
        daily=feeds.read_daily(spark, str(tmp_path / "d")),
        weekly=feeds.read_period(spark, str(tmp_path / "w_in"), WEEKLY),
    )
    assert rows(warehouse.state(WEEKLY), "Value", "Input_File", "was_corrected_Flag") == [(9.0, "w.csv", "Correction")]
    jobs.run_multimarket(warehouse, feeds.read_multimarket(spark, str(tmp_path / "m")), market_map, 2.0, ["MA"])
    assert rows(warehouse.state(MONTHLY), "Input_ID", "Value", "was_corrected_Flag") == [("MA-KPI ONE-01.01.2024-m", 4.0, "Correction")]
    assert rows(spark.read.parquet(str(tmp_path / "w" / "quarantine")), "reason", "grain") == [("unknown country", "multimarket")]

    jobs.run_matrices(warehouse, registry, ["XA", "XA_1", "XA_2"], market_map, date(2024, 1, 1), date(2024, 2, 5))
    daily = spark.read.parquet(str(tmp_path / "w" / "matrix_daily"))
    assert daily.count() == 2 * 35 and daily.filter("IsDelivered = '1'").count() == 2

    for _ in range(2):
        jobs.run_ims(warehouse, feeds.read_ims(spark, str(tmp_path / "i")), only_new=True)
    jobs.run_facts(warehouse, registry)
    text = "".join(p.read_text() for p in (tmp_path / "w" / "facts").glob("*.csv"))
    assert '"02.01.2024"|"KPI ONE"|"3.0"|"MA"|"MAKPI ONE-02.01.2024-w"' in text
    assert '"01.01.2024"|"KPI ONE"|"9.0"|"MA"|"MA-KPI ONE-01.01.2024-w"' in text

    mapping = spark.createDataFrame([("k1", "5", "T", "x")], "KPI_ID string, Threshold string, Threshold_flag string, XA string")
    jobs.run_report(warehouse, registry, mapping, ["XA"], date(2024, 2, 5), excluded=["ZZ"])
    text = "".join(p.read_text() for p in (tmp_path / "w" / "reports").glob("market=XA/*.csv"))
    assert "XA|SLA Breach|kpi one|4.0|NaN|NaN|u|5" in text


def test_stream_takes_each_file_once(spark, tmp_path, rows, registry):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    source, checkpoint = tmp_path / "in", str(tmp_path / "checkpoint")

    def run():
        stream = read_daily_stream(spark, str(source))
        assert ingest_stream(stream, warehouse, checkpoint, 1.0, registry).awaitTermination(120)

    put(source / "MA" / "daily", "a.csv", [daily_line("20240101", "k1", "1")], 10)
    run()
    put(source / "MA" / "daily", "b.csv", [daily_line("20240101", "k1", "3"), daily_line("20240102", "k1", "5")], 20)
    run()
    run()
    assert rows(warehouse.state(DAILY), "Input_ID", "Value", "was_corrected_Flag") == [
        ("MA-K1-01.01.2024-d", 3.0, "Correction"), ("MA-K1-02.01.2024-d", 5.0, None),
    ]
    assert warehouse.log().count() == 1
    assert rows(warehouse.state(WEEKLY), "Value") == [(4.0,)]
