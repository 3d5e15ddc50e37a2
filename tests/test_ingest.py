"""Corrections, upsert and fold on tiny frames; one case per rule that is easy to get wrong."""

import random

import pytest
from pyspark.sql import functions as F

from kpiweave import schemas
from kpiweave.operators import corrections, normalize, upsert
from kpiweave.operators.fold import fold
from kpiweave.operators.grain import DAILY, MONTHLY, WEEKLY

PERIOD = "Input_ID string, Date string, `KPI name` string, Region string, Value double, Remarks string, Input_File string"


def period_rows(spark, items, delivery=1):
    """items: (id, value, remark[, delivery])."""
    rows = [
        (k, "01.01.2024", "K", "M", v, r, f"f{(d or [delivery])[0]}", "t", (d or [delivery])[0]) for k, v, r, *d in items
    ]
    return spark.createDataFrame(rows, PERIOD + ", Input_File_Time string, delivery int")


def period_state(spark, items):
    rows = [(k, "01.01.2024", "K", "M", v, r, f, flag) for k, v, r, f, flag in items]
    return spark.createDataFrame(rows, PERIOD + ", was_corrected_Flag string")


def daily_rows(spark, items):
    """items: (id, value, delivery, comment)."""
    rows = [(k, "01.01.2024", "t", "M", "S", "K", "1", "2", v, f"f{d}", "t", d, c) for k, v, d, c in items]
    layout = ", ".join(f"{c} {'double' if c == 'Value' else 'string'}" for c in schemas.DAILY_OUTPUT[:-1])
    return spark.createDataFrame(rows, layout + ", Input_File_Time string, delivery int, CommentFileNew string")


def empty_log(spark):
    return spark.createDataFrame([], schemas.CORRECTIONS_SCHEMA)


def pairs(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_unchanged_value_is_no_correction_unless_compat(spark):
    state = period_state(spark, [("a", 1.0, None, "f0", None), ("b", 1.0, None, "f0", None)])
    new = period_rows(spark, [("a", 1.0, None), ("b", 2.0, None), ("c", 3.0, None)])
    log = upsert.ingest(new, state, empty_log(spark), WEEKLY, 1.0).new_corrections
    assert pairs(log, "Key_Corr", "KPIValueOld", "KPIValueNew", "FileOld", "FileNew") == [("b", 1.0, 2.0, "f0", "f1")]
    literal = upsert.ingest(new, state, empty_log(spark), WEEKLY, 1.0, compat=True).new_corrections
    assert pairs(literal, "Key_Corr") == [("a",), ("b",)]


def test_old_value_is_the_largest(spark):
    state = period_state(spark, [("a", 9.5, None, "f0", None), ("a", 10.0, None, "f0", None), (None, 99.0, None, "f0", None)])
    assert pairs(corrections.value_map(state), "Input_ID", "KPIValueOld") == [("a", 10.0)]
    assert pairs(corrections.value_map(state, compat=True), "Input_ID", "KPIValueOld") == [("a", 9.5)]


def test_remarks_are_compared_by_containment(spark):
    state = period_state(spark, [(k, 1.0, r, "f0", None) for k, r in
                                 (("a", "late delivery"), ("b", "late"), ("c", None), ("d", "ok"), ("e", "banana"))])
    new = period_rows(spark, [("a", 1.0, "late"), ("b", 1.0, "late delivery"), ("c", 1.0, None), ("d", 1.0, None), ("e", 1.0, None), ("f", 1.0, "new")])
    log = upsert.ingest(new, state, empty_log(spark), WEEKLY, 1.0).new_corrections
    # a missing remark reads "nan", which "banana" contains
    assert pairs(log, "Key_Corr", "CommentRowOld", "CommentRowNew") == [("b", "late", "late delivery"), ("d", "ok", None)]


def test_multimarket_literal_remark_rule(spark):
    state = period_state(spark, [("a", 1.0, "x", "f0", None)])
    new = period_rows(spark, [("b", 1.0, "remark"), ("c", 1.0, None)])
    run = lambda compat: upsert.ingest(new, state, empty_log(spark), MONTHLY, 1.0, compat, multimarket=True).new_corrections
    assert pairs(run(False), "Key_Corr") == []
    assert pairs(run(True), "Key_Corr") == [("b",)]


@pytest.mark.parametrize("compat,combinations", [(False, ["f0 x", "f00 y"]), (True, ["f0 x", "f0 y", "f00 x", "f00 y"])])
def test_old_attributes_fan_out(spark, compat, combinations):
    state = period_state(spark, [("a", 1.0, "x", "f0", None), ("a", 2.0, "y", "f00", None)])
    expected = [(2.0, *c.split()) for c in combinations]
    rows = period_rows(spark, [("a", 3.0, "z")])
    for ingest in (upsert.ingest, fold):
        log = ingest(rows, state, empty_log(spark), WEEKLY, 1.0, compat).new_corrections
        assert pairs(log, "KPIValueOld", "FileOld", "CommentRowOld") == expected


@pytest.mark.parametrize("compat,flag", [(False, "Correction"), (True, None)])
def test_monthly_flag(spark, compat, flag):
    state = period_state(spark, [("a", 1.0, None, "f0", None), (None, 7.0, None, "f0", None), ("z", 1.0, None, "f0", "Correction")])
    done = upsert.ingest(period_rows(spark, [("a", 2.0, None), ("a", 2.0, None)]), state, empty_log(spark), MONTHLY, 1.0, compat)
    assert pairs(done.output, "Input_ID", "Value", "was_corrected_Flag") == sorted(
        [("a", 2.0, flag), ("a", 2.0, flag), (None, 7.0, None), ("z", 1.0, "Correction")], key=str
    )


def test_daily_comments(spark):
    rows = daily_rows(spark, [("a", 1.0, 1, "c1"), ("a", 1.0, 2, "c2"), ("a", 2.0, 3, "c3"), ("a", 3.0, 4, "c0"), ("a", 4.0, 5, "c5")])
    state = spark.createDataFrame([], schemas.DAILY_OUTPUT_SCHEMA)
    log = fold(rows, state, empty_log(spark), DAILY, 1.0).new_corrections
    # the comment alone (delivery 2) is no correction; the largest logged so far is the old one
    assert pairs(log, "KPIValueOld", "KPIValueNew", "CommentFileOld", "CommentFileNew") == [
        (1.0, 2.0, None, "c3"), (2.0, 3.0, "c3", "c0"), (3.0, 4.0, "c3", "c5"),
    ]


def test_file_comment(spark):
    raw = spark.createDataFrame(
        [("C", "x", 2, "f"), ("C", "first", 1, "f"), ("L", "l", 0, "f"), ("L", "l", 0, "g")],
        "Marker string, DatumKPI string, row_no int, Input_File string",
    )
    comments = normalize.file_comments(raw)
    assert pairs(comments, "Input_File", "CommentFileNew") == [("f", "first")]
    files = raw.select("Input_File").distinct()
    assert pairs(normalize.with_file_comment(files, comments), "Input_File", "CommentFileNew") == [("f", "first"), ("g", "null")]


def test_quarantine_and_unknown_country(spark):
    raw = spark.createDataFrame(
        [("01.01.2024", " k ", "1,0", "XA"), ("1.1.2024", "k", "1", "XA"), ("01.01.2024", None, "1", "XA"), ("01.01.2024", "k", "n/a", "XA"), ("01.01.2024", "k", "1", "ZZ")],
        "Date string, `KPI name` string, Value string, Region string",
    )
    assert pairs(normalize.normalize_period(raw, MONTHLY), "Input_ID", "Remarks") == [("XA-K-01.01.2024-m", ""), ("ZZ-K-01.01.2024-m", "")]
    assert pairs(normalize.quarantine_period(raw, MONTHLY), "Date", "reason") == [("1.1.2024", "unreadable date")]
    market_map = spark.createDataFrame([("XA", "MA")], "code string, market string")
    assert normalize.resolve_market(raw, market_map).select("Region").distinct().collect() == [("MA",)]
    assert normalize.unknown_markets(raw, market_map).count() == 1
    with pytest.raises(Exception, match="unknown country ZZ"):
        normalize.resolve_market(raw, market_map, compat=True).collect()


@pytest.mark.parametrize("grain,compat,multimarket", [(DAILY, False, False), (WEEKLY, False, False), (MONTHLY, True, True)])
def test_fold_equals_one_delivery_after_the_other(spark, grain, compat, multimarket):
    rnd = random.Random(7)
    keys, remarks = [f"k{i}" for i in range(12)], [None, "late", "late delivery", "ok", ""]
    values = [1.0, 2.0, 9.5, 10.0, None]
    if grain is DAILY:
        comments = {1: "c2", 2: "c9", 3: "c1"}
        items = [(rnd.choice(keys), rnd.choice(values), d, comments[d]) for d in (1, 2, 3) for _ in range(14)]
        rows, state = daily_rows(spark, items), daily_rows(spark, [(k, 1.0, 0, None) for k in keys[:6]])
        state = state.withColumn("was_corrected_Flag", F.lit(None).cast("string")).select(*schemas.DAILY_OUTPUT)
    else:
        items = [(rnd.choice(keys), rnd.choice(values), rnd.choice(remarks), d) for d in (1, 2, 3) for _ in range(14)]
        rows = period_rows(spark, items)
        seed = [(rnd.choice(keys[:6]), 1.0, rnd.choice(remarks), rnd.choice(["f0", "f00"]), None) for _ in range(9)]
        state = period_state(spark, seed)
    log = empty_log(spark)
    once = fold(rows, state, log, grain, 1.0, compat, multimarket)
    for d in (1, 2, 3):
        step = upsert.ingest(rows.filter(F.col("delivery") == d), state, log, grain, 1.0, compat, multimarket)
        cut = lambda df: spark.createDataFrame(df.collect(), df.schema)
        state, log = cut(step.output), cut(step.corrections)
    assert pairs(once.output, *[f"`{c}`" for c in grain.output]) == pairs(state, *[f"`{c}`" for c in grain.output])
    assert pairs(once.corrections, *schemas.CORRECTIONS) == pairs(log, *schemas.CORRECTIONS)


def test_delivering_the_same_again_changes_nothing(spark):
    rows = period_rows(spark, [("a", 1.0, "x", 1), ("b", 2.0, None, 1), ("a", 1.0, "x", 2), ("b", 2.0, None, 2)])
    state = spark.createDataFrame([], schemas.PERIOD_OUTPUT_SCHEMA)
    done = fold(rows, state, empty_log(spark), WEEKLY, 1.0)
    assert done.new_corrections.isEmpty()
    assert pairs(done.output, "Input_ID", "Value", "Input_File", "was_corrected_Flag") == [("a", 1.0, "f2", None), ("b", 2.0, "f2", None)]


def test_rows_of_a_hot_key_are_split(spark):
    """One key holds most rows: the join that takes its rows runs in several tasks."""
    hot = spark.range(40_000).select(
        F.when(F.col("id") % 10 == 0, F.concat(F.lit("k"), F.col("id"))).otherwise("hot").alias("Input_ID"),
        F.lit("01.01.2024").alias("Date"), F.lit("K").alias("KPI name"), F.lit("M").alias("Region"),
        F.col("id").cast("double").alias("Value"), F.lit("r").alias("Remarks"),
        F.concat(F.lit("f"), F.col("id") % 2).alias("Input_File"), F.lit("t").alias("Input_File_Time"),
        (F.col("id") % 2).cast("int").alias("delivery"),
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        state = spark.createDataFrame([], schemas.PERIOD_OUTPUT_SCHEMA)
        output = fold(hot, state, empty_log(spark), WEEKLY, 1.0).output
        assert len(output.collect()) == 20_000 + 4_000
        assert "skew=true" in output._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
