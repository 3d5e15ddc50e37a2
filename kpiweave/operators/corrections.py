"""What changed against the state.

``compat=True`` repeats the literal comparison rules: every re-delivered key counts as changed and
the old value is the lexicographically largest text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from kpiweave import schemas
from kpiweave.functions.text import contains_text, or_text
from kpiweave.operators.grain import DAILY, MONTHLY, WEEKLY, Grain


def largest(value: Column, compat: bool = False) -> Column:
    return F.max_by(value, value.cast("string")) if compat else F.max(value)


def value_map(state: DataFrame, compat: bool = False) -> DataFrame:
    """One old value per key."""
    return (
        state.filter(F.col("Input_ID").isNotNull())
        .groupBy("Input_ID")
        .agg(largest(F.col("Value"), compat).alias("KPIValueOld"))
    )


OLD_COLUMNS = {"Input_File": "FileOld", "Remarks": "CommentRowOld"}


def old_columns(grain: Grain, compat: bool = False) -> list[list[str]]:
    """Attributes of an old row that go into the log: together, as they were delivered. In ``compat`` each
    by itself, so that a key gets every combination of its files and remarks."""
    columns = ["Input_File", "Remarks"] if grain.has_remarks else ["Input_File"]
    return [[c] for c in columns] if compat else [columns]


def distinct_values(state: DataFrame, columns: list[str]) -> DataFrame:
    """Every distinct (key, attributes) tuple; several per key stay several."""
    renamed = [F.col(c).alias(OLD_COLUMNS[c]) for c in columns]
    return state.filter(F.col("Input_ID").isNotNull()).select("Input_ID", *renamed).distinct()


def comment_map(log: DataFrame) -> DataFrame:
    """A2: the largest file comment logged per key, missing ones as empty text."""
    return log.groupBy(F.col("Key_Corr").alias("Input_ID")).agg(
        F.max(or_text(F.col("CommentFileNew"), "")).alias("CommentFileOld")
    )


def old_values(state: DataFrame, grain: Grain, compat: bool = False) -> DataFrame:
    """J1-J3 prepared on the key: old value with its file (and remark) variants, one join away
    from the delivery, so that rows of a hot key are shuffled once."""
    old = value_map(state, compat)
    if not compat:
        old = old.filter(F.col("KPIValueOld").isNotNull())
    for columns in old_columns(grain, compat):
        old = old.join(distinct_values(state, columns), "Input_ID", "left")
    return old


def value_differs(new: Column, old: Column, compat: bool = False) -> Column:
    """F18. ``old`` is the previous value or null for a new key."""
    if compat:
        return old.isNotNull() | new.isNull()
    return old.isNotNull() & ~new.eqNullSafe(old)


def remark_differs(new: Column, old: Column, old_value: Column, own_when_new: bool = True) -> Column:
    """The new remark is not part of the old one; a new key is compared with itself."""
    compare = F.when(old_value.isNull(), new).otherwise(old) if own_when_new else old
    return ~contains_text(compare, new)


def is_correction(grain: Grain, compat: bool = False, multimarket: bool = False) -> Column:
    """Row predicate over delivery rows that carry KPIValueOld (and CommentRowOld)."""
    differs = value_differs(F.col("Value"), F.col("KPIValueOld"), compat)
    if grain.has_remarks:
        own_when_new = not (compat and multimarket)
        differs = differs | remark_differs(
            F.col("Remarks"), F.col("CommentRowOld"), F.col("KPIValueOld"), own_when_new
        )
    return differs


def to_log(rows: DataFrame, grain: Grain, run_ts: float) -> DataFrame:
    """Correction rows in the log layout."""
    text = F.lit(None).cast("string")
    remark = grain.has_remarks
    columns = {
        "Key_Corr": F.col("Input_ID"),
        "DatumKPI": F.col("Date"),
        "KPINameQVD": F.col(f"`{grain.kpi}`"),
        "Natco": F.col("Region"),
        "KPIValueOld": F.col("KPIValueOld"),
        "KPIValueNew": F.col("Value"),
        "CommentRowOld": F.col("CommentRowOld") if remark else text,
        "CommentRowNew": F.col("Remarks") if remark else text,
        "CommentFileOld": text if remark else F.col("CommentFileOld"),
        "CommentFileNew": text if remark else F.col("CommentFileNew"),
        "TimestampCorrFile": F.col("Input_File_Time"),
        "Granularity": F.lit(grain.code),
        "FileOld": F.col("FileOld"),
        "FileNew": F.col("Input_File"),
        "correction_timestamp": F.lit(float(run_ts)),
    }
    return rows.select([columns[c].alias(c) for c in schemas.CORRECTIONS])


def find_corrections(
    rows: DataFrame,
    state: DataFrame,
    log: DataFrame,
    grain: Grain,
    run_ts: float,
    compat: bool = False,
    multimarket: bool = False,
) -> DataFrame:
    """New log rows of one delivery against the state before it."""
    old = old_values(state, grain, compat)
    if grain is DAILY:
        old = old.join(comment_map(log), "Input_ID", "left")
    enriched = rows.join(old, "Input_ID", "left" if compat else "inner")
    return to_log(enriched.filter(is_correction(grain, compat, multimarket)), grain, run_ts)


def flag_granularity(grain: Grain, compat: bool = False, multimarket: bool = False) -> str:
    """The log rows a flag looks at; the literal monthly input looks at the weekly ones."""
    return WEEKLY.code if compat and grain is MONTHLY and not multimarket else grain.code


def logged_keys(log: DataFrame, grain: Grain, compat: bool = False, multimarket: bool = False) -> DataFrame:
    """keys of one granularity."""
    code = flag_granularity(grain, compat, multimarket)
    rows = log if grain is DAILY else log.filter(F.col("Granularity") == code)
    return rows.select(F.col("Key_Corr").alias("Input_ID"))


def flag_corrected(rows: DataFrame, corrected: DataFrame) -> DataFrame:
    """``Correction`` on every row whose key is among ``corrected`` (column Input_ID)."""
    keys = corrected.filter(F.col("Input_ID").isNotNull()).distinct()
    keys = keys.withColumn("was_corrected_Flag", F.lit("Correction"))
    return rows.join(keys, "Input_ID", "left")
