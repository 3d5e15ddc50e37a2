"""All pending deliveries against the state in one pass.

Deliveries of a key are compared pairwise in delivery order, so the result equals ingesting them one
after the other. The order is worked out on rows pre-aggregated to (key, delivery); delivered rows
themselves are never put into a window, so a key that holds a large share of them stays splittable:
they take part in one join per result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from kpiweave.functions.text import or_text
from kpiweave.operators import corrections as corr
from kpiweave.operators.grain import DAILY, Grain
from kpiweave.operators.upsert import Ingested, without_keys


def _of_keys(aggregated: DataFrame, ids: DataFrame) -> DataFrame:
    """Restrict state aggregates to the delivered keys. Written after the aggregation, so that a hot key
    is combined before it is shuffled; Catalyst moves the semi join below it where ``ids`` is small
    enough to broadcast."""
    return aggregated.join(ids, "Input_ID", "left_semi")


def _steps(rows: DataFrame, state: DataFrame, ids: DataFrame, grain: Grain, compat: bool) -> DataFrame:
    """One row per key and delivery; the state is the step before the first delivery."""
    value = F.col("Value")
    measures = [
        corr.largest(value, compat).alias("_largest"),
        F.min(value).alias("_smallest"),
        F.max(value.isNull()).alias("_has_null"),
    ]
    comment = F.max(F.col("CommentFileNew") if grain is DAILY else F.lit(None).cast("string"))
    delivered = (
        rows.groupBy("Input_ID", "delivery")
        .agg(*measures, comment.alias("_comment"))
        .withColumn("_from_delivery", F.lit(True))
    )
    before = _of_keys(state.groupBy("Input_ID").agg(*measures), ids).withColumn("_from_delivery", F.lit(False))
    return delivered.unionByName(before, allowMissingColumns=True)


def _history(steps: DataFrame, log: DataFrame, grain: Grain, compat: bool) -> DataFrame:
    """Per key and delivery the value it replaces, where that came from, and whether it is the last."""
    by_key = Window.partitionBy("Input_ID").orderBy("_from_delivery", "delivery")
    old = F.col("KPIValueOld")
    history = steps.select(
        "*",
        F.lag("_largest").over(by_key).alias("KPIValueOld"),
        F.lag("_from_delivery").over(by_key).alias("_before_from_delivery"),
        F.lag("delivery").over(by_key).alias("_before_delivery"),
        F.lead("_from_delivery").over(by_key).isNull().alias("_is_last"),
    )
    if compat:
        changed = old.isNotNull() | F.col("_has_null")
    else:
        same = F.col("_largest").eqNullSafe(old) & F.col("_smallest").eqNullSafe(old) & ~F.col("_has_null")
        changed = old.isNotNull() & ~same
    history = history.withColumn("_value_changed", changed)
    if grain is DAILY:  # W3
        logged = F.when(F.col("_value_changed"), or_text(F.col("_comment"), ""))
        so_far = F.max(logged).over(by_key.rowsBetween(Window.unboundedPreceding, -1))
        history = (
            history.withColumn("_comment_so_far", so_far)
            .join(corr.comment_map(log), "Input_ID", "left")
            .withColumn("CommentFileOld", F.greatest("CommentFileOld", "_comment_so_far"))
        )
    return history.filter(F.col("_from_delivery"))


def _variants(rows: DataFrame, state: DataFrame, ids: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct attribute values per step, to be read by the step that follows."""
    before, values = F.col("delivery").alias("_before_delivery"), [F.col(c).alias(corr.OLD_COLUMNS[c]) for c in columns]
    delivered = rows.select("Input_ID", before, F.lit(True).alias("_before_from_delivery"), *values).distinct()
    stored = _of_keys(state.select("Input_ID", *values).distinct(), ids)
    stored = stored.withColumn("_before_from_delivery", F.lit(False))
    return delivered.unionByName(stored, allowMissingColumns=True)


def _with_variants(history: DataFrame, variants: DataFrame) -> DataFrame:
    h, v = history.alias("h"), variants.alias("v")
    same_step = (
        (F.col("h.Input_ID") == F.col("v.Input_ID"))
        & (F.col("h._before_from_delivery") == F.col("v._before_from_delivery"))
        & F.col("h._before_delivery").eqNullSafe(F.col("v._before_delivery"))
    )
    added = [c for c in variants.columns if c not in history.columns]
    return h.join(v, same_step, "left").select("h.*", *[f"v.{c}" for c in added])


def fold(
    rows: DataFrame,
    state: DataFrame,
    log: DataFrame,
    grain: Grain,
    run_ts: float,
    compat: bool = False,
    multimarket: bool = False,
) -> Ingested:
    """``rows``: normalised rows of any number of deliveries, ordered by ``delivery``."""
    ids = rows.select("Input_ID").distinct()
    history = _history(_steps(rows, state, ids, grain, compat), log, grain, compat)

    needed = history if compat else history.filter(F.col("KPIValueOld").isNotNull())
    old = needed
    for columns in corr.old_columns(grain, compat):
        old = _with_variants(old, _variants(rows, state, ids, columns))
    carried = ["KPIValueOld", "FileOld", "CommentRowOld" if grain.has_remarks else "CommentFileOld"]
    compared = rows.join(old.select("Input_ID", "delivery", *carried), ["Input_ID", "delivery"])
    new = corr.to_log(compared.filter(corr.is_correction(grain, compat, multimarket)), grain, run_ts)

    corrected = corr.logged_keys(log, grain, compat, multimarket)
    if corr.flag_granularity(grain, compat, multimarket) == grain.code:
        corrected = corrected.unionByName(_corrected_keys(rows, history, old, grain, compat, multimarket))
    last = history.filter(F.col("_is_last")).select("Input_ID", "delivery")
    last = corr.flag_corrected(last, corrected)
    output = rows.join(last, ["Input_ID", "delivery"]).select(*grain.output)  # W2
    output = output.unionByName(without_keys(state, ids).select(*grain.output))
    return Ingested(output, new, log.unionByName(new))


def _corrected_keys(
    rows: DataFrame, history: DataFrame, old: DataFrame, grain: Grain, compat: bool, multimarket: bool
) -> DataFrame:
    """Keys that log at least one correction, found without touching single rows."""
    keys = history.filter(F.col("_value_changed")).select("Input_ID")
    if grain.has_remarks:
        remarks = rows.select("Input_ID", "delivery", "Remarks").distinct()
        pairs = old.select("Input_ID", "delivery", "KPIValueOld", "CommentRowOld").distinct()
        differs = corr.remark_differs(
            F.col("Remarks"), F.col("CommentRowOld"), F.col("KPIValueOld"), not (compat and multimarket)
        )
        keys = keys.unionByName(
            remarks.join(pairs, ["Input_ID", "delivery"]).filter(differs).select("Input_ID")
        )
    return keys.distinct()
