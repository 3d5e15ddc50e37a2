"""Replacement by key, and one delivery end to end."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from kpiweave.operators import corrections as corr
from kpiweave.operators.grain import Grain


@dataclass(frozen=True)
class Ingested:
    output: DataFrame  # state after the delivery
    new_corrections: DataFrame  # log rows of this delivery only
    corrections: DataFrame  # U1: the log with them appended


def without_keys(state: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose Input_ID is not delivered again; a null id always stays."""
    return state.join(keys.select("Input_ID"), "Input_ID", "left_anti")


def replace_by_key(state: DataFrame, rows: DataFrame) -> DataFrame:
    """Delivered rows plus the surviving state."""
    return rows.unionByName(without_keys(state, rows).select(*rows.columns))


def ingest(
    rows: DataFrame,
    state: DataFrame,
    log: DataFrame,
    grain: Grain,
    run_ts: float,
    compat: bool = False,
    multimarket: bool = False,
) -> Ingested:
    """Normalised rows of one delivery against state and log. Daily rows carry ``CommentFileNew``."""
    new = corr.find_corrections(rows, state, log, grain, run_ts, compat, multimarket)
    logged = corr.logged_keys(log, grain, compat, multimarket)
    # In the literal monthly rule the rows just logged are of the wrong granularity, too.
    corrected = logged.unionByName(corr.logged_keys(new, grain, compat, multimarket))
    flagged = corr.flag_corrected(rows, corrected).select(*grain.output)
    return Ingested(replace_by_key(state, flagged), new, log.unionByName(new))
