"""Source -> operator -> sink. The only places that write, beside the stream."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, functions as F

from kpiweave import schemas
from kpiweave.functions import dates
from kpiweave.operators import matrix, normalize, registry as reg, report, rollup
from kpiweave.operators.facts import facts
from kpiweave.operators.fold import fold
from kpiweave.operators.grain import DAILY, MONTHLY, WEEKLY, Grain
from kpiweave.operators.upsert import replace_by_key
from kpiweave.sinks import files
from kpiweave.sources.staging import staged
from kpiweave.sources.tables import LOG, QUARANTINE, Warehouse, partitions_of, read_or_empty


def normalized(raw: DataFrame, grain: Grain) -> DataFrame:
    if grain is not DAILY:
        return normalize.normalize_period(raw, grain)
    return normalize.with_file_comment(normalize.normalize_daily(raw), normalize.file_comments(raw))


def quarantined(raw: DataFrame, grain: Grain) -> DataFrame:
    return normalize.quarantine_daily(raw) if grain is DAILY else normalize.quarantine_period(raw, grain)


def run_ingest(
    warehouse: Warehouse,
    raw: DataFrame,
    grain: Grain,
    run_ts: float,
    run_id: str | None = None,
    multimarket: bool = False,
    regions: Sequence[str] | None = None,
) -> DataFrame:
    """All pending deliveries of a grain, of all markets, into the warehouse. Returns the rows taken in.

    ``regions`` restricts what the state may hold (K4), not what is logged.
    """
    run = warehouse.begin(run_id)
    rows = staged(normalized(raw, grain), grain.name)
    parts = partitions_of(rows)
    log = warehouse.log(parts)
    result = fold(rows, warehouse.state(grain, parts), log, grain, run_ts, multimarket=multimarket)
    output = result.output
    if regions is not None:
        output = output.filter(F.col("Region").isin(list(regions)))
    warehouse.stage(run, grain.name, output)
    warehouse.stage_log(run, result.new_corrections)
    rejected = quarantined(raw, grain).select("Input_File", "Input_File_Time", "Value", "reason")
    warehouse.stage_quarantine(run, rejected.withColumn("grain", F.lit(grain.name)))
    warehouse.publish(run, [grain.name, LOG, QUARANTINE])
    return rows


def run_averages(
    warehouse: Warehouse, registry: DataFrame, grain: Grain, changed: DataFrame | None = None
) -> None:
    """C5 / C6 with both results (K3). With ``changed`` daily rows only their periods are recomputed."""
    daily, table = warehouse.state(DAILY), f"{grain.name}_averages"
    if changed is not None:
        start = dates.week_start if grain is WEEKLY else dates.month_start
        periods = changed.select("Region", start(F.col("Date")).alias("_start")).distinct()
        last = F.date_add("_start", 6) if grain is WEEKLY else F.col("_start")
        ends = periods.select("Region", F.explode(F.array("_start", last)).alias("_day"))
        parts = partitions_of(ends.withColumn("Date", dates.business_text(F.col("_day"))))
        daily = (
            warehouse.state(DAILY, parts)
            .withColumn("_start", start(F.col("Date")))
            .join(periods, ["Region", "_start"], "left_semi")
            .drop("_start")
        )
    run = warehouse.begin()
    calculated = staged(rollup.averages(daily, registry, grain), table)
    parts = partitions_of(calculated)
    before = warehouse.read(table, schemas.PERIOD_OUTPUT_SCHEMA, parts)
    merged = rollup.merge_averages(calculated, warehouse.state(grain, parts))
    warehouse.stage(run, table, replace_by_key(before, calculated))
    warehouse.stage(run, grain.name, merged)
    warehouse.publish(run, [table, grain.name])


def run_inputs(
    warehouse: Warehouse,
    registry: DataFrame,
    run_ts: float,
    daily: DataFrame | None = None,
    weekly: DataFrame | None = None,
    monthly: DataFrame | None = None,
) -> None:
    """Daily first, means from it, then what was delivered by week and month and so replaces means."""
    if daily is not None:
        rows = run_ingest(warehouse, daily, DAILY, run_ts)
        for grain in (WEEKLY, MONTHLY):
            run_averages(warehouse, registry, grain, changed=rows)
    if weekly is not None:
        run_ingest(warehouse, weekly, WEEKLY, run_ts)
    if monthly is not None:
        run_ingest(warehouse, monthly, MONTHLY, run_ts)


def run_multimarket(
    warehouse: Warehouse, raw: DataFrame, market_map: DataFrame, run_ts: float, regions: Sequence[str]
) -> None:
    """C4. All files are folded in order of arrival."""
    unknown = normalize.unknown_markets(raw, market_map)
    run = warehouse.begin()
    warehouse.stage_quarantine(
        run, unknown.select("Input_File", "Input_File_Time", "Value", "reason").withColumn("grain", F.lit("multimarket"))
    )
    warehouse.publish(run, [QUARANTINE])
    resolved = normalize.resolve_market(raw, market_map)
    run_ingest(warehouse, resolved, MONTHLY, run_ts, multimarket=True, regions=regions)


def run_matrices(
    warehouse: Warehouse,
    registry: DataFrame,
    grid: Sequence[str],
    market_map: DataFrame,
    start: date,
    as_of: date,
    markets: Sequence[str] | None = None,
) -> None:
    """C7 for all markets (or those given, F9), one folder per country code (K2)."""
    flags = reg.request_flags(registry, grid)
    unknown = normalize.unknown_markets(flags, market_map, "Natco").select("Natco", "reason").distinct()
    unknown.write.mode("overwrite").parquet(f"{warehouse.root}/unknown_grid_codes")
    if markets is not None:
        market_map = market_map.filter(F.col("market").isin(list(markets)))
    for grain in (DAILY, WEEKLY, MONTHLY):
        built = matrix.matrix(flags, market_map, warehouse.state(grain), start, as_of, grain)
        files.write_partitioned(built, f"{warehouse.root}/matrix_{grain.name}", "Natco")


def run_ims(warehouse: Warehouse, raw: DataFrame, only_new: bool = False) -> None:
    """C9, appended (K5); rows with an unreadable date go to ``quarantine_ims``. ``only_new`` leaves out rows whose id is already there."""
    rows, path = normalize.normalize_ims(raw), f"{warehouse.root}/ims_facts"
    rejected = normalize.quarantine_ims(raw).select("Date", "KPI name", "Value", "Region", "reason")
    files.append(rejected, f"{warehouse.root}/quarantine_ims")
    if only_new:
        known = read_or_empty(warehouse.spark, path, schemas.IMS_FACTS_SCHEMA)
        rows = staged(rows.join(known.select("Input_ID"), "Input_ID", "left_anti"), "ims")
    files.append(rows.select(*schemas.IMS_FACTS_SCHEMA.names), path)


def run_facts(warehouse: Warehouse, registry: DataFrame) -> None:
    """C8, every field quoted (K6)."""
    ims = read_or_empty(warehouse.spark, f"{warehouse.root}/ims_facts", schemas.IMS_FACTS_SCHEMA)
    built = facts(warehouse.state(WEEKLY), ims, registry)
    files.write_delimited(built, f"{warehouse.root}/facts", quote_all=True)


def run_report(
    warehouse: Warehouse,
    registry: DataFrame,
    mapping: DataFrame,
    countries: Sequence[str],
    as_of: date,
    excluded: Sequence[str] = (),
) -> None:
    """C10 from the stored monthly matrix, one folder per country (K7); ``excluded`` is F20."""
    stored = warehouse.spark.read.parquet(f"{warehouse.root}/matrix_monthly").drop("part_Natco")
    wanted = stored.filter(~F.col("Natco").isin(list(excluded))) if excluded else stored
    built = report.status_report(wanted, registry, mapping, countries, as_of)
    files.write_delimited(
        built.withColumn("market", F.col("Natco")),
        f"{warehouse.root}/reports",
        null_value="NaN",
        partition_by=["market"],
    )
