"""Registered queries: every operator over the whole derived feeds.

State for the single-delivery queries holds the first two deliveries side by side (so keys repeat with
several files, values and remarks); the third is the one ingested. The fold queries start from nothing
and take all three; the stored ones fold the third, as two, onto the state and log that the first two leave. Means are rounded here, for comparison between engines, never in an operator.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from kpiweave import schemas
from kpiweave.functions import dates, keys, text
from kpiweave.operators import calendar, corrections, deliveries, facts, matrix, normalize, registry
from kpiweave.operators import report, rollup, upsert
from kpiweave.operators.fold import fold
from kpiweave.operators.grain import DAILY, MONTHLY, WEEKLY, Grain
from kpiweave.plans import views
from kpiweave.session import prepare
from kpiweave.sources.staging import staged

DAILY_START, DAILY_AS_OF = date(2024, 1, 1), date(2024, 2, 5)
PERIOD_START, PERIOD_AS_OF = date(1994, 12, 26), date(2001, 8, 15)
RUN_TS = 0.0
FILE_TYPES = ("click", "view", "purchase")


def rounded(value: Column) -> Column:
    return F.round(value + F.lit(0.0000001), 4)


class Feeds:
    """The derived feeds of one data folder, with provenance columns. As in the jobs, normalised
    deliveries are staged: they are parsed once and then read by every step that needs them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = prepare(spark), sf_dir

    def view(self, name: str) -> DataFrame:
        return views.view(self.spark, self.sf_dir, name)

    @staticmethod
    def _sourced(raw: DataFrame) -> DataFrame:
        return raw.withColumnsRenamed(
            {"file_name": "Input_File", "delivery_seq": "delivery", "kpi_name": "KPI name"}
        ).withColumn(
            "Input_File_Time", F.concat(F.lit("2024-02-0"), F.col("delivery").cast("string"), F.lit("-07:05:00"))
        )

    @cached_property
    def daily_raw(self) -> DataFrame:
        return self._sourced(self.view("fx_daily_raw"))

    @cached_property
    def weekly_raw(self) -> DataFrame:
        return self._sourced(self.view("fx_weekly_raw"))

    @cached_property
    def monthly_raw(self) -> DataFrame:
        return self._sourced(self.view("fx_monthly_raw"))

    @cached_property
    def ims_raw(self) -> DataFrame:
        return self.view("fx_ims_raw").withColumnRenamed("kpi_name", "KPI name")

    @cached_property
    def registry(self) -> DataFrame:
        return staged(self.view("fx_registry"), "registry")

    @cached_property
    def mapping(self) -> DataFrame:
        return self.view("fx_report_mapping")

    @cached_property
    def market_map(self) -> DataFrame:
        return self.view("fx_market")

    @cached_property
    def region_map(self) -> DataFrame:
        """Codes by region, the markets of the weekly feed."""
        return self.view("fx_region_market")

    @cached_property
    def manifest(self) -> DataFrame:
        return self.view("fx_manifest")

    def normalized(self, name: str) -> DataFrame:
        """The plan of a normalised feed, for a query that reads it once."""
        if name == "daily":
            rows = normalize.normalize_daily(self.daily_raw)
            return normalize.with_file_comment(rows, normalize.file_comments(self.daily_raw))
        if name == "weekly":
            return normalize.normalize_period(self.weekly_raw, WEEKLY)
        raw = self.monthly_raw
        return normalize.normalize_period(raw if name == "monthly" else normalize.resolve_market(raw, self.market_map), MONTHLY)

    @cached_property
    def daily(self) -> DataFrame:
        return staged(self.normalized("daily"), "daily")

    @cached_property
    def weekly(self) -> DataFrame:
        return staged(self.normalized("weekly"), "weekly")

    @cached_property
    def monthly(self) -> DataFrame:
        return staged(self.normalized("monthly"), "monthly")

    @cached_property
    def multimarket(self) -> DataFrame:
        return staged(self.normalized("multimarket"), "multimarket")

    def rows(self, name: str) -> tuple[DataFrame, Grain]:
        return getattr(self, name), {"daily": DAILY, "weekly": WEEKLY}.get(name, MONTHLY)

    def empty_log(self) -> DataFrame:
        return self.spark.createDataFrame([], schemas.CORRECTIONS_SCHEMA)

    def empty_state(self, grain: Grain) -> DataFrame:
        layout = schemas.DAILY_OUTPUT_SCHEMA if grain is DAILY else schemas.PERIOD_OUTPUT_SCHEMA
        return self.spark.createDataFrame([], layout)

    def ingest_third(self, name: str, compat: bool = False) -> upsert.Ingested:
        rows, grain = self.rows(name)
        state = as_state(rows.filter("delivery < 3"), grain)
        return upsert.ingest(
            rows.filter("delivery = 3"), state, self.empty_log(), grain, RUN_TS, compat, name == "multimarket"
        )

    def fold_all(self, name: str, compat: bool = False) -> upsert.Ingested:
        rows, grain = self.rows(name)
        return fold(rows, self.empty_state(grain), self.empty_log(), grain, RUN_TS, compat, name == "multimarket")

    def fold_stored(self, name: str) -> upsert.Ingested:
        rows, grain = self.rows(name)
        multimarket = name == "multimarket"
        first = fold(
            rows.filter("delivery < 3"), self.empty_state(grain), self.empty_log(), grain, RUN_TS, multimarket=multimarket
        )
        state, log = staged(first.output, f"{name}-state"), staged(first.corrections, f"{name}-log")
        later = F.when(F.expr(views.LATER[name]), 4).otherwise(3)
        third = rows.filter("delivery = 3").withColumn("delivery", later.cast(rows.schema["delivery"].dataType))
        return fold(third, state, log, grain, RUN_TS, multimarket=multimarket)

    def daily_averages(self, grain: Grain) -> DataFrame:
        return rollup.averages(self.fold_all("daily").output, self.registry, grain)

    def merged_averages(self, grain: Grain) -> DataFrame:
        """Period table before: the means of the first two deliveries, those of clicks passed off as
        delivered, beside the period feed itself."""
        rows, _ = self.rows(grain.name)
        first = rollup.averages(as_state(self.daily.filter("delivery < 3"), DAILY), self.registry, grain)
        first = first.withColumn(
            "Input_File", F.when(F.col("KPI name") == "KPI CLICK", "delivered.csv").otherwise(F.col("Input_File"))
        )
        before = as_state(rows, grain).unionByName(first)
        return rollup.merge_averages(self.daily_averages(grain), before)

    def weekly_table(self) -> DataFrame:
        """Calculated means beside the weekly feed, the means not yet compared with anything."""
        means = rollup.averages(as_state(self.daily, DAILY), self.registry, WEEKLY)
        return means.unionByName(as_state(self.weekly, WEEKLY))

    def matrix(self, grain: Grain, compat: bool = False) -> DataFrame:
        flags = registry.request_flags(self.registry, views.GRID, compat)
        if grain is MONTHLY:
            output, start, as_of = as_state(self.multimarket, MONTHLY), PERIOD_START, PERIOD_AS_OF
        else:
            output = as_state(self.daily, DAILY) if grain is DAILY else self.weekly_table()
            start, as_of = DAILY_START, DAILY_AS_OF
        return matrix.matrix(flags, self.market_map, output, start, as_of, grain, compat)

    def matrix_delivered(self) -> DataFrame:
        """The weekly matrix over the periods and markets of the delivered weekly rows."""
        flags = registry.request_flags(self.registry, views.GRID)
        return matrix.matrix(flags, self.region_map, self.weekly_table(), PERIOD_START, PERIOD_AS_OF, WEEKLY)

    @cached_property
    def parsed_manifest(self) -> DataFrame:
        return deliveries.parse_names(self.manifest)

    @cached_property
    def watched_markets(self) -> DataFrame:
        return self.market_map.select(F.lower("code").alias("market"), (F.col("code") < "HX").alias("stable"))

    def expected(self) -> DataFrame:
        last = date(2024, 2, 3)  # two days before as_of
        return deliveries.expected_deliveries(self.watched_markets, FILE_TYPES, DAILY_START, last)


def as_state(rows: DataFrame, grain: Grain) -> DataFrame:
    """Normalised rows as an output table that nothing has been compared with yet."""
    return rows.withColumn("was_corrected_Flag", F.lit(None).cast("string")).select(*grain.output)


def _scan_daily_feed(f: Feeds) -> DataFrame:
    lines, comments = normalize.daily_lines(f.daily_raw), normalize.comment_lines(f.daily_raw)
    return lines.unionByName(comments).select("row_no", "Marker", "DatumKPI", "Natco", "Value", "Input_File")


def _normalize_values(f: Feeds) -> DataFrame:
    def numbers(raw: DataFrame, feed: str) -> DataFrame:
        value = F.col("Value")
        return raw.select(
            F.lit(feed).alias("feed"), "row_no", text.is_number_text(value).alias("is_number"),
            text.number(value).alias("number"),
        )

    daily = numbers(f.daily_raw, "daily")
    return daily.unionByName(numbers(f.weekly_raw, "weekly")).unionByName(numbers(f.monthly_raw, "monthly"))


def _normalize_dates(f: Feeds) -> DataFrame:
    def parsed(raw: DataFrame, feed: str, day: Column) -> DataFrame:
        return raw.select(F.lit(feed).alias("feed"), "row_no", dates.business_text(day).alias("business_date"))

    daily = parsed(f.daily_raw, "daily", dates.daily_date(F.col("DatumKPI")))
    weekly = parsed(f.weekly_raw, "weekly", dates.weekly_date(F.col("Date")))
    monthly = parsed(f.monthly_raw, "monthly", dates.period_date(F.col("Date")))
    return daily.unionByName(weekly).unionByName(monthly)


def _date_helpers(f: Feeds) -> DataFrame:
    daily = f.daily_raw.select(F.lit("daily").alias("feed"), "row_no", F.col("DatumKPI").alias("stamp"))
    weekly = f.weekly_raw.select(F.lit("weekly").alias("feed"), "row_no", F.col("Date").alias("stamp"))
    stamp = F.col("stamp")
    return daily.unionByName(weekly).select(
        "feed",
        "row_no",
        dates.month_code(stamp).alias("month_code"),
        dates.stamp_to_business(stamp).alias("business_date"),
        dates.first_of_month_text(stamp).alias("first_of_month"),
        dates.dotted_text(stamp).alias("dotted"),
    )


def _text_helpers(f: Feeds) -> DataFrame:
    remark, kpi, value = F.col("Remarks"), F.col("KPI name"), F.col("Value")
    return f.weekly_raw.select(
        "row_no",
        text.name_or_placeholder(remark, kpi, also_empty=True).alias("name"),
        text.compare_value(value, remark, empty_is_missing=True).alias("compare"),
        text.has_update(value, remark).alias("has_update"),
    )


def _build_keys(f: Feeds) -> DataFrame:
    def keyed(rows: DataFrame, feed: str) -> DataFrame:
        return rows.select(F.lit(feed).alias("feed"), "Input_ID")

    service = f.registry.select(
        F.lit("registry").alias("feed"),
        keys.service_key(F.col("Service"), F.col("Vendor"), F.col("KPI_Name")).alias("Input_ID"),
    )
    parts = [keyed(f.normalized(name), name) for name in ("daily", "weekly", "monthly")]
    parts += [keyed(normalize.normalize_ims(f.ims_raw), "ims"), service]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.groupBy("feed", "Input_ID").agg(F.count(F.lit(1)).alias("n"))


def _correction_flag(f: Feeds) -> DataFrame:
    log = f.ingest_third("weekly").corrections
    flagged = corrections.flag_corrected(f.weekly, corrections.logged_keys(log, WEEKLY))
    return flagged.select("Input_ID", "Input_File", "Value", "was_corrected_Flag")


def _multimarket_split(f: Feeds, compat: bool = False) -> DataFrame:
    output = f.ingest_third("multimarket", compat).output
    return output.join(f.market_map.select(F.col("market").alias("Region")), "Region", "left_semi")


def _calendar(f: Feeds) -> DataFrame:
    day = dates.daily_date(F.col("DatumKPI"))
    bounds = f.daily_raw.agg(F.min(day).alias("start"), F.date_add(F.max(day), 1).alias("as_of"))
    return calendar.calendar(bounds)


def _calendar_compat(f: Feeds) -> DataFrame:
    day = dates.period_date(F.col("Date"))
    bounds = f.monthly_raw.agg(F.min(day).alias("start"), F.max(day).alias("as_of"))
    return calendar.calendar(bounds, compat=True).select("Date", "YearWeek", "Quarter", "RC12")


def _mean_columns(df: DataFrame) -> DataFrame:
    return df.withColumn("Value", rounded(F.col("Value")))


def _facts(f: Feeds) -> DataFrame:
    return facts.facts(as_state(f.normalized("weekly"), WEEKLY), normalize.normalize_ims(f.ims_raw), f.registry)


def _report(f: Feeds) -> DataFrame:
    return report.status_report(f.matrix(MONTHLY), f.registry, f.mapping, views.COUNTRIES, PERIOD_AS_OF)


def _report_unrequested(f: Feeds) -> DataFrame:
    return report.status_report(
        f.matrix(MONTHLY), f.registry, f.mapping, views.COUNTRIES, PERIOD_AS_OF, include_unrequested=True
    )


def _matrix_outer(f: Feeds, compat: bool = False) -> DataFrame:
    flags = registry.request_flags(f.registry, views.GRID)
    joined = matrix.matrix_outer(flags, f.market_map, f.weekly_table(), DAILY_START, DAILY_AS_OF, compat=compat)
    return joined.withColumn("KPI_Value", rounded(F.col("KPI_Value")))


def _unknown_grid_codes(f: Feeds) -> DataFrame:
    """The request grid against a market map that lacks one of its codes."""
    return normalize.unknown_markets(registry.request_flags(f.registry, views.GRID), f.market_map.filter("code <> 'CX'"), "Natco")


def _matrix_weekly(f: Feeds) -> DataFrame:
    return f.matrix(WEEKLY).withColumn("KPI_Value", rounded(F.col("KPI_Value")))


def _allow_list(f: Feeds) -> DataFrame:
    """Names the stable markets owe us."""
    name = F.concat_ws(
        "_", "file_type", F.concat(F.date_format("delivery_date", "yyyy-MM-dd"), F.lit(".csv")),
        F.concat("market", F.lit(".csv")),
    )
    return deliveries.publishable(f.manifest, f.expected().filter("stable").select(name.alias("name")))


def _rejected(f: Feeds) -> DataFrame:
    patterns = (r"click_{date}\.csv_[a-z]x\.csv", r"view_{date}\.csv_[a-m]x\.csv")
    return deliveries.rejected_names(f.manifest, patterns, date(2024, 1, 15), "%Y-%m-%d")


def _recipients(f: Feeds) -> DataFrame:
    code = F.lower("code")
    who = f.market_map.select(code.alias("market"), F.concat(F.lit("kpi@"), code).alias("address"))
    return deliveries.report_recipients(f.manifest, who)


def _run_dates(f: Feeds) -> DataFrame:
    days = f.parsed_manifest.select(F.col("delivery_date").alias("as_of")).distinct()
    return days.select("as_of", *[c.alias(n) for n, c in deliveries.run_dates(F.col("as_of")).items()])


QUERIES: dict[str, Callable[[Feeds], DataFrame]] = {
    # feeds and scalar rules
    "scan_daily_feed": _scan_daily_feed,
    "normalize_values": _normalize_values,
    "normalize_dates": _normalize_dates,
    "date_helpers": _date_helpers,
    "text_helpers": _text_helpers,
    "build_keys": _build_keys,
    "file_comment": lambda f: normalize.file_comments(f.daily_raw),
    "normalize_daily": lambda f: f.normalized("daily"),
    "normalize_weekly": lambda f: f.normalized("weekly"),
    "normalize_monthly": lambda f: f.normalized("monthly"),
    # one delivery against the state
    "old_value_map": lambda f: corrections.value_map(as_state(f.normalized("daily"), DAILY)),
    "old_comment_map": lambda f: corrections.comment_map(f.ingest_third("daily").corrections),
    "corrections_daily": lambda f: f.ingest_third("daily").new_corrections,
    "corrections_weekly": lambda f: f.ingest_third("weekly").new_corrections,
    "corrections_monthly": lambda f: f.ingest_third("monthly").new_corrections,
    "corrections_multimarket_compat": lambda f: f.ingest_third("multimarket", compat=True).new_corrections,
    "correction_flag": _correction_flag,
    "upsert_daily": lambda f: f.ingest_third("daily").output,
    "upsert_weekly": lambda f: f.ingest_third("weekly").output,
    "upsert_monthly": lambda f: f.ingest_third("monthly").output,
    "upsert_monthly_compat": lambda f: f.ingest_third("monthly", compat=True).output,
    "multimarket_split": _multimarket_split,
    # all deliveries at once
    "fold_deliveries": lambda f: f.fold_all("daily").output,
    "fold_corrections": lambda f: f.fold_all("daily").new_corrections,
    "fold_corrections_compat": lambda f: f.fold_all("daily", compat=True).new_corrections,
    "fold_deliveries_weekly": lambda f: f.fold_all("weekly").output,
    "fold_corrections_weekly": lambda f: f.fold_all("weekly").new_corrections,
    "fold_multimarket": lambda f: f.fold_all("multimarket").output,
    "fold_stored_deliveries": lambda f: f.fold_stored("daily").output,
    "fold_stored_corrections": lambda f: f.fold_stored("daily").corrections,
    "fold_stored_deliveries_weekly": lambda f: f.fold_stored("weekly").output,
    "fold_stored_corrections_weekly": lambda f: f.fold_stored("weekly").corrections,
    "fold_stored_multimarket": lambda f: f.fold_stored("multimarket").output,
    # roll-ups
    "weekly_averages": lambda f: _mean_columns(f.daily_averages(WEEKLY)),
    "monthly_averages": lambda f: _mean_columns(f.daily_averages(MONTHLY)),
    "weekly_averages_merged": lambda f: _mean_columns(f.merged_averages(WEEKLY)),
    "monthly_averages_merged": lambda f: _mean_columns(f.merged_averages(MONTHLY)),
    # registry, calendar, matrix
    "registry_names": lambda f: registry.id_names(f.registry),
    "registry_unpivot": lambda f: registry.request_grid(f.registry, views.GRID),
    "registry_flags": lambda f: registry.request_flags(f.registry, views.GRID),
    "calendar_day": _calendar,
    "calendar_week": lambda f: calendar.week_starts(_calendar(f)),
    "calendar_month": lambda f: calendar.month_starts(_calendar(f)),
    "calendar_compat": _calendar_compat,
    "matrix_daily": lambda f: f.matrix(DAILY),
    "matrix_daily_compat": lambda f: f.matrix(DAILY, compat=True),
    "matrix_weekly": _matrix_weekly,
    "matrix_weekly_delivered": lambda f: f.matrix_delivered().withColumn("KPI_Value", rounded(F.col("KPI_Value"))),
    "matrix_monthly": lambda f: f.matrix(MONTHLY),
    "matrix_outer": _matrix_outer,
    "matrix_outer_compat": lambda f: _matrix_outer(f, compat=True),
    "unknown_grid_codes": _unknown_grid_codes,
    # publishing
    "rejected_ims": lambda f: normalize.quarantine_ims(f.ims_raw),
    "ims_normalize": lambda f: normalize.normalize_ims(f.ims_raw),
    "facts": _facts,
    "report_thresholds": lambda f: registry.country_thresholds(f.mapping, views.COUNTRIES),
    "report_status": _report,
    "report_status_unrequested": _report_unrequested,
    "report_three_months": lambda f: report.last_three_months(f.matrix(MONTHLY), PERIOD_AS_OF),
    # deliveries
    "expected_vs_delivered": lambda f: deliveries.missing_deliveries(f.parsed_manifest, f.expected()),
    "run_verdict": lambda f: deliveries.run_verdict(f.parsed_manifest, f.expected()),
    "pending_files": lambda f: deliveries.pending_files(f.parsed_manifest, f.watched_markets, FILE_TYPES),
    "incomplete_deliveries": lambda f: deliveries.incomplete_deliveries(f.parsed_manifest, FILE_TYPES),
    "complete_deliveries": lambda f: deliveries.complete_deliveries(f.parsed_manifest, FILE_TYPES),
    "reprocess_plan": lambda f: deliveries.reprocess_plan(f.parsed_manifest),
    "run_dates": _run_dates,
    "publish_allow_list": _allow_list,
    "rejected_names": _rejected,
    "report_recipients": _recipients,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build: Callable[[Feeds], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: build(Feeds(spark, sf_dir))

    return {name: bind(build) for name, build in QUERIES.items()}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly means straight from the daily feed."""
    f = Feeds(spark, sf_dir)
    return rollup.averages(as_state(f.normalized("daily"), DAILY), f.registry, WEEKLY)
