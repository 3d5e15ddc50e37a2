"""The KPI registry and its request grid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from kpiweave.functions.keys import service_key
from kpiweave.functions.text import or_text, strip, upper_strip


def id_names(registry: DataFrame) -> DataFrame:
    """Trimmed, upper-cased (KPI_ID, KPI_Name) pairs, distinct, id present."""
    return (
        registry.filter(F.col("KPI_ID").isNotNull())
        .select(upper_strip(F.col("KPI_ID")).alias("KPI_ID"), upper_strip(F.col("KPI_Name")).alias("KPI_Name"))
        .distinct()
    )


def request_grid(registry: DataFrame, grid: Sequence[str], compat: bool = False) -> DataFrame:
    """One row per KPI and grid cell with its three request flags.

    A cell column is named after its country; a ``1`` in the name marks weekly, a ``2`` monthly
    requests. Rows without an id are left out (``compat`` names them ``nan``).
    """
    rows = registry.filter(~F.col("KPI_ID").eqNullSafe("") & ~F.col("KPI_Name").eqNullSafe(""))
    if not compat:
        rows = rows.filter(F.col("KPI_ID").isNotNull())
    cells = rows.select("KPI_ID", "KPI_Name", *grid).unpivot(
        ["KPI_ID", "KPI_Name"], list(grid), "_cell", "Requested"
    )
    cell, filled = F.col("_cell"), F.col("Requested").isNotNull()
    weekly = filled & F.contains(cell, F.lit("1"))
    monthly = filled & ~F.contains(cell, F.lit("1")) & F.contains(cell, F.lit("2"))
    return cells.select(
        strip(or_text(F.col("KPI_ID"), "nan")).alias("KPI_ID"),
        strip(or_text(F.col("KPI_Name"), "nan")).alias("KPI_Name"),
        F.substring(cell, 1, 2).alias("Natco"),
        (filled & ~weekly & ~monthly).cast("int").alias("requested_Daily"),
        weekly.cast("int").alias("requested_Weekly"),
        monthly.cast("int").alias("requested_Monthly"),
    )


def request_flags(registry: DataFrame, grid: Sequence[str], compat: bool = False) -> DataFrame:
    """A5: one row per KPI and country code."""
    flags = ("requested_Daily", "requested_Weekly", "requested_Monthly")
    return (
        request_grid(registry, grid, compat)
        .groupBy("KPI_ID", "KPI_Name", "Natco")
        .agg(*[F.max(c).alias(c) for c in flags])
    )


def facts_registry(registry: DataFrame, compat: bool = False) -> DataFrame:
    """Registry rows that can carry facts. Names are trimmed unless ``compat``."""
    name = or_text(F.col("KPI_Name"), "nan")
    name = F.upper(name) if compat else upper_strip(name)
    more = F.col("more")
    polarity = F.when(more == "yes", "more is better").when(more == "no", "less is better").when(more.isNull(), "")
    if compat:
        polarity = polarity.otherwise(F.raise_error(F.concat(F.lit("unknown polarity "), more)).cast("string"))
    present = lambda c: F.col(c).isNotNull() & (F.col(c) != "")
    return registry.filter(present("Vendor") & present("Service")).select(
        name.alias("KPI name"),
        F.col("PM_Report").alias("PM Report"),
        "Vendor",
        "Service",
        F.col("Unit").alias("Units"),
        polarity.alias("Polarity"),
        service_key(F.col("Service"), F.col("Vendor"), name).alias("%SVKPI_Key"),
    ).filter(F.col("KPI name") != "")


def country_thresholds(mapping: DataFrame, countries: Sequence[str], compat: bool = False) -> DataFrame:
    """Thresholds that apply, one row per KPI and country."""
    kpi = F.col("KPI_ID") if compat else strip(F.col("KPI_ID"))
    return (
        mapping.filter(F.col("Threshold_flag") == "T")
        .select(kpi.alias("KPI_ID"), "Threshold", *countries)
        .unpivot(["KPI_ID", "Threshold"], list(countries), "Natco", "_cell")
        .filter(F.col("_cell").isNotNull())
        .drop("_cell")
    )
