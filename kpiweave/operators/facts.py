"""Facts of all weekly figures and the external measurements."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kpiweave import schemas
from kpiweave.functions.text import number, or_text
from kpiweave.operators.registry import facts_registry

_COLUMNS = ["Date", "KPI name", "Value", "Region", "Input_ID"]


def facts(weekly_output: DataFrame, ims: DataFrame, registry: DataFrame, compat: bool = False) -> DataFrame:
    """Weekly rows and normalised external rows, inner joined to the registry on the KPI name.

    Only registry rows marked for the report take part; the mark is tested before the join.
    """
    external = ims.select(
        "Date",
        "KPI name",
        number(F.col("Value").cast("string")).alias("Value"),
        "Region",
        F.concat(or_text(F.col("Input_ID"), "nan"), F.lit("-w")).alias("Input_ID"),
    )
    every = weekly_output.select(*_COLUMNS).unionByName(external)
    reported = facts_registry(registry, compat).filter(
        F.col("PM Report").isin("Y", "y") & F.col("%SVKPI_Key").isNotNull() & (F.col("%SVKPI_Key") != "--")
    )
    joined = every.join(reported, "KPI name").withColumnRenamed("KPI name", "Kpi name")
    return joined.select(*[f"`{c}`" for c in schemas.FACTS])
