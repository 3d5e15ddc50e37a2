"""P5: business keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from kpiweave.functions.text import or_text


def input_id(market: Column, kpi: Column, day_text: Column, suffix: str) -> Column:
    """``{market}-{kpi}-{dd.MM.yyyy}-{d|w|m}``."""
    return F.concat(
        or_text(market, "nan"), F.lit("-"), or_text(kpi, "nan"), F.lit("-"), day_text, F.lit(f"-{suffix}")
    )


def ims_id(region: Column, kpi: Column, day_text: Column) -> Column:
    """No dash after the region."""
    return F.concat(or_text(region, "nan"), or_text(kpi, "nan"), F.lit("-"), day_text)


def service_key(service: Column, vendor: Column, kpi: Column) -> Column:
    return F.concat(or_text(service, "nan"), F.lit("-"), or_text(vendor, "nan"), F.lit("-"), or_text(kpi, "nan"))
