"""What differs between daily, weekly and monthly tables."""

from __future__ import annotations

from dataclasses import dataclass

from kpiweave import schemas


@dataclass(frozen=True)
class Grain:
    name: str
    suffix: str  # last part of Input_ID
    code: str  # Granularity in the corrections log
    kpi: str  # column that names the KPI
    output: tuple[str, ...]  # output table columns
    has_remarks: bool


DAILY = Grain("daily", "d", "D", "KPI_ID", tuple(schemas.DAILY_OUTPUT), False)
WEEKLY = Grain("weekly", "w", "W", "KPI name", tuple(schemas.PERIOD_OUTPUT), True)
MONTHLY = Grain("monthly", "m", "M", "KPI name", tuple(schemas.PERIOD_OUTPUT), True)
