"""Fixed table layouts. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampType


def _text(*names: str) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


def _typed(names: list[str], **types) -> StructType:
    return StructType([StructField(n, types.get(n, StringType())) for n in names])


# Column lists of the feeds and tables, in file order.
DAILY_RAW = _text(
    "Marker", "DatumKPI", "TimestampTo", "Natco", "SourceSystem", "KPINameDaily",
    "Denominator", "Numerator", "Value", "trail",
)
WEEKLY_RAW = _text("Date", "Service", "KPI name", "Vendor", "Region", "Value", "Unit", "Remarks")
MONTHLY_RAW = _text("Date", "KPI name", "Value", "Remarks")
MULTIMARKET_RAW = _text("Date", "KPI name", "Region", "Value", "Remarks")
IMS_RAW = _text("Date", "KPI name", "Value", "Region")

DAILY_OUTPUT = [
    "Input_ID", "Date", "TimestampTo", "Region", "SourceSystem", "KPI_ID", "Denominator",
    "Numerator", "Value", "Input_File", "was_corrected_Flag",
]
PERIOD_OUTPUT = [
    "Input_ID", "Date", "KPI name", "Region", "Value", "Remarks", "Input_File", "was_corrected_Flag",
]
CORRECTIONS = [
    "Key_Corr", "DatumKPI", "KPINameQVD", "Natco", "KPIValueOld", "KPIValueNew", "CommentRowOld",
    "CommentRowNew", "CommentFileOld", "CommentFileNew", "TimestampCorrFile", "Granularity",
    "FileOld", "FileNew", "correction_timestamp",
]
MATRIX_DAILY = [
    "Natco", "KPI_ID", "KPI_Name", "requested_Daily", "Date", "normDate", "Week", "Year", "Month",
    "Day", "YearMonth", "Quarter", "YearWeek", "WeekDay", "KEY1", "KPI_Value", "Time", "IsDelivered",
    "Input_File", "SourceSystem", "Denominator", "Numerator", "was_corrected_Flag",
]
MATRIX_WEEKLY = [
    "Natco", "KPI_ID", "KPI_Name", "requested_Weekly", "Date", "KEY1", "KPI_Value", "IsDelivered",
    "Time", "Input_File", "Remarks", "was_corrected_Flag",
]
MATRIX_MONTHLY = [
    "Natco", "KPI_ID", "KPI_Name", "requested_Monthly", "Date", "KEY1", "KPI_Value", "IsDelivered",
    "Time", "Input_File", "Remarks", "was_corrected_Flag",
]
FACTS = [
    "Date", "Kpi name", "Value", "Region", "Input_ID", "Vendor", "Service", "Units", "Polarity",
    "%SVKPI_Key", "PM Report",
]

DAILY_OUTPUT_SCHEMA = _typed(DAILY_OUTPUT, Value=DoubleType())
PERIOD_OUTPUT_SCHEMA = _typed(PERIOD_OUTPUT, Value=DoubleType())
CORRECTIONS_SCHEMA = _typed(
    CORRECTIONS, KPIValueOld=DoubleType(), KPIValueNew=DoubleType(), correction_timestamp=DoubleType()
)
IMS_FACTS_SCHEMA = _text("Date", "KPI name", "Value", "Region", "Input_ID")
MANIFEST = StructType(
    [
        StructField("name", StringType()),
        StructField("path", StringType()),
        StructField("mtime", TimestampType()),
        StructField("length", LongType()),
    ]
)

# Exported workbook headers -> column names used by the operators.
REGISTRY_HEADERS = {
    "EDWH KPI_ID": "KPI_ID",
    "KPI name": "KPI_Name",
    "PM Report": "PM_Report",
    "[13] More is better": "more",
    "iSLA2.0": "iSLA2_0",
    "Threshold flag": "Threshold_flag",
}
