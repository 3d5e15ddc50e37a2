"""schema'd scans of deliveries and dimensions, with the provenance the operators need.

``delivery`` is the sortable pair (modification time, path): files of a folder are taken in that order.
``row_no`` orders the lines of one file also when it is read in several splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from kpiweave import schemas
from kpiweave.operators.grain import WEEKLY, Grain

# Text that a missing cell may be written as.
MISSING_TEXT = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
_SHORT_ROW = "_short_row"


def _market_from_path() -> Column:
    """Folders are laid out as base/market/period/file."""
    folder = F.regexp_extract("_metadata.file_path", r"/([^/]+)/[^/]+/[^/]+$", 1)
    return F.url_decode(F.replace(folder, F.lit("+"), F.lit("%2B")))  # paths come percent-encoded, "+" as itself


def provenance() -> list[Column]:
    """S11, S13, O1. The row number is added by ``with_row_order``, as streams do not allow it."""
    file = F.col("_metadata")
    return [
        file["file_name"].alias("Input_File"),
        F.date_format(file["file_modification_time"], "yyyy-MM-dd-HH:mm:ss").alias("Input_File_Time"),
        F.struct(
            file["file_modification_time"].alias("mtime"), file["file_path"].alias("path")
        ).alias("delivery"),
        file["file_block_start"].alias("_block"),
    ]


def with_row_order(raw: DataFrame) -> DataFrame:
    order = F.struct(F.col("_block").alias("block"), F.monotonically_increasing_id().alias("line"))
    return raw.withColumn("row_no", order).drop("_block")


def without_missing_text(raw: DataFrame, schema: StructType) -> DataFrame:
    cell = lambda c: F.when(~F.col(f"`{c}`").isin(*MISSING_TEXT), F.col(f"`{c}`")).alias(c)
    names = set(schema.names)
    return raw.select(*[cell(c) if c in names else F.col(f"`{c}`") for c in raw.columns])


def _delimited(reader, schema: StructType, header: bool):
    return (
        reader.schema(schema)
        .option("sep", "|")
        .option("header", header)
        .option("escape", '"')
        .option("pathGlobFilter", "*.csv")
        .option("recursiveFileLookup", True)
    )


def shape_daily(scan: DataFrame) -> DataFrame:
    """Nine or ten columns; the market is the folder's, not the file's."""
    columns = [c for c in schemas.DAILY_RAW.names if c != "trail"]
    raw = scan.select(*columns, _market_from_path().alias("_market"), *provenance())
    raw = without_missing_text(raw, schemas.DAILY_RAW)
    return raw.withColumn("Natco", F.col("_market")).drop("_market")


def read_daily(spark: SparkSession, path: str) -> DataFrame:
    return with_row_order(shape_daily(_delimited(spark.read, schemas.DAILY_RAW, False).csv(path)))


def read_period(spark: SparkSession, path: str, grain: Grain, fmt: str = "csv") -> DataFrame:
    """Weekly or monthly deliveries of a market folder, as delimited text or as an export with
    the same columns. Rows of files that have no remarks column get an empty remark (P4)."""
    schema = schemas.WEEKLY_RAW if grain is WEEKLY else schemas.MONTHLY_RAW
    raw = _read_headed(spark, path, schema, fmt)
    columns = [c for c in raw.columns if c != "Region"]
    return raw.select(*[f"`{c}`" for c in columns if c != "_market"], F.col("_market").alias("Region"))


def read_multimarket(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """The country is a column."""
    return _read_headed(spark, path, schemas.MULTIMARKET_RAW, fmt).drop("_market")


def read_ims(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """S15."""
    return _read_headed(spark, path, schemas.IMS_RAW, fmt).drop("_market")


def _read_headed(spark: SparkSession, path: str, schema: StructType, fmt: str) -> DataFrame:
    if fmt == "csv":
        checked = StructType(schema.fields + [StructField(_SHORT_ROW, StringType())])
        reader = _delimited(spark.read, checked, True).option("columnNameOfCorruptRecord", _SHORT_ROW).option(
            "columnPruning", False
        )
        scan = reader.csv(path)
    else:
        scan = spark.read.schema(schema).format(fmt).option("recursiveFileLookup", True).load(path)
    raw = scan.select(*[f"`{c}`" for c in scan.columns], _market_from_path().alias("_market"), *provenance())
    raw = without_missing_text(raw, schema)
    if fmt == "csv":
        if "Remarks" in schema.names:
            lacks = F.col(_SHORT_ROW).isNotNull() & F.col("Remarks").isNull()
            raw = raw.withColumn("Remarks", F.when(lacks, "").otherwise(F.col("Remarks")))
        raw = raw.drop(_SHORT_ROW)
    return with_row_order(raw)


def read_dimension(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """An exported registry or report mapping. Columns keep the export's order and headers,
    renamed where the operators use another name; ``AT.1`` becomes ``AT_1``."""
    reader = spark.read.option("sep", "|").option("header", True) if fmt == "csv" else spark.read
    raw = reader.format(fmt).load(path)
    names = [schemas.REGISTRY_HEADERS.get(c, c.replace(".", "_")) for c in raw.columns]
    raw = raw.toDF(*names)
    return without_missing_text(raw, raw.schema) if fmt == "csv" else raw


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Names and times of the files below a folder; file contents are not read."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return listing.select(
        F.element_at(F.split("path", "/"), -1).alias("name"),
        "path",
        F.col("modificationTime").alias("mtime"),
        "length",
    )


