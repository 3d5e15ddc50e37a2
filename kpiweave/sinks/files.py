"""K2, K5-K7: published files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_delimited(
    df: DataFrame,
    path: str,
    quote_all: bool = False,
    null_value: str = "",
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
) -> None:
    """K6 / K7: ``|`` separated text with a header, by market folder where asked for."""
    writer = (
        df.write.mode(mode)
        .option("sep", "|")
        .option("header", True)
        .option("quoteAll", quote_all)
        .option("escape", '"')
        .option("nullValue", null_value)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)


def write_partitioned(df: DataFrame, path: str, column: str, mode: str = "overwrite") -> None:
    """K2 / K4: one folder per market; with dynamic overwrite only the markets in ``df`` are replaced."""
    (
        df.withColumn(f"part_{column}", df[column])
        .hint("rebalance", f"part_{column}")
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(f"part_{column}")
        .parquet(path)
    )


def append(df: DataFrame, path: str) -> None:
    """K5."""
    df.write.mode("append").parquet(path)
