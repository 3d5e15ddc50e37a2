"""Intermediate tables, and the package's own code, in the shared folder of the cluster."""

from __future__ import annotations

import io
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import kpiweave
from kpiweave.session import checkpoint_root


def _own(spark: SparkSession, path: str):
    """File system and path; the path is removed when the session's file system closes."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = found.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    system.deleteOnExit(found)
    return system, found


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the checkpoint folder and read it back.

    Cuts the lineage and survives lost executors; the copy goes when the session's file system closes."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _own(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def parallelism(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


_SHIPPED: set[str] = set()


def on_workers(df: DataFrame) -> DataFrame:
    """Send this package to the Python workers, where it may not be installed; once per application."""
    spark = df.sparkSession
    if spark.sparkContext.applicationId not in _SHIPPED:
        package, archive = Path(kpiweave.__file__).parent, io.BytesIO()
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as zipped:
            for source in sorted(package.rglob("*.py")):
                zipped.write(source, source.relative_to(package.parent))
        path = f"{checkpoint_root(spark)}/llm/code-{uuid.uuid4().hex}/kpiweave.zip"
        system, found = _own(spark, path)
        stream = system.create(found)
        stream.write(bytearray(archive.getvalue()))
        stream.close()
        spark.sparkContext.addPyFile(found.toString())
        _SHIPPED.add(spark.sparkContext.applicationId)
    return df


def own_columns(df: DataFrame) -> list[Column]:
    """All columns of ``df`` by name, whatever signs the names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]
