"""Cut lineage: normalised deliveries are parsed once and read back as a column-pruned table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from kpiweave.session import checkpoint_root


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back; removed when the session's
    file system closes."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/kpiweave-stage/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).deleteOnExit(folder)
    return spark.read.schema(df.schema).parquet(path)
