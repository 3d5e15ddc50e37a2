"""Session settings that the operators are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Small dimensions are never hinted: Spark broadcasts a side only when its measured size is under
# autoBroadcastJoinThreshold and shuffles it otherwise. Hot keys on the large side of a join are
# split by AQE, also where the split costs one more exchange.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


# Spark 4.1 lets a union keep the hash partitioning its inputs share. When AQE then changes the number
# of partitions of one input, the query fails ("Can't zip RDDs with unequal numbers of partitions").
UNION_SETTING = ("spark.sql.unionOutputPartitioning", "false")


def prepare(spark: SparkSession) -> SparkSession:
    """The one setting that results, not only speed, depend on; safe to call on any session."""
    spark.conf.set(*UNION_SETTING)
    return spark


def build_session(app_name: str = "kpiweave", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names, or one in the session's warehouse, which is shared as well."""
    configured = spark.conf.get("spark.checkpoint.dir", "") or ""
    return configured or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_kpiweave"
