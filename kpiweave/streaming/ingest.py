"""New daily files into the warehouse, each once.

The file source's checkpoint remembers what was taken; a batch is folded like any set of pending
deliveries. A late file simply becomes the latest delivery of its keys, so there is no watermark. A batch
repeated after a failure is taken in once only, as its commit carries the batch id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from kpiweave import schemas
from kpiweave.operators.grain import DAILY, MONTHLY, WEEKLY
from kpiweave.plans.jobs import normalized, run_averages, run_ingest
from kpiweave.sources.feeds import shape_daily, with_row_order
from kpiweave.sources.tables import Warehouse


def read_daily_stream(spark: SparkSession, path: str, archive: str | None = None, **options: str) -> DataFrame:
    """``archive`` moves consumed files there."""
    reader = (
        spark.readStream.schema(schemas.DAILY_RAW)
        .option("sep", "|")
        .option("escape", '"')
        .option("pathGlobFilter", "*.csv")
        .option("recursiveFileLookup", True)
    )
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    for key, value in options.items():
        reader = reader.option(key, value)
    return shape_daily(reader.csv(path))


def ingest_stream(
    stream: DataFrame,
    warehouse: Warehouse,
    checkpoint: str,
    run_ts: float,
    registry: DataFrame | None = None,
) -> StreamingQuery:
    """Start taking in what is there now; with a registry the means of changed periods follow."""

    def take(batch: DataFrame, batch_id: int) -> None:
        raw, run_id = with_row_order(batch), f"{checkpoint}#{batch_id}"
        if warehouse.has_run(run_id):
            rows = normalized(raw, DAILY)
        else:
            rows = run_ingest(warehouse, raw, DAILY, run_ts, run_id)
        if registry is not None:
            for grain in (WEEKLY, MONTHLY):
                run_averages(warehouse, registry, grain, changed=rows)

    return (
        stream.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
