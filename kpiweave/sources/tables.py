"""Warehouse tables as Parquet folders partitioned by market and month.

A run first claims its name: the next number after the last claim, taken by creating its marker file only if it does
not exist, and only once the run before it is published. The run stages each result in its own folder, then publishes
it with Spark's dynamic partition overwrite, which replaces in each table exactly the partitions the staged result
holds. Two overlapping runs therefore never start from the same state: the second fails when it claims. A run that dies
before it is published can be run again under the same run id, and then resumes its claim; nothing of it is read until
then. Staged folders of all runs but the last two are removed.

Creating a file only if absent is atomic on HDFS and on object stores with conditional writes; on a local file system
it is a check followed by a create.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from kpiweave import schemas
from kpiweave.functions.text import or_text
from kpiweave.operators.grain import DAILY, Grain
from kpiweave.session import prepare

PARTITION = ["part_market", "part_month"]
LOG = "corrections"
QUARANTINE = "quarantine"
# Tables that every run adds to rather than replaces: their rows are kept per run as well.
APPENDED = (LOG, QUARANTINE)
KEEP_STAGED = 2


class RunConflict(RuntimeError):
    """Another run holds the warehouse, or took the same name first."""


def state_schema(grain: Grain) -> StructType:
    return schemas.DAILY_OUTPUT_SCHEMA if grain is DAILY else schemas.PERIOD_OUTPUT_SCHEMA


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A table that does not exist yet has no rows."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def partitions_of(rows: DataFrame, market: str = "Region", day: str = "Date") -> DataFrame:
    """The partition columns of rows with ``dd.MM.yyyy`` dates, added to them."""
    text = F.col(day)
    month = F.concat(F.substring(text, 7, 4), F.substring(text, 4, 2))
    return rows.withColumn("part_market", or_text(F.col(market), "none")).withColumn(
        "part_month", or_text(month, "none")
    )


@dataclass(frozen=True)
class Run:
    number: int
    run_id: str | None


def _digest(run_id: str | None) -> str:
    return hashlib.sha256((run_id or "").encode()).hexdigest()[:16] if run_id else "none"


@dataclass(frozen=True)
class Warehouse:
    spark: SparkSession
    root: str

    def __post_init__(self) -> None:
        prepare(self.spark)

    # Files of the run markers, through the cluster's file system.
    def _fs(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/_runs")
        return path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), path

    def _markers(self) -> dict[int, dict[str, str]]:
        """Run number -> {kind: run id digest} for kinds claim, done, dropped."""
        fs, folder = self._fs()
        found: dict[int, dict[str, str]] = {}
        if not fs.exists(folder):
            return found
        for status in fs.listStatus(folder):
            name = status.getPath().getName()
            parts = name.split(".")
            if len(parts) == 3 and parts[0].isdigit() and parts[2] in ("claim", "done", "dropped"):
                found.setdefault(int(parts[0]), {})[parts[2]] = parts[1]
        return found

    def _mark(self, run: Run, kind: str) -> bool:
        fs, folder = self._fs()
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder, f"{run.number:012d}.{_digest(run.run_id)}.{kind}")
        try:
            fs.create(path, False).close()
        except Exception as error:  # noqa: BLE001 - the JVM's FileAlreadyExistsException
            if "FileAlreadyExists" in str(error) or "already exists" in str(error):
                return False
            raise
        return True

    def has_run(self, run_id: str) -> bool:
        """Whether a run of this id has been published."""
        digest = _digest(run_id)
        return any(kinds.get("done") == digest for kinds in self._markers().values())

    def begin(self, run_id: str | None = None, take_over: bool = False) -> Run:
        """Claim the next run. The last claimed run must be published, unless it has this run id (then it resumes) or
        ``take_over`` declares it dropped. Raises ``RunConflict`` where another run holds the warehouse."""
        markers = self._markers()
        last = max(markers, default=0)
        if last and not ({"done", "dropped"} & markers[last].keys()):
            if run_id is not None and markers[last]["claim"] == _digest(run_id):
                return Run(last, run_id)
            if not take_over:
                raise RunConflict(f"run {last} of {self.root} is not published")
            self._mark(Run(last, None), "dropped")
        run = Run(last + 1, run_id)
        if not self._mark(run, "claim"):
            raise RunConflict(f"run {run.number} of {self.root} was claimed by another run")
        return run

    def _staged(self, run: Run, table: str) -> str:
        return f"{self.root}/_runs/{run.number:012d}/{table}"

    def read(self, table: str, schema: StructType, parts: DataFrame | None = None) -> DataFrame:
        """The published rows, of the given partitions only; a semi join on the partition columns prunes the scan."""
        columns = [*schema.names]
        stored = read_or_empty(self.spark, f"{self.root}/{table}", StructType(schema.fields + _partition_fields()))
        if parts is not None:
            # The comparison, true for every partition, marks the list as a selective side, so that dynamic partition
            # pruning applies to the scan.
            wanted = parts.select(*PARTITION).distinct().where(F.col("part_month") >= F.lit(""))
            stored = stored.join(wanted, PARTITION, "left_semi")
        return stored.select(*[f"`{c}`" for c in columns])

    def state(self, grain: Grain, parts: DataFrame | None = None) -> DataFrame:
        return self.read(grain.name, state_schema(grain), parts)

    def log(self, parts: DataFrame | None = None) -> DataFrame:
        """Every published run's corrections."""
        return self.read(LOG, schemas.CORRECTIONS_SCHEMA, parts).select(*schemas.CORRECTIONS)

    def stage(self, run: Run, table: str, rows: DataFrame, market: str = "Region", day: str = "Date") -> None:
        """The run's result for ``table``, by partition, in the run's own folder. Rows are gathered by partition before
        the write; AQE splits the large ones again."""
        self._write_staged(run, table, partitions_of(rows, market, day))

    def _write_staged(self, run: Run, table: str, placed: DataFrame) -> None:
        placed.hint("rebalance", *PARTITION).write.mode("overwrite").partitionBy(*PARTITION).parquet(self._staged(run, table))

    def stage_log(self, run: Run, rows: DataFrame) -> None:
        self.stage(run, LOG, rows, "Natco", "DatumKPI")

    def stage_quarantine(self, run: Run, rows: DataFrame) -> None:
        """Rejected rows of the run, kept under its number like the log, so that a repeated run holds them once."""
        placed = rows.withColumn("part_market", or_text(F.col("grain"), "none")).withColumn("part_month", F.lit("none"))
        self._write_staged(run, QUARANTINE, placed)

    def publish(self, run: Run, tables: list[str]) -> None:
        """Replace, table by table, the partitions the run staged; appended tables take the run's own partitions. Then
        mark the run published and remove staged folders older than the last ``KEEP_STAGED`` runs."""
        for table in tables:
            try:
                staged = self.spark.read.parquet(self._staged(run, table))
            except AnalysisException as error:
                # A result without rows leaves no files: no partition to replace.
                if error.getCondition() not in ("UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND"):
                    raise
                continue
            keys = PARTITION
            if table in APPENDED:
                staged, keys = staged.withColumn("part_run", F.lit(run.number)), [*PARTITION, "part_run"]
            (
                staged.write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(*keys)
                .parquet(f"{self.root}/{table}")
            )
        self._mark(run, "done")
        fs, folder = self._fs()
        for number in self._markers():
            old = self.spark._jvm.org.apache.hadoop.fs.Path(folder, f"{number:012d}")
            if number <= run.number - KEEP_STAGED and fs.exists(old):
                fs.delete(old, True)


def _partition_fields() -> list[StructField]:
    return [StructField(name, StringType()) for name in PARTITION]
