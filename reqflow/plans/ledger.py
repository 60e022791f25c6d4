"""A run's folder: its tables, and an append-only ledger of the stages that requisitions have reached.

Tables are named by run.  One that is whole (it has Spark's success marker) is read, not made again, so a run that died goes on at its stage when it
is started again under its number; what a write has left half done is removed first.  The ledger has a folder for each run and stage with a row
per requisition: moved on, or held back with an error.  Nothing in it is changed later; what holds now is a view of it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reqflow.sources.publish import drop
from reqflow.storage import file_system

LEDGER = "req_no string, error string, run long, stage int"


def is_whole(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, f"{path}/_SUCCESS")
    return fs.exists(p)


class RunFolder:
    """Tables and moves of one run below ``root``."""

    def __init__(self, spark: SparkSession, root: str, run: int):
        self.spark, self.root, self.run = spark, root, int(run)
        self.made: list[str] = []

    def _write(self, df: DataFrame, path: str) -> None:
        drop(self.spark, path)
        df.write.parquet(path)
        self.made.append(path)

    def table(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """The run's table of this name; made if it isn't there."""
        path = f"{self.root}/run={self.run}/{name}"
        if is_whole(self.spark, path):
            return self.spark.read.parquet(path)
        df = make()
        self._write(df, path)
        return self.spark.read.schema(df.schema).parquet(path)

    def move(self, stage: int, alive: DataFrame, rejects: DataFrame | None = None) -> None:
        """Enter that the requisitions ``alive`` have reached a stage, and ``rejects`` (req_no, error) have not."""
        path = f"{self.root}/ledger/run={self.run}/stage={stage}"
        if is_whole(self.spark, path):
            return
        rows = alive.select("req_no", F.lit(None).cast("string").alias("error"))
        self._write((rows if rejects is None else rows.unionByName(rejects.select("req_no", "error"))).coalesce(8), path)

    def moves(self) -> DataFrame:
        """The ledger's rows of this run."""
        return ledger(self.spark, self.root).filter(F.col("run") == self.run)


def ledger(spark: SparkSession, root: str) -> DataFrame:
    """req_no, error, run, stage of all runs."""
    return spark.read.schema(LEDGER).parquet(f"{root}/ledger")


def latest(moves: DataFrame) -> DataFrame:
    """req_no, run, stage_id, error: how far each requisition came in the last run that took it, and what held it back then."""
    reached = F.max(F.when(F.col("error").isNull(), F.col("stage")))
    per_run = moves.groupBy("req_no", "run").agg(reached.alias("stage_id"), F.min(F.when(F.col("error").isNotNull(), F.struct("stage", "error"))).alias("bad"))
    last = per_run.groupBy("req_no").agg(F.max(F.struct("run", "stage_id", F.col("bad.error").alias("error"))).alias("x"))
    return last.select("req_no", "x.*")
