"""Full refresh of tables named by a control table."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reqflow.functions.text import error_clip
from reqflow.operators.reports import sync_summary
from reqflow.operators.requisitions import orphans
from reqflow.sources.database import JdbcTarget
from reqflow.sources.publish import append_status, current, publish
from reqflow.sources.scan import TableRules, align_to, control_scan

STATUS = "etl_id int, run_id long, synced_on date, status string, n_rows long, error_message string"


class SyncError(RuntimeError):
    """At least one table failed; the others are published."""


@dataclass
class SyncJob:
    """``read`` gives a source table by name; ``root`` holds the status log and, unless they are in a ``database``, the targets."""

    spark: SparkSession
    read: Callable[[str], DataFrame]
    root: str
    run_id: int
    run_date: str
    rules: TableRules = field(default_factory=TableRules)
    on_empty: str = "keep"
    parallel: int = 4
    database: JdbcTarget | None = None

    def published(self, name: str) -> DataFrame | None:
        """What a target holds now."""
        return current(self.spark, self.target(name)) if self.database is None else self.database.read(name) if self.database.exists(name) else None

    def target(self, name: str) -> str:
        return f"{self.root}/{name}"

    def refresh(self, entry) -> int:
        """Publish one table; the rows published, 0 if an empty source leaves the target as it is."""
        rows = self.rules.apply(self.read(entry.source), entry.source)
        old = current(self.spark, self.target(entry.destination)) if self.database is None else None
        if old is not None:
            rows = align_to(rows, old)
        expected = rows.count()
        if not expected and self.on_empty == "keep":
            return 0
        if self.database is not None:
            return self.database.refresh(rows, entry.destination, expected, (entry.etl_id, self.run_id, self.run_date, "SUCCESS", expected, None))
        return publish(self.spark, rows, self.target(entry.destination), str(self.run_id), expected)

    def one(self, entry) -> tuple:
        """A status row; a failure is recorded and leaves the other tables alone."""
        try:
            return (entry.etl_id, self.run_id, "SUCCESS", self.refresh(entry), None)
        except Exception as e:  # noqa: BLE001 - any table's failure is a status row
            return (entry.etl_id, self.run_id, "FAILED", 0, f"{type(e).__name__}: {e}")

    def run(self, control: DataFrame) -> DataFrame:
        """Refresh all enabled tables, append the status log; this run's status rows."""
        entries = control_scan(control).collect()  # one row per table to sync
        with ThreadPoolExecutor(self.parallel) as pool:
            rows = list(pool.map(self.one, entries))
        status = self.spark.createDataFrame(rows, "etl_id int, run_id long, status string, n_rows long, error_message string")
        status = status.select("etl_id", "run_id", F.lit(self.run_date).cast("date").alias("synced_on"), "status", "n_rows", error_clip(F.col("error_message")).alias("error_message"))
        append_status(status, f"{self.root}/_status")
        return self.spark.read.parquet(f"{self.root}/_status").filter(F.col("run_id") == self.run_id)

    def run_and_check(self, control: DataFrame, keys: list[tuple[str, str, str, str]]) -> DataFrame:
        """The run's summary with, per table, the orphans that its foreign keys have in what is published now.

        ``keys``: (child, foreign key, parent, key) by destination.  etl_id, success, tables, failed, n_rows, n_orphans;
        the totals have no etl_id.  Keys of tables that aren't published can't be checked and count as none.
        """
        status = self.run(control)
        names = control_scan(control).select("etl_id", F.col("destination").alias("child"))
        there = {r.child: self.published(r.child) for r in names.collect()}  # one entry per table to sync
        usable = [k for k in keys if there.get(k[0]) is not None and there.get(k[2]) is not None]
        found = foreign_key_report(there, usable) if usable else self.spark.createDataFrame([], "child string, foreign_key string, n_orphans long")
        per_child = names.join(found, "child", "left").groupBy("etl_id").agg(F.coalesce(F.sum("n_orphans"), F.lit(0)).cast("long").alias("n_orphans"))
        totals = per_child.agg(F.sum("n_orphans").alias("n_orphans")).select(F.lit(None).cast("int").alias("etl_id"), "n_orphans")
        return sync_summary(status).alias("s").join(per_child.union(totals).alias("f"), F.col("s.etl_id").eqNullSafe(F.col("f.etl_id")), "left").select("s.*", "f.n_orphans")

    def run_or_raise(self, control: DataFrame) -> DataFrame:
        status = self.run(control)
        failed = sync_summary(status).filter("etl_id is null").first().failed
        if failed:
            raise SyncError(f"{failed} of the tables failed")
        return status


def foreign_key_report(tables: dict[str, DataFrame], keys: list[tuple[str, str, str, str]]) -> DataFrame:
    """child, foreign_key, n_orphans for (child, foreign key, parent, key) declarations."""
    parts = [
        orphans(tables[child], tables[parent], foreign, key).agg(F.count("*").alias("n_orphans")).select(F.lit(child).alias("child"), F.lit(foreign).alias("foreign_key"), "n_orphans")
        for child, foreign, parent, key in keys
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
