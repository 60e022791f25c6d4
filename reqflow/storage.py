"""Folders that all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``; one is made only where none is set and all runs on this machine."""
    if spark.sparkContext.getCheckpointDir() is None:
        path = spark.conf.get("spark.checkpoint.dir", None)
        if not path:
            if not spark.sparkContext.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            path = tempfile.mkdtemp(prefix="spark-shared-")
        spark.sparkContext.setCheckpointDir(path)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system and path object for ``path``, for listing and deleting folders."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def arrow_store(root: str):
    """Arrow's file system for ``root``, and the path there."""
    from pyarrow import fs

    scheme, _, rest = root.rpartition(":/")
    # Hadoop writes local folders as file:/x, Arrow wants file:///x; other stores' addresses are full already.
    return fs.FileSystem.from_uri(root if "://" in root else f"{scheme or 'file'}:///{rest.lstrip('/') if scheme else root.lstrip('/')}")


def small_batches(spark: SparkSession) -> None:
    """Bound what goes to a Python worker at once: texts may be long, and workers keep what they once took."""
    for name, most in (("maxRecordsPerBatch", 1000), ("maxBytesPerBatch", 8 << 20)):
        key = f"spark.sql.execution.arrow.{name}"
        now = spark.conf.get(key).rstrip("b")
        if not (now.isdigit() and 0 < int(now) <= most):  # else larger, unbounded, or in other units
            spark.conf.set(key, most)


def small_partitions(spark: SparkSession, most: int = 8 << 20) -> None:
    """Bound what one task reads of a shuffle, where Spark merges small partitions: short keys took 13 to 25 times their compressed size when they were sorted."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    now = re.fullmatch(r"(\d+)([kmgtp]?)(?:i?b)?", spark.conf.get(key).strip().lower())
    if not (now and 0 < int(now[1]) << 10 * " kmgtp".index(now[2] or " ") <= most):
        spark.conf.set(key, most)
