"""Tables that upserts change in part: buckets by a hash of the key, each version naming the folder of every bucket.

A version is a small manifest (bucket, path) that the pointer of :mod:`reqflow.sources.publish` names.  An upsert looks for the buckets that its source has
keys in, joins and writes those alone, and publishes a manifest that refers to the folders of earlier versions for all others.  So the
cost follows the source, not the target.  Readers of a version see all of it or none.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reqflow.operators.merge import upsert
from reqflow.sources import publish as W
from reqflow.storage import file_system

BUCKET = "bucket__"


class KeyedTable:
    """A table at ``root`` with one row per ``key``; ``buckets`` is fixed when it is made, and best leaves some 100 MB to each."""

    def __init__(self, spark: SparkSession, root: str, key: str, buckets: int = 64):
        self.spark, self.root, self.key, self.buckets = spark, root, key, buckets

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key).cast("string")), F.lit(self.buckets)).cast("int")

    def manifest(self) -> dict[int, str]:
        """The folder of each bucket that has rows: one entry per bucket."""
        held = W.current(self.spark, f"{self.root}/manifest")
        return {r.bucket: r.path for r in held.collect()} if held is not None else {}

    def _folders(self, paths: dict[int, str], schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*paths.values()) if paths else self.spark.createDataFrame([], schema)

    def _schema(self, paths: dict[int, str]):
        return self.spark.read.parquet(next(iter(paths.values()))).schema

    def read(self, buckets: Sequence[int] | None = None) -> DataFrame | None:
        """The table, or some of its buckets; None before it is made."""
        paths = self.manifest()
        if not paths:
            return None
        return self._folders(paths if buckets is None else {b: p for b, p in paths.items() if b in set(buckets)}, self._schema(paths))

    def _write(self, rows: DataFrame, version: str, kept: dict[int, str]) -> int:
        """Write ``rows`` by bucket and publish them beside the ``kept`` folders; how many rows were written."""
        data = f"{self.root}/data"
        path, n = W.write_version(rows.withColumn(BUCKET, self.bucket()).repartition(BUCKET), data, version, partition_by=BUCKET)
        fs, p = file_system(self.spark, path)
        made = {int(s.getPath().getName().split("=")[1]): s.getPath().toString() for s in fs.listStatus(p) if s.getPath().getName().startswith(BUCKET)}
        entries = sorted({**kept, **made}.items())
        manifest = self.spark.createDataFrame(entries, "bucket int, path string").coalesce(1)
        W.publish(self.spark, manifest, f"{self.root}/manifest", version, len(entries))
        self._clean()
        return n

    def _clean(self) -> None:
        """Delete the folders of versions that no manifest left refers to."""
        used = set()
        for v in W.versions(self.spark, f"{self.root}/manifest"):
            used |= {r.path.rsplit("/", 2)[1] for r in self.spark.read.parquet(v).collect()}
        for v in W.versions(self.spark, f"{self.root}/data"):
            if v.rsplit("/", 1)[-1] not in used:
                W.drop(self.spark, v)

    def replace(self, rows: DataFrame, version: str) -> int:
        return self._write(rows, version, {})

    def upsert(self, source: DataFrame, version: str, update: Sequence[str], insert: bool = True) -> int:
        """:func:`reqflow.operators.merge.upsert` of ``source`` into the buckets that it has keys in; how many rows were written."""
        paths = self.manifest()
        if not paths:
            raise ValueError(f"{self.root}: make the table first, by replace()")
        touched = {r[0] for r in source.select(self.bucket()).distinct().collect()}  # as many as there are buckets at most
        old = self._folders({b: p for b, p in paths.items() if b in touched}, self._schema(paths))
        return self._write(upsert(old, source, self.key, update, insert), version, {b: p for b, p in paths.items() if b not in touched})
