"""Export of files by a manifest: only those that are new or changed are written, each as a file of its own or many to a pack."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reqflow.sources.keyed import KeyedTable
from reqflow.sources.publish import drop, export_blobs, write_version

MANIFEST = "path string, size long, digest string"


def export_changed(files: DataFrame, root: str, version: str, buckets: int = 16) -> int:
    """Write those of ``files`` (path, content; one row per path) that the manifest at ``root`` doesn't have with the same bytes; how many.

    The manifest (path, size, digest) is moved on when all are written, under ``version``; an export that failed is repeated.  Files
    that aren't among ``files`` stay, in the manifest too.  Only paths and digests are shuffled, and contents only of an export that changes too many files for a
    broadcast of their paths.
    """
    spark = files.sparkSession
    manifest = KeyedTable(spark, f"{root}/_manifest", "path", buckets)
    told = files.select("path", F.coalesce(F.octet_length("content"), F.lit(0)).cast("long").alias("size"), F.sha2(F.coalesce("content", F.lit(b"")), 256).alias("digest"))
    held = manifest.read()
    if held is None:
        n = export_blobs(files, f"{root}/files")
        manifest.replace(told, version)
        return n
    changed = told.join(held, ["path", "size", "digest"], "left_anti")
    n = export_blobs(files.join(changed.select("path"), "path", "left_semi"), f"{root}/files")
    if n:
        manifest.upsert(changed, version, ["size", "digest"])
    return n


PACKED = "path string, content binary, size long, digest string"


def export_packed(files: DataFrame, root: str, version: str, buckets: int = 16) -> int:
    """:func:`export_changed` that writes whole contents as rows of packs, not as files; how many.

    A small file takes a block of the disk and a folder for each part of its path, often a hundred times what it holds; in a pack it takes its bytes.  Each export
    adds a pack of what is new or changed, and the manifest (path, size, digest, pack) tells which pack holds a path now.
    :func:`packed_files` gives all of them, and :func:`reqflow.sources.publish.export_blobs` of it makes files.
    """
    manifest = KeyedTable(files.sparkSession, f"{root}/_manifest", "path", buckets)
    content = F.coalesce("content", F.lit(b""))
    told = files.select("path", content.alias("content"), F.octet_length(content).cast("long").alias("size"), F.sha2(content, 256).alias("digest"))
    held = manifest.read()
    if held is not None:
        changed = told.select("path", "size", "digest").join(held.select("path", "size", "digest"), ["path", "size", "digest"], "left_anti")
        told = told.join(changed.select("path"), "path", "left_semi")
    name = f"{version}-{uuid.uuid4().hex[:12]}"  # a pack is never written over, also by an export under the same version
    pack, n = write_version(told, f"{root}/packs", name)
    new = files.sparkSession.read.schema(PACKED).parquet(pack).select("path", "size", "digest", F.lit(name).alias("pack"))
    if held is None:
        manifest.replace(new, name)
    elif n:
        manifest.upsert(new, name, ["size", "digest", "pack"])
    else:
        drop(files.sparkSession, pack)
    return n


def packed_files(spark: SparkSession, root: str) -> DataFrame | None:
    """path, content of all files in the packs at ``root``, as last exported; None before the first export."""
    held = KeyedTable(spark, f"{root}/_manifest", "path").read()
    if held is None:
        return None
    packs = spark.read.schema(f"{PACKED}, v string").option("basePath", f"{root}/packs").parquet(f"{root}/packs")
    return packs.withColumnRenamed("v", "pack").join(held.select("path", "pack"), ["path", "pack"], "left_semi").select("path", "content")
