"""Versioned publishing: write beside, reconcile, then move the pointer; old data stays until then.

A pointer is a small file with the version's path, created under the next number and never overwritten.  The highest number that
has a path counts: of a pointer that is only half written, the one before it.  One run writes to a target at a time, so version folders that no
pointer names are leftovers of writes that failed; they are removed before a write, after one that fails, and after publishing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from reqflow.storage import arrow_store, file_system, small_batches


class ReconcileError(RuntimeError):
    """The staging copy doesn't hold as many rows as the source."""


def write_version(df: DataFrame, root: str, version: str, partition_by: str | None = None) -> tuple[str, int]:
    """Write ``df`` to a fresh version folder; its path and the rows written, counted in the same pass.

    What a failed write of the same version has left is removed first, and what this one leaves if it fails.
    A version that a pointer names is never written again.
    """
    spark, path = df.sparkSession, f"{root}/v={version}"
    if version in _kept_versions(spark, root):
        raise FileExistsError(f"{path} is published")
    drop(spark, path)
    seen = Observation()
    try:
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("errorifexists").parquet(path, partitionBy=partition_by)
    except Exception:
        drop(spark, path)
        raise
    return path, seen.get["n"]


def _pointers(spark: SparkSession, root: str) -> list:
    """Pointer files in order."""
    fs, p = file_system(spark, f"{root}/_pointers")
    return sorted((f.getPath() for f in fs.listStatus(p) if f.getPath().getName().isdigit()), key=lambda f: int(f.getName())) if fs.exists(p) else []


def _read(spark: SparkSession, pointer) -> str:
    return "".join(r.value for r in spark.read.text(pointer.toString()).collect())  # one line


def _named(spark: SparkSession, root: str) -> str | None:
    """The version folder that the last whole pointer names."""
    return next((path for path in (_read(spark, p) for p in reversed(_pointers(spark, root))) if path), None)


def _kept_versions(spark: SparkSession, root: str) -> set[str]:
    """Names of the versions that pointers name."""
    return {_read(spark, p).rsplit("/v=", 1)[-1] for p in _pointers(spark, root)}


def _point(spark: SparkSession, root: str, path: str, keep: int) -> None:
    old = _pointers(spark, root)
    final = f"{root}/_pointers/{int(old[-1].getName()) + 1 if old else 1:09d}"
    fs, p = file_system(spark, final)
    out = fs.create(p, False)  # refused if another run has published
    out.write(bytearray(path.encode()))
    out.close()
    for f in old[: max(0, len(old) + 1 - max(1, keep))]:
        fs.delete(f, False)


def current(spark: SparkSession, root: str) -> DataFrame | None:
    """The version that the pointer names."""
    path = _named(spark, root)
    return None if path is None else spark.read.parquet(path)


def publish(spark: SparkSession, df: DataFrame, root: str, version: str, expected: int | None = None, keep: int = 2) -> int:
    """Replace the table at ``root`` by ``df``; nothing changes unless all its rows are written.

    A run that failed, at whatever point before the pointer, is simply repeated under the same version.
    """
    clean_versions(spark, root)
    path, n = write_version(df, root, version)
    if expected is not None and n != expected:
        drop(spark, path)
        raise ReconcileError(f"{root}: {n} rows staged, {expected} in the source")
    _point(spark, root, path, keep)
    clean_versions(spark, root)
    return n


def drop(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    fs.delete(p, True)


def versions(spark: SparkSession, root: str) -> list[str]:
    """Version folders, oldest first."""
    fs, p = file_system(spark, root)
    if not fs.exists(p):
        return []
    found = [s for s in fs.listStatus(p) if s.getPath().getName().startswith("v=")]
    return [s.getPath().toString() for s in sorted(found, key=lambda s: (s.getModificationTime(), s.getPath().getName()))]


def clean_versions(spark: SparkSession, root: str) -> list[str]:
    """Delete the version folders that no pointer names: old ones and leftovers of failed writes; what was deleted."""
    named = _kept_versions(spark, root)
    old = [v for v in versions(spark, root) if v.rsplit("/v=", 1)[-1] not in named]
    for v in old:
        drop(spark, v)
    return old


def append_status(status: DataFrame, path: str) -> None:
    status.write.mode("append").parquet(path)


#: Files that one task has open at once: creating a file is mostly waiting.
OPEN_FILES = 16


class _FileWriter(DataSourceWriter):
    """Each task writes its rows' bytes below the root, some files at a time; the same path is overwritten."""

    def __init__(self, root: str):
        self.root = root

    def write(self, rows) -> WriterCommitMessage:
        from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait

        store, base = arrow_store(self.root)

        def put(path: str, content: bytes) -> None:
            store.create_dir(path.rsplit("/", 1)[0], recursive=True)
            with store.open_output_stream(path) as out:
                out.write(content)

        with ThreadPoolExecutor(OPEN_FILES) as pool:
            going: set = set()
            for r in rows:
                if len(going) >= 2 * OPEN_FILES:  # no more contents are held than that
                    done, going = wait(going, return_when=FIRST_COMPLETED)
                    for d in done:
                        d.result()
                going.add(pool.submit(put, f"{base}/{r.path}", bytes(r.content or b"")))
            for d in going:
                d.result()
        return WriterCommitMessage()


class FileSink(DataSource):
    """``df.write.format("files").option("path", root)`` for rows of path, content."""

    @classmethod
    def name(cls) -> str:
        return "files"

    def schema(self) -> str:
        return "path string, content binary"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _FileWriter(self.options["path"])


def export_blobs(files: DataFrame, root: str) -> int:
    """Write path, content (one row per path) as files; how many there are."""
    files.sparkSession.dataSource.register(FileSink)
    small_batches(files.sparkSession)  # tasks hold a batch as rows
    seen = Observation()
    # The writer takes rows as they lie in the scan: no bytes are shuffled.
    files.select("path", "content").observe(seen, F.count(F.lit(1)).alias("n")).write.format("files").option("path", root).mode("append").save()
    return seen.get["n"]
