"""Helpers shared by the corpus operators: row keys, shared scratch tables, group look-ups."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reqflow.storage import small_batches

#: Groups that hold more than this share of all rows are hot: at most
#: ``1 / HOT_SHARE`` of them, whatever the input's size.  Small groups never are.
HOT_SHARE = 1.0 / 512
MIN_HOT = 100
SALTS = 32

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only; null becomes the empty string."""
    return F.translate(F.coalesce(col.cast("string"), F.lit("")), ASCII_UPPER, ASCII_LOWER)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: A row's key holds its file's number above these bits and its place in the file below.
PLACE_BITS = 36
#: Paths and numbers of up to so many files are broadcast (some 100 bytes each).
MAX_BROADCAST_FILES = 200_000


def _is_scan(df: DataFrame) -> bool:
    """Whether ``df`` is files read, with deterministic filters and projections at most: only then is a row's place a key."""
    if "_metadata" in map(str.lower, df.columns) or not hasattr(df, "_jdf"):
        return False
    plan = df._jdf.queryExecution().analyzed()
    while True:
        kind, below = plan.nodeName(), plan.children()
        if kind.startswith(("LogicalRelation", "Relation")) and not below.size():
            break
        if kind not in ("Project", "Filter", "SubqueryAlias", "View") or below.size() != 1 or not plan.deterministic():
            return False
        plan = below.head()
    try:
        df.select("_metadata.file_path", "_metadata.row_index")
    except AnalysisException:
        return False
    return True


def keyed_rows(df: DataFrame) -> DataFrame:
    """``row`` (a struct of all columns) and ``rk``, a key of the input row that is the same in every scan.

    ``doc_id`` may be null or repeated, so it can't serve as a key, and numbers
    made while scanning follow the splits, which change with the executors at
    hand.  Of a file scan the key is the file's number (in order of the paths) and
    the row's place in the file.  Anything else is written once to the shared
    folder, with a number, and read from there.
    """
    spark = df.sparkSession
    small_batches(spark)
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
    if not _is_scan(df):
        path = shared_path(spark, "keyed")
        df.select(row, F.monotonically_increasing_id().alias("rk")).write.parquet(path)
        return spark.read.parquet(path)
    place = F.col("_metadata.row_index")
    # One path per file of the table, which the driver lists for any scan.
    paths = sorted(r[0] for r in df.select("_metadata.file_path").distinct().collect())
    if len(paths) < 2:
        return df.select(row, place.alias("rk"))
    numbers = spark.createDataFrame(pa.table({"file__": paths, "number__": pa.array(range(len(paths)), pa.int64())}))
    numbers = F.broadcast(numbers) if len(paths) <= MAX_BROADCAST_FILES else numbers
    rows = df.select(row, F.col("_metadata.file_path").alias("file__"), place.alias("place__")).join(numbers, "file__")
    return rows.select("row", (F.shiftleft("number__", PLACE_BITS) + F.col("place__")).alias("rk"))


def keyed(df: DataFrame, *cols: Callable[[Callable[[str], Column]], Column]) -> DataFrame:
    """The given columns, made by functions of a column look-up, plus ``rk`` (see :func:`keyed_rows`)."""
    return columns_of(keyed_rows(df), *cols)


def columns_of(rows: DataFrame, *cols: Callable[[Callable[[str], Column]], Column]) -> DataFrame:
    """Columns of :func:`keyed_rows`' rows, made by functions of a column look-up, plus ``rk``."""
    look_up = lambda name: F.col("row")[name]
    return rows.select(*[c(look_up) for c in cols], "rk")


def ensure_shared_dir(spark: SparkSession) -> None:
    """Use the cluster's ``spark.checkpoint.dir``; make one only where none is set and all runs on this machine."""
    if spark.sparkContext.getCheckpointDir() is None:
        path = spark.conf.get("spark.checkpoint.dir", None)
        if not path:
            if not spark.sparkContext.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            path = tempfile.mkdtemp(prefix="spark-ckpt-")
        spark.sparkContext.setCheckpointDir(path)


def saved(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and cut its lineage."""
    ensure_shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    ensure_shared_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def hot_keys(groups: DataFrame, key: str, size: str, count: Callable[[], int] | None = None) -> list:
    """Keys of the groups with more than ``HOT_SHARE`` of all rows: at most 512; ``count`` tells how many rows there are, where that is cheaper than adding up."""
    top = groups.select(key, size).orderBy(F.desc(size)).limit(int(1 / HOT_SHARE)).collect()
    if not top or top[0][1] <= MIN_HOT:
        return []
    total = count() if count else groups.agg(F.sum(size)).first()[0]
    return [k for k, n in top if n > max(MIN_HOT, total * HOT_SHARE)]


def attach_groups(rows: DataFrame, groups: DataFrame, key: str, size: str | None, how: str = "left", hot: list | None = None) -> DataFrame:
    """Join ``rows`` to one row per group without gathering a hot group in one task.

    ``groups`` has ``key``, ``size`` (rows in the group; not needed where ``hot`` keys are given) and
    further columns, none of which ``rows`` has except ``key``.  Hot groups (see :func:`hot_keys`) are
    repeated ``SALTS`` times and their rows spread over the copies; rows whose key is null are
    spread too.  It is one shuffle join at any size.
    """
    extra = [c for c in groups.columns if c != key]
    hot = hot_keys(groups, key, size) if hot is None else hot
    is_hot = F.col(key).isin(hot) if hot else F.lit(False)
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns]), F.lit(SALTS)).cast("int")
    spread = rows.withColumns({"key__": F.col(key), "salt__": F.when(is_hot | F.col(key).isNull(), salt).otherwise(0)})
    salts = F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    copies = groups.select(F.col(key).alias("key__"), F.struct(*extra).alias("group__"), F.explode(salts).alias("salt__"))
    joined = spread.join(copies, ["key__", "salt__"], how)
    return joined.select(*rows.columns, *[F.col(f"group__.{c}").alias(c) for c in extra])


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit words."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


class WordHasher(dict):
    """word (bytes) -> stable 64-bit hash, remembered up to ``limit`` words."""

    def __init__(self, limit: int = 250_000):
        super().__init__()
        import xxhash

        self.limit, self.digest = limit, xxhash.xxh3_64_intdigest

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = self[word] = self.digest(word)
        return h

    def many(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def arrow_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[list]]]:
    """Each batch with its columns as Python lists."""
    for b in batches:
        yield b, [c.to_pylist() for c in b.columns]


def batch_of(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)
