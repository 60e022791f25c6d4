"""Which requisitions and attachments a run works on, and what it keeps of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reqflow.storage import small_partitions

#: The stages of the pipeline in order.
STAGES = ("INGESTION", "EMBED_DOC_EXTRACTION", "BLOB_UPLOAD", "CLASSIFICATION", "METADATA_EXTRACTION", "EMBEDDINGS", "PRICE_BENCHMARK", "COMPLETE")
COMPLETE = 8


def pending(requisitions: DataFrame, tracker: DataFrame) -> DataFrame:
    """Requisitions without a tracker row or short of the last stage."""
    t = tracker.select("req_no", "stage_id")
    return requisitions.join(t, "req_no", "left").filter(F.col("stage_id").isNull() | (F.col("stage_id") < COMPLETE))


def oldest(df: DataFrame, n: int, *order: str) -> DataFrame:
    return df.orderBy(*order).limit(n)


def choose(requisitions: DataFrame, tracker: DataFrame, only: str | None = None, n: int | None = 10) -> DataFrame:
    """The one named requisition, or the ``n`` oldest pending ones (all without ``n``)."""
    name = (only or "").strip()
    if name:
        return requisitions.filter(F.col("req_no") == name).select("req_no")
    if n is None:
        return pending(requisitions, tracker).select("req_no")
    return oldest(pending(requisitions, tracker), n, "created_on", "req_no").select("req_no")


def attachments_with_documents(attachments: DataFrame, documents: DataFrame, left_key: str = "attachment_id", right_key: str = "attachment_id") -> DataFrame:
    small_partitions(attachments.sparkSession)
    docs = documents.withColumnRenamed(right_key, "__doc_key")
    return attachments.join(docs, F.col(left_key) == F.col("__doc_key")).drop("__doc_key")


def in_scope(df: DataFrame, scope: DataFrame | None, key: str = "req_no", how: str = "left_semi") -> DataFrame:
    """The rows whose key is in the scope, or with ``left_anti`` those whose key isn't; a scope of None is everything and takes no join."""
    if scope is None:
        return df.limit(0) if how == "left_anti" else df
    small_partitions(df.sparkSession)
    return df.join(scope.select(key), key, how)


def orphans(child: DataFrame, parent: DataFrame, foreign: str, key: str) -> DataFrame:
    """Child rows whose key isn't null and has no parent."""
    p = parent.select(F.col(key).alias(foreign)).distinct()
    return child.filter(F.col(foreign).isNotNull()).join(p, foreign, "left_anti")


def selected_items(items: DataFrame) -> DataFrame:
    return items.filter((F.col("is_selected") == 1) & (F.col("item_name") != ""))


def range_number(key: str, cuts: list) -> Column:
    """Which range a key is in: 0 up to and with the first cut, and so on; -1 without a key."""
    above = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: F.col(key) > c)) if cuts else F.lit(0)
    return F.when(F.col(key).isNull(), -1).otherwise(above)


def depth_cuts(df: DataFrame, key: str, n: int) -> list:
    """At most n - 1 keys that cut ``df`` into ranges of near equal size: approximate quantiles from a sketch of bounded size, so no global sort takes place.

    A range may hold a tenth of its share more or less, and all rows of a key are in one.  The key is a number.
    """
    found = df.approxQuantile(key, [i / n for i in range(1, n)], 0.05 / n) if n > 1 else []
    whole = df.schema[key].dataType.typeName() in ("byte", "short", "integer", "long")
    return sorted({int(c) if whole else c for c in found})


def row_slices(df: DataFrame, key: str, n: int) -> DataFrame:
    """Key ranges of ``n`` slices of near equal size: slice, lo, hi, n_rows; fewer where keys repeat.  Rows without a key are slice -1."""
    number = range_number(key, depth_cuts(df, key, n))
    return df.select(number.alias("slice"), key).groupBy("slice").agg(F.min(key).alias("lo"), F.max(key).alias("hi"), F.count("*").alias("n_rows"))


def slice_of(df: DataFrame, key: str, offset: int, n: int, *ties: str, ranges: int = 128) -> DataFrame:
    """Rows offset to offset + n - 1 in order of a number key, null first, then of ``ties``.

    Rows are counted by key range; the running counts tell which ranges hold the wanted places, and only these are read and sorted.
    """
    cuts = depth_cuts(df, key, ranges)
    counts = {r[0]: r[1] for r in df.groupBy(range_number(key, cuts)).count().collect()}  # one row per range
    before, first, last, upto = 0, None, None, 0
    for number in range(-1, len(cuts) + 1):
        start, upto = upto, upto + counts.get(number, 0)
        if first is None and upto > offset:
            first, before = number, start
        if start < offset + n:
            last = number
    if first is None or n < 1:
        return df.limit(0)
    low = None if first < 0 else F.col(key).isNotNull() if first == 0 else F.col(key) > F.lit(cuts[first - 1])
    high = F.col(key).isNull() if last < 0 else F.col(key) <= F.lit(cuts[last]) if last < len(cuts) else None
    if low is None and high is not None and last >= 0:
        high = high | F.col(key).isNull()
    part = df
    for bound in (low, high):
        part = part if bound is None else part.filter(bound)
    return part.orderBy(key, *ties).offset(offset - before).limit(n)


def top_per_key(df: DataFrame, key: str, k: int, *order) -> DataFrame:
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("rk", F.row_number().over(w)).filter(F.col("rk") <= k)
