"""Exact deduplication by content-defined chunk recipes.

A text is cut where a hash of its last eight bytes says so, so equal passages
give equal chunks wherever they stand.  A chunk's identifier is a 64-bit hash
and its length; a document's recipe is the ordered list of its identifiers, and
documents with equal recipes are equal once the identifiers are verified: the
bytes of the chunks of documents whose recipes occur more than once are brought
together by identifier, once per distinct chunk and task, and must be the same.
If an identifier ever stands for two byte strings, the work is repeated with
SHA-256 identifiers.  Only such chunks move; long documents as such never do.

Texts are compared after lower-casing A-Z.

Defined results: null counts as empty, and all empty texts are equal; of equal
texts the row with the largest doc_id stays (null ids are smallest; of rows that
repeat an id, the first in order of files and places); an empty table gives an empty table; extra
columns, whatever their names, are passed through by :func:`drop_copies` and not
read otherwise.  The input is read more than once, by keys that don't depend on how it
is split (see :func:`reqflow.llm.common.keyed_rows`).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reqflow.llm.common import ascii_lower, attach_groups, columns_of, keyed_rows, saved

MIN_CHUNK, MAX_CHUNK, AVERAGE_BITS = 512, 16_384, 11
#: Bits of the filter that says whose chunks need verifying: per recipe that occurs more than once, and at most.
#: Beyond the bound it is fuller and more chunks are moved; the result is the same.
BITS_PER_RECIPE, MAX_FILTER_BITS = 16, 1 << 30
#: Dropped rows are broadcast up to this many (8 bytes each), joined by shuffle beyond.
MAX_BROADCAST_ROWS = 1_000_000


def cut(text: bytes) -> list[bytes]:
    """The chunks of a text, in order; none for an empty one."""
    n = len(text)
    if n <= MIN_CHUNK:
        return [text] if n else []
    x = np.frombuffer(text, np.uint8).astype(np.uint64)
    for shift in (1, 2, 4):  # eight bytes per window, by doubling
        x = x[:-shift] | (x[shift:] << np.uint64(8 * shift))
    marks = np.flatnonzero((x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - AVERAGE_BITS) == 0) + 8
    out, start = [], 0
    for end in [*marks.tolist(), n]:
        while end - start > MAX_CHUNK:
            out.append(text[start : start + MAX_CHUNK])
            start += MAX_CHUNK
        if end - start >= MIN_CHUNK or end == n and end > start:
            out.append(text[start:end])
            start = end
    return out


def _identifier(strong: bool, bits: int):
    if strong:
        return lambda c: hashlib.sha256(c).digest() + len(c).to_bytes(8, "big")
    mask = (1 << bits) - 1
    return lambda c: (xxhash.xxh3_64_intdigest(c) & mask).to_bytes(8, "big") + len(c).to_bytes(8, "big")


def _recipes(docs: DataFrame, strong: bool, bits: int) -> DataFrame:
    """rk, doc_id, text_sha256, recipe, recipe_hash per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = _identifier(strong, bits)
        for b in batches:
            texts = b.column(1).to_pylist()
            recipes = [b"".join(map(name, cut(t))) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column(2), b.column(0), pa.array([hashlib.sha256(t).hexdigest() for t in texts]), pa.array(recipes, pa.binary()),
                 pa.array([xxhash.xxh3_64_intdigest(r) >> 1 for r in recipes], pa.int64())],
                names=["rk", "doc_id", "text_sha256", "recipe", "recipe_hash"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"rk long, doc_id {kind}, text_sha256 string, recipe binary, recipe_hash long")


def _ambiguous(docs: DataFrame, shared: DataFrame, strong: bool, bits: int) -> DataFrame:
    """Identifiers that stand for more than one byte string among documents with shared recipes."""
    size = min(MAX_FILTER_BITS, 64 << max(0, (shared.count() * BITS_PER_RECIPE // 64).bit_length()))
    slots = shared.select((F.col("recipe_hash") % size).alias("slot"))
    words = slots.select((F.col("slot") / 64).cast("int").alias("word"), F.expr("shiftleft(1L, cast(slot % 64 as int))").alias("bit"))
    table = np.zeros(size // 64, np.uint64)
    for part in words.groupBy("word").agg(F.bit_or("bit").alias("bit")).toLocalIterator():  # at most size / 64 rows
        table[part.word] = np.uint64(part.bit & 0xFFFFFFFFFFFFFFFF)
    held = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, bit_of, sent = _identifier(strong, bits), held.value, set()
        for b in batches:
            ids, chunks = [], []
            for t in b.column(1).to_pylist():
                parts = cut(t)
                slot = (xxhash.xxh3_64_intdigest(b"".join(map(name, parts))) >> 1) % size
                if not int(bit_of[slot // 64]) >> (slot % 64) & 1:
                    continue
                for c in parts:
                    digest = hashlib.blake2b(c, digest_size=16).digest()
                    if digest not in sent:  # bytes that this task has sent already
                        if len(sent) >= 1_000_000:
                            sent.clear()
                        sent.add(digest)
                        ids.append(name(c))
                        chunks.append(c)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), pa.array(chunks, pa.binary())], names=["id", "chunk"])

    chunks = docs.mapInArrow(run, "id binary, chunk binary").distinct()
    return chunks.groupBy("id").count().filter("count > 1")


def chunk_recipes(rows: DataFrame, doc_id: str = "doc_id", text: str = "text", bits: int = 64) -> DataFrame:
    """rk, doc_id, text_sha256, recipe, with verified identifiers, of keyed rows; ``bits`` shortens the hash in tests."""
    narrow = columns_of(rows, lambda c: c(doc_id).alias("doc_id"), lambda c: ascii_lower(c(text)).cast("binary").alias("text"))
    for strong in (False, True):
        recipes = saved(_recipes(narrow, strong, bits))
        shared = saved(recipes.groupBy("recipe", "recipe_hash").count().filter("count > 1").select("recipe_hash"))
        if strong or _ambiguous(narrow, shared, strong, bits).isEmpty():
            break
    return recipes.drop("recipe_hash")


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bits: int = 64) -> DataFrame:
    """rk, doc_id, keep_id, group_size, kept, text_sha256: one row per input row."""
    return groups_of(keyed_rows(docs), doc_id, text, bits)


def groups_of(rows: DataFrame, doc_id: str, text: str, bits: int = 64) -> DataFrame:
    """:func:`exact_groups` of keyed rows."""
    rows = chunk_recipes(rows, doc_id, text, bits)
    best = F.max(F.struct(F.col("doc_id"), (-F.col("rk")).alias("neg")))
    groups = rows.groupBy("recipe").agg(F.count("*").alias("group_size"), best.alias("best")).filter("group_size > 1")
    groups = saved(groups.select("recipe", "group_size", F.col("best.doc_id").alias("keep_id"), (-F.col("best.neg")).alias("keep_rk")))
    out = attach_groups(rows, groups, "recipe", "group_size")
    alone = F.col("group_size").isNull()
    return out.select(
        "rk",
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("rk") == F.col("keep_rk"))).alias("kept"),
        "text_sha256",
    )


def drop_rows(rows: DataFrame, dropped: DataFrame) -> DataFrame:
    """The documents of keyed rows whose key isn't in ``dropped.rk``; all columns kept."""
    few = dropped.limit(MAX_BROADCAST_ROWS + 1).count() <= MAX_BROADCAST_ROWS
    return rows.join(F.broadcast(dropped) if few else dropped, "rk", "left_anti").select("row.*")


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, with all their columns."""
    rows = keyed_rows(docs)
    return drop_rows(rows, saved(groups_of(rows, doc_id, text).filter("not kept").select("rk")))


def op9_exact_dedup(spark, sf_dir):
    from reqflow.llm.common import read_table

    return exact_groups(read_table(spark, sf_dir, "documents")).drop("rk")


OP9_SQL = """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY norm) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY norm) AS kept,
       sha256(norm) AS text_sha256
FROM t
"""
