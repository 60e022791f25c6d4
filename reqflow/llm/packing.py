"""Conflict-constrained best-fit packing of documents into training sequences.

A document of ``n`` words takes ``n + 1`` tokens (one ends it).  It is cut into
pieces of at most ``capacity`` tokens, and pieces go into bins of that capacity
so that no bin holds two pieces of one source or of one duplicate cluster.

Pieces are dealt by hash into shards of bounded size, whose number follows the
input.  Within a shard, pieces are placed longest first.  Open bins are ordered
by what is left in them; each carries a bitmap of its sources and one of its
clusters.  From the tightest bin that a piece fits in, the search goes on to the
next until one has no conflict; a bitmap's hit is confirmed on the bin's
own sets, so a chance collision never turns a compatible bin away.

Defined results: null and empty texts take one token; long texts are cut, never
shortened; a null source is a source of its own, and in a table without that column every doc_id is one; rows that repeat an id are
packed each for itself and numbered by ``copy``; ties go by doc_id (nulls last), then by
piece; an empty table gives an empty table; extra columns are never read.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reqflow.llm.common import ascii_lower, saved

CAPACITY = 2048
#: Pieces per shard, on average: the bound on what one task packs at once.
SHARD_PIECES = 4096
_BITS = 256
WORD = r"[^\x20\x09-\x0D]+"


def best_fit(sizes: list[int], sources: list[int], clusters: list[int], capacity: int) -> list[int]:
    """The bin of each piece; pieces are placed in the order given."""
    open_bins: list[tuple[int, int]] = []  # (room, bin), ordered
    source_bits: list[int] = []
    cluster_bits: list[int] = []
    held: list[tuple[set[int], set[int]]] = []
    out = []
    for size, source, cluster in zip(sizes, sources, clusters, strict=True):
        s_bit, c_bit = 1 << source % _BITS, 1 << cluster % _BITS
        i, found = bisect_left(open_bins, (size, -1)), -1
        while i < len(open_bins):
            b = open_bins[i][1]
            if not (source_bits[b] & s_bit and source in held[b][0] or cluster_bits[b] & c_bit and cluster in held[b][1]):
                found = b
                break
            i += 1
        if found < 0:
            found, room = len(held), capacity
            source_bits.append(0)
            cluster_bits.append(0)
            held.append((set(), set()))
        else:
            room = open_bins.pop(i)[0]
        source_bits[found] |= s_bit
        cluster_bits[found] |= c_bit
        held[found][0].add(source)
        held[found][1].add(cluster)
        if room > size:
            insort(open_bins, (room - size, found))
        out.append(found)
    return out


def pack_pieces(pieces: DataFrame, capacity: int) -> DataFrame:
    """Adds bin_id to rows of doc_id, copy, piece, n_tokens, source_code, cluster_code, shard."""

    def run(table: pa.Table) -> pa.Table:
        col = {n: table.column(n).to_pylist() for n in table.column_names}
        keys = list(zip([-n for n in col["n_tokens"]], [d is None for d in col["doc_id"]], [0 if d is None else d for d in col["doc_id"]], *[col[c] for c in ("source_code", "cluster_code", "copy", "piece")], strict=True))
        order = sorted(range(len(keys)), key=keys.__getitem__)
        bins = best_fit(*[[col[c][i] for i in order] for c in ("n_tokens", "source_code", "cluster_code")], capacity)
        table = table.take(pa.array(order))
        ids = [s << 24 | b for s, b in zip(table.column("shard").to_pylist(), bins, strict=True)]
        return table.select(out).append_column("bin_id", pa.array(ids, pa.int64()))

    kinds = {f.name: f.dataType.simpleString() for f in pieces.schema}
    out = [c for c in pieces.columns if c not in ("source_code", "cluster_code", "shard")]
    return pieces.groupBy("shard").applyInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in out) + ", bin_id long")


def pack_documents(
    docs: DataFrame,
    capacity: int = CAPACITY,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    length: Column | None = None,
    cluster: Column | None = None,
) -> DataFrame:
    """doc_id, copy, piece, n_pieces, start_token, n_tokens, bin_id: one row per piece.

    ``length`` (default: words + 1) and ``cluster`` (default: the text after
    lower-casing A-Z) may be any columns of ``docs``.
    """
    if length is None:
        length = F.regexp_count(F.coalesce(F.col(text).cast("string"), F.lit("")), F.lit(WORD)) + 1
    if cluster is None:
        cluster = F.sha2(ascii_lower(F.col(text)), 256)
    origin = F.col(source if source in docs.columns else doc_id).cast("string")
    items = docs.select(
        F.col(doc_id).alias("doc_id"),
        length.cast("long").alias("length"),
        F.xxhash64(origin, origin.isNull()).alias("source_code"),
        F.xxhash64(cluster, cluster.isNull()).alias("cluster_code"),
    )
    # Rows that are alike in all this are counted, then numbered: no key depends on the order of reading.
    items = saved(items.groupBy(*items.columns).count().withColumn("n_pieces", F.ceil(F.col("length") / capacity)))
    total = items.agg(F.sum(F.col("count") * F.col("n_pieces"))).first()[0] or 0
    shards = max(1, -(-int(total) // SHARD_PIECES))
    pieces = (
        items.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("count"))))
        .withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_pieces") - 1)))
        .withColumn("start_token", F.col("piece") * capacity)
        .withColumn("n_tokens", F.least(F.lit(capacity).cast("long"), F.col("length") - F.col("start_token")))
        .withColumn("shard", F.pmod(F.xxhash64("doc_id", "source_code", "cluster_code", "length", "copy", "piece"), F.lit(shards)))
        .select("doc_id", "copy", "piece", "n_pieces", "start_token", "n_tokens", "source_code", "cluster_code", "shard")
    )
    return pack_pieces(pieces, capacity)


def op1_best_fit_packing(spark, sf_dir):
    from reqflow.llm.common import read_table

    return pack_documents(read_table(spark, sf_dir, "documents"))
