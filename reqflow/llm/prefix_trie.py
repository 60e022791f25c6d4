"""The trie of conversations' prefixes: which turns conversations have in common, exactly.

A node is a distinct sequence of first turns (role, text); the root is the empty one.
Conversations that begin with it are its members, and the smallest member stands for it.

1. Turns become narrow rows: two 64-bit hashes of (role, text), a word count, no text.
2. They are sorted by conversation and place in ranges, so that one conversation may lie in many
   tasks.  Each task tells how its last conversation ends; from one such row per task the driver
   adds up what the next tasks begin with: places first, then sums.  A prefix' digest (128 bits) is the sum of its turns' hashes, each mixed with its
   place, so digests go on from task to task.
3. Count-min screening: prefixes are counted in a sketch of at most ``MAX_CELLS`` two-bit counters.  An estimate is never too low, so
   an estimate of one proves that a prefix has one member.  Where a turn and the turn before it
   are both proven so, the rest of the conversation is a chain of its own and
   its nodes are emitted where they are.  The sketch grows with the input up to its bound (64 MB, broadcast); beyond that it
   proves less, and more prefixes are grouped exactly: the result is the same.
4. The other prefixes are grouped by digest: members, the smallest of them, those that end.
5. What is summed over subtrees comes from the members.  Member m first differs from all smaller ones at some depth r(m):
   the nodes from there on have m as the smallest member.  A turn that n members share saves n - 1 copies of its words, so
   a subtree saves, for each member but the smallest, its words between the node and r(m);
   and a subtree has as many leaves as members that stand for a node at which all of them end.  So two more sums by digest,
   pre-aggregated before they are shuffled, give saved tokens and leaves at any depth.

Members that end at a node are hashed in order of conv_id.  SHA-256 goes from first to last, so one task reads all ids of a
node, in blocks of ``ID_BLOCK``, sorted, one block at a time.

Defined results: a null role or text is empty; turns come in order, null first, and equal turns in order of a fixed hash of role and
text; rows without conv_id belong to no conversation and are left out; repeated rows are turns; long
texts are read whole; an empty table has no nodes (a root without members is none); extra columns, whatever their names, are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reqflow.llm.common import attach_groups, hot_keys, mix64, saved, small_batches

WORD = r"[^\x20\x09-\x0D]+"
#: Counters of the sketch: at most this many, of two bits; and how many a prefix adds to.
MAX_CELLS = 1 << 28
PROBES = 4
#: Counters for each turn, below the bound; counters that one task adds up.
CELLS_PER_TURN = 16
BLOCK_CELLS = 1 << 22
#: Conversations' ids are hashed in blocks of so many.
ID_BLOCK = 4096
ROOT = bytes(16)
_EMPTY_SHA = hashlib.sha256(b"").hexdigest()
_SORTED = ("conv_id", "part", "turn", "a", "b", "u")
_G1, _G2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def turn_rows(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, turn, a, b (hashes of role and text), words, u (a number of the row), written once."""
    r, t = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    rows = turns.filter(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"),
        F.xxhash64(r, t).alias("a"), F.xxhash64(F.lit(7), t, r).alias("b"),
        F.regexp_count(t, F.lit(WORD)).cast("long").alias("words"), F.monotonically_increasing_id().alias("u"),
    )
    return saved(rows)


def with_shared_beginnings(rows: DataFrame, group: int = 20, most: int = 3) -> DataFrame:
    """:func:`turn_rows` rebuilt: conv_id c begins with the first h turns of c - c % group, then has its own after its first h.

    h is the unsigned CRC-32 of the decimal c modulo ``most`` + 1.  Adds part: 0 for lent turns, 1 for own ones.
    """
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most + 1))
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "a", "b", "u"))
    heads = saved(rows.withColumn("k", place).filter(F.col("k") <= most))
    own = rows.join(heads.filter(F.col("k") <= h).select("u"), "u", "left_anti")
    ids = rows.select("conv_id").distinct()
    ids = ids.withColumn("base", F.col("conv_id") - F.col("conv_id") % group)
    lent = heads.drop("u").withColumnRenamed("conv_id", "base").join(ids, "base").filter(F.col("k") <= h)
    kind = rows.schema["turn"].dataType
    lent = lent.select("conv_id", F.lit(0).alias("part"), F.col("k").cast(kind).alias("turn"), "a", "b", "words", F.col("k").cast("long").alias("u"))
    return own.select("conv_id", F.lit(1).alias("part"), "turn", "a", "b", "words", "u").unionByName(lent)


def _walk(batches: Iterator[pa.RecordBatch], place: int, conv) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """Each batch of sorted rows with conv_id, each turn's place and whether it begins a conversation; ``place`` turns of ``conv`` came before."""
    for b in batches:
        if not b.num_rows:
            continue
        ids = b.column(0).to_numpy()
        begins = np.concatenate(([ids[0] != conv], ids[1:] != ids[:-1]))
        n = np.arange(1, len(ids) + 1)
        since = np.where(begins, n - 1, 0)
        since[0] = since[0] if begins[0] else -place
        places = n - np.maximum.accumulate(np.where(begins | (n == 1), since, -(1 << 62)))
        conv, place = ids[-1], int(places[-1])
        yield b, ids, places, begins


def _sums(terms: np.ndarray, begins: np.ndarray, before) -> np.ndarray:
    """Running sums that start anew where a conversation begins; ``before`` came first."""
    total = np.cumsum(terms, dtype=terms.dtype)
    base = total - terms
    start = np.maximum.accumulate(np.where(begins, np.arange(len(terms)), -1))
    return total - np.where(start < 0, terms.dtype.type(0), base[start]) + np.where(start < 0, before, terms.dtype.type(0))


class _Tail:
    """What comes before a task's rows: the last conversation, its turns, the sums over them, and the next task's first conversation."""

    def __init__(self, conv=None, place: int = 0, a: int = 0, b: int = 0, words: int = 0, next_conv=None):
        self.conv, self.place, self.a, self.b, self.words, self.next_conv = conv, place, a, b, words, next_conv


def _digests(batches: Iterator[pa.RecordBatch], tail: _Tail) -> Iterator[tuple]:
    """ids, places, begins, digest sums a and b, words and words so far of each batch."""
    a, b, w = np.uint64(tail.a), np.uint64(tail.b), np.int64(tail.words)
    for batch, ids, places, begins in _walk(batches, tail.place, tail.conv):
        at = places.astype(np.uint64)
        x, y = (batch.column(i).to_numpy().view(np.uint64) for i in (1, 2))
        words = batch.column(3).to_numpy()
        sa = _sums(mix64(mix64(x + at * _G1) + y), begins, a)
        sb = _sums(mix64(mix64(y + at * _G2) ^ x), begins, b)
        sw = _sums(words, begins, w)
        yield ids, places, begins, sa, sb, words, sw
        a, b, w = sa[-1], sb[-1], sw[-1]


def _binary16(hi: np.ndarray, lo: np.ndarray) -> pa.Array:
    raw = np.empty((len(hi), 2), np.uint64)
    raw[:, 0], raw[:, 1] = hi, lo
    return pa.Array.from_buffers(pa.binary(), len(hi), [None, pa.py_buffer(np.arange(0, 16 * len(hi) + 1, 16, dtype=np.int32)), pa.py_buffer(raw)])


def _tails(ordered: DataFrame) -> dict[int, _Tail]:
    """What comes before each task of sorted rows: from one row per task, twice, places and then sums."""
    from pyspark import TaskContext

    spark = ordered.sparkSession
    narrow = ordered.select("conv_id", "a", "b", "words")

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = None
        n = 0
        for _, ids, place, _ in _walk(batches, 0, None):
            first, last, n = (int(ids[0]) if first is None else first), int(ids[-1]), int(place[-1])
        if first is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (TaskContext.get().partitionId(), first, last, n)], names=["task", "first", "last", "n"])

    told = sorted(tuple(r) for r in narrow.mapInArrow(places, "task long, first long, last long, n long").collect())
    tails: dict[int, _Tail] = {}
    conv, n = None, 0
    for task, first, last, own in told:
        tails[task] = _Tail(conv, n)
        n = own + (n if first == last == conv else 0)
        conv = last
    for (task, *_), (_, first, _, _) in zip(told, told[1:], strict=False):
        tails[task].next_conv = first
    held = spark.sparkContext.broadcast(tails)

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        end = None
        if task in held.value:
            for ids, _, _, a, b, _, w in _digests(batches, held.value[task]):
                end = (task, a[-1].view(np.int64), b[-1].view(np.int64), w[-1])
        if end is not None:
            yield pa.RecordBatch.from_arrays([pa.array([int(x)], pa.int64()) for x in end], names=["task", "a", "b", "w"])

    sums = {r[0]: r[1:] for r in narrow.mapInArrow(ends, "task long, a long, b long, w long").collect()}
    a = b = w = 0
    conv = None
    for task, first, last, _ in told:
        tails[task].a, tails[task].b, tails[task].words = a, b, w
        add = first == last == conv
        x, y, z = sums[task]
        a, b, w = (x % 2**64 + add * a) % 2**64, (y % 2**64 + add * b) % 2**64, z + add * w
        conv = last
    return tails


def _cells(a: np.ndarray, b: np.ndarray, cells: int) -> np.ndarray:
    """(PROBES, n) counters of prefixes; each row of counters has its own part."""
    per = np.uint64(cells // PROBES)
    return np.stack([(mix64(a + np.uint64(i) * _G2) ^ b) % per + np.uint64(i) * per for i in range(PROBES)])


def _sketch(narrow: DataFrame, tails, cells: int) -> np.ndarray:
    """Two-bit counters (0, 1, 2 or more) of all prefixes, four to a byte."""
    from pyspark import TaskContext

    block = min(BLOCK_CELLS, cells)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, _, a, b, _, _ in _digests(batches, tails.value.get(TaskContext.get().partitionId(), _Tail())):
            # Twice is as much as a counter holds.
            cell, n = np.unique(_cells(a, b, cells), return_counts=True)
            cell = np.repeat(cell, np.minimum(n, 2))
            number = (cell // np.uint64(block)).astype(np.int64)
            cut = np.flatnonzero(np.concatenate(([True], number[1:] != number[:-1])))
            parts = [pa.scalar(x.astype(np.uint32).tobytes(), pa.binary()) for x in np.split(cell % np.uint64(block), cut[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(number[cut]), pa.array([p.as_py() for p in parts], pa.binary())], names=["block", "cells"])

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(block, np.uint8)
        for b in batches:
            for part in b.column(1).to_pylist():
                cell, n = np.unique(np.frombuffer(part, np.uint32), return_counts=True)
                held[cell] = np.minimum(held[cell] + np.minimum(n, 2), 2).astype(np.uint8)
        four = held.reshape(-1, 4)
        packed = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()]), pa.array([packed.tobytes()], pa.binary())], names=["block", "packed"])

    out = np.zeros(cells // 4, np.uint8)
    found = narrow.mapInArrow(count, "block long, cells binary").groupBy("block").applyInArrow(add, "block long, packed binary")
    for r in found.toLocalIterator():  # MAX_CELLS / 4 bytes in all
        out[r.block * block // 4 : (r.block + 1) * block // 4] = np.frombuffer(r.packed, np.uint8)
    return out


def _single(sketch: np.ndarray, a: np.ndarray, b: np.ndarray, cells: int) -> np.ndarray:
    """Prefixes that are proven to have one member."""
    at = _cells(a, b, cells)
    return ((sketch[(at >> np.uint64(2)).astype(np.int64)] >> ((at & np.uint64(3)) * np.uint64(2)).astype(np.uint8)) & 3).min(axis=0) <= 1


def prefix_rows(rows: DataFrame, max_cells: int = MAX_CELLS) -> DataFrame:
    """conv_id, depth, node, parent (digests), words, upto (words up to and with this turn), last, alone: one row per turn.

    ``alone``: this prefix and the one before it are proven to have one member.  ``rows``: conv_id, a, b, words, in the
    order of part, turn, a, b, u.
    """
    from pyspark import TaskContext

    small_batches(rows.sparkSession)
    rows = saved(rows.select(*_SORTED, "words"))
    ranges = rows.repartitionByRange(F.col("conv_id"), F.col("part"), F.col("turn").asc_nulls_first(), "a", "b", "u")
    # Written with its partitions, which every later pass finds as they are.
    ordered = saved(ranges.sortWithinPartitions("conv_id", "part", F.col("turn").asc_nulls_first(), "a", "b", "u").select("conv_id", "a", "b", "words"))
    tails = rows.sparkSession.sparkContext.broadcast(_tails(ordered))
    cells = 4096
    n = rows.count()
    while cells < min(max_cells, n * CELLS_PER_TURN):
        cells *= 2
    sketch = rows.sparkSession.sparkContext.broadcast(_sketch(ordered, tails, cells))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail = tails.value.get(TaskContext.get().partitionId(), _Tail())
        before = (np.uint64(tail.a), np.uint64(tail.b))
        proven = bool(tail.place) and bool(_single(sketch.value, np.array([tail.a], np.uint64), np.array([tail.b], np.uint64), cells)[0])
        held = None
        for ids, places, begins, a, b, words, upto in _digests(batches, tail):
            single = _single(sketch.value, a, b, cells)
            pa_, pb = (np.where(begins, np.uint64(0), np.concatenate(([x], s[:-1]))) for x, s in zip(before, (a, b), strict=True))
            alone = single & ~begins & np.concatenate(([proven], single[:-1]))
            if held is not None:
                yield held(int(ids[0]))
            own = [pa.array(ids), pa.array(places), _binary16(a, b), _binary16(pa_, pb), pa.array(words), pa.array(upto), pa.array(alone)]

            def held(following, ids=ids, own=own):
                last = np.concatenate((ids[1:] != ids[:-1], [following is None or ids[-1] != following]))
                return pa.RecordBatch.from_arrays([*own, pa.array(last)], names=["conv_id", "depth", "node", "parent", "words", "upto", "alone", "last"])

            before, proven = (a[-1], b[-1]), bool(single[-1])
        if held is not None:
            yield held(tail.next_conv)

    return saved(ordered.mapInArrow(run, "conv_id long, depth long, node binary, parent binary, words long, upto long, alone boolean, last boolean"))


def _ends_sha256(ends: DataFrame) -> DataFrame:
    """node, ends_sha256 of node, conv_id: ids in order, joined by commas, hashed block by block."""
    block = F.floor(F.col("conv_id") / ID_BLOCK).cast("long")
    text = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",")
    blocks = ends.select("node", block.alias("block"), "conv_id").groupBy("node", "block").agg(text.alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for b in batches:
                yield from zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)

        out: tuple[list, list] = ([], [])
        for node, parts in groupby(rows(), itemgetter(0)):
            sha, comma = hashlib.sha256(), b""
            for _, ids in parts:
                sha.update(comma + ids.encode())
                comma = b","
            out[0].append(node)
            out[1].append(sha.hexdigest())
            if len(out[0]) == 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.binary()), pa.array(out[1])], names=["node", "ends_sha256"])
                out = ([], [])
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.binary()), pa.array(out[1], pa.string())], names=["node", "ends_sha256"])

    return blocks.repartition("node").sortWithinPartitions("node", "block").select("node", "ids").mapInArrow(run, "node binary, ends_sha256 string")


def prefix_trie(rows: DataFrame, members: DataFrame, max_cells: int = MAX_CELLS) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``rows``: conv_id, part, turn, a, b, u, words (see :func:`turn_rows`, :func:`with_shared_beginnings`); ``members``: the conv_id of all
    conversations, those without turns included.
    """
    prefixes = prefix_rows(rows, max_cells)
    spoken = prefixes.filter("depth = 1").select("conv_id")
    root = members.join(spoken.withColumn("some", F.lit(True)), "conv_id", "left").select(
        "conv_id", F.lit(0).cast("long").alias("depth"), F.lit(ROOT).alias("node"), F.lit(None).cast("binary").alias("parent"),
        F.lit(0).cast("long").alias("words"), F.lit(0).cast("long").alias("upto"), F.lit(False).alias("alone"), F.col("some").isNull().alias("last"),
    )
    shared = saved(prefixes.filter("not alone").unionByName(root))

    # Every node that isn't proven to be alone, exactly.
    nodes = shared.groupBy("node").agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("parent").alias("parent"),
        F.min(F.col("upto") - F.col("words")).alias("above"), F.count_if("last").alias("n_ends"),
    )
    nodes = saved(nodes)

    # For each conversation: words before the first node that it stands for, and whether it stands for a leaf.
    stands = nodes.groupBy("conv_id").agg(F.min("above").alias("above"), F.bool_or(F.col("n_ends") == F.col("n_convs")).alias("leaf"))
    ended = shared.groupBy("conv_id").agg(F.max(F.when(F.col("last"), F.col("upto"))).alias("total"))
    convs = ended.join(stands, "conv_id", "left").select(
        "conv_id", F.coalesce("above", "total").alias("common"), (F.col("total").isNull() | F.coalesce("leaf", F.lit(False))).cast("long").alias("leaf")
    )
    turns = shared.groupBy("conv_id").agg(F.count("*").alias("c"))
    of_member = attach_groups(shared.select("conv_id", "node"), saved(convs), "conv_id", None, "inner", hot_keys(turns, "conv_id", "c", shared.count))
    sums = of_member.groupBy("node").agg(F.sum("common").alias("common"), F.min_by("common", "conv_id").alias("least"), F.sum("leaf").alias("n_leaves"))

    children = nodes.filter("parent is not null").groupBy("parent").agg(F.count("*").alias("n_children"))
    children = saved(children.select(F.col("parent").alias("node"), "n_children"))
    told = nodes.join(sums, "node").join(children, "node", "left").join(_ends_sha256(shared.filter("last").select("node", "conv_id")), "node", "left")
    one = F.col("n_convs") == 1
    told = told.select(
        "conv_id", "depth", "node", "parent", "n_convs",
        # The only child of a node with one member may have been emitted as alone.
        F.when(one, 1 - F.col("n_ends")).otherwise(F.coalesce("n_children", F.lit(0))).cast("long").alias("n_children"), "n_leaves",
        (F.col("common") - F.col("least") - (F.col("n_convs") - 1) * F.col("above")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(_EMPTY_SHA)).alias("ends_sha256"),
    )
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    hot = hot_keys(children, "node", "n_children", nodes.count)
    exact = attach_groups(told, parents, "parent", None, "left", hot)
    # A parent that isn't among the nodes was proven to be alone: it has the same member.
    parent = F.when(F.col("parent").isNull(), F.lit(None)).otherwise(F.coalesce("parent_conv_id", "conv_id"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    exact = exact.withColumn("parent_conv_id", parent).select(*columns)
    n = lambda x: F.lit(x).cast("long")
    own = F.when(F.col("last"), F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)).otherwise(_EMPTY_SHA)
    chains = prefixes.filter("alone").select(
        "conv_id", "depth", F.col("conv_id").alias("parent_conv_id"), n(1).alias("n_convs"), F.when(F.col("last"), n(0)).otherwise(n(1)).alias("n_children"),
        n(1).alias("n_leaves"), n(0).alias("saved_tokens"), own.alias("ends_sha256"),
    )
    return exact.unionByName(chains)


def op11_prefix_trie(spark, sf_dir):
    from reqflow.llm.common import read_table

    rows = turn_rows(read_table(spark, sf_dir, "conversations"))
    return prefix_trie(with_shared_beginnings(rows), rows.select("conv_id").distinct())
