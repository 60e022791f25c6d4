"""Near-duplicate groups by SetSketch registers, exact on full shingle sets.

A text's set holds its distinct shingles (64-bit hashes of runs of words).  Two
texts are linked if their sets' Jaccard similarity reaches the threshold.

1. Texts with equal sets become one node, so copies cost nothing further on.
2. A node's sketch has ``M`` registers: the exponent, in base ``B``, of the least
   of exponentially distributed hashes of its shingles.  Equal registers have
   about the probability of the sets' similarity; ``ROWS`` of them make a band key.
   A pair at similarity 0.8 shares none of the 24 bands with probability 3e-6.
3. Nodes that share a band are candidates.  In each band bucket they are compared
   to its hub, the member with most company over all buckets.  Members of a hub that are still in
   different components are then compared across components, without listing a family's
   pairs: two sets that are linked share one of their rarest shingles.  Shingles that no other of
   these nodes has come first and can't be shared; with the sizes they bound what two sets may have in common
   and so which sizes a partner may have.  Nodes meet by (shingle, size band) where the shingle is among the
   larger set's first ones for that band and among the smaller set's first ones for any larger partner;
   of nodes in the component that has most nodes at that meeting point, only those of others are compared.
   So no link between components is left out, and a group of near copies costs a comparison or two per
   member, not all pairs.
4. All pairs are dropped if the joint likelihood of their sketches at any similarity from the
   threshold up is ``exp(-MAX_LOG_ODDS)`` of its maximum or less; the rest are confirmed on the
   full sets.

Components come from alternating large-star and small-star steps on the links, until those left fit one task.

Defined results: null, empty and wordless texts have no shingles, are linked with
nothing and are their own component; texts shorter than a shingle are one shingle;
long texts are read whole; equal ids and repeated rows are separate documents of
one component, of which one row is kept; a null doc_id is larger than any other;
an empty table gives an empty table; extra columns, whatever their names, are passed
through by :func:`drop_near_copies` and not read otherwise.  The input is read more
than once, by keys that don't depend on how it is split (see :func:`reqflow.llm.common.keyed_rows`).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reqflow.llm.common import SALTS, WordHasher, ascii_lower, attach_groups, columns_of, hot_keys, keyed_rows, mix64, saved
from reqflow.llm.exact_dedup import MAX_BROADCAST_ROWS, drop_rows

M, ROWS = 96, 4
#: Register base and rate of the exponential hashes; registers fit 16 bits.
B, RATE = 1.001, 20.0
MAX_LOG_ODDS = 10.0
MANY_EDGES = 1_000_000
#: So many links are joined in one task: some 32 MB of them.
LINKS_IN_ONE_TASK = 2_000_000
#: Sizes in one band differ by less than this factor; counters by which shingles are ordered (only speed depends on them).
BAND = 1.05
MOST_COUNTERS = 1 << 18
_SEEDS = mix64(np.arange(1, M + 1, dtype=np.uint64)) | np.uint64(1)
_BAND = mix64(np.arange(101, 101 + M // ROWS, dtype=np.uint64))
_PLACE = mix64(np.arange(1001, 1017, dtype=np.uint64)) | np.uint64(1)

_hasher = WordHasher()


def shingle_set(text: bytes, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    words = text.split()
    if not words:
        return np.zeros(0, np.uint64)
    h = _hasher.many(words)
    n = min(width, len(words))
    acc = np.full(len(words) - n + 1, np.uint64(n))
    for j in range(n):
        acc = mix64(acc + h[j : len(h) - n + 1 + j] * _PLACE[j % 16] + np.uint64(j))
    return np.unique(acc)


def registers(shingles: np.ndarray) -> np.ndarray:
    """SetSketch registers of a set that isn't empty."""
    least = np.full(M, np.iinfo(np.uint64).max, np.uint64)
    for lo in range(0, len(shingles), 8192):
        least = np.minimum(least, (shingles[lo : lo + 8192] * _SEEDS[:, None]).min(axis=1))
    x = -np.log1p(-np.minimum((least.astype(np.float64) + 1.0) / 2.0**64, 1 - 2.0**-53)) / RATE
    return np.clip(np.floor(1.0 - np.log(x) / np.log(B)), 0, 65535).astype(np.uint16)


def band_keys(regs: np.ndarray) -> np.ndarray:
    acc = _BAND.copy()
    for part in regs.reshape(-1, ROWS).T:
        acc = mix64(acc ^ (part.astype(np.uint64) + np.uint64(1)))
    return acc.view(np.int64)


def _p(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-np.clip(x, 0, 1) * (B - 1) / B) / np.log(B)


def may_reach(ra: np.ndarray, rb: np.ndarray, na: np.ndarray, nb: np.ndarray, threshold: float) -> np.ndarray:
    """Whether the sketches leave room for a similarity of ``threshold``: a joint likelihood test.

    ``ra``, ``rb`` are (pairs, M) registers; ``na``, ``nb`` the known set sizes.
    """
    u = (na / (na + nb))[:, None]
    v = 1.0 - u
    more = (ra > rb).sum(axis=1)[:, None]
    less = (ra < rb).sum(axis=1)[:, None]
    same = ra.shape[1] - more - less
    most = np.minimum(u / v, v / u)

    def loglik(j: np.ndarray) -> np.ndarray:
        up, down = np.maximum(_p(u - v * j), 1e-12), np.maximum(_p(v - u * j), 1e-12)
        return more * np.log(up) + less * np.log(down) + same * np.log(np.maximum(1 - up - down, 1e-12))

    grid = np.linspace(0.0, 1.0, 51)[None, :]
    free = loglik(most * grid).max(axis=1)
    high = loglik(threshold + (np.maximum(most, threshold) - threshold) * grid).max(axis=1)
    return (most[:, 0] >= threshold - 1e-9) & (high >= free - MAX_LOG_ODDS)


def sketch_documents(rows: DataFrame, width: int) -> DataFrame:
    """rk, doc_id, n_shingles, digest of the set, registers, bands (null for empty sets)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, digests, regs, bands = [], [], [], []
            for t in b.column(1).to_pylist():
                s = shingle_set(t, width)
                n.append(len(s))
                r = registers(s) if len(s) else None
                digests.append(None if r is None else hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest())
                regs.append(None if r is None else r.tobytes())
                bands.append(None if r is None else band_keys(r))
            yield pa.RecordBatch.from_arrays(
                [b.column(2), b.column(0), pa.array(n, pa.int64()), pa.array(digests, pa.string()), pa.array(regs, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                names=["rk", "doc_id", "n_shingles", "digest", "regs", "bands"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"rk long, doc_id {kind}, n_shingles long, digest string, regs binary, bands array<long>")


def smallest_labels(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of the links u-v and the smallest node of each one's component."""
    nodes, ends = np.unique(np.concatenate((u, v)), return_inverse=True)
    u, v = ends[: len(u)], ends[len(u) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, label[u], low)
        np.minimum.at(new, label[v], low)
        while True:  # labels of labels, to the end
            next_ = new[new]
            if (next_ == new).all():
                break
            new = next_
        if (new == label).all():
            return nodes, nodes[label]
        label = new


def _in_one_task(edges: DataFrame) -> DataFrame:
    """:func:`components` of few links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
        if held:
            nodes, low = smallest_labels(*(np.concatenate(x) for x in zip(*held, strict=True)))
            rest = nodes != low
            for lo in range(0, int(rest.sum()), 100_000):
                part = slice(lo, lo + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array(nodes[rest][part]), pa.array(low[rest][part])], names=["u", "v"])

    return saved(edges.coalesce(1).mapInArrow(run, "u long, v long"))


def components(links: DataFrame, most: int = LINKS_IN_ONE_TASK) -> DataFrame:
    """u, v: each node of the links that isn't its component's smallest, and that smallest.

    Up to ``most`` links are joined in one task (16 bytes each); more of them in rounds of joins until they are few, or all is joined.
    """
    edges = saved(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    before = mark(edges)
    while before[0] > most:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _meet(both, least, before[0]).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _meet(large, low, before[0]).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = saved(small.union(low.select("u", F.col("m").alias("v"))).distinct())
        after = mark(edges)
        if after == before:
            return edges
        before = after
    return _in_one_task(edges) if before[0] else edges


def _meet(edges: DataFrame, least: DataFrame, n: int) -> DataFrame:
    """``edges`` (about ``n``) with the least of their node; stars of very many edges are split."""
    # Of fewer edges, a star is some megabytes at most: looking for large ones isn't worth a job.
    hot = hot_keys(edges.groupBy("u").agg(F.count("*").alias("c")), "u", "c") if n > MANY_EDGES else []
    return attach_groups(edges, least, "u", None, "inner", hot)


def _with_sides(pairs: DataFrame, side: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``pairs`` (a, b) with columns of both nodes, renamed by side; a node (b) of very many pairs is split."""
    out = pairs
    for key in ("a", "b"):
        hot = hot_keys(pairs.groupBy(key).agg(F.count("*").alias("c")), key, "c", pairs.count) if key == "b" else []
        part = side.select(F.col("node").alias(key), *[F.col(c).alias(n + key) for c, n in columns.items()])
        out = attach_groups(out, part, key, None, "inner", hot)
    return out


def _links(pairs: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """a, b of the pairs that are linked; ``known`` has each node's regs and shingles.

    Sizes and sketches are asked first, then the full sets of those that they don't rule out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            cols = {n: b.column(i) for i, n in enumerate(b.schema.names)}
            ra, rb = (np.frombuffer(b"".join(cols[c].to_pylist()), np.uint16).reshape(-1, M) for c in ("ra", "rb"))
            na, nb = (pc.binary_length(cols[c]).to_numpy(zero_copy_only=False) // 8 for c in ("sa", "sb"))
            keep = may_reach(ra, rb, na.astype(float), nb.astype(float), percent / 100.0)
            for i in np.flatnonzero(keep):
                x, y = (np.frombuffer(cols[c][i].as_buffer(), np.uint64) for c in ("sa", "sb"))
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep[i] = 100 * common >= percent * (len(x) + len(y) - common)
            kept = pa.array(keep)
            yield pa.RecordBatch.from_arrays([cols["a"].filter(kept), cols["b"].filter(kept)], names=["a", "b"])

    return _with_sides(pairs, known, {"regs": "r", "shingles": "s"}).mapInArrow(run, "a long, b long")


def _full_sets(rows: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """node, shingles (sorted, 8 bytes each) of the wanted nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingle_set(t, width).tobytes() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.binary())], names=["node", "shingles"])

    few = wanted.limit(MAX_BROADCAST_ROWS + 1).count() <= MAX_BROADCAST_ROWS
    ids = wanted.select(F.col("node").alias("rk"))
    texts = rows.join(F.broadcast(ids) if few else ids, "rk", "left_semi")
    return texts.select(F.col("rk").alias("node"), "text").mapInArrow(run, "node long, shingles binary")


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """Nodes and their sets, of batches of (node, shingles)."""
    for b in batches:
        yield b.column(0).to_numpy(zero_copy_only=False), [np.frombuffer(x, np.int64) for x in b.column(1).to_pylist()]


def _lone_shingles(sets: DataFrame) -> DataFrame:
    """node, alone: those of a node's shingles that no other node has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for nodes, hashes in _hashes(batches):
            if hashes:
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(nodes, [len(h) for h in hashes])), pa.array(np.concatenate(hashes))], names=["node", "h"])

    grams = sets.select("node", "shingles").mapInArrow(run, "node long, h long")
    once = grams.groupBy("h").agg(F.count("*").alias("c"), F.min("node").alias("node")).filter("c = 1")
    return once.groupBy("node").agg(F.collect_list("h").alias("alone"))


def _slot(h: np.ndarray, counters: int) -> np.ndarray:
    return (mix64(h.view(np.uint64)) & np.uint64(counters - 1)).astype(np.int64)


def _counters(sets: DataFrame) -> np.ndarray:
    """How often shingles occur, roughly: counters by hash, MOST_COUNTERS at most."""
    total = sets.agg(F.sum(F.octet_length("shingles") / 8)).first()[0] or 0
    n = min(MOST_COUNTERS, 1 << max(10, int(total / 4).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(n, np.int64)
        for _, hashes in _hashes(batches):
            if hashes:
                held += np.bincount(_slot(np.concatenate(hashes), n), minlength=n)
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[at])], names=["slot", "c"])

    counted = sets.select("node", "shingles").mapInArrow(run, "slot long, c long").groupBy("slot").agg(F.sum("c").alias("c")).toArrow()
    out = np.zeros(n, np.int64)
    out[counted.column("slot").to_numpy()] = counted.column("c").to_numpy()
    return np.minimum(out, 2**31 - 1).astype(np.int32)


def _size_band(n: int) -> int:
    return int(np.log(n) / np.log(BAND) + 1e-9)


def meeting_points(shingles: np.ndarray, alone: np.ndarray, counts: np.ndarray, percent: int) -> Iterator[tuple[str, int, np.ndarray]]:
    """(role, size band, shingles) at which a set must meet any linked set: as the larger of the two, and as the smaller."""
    shared = np.setdiff1d(shingles, alone, assume_unique=True)
    n, reach = len(shingles), len(shared)
    need = lambda m: -(-percent * (n + m) // (100 + percent))  # noqa: E731  what sets of n and m must have in common
    order = shared[np.lexsort((shared, counts[_slot(shared, len(counts))]))]
    if reach >= need(n):
        yield "smaller", _size_band(n), order[: reach - need(n) + 1]
    least = -(-percent * n // 100)
    most = min(n, reach * (100 + percent) // percent - n)
    if most >= least:
        for band in range(_size_band(least), _size_band(most) + 1):
            m = max(least, int(BAND**band) - 1)  # no size in the band is smaller
            if reach >= need(m):
                yield "larger", band, order[: reach - need(m) + 1]


def _pairs_across(sets: DataFrame, placed: DataFrame, percent: int) -> DataFrame:
    """a, b: the nodes of different components that sizes and rare shingles don't rule out; ``placed`` has node, comp."""
    counts = placed.sparkSession.sparkContext.broadcast(_counters(sets))
    known = sets.join(_lone_shingles(sets), "node", "left").join(placed, "node").select("node", "shingles", "comp", "alone")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            roles, bands, points, per, at, sizes, left = [], [], [], [], [], [], []
            for i in range(b.num_rows):
                s = np.frombuffer(b.column(1)[i].as_py(), np.int64)
                alone = np.array(b.column(3)[i].as_py() or [], np.int64)
                for role, band, h in meeting_points(s, alone, counts.value, percent):
                    roles.append(role == "larger")
                    bands.append(band)
                    points.append(h)
                    per.append(len(h))
                    at.append(i)
                    sizes.append(len(s))
                    left.append(len(s) - len(alone) - np.arange(len(h)))
            if at:
                take = pa.array(np.repeat(at, per))
                numbers = [pa.array(np.repeat(x, per)) for x in (roles, bands)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(points)), *numbers, b.column(0).take(take), b.column(2).take(take), pa.array(np.repeat(sizes, per)), pa.array(np.concatenate(left))],
                    names=["h", "larger", "band", "node", "comp", "n", "left"],
                )

    met = saved(known.mapInArrow(run, "h long, larger boolean, band long, node long, comp long, n long, left long").withColumn("point", F.xxhash64("h", "band")))
    parts = met.groupBy("point", "comp").agg(F.count("*").alias("rows"))
    points = parts.groupBy("point").agg(F.count("*").alias("parts"), F.sum("rows").alias("size"), F.max_by("comp", F.struct("rows", "comp")).alias("main"))
    points = saved(points.filter("parts > 1").select("point", "size", "main"))
    hot = hot_keys(points, "point", "size")
    is_hot = F.col("point").isin(hot) if hot else F.lit(False)
    # Written once: four sides are read from it, and points where one component meets itself are gone.
    met = saved(attach_groups(met.drop("h", "band"), points, "point", None, "inner", hot))

    def side(role: str, main: bool | None, key: str, copies: bool) -> DataFrame:
        rows = met.filter("larger" if role == "larger" else "not larger")
        if main is not None:
            rows = rows.filter("comp = main" if main else "comp <> main")
        salt = F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))) if copies else F.when(is_hot, F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")).otherwise(0)
        return rows.select("point", salt.alias("salt"), *[F.col(c).alias(f"{c}_{key}") for c in ("node", "comp", "n", "left")])

    # Of what two sets have in common, none comes before the first of it in either's order, at which they meet.
    enough = F.lit(100 + percent) * F.least("left_x", "left_y") >= F.lit(percent) * (F.col("n_x") + F.col("n_y"))
    fits = enough & (F.col("comp_x") != F.col("comp_y")) & (F.col("n_x") >= F.col("n_y"))
    found = None
    for main_x, main_y in ((False, None), (True, False)):
        # The side that is outside the main component is spread, the other one copied.
        part = side("larger", main_x, "x", main_x).join(side("smaller", main_y, "y", not main_x), ["point", "salt"]).filter(fits)
        part = part.select(F.least("node_x", "node_y").alias("a"), F.greatest("node_x", "node_y").alias("b"))
        found = part if found is None else found.union(part)
    return found.distinct()


def link_components(rows: DataFrame, sketches: DataFrame, heads: DataFrame, width: int, percent: int) -> DataFrame:
    """node, comp for nodes that are linked to others (comp: the component's smallest node)."""
    nodes = saved(sketches.join(heads.select(F.col("node").alias("rk")), "rk", "left_semi").select(F.col("rk").alias("node"), "n_shingles", "regs", "bands"))
    member = nodes.select("node", F.explode("bands").alias("bucket"))
    buckets = member.groupBy("bucket").agg(F.count("*").alias("c")).filter("c > 1")
    member = saved(attach_groups(member, saved(buckets), "bucket", "c", "inner"))
    company = member.groupBy("node").agg(F.sum("c").alias("company"))
    member = saved(member.join(company, "node"))
    hubs = member.groupBy("bucket").agg(F.count("*").alias("size"), F.max(F.struct("company", (-F.col("node")).alias("neg"))).alias("top"))
    hubs = saved(hubs.select("bucket", "size", (-F.col("top.neg")).alias("hub")))
    star = attach_groups(member.select("node", "bucket"), hubs, "bucket", "size").filter("node <> hub")
    star = saved(star.select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct())
    sets = _full_sets(rows, company.select("node"), width)
    sets = saved(sets.join(nodes.select("node", "regs"), "node"))
    links = saved(_links(star, sets, percent))
    comp = components(links).select(F.col("u").alias("node"), F.col("v").alias("comp"))

    # Hubs whose members, themselves included, are in several components.
    members = star.select(F.col("b").alias("hub"), F.col("a").alias("node")).union(star.select(F.col("b").alias("hub"), F.col("b").alias("node")).distinct())
    placed = saved(members.join(comp, "node", "left").select("hub", "node", F.coalesce("comp", "node").alias("comp")))
    mixed = placed.groupBy("hub").agg(F.count("*").alias("size"), F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low <> high")
    placed = saved(attach_groups(placed, saved(mixed), "hub", "size", "inner").select("node", "comp").distinct())
    family = saved(sets.join(placed.select("node"), "node", "left_semi"))
    more = _links(saved(_pairs_across(family, placed, percent)), family, percent)
    return components(links.union(more)).select(F.col("u").alias("node"), F.col("v").alias("comp"))


def near_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """rk, doc_id, n_shingles, component_id, kept: one row per input row."""
    return groups_of(keyed_rows(docs), doc_id, text, width, percent)


def groups_of(rows: DataFrame, doc_id: str, text: str, width: int, percent: int) -> DataFrame:
    """:func:`near_groups` of keyed rows."""
    rows = columns_of(rows, lambda c: c(doc_id).alias("doc_id"), lambda c: ascii_lower(c(text)).cast("binary").alias("text"))
    sketches = saved(sketch_documents(rows, width))
    # The row of a set that has the smallest doc_id, then the smallest key; null ids come last.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rk"))
    heads = sketches.filter("digest is not null").groupBy("digest").agg(F.count("*").alias("n"), F.min("rk").alias("node"), first.alias("first"))
    heads = saved(heads)
    linked = link_components(rows, sketches, heads, width, percent)
    heads = saved(heads.join(linked, "node", "left").withColumn("comp", F.coalesce("comp", "node")))
    best = heads.groupBy("comp").agg(F.count("*").alias("n_sets"), F.min("first").alias("best"))
    heads = attach_groups(heads.select("digest", "n", "comp"), saved(best), "comp", "n_sets")
    heads = saved(heads.select("digest", F.col("n").alias("n_copies"), F.col("best.doc_id").alias("component_id"), F.col("best.rk").alias("keep_rk")))
    out = attach_groups(sketches.select("rk", "doc_id", "n_shingles", "digest"), heads, "digest", "n_copies")
    alone = F.col("digest").isNull()
    return out.select(
        "rk",
        "doc_id",
        "n_shingles",
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        (alone | (F.col("rk") == F.col("keep_rk"))).alias("kept"),
    )


def drop_near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group, with all its columns; documents without words stay."""
    rows = keyed_rows(docs)
    return drop_rows(rows, saved(groups_of(rows, doc_id, text, width, percent).filter("not kept").select("rk")))


def op7_near_dedup(spark, sf_dir):
    from reqflow.llm.common import read_table

    return near_groups(read_table(spark, sf_dir, "documents"), width=4).drop("rk")
