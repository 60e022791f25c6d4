"""Nearest vectors: exact top k, few queries broadcast to a partitioned index, many met in blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reqflow.storage import shared_folder

#: Queries broadcast at once, and looked at at once; index vectors looked at at once: 8 * QUERY_BLOCK * CHUNK bytes of scores.
QUERY_BLOCK = 2048
CHUNK = 2048
#: Vectors in one block of either side: each side is sent as often as the other has blocks.
INDEX_BLOCK = 65_536
FOUND = "query_id long, detail_id long, score double, same_group boolean"


class _Side:
    """Unit vectors with identifiers, groups as text (null belongs to no group) and order."""

    def __init__(self, table: pa.Table):
        n = table.num_rows
        values = table.column("vals").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        self.unit = values.reshape(n, -1)
        self.unit /= np.maximum(np.linalg.norm(self.unit, axis=1, keepdims=True), 1e-300)
        self.ids = table.column("detail_id").to_numpy()
        self.groups = table.column("req_group").combine_chunks()
        self.seq = table.column("seq").to_numpy()
        self.order = table.column("first").to_numpy() if "first" in table.column_names else self.ids

    def part(self, rows: slice | np.ndarray) -> _Side:
        out = object.__new__(_Side)
        out.unit, out.ids, out.seq, out.order = self.unit[rows], self.ids[rows], self.seq[rows], self.order[rows]
        out.groups = self.groups[rows] if isinstance(rows, slice) else self.groups.take(pa.array(rows))
        return out


def _group_codes(q: _Side, x: _Side) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of both sides' groups, equal for equal groups; no group is -1 in one and -2 in the other."""
    both = pa.concat_arrays([q.groups, x.groups]).dictionary_encode().indices
    codes = pc.fill_null(both, -1).to_numpy(zero_copy_only=False).astype(np.int64)
    theirs = codes[len(q.ids) :]
    return codes[: len(q.ids)], np.where(theirs < 0, -2, theirs)


def _top_k(q: _Side, x: _Side, k: int, exclude: str | None, earlier: bool) -> pa.RecordBatch:
    """The ``k`` best of ``x`` for each of ``q``, of equal scores those that come first; no more than QUERY_BLOCK x CHUNK scores are held.

    ``exclude`` leaves out a query's ``own`` group; with ``any`` the ``k`` best without it are there whatever group is left out later.
    """

    def found(q: _Side) -> tuple[np.ndarray, ...]:
        mine, theirs = _group_codes(q, x)
        qi, xi, score = _without_any(q, x, k, theirs) if exclude == "any" else _top_k_of_few(q, x, k, mine if exclude else None, theirs, earlier)
        return q.ids[qi], x.ids[xi], score, mine[qi] == theirs[xi]

    parts = [found(q.part(slice(lo, lo + QUERY_BLOCK))) for lo in range(0, len(q.ids), QUERY_BLOCK)]
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts, strict=True)], names=["query_id", "detail_id", "score", "same_group"])


def _without_any(q: _Side, x: _Side, k: int, theirs: np.ndarray) -> tuple[np.ndarray, ...]:
    """Places in ``q`` and ``x`` and scores, 2 k for each of ``q`` at most, among which are the ``k`` best without any one group.

    The 2 k best have them for all groups but one that has over k of these; for a query with such a group, the k best of it and the k best of the others do.
    """
    qi, xi, score = _top_k_of_few(q, x, 2 * k, None, theirs, False)
    own = qi * (len(x.ids) + 2) + theirs[xi] + 2  # of a query and a group; no group has number 0
    pairs, at, n = np.unique(own, return_inverse=True, return_counts=True)
    large = (n > k) & (pairs % (len(x.ids) + 2) > 0)
    if not large.any():
        return qi, xi, score
    who, group = np.divmod(pairs[large], len(x.ids) + 2)
    a, b, s = _top_k_of_few(q.part(who), x, k, group - 2, theirs, False)
    by = np.argsort(at, kind="stable")  # the best of each pair first
    place = np.empty(len(at), np.int64)
    place[by] = np.arange(len(at)) - np.searchsorted(at[by], at[by])
    left = ~np.isin(qi, who) | (large[at] & (place < k))
    return np.concatenate([qi[left], who[a]]), np.concatenate([xi[left], b]), np.concatenate([score[left], s])


def _top_k_of_few(q: _Side, x: _Side, k: int, mine: np.ndarray | None, theirs: np.ndarray, earlier: bool) -> tuple[np.ndarray, ...]:
    """Places in ``q`` and ``x`` and scores of the ``k`` best, in order; of each query without those of ``x`` whose group (``theirs``) has the number in ``mine``."""
    edge = np.full(len(q.ids), -np.inf)  # no more than the k-th best score so far
    qi, xi, score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    for lo in range(0, len(x.ids), CHUNK):
        part = slice(lo, lo + CHUNK)
        s = q.unit @ x.unit[part].T
        if mine is not None:
            s[mine[:, None] == theirs[None, part]] = -np.inf
        if earlier:
            s[x.seq[None, part] >= q.seq[:, None]] = -np.inf
        if s.shape[1] >= k:
            np.maximum(edge, np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k], out=edge)
        a, b = np.nonzero((s >= edge[:, None]) & (s > -np.inf))
        qi, xi, score = np.concatenate([qi, a]), np.concatenate([xi, b + lo]), np.concatenate([score, s[a, b]])
        # Many may tie with the last: of each query the k first are kept.
        best = np.lexsort((x.order[xi], -score, qi))
        starts = np.searchsorted(qi[best], np.arange(len(q.ids)))
        best = best[np.arange(len(best)) - starts[qi[best]] < k]
        qi, xi, score = qi[best], xi[best], score[best]
    return qi, xi, score


def _by_broadcast(index: DataFrame, queries: pa.Table, k: int, exclude: str | None, earlier: bool) -> DataFrame:
    held = index.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = _Side(held.value)
        for b in batches:
            if b.num_rows:
                yield _top_k(q, _Side(pa.Table.from_batches([b])), k, exclude, earlier)

    return index.mapInArrow(run, FOUND)


def _by_blocks(index: DataFrame, queries: DataFrame, k: int, exclude: str | None, earlier: bool) -> DataFrame:
    """Every block of queries meets every block of the index in a task of its own."""

    def blocked(df: DataFrame, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        number = F.pmod(F.xxhash64("detail_id"), F.lit(n_own)).cast("int")
        return df.withColumn(own, number).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))))

    def run(q: pa.Table, x: pa.Table) -> pa.Table:
        empty = pa.table({"query_id": pa.array([], pa.int64()), "detail_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64()), "same_group": pa.array([], pa.bool_())})
        return pa.Table.from_batches([_top_k(_Side(q), _Side(x), k, exclude, earlier)]) if q.num_rows and x.num_rows else empty

    n_q, n_x = (max(1, -(-df.count() // most)) for df, most in ((queries, INDEX_BLOCK), (index, INDEX_BLOCK)))
    q, x = blocked(queries, "qb", n_q, "xb", n_x), blocked(index, "xb", n_x, "qb", n_q)
    return q.groupBy("qb", "xb").cogroup(x.groupBy("qb", "xb")).applyInArrow(run, FOUND)


def _found(index: DataFrame, queries: DataFrame, k: int, exclude: str | None, earlier: bool) -> DataFrame | None:
    """FOUND: ``k`` rows at most (twice that if ``any`` group may be left out later) for each query and part of the index; None without queries."""
    few = queries.limit(QUERY_BLOCK + 1).toArrow()
    if few.num_rows > QUERY_BLOCK:
        return _by_blocks(index, queries, k, exclude, earlier)
    return _by_broadcast(index, few, k, exclude, earlier) if few.num_rows else None


def _distinct(df: DataFrame) -> DataFrame:
    """detail_id (a number of its own), vals, first (least identifier) of each distinct vector; written, as the numbers must stay."""
    path = shared_folder(df.sparkSession, "distinct")
    df.groupBy("vals").agg(F.min("detail_id").alias("first")).withColumn("detail_id", F.monotonically_increasing_id()).write.parquet(path)
    return df.sparkSession.read.parquet(path).withColumns({"req_group": F.lit(None).cast("string"), "seq": F.lit(0).cast("long")})


def _grouped(rows: DataFrame, x: DataFrame) -> DataFrame:
    """Distinct vectors once for each group of their rows (vector, detail_id, req_group), with a number and the least identifier of their own."""
    path = shared_folder(rows.sparkSession, "grouped")
    held = rows.groupBy("vector", "req_group").agg(F.min("detail_id").alias("first"))
    held.join(x.select(F.col("detail_id").alias("vector"), "vals"), "vector").withColumn("detail_id", F.monotonically_increasing_id()).write.parquet(path)
    return rows.sparkSession.read.parquet(path).withColumn("seq", F.lit(0).cast("long"))


def _by_distinct(index: DataFrame, queries: DataFrame, k: int, before: bool) -> DataFrame | None:
    """query_id, detail_id, score, rk: each distinct vector of the queries meets each distinct vector of the index once, whatever the number of copies.

    With groups left out before the cut, it meets a vector once for each of its groups, 2 k of them at most, as all of its nearest may be of one group.
    Of the rows that are the nearest of a query vector, those past the k-th of their group can't be wanted, and of what is left a query's own group has k at
    most: so the 2 k first hold every query's k.
    """
    most = 2 * k if before else k
    x, q = _distinct(index), _distinct(queries)

    def kept(rows: DataFrame, key: str, *order) -> DataFrame:
        if before:
            rows = rows.withColumn("n", F.row_number().over(Window.partitionBy(key, "req_group").orderBy(*order))).filter(F.col("n") <= k)
        return rows.withColumn("n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter(F.col("n") <= most)

    rows = index.select("detail_id", "req_group", "vals").join(x.select("vals", F.col("detail_id").alias("vector")), "vals").select("vector", "detail_id", "req_group")
    rows = kept(rows, "vector", "detail_id")
    if before:
        x = _grouped(rows, x)
    else:
        x = x.withColumn("vector", F.col("detail_id"))
    pairs = _found(x, q, k, "any" if before else None, False)
    if pairs is None:
        return None
    pairs = kept(pairs.select("query_id", "detail_id", "score").join(x.select("detail_id", "vector", "first", "req_group"), "detail_id"), "query_id", F.desc("score"), "first")
    pairs = pairs.groupBy("query_id", "vector").agg(F.max("score").alias("score"))
    best = kept(pairs.join(rows, "vector"), "query_id", F.desc("score"), "detail_id")
    lists = best.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("n", "detail_id", "score", "req_group"))).alias("best"))
    lists = lists.withColumnRenamed("query_id", "vector").join(q.select(F.col("detail_id").alias("vector"), "vals"), "vector").select("vals", "best")
    own = lambda c: F.coalesce(c["req_group"] == F.col("req_group"), F.lit(False))
    seen = F.slice(F.filter("best", lambda c: ~own(c)), 1, k) if before else F.col("best")
    out = queries.join(lists, "vals").select(F.col("detail_id").alias("query_id"), "req_group", F.posexplode(seen).alias("at", "c"))
    if not before:
        out = out.filter(~own(F.col("c")))
    return out.select("query_id", "c.detail_id", "c.score", (F.col("at") + 1).alias("rk"))


def nearest(index: DataFrame, queries: DataFrame, k: int = 10, exclude: str = "before", visibility: str = "all", seq: Column | None = None) -> DataFrame:
    """query_id, detail_id, score, rk: the ``k`` nearest by cosine, ties by identifier.

    Vectors of the query's own group are left out ``before`` the cut (k rows as a
    rule) or ``after`` it (fewer rows then).  Both sides have detail_id, req_group, vals.
    With visibility ``earlier`` only vectors whose ``seq`` (a column of both sides) is less than the query's are seen.
    Rows without a vector or identifier are left out; a null group is no group's own.
    """
    place = F.lit(0) if seq is None else seq
    narrow = lambda df: df.filter("vals is not null and detail_id is not null").select(F.col("detail_id").cast("long").alias("detail_id"), F.col("req_group").cast("string").alias("req_group"), F.col("vals").alias("vals"), place.cast("long").alias("seq"))
    index, queries = narrow(index), narrow(queries)
    nothing = index.sparkSession.createDataFrame([], "query_id long, detail_id long, score double, rk int")
    if visibility != "earlier":
        out = _by_distinct(index, queries, k, exclude == "before")
        return nothing if out is None else out
    found = _found(index, queries, k, "own" if exclude == "before" else None, True)
    if found is None:
        return nothing
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "detail_id")
    out = found.withColumn("rk", F.row_number().over(w)).filter(F.col("rk") <= k)
    return (out.filter("not same_group") if exclude == "after" else out).drop("same_group")


def hashed_vectors(names: DataFrame, column: str, size: int = 64) -> DataFrame:
    """``column`` and vals: an offline embedding of each distinct text by hashed words, of unit length (zero without words)."""
    words = F.filter(F.split(F.lower(column), r"\s+"), lambda w: w != "")
    slots = F.transform(words, lambda w: F.conv(F.substring(F.md5(w), 1, 7), 16, 10).cast("long") % size)
    counts = F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.size(F.filter("__slots", lambda s: s == i)))
    norm = F.sqrt(F.aggregate("__counts", F.lit(0).cast("long"), lambda a, c: a + c * c).cast("double"))
    distinct = names.select(column).filter(F.col(column).isNotNull()).distinct().withColumn("__slots", slots).withColumn("__counts", counts)
    unit = F.transform("__counts", lambda c: (c / F.greatest(norm, F.lit(1.0))).cast("float"))
    return distinct.select(column, unit.alias("vals"))


def batch_embed(items: DataFrame, column: str, embed=hashed_vectors) -> DataFrame:
    """``items`` with vals: each distinct text is embedded once and joined back; a null text has no vector."""
    return items.join(embed(items, column), column, "left").select(*items.columns, "vals")
