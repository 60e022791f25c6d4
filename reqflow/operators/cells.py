"""An inverted-file index for vectors: each vector in the cell of its nearest centroid, some cells probed per query, scores exact.

For indexes that are too large to be met by every query; :func:`reqflow.operators.vectors.nearest` is exact and stays the default.
Centroids are fitted on a bounded sample, every vector is indexed, and within the probed cells nothing is left out: what is missed is
a neighbour whose cell isn't probed.  Cells and queries are dealt in blocks of bounded size, so a cell with a third of all vectors is many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reqflow.operators.vectors import FOUND, INDEX_BLOCK, QUERY_BLOCK, _Side, _top_k

#: The sample that centroids are fitted on: vectors and bytes at most; and cells.
SAMPLE_ROWS, SAMPLE_BYTES = 20_000, 64 << 20
MOST_CELLS = 4096
ROUNDS = 8


def _unit(values: np.ndarray) -> np.ndarray:
    return values / np.maximum(np.linalg.norm(values, axis=1, keepdims=True), 1e-12)


def fit_cells(index: DataFrame, n_cells: int, seed: int = 0) -> np.ndarray:
    """Unit centroids (at most ``n_cells``) by spherical k-means on the SAMPLE_ROWS vectors with the least hash of their identifier."""
    held = index.filter("vals is not null and detail_id is not null")
    first = held.select(F.size("vals")).first()
    if first is None:
        return np.zeros((0, 0), np.float32)
    rows = max(1, min(SAMPLE_ROWS, SAMPLE_BYTES // (4 * max(1, first[0]))))
    sample = held.orderBy(F.xxhash64("detail_id"), "detail_id").limit(rows).select("vals").toArrow().column("vals").combine_chunks()
    x = _unit(sample.flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(len(sample), -1))
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(n_cells, MOST_CELLS, len(x)), replace=False)].copy()
    for _ in range(ROUNDS):
        own = np.argmax(x @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        some = np.bincount(own, minlength=len(centres)) > 0
        centres[some] = _unit(sums[some])
    return centres


def with_cells(df: DataFrame, centres: np.ndarray, probes: int = 1) -> DataFrame:
    """A row of ``df`` (detail_id, req_group, vals, seq) with each of the ``probes`` cells nearest to it."""
    held = df.sparkSession.sparkContext.broadcast(centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            vals = b.column(2)
            x = vals.flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(b.num_rows, -1)
            score, k = x @ held.value.T, min(probes, len(held.value))
            cells = np.argpartition(-score, k - 1, axis=1)[:, :k]
            rows = b.take(pa.array(np.repeat(np.arange(b.num_rows), k)))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(cells.ravel().astype(np.int32))], names=["detail_id", "req_group", "vals", "seq", "cell"])

    kind = df.schema["vals"].dataType.simpleString()
    return df.mapInArrow(run, f"detail_id long, req_group string, vals {kind}, seq long, cell int")


def nearest_in_cells(index: DataFrame, queries: DataFrame, k: int = 10, n_cells: int = 64, probes: int = 16, exclude: str = "before", centres: np.ndarray | None = None) -> DataFrame:
    """query_id, detail_id, score, rk: of the vectors in the ``probes`` nearest of ``n_cells`` cells, the ``k`` nearest, as :func:`nearest` does of all.

    ``centres``: a fit made before, in place of a new one.
    """
    narrow = lambda df: df.filter("vals is not null and detail_id is not null").select(F.col("detail_id").cast("long").alias("detail_id"), F.col("req_group").cast("string").alias("req_group"), "vals", F.lit(0).cast("long").alias("seq"))
    centres = fit_cells(index, n_cells) if centres is None else centres
    if not len(centres):
        return index.sparkSession.createDataFrame([], "query_id long, detail_id long, score double, rk int")
    x, q = with_cells(narrow(index), centres), with_cells(narrow(queries), centres, probes)

    def blocks(df: DataFrame, most: int) -> list[int]:
        found = {r.cell: r[1] for r in df.groupBy("cell").count().collect()}  # one row per cell
        return [-(-found.get(c, 0) // most) for c in range(len(centres))]

    of_x, of_q = (F.element_at(F.array(*[F.lit(max(1, n)) for n in blocks(df, most)]), F.col("cell") + 1) for df, most in ((x, INDEX_BLOCK), (q, QUERY_BLOCK)))
    own = lambda n: F.pmod(F.xxhash64("detail_id"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    x = x.withColumn("xb", own(of_x)).withColumn("qb", every(of_q))
    q = q.withColumn("qb", own(of_q)).withColumn("xb", every(of_x))

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        empty = pa.table({"query_id": pa.array([], pa.int64()), "detail_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64()), "same_group": pa.array([], pa.bool_())})
        return pa.Table.from_batches([_top_k(_Side(a), _Side(b), k, "own" if exclude == "before" else None, False)]) if a.num_rows and b.num_rows else empty

    found = q.groupBy("cell", "qb", "xb").cogroup(x.groupBy("cell", "qb", "xb")).applyInArrow(run, FOUND)
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "detail_id")
    out = found.withColumn("rk", F.row_number().over(w)).filter(F.col("rk") <= k)
    return (out.filter("not same_group") if exclude == "after" else out).drop("same_group")
