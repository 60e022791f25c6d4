"""Questions about a corpus's distinct items, answered once per item and taken back to the documents.

Documents are dealt with in runs of bounded size.  A run sends its distinct items
(words, n-grams, pre-tokens) as packed lists, one per block of the hash space in which it has
any, and what it must remember - which document has which item - as one list to itself.  A
block sees the lists of all runs, merges them, and answers each in its order.  The
answers meet the run again, which ends with one row per document.  So nothing is
sent per document and item, no list grows with an item's frequency, and two
shuffles do it whatever the corpus.

A run is named by the key of its first row, so a task that is run again sends the same.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SENT = "dest long, run long, block long, payload binary"
_KINDS = [("dest", pa.int64()), ("run", pa.int64()), ("block", pa.int64()), ("payload", pa.binary())]
#: The block number of what a run remembers, and of figures that a block reports.
HOME, FIGURES = -1, -2


def pack(*arrays: np.ndarray) -> bytes:
    """The arrays byte plane by byte plane, compressed: sorted hashes and small numbers have planes that hardly vary."""
    sizes = np.array([len(a) for a in arrays], np.int64)
    planes = [np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() for a in arrays]
    data = sizes.tobytes() + b"".join(planes)
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def unpack(data: bytes, *kinds) -> list[np.ndarray]:
    data = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    at, out = 8 * len(kinds), []
    for n, kind in zip(np.frombuffer(data, np.int64, len(kinds)).tolist(), kinds, strict=True):
        width = np.dtype(kind).itemsize
        planes = np.frombuffer(data, np.uint8, n * width, at).reshape(width, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(n))
        at += n * width
    return out


def joined(*parts: bytes) -> bytes:
    """Byte strings in one, for :func:`parted`."""
    return np.array([len(p) for p in parts], np.int64).tobytes() + b"".join(parts)


def parted(data: bytes, n: int) -> list[bytes]:
    at, out = 8 * n, []
    for size in np.frombuffer(data, np.int64, n).tolist():
        out.append(data[at : at + size])
        at += size
    return out


def rows_as_bytes(*columns: pa.Array) -> bytes:
    """Columns of a run's documents, of any types, kept until they are given out again."""
    batch = pa.RecordBatch.from_arrays(list(columns), names=[f"c{i}" for i in range(len(columns))])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def rows_from_bytes(data: bytes) -> list[pa.Array]:
    return pa.ipc.open_stream(data).read_all().combine_chunks().to_batches()[0].columns


def block_slices(block: np.ndarray) -> Iterator[tuple[int, slice]]:
    """The blocks that occur in a sorted list, with their places."""
    if len(block):
        starts = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(block)], strict=True):
            yield int(block[a]), slice(a, b)


def runs_of(batches: Iterable[pa.RecordBatch], measure: Callable[[pa.RecordBatch], list[tuple[object, int]]], most: int) -> Iterator[tuple[list[pa.RecordBatch], list]]:
    """Slices of batches, with what ``measure`` gives for their rows, of about ``most`` units each; a row is never cut."""
    parts, held, size = [], [], 0
    for b in batches:
        start = 0
        for i, (value, units) in enumerate(measure(b)):
            held.append(value)
            size += units
            if size >= most:
                yield [*parts, b.slice(start, i + 1 - start)], held
                parts, held, size, start = [], [], 0, i + 1
        if start < b.num_rows:
            parts.append(b.slice(start))
    if held:
        yield parts, held


def column(parts: list[pa.RecordBatch], i: int) -> pa.Array:
    return pa.concat_arrays([p.column(i) for p in parts])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), _KINDS, strict=True)], names=[n for n, _ in _KINDS])


def ask(
    rows: DataFrame,
    send: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[int, bytes, Iterable[tuple[int, bytes]]]]],
    answer: Callable[[list[bytes]], tuple[list[bytes], bytes]],
    finish: Callable[[bytes, dict[int, bytes]], pa.RecordBatch],
    schema: str,
    figures: Callable[[bytes], pa.RecordBatch] | None = None,
) -> DataFrame:
    """The rows that ``finish`` makes of every run, and those that ``figures`` makes of every block's report.

    ``send`` gives (run, memory, (block, question) pairs); ``answer`` takes a block's questions and
    gives an answer each, and a report; ``finish`` takes a run's memory and its answers by block.
    """

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run, memory, questions in send(batches):
            yield _batch([(-1 - run, run, HOME, memory)])
            for b in _chunks(((block, run, block, q) for block, q in questions), 256):
                yield _batch(b)

    def met(table: pa.Table) -> pa.Table:
        first = table.column("dest")[0].as_py()
        if first < 0:
            return table
        answers, report = answer(table.column("payload").to_pylist())
        out = pa.table([pa.array([-1 - r for r in table.column("run").to_pylist()], pa.int64()), table.column("run"), table.column("block"), pa.array(answers, pa.binary())], names=table.column_names)
        if figures is None:
            return out
        return pa.concat_tables([out, pa.Table.from_batches([_batch([(first, 0, FIGURES, report)])])])

    def done(table: pa.Table) -> pa.Table:
        blocks, payloads = table.column("block").to_pylist(), table.column("payload").to_pylist()
        if blocks[0] == FIGURES:
            return pa.Table.from_batches([figures(payloads[0])])
        found = dict(zip(blocks, payloads, strict=True))
        return pa.Table.from_batches([finish(found.pop(HOME), found)])

    return rows.mapInArrow(sent, SENT).groupBy("dest").applyInArrow(met, SENT).groupBy("dest").applyInArrow(done, schema)


def _chunks(items: Iterator, n: int) -> Iterator[list]:
    held = []
    for x in items:
        held.append(x)
        if len(held) == n:
            yield held
            held = []
    if held:
        yield held
