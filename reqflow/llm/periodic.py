"""Periodic runs: stretches of words that repeat with some period, found by seeds on diagonals.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q``
apart are identical) and at least ``max(MIN_LENGTH, 2 * q)`` words, that no
neighbouring word extends.  So words ``lag`` apart agree over at least
``max(MIN_LENGTH - q, q)`` places in a row at lag ``q``: the overlap that is
guaranteed.

* Lags are taken in classes ``[1, 8)``, ``[8, 16)``, ``[16, 32)`` and so on.  A class
  has k-grams of half its guaranteed overlap, so that one at a multiple of ``k`` lies in every such overlap.
* k-grams that occur once in their document are put aside; only those whose parts
  repeat are looked at in the next class.  Equal ones are neighbours after
  sorting, and each seed (a k-gram at a multiple of ``k``) is paired with those later ones that
  are one of the class's lags away: never more than four times the words for a class.
* A pair is extended to both sides along its diagonal, comparing words.  A table of the furthest
  place covered by each lag passes over the pairs of a stretch that is known, and pairs
  inside a run of a smaller period that divides their lag, which could only find that run again, are left out.
* Lags go upwards.  A stretch whose smallest period is less than its lag is the very run
  of that period, which is known by then.

Documents of a batch are searched together, divided by words that are equal to none.
Nothing is shuffled.  Words are the runs of non-blank characters (blank: space and U+0009-U+000D).

Defined results: null, empty and wordless texts have no words and no runs; long texts are read
whole, one at a time if need be; repeated rows are searched each for itself; ties don't arise, as runs are a set; an empty
table gives an empty table; extra columns, whatever their names, are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reqflow.llm.common import mix64, small_batches

#: Words that a run has at least.
MIN_LENGTH = 12
WORD = r"[^\x20\x09-\x0D]+"
#: Words searched together, unless one document has more.
GROUP_WORDS = 250_000
#: Pairs looked at at once, unless one seed has more.
PAIRS = 1_000_000
_RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])


def _classes(most: int) -> Iterator[tuple[int, int, int]]:
    """(k, least lag, least lag of the next class) for lags up to ``most``; 2k - 1 is at most the guaranteed overlap."""
    k, low, high = 3, 1, 8
    while low <= most:
        yield k, low, high
        k, low, high = high // 2, high, high * 2


def _repeats(hashes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of k-grams that occur twice or more, by k-gram and place, and the number of each one's k-gram."""
    order = np.argsort(hashes, kind="stable")
    h, p = hashes[order], at[order]
    same = h[1:] == h[:-1]
    several = np.concatenate((same, [False])) | np.concatenate(([False], same))
    return p[several], np.cumsum(np.concatenate(([0], ~same)))[several]


def _pairs(p: np.ndarray, gram: np.ndarray, seeds: np.ndarray, low: int, high: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and lags of the seeds (indices of :func:`_repeats`' rows) and the equal k-grams ``low`` to ``high - 1`` words on, some at a time."""
    width = np.int64(p.max() + high + 1)
    key = gram * width + p
    start = np.searchsorted(key, key[seeds] + low)
    count = np.searchsorted(key, gram[seeds] * width + np.minimum(p[seeds] + high, width - 1)) - start
    some = count > 0
    seeds, start, count = seeds[some], start[some], count[some]
    upto = np.cumsum(count)
    first = 0
    while first < len(seeds):
        last = max(first + 1, int(np.searchsorted(upto, (upto[first - 1] if first else 0) + PAIRS, "right")))
        c = count[first:last]
        place = np.repeat(p[seeds[first:last]], c)
        yield place, p[np.repeat(start[first:last] - np.cumsum(c) + c, c) + np.arange(len(place))] - place
        first = last


def _reach(ids: np.ndarray, i: int, j: int, step: int) -> int:
    """How many words agree going from ``i`` and ``j`` (i < j) by ``step`` (1 or -1), themselves included."""
    n, size, most = 0, 64, len(ids) - j if step > 0 else i + 1
    while n < most:
        m = min(size, most - n)
        a, b = (ids[x + n : x + n + m] if step > 0 else ids[x - n - m + 1 : x - n + 1][::-1] for x in (i, j))
        differ = np.flatnonzero(a != b)
        if len(differ):
            return n + int(differ[0])
        n += m
        size *= 4
    return n


def find_runs(ids: np.ndarray, longest: int, doc: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs in word numbers, by lag.

    ``ids`` may hold several documents with a number between them that occurs nowhere else; ``longest`` is the length
    of the longest, ``doc`` each word's document.
    """
    runs: list[tuple[int, int, int]] = []
    known: set[tuple[int, int]] = set()
    # Of the run that reaches furthest of those a word is in: its end and period.
    inside, period = np.zeros(len(ids), np.int64), np.ones(len(ids), np.int64)
    done, size = 0, len(ids)
    hashes = mix64(mix64(doc.astype(np.uint64)) + ids.astype(np.uint64))
    at, parts = np.arange(size), 1
    for k, low, high in _classes(longest // 2):
        # A k-gram's hash comes from those of the parts looked at before; it repeats only if they do.
        if parts == 1:
            at = at[: max(0, size - k + 1)]
            grams = mix64(mix64(hashes[at]) + hashes[at + 1])
            grams = mix64(grams + hashes[at + 2])
        else:
            held = np.zeros(size + 1, bool)
            held[at] = True
            at = at[held[np.minimum(at + k - parts, size)]]
            grams = mix64(mix64(hashes[at]) + hashes[at + k - parts])
        if not len(at):
            break
        for start, length, q in runs[done:]:
            part = slice(start, start + length)
            further = inside[part] < start + length
            inside[part][further], period[part][further] = start + length, q
        done, parts = len(runs), k
        p, gram = _repeats(grams, at)
        if not len(p):
            break
        hashes[at] = grams
        seeds = np.flatnonzero((p % k == 0) & ((inside[p] < p + high + k) | (period[p] > k)))
        found = []
        for place, lag in _pairs(p, gram, seeds, low, high):
            new = (inside[place] <= place + lag) | (lag % period[place] != 0)
            found.append((lag[new], place[new]))
        at = np.sort(p)
        furthest: dict[int, int] = {}
        lag, place = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (p[:0], p[:0])
        order = np.lexsort((place, lag))
        for i, q in zip(place[order].tolist(), lag[order].tolist(), strict=True):
            if i < furthest.get(q, 0):
                continue
            ahead = _reach(ids, i, i + q, 1)
            if not ahead:
                continue  # another k-gram with the same hash
            first = i - (_reach(ids, i - 1, i - 1 + q, -1) if i else 0)
            furthest[q] = i + ahead
            length = i + ahead - first + q
            if length >= max(MIN_LENGTH, 2 * q) and (first, length) not in known:
                known.add((first, length))
                runs.append((first, length, q))
    return runs


def _search(texts: list[bytes | None]) -> tuple[list[list[tuple]], list[bytes]]:
    """Each text's runs by start and period, and its words that no run repeats, joined by a space."""
    split = [(t or b"").split() for t in texts]
    runs: list[list[tuple]] = [[] for _ in texts]
    kept: list[bytes] = []
    begin = 0
    while begin < len(split):
        end, size = begin, 0
        while end < len(split) and (end == begin or size + len(split[end]) <= GROUP_WORDS):
            size += len(split[end])
            end += 1
        number: dict[bytes, int] = {}
        lengths = np.array([len(w) for w in split[begin:end]], np.int64)
        starts = np.concatenate(([0], np.cumsum(lengths + 1)))
        ids = np.empty(int(starts[-1]), np.int64)
        for d, words in enumerate(split[begin:end]):
            ids[starts[d] : starts[d] + len(words)] = [number.setdefault(w, len(number)) for w in words]
            ids[starts[d + 1] - 1] = -1 - d
        doc = np.repeat(np.arange(end - begin), lengths + 1)
        for start, length, period in find_runs(ids, int(lengths.max()), doc):
            d = int(doc[start])
            runs[begin + d].append((start - int(starts[d]), length, period))
        for d in range(begin, end):
            runs[d].sort(key=lambda r: (r[0], r[2]))
            words = split[d]
            drop = np.zeros(len(words), bool)
            for start, length, period in runs[d]:
                drop[start + period : start + length] = True
            kept.append(b" ".join([words[i] for i in np.flatnonzero(~drop).tolist()] if runs[d] else words))
        begin = end
    return runs, kept


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str | Column = "text") -> DataFrame:
    """doc_id, runs (start, length, period of each, by start, then period; words from 0) and collapsed.

    ``collapsed`` is the text without the words that lie in a run after its first period, its words joined by one space.
    """
    small_batches(docs.sparkSession)
    body = F.col(text) if isinstance(text, str) else text
    given = docs.select(F.col(doc_id).alias("doc_id"), body.cast("string").cast("binary").alias("text"))
    fields = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            runs, kept = _search(b.column(1).to_pylist())
            listed = pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in own] for own in runs], fields)
            yield pa.RecordBatch.from_arrays([b.column(0), listed, pa.array(kept, pa.binary()).view(pa.string())], names=["doc_id", "runs", "collapsed"])

    schema = T.StructType([T.StructField("doc_id", given.schema["doc_id"].dataType), T.StructField("runs", T.ArrayType(_RUN)), T.StructField("collapsed", T.StringType())])
    return given.mapInArrow(run, schema)


def with_tails(doc_id: Column, text: Column) -> Column:
    """The text, in which one document of ten repeats a part of itself to its end.

    With h the unsigned CRC-32 of the decimal doc_id and g = floor(h / 10), of n words: if h % 10 = 0, each word i >= a = g % n becomes word
    a + (i - a) % p, where p = 1 + floor((n - a) / (3 + g % 8)).  A null id changes nothing.
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({WORD})"), F.lit(1))

    def tail(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = F.when(n > 0, F.pmod(g, n)).otherwise(F.lit(0))
        p = F.floor((n - a) / (F.pmod(g, F.lit(8)) + 3)).cast("long") + 1
        moved = F.transform(w, lambda x, i: F.when(i < a, x).otherwise(F.get(w, (a + F.pmod(i.cast("long") - a, p)).cast("int"))))
        return F.array_join(moved, " ")

    # The transform over a one-element array binds the words, so that they are taken from the text once.
    return F.when(F.pmod(h, F.lit(10)) == 0, F.transform(F.array(words), tail)[0]).otherwise(text)


def op13_periodic_runs(spark, sf_dir):
    from reqflow.llm.common import read_table

    docs = read_table(spark, sf_dir, "documents")
    found = periodic_runs(docs, text=with_tails(F.col("doc_id"), F.col("text")))
    # Greatest length first, then smallest start, then smallest period.
    top = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n"))), "")
    return found.withColumn("top", top).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("top.start")).alias("start"),
        F.col("top.length").alias("length"),
        (-F.col("top.period")).alias("period"),
        F.floor(F.col("top.length") * 1000 / -F.col("top.period")).cast("long").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
