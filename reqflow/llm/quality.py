"""Quality rules: how much of a text lies inside repeated word n-grams and lines.

Every text is read whole.  Words are the runs of non-blank characters (blank:
space and U+0009-U+000D); lines are split at ``\\n``.

Defined results: a null or empty text has no words and fails the base rule; ties
and repeated rows are scored row by row; an empty table gives an empty table;
extra columns, whatever their names, are never read and, in
:func:`keep_clean`, are passed through as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reqflow.llm.common import mix64, small_batches

#: Window of the base rule and the n-gram lengths of the coverage rules.
BASE_WINDOW = 8
LENGTHS = (3, 5, 8)

FEATURES = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("word_chars", T.LongType()),
        T.StructField("n_symbols", T.LongType()),
        T.StructField("n_dup_lines", T.LongType()),
        T.StructField("n_repeat_words", T.LongType()),
        T.StructField("dup_line_chars", T.LongType()),
        T.StructField("dup_chars_3", T.LongType()),
        T.StructField("dup_chars_5", T.LongType()),
        T.StructField("dup_chars_8", T.LongType()),
        T.StructField("n_upper", T.LongType()),
        T.StructField("n_lower", T.LongType()),
        T.StructField("n_shouts", T.LongType()),
    ]
)


@dataclass(frozen=True)
class QualityRules:
    """Limits of the method's verdict; shares are of the text's word characters."""

    min_words: int = 20
    max_repeat_percent: int = 30
    max_line_share: float = 0.30
    max_share_3: float = 0.45
    max_share_5: float = 0.35
    max_share_8: float = 0.30
    max_symbols_per_word: float = 0.20
    max_shouts_per_word: float = 0.20
    max_upper_share: float = 0.50


_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


def _repeated(ids: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """Which n-word windows occur at least twice; hash matches are confirmed on the word ids."""
    order = np.argsort(hashes, kind="stable")
    h = hashes[order]
    same = h[1:] == h[:-1]
    out = np.zeros(len(hashes), bool)
    if not same.any():
        return out
    first = np.concatenate(([True], ~same))
    lead = order[np.maximum.accumulate(np.where(first, np.arange(len(h)), 0))]
    follow = np.flatnonzero(~first)
    at, to = order[follow], lead[follow]
    equal = np.ones(len(at), bool)
    for j in range(n):
        equal &= ids[at + j] == ids[to + j]
    out[at[equal]] = True
    out[to[equal]] = True
    if not equal.all():  # different windows under one hash: compare those exactly
        rest = np.unique(np.concatenate((at[~equal], to[~equal])))
        seen: dict[bytes, int] = {}
        for i in rest.tolist():
            k = ids[i : i + n].tobytes()
            if k in seen:
                out[i] = out[seen[k]] = True
            seen.setdefault(k, i)
    return out


def _covered(windows: np.ndarray, n: int, size: int) -> np.ndarray:
    """Which of ``size`` words lie in a marked window of ``n`` words."""
    step = np.zeros(size + 1, np.int64)
    starts = np.flatnonzero(windows)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + n, -1)
    return np.cumsum(step[:size]) > 0


def text_features(text: bytes | None) -> tuple:
    """The fields of :data:`FEATURES` for one text in UTF-8."""
    words = (text or b"").split()
    n = len(words)
    if not n:
        return (0,) * len(FEATURES)
    raw = np.frombuffer(text, np.uint8)
    space = _SPACE[raw]
    points = np.cumsum((raw & 0xC0 != 0x80) & ~space)
    edge = np.diff(np.concatenate(([True], space, [True])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    before = np.concatenate(([0], points))
    chars = before[ends] - before[starts]
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    base = mix64(ids + np.int64(1))
    shares = {}
    repeat_words = 0
    rolling, upto = base.copy(), 1
    for k in LENGTHS:
        if n < k:
            shares[k] = 0
            continue
        while upto < k:  # h(i, k+1) = h(i, k) * B + w(i+k)
            rolling = rolling[:-1] * np.uint64(0x9E3779B97F4A7C15) + base[upto:]
            upto += 1
        inside = _covered(_repeated(ids, rolling, k), k, n)
        shares[k] = int(chars[inside].sum())
        if k == BASE_WINDOW:
            repeat_words = int(inside.sum())
    lines: set[bytes] = set()
    dup_lines = dup_line_chars = 0
    for line in text.split(b"\n"):
        if line in lines:
            dup_lines += 1
            dup_line_chars += len(b"".join(line.split()).decode("utf-8", "replace"))
        elif line.strip():
            lines.add(line)
    upper = int(((raw >= 65) & (raw <= 90)).sum())
    lower = int(((raw >= 97) & (raw <= 122)).sum())
    return (n, int(chars.sum()), int(_SYMBOL[raw].sum()), dup_lines, repeat_words, dup_line_chars, shares[3], shares[5], shares[8], upper, lower, text.count(b"!!"))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fields = pa.struct([(f.name, pa.int64()) for f in FEATURES])
    for b in batches:
        rows = [text_features(t) for t in b.column(0).to_pylist()]
        cols = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] if rows else [pa.array([], pa.int64()) for _ in FEATURES]
        q = pa.StructArray.from_arrays(cols, fields=list(fields))
        yield pa.RecordBatch.from_arrays([b.column(1), q], names=["row", "q"])


def base_failed(q, rules: QualityRules):
    return (q["n_words"] < rules.min_words) | (F.lit(100) * q["n_repeat_words"] > F.lit(rules.max_repeat_percent) * q["n_words"])


def verdict(q, rules: QualityRules):
    """True where the text passes the base rule and every coverage rule."""
    chars = F.greatest(q["word_chars"], F.lit(1)).cast("double")
    words = F.greatest(q["n_words"], F.lit(1)).cast("double")
    bad = (
        (q["dup_line_chars"] / chars > rules.max_line_share)
        | (q["dup_chars_3"] / chars > rules.max_share_3)
        | (q["dup_chars_5"] / chars > rules.max_share_5)
        | (q["dup_chars_8"] / chars > rules.max_share_8)
        | (q["n_symbols"] / words > rules.max_symbols_per_word)
        | (q["n_shouts"] / words > rules.max_shouts_per_word)
        | (q["n_upper"] > rules.max_upper_share * (q["n_upper"] + q["n_lower"]))
    )
    return ~base_failed(q, rules) & ~bad


def quality_features(docs: DataFrame, text: str = "text") -> DataFrame:
    """``row`` (the whole input row) and ``q`` (its :data:`FEATURES`)."""
    small_batches(docs.sparkSession)
    packed = docs.select(F.col(text).cast("string").cast("binary").alias("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    schema = T.StructType([T.StructField("row", packed.schema["row"].dataType), T.StructField("q", FEATURES)])
    return packed.mapInArrow(_features, schema)


def score_quality(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: QualityRules = QualityRules()) -> DataFrame:
    """One row per document: features, ``base_failed`` and ``kept``."""
    scored = _narrow(docs, doc_id, text)
    q = F.col("q")
    return scored.select("doc_id", *[q[f.name].alias(f.name) for f in FEATURES], base_failed(q, rules).alias("base_failed"), verdict(q, rules).alias("kept"))


def _narrow(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    small_batches(docs.sparkSession)
    packed = docs.select(F.col(text).cast("string").cast("binary").alias("text"), F.col(doc_id).alias("row"))
    schema = T.StructType([T.StructField("doc_id", packed.schema["row"].dataType), T.StructField("q", FEATURES)])
    return packed.mapInArrow(_features, schema)


def keep_clean(docs: DataFrame, text: str = "text", rules: QualityRules = QualityRules()) -> DataFrame:
    """The documents that pass, with all their columns."""
    return quality_features(docs, text).filter(verdict(F.col("q"), rules)).select("row.*")


def op3_quality_rules(spark, sf_dir):
    from reqflow.llm.common import read_table

    return score_quality(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )
