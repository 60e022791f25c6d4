"""Language-model scores from a log-frequency Bloom filter, and exact unigram scores.

Counts of words and word pairs are quantised on a log scale, and an n-gram of
level q is entered in a Bloom filter as (n-gram, 1) ... (n-gram, q).  A level is read
back by probing until one is missing.  The filter is sized from what is entered, so
every n-gram of the training texts is held at every size.

Up to ``max_bits`` - a bound that follows from the number of training tokens alone,
see :func:`most_bits` - the filter is built by blocks of the hash space, gathered,
and broadcast with the exact word counts; documents are scored where they are read.

A larger filter isn't broadcast but stays in its blocks, and the n-grams come to
it (:mod:`reqflow.llm.ask`): each run of documents sends every block its distinct words and pairs, with
their counts in its training texts.  The block merges the counts, builds its part of the
filter, probes it for every n-gram it was sent and sends levels and exact word counts
back to the runs.  Texts are read and tokenised once.  A run sends one list to each block in
which it has an n-gram; pairs are named by 40 bits within their block.

``score`` sums log10 P(w | v) = log10 ((c(vw) + m p(w)) / (c(v) + m)) with
m = MU + MU_SHARE c(v) and p(w) = (c(w) + 1) / (2 N + 1), N training tokens; counts above
are read as the lower end of their level and c(v) as the upper one, so that the probabilities
sum to at most 1 but for the filter's false positives.  ``base_score`` is exact.

Defined results: null and empty texts hold one token, the end; long texts are
scored whole; a null doc_id counts as the empty string and is in training;
repeated rows count and are scored each; an empty table gives an empty table;
extra columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reqflow.llm.ask import ask, block_slices, column, joined, pack, parted, rows_as_bytes, rows_from_bytes, runs_of, unpack
from reqflow.llm.common import WordHasher, ascii_lower, keyed, mix64, saved

BETA = 1.2
MU, MU_SHARE = 1.0, 4.0
PROBES = 4
BITS_PER_ENTRY = 10
#: Tokens in a run of documents; text bytes per block.
RUN_TOKENS = 1_000_000
BLOCK_BYTES = 16_000_000
#: Bits that tell the pairs of a block apart.
PAIR_BITS = 40
WORD = r"[^\x20\x09-\x0D]+"
END = np.uint64(0x5EED0F7E47E4D000)
_PAIR, _STEP, _PROBE = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)
_UNIGRAM, _BIGRAM = np.uint64(0x1B00000000000000), np.uint64(0x2B00000000000000)

_hasher = WordHasher()


def tokens(text: bytes) -> np.ndarray:
    """Hashes of the words of a lower-cased text, then the end."""
    words = text.split()
    out = np.empty(len(words) + 1, np.uint64)
    out[:-1] = _hasher.many(words)
    out[-1] = END
    return out


class Run:
    """Documents' tokens: distinct words (sorted hashes), each token's word, and each text's size."""

    def __init__(self, words: np.ndarray, at: np.ndarray, sizes: np.ndarray):
        self.words, self.at, self.sizes = words, at, sizes
        self.doc = np.repeat(np.arange(len(sizes)), sizes)
        before = np.empty_like(at)
        before[1:] = at[:-1]
        before[np.cumsum(sizes) - sizes] = np.searchsorted(words, END)  # the end stands before the first
        self.before = before

    @classmethod
    def of(cls, texts: list[np.ndarray]) -> Run:
        words, at = np.unique(np.concatenate(texts), return_inverse=True)
        return cls(words, at, np.array([len(t) for t in texts]))

    def pairs(self, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys of the distinct pairs - block, then PAIR_BITS bits - sorted; a place of each, and each token's pair."""
        h = mix64(self.words[self.before] * _PAIR + self.words[self.at])
        return np.unique(h >> np.uint64(64 - PAIR_BITS - bits), return_index=True, return_inverse=True)

    def pack(self) -> bytes:
        """Words by frequency, so that the tokens' numbers are small."""
        often = np.argsort(-np.bincount(self.at, minlength=len(self.words)), kind="stable")
        rank = np.empty(len(often), np.uint32)
        rank[often] = np.arange(len(often), dtype=np.uint32)
        return pack(self.words[often], rank[self.at], self.sizes.astype(np.int64))

    @classmethod
    def unpack(cls, data: bytes) -> Run:
        words, at, sizes = unpack(data, np.uint64, np.uint32, np.int64)
        order = np.argsort(words)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        return cls(words[order], place[at], sizes)

    def questions(self, bits: int, training: np.ndarray) -> Iterator[tuple[int, bytes]]:
        """(block, packed words, their training counts, pairs, theirs); ``training`` says which texts count."""
        counted = training[self.doc].astype(np.float64)
        uni = np.bincount(self.at, counted, len(self.words)).astype(np.uint32)
        keys, _, where = self.pairs(bits)
        bi = np.bincount(where, counted, len(keys)).astype(np.uint32)
        w = dict(block_slices(word_block(self.words, bits)))
        p = dict(block_slices(keys >> np.uint64(PAIR_BITS)))
        rest, none = keys & np.uint64((1 << PAIR_BITS) - 1), slice(0, 0)
        for b in sorted(w.keys() | p.keys()):
            i, j = w.get(b, none), p.get(b, none)
            yield b, pack(self.words[i], uni[i], rest[j], bi[j])


def word_block(words: np.ndarray, bits: int) -> np.ndarray:
    return words >> np.uint64(64 - bits)


def levels(counts: np.ndarray) -> np.ndarray:
    """Level 1, 2, ... of counts; 0 of 0."""
    q = np.floor(np.log(np.maximum(counts, 1)) / np.log(BETA) + 1e-9).astype(np.int64) + 1
    return np.where(counts > 0, q, 0)


def least_count(q: np.ndarray) -> np.ndarray:
    """The least count of level q (0 for level 0)."""
    return np.where(q > 0, np.ceil(BETA ** (q - 1.0) - 1e-6), 0.0)


def most_count(q: np.ndarray) -> np.ndarray:
    """The largest count of level q."""
    return np.ceil(BETA ** q.astype(float) - 1e-6) - 1


def most_bits(n: int) -> int:
    """A bound of the filter's bits for ``n`` training tokens: no level is more than 7/3 of its count, and there are two n-grams a token."""
    return -(-14 * n // 3) * BITS_PER_ENTRY


def _times(n: int, step: np.uint64) -> np.uint64:
    return np.uint64(n * int(step) & 0xFFFFFFFFFFFFFFFF)


def _places(h: np.ndarray, level: int, size) -> Iterator[np.ndarray]:
    x = mix64(h + _times(level, _STEP))
    for i in range(PROBES):
        yield (mix64(x + _times(i, _PROBE)) % np.asarray(size, np.uint64)).astype(np.int64)


def build_filter(h: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The bits of a filter (packed) that holds the levels of the salted hashes."""
    q = levels(counts)
    table = np.zeros(max(64, -(-int(q.sum()) * BITS_PER_ENTRY // 64) * 64), bool)
    h, q = h[q > 0], q[q > 0]
    level = 1
    while len(h):
        for at in _places(h, level, len(table)):
            table[at] = True
        level += 1
        h, q = h[q >= level], q[q >= level]
    return np.packbits(table, bitorder="little")


def probe(table: np.ndarray, h: np.ndarray, size: np.ndarray | int, offset: np.ndarray | int = 0) -> np.ndarray:
    """Levels read from a filter: probe level after level until one is missing."""
    out = np.zeros(len(h), np.int64)
    alive, level = np.arange(len(h)), 0
    of = lambda x: x if np.isscalar(x) else x[alive]
    while len(alive):
        level += 1
        there = np.ones(len(alive), bool)
        for at in _places(h[alive], level, of(size)):
            at += of(offset)
            there &= (table[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
        alive = alive[there]
        out[alive] = level
    return out


class Block:
    """A block's merged counts and its part of the filter."""

    def __init__(self, questions: list[bytes]):
        self.parts = [unpack(q, np.uint64, np.uint32, np.uint64, np.uint32) for q in questions]
        self.words, self.word_at, self.word_counts = self._merge(0)
        self.pairs, self.pair_at, self.pair_counts = self._merge(2)
        self.filter = build_filter(np.concatenate((self.words ^ _UNIGRAM, self.pairs ^ _BIGRAM)), np.concatenate((self.word_counts, self.pair_counts)))

    def _merge(self, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        values, at = np.unique(np.concatenate([p[i] for p in self.parts]), return_inverse=True)
        counts = np.bincount(at, np.concatenate([p[i + 1] for p in self.parts]).astype(np.float64), len(values))
        return values, at, counts.astype(np.int64)

    def figures(self) -> tuple[int, int]:
        """Training tokens and distinct training words."""
        return int(self.word_counts.sum()), int((self.word_counts > 0).sum())

    def answers(self) -> list[bytes]:
        """For each question: exact counts and levels of its words, levels of its pairs."""
        size = 8 * len(self.filter)
        word_levels = probe(self.filter, self.words ^ _UNIGRAM, size).astype(np.uint8)
        pair_levels = probe(self.filter, self.pairs ^ _BIGRAM, size).astype(np.uint8)
        out, i, j = [], 0, 0
        for p in self.parts:
            w, q = self.word_at[i : i + len(p[0])], self.pair_at[j : j + len(p[2])]
            i, j = i + len(p[0]), j + len(p[2])
            out.append(pack(self.word_counts[w], word_levels[w], pair_levels[q]))
        return out


def document_scores(run: Run, first, where, counts, word_levels, pair_levels, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per document: tokens that are known, sum of log10(c + 1), and the model's log10 probability."""
    docs = len(run.sizes)
    known = np.bincount(run.doc, (counts > 0)[run.at].astype(float), docs).astype(np.int64)
    part = np.bincount(run.doc, np.log10(counts + 1.0)[run.at], docs)
    v, w = run.before[first], run.at[first]
    upper, lower = most_count(word_levels), least_count(word_levels)
    before = upper[v]
    seen = np.minimum(np.minimum(least_count(pair_levels), before), upper[w])  # no more than either word, should a probe be wrong
    weight = MU + MU_SHARE * before
    logs = np.log10((seen + weight * (lower[w] + 1.0) / (2.0 * n + 1.0)) / (before + weight))
    return known, part, np.bincount(run.doc, logs[where], docs)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[pa.RecordBatch], Run, np.ndarray]]:
    """Runs of (text, doc_id, held_out, rk) rows: their rows, tokens, and which are in training."""

    def measure(b: pa.RecordBatch) -> list:
        found = [tokens(t.as_py()) for t in b.column(0)]
        return [(h, len(h)) for h in found]

    for parts, texts in runs_of(batches, measure, RUN_TOKENS):
        yield parts, Run.of(texts), ~column(parts, 2).to_numpy(zero_copy_only=False)


OUT = "doc_id {id}, held_out boolean, n_tokens long, n_known long, part double, score double, n long, v long"


def _scored(doc_id: pa.Array, held_out: pa.Array, sizes, known, part, score) -> pa.RecordBatch:
    none = pa.nulls(len(doc_id), pa.int64())
    return pa.RecordBatch.from_arrays(
        [doc_id, held_out, pa.array(sizes, pa.int64()), pa.array(known), pa.array(part), pa.array(score), none, none],
        names=[x.split()[0] for x in OUT.split(", ")],
    )


def score_in_blocks(rows: DataFrame, bits: int, n: int) -> DataFrame:
    """Rows of OUT: one per document, and one per block with its share of the tokens (n) and distinct words (v)."""
    kind = rows.schema["doc_id"].dataType

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for parts, run, training in _runs(batches):
            memory = joined(run.pack(), rows_as_bytes(column(parts, 1), column(parts, 2)))
            yield parts[0].column(3)[0].as_py(), memory, run.questions(bits, training)

    def answer(questions: list[bytes]) -> tuple[list[bytes], bytes]:
        block = Block(questions)
        return block.answers(), pack(np.array(block.figures(), np.int64))

    def finish(memory: bytes, answers: dict[int, bytes]) -> pa.RecordBatch:
        tokens_of, documents = parted(memory, 2)
        run = Run.unpack(tokens_of)
        _, first, where = run.pairs(bits)
        found = [unpack(answers[b], np.int64, np.uint8, np.uint8) for b in sorted(answers)]
        counts, word_levels, pair_levels = (np.concatenate([f[i] for f in found]) for i in range(3))
        known, part, score = document_scores(run, first, where, counts, word_levels, pair_levels, n)
        return _scored(*rows_from_bytes(documents), run.sizes, known, part, score)

    def figures(report: bytes) -> pa.RecordBatch:
        n_here, v_here = unpack(report, np.int64)[0].tolist()
        from pyspark.sql.pandas.types import to_arrow_type

        types = [to_arrow_type(kind), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        return pa.RecordBatch.from_arrays([*[pa.nulls(1, t) for t in types], pa.array([n_here]), pa.array([v_here])], names=[x.split()[0] for x in OUT.split(", ")])

    return ask(rows, send, answer, finish, OUT.format(id=kind.simpleString()), figures)


@dataclass
class Model:
    """A filter small enough to be broadcast, and the exact word counts."""

    n: int
    bits: int
    size: np.ndarray
    offset: np.ndarray
    filter: np.ndarray
    words: np.ndarray
    counts: np.ndarray

    @property
    def v(self) -> int:
        return len(self.words)

    @classmethod
    def fit(cls, rows: DataFrame, bits: int) -> Model:
        """From the training rows; what the driver gathers is bounded by :func:`most_bits` and 16 bytes a training token."""

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for _, run, training in _runs(batches):
                blocks, payloads = zip(*run.questions(bits, training), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array(payloads, pa.binary())], names=["block", "payload"])

        def merge(table: pa.Table) -> pa.Table:
            b = Block(table.column("payload").to_pylist())
            return pa.table({"block": [table.column("block")[0].as_py()], "filter": [b.filter.tobytes()], "words": [pack(b.words, b.word_counts)]})

        merged = rows.filter("not held_out").mapInArrow(count, "block long, payload binary").groupBy("block").applyInArrow(merge, "block long, filter binary, words binary")
        size, filters = np.full(1 << bits, 64, np.int64), [bytes(8)] * (1 << bits)
        words, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for r in sorted(merged.collect(), key=lambda r: r.block):
            size[r.block], filters[r.block] = 8 * len(r["filter"]), bytes(r["filter"])
            w, c = unpack(bytes(r["words"]), np.uint64, np.int64)
            words.append(w)
            counts.append(c)
        offset = np.concatenate(([0], np.cumsum(size)[:-1]))
        counts = np.concatenate(counts)
        return cls(int(counts.sum()), bits, size, offset, np.frombuffer(b"".join(filters), np.uint8), np.concatenate(words), counts)

    def word_counts(self, words: np.ndarray) -> np.ndarray:
        if not self.v:
            return np.zeros(len(words), np.int64)
        i = np.minimum(np.searchsorted(self.words, words), self.v - 1)
        return np.where(self.words[i] == words, self.counts[i], 0)

    def levels_of(self, h: np.ndarray, block: np.ndarray) -> np.ndarray:
        block = block.astype(np.int64)
        return probe(self.filter, h, self.size[block], self.offset[block])


def score_by_broadcast(rows: DataFrame, model: Model) -> DataFrame:
    """Rows of OUT, one per document, scored where they are read."""
    held = rows.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = held.value
        for parts, run, _ in _runs(batches):
            keys, first, where = run.pairs(m.bits)
            word_levels = m.levels_of(run.words ^ _UNIGRAM, word_block(run.words, m.bits))
            pair_levels = m.levels_of((keys & np.uint64((1 << PAIR_BITS) - 1)) ^ _BIGRAM, keys >> np.uint64(PAIR_BITS))
            known, part, total = document_scores(run, first, where, m.word_counts(run.words), word_levels, pair_levels, m.n)
            yield _scored(column(parts, 1), column(parts, 2), run.sizes, known, part, total)

    return rows.mapInArrow(score, OUT.format(id=rows.schema["doc_id"].dataType.simpleString()))


def score_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", folds: int = 7, held_out_fold: int = 2, max_bits: int = 1 << 28) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: one row per input row.

    ``max_bits`` bounds what is broadcast, not what the filter holds.
    """

    def held_out(name):
        return F.crc32(F.coalesce(name.cast("string"), F.lit("")).cast("binary")) % folds == held_out_fold

    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    trained = F.sum(F.when(~held_out(F.col(doc_id)), F.regexp_count(whole, F.lit(WORD)) + 1).cast("long"))
    size, n = docs.agg(F.sum(F.octet_length(whole).cast("long")), trained).first()
    n = int(n or 0)
    bits = max(3, (-(-int(size or 0) // BLOCK_BYTES) - 1).bit_length())
    rows = keyed(docs, lambda c: ascii_lower(c(text)).cast("binary").alias("text"), lambda c: c(doc_id).alias("doc_id"), lambda c: held_out(c(doc_id)).alias("held_out"))
    if most_bits(n) <= max_bits:
        model = Model.fit(rows, bits)
        scored, n, v = score_by_broadcast(rows, model), model.n, model.v
    else:
        scored = saved(score_in_blocks(rows, bits, n))
        n, v = (int(x or 0) for x in scored.agg(F.sum("n"), F.sum("v")).first())
        scored = scored.filter("v is null")
    base = F.col("part") - F.col("n_tokens") * F.log10(F.lit(float(n + v + 1)))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), base.alias("base_score"), "score")


def op5_lm_score(spark, sf_dir):
    from reqflow.llm.common import read_table

    return score_documents(read_table(spark, sf_dir, "documents"))
