"""Token counts without a document's token ids: pieces are counted once per distinct pre-token.

The model escapes a blank as U+2581 and puts one before the text.  None of its
pieces holds that mark after another character, so no merge crosses from a
character into a mark, and the text falls apart into pre-tokens - a run of marks
and the characters after it - that are encoded alike wherever they stand.  The
assumption is checked when the model is loaded; where it doesn't hold, the whole
text is one pre-token.

Runs of documents send their distinct pre-tokens to blocks of the hash space and
keep their documents' pre-token frequencies (:mod:`reqflow.llm.ask`).  A block
has the library count each of its distinct pre-tokens once, for the whole corpus; the counts
come back to the runs, where they are joined to the frequencies and summed.

Defined results: null and empty texts have 0 tokens; very long texts are counted
whole; ties and repeated rows are counted alike; an empty table gives an empty
table; extra columns are never read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reqflow.llm.ask import ask, block_slices, column, joined, pack, parted, rows_as_bytes, rows_from_bytes, runs_of, unpack
from reqflow.llm.common import keyed

#: Text bytes in a run of documents and, of all texts, in a block.
RUN_BYTES = 6_000_000
BLOCK_BYTES = 32_000_000
#: Pre-tokens that the library is given at once.
CALL = 20_000
MARK = "\u2581"


class PieceCounter:
    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.splits = not any(MARK in p.lstrip(MARK) for p in pieces)
        self.find = re.compile(f"[ {MARK}]+[^ {MARK}]*").findall

    def pre_tokens(self, text: str) -> Counter:
        """How often each pre-token occurs; its first mark is the one that the library adds itself."""
        if not text:
            return Counter()
        return Counter(self.find(" " + text)) if self.splits else Counter([" " + text])

    def count(self, pre_tokens: list[str]) -> np.ndarray:
        """Tokens of each pre-token."""
        out = np.empty(len(pre_tokens), np.int64)
        for lo in range(0, len(pre_tokens), CALL):
            part = pre_tokens[lo : lo + CALL]
            ids = self.model.encode([p[1:] for p in part], num_threads=1)
            out[lo : lo + len(part)] = [len(i) if len(p) > 1 else 1 for p, i in zip(part, ids, strict=True)]  # a mark alone is a piece, an empty text is none
        return out


_counters: dict[str, PieceCounter] = {}


def counter(model: str) -> PieceCounter:
    """One counter per worker process; ``model`` is a path or a public_tokenizers file name."""
    if model not in _counters:
        import public_tokenizers

        _counters[model] = PieceCounter(model if "/" in model else public_tokenizers.path(model))
    return _counters[model]


def _strings(items: list[bytes]) -> bytes:
    return pack(np.array([len(x) for x in items], np.uint32), np.frombuffer(b"".join(items), np.uint8))


def _read_strings(data: bytes) -> Iterator[bytes]:
    sizes, text = unpack(data, np.uint32, np.uint8)
    text, at = text.tobytes(), 0
    for n in sizes.tolist():
        yield text[at : at + n]
        at += n


def _questions(items: list[bytes], block: np.ndarray) -> Iterable[tuple[int, bytes]]:
    for b, at in block_slices(block):
        yield b, _strings(items[at])


def count_tokens(docs: DataFrame, model: str, limit: int = 4096, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit."""
    whole = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    size = docs.agg(F.sum(F.octet_length(whole(F.col(text))).cast("long"))).first()[0] or 0
    bits = max(3, (-(-int(size) // BLOCK_BYTES) - 1).bit_length())
    rows = keyed(docs, lambda c: whole(c(text)).alias("text"), lambda c: c(doc_id).alias("doc_id"), lambda c: F.octet_length(whole(c(text))).cast("long").alias("n_bytes"))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        c = counter(model)

        def measure(b: pa.RecordBatch) -> Iterator[tuple]:
            for t, n in zip(b.column(0), b.column(2).to_pylist(), strict=True):
                yield c.pre_tokens(t.as_py()), n + 1

        for parts, counted in runs_of(batches, measure, RUN_BYTES):
            number: dict[str, int] = {}
            at = np.array([number.setdefault(p, len(number)) for f in counted for p in f], np.int64)
            times = np.array([n for f in counted for n in f.values()], np.uint32)
            items = [p.encode() for p in number]
            block = np.array([xxhash.xxh3_64_intdigest(p) for p in items], np.uint64) >> np.uint64(64 - bits)
            order = np.argsort(block, kind="stable")  # the answers' order
            memory = pack(at.astype(np.uint32), times, np.array([len(f) for f in counted], np.uint32), order.astype(np.uint32))
            questions = _questions([items[i] for i in order.tolist()], block[order])
            yield parts[0].column(3)[0].as_py(), joined(memory, rows_as_bytes(column(parts, 1), column(parts, 2))), questions

    def answer(questions: list[bytes]) -> tuple[list[bytes], bytes]:
        number: dict[bytes, int] = {}
        asked = [np.array([number.setdefault(p, len(number)) for p in _read_strings(q)], np.int64) for q in questions]
        tokens = counter(model).count([p.decode() for p in number]).astype(np.uint32)
        return [pack(tokens[at]) for at in asked], b""

    def finish(memory: bytes, answers: dict[int, bytes]) -> pa.RecordBatch:
        frequencies, documents = parted(memory, 2)
        at, times, per, order = unpack(frequencies, np.uint32, np.uint32, np.uint32, np.uint32)
        tokens = np.zeros(len(order), np.int64)
        if answers:
            tokens[order] = np.concatenate([unpack(answers[b], np.uint32)[0] for b in sorted(answers)])
        ends = np.cumsum(per.astype(np.int64))
        sums = np.concatenate(([0], np.cumsum(tokens[at] * times.astype(np.int64))))
        ids, n_bytes = rows_from_bytes(documents)
        return pa.RecordBatch.from_arrays([ids, n_bytes, pa.array(sums[ends] - sums[ends - per])], names=["doc_id", "n_bytes", "n_tokens"])

    counted = ask(rows, send, answer, finish, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op8_token_counts(spark, sf_dir):
    from reqflow.llm.common import read_table

    return count_tokens(read_table(spark, sf_dir, "documents"), "piece_bpe_32k.model")
