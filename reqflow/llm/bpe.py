"""Byte-level BPE as a lazily determinised transducer, and its streaming decoder.

Encoding.  The tokens of a byte string's prefixes are linked: the last token of
``t[:i]`` is the one token that ends at ``i``, starts where a prefix's tokens
end, and does not merge with the token before it.  While bytes arrive, the
places where a token may still start are those whose bytes since then begin some
token; the tokens that all these places share cannot change any more and are
emitted.  A state is what can still change: for each open place the
tokens up to it and the bytes after it (a node of the tokens' trie), and the last
emitted token if a place lies right behind it.  That is bounded by the
longest token, so states and their transitions are worked out when first met and
remembered (up to a limit, after which the memory starts anew).

Decoding.  Token bytes run through a UTF-8 state machine whose state is the
unfinished character; a token's effect in a state is worked out once.

Defined results: null and empty texts give no ids (and decode to nothing); long
texts and pieces are read whole, in time linear in their length; ties and
repeated rows give equal ids; an empty table gives an empty table; extra columns
are never read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reqflow.llm.common import small_batches

#: Remembered states and pieces per worker; a full memory is emptied and filled again.
MAX_STATES = 200_000
MAX_PIECES = 300_000


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def merge_naively(piece: bytes, ranks: dict[bytes, int], whole: bool = False) -> list:
    """BPE by its definition, for short strings: join the pair of lowest rank until none is left.

    Token ids, or with ``whole`` the parts' bytes.
    """
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        rank, at = min((ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
        if rank == 1 << 60:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts if whole else [ranks[p] for p in parts]


class BpeTransducer:
    """Bytes in, token ids out, with lookahead bounded by the longest token."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = MAX_STATES):
        self.ranks, self.max_states = ranks, max_states
        self.bytes_of = {r: t for t, r in ranks.items()}
        # A trie of the tokens: child[node << 8 | byte], the token that ends in a node, and whether any goes on.
        self.child: dict[int, int] = {}
        self.token: list[int] = [-1]
        self.goes_on: list[bool] = [True]
        for text, rank in ranks.items():
            node = 0
            for byte in text:
                self.goes_on[node] = True
                to = self.child.get(node << 8 | byte)
                if to is None:
                    to = self.child[node << 8 | byte] = len(self.token)
                    self.token.append(-1)
                    self.goes_on.append(False)
                node = to
            self.token[node] = rank
        self.apart: dict[int, bool] = {}
        self.edges: dict[tuple[int, bool], list[bytes]] = {}
        self._forget()

    def _forget(self) -> None:
        self.step: dict[int, tuple[int, tuple[int, ...]]] = {}
        start = (-1, ((), 0))
        self.number = {start: 0}
        self.states = [start]

    def _edge(self, token: int, right: bool) -> list[bytes]:
        """The parts that stand at a token's right (left) end while BPE builds it, smallest first."""
        known = self.edges.get((token, right))
        if known is None:
            known, text = [], self.bytes_of[token]
            while len(text) > 1:
                known.append(text)
                halves = merge_naively(text, {t: r for t, r in self._inner(text) if t != text}, whole=True)
                text = halves[-1] if right else halves[0]
            known.append(text)
            known.reverse()
            self.edges[token, right] = known
        return known

    def _inner(self, text: bytes) -> Iterator[tuple[bytes, int]]:
        for i in range(len(text)):
            for j in range(i + 1, len(text) + 1):
                if (r := self.ranks.get(text[i:j])) is not None:
                    yield text[i:j], r

    def _stay_apart(self, a: int, b: int) -> bool:
        """Whether tokens a and b stay two when BPE works on their joined bytes.

        Merges happen in order of rank.  Only the parts at the seam matter: they
        grow as in a and b alone unless the pair across the seam comes first.
        """
        left, right = self._edge(a, True), self._edge(b, False)
        rank, never, i, j = self.ranks.get, 1 << 60, 0, 0
        while True:
            across = rank(left[i] + right[j], never)
            grow_left = rank(left[i + 1]) if i + 1 < len(left) else never
            grow_right = rank(right[j + 1]) if j + 1 < len(right) else never
            if across < grow_left and across <= grow_right:
                return False
            if grow_left == grow_right == never:
                return True
            if grow_left <= grow_right:
                i += 1
            else:
                j += 1

    def _advance(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        before, places = self.states[state]
        child, token_at, goes_on, apart = self.child, self.token, self.goes_on, self.apart
        grown: list = []
        ended = None
        for k in range(0, len(places), 2):
            node = child.get(places[k + 1] << 8 | byte)
            if node is None:
                continue
            token = token_at[node]
            if token >= 0 and ended is None:
                tokens = places[k]
                last = tokens[-1] if tokens else before
                if last >= 0:
                    pair = last << 32 | token
                    fine = apart.get(pair)
                    if fine is None:
                        if len(apart) > 4 * self.max_states:
                            apart.clear()
                        fine = apart[pair] = self._stay_apart(last, token)
                else:
                    fine = True
                if fine:
                    ended = (*tokens, token)
            if goes_on[node]:
                grown.append(places[k])
                grown.append(node)
        if not grown:  # nothing but the new end is open: all is settled
            out = ended
            key = (ended[-1], ((), 0))
        else:
            grown.append(ended)
            grown.append(0)
            shared = 0
            first = grown[0]
            while shared < len(first):
                t = first[shared]
                if any(len(x) <= shared or x[shared] != t for x in grown[2::2]):
                    break
                shared += 1
            out = ended[:shared]
            if shared:
                before = out[-1]
                grown[::2] = [x[shared:] for x in grown[::2]]
            # What was emitted last matters only to a place right behind it.
            key = (before if () in grown[::2] else -1, tuple(grown))
        to = self.number.get(key)
        if to is None:
            to = self.number[key] = len(self.states)
            self.states.append(key)
        found = self.step[state << 8 | byte] = (to, out)
        return found

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self.states) > self.max_states:
            self._forget()
        out: list[int] = []
        state, step = 0, self.step
        for n, byte in enumerate(piece):
            found = step.get(state << 8 | byte)
            if found is None:
                found = self._advance(state, byte)
            state = found[0]
            if found[1]:
                out += found[1]
            if not n & 0xFFFF and len(self.states) > 2 * self.max_states:  # within one very long piece
                key = self.states[state]
                self._forget()
                step = self.step
                state = self.number.setdefault(key, len(self.states))
                if state == len(self.states):
                    self.states.append(key)
        return out + list(self.states[state][1][-2])


class Utf8Decoder:
    """Token ids in, whole characters out; unfinished ones wait for the next token.

    Bytes that no UTF-8 text holds are passed on as they are, so the output
    is the tokens' bytes exactly.
    """

    class _Table(dict):
        def __init__(self, owner: Utf8Decoder, pending: bytes):
            super().__init__()
            self.owner, self.pending = owner, pending

        def __missing__(self, token: int):
            done, pending = Utf8Decoder.run(self.pending, self.owner.bytes_of[token])
            found = self[token] = (done, self.owner.table(pending))
            return found

    def __init__(self, bytes_of: dict[int, bytes]):
        self.bytes_of = bytes_of
        self.tables: dict[bytes, Utf8Decoder._Table] = {}

    def table(self, pending: bytes) -> _Table:
        return self.tables.setdefault(pending, self._Table(self, pending))

    @staticmethod
    def needed(lead: int) -> int:
        """Bytes of the character that starts with ``lead``; 1 also for what can't start one."""
        return 2 if 0xC2 <= lead <= 0xDF else 3 if 0xE0 <= lead <= 0xEF else 4 if 0xF0 <= lead <= 0xF4 else 1

    @staticmethod
    def may_follow(pending: bytes, byte: int) -> bool:
        """Whether ``byte`` continues the character begun by ``pending``."""
        if len(pending) == 1:
            low = {0xE0: 0xA0, 0xF0: 0x90}.get(pending[0], 0x80)
            high = {0xED: 0x9F, 0xF4: 0x8F}.get(pending[0], 0xBF)
            return low <= byte <= high
        return 0x80 <= byte <= 0xBF

    @classmethod
    def run(cls, pending: bytes, data: bytes) -> tuple[bytes, bytes]:
        """Finished bytes and the unfinished character after ``data``."""
        done = bytearray()
        for byte in data:
            if pending and not cls.may_follow(pending, byte):
                done += pending
                pending = b""
            pending += bytes((byte,))
            if len(pending) >= cls.needed(pending[0]):
                done += pending
                pending = b""
        return bytes(done), pending

    def decode(self, ids: list[int]) -> Iterator[bytes]:
        table = self.table(b"")
        for i in ids:
            done, table = table[i]
            yield done
        if table.pending:
            yield table.pending


class BpeCodec:
    """Pieces by a pattern, ids by the transducer, text back by the decoder."""

    def __init__(self, path: str, pattern: str):
        import regex

        self.ranks = load_ranks(path)
        self.pieces = regex.compile(pattern).findall
        self.transducer = BpeTransducer(self.ranks)
        self.decoder = Utf8Decoder(self.transducer.bytes_of)
        self.known: dict[str, list[int]] = {}

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        known = self.known
        if len(known) > MAX_PIECES:
            known.clear()
        for p in self.pieces(text):
            ids = known.get(p)
            if ids is None:
                ids = self.transducer.encode(p.encode())
                if len(p) < 64:
                    known[p] = ids
            out += ids
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(self.decoder.decode(ids))


_codecs: dict[tuple, BpeCodec] = {}


def codec(vocabulary: str, pattern: str | None = None) -> BpeCodec:
    """One codec per worker process; ``vocabulary`` is a path or a public_tokenizers file name."""
    if (vocabulary, pattern) not in _codecs:
        import public_tokenizers

        path = vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary)
        _codecs[vocabulary, pattern] = BpeCodec(path, pattern or public_tokenizers.PATTERN)
    return _codecs[vocabulary, pattern]


def encode_documents(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids (array of int)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocabulary)
        for b in batches:
            ids = pa.array([c.encode(t or "") for t in b.column(1).to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(0), ids], names=["doc_id", "ids"])

    small_batches(docs.sparkSession)
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return narrow.mapInArrow(run, f"doc_id {narrow.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode_documents(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, decoded (binary), from doc_id and ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocabulary)
        for b in batches:
            out = pa.array([c.decode(x or []) for x in b.column(1).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), out], names=["doc_id", "decoded"])

    narrow = encoded.select("doc_id", "ids")
    return narrow.mapInArrow(run, f"doc_id {narrow.schema['doc_id'].dataType.simpleString()}, decoded binary")


def round_trip_digests(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encode, then decode those ids, batch by batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocabulary)
        decimal = [str(i) for i in range(max(c.ranks.values(), default=0) + 1)].__getitem__
        for b in batches:
            n, ids_sha, back_sha = [], [], []
            for t in b.column(1).to_pylist():
                ids = c.encode(t or "")
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(",".join(map(decimal, ids)).encode()).hexdigest())
                back_sha.append(hashlib.sha256(c.decode(ids)).hexdigest())
            cols = [b.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(back_sha, pa.string())]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    small_batches(docs.sparkSession)
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op10_bpe_round_trip(spark, sf_dir):
    from reqflow.llm.common import read_table

    return round_trip_digests(read_table(spark, sf_dir, "documents"), "byte_bpe_multi_50k.tiktoken")
