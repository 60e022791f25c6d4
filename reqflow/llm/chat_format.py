"""Chat formatting from event logs: fold what happened into final messages, then render them with a loss mask.

An event has conv_id, seq (its place in the log), message (number of the message it is about, in order of the conversation),
kind, role and text:

* ``start`` and ``delta`` add their text to the message, in order of seq;
* ``edit`` puts its text in place of what the message had before;
* ``regenerate`` empties its message and takes away all later ones, as they were then; what comes after it begins anew.

So an event counts if no regeneration of its message or an earlier one comes after it, and no later edit of its message.
Logs are partitioned by conversation and sorted by message, then regenerations, then edits, then sequence. In that order one pass knows what
a message's events are worth before it sees them, and keeps no more than the last edit: deltas go on to the output as they come, so a conversation or
message of any length takes no more memory than its largest event.  (Its events are still read by one task: the contract's hashes run from first to last.)

Rendering: a user's message is ``[INST] text [/INST]``, an assistant's ``<s> text </s>``, any other role's ``<<SYS>> n role text <</SYS>>``, n being
the length of the role as written.  In roles and texts a backslash is doubled and one is put after the first character of each control string,
so that none is left; this is undone exactly.  The loss mask covers the assistant's texts.  A rendered conversation is one or more rows, cut at some
``PIECE`` characters: conv_id, part, formatted, loss (spans within the row).  :func:`read_back` parses them again.

Defined results: null roles and texts are empty; a null seq comes first, a null message is number 0, a null or unknown kind is a delta; a null conv_id
is a conversation of its own; equal seqs go by kind (regenerate, edit, others), then message, then text; repeated rows are events; a message's role is that of
the first event that counts, in the order above; messages without an event that counts don't exist, nor conversations without messages;
long texts are read whole; an empty table gives an empty table; extra columns, whatever their names, are never read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reqflow.llm.common import small_batches

#: Characters of a rendered row, about, and of a streamed delta in the query's log.
PIECE = 65_536
DELTA = 2_000
#: Fixed values of the template: control strings by role.
USER = ("[INST]", "[/INST]")
ASSISTANT = ("<s>", "</s>")
OTHER = ("<<SYS>>", "<</SYS>>")
CONTROLS = (*USER, *ASSISTANT, *OTHER)
_LONGEST = max(map(len, CONTROLS))
_CONTROL = re.compile("|".join(map(re.escape, CONTROLS)))
_ESCAPED = re.compile(r"\\|" + _CONTROL.pattern)
_PAIR = re.compile(r"\\(.)", re.DOTALL)
RENDERED = "part long, formatted string, loss array<struct<start: int, end: int>>"
_LOSS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def escape(text: str) -> str:
    """``text`` without control strings, reversibly."""
    return _ESCAPED.sub(lambda m: "\\\\" if m[0] == "\\" else m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _PAIR.sub(r"\1", text)


class _Escaper:
    """:func:`escape` of a text that comes in pieces."""

    def __init__(self):
        self.rest = ""

    def push(self, text: str) -> str:
        text = self.rest + text
        cut = max(0, len(text) - _LONGEST + 1)
        for m in _CONTROL.finditer(text):
            if m.start() < cut:
                cut = max(cut, m.end())
        self.rest = text[cut:]
        return escape(text[:cut])

    def close(self) -> str:
        out, self.rest = escape(self.rest), ""
        return out


class _Unescaper:
    """:func:`unescape` of a text that comes in pieces."""

    def __init__(self):
        self.rest = ""

    def push(self, text: str) -> str:
        text = self.rest + text
        odd = (len(text) - len(text.rstrip("\\"))) % 2
        self.rest = text[len(text) - odd :]
        return unescape(text[: len(text) - odd])


def fold(events: Iterator[tuple]) -> Iterator[tuple]:
    """(conv_id, None, role) at each message that exists, then (conv_id, text, None) for its text piece by piece.

    ``events``: conv_id, message, rank (0 regenerate, 1 edit, 2 others), seq, role, text, in this order.
    """
    nothing = object()
    conv, message = nothing, nothing
    cut = own = None  # sequences: the last regeneration of this message or an earlier one; of this one
    edit = None  # (seq, role, text) of the last edit that counts
    regenerated = None  # role of this message's regeneration
    opened = False

    def begun() -> Iterator[tuple]:
        """What a message starts with, once its regenerations and edits are known."""
        nonlocal opened
        counts = own is not None and own == cut
        if not opened and (counts or edit):
            opened = True
            yield conv, None, regenerated if counts else edit[1]
            if edit:
                yield conv, edit[2], None

    for c, m, rank, seq, role, text in events:
        if (c, m) != (conv, message):
            if message is not nothing:
                yield from begun()
            if c != conv or conv is nothing:
                cut = None
            conv, message, own, edit, opened = c, m, None, None, False
        if rank == 0:
            own, regenerated = seq, role
            cut = seq if cut is None else max(cut, seq)
        elif rank == 1:
            if cut is None or seq >= cut:
                edit = (seq, role, text)
        else:
            yield from begun()
            if (cut is None or seq >= cut) and (edit is None or seq >= edit[0]):
                if not opened:
                    opened = True
                    yield conv, None, role
                yield conv, text, None
    if message is not nothing:
        yield from begun()


def render(messages: Iterator[tuple], piece: int = PIECE) -> Iterator[tuple]:
    """(conv_id, part, formatted, loss) of :func:`fold`'s messages."""
    nothing = object()
    conv, part = nothing, 0
    out: list[str] = []
    size = 0
    loss: list[dict] = []
    closing = None
    learn = False
    escaper = _Escaper()

    def put(text: str, masked: bool = False) -> None:
        nonlocal size
        if text:
            if masked and loss and loss[-1]["end"] == size and loss[-1]["open"]:
                loss[-1]["end"] += len(text)
            elif masked:
                loss.append({"start": size, "end": size + len(text), "open": True})
            out.append(text)
            size += len(text)

    def row() -> tuple:
        nonlocal out, size, loss, part
        made = (conv, part, "".join(out), [{"start": x["start"], "end": x["end"]} for x in loss])
        out, size, loss, part = [], 0, [], part + 1
        return made

    def close() -> None:
        if closing:
            put(escaper.close(), learn)
            if loss:
                loss[-1]["open"] = False
            put(f" {closing}")

    for c, text, role in messages:
        if text is None:
            close()
            if c != conv or conv is nothing:
                if conv is not nothing:
                    yield row()
                conv, part = c, 0
            learn = role == "assistant"
            opening, closing = USER if role == "user" else ASSISTANT if learn else OTHER
            put(f"{opening} ")
            if opening == OTHER[0]:
                name = escape(role)
                put(f"{len(name)} {name} ")
        else:
            for i in range(0, len(text), piece):
                put(escaper.push(text[i : i + piece]), learn)
                if size >= piece:
                    yield row()
    close()
    if conv is not nothing:
        yield row()


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*[c.to_pylist() for c in b.columns], strict=True)


def render_conversations(events: DataFrame, together: bool = False, piece: int = PIECE) -> DataFrame:
    """conv_id, part, formatted, loss: the final messages of event logs, rendered; rows of a conversation are in order in one task.

    ``together``: the events of a conversation lie in one task already.
    """
    small_batches(events.sparkSession)
    kind = F.coalesce(F.col("kind"), F.lit("delta"))
    rank = F.when(kind == "regenerate", 0).when(kind == "edit", 1).otherwise(2)
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = events if together else events.repartition("conv_id")
    rows = rows.select(
        "conv_id", F.coalesce(F.col("message").cast("long"), F.lit(0)).alias("message"), rank.alias("rank"),
        F.coalesce(F.col("seq").cast("long"), F.lit(-(1 << 63)).cast("long")).alias("seq"), text("role").alias("role"), text("text").alias("text"),
    )
    ordered = rows.sortWithinPartitions("conv_id", "message", "rank", "seq", "text")
    id_type = ordered.schema["conv_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def batch() -> pa.RecordBatch:
            cols = list(zip(*held, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.from_numpy_dtype("int64") if isinstance(id_type, T.LongType) else None, pa.int64(), pa.string(), _LOSS), strict=True)], names=["conv_id", "part", "formatted", "loss"])

        for r in render(fold(_records(batches)), piece):
            held.append(r)
            size += len(r[2])
            if size >= 4 * PIECE or len(held) >= 1000:
                yield batch()
                held, size = [], 0
        if held:
            yield batch()

    return ordered.mapInArrow(run, f"conv_id {id_type.simpleString()}, {RENDERED}")


class _Reader:
    """Parses one conversation as its rows come; digests and counts of what was read."""

    def __init__(self):
        self.n_turns = self.loss_chars = self.formatted_chars = 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.buffer, self.closing = "", None
        self.text, self.masked = _Unescaper(), _Unescaper()

    def _say(self, text: str) -> None:
        self.turns.update(text.encode("utf-8", "surrogatepass"))

    def _open(self) -> bool:
        """Take a message's head from the buffer, if all of it is there."""
        for opening, closing, role in ((*USER, "user"), (*ASSISTANT, "assistant"), (*OTHER, None)):
            if self.buffer.startswith(f"{opening} "):
                rest = self.buffer[len(opening) + 1 :]
                if role is None:
                    number, space, rest = rest.partition(" ")
                    if not space or len(rest) <= int(number):
                        return False
                    role, rest = unescape(rest[: int(number)]), rest[int(number) + 1 :]
                self.buffer, self.closing = rest, closing
                self.n_turns += 1
                self._say(role + "\n")
                return True
        return False

    def take(self, formatted: str, loss: list) -> None:
        self.formatted_chars += len(formatted)
        for span in loss:
            plain = self.masked.push(formatted[span["start"] : span["end"]])
            self.loss_chars += len(plain)
            self.loss.update(plain.encode("utf-8", "surrogatepass"))
        self.buffer += formatted
        while True:
            if self.closing is None and not self._open():
                return
            end = self.buffer.find(f" {self.closing}")
            if end < 0:
                keep = max(0, len(self.buffer) - len(self.closing))
                self._say(self.text.push(self.buffer[:keep]))
                self.buffer = self.buffer[keep:]
                return
            self._say(self.text.push(self.buffer[:end]) + "\n")
            self.buffer, self.closing = self.buffer[end + 1 + len(self.closing) :], None

    def result(self) -> tuple:
        if self.buffer or self.closing or self.text.rest or self.masked.rest:
            raise ValueError("a rendered conversation is cut short")
        return self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted_chars


def read_back(rendered: DataFrame, together: bool = True) -> DataFrame:
    """conv_id, n_turns, turns_sha256 (role, LF, text, LF per turn), loss_chars, loss_sha256 (text under the mask) and formatted_chars, parsed from rendered rows.

    ``together``: the rows come from :func:`render_conversations` itself; else they are brought together and sorted first.
    """
    names = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    rows = rendered.select("conv_id", "part", "formatted", "loss")
    if not together:
        rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    id_type = rows.schema["conv_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = object()
        conv, reader, done = nothing, _Reader(), []

        def batch() -> pa.RecordBatch:
            cols = list(zip(*done, strict=True))
            types = (pa.int64() if isinstance(id_type, T.LongType) else None, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["conv_id", *names])

        for c, _, formatted, loss in _records(batches):
            if c != conv or conv is nothing:
                if conv is not nothing:
                    done.append((conv, *reader.result()))
                    if len(done) >= 10_000:
                        yield batch()
                        done = []
                conv, reader = c, _Reader()
            reader.take(formatted, loss)
        if conv is not nothing:
            done.append((conv, *reader.result()))
        if done:
            yield batch()

    return rows.mapInArrow(run, f"conv_id {id_type.simpleString()}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def log_of(turns: DataFrame) -> DataFrame:
    """The event log that conversations (conv_id, turn, role, text) come from; a conversation's events lie in one task.

    Each message starts with a draft, its first characters.  An assistant's is then regenerated and streamed, any other's edited and streamed on.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", text("role").alias("role"), text("text").alias("text")).repartition("conv_id")
    message = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text"))
    pieces = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{DELTA}}}"), F.lit(0))
    event = lambda kind, text: F.struct(F.lit(kind).alias("kind"), text.alias("text"))
    deltas = lambda p: F.transform(p, lambda x: event("delta", x))

    def streamed(p):
        whole = F.concat(F.array(event("regenerate", F.lit(""))), deltas(p))
        first = F.coalesce(F.get(p, F.lit(0)), F.lit(""))
        edited = F.concat(F.array(event("edit", first)), deltas(F.slice(p, F.lit(2), F.greatest(F.size(p) - 1, F.lit(0)))))
        return F.concat(F.array(event("start", F.substring("text", 1, 20))), F.when(F.col("role") == "assistant", whole).otherwise(edited))

    events = F.transform(F.array(pieces), streamed)[0]  # binds the pieces, which are cut once
    logged = rows.withColumn("message", message.cast("long")).select("conv_id", "message", "role", F.posexplode(events).alias("i", "e"))
    return logged.select("conv_id", (F.shiftleft("message", 32) + F.col("i")).alias("seq"), "message", "e.kind", "role", "e.text")


def op12_chat_format(spark, sf_dir):
    from reqflow.llm.common import read_table

    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return read_back(render_conversations(log_of(turns.unionByName(added)), together=True))
