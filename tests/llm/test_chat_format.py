"""op12_chat_format: exact round trips, and event logs against a plain fold."""

import hashlib
import random

import pytest

from reqflow.llm import chat_format as C
from tests.llm.data import stable

TURNS = "conv_id long, turn long, role string, text string"
EVENTS = "conv_id long, seq long, message long, kind string, role string, text string"
NASTY = ["", " ", "\\", "\\\\", "<", "<\\s>", "</s>", "[INST]", "[/INST] ", "<<SYS>>", "<</SYS>>", " </s>", "<<s>>", "<</s>", "[", "[\\INST]", "é\U0001f600", "\n", "a" * 30, "1 x ", " <</SYS>> [/INST]"]


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def digest(messages):
    return len(messages), sha("".join(f"{r}\n{t}\n" for r, t in messages)), sum(len(t) for r, t in messages if r == "assistant"), sha("".join(t for r, t in messages if r == "assistant"))


def plain_fold(events):
    """The log by sequence, one event after the other, over a whole conversation."""
    rank = {"regenerate": 0, "edit": 1}
    state = {}
    for seq, message, kind, role, text in sorted(events, key=lambda e: (e[0], rank.get(e[2], 2), e[1], e[4])):
        if kind == "regenerate":
            state = {m: s for m, s in state.items() if m < message}
            state[message] = ""
        elif kind == "edit":
            state[message] = text
        else:
            state[message] = state.get(message, "") + text
    return [t for _, t in sorted(state.items())]


def random_text(rng):
    return "".join(rng.choice(NASTY) for _ in range(rng.randint(0, 6)))


def test_escaping_is_undone_and_leaves_no_control_string():
    rng = random.Random(1)
    for _ in range(3000):
        t = random_text(rng)
        e = C.escape(t)
        assert C.unescape(e) == t and not C._CONTROL.search(e) and not C._CONTROL.search(f"[ {e}"[2:] + e)
        escaper, unescaper, parts, back = C._Escaper(), C._Unescaper(), [], []
        while t:
            k = rng.randint(1, 5)
            parts.append(escaper.push(t[:k]))
            t = t[k:]
        whole = "".join(parts) + escaper.close()
        assert whole == e
        for i in range(0, len(whole), 3):
            back.append(unescaper.push(whole[i : i + 3]))
        assert "".join(back) == C.unescape(e) and not unescaper.rest


@pytest.mark.parametrize("piece", [7, 40, C.PIECE])
def test_rendered_pieces_of_any_size_read_back(piece):
    rng = random.Random(piece)
    for _ in range(300):
        messages = [(rng.choice(["user", "assistant", "system", "", "a b", "1 2", "\\</s>\n"]), random_text(rng)) for _ in range(rng.randint(1, 6))]
        stream = []
        for role, text in messages:
            stream.append((5, None, role))
            while text:
                k = rng.randint(1, 9)
                stream.append((5, text[:k], None))
                text = text[k:]
        rows = list(C.render(iter(stream), piece))
        assert [r[1] for r in rows] == list(range(len(rows)))
        reader = C._Reader()
        for _, _, formatted, loss in rows:
            reader.take(formatted, loss)
        assert reader.result()[:4] == digest(messages)
        assert reader.result()[4] == sum(len(r[2]) for r in rows)
        assert all(len(r[2]) <= 3 * piece + 60 for r in rows)


def log(rng, n):
    """A log of random events, sequences shuffled over messages; roles follow the message."""
    kinds = ["start", "delta", "delta", "edit", "regenerate", None]
    role = {m: rng.choice(["user", "assistant", "tool"]) for m in range(5)}
    return [(rng.randint(0, 2 * n), (m := rng.randint(0, 4)), rng.choice(kinds), role[m], random_text(rng)) for _ in range(n)]


def test_folding_equals_the_plain_fold():
    rng = random.Random(4)
    rank = {"regenerate": 0, "edit": 1}
    for _ in range(1500):
        events = log(rng, rng.randint(0, 14))
        rows = sorted((7, m, rank.get(k, 2), s, r, t) for s, m, k, r, t in events)
        got = []
        for _, text, role in C.fold(iter(rows)):
            if text is None:
                got.append("")
            else:
                got[-1] += text
        assert got == plain_fold(events)


def test_logs_over_many_conversations(spark):
    rng = random.Random(8)
    logs = {c: log(rng, rng.randint(1, 20)) for c in range(40)}
    logs[None] = log(rng, 9)
    rows = [(c, *e) for c, events in logs.items() for e in events]
    rng.shuffle(rows)
    df = stable(spark.createDataFrame(rows, EVENTS).selectExpr("*", "1 as part", "'x' as loss", "2 as rank"))
    rendered = C.render_conversations(df, piece=50)
    got = {r.conv_id: (r.n_turns, r.loss_chars) for r in C.read_back(rendered).collect()}
    roles = {c: {m: r for _, m, _, r, _ in events} for c, events in logs.items()}
    want = {}
    for c, events in logs.items():
        texts = plain_fold(events)
        if texts:
            want[c] = len(texts)
    assert {c: n for c, (n, _) in got.items()} == want and len(want) > 30 and roles
    again = {r.conv_id: tuple(r) for r in C.read_back(stable(rendered.repartition(4)), together=False).collect()}
    assert again == {r.conv_id: tuple(r) for r in C.read_back(rendered).collect()}
    one = C.render_conversations(spark.createDataFrame([(1, None, None, "start", None, None), (1, 5, 1, "delta", "assistant", "hi")], EVENTS)).collect()
    assert [(r.formatted, [tuple(x) for x in r.loss]) for r in one] == [("<<SYS>> 0   <</SYS>><s> hi </s>", [(24, 26)])]


def test_the_query_gives_back_every_conversation(spark, tmp_path):
    rng = random.Random(3)
    rows = []
    for c in range(30):
        for t in range(rng.randint(1, 6)):
            rows.append((c, None if t == 0 and c % 3 == 0 else t, rng.choice(["user", "assistant", "system", None]), rng.choice([None, random_text(rng), "x" * 5001, " ".join(NASTY) * 200])))
    rows += [(None, 1, "user", "lost"), rows[3], (4, 90, "user", "tie"), (4, 90, "assistant", "tie"), (4, 90, "user", "tie")]
    df = spark.createDataFrame(rows, TURNS).repartition(3).selectExpr("*", "1 as message", "'k' as kind", "2 as seq", "3 as i", "'q' as e")
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: tuple(r) for r in C.op12_chat_format(spark, str(tmp_path)).collect()}
    said = "</s>[INST] ok [/INST]"
    convs = {-1: [("user", said), ("assistant", said)]}
    for c, t, r, x in sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        convs.setdefault(c, []).append((r or "", x or ""))
    assert set(got) == set(convs)
    for c, messages in convs.items():
        assert got[c][1:5] == digest(messages)
        assert got[c][5] >= sum(len(t) for _, t in messages)


def test_an_empty_table(spark, tmp_path):
    assert C.render_conversations(spark.createDataFrame([], EVENTS)).count() == 0
    spark.createDataFrame([], TURNS).write.parquet(f"{tmp_path}/conversations.parquet")
    assert [r.conv_id for r in C.op12_chat_format(spark, str(tmp_path)).collect()] == [-1]
