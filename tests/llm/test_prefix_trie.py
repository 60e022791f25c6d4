"""op11_prefix_trie against brute force."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from reqflow.llm import prefix_trie as P
from tests.llm.data import stable

SCHEMA = "conv_id long, turn long, role string, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rebuilt(convs):
    """convs: conv_id -> turns (role, text) in order."""
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = convs.get(c - c % 20, [])[:h] + own[h:]
    return out


def brute(convs):
    members = defaultdict(list)
    for c, turns in sorted(convs.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, spared = {}, {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * len(WORD.findall(node[-1][1])) if node else 0
        leaves[node] = sum(leaves[x] for x in children[node]) or 1
        spared[node] = own + sum(spared[x] for x in children[node])
    rows = []
    for node, who in members.items():
        ends = ",".join(str(c) for c in sorted(who) if len(convs[c]) == len(node))
        rows.append((min(who), len(node), min(members[node[:-1]]) if node else None, len(who), len(children[node]), leaves[node], spared[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=str)


def table(seed, size):
    """Rows of conversations that share beginnings, whole copies and single turns; and the conversations."""
    rng = random.Random(seed)
    words = ["hi", "a b", "", "c\td e", "long " * 30]
    convs = {}
    for c in rng.sample(range(size * 2), size):
        if convs and rng.random() < 0.5:
            turns = list(rng.choice(list(convs.values())))[: rng.randint(0, 9)]
        else:
            turns = []
        turns += [(rng.choice(["user", "assistant", ""]), rng.choice(words) + (str(rng.randint(0, 99)) if rng.random() < 0.4 else "")) for _ in range(rng.randint(0 if turns else 1, 4))]
        if turns:
            convs[c] = turns
    rows = []
    for c, turns in convs.items():
        places = sorted(rng.sample(range(-3, 40), len(turns)))
        rows += [(c, None if i == 0 and rng.random() < 0.2 else t, r or None, x or None) for i, (t, (r, x)) in enumerate(zip(places, turns, strict=True))]
    rng.shuffle(rows)
    return rows, convs


def as_rows(df):
    return sorted((tuple(r) for r in df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()), key=str)


def test_the_query_equals_brute_force(spark, tmp_path):
    rows, convs = table(1, 150)
    df = spark.createDataFrame([*rows, (None, 1, "user", "x")], SCHEMA).repartition(3).selectExpr("*", "1 as u", "'x' as node", "2 as depth", "3 as part")
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    got = P.op11_prefix_trie(spark, str(tmp_path))
    assert {t for c, t in got.dtypes if c != "ends_sha256"} == {"bigint"}
    assert as_rows(got) == brute(rebuilt(convs))


@pytest.mark.parametrize("cells", [4096, 64, 1 << 16])
def test_a_sketch_of_any_size_gives_the_same_nodes(spark, monkeypatch, cells):
    """One conversation with a third of all rows, lying in several tasks, and one text that a third of all begin with."""
    rng = random.Random(cells)
    convs = {c: [("u", "hello there")] + [("a", str(rng.randint(0, 3))) for _ in range(rng.randint(0, 5))] for c in range(40)}
    convs |= {c: [("u", str(rng.randint(0, 5)))] for c in range(100, 140)}
    convs[7] = [("u", str(i % 5)) for i in range(150)]
    convs[90], convs[95] = list(convs[7]), convs[7][:80] + [("u", "z")]
    rows = [(c, i, *t) for c, turns in convs.items() for i, t in enumerate(turns)]
    monkeypatch.setattr(P, "BLOCK_CELLS", 1024)
    if cells < 4096:
        monkeypatch.setattr(P, "_single", lambda sketch, a, b, n: np.zeros(len(a), bool))  # nothing is proven
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        turns = P.turn_rows(stable(spark.createDataFrame(rows, SCHEMA)))
        steps = turns.selectExpr("conv_id", "0 as part", "turn", "a", "b", "words", "u")
        assert as_rows(P.prefix_trie(steps, turns.select("conv_id").distinct(), cells)) == brute(convs)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "3")


def test_estimates_are_never_too_low_and_tails_stay(spark):
    rows, _ = table(3, 120)
    turns = P.turn_rows(stable(spark.createDataFrame(rows, SCHEMA)))
    found = P.prefix_rows(turns.selectExpr("conv_id", "0 as part", "turn", "a", "b", "words", "u")).collect()
    count = defaultdict(int)
    for r in found:
        count[bytes(r.node)] += 1
    assert all(count[bytes(r.node)] == 1 for r in found if r.alone)
    assert sum(r.alone for r in found) > 50


def test_ties_of_a_turn_do_not_depend_on_the_order_of_rows(spark):
    rows = [(1, 0, "u", "a"), (1, 0, "u", "b"), (1, 0, "u", "a"), (2, 0, "u", "b"), (2, 0, "u", "a"), (2, 0, "u", "a")]
    results = []
    for r in (rows, rows[::-1]):
        turns = P.turn_rows(stable(spark.createDataFrame(r, SCHEMA)))
        results.append(as_rows(P.prefix_trie(turns.selectExpr("conv_id", "0 as part", "turn", "a", "b", "words", "u"), turns.select("conv_id").distinct())))
    assert results[0] == results[1] and all(r[3] == 2 for r in results[0]) and len(results[0]) == 4


def test_ids_are_hashed_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(P, "ID_BLOCK", 10)
    ids = [*range(-25, 0), *range(95, 130)]
    df = spark.createDataFrame([(bytearray(b"n"), i) for i in ids] + [(bytearray(b"m"), 5)], "node binary, conv_id long")
    want = {b"n": hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), b"m": hashlib.sha256(b"5").hexdigest()}
    assert {bytes(r.node): r.ends_sha256 for r in P._ends_sha256(df).collect()} == want


def test_no_conversations(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    assert P.op11_prefix_trie(spark, str(tmp_path)).count() == 0
    spark.createDataFrame([(1, 0, None, None)], SCHEMA).write.parquet(f"{tmp_path}/one/conversations.parquet")
    # Conversation 1 has h > 0 and no conversation 0 to begin with.
    assert as_rows(P.op11_prefix_trie(spark, f"{tmp_path}/one")) == brute(rebuilt({1: [("", "")]}))
