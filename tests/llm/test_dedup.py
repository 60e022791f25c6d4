import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from reqflow.llm import exact_dedup as E
from reqflow.llm import near_dedup as N
from tests.llm.data import LOWER, documents, empty, frame


def norm(t):
    return (t or "").translate(LOWER)


@pytest.mark.parametrize("bits", [64, 2])
def test_exact_groups_match_brute_force(spark, bits):
    rows = documents()
    got = E.exact_groups(frame(spark, rows), bits=bits).collect()
    assert Counter((r.doc_id, r.text_sha256) for r in got) == Counter((r[0], hashlib.sha256(norm(r[1]).encode()).hexdigest()) for r in rows)
    groups = defaultdict(list)
    for r in rows:
        groups[hashlib.sha256(norm(r[1]).encode()).hexdigest()].append(r[0])
    for r in got:
        ids = groups[r.text_sha256]
        assert r.group_size == len(ids)
        assert r.keep_id == max(i for i in ids if i is not None)
        assert not r.kept or r.doc_id == r.keep_id
    assert Counter(r.text_sha256 for r in got if r.kept) == Counter(list(groups))


def test_exact_null_ids_alone(spark):
    got = E.exact_groups(frame(spark, [(None, "a", None, None, 1), (None, "a", None, None, 1), (None, None, None, None, None)])).collect()
    assert sorted((r.group_size, r.kept) for r in got) == [(1, True), (2, False), (2, True)]
    assert all(r.keep_id is None for r in got)


def test_exact_drop_keeps_columns(spark):
    df = frame(spark, documents())
    out = E.drop_copies(df)
    assert out.columns == df.columns
    assert out.count() == len({norm(r.text) for r in df.collect()})


def test_exact_empty(spark):
    assert E.exact_groups(empty(spark)).count() == 0
    assert E.drop_copies(empty(spark)).count() == 0


def test_chunks_join_to_the_text_and_follow_content():
    rng = np.random.default_rng(3)
    text = rng.integers(97, 123, 60_000, dtype=np.uint8).tobytes()
    chunks = E.cut(text)
    assert b"".join(chunks) == text and len(chunks) > 5
    assert max(map(len, chunks)) <= E.MAX_CHUNK
    assert len(set(chunks) & set(E.cut(b"other words " * 7 + text))) > len(chunks) // 2
    assert E.cut(b"") == [] and E.cut(b"ab") == [b"ab"]
    assert b"".join(E.cut(b"a" * 100_000)) == b"a" * 100_000


def brute_components(rows, width, percent):
    sets = []
    for r in rows:
        w = norm(r[1]).encode().split()
        sets.append(frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            c = len(sets[i] & sets[j])
            if c and 100 * c >= percent * (len(sets[i]) + len(sets[j]) - c):
                parent[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    least = {g: min((x for x in ids if x is not None), default=None) for g, ids in groups.items()}
    return Counter((rows[i][0], len(sets[i]), least[find(i)]) for i in range(len(rows))), len(groups)


def test_near_groups_match_brute_force(spark):
    rows = documents()
    df = frame(spark, rows)
    got = N.near_groups(df, width=4).collect()
    want, n_groups = brute_components(rows, 4, 80)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == want
    assert sum(r.kept for r in got) == n_groups
    assert all(r.doc_id == r.component_id for r in got if r.kept and r.doc_id is not None)
    out = N.drop_near_copies(df, width=4)
    assert out.columns == df.columns and out.count() == n_groups


def test_near_edges(spark):
    assert N.near_groups(empty(spark)).count() == 0
    got = N.near_groups(frame(spark, [(None, None, None, None, None), (2, " ", None, None, 1), (1, "\n", None, None, 1)])).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0, r.kept) for r in got) == [(0, 0, 0, True), (1, 0, 1, True), (2, 0, 2, True)]


@pytest.mark.parametrize("many,most", [(1_000_000, 1000), (1_000_000, 25), (1_000_000, 0), (0, 0)])
def test_components_of_a_chain_and_a_star(spark, monkeypatch, many, most):
    monkeypatch.setattr(N, "MANY_EDGES", many)
    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 20)] + [(5, 4)]
    got = {r.u: r.v for r in N.components(spark.createDataFrame(edges, "a long, b long"), most).collect()}
    assert got == {**{i: 0 for i in range(1, 31)}, **{100 + i: 100 for i in range(1, 20)}}


@pytest.mark.parametrize("share", [0.3, 0.6, 0.8, 0.9])
def test_registers_estimate_similarity(share):
    rng = np.random.default_rng(5)
    same = 0
    for _ in range(20):
        x = rng.integers(0, 2**63, 600, dtype=np.uint64)
        n = round(2 * 600 * share / (1 + share))
        y = np.concatenate((x[:n], rng.integers(0, 2**63, 600 - n, dtype=np.uint64)))
        a, b = N.registers(np.unique(x)), N.registers(np.unique(y))
        same += (a == b).mean() / 20
        sizes = np.array([600.0])
        assert N.may_reach(a[None], b[None], sizes, sizes, 0.8)[0] or share < 0.8
        # The sketch of a union is the larger register of each.
        assert (N.registers(np.unique(np.concatenate((x, y)))) == np.maximum(a, b)).all()
    assert abs(same - share) < 0.05


def family(n, seed=2, size=100, words=40):
    """Near copies of one form, most of them just above or below the threshold to one another."""
    import random

    rng = random.Random(seed)
    base = [f"w{i}" for i in range(size)]
    rows = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 2, 3])):
            w[rng.randrange(size)] = f"x{rng.randrange(words)}"
        rows.append((i, " ".join(w), None, None, 0))
    return rows


def brute_by_bits(rows, width, percent):
    """Smallest id of each row's component, for rows of many near copies: sets as integers of bits."""
    number, bits = {}, []
    for _, t, *_ in rows:
        w, x = t.split(), 0
        for i in range(len(w) - width + 1):
            x |= 1 << number.setdefault(tuple(w[i : i + width]), len(number))
        bits.append(x)
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    sizes = [x.bit_count() for x in bits]
    for i, x in enumerate(bits):
        for j in range(i):
            c = (x & bits[j]).bit_count()
            if 100 * c >= percent * (sizes[i] + sizes[j] - c):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {r[0]: rows[find(i)][0] for i, r in enumerate(rows)}


def test_a_family_around_the_threshold_is_exact_and_its_pairs_are_few(spark, monkeypatch):
    rows = family(1500)
    seen = {}
    pairs_across = N._pairs_across

    def counted(sets, placed, percent):
        out = pairs_across(sets, placed, percent)
        seen["in"], seen["out"] = placed.count(), out.count()
        return out

    monkeypatch.setattr(N, "_pairs_across", counted)
    got = {r.doc_id: r.component_id for r in N.near_groups(frame(spark, rows)).collect()}
    assert got == brute_by_bits(rows, 5, 80)
    # Only nodes that are really linked to the large component have many candidates there.
    assert len(set(got.values())) > 50 and seen["out"] < 0.04 * seen["in"] * (seen["in"] - 1) / 2


def test_keys_do_not_follow_the_splits(spark):
    """Rows found in one scan are the rows dropped in another, whatever the parallelism in between."""
    from reqflow.llm import common, lm_score, warc

    rows = [r for r in documents(size=120) if r[0] is not None]
    df = frame(spark, rows * 8, extra=False).select("doc_id", "text")
    option, before = "spark.sql.files.minPartitionNum", {}
    wanted = len({norm(r[1]) for r in rows})
    real = common.saved

    def changing(frame_):
        out = real(frame_)
        spark.conf.set(option, {"2": "16", "16": "5", "5": "2"}[spark.conf.get(option)])
        return out

    try:
        spark.conf.set(option, "2")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        for module in (E, N, lm_score, warc):
            before[module] = module.saved
            module.saved = changing
        assert E.drop_copies(df).count() == wanted
        again = N.near_groups(df, width=4).collect()
        want, n_groups = brute_components(rows, 4, 80)
        assert {(r.doc_id, r.component_id) for r in again} == {(i, c) for i, _, c in want}
        assert N.drop_near_copies(df, width=4).count() == n_groups + 7 * sum(not norm(r[1]).split() for r in rows)  # wordless rows all stay
        keys = [common.keyed(df, lambda c: c("doc_id").alias("doc_id")).collect() for _ in "ab" if spark.conf.set(option, "2" if _ == "a" else "16") is None]
        assert sorted(map(tuple, keys[0])) == sorted(map(tuple, keys[1]))
    finally:
        for module, f in before.items():
            module.saved = f
        for o in (option, "spark.sql.files.openCostInBytes", "spark.sql.files.maxPartitionBytes"):
            spark.conf.unset(o)


def test_input_that_is_no_scan_is_written_once(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([r for r in documents() if r[0] is not None], "doc_id long, text string, lang string, source string, n_chars long").repartition(3, F.rand())
    assert E.drop_copies(df).count() == len({norm(r[1]) for r in documents()})
    metadata = df.withColumn("_metadata", F.lit("x"))
    assert E.drop_copies(frame(spark, documents()).withColumn("_metadata", F.lit("x"))).columns[-1] == "_metadata" and E.exact_groups(metadata).count() == df.count()
