"""op13_periodic_runs against brute force."""

import hashlib
import random
import re
import zlib

import pytest

from reqflow.llm import periodic as P
from tests.llm.data import documents, empty, frame, stable

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words):
    """All runs by definition: every lag's maximal stretches, those of a smaller period left out."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(12, 2 * q):
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((s, length, q) for (s, length), q in found.items())


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def collapsed(words, runs):
    drop = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in drop)


def expected(doc_id, text):
    words = planted(doc_id, WORD.findall(text or ""))
    runs = brute_runs(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(collapsed(words, runs)))


def texts(seed, size):
    """Texts with nested, touching and overlapping repeats over few words."""
    rng = random.Random(seed)
    out = []
    for _ in range(size):
        parts = []
        for _ in range(rng.randint(1, 5)):
            block = rng.choices("abcde"[: rng.randint(1, 5)], k=rng.randint(1, 30))
            if rng.random() < 0.5:
                block = block * rng.randint(1, 3) + rng.choices("ab", k=rng.randint(0, 3))
            parts += block * rng.randint(1, 6) + block[: rng.randint(0, len(block))]
        out.append(parts)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_brute_force(seed):
    cases = texts(seed, 150) + [["a"] * n for n in (0, 1, 11, 12, 13, 200)] + [["a", "b"] * 40 + ["c"], [str(i) for i in range(500)] * 2]
    got, kept = P._search([" ".join(w).encode() for w in cases])
    for words, runs, left in zip(cases, got, kept, strict=True):
        assert runs == brute_runs(words)
        assert left.decode() == collapsed(words, runs)


def test_every_short_text_over_two_words():
    cases = [[("a", "b")[n >> i & 1] for i in range(13)] for n in range(1 << 13)]
    got, _ = P._search([" ".join(w).encode() for w in cases])
    assert got == [brute_runs(w) for w in cases]


def test_a_fibonacci_text_and_long_ones():
    a, b = ["a"], ["b"]
    while len(b) < 900:
        a, b = b, b + a
    assert P._search([" ".join(b).encode()])[0][0] == brute_runs(b)
    rng = random.Random(5)
    block = [str(rng.randrange(10**6)) for _ in range(70_000)]
    words = ["x"] + block + block + block[:9] + ["y"] + ["z"] * 100_000
    assert P._search([" ".join(words).encode()])[0][0] == [(1, 140_009, 70_000), (140_011, 100_000, 1)]


def test_classes_cover_all_lags_with_a_k_gram_in_every_overlap():
    low = 1
    for k, a, b in P._classes(5000):
        assert a == low and all(2 * k - 1 <= max(12 - q, q) for q in range(a, b))
        low = b
    assert low > 5000


def test_the_query_equals_brute_force(spark, tmp_path):
    rows = documents(3, 30)
    rows += [(1000 + i, " \n".join(w), None, "s", 1) for i, w in enumerate(texts(9, 60))]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in P.op13_periodic_runs(spark, str(tmp_path)).collect()), key=str)
    assert got == sorted((expected(r[0], r[1]) for r in rows), key=str)
    assert sum(r[1] > 0 for r in got) > 40


def test_planted_tails_have_their_period(spark, tmp_path):
    rng = random.Random(2)
    rows = [(i, " ".join(str(rng.randrange(10**6)) for _ in range(400)), "en", "s", 1) for i in range(100)]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in P.op13_periodic_runs(spark, str(tmp_path)).collect()]
    hit = {r[0] for r in got if r[1]}
    assert hit and hit <= {i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0}


def test_empty_tables_and_columns_of_the_operator(spark):
    assert P.periodic_runs(empty(spark)).count() == 0
    docs = stable(spark.createDataFrame([("k", "a b " * 20), (None, None)], "doc_id string, text string"))
    got = {r.doc_id: (r.runs, r.collapsed) for r in P.periodic_runs(docs).collect()}
    assert [tuple(x) for x in got["k"][0]] == [(0, 40, 2)] and got["k"][1] == "a b" and got[None] == ([], "")


def test_speed_does_not_follow_the_square_of_a_repeat():
    import time

    began = time.time()
    runs, _ = P._search([b"a " * 300_000, b"a b a c " * 50_000])
    assert runs == [[(0, 300_000, 1)], [(0, 200_000, 4)]]
    assert time.time() - began < 20
