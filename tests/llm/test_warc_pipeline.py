import gzip
import hashlib
from collections import Counter

from reqflow.llm import near_dedup, packing, pii, quality, warc
from reqflow.llm.common import attach_groups, shared_path
from tests.llm.data import LOWER, documents, empty, frame, stable


def pages(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as rk", "'y' as digest", "1 as type")
    return stable(df)


HTML = "<p>é 😀</p>\r\n\r\n" * 80
ROWS = [
    (1, "http://a.org/x y", HTML), (2, None, HTML), (3, "https://b.org/\r\nq", HTML), (4, "http://c", "short"), (5, "http://c", "short"), (6, "http://d", None), (7, "", ""), (8, "u", "WARC/1.1\r\n\r\n" * 200), (8, "u", "WARC/1.1\r\n\r\n" * 200), (None, "n", "z" * 2000),
]


def test_captures_match_brute_force(spark):
    path = shared_path(spark, "warc")
    warc.write_archives(pages(spark, ROWS), path)
    got = warc.assemble(warc.read_records(spark, path, with_payload=True)).collect()
    last = {}
    for i, _, h in ROWS:
        if len((h or "").encode()) >= 1000:
            last[h] = max(last.get(h) or 0, i or 0)
    want = Counter()
    seen = set()
    for i, _, h in ROWS:
        b = (h or "").encode()
        first = len(b) < 1000 or ((i or 0) == last[h] and (h, i) not in seen)
        seen.add((h, i))
        want[(i, len(b), hashlib.sha1(b).hexdigest(), "response" if first else "revisit", None if first else last[h])] += 1
    num = lambda x: None if x is None else int(x)
    assert Counter((num(r.page_id), r.response.payload_bytes, r.response.digest, r.response.type, num(r.revisit_of.original_page_id)) for r in got) == want
    for r in got:
        assert r.request.head.startswith("GET ") and "fetchTimeMs" in r.metadata.head
        assert (r.response.payload is None) == (r.response.type == "revisit")


def test_files_are_plain_warc(spark):
    path = shared_path(spark, "warc")
    warc.write_archives(pages(spark, ROWS[:3]), path)
    content = b"".join(gzip.decompress(bytes(r.content)) for r in spark.read.format("binaryFile").load(path).collect())
    records = list(warc.split_records(content))
    assert Counter(h["warc-type"] for h, _ in records) == {"request": 3, "metadata": 3, "response": 1, "revisit": 2}
    ids = {h["warc-record-id"] for h, _ in records}
    assert len(ids) == 9 and all(h["warc-concurrent-to"] in ids for h, _ in records if h["warc-type"] in ("request", "metadata"))


def test_no_pages(spark):
    path = shared_path(spark, "warc")
    warc.write_archives(pages(spark, []), path)
    assert warc.assemble(warc.read_records(spark, path)).count() == 0


def test_missing_partners_are_null(spark):
    path = shared_path(spark, "warc")
    warc.write_archives(pages(spark, ROWS[:4]), path)
    alone = warc.read_records(spark, path).filter("type <> 'request'")
    assert all(r.request is None and r.metadata is not None for r in warc.assemble(alone).collect())


def test_hot_groups_are_spread_and_whole(spark):
    rows = spark.range(5000).selectExpr("id", "case when id % 3 = 0 then 'hot' when id % 7 = 0 then null else cast(id % 50 as string) end as k")
    groups = rows.filter("k is not null").groupBy("k").count().withColumnRenamed("count", "n")
    got = attach_groups(rows, groups, "k", "n").collect()
    sizes = Counter(r.k for r in got)
    assert len(got) == 5000 and all(r.n == (sizes[r.k] if r.k else None) for r in got)


def test_pipeline_matches_its_steps(spark):
    import pytest

    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    clean = [f"w{i} v{i} says u{i} to t{i}" for i in range(30)]
    rows = documents(size=20)
    rows += [(500, " ".join(clean), "en", "s", 1), (501, " ".join(clean).upper(), "en", "s", 1), (502, " ".join(clean[:29]) + " write to a@b.org now", "en", "s", 1)]
    rows += [(600 + i, " ".join(f"{c}{i}{j}" for j in range(25) for c in "abc") + " call +1 (555) 010-1234", "en", f"s{i}", 1) for i in range(5)]
    docs = frame(spark, rows)
    kept = {i: t for i, t, *_ in rows if quality_passes(t)}
    equal = {}
    for i, t in kept.items():
        k = t.translate(LOWER)
        equal[k] = max(equal.get(k, -1), -1 if i is None else i)
    stage = docs
    for name, f in corpus_pipeline.STAGES[:-1]:
        stage = stable(f(spark, stage, ""))
        assert stage.columns == docs.columns, name
        if name == "exact_dedup":
            assert Counter(r.doc_id for r in stage.collect()) == Counter(equal.values())
    out = corpus_pipeline.STAGES[-1][1](spark, stage, "").collect()
    assert {r.doc_id for r in out} == {r.doc_id for r in stage.collect()}
    assert not any("555) 010-1234" in r.text or "a@b.org" in r.text for r in stage.collect())
    assert {r.doc_id for r in out} >= {600, 601, 602, 603, 604}
    assert len({500, 501, 502} & {r.doc_id for r in out}) == 1


def quality_passes(t):
    n, chars, sym, _, rep, dl, d3, d5, d8, up, low, shout = quality.text_features((t or "").encode())
    r = quality.QualityRules()
    w, c = max(n, 1), max(chars, 1)
    bad = dl / c > r.max_line_share or d3 / c > r.max_share_3 or d5 / c > r.max_share_5 or d8 / c > r.max_share_8
    bad = bad or sym / w > r.max_symbols_per_word or shout / w > r.max_shouts_per_word or up > r.max_upper_share * (up + low)
    return not (n < r.min_words or 100 * rep > r.max_repeat_percent * n or bad)


def test_a_table_without_sources_is_packed(spark):
    import pytest

    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    docs = frame(spark, documents(size=20), extra=False).drop("source", "n_chars")
    packed = corpus_pipeline.packed(spark, docs, "").collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in docs.collect()}
    assert max(Counter(r.bin_id for r in packed).values()) > 3  # sources that aren't known don't keep texts apart


def test_pipeline_on_an_empty_table(spark, tmp_path):
    import pytest

    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    empty(spark).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
