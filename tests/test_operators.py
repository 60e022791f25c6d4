import numpy as np
import pytest
from pyspark.sql import functions as F

from reqflow.operators import merge, reports, requisitions
from reqflow.operators.benchmark import price_benchmark
from reqflow.operators.classify import coverage_classify
from reqflow.operators.vectors import nearest
from reqflow.plans import documents as D

TRACKER = "req_no string, stage_id int, tracker_uuid string, created_at date, updated_at date"


def tracker(spark, rows):
    return spark.createDataFrame([(r, s, "u", None, None) for r, s in rows], TRACKER)


def stages(df):
    return {r.req_no: r.stage_id for r in df.collect()}


def test_tracker_moves(spark):
    old, scope = tracker(spark, [("a", 5), ("z", 2)]), spark.createDataFrame([("a",), ("b",)], "req_no string")
    assert stages(D.set_stage(old, scope, 1, "2024-01-01")) == {"a": 1, "b": 1, "z": 2}
    assert stages(D.touch(old, scope, "2024-01-01")) == {"a": 5, "b": 1, "z": 2}
    assert stages(D.advance(old, scope, 4, "2024-01-01")) == {"a": 4, "z": 2}


def test_upsert_takes_nulls_keeps_creation_and_is_idempotent(spark):
    t = spark.createDataFrame([(1, 10.0, "old"), (2, 5.0, "old"), (None, 1.0, "old")], "k int, price double, made string")
    s = spark.createDataFrame([(1, None, "new"), (3, 7.0, "new"), (None, 2.0, "new")], "k int, price double, made string")
    once = merge.upsert(t, s, "k", ["price"])
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or 0)
    rows = sorted(map(tuple, once.collect()), key=key)
    assert rows == [(1, None, "old"), (2, 5.0, "old"), (3, 7.0, "new"), (None, 1.0, "old"), (None, 2.0, "new")]
    s = s.filter("k is not null")
    again = merge.upsert(once, s, "k", ["price"])
    assert sorted(map(tuple, again.collect()), key=key) == rows


def test_last_wins(spark):
    df = spark.createDataFrame([(1, 1, "x"), (1, 3, "z"), (1, 2, "y"), (2, 1, "w")], "k int, seq int, v string")
    assert sorted(r.v for r in merge.last_wins(df, "k", F.col("seq")).collect()) == ["w", "z"]


def test_pending_and_choice(spark):
    req = spark.createDataFrame([("b", 1), ("a", 1), ("c", 0), ("d", 2)], "req_no string, created_on int")
    t = tracker(spark, [("c", 8), ("d", 7)])
    assert [r.req_no for r in requisitions.choose(req, t, n=2).collect()] == ["a", "b"]
    assert [r.req_no for r in requisitions.choose(req, t, only=" c ").collect()] == ["c"]


def test_orphans(spark):
    child = spark.createDataFrame([(1,), (None,), (9,)], "fk int")
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    assert [r.fk for r in requisitions.orphans(child, parent, "fk", "id").collect()] == [9]


@pytest.mark.parametrize("n", [1, 4, 7])
def test_row_slices_cover_the_table(spark, n):
    df = spark.range(100).select((F.col("id") * 3).alias("id"))
    got = sorted(requisitions.row_slices(df, "id", n).collect())
    assert sum(r.n_rows for r in got) == 100 and len(got) == n
    assert all(a.hi < b.lo for a, b in zip(got, got[1:]))


def test_text_batch_and_lines(spark):
    scope = spark.createDataFrame([("r1",), ("r2",)], "req_no string")
    files = spark.createDataFrame([("r1", 2, "b", "y"), ("r1", 1, "a", "x")], "req_no string, attachment_id long, name string, text string")
    got = {r.req_no: r.batch for r in reports.text_batch(scope, files).collect()}
    assert got == {"r1": "=== FILE: a (REQ: r1) ===\nx\n\n=== FILE: b (REQ: r1) ===\ny", "r2": "(no files found)"}
    rows = spark.createDataFrame([("r1", 4, "OK"), ("r1", 1, "OK (2 files)")], "req_no string, stage_id int, status string")
    assert reports.stage_lines(rows).first().line == "REQ [r1]: INGESTION: OK (2 files) → CLASSIFICATION: OK"


def test_fragments(spark):
    rows = [(1, "s", 2, ["a", None, "b"]), (1, "s", 1, [None]), (1, "t", 1, ["c"])]
    df = spark.createDataFrame(rows, "doc_id int, sheet string, row_no int, cells array<string>")
    assert reports.assemble_fragments(df).first().text == "--- Sheet: s ---\na\tb\n--- Sheet: t ---\nc"


def test_coverage(spark):
    texts = [
        "Vendor Name A\nDate x\nTotal Amount 5\nPayment terms\nDelivery time", "Vendor name, date, total amount, payment terms", "order value, justification, prepared, purchasing, MD, a) b)", "", None,
        "Event ID BID Id Participant basic price extended price eAuction 10:45",
    ]
    got = coverage_classify(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")).orderBy("i").collect()
    assert [r.doc_type for r in got] == ["Quotation", "Other", "Other", "Other", "Other", "E-Auction"]
    assert got[0].coverage == 0.625 and got[5].band == "all"


def vectors(spark, n=40, dim=8):
    rng = np.random.default_rng(0)
    rows = [(i, i % 4, rng.normal(size=dim).astype(float).tolist()) for i in range(n)]
    return rows, spark.createDataFrame(rows, "detail_id long, req_group int, vals array<float>").repartition(3)


@pytest.mark.parametrize("mode", ["before", "after"])
def test_nearest_matches_brute_force(spark, mode):
    rows, df = vectors(spark)
    got = {}
    for r in nearest(df, df.filter("detail_id < 5"), 6, mode).collect():
        got.setdefault(r.query_id, []).append((r.rk, r.detail_id))
    x = np.array([r[2] for r in rows], np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for q in range(5):
        order = sorted(range(len(rows)), key=lambda j: (-float(x[q] @ x[j]), j))
        same = [j for j in order if rows[j][1] == rows[q][1]]
        want = [j for j in order if j not in same][:6] if mode == "before" else [j for j in order[:6] if j not in same]
        assert [d for _, d in sorted(got[q])] == want


def test_nearest_in_several_blocks(spark, monkeypatch):
    from reqflow.operators import vectors as V

    _, df = vectors(spark)
    whole = {m: sorted(map(tuple, nearest(df, df, 3, m).select("query_id", "detail_id", "rk").collect())) for m in ("before", "after")}
    monkeypatch.setattr(V, "QUERY_BLOCK", 7)
    monkeypatch.setattr(V, "INDEX_BLOCK", 16)
    for m, want in whole.items():  # blocks of queries met with blocks of the index
        assert sorted(map(tuple, nearest(df, df, 3, m).select("query_id", "detail_id", "rk").collect())) == want
    assert nearest(df, df.limit(0), 3).count() == 0 and nearest(df.limit(0), df, 3).count() == 0


@pytest.mark.parametrize("mode", ["before", "after"])
def test_copies_of_a_vector_meet_the_index_once(spark, monkeypatch, mode):
    """Seven distinct vectors, 210 rows: as many scores as pairs of vectors are made, and each row gets the nearest rows all the same."""
    from reqflow.operators import vectors as V

    made, found = [], V._found
    monkeypatch.setattr(V, "_found", lambda *a: made.append(found(*a)) or made[-1])
    seven = np.eye(7, dtype=np.float32) + np.arange(7, dtype=np.float32)[None, :] / 16
    rows = [(i, None if i % 11 == 0 else i % 3, seven[i % 7].tolist()) for i in range(210)]
    df = spark.createDataFrame(rows, "detail_id long, req_group int, vals array<float>").repartition(4)
    got = {}
    for r in nearest(df, df, 4, mode).collect():
        got.setdefault(r.query_id, []).append((r.rk, r.detail_id))
    unit = seven.astype(float) / np.linalg.norm(seven.astype(float), axis=1, keepdims=True)
    near = np.round(unit @ unit.T, 9)
    for i, g, _ in rows:
        order = sorted(range(210), key=lambda j: (-near[i % 7, j % 7], j))
        same = [j for j in order if g is not None and rows[j][1] == g]
        ranked = list(enumerate([j for j in order if j not in same], 1))[:4] if mode == "before" else [(n, j) for n, j in enumerate(order[:4], 1) if j not in same]
        assert sorted(got.get(i, [])) == ranked
    assert made[0].count() <= 7 * 7 * 4


@pytest.mark.parametrize("block", [None, 7])
def test_nearest_beyond_a_group_that_holds_all_near_vectors(spark, monkeypatch, block):
    """Each group is a cluster, larger than what is looked at first; one vector has copies in all groups, and some rows have no group."""
    from reqflow.operators import vectors as V

    if block:
        monkeypatch.setattr(V, "QUERY_BLOCK", block)
        monkeypatch.setattr(V, "INDEX_BLOCK", 3 * block)
        monkeypatch.setattr(V, "CHUNK", block)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(4, 6))
    rows = [(i, None if i % 4 == 3 else i % 4, (centres[i % 4] + rng.normal(size=6) / 20).astype(np.float32).tolist()) for i in range(120)]
    rows += [(200 + i, i % 4, centres[0].astype(np.float32).tolist()) for i in range(30)]
    df = spark.createDataFrame(rows, "detail_id long, req_group int, vals array<float>").repartition(3)
    got = {}
    for r in nearest(df, df, 5).collect():
        got.setdefault(r.query_id, []).append((r.rk, r.detail_id))
    x = np.array([r[2] for r in rows], np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = np.round(x @ x.T, 12)
    for q, (i, g, _) in enumerate(rows):
        order = sorted((j for j in range(len(rows)) if g is None or rows[j][1] != g), key=lambda j: (-near[q, j], rows[j][0]))
        assert sorted(got[i]) == [(n, rows[j][0]) for n, j in enumerate(order[:5], 1)]


def test_nearest_of_nulls_and_of_earlier_ones(spark):
    rows = [(1, None, [1.0, 0.0]), (2, None, [1.0, 0.1]), (3, "a", None), (None, "a", [1.0, 0.0]), (4, "a", [1.0, 0.2])]
    df = spark.createDataFrame(rows, "detail_id long, req_group string, vals array<float>")
    got = {(r.query_id, r.detail_id) for r in nearest(df, df, 5).collect()}
    assert got == {(q, x) for q in (1, 2, 4) for x in (1, 2, 4) if (q, x) != (4, 4)}  # a null group is no group's own
    seen = nearest(df, df, 5, visibility="earlier", seq=F.col("detail_id")).collect()
    assert {(r.query_id, r.detail_id) for r in seen} == {(2, 1), (4, 1), (4, 2)}


def test_benchmark_without_history_is_null(spark):
    items = spark.createDataFrame([(1, "EUR", 10.0), (2, None, 4.0)], "detail_id long, currency string, unit_price double")
    near = spark.createDataFrame([(1, 5, 0.9, 1), (1, 6, 0.8, 6), (2, 5, 0.7, 1)], "query_id long, detail_id long, score double, rk int")
    history = spark.createDataFrame([(5, "USD", 8.0), (6, "EUR", 3.0)], "detail_id long, currency string, unit_price double")
    got = {r.detail_id: r for r in price_benchmark(items, near, history).collect()}
    assert got[1].bp_unit_price is None and got[1].n_prices == 0
    assert [r.detail_id for r in price_benchmark(items, near, history, on_error="skip").collect()] == [2]
    assert (got[2].bp_unit_price, got[2].currency, got[2].price_ratio) == (8.0, "USD", 0.5)


def test_a_slice_by_position_sorts_its_ranges_only(spark):
    keys = [None, None, *[i * i % 97 for i in range(300)], *[5] * 40]
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k long, i long")
    want = sorted(((k, i) for i, k in enumerate(keys)), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    for offset, n in ((0, 1), (0, 400), (1, 3), (2, 2), (17, 50), (60, 60), (330, 50), (341, 5), (342, 5), (900, 5), (10, 0)):
        assert [tuple(r) for r in requisitions.slice_of(df, "k", offset, n, "i", ranges=16).collect()] == want[offset : offset + n]
    assert requisitions.slice_of(df.limit(0), "k", 0, 5).count() == 0
    plan = requisitions.slice_of(df, "k", 100, 5, ranges=16)._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" in plan and "k" in plan


def test_slices_of_equal_depth(spark):
    df = spark.createDataFrame([(int(1.03**i),) for i in range(1000)] + [(None,)], "k long")
    got = requisitions.row_slices(df, "k", 8).collect()
    assert sum(r.n_rows for r in got) == 1001 and max(r.n_rows for r in got) <= 250 and {r.slice for r in got} == set(range(-1, 8))


def test_medians_of_histograms_equal_spark_s(spark):
    import random

    rng = random.Random(1)
    rows = [(rng.randint(0, 30), rng.choice(["EUR", "USD"]), rng.choice([None, 1.5, 2.25, 3.0, rng.random()])) for _ in range(700)]
    df = spark.createDataFrame(rows, "item int, currency string, unit_price double")
    from reqflow.operators.benchmark import median_price, price_histogram

    got = {(r.item, r.currency): r.median for r in median_price(price_histogram(df, "item", "currency"), "item", "currency").collect()}
    want = {(r.item, r.currency): r.m for r in df.groupBy("item", "currency").agg(F.median("unit_price").alias("m")).collect() if r.m is not None}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)
    plan = price_benchmark(df.withColumnRenamed("item", "detail_id"), spark.createDataFrame([], "query_id long, detail_id long, score double, rk int"), df.withColumnRenamed("item", "detail_id"))._jdf.queryExecution().optimizedPlan().toString()
    assert "median" not in plan.lower().replace("bp_unit_price", "") and "percentile" not in plan.lower()


def test_batches_of_bounded_size_join_to_the_whole_text(spark):
    files = [("a", i, f"f{i}", "x" * n + str(i)) for i, n in enumerate([0, 5, 300, 40, 41, 1000, 1, 1, 1])] + [("b", 1, "n", "short"), ("a", 20, "é\n", "\n\U0001f600" * 90)]
    df = spark.createDataFrame(files, "req_no string, attachment_id long, name string, text string")
    scope = spark.createDataFrame([("a",), ("b",), ("none",)], "req_no string")
    whole = {r.req_no: r.batch for r in reports.text_batch(scope, df).collect()}
    for limit in (20, 150, 333, 100_000):
        got = sorted(map(tuple, reports.text_batches(scope, df, limit).collect()))
        assert all(len(b) <= max(limit, 16) for _, _, b in got)
        for req, text in whole.items():
            own = [(n, b) for r, n, b in got if r == req]
            assert [n for n, _ in own] == list(range(len(own))) and "".join(b for _, b in own) == text
