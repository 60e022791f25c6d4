import hashlib

import pandas as pd
import pytest
from pyspark.sql import functions as F

from reqflow.plans import documents as D
from reqflow.plans.sync import SyncError, SyncJob
from reqflow.sources import publish as W
from reqflow.sources import scan as S

CONTROL = "etl_id int, source string, destination string, sync_hours int, enable_sync int"


def control(spark, names):
    return spark.createDataFrame([(i, f"dbo.{n}", n, 1, 1) for i, n in enumerate(names)], CONTROL)


def job(spark, root, tables, run_id=1, **kw):
    def read(name):
        found = tables[name.rsplit(".", 1)[-1]]
        if found is None:
            raise OSError("unreadable")
        return found

    return SyncJob(spark, read, str(root), run_id, "2024-01-01", **kw)


def test_a_failed_table_leaves_the_others(spark, tmp_path):
    tables = {"a": spark.range(3), "b": None, "c": spark.range(5)}
    status = {r.etl_id: (r.status, r.n_rows) for r in job(spark, tmp_path, tables).run(control(spark, "abc")).collect()}
    assert status == {0: ("SUCCESS", 3), 1: ("FAILED", 0), 2: ("SUCCESS", 5)}
    assert W.current(spark, f"{tmp_path}/c").count() == 5 and W.current(spark, f"{tmp_path}/b") is None
    with pytest.raises(SyncError):
        job(spark, tmp_path, tables, 2).run_or_raise(control(spark, "abc"))


@pytest.mark.parametrize("on_empty,left", [("keep", 3), ("replace", 0)])
def test_an_empty_source(spark, tmp_path, on_empty, left):
    job(spark, tmp_path, {"a": spark.range(3)}).run(control(spark, "a"))
    status = job(spark, tmp_path, {"a": spark.range(0)}, 2, on_empty=on_empty).run(control(spark, "a")).first()
    assert (status.status, status.n_rows) == ("SUCCESS", 0)
    assert W.current(spark, f"{tmp_path}/a").count() == left


def test_rules_find_tables_by_last_or_full_name(spark):
    rules = S.TableRules({"Reqs": "x > 1", "dbo.other": "x > 2"}, {"dbo.Reqs": ("SECRET",)})
    df = spark.createDataFrame([(1, "s"), (2, "s"), (None, "s")], "x int, Secret string")
    assert [tuple(r) for r in rules.apply(df, "[dbo].[reqs]").collect()] == [(2,)]
    assert rules.apply(df, "other").columns == ["x", "Secret"] and rules.predicate("x.other") is None


def test_a_mismatch_is_not_published(spark, tmp_path):
    root = str(tmp_path)
    W.publish(spark, spark.range(4), root, "1", 4)
    with pytest.raises(W.ReconcileError):
        W.publish(spark, spark.range(3), root, "2", 4)
    assert W.current(spark, root).count() == 4 and len(W.versions(spark, root)) == 1
    for v in "345":
        W.publish(spark, spark.range(int(v)), root, v, keep=2)
    assert W.current(spark, root).count() == 5 and len(W.versions(spark, root)) == 2


def test_align_by_name(spark):
    target = spark.createDataFrame([], "a long, b string, c double")
    out = S.align_to(spark.createDataFrame([("1", 2, 9)], "B string, A int, extra int"), target)
    assert out.dtypes == target.dtypes and tuple(out.first()) == (2, "1", None)
    with pytest.raises(ValueError):
        S.align_to(spark.range(1).withColumnRenamed("id", "zz"), target)


def test_blobs_are_written_by_tasks(spark, tmp_path):
    rows = spark.createDataFrame([("r/1/a.bin", bytearray(b"\x00\xff")), ("r/2/b.txt", bytearray("é".encode() + b"\xff")), ("r/3/c", None)], "path string, content binary")
    assert W.export_blobs(rows, str(tmp_path / "out")) == 3
    assert (tmp_path / "out/r/1/a.bin").read_bytes() == b"\x00\xff"
    texts = {r.path.rsplit("/", 1)[-1]: r.text for r in S.text_files(spark, str(tmp_path / "out")).collect()}
    assert texts["b.txt"] == "é�" and set(texts) == {"a.bin", "b.txt"}


def test_files_are_listed_and_read_by_tasks(spark, tmp_path, monkeypatch):
    """Neither a listing nor contents pass through Spark's driver-side file index, and empty files count."""
    from pyspark.sql.readwriter import DataFrameReader

    rows = [(f"r/{i % 7}/{i}/f{i}.txt", bytearray(("é" * 12_000 if i == 3 else "x" * (i % 50)).encode())) for i in range(200)]
    W.export_blobs(spark.createDataFrame(rows, "path string, content binary"), str(tmp_path / "out"))
    read = DataFrameReader.format
    monkeypatch.setattr(DataFrameReader, "format", lambda self, kind: pytest.fail("listed by the driver") if kind == "binaryFile" else read(self, kind))
    assert {(r.path, r.size) for r in S.file_list(spark, str(tmp_path / "out")).collect()} == {(p, len(c)) for p, c in rows}
    texts = {r.path.removeprefix(f"{tmp_path}/out/"): r.text for r in S.text_files(spark, f"{tmp_path}/out").collect()}
    assert texts == {p: c.decode()[:10_000] for p, c in rows if c}


def test_what_goes_to_a_model_or_an_export_at_once_is_bounded(spark, tmp_path):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    rows = spark.range(0, 5000, 1, 1).select("id", F.lit("x").alias("text"))
    spark.conf.set(key, 10_000)
    sizes = {int(r.answer) for r in D.batch_infer(rows, lambda t: pd.Series([str(len(t))] * len(t))).collect()}
    assert max(sizes) <= 1000
    spark.conf.set(key, 10_000)
    W.export_blobs(rows.limit(3).select(F.col("id").cast("string").alias("path"), F.col("text").cast("binary").alias("content")), str(tmp_path))
    assert int(spark.conf.get(key)) <= 1000


def test_only_new_and_changed_files_are_exported(spark, tmp_path):
    from reqflow.sources.export import export_changed

    def at(rows):
        return spark.createDataFrame([(p, bytearray(c) if c is not None else None) for p, c in rows], "path string, content binary")

    root = str(tmp_path / "out")
    first = [(f"r/{i}/a.bin", b"x" * i) for i in range(40)] + [("r/none", None)]
    assert export_changed(at(first), root, "1") == 41
    held = {p: p.stat().st_mtime_ns for p in (tmp_path / "out/files").rglob("*") if p.is_file()}
    assert export_changed(at(first), root, "2") == 0
    assert {p: p.stat().st_mtime_ns for p in held} == held
    again = [(p, c) for p, c in first if p != "r/5/a.bin"] + [("r/5/a.bin", b"yyyyy"), ("r/new", b"z")]
    assert export_changed(at(again), root, "3") == 2
    assert (tmp_path / "out/files/r/5/a.bin").read_bytes() == b"yyyyy" and (tmp_path / "out/files/r/none").read_bytes() == b""
    assert export_changed(at(again[:3]), root, "4") == 0 and export_changed(at(again), root, "5") == 0


def test_files_of_a_run_are_packed_and_come_back_whole(spark, tmp_path):
    from reqflow.sources.export import export_packed, packed_files

    root = str(tmp_path / "out")
    at = lambda rows: spark.createDataFrame([(p, None if c is None else bytearray(c)) for p, c in rows.items()], "path string, content binary")
    first = {f"r/{i}/a.bin": b"x" * i for i in range(500)} | {"r/none": None}
    assert packed_files(spark, root) is None
    assert export_packed(at(first), root, "1") == 501 and export_packed(at(first), root, "1") == 0
    again = {"r/5/a.bin": b"yyyyy", "r/new": b"z", "r/none": b"", "r/6/a.bin": b"x" * 6}
    assert export_packed(at(again), root, "1") == 2
    want = {p: c or b"" for p, c in (first | again).items()}
    assert {r.path: bytes(r.content) for r in packed_files(spark, root).collect()} == want
    assert sum(p.is_file() for p in (tmp_path / "out").rglob("*")) < 150  # not a file for each
    assert W.export_blobs(packed_files(spark, root), str(tmp_path / "files")) == 502
    assert (tmp_path / "files/r/5/a.bin").read_bytes() == b"yyyyy"


def test_ingest_writes_no_file_for_each_attachment(spark, tmp_path):
    from reqflow.sources.export import packed_files

    req = spark.createDataFrame([("a", 1)], "req_no string, created_on int")
    attachments = spark.range(300).select(F.col("id").alias("attachment_id"), F.lit("a").alias("req_no"))
    docs = attachments.select("attachment_id", F.lit("in/f.txt").alias("attachment_name"), F.concat(F.lit("text "), F.col("attachment_id").cast("string")).alias("content"))
    tracker = spark.createDataFrame([], "req_no string, stage_id int, tracker_uuid string, created_at date, updated_at date")
    D.ingest(req, tracker, attachments, docs, "2024-06-01", str(tmp_path / "out"), n=None)
    assert sum(p.is_file() for p in (tmp_path / "out").rglob("*")) < 150
    assert {bytes(r.content).decode() for r in packed_files(spark, str(tmp_path / "out")).collect()} == {f"text {i}" for i in range(300)}


def test_a_file_that_can_not_be_written_fails_the_export(spark, tmp_path):
    (tmp_path / "r").write_text("a file where a folder must be")
    with pytest.raises(Exception, match="(?i)directory|exist"):
        W.export_blobs(spark.createDataFrame([(f"r/{i}", bytearray(b"x")) for i in range(50)], "path string, content binary"), str(tmp_path))


def test_jdbc_scan_reads_key_ranges(spark, tmp_path):
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    driver = "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    spark.range(1, 101).withColumn("V", F.col("id") * 2).withColumnRenamed("id", "K").coalesce(1).write.format("jdbc").option("url", url).option("driver", driver).option("dbtable", "T").save()
    got = S.jdbc_scan(spark, url, "T", "K", 4, driver=driver)
    assert got.rdd.getNumPartitions() == 4 and got.agg(F.sum("V")).first()[0] == 10100


def test_inference_errors_stay_with_their_row(spark):
    def model(texts: pd.Series) -> pd.Series:
        if (texts == "bad").any():
            raise ValueError("no")
        return texts + "!"

    df = spark.createDataFrame([(1, "a"), (2, "bad"), (3, "c")], "i int, text string").coalesce(1)
    got = {r.i: (r.answer, r.answer_error) for r in D.batch_infer(df, model).collect()}
    assert got == {1: ("a!", None), 2: (None, "ValueError: no"), 3: ("c!", None)}


def test_selected_items_keep_their_identity(spark):
    items = spark.createDataFrame(
        [("k1", None, "r", "bolt", 1), ("k2", 5, "r", None, 1), ("k3", 6, "r", "bolt m8", 1), ("k4", 7, "r", "bolt", 0)], "item_key string, detail_id long, req_no string, item_name string, is_selected int"
    )
    rows, rejected = D.embed_selected(items)
    got = rows.collect()
    assert [(r.id, r.item_name, len(r.vals)) for r in got] == [("dtl_6", "bolt m8", 64)] and abs(sum(x * x for x in got[0].vals) - 1) < 1e-5
    assert [r.item_key for r in rejected.collect()] == ["k1"]


def test_items_replace_or_append(spark):
    a = spark.createDataFrame([("r", "p", 1)], "req_no string, blob_path string, n int")
    assert D.replace_items(a, a).count() == 1 and D.replace_items(a, a, "append").count() == 2


def test_what_a_task_sorts_of_a_run_s_files_is_bounded(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    _, _, attachments, documents, _, _ = a_run(spark)
    try:
        for before, after in (("64MB", str(8 << 20)), ("1g", str(8 << 20)), ("16k", "16k"), (str(1 << 20), str(1 << 20))):
            spark.conf.set(key, before)
            D.attachments_of(attachments.select("req_no"), attachments, documents)
            assert spark.conf.get(key).removesuffix("b") == after
    finally:
        spark.conf.unset(key)


def test_files_of_all_requisitions_need_no_scope(spark):
    """A scope of all rows is a join of the table with itself, and drops rows without a requisition, which SQL keeps."""
    _, _, attachments, documents, _, _ = a_run(spark)
    more = attachments.union(spark.createDataFrame([(3, None)], attachments.schema))
    assert sorted(r.attachment_id for r in D.attachments_of(None, more, documents).collect()) == [1, 2, 3, 3]
    assert sorted(r.attachment_id for r in D.attachments_of(attachments.filter("req_no = 'b'").select("req_no"), more, documents).collect()) == [2]


def test_classify_files_with_a_model_that_fails(spark):
    def model(texts):
        if (texts == "boom").any():
            raise ValueError
        return pd.Series(['{"classification":"RFQ"}'] * len(texts))

    df = spark.createDataFrame([(1, "pdf", "x"), (2, "pdf", "boom"), (3, "unsupported", "x")], "i int, kind string, text string").coalesce(1)
    got = {r.i: (r.doc_type, r.confidence) for r in D.classify_files(df, model).collect()}
    assert got == {1: ("RFQ", 0.5), 2: ("Others", 0.0), 3: ("Others", 0.0)}


OFFER = "Vendor Name: V\nAddress: x\nDate: y\nTotal Amount: 3\nPayment Terms: 30 days net\nDelivery Time: 2 weeks\n{}"
ITEMS = "item_key string, detail_id long, req_no string, item_name string, quantity double, unit_price double, total_price double, currency string, supplier_name string, is_selected int"
TRACKED = "req_no string, stage_id int, tracker_uuid string, created_at date, updated_at date"


def a_run(spark):
    """Inputs of a run: a is fine, b's quotation can't be read, c has an item without a number, d is done."""
    files = [(1, "a", "in/a.txt", OFFER.format("Item Description: Bolt | Quantity: 2 | Unit Price: 1.5 | Currency: EUR")), (2, "b", "in/b.txt", OFFER.format("boom")), (3, "c", "in/c.zip", "x")]
    return (
        spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), ("d", 4)], "req_no string, created_on int"),
        spark.createDataFrame([("d", 8, "u", None, None), ("b", 2, "kept", None, None)], TRACKED),
        spark.createDataFrame([f[:2] for f in files], "attachment_id long, req_no string"),
        spark.createDataFrame([(f[0], *f[2:]) for f in files], "attachment_id long, attachment_name string, content string"),
        spark.createDataFrame([("k1", 5, "a", "bolt", 2.0, 3.0, 6.0, "EUR", "V", 1), ("k2", None, "c", "nut", 2.0, 3.0, 6.0, "EUR", "V", 1)], ITEMS),
        spark.createDataFrame([("dtl_9", 9, "z", [1.0] * 64)], "id string, detail_id long, req_group string, vals array<float>"),
    )


def reading_model(texts):
    if texts.str.contains("boom").any():
        raise ValueError("no answer")
    return pd.Series(['[{"item_name": "Bolt", "quantity": 2, "unit_price": 1.5}]'] * len(texts))


def test_a_requisition_with_a_rejected_row_stays_at_the_stage_before(spark, tmp_path):
    run = D.run_pipeline(*a_run(spark), "2024-06-01", str(tmp_path), infer=reading_model)
    assert {r.req_no: r.stage_id for r in run.tracker.collect()} == {"a": 8, "b": 4, "c": 5, "d": 8}
    lines = {r.req_no: (r.status, r.line) for r in run.lines.collect()}
    assert set(lines) == {"a", "b", "c"} and lines["a"][0] == "SUCCESS" and lines["a"][1].endswith("COMPLETE:OK")
    assert lines["b"] == ("FAILED", "ERR [b] ValueError: no answer") and lines["c"] == ("FAILED", "ERR [c] item without a number: nut")
    assert [r.detail_id for r in run.found.collect()] == [5] and run.classified is None
    said = {(r.req_no, r.stage_id): r.status for r in run.statuses.collect()}
    assert said["a", 5] == "OK (1 items)" and said["a", 3] == "OK (1 files)"


def test_a_run_stores_classifications_with_the_trackers_uuid_and_benchmarks(spark, tmp_path):
    old = spark.createDataFrame([(1, "was", "u0", "p", "RFQ", 0.1, None, None), (77, "q", None, "p", "BER", 0.2, None, None)], "attachment_id long, req_no string, tracker_uuid string, blob_path string, doc_type string, confidence double, created_at date, updated_at date")
    priced = spark.createDataFrame([(5, "EUR", 1.0, "s", None, None)], "detail_id long, currency string, bp_unit_price double, summary string, created_at date, updated_at date")
    label = lambda texts: pd.Series(['{"classification":"Quotation","confidence":0.9}'] * len(texts))
    run = D.run_pipeline(*a_run(spark), "2024-06-01", str(tmp_path), infer=reading_model, classified=old, benchmarks=priced, infer_label=label)
    got = {r.attachment_id: (r.req_no, r.tracker_uuid, r.doc_type, r.confidence, str(r.updated_at)) for r in run.classified.collect()}
    made = hashlib.sha256(b"tracker/c").hexdigest()
    assert got == {1: ("was", "u0", "Quotation", 0.9, "2024-06-01"), 2: ("b", "kept", "Quotation", 0.9, "2024-06-01"), 3: ("c", made, "Others", 0.0, "2024-06-01"), 77: ("q", None, "BER", 0.2, "None")}
    assert [(r.detail_id, r.currency, str(r.updated_at)) for r in run.benchmarks.collect()] == [(5, "EUR", "2024-06-01")]


def as_set(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("dies", ["store_vectors", "classify_files"])
def test_a_run_that_died_goes_on_at_its_stage(spark, tmp_path, monkeypatch, dies):
    calls = spark.sparkContext.accumulator(0)

    def counted(texts):
        calls.add(len(texts))
        return reading_model(texts)

    whole = D.run_pipeline(*a_run(spark), "2024-06-01", str(tmp_path / "whole"), infer=counted)
    want, asked = [as_set(x) for x in (whole.tracker, whole.lines, whole.found)], calls.value
    root = str(tmp_path / "dies")
    with monkeypatch.context() as m:
        m.setattr(D, dies, lambda *a, **k: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError, match="killed"):
            D.run_pipeline(*a_run(spark), "2024-06-01", root, infer=counted)
    (tmp_path / "dies" / "run=1" / "vectors" / "_temporary").mkdir(parents=True, exist_ok=True)  # half a table
    done = {p: p.stat().st_mtime_ns for p in (tmp_path / "dies" / "run=1").rglob("*.parquet")}
    before = calls.value
    run = D.run_pipeline(*a_run(spark), "2024-06-01", root, infer=counted)
    assert [as_set(x) for x in (run.tracker, run.lines, run.found)] == want
    assert {p: p.stat().st_mtime_ns for p in done} == done  # what was whole wasn't written again
    assert (calls.value > before) == (dies == "classify_files") and asked  # stage 5 isn't repeated
    moves = run.tracker.sparkSession.read.parquet(f"{root}/ledger")
    assert moves.filter("req_no = 'a'").count() == 8 and moves.filter("error is not null").count() == 2


def test_a_later_run_asks_no_model_about_what_it_knows(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    def counted(texts):
        calls.add(len(texts))
        return reading_model(texts.str.replace("boom", ""))

    def label(texts):
        calls.add(len(texts))
        return pd.Series(['{"classification":"Quotation","confidence":0.9}'] * len(texts))

    found = []
    for run_id in (1, 2):
        run = D.run_pipeline(*a_run(spark), "2024-06-01", str(tmp_path), infer=counted, infer_label=label, run_id=run_id, answers=D.Answers(str(tmp_path / "answers"), "m", str(run_id)))
        found.append((as_set(run.tracker), as_set(run.lines), calls.value))
    assert found[0][:2] == found[1][:2] and found[0][2] == found[1][2] >= 4  # two labels, two quotations
    assert {r.run for r in spark.read.parquet(f"{tmp_path}/ledger").select("run").distinct().collect()} == {1, 2}


def test_the_ledger_tells_how_far_each_requisition_came_last(spark):
    from reqflow.plans.ledger import LEDGER, latest

    rows = [("a", None, 1, 1), ("a", None, 1, 2), ("a", "bad", 1, 3), ("a", None, 2, 1), ("b", None, 1, 1), ("b", None, 1, 8), ("c", None, 1, 4), ("c", "x", 1, 5)]
    got = {r.req_no: (r.run, r.stage_id, r.error) for r in latest(spark.createDataFrame(rows, LEDGER)).collect()}
    assert got == {"a": (2, 1, None), "b": (1, 8, None), "c": (1, 4, "x")}


def test_answers_without_a_number_hold_their_requisition_back(spark, tmp_path):
    raw = '[{"pr_no":"%s","att_id":"%d","doc_type":"Quotation","classification_conf":0.5,"items":[{"item_name":"nut","quantity":1,"unit_price":2}]}]'
    responses = spark.createDataFrame([(i, raw % (r, i)) for i, r in enumerate("abz")] + [(9, "not json")], "doc_id long, raw string")
    req, tracker, _, _, items, vectors = a_run(spark)
    tracker = spark.createDataFrame([("a", 3, "u", None, None), ("c", 3, "u", None, None)], TRACKED)
    classified = spark.createDataFrame([], "attachment_id long, req_no string, doc_type string, confidence double, blob_path string")
    priced = spark.createDataFrame([], "detail_id long, currency string, bp_unit_price double, summary string, created_at date, updated_at date")
    run = D.apply_results(responses, req, tracker, classified, items, vectors, priced, "2024-06-01", str(tmp_path))
    assert {r.req_no: r.stage_id for r in run.tracker.collect()} == {"a": 8, "c": 5}
    lines = {r.req_no: r.line for r in run.lines.collect()}
    assert lines["c"] == "REQ [c]: CLASSIFICATION: OK (0 files) → METADATA_EXTRACTION: OK (0 items) → EMBEDDINGS: FAILED (item without a number: nut)"
    assert lines["a"].endswith("EMBEDDINGS: OK (1 vectors) → PRICE_BENCHMARK: OK (1 rows) → COMPLETE: OK")
    assert {(r.req_no, r.stage_id, r.error) for r in run.errors.collect()} == {(None, 4, "unreadable answer of 9"), ("c", 6, "item without a number: nut")}
    moves = spark.read.parquet(f"{tmp_path}/ledger")
    assert {r.stage for r in moves.filter("req_no = 'c' and error is null").collect()} == {4, 5}


def test_answers_are_kept_and_passing_faults_tried_again(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)
    seen = tmp_path / "seen"
    seen.mkdir()

    def flaky(texts):
        calls.add(len(texts))
        for t in texts:
            if t.startswith("slow") and len(texts) == 1:
                n = len(list(seen.glob(f"{t}-*")))
                (seen / f"{t}-{n}").touch()
                if n < (1 if t == "slow" else 9):
                    raise OSError("Connection reset by peer")
            elif t.startswith("slow"):
                raise OSError("connection reset")
            elif t == "bad":
                raise ValueError("no")
        return texts + "!"

    docs = spark.createDataFrame([(1, "a"), (2, "slow"), (3, "bad"), (4, "a"), (5, "slower"), (6, None)], "i int, text string").coalesce(1)
    ask = lambda run, model="m": {r.i: (r.answer, r.answer_error) for r in D.Answers(str(tmp_path / "kept"), model, run).infer(docs, flaky, wait=0.01).collect()}
    lost = "OSError: Connection reset by peer"
    want = {1: ("a!", None), 2: ("slow!", None), 3: (None, "ValueError: no"), 4: ("a!", None), 5: (None, lost), 6: ("!", None)}
    assert ask("1") == want
    assert len(list(seen.glob("slow-*"))) == 2 and len(list(seen.glob("slower-*"))) == 3  # bounded
    before = calls.value
    (tmp_path / "kept" / "v=dead-1").mkdir()  # a batch that never became whole
    assert ask("2") == want
    assert {p.name for p in seen.glob("slow-*")} == {"slow-0", "slow-1"} and calls.value > before  # only those that failed are asked again
    docs = docs.filter("i in (1, 2, 4, 6)")
    before = calls.value
    assert ask("3") == {i: want[i] for i in (1, 2, 4, 6)} and calls.value == before
    assert ask("4", "other")[1] == ("a!", None) and calls.value > before


def test_key_ranges_cover_without_overlap(spark):
    for low, high, n in ((0, 99, 7), (5, 5, 4), (-3, 3, 3), (0, 1, 8)):
        r = S.key_ranges(low, high, n)
        assert [x for a, b in r for x in range(a, b + 1)] == list(range(low, high + 1))
    df = spark.createDataFrame([(1, "a"), (None, "b"), (50, "c"), (50, "d")], "k long, v string")
    for equal in ("width", "depth"):
        parts = S.sliced_scan(df, "k", 3, columns=["v"], equal=equal)
        assert sorted(r.v for r in parts.collect()) == ["a", "b", "c", "d"] and parts.columns == ["slice", "v"]
        assert {r.v: r.slice for r in parts.collect()}["b"] == 0 and S.sliced_scan(df.limit(0), "k", 3, equal=equal).count() == 0


def test_jdbc_slices_of_a_skewed_key_are_near_equal(spark):
    url, driver = "jdbc:derby:memory:slices;create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    rows = spark.range(4000).select(F.pow("id", F.lit(3)).cast("long").alias("K"), F.col("id").alias("V")).union(spark.createDataFrame([(None, 9999)], "K long, V long"))
    rows.coalesce(1).write.format("jdbc").option("url", url).option("driver", driver).option("dbtable", "S").save()
    got = S.jdbc_slices(spark, url, "S", "K", 8, driver=driver)
    sizes = [r[1] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) <= 2 * 4001 / 8 and got.agg(F.sum("V")).first()[0] == 3999 * 2000 + 9999
    wide = S.jdbc_scan(spark, url, "S", "K", 8, driver=driver).groupBy(F.spark_partition_id()).count()
    assert max(r[1] for r in wide.collect()) > 2 * 4001 / 8  # what equal widths give


def test_half_written_pointers_and_leftovers_are_passed_over(spark, tmp_path):
    root = str(tmp_path)
    W.publish(spark, spark.range(3), root, "1", 3)
    (tmp_path / "_pointers" / "_dead").write_text("nowhere")
    (tmp_path / "_pointers" / "000000007").write_text("")  # a run that died while it wrote the pointer
    W.write_version(spark.range(9), root, "dead")  # one that died before it
    assert W.current(spark, root).count() == 3
    W.publish(spark, spark.range(4), root, "2", 4)
    assert W.current(spark, root).count() == 4
    assert sorted(v.rsplit("/", 1)[-1] for v in W.versions(spark, root)) == ["v=2"]  # the empty pointer counts as one of the two kept
    with pytest.raises(FileExistsError):
        W.write_version(spark.range(1), root, "2")


def test_a_failed_write_is_repeated_under_the_same_run(spark, tmp_path):
    tables = {"a": spark.range(3), "b": spark.range(2)}
    job(spark, tmp_path, tables).run(control(spark, "ab"))
    bad = spark.range(5).withColumn("id", F.when(F.col("id") == 4, F.raise_error(F.lit("boom")).cast("long")).otherwise(F.col("id")))
    first = {r.etl_id: r.status for r in job(spark, tmp_path, {"a": bad, "b": spark.range(4)}, 2).run(control(spark, "ab")).collect()}
    assert first == {0: "FAILED", 1: "SUCCESS"}
    assert W.current(spark, f"{tmp_path}/a").count() == 3 and not (tmp_path / "a" / "v=2").exists()
    (tmp_path / "a" / "v=2" / "_temporary").mkdir(parents=True)  # killed, so that nothing could tidy up
    again = job(spark, tmp_path, {"a": spark.range(6)}, 2).run(control(spark, "a"))
    assert [r.n_rows for r in again.filter("status = 'SUCCESS' and etl_id = 0").collect()] == [6]
    assert W.current(spark, f"{tmp_path}/a").count() == 6


def test_orphans_are_reported_after_a_run(spark, tmp_path):
    tables = {"p": spark.range(3), "c": spark.createDataFrame([(1,), (9,), (None,)], "fk long"), "x": None}
    got = {r.etl_id: (r.success, r.tables, r.failed, r.n_rows, r.n_orphans) for r in job(spark, tmp_path, tables).run_and_check(control(spark, "pcx"), [("c", "fk", "p", "id"), ("x", "fk", "p", "id")]).collect()}
    assert got == {0: (True, 1, 0, 3, 0), 1: (True, 1, 0, 3, 1), 2: (False, 1, 1, 0, 0), None: (False, 3, 1, 6, 1)}
