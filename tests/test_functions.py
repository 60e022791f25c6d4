from pyspark.sql import functions as F

from reqflow.functions import answers as A
from reqflow.functions import text as X


def values(spark, cells, fn, kind="string"):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], f"i int, c {kind}")
    return [r.v for r in df.select("i", fn(F.col("c")).alias("v")).orderBy("i").collect()]


def test_names_and_paths(spark):
    got = values(spark, [None, "", "a/b.pdf", "a/", "x"], lambda c: X.safe_name(c, F.lit(7)))
    assert got == ["7.bin", "7.bin", "b.pdf", "a", "x"]
    assert values(spark, ["R_1/2024", "a\\b"], X.safe_req) == ["R_1_2024", "a_b"]
    assert values(spark, ["d/q.pdf"], lambda c: X.blob_path(F.lit("R_1/2"), F.lit(5), c)) == ["procurement/R_1_2/5/q.pdf"]


def test_kinds_and_caps(spark):
    assert values(spark, ["A.PDF", ".pdf", "x.tar.gz", "none", None, "a.HTM", "p/q.jpeg"], X.file_kind) == ["pdf", "unsupported", "unsupported", "unsupported", "unsupported", "text", "image"]
    assert values(spark, ["pdf", "csv", "image"], lambda c: F.length(X.text_cap(F.lit("x" * 20000), c))) == [15000, 10000, 0]


def test_images_and_ocr(spark):
    rows = [(199, 199, 0.1), (1000, 150, 0.1), (500, 500, 0.98), (None, None, None), (600, 600, 0.5)]
    df = spark.createDataFrame(rows, "w int, h int, b double")
    assert [r.t for r in df.select(X.is_trivial_image(F.col("w"), F.col("h"), F.col("b")).alias("t")).collect()] == [True, True, True, True, False]
    df = spark.createDataFrame([(" " * 60 + "x" * 49, 1), ("x" * 50, 1), ("x", 0), (None, 2)], "t string, n int")
    assert [r.o for r in df.select(X.needs_ocr(F.col("t"), F.col("n")).alias("o")).collect()] == [True, False, False, True]


def test_clips_and_errors(spark):
    assert values(spark, [None, "x" * 300], X.clip) == ["", "x" * 200]
    assert values(spark, ["a\nb" + "c" * 600], X.error_clip) == ["a b" + "c" * 497]
    assert values(spark, ["TCP Provider: x", "state 40001", "bad column", None, "Timed OUT"], X.is_transient) == [True, True, False, False, True]
    assert values(spark, [None, "", "EUR"], X.default_currency) == ["USD", "USD", "EUR"]


def test_fences(spark):
    raw = ["[1]", "```json\n[1]\n```", "```\n[1]", "\n ```json\n{}\n``` ", None]
    assert values(spark, raw, A.fence_strip) == ["[1]", "[1]", "[1]", "{}", ""]


def test_classification_answers(spark):
    raw = ["{}", "x", '{"classification":"E-Auction"}', '{"classification":"BER","confidence":0.9}', None, '[{"classification":"RFQ"}]']
    got = values(spark, raw, A.parse_classification)
    assert [tuple(g) for g in got] == [("Others", 0.5), ("Others", 0.0), ("E-Auction Results", 0.5), ("BER", 0.9), ("Others", 0.0), ("Others", 0.0)]


def test_item_answers(spark):
    raw = ['{"item_name":"x"}', "[]", "[1", '[{"item_name":"x","quantity":"bad","unit_price":2}]', None]
    got = values(spark, raw, A.parse_items)
    assert [len(g) for g in got] == [0, 0, 0, 1, 0]
    assert (got[3][0].item_name, got[3][0].quantity, got[3][0].unit_price) == ("x", None, 2.0)


def test_item_normalisation(spark):
    assert values(spark, [" us$", "€", "inr", "", None], A.currency_code) == ["USD", "EUR", "INR", None, None]
    assert values(spark, ["NET 30", "45 days net", "advance", None], A.payment_terms) == ["Net 30", "Net 45", "advance", ""]


def test_currency_text_is_made_once(spark):
    """Its white space is stripped by patterns, so it must not be made anew for each currency's name."""
    from reqflow.functions import answers as A

    df = spark.sql("select explode(array(' us$ ', 'Euro', 'rs.', '', ' ', 'chf', null)) as c").select(A.currency_code(F.col("c")).alias("code"))
    assert [r.code for r in df.collect()] == ["USD", "EUR", "INR", None, None, "CHF", None]
    assert str(df._jdf.queryExecution().optimizedPlan()).lower().count("regexp_replace") <= 4
