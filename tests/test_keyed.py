"""Upserts that read and write the buckets of their keys only."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from reqflow.operators.merge import upsert
from reqflow.sources import publish as W
from reqflow.sources.keyed import KeyedTable


def rows(spark, keys, made):
    return spark.createDataFrame([(k, None if k is not None and k % 7 == 0 else float(k or 0), made) for k in keys], "k long, price double, made string")


def files(root):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{root}/data/**/part-*.parquet", recursive=True)}


@pytest.fixture
def table(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "t"), "k", 32)
    t.replace(rows(spark, [*range(1000), None], "old"), "1")
    return t


def same(a, b):
    return sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


def test_an_upsert_touches_its_buckets_only(spark, table, tmp_path):
    before = files(table.root)
    source = rows(spark, [5, 6, 7, 2000], "new")
    want = upsert(table.read(), source, "k", ["price"])
    want = spark.createDataFrame(want.collect(), want.schema)
    touched = {r[0] for r in source.select(table.bucket()).collect()}
    own = table.read(list(touched)).count()
    assert table.upsert(source, "2", ["price"]) == own + 1  # the rows of those buckets and one new one
    after = files(table.root)
    assert {f: t for f, t in after.items() if f in before} == before  # nothing old was written to
    assert {int(f.split("bucket__=")[1].split("/")[0]) for f in set(after) - set(before)} == touched and len(touched) <= 4
    assert same(table.read(), want)
    assert {p.split("/v=")[1].split("/")[0] for p in table.manifest().values()} == {"1", "2"}


def test_update_only_null_keys_and_new_buckets(spark, table):
    source = rows(spark, [5000, None, 3], "new")
    want = upsert(table.read(), source, "k", ["price", "made"], insert=False)
    want = spark.createDataFrame(want.collect(), want.schema)
    table.upsert(source, "2", ["price", "made"], insert=False)
    assert same(table.read(), want) and table.read().filter("made = 'new'").count() == 1
    table.upsert(source, "3", ["price"])
    assert table.read().count() == 1003 and table.read().filter("k is null").count() == 2


def test_a_failed_upsert_is_repeated_and_old_folders_go(spark, table):
    bad = rows(spark, [1], "new").withColumn("price", F.raise_error(F.lit("boom")).cast("double"))
    with pytest.raises(Exception, match="boom"):
        table.upsert(bad, "2", ["price"])
    assert table.read().count() == 1001 and {p.split("/v=")[1].split("/")[0] for p in table.manifest().values()} == {"1"}
    for v in "2345":
        table.upsert(rows(spark, [1], v), v, ["made"])
    assert table.read().filter("k = 1").first().made == "5"
    kept = {v.rsplit("=", 1)[-1] for v in W.versions(spark, f"{table.root}/data")}
    assert kept == {"1", "4", "5"}  # the two last manifests and what they refer to
    table.replace(rows(spark, [1], "all"), "6")
    table.replace(rows(spark, [2], "all"), "7")
    assert {v.rsplit("=", 1)[-1] for v in W.versions(spark, f"{table.root}/data")} == {"6", "7"}
    assert table.read().count() == 1
    with pytest.raises(ValueError):
        KeyedTable(spark, f"{table.root}-none", "k").upsert(rows(spark, [1], "x"), "1", ["made"])
