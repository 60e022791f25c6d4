"""The inverted-file index against the exact search."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from reqflow.operators import cells as C
from reqflow.operators.vectors import nearest

SCHEMA = "detail_id long, req_group string, vals array<float>"
SF = "/root/testdata/sf0.1"


def table(spark, n, dim=16, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    rows = [(i, f"g{i % 7}", (centres[i % 12] + 0.5 * rng.normal(size=dim)).tolist()) for i in range(n)]
    rows += [(n + i, None, rows[0][2]) for i in range(n // 3)]  # a third are one vector
    rows += [(None, "g", rows[0][2]), (10**6, "g", None)]
    return spark.createDataFrame(rows, SCHEMA)


def recall(got, want):
    got, want = ({(r.query_id, r.detail_id) for r in df.collect()} for df in (got, want))
    return len(got & want) / len(want)


@pytest.mark.parametrize("exclude", ["before", "after"])
def test_all_cells_probed_is_the_exact_search(spark, monkeypatch, exclude):
    monkeypatch.setattr(C, "INDEX_BLOCK", 50)  # the hot cell is divided
    monkeypatch.setattr(C, "QUERY_BLOCK", 5)
    df = table(spark, 300)
    queries = df.filter("detail_id % 10 = 0")
    got = C.nearest_in_cells(df, queries, 5, n_cells=8, probes=8, exclude=exclude)
    as_rows = lambda d: sorted((r.query_id, r.detail_id, round(r.score, 9), r.rk) for r in d.collect())
    assert as_rows(got) == as_rows(nearest(df, queries, 5, exclude))


def test_few_cells_find_most_neighbours_and_no_others(spark):
    df = table(spark, 900)
    queries = df.filter("detail_id % 9 = 0")
    got = C.nearest_in_cells(df, queries, 5, n_cells=12, probes=4)
    assert recall(got, nearest(df, queries, 5)) > 0.9
    assert got.groupBy("query_id").count().agg(F.max("count")).first()[0] <= 5
    assert C.nearest_in_cells(df.limit(0), queries, 5).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_recall_on_the_test_data(spark):
    from reqflow import catalog

    got = recall(catalog.QUERIES["knn_cells"](spark, SF), catalog.QUERIES["knn_prefilter"](spark, SF))
    print(f"recall {got}")
    assert got >= 0.9
