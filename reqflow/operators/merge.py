"""Upserts as joins: the result is a new table, to be published in place of the old one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def last_wins(df: DataFrame, key: Sequence[str] | str, *order: Column) -> DataFrame:
    """One row per key: the last by ``order``."""
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*[c.desc_nulls_last() for c in order])
    return df.withColumn("__rank", F.row_number().over(w)).filter("__rank = 1").drop("__rank")


def upsert(target: DataFrame, source: DataFrame, key: str, update: Sequence[str], insert: bool = True) -> DataFrame:
    """``target`` after a merge of ``source`` on ``key``.

    Matched rows take ``update`` from the source, nulls included, and keep the
    rest; other source rows are added if ``insert``.  The source must have one row
    per key (see :func:`last_wins`) and the target's columns; null keys match nothing.
    """
    t = target.select(F.col(key), F.struct(*target.columns).alias("t"))
    s = source.select(F.col(key), F.struct(*target.columns).alias("s"))
    joined = t.join(s, key, "full" if insert else "left")

    def value(c: str) -> Column:
        new = F.col("s")[c]
        matched = new if c in update else F.col("t")[c]
        return F.when(F.col("s").isNull(), F.col("t")[c]).when(F.col("t").isNull(), new).otherwise(matched).alias(c)

    return joined.select(*[value(c) for c in target.columns])
