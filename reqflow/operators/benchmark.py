"""Price benchmarks of items from the prices of similar ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reqflow.functions.text import default_currency


def price_histogram(rows: DataFrame, *keys: str, price: str = "unit_price") -> DataFrame:
    """keys, price, n: how often each price occurs; pre-aggregated before it is shuffled, and histograms add up."""
    return rows.filter(F.col(price).isNotNull()).groupBy(*keys, F.col(price).alias("price")).agg(F.count("*").alias("n"))


def median_price(histogram: DataFrame, *keys: str, out: str = "median") -> DataFrame:
    """keys and the median of a histogram (keys, price, n): the price at the middle of the running counts, or midway between the two there.

    Prices pass in order, and no list of them is held.
    """
    ordered = Window.partitionBy(*keys).orderBy("price")
    counted = histogram.withColumn("__upto", F.sum("n").over(ordered.rowsBetween(Window.unboundedPreceding, 0))).withColumn("__all", F.sum("n").over(Window.partitionBy(*keys)))
    at = lambda place: F.min(F.when(F.col("__upto") >= place, F.col("price")))
    low, high = at(F.floor((F.col("__all") + 1) / 2)), at(F.floor(F.col("__all") / 2) + 1)
    return counted.groupBy(*keys).agg((low + (high - low) * 0.5).alias(out))


def price_benchmark(items: DataFrame, neighbours: DataFrame, history: DataFrame, top: int = 5, on_error: str = "null") -> DataFrame:
    """One row per item and currency: median, least, most, count and score-weighted mean of neighbours' prices.

    ``items``: detail_id, currency, unit_price.  ``neighbours``: query_id,
    detail_id, score, rk.  ``history``: detail_id, currency, unit_price.  Only
    prices in the item's currency count; an item without any has null prices, or no row with ``on_error="skip"``.
    Prices are counted per article first, and the counts are merged over an item's neighbours, once for all items with the same ones.
    """
    near = neighbours.filter(F.col("rk") <= top).select("query_id", "detail_id", F.floor(F.col("score") * 1000 + 0.5).cast("long").alias("weight"))
    lists = near.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("detail_id", "weight"))).alias("near"))
    alike = lists.groupBy("near").agg(F.min("query_id").alias("list_id"))
    owners = lists.join(alike, "near").select("query_id", "list_id")
    near = alike.select("list_id", F.explode("near").alias("n")).select("list_id", "n.*")
    prices = price_histogram(history.withColumn("currency", default_currency(F.col("currency"))), "detail_id", "currency")
    # Sums of whole numbers, so that the result doesn't depend on the order of rows.
    merged = near.join(prices, "detail_id").groupBy("list_id", "currency", "price").agg(F.sum("n").alias("n"), F.sum(F.col("weight") * F.col("n")).alias("weight"))
    cents = F.floor(F.col("price") * 100 + 0.5).cast("long")
    stats = merged.groupBy("list_id", "currency").agg(
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.sum("n").alias("n_prices"),
        (F.sum(F.col("weight") * cents) / F.sum("weight") / 100).alias("weighted_price"),
    )
    stats = stats.join(median_price(merged.select("list_id", "currency", "price", "n"), "list_id", "currency", out="bp_unit_price"), ["list_id", "currency"])
    wanted = items.select(F.col("detail_id").alias("query_id"), default_currency(F.col("currency")).alias("currency"), "unit_price")
    own = median_price(price_histogram(wanted, "query_id", "currency"), "query_id", "currency", out="unit_price")
    current = wanted.select("query_id", "currency").distinct().join(own, ["query_id", "currency"], "left")
    stats = owners.join(stats, "list_id").drop("list_id")
    out = current.join(stats, ["query_id", "currency"], "inner" if on_error == "skip" else "left")
    return out.select(
        F.col("query_id").alias("detail_id"), "currency", "unit_price", "bp_unit_price", "min_price", "max_price",
        F.coalesce("n_prices", F.lit(0)).cast("long").alias("n_prices"), "weighted_price", (F.col("unit_price") / F.col("bp_unit_price")).alias("price_ratio"),
    )


def summary_text(n: str = "n_prices", median: str = "bp_unit_price", ratio: str = "price_ratio"):
    """A sentence about a benchmark."""
    trend = F.when(F.col(ratio) > 1.05, "above").when(F.col(ratio) < 0.95, "below").otherwise("near")
    text = F.concat(F.lit("Price is "), trend, F.lit(" the median of "), F.col(n).cast("string"), F.lit(" similar prices."))
    return F.when(F.col(median).isNull(), F.lit("No similar prices.")).otherwise(text)
