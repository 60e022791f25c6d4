"""Counts, summaries and text lines of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reqflow.operators.requisitions import STAGES


def reconcile(loaded: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Rows loaded against rows in the source, by table: key, n_loaded, n_source, percent, complete."""
    a = loaded.groupBy(key).agg(F.count("*").alias("n_loaded"))
    b = source.groupBy(key).agg(F.count("*").alias("n_source"))
    both = b.join(a, key, "full").select(key, F.coalesce("n_loaded", F.lit(0)).cast("long").alias("n_loaded"), F.coalesce("n_source", F.lit(0)).cast("long").alias("n_source"))
    percent = F.when(F.col("n_source") == 0, 100.0).otherwise(F.col("n_loaded") * 100.0 / F.col("n_source"))
    return both.withColumn("percent", percent).withColumn("complete", F.col("n_loaded") == F.col("n_source"))


def latest_sync(status: DataFrame) -> DataFrame:
    """Last run of each entry: etl_id, synced_on, status."""
    last = F.max(F.struct("synced_on", "run_id", "status")).alias("m")
    return status.groupBy("etl_id").agg(last).select("etl_id", F.col("m.synced_on").alias("synced_on"), F.col("m.status").alias("status"))


def sync_summary(status: DataFrame) -> DataFrame:
    """Totals of a run (etl_id null) and the results of each table: etl_id, success, tables, failed, n_rows."""
    totals = status.rollup("etl_id").agg(
        F.grouping("etl_id").alias("__all"),
        F.bool_and(F.col("status") == "SUCCESS").alias("success"),
        F.count("*").alias("tables"),
        F.count_if(F.col("status") == "FAILED").alias("failed"),
        F.coalesce(F.sum("n_rows"), F.lit(0)).cast("long").alias("n_rows"),
    )
    return totals.withColumn("success", F.coalesce("success", F.lit(True))).drop("__all")


def pipeline_summary(results: DataFrame) -> DataFrame:
    """status, n, total: how many requisitions of a run (req_no, status) succeeded and failed."""
    n = results.groupBy("status").agg(F.count("*").alias("n"))
    return n.withColumn("total", F.sum("n").over(Window.partitionBy()))  # one row per status


def result_lines(stages: DataFrame, errors: DataFrame) -> DataFrame:
    """req_no, status, line: ``OK [x] STAGE:word -> ...`` of a requisition's stages, or ``ERR [x] error`` of its first error.

    ``stages``: req_no, stage_id, status, of which the words before a bracket are taken.  ``errors``: req_no, stage_id, error.
    """
    names = F.array(*[F.lit(s) for s in STAGES])
    word = F.rtrim(F.regexp_extract("status", r"^([^(]*)", 1))
    done = joined_in_order(stages, "req_no", F.concat(F.element_at(names, F.col("stage_id")), F.lit(":"), word), ["stage_id"], " → ", "stages")
    first = errors.groupBy("req_no").agg(F.min(F.struct("stage_id", "error")).alias("e")).select("req_no", F.col("e.error").alias("error"))
    both = done.join(first, "req_no", "full")
    failed = F.col("error").isNotNull()
    line = F.when(failed, F.concat(F.lit("ERR ["), F.col("req_no"), F.lit("] "), F.col("error"))).otherwise(F.concat(F.lit("OK ["), F.col("req_no"), F.lit("] "), F.col("stages")))
    return both.select("req_no", F.when(failed, "FAILED").otherwise("SUCCESS").alias("status"), line.alias("line"))


def counts_per_requisition(scope: DataFrame, **tables: tuple[DataFrame, Column | None]) -> DataFrame:
    """``scope`` with one count per named table (rows that meet a condition, if given); 0 where there are none."""
    out = scope.select("req_no")
    for name, (df, cond) in tables.items():
        n = F.count("*") if cond is None else F.count_if(cond)
        out = out.join(df.groupBy("req_no").agg(n.cast("long").alias(name)), "req_no", "left")
    return out.select("req_no", *[F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in tables])


def ok_or_skipped(n: Column, what: str, why: str) -> Column:
    return F.when(n > 0, F.concat(F.lit("OK ("), n.cast("string"), F.lit(f" {what})"))).otherwise(f"SKIPPED ({why})")


def joined_in_order(df: DataFrame, key: str, value: Column, order: list[str], separator: str, out: str) -> DataFrame:
    """One text per key: values in order, joined; strings are bounded by the key's rows."""
    rows = df.select(key, *[F.col(o) for o in order], value.alias("__v"))
    packed = rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*order, "__v"))).alias("__a"))
    return packed.select(key, F.array_join(F.transform("__a", lambda x: x["__v"]), separator).alias(out))


def stage_lines(stages: DataFrame) -> DataFrame:
    """``REQ [x]: STAGE: status -> ...`` from req_no, stage_id, status."""
    names = F.array(*[F.lit(s) for s in STAGES])
    text = F.concat(F.element_at(names, F.col("stage_id")), F.lit(": "), F.col("status"))
    lines = joined_in_order(stages, "req_no", text, ["stage_id"], " → ", "stages")
    return lines.select("req_no", F.concat(F.lit("REQ ["), F.col("req_no"), F.lit("]: "), F.col("stages")).alias("line"))


def text_batch(scope: DataFrame, files: DataFrame) -> DataFrame:
    """One text per requisition of the scope: its files' sections, or a note that there are none.

    ``files``: req_no, attachment_id, name, text.
    """
    section = F.concat(F.lit("=== FILE: "), F.col("name"), F.lit(" (REQ: "), F.col("req_no"), F.lit(") ===\n"), F.col("text"))
    texts = joined_in_order(files, "req_no", section, ["attachment_id"], "\n\n", "batch")
    return scope.select("req_no").join(texts, "req_no", "left").withColumn("batch", F.coalesce("batch", F.lit("(no files found)")))


def text_batches(scope: DataFrame, files: DataFrame, limit: int = 100_000) -> DataFrame:
    """req_no, batch_no (from 0), batch: :func:`text_batch` in texts of at most ``limit`` characters; joined in order they are that text.

    Files go to batches by running sizes within their requisition.  One of more than half the limit is divided into parts; nothing is cut off.
    Only sizes are sorted by requisition, and texts are gathered by batch, so a requisition with very many files is spread.
    """
    half = max(1, limit // 2)
    section = F.concat(F.lit("=== FILE: "), F.col("name"), F.lit(" (REQ: "), F.col("req_no"), F.lit(") ===\n"), F.col("text"))
    order = Window.partitionBy("req_no").orderBy("attachment_id", "name")
    sizes = files.select("req_no", "attachment_id", "name", F.length(section).alias("size")).withColumn("first", F.row_number().over(order) == 1)
    sizes = sizes.withColumn("size", F.col("size") + F.when(F.col("first"), 0).otherwise(2))
    sizes = sizes.withColumn("start", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    placed = files.join(sizes.select("req_no", "attachment_id", "name", "first", F.coalesce("start", F.lit(0)).cast("long").alias("start")), ["req_no", "attachment_id", "name"])
    whole = placed.select("req_no", "start", F.concat(F.when(F.col("first"), "").otherwise("\n\n"), section).alias("text"))
    parts = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{half}}}"), F.lit(0))
    parts = whole.select("req_no", "start", F.posexplode(parts).alias("i", "part")).withColumn("at", F.col("start") + F.col("i") * half)
    # Parts that start in one half-limit of the running size: together with the last of them no more than the limit.
    numbered = parts.groupBy("req_no", F.floor(F.col("at") / half).alias("batch_no")).agg(F.array_sort(F.collect_list(F.struct("at", "part"))).alias("p"))
    batches = numbered.select("req_no", "batch_no", F.array_join(F.transform("p", lambda x: x["part"]), "").alias("batch"))
    out = scope.select("req_no").join(batches, "req_no", "left")
    return out.select("req_no", F.coalesce("batch_no", F.lit(0)).cast("long").alias("batch_no"), F.coalesce("batch", F.lit("(no files found)")).alias("batch"))


def assemble_fragments(fragments: DataFrame, cap: int = 15_000, rows_per_sheet: int = 500) -> DataFrame:
    """doc_id, text: sheets in order under a header line, rows of tab-joined cells, blank rows left out.

    ``fragments``: doc_id, sheet, row_no, cells.
    """
    line = F.array_join(F.filter("cells", lambda c: c.isNotNull()), "\t")
    rows = fragments.withColumn("line", line)
    w = Window.partitionBy("doc_id", "sheet").orderBy("row_no", "line")
    rows = rows.withColumn("__n", F.row_number().over(w)).filter((F.col("__n") <= rows_per_sheet) & (F.col("line") != ""))
    heads = fragments.select("doc_id", "sheet").distinct().select("doc_id", "sheet", F.lit(0).alias("__n"), F.concat(F.lit("--- Sheet: "), F.col("sheet"), F.lit(" ---")).alias("line"))
    both = rows.select("doc_id", "sheet", "__n", "line").union(heads)
    return joined_in_order(both, "doc_id", F.col("line"), ["sheet", "__n"], "\n", "text").withColumn("text", F.substring("text", 1, cap))
