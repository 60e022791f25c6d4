"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage
before it kept.  Between stages the documents are written to the shared
checkpoint folder and read again, so a lost executor costs one stage at most.

Defined results, of :func:`run` and of every stage: documents with a null, empty or wordless text are rejected by the quality rules; after
them, in a stage used alone, exact copies of empty texts are copies, texts without words are never near copies, and an empty text packs as one token.
Very long texts are read whole.  Of equal rows one stays (exact copies).  Of ties the row with the largest doc_id stays among exact copies, the one with the
smallest among near copies; null ids come last.  A null source is a source of its own.  An empty table gives an empty table.  All stages but the last
return the columns that they are given, whatever these are; the texts' column is ``text``, the identifiers' ``doc_id``; ``source`` and ``n_chars`` may be missing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reqflow.llm import exact_dedup, near_dedup, packing, pii, quality
from reqflow.llm.common import shared_path

#: Key of the surrogates; a production run sets its own.
SURROGATE_KEY = "reqflow-demo-key"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules; null, empty and wordless texts don't."""
    return quality.keep_clean(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the largest doc_id, null ids first to go; null counts as empty."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five-word shingles, similarity 0.8): the smallest doc_id; texts without words stay."""
    return near_dedup.drop_near_copies(docs, width=5, percent=80)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data and secrets; n_chars follows the text, where there is such a column; a null text stays null."""
    out = pii.replace_entities(docs, SURROGATE_KEY)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        counted = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind))
        out = out.select(*[counted.alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in out.columns])
    return out


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and the training sequence (bin) each goes into; repeated rows are packed each for itself."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("pii_surrogates", personal_data),
    ("best_fit_packing", packed),
]

#: Packing is sequential within a shard and surrogates are keyed hashes: SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; the result is the last stage's."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
