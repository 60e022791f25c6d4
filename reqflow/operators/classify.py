"""Documents classified by how many of a category's fields their text has."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Category:
    name: str
    fields: tuple[str, ...]
    required: tuple[str, ...] = ()


# Categories in order of precedence; a field is a pattern, `required` must be met.
CATEGORIES = (
    Category(
        "MPBC",
        (r"supplier\s*[12]\b", r"supplier\s*3", r"\bras (?:number|no)", r"\bgsp\b", r"\bmpbc\b|bid comparison|preisspiegel|angebotsvergleich", r"approv"),
        (r"supplier\s*3",),
    ),
    Category("Quotation", (r"vendor name", r"\baddress\b", r"\bdate\b", r"total amount", r"payment terms", r"delivery time", r"\bvalidity\b|valid until", r"item description")),
    Category("RFQ", (r"project name", r"rfq number", r"\bdate\b", r"supplier to specify", r"specification", r"\bcommercials\b")),
    Category("BER", (r"bid exception report", r"order value", r"justification", r"\b[a-e]\)|option [a-e]\b", r"\bprepared\b", r"\bpurchasing\b", r"\bmd\b"), (r"bid exception report",)),
    Category("E-Auction", (r"event id", r"bid id", r"participant", r"basic price", r"extended price", r"e-?auction|reverse auction", r"[0-9]{1,2}:[0-9]{2}")),
)
MIN_COVERAGE = 0.6


def has_field(low: Column, field: str) -> Column:
    """Whether a lower-cased text has a field; a plain one is looked for as it is."""
    return low.contains(field) if re.fullmatch("[a-z0-9 ]+", field) else low.rlike(field)


def coverage(low: Column, category: Category) -> Column:
    """Share of the category's fields that a lower-cased text has; 0 without a required one."""
    met = sum((has_field(low, f).cast("int") for f in category.fields), F.lit(0))
    share = met.cast("double") / F.lit(float(len(category.fields)))
    for r in category.required:
        share = F.when(has_field(low, r), share).otherwise(0.0)
    return share


def coverage_classify(docs: DataFrame, text: str = "text", categories: tuple[Category, ...] = CATEGORIES) -> DataFrame:
    """``docs`` with doc_type, coverage and band: one pass, no shuffle."""
    scores = [coverage(F.col("__low"), c) for c in categories]
    scored = docs.withColumn("__low", F.lower(F.coalesce(F.col(text), F.lit("")))).withColumn("__s", F.array(*scores))
    best = F.array_max("__s")
    name = F.element_at(F.array(*[F.lit(c.name) for c in categories]), F.array_position("__s", best).cast("int"))
    band = F.when(best >= 0.9, "all").when(best >= 0.75, "most").when(best >= MIN_COVERAGE, "enough").otherwise("none")
    return (
        scored.withColumn("doc_type", F.when(best >= MIN_COVERAGE, name).otherwise("Other")).withColumn("coverage", best).withColumn("band", band).drop("__s", "__low")
    )
