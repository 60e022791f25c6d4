"""A model's JSON answers, turned into typed columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reqflow.functions.text import clip, strip

#: A model's labels that have another name here, and currency signs and words.
LABELS = {"E-Auction": "E-Auction Results", "Other": "Others"}
CURRENCIES = {"$": "USD", "US$": "USD", "DOLLAR": "USD", "€": "EUR", "EURO": "EUR", "£": "GBP", "POUND": "GBP", "₹": "INR", "RS": "INR", "RS.": "INR", "RUPEE": "INR", "R": "ZAR", "RAND": "ZAR", "DIRHAM": "AED"}

ITEM = (
    "struct<item_name:string,quantity:double,unit_price:double,total_price:double,currency:string,"
    "delivery_time:string,payment_terms:string,supplier_name:string>"
)
FILE_RECORDS = f"array<struct<pr_no:string,att_id:string,filename:string,blob_path:string,doc_type:string,classification_conf:double,items:array<{ITEM}>>>"


def fence_strip(raw: Column) -> Column:
    """The text inside a leading code fence, without its language tag; other text trimmed."""
    text = strip(F.coalesce(raw, F.lit("")))
    inner = strip(F.regexp_replace(F.element_at(F.split(text, "```"), 2), "^[json]+", ""))
    return F.when(text.startswith("```"), inner).otherwise(text)


def label_map(label: Column) -> Column:
    out = label
    for theirs, ours in LABELS.items():
        out = F.when(label == theirs, ours).otherwise(out)
    return out


def parse_classification(raw: Column) -> Column:
    """struct(doc_type, confidence): Others and 0.5 where a field is missing, Others and 0.0 for what isn't a JSON object."""
    text = fence_strip(raw)
    got = F.from_json(text, "struct<classification:string,confidence:double>")
    fine = text.startswith("{") & text.endswith("}") & got.isNotNull()
    return F.struct(
        F.when(fine, label_map(F.coalesce(got["classification"], F.lit("Other")))).otherwise("Others").alias("doc_type"),
        F.when(fine, F.coalesce(got["confidence"], F.lit(0.5))).otherwise(0.0).alias("confidence"),
    )


def parse_items(raw: Column) -> Column:
    """The array of items in an answer; empty for anything but a JSON array."""
    text = fence_strip(raw)
    return F.coalesce(F.when(text.startswith("["), F.from_json(text, f"array<{ITEM}>")), F.array().cast(f"array<{ITEM}>"))


def parse_file_records(raw: Column) -> Column:
    """The array of file records in an answer; null where it can't be read."""
    text = fence_strip(raw)
    return F.when(text.startswith("["), F.from_json(text, FILE_RECORDS))


def currency_code(currency: Column) -> Column:
    """ISO code of a currency's sign, name or code; null stays null."""
    codes = F.create_map(*[F.lit(x) for pair in CURRENCIES.items() for x in pair])
    # An array of one, so that the text is made once and not for each name.
    return F.transform(F.array(F.upper(strip(currency))), lambda c: F.nullif(F.coalesce(codes[c], c), F.lit("")))[0]


def payment_terms(terms: Column) -> Column:
    """``Net <days>`` where terms name net days; else the text, clipped."""
    days = F.regexp_extract(F.coalesce(terms, F.lit("")), r"(?i)net\s*(\d+)|(\d+)\s*days?\s*net", 0)
    number = F.regexp_extract(days, r"(\d+)", 1)
    return F.when(number != "", F.concat(F.lit("Net "), number)).otherwise(clip(terms))


def total_or_product(total: Column, unit: Column, quantity: Column) -> Column:
    return F.coalesce(total, unit * quantity)


#: A line of a quotation that names an item, as the default rules read it: name, quantity, unit price, currency.
ITEM_LINE = r"(?im)^item(?: description)?:[ ]*([^|\n]+?)[ ]*\|[ ]*(?:quantity|qty):[ ]*([0-9.]+)[ ]*\|[ ]*unit price:[ ]*([0-9.]+)(?:[ ]*\|[ ]*currency:[ ]*([^ |\n]+))?"


def rule_items(text: Column) -> Column:
    """The array of items that a quotation's text names line by line, with the terms that it states for all of them."""
    once = lambda name: F.nullif(F.regexp_extract(text, rf"(?im)^{name}:[ ]*([^\n]+)$", 1), F.lit(""))
    delivery, terms, supplier = once("delivery time"), once("payment terms"), once("vendor name")

    def item(line: Column) -> Column:
        part = lambda i: F.nullif(F.regexp_extract(line, ITEM_LINE, i), F.lit(""))
        return F.struct(
            part(1).alias("item_name"), part(2).try_cast("double").alias("quantity"), part(3).try_cast("double").alias("unit_price"), F.lit(None).cast("double").alias("total_price"),
            part(4).alias("currency"), delivery.alias("delivery_time"), terms.alias("payment_terms"), supplier.alias("supplier_name"),
        )

    return F.transform(F.regexp_extract_all(text, F.lit(ITEM_LINE), F.lit(0)), item)
