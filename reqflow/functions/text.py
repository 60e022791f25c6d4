"""Names, paths, text caps and messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Kinds by extension, and how many characters of each kind are used.
KINDS = {
    "pdf": ("pdf",),
    "doc": ("docx", "doc"),
    "sheet": ("xlsx", "xls"),
    "csv": ("csv",),
    "text": ("txt", "html", "htm"),
    "image": ("png", "jpg", "jpeg", "tiff", "tif", "bmp"),
}
CAPS = {"pdf": 15000, "doc": 15000, "sheet": 15000, "csv": 10000, "text": 10000}
CLASSIFY_CAP, EXTRACT_CAP = 8000, 12000

#: What marks an error as worth another try.
TRANSIENT_STATES = ("08S01", "08001", "HYT00", "HYT01", "40001", "40613")
TRANSIENT_WORDS = ("communication link failure", "tcp provider", "connection timeout", "connection reset", "timed out", "broken pipe", "10060", "10054")


def safe_req(req_no: Column) -> Column:
    """A requisition number as a folder name."""
    return F.regexp_replace(req_no, r"[/\\]", "_")


def safe_name(path: Column, attachment_id: Column) -> Column:
    """The last part of a path; ``<id>.bin`` where there is none."""
    base = F.regexp_extract(F.coalesce(path, F.lit("")), r"([^/]+)/*$", 1)
    return F.when(base == "", F.concat(attachment_id.cast("string"), F.lit(".bin"))).otherwise(base)


def blob_path(req_no: Column, attachment_id: Column, path: Column) -> Column:
    return F.concat_ws("/", F.lit("procurement"), safe_req(req_no), attachment_id.cast("string"), safe_name(path, attachment_id))


def extension(path: Column) -> Column:
    """Lower-case extension of a path's last part; a leading dot starts none."""
    return F.lower(F.regexp_extract(F.coalesce(path, F.lit("")), r"[^/]\.([^./]+)$", 1))


def file_kind(path: Column) -> Column:
    ext, kind = extension(path), F.lit("unsupported")
    for name, exts in KINDS.items():
        kind = F.when(ext.isin(*exts), name).otherwise(kind)
    return kind


def text_cap(text: Column, kind: Column, whole: bool = False) -> Column:
    """The part of a text that is used, by the file's kind, or the ``whole`` of it; nothing of other kinds."""
    if whole:
        return F.when(kind.isin(*CAPS), F.coalesce(text, F.lit(""))).otherwise("")
    n = F.lit(0)
    for name, cap in CAPS.items():
        n = F.when(kind == name, cap).otherwise(n)
    return F.substring(F.coalesce(text, F.lit("")), F.lit(1), n)


def strip(text: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(F.regexp_replace(text, r"^\s+", ""), r"\s+$", "")


def clip(text: Column, n: int = 200) -> Column:
    return F.substring(F.coalesce(text.cast("string"), F.lit("")), 1, n)


def error_clip(message: Column, n: int = 500) -> Column:
    return F.substring(F.regexp_replace(message, "\n", " "), 1, n)


def is_transient(message: Column) -> Column:
    """Whether an error message names a passing fault; null is none."""
    message = F.coalesce(message, F.lit(""))
    words = "|".join(w.replace(" ", r"\s") for w in TRANSIENT_WORDS)
    return message.rlike("|".join(TRANSIENT_STATES)) | F.lower(message).rlike(words)


def says_transient(message: str) -> bool:
    """:func:`is_transient` of a message at hand."""
    return any(s in message for s in TRANSIENT_STATES) or any(w in message.lower() for w in TRANSIENT_WORDS)


def default_currency(currency: Column) -> Column:
    return F.coalesce(F.nullif(currency, F.lit("")), F.lit("USD"))


def is_trivial_image(width: Column, height: Column, bright: Column) -> Column:
    """Too small, too narrow or nearly blank; true where anything is unknown."""
    most, least = F.greatest(width, height), F.least(width, height)
    bad = (most < 200) | (least < 100) | (most / F.greatest(least, F.lit(1)) > 5) | (bright > 0.97)
    known = width.isNotNull() & height.isNotNull() & bright.isNotNull()
    return F.when(known, bad).otherwise(True)


def needs_ocr(text: Column, pages: Column) -> Column:
    return (F.length(strip(F.coalesce(text, F.lit("")))) < 50) & (pages > 0)
