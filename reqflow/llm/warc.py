"""WARC archives: written from pages by Spark, read back, transactions put together.

Each page becomes one capture of three records: a ``request``, a ``response``
(or a ``revisit`` of an equal payload archived elsewhere) and a ``metadata``
record.  The first and the last name the capture in ``WARC-Concurrent-To``.
Spark's text writer makes the files (a record ends in the separator CRLF CRLF), so
any store that Spark writes to will do; files hold a bounded number of captures, fewer of
large ones, so that reading a file as a whole is bounded too.  Which payloads repeat is found
from digests; payloads aren't shuffled unless very many different ones repeat.

Reading takes each file as bytes, cuts it into records by their lengths, and
joins requests and metadata to captures by the concurrent-to identifiers - never
by place, so the three may lie in different files - and revisits to the captures
they refer to.  One nested row comes out per capture.

Defined results: a null payload is an empty one; a null address leaves out the
target header, blanks and control characters in one are percent-encoded; a null
page_id is written as none; of rows with one page_id, each is a capture of its
own, and among equal payloads with the same largest page_id the first read is the
response; an empty table gives empty archives and an empty table; extra columns
are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reqflow.llm.common import attach_groups, keyed, saved, shared_path

CRLF = "\r\n"
END = CRLF + CRLF
MIN_REVISIT_BYTES = 1000
#: Payload sizes (from, below) and the most captures of such size in one file.
FILES = ((0, 1 << 16, 1000), (1 << 16, 1 << 22, 16), (1 << 22, 1 << 62, 1))
#: Repeated payloads are broadcast (some 100 bytes each) up to so many, joined by shuffle beyond.
MAX_BROADCAST_ROWS = 1_000_000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _uuid(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("/", *parts))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in cuts]), F.lit(">"))


def _record(kind: Column | str, record_id: Column, block: Column, *headers: Column) -> Column:
    """A record without its closing separator; a null header is left out."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    head = F.concat_ws(
        CRLF,
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), kind),
        F.concat(F.lit("WARC-Record-ID: "), record_id),
        F.lit(f"WARC-Date: {DATE}"),
        *headers,
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    )
    return F.concat(head, F.lit(END), block)


def mark_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """rk, page_id, url, html, n_bytes, sha1, refers_rk: the row whose payload this one repeats, or null."""
    rows = keyed(
        pages, lambda c: c("page_id").cast("string").alias("page"), lambda c: c("page_id").alias("page_id"), lambda c: c("url").cast("string").alias("url"),
        lambda c: F.coalesce(c("html").cast("string"), F.lit("")).alias("html"),
    )
    n_bytes = F.octet_length("html").cast("long")
    # Equal payloads are told by length and SHA-256; the archive's own digest is SHA-1.
    same = F.when(n_bytes >= min_bytes, F.concat(F.sha2("html", 256), F.lit("-"), n_bytes.cast("string")))
    rows = rows.withColumns({"n_bytes": n_bytes, "same": same})
    best = F.max(F.struct("page_id", (-F.col("rk")).alias("neg"))).alias("best")
    groups = rows.filter(F.col("n_bytes") >= min_bytes).groupBy("same").agg(F.count("*").alias("n"), best).filter("n > 1")
    groups = saved(groups.select("same", "n", (-F.col("best.neg")).alias("first_rk"), F.col("best.page_id").cast("string").alias("first_page")))
    few = groups.limit(MAX_BROADCAST_ROWS + 1).count() <= MAX_BROADCAST_ROWS
    out = rows.join(F.broadcast(groups), "same", "left") if few else attach_groups(rows, groups, "same", "n")
    other = F.col("first_rk").isNotNull() & (F.col("first_rk") != F.col("rk"))
    sha1 = F.sha1(F.col("html").cast("binary")).alias("sha1")
    return out.select("rk", "page", "url", "html", "n_bytes", sha1, F.when(other, F.col("first_rk")).alias("refers_rk"), F.when(other, F.col("first_page")).alias("refers_page"))


def write_archives(pages: DataFrame, path: str, min_bytes: int = MIN_REVISIT_BYTES) -> None:
    """Write page_id, url, html as gzipped WARC files below ``path``."""
    rows = mark_revisits(pages, min_bytes)
    hexed = F.expr(r"regexp_replace(regexp_replace(url, '[\\x00-\\x1F]', '%1F'), ' ', '%20')")
    target = F.concat(F.lit("WARC-Target-URI: "), hexed)
    capture = _uuid(F.lit("capture"), F.col("rk").cast("string"), F.coalesce("page", F.lit("")))
    # The identifier of the capture that this one repeats, made the same way from that row's keys.
    first = _uuid(F.lit("capture"), F.col("refers_rk").cast("string"), F.coalesce("refers_page", F.lit("")))
    revisit = F.col("refers_rk").isNotNull()
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("n_bytes").cast("string"), F.lit(END))
    concurrent = F.concat(F.lit("WARC-Concurrent-To: "), capture)
    host = F.coalesce(F.regexp_extract(hexed, r"^[a-zA-Z]+://([^/?#]*)", 1), F.lit(""))
    get = F.concat(F.lit("GET "), F.coalesce(hexed, F.lit("/")), F.lit(f" HTTP/1.1{CRLF}Host: "), host, F.lit(END))
    fields = F.concat_ws(CRLF, F.lit("fetchTimeMs: 0"), F.concat(F.lit("pageId: "), F.col("page")))
    records = [
        _record("request", _uuid(F.lit("request"), F.col("rk").cast("string")), get, target, concurrent, F.lit("Content-Type: application/http;msgtype=request")),
        _record(
            F.when(revisit, "revisit").otherwise("response"),
            capture,
            F.when(revisit, http).otherwise(F.concat(http, F.col("html"))),
            target,
            F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("sha1")),
            F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), first)),
            F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
            F.lit("Content-Type: application/http;msgtype=response"),
        ),
        _record("metadata", _uuid(F.lit("metadata"), F.col("rk").cast("string")), fields, target, concurrent, F.lit("Content-Type: application/warc-fields")),
    ]
    value = F.concat(records[0], F.lit(END), records[1], F.lit(END), records[2]).alias("value")
    largest = pages.agg(F.max(F.octet_length(F.col("html").cast("string")))).first()[0] or 0
    for low, high, most in FILES:
        if low <= largest:
            part = rows.filter((F.col("n_bytes") >= low) & (F.col("n_bytes") < high)).select(value)
            part.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", most).mode("append").text(path)


RECORDS = (
    "record_id string, type string, target string, date string, concurrent_to string, refers_to string, "
    "digest string, payload_bytes long, head string, payload binary"
)


def split_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of an uncompressed archive."""
    at = 0
    while at < len(content):
        end = content.index(b"\r\n\r\n", at)
        lines = content[at:end].decode("utf-8", "replace").split(CRLF)
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        n = int(headers["content-length"])
        yield headers, content[end + 4 : end + 4 + n]
        at = end + 4 + n + 4


def parse_record(headers: dict[str, str], block: bytes, with_payload: bool) -> tuple:
    kind = headers["warc-type"]
    head, payload = block, b""
    if headers.get("content-type", "").startswith("application/http"):
        head, _, payload = block.partition(b"\r\n\r\n")
    digest, size = headers.get("warc-payload-digest", "").rpartition(":")[2] or None, len(payload)
    if kind == "response":
        found = hashlib.sha1(payload).hexdigest()
        if digest not in (None, found):
            raise ValueError(f"{headers['warc-record-id']}: the payload doesn't have the digest {digest}")
        digest = found
    elif kind == "revisit":  # the headers tell the size of the payload that isn't stored again
        size = next((int(x.partition(b":")[2]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:")), 0)
    get = headers.get
    return (
        get("warc-record-id"), kind, get("warc-target-uri"), get("warc-date"), get("warc-concurrent-to"), get("warc-refers-to"),
        digest, size, head.decode("utf-8", "replace"), payload if with_payload and kind == "response" else None,
    )


def read_records(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """One row per record of the archives below ``path``."""
    import gzip

    names = [x.split()[0] for x in RECORDS.split(", ")]
    kinds = [pa.int64() if " long" in x else pa.binary() if " binary" in x else pa.string() for x in RECORDS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                content = b.column(0)[i].as_py()
                if content[:2] == b"\x1f\x8b":
                    content = gzip.decompress(content)
                rows = [parse_record(h, block, with_payload) for h, block in split_records(content)]
                cols = list(zip(*rows, strict=True)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=names)

    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content").mapInArrow(run, RECORDS)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: its response or revisit, its request and its metadata (null if missing)."""
    capture = records.filter(F.col("type").isin("response", "revisit"))

    def partner(kind: str) -> DataFrame:
        part = F.struct("record_id", "head").alias(kind)
        return records.filter(F.col("type") == kind).groupBy("concurrent_to").agg(F.min_by(part, "record_id").alias(kind)).withColumnRenamed("concurrent_to", "record_id")

    # What revisits refer to may be one capture for a third of all rows.
    wanted = capture.filter("type = 'revisit'").groupBy(F.col("refers_to").alias("refers_to")).agg(F.count("*").alias("n_revisits"))
    page = F.nullif(F.regexp_extract(F.col("metadata.head"), r"(?m)^pageId: (\S+)", 1), F.lit(""))
    joined = capture.join(partner("request"), "record_id", "left").join(partner("metadata"), "record_id", "left").withColumn("page_id", page)
    joined = saved(joined)
    target = joined.filter("type = 'response'").select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("original_page_id"))
    found = attach_groups(joined, wanted.join(target, "refers_to"), "refers_to", "n_revisits")
    return found.select(
        "page_id",
        F.struct("record_id", "type", "target", "date", "digest", "payload_bytes", "head", "payload").alias("response"),
        "request",
        "metadata",
        F.struct("refers_to", "original_page_id").alias("revisit_of"),
    )


def op6_warc_transactions(spark, sf_dir):
    from reqflow.llm.common import read_table

    path = shared_path(spark, "warc")
    write_archives(read_table(spark, sf_dir, "pages"), path)
    captures = assemble(saved(read_records(spark, path)))
    return captures.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.digest").alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        F.col("revisit_of.original_page_id").cast("long").alias("refers_to"),
    )


OP6_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
q AS (
  SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes, sha1(payload) AS payload_digest,
         max(page_id) OVER (PARTITION BY payload) AS last_id
  FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last_id THEN last_id END AS refers_to
FROM q
"""
