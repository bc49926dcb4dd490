"""Content-addressed WARC archive.

An archive is two tables in one folder:

* ``payloads``: every distinct payload once, keyed by its SHA-256; the digest and the
  length are recomputed and compared whenever the archive is read.
* ``headers``: per record the exact header bytes (WARC header block and HTTP header),
  and the payload's SHA-256.

Original records are reconstructed by joining the two on the digest. Of records with
equal payloads the one with the smallest id is a ``response``, the others are
``revisit`` records that refer to it (payloads shorter than ``min_bytes`` are never
revisits).

A payload that a third of all rows share costs one partial row per task: copies merge
before the shuffle, and the joins on the digest carry narrow rows that Spark splits
by size.

Defined results: a null payload is empty, a null URL is written as ``urn:page:<id>``,
line breaks in a URL are percent-encoded. Rows that repeat an id together with its
payload are each written; all rows with the smallest id of their payload are
responses. A null id is larger than every other; if a payload has only null ids they
are all responses. Empty tables give empty archives; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HTTP_HEADER = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
WARC_DATE = "2024-01-01T00:00:00Z"
_B32HEX, _B32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload):
    """Bare upper-case base32 SHA-1: five hex digits are four base32 digits."""
    digits = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digits, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), _B32HEX, _B32)


def _uuid(*cols):
    h = F.md5(F.concat_ws("|", *cols))
    return F.concat(F.lit("<urn:uuid:"), F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-"),
                    F.substring(h, 13, 4), F.lit("-"), F.substring(h, 17, 4), F.lit("-"), F.substring(h, 21, 12), F.lit(">"))


def _line(name: str, value):
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def write_archive(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html", min_bytes: int = 0) -> None:
    """Write one record per row of ``pages`` to the archive in ``folder``."""
    payload = F.coalesce(pages[payload_col].cast("binary"), F.lit(b""))
    rows = pages.select(pages[id_col].alias("page_id"), pages[url_col].alias("url"), payload.alias("payload"))
    stored = rows.select(F.sha2("payload", 256).alias("sha256"), "payload")
    stored.groupBy("sha256").agg(F.first("payload").alias("payload")).select(
        "sha256", F.octet_length("payload").cast("bigint").alias("payload_bytes"), "payload"
    ).write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/payloads")

    index = rows.select("page_id", "url", F.sha2("payload", 256).alias("sha256"), base32_sha1(F.col("payload")).alias("sha1"),
                        F.octet_length("payload").cast("bigint").alias("n"))
    firsts = index.filter(F.col("n") >= min_bytes).groupBy("sha256").agg(F.min("page_id").alias("first_id"))
    marked = index.join(firsts, "sha256", "left")
    revisit = F.coalesce(~F.col("page_id").eqNullSafe(F.col("first_id")) & F.col("first_id").isNotNull(), F.lit(False))
    page = F.coalesce(F.col("page_id").cast("string"), F.lit("null"))
    uri = F.coalesce(F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A"), F.concat(F.lit("urn:page:"), page))
    block = F.when(revisit, F.lit(0)).otherwise(F.col("n")) + F.lit(len(HTTP_HEADER) + 2)
    header = F.concat(
        F.lit("WARC/1.1\r\n"), _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _uuid(page, F.col("sha256"))), _line("WARC-Date", F.lit(WARC_DATE)),
        _line("WARC-Target-URI", uri), _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(revisit, F.concat(
            _line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            _line("WARC-Refers-To", _uuid(F.col("first_id").cast("string"), F.col("sha256"))),
            _line("X-Refers-To-Page", F.col("first_id").cast("string")))).otherwise(""),
        _line("X-Page", page), _line("Content-Type", F.lit("application/http;msgtype=response")),
        _line("Content-Length", block.cast("string")))
    marked.select(header.cast("binary").alias("header"), F.lit(HTTP_HEADER).cast("binary").alias("http_header"), "sha256"
                  ).write.mode("overwrite").parquet(f"{folder}/headers")


def _field(name: str):
    return F.regexp_extract(F.col("header").cast("string"), rf"(?m)^{name}: ([^\r\n]*)", 1)


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """Records of the archive: fields parsed from the exact header bytes, the payload
    joined from the store, and its verified figures.

    The store's digests are recomputed on its own side of the join, so a reader that
    leaves out ``payload`` moves narrow rows only. A payload whose bytes do not match
    its key, a record without payload, or a header whose SHA-1 differs raises."""
    store = spark.read.parquet(f"{folder}/payloads")
    sound = (F.sha2("payload", 256) == F.col("sha256")) & (F.octet_length("payload") == F.col("payload_bytes"))
    checked = store.select("sha256", "payload", F.when(sound, F.col("payload_bytes")).otherwise(
        F.raise_error(F.concat(F.lit("corrupt payload "), F.col("sha256")))).alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("payload_digest"))
    heads = spark.read.parquet(f"{folder}/headers").select(
        "sha256", "header", "http_header", _field("WARC-Type").alias("record_type"),
        _field("X-Page").try_cast("bigint").alias("page_id"), _field("X-Refers-To-Page").try_cast("bigint").alias("refers_to"),
        F.substring(_field("WARC-Payload-Digest"), 6, 32).alias("header_sha1"))
    joined = heads.join(checked, "sha256", "left")
    agrees = F.col("payload_digest").eqNullSafe(F.col("header_sha1"))
    return joined.withColumn("payload_digest", F.when(agrees, F.col("payload_digest")).otherwise(
        F.raise_error(F.concat(F.lit("missing or different payload "), F.col("sha256"))))).drop("header_sha1")


def original_records(spark: SparkSession, folder: str) -> DataFrame:
    """The exact bytes of every WARC record (``record``; a revisit has no payload), rebuilt by
    joining headers and store, with page_id, record_type, refers_to, the number of bytes
    before the payload and the store's verified figures.

    Only responses need payload bytes, so revisits join narrow rows of the store, however
    many refer to one payload."""
    crlf = F.lit(b"\r\n")

    def rebuilt(rows: DataFrame, body) -> DataFrame:
        before = F.concat(F.col("header"), crlf, F.col("http_header"), crlf)
        return rows.select("page_id", "record_type", "refers_to", "payload_bytes", "payload_digest",
                           F.octet_length(before).alias("payload_at"), F.concat(before, body, crlf, crlf).alias("record"))

    found = read_archive(spark, folder)
    response = F.col("record_type") == "response"
    return rebuilt(found.where(response), F.col("payload")).unionByName(rebuilt(found.where(~response), F.lit(b"")))


def digests_of_records(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to. The figures of a
    response are taken from the bytes of its rebuilt record, those of a revisit from the
    verified payload it shares."""
    payload = F.substring(F.col("record"), F.col("payload_at") + 1, F.octet_length("record") - F.col("payload_at") - 4)
    response = F.col("record_type") == "response"
    return records.select(
        "page_id", F.when(response, F.octet_length(payload).cast("bigint")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(response, base32_sha1(payload)).otherwise(F.col("payload_digest")).alias("payload_digest"), "record_type", "refers_to")
