"""A content-addressed web archive: payload bytes once, record headers apart, records rebuilt by joins.

Two tables make an archive. `payloads` holds the bytes of each distinct payload under its SHA-256; `records` holds each
record's exact header block and the SHA-256 of its payload. Of records with equal payloads the one with the smallest
page_id is the response; the others are revisits that name it. Bytes are stored under a digest only after length and
SHA-1 of all its rows agree, and are hashed again when read.

A response's header block ends with the HTTP status line and headers that the record's content begins with. Line breaks
in an address are written as %0A, so such an address isn't rebuilt to the byte; payloads are.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm.tables import RELEASE, shared_folder

#: Payloads shorter than this are never revisited.
LEAST_BYTES = 0
RECORD_URN = "urn:page:"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n"
#: The date of records whose pages have no fetch time.
NO_DATE = "1970-01-01T00:00:00Z"


@dataclass(frozen=True)
class Archive:
    records: str
    payloads: str


def base32_of_hex(digest: Column) -> Column:
    """RFC 4648 base32 of a hexadecimal SHA-1: 5 hexadecimal digits are 4 characters, without padding."""
    alphabet = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")

    def four(k: Column) -> Column:
        bits = F.conv(F.substr(digest, k * 5 + 1, F.lit(5)), 16, 10).cast("int")
        return F.concat(*[F.substr(alphabet, F.shiftright(bits, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)])

    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), four), "")


def checked(holds: Column, value: Column, complaint: str) -> Column:
    return F.when(holds, value).otherwise(F.raise_error(F.lit(complaint)))


def header_block(page: Column, url: Column, date: Column, size: Column, sha1: Column, first: Column) -> Column:
    """The record's header lines, the empty line after them and, for a response, its HTTP headers. `first` is null for a
    response."""
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    common = F.concat(
        F.lit(f"WARC/1.1{END}WARC-Type: "), F.when(first.isNull(), "response").otherwise("revisit"),
        F.lit(f"{END}WARC-Record-ID: <{RECORD_URN}"), text(page), F.lit(f">{END}WARC-Date: "), date,
        # a line break in an address would begin another header line
        F.lit(f"{END}WARC-Target-URI: "), F.regexp_replace(text(url), r"[\r\n]", "%0A"),
        F.lit(f"{END}WARC-Payload-Digest: sha1:"), base32_of_hex(sha1),
    )
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "), size.cast("string"), F.lit(END + END)
    )
    response = F.concat(
        F.lit(f"{END}Content-Type: application/http;msgtype=response{END}Content-Length: "),
        (F.octet_length(http) + size).cast("string"), F.lit(END + END), http,
    )
    revisit = F.concat(
        F.lit(f"{END}WARC-Refers-To: <{RECORD_URN}"), text(first),
        F.lit(f">{END}WARC-Profile: {REVISIT_PROFILE}{END}Content-Length: 0{END}{END}"),
    )
    return F.concat(common, F.when(first.isNull(), response).otherwise(revisit))


def dated(column: str | None) -> Column:
    """A timestamp column as a record's date, in UTC."""
    if column is None:
        return F.lit(NO_DATE)
    utc = F.to_utc_timestamp(F.col(column).cast("timestamp"), F.current_timezone())
    return F.coalesce(F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit(NO_DATE))


def write_archive(pages: DataFrame, least_bytes: int = LEAST_BYTES, fetched: str | None = None) -> Archive:
    """Writes both tables to the shared folder. A null html is an empty payload.

    `fetched` names a column of fetch times; records without one are dated NO_DATE.
    """
    spark = pages.sparkSession
    root = f"{shared_folder(spark)}/archive-{uuid.uuid4().hex}"
    out = Archive(f"{root}/records", f"{root}/payloads")
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), dated(fetched).alias("date"), payload.alias("payload")
    )
    rows = rows.withColumns({"sha256": F.sha2("payload", 256), "size": F.octet_length("payload").cast("bigint")})
    # Payload bytes meet once per digest and task before they are shuffled.
    sha1 = F.sha1("payload")
    stored = rows.groupBy("sha256").agg(
        F.first("payload").alias("payload"), F.min("size").alias("size"), F.max("size").alias("most"),
        F.min(sha1).alias("sha1"), F.max(sha1).alias("other"),
    )
    agree = (F.col("size") == F.col("most")) & (F.col("sha1") == F.col("other"))
    stored = stored.select("sha256", checked(agree, F.col("payload"), "payloads differ under one SHA-256").alias("payload"))

    light = rows.select("page_id", "url", "date", "sha256", "size", sha1.alias("sha1"))
    firsts = light.where(F.col("size") >= least_bytes).groupBy(F.col("sha256").alias("_digest")).agg(F.min("page_id").alias("first"))
    named = light.join(firsts, F.col("sha256") == F.col("_digest"), "left")
    first = F.when(F.col("first") != F.coalesce("page_id", F.col("first") + 1), F.col("first"))
    header = header_block(F.col("page_id"), F.col("url"), F.col("date"), F.col("size"), F.col("sha1"), first)
    records = named.select(header.alias("header"), "sha256")
    before = spark.conf.get(RELEASE, "false")
    spark.conf.set(RELEASE, "true")
    try:
        stored.write.parquet(out.payloads)
        records.write.parquet(out.records)
    finally:
        spark.conf.set(RELEASE, before)
    return out


def read_records(spark: SparkSession, archive: Archive) -> DataFrame:
    """Every record: header, payload (in full for revisits, too), payload_bytes, payload_digest (from the bytes read)."""
    payloads = spark.read.schema("sha256 string, payload binary").parquet(archive.payloads)
    same = F.sha2("payload", 256) == F.col("sha256")
    payloads = payloads.select(
        F.col("sha256").alias("_digest"),
        "payload",
        checked(same, F.octet_length("payload").cast("bigint"), "a stored payload doesn't match its digest").alias("payload_bytes"),
        base32_of_hex(F.sha1("payload")).alias("payload_digest"),
    )
    records = spark.read.schema("header string, sha256 string").parquet(archive.records)
    return records.join(payloads, F.col("sha256") == F.col("_digest")).drop("_digest", "sha256")


def field(name: str) -> Column:
    """A header field's value, null where the record has no such field."""
    found = F.regexp_extract("header", rf"\r\n{name}: ([^\r]*)\r\n", 1)
    return F.when(F.col("header").contains(f"{END}{name}: "), found)


def page_of(urn: Column) -> Column:
    return F.regexp_extract(urn, rf"^<{RECORD_URN}(-?\d*)>$", 1)


def captures(spark: SparkSession, archive: Archive) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, as the archive says; digests must agree."""
    records = read_records(spark, archive)
    same = field("WARC-Payload-Digest") == F.concat(F.lit("sha1:"), F.col("payload_digest"))
    http = F.octet_length("header") - F.octet_length(F.substring_index("header", END + END, 1)) - 4
    whole = (field("WARC-Type") == "revisit") | (field("Content-Length") == (F.col("payload_bytes") + http).cast("string"))
    return records.select(
        F.nullif(page_of(field("WARC-Record-ID")), F.lit("")).cast("bigint").alias("page_id"),
        "payload_bytes",
        checked(same & whole, F.col("payload_digest"), "a record's header doesn't match its payload").alias("payload_digest"),
        field("WARC-Type").alias("record_type"),
        page_of(field("WARC-Refers-To")).cast("bigint").alias("refers_to"),
    )


def warc_records(spark: SparkSession, archive: Archive) -> DataFrame:
    """The original records as bytes: header block with any HTTP headers, payload (none for revisits), two line ends."""
    body = F.when(field("WARC-Type") == "response", F.col("payload")).otherwise(F.lit(b""))
    return read_records(spark, archive).select(
        F.concat(F.col("header").cast("binary"), body, F.lit((END + END).encode())).alias("record")
    )


def archived_pages(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Writes an archive of the pages and reads it back.

    A null html is an empty payload. A null page_id is written without a number and read back as null; it is never the
    record referred to while its group has a numbered page, and several such rows alone are all responses. Rows that
    repeat the smallest page_id of a group are all responses. An empty table is an empty archive.
    """
    return captures(pages.sparkSession, write_archive(pages, least_bytes))
