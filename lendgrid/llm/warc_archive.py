"""A content-addressed archive of web records: payloads stored once, record headers exactly, records rebuilt by joins."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lendgrid.llm.frames import written

_DATE = "1970-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1, 32 letters: each 5 hex digits are 4 digits to the base 32."""
    digest = F.sha1(payload)
    digits = F.concat(*[F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)])
    return F.translate(digits, "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _name(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def _lines(*fields: Column) -> Column:
    """Header lines with their line ends; a field that is null is left out."""
    return F.concat(F.concat_ws("\r\n", *fields), F.lit("\r\n\r\n"))


def write_archive(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0) -> None:
    """Write one WARC record per row of ``pages`` below ``path``: ``payloads`` by SHA-256 and ``headers`` by record.

    The payload is the text in UTF-8; a missing one is empty. Of the records with equal payloads of at least ``min_bytes``
    bytes, the one with the smallest id is a response and the others are revisits of it; shorter payloads are always
    responses. Rows that repeat the smallest id are responses too; rows without an id revisit one that has an id.
    Other columns are ignored. Line breaks in a URL are percent-encoded, a missing URL has no header line.

    Only keys and sizes are grouped, so texts stay where they are; just the payloads that occur more than once are
    brought together, one per task and digest.
    """
    body = F.encode(F.coalesce(F.col(f"`{html}`"), F.lit("")), "UTF-8")
    rows = pages.select(F.col(f"`{page_id}`").cast("long").alias("page_id"), F.col(f"`{url}`").alias("url"), body.alias("payload"))
    rows = rows.withColumn("address", F.unhex(F.sha2("payload", 256)))
    groups = rows.groupBy("address").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("address", "first", F.lit(True).alias("many"))
    groups = written(groups, "warc-groups")
    joined = rows.join(groups, "address", "left").withColumn("many", F.coalesce("many", F.lit(False)))
    size = F.octet_length("payload")
    revisit = F.col("many") & F.col("first").isNotNull() & (F.coalesce(F.col("page_id") != F.col("first"), F.lit(True))) & (size >= min_bytes)
    digest = F.concat(F.lit("sha1:"), base32_sha1(F.col("payload")))
    web = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: "), size.cast("string"), F.lit("\r\n\r\n"))
    target = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    block = F.length(web) + F.when(revisit, 0).otherwise(size)
    head = _lines(
        F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), _name(F.col("page_id"))), F.concat(F.lit("WARC-Target-URI: "), target),
        F.lit(f"WARC-Date: {_DATE}"), F.concat(F.lit("WARC-Payload-Digest: "), digest),
        F.when(revisit, F.lit(f"WARC-Profile: {_PROFILE}")), F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), _name(F.col("first")))),
        F.lit("Content-Type: application/http; msgtype=response"), F.concat(F.lit("Content-Length: "), block.cast("string")),
    )
    headers = joined.select("address", size.cast("long").alias("payload_bytes"), F.encode(F.concat(head, web), "UTF-8").alias("header"))
    headers.write.option("compression", "zstd").parquet(f"{path}/headers")
    single = joined.filter(~F.col("many")).select("address", "payload")
    shared = joined.filter("many").groupBy("address").agg(F.first("payload").alias("payload"))
    for part in (single, shared):
        part.write.option("compression", "zstd").mode("append").parquet(f"{path}/payloads")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The records below ``path``, rebuilt: ``page_id url record_type refers_to payload_bytes payload_digest payload record``.

    ``record`` has the exact bytes of the WARC record without the two line ends that close it; a revisit's has no payload, but
    ``payload`` is there. Every payload is checked against its address; a damaged or missing one ends the job.
    """
    headers = spark.read.parquet(f"{path}/headers")
    payloads = spark.read.parquet(f"{path}/payloads")
    sound = F.when(F.unhex(F.sha2("payload", 256)) == F.col("address"), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("payload does not match its address "), F.hex("address"))).cast("binary"))
    joined = headers.join(payloads, "address", "left").withColumn("payload", sound)
    head = F.col("header").cast("string")
    field = lambda name: F.nullif(F.regexp_extract(head, rf"\r\n{name}: ([^\r]*)", 1), F.lit(""))
    number = lambda name: F.nullif(F.regexp_extract(head, rf"\r\n{name}: <urn:page:([^>]*)>", 1), F.lit("none")).try_cast("long")
    kind = field("WARC-Type")
    return joined.select(
        number("WARC-Record-ID").alias("page_id"), field("WARC-Target-URI").alias("url"), kind.alias("record_type"),
        F.when(kind == "revisit", number("WARC-Refers-To")).alias("refers_to"),
        F.octet_length("payload").cast("long").alias("payload_bytes"), base32_sha1(F.col("payload")).alias("payload_digest"), "payload",
        F.when(kind == "revisit", F.col("header")).otherwise(F.concat(F.col("header"), F.col("payload"))).alias("record"),
    )


def export_warc(spark: SparkSession, path: str, out: str, records_per_file: int = 10_000) -> None:
    """Write the archive as plain WARC files: Spark's text sink closes each record with two line ends, as the format asks."""
    record = read_archive(spark, path).select(F.col("record").cast("string"))
    record.write.option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", records_per_file).text(out)


def read_warc_files(spark: SparkSession, path: str) -> DataFrame:
    """``header`` and ``block`` (bytes) of each record in plain WARC files; a file is read by one task."""

    def parse(batches):
        for batch in batches:
            for content in batch.column(0).to_pylist():
                head, block, at = [], [], 0
                while at < len(content):
                    end = content.index(b"\r\n\r\n", at) + 4
                    header = content[at:end]
                    size = int(header.split(b"\r\nContent-Length: ")[1].split(b"\r\n")[0])
                    head.append(header)
                    block.append(content[end:end + size])
                    at = end + size + 4
                yield pa.RecordBatch.from_arrays([pa.array(head, pa.binary()), pa.array(block, pa.binary())], names=["header", "block"])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(parse, "header binary, block binary")
