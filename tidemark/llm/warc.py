"""WARC archives: writing, reading, and resolving records of equal payloads.

Archives are written by Spark's text writer with the records' own terminator as line
separator, so they go through the file system and commit protocol of any Spark
output: a lost executor's files are never seen. They are gzip files of one member.
A file holds a bounded number of records; readers take a whole file as one value.

Resolution works on headers. They are counted by payload digest (with partial sums),
the record with the smallest id of each digest is the original response, and the
others are joined to it. Payloads meet only the list of revisits, by record id.
"""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.storage import materialise, scratch_path

# Payload bytes below which a record is always stored whole.
SMALLEST_REVISIT = 100
# Payload bytes aimed at per archive; a single record may be larger.
ARCHIVE_BYTES = 8 << 20
_END = "\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_FIELDS = (
    "record_id string, record_type string, target_uri string, page_id string, payload_digest string, "
    "payload_bytes bigint, refers_to_record string, refers_to string, payload string"
)


def as_responses(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One response record per row; a NULL payload is empty, NULL ids and addresses get no header."""
    payload = F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit(""))
    return pages.select(
        F.concat(F.lit("urn:uuid:"), F.uuid()).alias("record_id"), F.lit("response").alias("record_type"),
        F.col(f"`{url_col}`").cast("string").alias("target_uri"),
        F.col(f"`{id_col}`").cast("string").alias("page_id"),
        F.sha2(payload.cast("binary"), 256).alias("payload_digest"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.lit(None).cast("string").alias("refers_to_record"), F.lit(None).cast("string").alias("refers_to"),
        payload.alias("payload"),
    )


def write_archives(records: DataFrame, path: str, date: str, average_bytes: float = 4096) -> None:
    """Writes records (:data:`_FIELDS`) with headers made anew; revisits carry no payload.

    ``payload_bytes`` and the digest of a revisit stay those of the full payload.
    """
    revisit = F.col("record_type") == "revisit"
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))

    def line(name: str, value: Column) -> Column:
        # Line breaks would end the header; a NULL value leaves the whole line out.
        clean = F.regexp_replace(value.cast("string"), "[\\r\\n]+", " ")
        return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit("\r\n")), F.lit(""))

    header = F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", F.concat(F.lit("<"), F.col("record_id"), F.lit(">"))),
        line("WARC-Date", F.lit(date)), line("WARC-Target-URI", F.col("target_uri")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        line("WARC-Profile", F.when(revisit, F.lit(_PROFILE))),
        line("WARC-Refers-To", F.concat(F.lit("<"), F.col("refers_to_record"), F.lit(">"))),
        line("X-Page-ID", F.col("page_id")), line("X-Refers-To-Page-ID", F.col("refers_to")),
        line("X-Payload-Length", F.col("payload_bytes")), line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.octet_length(body)),
    )
    (
        records.select(F.concat(header, F.lit("\r\n"), body).alias("value"))
        .write.option("lineSep", _END).option("compression", "gzip")
        .option("maxRecordsPerFile", max(1, int(ARCHIVE_BYTES / max(1.0, average_bytes))))
        .text(path)
    )


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of all archives in a folder, found by their lengths, so that payloads may hold anything.

    A response whose payload does not have its digest, or a broken record, raises.
    """
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
        .select("content").mapInArrow(_parser(payloads), _FIELDS)
    )


def resolve(records: DataFrame, id_type: str = "string", smallest: int = SMALLEST_REVISIT) -> DataFrame:
    """The records that have to become revisits: ``record_id, refers_to_record, refers_to``.

    Of responses with equal payloads of at least ``smallest`` bytes, the one with the
    smallest id (as ``id_type``; NULL first, then by record id) stays; the others and
    earlier revisits of the digest refer to it. Revisits whose response is not among
    the records are left as they are.
    """
    headers = records.filter(F.col("payload_bytes") >= smallest).select(
        "record_id", "record_type", "payload_digest", "payload_bytes",
        F.struct(F.col("page_id").cast(id_type).alias("id"), "record_id", "page_id").alias("place"),
    )
    responses = F.when(F.col("record_type") == "response", F.col("place"))
    originals = (
        headers.groupBy("payload_digest", "payload_bytes")
        .agg(F.min(responses).alias("original"), F.count("*").alias("n"))
        .filter("n > 1 AND original IS NOT NULL")
        .drop("n")
    )
    return (
        headers.join(originals, ["payload_digest", "payload_bytes"])
        .filter(F.col("record_id") != F.col("original.record_id"))
        .select(
            "record_id", F.col("original.record_id").alias("refers_to_record"),
            F.col("original.page_id").alias("refers_to"),
        )
    )


def deduplicate(
    spark: SparkSession, source: str, target: str, date: str, id_type: str = "string",
    smallest: int = SMALLEST_REVISIT, average_bytes: float = 4096,
) -> None:
    """Reads the archives of one folder and writes them to another, copies as revisits."""
    revisits = materialise(resolve(read_archives(spark, source, payloads=False), id_type, smallest), "warc-revisits")
    revisits = revisits.select(
        "record_id", F.col("refers_to_record").alias("__record"), F.col("refers_to").alias("__page")
    )
    joined = read_archives(spark, source).join(revisits.hint("merge"), "record_id", "left")
    write_archives(
        joined.withColumns({
            "record_type": F.when(F.col("__record").isNotNull(), "revisit").otherwise(F.col("record_type")),
            "refers_to_record": F.coalesce("__record", "refers_to_record"),
            "refers_to": F.when(F.col("__record").isNotNull(), F.col("__page")).otherwise(F.col("refers_to")),
        }),
        target, date, average_bytes,
    )


def archived(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Writes ``pages`` as archives, deduplicates them and reads the result's headers back.

    Repeated rows are records of their own: one is the response, the others revisit it.
    """
    spark = pages.sparkSession
    id_type = dict(pages.dtypes)[id_col]
    first, second = scratch_path(spark, "warc-first"), scratch_path(spark, "warc-final")
    records = as_responses(pages, id_col, url_col, html_col)
    row = records.agg(F.avg("payload_bytes"), F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")).first()
    average = row[0] or 1.0
    write_archives(records, first, row[1], average)
    deduplicate(spark, first, second, row[1], id_type, average_bytes=average)
    return read_archives(spark, second, payloads=False).select(
        F.col("page_id").cast(id_type).alias(id_col), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(id_type).alias("refers_to"),
    )


def _parser(payloads: bool):
    columns = [f.split(" ")[0] for f in _FIELDS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows = list(_records(gzip.decompress(content.as_py()), payloads))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r[i] for r in rows], pa.int64() if c == "payload_bytes" else pa.string())
                        for i, c in enumerate(columns)
                    ],
                    names=columns,
                )

    return run


def _records(data: bytes, payloads: bool) -> Iterator[tuple]:
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:end].decode("utf-8").split("\r\n")
        fields = dict(x.split(": ", 1) for x in lines)
        length = int(fields["Content-Length"])
        body = data[end + 4 : end + 4 + length]
        at = end + 4 + length + len(_END)
        digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
        if first != "WARC/1.1" or len(body) != length or data[at - len(_END) : at] != _END.encode():
            raise ValueError("broken WARC record")
        if fields["WARC-Type"] == "response" and hashlib.sha256(body).hexdigest() != digest:
            raise ValueError(f"payload of {fields['WARC-Record-ID']} does not have its digest")
        refers = fields.get("WARC-Refers-To")
        yield (
            fields["WARC-Record-ID"][1:-1], fields["WARC-Type"], fields.get("WARC-Target-URI"),
            fields.get("X-Page-ID"), digest, int(fields["X-Payload-Length"]), refers[1:-1] if refers else None,
            fields.get("X-Refers-To-Page-ID"), body.decode("utf-8") if payloads else None,
        )


ORACLE = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
    sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS original FROM p
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> original THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> original THEN original END AS refers_to
FROM f
"""
