"""Web archives whose repeated payloads are stored once and revisited by header."""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quitanda.llm.tables import BROADCAST_ROWS, small_batches, stored, with_key_values
from quitanda.session import new_location

# An archive ends with the record that reaches this many bytes, before compression.
ARCHIVE_BYTES = 32_000_000
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"


def payload_digest(payload: Column) -> Column:
    """SHA-1 in base 32: 40 bits, or 10 hex digits, are 8 base-32 digits."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def captured(pages: DataFrame, key: str = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """(page_id, url, payload, payload_bytes, payload_digest) of every page; a NULL body is empty."""
    payload = F.coalesce(F.col(body), F.lit(""))
    return pages.select(
        F.col(key).cast("bigint").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).cast("bigint").alias("payload_bytes"),
        payload_digest(payload).alias("payload_digest"),
    )


def originals(headers: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Per digest that several records of at least ``least_bytes`` have: ``copies`` and ``original``,
    the largest page_id. Only headers are shuffled, one per digest and map task."""
    counted = (
        headers.where(F.col("payload_bytes") >= least_bytes)
        .groupBy("payload_digest")
        .agg(F.count("*").alias("copies"), F.max("page_id").alias("original"))
    )
    return stored(counted.where("copies > 1"), "originals")


def resolved(records: DataFrame, first: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Adds record_type and refers_to: records whose payload another page keeps are revisits.

    Records that share the largest page_id and the payload all stay responses, as do records
    whose copies have no page_id at all; a record without page_id revisits one that has it.
    """
    joined = with_key_values(records, first, "payload_digest", "copies", ["original"], broadcast_rows)
    older = F.coalesce(F.col("page_id") < F.col("original"), F.col("original").isNotNull())
    return joined.withColumns(
        {
            "record_type": F.when(older, F.lit("revisit")).otherwise(F.lit("response")),
            "refers_to": F.when(older, F.col("original")),
        }
    ).drop("original")


def _record(date: str) -> Column:
    """A whole record but for its final END, from the columns of `resolved`."""
    lines = "\r\n"
    revisit = F.col("record_type") == "revisit"

    def urn(page: str) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(page).cast("string"), F.lit("")), F.lit(">"))

    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{lines}Content-Type: text/html; charset=utf-8{lines}Content-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit(END),
    )
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    clean_url = F.regexp_replace("url", r"[\x00-\x20\x7F]", "")  # a line feed would forge a header
    return F.concat(
        F.lit(f"WARC/1.1{lines}WARC-Type: "),
        F.col("record_type"),
        F.lit(f"{lines}WARC-Record-ID: "),
        urn("page_id"),
        F.lit(f"{lines}WARC-Date: {date}{lines}"),
        F.coalesce(F.concat(F.lit("WARC-Target-URI: "), clean_url, F.lit(lines)), F.lit("")),
        F.lit("WARC-Payload-Digest: sha1:"),
        F.col("payload_digest"),
        F.when(revisit, F.concat(F.lit(f"{lines}WARC-Profile: {PROFILE}{lines}WARC-Refers-To: "), urn("refers_to"))).otherwise(
            F.lit("")
        ),
        F.lit(f"{lines}Content-Type: application/http; msgtype=response{lines}Content-Length: "),
        F.octet_length(block).cast("string"),
        F.lit(END),
        block,
    )


def write_archives(
    records: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES
) -> None:
    """Writes gzipped archives below ``path``, each of ``archive_bytes`` or one record more.

    A task numbers its archives while its records stream through; the record's final END is the
    line separator of Spark's text writer, so any file system Spark reaches will do.
    """

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = 0
        for batch in batches:
            sizes = pc.binary_length(batch.column(0)).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = before + np.cumsum(sizes)
            archive = (ends - sizes) // archive_bytes
            before = int(ends[-1]) if len(ends) else before
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(archive)], ["record", "archive"])

    whole = small_batches(records).select(_record(date).alias("record"))
    numbered_records = whole.mapInArrow(numbered, "record string, archive bigint")
    writer = numbered_records.write.partitionBy("archive").option("lineSep", END).option("compression", "gzip")
    writer.text(path)


def parse(archive: bytes) -> Iterator[dict]:
    """The records of an uncompressed archive; a payload that does not match its digest is an error."""
    at, end = 0, len(archive)
    while at < end:
        head_end = archive.index(b"\r\n\r\n", at)
        version, *lines = archive[at:head_end].decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        header = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}
        size = int(header["content-length"])
        block = archive[head_end + 4 : head_end + 4 + size]
        at = head_end + 4 + size + 4
        payload = block[block.index(b"\r\n\r\n") + 4 :]
        digest = header["warc-payload-digest"].removeprefix("sha1:")
        row = {"type": header["warc-type"], "digest": digest, "url": header.get("warc-target-uri")}
        for name, value in (("page", header["warc-record-id"]), ("refers", header.get("warc-refers-to", ""))):
            number = value.removeprefix("<urn:page:").removesuffix(">")
            row[name] = int(number) if number else None
        if row["type"] == "response":
            if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                raise ValueError(f"damaged payload of page {row['page']}")
            row["payload"] = payload
        yield row


def read_archives(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """(page_id, url, record_type, payload_digest, payload_bytes, refers_to[, payload]) of all records.

    An archive is read as one value, which its writer's size bounds. Revisits have no payload here.
    """
    names = ["page_id", "url", "record_type", "payload_digest", "payload_bytes", "refers_to"]
    types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
    schema = "page_id bigint, url string, record_type string, payload_digest string, payload_bytes bigint, refers_to bigint"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = list(parse(zlib.decompress(content.as_py(), 31)))
                columns = [
                    [r["page"] for r in rows],
                    [r["url"] for r in rows],
                    [r["type"] for r in rows],
                    [r["digest"] for r in rows],
                    [len(r["payload"]) if "payload" in r else None for r in rows],
                    [r["refers"] for r in rows],
                ]
                arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
                if payloads:
                    arrays.append(pa.array([r.get("payload") for r in rows], pa.binary()))
                yield pa.RecordBatch.from_arrays(arrays, names + ["payload"] * payloads)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.gz")
    return small_batches(files.load(path)).select("content").mapInArrow(read, schema + ", payload binary" * payloads)


def revisited(headers: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``headers`` with the payload_bytes of every revisit, joined by digest to the response it
    refers to; NULL where that response is not among them."""
    is_response = F.col("record_type") == "response"
    per_digest = stored(
        headers.groupBy("payload_digest")
        .agg(
            F.count("*").alias("copies"),
            F.max(F.when(is_response, F.struct("page_id", "payload_bytes"))).alias("_r"),
        )
        .where("copies > 1")
        .select("payload_digest", "copies", F.col("_r.page_id").alias("_page"), F.col("_r.payload_bytes").alias("_bytes")),
        "responses",
    )
    joined = with_key_values(headers, per_digest, "payload_digest", "copies", ["_page", "_bytes"], broadcast_rows)
    found = F.when(F.col("refers_to") == F.col("_page"), F.col("_bytes"))
    return joined.withColumn("payload_bytes", F.coalesce("payload_bytes", found)).drop("_page", "_bytes")


def deduplicated(
    pages: DataFrame,
    path: str | None = None,
    least_bytes: int = 0,
    archive_bytes: int = ARCHIVE_BYTES,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) as archives at ``path`` and returns all records read back.

    One pass over the payloads makes headers, which are shuffled by digest; a second one writes
    each payload once and a revisit record for every other page that had it. Payloads are shuffled
    only if the table of repeated digests is too large to broadcast, and then hot digests are not.

    NULL html is an empty payload, a NULL url leaves its header out, a NULL page_id is kept as such
    and smaller than any other. Repeated rows are records of their own, see `resolved`. Extra
    columns are ignored. An empty table writes no archive and returns no rows.
    """
    spark = pages.sparkSession
    path = path or new_location(spark, "archives")
    rows = captured(pages)
    first = originals(rows.drop("payload", "url"), least_bytes)
    write_archives(resolved(rows, first, broadcast_rows), path, archive_bytes=archive_bytes)
    headers = stored(read_archives(spark, path), "headers")
    return revisited(headers, broadcast_rows)
