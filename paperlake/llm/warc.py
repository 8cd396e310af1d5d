"""WARC archives: writing pages, reading records back, and resolving repeated payloads to revisits.

Archives are written by Spark's text writer: a record is one value and the two line
breaks that end a record are the writer's line separator. They are read as binary
files, so both work on any storage Spark can reach. A file holds a bounded number
of records and is parsed in one task.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperlake.session import scratch_path

RECORDS_PER_FILE = 2000
DATE = "2024-01-01T00:00:00Z"
_EOL = "\r\n"
_FLUSH_BYTES = 8 << 20

# --- Fixed values: the two alphabets of 32 digits ---
_RADIX_32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_BASE_32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

_RECORD = (
    "page_id long, url string, record_type string, payload_bytes long, payload_digest string, "
    "refers_to long, file string, offset long"
)


def base32_sha1(payload: Column) -> Column:
    """Upper-case base-32 SHA-1: five hexadecimal digits are four of base 32."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), _RADIX_32, _BASE_32)


def _page_records(pages: DataFrame) -> DataFrame:
    """One response record per page, as text."""
    payload = F.coalesce("html", F.lit(""))
    page = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    url = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]+", " ")
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{_EOL}Content-Type: text/html; charset=utf-8{_EOL}Content-Length: "),
        F.octet_length(payload).cast("string"),
        F.lit(_EOL * 2),
    )
    plain = F.md5(F.concat_ws("|", page, url, payload))
    name = F.concat_ws("-", *[F.substring(plain, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    fields = [
        ("WARC-Type", F.lit("response")),
        ("WARC-Record-ID", F.concat(F.lit("<urn:uuid:"), name, F.lit(">"))),
        ("WARC-Date", F.lit(DATE)),
        ("WARC-Target-URI", url),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_sha1(payload))),
        ("X-Page-ID", page),
        ("Content-Type", F.lit("application/http; msgtype=response")),
        ("Content-Length", (F.octet_length(http) + F.octet_length(payload)).cast("string")),
    ]
    header = F.concat(F.lit(f"WARC/1.1{_EOL}"), *[F.concat(F.lit(f"{k}: "), v, F.lit(_EOL)) for k, v in fields])
    return pages.select(F.concat(header, F.lit(_EOL), http, payload).alias("value"))


def _write(records: DataFrame, path: str) -> None:
    writer = records.write.option("lineSep", _EOL * 2).option("compression", "gzip")
    writer.option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def write_pages(pages: DataFrame, path: str) -> None:
    """Gzipped archives with one response record per row of ``pages`` (page_id, url, html); null html is empty."""
    _write(_page_records(pages), path)


@dataclass
class Record:
    """One record: its header fields, lower-cased, its block and where it starts in the unpacked file."""

    fields: dict[str, str]
    block: bytes
    offset: int

    @property
    def payload(self) -> bytes:
        """What follows the HTTP header; of a record that is no HTTP message, the block."""
        if self.fields.get("content-type", "").startswith("application/http"):
            return self.block.partition(b"\r\n\r\n")[2]
        return self.block

    def as_row(self, file: str) -> tuple:
        kind = self.fields.get("warc-type", "")
        if kind == "revisit":
            size = int(self.fields.get("x-payload-length") or 0)
            digest = self.fields.get("warc-payload-digest", "").removeprefix("sha1:")
        else:
            payload = self.payload
            size, digest = len(payload), _digest(payload)
        page, refers = self.fields.get("x-page-id"), self.fields.get("x-refers-to-page-id")
        return (
            int(page) if page else None,
            self.fields.get("warc-target-uri", ""),
            kind,
            size,
            digest,
            int(refers) if refers else None,
            file,
            self.offset,
        )


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()


def parse_records(data: bytes) -> Iterator[Record]:
    """The records of an unpacked archive, found by their lengths alone."""
    at = 0
    while (start := data.find(b"WARC/", at)) >= 0:
        end = data.find(b"\r\n\r\n", start)
        if end < 0:
            return
        lines = data[start:end].decode("utf-8", "replace").split("\r\n")[1:]
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        size = int(fields.get("content-length") or 0)
        at = end + 4 + size
        yield Record(fields, data[end + 4 : at], start)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, url, record_type, payload_bytes, payload_digest, refers_to, file, offset`` of all records.

    Size and digest are those of the full payload: computed where the record has it,
    taken from the header of a revisit.
    """
    names = [c.split()[0] for c in _RECORD.split(", ")]

    def headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        for batch in batches:
            for file, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                rows = [r.as_row(file) for r in parse_records(gzip.decompress(content.as_buffer()))]
                if rows:
                    columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                    yield pa.RecordBatch.from_arrays(columns, names)

    return _files(spark, path).mapInArrow(headers, _RECORD)


def resolve_revisits(records: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Adds ``original`` to record headers: of equal payloads, the place and page of the first.

    Headers are grouped by payload digest and length and joined back; the response with
    the smallest page id is the original, among those the first by file and offset.
    Records without page id come last. Payloads under ``min_bytes`` are their own originals.

    A revisit record holds no payload, so it is nobody's original. One whose original is
    not in these archives keeps the page it refers to, whatever its size.
    """
    place = F.struct(F.col("page_id").isNull().alias("nameless"), "page_id", "file", "offset")
    rows = records.withColumn("_place", place)
    full = rows.filter(F.col("record_type") != "revisit")
    firsts = full.filter(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest", "payload_bytes")
    firsts = firsts.agg(F.min("_place").alias("original"))
    joined = rows.join(firsts, ["payload_digest", "payload_bytes"], "left")
    nowhere = F.struct(
        F.lit(True).alias("nameless"),
        F.col("refers_to").alias("page_id"),
        F.lit(None).cast("string").alias("file"),
        F.lit(None).cast("long").alias("offset"),
    )
    own = F.when(F.col("record_type") == "revisit", nowhere).otherwise(F.col("_place"))
    return joined.withColumn("original", F.coalesce("original", own)).drop("_place")


def deduplicate(spark: SparkSession, source: str, target: str, min_bytes: int = 0) -> None:
    """Writes the archives below ``source`` to ``target``, repeated payloads as revisit records.

    Decisions are gathered per source file, a bounded number each, and meet the packed
    file; payloads are not shuffled one by one. Every record gets a fresh header.
    """
    decided = resolve_revisits(read_records(spark, source), min_bytes)
    is_original = (F.col("original.file") == F.col("file")) & (F.col("original.offset") == F.col("offset"))
    is_original = F.coalesce(is_original, F.lit(False))
    decision = F.struct("offset", is_original.alias("keep"), F.col("original.page_id").alias("page_id"))
    by_file = decided.groupBy(F.col("file").alias("path")).agg(F.collect_list(decision).alias("decisions"))

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, decisions in zip(batch.column("content"), batch.column("decisions").to_pylist()):
                by_offset = {d["offset"]: d for d in decisions}
                values, held = [], 0
                for record in parse_records(gzip.decompress(content.as_buffer())):
                    choice = by_offset[record.offset]
                    values.append(_fresh(record, choice["keep"], choice["page_id"]))
                    held += len(values[-1])
                    if held > _FLUSH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(values, pa.string())], ["value"])
                        values, held = [], 0
                yield pa.RecordBatch.from_arrays([pa.array(values, pa.string())], ["value"])

    _write(_files(spark, source).join(by_file, "path").mapInArrow(rewrite, "value string"), target)


def _fresh(record: Record, keep: bool, original_page: int | None) -> bytes:
    """The record as written to the new archive: with its block, or as a revisit with the HTTP header only.

    Digest and length are those of the full payload, which a revisit read in has in its header only.
    """
    payload, old = record.payload, record.fields
    again = old.get("warc-type") == "revisit"
    block = record.block if keep else record.block[: len(record.block) - len(payload)]
    digest = old.get("warc-payload-digest", "") if again else f"sha1:{_digest(payload)}"
    length = old.get("x-payload-length", "") if again else str(len(payload))
    fields = {
        "WARC-Type": "response" if keep else "revisit",
        "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, old.get('warc-record-id', '') + str(keep))}>",
        "WARC-Date": old.get("warc-date", DATE),
        "WARC-Target-URI": old.get("warc-target-uri", ""),
        "WARC-Payload-Digest": digest,
        "X-Page-ID": old.get("x-page-id", ""),
    }
    if not keep:
        fields |= {
            "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            "X-Refers-To-Page-ID": "" if original_page is None else str(original_page),
            "X-Payload-Length": length,
        }
    fields |= {"Content-Type": old.get("content-type", ""), "Content-Length": str(len(block))}
    header = "".join(f"{k}: {v}{_EOL}" for k, v in fields.items())
    return f"WARC/1.1{_EOL}{header}{_EOL}".encode() + block


def deduplicated_pages(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` per row of ``pages``.

    Pages (page_id, url, html) are written to an archive in the shared folder, read
    back, written again with revisit records for repeated payloads, and read from
    there. Null html is an empty payload, and all empty payloads are equal; repeated
    rows are records of their own, of which one is the response. Extra columns are ignored.
    """
    spark = pages.sparkSession
    first, second = scratch_path(spark, "warc"), scratch_path(spark, "warc-deduplicated")
    write_pages(pages, first)
    deduplicate(spark, first, second, min_bytes)
    return read_records(spark, second).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
