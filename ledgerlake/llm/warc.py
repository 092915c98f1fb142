"""WARC archives by way of a chunked record table.

A payload is never handled as one block beyond the cell it arrives in: it becomes rows of record number,
chunk number, a chunk of at most ``CHUNK`` bytes and the running SHA-1 and size so far.  Each chunk is then
one WARC record; chunks after the first are ``continuation`` records (segmentation as in WARC 1.1).  Chunks
end between characters, and also inside any occurrence of the record separator and of its visible part at a chunk's
end, which the line end behind the chunk would complete.  So an archive can be split at separators by parallel
readers whatever the payloads hold.

Of records with equal payloads (same SHA-1 and size, at least ``least`` bytes) the one with the smallest
page id is a ``response``, the others are ``revisit`` records that refer to it.  A NULL payload is empty;
records without a page id are always responses and are never referred to; of rows that repeat a page id and
payload, one is the response.  An empty table gives no records.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import partitions
from ledgerlake.sinks.stage import Stage

CHUNK = 1 << 18
SEPARATOR = "WARC/1.1\r\n"
DATE = "2026-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_CHUNKS = (
    "record long, page_id long, url string, chunk_no int, chunk binary, running_sha1 string, "
    "running_bytes long, last boolean"
)
_SEGMENTS = (
    "record long, segment int, last boolean, page_id long, record_type string, refers_to long, digest string, "
    "payload_bytes long, payload binary"
)


def base32_sha1(digest) -> str:
    return base64.b32encode(digest.digest()).decode()


def chunk_bounds(data: bytes, size: int) -> Iterator[tuple[int, int]]:
    """Where a payload is cut: by size, between characters, and within each separator, also one that a line end completes."""
    mark = SEPARATOR.encode()
    open_mark = mark.rstrip()
    start, at = 0, data.find(mark)
    while True:
        end = min(len(data), start + size)
        if 0 <= at < start:
            at = data.find(mark, start)
        while start < end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        if 0 <= at < end - len(mark) + 1:
            end = at + len(open_mark) - 1
            at = data.find(mark, end)
        elif data.endswith(open_mark, start, end):
            end -= 1
        yield start, end
        if end >= len(data):
            return
        start = end


def _chunks(size: int):
    schema = pa.schema(
        [
            ("record", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()), ("chunk_no", pa.int32()),
            ("chunk", pa.binary()), ("running_sha1", pa.string()), ("running_bytes", pa.int64()), ("last", pa.bool_()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            for i in range(batch.num_rows):
                record, page, url = (batch.column(c)[i].as_py() for c in ("record", "page_id", "url"))
                data = batch.column("payload")[i].as_py() or b""
                digest = hashlib.sha1()
                for number, (start, end) in enumerate(chunk_bounds(data, size)):
                    digest.update(data[start:end])
                    last = end == len(data)
                    rows.append((record, page, url, number, data[start:end], base32_sha1(digest), end, last))
                    held += end - start
                    if held > 4 * size:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                        rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return run


def chunk_table(pages: DataFrame, size: int = CHUNK) -> DataFrame:
    """The chunked record table of a table of pages; ``record`` tells equal rows apart."""
    rows = pages.select(
        F.monotonically_increasing_id().alias("record"),
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("binary").alias("payload"),
    )
    return rows.mapInArrow(_chunks(size), _CHUNKS)


def revisits(chunks: DataFrame, least: int = 0) -> DataFrame:
    """``record, refers_to, digest, bytes`` of the records whose payload an earlier page has."""
    payloads = chunks.where("last").select(
        "record", "page_id", F.col("running_sha1").alias("digest"), F.col("running_bytes").alias("bytes")
    ).where(F.col("page_id").isNotNull() & (F.col("bytes") >= least))
    # Partial minima come first, so a payload that very many pages share is no hot key here; the join back
    # holds only payloads that occur twice and leaves skew to the adaptive planner.
    first = (
        payloads.groupBy("digest", "bytes")
        .agg(F.min(F.struct("page_id", "record")).alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", "bytes", F.col("first.page_id").alias("refers_to"), F.col("first.record").alias("response"))
    )
    return payloads.join(first, ["digest", "bytes"]).where("record <> response").select("record", "refers_to", "digest", "bytes")


def _field(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def write_archives(chunks: DataFrame, repeated: DataFrame, path: str) -> None:
    """Write one WARC record per chunk (revisits: one without payload) into gzip files under ``path``."""
    again = repeated.select("record", "refers_to", F.col("digest").alias("of_digest"), F.col("bytes").alias("of_bytes"))
    rows = chunks.join(again, "record", "left").where(F.col("refers_to").isNull() | (F.col("chunk_no") == 0))
    revisit = F.col("refers_to").isNotNull()
    # Blanks, control and other characters in a URL must not end its header line, nor its line end make a separator.
    plain = F.col("url").rlike(r"\A[!-~]*\z") & ~F.col("url").endswith(SEPARATOR.rstrip())
    uri = F.when(plain, F.col("url")).otherwise(F.url_encode("url"))
    chunk = F.when(revisit, F.lit("")).otherwise(F.col("chunk").cast("string"))
    size = F.when(revisit, F.lit(0)).otherwise(F.octet_length("chunk"))
    identity = F.concat(F.lit("<urn:record:"), F.col("record").cast("string"))
    optional = F.lit("")
    record = F.concat(
        F.lit(SEPARATOR),
        _field("WARC-Type", F.when(revisit, "revisit").when(F.col("chunk_no") == 0, "response").otherwise("continuation")),
        _field("WARC-Record-ID", F.concat(identity, F.lit(":"), F.col("chunk_no").cast("string"), F.lit(">"))),
        _field("WARC-Date", F.lit(DATE)),
        _field("WARC-Segment-Number", (F.col("chunk_no") + 1).cast("string")),
        F.when(F.col("chunk_no") > 0, _field("WARC-Segment-Origin-ID", F.concat(identity, F.lit(":0>")))).otherwise(optional),
        F.when(F.col("page_id").isNotNull(), _field("Page-ID", F.col("page_id").cast("string"))).otherwise(optional),
        F.when(F.col("url").isNotNull(), _field("WARC-Target-URI", uri)).otherwise(optional),
        F.when(revisit, _field("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">")))).otherwise(optional),
        F.when(revisit, _field("WARC-Profile", F.lit(REVISIT_PROFILE))).otherwise(optional),
        F.when(
            revisit | F.col("last"),
            F.concat(
                _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.when(revisit, F.col("of_digest")).otherwise(F.col("running_sha1")))),
                _field("WARC-Segment-Total-Length", F.when(revisit, F.col("of_bytes")).otherwise(F.col("running_bytes")).cast("string")),
            ),
        ).otherwise(optional),
        _field("Content-Length", size.cast("string")),
        F.lit("\r\n"),
        chunk,
        F.lit("\r\n"),
    )
    rows.select(record.alias("value")).write.option("lineSep", "\r\n").option("compression", "gzip").text(path)


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of an archive: a record of one segment gets its digest here, others keep their payload."""
    schema = pa.schema(
        [
            ("record", pa.int64()), ("segment", pa.int32()), ("last", pa.bool_()), ("page_id", pa.int64()),
            ("record_type", pa.string()), ("refers_to", pa.int64()), ("digest", pa.string()),
            ("payload_bytes", pa.int64()), ("payload", pa.binary()),
        ]
    )
    for batch in batches:
        rows = []
        for cell in batch.column("value"):
            head, _, rest = cell.as_py().partition(b"\r\n\r\n")
            fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n"))
            payload = rest[: int(fields["Content-Length"])]
            if len(payload) != int(fields["Content-Length"]):
                raise ValueError(f"record {fields['WARC-Record-ID']} is cut short")
            segment = int(fields["WARC-Segment-Number"])
            total = fields.get("WARC-Segment-Total-Length")
            kind = fields["WARC-Type"]
            refers = int(fields["WARC-Refers-To"][len("<urn:page:") : -1]) if "WARC-Refers-To" in fields else None
            digest = fields.get("WARC-Payload-Digest", "sha1:")[5:]
            page = int(fields["Page-ID"]) if "Page-ID" in fields else None
            if kind == "response" and total is not None:
                if base32_sha1(hashlib.sha1(payload)) != digest or len(payload) != int(total):
                    raise ValueError(f"record {fields['WARC-Record-ID']} fails its digest")
            single = kind == "revisit" or kind == "response" and total is not None
            rows.append((
                int(fields["WARC-Record-ID"].split(":")[2]), segment, total is not None, page,
                "revisit" if kind == "revisit" else "response", refers, digest, int(total) if total else None,
                None if single else payload,
            ))
        yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows) if rows else [[]] * 9, schema)], schema=schema)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of records of several segments, which arrive in order; one segment is held at a time."""
    record, digest, size, head, upto = None, hashlib.sha1(), 0, None, 0
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    for batch in batches:
        rows = []
        for i in range(batch.num_rows):
            at = {c: batch.column(c)[i].as_py() for c in ("record", "segment", "last", "page_id", "digest", "payload_bytes", "payload")}
            if at["record"] != record:
                record, digest, size, upto, head = at["record"], hashlib.sha1(), 0, 0, at["page_id"]
            if at["segment"] != upto + 1:
                raise ValueError(f"record {record} lacks segment {upto + 1}")
            upto = at["segment"]
            digest.update(at["payload"])
            size += len(at["payload"])
            if at["last"]:
                if base32_sha1(digest) != at["digest"] or size != at["payload_bytes"]:
                    raise ValueError(f"record {record} fails its digest")
                rows.append((head, size, base32_sha1(digest), "response", None))
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows) if rows else [[]] * 5, types)], names=names)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of all records under ``path``.

    Every payload is digested again and must agree with its header.
    """
    pieces = spark.read.option("lineSep", SEPARATOR).text(path).where(F.octet_length("value") > 0)
    segments = pieces.select(F.col("value").cast("binary").alias("value")).mapInArrow(_parsed, _SEGMENTS)
    names = ("page_id", "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to")
    whole = segments.where(F.col("payload").isNull()).select(*names)
    several = segments.where(F.col("payload").isNotNull())
    streamed = several.repartition(partitions(spark), "record").sortWithinPartitions("record", "segment")
    return whole.unionByName(
        streamed.mapInArrow(_joined, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
    )


def archived(pages: DataFrame, stage: Stage, least: int = 0, size: int = CHUNK) -> DataFrame:
    """Write the pages as archives under the stage and return what reading them back gives."""
    spark = pages.sparkSession
    chunks = stage.keep(chunk_table(pages, size), "chunks")
    path = stage.path("warc")
    write_archives(chunks, stage.keep(revisits(chunks, least), "revisits"), path)
    return read_archives(spark, path)
