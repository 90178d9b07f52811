"""WARC archives as tables of chunks.

Writing. A page becomes one record; a payload of more than ``chunk`` characters becomes a record and
``continuation`` records, the segments that the WARC format has for this. Each row is one segment,
so no row, task or file ever holds more of a payload than a chunk. Spark's text writer puts the rows
into gzipped archives of ``records_per_file`` segments at most, in any store that Spark can write.
Of equal payloads of ``least`` bytes and more, the one with the largest page_id is a response; the
others are revisits that name it and hold no payload.

Reading back. Archives are decompressed and parsed as streams; a segment becomes a row with its
record's identifier and its chunk number. Payloads of one segment are digested where they are
parsed. The chunks of all others are dealt out by record identifier and sorted by chunk number; a
task carries the digest of the record it is in from chunk to chunk, over batches, and checks it
against the record's header at the end.

Defined results: a null payload is empty. Rows that repeat a page_id and a payload share their
record type. A null page_id is kept as null; it is never referred to unless all ids of its group are
null. Characters that would end a header line are percent-encoded in URLs; a null URL is left out.
An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import io
import re
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from maskwright.sources.staging import new_path

CHUNK = 1 << 16
LEAST = 1000
RECORDS_PER_FILE = 2000
READ = 1 << 16
DATE = "1970-01-01T00:00:00Z"

# Fixed values of the format.
BREAK = "\r\n"
RECORD_END = BREAK + BREAK
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

CHUNKS = (
    "record_id string, chunk_no int, last boolean, page_id long, record_type string, "
    "refers_to long, digest string, payload_bytes long, data binary"
)
RECORDS = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
)


def header(name: str, value: Column) -> Column:
    """A header line, or nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(BREAK)), F.lit(""))


def records(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    least: int = LEAST,
    chunk: int = CHUNK,
    date: str = DATE,
) -> DataFrame:
    """One row ``value`` per segment: all that the archive holds for it, without the record's end."""
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.regexp_replace(F.col(url_col), "[\\x00-\\x20\\x7F]", "%20").alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("bytes"),
        F.sha1(payload.cast("binary")).alias("digest"),
        F.sha2(payload.cast("binary"), 256).alias("same"),
    )
    copies = (
        rows.where(F.col("bytes") >= least)
        .groupBy("same")
        .agg(F.max("page_id").alias("kept"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
    )
    rows = rows.join(copies, "same", "left")
    repeats = F.coalesce(~F.col("page_id").eqNullSafe(F.col("kept")), F.lit(False))
    rows = rows.withColumn("revisit", F.col("copies").isNotNull() & repeats)
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{BREAK}Content-Type: text/html; charset=utf-8{BREAK}"),
        header("Content-Length", F.col("bytes").cast("string")),
        F.lit(BREAK),
    )
    body = F.when(F.col("revisit"), F.lit("")).otherwise(F.col("payload"))
    count = F.greatest(F.lit(1), F.ceil(F.length(body) / F.lit(chunk))).cast("int")
    rows = rows.select(
        "*",
        F.concat(F.lit("urn:uuid:"), F.expr("uuid()")).alias("record"),
        http.alias("http"),
        body.alias("body"),
        count.alias("n"),
    )
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("k"))
    first, many = F.col("k") == 0, F.col("n") > 1
    piece = F.when(
        many, F.substring(F.col("body"), F.col("k") * chunk + 1, F.lit(chunk))
    ).otherwise(F.col("body"))
    block = F.when(first, F.concat("http", piece)).otherwise(piece)
    kind = (
        F.when(~first, F.lit("continuation"))
        .when(F.col("revisit"), F.lit("revisit"))
        .otherwise(F.lit("response"))
    )
    record = F.concat(F.lit("<"), F.col("record"), F.lit(">"))
    identifier = F.when(first, record).otherwise(
        F.concat(F.lit("<"), F.col("record"), F.lit("-"), F.col("k"), F.lit(">"))
    )
    value = F.concat(
        F.lit(VERSION + BREAK),
        header("WARC-Type", kind),
        header("WARC-Record-ID", identifier),
        header("WARC-Date", F.lit(date)),
        header("WARC-Target-URI", F.nullif(F.col("url"), F.lit(""))),
        header("Content-Type", F.lit("application/http; msgtype=response")),
        header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        header("WARC-Page-ID", F.col("page_id").cast("string")),
        header("WARC-Profile", F.when(F.col("revisit"), F.lit(REVISIT_PROFILE))),
        header("WARC-Refers-To-Page-ID", F.when(F.col("revisit"), F.col("kept").cast("string"))),
        header("WARC-Segment-Number", F.when(many, (F.col("k") + 1).cast("string"))),
        header("WARC-Segment-Origin-ID", F.when(~first, record)),
        header("WARC-Segment-Count", F.when(many, F.col("n").cast("string"))),
        header("Content-Length", F.octet_length(block).cast("string")),
        F.lit(BREAK),
        block,
    )
    return rows.select(value.alias("value"))


def write_archives(
    segments: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE
) -> None:
    """Write segments to gzipped archives; each record ends with two line breaks."""
    (
        segments.write.mode("error")
        .option("lineSep", RECORD_END)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", records_per_file)
        .text(path)
    )


class Inflated(io.RawIOBase):
    """Reads gzipped bytes, of one member or many, without holding what they decompress to."""

    def __init__(self, data: bytes | pa.Buffer) -> None:
        self.data, self.at = memoryview(data), 0
        self.inflate = zlib.decompressobj(31)
        self.left = b""

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        while True:
            if self.inflate.eof:
                rest = self.inflate.unused_data + self.left
                self.left = rest
                if not rest and self.at >= len(self.data):
                    return 0
                self.inflate = zlib.decompressobj(31)
            feed = self.left
            if not feed:
                feed = bytes(self.data[self.at : self.at + READ])
                self.at += len(feed)
                if not feed:
                    raise EOFError("archive is cut off")
            got = self.inflate.decompress(feed, len(buffer))
            self.left = self.inflate.unconsumed_tail
            if got:
                buffer[: len(got)] = got
                return len(got)


def segments_of(data: bytes | pa.Buffer) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an archive."""
    stream = io.BufferedReader(Inflated(data), READ)
    while True:
        line = stream.readline()
        if not line:
            return
        if line in (b"\r\n", b"\n"):
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a record: {line[:40]!r}")
        headers = {}
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            name, _, value = line.decode("utf-8").partition(":")
            headers[name.strip().lower()] = value.strip()
        size = int(headers["content-length"])
        block = stream.read(size)
        if len(block) != size:
            raise EOFError("record is cut off")
        yield headers, block


def chunk_row(headers: dict[str, str], block: bytes) -> tuple:
    number = int(headers.get("warc-segment-number", 1))
    count = int(headers.get("warc-segment-count", 1))
    length = None
    if number == 1:
        lines, _, block = block.partition(b"\r\n\r\n")
        found = re.search(rb"(?i)\ncontent-length: *([0-9]+)", lines)
        length = int(found[1]) if found else len(block)
    page, other = headers.get("warc-page-id"), headers.get("warc-refers-to-page-id")
    return (
        headers.get("warc-segment-origin-id", headers["warc-record-id"]).strip("<>"),
        number - 1,
        number == count,
        int(page) if page else None,
        headers["warc-type"],
        int(other) if other else None,
        headers["warc-payload-digest"].partition(":")[2].lower(),
        length,
        block,
    )


def verified(kind: str, found: str, told: str, length: int, size: int, record: str) -> str:
    if kind != "revisit" and (found != told or length != size):
        raise ValueError(f"{record}: payload has {size} bytes and sha1 {found}, not {told}")
    return told


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """Segments of all archives. ``data`` is null, and ``digest`` checked, where one segment is all."""
    names = [f.split()[0] for f in CHUNKS.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [
                pa.string(), pa.int32(), pa.bool_(), pa.int64(), pa.string(),
                pa.int64(), pa.string(), pa.int64(), pa.binary(),
            ]
            columns = list(zip(*rows))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds)], names=names
            )

        for batch in batches:
            for archive in batch.column(0):
                rows, held = [], 0
                for headers, block in segments_of(archive.as_buffer()):
                    row = chunk_row(headers, block)
                    if row[1] == 0 and row[2]:
                        found = hashlib.sha1(row[8]).hexdigest()
                        verified(row[4], found, row[6], row[7], len(row[8]), row[0])
                        row = (*row[:8], None)
                    rows.append(row)
                    held += len(row[8] or b"") + 200
                    if held > 1 << 22:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(run, CHUNKS)


def read_records(chunks: DataFrame) -> DataFrame:
    """One row per record, from its chunks in order."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        record, digest, size, head, expected = None, None, 0, None, 0
        for batch in batches:
            done = []
            columns = [batch.column(i).to_pylist() for i in range(8)]
            for i, row in enumerate(zip(*columns)):
                name, number, last, page, kind, refers, told, length = row
                if number == 0:
                    if record is not None:
                        raise ValueError(f"{record}: last segment is missing")
                    record, head, expected, size = name, (page, kind, refers, told, length), 0, 0
                    digest = hashlib.sha1()
                if name != record or number != expected:
                    raise ValueError(f"{name}: segment {number} is out of order")
                expected += 1
                data = batch.column(8)[i]
                if data.is_valid:
                    digest.update(data.as_buffer())
                    size += len(data.as_buffer())
                if last:
                    page, kind, refers, told, length = head
                    if data.is_valid:
                        verified(kind, digest.hexdigest(), told, length, size, record)
                    done.append((page, length, told, kind, refers))
                    record = None
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            names = [f.split()[0] for f in RECORDS.split(", ")]
            parts = zip(*done) if done else [[] for _ in kinds]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(parts, kinds)], names=names
            )
        if record is not None:
            raise ValueError(f"{record}: last segment is missing")

    ordered = chunks.repartition("record_id").sortWithinPartitions("record_id", "chunk_no")
    return ordered.mapInArrow(run, RECORDS)


def warc_round_trip(pages: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write the pages' archives, read them back and return a row per page."""
    spark = pages.sparkSession
    target = path or new_path(spark, "archives")
    write_archives(records(pages, **options), target)
    return read_records(read_chunks(spark, target))
