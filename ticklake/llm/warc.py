"""WARC archives: a writer that deduplicates payloads and a reader that salvages.

Writing. Payloads of ``SMALLEST`` bytes or more are deduplicated by their SHA-256: the
record of the smallest id is the response, the others are revisits that name it. Every
record is a gzip member of its own (or plain). Spark's text writer puts the records down;
what it adds after each is part of the format: the last newline of a plain record, or an
empty gzip member. So archives are committed like any Spark output.

Reading. Each file is read as a whole by one task; records are checked (gzip checksums,
version line, header fields, length, the blank lines at the end, block and payload digest).
Where a check fails, the reader searches for the next gzip member or version line at which
a whole record passes, goes on from there, and reports the bytes between as a gap with the
reason. No byte of a file is neither in a record nor in a gap.

Defined results: a null payload is empty; a null id is left out of its record and comes
back as null, and it never is the smallest unless all ids of its group are null, in which
case all are responses; rows that repeat the smallest id are all responses; smaller
payloads are all responses; a null target is left out; white space and control characters
in targets are percent-encoded. Empty tables and files give no records.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.llm.common import arrow_schema, scratch

SMALLEST = 100
SLICE = 1 << 16
GZIP = b"\x1f\x8b\x08"
EMPTY_MEMBER = zlib.compressobj(1, zlib.DEFLATED, 31).flush()
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SPACE_FOR = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
_HEADER_END = re.compile(rb"\r\n(?:(\r\n)|WARC/1\.[01]\r\n)")  # or the next record's version line
_CANDIDATE = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


def record_id(number: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE_FOR, f'{number}/{digest}')}>"


def record(
    number: int | None, url: str | None, payload: bytes, digest: str, first: int | None, date: str
) -> bytes:
    """One record; ``first`` is the id of the response that a revisit refers to."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = head if first is not None else head + payload
    lines = [
        "WARC/1.1", f"WARC-Type: {'response' if first is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(number, digest)}", f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
        f"Payload-Length: {len(payload)}",
    ]
    if url is not None:
        safe = _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url)
        lines.append(f"WARC-Target-URI: {safe}")
    if number is not None:
        lines.append(f"Row-ID: {number}")
    if first is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(first, digest)}", f"Refers-To-Row-ID: {first}"]
    return "\r\n".join(lines).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    deflate = zlib.compressobj(4, zlib.DEFLATED, 31)
    return deflate.compress(data) + deflate.flush()


# salvage


@dataclass
class Found:
    """A record, or a gap if ``reason`` is set, with its place in the file."""

    offset: int
    length: int
    fields: dict[str, str] = field(default_factory=dict)
    block: bytes = b""
    reason: str | None = None

    @property
    def payload(self) -> bytes:
        """The block after the HTTP header, if the record has one."""
        if "application/http" not in self.fields.get("content-type", ""):
            return self.block
        return self.block.partition(b"\r\n\r\n")[2]


class Damaged(Exception):
    """Why the bytes at a place are no valid record."""


def _parsed(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Fields, block and end of the plain record at a place."""
    version = _VERSION.match(data, at)
    if not version:
        raise Damaged("no version line")
    ending = _HEADER_END.search(data, version.end() - 2)
    if not ending or not ending[1]:
        raise Damaged("the header has no end")
    end = ending.start()
    fields: dict[str, str] = {}
    for line in data[at:end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            raise Damaged("a header line has no name")
        fields[name.strip().decode("utf-8", "replace").lower()] = value.strip().decode("utf-8", "replace")
    size = fields.get("content-length", "")
    if not re.fullmatch("[0-9]{1,18}", size) or "warc-type" not in fields:
        raise Damaged("no valid length or type")
    begin, stop = end + 4, end + 4 + int(size)
    if data[stop : stop + 4] != b"\r\n\r\n":
        raise Damaged("the record does not end at its length")
    block = bytes(data[begin:stop])
    found = Found(at, stop + 4 - at, fields, block)
    _check(fields.get("warc-block-digest"), block, "block")
    if fields["warc-type"] != "revisit":
        _check(fields.get("warc-payload-digest"), found.payload, "payload")
    return fields, block, stop + 4


def _check(digest: str | None, data: bytes, what: str) -> None:
    name, _, value = (digest or "").partition(":")
    if name.lower() == "sha256" and re.fullmatch("[0-9a-f]{64}", value):
        if hashlib.sha256(data).hexdigest() != value:
            raise Damaged(f"the {what} digest does not match")


def _inflated(data: memoryview, at: int) -> tuple[bytes, int]:
    """Content and end of the gzip member at a place."""
    inflate = zlib.decompressobj(31)
    out, place = [], at
    try:
        while not inflate.eof:
            if place >= len(data):
                raise Damaged("the member is cut off")
            piece = data[place : place + SLICE]
            out.append(inflate.decompress(piece))
            place += len(piece)
            if sum(map(len, out[:2])) >= 5 and len(out) < 3 and not b"".join(out).startswith(b"WARC/"):
                raise Damaged("the member holds no record")
    except zlib.error as error:
        raise Damaged("the member is damaged") from error
    return b"".join(out), place - len(inflate.unused_data)


def _at(data: bytes, view: memoryview, at: int) -> tuple[list[Found], int]:
    """Records at a place (none in an empty member) and where they end."""
    if data[at : at + 3] != GZIP:
        fields, block, end = _parsed(data, at)
        return [Found(at, end - at, fields, block)], end
    content, end = _inflated(view, at)
    records, place = [], 0
    while place < len(content):
        fields, block, place = _parsed(content, place)
        records.append(Found(at, end - at, fields, block))
    return records, end


def salvaged(data: bytes) -> Iterator[Found]:
    """Every valid record of a file, and the gaps between them."""
    view, at = memoryview(data), 0
    while at < len(data):
        try:
            records, end = _at(data, view, at)
        except Damaged as error:
            end, records = _next_valid(data, view, at + 1)
            yield Found(at, end - at, reason=str(error))
        else:
            yield from records
            at = end
            continue
        at = end


def _next_valid(data: bytes, view: memoryview, at: int) -> tuple[int, list[Found]]:
    """The first later place where a record passes all checks, or the end."""
    for candidate in _CANDIDATE.finditer(data, at):
        try:
            records, _ = _at(data, view, candidate.start())
        except Damaged:
            continue
        if records or data[candidate.start() :].startswith(EMPTY_MEMBER):
            return candidate.start(), records
    return len(data), []


# tables


def archive(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    compress: bool = True, date: str = "1970-01-01T00:00:00Z", smallest: int = SMALLEST,
) -> None:
    """Write one record per row to a new folder of archives."""
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(payload_col).cast("string").cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    shared = (
        rows.filter(F.octet_length("payload") >= smallest).select("digest", "id")
        .groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("copies"))
        .filter("copies > 1").select("digest", "first")
    )
    placed = rows.join(shared, "digest", "left").withColumn(
        "first", F.when(~F.col("id").eqNullSafe(F.col("first")), F.col("first"))
    )

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(n) for n in ("id", "url", "payload", "digest", "first")]
            pieces, held = [], 0
            for at in range(batch.num_rows):
                data = record(*(c[at].as_py() for c in columns), date)
                pieces.append(member(data) if compress else data[:-1])
                held += len(pieces[-1])
                if held > 1 << 22:
                    yield pa.RecordBatch.from_arrays([pa.array(pieces, pa.binary())], names=["piece"])
                    pieces, held = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(pieces, pa.binary())], names=["piece"])

    ending = EMPTY_MEMBER.decode("iso-8859-1") if compress else "\n"
    (
        placed.mapInArrow(records, "piece binary").select(F.col("piece").cast("string"))
        .write.option("lineSep", ending).option("encoding", "ISO-8859-1").text(folder)
    )


READ = """file string, offset long, length long, reason string, record_type string, row_id long,
    refers_to long, target string, payload_bytes long, payload_digest string, payload binary"""


def read(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """Records and gaps of all files in a folder; gaps have a ``reason`` and no type."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    schema = arrow_schema(READ)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                rows: list[tuple] = []
                held = 0
                for found in salvaged(content.as_py()):
                    rows.append(_row(path, found, payloads))
                    held += len(rows[-1][-1] or b"") + 500
                    if held > 1 << 23:
                        yield _as_batch(rows, schema)
                        rows, held = [], 0
                yield _as_batch(rows, schema)

    return files.select("path", "content").mapInArrow(listed, READ)


def _as_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _long(value: str) -> int | None:
    """A signed 64-bit number, or null."""
    number = int(value) if re.fullmatch("-?[0-9]{1,19}", value) else None
    return number if number is not None and -(1 << 63) <= number < 1 << 63 else None


def _row(path: str, found: Found, payloads: bool) -> tuple:
    if found.reason is not None:
        return (path, found.offset, found.length, found.reason, *[None] * 7)
    fields, whole = found.fields, found.fields["warc-type"] != "revisit"
    number = lambda name: _long(fields.get(name, ""))
    payload = found.payload if whole else None
    return (
        path, found.offset, found.length, None, fields["warc-type"], number("row-id"), number("refers-to-row-id"),
        fields.get("warc-target-uri"), len(payload) if whole else number("payload-length"),
        hashlib.sha256(payload).hexdigest() if whole else fields.get("warc-payload-digest", "").rpartition(":")[2],
        payload if payloads else None,
    )


def archive_and_read(pages: DataFrame, payloads: bool = False) -> DataFrame:
    """Records of the rows as read back from archives in the shared folder."""
    folder = scratch(pages.sparkSession, "warc")
    archive(pages, folder)
    return read(pages.sparkSession, folder, payloads)
