"""Web archives: one zstandard frame per record, with the dictionary in front.

An archive starts with a skippable frame that holds the dictionary its records were
compressed with. Records with a payload seen elsewhere are written as revisits.
Archives are rows of (path, content), as Spark's ``binaryFile`` source reads files, so
the reader takes stored archives and archive files alike.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.llm.common import small_batches

SKIPPABLE_MAGIC = 0x184D2A5D
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = "WARC/1.1"
REVISIT_BYTES = 1000
DICTIONARY_BYTES = 32 * 1024
DICTIONARY_SAMPLES = 64
ARCHIVE_BYTES = 16 << 20
READ_BYTES = 16 << 10
DATE = "2001-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def plan_records(
    pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """Record type of every page: page_id, url, payload, payload_digest, refers_to.

    Of the pages with equal payloads of at least ``REVISIT_BYTES`` the one with the
    largest id is the response, and the others refer to it. A null html is an empty
    payload. A null id is never referred to unless no copy has one, when all stay
    responses; rows that share the largest id are all responses.
    """
    rows = pages.select(
        pages[id].alias("page_id"),
        pages[url].alias("url"),
        F.encode(F.coalesce(pages[html], F.lit("")), "UTF-8").alias("payload"),
    ).withColumn("payload_digest", F.sha1("payload"))
    large = F.octet_length("payload") >= REVISIT_BYTES
    # Copies are counted before the shuffle, so one page repeated often is one row a task.
    last = (
        rows.where(large)
        .groupBy("payload_digest")
        .agg(F.max("page_id").alias("last_id"), F.count("*").alias("copies"))
        .where("copies > 1 and last_id is not null")
        .drop("copies")
    )
    refers = F.when(large & ~F.col("page_id").eqNullSafe(F.col("last_id")), F.col("last_id"))
    return rows.join(last, "payload_digest", "left").select(
        "page_id", "url", "payload", "payload_digest", refers.alias("refers_to")
    )


def record(kind: str, headers: dict[str, str], body: bytes) -> bytes:
    lines = [VERSION, f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in headers.items())]
    lines.append(f"Content-Length: {len(body)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def _dictionary(samples: list[bytes]) -> bytes:
    """Raw content of evenly chosen payloads; any bytes serve as such a dictionary."""
    share = max(1, DICTIONARY_BYTES // max(1, len(samples)))
    return b"".join(s[:share] for s in samples)


class Writer:
    """Gathers records and closes an archive when it is full."""

    def __init__(self, name: str):
        self.name, self.number, self.waiting = name, 0, []
        self.held = 0

    def add(self, data: bytes) -> tuple[str, bytes] | None:
        self.waiting.append(data)
        self.held += len(data)
        return self.close() if self.held >= ARCHIVE_BYTES else None

    def close(self) -> tuple[str, bytes] | None:
        import zstandard

        if not self.waiting:
            return None
        step = max(1, len(self.waiting) // DICTIONARY_SAMPLES)
        words = _dictionary(self.waiting[::step])
        held = zstandard.ZstdCompressionDict(words, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        compress = zstandard.ZstdCompressor(level=3, dict_data=held, write_checksum=True).compress
        frames = [struct.pack("<II", SKIPPABLE_MAGIC, len(words)) + words]
        frames += [compress(data) for data in self.waiting]
        name = f"{self.name}-{self.number:05d}.warc.zst"
        self.waiting, self.held, self.number = [], 0, self.number + 1
        return name, b"".join(frames)


def write_archives(records: DataFrame) -> DataFrame:
    """Archives (path, content) of the rows of ``plan_records``, some 16 MB of text each."""
    small_batches(records.sparkSession)

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        writer = Writer(f"part-{TaskContext.get().partitionId():06d}")
        for batch in batches:
            for row in batch.to_pylist():
                if done := writer.add(_page_record(row)):
                    yield _archive_batch(done)
        if done := writer.close():
            yield _archive_batch(done)

    return records.mapInArrow(written, "path string, content binary")


def _archive_batch(archive: tuple[str, bytes]) -> pa.RecordBatch:
    path, content = archive
    return pa.RecordBatch.from_arrays(
        [pa.array([path], pa.string()), pa.array([content], pa.binary())], names=["path", "content"]
    )


def _clean(text: str | None) -> str:
    """One header line: percent signs and line breaks are escaped."""
    return (text or "").replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _page_record(row: dict) -> bytes:
    page = "" if row["page_id"] is None else str(row["page_id"])
    headers = {"WARC-Record-ID": f"<urn:page:{page}>", "WARC-Date": DATE}
    if row["url"] is not None:
        headers["WARC-Target-URI"] = _clean(row["url"])
    headers["WARC-Payload-Digest"] = f"sha1:{row['payload_digest']}"
    body = row["payload"]
    if row["refers_to"] is None:
        return record("response", headers, body)
    headers["WARC-Profile"] = PROFILE
    headers["WARC-Refers-To"] = f"<urn:page:{row['refers_to']}>"
    headers["X-Payload-Length"] = str(len(body))
    return record("revisit", headers, b"")


class ArchiveError(ValueError):
    """An archive that breaks the format."""


def read_archive(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and body of every record, with formats, lengths and digests checked."""
    import zstandard

    if len(content) < 8 or struct.unpack_from("<I", content)[0] != SKIPPABLE_MAGIC:
        raise ArchiveError("no dictionary frame in front")
    size = struct.unpack_from("<I", content, 4)[0]
    if 8 + size > len(content):
        raise ArchiveError("the dictionary frame is cut short")
    words = content[8 : 8 + size]
    if words.startswith(FRAME_MAGIC):
        words = zstandard.ZstdDecompressor().decompress(words)
    held = zstandard.ZstdCompressionDict(words, dict_type=zstandard.DICT_TYPE_AUTO)
    view, at = memoryview(content), 8 + size
    while at < len(content):
        if bytes(view[at : at + 4]) != FRAME_MAGIC:
            raise ArchiveError("no frame where a record should start")
        decoder = zstandard.ZstdDecompressor(dict_data=held).decompressobj()
        parts = []
        try:
            while not decoder.eof and at < len(content):
                parts.append(decoder.decompress(view[at : at + READ_BYTES]))
                at += min(READ_BYTES, len(content) - at)
        except zstandard.ZstdError as error:
            raise ArchiveError(f"a frame can't be decoded: {error}") from error
        if not decoder.eof:
            raise ArchiveError("the last frame is cut short")
        at -= len(decoder.unused_data)
        yield parse_record(b"".join(parts))


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    head, found, tail = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not found or version != VERSION:
        raise ArchiveError("no WARC header")
    headers: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon:
            raise ArchiveError(f"header line without a name: {line[:80]}")
        headers[name.strip().lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in headers:
            raise ArchiveError(f"no {name}")
    length = int(headers["content-length"])
    if len(tail) != length + 4 or tail[length:] != b"\r\n\r\n":
        raise ArchiveError("the length doesn't fit the record")
    body = tail[:length]
    digest = headers.get("warc-payload-digest", "")
    if headers["warc-type"] == "response" and digest:
        if digest != f"sha1:{hashlib.sha1(body).hexdigest()}":
            raise ArchiveError("the digest doesn't fit the payload")
    return headers, body


def _page_of(value: str) -> int | None:
    number = value.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


RECORD_SCHEMA = (
    "page_id long, url string, record_type string, payload_bytes long, payload_digest string,"
    " refers_to long, payload binary"
)


def read_archives(archives: DataFrame) -> DataFrame:
    """Every record of archives given as rows with ``content``, as a row.

    ``payload`` is null for revisits, whose length and digest come from their headers.
    A damaged archive raises.
    """
    small_batches(archives.sparkSession)
    names = [field.split()[0] for field in RECORD_SCHEMA.split(", ")]
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]

    def rows_of(content: bytes) -> Iterator[tuple]:
        for headers, body in read_archive(content):
            kind = headers["warc-type"]
            uri = headers.get("warc-target-uri")
            if uri is not None:
                uri = uri.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
            refers = headers.get("warc-refers-to")
            yield (
                _page_of(headers["warc-record-id"]),
                uri,
                kind,
                len(body) if kind == "response" else int(headers["x-payload-length"]),
                headers["warc-payload-digest"].removeprefix("sha1:"),
                None if refers is None else _page_of(refers),
                body if kind == "response" else None,
            )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = list(rows_of(content.as_py()))
                columns = zip(*rows) if rows else [[]] * len(names)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types)], names=names
                )

    return archives.select("content").mapInArrow(read, RECORD_SCHEMA)
