"""WARC archives: writing with revisit records, and a reader that salvages.

The reader goes on after damage: where a record does not pass its checks, it looks
for the next gzip member (or, in plain archives, the next version line) at which a
whole valid record begins, reads on from there and logs the bytes between as a gap.
"""

import hashlib
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import broadcast_if_bounded
from .common import work_path, work_table
from .files import attempt_name, open_output

VERSION = b"WARC/1."
_MANDATORY = ("warc-type", "warc-record-id", "warc-date", "content-length")
GZIP_START = b"\x1f\x8b\x08"
#: An archive is closed at the first record end after so many bytes.
FILE_BYTES = 16 << 20
#: Payloads below this size are stored each time.
REVISIT_BYTES = 1000
#: Bytes of a gzip member that are unpacked at a time.
PIECE_BYTES = 1 << 14

RECORD_SCHEMA = (
    "file string, offset long, length long, record_type string, record_id string, "
    "target_uri string, page_id long, refers_to string, payload_digest string, "
    "payload_bytes long, payload binary, gap string"
)
_NAMES = [field.split()[0] for field in RECORD_SCHEMA.split(", ")]
_KINDS = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
_TYPES = [_KINDS[field.split()[1]] for field in RECORD_SCHEMA.split(", ")]


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def format_record(
    page_id: int | None,
    url: str | None,
    payload: bytes,
    digest: str,
    refers_to: int | None,
    revisit: bool,
    date: str,
) -> bytes:
    """The bytes of one record; a revisit carries no payload but its size and digest."""
    block = b"" if revisit else payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{hashlib.sha1(block).hexdigest()}",
        f"X-Payload-Length: {len(payload)}",
        "Content-Type: application/octet-stream",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {' '.join(url.split())}")
    if revisit:
        lines.append(f"WARC-Refers-To: {record_id(refers_to)}")
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def parse_record(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and end of the record at ``at``; ValueError if it isn't whole."""
    if not data.startswith(VERSION, at):
        raise ValueError("no version line")
    head_end = data.find(b"\r\n\r\n", at)
    if head_end < 0:
        raise ValueError("headers do not end")
    headers = {}
    for line in data[at:head_end].decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise ValueError("header without a colon")
        if any(char < " " and char != "\t" for char in line):
            raise ValueError("control character in a header")
        headers[name.strip().lower()] = value.strip()
    if not all(headers.get(name) for name in _MANDATORY):
        raise ValueError("a mandatory header is missing")
    length = headers.get("content-length", "")
    if not length.isdigit():
        raise ValueError("no content length")
    start = head_end + 4
    end = start + int(length)
    if data[end : end + 4] != b"\r\n\r\n":
        raise ValueError("block does not end where its length says")
    block = data[start:end]
    digest = headers.get("warc-block-digest", "")
    if digest.startswith("sha1:") and hashlib.sha1(block).hexdigest() != digest[5:]:
        raise ValueError("block digest differs")
    return headers, block, end + 4


def _record_at(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """The record at ``at``, in a gzip member of its own or plain."""
    if data.startswith(GZIP_START, at):
        # In pieces, so that the rest of the archive is not copied for each member.
        unpacker, parts, end = zlib.decompressobj(31), [], at
        try:
            while not unpacker.eof and end < len(data):
                parts.append(unpacker.decompress(data[end : end + PIECE_BYTES]))
                end = min(end + PIECE_BYTES, len(data))
        except zlib.error as error:
            raise ValueError(str(error)) from None
        if not unpacker.eof:
            raise ValueError("member is cut off")
        end -= len(unpacker.unused_data)
        plain = b"".join(parts)
        headers, block, length = parse_record(plain)
        if length != len(plain):
            raise ValueError("member holds more than its record")
        return headers, block, end
    return parse_record(data, at)


def _next_start(data: bytes, at: int) -> int:
    found = [p for p in (data.find(GZIP_START, at), data.find(VERSION, at)) if p >= 0]
    return min(found, default=len(data))


def salvage(data: bytes) -> Iterator[tuple[int, int, dict[str, str] | None, bytes, str | None]]:
    """Records and gaps of an archive: offset, length, headers, block, reason.

    A gap has no headers; its reason is why the record at its start failed. Gaps
    and records together cover every byte once.
    """
    at = 0
    while at < len(data):
        try:
            headers, block, end = _record_at(data, at)
            yield at, end - at, headers, block, None
            at = end
            continue
        except ValueError as error:
            reason = str(error)
        start = at
        at = _next_start(data, at + 1)
        while at < len(data):
            try:
                _record_at(data, at)
                break
            except ValueError:
                at = _next_start(data, at + 1)
        yield start, at - start, None, b"", reason


def write_warc(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    body_col: str = "html",
    path: str | None = None,
    revisit_bytes: int = REVISIT_BYTES,
) -> DataFrame:
    """Write one record per row into gzip archives; returns the manifest.

    Of equal payloads of ``revisit_bytes`` or more, the row with the largest id is
    the response and the others revisit it; smaller payloads and rows without an id
    are responses. A null body is an empty payload. Rows that repeat the largest id
    with the same payload are responses all. Only files in the manifest (``file``,
    ``n_records``) count: a lost or repeated task leaves its own, unlisted files.
    """
    spark = pages.sparkSession
    root = path or work_path(spark)
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).alias("url"),
        F.coalesce(F.col(body_col).cast("binary"), F.lit(b"")).alias("payload"),
    )
    large = F.octet_length("payload") >= revisit_bytes
    narrow = rows.where(large & F.col("page_id").isNotNull()).select(
        "page_id", F.sha1("payload").alias("digest")
    )
    # Partial sums make one row per payload and task, however many copies there are.
    repeated = (
        narrow.groupBy("digest")
        .agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
        .drop("copies")
    )
    revisits = (
        narrow.join(repeated, "digest")
        .where("page_id < refers_to")
        .select("page_id", F.col("digest").alias("of_digest"), "refers_to")
        .distinct()
    )
    marked = rows.withColumn("digest", F.sha1("payload")).join(
        revisits.withColumnRenamed("of_digest", "digest"), ["page_id", "digest"], "left"
    )
    date = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    columns = ("page_id", "url", "payload", "digest", "refers_to")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, stream = [], None
        for batch in batches:
            for row in zip(*[batch.column(name) for name in columns]):
                page_id, url, payload, digest, refers_to = [value.as_py() for value in row]
                if stream is None:
                    files.append([f"{root}/{attempt_name(len(files), '.warc.gz')}", 0])
                    stream = open_output(files[-1][0])
                revisit = refers_to is not None
                record = format_record(page_id, url, payload, digest, refers_to, revisit, date)
                stream.write(gzip_member(record))
                files[-1][1] += 1
                if stream.tell() >= FILE_BYTES:
                    stream.close()
                    stream = None
        if stream is not None:
            stream.close()
        if files:
            names, counts = zip(*files)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(counts, pa.int64())],
                names=["file", "n_records"],
            )

    return work_table(marked.mapInArrow(write, "file string, n_records long"))


def read_warc(
    spark: SparkSession, files: list[str] | str, manifest: DataFrame | None = None
) -> DataFrame:
    """The records of archives (paths, folders or globs), and the gaps between them.

    With a ``manifest`` of :func:`write_warc`, only the files it lists are read.

    A gap has ``record_type`` null and its reason in ``gap``; ``offset`` and
    ``length`` are the bytes it covers. Files that end in ``.gz`` hold a gzip
    member per record; plain archives may be mixed in. A revisit has an empty
    payload and the digest and size of the one it refers to.
    """
    contents = spark.read.format("binaryFile").load(files).select("path", "content")
    if manifest is not None:
        base = F.element_at(F.split("file", "/"), -1)
        names, _ = broadcast_if_bounded(manifest.select(base.alias("_name")).distinct())
        name = F.element_at(F.split("path", "/"), -1)
        contents = contents.join(names, name == names["_name"], "left_semi")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("path"), batch.column("content")):
                rows, size, name = [], 0, file.as_py()
                for offset, length, headers, block, reason in salvage(content.as_py()):
                    rows.append(_row(name, offset, length, headers, block, reason))
                    size += len(block)
                    if size > 4 << 20:
                        yield _batch(rows)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows)

    return contents.mapInArrow(read, RECORD_SCHEMA)


def _row(file, offset, length, headers, block, reason):
    if headers is None:
        return (file, offset, length, *[None] * 8, reason)
    name = headers.get("warc-record-id", "")
    number = name.removeprefix("<urn:page:").removesuffix(">")
    digest = headers.get("warc-payload-digest", "").removeprefix("sha1:")
    size = headers.get("x-payload-length", "")
    return (
        file,
        offset,
        length,
        headers.get("warc-type"),
        name,
        headers.get("warc-target-uri"),
        int(number) if number.lstrip("-").isdigit() else None,
        headers.get("warc-refers-to"),
        digest or None,
        int(size) if size.isdigit() else len(block),
        block,
        None,
    )


def _batch(rows) -> pa.RecordBatch:
    arrays = [pa.array(values, kind) for values, kind in zip(zip(*rows), _TYPES)]
    return pa.RecordBatch.from_arrays(arrays, names=_NAMES)
