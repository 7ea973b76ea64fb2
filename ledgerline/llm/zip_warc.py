"""WARC records in ZIP-packaged archives: written once, read by range without extraction.

An archive is a ZIP file with two stored members, ``archive/data.warc.gz`` (each
record a gzip member of its own) and ``indexes/index.cdxj`` (a line per record with
its place in the data).  The reader finds the members by the central directory,
ZIP64 included, and then reads single records by offset and length.

Files are reached through ``pyarrow.fs``, so their folder may be any URI that it
opens and that all executors share.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import materialize, scratch_path

REVISIT_BYTES = 1000  # payloads below are always written in full
ARCHIVE_BYTES = 64 << 20  # a task starts another archive beyond
RANGE_BYTES = 4 << 20  # records read by one row of the reading plan
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
DATE = "2024-01-01T00:00:00Z"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# Fixed values of the ZIP format: signatures, and the marks of 64-bit fields.
END, END64, LOCATOR64 = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
CENTRAL, LOCAL = b"PK\x01\x02", b"PK\x03\x04"
BIG16, BIG32, EXTRA64 = 0xFFFF, 0xFFFFFFFF, 1


# --- records ---------------------------------------------------------------


def _record_id(page_id: int | None, url: str | None, sha1: bytes) -> str:
    if page_id is not None:
        return f"urn:x-page:{page_id}"
    return uuid.uuid5(uuid.NAMESPACE_URL, f"{url} {sha1.hex()}").urn


def _page_of(record_id: str | None) -> int | None:
    found = re.fullmatch(r"<?urn:x-page:(-?\d+)>?", record_id or "")
    return int(found[1]) if found else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record: a response, or a revisit of the page that holds the payload."""
    sha1 = hashlib.sha1(payload).digest()
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    head = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": f"<{_record_id(page_id, url, sha1)}>",
        "WARC-Date": DATE,
        # A header is one line: line breaks and other controls are percent-encoded.
        "WARC-Target-URI": None
        if url is None
        else re.sub(r"[\x00-\x1f\x7f%]", lambda m: f"%{ord(m[0]):02X}", url),
        "WARC-Payload-Digest": f"sha1:{base64.b32encode(sha1).decode()}",
        "Content-Type": "application/http; msgtype=response",
    }
    if refers_to is not None:
        head |= {
            "WARC-Refers-To": f"<{_record_id(refers_to, None, sha1)}>",
            "WARC-Profile": IDENTICAL,
        }
    block = http + (payload if refers_to is None else b"")
    head["Content-Length"] = str(len(block))
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items() if v is not None)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def _headers(raw: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in raw.decode("utf-8").split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs if name}


def parsed(raw: bytes) -> dict:
    """A record's row; a response whose payload does not have its digest is refused."""
    if not raw.startswith(b"WARC/"):
        raise ValueError("no WARC record here")
    head, _, rest = raw.partition(b"\r\n\r\n")
    warc = _headers(head)
    block = rest[: int(warc["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    sha1 = base64.b32decode(warc["warc-payload-digest"].removeprefix("sha1:")).hex()
    revisit = warc["warc-type"] == "revisit"
    if not revisit and hashlib.sha1(payload).hexdigest() != sha1:
        raise ValueError(f"{warc['warc-record-id']}: the payload does not match its digest")
    url = warc.get("warc-target-uri")
    if url is not None:
        url = re.sub(r"%([01][0-9A-F]|7F|25)", lambda m: chr(int(m[1], 16)), url)
    return {
        "page_id": _page_of(warc["warc-record-id"]),
        "url": url,
        "payload_bytes": int(_headers(http)["content-length"]),
        "payload_digest": sha1,
        "record_type": warc["warc-type"],
        "refers_to": _page_of(warc.get("warc-refers-to")),
        "payload": None if revisit else payload,
    }


# --- the ZIP directory -----------------------------------------------------


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    compressed: int
    size: int
    header: int  # offset of the local header


def _read(file: pa.NativeFile, offset: int, length: int) -> bytes:
    file.seek(offset)
    found = file.read(length)
    if len(found) != length:
        raise ValueError("the archive ends too early")
    return found


def members(file: pa.NativeFile) -> list[Member]:
    """The members by the central directory, read from the end of the file."""
    length = file.size()
    tail_at = max(0, length - 22 - BIG16)  # the end record with the longest comment
    tail = _read(file, tail_at, length - tail_at)
    at = tail.rfind(END, 0, max(0, len(tail) - 18))  # whole records only
    # A comment may hold the signature; the true record's comment ends the file.
    while at >= 0 and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail):
        at = tail.rfind(END, 0, at)
    if at < 0:
        raise ValueError("no end of a central directory")
    count, size, start = struct.unpack_from("<HII", tail, at + 10)
    locator = tail_at + at - 20
    if locator >= 0 and (raw := _read(file, locator, 20)).startswith(LOCATOR64):
        end64 = _read(file, struct.unpack_from("<Q", raw, 8)[0], 56)
        if not end64.startswith(END64):
            raise ValueError("no ZIP64 end record where its locator points")
        count, size, start = struct.unpack_from("<QQQ", end64, 32)
    directory, out, at = _read(file, start, size), [], 0
    for _ in range(count):
        if directory[at : at + 4] != CENTRAL:
            raise ValueError("the central directory is broken")
        method, compressed, plain = struct.unpack_from("<10xH8xII", directory, at)
        n_name, n_extra, n_comment = struct.unpack_from("<HHH", directory, at + 28)
        (header,) = struct.unpack_from("<I", directory, at + 42)
        name = directory[at + 46 : at + 46 + n_name].decode("utf-8")
        extra = directory[at + 46 + n_name : at + 46 + n_name + n_extra]
        wide = _extra64(extra)
        # The 64-bit values follow in this order, each only where its field is full.
        plain, compressed, header = (
            struct.unpack("<Q", wide.read(8))[0] if field == BIG32 else field
            for field in (plain, compressed, header)
        )
        out.append(Member(name, method, compressed, plain, header))
        at += 46 + n_name + n_extra + n_comment
    return out


def _extra64(extra: bytes) -> pa.BufferReader:
    at = 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<HH", extra, at)
        if kind == EXTRA64:
            return pa.BufferReader(extra[at + 4 : at + 4 + length])
        at += 4 + length
    return pa.BufferReader(b"")


def data_start(file: pa.NativeFile, member: Member) -> int:
    """Where a member's bytes begin: its local header has lengths of its own."""
    local = _read(file, member.header, 30)
    if not local.startswith(LOCAL):
        raise ValueError(f"{member.name}: no local header")
    return member.header + 30 + sum(struct.unpack_from("<HH", local, 26))


# --- Spark -----------------------------------------------------------------


def _opened(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def _index_line(page_id: int | None, url: str | None, offset: int, length: int) -> bytes:
    place = {"page_id": page_id, "url": url, "offset": offset, "length": length}
    return json.dumps(place).encode() + b"\n"


def _writer(folder: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def archive(rows: Iterator[tuple]) -> Iterator[tuple[str, int]]:
        """Writes rows until the archive is large enough; a new name for each attempt."""
        system, root = _opened(folder)
        system.create_dir(root, recursive=True)
        name = f"{uuid.uuid4().hex}.zip"
        written, index = 0, []
        with (
            system.open_output_stream(f"{root}/{name}") as out,
            zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as package,
        ):
            with package.open(DATA, "w", force_zip64=True) as data:
                for page_id, url, html, refers_to in rows:
                    raw = record(page_id, url, (html or "").encode("utf-8"), refers_to)
                    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                    packed = packer.compress(raw) + packer.flush()
                    data.write(packed)
                    index.append(_index_line(page_id, url, written, len(packed)))
                    written += len(packed)
                    if written >= ARCHIVE_BYTES:
                        break
            package.writestr(INDEX, b"".join(index))
        yield f"{folder}/{name}", len(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _rows(batches, ("page_id", "url", "html", "refers_to"))
        for first in rows:
            # ``chain`` leaves ``rows`` open when an archive is full and drops it.
            for path, n in archive(chain((first,), rows)):
                yield pa.RecordBatch.from_pydict({"path": [path], "records": [n]})

    return run


def _rows(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            yield from zip(*(part.column(n).to_pylist() for n in names), strict=True)


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes ``pages`` (``page_id``, ``url``, ``html``) to archives below ``folder``.

    Of rows with equal payloads of ``REVISIT_BYTES`` or more, those with the largest
    page_id hold it and all others are revisits.  Returns ``path`` and ``records`` of
    the archives.  That table is written before it is returned: a task that is
    repeated leaves a file which no row names.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"))
    digest = F.sha1("html")
    large = rows.where(F.octet_length("html") >= REVISIT_BYTES).select(
        "page_id", digest.alias("digest")
    )
    # Only digests and ids are grouped; a table of its own lets a hot payload be split.
    heads = materialize(
        large.groupBy("digest")
        .agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n"))
        .where("n > 1 AND refers_to IS NOT NULL")
        .drop("n"),
        "payloads",
    )
    revisits = materialize(
        large.join(heads, "digest")
        .where("page_id IS NULL OR page_id < refers_to")
        .select("digest", F.col("page_id").alias("id"), "refers_to")
        .distinct(),
        "revisits",
    )
    whole = rows.withColumn("sha1", digest)
    held = whole.join(
        revisits,
        whole["page_id"].eqNullSafe(revisits["id"]) & (whole["sha1"] == revisits["digest"]),
        "left",
    ).select("page_id", "url", "html", "refers_to")
    archives = materialize(held.mapInArrow(_writer(folder), "path string, records long"), "archives")
    written, given = archives.agg(F.sum("records")).first()[0] or 0, rows.count()
    if written != given:
        raise RuntimeError(f"{written} records were written for {given} pages")
    return archives


def _located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges of records: where each starts in the file, and the lengths of its records."""
    for (uri,) in _rows(batches, ("path",)):
        system, path = _opened(uri)
        with system.open_input_file(path) as file:
            found = {m.name: m for m in members(file)}
            data, index = found[DATA], found[INDEX]
            if data.method or index.method:
                raise ValueError(f"{uri}: members are compressed, not stored")
            base = data_start(file, data)
            places = _read(file, data_start(file, index), index.size).splitlines()
        begin, length, lengths, out = 0, 0, [], []
        for place in map(json.loads, places):
            if place["offset"] != begin + length:
                raise ValueError(f"{uri}: the index leaves a gap")
            if length >= RANGE_BYTES:
                out.append((uri, base + begin, lengths))
                begin, length, lengths = begin + length, 0, []
            lengths.append(place["length"])
            length += place["length"]
        if lengths:
            out.append((uri, base + begin, lengths))
        if out:
            paths, starts, sizes = (list(x) for x in zip(*out))
            yield pa.RecordBatch.from_pydict({"path": paths, "start": starts, "lengths": sizes})


_RECORD = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload", pa.binary()),
    ]
)
_RECORD_DDL = (
    "page_id long, url string, payload_bytes long, payload_digest string, "
    "record_type string, refers_to long, payload binary"
)


def _reader(keep_payload: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for uri, start, lengths in _rows(batches, ("path", "start", "lengths")):
            system, path = _opened(uri)
            out = []
            with system.open_input_file(path) as file:
                held = memoryview(_read(file, start, sum(lengths)))
            for length in lengths:
                row = parsed(zlib.decompress(held[:length], 31))
                out.append(row if keep_payload else row | {"payload": None})
                held = held[length:]
            yield pa.RecordBatch.from_pylist(out, schema=_RECORD)

    return run


def read_archives(
    spark: SparkSession, archives: DataFrame, *, keep_payload: bool = True
) -> DataFrame:
    """The records of the archives that ``archives`` names in ``path``.

    One task reads the directory and index of an archive; its records are then
    dealt out in ranges of some ``RANGE_BYTES``, and each range is read where the
    directory says it is.
    """
    ranges = archives.select("path").mapInArrow(
        _located, "path string, start long, lengths array<long>"
    )
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = ranges.repartition(partitions, "path", "start")
    return dealt.mapInArrow(_reader(keep_payload), _RECORD_DDL)


def archive_round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes the pages to archives and reads them back.

    One row per row of ``pages``: ``page_id``, ``payload_bytes``,
    ``payload_digest`` (SHA-1 in hex), ``record_type``, ``refers_to``, all as read
    from the archives.  A null html is an empty payload.  Rows that repeat a page_id
    with the same payload have the same type.  A null page_id is less than any
    other; among equal payloads without any page_id each is a response.  A null url
    writes no target URI.  A very long html is one record, which a task holds whole.
    Other columns are ignored.  An empty table writes no archive and gives no rows.  ``folder`` must be shared by all executors; by
    default it is a new one in the scratch folder.
    """
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    found = read_archives(spark, write_archives(pages, folder), keep_payload=False)
    return found.drop("url", "payload")
