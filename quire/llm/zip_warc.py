"""WARC records in ZIP packages, read by range without extraction.

Writing: every task packs its records into archives of its own, in the shared
folder. An archive is a ZIP file whose members are stored, not deflated:
``archive/<n>.warc.gz`` hold some megabytes of records each (every record is
one gzip member), ``indexes/index.tsv`` has member, offset and length of every
record in order. The directory is written in its ZIP64 form. A task that is run
again writes files of new names; the table of archives lists those of the
attempts that ended.

Reading: the tail of a file gives the end-of-directory record and, through its
locator, the ZIP64 one; the central directory gives the members. The index is
read by its range and cut into ranges of consecutive records; ranges are dealt
out over the tasks, so one large archive is read by many. A task reads its range
of bytes and decodes the records one by one. Members without an index entry are
read whole in bounded steps, so archives of other writers can be read too;
archive members must be stored (``.warc.gz`` or ``.warc``).

Payloads are compared by length and SHA-1 over the whole table. Of equal payloads of at least
``min_bytes`` bytes the row of the smallest id is the response, the others are
revisits that name it and hold no payload; smaller ones are all responses. The
most frequent payloads are joined by broadcast, so no task meets a hot one.

A null payload is empty. Null ids come after all others and are named by no
revisit (their refers_to is null); among repeated rows of the smallest id one is
the response, the others revisit it. Control characters, spaces and non-ASCII
characters of a URL are percent-encoded in the archive; a null URL is left out.
An empty table writes no archive. Other columns are ignored.

Archives are opened through ``pyarrow.fs``: any folder it knows by its URI can
hold them (local or mounted paths, S3, GCS, HDFS).
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import join_counted, written
from quire.session import checkpoint_dir

MEMBER_BYTES = 8 << 20
ARCHIVE_BYTES = 256 << 20
#: Bytes of records read at once; a longer record is read alone.
RANGE_BYTES = 4 << 20
#: Bytes of archives read by a task.
TASK_BYTES = 64 << 20
GZIP_LEVEL = 3
DATE = "2000-01-01T00:00:00Z"
INDEX = "indexes/index.tsv"

# Fixed values of the ZIP format: signatures, the largest values of 16 and 32 bits, and the
# fields of each record.
LOCAL, CENTRAL, END, END64, LOCATOR = b"PK\3\4", b"PK\1\2", b"PK\5\6", b"PK\6\6", b"PK\6\7"
MAX16, MAX32 = 0xFFFF, 0xFFFFFFFF
LOCAL_FIELDS = struct.Struct("<4s5H3I2H")
CENTRAL_FIELDS = struct.Struct("<4s6H3I5H2I")
END_FIELDS = struct.Struct("<4s4H2IH")
END64_FIELDS = struct.Struct("<4sQ2H2I4Q")
LOCATOR_FIELDS = struct.Struct("<4sIQI")
ZIP64_EXTRA = 1
#: 1980-01-01, the format's first day, as its date field; version 4.5 reads ZIP64.
FIRST_DAY, VERSION, UTF8_NAMES = 0x21, 45, 0x800

ReadAt = Callable[[int, int], bytes]


# ---- ZIP --------------------------------------------------------------------------

class ZipWriter:
    """Stored members, one after the other, into a byte stream; ZIP64 directory."""

    def __init__(self, stream):
        self.stream, self.at, self.directory = stream, 0, []

    def add(self, name: str, data: bytes) -> None:
        raw, crc = name.encode(), zlib.crc32(data)
        large = len(data) >= MAX32
        extra = struct.pack("<2H2Q", ZIP64_EXTRA, 16, len(data), len(data)) if large else b""
        size = MAX32 if large else len(data)
        self.directory.append((raw, crc, len(data), self.at))
        self._put(LOCAL_FIELDS.pack(LOCAL, VERSION, UTF8_NAMES, 0, 0, FIRST_DAY, crc, size, size, len(raw), len(extra)) + raw + extra)
        self._put(data)

    def close(self) -> int:
        """Write the directory; returns the size of the file."""
        first = self.at
        for name, crc, size, at in self.directory:
            extra = struct.pack("<2H3Q", ZIP64_EXTRA, 24, size, size, at)
            self._put(CENTRAL_FIELDS.pack(CENTRAL, VERSION, VERSION, UTF8_NAMES, 0, 0, FIRST_DAY, crc, MAX32, MAX32, len(name), len(extra), 0, 0, 0, 0, MAX32) + name + extra)
        end, n = self.at, len(self.directory)
        self._put(END64_FIELDS.pack(END64, END64_FIELDS.size - 12, VERSION, VERSION, 0, 0, n, n, end - first, first))
        self._put(LOCATOR_FIELDS.pack(LOCATOR, 0, end, 1))
        self._put(END_FIELDS.pack(END, 0, 0, MAX16, MAX16, MAX32, MAX32, 0))
        return self.at

    def _put(self, data: bytes) -> None:
        self.stream.write(data)
        self.at += len(data)


class Member(NamedTuple):
    name: str
    method: int
    size: int
    local: int

    def start(self, read_at: ReadAt) -> int:
        """Offset of the member's data in the file."""
        head = LOCAL_FIELDS.unpack(read_at(self.local, LOCAL_FIELDS.size))
        if head[0] != LOCAL:
            raise ValueError(f"no member at {self.local}")
        return self.local + LOCAL_FIELDS.size + head[-2] + head[-1]


def directory_place(read_at: ReadAt, size: int) -> tuple[int, int]:
    """(offset, bytes) of the central directory."""
    for reach in (END_FIELDS.size, END_FIELDS.size + MAX16):  # without and with a comment behind it
        first = max(0, size - reach)
        tail = read_at(first, size - first)
        at = tail.rfind(END)
        while at >= 0:
            if len(tail) - at >= END_FIELDS.size:
                end = END_FIELDS.unpack_from(tail, at)
                if at + END_FIELDS.size + end[-1] == len(tail):
                    return _wide(read_at, first + at) or (end[6], end[5])
            at = tail.rfind(END, 0, at)
    raise ValueError("not a ZIP file: it has no end-of-directory record")


def _wide(read_at: ReadAt, end: int) -> tuple[int, int] | None:
    """The place named by the ZIP64 record, if a locator stands before the end record."""
    if end < LOCATOR_FIELDS.size:
        return None
    sign, _, at, _ = LOCATOR_FIELDS.unpack(read_at(end - LOCATOR_FIELDS.size, LOCATOR_FIELDS.size))
    if sign != LOCATOR:
        return None
    found = END64_FIELDS.unpack(read_at(at, END64_FIELDS.size))
    if found[0] != END64:
        raise ValueError("the ZIP64 locator names no ZIP64 record")
    return found[9], found[8]


def members(read_at: ReadAt, size: int) -> list[Member]:
    """The central directory, in its own order."""
    first, n = directory_place(read_at, size)
    raw, at, out = read_at(first, n), 0, []
    while at < n:
        f = CENTRAL_FIELDS.unpack_from(raw, at)
        if f[0] != CENTRAL:
            raise ValueError(f"damaged central directory at {first + at}")
        name_end = at + CENTRAL_FIELDS.size + f[10]
        name, extra = raw[at + CENTRAL_FIELDS.size:name_end], raw[name_end:name_end + f[11]]
        # the ZIP64 field holds only the values that are at their limit, in this order
        wide = _zip64_values(extra)
        plain, packed, local = (next(wide) if v == MAX32 else v for v in (f[9], f[8], f[16]))
        out.append(Member(name.decode("utf-8" if f[3] & UTF8_NAMES else "cp437"), f[4], packed if f[4] else plain, local))
        at = name_end + f[11] + f[12]
    return out


def _zip64_values(extra: bytes) -> Iterator[int]:
    at = 0
    while at + 4 <= len(extra):
        kind, n = struct.unpack_from("<2H", extra, at)
        if kind == ZIP64_EXTRA:
            yield from struct.unpack_from(f"<{n // 8}Q", extra, at + 4)
        at += 4 + n


# ---- WARC ---------------------------------------------------------------------------

class Record(NamedTuple):
    kind: str
    record_id: str | None
    url: str | None
    refers_to: str | None
    payload_bytes: int
    payload_digest: str
    payload: bytes | None


def base32(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def urn(page: str | None) -> str:
    return f"<urn:page:{quote(page, safe='')}>" if page is not None else "<urn:page>"


def page_of(name: str | None) -> str | None:
    """The id in a record's name; None where it has none."""
    name = (name or "").strip("<>")
    return unquote(name[len("urn:page:"):]) if name.startswith("urn:page:") else None


def record_bytes(page: str | None, url: str | None, payload: bytes | None, n_bytes: int, digest: str, refers_to: str | None, revisit: bool) -> bytes:
    """One WARC record as one gzip member; ``payload`` is None for a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    block = http + (payload or b"")
    head = [f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {urn(page)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=_URL)}")
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {urn(refers_to)}"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    data = ("WARC/1.1\r\n" + "\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"
    packer = zlib.compressobj(GZIP_LEVEL, wbits=31)
    return packer.compress(data) + packer.flush()


_URL = "".join(chr(c) for c in range(0x21, 0x7F))


def fields(head: bytes) -> dict[str, str]:
    """Header lines by lower-cased name; the first line is left out."""
    rows = (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {k.strip().lower(): v.strip() for k, sep, v in rows if sep}


def parse(data: bytes) -> Record | None:
    """A response or revisit of an unpacked record; None for other kinds."""
    end = data.index(b"\r\n\r\n")
    warc = fields(data[:end])
    kind = warc.get("warc-type")
    if kind not in ("response", "revisit"):
        return None
    block = data[end + 4:end + 4 + int(warc["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    named = warc.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind == "revisit":
        return Record(kind, page_of(warc.get("warc-record-id")), warc.get("warc-target-uri"), page_of(warc.get("warc-refers-to")),
                      int(fields(http).get("content-length", 0)), named, None)
    digest = base32(hashlib.sha1(payload).hexdigest())
    if named and named != digest:
        raise ValueError(f"record {warc.get('warc-record-id')}: its payload is not the one of its digest")
    return Record(kind, page_of(warc.get("warc-record-id")), warc.get("warc-target-uri"), None, len(payload), digest, payload)


def unpacked(data: bytes) -> bytes:
    return zlib.decompress(data, 31) if data[:2] == b"\x1f\x8b" else data


def scan(read_at: ReadAt, start: int, size: int, step: int = 1 << 16) -> Iterator[bytes]:
    """The unpacked records of a member that no index cuts, holding one record at a time."""
    at, end, buffer, packer = start, start + size, b"", None
    if read_at(start, min(2, size)) == b"\x1f\x8b":
        record = bytearray()
        while at < end or buffer:
            if not buffer:
                buffer = read_at(at, min(step, end - at))
                at += len(buffer)
            packer = packer or zlib.decompressobj(31)
            record += packer.decompress(buffer)
            buffer = packer.unused_data
            if packer.eof:
                yield bytes(record)
                record, packer = bytearray(), None
        return
    while at < end:
        head = b""
        while b"\r\n\r\n" not in head and at + len(head) < end:
            head += read_at(at + len(head), min(step, end - at - len(head)))
        cut = head.index(b"\r\n\r\n") + 4
        length = cut + int(fields(head[:cut - 4])["content-length"])
        yield head[:length] if len(head) >= length else read_at(at, length)
        at += length + 4


# ---- Spark ----------------------------------------------------------------------------

def located(uri: str):
    """(file system, path) of a folder or file."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("/") else uri.replace("file:", "file://", 1))


def opened(uri: str) -> tuple[ReadAt, int]:
    files, path = located(uri)
    f = files.open_input_file(path)

    def read_at(at: int, n: int) -> bytes:
        f.seek(at)
        return f.read(n)

    return read_at, f.size()


class ArchiveWriter:
    """Records of one task into archives of bounded size; ``done`` has (path, bytes, records)."""

    def __init__(self, folder: str, archive_bytes: int, member_bytes: int):
        self.files, self.folder = located(folder)
        self.uri, self.limit, self.member_bytes = folder, archive_bytes, member_bytes
        self.done: list[tuple[str, int, int]] = []
        self.zip = None

    def add(self, record: bytes) -> None:
        if self.zip is None:
            self.name = f"{uuid.uuid4().hex}.wacz"
            self.files.create_dir(self.folder, recursive=True)
            self.stream = self.files.open_output_stream(f"{self.folder}/{self.name}")
            self.zip, self.index, self.n = ZipWriter(self.stream), [], 0
            self.member, self.filled = [], 0
        self.index.append(f"archive/{self.n:05d}.warc.gz\t{self.filled}\t{len(record)}\n")
        self.member.append(record)
        self.filled += len(record)
        if self.filled >= self.member_bytes:
            self._end_member()
            if self.zip.at >= self.limit:
                self.close()

    def _end_member(self) -> None:
        if self.member:
            self.zip.add(f"archive/{self.n:05d}.warc.gz", b"".join(self.member))
            self.n, self.member, self.filled = self.n + 1, [], 0

    def close(self) -> None:
        if self.zip is not None:
            self._end_member()
            self.zip.add(INDEX, "".join(self.index).encode())
            self.done.append((f"{self.uri}/{self.name}", self.zip.close(), len(self.index)))
            self.stream.close()
            self.zip = None


def typed_rows(pages: DataFrame, id_col: str, url_col: str, payload_col: str, min_bytes: int) -> DataFrame:
    """(id, url, payload, bytes, digest, refers_to, revisit) of every row; ids as text,
    no payload for revisits."""
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = written(pages.select(F.monotonically_increasing_id().alias("num"), F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
                   .withColumns({"digest": F.sha1("payload"), "bytes": F.octet_length("payload").cast("long")}), "pages", compression="zstd")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "num")).alias("first")
    equal = rows.filter(F.col("bytes") >= min_bytes).groupBy("digest", "bytes").agg(first, F.count(F.lit(1)).alias("n")).filter("n > 1")
    equal = written(equal, "equal-payloads")
    met = join_counted(rows, equal, ["digest", "bytes"], "n", "left")
    revisit = F.coalesce(F.col("num") != F.col("first.num"), F.lit(False))
    return met.select(F.col("id").cast("string").alias("id"), "url", F.when(~revisit, F.col("payload")).alias("payload"), "bytes", "digest",
                      F.when(revisit, F.col("first.id").cast("string")).alias("refers_to"), revisit.alias("revisit"))


def write_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0,
                   archive_bytes: int = ARCHIVE_BYTES, member_bytes: int = MEMBER_BYTES, folder: str | None = None) -> DataFrame:
    """Write a record per row into ZIP archives below ``folder`` (the shared checkpoint folder
    if not given); returns the table (path, bytes, records) of the archives."""
    folder = folder or f"{checkpoint_dir(pages.sparkSession).rstrip('/')}/llm/warc-{uuid.uuid4().hex[:12]}"

    def run(batches):
        out = ArchiveWriter(folder, archive_bytes, member_bytes)
        for b in batches:
            for page, url, payload, n, digest, refers_to, revisit in zip(*(c for c in b.columns), strict=True):
                out.add(record_bytes(page.as_py(), url.as_py(), payload.as_py(), n.as_py(), base32(digest.as_py()), refers_to.as_py(), revisit.as_py()))
        out.close()
        if out.done:
            path, size, n = zip(*out.done, strict=True)
            yield pa.RecordBatch.from_pydict({"path": list(path), "bytes": list(size), "records": list(n)})

    rows = typed_rows(pages, id_col, url_col, payload_col, min_bytes)
    return written(rows.mapInArrow(run, "path string, bytes long, records long"), "archives")


def ranges_of(path: str, range_bytes: int) -> Iterator[tuple[int, int, list[int] | None]]:
    """(start, bytes, record lengths) of the ranges of an archive; without lengths where a
    member has no index entry."""
    read_at, size = opened(path)
    found = {m.name: m for m in members(read_at, size)}
    data = {n: m for n, m in found.items() if n.startswith("archive/") and n.endswith((".warc", ".warc.gz"))}
    for m in data.values():
        if m.method:
            raise ValueError(f"{path}: {m.name} is not stored")
    known = {}
    if INDEX in found and not found[INDEX].method:
        m = found[INDEX]
        for line in read_at(m.start(read_at), m.size).decode().splitlines():
            name, at, n = line.split("\t")
            known.setdefault(name, []).append((int(at), int(n)))
    for name, m in data.items():
        start, rows = m.start(read_at), known.get(name)
        if rows is None:
            yield start, m.size, None
            continue
        first, lengths, filled = 0, [], 0
        for at, n in rows:
            if lengths and filled + n > range_bytes:
                yield start + first, filled, lengths
                first, lengths, filled = at, [], 0
            lengths.append(n)
            filled += n
        yield start + first, filled, lengths


def read_archives(archives: DataFrame, id_type: str = "string", payload: bool = True, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload) of every
    response and revisit of the archives (path, bytes, ...); payload is null for revisits, and
    left out if not asked for."""
    size = archives.agg(F.sum("bytes")).first()[0] or 0
    tasks = max(archives.sparkSession.sparkContext.defaultParallelism, -(-size // TASK_BYTES))

    def directories(batches):
        for b in batches:
            for path in b.column(0).to_pylist():
                found = list(ranges_of(path, range_bytes))
                if found:
                    at, n, lengths = zip(*found, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array([path] * len(at)), pa.array(at, pa.int64()), pa.array(n, pa.int64()), pa.array(lengths, pa.list_(pa.int64()))],
                                                     names=["path", "start", "bytes", "lengths"])

    def records(batches):
        for b in batches:
            for path, start, n, lengths in zip(*(c.to_pylist() for c in b.columns), strict=True):
                read_at, _ = opened(path)
                if lengths is None:
                    for data in scan(read_at, start, n):
                        yield from batch([parse(data)])
                    continue
                raw, at, held, out = memoryview(read_at(start, n)), 0, 0, []
                for k in lengths:
                    record = parse(unpacked(bytes(raw[at:at + k])))
                    out.append(record if payload or record is None else record._replace(payload=None))
                    at, held = at + k, held + (record.payload_bytes if record else 0)
                    if held > range_bytes:
                        yield from batch(out)
                        held, out = 0, []
                yield from batch(out)

    def batch(found: list[Record | None]):
        rows = [r for r in found if r is not None]
        cols = [pa.array([getattr(r, k) for r in rows], t) for k, t in kinds]
        yield pa.RecordBatch.from_arrays(cols[:len(names)], names=names)

    kinds = [("record_id", pa.string()), ("url", pa.string()), ("kind", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
             ("refers_to", pa.string()), ("payload", pa.binary())]
    schema = "page_id string, url string, record_type string, payload_bytes long, payload_digest string, refers_to string" + (", payload binary" if payload else "")
    names = [x.split()[0] for x in schema.split(", ")]
    ranges = archives.select("path").mapInArrow(directories, "path string, start long, bytes long, lengths array<long>")
    found = ranges.repartition(tasks, "path", "start").mapInArrow(records, schema)
    return found.withColumns({k: F.col(k).cast(id_type) for k in ("page_id", "refers_to")})


def archive_round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """Write all pages, read the archives back: page_id, payload_bytes, payload_digest,
    record_type, refers_to."""
    kind = pages.schema[id_col].dataType.simpleString()
    found = read_archives(write_archives(pages, id_col, url_col, payload_col, min_bytes), kind, payload=False)
    return found.select(F.col("page_id").alias(id_col), "payload_bytes", "payload_digest", "record_type", "refers_to")
