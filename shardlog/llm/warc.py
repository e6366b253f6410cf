"""WARC records in ZIP packages, and a reader that takes records out by range reads.

A package is a ZIP file whose members are stored, not compressed: ``archive/data.warc.gz`` (one gzip member per WARC/1.1 record) and
``indexes/index.cdxj`` (one line per record: page id, then JSON with offset and length inside the archive member). The reader opens a
package by its last bytes (end-of-directory record and, where present, the ZIP64 locator and record), walks the central directory,
turns each stored member into a byte range of the package, reads the index, and then reads one range per record. Nothing is
extracted and no member is read whole except the index.

Packages are written by the tasks into the shared folder through pyarrow's file systems, under a name of their own for each attempt;
the manifest that is returned names only those of tasks that succeeded, so files of lost executors are never read.

Of rows with equal payloads of at least ``least`` bytes, the one with the smallest page id is the response and the others are
revisits of it. Only digests, sizes and ids are grouped (a partial minimum first); payloads move once, to join with what they revisit.

Edge cases: null html is an empty payload; rows that share the smallest page id of a payload are all responses; null page ids sort
last and, when a payload has no other id, are responses; an empty table gives no packages; other columns are neither read nor kept.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import struct
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import Scratch, partitions

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
NO_DATE = "1970-01-01T00:00:00Z"


def digest(payload: bytes) -> str:
    """Base32 SHA-1, upper case, bare."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# ---- writing


def _one_line(s: str) -> str:
    return " ".join(s.split())


def record(page_id: int | None, url: str | None, payload: bytes, revisits: int | None) -> bytes:
    """One WARC/1.1 record. A revisit carries no payload but the digest and size of the one that it stands for."""
    name = "none" if page_id is None else page_id
    head = [("WARC-Type", "response" if revisits is None else "revisit"), ("WARC-Record-ID", f"<urn:page:{name}>"), ("WARC-Target-URI", _one_line(url) if url else f"urn:page:{name}"), ("WARC-Date", NO_DATE), ("WARC-Payload-Digest", f"sha1:{digest(payload)}")]
    if revisits is not None:
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", f"<urn:page:{revisits}>"), ("X-Payload-Length", str(len(payload)))]
        block = b"HTTP/1.1 200 OK\r\n\r\n"
    else:
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload
    head += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode("utf-8", "surrogatepass") + b"\r\n" + block + b"\r\n\r\n"


class _Out(io.RawIOBase):
    """A pyarrow output stream as an unseekable file for zipfile."""

    def __init__(self, stream):
        self.stream, self.at = stream, 0

    def writable(self) -> bool:
        return True

    def write(self, b) -> int:
        self.stream.write(b)
        self.at += len(b)
        return len(b)

    def tell(self) -> int:
        return self.at

    def seekable(self) -> bool:
        return False


def _fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder that Spark names: s3a and s3n are s3, gcs is gs; what pyarrow has no file system for is refused."""
    scheme, colon, rest = uri.partition("://")
    uri = {"s3a": "s3", "s3n": "s3", "gcs": "gs"}.get(scheme, scheme) + colon + rest if colon else uri
    try:
        return pafs.FileSystem.from_uri(uri)
    except pa.ArrowInvalid as e:
        raise ValueError(f"packages can't be kept at {uri}: spark.checkpoint.dir must be a path, file:, hdfs:, viewfs:, s3:, s3a:, gs: or abfss:") from e


class PackageWriter:
    """Streams one package: each record is compressed and passed on at once, only index lines stay in memory."""

    def __init__(self, uri: str, zip64: bool = True):
        fs, path = _fs(uri)
        fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.uri, self.stream = uri, fs.open_output_stream(path)
        self.zip = zipfile.ZipFile(_Out(self.stream), "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(zipfile.ZipInfo(ARCHIVE), "w", force_zip64=zip64)
        self.at, self.lines = 0, []

    def add(self, page_id, url, payload: bytes, revisits) -> None:
        z = gzip.compress(record(page_id, url, payload, revisits), 6, mtime=0)
        self.member.write(z)
        self.lines.append(f"{'-' if page_id is None else page_id} {json.dumps({'offset': self.at, 'length': len(z)})}\n")
        self.at += len(z)

    def close(self) -> tuple[str, int]:
        self.member.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX), "".join(self.lines))
        self.zip.close()
        self.stream.close()
        return self.uri, len(self.lines)


# ---- reading


class Package:
    """Range reader over a ZIP package. file: anything with seek, read and size."""

    def __init__(self, file, size: int):
        self.file, self.size = file, size
        self.members = dict(self._directory())

    @classmethod
    def open(cls, uri: str) -> Package:
        fs, path = _fs(uri)
        f = fs.open_input_file(path)
        return cls(f, f.size())

    def read(self, at: int, n: int) -> bytes:
        if at < 0 or n < 0 or at + n > self.size:
            raise ValueError(f"range {at}+{n} lies outside the package of {self.size} bytes")
        self.file.seek(at)
        return self.file.read(n)

    def _directory(self) -> Iterator[tuple[str, tuple[int, int]]]:
        """Stored members: name -> (offset of the data, size)."""
        tail_at = max(0, self.size - 22 - 65535)
        tail = self.read(tail_at, self.size - tail_at)
        end = tail.rfind(b"PK\x05\x06")
        while end >= 0 and end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail):
            end = tail.rfind(b"PK\x05\x06", 0, end)  # the signature may also occur in a comment
        if end < 0:
            raise ValueError("no end of central directory")
        count, length, start = struct.unpack_from("<HII", tail, end + 10)
        if 0xFFFF == count or 0xFFFFFFFF in (length, start):
            where = tail_at + end - 20
            sig, _, at, _ = struct.unpack("<4sIQI", self.read(where, 20))
            if sig != b"PK\x06\x07":
                raise ValueError("no ZIP64 locator")
            sig, *_, count, length, start = struct.unpack("<4sQHHIIQQQQ", self.read(at, 56))
            if sig != b"PK\x06\x06":
                raise ValueError("no ZIP64 end of central directory")
        entries, at = self.read(start, length), 0
        for _ in range(count):
            (sig, _, _, flags, method, _, _, _, packed, size, n, x, c, _, _, _, local) = struct.unpack_from("<4sHHHHHHIIIHHHHHII", entries, at)
            if sig != b"PK\x01\x02":
                raise ValueError("damaged central directory")
            name, extra = entries[at + 46 : at + 46 + n], entries[at + 46 + n : at + 46 + n + x]
            at += 46 + n + x + c
            if 0xFFFFFFFF in (packed, size, local):
                size, packed, local = self._wide(extra, size, packed, local)
            if method == 0 and not flags & 1:
                sig, n, x = struct.unpack("<4s22xHH", self.read(local, 30))
                if sig != b"PK\x03\x04":
                    raise ValueError("damaged local header")
                yield name.decode("utf-8" if flags & 0x800 else "cp437"), (local + 30 + n + x, size)

    @staticmethod
    def _wide(extra: bytes, *values: int) -> list[int]:
        """ZIP64 extra field: one 64-bit number for each 32-bit one that is full."""
        at = 0
        while at + 4 <= len(extra):
            kind, n = struct.unpack_from("<HH", extra, at)
            if kind == 1:
                wide = iter(struct.unpack_from(f"<{n // 8}Q", extra, at + 4))
                return [next(wide) if v == 0xFFFFFFFF else v for v in values]
            at += 4 + n
        raise ValueError("no ZIP64 field where one is needed")

    def index(self) -> Iterator[tuple[int | None, int, int]]:
        for name, (at, size) in self.members.items():
            if name.startswith("indexes/") and name.endswith(".cdxj"):
                for line in self.read(at, size).decode().splitlines():
                    key, _, rest = line.partition(" ")
                    where = json.loads(rest)
                    yield None if key == "-" else int(key), where["offset"], where["length"]

    def record(self, offset: int, length: int, member: str = ARCHIVE) -> tuple[dict[str, str], bytes]:
        """Header fields and payload (what follows the HTTP header) of the record at a range of an archive member."""
        at, size = self.members[member]
        if offset + length > size:
            raise ValueError("record lies outside its member")
        raw = gzip.decompress(self.read(at + offset, length))
        head, _, body = raw.partition(b"\r\n\r\n")
        version, *lines = head.decode("utf-8", "surrogatepass").split("\r\n")
        if not version.startswith("WARC/1."):
            raise ValueError("not a WARC record")
        fields = dict(x.split(": ", 1) for x in lines)
        block = body[: int(fields["Content-Length"])]
        return fields, block.partition(b"\r\n\r\n")[2]


# ---- on tables


def with_revisits(pages: DataFrame, least: int = 0) -> DataFrame:
    """page_id, url, html, refers_to: refers_to is null for responses."""
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    light = p.select("page_id", F.sha1(F.col("html").cast("binary")).alias("sha"), F.octet_length("html").alias("n")).where(F.col("n") >= least)
    first = light.groupBy("sha", "n").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("rows")).where("rows > 1 and first is not null").select("sha", "n", "first")
    # The join is on the payload's digest: a large group of copies is a hot key of an ordinary join, which Spark splits.
    d = p.withColumn("sha", F.sha1(F.col("html").cast("binary"))).withColumn("n", F.octet_length("html")).join(first, ["sha", "n"], "left")
    return d.select("page_id", "url", "html", F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first")).alias("refers_to"))


def write(pages: DataFrame, folder: str, least: int = 0, package_bytes: int = 64 << 20) -> DataFrame:
    """Writes packages of about package_bytes of payload into folder; returns path, records."""

    def run(batches):
        out, size, made = None, 0, []
        for b in batches:
            for page_id, url, html, revisits in zip(*(c.to_pylist() for c in b.columns), strict=True):
                payload = html.encode("utf-8", "surrogatepass")
                if out is None:
                    out, size = PackageWriter(f"{folder}/{uuid.uuid4().hex}.wacz"), 0
                out.add(page_id, url, payload, revisits)
                size += len(payload)
                if size >= package_bytes:
                    made.append(out.close())
                    out = None
        if out is not None:
            made.append(out.close())
        yield pa.RecordBatch.from_arrays([pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.int64())], ["path", "records"])

    return with_revisits(pages, least).mapInArrow(run, "path string, records long")


def read(manifest: DataFrame, batch: int = 1000) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record of the packages named in manifest.path."""
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def page(urn: str) -> int | None:
        at = urn.strip("<>").rsplit(":", 1)[-1]
        return None if at == "none" else int(at)

    def run(batches):
        for b in batches:
            for path in b.column(0).to_pylist():
                package, rows = Package.open(path), []
                for page_id, offset, length in package.index():
                    fields, payload = package.record(offset, length)
                    kind = fields["WARC-Type"]
                    said = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    if page(fields["WARC-Record-ID"]) != page_id or kind == "response" and digest(payload) != said:
                        raise ValueError(f"{path}: record at {offset} does not match its index or digest")
                    rows.append((page_id, len(payload), said, kind, None) if kind == "response" else (page_id, int(fields["X-Payload-Length"]), said, kind, page(fields["WARC-Refers-To"])))
                    if len(rows) >= batch:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    return manifest.select("path").repartition(partitions(manifest.sparkSession), "path").mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def round_trip(pages: DataFrame, least: int = 0) -> DataFrame:
    """Writes pages into packages in the shared folder and reads them back."""
    scratch = Scratch(pages.sparkSession, "warc")
    return read(scratch.save(write(pages, scratch.path("packages"), least), "manifest"))
