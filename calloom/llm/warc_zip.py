"""WARC records in ZIP packages: written as stored members with an index, read back by ranges without extraction.

Writing: each task streams records, gzipped one by one, into stored ZIP members, and starts a new package at
``PACKAGE_BYTES``. A package holds ``archive/data.warc.gz`` and ``indexes/index.cdxj`` (offset and length of each record
in the member). Packages have names of their own for every attempt of a task; a table of those that finished is the
manifest, so what a lost task left behind is never read.

Reading: a package's end record and, where there is one, its ZIP64 end record give the central directory, which gives the
members; the local header gives where a member's bytes begin. The index member is read by its range and makes a table of
record ranges. Ranges are dealt out anew by package and ``READ_BYTES`` of it, to as many tasks as the manifest's bytes ask
for; neighbouring records are read by one request of up to ``REQUEST_BYTES``. Members without an index are walked once to
find their records.

Of equal payloads of at least ``REVISIT_BYTES`` only the smallest key's record has the payload, others are revisits. The
smallest key comes from an aggregate, and only digests found twice or more go into the join; a digest that fills a third
of the table has its side of that join split at run time.

Packages lie under the given folder, which all executors must reach: a mounted path, or any address that Arrow's file
systems open. Defined cases: null payloads are empty; null keys are written as such, are no smallest key and always
responses; repeated rows are each written, and rows that repeat the smallest key are responses like it; an empty table
gives no package. Input columns beyond key, address and payload are not stored.
"""

from __future__ import annotations

import gzip
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from calloom.session import stage, stage_folder

REVISIT_BYTES = 100
PACKAGE_BYTES = 64 << 20
READ_BYTES = 4 << 20
REQUEST_BYTES = 1 << 20
#: Tasks that read, at most.
MOST_TASKS = 1 << 15
DATE = "1970-01-01T00:00:00Z"
MEMBER, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# --- writing -----------------------------------------------------------------------------------------------------------


def warc_record(key: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None = None) -> bytes:
    """One record; a revisit has the HTTP header alone, with the length of the payload it stands for."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{'' if key is None else key}>"),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        headers.append(("WARC-Target-URI", quote(url, safe=":/?#[]@!$&'()*+,;=-._~")))
    if refers_to is not None:
        headers += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", PROFILE)]
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in headers) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


class _Package:
    """A ZIP package that is written while its records come."""

    def __init__(self, folder: str):
        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        name = f"{uuid.uuid4().hex}.wacz"
        self.path = f"{folder}/{name}"
        self.out = system.open_output_stream(f"{root}/{name}")
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED)
        self.member = self.zip.open(zipfile.ZipInfo(MEMBER), "w", force_zip64=True)
        self.index, self.size = [], 0

    def add(self, key: int | None, record: bytes) -> None:
        data = gzip.compress(record, 1, mtime=0)
        self.member.write(data)
        self.index.append(json.dumps({"id": key, "filename": MEMBER, "offset": self.size, "length": len(data)}))
        self.size += len(data)

    def close(self) -> tuple[str, int, int]:
        self.member.close()
        with self.zip.open(zipfile.ZipInfo(INDEX), "w") as member:
            for line in self.index:
                member.write(f"page 19700101000000 {line}\n".encode())
        self.zip.close()
        self.out.close()
        return self.path, len(self.index), self.size


def write_packages(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Write one record per row; the result, (package, records, bytes), is the manifest."""
    text = F.coalesce(F.col(payload).cast("string"), F.lit(""))
    pages = pages.select(
        F.col(key).cast("long").alias("key"), F.col(url).cast("string").alias("url"), text.alias("payload"),
        F.sha2(text, 256).alias("digest"),
    )
    long = pages.filter((F.octet_length("payload") >= REVISIT_BYTES) & F.col("key").isNotNull())
    firsts = stage(
        long.groupBy("digest").agg(F.min("key").alias("first"), F.max("key").alias("last"))
        .filter("first < last").select("digest", "first")
    )
    decided = pages.join(firsts, "digest", "left").select(
        "key", "url", "payload", "digest", F.when(F.col("key") > F.col("first"), F.col("first")).alias("refers_to")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        package, done = None, []
        for batch in batches:
            for row in batch.to_pylist():
                package = package or _Package(folder)
                data = warc_record(row["key"], row["url"], row["payload"].encode(), row["digest"], row["refers_to"])
                package.add(row["key"], data)
                if package.size >= PACKAGE_BYTES:
                    done.append(package.close())
                    package = None
        if package:
            done.append(package.close())
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[0] for d in done], pa.string()), *(pa.array([d[n] for d in done], pa.int64()) for n in (1, 2))],
            names=["package", "records", "bytes"],
        )

    return stage(decided.mapInArrow(run, "package string, records long, bytes long"))


# --- reading -----------------------------------------------------------------------------------------------------------


class Member(NamedTuple):
    name: str
    method: int
    stored: int  # bytes in the package
    header: int  # where its local header begins


class Package:
    """Members of a ZIP package, read by ranges."""

    def __init__(self, path: str):
        system, inner = fs.FileSystem.from_uri(path)
        self.file = system.open_input_file(inner)
        self.size = self.file.size()
        self.members = {m.name: m for m in self._directory()}

    def close(self) -> None:
        self.file.close()

    def ranges(self, spans: list[tuple[int, int]]) -> Iterator[bytes]:
        """The bytes of ranges in order of their offset; neighbours come from one request."""
        first = 0
        while first < len(spans):
            begin, length = spans[first]
            end, after = begin + length, first + 1
            while after < len(spans) and spans[after][0] == end and end + spans[after][1] - begin <= REQUEST_BYTES:
                end, after = end + spans[after][1], after + 1
            data = self.range(begin, end - begin)
            for offset, length in spans[first:after]:
                yield data[offset - begin : offset - begin + length]
            first = after

    def range(self, offset: int, length: int) -> bytes:
        data = self.file.read_at(length, offset)
        if len(data) != length:
            raise ValueError("the package ends within a range")
        return data

    def _directory(self) -> Iterator[Member]:
        """The central directory: from the end record, or from the ZIP64 end record that its locator names."""
        tail_at = max(0, self.size - 65557)
        tail = self.range(tail_at, self.size - tail_at)
        at = tail.rfind(b"PK\x05\x06")
        while at >= 0 and (at + 22 > len(tail) or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
            at = tail.rfind(b"PK\x05\x06", 0, at)
        if at < 0:
            raise ValueError("no end record: not a ZIP package")
        entries, length, offset = struct.unpack_from("<HLL", tail, at + 10)
        end = tail_at + at
        if at >= 20 and tail[at - 20 : at - 16] == b"PK\x06\x07":
            end64 = struct.unpack_from("<Q", tail, at - 12)[0]
            record = self.range(end64, 56)
            if record[:4] != b"PK\x06\x06":
                raise ValueError("no ZIP64 end record where its locator points")
            entries, length, offset = struct.unpack_from("<QQQ", record, 32)
            end = end64
        shift = end - length - offset  # bytes before the package proper
        directory, at = self.range(offset + shift, length), 0
        for _ in range(entries):
            if directory[at : at + 4] != b"PK\x01\x02":
                raise ValueError("no central directory entry where one should be")
            method, = struct.unpack_from("<H", directory, at + 10)
            stored, full, n_name, n_extra, n_comment = struct.unpack_from("<LLHHH", directory, at + 20)
            header, = struct.unpack_from("<L", directory, at + 42)
            name = directory[at + 46 : at + 46 + n_name].decode("utf-8", "replace")
            extra, place = directory[at + 46 + n_name : at + 46 + n_name + n_extra], 0
            while place + 4 <= len(extra):
                kind, size = struct.unpack_from("<HH", extra, place)
                if kind == 1:  # ZIP64: of the three numbers, those that did not fit above
                    wide = iter(struct.unpack_from(f"<{size // 8}Q", extra, place + 4))
                    full = next(wide) if full == 0xFFFFFFFF else full
                    stored = next(wide) if stored == 0xFFFFFFFF else stored
                    header = next(wide) if header == 0xFFFFFFFF else header
                place += 4 + size
            yield Member(name, method, stored, header + shift)
            at += 46 + n_name + n_extra + n_comment

    def begin(self, member: Member) -> int:
        """Where a member's bytes begin."""
        header = self.range(member.header, 30)
        if header[:4] != b"PK\x03\x04":
            raise ValueError("no local header where the directory points")
        return member.header + 30 + sum(struct.unpack_from("<HH", header, 26))

    def content(self, member: Member) -> bytes:
        data = self.range(self.begin(member), member.stored)
        return zlib.decompress(data, -15) if member.method == 8 else data

    def record_ranges(self) -> Iterator[tuple[int, int]]:
        """Offset and length in the package of each WARC record, by the indexes or else by walking a member."""
        archives = {m.name: m for m in self.members.values() if m.name.startswith("archive/") and not m.name.endswith("/")}
        for member in archives.values():
            if member.method != 0:
                raise ValueError(f"{member.name} is not stored, its records cannot be read by ranges")
        begins, indexed = {name: self.begin(member) for name, member in archives.items()}, set()
        for name, member in self.members.items():
            if name.startswith("indexes/") and not name.endswith("/"):
                for line in self.content(member).decode().splitlines():
                    if "{" in line:
                        entry = json.loads(line[line.index("{") :])
                        file = entry["filename"] if entry["filename"] in archives else f"archive/{entry['filename']}"
                        indexed.add(file)
                        yield begins[file] + int(entry["offset"]), int(entry["length"])
        for name in archives.keys() - indexed:
            yield from self._walk(begins[name], archives[name].stored)

    def _walk(self, begin: int, length: int) -> Iterator[tuple[int, int]]:
        at = first = 0
        inflate, data = zlib.decompressobj(31), b""
        while at < length or data:
            if not data:
                data = self.range(begin + at, min(1 << 20, length - at))
                at += len(data)
            inflate.decompress(data)
            data = inflate.unused_data
            if inflate.eof:
                end = at - len(data)
                yield begin + first, end - first
                first, inflate = end, zlib.decompressobj(31)


def parse_record(data: bytes) -> dict:
    """Fields of a WARC record: id, url, type, refers_to, digest and length as declared, payload (none of a revisit)."""
    head, _, rest = data.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(headers["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    declared = next(int(l.split(b":")[1]) for l in http.split(b"\r\n") if l.lower().startswith(b"content-length:"))
    number = lambda urn: int(urn[len("<urn:page:") : -1]) if urn and urn != "<urn:page:>" else None
    revisit = headers["WARC-Type"] == "revisit"
    return {
        "key": number(headers["WARC-Record-ID"]),
        "url": unquote(headers["WARC-Target-URI"]) if "WARC-Target-URI" in headers else None,
        "record_type": headers["WARC-Type"],
        "refers_to": number(headers.get("WARC-Refers-To")),
        "declared_digest": headers["WARC-Payload-Digest"].removeprefix("sha256:"),
        "declared_bytes": declared,
        "payload": None if revisit else payload,
    }


RECORD = (
    "key long, url string, record_type string, refers_to long, declared_digest string, declared_bytes long, payload binary"
)
_ARROW = pa.schema([
    ("key", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
    ("declared_digest", pa.string()), ("declared_bytes", pa.int64()), ("payload", pa.binary()),
])


def record_ranges(packages: DataFrame) -> DataFrame:
    """(package, offset, length) of each record in the packages of a manifest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("package").to_pylist():
                package = Package(path)
                ranges = list(package.record_ranges())
                package.close()
                for at in range(0, len(ranges), 10_000):
                    part = ranges[at : at + 10_000]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([path] * len(part)), pa.array([o for o, _ in part], pa.int64()),
                            pa.array([n for _, n in part], pa.int64()),
                        ],
                        names=["package", "offset", "length"],
                    )

    return packages.select("package").mapInArrow(run, "package string, offset long, length long")


def read_records(ranges: DataFrame, tasks: int) -> DataFrame:
    """The records at the given ranges, read by a number of tasks; neighbouring ones are read by the same task.

    Spark would choose the number by the bytes of the ranges, which say nothing of the bytes of the records.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, package = None, None
        for batch in batches:
            rows = batch.to_pylist()
            at = 0
            while at < len(rows):
                if rows[at]["package"] != path:
                    if package:
                        package.close()
                    path = rows[at]["package"]
                    package = Package(path)
                spans = []
                while at < len(rows) and len(spans) < 500 and rows[at]["package"] == path:
                    spans.append((rows[at]["offset"], rows[at]["length"]))
                    at += 1
                found = [parse_record(gzip.decompress(data)) for data in package.ranges(spans)]
                yield pa.RecordBatch.from_pylist(found, schema=_ARROW)
        if package:
            package.close()

    place = ["package", F.floor(F.col("offset") / READ_BYTES)]
    return ranges.repartition(tasks, *place).sortWithinPartitions("package", "offset").mapInArrow(run, RECORD)


def round_trip(pages: DataFrame, **columns: str) -> DataFrame:
    """Pages written to packages in the shared folder and read back."""
    folder = f"{stage_folder(pages.sparkSession)}/packages-{uuid.uuid4().hex}"
    manifest = write_packages(pages, folder, **columns)
    stored = manifest.agg(F.sum("bytes")).first()[0] or 0
    return read_records(record_ranges(manifest), max(1, min(-(-stored // READ_BYTES), MOST_TASKS)))
