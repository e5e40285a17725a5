"""WARC archives as a Python data source of Spark.

Files are sequences of gzip members, one per record. Each member's header names its compressed size (the ``sl`` extra
field of the WARC standard), so a reader that has seen a record's headers can step over the rest. Files without that
field are read as well; their unwanted records are unpacked but not kept.

Writing: each task writes files under names of its own; a commit lists them in a manifest. What failed attempts left
behind is in no manifest and is never read. Reading: partitions are planned from file sizes, filters on header columns
are pushed down and judged on the record headers before the block is unpacked.
"""

from __future__ import annotations

import base64
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
    StringStartsWith,
    WriterCommitMessage,
)

_TEXTS = ("record_id", "record_type", "target_uri", "date", "refers_to", "payload_digest")
FIELDS = ", ".join(f"{c} string" for c in _TEXTS) + ", payload_bytes long, payload binary"
_SCHEMA = pa.schema([*((c, pa.string()) for c in _TEXTS), ("payload_bytes", pa.int64()), ("payload", pa.binary())])
# Fixed names of the archive format.
_HEADERS = {
    "record_id": "WARC-Record-ID",
    "record_type": "WARC-Type",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "refers_to": "WARC-Refers-To",
    "payload_digest": "WARC-Payload-Digest",
}
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MANIFEST = "_manifest-"
FILE_BYTES, PARTITION_BYTES, BATCH_BYTES = 64 << 20, 32 << 20, 8 << 20
_CHUNK = 1 << 16


def open_store(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    return pafs.FileSystem.from_uri(path) if ":/" in path else (pafs.LocalFileSystem(), path)


def _clean(value: str) -> str:
    """A header value on one line."""
    return "".join(c if c >= " " else f"%{ord(c):02X}" for c in value)


def pack(record: dict) -> bytes:
    """One record as a gzip member. A revisit holds the HTTP headers of its response, not the payload."""
    payload = record["payload"] or b""
    head = ["WARC/1.1"]
    for field, name in _HEADERS.items():
        value = record.get(field)
        if value is None:
            continue
        if field == "payload_digest":
            value = "sha1:" + base64.b32encode(bytes.fromhex(value)).decode()
        elif field in ("record_id", "refers_to"):
            value = f"<{value}>"
        head.append(f"{name}: {_clean(value)}")
    size = record["payload_bytes"] if record.get("payload_bytes") is not None else len(payload)
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    if record["record_type"] == "revisit":
        head.append(f"WARC-Profile: {_PROFILE}")
    else:
        block += payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    deflate = zlib.compressobj(1, zlib.DEFLATED, -15)
    body = deflate.compress(raw) + deflate.flush()
    extra = struct.pack("<2sHII", b"sl", 8, len(body) + 32, len(raw))
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + body + struct.pack("<II", zlib.crc32(raw), len(raw))


def _lines(raw: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in raw.decode("utf-8", "replace").split("\r\n")[1:])}


class _Member:
    """One gzip member of a file: its start is unpacked first, the rest on demand."""

    def __init__(self, file, at: int, size: int):
        self.file, self.at, self.size, self.end = file, at, size, None
        head = file.read_at(min(_CHUNK, size - at), at)
        if head[:3] != b"\x1f\x8b\x08":
            raise ValueError(f"no gzip member at byte {at}")
        skip = 10
        if head[3] & 4:
            length = struct.unpack_from("<H", head, 10)[0]
            if length == 12 and head[12:14] == b"sl":
                self.end = at + struct.unpack_from("<I", head, 16)[0]
            skip += 2 + length
        for flag in (8, 16):  # name and comment
            if head[3] & flag:
                skip = head.index(b"\0", skip) + 1
        skip += 2 * bool(head[3] & 2)
        self.inflate, self.left, self.next = zlib.decompressobj(-15), head[skip:], at + len(head)

    def more(self, most: int = 0) -> bytes:
        """The next unpacked bytes, about ``most`` or whatever one chunk gives; empty at the end."""
        while not self.inflate.eof:
            if not self.left:
                self.left = self.file.read_at(min(_CHUNK, self.size - self.next), self.next)
                self.next += len(self.left)
                if not self.left:
                    raise ValueError(f"the gzip member at byte {self.at} is cut off")
            out = self.inflate.decompress(self.left, most)
            self.left = self.inflate.unconsumed_tail
            if out:
                return out
        return b""

    def rest(self) -> bytes:
        return b"".join(iter(self.more, b""))

    def stop(self) -> int:
        """Where the next member begins."""
        if self.end is None:
            while self.more():
                pass
            self.end = self.next - len(self.inflate.unused_data) + 8
        return self.end


def records(file, size: int, wanted, payloads: bool) -> Iterator[tuple]:
    """Rows of one file. ``wanted`` judges the header columns; only then the block is looked at."""
    at = 0
    while at < size:
        member = _Member(file, at, size)
        raw = b""
        while b"\r\n\r\n" not in raw and (part := member.more(1024)):
            raw += part
        head, _, block = raw.partition(b"\r\n\r\n")
        named = _lines(head)
        row = {field: named.get(name.lower()) for field, name in _HEADERS.items()}
        for field in ("record_id", "refers_to"):
            row[field] = row[field] and row[field].strip("<>")
        kind, _, digest = (row["payload_digest"] or "").partition(":")
        if kind.lower() == "sha1":
            row["payload_digest"] = digest.lower() if len(digest) == 40 else base64.b32decode(digest.upper()).hex()
        if wanted(row):
            length = int(named.get("content-length", 0))
            http = named.get("content-type", "").startswith("application/http")
            if http:
                while b"\r\n\r\n" not in block and (part := member.more(1024)):
                    block += part
                inner, _, start = block.partition(b"\r\n\r\n")
                stated = _lines(inner).get("content-length", "")
                body = length - len(inner) - 4
                count = int(stated) if row["record_type"] == "revisit" and stated.isdigit() else body
            else:
                start, body = block, length
                count = body
            payload = (start + member.rest())[:body] if payloads and row["record_type"] != "revisit" else None
            yield (*row.values(), count, payload)
        at = member.stop()


@dataclass
class _Files(InputPartition):
    files: list[tuple[str, int]]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(zip(*rows, strict=True), _SCHEMA.types, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], schema=_SCHEMA)


class _Reader(DataSourceReader):
    """Options: ``path``; ``payload`` = false leaves the payload column null and its bytes packed."""

    def __init__(self, options):
        self.path, self.payloads, self.tests = options["path"], options.get("payload", "true") == "true", []

    def pushFilters(self, filters):
        known = (EqualTo, In, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual, StringStartsWith, IsNotNull)
        for f in filters:
            if isinstance(f, known) and len(f.attribute) == 1 and f.attribute[0] in _HEADERS:
                self.tests.append((type(f).__name__, f.attribute[0], getattr(f, "value", None)))
            else:
                yield f

    def partitions(self):
        store, path = open_store(self.path)
        info = store.get_file_info(pafs.FileSelector(path))
        listed = [i for i in info if i.base_name.startswith(_MANIFEST)]
        if listed:
            names = {n for i in listed for n in json.loads(store.open_input_file(i.path).read())}
            info = [i for i in info if i.base_name in names]
        else:
            info = [i for i in info if i.base_name.endswith(".warc.gz")]
        parts, size = [_Files([])], 0
        for i in sorted(info, key=lambda i: i.path):
            if parts[-1].files and size + i.size > PARTITION_BYTES:
                parts.append(_Files([]))
                size = 0
            parts[-1].files.append((i.path, i.size))
            size += i.size
        return parts

    def _wanted(self, row: dict) -> bool:
        checks = {
            "EqualTo": lambda a, b: a == b,
            "In": lambda a, b: a in b,
            "GreaterThan": lambda a, b: a > b,
            "GreaterThanOrEqual": lambda a, b: a >= b,
            "LessThan": lambda a, b: a < b,
            "LessThanOrEqual": lambda a, b: a <= b,
            "StringStartsWith": lambda a, b: a.startswith(b),
            "IsNotNull": lambda a, b: True,
        }
        return all(row[field] is not None and checks[kind](row[field], value) for kind, field, value in self.tests)

    def read(self, partition):
        store, _ = open_store(self.path)
        held, size = [], 0
        for path, length in partition.files:
            with store.open_input_file(path) as file:
                for row in records(file, length, self._wanted, self.payloads):
                    held.append(row)
                    size += 500 + len(row[-1] or b"")
                    if size >= BATCH_BYTES:
                        yield _batch(held)
                        held, size = [], 0
        if held:
            yield _batch(held)


@dataclass
class _Written(WriterCommitMessage):
    names: list[str]


class _Writer(DataSourceArrowWriter):
    def __init__(self, options):
        self.path = options["path"]

    def write(self, iterator):
        store, path = open_store(self.path)
        store.create_dir(path, recursive=True)
        names, file, size = [], None, 0
        for batch in iterator:
            for record in batch.to_pylist():
                if file is None or size >= FILE_BYTES:
                    if file:
                        file.close()
                    names.append(f"{uuid.uuid4().hex}.warc.gz")
                    file, size = store.open_output_stream(f"{path}/{names[-1]}", compression=None), 0
                raw = pack(record)
                file.write(raw)
                size += len(raw)
        if file:
            file.close()
        return _Written(names)

    def commit(self, messages):
        store, path = open_store(self.path)
        store.create_dir(path, recursive=True)
        with store.open_output_stream(f"{path}/{_MANIFEST}{uuid.uuid4().hex}.json") as file:
            file.write(json.dumps([n for m in messages if m for n in m.names]).encode())

    def abort(self, messages):
        store, path = open_store(self.path)
        for name in (n for m in messages if m for n in m.names):
            store.delete_file(f"{path}/{name}")


class WarcSource(DataSource):
    """``spark.read.format("warc")`` and ``df.write.format("warc").mode("append")``."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return FIELDS

    def reader(self, schema):
        return _Reader(self.options)

    def writer(self, schema, overwrite):
        return _Writer(self.options)


def register(spark: SparkSession) -> None:
    """Make the format known to a session and let it push filters into Python sources from now on."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def write_warc(records_: DataFrame, path: str) -> None:
    """Append records with the columns record_id, record_type, target_uri, date, refers_to, payload_digest (hex SHA-1),
    payload_bytes and payload; other columns are ignored. Nulls leave their header out, a null payload is empty."""
    register(records_.sparkSession)
    records_.write.format("warc").mode("append").save(path)


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """All records of committed archives, or of all ``.warc.gz`` files where there is no manifest."""
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)
