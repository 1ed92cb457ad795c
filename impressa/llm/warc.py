"""WARC archives as a Spark data source, for writing and for reading with pushed-down predicates."""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from urllib.parse import quote

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceWriter,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    StringStartsWith,
    WriterCommitMessage,
)

SCHEMA = (
    "record_id string, record_type string, target_uri string, date string, payload_digest string, "
    "refers_to string, payload_length bigint, payload binary"
)
# Header names of the format, and one of our own for the length of what a revisit
# record leaves out.
HEADERS = {
    "record_id": "WARC-Record-ID",
    "record_type": "WARC-Type",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "payload_digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To",
    "payload_length": "X-Payload-Length",
}
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MANIFEST = "_files"
# A file is closed when it has reached this size; a read task gets files of about this size.
FILE_BYTES = 64 << 20
_CHUNK = 1 << 16


def _filesystem(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))


# ---------------------------------------------------------------- records


def _printable(value: object) -> bytes:
    """A header value without line breaks or other control characters."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: quote(m[0]), str(value)).encode()


def encode_record(row: dict) -> bytes:
    """One record as a gzip member that says how long it is, so that readers can jump over it."""
    payload = bytes(row["payload"]) if row["payload"] is not None else b""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http + payload
    head = [b"WARC/1.1"]
    for column, name in HEADERS.items():
        if row[column] is not None:
            head.append(name.encode() + b": " + _printable(row[column]))
    if row["record_type"] == "revisit":
        head.append(b"WARC-Profile: " + _REVISIT_PROFILE.encode())
    head.append(b"Content-Type: application/http;msgtype=response")
    head.append(b"Content-Length: %d" % len(block))
    data = b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"
    squeeze = zlib.compressobj(3, zlib.DEFLATED, -15)
    body = squeeze.compress(data) + squeeze.flush()
    # 10 bytes of gzip header, 2 + 12 of the extra field, 8 of the trailer
    length = 10 + 14 + len(body) + 8
    trailer = struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    if length >= 1 << 32 or len(data) >= 1 << 32:
        return b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\xff" + body + trailer
    extra = struct.pack("<H2sHII", 12, b"sl", 8, length, len(data))
    return b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff" + extra + body + trailer


def _stated_length(member: bytes) -> int | None:
    """Length of a gzip member from its extra field ``sl``."""
    if len(member) < 24 or member[:2] != b"\x1f\x8b" or not member[3] & 4:
        return None
    at, end = 12, 12 + struct.unpack_from("<H", member, 10)[0]
    while at + 4 <= min(end, len(member)):
        size = struct.unpack_from("<H", member, at + 2)[0]
        if member[at : at + 2] == b"sl" and size == 8:
            return struct.unpack_from("<I", member, at + 4)[0]
        at += 4 + size
    return None


def _parse_headers(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8", "replace").split("\r\n")
    pairs = (line.partition(":") for line in lines[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


class _Bytes:
    """Plain or gzip bytes from a file position on, produced as they are asked for."""

    def __init__(self, handle, start: int):
        handle.seek(start)
        self.handle, self.data, self.start = handle, bytearray(), start
        self.pending = handle.read(_CHUNK)
        self.length = _stated_length(self.pending)
        self.inflate = zlib.decompressobj(31) if self.pending[:2] == b"\x1f\x8b" else None
        self.read = len(self.pending)

    def more(self, step: int = 2048) -> bool:
        """Add some bytes to ``data``; false at the end of the member or file."""
        if self.inflate and self.inflate.eof:
            return False
        if not self.pending:
            self.pending = self.handle.read(_CHUNK)
            self.read += len(self.pending)
            if not self.pending:
                return False
        if self.inflate:
            self.data += self.inflate.decompress(self.pending, step)
            self.pending = self.inflate.unconsumed_tail
        else:
            self.data += self.pending
            self.pending = b""
        return True


def read_records(
    handle, size: int, wanted: Callable[[dict[str, str]], bool], payloads: bool = True
) -> Iterator[tuple[dict[str, str], bytes | None]]:
    """(headers, payload) of the records of a file whose headers ``wanted`` accepts.

    Headers come first: of a record that is not wanted, or without ``payloads``, the rest is jumped
    over where the member or the headers tell its length, and is otherwise inflated and dropped.
    """
    at = 0
    while at < size:
        source = _Bytes(handle, at)
        while (head := source.data.find(b"\r\n\r\n")) < 0 and source.more():
            pass
        if head < 0:
            if bytes(source.data).strip():
                raise ValueError(f"no WARC record at byte {at}")
            return
        headers = _parse_headers(bytes(source.data[:head]))
        content = int(headers.get("content-length", 0))
        keep = wanted(headers)
        end = head + 4 + content + 4
        if keep and payloads:
            while len(source.data) < end and source.more(1 << 20):
                pass
            block = bytes(source.data[head + 4 : head + 4 + content])
            http = headers.get("content-type", "").startswith("application/http")
            yield headers, block.partition(b"\r\n\r\n")[2] if http else block
        elif keep:
            yield headers, None
        if not source.inflate:
            at += end
        elif source.length:
            at += source.length
        else:
            while source.more(1 << 20):
                source.data.clear()
            at += source.read - len(source.inflate.unused_data)


# ---------------------------------------------------------------- data source


class _Files(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payloads: bool):
        self.path, self.payloads, self.filters = path, payloads, []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802
        """Keep predicates on headers; give back all others."""
        for f in filters:
            known = len(f.attribute) == 1 and f.attribute[0] in HEADERS if hasattr(f, "attribute") else False
            if known and f.attribute[0] != "payload_length" and isinstance(
                f, (EqualTo, In, IsNotNull, StringStartsWith)
            ):
                self.filters.append(f)
            else:
                yield f

    def _wanted(self, headers: dict[str, str]) -> bool:
        for f in self.filters:
            value = headers.get(HEADERS[f.attribute[0]].lower())
            if value is None:
                return False
            if isinstance(f, EqualTo) and value != f.value:
                return False
            if isinstance(f, In) and value not in f.value:
                return False
            if isinstance(f, StringStartsWith) and not value.startswith(f.value):
                return False
        return True

    def partitions(self) -> list[InputPartition]:
        store, root = _filesystem(self.path)
        listed = store.get_file_info(fs.FileSelector(root))
        files = {f.base_name: f for f in listed if f.type == fs.FileType.File}
        manifests = [n for n in files if n.startswith(_MANIFEST)]
        names = []
        for manifest in manifests:  # written here: files of failed attempts are in none
            with store.open_input_stream(files[manifest].path) as handle:
                names += handle.read().decode().split()
        if not manifests:
            names = [n for n in files if not n.startswith(("_", "."))]
        plan: list[_Files] = []
        room = 0
        for name in sorted(names):
            if files[name].size > room:
                plan.append(_Files([]))
                room = FILE_BYTES
            plan[-1].paths.append(f"{self.path.rstrip('/')}/{name}")
            room -= files[name].size
        return plan or [_Files([])]

    def read(self, partition: _Files) -> Iterator[tuple]:
        for path in partition.paths:
            store, name = _filesystem(path)
            with store.open_input_file(name) as handle:
                for headers, payload in read_records(
                    handle, handle.size(), self._wanted, self.payloads
                ):
                    row = {c: headers.get(h.lower()) for c, h in HEADERS.items()}
                    length = row.pop("payload_length")
                    if row["record_type"] == "revisit":
                        payload = None
                    yield (*row.values(), int(length) if length else None, payload)


class _Written(WriterCommitMessage):
    def __init__(self, names: list[str]):
        self.names = names


class WarcWriter(DataSourceWriter):
    def __init__(self, path: str, columns: list[str], overwrite: bool = False):
        self.path, self.columns, self.overwrite = path, columns, overwrite

    def write(self, iterator: Iterator) -> _Written:
        store, root = _filesystem(self.path)
        store.create_dir(root, recursive=True)
        names: list[str] = []
        handle = None
        for row in iterator:
            if handle is None:
                names.append(f"{uuid.uuid4().hex}.warc.gz")
                handle = store.open_output_stream(f"{root}/{names[-1]}", compression=None)
            handle.write(encode_record(dict(zip(self.columns, row, strict=True))))
            if handle.tell() >= FILE_BYTES:
                handle.close()
                handle = None
        if handle is not None:
            handle.close()
        return _Written(names)

    def commit(self, messages: list) -> None:
        store, root = _filesystem(self.path)
        store.create_dir(root, recursive=True)
        names = [name for m in messages if m is not None for name in m.names]
        # A manifest for each write, so that a folder has the records of all of them.
        older = [
            f.path for f in store.get_file_info(fs.FileSelector(root)) if f.base_name.startswith(_MANIFEST)
        ]
        with store.open_output_stream(f"{root}/{_MANIFEST}-{uuid.uuid4().hex}", compression=None) as handle:
            handle.write("\n".join(names).encode())
        if self.overwrite:
            for path in older:
                store.delete_file(path)

    def abort(self, messages: list) -> None:
        """Without a manifest that names them, left files are never read."""


class WarcSource(DataSource):
    """Options: ``path`` of a folder; ``payloads`` false reads headers only."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], self.options.get("payloads", "true") == "true")

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], schema.fieldNames(), overwrite)


# ---------------------------------------------------------------- operators


def write_warc(records: DataFrame, path: str) -> None:
    """Add rows of ``SCHEMA`` (columns in any order, others left out) to a folder as .warc.gz files."""
    records.sparkSession.dataSource.register(WarcSource)
    columns = [part.split()[0] for part in SCHEMA.split(", ")]
    records.select(*columns).write.format("warc").mode("append").save(path)


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records of a folder of .warc or .warc.gz files, payload null where a record has none.

    Filters on header columns are evaluated in the reader, before payloads are decoded.
    """
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("warc").option("payloads", str(payloads).lower()).load(path)


def page_records(pages: DataFrame, least_bytes: int = 100) -> DataFrame:
    """A record per row of ``pages`` (page_id, url, html), with equal payloads written once.

    The payload is the html in UTF-8, empty for null. Of equal payloads of at least ``least_bytes``
    bytes, the row with the smallest page_id is a response and all others revisit it. Rows that
    repeat that page_id, and rows with a null page_id, are responses. Digests occurring once are
    left out of the lookup; rows of a frequent digest are split by the adaptive skew join.
    """
    raw = pages.select(
        "page_id", "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload")
    ).select("*", F.sha2("payload", 256).alias("digest"), F.length("payload").alias("bytes"))
    first = (
        raw.filter(F.col("bytes") >= least_bytes)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("rows"))
        .filter(F.col("rows") > 1)
        .select("digest", "first_id")
    )
    revisit = F.coalesce(F.col("page_id") != F.col("first_id"), F.lit(False))
    name = lambda c: F.concat(F.lit("urn:page:"), c.cast("string"))
    return raw.join(first, "digest", "left").select(
        F.coalesce(name(F.col("page_id")), F.lit("urn:page:")).alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.col("url").alias("target_uri"),
        F.lit("1970-01-01T00:00:00Z").alias("date"),
        F.concat(F.lit("sha256:"), "digest").alias("payload_digest"),
        F.when(revisit, name(F.col("first_id"))).alias("refers_to"),
        F.col("bytes").cast("bigint").alias("payload_length"),
        F.when(~revisit, F.col("payload")).alias("payload"),
    )
