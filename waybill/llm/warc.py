"""A Spark data source for WARC archives, and an archive of pages with revisit records.

Files are gzip members, one per record. The writer notes a member's compressed and full length in
the member's header (the extra field ``sl``), so a reader can pass over a record it does not want
after looking at its first bytes. Archives of other writers, without that field, are read too.

``spark.read.format("waybill_warc")`` plans partitions as byte ranges of files; a range owns the
members that start in it. Filters on ``record_type``, ``record_id``, ``target_uri``, ``refers_to``
and ``payload_digest`` are pushed into the reader, which reads headers first and inflates the rest
only for records that pass; option ``payload`` = ``false`` leaves payloads out altogether.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from uuid import uuid4

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    StringContains,
    StringEndsWith,
    StringStartsWith,
    WriterCommitMessage,
)

FORMAT = "waybill_warc"
SCHEMA = (
    "record_id string, record_type string, target_uri string, date string, refers_to string, "
    "payload_digest string, payload_length long, payload binary"
)
SPLIT_BYTES = 64 << 20
ROLL_BYTES = 256 << 20
READ_BYTES = 1 << 20
BATCH_BYTES = 8 << 20
MAGIC = b"\x1f\x8b\x08"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
NAMED = {
    "warc-record-id": "record_id",
    "warc-type": "record_type",
    "warc-target-uri": "target_uri",
    "warc-date": "date",
    "warc-refers-to": "refers_to",
    "warc-payload-digest": "payload_digest",
    "x-payload-length": "payload_length",
}
BRACKETED = ("record_id", "refers_to")


def _clean(value: str) -> str:
    """A header value on one line: control characters as percent codes."""
    return "".join(c if c >= " " else f"%{ord(c):02X}" for c in value)


def member(row: dict, level: int = 3) -> bytes:
    """One record as a gzip member that knows its own length."""
    payload = row["payload"] or b""
    if row["record_type"] == "response":
        block, kind = HTTP_HEAD + payload, "application/http; msgtype=response"
    else:
        block, kind = payload, "application/octet-stream"
    head = ["WARC/1.1"]
    for name, column in (
        ("WARC-Type", "record_type"),
        ("WARC-Record-ID", "record_id"),
        ("WARC-Date", "date"),
        ("WARC-Target-URI", "target_uri"),
        ("WARC-Refers-To", "refers_to"),
        ("WARC-Payload-Digest", "payload_digest"),
        ("X-Payload-Length", "payload_length"),
    ):
        value = row.get(column)
        if value is not None:
            value = _clean(str(value))
            head.append(f"{name}: <{value}>" if column in BRACKETED else f"{name}: {value}")
    head += [f"Content-Type: {kind}", f"Content-Length: {len(block)}", "", ""]
    plain = "\r\n".join(head).encode() + block + b"\r\n\r\n"
    squeeze = zlib.compressobj(level, zlib.DEFLATED, -zlib.MAX_WBITS)
    body = squeeze.compress(plain) + squeeze.flush()
    total = 10 + 2 + 12 + len(body) + 8
    extra = struct.pack("<H2sHII", 12, b"sl", 8, total & 0xFFFFFFFF, len(plain) & 0xFFFFFFFF)
    gzip_head = MAGIC + b"\x04" + b"\0" * 4 + b"\0\xff"
    return gzip_head + extra + body + struct.pack("<II", zlib.crc32(plain), len(plain) & 0xFFFFFFFF)


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, str]]


class WarcWriter(DataSourceArrowWriter):
    """Each task writes files of its own under a pending name; the commit renames them."""

    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path, overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = fs.FileSystem.from_uri(self.path)
        store.create_dir(root, recursive=True)
        task = TaskContext.get()
        stem = f"{task.partitionId() if task else 0:06d}-{uuid4().hex}"
        files, out, size = [], None, 0
        for batch in iterator:
            for k in range(batch.num_rows):
                row = {n: batch.column(i)[k].as_py() for i, n in enumerate(batch.schema.names)}
                if out is None or size >= ROLL_BYTES:
                    if out is not None:
                        out.close()
                    name = f"{stem}-{len(files):04d}.warc.gz"
                    files.append((f"{root}/_pending-{name}", f"{root}/part-{name}"))
                    out, size = store.open_output_stream(files[-1][0], compression=None), 0
                data = member(row)
                out.write(data)
                size += len(data)
        if out is not None:
            out.close()
        return Written(files)

    def commit(self, messages: list) -> None:
        store, root = fs.FileSystem.from_uri(self.path)
        old = []
        if self.overwrite:
            old = [x.path for x in store.get_file_info(fs.FileSelector(root, allow_not_found=True)) if x.base_name.startswith("part-")]
        for message in messages:
            for pending, final in message.files if message else []:
                store.move(pending, final)
        for path in old:
            store.delete_file(path)

    def abort(self, messages: list) -> None:
        store, _ = fs.FileSystem.from_uri(self.path)
        for message in messages:
            for pending, _ in message.files if message else []:
                store.delete_file(pending)


@dataclass
class Range(InputPartition):
    path: str
    start: int
    end: int


class Tape:
    """A file from an offset on, read through a buffer."""

    def __init__(self, store, path: str, at: int):
        self.file, self.at = store.open_input_file(path), at
        self.size, self._held, self._from = self.file.size(), b"", at

    def peek(self, n: int, skip: int = 0) -> bytes:
        """Up to ``n`` bytes, fewer only at the file's end, from ``skip`` after the current place."""
        start = self.at + skip
        end = min(start + n, self.size)
        if start >= end:
            return b""
        if not self._from <= start or end > self._from + len(self._held):
            self._from = start
            self._held = self.file.read_at(min(max(READ_BYTES, n), self.size - start), start)
        return self._held[start - self._from : end - self._from]


def _length(head: bytes) -> tuple[int, int]:
    """Where the deflated data of a member start, and the member's length if it is noted (else 0)."""
    flags, at, length = head[3], 10, 0
    if flags & 4:
        size = struct.unpack_from("<H", head, at)[0]
        extra, at = head[at + 2 : at + 2 + size], at + 2 + size
        while len(extra) >= 4:
            name, n = extra[:2], struct.unpack_from("<H", extra, 2)[0]
            if name == b"sl" and n == 8:
                length = struct.unpack_from("<I", extra, 4)[0]
            extra = extra[4 + n :]
    for flag in (8, 16):
        if flags & flag:
            at = head.index(b"\0", at) + 1
    return at + 2 * bool(flags & 2), length


def _is_record(data: bytes) -> bool:
    try:
        at, _ = _length(data)
        return zlib.decompressobj(-zlib.MAX_WBITS).decompress(data[at : at + 512], 8).startswith(b"WARC/1.")
    except (zlib.error, ValueError, IndexError, struct.error):
        return False


def _align(tape: Tape, end: int) -> bool:
    """Move to the first record that starts before ``end``."""
    while tape.at < end:
        found = tape.peek(READ_BYTES).find(MAGIC)
        if found < 0:
            tape.at += READ_BYTES - len(MAGIC) + 1
            continue
        tape.at += found
        if tape.at < end and _is_record(tape.peek(4096)):
            return True
        tape.at += 1
    return False


def _fields(head: bytes) -> dict:
    out = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        column = NAMED.get(name.strip().lower())
        if colon and column:
            value = value.strip()
            out[column] = value[1:-1] if column in BRACKETED and value[:1] == "<" else value
        elif colon and name.strip().lower() == "content-type":
            out["content_type"] = value.strip()
        elif colon and name.strip().lower() == "content-length":
            out["content_length"] = int(value)
    if "payload_length" in out:
        out["payload_length"] = int(out["payload_length"])
    return out


def _passes(test: Filter, row: dict) -> bool:
    value = row.get(test.attribute[0])
    if isinstance(test, IsNull):
        return value is None
    if value is None:
        return False
    if isinstance(test, IsNotNull):
        return True
    if isinstance(test, In):
        return value in test.value
    if isinstance(test, StringStartsWith):
        return value.startswith(test.value)
    if isinstance(test, StringEndsWith):
        return value.endswith(test.value)
    if isinstance(test, StringContains):
        return test.value in value
    return value == test.value


def records(tape: Tape, end: int, tests: list, payload: bool = True) -> Iterator[dict]:
    """The records that start before ``end`` and pass all ``tests``."""
    while tape.at < end and _is_record(tape.peek(4096)):
        fed, length = _length(tape.peek(4096))
        inflate, plain = zlib.decompressobj(-zlib.MAX_WBITS), b""
        while b"\r\n\r\n" not in plain and not inflate.eof:
            plain += inflate.decompress(_piece(tape, 1024, fed))
            fed += 1024
        head, _, rest = plain.partition(b"\r\n\r\n")
        row = _fields(head)
        wanted = all(_passes(t, row) for t in tests)
        if (wanted and payload) or not length:
            parts, step = [rest], max(1024, length - fed) if length else READ_BYTES
            while not inflate.eof:
                piece = _piece(tape, step, fed)
                parts.append(inflate.decompress(piece))
                fed += len(piece)
            fed = min(fed, tape.size - tape.at)
            length = length or fed - len(inflate.unused_data) + 8
            if wanted and payload:
                block = b"".join(parts)[: row.get("content_length", 0)]
                if row.get("content_type", "").startswith("application/http"):
                    block = block.partition(b"\r\n\r\n")[2]
                row["payload"] = block
        tape.at += length
        if wanted:
            yield row


def _piece(tape: Tape, n: int, skip: int) -> bytes:
    piece = tape.peek(n, skip)
    if not piece:
        raise ValueError("a WARC record is cut off")
    return piece


class WarcReader(DataSourceReader):
    def __init__(self, schema: pa.Schema, options: dict):
        self.schema, self.path = schema, options["path"]
        self.payload = options.get("payload", "true").lower() != "false"
        self.split = int(options.get("splitBytes", SPLIT_BYTES))
        self.tests: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        kinds = (EqualTo, In, IsNull, IsNotNull, StringStartsWith, StringEndsWith, StringContains)
        pushable = ("record_id", "record_type", "target_uri", "date", "refers_to", "payload_digest")
        for f in filters:
            if isinstance(f, kinds) and len(f.attribute) == 1 and f.attribute[0] in pushable:
                self.tests.append(f)
            else:
                yield f

    def partitions(self) -> list[Range]:
        store, root = fs.FileSystem.from_uri(self.path)
        info = store.get_file_info(root)
        files = [info] if info.is_file else store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
        return [
            Range(x.path, at, min(at + self.split, x.size))
            for x in sorted(files, key=lambda x: x.path)
            if x.is_file and x.size and not x.base_name.startswith(("_", "."))
            for at in range(0, x.size, self.split)
        ] or [Range("", 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if not partition.end:
            return
        store, _ = fs.FileSystem.from_uri(self.path)
        tape = Tape(store, partition.path, partition.start)
        if not _align(tape, partition.end):
            return
        rows, size = [], 0
        for row in records(tape, partition.end, self.tests, self.payload):
            rows.append({n: row.get(n) for n in self.schema.names})
            size += len(row.get("payload") or b"") + 500
            if size >= BATCH_BYTES:
                yield pa.RecordBatch.from_pylist(rows, self.schema)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, self.schema)


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        from pyspark.sql.pandas.types import to_arrow_schema

        return WarcReader(to_arrow_schema(schema), dict(self.options))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known to the session and let Spark hand its filters to the reader."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def page_records(pages: DataFrame, least: int = 1000) -> DataFrame:
    """One archive record per page: a response, or a revisit of the page it repeats.

    Of the pages of equal payload of at least ``least`` bytes the one with the largest page_id is
    the response (all of them, if that page_id repeats); a page without page_id, or smaller, is
    a response. NULL html is the empty payload. The join of pages and digests meets one row per
    repeated digest, and a hot digest can be split by Spark as both sides are plain shuffles.
    """
    page = pages.select(
        F.col("page_id").cast("string").alias("record_id"),
        F.col("page_id").alias("_id"),
        F.col("url").alias("target_uri"),
        F.coalesce("html", F.lit("")).cast("binary").alias("payload"),
    ).withColumns({"payload_digest": F.sha1("payload"), "payload_length": F.octet_length("payload").cast("long")})
    last = (
        page.where((F.col("payload_length") >= least) & F.col("_id").isNotNull())
        .groupBy(F.col("payload_digest").alias("_digest"))
        .agg(F.max("_id").alias("_last"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1")
        .select("_digest", "_last")
    )
    joined = page.join(last, (F.col("payload_digest") == F.col("_digest")) & (F.col("_last") > F.col("_id")), "left")
    again = F.col("_last").isNotNull()
    return joined.select(
        "record_id",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        "target_uri",
        F.lit("2000-01-01T00:00:00Z").alias("date"),
        F.col("_last").cast("string").alias("refers_to"),
        "payload_digest",
        "payload_length",
        F.when(~again, F.col("payload")).alias("payload"),
    )


def write_warc(records_: DataFrame, path: str) -> None:
    """Write archive records (columns of ``SCHEMA``) as files under ``path``."""
    register(records_.sparkSession)
    records_.write.format(FORMAT).mode("append").save(path)


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records under ``path``; see the module for filters that reach the reader."""
    register(spark)
    return spark.read.format(FORMAT).option("payload", str(payload).lower()).load(path)
