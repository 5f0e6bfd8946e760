"""WARC archives as a PySpark Python data source, and pages written to and read back from them.

Reading. Files below a path are planned as partitions: large files alone, small ones packed together. A record's
WARC headers are parsed first. Predicates on columns that headers give (type, id, URI, date, digest, lengths) are
taken over from Spark and tested on the headers alone; the block of a record that fails them, or whose payload is
not wanted (`payload` set to `false`), is never put together. In a compressed archive with one member for each
record, the member's extra field `sl` tells its length, so the rest of an unwanted record is not even inflated;
members without it are inflated and thrown away, uncompressed blocks are jumped over by their length. Several
records in one member, and files that are not compressed, are read as well.

Writing. A task writes its records to files of about `max_bytes` below `_temporary`; the driver moves the files of
the attempts that committed, so a lost executor or a second attempt leaves no records behind.

`archive_pages` writes a record for each page. Of pages with equal payloads of at least `least_bytes` bytes the one
with the smallest id is a response, the others are revisits of it: payloads are equal when SHA-256 and length agree.
Null payloads count as empty. A null id is larger than any other; of repeated rows (same id and payload) the first
by row number is the response. Records keep the id and the row number in their record id. Line breaks and other
control characters in a URI are percent-encoded. A very long payload is held once by its task. An empty table
makes an archive without records. Extra columns are ignored; a record holds the id, URI and payload.

`http_length`, the length an HTTP head names, is read for revisits and wherever payloads are. Names of header fields
are in lower case. Paths may be of any file system that pyarrow knows (local, HDFS, S3, GCS); all executors must see it.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from datetime import UTC, datetime

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F

from onefold.llm.shared import numbered
from onefold.session import cut_lineage, scratch_path
from onefold.skew import lookup_join

FORMAT = "warc"
SCHEMA = (
    "record_id string, warc_type string, target_uri string, warc_date string, payload_digest string, "
    "refers_to string, content_length long, headers map<string,string>, http_length long, payload binary, "
    "file string, offset long"
)
# Header fields of the format.
FIELDS = {
    "record_id": "WARC-Record-ID",
    "warc_type": "WARC-Type",
    "target_uri": "WARC-Target-URI",
    "warc_date": "WARC-Date",
    "payload_digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To",
    "content_length": "Content-Length",
}
VERSION, REVISIT_PROFILE = b"WARC/1.1", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"
GZIP, EXTRA_FLAG = b"\x1f\x8b", 4
READ_BYTES, INFLATE_BYTES, FIRST_BYTES = 1 << 16, 1 << 18, 1 << 11  # the first part of a member holds its headers
PARTITION_BYTES, FILE_BYTES = 32 << 20, 256 << 20
BATCH_BYTES, BATCH_ROWS, HEADER_BYTES = 4 << 20, 2_000, 1 << 20
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


# ---- bytes of a file ----


class Stream:
    """The decoded bytes of an archive file, member after member."""

    def __init__(self, file: pa.NativeFile):
        self.file, self.raw, self.out = file, b"", bytearray()
        self.raw_at = 0  # offset in the file of the first byte of `raw`
        self.out_at = 0  # bytes of `out` that are used up
        self.inflater = None
        self.member = (0, None)  # offset and, where its extra field tells it, length of the open member
        self.inflated = self.begun = 0  # decoded bytes so far, and when the open member began
        self.compressed = self._more(2) and self.raw[:2] == GZIP

    def _more(self, least: int) -> bool:
        while len(self.raw) < least:
            data = self.file.read(max(READ_BYTES, least - len(self.raw)))
            if not data:
                return False
            self.raw += data
        return True

    def _drop(self, n: int) -> None:
        self.raw, self.raw_at = self.raw[n:], self.raw_at + n

    def _open_member(self) -> None:
        length = None
        if self._more(12) and self.raw[3] & EXTRA_FLAG:
            size = struct.unpack_from("<H", self.raw, 10)[0]
            if self._more(12 + size):
                length = extra_length(self.raw[12 : 12 + size])
        self.member, self.inflater, self.begun = (self.raw_at, length), zlib.decompressobj(31), self.inflated

    def _fill(self) -> bool:
        """Decodes some more; False at the end of the file."""
        if self.out_at:
            del self.out[: self.out_at]
            self.out_at = 0
        if not self.compressed:
            if not self._more(1):
                return False
            self.out += self.raw
            self._drop(len(self.raw))
            return True
        if self.inflater is None:
            if not self._more(2):
                return False
            self._open_member()
        if not self._more(1):
            raise EOFError(f"the member at byte {self.member[0]} is cut off")
        before = len(self.raw)
        data = self.inflater.decompress(self.raw, FIRST_BYTES if self.inflated == self.begun else INFLATE_BYTES)
        rest = self.inflater.unused_data if self.inflater.eof else self.inflater.unconsumed_tail
        self._drop(before - len(rest))
        self.out += data
        self.inflated += len(data)
        if self.inflater.eof:
            self.inflater = None
        return True

    @property
    def held(self) -> int:
        return len(self.out) - self.out_at

    def at_end(self) -> bool:
        while not self.held:
            if not self._fill():
                return True
        return False

    def alone(self) -> bool:
        """True at the first decoded byte of a member whose length is known."""
        return self.compressed and self.member[1] is not None and self.inflated - self.held == self.begun

    def position(self) -> int:
        """Where the next record begins: its member's offset in a compressed file."""
        return self.member[0] if self.compressed else self.raw_at - self.held

    def until(self, mark: bytes, most: int = HEADER_BYTES) -> bytes:
        """The bytes before `mark`, which is used up as well."""
        looked = 0
        while (found := self.out.find(mark, self.out_at + looked)) < 0:
            looked = max(0, self.held - len(mark) + 1)
            if looked > most or not self._fill():
                raise ValueError(f"no end of headers in the record at byte {self.position()}")
        data = bytes(self.out[self.out_at : found])
        self.out_at = found + len(mark)
        return data

    def read(self, n: int) -> bytes:
        while self.held < n:
            if not self._fill():
                raise EOFError(f"the record at byte {self.position()} is cut off")
        data = bytes(self.out[self.out_at : self.out_at + n])
        self.out_at += n
        return data

    def skip(self, n: int) -> None:
        """Passes over `n` decoded bytes without keeping them."""
        while self.held < n:
            n -= self.held
            self.out_at = len(self.out)
            if not self.compressed and n > len(self.raw):
                self.raw_at += n
                self.raw, n = b"", 0
                self.file.seek(self.raw_at)
                return
            if not self._fill():
                raise EOFError(f"the record at byte {self.position()} is cut off")
        self.out_at += n

    def skip_member(self) -> None:
        """Passes over the rest of a member whose length is known without inflating it."""
        stop = self.member[0] + self.member[1]
        self.out.clear()
        self.out_at, self.inflater = 0, None
        if stop - self.raw_at <= len(self.raw):
            self._drop(stop - self.raw_at)
        else:
            self.file.seek(stop)
            self.raw, self.raw_at = b"", stop


def extra_length(extra: bytes) -> int | None:
    """The length of a member that the subfield `sl` of its extra field gives."""
    at = 0
    while at + 4 <= len(extra):
        size = struct.unpack_from("<H", extra, at + 2)[0]
        if extra[at : at + 2] == b"sl" and size >= 4:
            return struct.unpack_from("<I", extra, at + 4)[0] or None
        at += 4 + size
    return None


def gzip_member(data: list[bytes], level: int = 6) -> bytes:
    """One gzip member whose extra field tells its compressed and its plain length."""
    deflater, crc, size, parts = zlib.compressobj(level, zlib.DEFLATED, -15), 0, 0, []
    for part in data:
        parts.append(deflater.compress(part))
        crc, size = zlib.crc32(part, crc), size + len(part)
    parts.append(deflater.flush())
    body = b"".join(parts)
    total = 10 + 2 + 12 + len(body) + 8
    told = total if total < 1 << 32 else 0
    head = GZIP + bytes([8, EXTRA_FLAG, 0, 0, 0, 0, 0, 255]) + struct.pack("<H2sHII", 12, b"sl", 8, told, size & 0xFFFFFFFF)
    return head + body + struct.pack("<II", crc, size & 0xFFFFFFFF)


# ---- records ----


def parse_headers(data: bytes, first_line: bytes) -> dict[str, str]:
    """Header fields by lower-case name; folded lines are joined, of repeated fields the first counts."""
    lines = re.sub(rb"\r?\n[ \t]+", b" ", data).split(b"\n")
    if not lines[0].startswith(first_line):
        raise ValueError(f"{lines[0][:40]!r} does not begin a record")
    found: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if colon:
            found.setdefault(name.strip().decode("utf-8", "replace").lower(), value.strip().decode("utf-8", "replace"))
    return found


@dataclass
class Record:
    headers: dict[str, str]
    offset: int
    payload: bytes | None = None
    http_length: int | None = None

    def value(self, column: str):
        if column == "content_length":
            return int(self.headers["content-length"])
        return self.headers.get(FIELDS[column].lower())


def http_parts(block: bytes) -> tuple[int | None, bytes]:
    """The `Content-Length` of an HTTP message and its body."""
    head, _, body = block.partition(END)
    if not head.startswith(b"HTTP/"):
        return None, block
    length = parse_headers(head, b"HTTP/").get("content-length", "")
    return (int(length) if length.isascii() and length.isdigit() else None), body


def read_records(stream: Stream, wanted: Callable[[Record], bool], payload: bool) -> Iterator[Record]:
    """Records whose headers are wanted, in order; payloads only where asked for."""
    while not stream.at_end():
        alone, offset = stream.alone(), stream.position()
        record = Record(parse_headers(stream.until(END), b"WARC/"), offset)
        size, keep = record.value("content_length"), wanted(record)
        is_http = "application/http" in record.headers.get("content-type", "")
        revisit = record.headers.get("warc-type") == "revisit"
        if keep and (payload or revisit and is_http and size <= HEADER_BYTES):
            block = stream.read(size)
            record.http_length, body = http_parts(block) if is_http else (None, block)
            record.payload = None if revisit else body
        elif alone:
            stream.skip_member()
            if keep:
                yield record
            continue
        else:
            stream.skip(size)
        stream.skip(len(END))
        if keep:
            yield record


def clean(value: str) -> str:
    """A header value without control characters; they are percent-encoded."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record_bytes(row: dict, block: list[bytes]) -> list[bytes]:
    lines = [VERSION]
    for name, value in row.items():
        if value is not None:
            lines.append(f"{name}: {clean(str(value))}".encode("utf-8", "replace"))
    lines.append(b"Content-Length: %d" % sum(map(len, block)))
    return [b"\r\n".join(lines) + END, *block, END]


def page_block(payload: bytes | None, length: int) -> list[bytes]:
    """An HTTP response; a revisit has its head alone."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d" % length + END
    return [head] if payload is None else [head, payload]


# ---- the data source ----


def test_of(f: ds.Filter) -> Callable[[Record], bool] | None:
    """A test on headers for a filter of Spark, or None where headers cannot answer it."""
    if isinstance(f, ds.Not):
        if isinstance(f.child, ds.IsNull):
            return test_of(ds.IsNotNull(f.child.attribute))
        if isinstance(f.child, ds.IsNotNull):
            return test_of(ds.IsNull(f.child.attribute))
        inner = test_of(f.child)
        if inner is None or isinstance(f.child, ds.EqualNullSafe):
            return None if inner is None else lambda r: not inner(r)
        column = f.child.attribute[0]
        return lambda r: r.value(column) is not None and not inner(r)
    column, value = f.attribute[0], getattr(f, "value", None)
    if len(f.attribute) != 1 or column not in FIELDS:
        return None
    if isinstance(f, ds.IsNull):
        return lambda r: r.value(column) is None
    if isinstance(f, ds.IsNotNull):
        return lambda r: r.value(column) is not None
    if isinstance(f, ds.EqualNullSafe):
        return lambda r: r.value(column) == value
    holds = {
        ds.EqualTo: lambda x: x == value,
        ds.In: lambda x: x in value,
        ds.GreaterThan: lambda x: x > value,
        ds.GreaterThanOrEqual: lambda x: x >= value,
        ds.LessThan: lambda x: x < value,
        ds.LessThanOrEqual: lambda x: x <= value,
        ds.StringStartsWith: lambda x: x.startswith(value),
        ds.StringEndsWith: lambda x: x.endswith(value),
        ds.StringContains: lambda x: value in x,
    }.get(type(f))
    if holds is None or value is None or isinstance(f, ds.In) and None in value:
        return None
    return lambda r: (x := r.value(column)) is not None and holds(x)


def plan_files(path: str, partition_bytes: int) -> list[ds.InputPartition]:
    """Partitions of whole files, in order of their names; names that begin with `_` or `.` are left out."""
    system, root = pafs.FileSystem.from_uri(path)
    found = system.get_file_info(root)
    if found.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    infos = [found]
    if found.type == pafs.FileType.Directory:
        infos = system.get_file_info(pafs.FileSelector(root, recursive=True))
    files = [i for i in infos if i.type == pafs.FileType.File and not re.search(r"(^|/)[._]", i.path[len(root) :])]
    planned: list[list[str]] = []
    room = 0
    for info in sorted(files, key=lambda i: i.path):
        if info.size > room:
            planned.append([])
            room = partition_bytes
        planned[-1].append(info.path)
        room -= info.size
    return [ds.InputPartition(paths) for paths in planned or [[]]]


class WarcReader(ds.DataSourceReader):
    def __init__(self, options: dict, schema):
        self.path, self.schema = options["path"], schema
        self.payload = str(options.get("payload", "true")).lower() == "true"
        self.partition_bytes = int(options.get("partition_bytes", PARTITION_BYTES))
        self.filters: list[ds.Filter] = []

    def pushFilters(self, filters: list[ds.Filter]) -> Iterable[ds.Filter]:
        for f in filters:
            if test_of(f) is None:
                yield f
            else:
                self.filters.append(f)

    def partitions(self) -> list[ds.InputPartition]:
        return plan_files(self.path, self.partition_bytes)

    def read(self, partition: ds.InputPartition) -> Iterator[pa.RecordBatch]:
        tests = [test_of(f) for f in self.filters]
        system, _ = pafs.FileSystem.from_uri(self.path)
        rows, size = [], 0
        for path in partition.value:
            with system.open_input_file(path) as file:
                for r in read_records(Stream(file), lambda r: all(t(r) for t in tests), self.payload):
                    rows.append((path, r))
                    size += len(r.payload or b"")
                    if size >= BATCH_BYTES or len(rows) >= BATCH_ROWS:
                        yield self._batch(rows)
                        rows, size = [], 0
        if rows:
            yield self._batch(rows)

    def _batch(self, rows: list[tuple[str, Record]]) -> pa.RecordBatch:
        made = {
            "headers": lambda p, r: list(r.headers.items()),
            "http_length": lambda p, r: r.http_length,
            "payload": lambda p, r: r.payload,
            "file": lambda p, r: p,
            "offset": lambda p, r: r.offset,
        }
        kinds = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
        arrays = []
        for f in self.schema.fields:
            get = made.get(f.name) or (lambda p, r, name=f.name: r.value(name))
            kind = kinds.get(f.dataType.simpleString(), pa.map_(pa.string(), pa.string()))
            arrays.append(pa.array([get(p, r) for p, r in rows], kind))
        return pa.RecordBatch.from_arrays(arrays, names=self.schema.names)


@dataclass
class Written(ds.WriterCommitMessage):
    paths: list[str]


class WarcWriter(ds.DataSourceArrowWriter):
    """Writes rows `record_id, warc_type, target_uri, warc_date, payload_digest, refers_to, http_length, payload`."""

    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.level, self.max_bytes = int(options.get("level", 6)), int(options.get("max_bytes", FILE_BYTES))
        self.job = options.get("job") or datetime.now(UTC).strftime("%Y%m%dT%H%M%S%f")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        context = TaskContext.get()
        system, root = pafs.FileSystem.from_uri(self.path)
        folder = f"{root}/_temporary/{self.job}-{context.taskAttemptId()}"
        system.create_dir(folder, recursive=True)
        paths, file, size = [], None, 0
        for batch in iterator:
            names = batch.schema.names
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                row = dict(zip(names, row, strict=True))
                if file is None:
                    paths.append(f"{folder}/part-{self.job}-{context.partitionId():06d}-{len(paths):04d}.warc.gz")
                    file, size = system.open_output_stream(paths[-1], compression=None), 0
                member = gzip_member(self._record(row), self.level)
                file.write(member)
                size += len(member)
                if size >= self.max_bytes:
                    file.close()
                    file = None
        if file is not None:
            file.close()
        return Written(paths)

    @staticmethod
    def _record(row: dict) -> list[bytes]:
        payload = row.get("payload")
        length = row.get("http_length")
        head = {FIELDS[name]: row.get(name) for name in FIELDS if name != "content_length"}
        if row["warc_type"] == "revisit":
            head["WARC-Profile"], payload = REVISIT_PROFILE, None
        else:
            payload = b"" if payload is None else bytes(payload)
            length = len(payload)
        head["Content-Type"] = "application/http; msgtype=response"
        return record_bytes(head, page_block(payload, length or 0))

    def commit(self, messages: list[Written]) -> None:
        system, root = pafs.FileSystem.from_uri(self.path)
        system.create_dir(root, recursive=True)
        if self.overwrite:
            for info in system.get_file_info(pafs.FileSelector(root)):
                if info.base_name != "_temporary":
                    (system.delete_dir if info.type == pafs.FileType.Directory else system.delete_file)(info.path)
        for path in (p for m in messages if m for p in m.paths):
            system.move(path, f"{root}/{path.rsplit('/', 1)[1]}")
        if system.get_file_info(f"{root}/_temporary").type == pafs.FileType.Directory:
            system.delete_dir(f"{root}/_temporary")

    def abort(self, messages: list[Written]) -> None:
        system, _ = pafs.FileSystem.from_uri(self.path)
        for path in (p for m in messages if m for p in m.paths):  # what failed attempts wrote goes with the next commit
            if system.get_file_info(path).type == pafs.FileType.File:
                system.delete_file(path)


class WarcDataSource(ds.DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(dict(self.options), schema)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options), overwrite)


# ---- pages to archives and back ----


def read_warc(spark: SparkSession, path: str, payload: bool = True, partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """The records below `path`. Turns the session's filter pushdown for Python data sources on, which they need."""
    spark.conf.set(PUSHDOWN, "true")
    spark.dataSource.register(WarcDataSource)
    reader = spark.read.format(FORMAT).option("payload", str(payload).lower())
    return reader.option("partition_bytes", partition_bytes).load(path)


def base32(hexed: Column) -> Column:
    """Base 32 of 40 hexadecimal digits."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    groups = [F.conv(F.substring(hexed, 5 * g + 1, 5), 16, 10).cast("int") for g in range(8)]
    places = [F.shiftright(g, 15 - 5 * k).bitwiseAND(F.lit(31)) + 1 for g in groups for k in range(4)]
    return F.concat(*[F.lit(letters).substr(p, F.lit(1)) for p in places])


def _record_id(page: Column, row: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(":"), row.cast("string"), F.lit(">"))


def page_of(record_id: Column, kind: str) -> Column:
    """The page id in a record id."""
    return F.nullif(F.regexp_extract(record_id, "^<urn:page:(.*):[0-9]+>$", 1), F.lit("")).cast(kind)


def archive_pages(
    pages: DataFrame,
    path: str,
    id_column: str = "page_id",
    uri_column: str = "url",
    payload_column: str = "html",
    least_bytes: int = 0,
    date: str | None = None,
    level: int = 6,
) -> None:
    """Writes a record for every row of `pages` to archives below `path`."""
    payload = F.encode(F.coalesce(payload_column, F.lit("")), "UTF-8")
    rows, _ = numbered(
        pages.select(F.col(id_column).alias("id"), F.col(uri_column).alias("uri"), payload.alias("payload"))
    )
    digests = cut_lineage(
        rows.select(
            F.col("_row").alias("row"),
            "id",
            "uri",
            F.unhex(F.sha2("payload", 256)).alias("key"),
            F.octet_length("payload").cast("bigint").alias("size"),
            F.sha1("payload").alias("sha1"),
        )
    )
    shared = digests.filter(F.col("size") >= least_bytes).groupBy("key", "size").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("first"), F.count(F.lit(1)).alias("n")
    )
    shared = cut_lineage(shared.filter("n > 1").drop("n"))
    found = lookup_join(digests, shared, ["key", "size"]).filter(F.col("first").isNotNull() & (F.col("first.row") != F.col("row")))
    revisits = cut_lineage(found.select("row", "id", "uri", "size", "sha1", "first"))
    told = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")

    def records(kind: str, df: DataFrame, row: str, sha1: Column, refers_to: Column, length: Column, body: Column) -> DataFrame:
        return df.select(
            _record_id(F.col("id"), F.col(row)).alias("record_id"),
            F.lit(kind).alias("warc_type"),
            F.col("uri").alias("target_uri"),
            F.lit(told).alias("warc_date"),
            F.concat(F.lit("sha1:"), base32(F.upper(sha1))).alias("payload_digest"),
            refers_to.cast("string").alias("refers_to"),
            length.cast("bigint").alias("http_length"),
            body.cast("binary").alias("payload"),
        )

    new = rows.join(revisits.select(F.col("row").alias("_row")), "_row", "left_anti")
    none = F.lit(None)
    both = records("response", new, "_row", F.sha1("payload"), none, F.octet_length("payload"), F.col("payload")).unionByName(
        records("revisit", revisits, "row", F.col("sha1"), _record_id(F.col("first.id"), F.col("first.row")), F.col("size"), none)
    )
    pages.sparkSession.dataSource.register(WarcDataSource)
    both.write.format(FORMAT).mode("overwrite").option("level", level).save(path)


def archived_pages(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """`page_id, target_uri, payload, payload_bytes, payload_digest, record_type, refers_to` of every record of pages.

    Digest and size of a response are those of the payload as it was read; a revisit's stand in its headers. Two
    scans, each with its record type pushed down; only the one for responses decodes payloads.
    """
    full = read_warc(spark, path).filter(F.col("warc_type") == "response")
    slim = read_warc(spark, path, payload=False).filter(F.col("warc_type") == "revisit")
    read = F.coalesce("payload", F.lit(b""))
    sides = (
        (full, F.octet_length(read), base32(F.upper(F.sha1(read))), F.col("payload")),
        (slim, F.col("http_length"), F.substring_index("payload_digest", ":", -1), F.lit(None).cast("binary")),
    )
    made = [
        side.select(
            page_of(F.col("record_id"), id_type).alias("page_id"),
            "target_uri",
            body.alias("payload"),
            size.cast("bigint").alias("payload_bytes"),
            digest.alias("payload_digest"),
            F.col("warc_type").alias("record_type"),
            page_of(F.col("refers_to"), id_type).alias("refers_to"),
        )
        for side, size, digest, body in sides
    ]
    return made[0].unionByName(made[1])


def round_trip(pages: DataFrame, **names) -> DataFrame:
    """Writes the pages to an archive in the session's shared folder and reads it back."""
    path = scratch_path(pages.sparkSession, "warc")
    archive_pages(pages, path, **names)
    return archived_pages(pages.sparkSession, path)
