"""WARC archives as a Spark data source: ``spark.read.format("warc")`` and ``df.write.format("warc")``.

Reading plans partitions of whole files, small ones together. Predicates on the columns of the headers
(record type, target, id, digest, date, what is referred to) are pushed into the reader: of every
record the headers are parsed first, and the payload of a record that is not wanted is neither decoded nor
hashed, in plain files not even read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull, StringStartsWith,
    WriterCommitMessage,
)

from weftgraph.llm.store import numbered, store
from weftgraph.plans.sizing import broadcast_if_small

VERSION = b"WARC/1.1"
#: Columns and the WARC header each is read from.
HEADERS = {
    "record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri", "date": "warc-date",
    "payload_digest": "warc-payload-digest", "refers_to": "warc-refers-to",
}
SCHEMA = T.StructType(
    [*[T.StructField(c, T.StringType()) for c in HEADERS], T.StructField("payload_bytes", T.LongType()), T.StructField("payload", T.BinaryType())]
)
#: Bytes of archive in a partition; a larger file is a partition of its own.
PARTITION_BYTES = 128 << 20
#: A file is closed and the next begun after so many bytes of records.
FILE_BYTES = 256 << 20
#: Rows handed to Spark together, by payload bytes.
BATCH_BYTES = 4 << 20


def digest(payload: bytes) -> str:
    """SHA-1 as archives write it: upper-case base 32."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if re.match(r"^[a-z0-9+.-]+:", path):
        return pafs.FileSystem.from_uri(path if "://" in path else path.replace(":", "://", 1))
    return pafs.LocalFileSystem(), path


class Input:
    """A file read record by record, plain or of gzip members; ``skip`` does not keep what it passes."""

    def __init__(self, stream, zipped: bool):
        self.stream, self.zipped = stream, zipped
        self.buffer = b""
        self.unzip = zlib.decompressobj(31) if zipped else None
        self.raw = b""

    def _more(self, size: int = 1 << 20) -> bool:
        if not self.zipped:
            got = self.stream.read(size)
            self.buffer += got
            return bool(got)
        while True:
            if not self.raw:
                self.raw = self.stream.read(size)
                if not self.raw:
                    return False
            if self.unzip.eof:
                self.unzip = zlib.decompressobj(31)
            got = self.unzip.decompress(self.raw, 1 << 22)
            self.raw = self.unzip.unconsumed_tail or self.unzip.unused_data
            if got:
                self.buffer += got
                return True

    def until(self, mark: bytes) -> bytes | None:
        """What comes before ``mark``, which is passed; None at the end of the file."""
        at = 0
        while (found := self.buffer.find(mark, at)) < 0:
            at = max(0, len(self.buffer) - len(mark) + 1)
            if not self._more(1 << 16):
                if self.buffer.strip():
                    raise ValueError("the archive breaks off within a header")
                return None
        head, self.buffer = self.buffer[:found], self.buffer[found + len(mark) :]
        return head

    def take(self, size: int) -> bytes:
        parts, have = [self.buffer], len(self.buffer)
        self.buffer = b""
        while have < size:
            if not self._more():
                raise ValueError("the archive breaks off within a record")
            parts.append(self.buffer)
            have += len(self.buffer)
            self.buffer = b""
        whole = b"".join(parts)
        self.buffer = whole[size:]
        return whole[:size]

    def skip(self, size: int) -> None:
        if size <= len(self.buffer):
            self.buffer = self.buffer[size:]
            return
        size -= len(self.buffer)
        self.buffer = b""
        if not self.zipped:
            self.stream.seek(size, 1)
            return
        while size > 0:
            if not self._more():
                raise ValueError("the archive breaks off within a record")
            have, self.buffer = self.buffer, self.buffer[size:]
            size -= len(have)


def header_fields(block: bytes) -> dict[str, str]:
    """Named fields by lower-case name; a line that begins with a blank goes on with the one above."""
    fields: dict[str, str] = {}
    name = ""
    for line in block.decode("utf-8", "replace").split("\r\n"):
        if line[:1] in (" ", "\t") and name:
            fields[name] += " " + line.strip()
        elif ":" in line:
            name, value = line.split(":", 1)
            name = name.strip().lower()
            fields[name] = value.strip()
    return fields


def records(source: Input, wanted, payloads: bool = True) -> Iterator[tuple]:
    """Rows of ``SCHEMA`` for the records whose headers are ``wanted``.

    The payload of a response is what follows its HTTP headers. A revisit has none; its size is the
    content length its HTTP headers state. A payload that does not fit its digest is an error.
    """
    while (block := source.until(b"\r\n\r\n")) is not None:
        first, _, rest = block.lstrip(b"\r\n").partition(b"\r\n")
        if not first.startswith(b"WARC/"):
            raise ValueError(f"no WARC record begins with {first[:40]!r}")
        fields = header_fields(rest)
        size = int(fields["content-length"])
        row = {c: fields.get(h) for c, h in HEADERS.items()}
        if not wanted(row):
            source.skip(size)
            source.skip(4)
            continue
        payload, length = None, None
        http = fields.get("content-type", "").startswith("application/http")
        if row["record_type"] == "revisit" or (http and not payloads):
            head = source.until(b"\r\n\r\n") if size and http else b""
            used = len(head) + 4 if size and http else 0
            stated = header_fields(head.partition(b"\r\n")[2]).get("content-length")
            length = int(stated) if stated is not None else None
            source.skip(size - used)
        elif payloads:
            body = source.take(size)
            payload = body.partition(b"\r\n\r\n")[2] if http else body
            length = len(payload)
            stated = row["payload_digest"]
            if stated and stated.lower().startswith("sha1:") and digest(payload) != stated[5:].upper():
                raise ValueError(f"the payload of {row['record_id']} does not fit its digest")
        else:
            length = size
            source.skip(size)
        source.skip(4)
        yield (*row.values(), length, payload)


@dataclass
class Files(InputPartition):
    paths: Sequence[str]


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payloads: bool):
        self.path, self.payloads = path, payloads
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]):  # noqa: N802 - the name Spark calls
        for f in filters:
            column = getattr(f, "attribute", ())
            known = len(column) == 1 and column[0] in HEADERS
            if known and isinstance(f, EqualTo):
                self.tests.append(("in", column[0], {f.value}))
            elif known and isinstance(f, In):
                self.tests.append(("in", column[0], set(f.value)))
            elif known and isinstance(f, StringStartsWith):
                self.tests.append(("starts", column[0], f.value))
            elif known and isinstance(f, IsNotNull):
                self.tests.append(("present", column[0], None))
            else:
                yield f

    def wanted(self, row: dict) -> bool:
        for kind, column, value in self.tests:
            have = row[column]
            if have is None or (kind == "in" and have not in value) or (kind == "starts" and not have.startswith(value)):
                return False
        return True

    def partitions(self) -> list[Files]:
        """Files of the folder, larger first, packed to about ``PARTITION_BYTES``."""
        system, path = file_system(self.path)
        info = system.get_file_info(path)
        if info.type == pafs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        found = [info] if info.type == pafs.FileType.File else system.get_file_info(pafs.FileSelector(path, recursive=True))
        files = [f for f in found if f.type == pafs.FileType.File and re.search(r"(^|/)[^_./][^/]*\.warc(\.gz)?$", f.path)]
        parts: list[list[str]] = []
        room = 0
        for f in sorted(files, key=lambda f: (-f.size, f.path)):
            if not parts or f.size > room:
                parts.append([])
                room = PARTITION_BYTES
            parts[-1].append(f.path)
            room -= f.size
        return [Files(p) for p in parts]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        system, _ = file_system(self.path)
        schema = pa.schema([*[(c, pa.string()) for c in HEADERS], ("payload_bytes", pa.int64()), ("payload", pa.binary())])
        for path in partition.paths:
            with system.open_input_file(path) as stream:
                rows: list[tuple] = []
                held = 0
                for row in records(Input(stream, path.endswith(".gz")), self.wanted, self.payloads):
                    rows.append(row)
                    held += 500 + len(row[-1] or b"")
                    if held >= BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, str]]


def warc_record(fields: list[tuple[str, str]], body: bytes) -> bytes:
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in fields), b"Content-Length: %d" % len(body)]
    return b"\r\n".join(lines) + b"\r\n\r\n" + body + b"\r\n\r\n"


class WarcWriter(DataSourceArrowWriter):
    """One or more files per task under a name of their own; the driver renames those of finished tasks."""

    def __init__(self, path: str, zipped: bool):
        self.path, self.zipped, self.job = path, zipped, uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, folder = file_system(self.path)
        system.create_dir(folder, recursive=True)
        context = TaskContext.get()
        files: list[tuple[str, str]] = []
        stream, size = None, 0

        def put(record: bytes) -> int:
            if self.zipped:
                packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                record = packer.compress(record) + packer.flush()
            stream.write(record)
            return len(record)

        for batch in iterator:
            for row in batch.to_pylist():
                if stream is None or size >= FILE_BYTES:
                    if stream is not None:
                        stream.close()
                    name = f"{self.job}-{context.partitionId():05d}-{len(files):03d}.warc{'.gz' if self.zipped else ''}"
                    hidden = f"{folder}/_{context.taskAttemptId()}-{name}"
                    files.append((hidden, f"{folder}/{name}"))
                    stream, size = system.open_output_stream(hidden, compression=None), 0
                    size += put(
                        warc_record(
                            [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"),
                             ("WARC-Date", row["date"]), ("Content-Type", "application/warc-fields")],
                            b"format: WARC File Format 1.1\r\n",
                        )
                    )
                size += put(self.record(row))
        if stream is not None:
            stream.close()
        return Written(files)

    def record(self, row: dict) -> bytes:
        payload = row["payload"] or b""
        revisit = row["record_type"] == "revisit"
        length = row["payload_bytes"] if row["payload_bytes"] is not None else len(payload)
        stated = row["payload_digest"] or f"sha1:{digest(payload)}"
        http = (
            b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % length
        )
        fields = [("WARC-Type", row["record_type"]), ("WARC-Record-ID", row["record_id"]), ("WARC-Date", row["date"])]
        if row["target_uri"] is not None:
            fields.append(("WARC-Target-URI", re.sub(r"[\r\n\t ]+", "%20", row["target_uri"])))
        fields += [("WARC-Payload-Digest", stated), ("Content-Type", "application/http; msgtype=response")]
        if revisit:
            fields.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
            fields.append(("WARC-Refers-To", row["refers_to"]))
        return warc_record(fields, http if revisit else http + payload)

    def commit(self, messages: list[Written | None]) -> None:
        system, _ = file_system(self.path)
        for message in messages:
            for hidden, name in message.files if message else ():
                system.move(hidden, name)

    def abort(self, messages: list[Written | None]) -> None:
        system, _ = file_system(self.path)
        for message in messages:
            for hidden, _ in message.files if message else ():
                system.delete_file(hidden)


class WarcDataSource(DataSource):
    """Options: ``path``; ``payload`` (false: no payloads are read); ``compression`` (``none`` or ``gzip``)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> T.StructType:
        return SCHEMA

    def reader(self, schema: T.StructType) -> WarcReader:
        return WarcReader(self.options["path"], self.options.get("payload", "true").lower() != "false")

    def writer(self, schema: T.StructType, overwrite: bool) -> WarcWriter:
        kind = self.options.get("compression", "none").lower()
        if kind not in ("none", "gzip"):
            raise ValueError(f"compression {kind!r}: none or gzip")
        return WarcWriter(self.options["path"], kind == "gzip")


def register(spark: SparkSession) -> None:
    """Make the format known to the session, with predicates pushed into it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def record_id(page: F.Column) -> F.Column:
    return F.concat(F.lit("<urn:page:"), page.cast("string"), F.lit(">"))


def page_of(record: F.Column) -> F.Column:
    return F.regexp_extract(record, r"^<urn:page:(-?\d+)(?:\.\d+)?>$", 1).try_cast("long")


def page_records(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 0,
    date: str = "2024-01-01T00:00:00Z",
) -> DataFrame:
    """A row of ``SCHEMA`` for each page: a response, or a revisit of the first page with the same payload.

    Payloads of fewer than ``least_bytes`` bytes are all responses. Pages are alike if their SHA-256 is;
    the smallest id is the response, of equal ids the first row. Where an id repeats, its further rows bear
    their row number behind the id. A null html is the empty payload; a null id is larger than any and
    written as none. Equal payloads are counted map-side; only repeated ones meet the pages again.
    """
    body = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    pages, row = numbered(pages)
    rows = pages.select(
        F.col(row).alias("row"), F.col(id_col).cast("long").alias("page"), F.col(url_col).cast("string").alias("url"), body.alias("body")
    )
    rows = rows.withColumn("sha", F.unhex(F.sha2("body", 256))).withColumn("bytes", F.length("body").cast("long"))
    place = F.struct(F.col("page").isNull().alias("none"), F.col("page"), F.col("row"))
    first = (
        rows.filter(F.col("bytes") >= least_bytes)
        .groupBy("sha")
        .agg(F.min(place).alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
    )
    first = store(first.select("sha", F.col("first.page").alias("first_page"), F.col("first.row").alias("first_row")), "repeated-payloads")
    ids = store(rows.groupBy(F.col("page").alias("id")).agg(F.min("row").alias("id_row"), F.count("*").alias("n")).filter("n > 1").drop("n"), "repeated-ids")

    def with_record(df: DataFrame, page: str, row: str, name: str) -> DataFrame:
        """The record id of a row: its page id, and the row number unless it is the first row of that id."""
        found = df.join(broadcast_if_small(ids), F.col(page).eqNullSafe(F.col("id")), "left")
        number = F.when(F.col("id_row") != F.col(row), F.concat(F.lit("."), F.col(row).cast("string"))).otherwise("")
        shown = F.coalesce(F.col(page).cast("string"), F.lit("none"))
        return found.withColumn(name, F.concat(F.lit("<urn:page:"), shown, number, F.lit(">"))).drop("id", "id_row")

    first = with_record(first, "first_page", "first_row", "first_record")
    met = with_record(rows.join(broadcast_if_small(first), "sha", "left"), "page", "row", "record_id")
    again = F.col("first_row").isNotNull() & (F.col("row") != F.col("first_row"))
    return met.select(
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        "record_id",
        F.coalesce("url", F.lit("urn:none")).alias("target_uri"),
        F.lit(date).alias("date"),
        F.concat(F.lit("sha1:"), base32_sha1(F.col("body"))).alias("payload_digest"),
        F.when(again, F.col("first_record")).alias("refers_to"),
        F.col("bytes").alias("payload_bytes"),
        F.when(~again, F.col("body")).alias("payload"),
    )


def base32_sha1(body: F.Column) -> F.Column:
    """Base 32 of the SHA-1 of a binary column: five bits of its 40 hex digits at a time."""
    hexed = F.sha1(body)
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    out = []
    for i in range(8):  # 20 bits make four letters
        number = F.conv(F.substring(hexed, 5 * i + 1, 5), 16, 10).cast("int")
        out += [F.substring(letters, F.shiftright(number, shift).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for shift in (15, 10, 5, 0)]
    return F.concat(*out)


def write_pages(pages: DataFrame, folder: str, compression: str = "none", **options) -> None:
    """Write a record per page to new archives under ``folder``."""
    register(pages.sparkSession)
    page_records(pages, **options).write.format("warc").mode("append").option("compression", compression).save(folder)


def read_archives(spark: SparkSession, folder: str, payload: bool = True) -> DataFrame:
    """The records of all archives under ``folder``."""
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(folder)
