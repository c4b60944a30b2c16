"""WARC archives: a writer with revisit records and a reader that salvages damaged files.

Archives are written by the tasks that hold the pages, one gzip member per record; a file name is new for every attempt, and
only files that a finished task reported are read.

The reader checks every record: gzip's checksum, the version line, the block's length and digest, and the closing
blank lines. After a failure it searches for the next place where a record passes all that (a gzip header, or a version line
in uncompressed files), goes on from there, and logs the bytes in between as a gap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barspan.llm import texts as tx
from barspan.session import scratch_dir

FILE_BYTES = 64 << 20
CHUNK = 1 << 18
#: A header longer than this is damaged.
HEADER_BYTES = 1 << 16
DATE = "2024-01-01T00:00:00Z"

# Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
GZIP_START = b"\x1f\x8b\x08"
END = b"\r\n\r\n"
VERSION_LINE = re.compile(rb"WARC/1\.\d\r\n")


def digest(data: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response, or with ``refers_to`` a revisit of that page: its block has the response's head without the payload."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", f"<urn:page:{page_id}>"), ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", "".join(c if ord(c) > 32 else f"%{ord(c):02X}" for c in url)))
    if page_id is not None:
        fields.append(("Page-ID", str(page_id)))
    fields.append(("WARC-Payload-Digest", f"sha1:{digest(payload)}"))
    if refers_to is None:
        block += payload
    else:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    fields += [("WARC-Block-Digest", f"sha1:{digest(block)}"), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = b"".join(f"{k}: {v}\r\n".encode() for k, v in fields)
    return VERSION + b"\r\n" + head + b"\r\n" + block + END


@dataclass
class Record:
    fields: dict[str, str]
    block: bytes
    offset: int = 0
    end: int = 0

    @property
    def http(self) -> tuple[dict[str, str], bytes]:
        head, _, payload = self.block.partition(END)
        return dict(_fields(head)), payload


@dataclass
class Gap:
    offset: int
    end: int
    reason: str
    fields: dict[str, str] = field(default_factory=dict)


class Damaged(Exception):
    pass


def _fields(head: bytes) -> Iterator[tuple[str, str]]:
    for line in head.split(b"\r\n")[1:]:
        name, colon, value = line.decode("utf-8", "replace").partition(":")
        if colon:
            yield name.strip().lower(), value.strip()


def _parsed(head: bytes, block_and_end: bytes) -> Record:
    fields = dict(_fields(head))
    try:
        n = int(fields["content-length"])
    except (KeyError, ValueError):
        raise Damaged("no content length") from None
    if len(block_and_end) != n + len(END) or not block_and_end.endswith(END):
        raise Damaged("block length differs")
    block = block_and_end[:n]
    told = fields.get("warc-block-digest", "")
    if told.startswith("sha1:") and told[5:] != digest(block):
        raise Damaged("block digest differs")
    return Record(fields, block)


class SalvageReader:
    """Iterates over the records of one archive and the gaps between them, in bounded memory (one record and one chunk)."""

    def __init__(self, file: pa.NativeFile):
        self.file, self.size = file, file.size()

    def _at(self, offset: int, n: int) -> bytes:
        return self.file.read_at(max(min(n, self.size - offset), 0), offset)

    def _find(self, pattern: bytes, offset: int) -> int:
        """The next place of the pattern at or after the offset, or the file's size."""
        while offset < self.size:
            chunk = self._at(offset, CHUNK)
            at = chunk.find(pattern)
            if at >= 0:
                return offset + at
            if offset + len(chunk) >= self.size:
                break
            offset += len(chunk) - len(pattern) + 1
        return self.size

    def _member(self, offset: int) -> Record:
        inflate, parts, at = zlib.decompressobj(31), [], offset
        try:
            while not inflate.eof:
                chunk = self._at(at, CHUNK)
                if not chunk:
                    raise Damaged("member is cut off")
                parts.append(inflate.decompress(chunk))
                at += len(chunk)
                if len(parts) == 1 and parts[0] and not parts[0].startswith(VERSION[:7]):
                    raise Damaged("no version line")
        except zlib.error as e:
            raise Damaged(f"member: {e}") from None
        head, found, rest = b"".join(parts).partition(END)
        if not found or not VERSION_LINE.match(head):
            raise Damaged("no version line")
        record = _parsed(head, rest)
        record.offset, record.end = offset, at - len(inflate.unused_data)
        return record

    def _plain(self, offset: int) -> Record:
        head, found, _ = self._at(offset, HEADER_BYTES).partition(END)
        if not found or not VERSION_LINE.match(head):
            raise Damaged("no version line")
        start = offset + len(head) + len(END)
        try:
            n = max(int(dict(_fields(head)).get("content-length", "")), 0)
        except ValueError:
            raise Damaged("no content length") from None
        if start + n + len(END) > self.size:
            raise Damaged("block is cut off")
        record = _parsed(head, self._at(start, n + len(END)))
        record.offset, record.end = offset, start + n + len(END)
        return record

    def _record(self, offset: int) -> Record:
        return self._member(offset) if self._at(offset, 3) == GZIP_START else self._plain(offset)

    def __iter__(self) -> Iterator[Record | Gap]:
        at = 0
        while at < self.size:
            try:
                record = self._record(at)
            except Damaged as e:
                gap, at = self._after(at, str(e))
                yield gap
                continue
            yield record
            at = record.end

    def _after(self, start: int, reason: str) -> tuple[Gap, int]:
        """The gap from a failed record to the next place where a record passes."""
        at = start
        places = {p: -1 for p in (GZIP_START, VERSION[:7])}
        while True:
            for pattern, place in places.items():
                if place <= at:
                    places[pattern] = self._find(pattern, at + 1)
            at = min(places.values())
            if at >= self.size:
                return Gap(start, self.size, reason), self.size
            try:
                self._record(at)
            except Damaged:
                continue
            return Gap(start, at, reason), at


def with_revisits(pages: DataFrame, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, payload, refers_to): of equal payloads of ``least_bytes`` or more, all but the smallest id refer to it.

    Null payloads are empty. Rows without id never refer nor are referred to; rows that share the smallest id are all responses. Other
    columns are ignored.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col).cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("sha", F.when(F.length("payload") >= least_bytes, F.sha1("payload")))
    counted = rows.where("sha IS NOT NULL AND page_id IS NOT NULL").groupBy("sha").agg(F.min("page_id").alias("first"), F.max("page_id").alias("last"))
    repeated = counted.where("first < last").select("sha", "first")
    met = rows.join(repeated, "sha", "left")
    return met.select("page_id", "url", "payload", F.when(F.col("page_id") > F.col("first"), F.col("first")).alias("refers_to"))


def write_archives(records: DataFrame, folder: str, compressed: bool = True) -> DataFrame:
    """Write rows of ``with_revisits`` to .warc(.gz) files below ``folder`` and return (path, n_records, n_bytes) as they were written.

    The frame writes when it is evaluated: keep its rows, as ``archives`` does. An empty table gives no file.
    """
    spark = records.sparkSession
    tx.small_batches(spark)
    folder = tx.qualified(spark, folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        out, name, n = None, "", 0

        def closed() -> pa.RecordBatch:
            size = out.tell()
            out.close()
            columns = [pa.array([f"{folder}/{name}"]), pa.array([n], pa.int64()), pa.array([size], pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["path", "n_records", "n_bytes"])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "refers_to"))):
                if out is None:
                    fs.create_dir(root, recursive=True)
                    name, n = f"pages-{uuid.uuid4().hex}.warc{'.gz' if compressed else ''}", 0
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)
                data = record_bytes(*row)
                if compressed:
                    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
                    data = deflate.compress(data) + deflate.flush()
                out.write(data)
                n += 1
                if out.tell() >= FILE_BYTES:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    return records.mapInArrow(write, "path string, n_records long, n_bytes long")


def archives(pages: DataFrame, folder: str | None = None, least_bytes: int = 0, compressed: bool = True, **columns) -> DataFrame:
    """Write the pages as archives (in a new scratch folder by default) and return the list of files."""
    spark = pages.sparkSession
    folder = folder or scratch_dir(spark, "warc")
    written = write_archives(with_revisits(pages, least_bytes, **columns), f"{folder}/files", compressed)
    written.write.mode("overwrite").parquet(f"{folder}/list")
    return spark.read.schema(written.schema).parquet(f"{folder}/list")


_READ = (
    "path string, offset long, end long, gap string, record_type string, page_id long, url string, "
    "payload_bytes long, payload_digest string, refers_to long, payload binary"
)


def read_archives(files: DataFrame, payloads: bool = True) -> DataFrame:
    """One row per record of the files (column ``path``) and per gap (``gap`` tells the reason, else null).

    Payload size and digest are those of the full payload, for revisits too. An empty file gives no row.
    """

    def number(text: str | None) -> int | None:
        text = (text or "").removeprefix("<urn:page:").removesuffix(">")
        return int(text) if text.removeprefix("-").isdigit() else None

    def row(path: str, x: Record | Gap) -> tuple:
        if isinstance(x, Gap):
            return path, x.offset, x.end, x.reason, *[None] * 7
        http, payload = x.http
        revisit = x.fields.get("warc-type") == "revisit"
        size = number(http.get("content-length")) if revisit else len(payload)
        told = x.fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
        name = told if revisit else digest(payload)
        refers = number(x.fields.get("warc-refers-to")) if revisit else None
        kept = payload if payloads and not revisit else None
        return path, x.offset, x.end, None, x.fields.get("warc-type"), number(x.fields.get("page-id")), x.fields.get("warc-target-uri"), size, name, refers, kept

    schema = pa.schema([(c.split()[0], {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[c.split()[1]]) for c in _READ.split(", ")])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                fs, at = pafs.FileSystem.from_uri(path)
                with fs.open_input_file(at) as file:
                    some = []
                    for x in SalvageReader(file):
                        some.append(row(path, x))
                        if len(some) >= tx.BATCH_ROWS:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), schema.types)], schema=schema)
                            some = []
                    if some:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), schema.types)], schema=schema)

    parts = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.select("path").repartition(parts, "path").mapInArrow(read, _READ)
