"""Operator 8, WARC: a PySpark data source that writes and reads WARC 1.1 archives.

Writing: every task writes one ``.warc.gz`` file of its own (named by partition and attempt), one gzip member per
record. A member's gzip header carries the standard's skip-lengths field ``sl`` (compressed and plain length), so a reader
can step over a record without inflating it. Tasks report the chunks of their files; the commit writes them to a
manifest, so files of failed or repeated attempts are never read.

Reading: one partition per chunk of the manifest (without a manifest: per ``*.warc`` or ``*.warc.gz`` file). Of each
record the headers are parsed first; predicates on the record type and other headers are pushed down and tested there, and
a record that is not wanted, or whose payload is not in the schema, is skipped without decoding its block.

Paths are opened through pyarrow's file systems (local, hdfs, s3, gs), never through local calls.
"""

from __future__ import annotations

import io
import json
import re
import uuid
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition,
                                    IsNotNull, IsNull, StringStartsWith, WriterCommitMessage)
from pyspark.sql.types import StructType

from retentia.llm.common import scratch_path, store, table

SCHEMA = ("record_id string, record_type string, target_uri string, date string, refers_to string, "
          "payload_digest string, payload_length long, payload binary")
#: Column -> WARC header that holds it.
HEADERS = {"record_id": "warc-record-id", "record_type": "warc-type", "target_uri": "warc-target-uri", "date": "warc-date",
           "refers_to": "warc-refers-to", "payload_digest": "warc-payload-digest"}
MANIFEST = "_manifest.json"
CHUNK_BYTES = 32 << 20
BATCH_BYTES = 4 << 20
LEVEL = 4
#: Fixed values of the WARC 1.1 standard.
VERSION = b"WARC/1.1\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _open_fs(path: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(path if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", path) else f"file://{path}")


def _bare(uri: str | None) -> str | None:
    return uri[1:-1] if uri and uri[0] == "<" and uri[-1] == ">" else uri


def _value(text: str) -> str:
    """A header value on one line: control characters are percent-encoded."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


# ---------------------------------------------------------------- writing

def record_bytes(row: dict) -> bytes:
    """A plain WARC record. A revisit (or any row with null payload) keeps its HTTP headers and has no payload."""
    payload = row.get("payload")
    length = row["payload_length"] if row.get("payload_length") is not None else len(payload or b"")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = http + (payload or b"")
    head = [f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: <{_value(row['record_id'])}>",
            f"WARC-Date: {row.get('date') or '1970-01-01T00:00:00Z'}"]
    if row.get("target_uri") is not None:
        head.append(f"WARC-Target-URI: {_value(row['target_uri'])}")
    if row.get("refers_to") is not None:
        head.append(f"WARC-Refers-To: <{_value(row['refers_to'])}>")
    if row["record_type"] == "revisit":
        head.append(f"WARC-Profile: {REVISIT_PROFILE}")
    if row.get("payload_digest") is not None:
        head.append(f"WARC-Payload-Digest: sha1:{row['payload_digest']}")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return VERSION + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = LEVEL) -> bytes:
    """One gzip member whose extra field ``sl`` holds the member's compressed and plain length (0: over 32 bits)."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    total = 24 + len(body) + 8
    lengths = struct.pack("<II", total, len(data)) if max(total, len(data)) < 1 << 32 else struct.pack("<II", 0, 0)
    head = b"\x1f\x8b\x08\x04" + b"\0\0\0\0" + b"\0\xff" + struct.pack("<H", 12) + b"sl" + struct.pack("<H", 8) + lengths
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


@dataclass
class WarcCommit(WriterCommitMessage):
    file: str
    chunks: list = field(default_factory=list)


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.level = int(options.get("level", LEVEL))
        self.chunk_bytes = int(options.get("chunkbytes", CHUNK_BYTES))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WarcCommit:
        task = TaskContext.get()
        name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}-{uuid.uuid4().hex}.warc.gz"
        fs, base = _open_fs(self.path)
        fs.create_dir(base, recursive=True)
        at, start, chunks = 0, 0, []
        with fs.open_output_stream(f"{base}/{name}", compression=None, buffer_size=1 << 20) as out:
            for batch in iterator:
                for i in range(batch.num_rows):  # row by row, so that one record at a time is a Python object
                    row = {n: c[i].as_py() for n, c in zip(batch.schema.names, batch.columns)}
                    member = gzip_member(record_bytes(row), self.level)
                    out.write(member)
                    at += len(member)
                    if at - start >= self.chunk_bytes:
                        chunks.append((start, at - start))
                        start = at
        if at > start:
            chunks.append((start, at - start))
        return WarcCommit(name, chunks)

    def commit(self, messages: list) -> None:
        fs, base = _open_fs(self.path)
        listed = [{"file": m.file, "chunks": m.chunks} for m in messages if m is not None]
        if fs.get_file_info(f"{base}/{MANIFEST}").type == pa.fs.FileType.File:  # an archive is there already: its files stay listed
            with fs.open_input_stream(f"{base}/{MANIFEST}", compression=None) as f:
                listed = json.loads(f.read()) + listed
        with fs.open_output_stream(f"{base}/{MANIFEST}.new", compression=None) as out:
            out.write(json.dumps(listed).encode())
        fs.move(f"{base}/{MANIFEST}.new", f"{base}/{MANIFEST}")

    def abort(self, messages: list) -> None:
        fs, base = _open_fs(self.path)
        for m in messages:
            if m is not None and fs.get_file_info(f"{base}/{m.file}").type == pa.fs.FileType.File:
                fs.delete_file(f"{base}/{m.file}")


# ---------------------------------------------------------------- reading

class _Record:
    """Headers of the record at a position, the means to read its block, and where the next record starts."""

    def __init__(self, headers: dict, more, end: int | None):
        self.headers, self.more, self.end = headers, more, end


def _parse_headers(head: bytes) -> dict[str, str]:
    lines = head.split(b"\r\n")
    if not lines[0].startswith(b"WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    pairs = (x.split(b":", 1) for x in lines[1:] if b":" in x)
    return {k.decode("latin-1").strip().lower(): v.decode("utf-8", "replace").strip() for k, v in pairs}


def _gzip_header(f) -> int | None:
    """Reads a member's header; the member's compressed length if it is given."""
    fixed = f.read(10)
    if len(fixed) < 10 or fixed[:3] != b"\x1f\x8b\x08":
        raise ValueError("not a gzip member")
    flags, length = fixed[3], None
    if flags & 4:
        extra = f.read(struct.unpack("<H", f.read(2))[0])
        while len(extra) >= 4:
            size = struct.unpack("<H", extra[2:4])[0]
            if extra[:2] == b"sl" and size == 8:
                length = struct.unpack("<II", extra[4:12])[0] or None
            extra = extra[4 + size:]
    for flag in (8, 16):  # file name, comment
        if flags & flag:
            while f.read(1) not in (b"\0", b""):
                pass
    if flags & 2:
        f.read(2)
    return length


def _gzip_record(f, start: int) -> _Record:
    f.seek(start)
    member = _gzip_header(f)
    inflate = zlib.decompressobj(-15)
    buffer, feed = b"", b""

    def more(most: int) -> bytes:
        """Up to ``most`` further plain bytes; empty at the member's end."""
        nonlocal feed
        while not inflate.eof:
            feed = feed or f.read(1 << 14)
            if not feed:
                raise ValueError("archive ends within a record")
            out = inflate.decompress(feed, most)
            feed = inflate.unconsumed_tail
            if out:
                return out
        return b""

    while b"\r\n\r\n" not in buffer:
        out = more(2048)
        if not out:
            raise ValueError("record without headers")
        buffer += out
    head, rest = buffer.split(b"\r\n\r\n", 1)

    def block(most: int) -> bytes:
        nonlocal rest
        out, rest = (rest, b"") if rest else (more(most), b"")
        return out

    def end() -> int:
        while more(1 << 16):
            pass
        return f.tell() - len(inflate.unused_data) + 8

    record = _Record(_parse_headers(head), block, start + member if member else None)
    record.find_end = end
    return record


def _plain_record(f, start: int) -> _Record:
    f.seek(start)
    buffer = b""
    while b"\r\n\r\n" not in buffer:
        got = f.read(2048)
        if not got:
            raise ValueError("record without headers")
        buffer += got
    head, rest = buffer.split(b"\r\n\r\n", 1)
    headers = _parse_headers(head)
    begin = start + len(head) + 4
    f.seek(begin)
    return _Record(headers, f.read, begin + int(headers["content-length"]) + 4)


def _block(record: _Record, most: int | None = None) -> bytes:
    """The record's block, or at least its HTTP headers if ``most`` is given."""
    length = int(record.headers["content-length"])
    parts, size = [], 0
    while size < length:
        got = record.more(min(1 << 16, length - size) if most is None else 1024)
        if not got:
            raise ValueError("archive ends within a record")
        parts.append(got)
        size += len(got)
        if most is not None and (size >= most or b"\r\n\r\n" in b"".join(parts[-2:])):
            break
    return b"".join(parts)[:length]


def _http_length(block: bytes) -> int | None:
    m = re.search(rb"^content-length:[ \t]*(\d+)", block.split(b"\r\n\r\n", 1)[0], re.I | re.M)
    return int(m[1]) if m else None


def _wanted(predicates: list[tuple], values: dict) -> bool:
    for kind, column, operand in predicates:
        v = values[column]
        ok = {"eq": lambda: v == operand, "in": lambda: v in operand, "notnull": lambda: v is not None,
              "null": lambda: v is None, "starts": lambda: v is not None and v.startswith(operand)}[kind]()
        if not ok:
            return False
    return True


@dataclass
class Chunk(InputPartition):
    file: str
    start: int
    length: int | None

    def __post_init__(self):
        super().__init__((self.file, self.start))


class WarcReader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.path, self.schema = options["path"], schema
        self.predicates: list[tuple] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column not in HEADERS:
                yield f
            elif isinstance(f, EqualTo):
                self.predicates.append(("eq", column, f.value))
            elif isinstance(f, In):
                self.predicates.append(("in", column, list(f.value)))
            elif isinstance(f, IsNotNull):
                self.predicates.append(("notnull", column, None))
            elif isinstance(f, IsNull):
                self.predicates.append(("null", column, None))
            elif isinstance(f, StringStartsWith):
                self.predicates.append(("starts", column, f.value))
            else:
                yield f

    def partitions(self) -> list[Chunk]:
        fs, base = _open_fs(self.path)
        if fs.get_file_info(f"{base}/{MANIFEST}").type == pa.fs.FileType.File:
            with fs.open_input_stream(f"{base}/{MANIFEST}") as f:
                listed = json.loads(f.read())
            found = [Chunk(f"{base}/{x['file']}", a, n) for x in listed for a, n in x["chunks"]]
        else:
            info = fs.get_file_info(base)
            files = [info] if info.type == pa.fs.FileType.File else fs.get_file_info(pa.fs.FileSelector(base))
            found = [Chunk(x.path, 0, None) for x in sorted(files, key=lambda x: x.path) if re.search(r"\.warc(\.gz)?$", x.path)]
        return found or [Chunk("", 0, 0)]  # an archive without records

    def read(self, partition: Chunk) -> Iterator[pa.RecordBatch]:
        if not partition.file:
            return
        fs, _ = _open_fs(self.path)
        names = self.schema.fieldNames()
        arrow = pa.schema([(n, {"payload": pa.binary(), "payload_length": pa.int64()}.get(n, pa.string())) for n in names])
        rows, held = [], 0
        with fs.open_input_file(partition.file) as native:
            f = io.BufferedReader(native, 1 << 18)
            at, stop = partition.start, partition.start + partition.length if partition.length is not None else native.size()
            while at < stop:
                f.seek(at)
                gz = f.peek(2)[:2] == b"\x1f\x8b"
                record = (_gzip_record if gz else _plain_record)(f, at)
                values = {c: record.headers.get(h) for c, h in HEADERS.items()}
                for c in ("record_id", "refers_to"):
                    values[c] = _bare(values[c])
                if values["payload_digest"] is not None:
                    values["payload_digest"] = values["payload_digest"].removeprefix("sha1:")
                if _wanted(self.predicates, values):
                    if "payload" in names:
                        block = _block(record)
                        http = block.startswith(b"HTTP/")
                        values["payload_length"] = _http_length(block) if http else len(block)
                        values["payload"] = block.split(b"\r\n\r\n", 1)[1] if http and b"\r\n\r\n" in block else block
                        held += len(block)
                    elif "payload_length" in names:
                        values["payload_length"] = _http_length(_block(record, 1 << 16))
                    rows.append({n: values.get(n) for n in names})
                    if held >= BATCH_BYTES or len(rows) >= 4096:
                        yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                        rows, held = [], 0
                at = record.end if record.end is not None else record.find_end()
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)


class WarcDataSource(DataSource):
    """``spark.read.format("warc").load(path)`` and ``df.write.format("warc").mode("append").save(path)``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        unknown = set(schema.fieldNames()) - {*HEADERS, "payload", "payload_length"}
        if unknown:
            raise ValueError(f"WARC archives have no columns {sorted(unknown)}")
        return WarcReader(self.options, schema)

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        if overwrite:
            raise ValueError("archives are written to a new path, with mode append")
        return WarcWriter(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme: one without is on the file system that Hadoop has as default, for driver and executors alike."""
    given = spark._jvm.org.apache.hadoop.fs.Path(path)
    return str(given.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(given).toString())


def read_warc(spark: SparkSession, path: str, columns: str = SCHEMA) -> DataFrame:
    """Leave ``payload`` out of ``columns`` and blocks are not decoded (but for the HTTP headers, for payload_length)."""
    register(spark)
    return spark.read.format("warc").schema(columns).load(qualified(spark, path))


def write_warc(records: DataFrame, path: str) -> None:
    """Adds the records to the archive at ``path`` (new or not; one writer at a time). A failed job adds nothing to what is read."""
    register(records.sparkSession)
    records.write.format("warc").mode("append").save(qualified(records.sparkSession, path))


# ---------------------------------------------------------------- pages as archives

def page_records(pages: DataFrame, min_bytes: int = 1000, id_col: str = "page_id", url_col: str = "url",
                 html_col: str = "html") -> DataFrame:
    """One record per page. Of equal payloads of at least ``min_bytes`` the page with the largest id is the response.

    Only digests and ids are aggregated. Digests that repeat are stored, and joined without a hint: broadcast while they
    are few, else shuffled with skewed digests split. Ids may be of any type that has an order and a text form (texts are compared as
    texts). Null html is an empty payload; null ids are smaller than all others; rows that share the largest id, or groups of null ids only, are all responses; empty tables give no record.
    """
    html = F.encode(F.coalesce(F.col(html_col).cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("target_uri"), html.alias("payload"),
                        F.sha1(html).alias("payload_digest"), F.octet_length(html).cast("long").alias("payload_length"))
    repeated = store(rows.where(F.col("payload_length") >= min_bytes).groupBy("payload_digest", "payload_length")
                     .agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "warc-repeated")
    rows = rows.join(repeated, ["payload_digest", "payload_length"], "left")
    revisit = F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    return rows.select(_urn(F.col("page_id")).alias("record_id"), F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                       "target_uri", F.when(revisit, _urn(F.col("keeper"))).alias("refers_to"), "payload_digest", "payload_length",
                       F.when(~revisit, F.col("payload")).alias("payload"))


def _urn(page_id: Column) -> Column:
    coded = F.url_encode(page_id.cast("string"))  # the text "null" is told from a null id
    return F.concat(F.lit("urn:page:"), F.coalesce(F.when(coded == "null", "%6Eull").otherwise(coded), F.lit("null")))


def _page(urn: Column, kind: str) -> Column:
    return F.url_decode(F.nullif(F.regexp_extract(urn, "^urn:page:(.*)$", 1), F.lit("null"))).cast(kind)


def archive_pages(pages: DataFrame, path: str) -> DataFrame:
    """Write the pages' archive, read it back: one row per record, digest and size of responses taken from the payload read."""
    spark, kind = pages.sparkSession, pages.schema["page_id"].dataType.simpleString()
    write_warc(page_records(pages), path)
    responses = read_warc(spark, path, "record_id string, record_type string, payload binary").where("record_type = 'response'")
    responses = responses.select("record_id", "record_type", F.lit(None).cast("string").alias("refers_to"),
                                 F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"))
    revisits = read_warc(spark, path, "record_id string, record_type string, refers_to string, payload_digest string, payload_length long")
    revisits = revisits.where("record_type = 'revisit'").select("record_id", "record_type", "refers_to",
                                                                 F.col("payload_length").alias("payload_bytes"), "payload_digest")
    both = responses.unionByName(revisits)
    return both.select(_page(F.col("record_id"), kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                       _page(F.col("refers_to"), kind).alias("refers_to"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))


ORACLE_SQL = """
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
k AS (SELECT payload_digest, max(page_id) AS keeper FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, payload_bytes, p.payload_digest,
       CASE WHEN page_id <> keeper THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> keeper THEN keeper END AS refers_to
FROM p LEFT JOIN k ON p.payload_digest = k.payload_digest
"""
