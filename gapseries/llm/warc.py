"""WARC archives: writing pages as records, and a Python data source that reads them.

Writing is a DataFrame job: a record is a string of header lines and an HTTP
message, and Spark's text writer (whose line separator completes the record's
closing blank line) commits the files on any file system Spark can write.

``WarcSource`` (format ``warc``) plans whole files into partitions of about
``partitionBytes``, as record boundaries can be told apart from payload bytes
only by reading from a file's start. Predicates on the record type and the
header columns are pushed down: the reader parses the header first, and skips
(seeks over, in uncompressed files) the blocks of records that fail, as well
as all payloads if the schema asks for none. Plain and gzip files (one member
a record or one for the file) are read.
"""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull, IsNull, Not,
                                    StringContains, StringEndsWith, StringStartsWith)

from gapseries.llm.common import materialise

MIN_REVISIT = 1000              # payloads below this many bytes are always stored
PARTITION_BYTES = 128 << 20
BATCH_BYTES = 8 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "urn:x-page:"

#: Column: header field (None: derived from the record).
FIELDS = {"record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri", "date": "warc-date",
          "refers_to": "warc-refers-to", "payload_digest": "warc-payload-digest", "payload_length": "warc-payload-length",
          "content_type": "content-type", "content_length": "content-length"}
SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in FIELDS] + [
    T.StructField("headers", T.MapType(T.StringType(), T.StringType())), T.StructField("payload", T.BinaryType()),
    T.StructField("file", T.StringType()), T.StructField("position", T.LongType())])


class Files(InputPartition):
    def __init__(self, paths: tuple[str, ...]):
        self.paths = paths


def _files(path: str) -> list[tuple[str, int]]:
    """(URI, bytes) of the data files under a path, in order."""
    from pyarrow import fs

    system, root = fs.FileSystem.from_uri(path)
    info = system.get_file_info(root)
    if info.type == fs.FileType.File:
        return [(path, info.size)]
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = system.get_file_info(fs.FileSelector(root, recursive=True))
    return sorted((path.rstrip("/") + f.path[len(root.rstrip("/")):], f.size) for f in found if f.type == fs.FileType.File
                  and not any(part.startswith(("_", ".")) for part in f.path[len(root):].split("/")) and f.size)


def _open(uri: str):
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri)
    raw = io.BufferedReader(system.open_input_file(path), 1 << 20)
    if raw.peek(2)[:2] == b"\x1f\x8b":
        return io.BufferedReader(gzip.GzipFile(fileobj=raw), 1 << 20), False
    return raw, True


def _skip(stream, size: int, seekable: bool) -> None:
    if seekable and size > 1 << 16:
        stream.seek(size, io.SEEK_CUR)
        return
    while size > 0:
        got = len(stream.read(min(size, 1 << 20)))
        if not got:
            raise ValueError("record is cut off")
        size -= got


def records(uri: str, wanted, payloads: bool) -> Iterator[tuple[dict[str, str], bytes | None, int]]:
    """(header, payload, position) of the records of a file whose header ``wanted`` accepts."""
    stream, seekable = _open(uri)
    with stream:
        at = 0
        while line := stream.readline():
            start, at = at, at + len(line)
            if not line.strip():
                continue
            if not line.startswith(b"WARC/"):
                raise ValueError(f"{uri}: no record at byte {start}")
            header: dict[str, str] = {}
            name = ""
            while (line := stream.readline()) and line not in (b"\r\n", b"\n"):
                at += len(line)
                text = line.decode(errors="replace").rstrip("\r\n")
                if text[:1] in (" ", "\t") and name:            # a folded line
                    header[name] += " " + text.strip()
                else:
                    name, _, value = text.partition(":")
                    name = name.strip().lower()
                    header[name] = value.strip()
            at += len(line)
            size = int(header["content-length"])
            if not wanted(header):
                _skip(stream, size, seekable)
                payload = None
            elif not payloads:
                _skip(stream, size, seekable)
                yield header, None, start
            else:
                block = stream.read(size)
                if len(block) < size:
                    raise ValueError(f"{uri}: record at byte {start} is cut off")
                payload = block
                if header.get("content-type", "").startswith("application/http"):
                    payload = block.partition(b"\r\n\r\n")[2]
                yield header, payload, start
            at += size


def _value(header: dict[str, str], column: str) -> str | None:
    return header.get(FIELDS[column])


def accepts(filters: list[Filter]):
    """Function that tests a header against pushed filters (a null value passes ``IsNull`` only)."""
    def one(f: Filter):
        if isinstance(f, Not):
            inner, column = one(f.child), f.child.attribute[0]
            return lambda h: _value(h, column) is not None and not inner(h)
        column = f.attribute[0]
        if isinstance(f, IsNull):
            return lambda h: _value(h, column) is None
        if isinstance(f, IsNotNull):
            return lambda h: _value(h, column) is not None
        test = {EqualTo: lambda v: v == f.value, StringStartsWith: lambda v: v.startswith(f.value),
                StringEndsWith: lambda v: v.endswith(f.value), StringContains: lambda v: f.value in v,
                In: lambda v: v in f.value}[type(f)]
        return lambda h: (v := _value(h, column)) is not None and test(v)
    tests = [one(f) for f in filters]
    return lambda header: all(t(header) for t in tests)


def _pushable(f: Filter) -> bool:
    if isinstance(f, Not):
        return not isinstance(f.child, (Not, IsNull, IsNotNull)) and _pushable(f.child)
    return isinstance(f, (EqualTo, In, IsNull, IsNotNull, StringStartsWith, StringEndsWith, StringContains)) \
        and len(f.attribute) == 1 and f.attribute[0] in FIELDS


class WarcReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options):
        self.schema, self.path = schema, options["path"]
        self.size = int(options.get("partitionBytes", PARTITION_BYTES))
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if _pushable(f):
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[Files]:
        out, held, size = [], [], 0
        for path, n in _files(self.path):
            if held and size + n > self.size:
                out.append(Files(tuple(held)))
                held, size = [], 0
            held.append(path)
            size += n
        return out + [Files(tuple(held))] if held else out

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target, wanted = to_arrow_schema(self.schema), accepts(self.filters)
        names = [f.name for f in self.schema.fields]
        rows, size = [], 0

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), target)], schema=target)
        for path in partition.paths if partition else ():
            for header, payload, at in records(path, wanted, "payload" in names):
                derived = {"headers": header if "headers" in names else None, "payload": payload, "file": path, "position": at}
                rows.append([derived[n] if n in derived else _value(header, n) for n in names])
                size += len(payload or b"") + 200
                if size >= BATCH_BYTES:
                    yield batch()
                    rows, size = [], 0
        if rows:
            yield batch()


class WarcSource(DataSource):
    """``spark.read.format("warc").schema(subset of SCHEMA).load(path)``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> T.StructType:
        return SCHEMA

    def reader(self, schema: T.StructType) -> WarcReader:
        unknown = {f.name for f in schema.fields} - {f.name for f in SCHEMA.fields}
        if unknown:
            raise ValueError(f"unknown columns: {sorted(unknown)}")
        return WarcReader(schema, self.options)


def read(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Records under ``path``; only the ``columns`` asked for are parsed, payloads only if among them."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    schema = T.StructType([SCHEMA[c] for c in columns]) if columns else SCHEMA
    return spark.read.format("warc").schema(schema).load(path)


def _field(name: str, value) -> F.Column:
    """A header line, or nothing if the value is null; line breaks in values are percent-encoded."""
    safe = F.regexp_replace(F.regexp_replace(value, "\r", "%0D"), "\n", "%0A")
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit("\r\n")), F.lit(""))


def write(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
          min_revisit: int = MIN_REVISIT) -> None:
    """Write one record per row: ``response``, or ``revisit`` of the response with an equal payload.

    Of equal payloads of at least ``min_revisit`` bytes the largest id is the
    response (all its rows, if the id repeats). Null html is an empty payload;
    a null id is stored as a response that nothing refers to; a null URL has no
    field. Other columns are ignored; an empty table writes no record.
    """
    spark = pages.sparkSession
    payload = F.coalesce(F.col(html_col), F.lit(""))
    own = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"),
                       F.sha2(payload, 256).alias("key"), F.octet_length(payload).cast("long").alias("n"))
    # equal payloads by SHA-256: SHA-1, which the records carry, can be made to collide
    large = materialise(own.where((F.col("n") >= min_revisit) & F.col("id").isNotNull()).select("id", "key"), "payloads")
    last = large.groupBy("key").agg(F.max("id").alias("last"), F.count("*").alias("copies")).where("copies > 1").drop("copies")
    revisits = materialise(large.join(last, "key").where("id < last").distinct(), "revisits")
    record = own.join(revisits, ["id", "key"], "left")
    http = F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n")
    again = F.col("last").isNotNull()
    block = F.concat(http, F.when(again, F.lit("")).otherwise(F.col("payload")))
    urn = lambda c: F.concat(F.lit(f"<{RECORD}"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    value = F.concat(
        F.lit("WARC/1.1\r\n"), _field("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.lit("response"))),
        _field("WARC-Record-ID", urn("id")), _field("WARC-Target-URI", F.col("url")),
        _field("WARC-Date", F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.sha1(F.col("payload").cast("binary")))),
        _field("WARC-Payload-Length", F.col("n").cast("string")),
        _field("WARC-Profile", F.when(again, F.lit(PROFILE))), _field("WARC-Refers-To", F.when(again, urn("last"))),
        _field("Content-Type", F.lit("application/http; msgtype=response")),
        _field("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"), block, F.lit("\r\n"))
    record.select(value.alias("value")).write.option("lineSep", "\r\n").text(path)


def page_records(spark: SparkSession, path: str) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to, url)`` of the page records under ``path``.

    Length and digest are taken from the payload that was read back; a
    revisit's are those of its header, and its block is not read.
    """
    page = lambda c: F.regexp_extract(c, f"^<{RECORD}(-?[0-9]+)>$", 1)
    number = lambda c: F.when(page(c) != "", page(c).cast("long"))
    stored = read(spark, path, ["record_type", "record_id", "target_uri", "payload"]).where("record_type = 'response'").select(
        number("record_id").alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"), "record_type", F.lit(None).cast("long").alias("refers_to"),
        F.col("target_uri").alias("url"))
    again = read(spark, path, ["record_type", "record_id", "target_uri", "payload_digest", "payload_length", "refers_to"]).where(
        "record_type = 'revisit'").select(
        number("record_id").alias("page_id"), F.col("payload_length").cast("long").alias("payload_bytes"),
        F.regexp_replace("payload_digest", "^sha1:", "").alias("payload_digest"), "record_type",
        number("refers_to").alias("refers_to"), F.col("target_uri").alias("url"))
    return stored.unionByName(again)
