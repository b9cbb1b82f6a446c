"""WARC archives: writing pages as records, and a reader that salvages what damaged archives still hold."""

from __future__ import annotations

import contextlib
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import as_row, from_row
from .store import shared_dir, stash

DATE = "2024-01-01T00:00:00Z"
LEAST_REVISIT = 100  # bytes of a payload from which equal ones are revisits
RECORDS_A_FILE = 8000
FILE_BYTES = 64 << 20  # a file is closed by the first record that brings it there
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_GZIP = b"\x1f\x8b\x08"
_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
_NEXT_VERSION = re.compile(rb"\nWARC/1\.[0-9]+\r\n")


DEDUP = ("payload", "payload_bytes", "payload_digest", "record_type", "refers_to")


def dedup(pages: DataFrame, id_col: str = "page_id", html: str = "html") -> DataFrame:
    """Pages with payload, payload_bytes, payload_digest, record_type and refers_to.

    Payloads are equal if their SHA-256 is. Smallest ids are summed up per digest before anything is shuffled; only digests that
    repeat go into the join, one row each, so a payload that a third of all pages share is a large group on one side alone, which
    adaptive execution splits. All rows of the smallest id, repeated ones too, are responses, as are rows without id. Columns that clash with these names are replaced, any other name may occur.
    """
    payload = F.coalesce(F.col(f"`{html}`"), F.lit(""))
    rows = pages.select(as_row(pages, DEDUP), F.col(f"`{id_col}`").alias("_id"), payload.alias("payload"), F.octet_length(payload).cast("long").alias("payload_bytes"), F.sha2(payload.cast("binary"), 256).alias("payload_digest"))
    firsts = (
        rows.filter(F.col("payload_bytes") >= LEAST_REVISIT)
        .groupBy("payload_digest")
        .agg(F.min("_id").alias("_first"), F.max("_id").alias("_last"))
        .filter(F.col("_first") < F.col("_last"))
        .select(F.col("payload_digest").alias("_digest"), "_first")
    )
    again = F.coalesce(F.col("_id") > F.col("_first"), F.lit(False))
    return (
        rows.join(firsts, F.col("payload_digest") == F.col("_digest"), "left")
        .withColumn("record_type", F.when(again, "revisit").otherwise("response"))
        .withColumn("refers_to", F.when(again, F.col("_first")))
        .select(*from_row(pages, DEDUP), *DEDUP)
    )


def _deflate(batches: Iterator[pa.RecordBatch], file_bytes: int) -> Iterator[pa.RecordBatch]:
    """Each record as a gzip member of its own, without the zero byte that ends it: the writer's separator puts that back. A member of 16 MiB or more ends in
    another byte, so an empty member follows it. `file` counts the task's files, by bytes."""
    file, size = 0, 0
    for batch in batches:
        out, files = [], []
        for record in batch.column(0):
            member = gzip.compress(record.as_buffer().to_pybytes() + b"\r\n\r\n", 6, mtime=0)
            out.append((member if member[-1] == 0 else member + gzip.compress(b"", mtime=0))[:-1])
            files.append(file)
            size += len(member)
            if size >= file_bytes:
                file, size = file + 1, 0
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), pa.array(files, pa.int32())], names=["value", "file"])


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url: str = "url", html: str = "html", file_bytes: int = FILE_BYTES) -> None:
    """Pages as WARC/1.1 records, each a gzip member, in files under `path`.

    A file has at most RECORDS_A_FILE records and, but for its last one, fewer than `file_bytes` bytes. Spark's own text writer makes the files wherever the path is, and a task that is lost is simply written again: a member is a
    line of raw bytes whose separator is the zero byte that ends the member. A revisit has no payload but says how long it was. Line ends in urls are escaped. Null urls are empty.
    """
    crlf = F.lit("\r\n")
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, crlf)
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")), F.lit(">"))
    revisit = F.col("record_type") == "revisit"
    block = F.concat(F.lit(_HTTP), F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    address = F.regexp_replace(F.regexp_replace(F.coalesce(F.col(f"`{url}`"), F.lit("")), "\r", "%0D"), "\n", "%0A")
    record = F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.col("record_type")), line("WARC-Record-ID", urn(id_col)), line("WARC-Date", F.lit(DATE)), line("WARC-Target-URI", address),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))), line("Payload-Length", F.col("payload_bytes").cast("string")),
        F.when(revisit, F.concat(line("WARC-Refers-To", urn("refers_to")), F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n"))).otherwise(F.lit("")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"), line("Content-Length", F.octet_length(block).cast("string")), crlf, block,
    )
    members = dedup(pages, id_col, html).select(record.cast("binary").alias("value")).mapInArrow(lambda batches: _deflate(batches, file_bytes), "value binary, file int").select(F.col("value").cast("string"), "file")
    members.write.partitionBy("file").option("lineSep", "\0").option("compression", "none").option("maxRecordsPerFile", RECORDS_A_FILE).text(path)
    sc = pages.sparkSession.sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(sc._jsc.hadoopConfiguration())
    for folder in fs.listStatus(at):  # the writer names them as text, in a folder for each count
        count = folder.getPath().getName()
        if not count.startswith("file="):
            continue
        for x in fs.listStatus(folder.getPath()):
            name = x.getPath().getName()
            if name.endswith(".txt") and not fs.rename(x.getPath(), sc._jvm.org.apache.hadoop.fs.Path(at, f"{name.removesuffix('.txt')}-{count.removeprefix('file=')}.warc.gz")):
                raise OSError(f"{name} can't be renamed")
        fs.delete(folder.getPath(), True)


class Record(NamedTuple):
    offset: int
    kind: str  # record or gap
    record_type: str | None
    record_id: str | None
    uri: str | None
    refers_to: str | None
    digest: str | None
    payload_bytes: int | None
    payload: bytes | None
    length: int
    reason: str | None


def _gap(start: int, end: int, reason: str) -> Record:
    return Record(start, "gap", None, None, None, None, None, None, None, end - start, reason)


def _parse(data: bytes, at: int) -> tuple[Record, int] | str:
    """The record at `at` and where the next begins, or which check fails."""
    if not _VERSION.match(data, at):
        return "no version line"
    # A version line has no colon, so a header that holds another one is none: looking no further than that, runs of version lines take linear time.
    other = _NEXT_VERSION.search(data, at + 1)
    head = data.find(b"\r\n\r\n", at, other.start() + 1 if other else len(data))
    if head < 0:
        return "header without end"
    fields = {}
    for x in data[at:head].decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = x.partition(":")
        if not colon:
            return "header line without colon"
        fields[name.strip().lower()] = value.strip()
    size = fields.get("content-length", "")
    if not size.isascii() or not size.isdigit():
        return "no content length"
    begin, end = head + 4, head + 4 + int(size)
    if end > len(data):
        return "block cut short"
    if data[end : end + 4] != b"\r\n\r\n":
        return "no end of record where the length says"
    kind = fields.get("warc-type")
    if not kind:
        return "no type"
    block = data[begin:end]
    cut = block.find(b"\r\n\r\n") if block.startswith(b"HTTP/") else -4
    payload = block[cut + 4 :]
    said = fields.get("warc-payload-digest", "")
    digest = said.removeprefix("sha256:") if said.startswith("sha256:") else hashlib.sha256(payload).hexdigest()
    size = len(payload)
    if kind == "revisit":
        payload = None
        said_size = fields.get("payload-length", "")
        size = int(said_size) if said_size.isdigit() else None
    elif hashlib.sha256(payload).hexdigest() != digest:
        return "payload digest differs"
    return Record(at, "record", kind, fields.get("warc-record-id"), fields.get("warc-target-uri"), fields.get("warc-refers-to"), digest, size, payload, end + 4 - at, None), end + 4


def salvage_plain(data: bytes) -> Iterator[Record]:
    """Records of uncompressed bytes; after a failed check the next version line that starts a sound record, and a gap for what lies before it."""
    at = 0
    while at < len(data):
        got = _parse(data, at)
        if not isinstance(got, str):
            yield got[0]
            at = got[1]
            continue
        reason, start = got, at
        while True:
            m = _VERSION.search(data, at + 1)
            at = m.start() if m else len(data)
            if not m or not isinstance(_parse(data, at), str):
                break
        yield _gap(start, at, reason)


def _members(data: bytes) -> Iterator[tuple[int, int, bytes, str | None]]:
    """First and last byte, content and fault of each gzip member; damaged stretches end at the next member that opens soundly."""
    at = 0
    while at < len(data):
        if data[at : at + 3] == _GZIP:
            z = zlib.decompressobj(31)
            out, fault, used = [], None, at
            try:
                while used < len(data) and not z.eof:
                    piece, before = data[used : used + (1 << 16)], z.copy()
                    out.append(z.decompress(piece))
                    used += len(piece)
                used -= len(z.unused_data)
                fault = None if z.eof else "member cut short"
            except zlib.error as e:
                fault = str(e)
                with contextlib.suppress(zlib.error):  # again byte by byte, to keep all that comes before the fault
                    for k in range(len(piece)):
                        out.append(before.decompress(piece[k : k + 1]))
            if fault is None:
                yield at, used, b"".join(out), None
                at = used
                continue
        else:
            out, fault = [], "no gzip member"
        to = at + 1
        while (to := data.find(_GZIP, to)) >= 0:
            try:
                if zlib.decompressobj(31).decompress(data[to : to + 4096], 64)[:5] == b"WARC/":
                    break
            except zlib.error:
                pass
            to += 1
        to = to if to >= 0 else len(data)
        yield at, to, b"".join(out), fault
        at = to


def salvage(data: bytes) -> Iterator[Record]:
    """Records of an archive, plain or of gzip members; offsets are those of the file (of the member, for its records)."""
    if not data:
        return
    if data[:3] != _GZIP and _VERSION.search(data):
        yield from salvage_plain(data)
        return
    for start, end, content, fault in _members(data):
        for r in salvage_plain(content):
            if r.kind == "record" or fault is None:
                yield r._replace(offset=start)
        if fault is not None:
            yield _gap(start, end, fault)


SCHEMA = T.StructType([
    T.StructField("file", T.StringType()), T.StructField("offset", T.LongType()), T.StructField("kind", T.StringType()), T.StructField("record_type", T.StringType()), T.StructField("record_id", T.StringType()),
    T.StructField("uri", T.StringType()), T.StructField("refers_to", T.StringType()), T.StructField("payload_digest", T.StringType()), T.StructField("payload_bytes", T.LongType()),
    T.StructField("payload", T.BinaryType()), T.StructField("length", T.LongType()), T.StructField("reason", T.StringType()),
])


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """A row per record (kind record) and per quarantined stretch of bytes (kind gap, with length and reason) of the archives under `path`.

    A file is the unit of work; the writer bounds its records and bytes. Without `payloads` that column is null. Empty files give no rows, repeated records rows of their own.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = pa.schema([(f.name, {"long": pa.int64(), "binary": pa.binary()}.get(f.dataType.typeName(), pa.string())) for f in SCHEMA.fields])
        for batch in batches:
            for k in range(batch.num_rows):
                name, rows = batch.column(0)[k].as_py(), []
                for r in salvage(batch.column(1)[k].as_buffer().to_pybytes()):
                    rows.append({"file": name, "offset": r.offset, "kind": r.kind, "record_type": r.record_type, "record_id": r.record_id, "uri": r.uri, "refers_to": r.refers_to, "payload_digest": r.digest, "payload_bytes": r.payload_bytes, "payload": r.payload if payloads else None, "length": r.length, "reason": r.reason})
                    if len(rows) >= 1000:
                        yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return files.mapInArrow(read, SCHEMA)


def read_records(spark: SparkSession, path: str) -> tuple[DataFrame, str]:
    """Records of the archives under `path` without payloads, and the table where what the reader quarantined is logged: file, offset, length and reason of each gap.

    The archives are read once, into a table in the shared folder. No gap leaves an empty log; no archives give no records.
    """
    found, log = stash(read_archives(spark, path, payloads=False), "warc-records"), f"{shared_dir(spark)}/warc-gaps-{uuid.uuid4().hex}"
    found.filter("kind = 'gap'").select("file", "offset", "length", "reason").write.parquet(log)
    return found.filter("kind = 'record'"), log


def op6_warc(spark, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"), path)
    number = lambda c: F.regexp_extract(c, r"<urn:page:(-?\d+)>", 1).try_cast("long")
    records, _ = read_records(spark, path)
    return records.select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to"))


OP6_SQL = """
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""
