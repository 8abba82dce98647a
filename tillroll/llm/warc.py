"""WARC archives: write, normalise monolithic gzip, index, read back.

``write_archives`` puts each Spark partition into one file, a single gzip stream
of all its records (what a plain ``gzip`` of a .warc gives). Such a file can't be
entered in the middle. ``normalise`` inflates each file once, as a stream,
rewrites every record as a gzip member of its own, and writes a sidecar index of
offsets beside it. ``read_records`` reads records by the index alone.

Archives lie in a folder that all executors see (Hadoop URI for the Spark side,
opened through Arrow's file systems by the tasks). A task writes under a name of
its own and renames when done, so a repeated task replaces a file by the same
bytes and never leaves half of one.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import posixpath
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.scratch import folder, ready, written

LEAST_REVISIT = 100
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
LEVEL = 6
_CHUNK = 1 << 20
INDEX = "archive string, offset long, length long, record_type string, record_id string, target_uri string, payload_digest string"
RECORD = ("page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, "
          "archive string, offset long, length long, payload string")


def _record_id(page_id: Column, digest: Column) -> Column:
    h = F.md5(F.concat_ws("|", F.coalesce(page_id.cast("string"), F.lit("")), digest))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")), F.lit(""))


def record_types(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """page_id, url, payload, digest, bytes and the response's page_id for revisits.

    Of equal payloads of ``LEAST_REVISIT`` bytes or more, rows with the smallest
    page_id are responses and the others revisit it; rows without a page_id are
    responses. A null payload is empty.
    """
    body = F.coalesce(pages[payload], F.lit(""))
    full = pages.select(pages[page_id].alias("page_id"), pages[url].alias("url"), body.alias("payload"),
                        F.sha2(body, 256).alias("digest"), F.octet_length(body).cast("long").alias("bytes"))
    same = (
        full.where(f"bytes >= {LEAST_REVISIT}").groupBy(F.col("digest").alias("_d"))
        .agg(F.min("page_id").alias("_first"), F.max("page_id").alias("_last")).where("_first < _last")
    )
    out = full.join(written(same.select("_d", "_first"), "payloads"), F.col("digest") == F.col("_d"), "left")
    return out.withColumn("refers_to", F.when(F.col("page_id") > F.col("_first"), F.col("_first"))).drop("_d", "_first")


def write_archives(typed: DataFrame, path: str) -> None:
    """One gzip stream of WARC records per Spark partition, under ``path``."""
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit("\r\n\r\n"))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    head = F.concat(
        F.lit("WARC/1.0\r\n"),
        _line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("digest"))),
        _line("WARC-Date", F.lit(DATE)),
        _line("WARC-Target-URI", F.translate(F.col("url"), "\r\n", "")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _line("WARC-Refers-To", F.when(revisit, _record_id(F.col("refers_to"), F.col("digest")))),
        _line("X-Page-Id", F.col("page_id")),
        _line("X-Refers-To-Page-Id", F.col("refers_to")),
        _line("X-Payload-Length", F.col("bytes")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        _line("Content-Length", F.octet_length(block)),
        F.lit("\r\n"),
    )
    # the writer's line end completes the CRLF CRLF behind a record
    record = F.concat(head, block, F.lit("\r\n\r"))
    typed.select(record.alias("value")).write.option("lineSep", "\n").option("compression", "gzip").text(path)


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    if uri.startswith("/"):
        uri = "file://" + uri
    return pafs.FileSystem.from_uri(uri)


def read_headers(stream) -> dict[str, str] | None:
    """The version line and named fields of the next record; None at the end.
    Field names are given in lower case."""
    line = stream.readline()
    while line in (b"\r\n", b"\n"):
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"not a WARC record: {line[:40]!r}")
    out = {}
    while True:
        line = stream.readline()
        if line in (b"\r\n", b"\n"):
            return out
        if not line:
            raise ValueError("a record ends within its header")
        name, _, value = line.partition(b":")
        out[name.decode().strip().lower()] = value.decode().strip()


def _rewrite(source, sink, name: str):
    """Every record of ``source`` as a member of its own in ``sink``; index rows."""
    offset = 0
    while True:
        head = io.BytesIO()
        fields = read_headers(_Tee(source, head))
        if fields is None:
            return
        member, length = zlib.compressobj(LEVEL, zlib.DEFLATED, 31), 0
        length += sink.write(member.compress(head.getvalue())) or 0
        left = int(fields["content-length"]) + 4
        while left:
            chunk = source.read(min(left, _CHUNK))
            if not chunk:
                raise ValueError(f"{name}: a record ends within its block")
            left -= len(chunk)
            length += sink.write(member.compress(chunk)) or 0
        length += sink.write(member.flush()) or 0
        yield {"archive": name, "offset": offset, "length": length, "record_type": fields["warc-type"], "record_id": fields["warc-record-id"],
               "target_uri": fields.get("warc-target-uri"), "payload_digest": fields.get("warc-payload-digest", "").removeprefix("sha256:") or None}
        offset += length


class _Tee:
    """readline of a stream that also keeps the lines (without blank ones before
    the record)."""

    def __init__(self, stream, keep):
        self.stream, self.keep, self.began = stream, keep, False

    def readline(self):
        line = self.stream.readline()
        self.began |= line not in (b"\r\n", b"\n")
        if self.began:
            self.keep.write(line)
        return line


class _Counted:
    def __init__(self, sink):
        self.sink = sink

    def write(self, data: bytes) -> int:
        self.sink.write(data)
        return len(data)


def normalise_file(source_uri: str, target_dir: str) -> int:
    """Rewrite one gzip archive; the archive and its index appear under their
    names only when complete. The number of records."""
    source_fs, source = _open(source_uri)
    target_fs, target = _open(target_dir)
    target_fs.create_dir(target, recursive=True)
    stem = posixpath.basename(source).split(".")[0]
    own = f"{target}/.{stem}-{uuid.uuid4().hex}"
    final = f"{target}/{stem}.warc.gz"
    n = 0
    with source_fs.open_input_stream(source, compression=None) as raw, io.BufferedReader(gzip.GzipFile(fileobj=raw), _CHUNK) as stream:
        with target_fs.open_output_stream(f"{own}.gz", compression=None) as data, target_fs.open_output_stream(f"{own}.idx", compression=None) as index:
            for row in _rewrite(stream, _Counted(data), f"{stem}.warc.gz"):
                index.write(json.dumps(row).encode() + b"\n")
                n += 1
    target_fs.move(f"{own}.gz", final)
    target_fs.move(f"{own}.idx", f"{target}/{stem}.idx.jsonl")
    return n


def normalise(spark: SparkSession, path: str, target: str) -> DataFrame:
    """Normalise every *.gz archive under ``path`` into ``target`` (a file is one
    task's work and is streamed); (archive, records) of each."""
    ready(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path")

    def run(batches):
        for batch in batches:
            uris = batch.column("path").to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array(uris), pa.array([normalise_file(u, target) for u in uris], pa.int64())], names=["archive", "records"])

    return written(files.mapInArrow(run, "archive string, records long"), "normalised")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(INDEX).option("pathGlobFilter", "*.idx.jsonl").json(path)


def parse_member(data: bytes) -> dict:
    """The record of one gzip member, its payload checked against its digest."""
    stream = io.BytesIO(zlib.decompress(data, 31))
    fields = read_headers(stream)
    block = stream.read(int(fields["content-length"]))
    payload = block.partition(b"\r\n\r\n")[2]
    digest = fields["warc-payload-digest"].removeprefix("sha256:")
    whole = fields["warc-type"] != "revisit"
    if whole and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"payload of {fields['warc-record-id']} doesn't match its digest")
    number = lambda name: int(fields[name]) if name in fields else None
    return {"page_id": number("x-page-id"), "url": fields.get("warc-target-uri"), "record_type": fields["warc-type"],
            "payload_bytes": len(payload) if whole else number("x-payload-length"), "payload_digest": digest,
            "refers_to": number("x-refers-to-page-id"), "payload": payload.decode("utf-8", "replace") if whole else None}


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Every record that the sidecar indexes under ``path`` list (columns RECORD;
    payload null for revisits, or for all if not asked for)."""
    ready(spark)
    index = read_index(spark, path).select("archive", "offset", "length")
    schema = RECORD if payloads else RECORD.replace(", payload string", "")
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        fs, base = _open(path)
        name, file = None, None
        for batch in batches:
            rows = []
            for at in batch.to_pylist():
                if at["archive"] != name:
                    if file is not None:
                        file.close()
                    name, file = at["archive"], fs.open_input_file(f"{base}/{at['archive']}")
                rows.append(parse_member(file.read_at(at["length"], at["offset"])) | at)
                if len(rows) == 512:
                    yield from pa.Table.from_pylist([{n: r[n] for n in names} for r in rows], schema=_arrow(names)).to_batches()
                    rows = []
            if rows:
                yield from pa.Table.from_pylist([{n: r[n] for n in names} for r in rows], schema=_arrow(names)).to_batches()
        if file is not None:
            file.close()

    return index.mapInArrow(run, schema)


def _arrow(names: list[str]) -> pa.Schema:
    kinds = dict(c.split() for c in RECORD.split(", "))
    return pa.schema([(n, pa.int64() if kinds[n] == "long" else pa.string()) for n in names])


def round_trip(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html", payloads: bool = False) -> DataFrame:
    """Write, normalise, and read back all pages. One record per row of ``pages``.

    Null and empty payloads are empty responses; repeated rows are records of
    their own (those with the smallest page_id are all responses); an empty table
    gives an empty result; other columns are not archived.
    """
    spark = pages.sparkSession
    raw, target = folder(spark, "warc-raw"), folder(spark, "warc")
    write_archives(record_types(pages, page_id, url, payload), raw)
    normalise(spark, raw, target)
    return read_records(spark, target, payloads)
