"""Web archives with a two-level capture index.

Records are written as WARC/1.1, one gzip member each, so a capture can be read
by offset and length alone.  Of captures with equal payloads the one with the
smallest id is a ``response``; the others are ``revisit`` records that name it.

The index keeps one line per capture, sorted by reversed-host URL key and
capture id, in compressed blocks of ``block_lines`` lines.  A sparse directory
holds each block's first key, offset and length.  A lookup binary-searches the
directory, range-reads the blocks that may hold the key, binary-searches their
lines, and range-reads the records.

Archives, blocks and directories are files in the shared scratch folder, under
names unique to the writing attempt; only what a finished task reported is read.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from valuora.llm.common import byte_slices, materialize, shipped
from valuora.session import scratch_path

DATE = "2000-01-01T00:00:00Z"  # captures carry no time of their own
ARCHIVE_BYTES = 256 << 20
BLOCK_LINES = 1000
SEGMENT = 4 << 20


def url_key(url: str | None) -> str:
    """Sort key of a URL: host labels reversed and comma-joined, then path and query.

    Scheme, user, default port and fragment do not count; null gives ``)/``.
    """
    try:
        parts = urlsplit((url or "").strip())
        host, port = (parts.hostname or ""), parts.port
    except ValueError:
        return f"){(url or '').strip()}"
    key = ",".join(reversed(host.split("."))) + (f":{port}" if port and port not in (80, 443) else "")
    return f"{key}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _fs(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


def _header_value(value) -> str:
    """Header values stay on one line."""
    return " ".join(str(value).split())


def record_bytes(row: dict) -> bytes:
    """One WARC record (uncompressed): page_id, url, payload, digest, record_type, refers_to, refers_url."""
    payload: bytes = row["payload"]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + (payload if row["record_type"] == "response" else b"")
    head = [
        ("WARC-Type", row["record_type"]),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, 'page:%s' % row['page_id'])}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", _header_value(row["url"] or "")),
        ("WARC-Payload-Digest", f"sha1:{row['digest']}"),
        ("X-Page-Id", "" if row["page_id"] is None else row["page_id"]),
    ]
    if row["record_type"] == "revisit":
        head += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, 'page:%s' % row['refers_to'])}>"),
            ("WARC-Refers-To-Target-URI", _header_value(row["refers_url"] or "")),
            ("X-Refers-To-Page-Id", row["refers_to"]),
        ]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    return text.encode() + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Headers, HTTP headers and payload of one uncompressed record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    block = rest[: int(headers["Content-Length"])]
    http_head, _, payload = block.partition(b"\r\n\r\n")
    http = dict(line.split(": ", 1) for line in http_head.decode().split("\r\n")[1:])
    return {"headers": headers, "http": http, "payload": payload}


def _rows(batches: Iterator[pa.RecordBatch], limit: int = SEGMENT) -> Iterator[dict]:
    for batch in batches:
        for part in byte_slices(batch, limit):
            yield from part.to_pylist()


def _flush(rows: list[dict], schema: T.StructType) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=to_arrow_schema(schema))


CAPTURE = T.StructType(
    [T.StructField("page_id", T.LongType()), T.StructField("key", T.StringType()), T.StructField("file", T.StringType()),
     T.StructField("offset", T.LongType()), T.StructField("length", T.LongType())])


def choose_records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``pages`` (page_id, url, html) with record_type, refers_to and refers_url.

    Payloads shorter than ``min_bytes`` are always responses.  Rows that repeat the
    smallest page_id of a payload are all responses; a null page_id is larger than
    any other.  Equal payloads are found by SHA-256 and length in the JVM.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("_sum", F.sha2("html", 256))
    copies = rows.groupBy("_sum").agg(
        F.count("*").alias("_n"), F.min("page_id").alias("_first"), F.min_by("url", "page_id").alias("_first_url")).where("_n > 1")
    joined = rows.join(copies.drop("_n"), "_sum", "left")
    again = (F.col("_first").isNotNull() & ~F.col("_first").eqNullSafe(F.col("page_id"))
             & (F.octet_length("html") >= min_bytes))
    return joined.select(
        "page_id", "url", "html", F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("_first")).alias("refers_to"), F.when(again, F.col("_first_url")).alias("refers_url"))


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Write the rows of :func:`choose_records` as archives below ``folder``.

    Gives the written table of captures: page_id, key, file, offset, length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _fs(folder)
        out, sink, path, at = [], None, "", 0
        try:
            for row in _rows(batches):
                payload = row["html"].encode()
                data = gzip.compress(record_bytes(row | {"payload": payload, "digest": payload_digest(payload)}), 6, mtime=0)
                if sink is None or at >= ARCHIVE_BYTES:
                    if sink is not None:
                        sink.close()
                    fs.create_dir(base, recursive=True)
                    path, at = f"{base}/{uuid.uuid4().hex}.warc.gz", 0
                    sink = fs.open_output_stream(path, compression=None)
                sink.write(data)
                out.append({"page_id": row["page_id"], "key": url_key(row["url"]), "file": path.rsplit("/", 1)[1],
                            "offset": at, "length": len(data)})
                at += len(data)
                if len(out) >= 5000:
                    yield _flush(out, CAPTURE)
                    out = []
        finally:
            if sink is not None:
                sink.close()
        if out:
            yield _flush(out, CAPTURE)

    return materialize(shipped(records).mapInArrow(run, CAPTURE), "warc-captures")


DIRECTORY = T.StructType(
    [T.StructField("file", T.StringType()), T.StructField("block", T.IntegerType()), T.StructField("first_key", T.StringType()),
     T.StructField("last_key", T.StringType()), T.StructField("offset", T.LongType()), T.StructField("length", T.LongType())])


def write_index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Sorted compressed blocks below ``folder``; gives the block directory (a written table).

    Captures are range-partitioned by key and id, so a key with very many captures
    spreads over several index files.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _fs(folder)
        out, sink, name, at, lines = [], None, "", 0, []

        def block() -> None:
            nonlocal sink, name, at
            if sink is None:
                fs.create_dir(base, recursive=True)
                name = f"{uuid.uuid4().hex}.cdx.gz"
                sink = fs.open_output_stream(f"{base}/{name}", compression=None)
            data = gzip.compress("\n".join(x for _, x in lines).encode(), 6, mtime=0)
            sink.write(data)
            out.append({"file": name, "block": len(out), "first_key": lines[0][0], "last_key": lines[-1][0],
                        "offset": at, "length": len(data)})
            at += len(data)
            lines.clear()

        try:
            for row in _rows(batches):
                fields = {k: row[k] for k in ("page_id", "file", "offset", "length")}
                lines.append((row["key"], json.dumps([row["key"], fields])))
                if len(lines) >= block_lines:
                    block()
            if lines:
                block()
        finally:
            if sink is not None:
                sink.close()
        if out:
            yield _flush(out, DIRECTORY)

    # keys are compared as UTF-8 bytes here and as code points in Python: the same order
    ordered = captures.repartitionByRange("key", "page_id").sortWithinPartitions("key", "page_id", "file", "offset")
    return materialize(shipped(ordered).mapInArrow(run, DIRECTORY), "warc-directory")


def lookup(keys: DataFrame, directory: DataFrame, folder: str) -> DataFrame:
    """Captures of every row of ``keys`` (column ``key``): key, page_id, file, offset, length.

    The directory is joined to the keys by the index files' first and last keys,
    which are as many as index files; each group then holds one index file's
    directory and the keys routed to it.  Repeated keys are looked up once.
    """
    files = directory.groupBy("file").agg(F.min("first_key").alias("low"), F.max("last_key").alias("high"))
    ranges = [(r["low"], r["high"], r["file"]) for r in files.orderBy("low", "high").collect()]
    lows, highs = [r[0] for r in ranges], [r[1] for r in ranges]
    routed_type = T.StructType([T.StructField("key", T.StringType()), T.StructField("_file", T.StringType())])

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # files hold consecutive ranges, so highs ascend with lows
        for batch in batches:
            out = []
            for key in batch.column(0).to_pylist():
                for i in range(bisect.bisect_left(highs, key), bisect.bisect_right(lows, key)):
                    out.append({"key": key, "_file": ranges[i][2]})
            if out:
                yield _flush(out, routed_type)

    routed = shipped(keys).select("key").distinct().mapInArrow(route, routed_type)
    blocks = directory.select(F.col("file").alias("_file"), "first_key", "last_key", F.col("offset").alias("at"), F.col("length").alias("size"))

    def search(group, wanted: Iterator, parts: Iterator):
        import pandas as pd

        table = pd.concat(list(parts), ignore_index=True) if parts is not None else None
        out = []
        queries = pd.concat(list(wanted), ignore_index=True)["key"].sort_values().tolist()
        if table is None or not len(table) or not queries:
            return pd.DataFrame(columns=[f.name for f in CAPTURE])
        table = table.sort_values("at")
        first, last = table["first_key"].tolist(), table["last_key"].tolist()
        fs, base = _fs(folder)
        held, lines, names = -1, [], []
        with fs.open_input_file(f"{base}/{group[0].as_py() if hasattr(group[0], 'as_py') else group[0]}") as source:
            for key in queries:
                for b in range(bisect.bisect_left(last, key), bisect.bisect_right(first, key)):
                    if b != held:
                        source.seek(int(table["at"].iat[b]))
                        lines = [json.loads(x) for x in gzip.decompress(source.read(int(table["size"].iat[b]))).decode().split("\n")]
                        names, held = [x[0] for x in lines], b
                    for i in range(bisect.bisect_left(names, key), bisect.bisect_right(names, key)):
                        out.append({"key": key, **lines[i][1]})
        return pd.DataFrame(out, columns=[f.name for f in CAPTURE])

    def search_frames(group, wanted, parts):
        return search(group, iter([wanted]), iter([parts]))

    found = routed.groupBy("_file").cogroup(blocks.groupBy("_file")).applyInPandas(search_frames, CAPTURE)
    return found


READ = T.StructType(
    [T.StructField("page_id", T.LongType()), T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()),
     T.StructField("record_type", T.StringType()), T.StructField("refers_to", T.LongType()), T.StructField("url", T.StringType()),
     T.StructField("html", T.StringType())])


def read_records(captures: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
    """Range-read captures: page_id, payload_bytes, payload_digest, record_type, refers_to, url, html.

    A response's length and digest are taken from the payload that was read (and
    the digest must equal its header); a revisit carries them in its headers.
    ``html`` is null without ``payloads`` and for revisits.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _fs(folder)
        out, held, name, size = [], None, "", 0
        try:
            for row in _rows(batches):
                if row["file"] != name:
                    if held is not None:
                        held.close()
                    held, name = fs.open_input_file(f"{base}/{row['file']}"), row["file"]
                held.seek(row["offset"])
                got = parse_record(zlib.decompress(held.read(row["length"]), 31))
                head, payload = got["headers"], got["payload"]
                digest, kind = head["WARC-Payload-Digest"].removeprefix("sha1:"), head["WARC-Type"]
                length = int(got["http"]["Content-Length"])
                if kind == "response" and (len(payload) != length or payload_digest(payload) != digest):
                    raise ValueError(f"damaged record in {name} at {row['offset']}")
                out.append(
                    {"page_id": int(head["X-Page-Id"]) if head["X-Page-Id"] else None, "payload_bytes": length,
                     "payload_digest": digest, "record_type": kind,
                     "refers_to": int(head["X-Refers-To-Page-Id"]) if kind == "revisit" else None,
                     "url": head["WARC-Target-URI"], "html": payload.decode() if payloads and kind == "response" else None})
                size += len(payload) if payloads else 200
                if size >= SEGMENT:
                    yield _flush(out, READ)
                    out, size = [], 0
        finally:
            if held is not None:
                held.close()
        if out:
            yield _flush(out, READ)

    segment = F.floor(F.col("offset") / F.lit(SEGMENT))
    near = captures.repartition(F.col("file"), segment).sortWithinPartitions("file", "offset")
    return shipped(near).mapInArrow(run, READ)


def archive(pages: DataFrame, min_bytes: int = 0) -> tuple[DataFrame, DataFrame, str, str]:
    """Write ``pages`` and their index; gives captures, block directory and the two folders."""
    spark = pages.sparkSession
    archives, index = scratch_path(spark, "warc-archives"), scratch_path(spark, "warc-index")
    captures = write_archives(choose_records(pages, min_bytes), archives)
    return captures, write_index(captures, index), archives, index
