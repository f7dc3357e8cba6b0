"""WARC archives and a two-level capture index.

Archives: every task writes its rows as one ``.warc.gz`` file in the shared folder, one gzip member per
record, so a record can be read by its offset and length alone. Equal payloads are stored once: the
first is a response, the others are revisit records that refer to it.

Index: capture lines are sorted by URL key (host reversed, then path) into parts; a part file is a row of
gzip blocks of ``BLOCK`` lines, and a sparse directory keeps the first and last key of each block. A
lookup finds the part by binary search among the parts' bounds, the block by binary search in that
part's directory, reads that block's byte range, searches its lines, and reads the records' ranges.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
import re
import uuid
import zlib
from urllib.parse import urlsplit

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.common import small_batches
from tidemark.session import work_dir
from tidemark.sources.sinks import materialize

BLOCK = 1000
MAX_PARTS = 20_000
LINES_PER_PART = 50_000
CAPTURE = "key string, page_id long, file string, offset long, length long"
RECORD = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
          "refers_to long")


def url_key(url: str | None) -> str:
    """Host reversed and lower-cased, then path and query: ``com,example)/a?b``. Null and empty give the empty key.

    Scheme, user, default ports, ``www.`` and the fragment do not count; query arguments are sorted. Blanks and
    line ends are escaped, so the key is sorted, written and looked up as the same text.
    """
    if not url:
        return ""
    try:
        parts = urlsplit(url if "//" in url else "//" + url)
        host = (parts.hostname or "").removeprefix("www.")
        port = parts.port
    except ValueError:
        return _no_blanks(url.strip().lower())
    name = ",".join(reversed(host.split("."))) + (f":{port}" if port not in (None, 80, 443) else "")
    query = "&".join(sorted(parts.query.split("&"))) if parts.query else ""
    return _no_blanks(f"{name}){parts.path or '/'}" + (f"?{query}" if query else ""))


def _no_blanks(key: str) -> str:
    return key.replace(" ", "%20").replace("\n", "%0A")


def _escaped(key: str) -> Column:
    """The column of keys with blanks and line ends escaped as in ``url_key``."""
    return F.replace(F.replace(key, F.lit(" "), F.lit("%20")), F.lit("\n"), F.lit("%0A"))


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(page_id, url: str | None, payload: bytes, payload_digest: str, refers_to) -> bytes:
    """One record: a response with its payload, or a revisit with the HTTP header alone.

    The HTTP header of a revisit is that of the full response, so its Content-Length is the payload's.
    """
    revisit = refers_to is not None
    block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
             ).encode() + (b"" if revisit else payload)
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: <urn:page:{'null' if page_id is None else page_id}>", "WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\r\n]", lambda m: f"%0{ord(m[0]):X}", url))
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += [f"WARC-Payload-Digest: sha1:{payload_digest}", "Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Fields of a record; a response's payload is digested anew and must match its header."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    kind, found = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != size or digest(payload) != found):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    number = lambda name: int(fields[name][len("<urn:page:"):-1])
    return {"page_id": None if fields["WARC-Record-ID"] == "<urn:page:null>" else number("WARC-Record-ID"),
            "url": fields.get("WARC-Target-URI"), "payload_bytes": size, "payload_digest": found, "record_type": kind,
            "refers_to": number("WARC-Refers-To") if kind == "revisit" else None,
            "payload": payload if kind == "response" else None}


def _store(path: str):
    """File system and path of a folder that all executors reach (file, hdfs, s3, gs)."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _new_file(folder: str, kind: str):
    """A file of its own for each attempt of a task; those of lost attempts are in no index."""
    store, place = _store(folder)
    store.create_dir(place, recursive=True)
    name = f"{kind}-{uuid.uuid4().hex}.gz"
    return name, store.open_output_stream(f"{place}/{name}", compression=None)


def _mark_repeats(pages: DataFrame) -> DataFrame:
    """Rows (page_id, url, html) with refers_to: the smallest page_id of equal payloads, null for that row itself.

    Payload digests are compared in a narrow table; only pages whose payload is not the first of its kind
    go into the join, and pages meet that table by page_id, so a payload that very many pages share is
    spread over all tasks.
    """
    narrow = materialize(pages.select("page_id", F.sha1(F.coalesce("html", F.lit("")).cast("binary")).alias("sum")), "payloads")
    first = narrow.groupBy("sum").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    repeats = narrow.join(first, "sum").where("page_id <> first OR (page_id IS NULL AND first IS NOT NULL)")
    repeats = repeats.select("page_id", "sum", F.col("first").alias("refers_to")).distinct()
    same = (pages["page_id"].eqNullSafe(repeats["page_id"])
            & (F.sha1(F.coalesce(pages["html"], F.lit("")).cast("binary")) == repeats["sum"]))
    return pages.join(repeats, same, "left").select(pages["page_id"], pages["url"], pages["html"], "refers_to")


def write_archives(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url",
                   html: str = "html") -> DataFrame:
    """Write a record for every row; returns the captures (key, page_id, file, offset, length), written as a table.

    The payload is the html in UTF-8, null counts as empty. Of equal payloads the row with the smallest
    page_id is the response and the others revisit it; rows that repeat that page_id and payload are
    responses too, and so are equal payloads that have no page_id at all. Null urls have no target. An
    empty table writes nothing; other columns are not read.
    """
    import pyarrow as pa

    small_batches(pages.sparkSession, 512)
    rows = _mark_repeats(pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"),
                                      F.col(html).alias("html")))

    def write(batches):
        out = None
        for batch in batches:
            if out is None:
                name, out = _new_file(folder, "archive")
            lines = []
            for number, target, body, refers in zip(*(c.to_pylist() for c in batch.columns)):
                payload = (body or "").encode("utf-8", "surrogatepass")
                raw = gzip.compress(record_bytes(number, target, payload, digest(payload), refers), 4, mtime=0)
                lines.append((url_key(target), number, name, out.tell(), len(raw)))
                out.write(raw)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*lines), (
                pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()))], ["key", "page_id", "file", "offset", "length"])
        if out is not None:
            out.close()

    return materialize(rows.mapInArrow(write, CAPTURE), "captures")


def build_index(captures: DataFrame, folder: str, block: int = BLOCK, per_part: int = LINES_PER_PART) -> DataFrame:
    """Sort capture lines into compressed blocks; returns the directory, written as a table.

    A directory row is (part, block, first, last, offset, length, lines). Lines are ordered by key, then page
    and place, so a key that very many captures share runs through several blocks and parts.
    """
    import pyarrow as pa

    parts = min(MAX_PARTS, captures.count() // per_part + 1)
    ordered = (captures.select(_escaped("key").alias("key"), "page_id", "file", "offset", "length")
               .repartitionByRange(parts, "key", "page_id", "file", "offset")
               .sortWithinPartitions("key", "page_id", "file", "offset"))

    def write(batches):
        out, waiting, number = None, [], 0

        def flush():
            nonlocal number
            raw = gzip.compress("".join(f"{k} {json.dumps(rest)}\n" for k, rest in waiting).encode(), 4, mtime=0)
            row = [name, number, waiting[0][0], waiting[-1][0], out.tell(), len(raw), len(waiting)]
            out.write(raw)
            number += 1
            waiting.clear()
            return pa.RecordBatch.from_pylist([dict(zip(("part", "block", "first", "last", "offset", "length", "lines"), row))],
                                              schema=shape)

        shape = pa.schema([("part", pa.string()), ("block", pa.int32()), ("first", pa.string()), ("last", pa.string()),
                           ("offset", pa.int64()), ("length", pa.int64()), ("lines", pa.int32())])
        for batch in batches:
            for key, *rest in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    name, out = _new_file(folder, "index")
                waiting.append((key, rest))
                if len(waiting) == block:
                    yield flush()
        if waiting:
            yield flush()
        if out is not None:
            out.close()

    return materialize(ordered.mapInArrow(write, "part string, block int, first string, last string, offset long, "
                                                 "length long, lines int"), "directory")


def lookup(keys: DataFrame, directory: DataFrame, folder: str) -> DataFrame:
    """Captures (key, page_id, file, offset, length) of the distinct keys of a table (key).

    Parts' bounds, at most MAX_PARTS, go to all tasks; keys travel to the part, or the several parts, that
    may hold them, together with that part's own directory rows.
    """
    import pyarrow as pa

    spark = keys.sparkSession
    bounds = sorted((r["first"], r["last"], r["part"]) for r in directory.groupBy("part").agg(
        F.min("first").alias("first"), F.max("last").alias("last")).collect())
    shared = spark.sparkContext.broadcast(bounds)

    def to_parts(batches):
        lasts = [b[1] for b in shared.value]
        for batch in batches:
            out = []
            for key in batch.column(0).to_pylist():
                k = bisect.bisect_left(lasts, key)
                while k < len(lasts) and shared.value[k][0] <= key:
                    out.append((shared.value[k][2], key))
                    k += 1
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.string()) for i in range(2)], ["part", "key"])

    wanted = keys.select(_escaped("key").alias("key")).where("key IS NOT NULL").distinct().mapInArrow(to_parts, "part string, key string")
    rows = wanted.select("part", "key", F.lit(None).cast("int").alias("block"), F.lit(None).cast("string").alias("last"),
                         F.lit(None).cast("long").alias("offset"), F.lit(None).cast("long").alias("length")).union(
        directory.select("part", F.col("first").alias("key"), "block", "last", "offset", "length"))
    # within a part: its directory in order of blocks, then the keys
    rows = rows.repartition(max(1, len(bounds)), "part").sortWithinPartitions("part", F.col("block").asc_nulls_last(), "key")

    def search(batches):
        store, place = _store(folder)
        part, handle, blocks, kept = None, None, [], (None, [], [])
        for batch in batches:
            out = []
            for name, key, block, last, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                if name != part:
                    if handle is not None:
                        handle.close()
                    part, blocks, kept = name, [], (None, [], [])
                    handle = store.open_input_file(f"{place}/{name}")
                if block is not None:
                    blocks.append((key, last, offset, length))
                    continue
                k = bisect.bisect_left(blocks, key, key=lambda b: b[1])
                while k < len(blocks) and blocks[k][0] <= key:
                    if kept[0] != k:
                        handle.seek(blocks[k][2])
                        lines = zlib.decompress(handle.read(blocks[k][3]), 31).decode().split("\n")[:-1]
                        kept = (k, [x.split(" ", 1)[0] for x in lines], lines)
                    for at in range(bisect.bisect_left(kept[1], key), bisect.bisect_right(kept[1], key)):
                        if kept[1][at] != key:
                            raise ValueError(f"index block out of order at {key}")
                        out.append((key, *json.loads(kept[2][at].split(" ", 1)[1])))
                    k += 1
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate((
                pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()))], ["key", "page_id", "file", "offset", "length"])
        if handle is not None:
            handle.close()

    return rows.mapInArrow(search, CAPTURE)


def read_records(captures: DataFrame, folder: str, payload: bool = False) -> DataFrame:
    """Read the records of captures by byte range, in order of file and offset: page_id, url, payload_bytes,
    payload_digest, record_type, refers_to, and the payload (binary; null for revisits) if asked for."""
    import pyarrow as pa

    ordered = captures.select("file", "offset", "length").repartition("file").sortWithinPartitions("file", "offset")
    types = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", *["payload"] * payload]

    def read(batches):
        store, place = _store(folder)
        now, handle = None, None
        for batch in batches:
            out = []
            for name, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                if name != now:
                    if handle is not None:
                        handle.close()
                    now, handle = name, store.open_input_file(f"{place}/{name}")
                handle.seek(offset)
                out.append(parse_record(zlib.decompress(handle.read(length), 31)))
            yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in out], t) for n, t in zip(names, types)], names)
        if handle is not None:
            handle.close()

    return ordered.mapInArrow(read, RECORD + ", payload binary" * payload)


def archive_and_read(spark: SparkSession, pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write archives and index of ``pages`` to ``folder``, look every url up in the index, and read the records."""
    folder = folder or work_dir(spark, "warc")
    captures = write_archives(pages, folder)
    directory = build_index(captures, folder)
    return read_records(lookup(captures.select("key"), directory, folder), folder)
