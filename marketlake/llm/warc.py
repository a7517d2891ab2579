"""WARC archives with a two-level capture index: sorted compressed blocks, a sparse directory, range reads."""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import groupby
from typing import NamedTuple
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, batch, batch_rows, new_path, stored

#: Payloads of at least so many bytes are written once; an archive is closed beyond ROLL bytes.
SMALLEST, ROLL = 100, 1 << 30
#: Lines of a compressed index block, and of an index file at least.
LINES, FILE_LINES = 2048, 16_384
#: Records of one reading task lie in the same 2^CHUNK bytes of an archive.
CHUNK = 24
_ID, _CRLF = "urn:uuid:", b"\r\n"


class Index(NamedTuple):
    """The first level: per index file its first and last key and where its block directory lies."""

    folder: str
    files: list[tuple[str, str, str, int, int]]


def url_key(url: str | None) -> str:
    """The URL with its host's labels reversed (`com,example,www)/path?query`), without scheme,
    user, default port and fragment.  Null gives the empty key; what is no URL is its own key."""
    if url is None:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or "").rstrip("."), parts.port
    except ValueError:
        return url
    if not host:
        return url
    number = ":" in host or host.replace(".", "").isdigit()
    key = host if number else ",".join(reversed(host.split(".")))
    if port not in (None, {"http": 80, "https": 443}.get(parts.scheme)):
        key += f":{port}"
    return f"{key}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


def _opened(folder: str) -> tuple[fs.FileSystem, str]:
    if folder.startswith("file:/") and not folder.startswith("file://"):
        folder = "file://" + folder.removeprefix("file:")
    return fs.FileSystem.from_uri(folder)


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One WARC record as a gzip member of its own."""
    head = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))])
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(b"WARC/1.1\r\n" + head.encode() + _CRLF + block + _CRLF * 2) + packer.flush()


def _headers(kind: str, run: uuid.UUID, row: int, url: str | None, digest: str, date: str) -> list[tuple[str, str]]:
    named = [("WARC-Type", kind), ("WARC-Record-ID", f"<{_ID}{uuid.uuid5(run, str(row))}>"), ("WARC-Date", date)]
    if url is not None:
        named.append(("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~|^`{}\"<>\\")))
    return [*named, ("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http; msgtype=response")]


_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"


def parse_record(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and payload of a gzip member that holds one record."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(_CRLF * 2)
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/1."):
        raise ValueError("no WARC record at this place")
    headers = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
    block = rest[: int(headers["content-length"])]
    if len(rest) != len(block) + 4:
        raise ValueError("the record's length is wrong")
    return headers, block.partition(_CRLF * 2)[2]


def write_archives(pages: DataFrame, date: str = "1970-01-01T00:00:00Z", roll: int = ROLL) -> tuple[str, DataFrame]:
    """Write (page_id, url, html) as records of gzip WARC files; the folder and the captures.

    Captures are (key, row, page_id, url, file, offset, length, record_type), a row for each
    page.  `row` tells apart rows that share everything else.  Of equal payloads (UTF-8; null:
    empty) of at least SMALLEST bytes the row of the smallest page_id (null last) is written as
    response and the others as revisits of it; equal rows count one by one.  A null URL has no
    target header.  An empty table writes no file.  Other columns are ignored.

    The payload is compressed by the task that reads it and only that member moves, to the
    row's number, so no group of copies lands in one task.  An archive's name holds the attempt
    that wrote it: files of lost attempts are named by no capture.
    """
    spark = pages.sparkSession
    folder, run = new_path(spark, "warc"), uuid.uuid4()

    def compressed(b: pa.RecordBatch) -> pa.RecordBatch:
        keys, sizes, digests, members = [], [], [], []
        urls = b.column("url").to_pylist()
        for row, url, html in zip(b.column("row").to_pylist(), urls, b.column("html"), strict=True):
            payload = html.as_buffer().to_pybytes() if html.is_valid else b""
            digest = hashlib.sha256(payload).hexdigest()
            block = _HTTP.format(len(payload)).encode() + payload
            members.append(_record(_headers("response", run, row, url, digest, date), block))
            keys.append(url_key(url))
            sizes.append(len(payload))
            digests.append(digest)
        return batch(
            row=b.column("row"), page_id=b.column("page_id"), url=b.column("url"), key=pa.array(keys, pa.string()),
            bytes=pa.array(sizes, pa.int64()), digest=digests, member=pa.array(members, pa.binary()),
        )

    batch_rows(spark, 256)
    given = pages.select(
        F.monotonically_increasing_id().alias("row"), F.col("page_id").cast("long"), F.col("url").cast("string"),
        F.col("html").cast("string").cast("binary").alias("html"),
    )
    fields = "row long, page_id long, url string, key string"
    members = stored(arrow_map(given, compressed, f"{fields}, bytes long, digest string, member binary"), "members")
    large = members.where(F.col("bytes") >= SMALLEST).select("row", "page_id", "digest")
    first = F.min(F.struct(F.col("page_id").isNull(), "page_id", "row"))["row"].alias("first")
    copied = large.groupBy("digest").agg(first, F.count("*").alias("n")).where("n > 1").select("digest", "first")
    revisits = stored(large.join(copied, "digest").where("row <> first").select("row", "first"), "revisits")
    records = members.join(revisits, "row", "left").withColumn("member", F.expr("if(first is null, member, null)"))

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = _opened(folder)
        task, out, at, name, part = TaskContext.get(), None, 0, "", 0
        try:
            for b in batches:
                offsets, lengths, files, kinds = [], [], [], []
                for r in b.select(["row", "url", "digest", "first", "member"]).to_pylist():
                    member = r["member"]
                    if member is None:
                        headers = _headers("revisit", run, r["row"], r["url"], r["digest"], date)
                        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
                        headers += [("WARC-Refers-To", f"<{_ID}{uuid.uuid5(run, str(r['first']))}>"), ("WARC-Profile", profile)]
                        member = _record(headers, b"HTTP/1.1 200 OK\r\n\r\n")
                    if out is None:
                        name = f"pages-{task.partitionId():06d}-{part:04d}-{task.taskAttemptId()}.warc.gz"
                        store.create_dir(top, recursive=True)
                        out = store.open_output_stream(f"{top}/{name}", compression=None)
                        info = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<{_ID}{uuid.uuid4()}>"), ("WARC-Date", date)]
                        start = _record([*info, ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
                        out.write(start)
                        at = len(start)
                    out.write(member)
                    offsets.append(at)
                    lengths.append(len(member))
                    files.append(name)
                    kinds.append("response" if r["first"] is None else "revisit")
                    at += len(member)
                    if at >= roll:
                        out.close()
                        out, part = None, part + 1
                yield batch(
                    key=b.column("key"), row=b.column("row"), page_id=b.column("page_id"), url=b.column("url"),
                    file=files, offset=pa.array(offsets, pa.int64()), length=pa.array(lengths, pa.int64()), record_type=kinds,
                )
        finally:
            if out is not None:
                out.close()

    captures = records.mapInArrow(written, f"key string, {fields.removesuffix(', key string')}, file string, offset long, length long, record_type string")
    return folder, stored(captures, "captures")


def build_index(folder: str, captures: DataFrame, lines: int = LINES, file_lines: int = FILE_LINES) -> Index:
    """Sort the captures by key into index files of compressed blocks, each with its directory.

    A block holds `lines` captures as JSON lines.  A file ends with its sparse directory, the
    first key, offset and length of every block.  The files cover ascending key ranges; their
    number grows with the square root of the captures, and only it reaches the driver.  A key
    with many captures goes on over as many blocks and files as it needs.
    """
    rows = captures.count()
    files = max(1, -(-rows // (file_lines * max(1, int(rows**0.5) >> 8))))
    order = ["key", "page_id", "row"]

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, directory, at, out, last = [], [], 0, None, ""
        store, top = _opened(folder)
        task = TaskContext.get()
        name = f"index-{task.partitionId():06d}-{task.taskAttemptId()}.cdx"

        def block() -> None:
            nonlocal at
            packed = zlib.compress("\n".join(map(json.dumps, held)).encode())
            out.write(packed)
            directory.append((held[0][0], at, len(packed)))
            at += len(packed)
            held.clear()

        try:
            for b in batches:
                out = out or store.open_output_stream(f"{top}/{name}", compression=None)
                for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    held.append(r)
                    last = r[0]
                    if len(held) == lines:
                        block()
            if held:
                block()
            if directory:
                packed = zlib.compress(json.dumps(directory).encode())
                out.write(packed)
        finally:
            if out is not None:
                out.close()
        if directory:
            yield batch(
                name=[name], first=[directory[0][0]], last=[last], offset=pa.array([at], pa.int64()),
                length=pa.array([len(packed)], pa.int64()),
            )

    batch_rows(captures.sparkSession, 10_000)
    dealt = captures.select("key", "row", "page_id", "url", "file", "offset", "length", "record_type")
    dealt = dealt.repartitionByRange(files, *order).sortWithinPartitions(*order)
    made = stored(dealt.mapInArrow(indexed, "name string, first string, last string, offset long, length long"), "index")
    return Index(folder, sorted((tuple(r) for r in made.collect()), key=lambda f: (f[1], f[2], f[0])))


def lookup(index: Index, urls: DataFrame) -> DataFrame:
    """The captures of every distinct key of the column `url`, by two binary searches.

    A key is looked for in the files' ranges, then in the directories of those files, which
    names the blocks that may hold it; every such block is read by its range and searched once,
    by whichever task it was dealt to.  So a key with many captures is as many small reads.
    A URL without captures gives no rows; the null URL finds captures without URL.
    """
    folder, files = index
    firsts, lasts = [f[1] for f in files], [f[2] for f in files]
    places = {f[0]: f[3:] for f in files}
    shared = urls.sparkSession.sparkContext.broadcast((files, firsts, lasts, places))

    def keyed(b: pa.RecordBatch) -> pa.RecordBatch:
        return batch(key=pa.array([url_key(u) for u in b.column("url").to_pylist()], pa.string()))

    def in_files(b: pa.RecordBatch) -> pa.RecordBatch | None:
        files, firsts, lasts, _ = shared.value
        found = [(files[i][0], key) for key in b.column("key").to_pylist() for i in range(bisect_left(lasts, key), bisect_right(firsts, key))]
        return batch(name=[f for f, _ in found], key=[k for _, k in found]) if found else None

    def in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = _opened(folder)
        now, directory, starts = None, [], []
        for b in batches:
            found = []
            for name, key in zip(b.column("name").to_pylist(), b.column("key").to_pylist(), strict=True):
                if name != now:
                    offset, length = shared.value[3][name]
                    with store.open_input_file(f"{top}/{name}") as f:
                        directory = json.loads(zlib.decompress(f.read_at(length, offset)))
                    now, starts = name, [d[0] for d in directory]
                # the key may begin inside the block before the first that starts with it
                for _, at, size in directory[max(0, bisect_left(starts, key) - 1) : bisect_right(starts, key)]:
                    found.append((name, at, size, key))
            if found:
                name, at, size, key = zip(*found, strict=True)
                yield batch(name=pa.array(name), at=pa.array(at, pa.int64()), size=pa.array(size, pa.int64()), key=pa.array(key))

    def in_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = _opened(folder)
        now, lines, starts = None, [], []
        for b in batches:
            found = []
            for name, at, size, key in zip(*(b.column(c).to_pylist() for c in ("name", "at", "size", "key")), strict=True):
                if (name, at) != now:
                    with store.open_input_file(f"{top}/{name}") as f:
                        lines = [json.loads(x) for x in zlib.decompress(f.read_at(size, at)).decode().split("\n")]
                    now, starts = (name, at), [x[0] for x in lines]
                found += lines[bisect_left(starts, key) : bisect_right(starts, key)]
            if found:
                columns = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _CAPTURE, strict=True)], schema=_CAPTURE)

    batch_rows(urls.sparkSession, 10_000)
    keys = arrow_map(urls.select("url"), keyed, "key string").distinct()
    wanted = arrow_map(keys, in_files, "name string, key string").repartition("name").sortWithinPartitions("name", "key")
    blocks = wanted.mapInArrow(in_blocks, "name string, at long, size long, key string")
    blocks = blocks.repartition("name", "at").sortWithinPartitions("name", "at", "key")
    return blocks.mapInArrow(in_lines, "key string, row long, page_id long, url string, file string, offset long, length long, record_type string")


_CAPTURE = pa.schema(
    [("key", pa.string()), ("row", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()), ("file", pa.string()),
     ("offset", pa.int64()), ("length", pa.int64()), ("record_type", pa.string())]
)


def read_records(index: Index, captures: DataFrame) -> DataFrame:
    """The captures with their records: record_id, refers_to_id, digest (the header's), payload.

    Each record is one range read; those near each other in an archive are read by one task in
    the archive's order.  A revisit's payload is empty: it lies in the record it refers to.
    """
    folder = index.folder

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = _opened(folder)
        for b in batches:
            kinds, ids, refers, digests, payloads = [], [], [], [], []
            places = zip(b.column("file").to_pylist(), b.column("offset").to_pylist(), b.column("length").to_pylist(), strict=True)
            for name, group in groupby(places, key=lambda p: p[0]):
                with store.open_input_file(f"{top}/{name}") as f:
                    for _, offset, length in group:
                        headers, payload = parse_record(f.read_at(length, offset))
                        kinds.append(headers["warc-type"])
                        ids.append(headers["warc-record-id"])
                        refers.append(headers.get("warc-refers-to"))
                        digests.append(headers["warc-payload-digest"].removeprefix("sha256:"))
                        payloads.append(payload)
            yield batch(
                key=b.column("key"), row=b.column("row"), page_id=b.column("page_id"), url=b.column("url"), record_type=kinds,
                record_id=ids, refers_to_id=pa.array(refers, pa.string()), digest=digests, payload=pa.array(payloads, pa.binary()),
            )

    batch_rows(captures.sparkSession, 256)
    near = F.shiftright("offset", CHUNK)
    dealt = captures.repartition("file", near).sortWithinPartitions("file", "offset")
    return dealt.mapInArrow(
        records,
        "key string, row long, page_id long, url string, record_type string, record_id string, refers_to_id string,"
        " digest string, payload binary",
    )


def capture_facts(index: Index, urls: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of the URLs' captures.

    Size and digest are taken from the payload that was read; a revisit has those of the
    record that it names, whose URL has to be among those asked for.
    """
    read = read_records(index, lookup(index, urls)).select(
        "page_id", "record_type", "record_id", "refers_to_id", F.octet_length("payload").cast("long").alias("size"), F.sha2("payload", 256).alias("hash")
    )
    read = stored(read, "read")
    whole = read.where("record_type = 'response'")
    named = whole.select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"), "size", "hash")
    again = read.where("record_type = 'revisit'").drop("size", "hash").join(named, "refers_to_id")
    columns = ["page_id", F.col("size").alias("payload_bytes"), F.col("hash").alias("payload_digest"), "record_type", "refers_to"]
    return whole.withColumn("refers_to", F.lit(None).cast("long")).select(*columns).union(again.select(*columns))


def round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages, index them and read every capture back through the index."""
    folder, captures = write_archives(pages)
    return capture_facts(build_index(folder, captures), pages.select("url"))
