"""WARC archives with a two-level capture index.

Captures are sorted by reversed-host URL key and stored as compressed blocks of
index lines; a sparse directory keeps the first and last key of each block. A
look-up binary-searches the directory, reads the byte range of the few blocks
that can hold the key, binary-searches their lines, and then reads the byte
ranges of the records. Archives, blocks and directories are files in the shared
folder, reached through its file system from any executor.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import uuid
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir, written

#: An archive file is closed once it is this large.
ARCHIVE_BYTES = 256 << 20
#: Index lines in one compressed block.
BLOCK_LINES = 3000
#: Byte ranges this close are read by one task, in order.
READ_SPAN = 8 << 20
#: Index blocks that one task reads, on average.
BLOCKS_PER_TASK = 16
RECORD_ID = "urn:ledgerwing:page:"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

CAPTURES = "key string, file string, offset long, length long"
SHARDS = "shard string, first_key string, last_key string, blocks long"
RECORDS = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, file string, offset long, payload binary"
)


def store_of(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def url_key(url: Column) -> Column:
    """Reversed-host key: ``http://a.b.com/x?y`` gives ``com,b,a)/x?y``; NULL gives ``-``.

    Scheme, user, port and fragment do not count and the host's case is folded.
    Blanks and control characters are escaped, so a key is one word of one line.
    """
    rest = F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://", "")
    host = F.lower(F.regexp_extract(rest, r"^(?:[^/?#@]*@)?([^/?#:]*)", 1))
    tail = F.regexp_replace(F.regexp_replace(rest, r"^[^/?#]*", ""), r"(?s)#.*$", "")
    key = F.concat(
        F.array_join(F.reverse(F.split(host, r"\.")), ","),
        F.lit(")"),
        F.when(tail == "", "/").otherwise(tail),
    )
    return F.coalesce(F.regexp_replace(key, r"[\x00-\x20\x7f]", "%20"), F.lit("-"))


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_bytes(row: dict, date: str) -> bytes:
    """One WARC/1.1 record; a revisit keeps the HTTP headers and drops the payload."""
    payload, revisit = row["payload"], row["revisit"]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if revisit else payload)
    page = row["page_id"]
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{RECORD_ID}{'none' if page is None else page}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if row["url"] is not None:
        head.append(f"WARC-Target-URI: {quote(row['url'], safe=':/?#[]@!$&()*+,;=%~')}")
    if revisit:
        head += [f"WARC-Refers-To: <{RECORD_ID}{row['refers_to']}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """The fields of :data:`RECORDS` of one record; raises if a digest does not hold."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    http, _, payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != size or sha1_base32(payload) != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")

    def number(name: str) -> int | None:
        text = fields.get(name, "none").strip("<>").removeprefix(RECORD_ID)
        return None if text == "none" else int(text)

    return {
        "page_id": number("WARC-Record-ID"),
        "url": fields.get("WARC-Target-URI"),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": number("WARC-Refers-To"),
        "payload": payload if kind == "response" else None,
    }


def mark_revisits(pages: DataFrame) -> DataFrame:
    """``(page_id, url, payload, revisit, refers_to)`` per row of ``pages(page_id, url, html)``.

    Of rows with equal payloads those with the smallest ``page_id`` are responses,
    the others revisit it. A row without a ``page_id`` comes last: it revisits, or
    is a response where no row with that payload has an id. NULL html is empty.
    """
    rows = pages.select(
        "page_id", "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload")
    ).withColumn("digest", F.sha1("payload"))
    repeated = (
        rows.groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
        .where("n > 1 AND first_id IS NOT NULL")
        .select("digest", "first_id")
    )
    # The written table joins as a plain scan: small ones are broadcast by size and
    # a digest with a third of all rows is a skewed partition that can be split.
    joined = rows.join(written(repeated, "repeated-payloads"), "digest", "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.select(
        "page_id",
        "url",
        "payload",
        revisit.alias("revisit"),
        F.when(revisit, F.col("first_id")).alias("refers_to"),
    )


def write_archives(records: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write one gzip member per record; returns where each lies, as ``CAPTURES``.

    Files carry a random name, and only rows of tasks that were committed name a
    file, so the leftovers of a lost task are never read.
    """
    source = records.withColumn("key", url_key(F.col("url")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = store_of(folder)
        out, path, at = None, "", 0
        for batch in batches:
            rows = {"key": [], "file": [], "offset": [], "length": []}
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                if out is None:
                    path, at = f"pages-{uuid.uuid4().hex}.warc.gz", 0
                    store.create_dir(root)
                    out = store.open_output_stream(f"{root}/{path}", compression=None)
                data = gzip.compress(record_bytes(row, date), 6, mtime=0)
                out.write(data)
                for name, value in (("key", row["key"]), ("file", path), ("offset", at), ("length", len(data))):
                    rows[name].append(value)
                at += len(data)
                if at >= ARCHIVE_BYTES:
                    out.close()
                    out = None
            yield pa.RecordBatch.from_pydict(rows)
        if out is not None:
            out.close()

    return written(source.mapInArrow(run, CAPTURES), "captures")


@dataclass(frozen=True)
class CaptureIndex:
    """Folder of blocks and directories, and one ``SHARDS`` row per sorted range."""

    folder: str
    shards: DataFrame


def build_index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> CaptureIndex:
    """Sort captures into compressed blocks, each range with a directory beside it.

    The sort key goes on with the record's place, so a URL or host that holds a
    third of all captures is spread over as many ranges as it needs.
    """
    order = ["key", "file", "offset"]
    ranged = captures.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = store_of(folder)
        name, out, at, lines, directory = uuid.uuid4().hex, None, 0, [], []

        def flush() -> None:
            nonlocal at
            data = gzip.compress("\n".join(f"{k} {json.dumps(v)}" for k, *v in lines).encode(), 6, mtime=0)
            out.write(data)
            directory.append((lines[0][0], lines[-1][0], at, len(data)))
            at += len(data)
            lines.clear()

        for batch in batches:
            if out is None and batch.num_rows:
                store.create_dir(root)
                out = store.open_output_stream(f"{root}/{name}.cdx.gz", compression=None)
            for line in zip(*(batch.column(c).to_pylist() for c in (*order, "length")), strict=True):
                lines.append(line)
                if len(lines) == block_lines:
                    flush()
        if lines:
            flush()
        if out is not None:
            out.close()
            with store.open_output_stream(f"{root}/{name}.dir") as side:
                side.write("\n".join(json.dumps(d) for d in directory).encode())
            yield pa.RecordBatch.from_pydict(
                {
                    "shard": [name],
                    "first_key": [directory[0][0]],
                    "last_key": [directory[-1][1]],
                    "blocks": [len(directory)],
                }
            )

    return CaptureIndex(folder, written(ranged.mapInArrow(run, SHARDS), "index-shards"))


def lookup(index: CaptureIndex, keys: DataFrame) -> DataFrame:
    """Captures (``CAPTURES``) of each distinct key of ``keys(key)``; absent keys give none.

    The shard bounds are one row per range of the index and travel with the tasks;
    the number of ranges is the cluster's number of shuffle partitions. A key with
    very many captures is located as many blocks, which different tasks read.
    """
    bounds = sorted(
        (r.first_key, r.last_key, r.shard) for r in index.shards.toLocalIterator()
    )
    firsts, lasts = [b[0] for b in bounds], [b[1] for b in bounds]
    folder = index.folder
    wanted = keys.select(F.coalesce("key", F.lit("-")).alias("key")).distinct()

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = store_of(folder)
        known: dict[str, tuple[list, list, list]] = {}

        def directory(shard: str) -> tuple[list, list, list]:
            if shard not in known:
                known.clear()  # keys come sorted, so one range is needed at a time
                with store.open_input_stream(f"{root}/{shard}.dir") as side:
                    rows = [json.loads(x) for x in side.read().decode().split("\n")]
                known[shard] = [r[0] for r in rows], [r[1] for r in rows], rows
            return known[shard]

        for batch in batches:
            out = {"key": [], "shard": [], "at": [], "size": []}
            for key in batch.column("key").to_pylist():
                for b in range(bisect_left(lasts, key), bisect_right(firsts, key)):
                    first, last, rows = directory(bounds[b][2])
                    for r in rows[bisect_left(last, key) : bisect_right(first, key)]:
                        for name, value in zip(out, (key, bounds[b][2], r[2], r[3]), strict=True):
                            out[name].append(value)
            yield pa.RecordBatch.from_pydict(out, pa.schema(_arrow("key", "shard", at=1, size=1)))

    places = wanted.sortWithinPartitions("key").mapInArrow(
        locate, "key string, shard string, at long, size long"
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = store_of(folder)
        held, lines, line_keys = None, [], []
        for batch in batches:
            out = {"key": [], "file": [], "offset": [], "length": []}
            for key, shard, at, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held != (shard, at):
                    with store.open_input_file(f"{root}/{shard}.cdx.gz") as blocks:
                        text = gzip.decompress(blocks.read_at(size, at)).decode()
                    lines = [x.split(" ", 1) for x in text.split("\n")]
                    line_keys, held = [x[0] for x in lines], (shard, at)
                for _, place in lines[bisect_left(line_keys, key) : bisect_right(line_keys, key)]:
                    for name, value in zip(out, (key, *json.loads(place)), strict=True):
                        out[name].append(value)
            yield pa.RecordBatch.from_pydict(out, pa.schema(_arrow("key", "file", offset=1, length=1)))

    # As many tasks as the index has blocks for, whatever the size of the keys that name them.
    blocks = index.shards.agg(F.coalesce(F.sum("blocks"), F.lit(0))).first()[0]
    near = places.repartition(max(1, -(-blocks // BLOCKS_PER_TASK)), "shard", "at")
    return near.sortWithinPartitions("shard", "at", "key").mapInArrow(read, CAPTURES)


def _arrow(*strings: str, **longs: int) -> list[tuple[str, pa.DataType]]:
    return [*((s, pa.string()) for s in strings), *((n, pa.int64()) for n in longs)]


def read_records(captures: DataFrame, folder: str) -> DataFrame:
    """Range-read the records of ``captures`` and check their digests, as ``RECORDS``.

    One task per ``READ_SPAN`` bytes of archive on average.
    """
    captures = written(captures, "located")
    total = captures.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    span = F.floor(F.col("offset") / READ_SPAN)
    near = captures.repartition(max(1, -(-total // READ_SPAN)), "file", span).sortWithinPartitions("file", "offset")
    schema = pa.schema(
        [
            ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
            ("file", pa.string()), ("offset", pa.int64()), ("payload", pa.binary()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = store_of(folder)
        archive, name = None, None
        for batch in batches:
            rows, held = [], 0
            for file, at, size in zip(
                *(batch.column(c).to_pylist() for c in ("file", "offset", "length")), strict=True
            ):
                if file != name:
                    archive, name = store.open_input_file(f"{root}/{file}"), file
                row = parse_record(gzip.decompress(archive.read_at(size, at)))
                rows.append(row | {"file": file, "offset": at})
                held += row["payload_bytes"]
                if held > READ_SPAN:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, held = [], 0
            yield pa.RecordBatch.from_pylist(rows, schema)

    return near.mapInArrow(run, RECORDS)


def archive_and_read_back(pages: DataFrame) -> DataFrame:
    """Archive every page, index the captures, and read all of them back by their keys.

    One ``RECORDS`` row per row of ``pages(page_id, url, html)``; no pages, no rows.
    """
    spark: SparkSession = pages.sparkSession
    archives, blocks = scratch_dir(spark, "warc"), scratch_dir(spark, "capture-index")
    captures = write_archives(mark_revisits(pages), archives)
    index = build_index(captures, blocks)
    return read_records(lookup(index, pages.select(url_key(F.col("url")).alias("key"))), archives)
