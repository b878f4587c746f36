"""Web archives (WARC 1.1) and a two-level capture index over them.

Archives are written by Spark's text writer: a record's block ends with two line ends, which is the writer's separator, so the
files are plain archives on any file system that Spark can write. Reading goes by Content-Length, never by separators. Records are
written apart by size, so many to a file that no file passes `FILE_BYTES` but for a single larger record: a reader's task holds one.

The index sorts captures by reversed-host URL key into compressed blocks, one a line, and keeps a sparse directory of the blocks'
first keys with path, offset and length. A lookup binary-searches the directory, reads the ranges of few blocks and records. Many
lookups at once binary-search the directory in tasks; then the blocks that they name, and no others, are unpacked and searched.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import re
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from ledgerforge.llm.common import at_most, shared_path, written

END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURE = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, path string, offset long, length long"
NAMES = [x.split()[0] for x in CAPTURE.split(", ")]
ARROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("path", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])
#: Bytes of an archive, about; the html sizes up to which records go to a file together, each with as many as fit.
FILE_BYTES, SIZES = 256 << 20, (1 << 16, 1 << 20, 1 << 24, 1 << 40)
#: Compressed blocks in a file of the index (some 200 kB each).
FILE_BLOCKS = 200
#: Blocks that a directory may have to be held whole: one for every 3,000 captures. Up to so many files of the index a lookup names.
DIRECTORY_ROWS, NAMED_FILES = 200_000, 1000


def surt(url: str) -> str:
    """The URL's key: host names reversed, without scheme, port and www, then path and query: com,example)/a?b. White space is as %20."""
    url = re.sub(r"[\x00-\x20\x7f]", "%20", url)
    try:
        parts = urlsplit(url if "//" in url else f"//{url}")
        host = (parts.hostname or "").removeprefix("www.")
    except ValueError:
        return url
    return f"{','.join(reversed(host.split('.')))}){parts.path or '/'}{'?' + parts.query if parts.query else ''}"


def write_archives(pages: DataFrame, path: str, *, least_bytes: int = 100, file_bytes: int = FILE_BYTES, broadcast_rows: int = 250_000, date: str = "2024-01-01T00:00:00Z") -> None:
    """Writes a record for each row of pages (page_id, url, html): the html in UTF-8, null as empty.

    Of equal payloads of at least `least_bytes`, that with the smallest page_id is a response and others refer to it; smaller
    ones are all responses, as is a page without an id where no equal one has an id. Payloads stay where they are read: only
    digests are aggregated, and those met twice return by a broadcast up to `broadcast_rows`, beyond that by a shuffle. Rows that
    repeat a page_id are records of their own: of equal payloads all with the smallest page_id are responses. No pages make no files.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), html.alias("html"))
    rows = rows.withColumns({"bytes": F.octet_length("html").cast("long"), "digest": F.sha2("html", 256)})
    size = sum((F.when(F.col("bytes") > n, 1).otherwise(0) for n in SIZES), F.lit(0))
    digests = written(rows.select(F.unhex("digest").alias("same"), "page_id", "bytes", size.alias("size")), "digests")
    big = digests.where(F.col("bytes") >= least_bytes).select("same", "page_id")
    twice = written(big.groupBy("same").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 AND first IS NOT NULL").select("same", "first"), "payloads")
    if at_most(twice, broadcast_rows):
        twice = F.broadcast(twice)
    rows = rows.join(twice, F.unhex("digest") == twice["same"], "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(END))
    block = F.when(again, http).otherwise(F.concat(http, "html"))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(again, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: "), name(F.col("page_id")), F.lit(f"\r\nWARC-Date: {date}\r\nWARC-Target-URI: "), F.regexp_replace("url", r"[\x00-\x20\x7f]", "%20"),
        F.lit("\r\nWARC-Payload-Digest: sha256:"), F.col("digest"),
        F.when(again, F.concat(F.lit(f"\r\nWARC-Profile: {PROFILE}\r\nWARC-Refers-To: "), name(F.col("first")))).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http;msgtype=response\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit(END),
    )
    for k in sorted(r["size"] for r in digests.select("size").distinct().collect()):
        fit = max(1, file_bytes // SIZES[k])
        rows.where(size == k).select(F.concat(head, block).alias("value")).write.option("lineSep", END).option("maxRecordsPerFile", fit).mode("append").text(path)
    if not digests.limit(1).count():
        rows.select(F.lit("").alias("value")).limit(0).write.text(path)


def records(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes, bytes]]:
    """Of each record of an archive: offset, length with its end, headers, HTTP headers, payload."""
    at = 0
    while at < len(data):
        head = data.index(b"\r\n\r\n", at)
        lines = data[at:head].decode("utf-8").split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError(f"no record at {at}: {lines[0]!r}")
        headers = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
        size = int(headers["Content-Length"])
        block = data[head + 4 : head + 4 + size]
        end = head + 4 + size + 4
        if len(block) < size or data[end - 4 : end] != b"\r\n\r\n":
            raise ValueError(f"the record at {at} is cut off")
        http, _, payload = block.partition(b"\r\n\r\n")
        yield at, end - at, headers, http, payload
        at = end


def capture(headers: dict[str, str], http: bytes, payload: bytes) -> tuple:
    """The first six columns of a capture; the payload of a response must have the digest that its header names."""
    number = lambda x: int(m[1]) if (m := re.fullmatch(r"<urn:page:(-?\d+)>", x)) else None
    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    if headers["WARC-Type"] == "response" and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != size):
        raise ValueError(f"{headers['WARC-Record-ID']}: its payload isn't that of its digest")
    return number(headers["WARC-Record-ID"]), headers["WARC-Target-URI"], headers["WARC-Type"], number(headers.get("WARC-Refers-To", "")), size, digest


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """A capture per record: what it is, and where (path, offset, length). A record that is cut off or isn't as its header says fails the read."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0), batch.column(1), strict=True):
                rows = [(*capture(h, http, payload), name.as_py(), at, n) for at, n, h, http, payload in records(data.as_py())]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), ARROW.types, strict=True)], schema=ARROW)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return files.mapInArrow(parse, CAPTURE)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = pa.array([None if u is None else surt(u) for u in batch.column(0).to_pylist()], pa.string())
        yield pa.RecordBatch.from_arrays([keys, *batch.columns], ["key", *batch.schema.names])


def write_index(captures: DataFrame, path: str, *, block_rows: int = 3000) -> None:
    """Writes path/blocks (text, a number and a compressed block a line) and path/directory (Parquet: first_key, number, path, offset,
    length).

    Captures of one key go by page_id, then by where they are; those that are repeated are repeated in the index. No captures make an
    empty directory.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = []
        number = TaskContext.get().partitionId() << 32

        def block(rows: list[list]) -> pa.RecordBatch:
            nonlocal number
            data = zlib.compress("\n".join(json.dumps(r) for r in rows).encode())
            number += 1
            return pa.RecordBatch.from_arrays([pa.array([f"{number} {base64.b64encode(data).decode()}"])], ["value"])

        for batch in batches:
            held += map(list, zip(*(c.to_pylist() for c in batch.columns), strict=True))
            while len(held) > block_rows:
                yield block(held[:block_rows])
                held = held[block_rows:]
        if held:
            yield block(held)

    spark = captures.sparkSession
    order = ["key", "page_id", "path", "offset"]
    keyed = captures.select("url", *(c for c in NAMES if c != "url")).mapInArrow(_keyed, f"key string, url string, {CAPTURE.replace('url string, ', '')}").select("key", *NAMES)
    rows = written(keyed, "captures").repartitionByRange(*order).sortWithinPartitions(*order)
    rows.mapInArrow(build, "value string").write.option("maxRecordsPerFile", FILE_BLOCKS).text(f"{path}/blocks")

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0), batch.column(1), strict=True):
                at, found = 0, []
                for line in data.as_py().splitlines():
                    found.append((block_rows_of(line)[0][0], int(line.split(b" ", 1)[0]), name.as_py(), at, len(line)))
                    at += len(line) + 1
                columns = list(zip(*found, strict=True)) or [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()), strict=True)], ["first_key", "number", "path", "offset", "length"])

    blocks = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/blocks").select("path", "content")
    blocks.mapInArrow(listed, "first_key string, number long, path string, offset long, length long").write.parquet(f"{path}/directory")


def block_rows_of(line: bytes) -> list[list]:
    """[key, page_id, url, ...] of each capture in a block."""
    return [json.loads(x) for x in zlib.decompress(base64.b64decode(line.split(b" ", 1)[1])).split(b"\n")]


def read_index(blocks: DataFrame) -> DataFrame:
    """key, and its captures, of lines (value) of an index."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for line in batch.column(0):
                rows = zip(*block_rows_of(line.as_py().encode()), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, [pa.string(), *ARROW.types], strict=True)], ["key", *NAMES])

    return blocks.select("value").mapInArrow(unpack, f"key string, {CAPTURE}")


def lookup(spark: SparkSession, path: str, urls: DataFrame, *, directory_rows: int = DIRECTORY_ROWS) -> DataFrame:
    """All captures in the index of keys that a row of urls (url) has, each once; a null url has the key of an empty one.

    Tasks binary-search the directory while it has at most `directory_rows` rows; only the files with blocks found are read (all, if
    they are more than NAMED_FILES), and of them only those blocks unpacked. Beyond that all blocks are read, which as many lookups would
    name anyway.
    """
    keys = written(urls.select(F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url")).distinct().mapInArrow(_keyed, "key string, url string").select("key").distinct(), "keys")
    blocks = spark.read.text(f"{path}/blocks")
    directory = spark.read.parquet(f"{path}/directory")
    if at_most(directory, directory_rows):
        rows = sorted((r["first_key"], r["number"]) for r in directory.select("first_key", "number").collect())
        firsts, numbers = [r[0] for r in rows], [r[1] for r in rows]

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found: set[int] = set()
                for key in batch.column(0).to_pylist():
                    found.update(numbers[max(0, bisect.bisect_left(firsts, key) - 1) : bisect.bisect_right(firsts, key)])
                yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.int64())], ["number"])

        asked = written(keys.mapInArrow(search, "number long").distinct(), "blocks")
        files = written(directory.join(F.broadcast(asked), "number", "left_semi").select("path").distinct(), "files")
        if at_most(files, NAMED_FILES):
            blocks = spark.read.text([r["path"] for r in files.collect()] or [f"{path}/blocks"])
        number = F.split_part("value", F.lit(" "), F.lit(1)).cast("long")
        blocks = blocks.withColumn("number", number).join(F.broadcast(asked), "number", "left_semi")
    return read_index(blocks).join(keys, "key", "left_semi").select(*NAMES)


class CaptureIndex:
    """Lookups by URL. Holds the sparse directory, one key for every `block_rows` captures; a directory of more than `directory_rows`
    rows is asked for each lookup instead."""

    def __init__(self, spark: SparkSession, path: str, *, directory_rows: int = DIRECTORY_ROWS):
        self.spark = spark
        self.table = spark.read.parquet(f"{path}/directory").select("first_key", "path", "offset", "length")
        self.held = sorted(map(tuple, self.table.collect())) if at_most(self.table, directory_rows) else None

    def _range(self, path: str, offset: int, length: int) -> bytes:
        jvm = self.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        stream = at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).open(at)
        try:
            stream.seek(offset)
            return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(jvm.org.apache.commons.io.input.BoundedInputStream(stream, length)))
        finally:
            stream.close()

    def _blocks(self, key: str) -> list[tuple]:
        """From the last block that begins before the key to the last that begins with it."""
        if self.held is not None:
            first = bisect.bisect_left(self.held, key, key=lambda x: x[0])
            return self.held[max(0, first - 1) : bisect.bisect_right(self.held, key, key=lambda x: x[0])]
        before = self.table.where(F.col("first_key") < key).agg(F.max("first_key").alias("k")).first()["k"]
        last = self.table.where(F.col("first_key") == (before or "")).orderBy(F.desc("path"), F.desc("offset")).limit(1)  # blocks of one key follow each other
        return sorted(map(tuple, last.unionByName(self.table.where(F.col("first_key") == key)).collect())) if before is not None else sorted(map(tuple, self.table.where(F.col("first_key") == key).collect()))

    def captures(self, url: str) -> list[dict]:
        """The captures whose URL has the same key."""
        key, out = surt(url), []
        for _, path, offset, length in self._blocks(key):
            rows = block_rows_of(self._range(path, offset, length))
            keys = [r[0] for r in rows]
            out += [dict(zip(NAMES, r[1:], strict=True)) for r in rows[bisect.bisect_left(keys, key) : bisect.bisect_right(keys, key)]]
        return out

    def payload(self, found: dict) -> bytes:
        """The payload of a response, by one range read."""
        return next(records(self._range(found["path"], found["offset"], found["length"])))[4]


def archive_round_trip(pages: DataFrame, **options) -> DataFrame:
    """Writes pages to archives, reads them back into an index, and looks all pages' URLs up in it: their captures (see CAPTURE's columns)."""
    spark = pages.sparkSession
    archives, index = shared_path(spark, "archives"), shared_path(spark, "index")
    write_archives(pages, archives, **options)
    write_index(read_archives(spark, archives), index)
    return lookup(spark, index, pages.select("url"))
