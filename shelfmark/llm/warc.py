"""WARC archives: written by tasks, one gzip member for each record, and read back sequentially.

Writing: of equal payloads of at least ``MIN_REVISIT`` bytes the one with the smallest page_id becomes a response
record, the others become revisits that name it; all smaller payloads are responses. The first of each group of
equal payloads comes from one grouped minimum over digests; each task writes its rows as an archive of its own,
under a temporary name that is renamed when complete, and returns its path. So a repeated task leaves a whole file.

Reading: each archive is one sequential stream. It is inflated with a decompression object in chunks, a member
ends where zlib says so, the block is framed by Content-Length, and block and payload digests are verified.
Memory holds a chunk and a header; a payload is held only where it is asked for.

Files go through pyarrow's file systems (file, hdfs, s3, gs), to the folder given, by default below
spark.checkpoint.dir.

Nulls and edges: a null html is an empty payload; a null page_id sorts after all others and is written as an
empty id (a revisit of such a record has a null refers_to); of repeated rows with equal page_id one is the
response, the others revisit it; a very long payload is one record: writing holds it and its compressed form, reading a chunk
(and the payload, where it is kept); an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterable, Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.llm._session import new_folder, table, written

MIN_REVISIT = 100
CHUNK = 1 << 16
#: A row of repeated payloads is about 100 bytes.
BROADCAST_ROWS = 100_000
#: Bytes of a record's headers; more means a broken archive.
MAX_HEADER = 1 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"

RECORD_SCHEMA = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def _header(lines: Iterable[str]) -> bytes:
    return "\r\n".join([*lines, "", ""]).encode()


def _clean(value: str | None) -> str:
    """A header value has no line ends."""
    return (value or "").replace("\r", "%0D").replace("\n", "%0A")


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{digest}>"


def record(page_id: int | None, url: str | None, html: bytes, digest: str, refers_to: int | None, is_revisit: bool) -> bytes:
    """One record as a gzip member."""
    http = _header(["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(html)}"])
    block = http if is_revisit else http + html
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if is_revisit else 'response'}",
        f"WARC-Record-ID: {_record_id(page_id, ('revisit:' if is_revisit else '') + digest)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_clean(url)}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        f"Content-Length: {len(block)}",
    ]
    if is_revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(refers_to, digest)}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(_header(lines) + block + b"\r\n\r\n") + packer.flush()


def inflated(stream: BinaryIO) -> Iterator[tuple[bool, bytes]]:
    """(is this the start of a member, some bytes), in order; an empty piece for a member's first byte never comes."""
    unpack, fresh, begun, raw = zlib.decompressobj(31), True, False, stream.read(CHUNK)
    while raw:
        data, begun = unpack.decompress(raw, CHUNK), True
        raw = unpack.unused_data if unpack.eof else unpack.unconsumed_tail
        if data:
            yield fresh, data
            fresh = False
        if unpack.eof:
            unpack, fresh, begun = zlib.decompressobj(31), True, False
        if not raw:
            raw = stream.read(CHUNK)
    if begun:  # a member may end before its first byte of data
        raise ValueError("the archive ends within a record")


class _Source:
    """Reads of exact length from the pieces of one archive."""

    def __init__(self, stream: BinaryIO):
        self.parts, self.held, self.fresh = inflated(stream), b"", False

    def more(self) -> bool:
        fresh, data = next(self.parts, (False, b""))
        if fresh and self.held:
            raise ValueError("a record runs over its gzip member's end")
        self.held += data
        return bool(data)

    def ended(self) -> bool:
        return not self.held and not self.more()

    def until(self, mark: bytes) -> bytes:
        while (at := self.held.find(mark)) < 0:
            if len(self.held) > MAX_HEADER or not self.more():
                raise ValueError("a header has no end")
        out, self.held = self.held[:at], self.held[at + len(mark) :]
        return out

    def take(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.held and not self.more():
                raise ValueError("a block is shorter than its Content-Length")
            part, self.held = self.held[:n], self.held[n:]
            n -= len(part)
            yield part


def _fields(head: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode().split("\r\n")[1:])}


def _page(record_id: str) -> int | None:
    return int(x) if (x := record_id.strip("<>").split(":")[2]) else None


def read_records(stream: BinaryIO, keep_payload: bool = True) -> Iterator[tuple]:
    """The records of one archive, as in RECORD_SCHEMA; raises ValueError where framing or a digest is wrong."""
    source = _Source(stream)
    while not source.ended():
        head = source.until(b"\r\n\r\n")
        if not head.startswith(b"WARC/1."):
            raise ValueError("a record doesn't start with its version")
        warc, size = _fields(head), 0
        whole, body, http, kept = hashlib.sha256(), hashlib.sha256(), b"", []
        in_body = False
        for part in source.take(int(warc["content-length"])):
            whole.update(part)
            if not in_body:
                http += part
                if (at := http.find(b"\r\n\r\n")) < 0:
                    continue
                http, part, in_body = http[:at], http[at + 4 :], True
            size += len(part)
            body.update(part)
            if keep_payload:
                kept.append(part)
        if b"".join(source.take(4)) != b"\r\n\r\n":
            raise ValueError("a record has no end mark")
        digest = warc["warc-payload-digest"].removeprefix("sha256:")
        if warc["warc-block-digest"] != f"sha256:{whole.hexdigest()}":
            raise ValueError(f"the block digest of {warc['warc-record-id']} is wrong")
        is_revisit, length = warc["warc-type"] == "revisit", int(_fields(http)["content-length"])
        if not is_revisit and (digest != body.hexdigest() or length != size):
            raise ValueError(f"the payload of {warc['warc-record-id']} is not what was written")
        yield (
            _page(warc["warc-record-id"]),
            warc["warc-target-uri"],
            length,
            digest,
            warc["warc-type"],
            _page(warc["warc-refers-to"]) if is_revisit else None,
            b"".join(kept) if keep_payload and not is_revisit else None,
        )


def with_record_types(pages: DataFrame) -> DataFrame:
    """page_id, url, html, payload_digest, refers_to, is_revisit.

    Only (digest, page_id) is grouped, with a minimum taken before the shuffle. The payloads that occur more than once
    are written down and counted: up to ``BROADCAST_ROWS`` of them are broadcast, so that pages stay where they are;
    beyond that they are joined by shuffling, where Spark splits a frequent payload's rows at run time.
    """
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("payload_digest", F.sha2(F.encode("html", "UTF-8"), 256))
    ids = rows.filter(F.octet_length("html") >= MIN_REVISIT).groupBy("payload_digest", "page_id").agg(F.count("*").alias("same"))
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "same")
    first = written(ids.groupBy("payload_digest").agg(F.min(order).alias("first"), F.sum("same").alias("n")).filter("n > 1"), "first-pages")
    small = first.count() <= BROADCAST_ROWS
    marked = rows.join(F.broadcast(first) if small else first, "payload_digest", "left").withColumn("is_first", F.col("page_id").eqNullSafe(F.col("first.page_id")))
    names = ["page_id", "url", "html", "payload_digest", F.when(F.col("is_revisit"), F.col("first.page_id")).alias("refers_to"), "is_revisit"]
    plain = marked.withColumn("is_revisit", F.col("n").isNotNull() & ~F.col("is_first"))
    if not first.filter("first.same > 1").limit(1).count():
        return plain.select(*names)
    # Only rows that repeat the smallest page_id of a payload need a turn.
    tied = F.col("is_first") & F.coalesce(F.col("first.same") > 1, F.lit(False))
    again = marked.filter(tied).withColumn("is_revisit", F.row_number().over(Window.partitionBy("payload_digest").orderBy("url")) > 1)
    return plain.filter(~tied).unionByName(again).select(*names)


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes an archive for each partition; the paths, as a table that is already computed."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        task = TaskContext.get()
        name = f"{root}/part-{task.partitionId():06d}-{task.taskAttemptId()}.warc.gz"
        n = 0
        with store.open_output_stream(f"{name}.tmp", compression=None) as out:
            for batch in batches:
                for row in batch.to_pylist():
                    n += 1
                    out.write(record(row["page_id"], row["url"], row["html"].encode("utf-8", "surrogatepass"), row["payload_digest"], row["refers_to"], row["is_revisit"]))
        if not n:
            store.delete_file(f"{name}.tmp")
            return
        store.move(f"{name}.tmp", name)
        yield pa.RecordBatch.from_pydict({"path": [name], "records": [n]})

    return written(with_record_types(pages).mapInArrow(write, "path string, records long"), "warc-files")


def read_archives(files: DataFrame, folder: str, keep_payload: bool = True) -> DataFrame:
    """The records of the archives named in files.path, a task for each archive at most; see RECORD_SCHEMA."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with store.open_input_stream(path, compression=None) as stream:
                    yield from _batches(read_records(stream, keep_payload))

    return files.select("path").repartition(max(1, files.count())).mapInArrow(read, RECORD_SCHEMA)


def _batches(rows: Iterator[tuple], most: int = 1000, most_bytes: int = 1 << 24) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in RECORD_SCHEMA.split(", ")]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    make: Callable[[list], pa.RecordBatch] = lambda held: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names=names)
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[-1] or b"")
        if len(held) >= most or size >= most_bytes:
            yield make(held)
            held, size = [], 0
    if held:
        yield make(held)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "warc")
    files = write_archives(table(spark, sf_dir, "pages"), folder)
    return read_archives(files, folder, keep_payload=False).drop("payload", "url")


ORACLE = f"""
WITH page AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
sized AS (SELECT page_id, octet_length(encode(html)) AS n, sha256(html) AS d FROM page),
ranked AS (SELECT *, row_number() OVER (PARTITION BY d ORDER BY page_id NULLS LAST) AS i, min(page_id) OVER (PARTITION BY d) AS first FROM sized)
SELECT page_id, n::BIGINT AS payload_bytes, d AS payload_digest,
  CASE WHEN n >= {MIN_REVISIT} AND i > 1 THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= {MIN_REVISIT} AND i > 1 THEN first END AS refers_to
FROM ranked
"""
