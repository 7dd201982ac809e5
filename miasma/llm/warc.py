"""WARC archives: written by tasks, indexed first, read back by byte ranges.

Writing: each task appends records to archive files of its own, one gzip member per record, and
returns an index row per record: file, offset, length, URL, payload digest. The index is written
as a table. File names are new for every attempt, so if a task is run again, the index names only
the files of the attempt that counted.

Records with equal payloads of at least ``MIN_SHARED_BYTES`` bytes are stored once: the one with
the smallest id is a response, the others are revisits that name it. Digests are compared, not
payloads, and shrink in a map-side aggregate, so a payload shared by a third of all rows is a few
rows; the join that follows can be split by adaptive execution, for it feeds no other grouping.

Reading: index rows of the records wanted are gathered per stretch of ``CHUNK`` bytes of a file,
without payloads. Inside a stretch, records are sorted by offset and those less than ``MAX_GAP``
apart are fetched by one ranged read. So a selection costs the bytes around it, not whole archives,
and a task holds at most one stretch. Digests are checked against what was read.

Archives lie below the folder that all executors share and are reached through ``pyarrow.fs``.

Defined cases: a null payload is empty, a null URL leaves its header out, control characters in a
URL are percent-encoded; of rows that repeat the smallest id of a payload each is a response; a
row without an id is a response if no row with an id has its payload, else a revisit; an empty
table gives an empty index and no archive; input columns beside the three named are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from miasma.llm.common import slices, stored
from miasma.session import shared_dir

MIN_SHARED_BYTES = 100
ARCHIVE_BYTES = 256 << 20
CHUNK = 8 << 20
READ_BYTES = 64 << 20
MAX_GAP = 64 << 10
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_INDEX = ["file", "offset", "length", "page_id", "url", "payload_digest", "record_type"]


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme of the cluster's default file system if it has none."""
    if "://" in path or path.startswith("file:"):
        return path
    default = spark._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///"
    return f"{default.rstrip('/')}{path}" if not default.startswith("file:") else f"file://{path}"


def _open(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_id(urn: str) -> int | None:
    text = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(text) if text else None


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
           revisit: bool, date: str) -> bytes:
    """One WARC record; a revisit holds the HTTP header alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_urn(page_id)}",
             f"WARC-Date: {date}", f"WARC-Payload-Digest: sha256:{digest}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if url is not None:
        safe = "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)
        lines.insert(3, f"WARC-Target-URI: {safe}")
    if revisit:
        lines += [f"WARC-Refers-To: {_urn(refers_to)}", f"WARC-Profile: {_PROFILE}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC header, HTTP header and payload of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    warc = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(warc["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return warc, dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:]), payload


def roles(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """(page_id, url, payload, digest, revisit, refers_to) of every row."""
    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    shared = (rows.filter(F.octet_length("payload") >= MIN_SHARED_BYTES).groupBy("digest")
              .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1 AND first IS NOT NULL"))
    # Only payloads with copies, stored, so Spark knows the size of the list when it joins.
    shared = stored(shared.select(F.col("digest").alias("_digest"), "first"), "warc-shared")
    joined = rows.join(shared, rows.digest == shared._digest, "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select("page_id", "url", "payload", "digest", revisit.alias("revisit"),
                         F.when(revisit, F.col("first")).alias("refers_to"))


def write(pages: DataFrame, folder: str, level: int = 6, date: str | None = None,
          archive_bytes: int = ARCHIVE_BYTES, **columns) -> DataFrame:
    """Write archives below ``folder`` and return their index, a stored table."""
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _open(folder)
        out, name, at = None, "", 0
        for batch in slices(batches, "payload"):
            rows = []
            for r in batch.to_pylist():
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    system.create_dir(root, recursive=True)
                    out, at = system.open_output_stream(f"{root}/{name}", compression=None), 0
                packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                data = packer.compress(record(r["page_id"], r["url"], r["payload"], r["digest"], r["refers_to"],
                                              r["revisit"], date)) + packer.flush()
                out.write(data)
                rows.append((f"{folder}/{name}", at, len(data), r["page_id"], r["url"], r["digest"],
                             "revisit" if r["revisit"] else "response"))
                at += len(data)
                if at >= archive_bytes:
                    out.close()
                    out = None
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=_INDEX)
        if out is not None:
            out.close()

    index = roles(pages, **columns).mapInArrow(
        run, "file string, offset bigint, length bigint, page_id bigint, url string, payload_digest string, record_type string")
    return stored(index, "warc-index")


def runs(ranges: list[tuple[int, int]], max_gap: int = MAX_GAP) -> list[tuple[int, int, list[tuple[int, int]]]]:
    """Sorted (offset, length) ranges joined where the gap is small: (start, end, ranges)."""
    out: list[tuple[int, int, list[tuple[int, int]]]] = []
    for offset, length in sorted(set(ranges)):
        if out and offset - out[-1][1] <= max_gap:
            start, end, inside = out.pop()
            out.append((start, max(end, offset + length), [*inside, (offset, length)]))
        else:
            out.append((offset, offset + length, [(offset, length)]))
    return out


def read(index: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of the index rows given: (page_id, url, record_type, refers_to, payload_bytes,
    payload_digest, payload). A revisit has no payload; ``payloads=False`` leaves the column out
    after the digests were checked.

    The number of reading tasks follows the archive bytes behind the index rows, not the rows' own
    size, by which adaptive execution would put all of them into one task.
    """
    behind = index.agg(F.sum("length")).first()[0] or 0
    tasks = max(-(-behind // READ_BYTES), index.sparkSession.sparkContext.defaultParallelism)
    chunks = (index.withColumn("chunk", F.floor(F.col("offset") / CHUNK)).repartition(tasks, "file", "chunk")
              .groupBy("file", "chunk").agg(F.collect_list(F.struct("offset", "length")).alias("ranges")))
    names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    ddl = "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, payload binary"
    if not payloads:
        names, kinds, ddl = names[:-1], kinds[:-1], ddl.rpartition(",")[0]

    def rows_of(data: bytes) -> tuple:
        warc, http, payload = parse(zlib.decompress(data, 31))
        digest, revisit = warc["WARC-Payload-Digest"].removeprefix("sha256:"), warc["WARC-Type"] == "revisit"
        if not revisit and hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"digest of {warc['WARC-Record-ID']} does not match its payload")
        return (_page_id(warc["WARC-Record-ID"]), warc.get("WARC-Target-URI"), warc["WARC-Type"],
                _page_id(warc["WARC-Refers-To"]) if revisit else None, int(http["Content-Length"]), digest,
                None if revisit else payload)[:len(names)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in batch.to_pylist():
                system, path = _open(chunk["file"])
                with system.open_input_file(path) as source:
                    for start, end, inside in runs([(r["offset"], r["length"]) for r in chunk["ranges"]]):
                        data = source.read_at(end - start, start)
                        rows = [rows_of(data[o - start:o - start + n]) for o, n in inside]
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return chunks.mapInArrow(run, ddl)


def round_trip(pages: DataFrame, **columns) -> DataFrame:
    """Write all rows to new archives and read every record back, without payloads."""
    spark = pages.sparkSession
    folder = qualified(spark, shared_dir(spark, "warc"))
    return read(write(pages, folder, **columns), payloads=False)
