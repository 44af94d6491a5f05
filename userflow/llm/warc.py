"""WARC archives as a chunked record table.

An archive is stored as rows (archive, record_no, chunk_no, data, ...): the
bytes of all rows of an archive, in (record_no, chunk_no) order, are a valid
WARC 1.1 file.  Chunk 0 holds the record's header, the next ones at most
``chunk_bytes`` of payload each, so an oversized payload never becomes one
allocation on the way in or out.  Every payload row carries the SHA-256 of the
payload up to its end: a reader knows at each chunk whether what it has read so
far is whole.  As a table it is written by Spark's own commit protocol to
any store, and a lost executor leaves no half-written archive.

Payloads of at least ``MIN_REVISIT`` bytes that occur again are ``revisit``
records without a payload that refer to the one with the smallest page id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from uuid import UUID

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from userflow.llm.common import arrow_batches
from userflow.session import materialize, shared_path

MIN_REVISIT = 100
CHUNK_BYTES = 64 << 10
#: Copies of the lookup row of a repeated payload: its pages are dealt over as many tasks.
SALTS = 32
#: Rows of a chunk table held in one output batch.
_OUT_ROWS = 64
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
WARC_DATE = "1970-01-01T00:00:00Z"

TABLE = "archive int, record_no long, chunk_no int, payload_offset long, running_sha256 string, data binary"
_TABLE_ARROW = pa.schema([("archive", pa.int32()), ("record_no", pa.int64()), ("chunk_no", pa.int32()),
                          ("payload_offset", pa.int64()), ("running_sha256", pa.string()), ("data", pa.binary())])
RECORDS = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
           "record_id string, n_chunks int, whole boolean")
_RECORDS_ARROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                            ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                            ("record_id", pa.string()), ("n_chunks", pa.int32()), ("whole", pa.bool_())])


def record_id(page_id: int | None, digest: str) -> str:
    """The same for every archive of the same page and payload."""
    return f"urn:uuid:{UUID(bytes=hashlib.sha256(f'{page_id}|{digest}'.encode()).digest()[:16], version=4)}"


def decide(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """(page_id, url, payload, digest, n, first_id): the pages, and for repeated
    payloads of at least MIN_REVISIT bytes the smallest page id with it.

    Only digests are grouped, pre-aggregated in each task; payloads meet the
    short list of repeated digests by (digest, salt)."""
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.encode(F.col(payload_col), "UTF-8"), F.expr("X''")).alias("payload")).withColumn(
        "digest", F.sha2("payload", 256)).withColumn("n", F.octet_length("payload").cast("long"))
    repeated = materialize(rows.where(f"n >= {MIN_REVISIT}").groupBy("digest").agg(
        F.count("*").alias("c"), F.min("page_id").alias("first_id")).where("c > 1").drop("c"))
    lookup = repeated.select(F.col("digest").alias("d"), "first_id", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("s"))
    salt = F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int")
    return rows.withColumn("salt", salt).join(
        lookup, (F.col("digest") == F.col("d")) & (F.col("salt") == F.col("s")), "left").drop("d", "s", "salt")


def _header(fields: list[tuple[str, str]]) -> bytes:
    return "".join(["WARC/1.1\r\n", *(f"{k}: {v}\r\n" for k, v in fields), "\r\n"]).encode()


def _clean(value: str | None) -> str:
    return " ".join((value or "").split())


def write_table(decided: DataFrame, path: str, chunk_bytes: int = CHUNK_BYTES) -> None:
    """Write the rows of :func:`decide` as a chunk table; one archive for each task."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, number = TaskContext.get().partitionId(), 0
        held: list[tuple] = []
        size = 0
        for batch in batches:
            cols = [batch.column(c) for c in ("page_id", "url", "payload", "digest", "n", "first_id")]
            for i in range(batch.num_rows):
                page, url, payload, digest, n, first = (c[i] for c in cols)
                page, url, digest, n, first = page.as_py(), url.as_py(), digest.as_py(), n.as_py(), first.as_py()
                revisit = first is not None and page is not None and page > first
                fields = [
                    ("WARC-Type", "revisit" if revisit else "response"),
                    ("WARC-Record-ID", f"<{record_id(page, digest)}>"),
                    ("WARC-Date", WARC_DATE),
                    ("WARC-Target-URI", _clean(url)),
                    ("WARC-Payload-Digest", f"sha256:{digest}"),
                    ("X-Page-Id", "" if page is None else str(page)),
                    ("X-Payload-Length", str(n)),
                ]
                if revisit:
                    fields += [("WARC-Profile", REVISIT_PROFILE),
                               ("WARC-Refers-To", f"<{record_id(first, digest)}>"), ("X-Refers-To-Page", str(first))]
                length = 0 if revisit else n
                fields += [("Content-Type", "text/html"), ("Content-Length", str(length))]
                held.append((archive, number, 0, 0, None, _header(fields)))
                running = hashlib.sha256()
                chunk = 0
                view = memoryview(payload.as_buffer()) if length else memoryview(b"")
                for at in range(0, length, chunk_bytes):
                    part = view[at : at + chunk_bytes]
                    running.update(part)
                    chunk += 1
                    held.append((archive, number, chunk, at, running.copy().hexdigest(), bytes(part)))
                    size += len(part)
                    if size > _OUT_ROWS * chunk_bytes:
                        yield _rows(held, _TABLE_ARROW)
                        held, size = [], 0
                held.append((archive, number, chunk + 1, length, None, b"\r\n\r\n"))
                number += 1
                if len(held) >= 1000:
                    yield _rows(held, _TABLE_ARROW)
                    held, size = [], 0
        if held:
            yield _rows(held, _TABLE_ARROW)

    decided.mapInArrow(records, TABLE).write.parquet(path)


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(col, f.type) for col, f in zip(zip(*rows), schema)], schema=schema)


class RecordReader:
    """Reads records from chunks in order, holding one header and a digest."""

    def __init__(self) -> None:
        self.open = None

    def feed(self, record: tuple, chunk_no: int, running: str | None, data: bytes) -> tuple | None:
        """The finished record before this one, if this chunk starts another."""
        done = None
        if self.open != record:
            done = self.finish()
            self.open, self.fields, self.read, self.chunks, self.next, self.whole = record, {}, 0, 0, 0, True
            self.digest = hashlib.sha256()
        self.whole &= chunk_no == self.next
        self.next = chunk_no + 1
        if chunk_no == 0:
            lines = bytes(data).decode().split("\r\n")
            self.whole &= lines[0] == "WARC/1.1"
            self.fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:] if line)
        elif self.read < int(self.fields.get("Content-Length", 0)):
            self.digest.update(data)
            self.read += len(data)
            self.chunks += 1
            self.whole &= running == self.digest.copy().hexdigest()
        else:
            self.whole &= bytes(data) == b"\r\n\r\n"
        return done

    def finish(self) -> tuple | None:
        if self.open is None:
            return None
        f = self.fields
        digest, kind = f.get("WARC-Payload-Digest", "").removeprefix("sha256:"), f.get("WARC-Type")
        whole = self.whole and self.read == int(f.get("Content-Length", -1))
        if kind == "response":  # what was read, not what the header says
            whole, digest = whole and digest == self.digest.hexdigest(), self.digest.hexdigest()
        number = lambda k: int(f[k]) if f.get(k) else None
        return (number("X-Page-Id"), f.get("WARC-Target-URI"),
                self.read if kind == "response" else number("X-Payload-Length"), digest, kind,
                number("X-Refers-To-Page"), f.get("WARC-Record-ID", "").strip("<>"), self.chunks, whole)


def read_table(table: DataFrame) -> DataFrame:
    """One row for each record of a chunk table: its header fields, digest and
    size computed from the payload chunks (of a revisit: as stated), and
    ``whole``: no chunk is missing and every running digest fits.

    Chunks are dealt out by record and streamed in order."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, out = RecordReader(), []
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("archive", "record_no", "chunk_no", "running_sha256")]
            data = batch.column("data")
            for i, (archive, number, chunk, running) in enumerate(zip(*cols)):
                done = reader.feed((archive, number), chunk, running, memoryview(data[i].as_buffer()))
                if done:
                    out.append(done)
            if len(out) >= 1000:
                yield _rows(out, _RECORDS_ARROW)
                out = []
        last = reader.finish()
        if last:
            out.append(last)
        if out:
            yield _rows(out, _RECORDS_ARROW)

    spread = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = table.repartition(spread, "archive", "record_no").sortWithinPartitions("archive", "record_no", "chunk_no")
    return ordered.mapInArrow(records, RECORDS)


def archive_pages(pages: DataFrame, path: str | None = None, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Write ``pages`` as a chunk table at ``path`` (default: new, in the shared
    folder) and return the records read back from it.

    A null payload is an empty one; of rows that repeat the smallest page id with
    one payload, all are responses; a row without an id is a response; an empty
    table gives an empty archive.  Other columns are not read.
    """
    spark = pages.sparkSession
    arrow_batches(spark, 200)
    path = path or shared_path(spark, "warc")
    write_table(decide(pages, id_col, url_col, payload_col), path, chunk_bytes)
    return read_table(spark.read.schema(TABLE).parquet(path))


def export_archive(table: DataFrame, archive: int) -> Iterator[bytes]:
    """The bytes of one archive as a WARC file, chunk by chunk."""
    for r in table.where(F.col("archive") == archive).orderBy("record_no", "chunk_no").select("data").toLocalIterator():
        yield bytes(r["data"])
