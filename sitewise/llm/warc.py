"""WARC archives: written by tasks, read back one gzip member at a time.

Each task writes the records of its rows to archive files of its own in the shared folder
and returns their names; files of lost or repeated attempts are never named and so never
read. The reader goes through a file in order: one gzip member per record, inflated in
steps, framed by Content-Length, its payload digest verified.

* Null html: empty payload. Null url: empty target. Null page_id: a record without an id of
  its own, never referred to; beside a row with an id and the same payload it is a revisit.
* Of equal payloads from ``MIN_REVISIT`` bytes on, rows that share the largest page_id are all responses.
* Line breaks and controls in a url are percent-encoded. Empty table: no archives, no rows.
* Columns other than page_id, url and html are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewise.llm.common import parts, table, whole
from sitewise.session import settle, workdir

MIN_REVISIT = 1_000
ARCHIVE_BYTES = 256 << 20
STEP = 1 << 16
DATE = "2024-01-01T00:00:00Z"
RECORD = ("page_id", "url", "record_type", "refers_to", "payload", "payload_bytes", "payload_digest")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _record_id(page_id: int | None) -> str:
    """Page ids live in the low half of a fixed name space; rows without one get a random id."""
    return f"<{(uuid.UUID(int=(0x7761 << 112) + (page_id & (2**64 - 1))) if page_id is not None else uuid.uuid4()).urn}>"


def _page_id(record_id: str) -> int | None:
    number = uuid.UUID(record_id.strip("<>")).int
    low = number & (2**64 - 1)
    return (low - (low >> 63 << 64)) if number >> 64 == 0x7761 << 48 else None


def _base32(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def _target(url: str | None) -> str:
    return "".join(c if " " < c < "\x7f" else "".join(f"%{b:02X}" for b in c.encode("utf-8", "surrogatepass")) for c in url or "")


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record as one gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_record_id(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_target(url)}",
        f"WARC-Payload-Digest: {_base32(hashlib.sha1(payload).digest())}",
        f"WARC-Block-Digest: {_base32(hashlib.sha1(block).digest())}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(refers_to)}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


class Member:
    """The bytes of one gzip member, inflated as they are asked for."""

    def __init__(self, file: BinaryIO, start: bytes):
        self.file, self.raw, self.inflater, self.ready = file, start, zlib.decompressobj(31), b""

    def more(self) -> bool:
        if self.inflater.eof:
            return False
        data = self.raw or self.file.read(STEP)
        if not data:
            raise ValueError("the archive ends inside a record")
        self.ready += self.inflater.decompress(data, STEP)
        self.raw = self.inflater.unconsumed_tail
        return True

    def head(self) -> list[str]:
        while b"\r\n\r\n" not in self.ready:
            if not self.more():
                raise ValueError("a record without the end of its header")
        text, _, self.ready = self.ready.partition(b"\r\n\r\n")
        return text.decode("utf-8").split("\r\n")

    def take(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.ready and not self.more():
                raise ValueError("a record shorter than its Content-Length")
            piece, self.ready = self.ready[:n], self.ready[n:]
            n -= len(piece)
            if piece:
                yield piece

    def finish(self) -> bytes:
        """What follows the member in the bytes read so far."""
        while self.more():
            pass
        if self.ready != b"\r\n\r\n":
            raise ValueError("a record longer than its Content-Length")
        return self.inflater.unused_data


def _fields(lines: list[str]) -> dict[str, str]:
    return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}


def read_records(file: BinaryIO) -> Iterator[dict]:
    """The records in order: page_id, url, record_type, refers_to, payload (None for a revisit), payload_bytes, payload_digest."""
    rest = file.read(STEP)
    while rest:
        member = Member(file, rest)
        warc = _fields(member.head())
        length = int(warc["content-length"])
        block, digest = hashlib.sha1(), hashlib.sha1()
        pieces, http = [], None
        waiting = b""
        for piece in member.take(length):
            block.update(piece)
            if http is None:
                waiting += piece
                if b"\r\n\r\n" not in waiting:
                    continue
                text, _, piece = waiting.partition(b"\r\n\r\n")
                http = _fields(text.decode("latin-1").split("\r\n"))
            digest.update(piece)
            pieces.append(piece)
        revisit = warc["warc-type"] == "revisit"
        if http is None:
            raise ValueError("a record without an HTTP header")
        if _base32(block.digest()) != warc["warc-block-digest"]:
            raise ValueError(f"block digest of {warc['warc-record-id']} does not match")
        if not revisit and _base32(digest.digest()) != warc["warc-payload-digest"]:
            raise ValueError(f"payload digest of {warc['warc-record-id']} does not match")
        yield {
            "page_id": _page_id(warc["warc-record-id"]),
            "url": warc["warc-target-uri"],
            "record_type": warc["warc-type"],
            "refers_to": _page_id(warc["warc-refers-to"]) if revisit else None,
            "payload": None if revisit else b"".join(pieces),
            "payload_bytes": int(http["content-length"]),
            "payload_digest": base64.b32decode(warc["warc-payload-digest"].removeprefix("sha1:")).hex(),
        }
        rest = member.finish() or file.read(STEP)


def with_revisits(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, refers_to (null for responses)."""
    rows = pages.select(F.col("page_id").cast("long"), "url", F.encode(whole(F.col("html")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    copies = (
        rows.where(F.octet_length("payload") >= MIN_REVISIT)
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("first"))
        .where((F.col("n") > 1) & F.col("first").isNotNull())
        .select("digest", "first")
    )
    later = F.when(F.col("first").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") < F.col("first"))), F.col("first"))
    return rows.join(copies, "digest", "left").select("page_id", "url", "payload", later.alias("refers_to"))


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Write page_id, url, payload, refers_to rows; the names and record counts of the archives, stored."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        task, file, made = TaskContext.get(), None, []
        for batch in batches:
            for row in batch.to_pylist():
                if file is None:
                    name = f"{task.partitionId():06d}-{len(made):04d}-{task.taskAttemptId()}.warc.gz"
                    file = store.open_output_stream(f"{root}/{name}")
                    made.append([f"{folder}/{name}", 0])
                file.write(record(row["page_id"], row["url"], row["payload"], row["refers_to"]))
                made[-1][1] += 1
                if file.tell() >= ARCHIVE_BYTES:
                    file.close()
                    file = None
        if file is not None:
            file.close()
        yield pa.RecordBatch.from_arrays([pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.int64())], ["archive", "records"])

    return settle(records.select("page_id", "url", "payload", "refers_to").mapInArrow(write, "archive string, records long"))


def read_archives(archives: DataFrame) -> DataFrame:
    """The records of the named archives; an archive with other than its number of records fails."""

    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.string()]
    schema = pa.schema(list(zip(RECORD, kinds, strict=True)))  # ids stay whole numbers, missing ones among them too

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, expected in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                store, path = fs.FileSystem.from_uri(archive)
                seen, size, rows = 0, 0, []
                with store.open_input_stream(path) as file:
                    for found in read_records(file):
                        seen, size = seen + 1, size + found["payload_bytes"]
                        rows.append(found)
                        if size > 8 << 20 or len(rows) >= 1000:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            size, rows = 0, []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                if seen != expected:
                    raise ValueError(f"{archive} holds {seen} records, not {expected}")

    n = parts(archives, archives.count(), 1)
    types = ["long", "string", "string", "long", "binary", "long", "string"]
    return archives.select("archive", "records").repartition(n).mapInArrow(read, ", ".join(map(" ".join, zip(RECORD, types, strict=True))))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = write_archives(with_revisits(table(spark, sf_dir, "pages")), workdir(spark, "warc"))
    return read_archives(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP3_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), g AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS first FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first IS NOT NULL AND coalesce(page_id < first, true) THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first IS NOT NULL AND coalesce(page_id < first, true) THEN first END AS refers_to
FROM g
"""
