"""WARC archives: a writer with revisit records and a sequential reader.

Every record is a gzip member of its own. The reader goes through a file front to back in blocks of bounded size: it
inflates member after member, frames a record by its Content-Length, and verifies block and payload digests.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexweave.llm.common import materialize, new_folder, small_batches
from lexweave.llm.files import Landing, at

#: Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BLOCK = 1 << 18
#: Records of one archive; the next ones go to another file.
ARCHIVE_ROWS = 20_000


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page: int | None, url: str | None, payload: bytes, first: int | None, revisit: bool, date: str) -> bytes:
    """One record as a gzip member. A revisit keeps the HTTP header, whose Content-Length is that of the full payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    name = lambda number: f"<urn:page:{'' if number is None else number}>"
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", name(page)),
        ("WARC-Date", date),
        ("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")),
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if revisit:
        fields[5:5] = [("WARC-Profile", PROFILE), ("WARC-Refers-To", name(first))]
    lines = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(lines.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n") + packer.flush()


class Inflater:
    """Bytes of consecutive gzip members, inflated as far as asked for."""

    def __init__(self, stream):
        self.stream, self.raw, self.held, self.member, self.ended = stream, b"", bytearray(), None, False

    def more(self) -> bool:
        """Inflate another block into held; False at the end of the file."""
        while True:
            if not self.raw:
                self.raw = self.stream.read(BLOCK)
                if not self.raw:
                    if self.member is not None:
                        raise ValueError("the last member is cut off")
                    return False
            if self.member is None:
                self.member = zlib.decompressobj(31)
            self.held += self.member.decompress(self.raw, BLOCK)
            self.raw = self.member.unconsumed_tail
            if self.member.eof:
                self.raw = self.member.unused_data
                self.member = None
                self.ended = True
            return True

    def until(self, mark: bytes) -> bytes | None:
        """Bytes up to and with mark; None if nothing is left."""
        seen = 0
        while (found := self.held.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.held)
            if not self.more():
                if self.held:
                    raise ValueError("a header without an end")
                return None
        out = bytes(self.held[: found + len(mark)])
        del self.held[: found + len(mark)]
        return out

    def take(self, n: int) -> bytes:
        while len(self.held) < n:
            if not self.more():
                raise ValueError("a block is shorter than its Content-Length")
        out = bytes(self.held[:n])
        del self.held[:n]
        return out


def fields_of(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    return {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines[1:] if ":" in line)}


def read_archive(stream) -> Iterator[tuple[dict[str, str], bytes, int]]:
    """(fields, payload, length of the full payload) of each record. Broken framing or digests are errors."""
    source = Inflater(stream)
    while (head := source.until(b"\r\n\r\n")) is not None:
        if not head.startswith(b"WARC/1."):
            raise ValueError("no WARC record where one should begin")
        fields = fields_of(head)
        block = source.take(int(fields["content-length"]))
        if source.take(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where its Content-Length says")
        if "sha1:" + digest(block) != fields.get("warc-block-digest", "sha1:" + digest(block)):
            raise ValueError(f"block digest of {fields.get('warc-record-id')} differs")
        http, _, payload = block.partition(b"\r\n\r\n")
        length = int(fields_of(http).get("content-length", len(payload)))
        if fields["warc-type"] == "response" and (length != len(payload) or "sha1:" + digest(payload) != fields["warc-payload-digest"]):
            raise ValueError(f"payload of {fields.get('warc-record-id')} differs from its length or digest")
        yield fields, payload, length


def first_pages(pages: DataFrame, payload: Column, least_bytes: int) -> DataFrame:
    """Smallest page_id of every payload that at least two rows have; made of digests only, combined before the shuffle."""
    marks = pages.select(F.col("page_id").cast("long").alias("page_id"), F.sha1(payload).alias("sha"), F.length(payload).alias("n"))
    firsts = marks.where(F.col("n") >= least_bytes).groupBy("sha").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
    return firsts.where("copies > 1").select("sha", "first_id")


def write_archives(pages: DataFrame, folder: str, url: Column | None = None, least_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Archives of page_id, url and html (null: empty) in folder; returns their URIs, one row per file (columns uri, records).

    Of equal payloads of at least least_bytes the row with the smallest page_id is the response and others revisit it;
    rows that repeat this id are responses too, as are rows without an id among themselves. Pages are dealt evenly by
    the join on their payload's digest, whose large groups adaptive execution splits: only the table of firsts repeats.
    """
    small_batches(pages.sparkSession)
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    firsts = materialize(first_pages(pages, payload, least_bytes), "first-pages")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(url if url is not None else F.col("url"), F.lit("")).alias("url"), payload.alias("payload"), F.sha1(payload).alias("sha"))
    rows = rows.join(firsts, "sha", "left").select("page_id", "url", "payload", "first_id")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number, held, made = TaskContext.get().partitionId(), 0, [], []

        def flush() -> None:
            nonlocal number, held
            uri = f"{folder}/part-{part:06d}-{number:04d}.warc.gz"
            with Landing(uri) as out:
                for row in held:
                    out.write(row)
            made.append((uri, len(held)))
            number, held = number + 1, []

        size = 0
        for batch in batches:
            for page, link, body, first in zip(*(batch.column(i).to_pylist() for i in range(4))):
                revisit = first is not None and page != first
                held.append(record(page, link, body, first, revisit, date))
                size += len(held[-1])
                if len(held) >= ARCHIVE_ROWS or size >= 64 << 20:
                    flush()
                    size = 0
        if held:
            flush()
        yield pa.RecordBatch.from_arrays([pa.array([u for u, _ in made], pa.string()), pa.array([n for _, n in made], pa.int64())], ["uri", "records"])

    return materialize(rows.mapInArrow(write, "uri string, records long"), "archives")


def read_archives(archives: DataFrame) -> DataFrame:
    """Rows of all records of the archives (column uri): page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload.

    payload_bytes and payload_digest are those of the full payload; the payload of a revisit is null.
    """
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
    number = lambda name: int(name[10:-1]) if name and name[10:-1] else None

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [part.split()[0] for part in schema.split(", ")]

        def frame(rows: list[tuple]) -> pd.DataFrame:
            made = pd.DataFrame(rows, columns=columns)
            return made.astype({"page_id": "Int64", "payload_bytes": "Int64", "refers_to": "Int64"})

        for uris in frames:
            for uri in uris["uri"]:
                system, path = at(uri)
                rows, size = [], 0
                with system.open_input_stream(path, compression=None) as stream:
                    for fields, payload, length in read_archive(stream):
                        revisit = fields["warc-type"] == "revisit"
                        rows.append((number(fields["warc-record-id"]), fields["warc-target-uri"], length, fields["warc-payload-digest"].removeprefix("sha1:"), fields["warc-type"], number(fields.get("warc-refers-to", "")), None if revisit else payload))
                        size += len(payload)
                        if len(rows) >= 1000 or size > 16 << 20:
                            yield frame(rows)
                            rows, size = [], 0
                if rows:
                    yield frame(rows)

    tasks = max(1, min(archives.count(), 100_000))
    return archives.select("uri").repartition(tasks, "uri").mapInPandas(read, schema)


def archive_pages(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write pages as archives below the shared folder and read them back."""
    return read_archives(write_archives(pages, new_folder(pages.sparkSession, "warc"), least_bytes=least_bytes))
