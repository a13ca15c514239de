"""Token ids of a corpus in binary files with Elias-Fano document boundaries.

A file holds the ids of a run of documents one after another and, behind them, two Elias-Fano sequences: where each
document begins (with the end of the last one) and the document ids. A sequence of n values up to u takes about
n * (2 + log2(u / n)) bits; select finds a value from its upper bits with a sample for every 64 values.

File: MAGIC, ids (2 or 4 bytes each, little-endian), boundaries, document ids, footer (struct FOOTER). A sequence is
its header (struct SEQUENCE), lower bits, upper bits and samples, each padded to 8 bytes.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexweave.llm.common import BYTE_LEVEL, WordTokens, materialize, new_folder, small_batches
from lexweave.llm.files import Landing, at

MAGIC = b"LWTOKEN1"
#: Bytes per id, documents without an id (they come first), least document id, places of the two sequences, their end.
FOOTER = struct.Struct("<QQqQQQ8s")
#: Values, lower bits per value, bytes of lower bits, of upper bits and of samples.
SEQUENCE = struct.Struct("<QQQQQ")
SAMPLE = 64
#: Bytes of text from which a file is cut.
FILE_TEXT = 48 << 20


class EliasFano:
    """A sequence of non-negative integers that never falls."""

    def __init__(self, n: int, width: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.width, self.low, self.high, self.samples = n, width, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> "EliasFano":
        values = np.asarray(values, np.int64)
        n = len(values)
        top = int(values[-1]) if n else 0
        width = max(0, (top // n).bit_length() - 1) if n else 0
        lower = (values[:, None] >> np.arange(width)) & 1 if width else np.zeros((n, 0), np.int64)
        places = (values >> width) + np.arange(n)
        bits = np.zeros((top >> width) + n + 1 if n else 0, np.uint8)
        bits[places] = 1
        words = lambda b: np.frombuffer(pad(np.packbits(b, bitorder="little").tobytes()), "<u8")
        return cls(n, width, words(lower.astype(np.uint8).ravel()), words(bits), places[::SAMPLE].astype("<u8"))

    def select(self, i: int) -> int:
        """Value i: the place of the i-th one among the upper bits, from the nearest sample, and its lower bits."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        place, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        word = int(self.high[place // 64]) >> (place % 64) << (place % 64)
        at = place // 64
        while left >= (ones := word.bit_count()):
            left, at = left - ones, at + 1
            word = int(self.high[at])
        for _ in range(left):
            word &= word - 1
        high = at * 64 + (word & -word).bit_length() - 1 - i
        bit = i * self.width
        low = int(self.low[bit // 64]) >> (bit % 64) if self.width else 0
        if self.width and bit % 64 + self.width > 64:
            low |= int(self.low[bit // 64 + 1]) << (64 - bit % 64)
        return high << self.width | low & ((1 << self.width) - 1)

    def values(self) -> np.ndarray:
        """All values at once."""
        upper = np.flatnonzero(np.unpackbits(self.high.view(np.uint8), bitorder="little"))[: self.n] - np.arange(self.n)
        bits = np.unpackbits(self.low.view(np.uint8), bitorder="little")[: self.n * self.width].reshape(self.n, self.width)
        return (upper.astype(np.int64) << self.width) + bits.astype(np.int64) @ (1 << np.arange(self.width, dtype=np.int64))

    def to_bytes(self) -> bytes:
        parts = [self.low.tobytes(), self.high.tobytes(), self.samples.tobytes()]
        return SEQUENCE.pack(self.n, self.width, *map(len, parts)) + b"".join(parts)

    @classmethod
    def from_bytes(cls, data: bytes) -> "EliasFano":
        n, width, *sizes = SEQUENCE.unpack_from(data)
        parts, place = [], SEQUENCE.size
        for size in sizes:
            parts.append(np.frombuffer(data, "<u8", size // 8, place))
            place += size
        return cls(n, width, *parts)


def pad(data: bytes) -> bytes:
    return data + b"\0" * (-len(data) % 8)


class TokenFile:
    """A file opened for reading: doc_ids, and ids(i, j) of documents i to j - 1 with one read."""

    def __init__(self, uri: str):
        system, path = at(uri)
        self.file = system.open_input_file(path)
        size = self.file.size()
        self.width, self.nulls, self.least, first, second, end, magic = FOOTER.unpack(self.file.read_at(FOOTER.size, size - FOOTER.size))
        if magic != MAGIC or end + FOOTER.size != size or self.file.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError(f"{uri} is no complete token file")
        self.bounds = EliasFano.from_bytes(self.file.read_at(second - first, first))
        self.names = EliasFano.from_bytes(self.file.read_at(end - second, second))

    def __len__(self) -> int:
        return self.bounds.n - 1

    def doc_id(self, i: int) -> int | None:
        return None if i < self.nulls else self.names.select(i - self.nulls) + self.least

    def ids(self, i: int, j: int | None = None) -> np.ndarray:
        begin, end = self.bounds.select(i), self.bounds.select(i + 1 if j is None else j)
        data = self.file.read_at((end - begin) * self.width, len(MAGIC) + begin * self.width)
        return np.frombuffer(data, f"<u{self.width}")


def write_file(uri: str, documents: Iterator[tuple[int | None, bytes]], width: int) -> tuple[int, int]:
    """Write (doc_id, ids as little-endian unsigned 32-bit bytes) in ascending doc_id order, nulls first; documents and ids written."""
    names, lengths, nulls = [], [], 0
    with Landing(uri) as out:
        out.write(MAGIC)
        for name, ids in documents:
            if name is None:
                nulls += 1
            else:
                names.append(name)
            lengths.append(len(ids) // 4)
            out.write(ids if width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes())
        total = sum(lengths)
        first = len(MAGIC) + total * width
        least = names[0] if names else 0
        bounds = EliasFano.of(np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])).to_bytes()
        held = EliasFano.of(np.array(names, np.int64) - least).to_bytes()
        out.write(bounds + held)
        out.write(FOOTER.pack(width, nulls, least, first, first + len(bounds), first + len(bounds) + len(held), MAGIC))
    return len(lengths), total


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int, file_text: int = FILE_TEXT) -> DataFrame:
    """Files of all documents in ascending doc_id order (nulls first, ties by text hash); one row per file: part, uri, n_docs, n_ids.

    A null text is empty, so its document has its end id only. Texts are dealt by ranges of doc_id and tokenised where
    they are written; a doc_id that many rows repeat is divided by the hash of its text.
    """
    spark = docs.sparkSession
    small_batches(spark)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(-(-int(size) // file_text), spark.sparkContext.defaultParallelism)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    rows = rows.repartitionByRange(files, "doc_id", "text_hash").sortWithinPartitions("doc_id", "text_hash")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, memory = TaskContext.get().partitionId(), WordTokens.of(tokenizer)
        width, end = 2 if max(end_id + 1, memory.tokenizer.get_vocab_size()) <= 1 << 16 else 4, int(end_id).to_bytes(4, "little")

        def documents() -> Iterator[tuple[int | None, bytes]]:
            for batch in batches:
                made = memory.encode([text or "" for text in batch.column(1).to_pylist()], BYTE_LEVEL)
                yield from zip(batch.column(0).to_pylist(), (ids + end for ids in made))

        uri = f"{folder}/part-{part:07d}.tokens"
        n_docs, n_ids = write_file(uri, documents(), width)
        yield pa.RecordBatch.from_pylist([{"part": part, "uri": uri, "n_docs": n_docs, "n_ids": n_ids}], pa.schema([("part", pa.int64()), ("uri", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

    written = rows.select("doc_id", "text").mapInArrow(write, "part long, uri string, n_docs long, n_ids long")
    return materialize(written, "token-files")


def read_tokens(files: DataFrame, with_ids: bool = False) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and, if asked for, ids.

    Starts of files are sums over the table of files, which has one small row per file.
    """
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    placed = materialize(files.select("uri", "n_docs", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base")), "token-starts")
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for uri, base in zip(frame["uri"], frame["base"]):
                source = TokenFile(uri)
                bounds = source.bounds.values()
                names = [None] * source.nulls + (source.names.values() + source.least).tolist()
                i = 0
                while i < len(source):
                    j = max(i + 1, min(i + 2000, int(np.searchsorted(bounds, bounds[i] + (4 << 20), "right")) - 1))
                    ids = source.ids(i, j).astype("<u4")
                    cut = [ids[a:b] for a, b in zip(bounds[i:j] - bounds[i], bounds[i + 1 : j + 1] - bounds[i])]
                    made = pd.DataFrame({"doc_id": pd.array(names[i:j], "Int64"), "start": bounds[i:j] + base, "n_tokens": bounds[i + 1 : j + 1] - bounds[i:j], "ids_crc32": [zlib.crc32(c.tobytes()) for c in cut]})
                    yield made.assign(ids=[c.tolist() for c in cut]) if with_ids else made
                    i = j

    tasks = max(1, min(files.count(), 100_000))
    return placed.where("n_docs > 0").repartition(tasks, "uri").mapInPandas(read, schema)


def token_table(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write the ids of all documents below the shared folder and read them back."""
    return read_tokens(write_tokens(docs, new_folder(docs.sparkSession, "tokens"), tokenizer, end_id))
