"""SimHash near-duplicates with a Gray-order hierarchical index.

Fingerprints are 64-bit SimHashes of word shingles. Equal fingerprints are one row. Two fingerprints that differ in at
most `distance` bits agree on one of distance + 1 blocks of bits, so each is sent once per block to the bucket of its
block value; buckets that are still large are divided again in the same way on the bits left, which loses no pair. In
a bucket, fingerprints are sorted by their rank in the Gray code. Neighbours then share many bits: runs of eight form
nodes that hold the bits all their members share (a mask and a value), eight nodes form one above, and a node keeps
only what its parent has not. A query walks down from the root of its bucket, adds up differing bits, and leaves out a
whole node once the sum exceeds the distance. Tasks return one link per linked row (a spanning forest), never pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexweave.llm.common import contracted, least_reachable, materialize, small_batches, spare

SEED = 42
#: Rows of a bucket from which it is divided again on the bits that are left.
LARGE_BUCKET = 4096
FAN = 8
#: Pairs of a query and a node held at once.
FRONTIER = 1 << 20


def simhashes(text: str | None, size: int = 3, seed: int = SEED, tables: int = 1) -> list[int]:
    """Fingerprints of a whole text as unsigned numbers; 0 without words, the hash of the whole sequence below `size` words.

    The first is made of the shingles' hashes, each other one of the same hashes mixed in its own way. bytes.lower()
    changes A-Z only and bytes.split() splits at space and \\x09-\\x0D, as the word rule says.
    """
    import xxhash

    made = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not made:
        return [0] * tables
    digest = xxhash.xxh64_intdigest
    if len(made) <= size:
        hashes = np.array([digest(b" ".join(made), seed)], np.uint64)
    else:
        hashes = np.array([digest(b" ".join(part), seed) for part in zip(*(made[i:] for i in range(size)))], np.uint64)
    return [majority(hashes if t == 0 else mixed(hashes, t)) for t in range(tables)]


def mixed(hashes: np.ndarray, table: int) -> np.ndarray:
    """Hashes turned into others, one to one: products with odd numbers and shifts."""
    made = hashes * np.uint64(2 * (table * 0x9E3779B97F4A7C15 % (1 << 63)) + 1)
    made ^= made >> np.uint64(29)
    made *= np.uint64(0xBF58476D1CE4E5B9)
    return made ^ made >> np.uint64(32)


def majority(hashes: np.ndarray) -> int:
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        part = hashes[at : at + (1 << 15)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.uint16)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, size: int = 3, seed: int = SEED, tables: int = 1) -> DataFrame:
    """doc_id, fp (the fingerprint's 64 bits as a signed long), text_hash and more (fingerprints of other tables) of every row.

    A null text has no words.
    """
    small_batches(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [simhashes(text, size, seed, tables) for text in batch.column(2).to_pylist()]
            made = np.array(made, np.uint64).reshape(-1, tables).view(np.int64)
            columns = [batch.column(0), pa.array(made[:, 0].copy()), batch.column(1), pa.array(list(made[:, 1:]), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "fp", "text_hash", "more"])

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(work, "doc_id long, fp long, text_hash long, more array<long>")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code word in the reflected Gray code."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Nodes over fingerprints sorted by bucket and Gray rank, from the rows (level 0) up to one root per bucket."""

    def __init__(self, buckets: np.ndarray, codes: np.ndarray):
        self.codes = codes
        group = np.concatenate([[0], np.cumsum(np.diff(buckets) != 0)])[: len(codes)]
        self.levels = []  # of the lowest first: first child, end of children, mask not held by the parent, value
        low, high, of = self.codes, self.codes, group
        shared = []
        while len(low) and (not self.levels or len(low) > of[-1] + 1):
            starts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
            within = np.arange(len(of)) - np.repeat(starts, np.diff(np.append(starts, len(of))))
            first = np.flatnonzero(within % FAN == 0)
            low, high, of = np.bitwise_and.reduceat(low, first), np.bitwise_or.reduceat(high, first), of[first]
            self.levels.append([first, np.append(first[1:], len(within)), None, low])
            shared.append(~(low ^ high))
        for k, level in enumerate(self.levels):
            level[2] = shared[k].copy()
            if k + 1 < len(self.levels):
                level[2] &= ~np.repeat(shared[k + 1], np.diff(np.append(self.levels[k + 1][0], len(shared[k]))))
        self.left = ~np.repeat(shared[0], self.levels[0][1] - self.levels[0][0]) if self.levels else None
        self.group = group

    def pairs(self, queries: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows (query, other) with other behind the query in the index, at most `distance` bits apart."""
        roots = self.group[queries]
        stack = [(len(self.levels) - 1, queries, roots, np.zeros(len(queries), np.uint8))]
        while stack:
            at, query, node, bits = stack.pop()
            first, end, mask, value = self.levels[at]
            bits = bits + np.bitwise_count((self.codes[query] ^ value[node]) & mask[node])
            keep = bits <= distance
            query, node, bits = query[keep], node[keep], bits[keep]
            for s in range(0, len(query), FRONTIER // FAN):
                q, n, b = query[s : s + FRONTIER // FAN], node[s : s + FRONTIER // FAN], bits[s : s + FRONTIER // FAN]
                many = end[n] - first[n]
                child = np.repeat(first[n] - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
                q, b = np.repeat(q, many), np.repeat(b, many)
                if at:
                    stack.append((at - 1, q, child, b))
                    continue
                apart = b + np.bitwise_count((self.codes[q] ^ self.codes[child]) & self.left[child])
                near = (apart <= distance) & (child > q)
                yield q[near], child[near]


def forest(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest row that each of n rows reaches by the pairs."""
    label = np.arange(n)
    for a, b in pairs:
        while len(a):
            least = np.minimum(label[a], label[b])
            top_a, top_b = label[a], label[b]
            np.minimum.at(label, top_a, least)
            np.minimum.at(label, top_b, least)
            while True:
                after = label[label]
                if (after == label).all():
                    break
                label = after
            open_pairs = label[a] != label[b]
            a, b = a[open_pairs], b[open_pairs]
    return label


def bucket_links(frames: Iterator[pd.DataFrame], distance: int) -> Iterator[pd.DataFrame]:
    """Links (a, b) among the nodes whose fingerprints meet in the buckets of one partition, one per linked node."""
    parts = list(frames)
    if not parts:
        return
    rows = pd.concat(parts)
    bucket, fp, node = (rows[name].to_numpy(np.int64) for name in ("bucket", "fp", "node"))
    del rows, parts
    order = np.lexsort((gray_rank(fp.view(np.uint64)), bucket))
    bucket, fp, node = bucket[order], fp[order], node[order]
    # equal fingerprints of a bucket are one row of the index
    new = np.concatenate([[True], (np.diff(bucket) != 0) | (np.diff(fp) != 0)])
    index = GrayIndex(bucket[new], fp[new].view(np.uint64))
    n = len(index.codes)
    step = max(1, FRONTIER // 64)
    found = (pair for s in range(0, n, step) for pair in index.pairs(np.arange(s, min(n, s + step)), distance))
    group = forest(n, found)[np.cumsum(new) - 1]
    order = np.lexsort((node, group))
    first = np.concatenate([[True], np.diff(group[order]) != 0])
    top = node[order][np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
    made = pd.DataFrame({"a": node[order], "b": top})
    yield made[made["a"] != made["b"]].drop_duplicates()


def blocks(rest: Column, bits: int, parts: int) -> Column:
    """One entry per block of a number of `bits` bits: the block, its value, and the other bits moved together."""
    width = bits // parts
    keep = (1 << bits) - 1 if bits < 64 else -1
    made = []
    for k in range(parts):
        turn = width * k
        turned = rest if not turn else F.shiftrightunsigned(rest, turn).bitwiseOR(F.shiftleft(rest, bits - turn)).bitwiseAND(F.lit(keep).cast("long"))
        value = turned.bitwiseAND(F.lit((1 << width) - 1).cast("long"))
        made.append(F.struct(F.lit(k).cast("long").alias("block"), value.alias("value"), F.shiftrightunsigned(turned, width).alias("rest")))
    return F.array(*made)


def near_links(prints: DataFrame, distance: int = 3, large: int = LARGE_BUCKET) -> DataFrame:
    """Links (a, b) between nodes whose closure is that of all pairs of nodes within `distance` bits in a table.

    prints: node, fp and bucket (the number of the table), distinct.
    """
    parts = distance + 1
    rows = materialize(prints.select("node", "fp", "bucket"), "codes").withColumn("rest", F.col("fp"))
    bits, ready = 64, []
    while True:
        width = bits // parts
        spread = rows.select("node", "fp", "bucket", F.explode(blocks(F.col("rest"), bits, parts)).alias("s"))
        key = (F.col("bucket") * parts + F.col("s.block")) * (1 << width) + F.col("s.value")
        spread = spread.select("node", "fp", key.alias("bucket"), F.col("s.rest").alias("rest"))
        bits -= width
        if bits // parts < 8:
            ready.append((spread, None))
            break
        hot = materialize(spread.groupBy("bucket").count().where(F.col("count") > large).select("bucket"), "large")
        if not hot.count():
            ready.append((spread, None))
            break
        ready.append((spread, hot))
        rows = materialize(spread.join(hot, "bucket", "left_semi"), "large-rows")
    links = None
    for spread, hot in ready:
        cold = spread if hot is None else spread.join(hot, "bucket", "left_anti")
        found = cold.select("bucket", "fp", "node").repartition("bucket").mapInPandas(lambda frames: bucket_links(frames, distance), "a long, b long")
        links = found if links is None else links.unionAll(found)
    return links


def joined_tables(codes: DataFrame, distance: int) -> DataFrame:
    """Components (node, root) over several tables of fingerprints. codes: node, fp and bucket (the number of the table).

    Nodes that share a whole fingerprint in some table are united first, each with the smallest node of that fingerprint.
    The index then takes every fingerprint of a table once, for the component that has it, so that a group of near copies
    does not meet again, table by table and block by block, as all its members.
    """
    codes = materialize(codes, "table-codes")
    shared = codes.groupBy("bucket", "fp").agg(F.min("node").alias("b"), F.count("*").alias("n")).where("n > 1").drop("n")
    equal = contracted(codes.select("bucket", "fp", F.col("node").alias("a")).join(shared, ["bucket", "fp"]).select("a", "b"))
    first = codes.join(equal, "node", "left").select(F.coalesce("root", "node").alias("node"), "fp", "bucket").distinct()
    near = contracted(near_links(first, distance))
    beyond = near.select(F.col("node").alias("root"), F.col("root").alias("beyond"))
    united = equal.join(beyond, "root", "left").select("node", F.coalesce("beyond", "root").alias("root"))
    # nodes that share no fingerprint but have near ones
    return united.unionAll(near.join(equal, "node", "left_anti").select("node", "root"))


def near_duplicates(docs: DataFrame, size: int = 3, distance: int = 3, seed: int = SEED, tables: int = 1) -> DataFrame:
    """One row per document: doc_id, text_hash, fp, component_id (the smallest doc_id reachable).

    Documents link if their fingerprints differ in at most `distance` bits in one of the tables. A null doc_id takes part
    and is its component's id only where no document of the component has one. Repeated rows stay. Texts without words
    share fingerprint zero and are linked like any other. Empty input, empty result.
    """
    rows = materialize(fingerprints(docs, size, seed, tables), "fingerprints")
    prints = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "prints")
    codes = prints.select(F.col("fp").alias("node"), "fp", F.lit(0).cast("long").alias("bucket"))
    if tables == 1:
        roots = least_reachable(materialize(near_links(codes, distance), "links"))
    else:
        others = rows.select(F.col("fp").alias("node"), F.posexplode("more").alias("table", "code")).distinct()
        roots = joined_tables(codes.unionAll(others.select("node", F.col("code").alias("fp"), (F.col("table") + 1).cast("long"))), distance)
    nodes = prints.join(roots, prints.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    nodes = materialize(nodes, "nodes")
    names = materialize(nodes.groupBy("root").agg(F.min("least").alias("component_id")), "components")
    named = materialize(nodes.join(names, "root").select("fp", "component_id"), "named")
    return rows.join(named, "fp").select("doc_id", "text_hash", "fp", "component_id")


def hex64(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def deduplicate(docs: DataFrame, size: int = 3, distance: int = 3, tables: int = 1) -> DataFrame:
    """One document of each component: the one with the smallest doc_id (null last), then the smallest text hash.

    Rows that repeat both doc_id and text are one document. All columns of docs are returned as they are.
    """
    found = near_duplicates(docs, size, distance, tables=tables)
    group = F.coalesce(F.concat(F.lit("c"), F.col("component_id")), F.concat(F.lit("f"), F.col("fp")))
    first = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")
    kept = found.groupBy(group.alias("g")).agg(F.min(first).alias("m")).select(F.col("m.doc_id").alias("keep_id"), F.col("m.text_hash").alias("keep_hash"))
    kept = materialize(kept.distinct(), "kept")
    key, mark = spare("kept_id", docs.columns), spare("kept_hash", docs.columns)
    rows = docs.withColumns({key: F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")), mark: F.xxhash64("text")})
    kept = kept.select(F.coalesce(F.col("keep_id").cast("string"), F.lit("")).alias(key), F.col("keep_hash").alias(mark))
    return rows.join(kept, [key, mark], "left_semi").dropDuplicates([key, mark]).select(*docs.columns)
