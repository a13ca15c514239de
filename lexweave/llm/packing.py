"""Best-fit packing with a swap-based local search.

Documents are cut into pieces of at most `capacity` tokens and placed into sequences of that size. Pieces are dealt at
random into groups of bounded size; each group is packed best-fit decreasing and then improved: the emptiest sequence
gives documents to other underfull ones by moves (one for none) and exchanges (one for one, two for one, one for two).
Every step raises the sum of squared fills, so sequences drain until they are empty. A group stops when it has as few
sequences as its tokens allow, or when what is free elsewhere could not take its emptiest sequence.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexweave.llm.common import LOWERED_WORDS, WordTokens, materialize, small_batches, spare

CAPACITY = 2048
#: Pieces packed together in one task. A group wastes at most part of one sequence, some 0.03 % at this size.
GROUP_ROWS = 8192
#: Effort of the search in a group: steps in all, and sources in a row that have nothing left to give.
STEPS, PATIENCE = 2000, 200


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and, if asked for, the ids as little-endian bytes.

    A null text counts as empty, so every document has at least its end id. Repeated rows give repeated pieces.
    """
    small_batches(docs.sparkSession)
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")
    names = [part.split()[0] for part in schema.split(", ")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory, end, width = WordTokens.of(tokenizer), int(end_id).to_bytes(4, "little"), 4 * capacity
        for batch in batches:
            made = memory.encode([text or "" for text in batch.column(1).to_pylist()], LOWERED_WORDS)
            rows = []
            for doc, ids in zip(batch.column(0).to_pylist(), made):
                ids += end
                for at in range(0, len(ids), width):
                    part = ids[at : at + width]
                    rows.append((doc, at // width, at // 4, len(part) // 4, zlib.crc32(part), part))
            columns = list(zip(*rows)) or [[]] * 6
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k, _ in zip(columns, kinds, names)], names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, schema)


def best_fit(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Best-fit decreasing: items of each bin. Bins are found by their free space, so an item costs constant time."""
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins: list[list[int]] = []
    open_sizes = 0  # bit r is set when some bin has r free
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        fitting = open_sizes >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            chosen = free[room].pop()
            if not free[room]:
                open_sizes ^= 1 << room
        else:
            room, chosen = capacity, len(bins)
            bins.append([])
        bins[chosen].append(item)
        room -= size
        if not free[room]:
            open_sizes |= 1 << room
        free[room].append(chosen)
    return bins


def pair_sums(held: list[int]) -> dict[int, tuple[int, int]]:
    """Sums of two items of a bin, each with a pair that makes it. A bin has few distinct sizes, as they add up to its fill."""
    count = Counter(held)
    kinds = sorted(count)
    return {a + b: (a, b) for i, a in enumerate(kinds) for b in kinds[i:] if a != b or count[a] > 1}


class Returns:
    """For each number of tokens y: the bin with the most free space that can hand back y tokens."""

    def __init__(self, capacity: int):
        self.capacity, self.values, self.owners = capacity, {}, {}

    def put(self, b: int, values: list[int]) -> None:
        self.values[b] = np.array(values, np.int64)
        self.owners[b] = np.full(len(values), b, np.int64)

    def table(self, free: np.ndarray, without: int) -> tuple[np.ndarray, np.ndarray]:
        room, where = np.full(self.capacity + 1, -1, np.int64), np.full(self.capacity + 1, -1, np.int64)
        if self.values:
            values, owners = np.concatenate(list(self.values.values())), np.concatenate(list(self.owners.values()))
            usable = (owners != without) & (free[owners] > 0)
            values, owners = values[usable], owners[usable]
            order = np.argsort(free[owners], kind="stable")  # later ones overwrite earlier ones
            room[values[order]], where[values[order]] = free[owners[order]], owners[order]
        return room, where


def improve(bins: list[list[int]], sizes: np.ndarray, capacity: int, steps: int = STEPS, patience: int = PATIENCE) -> list[list[int]]:
    """Drain the emptiest bins into other underfull ones; see the module's text. Returns the bins that hold items."""
    items = [list(own) for own in bins]
    held = [[int(sizes[i]) for i in own] for own in bins]
    free = np.array([capacity - sum(own) for own in held], np.int64)
    least, used, stuck = -(-int(sizes.sum()) // capacity), len(bins), set()
    singles, doubles = Returns(capacity), Returns(capacity)

    def note(b: int) -> None:
        singles.put(b, [0, *set(held[b])] if held[b] and free[b] else [])
        doubles.put(b, list(pair_sums(held[b])) if free[b] else [])

    for b in range(len(bins)):
        if free[b]:
            note(b)
    while used > max(1, least) and steps > 0 and len(stuck) < patience:
        sources = [b for b in np.flatnonzero((free > 0) & (free < capacity)).tolist() if b not in stuck]
        if not sources:
            break
        a = max(sources, key=lambda b: (free[b], -b))
        if int(free[free < capacity].sum()) - int(free[a]) < capacity - int(free[a]):
            break  # what is free elsewhere could not take it
        steps -= 1
        own = pair_sums(held[a])
        one, two = singles.table(free, a), doubles.table(free, a)
        best = (0, 0, 0, -1, 1, 1)
        for offers, back, gives, takes in ((sorted(set(held[a])), one, 1, 1), (sorted(set(held[a])), two, 1, 2), (sorted(own), one, 2, 1)):
            if not offers:
                continue
            gain = np.array(offers)[:, None] - np.arange(capacity + 1)[None, :]
            gain[gain > back[0][None, :]] = 0  # the other bin has no room for the difference
            row, y = divmod(int(gain.argmax()), capacity + 1)
            # a may hold less than the other bin or, if all emptier ones are stuck, more: squared fill must rise
            if gain[row, y] > best[0] and gain[row, y] > int(free[back[1][y]]) - int(free[a]):
                best = (int(gain[row, y]), offers[row], y, int(back[1][y]), gives, takes)
        gain, x, y, b, gives, takes = best
        if gain <= 0:
            stuck.add(a)
            continue
        given = (x,) if gives == 1 else own[x]
        taken = () if y == 0 else (y,) if takes == 1 else pair_sums(held[b])[y]
        for source, target, moved in ((a, b, given), (b, a, taken)):
            for size in moved:
                at = held[source].index(size)
                held[target].append(held[source].pop(at))
                items[target].append(items[source].pop(at))
        stuck.discard(b)
        for x in (a, b):
            free[x] = capacity - sum(held[x])
            note(x)
        if not held[a]:
            used -= 1
            stuck.clear()
    return [own for own in items if own]


def pack_sizes(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    return improve(best_fit(sizes, capacity), sizes, capacity)


def pack(pieces: DataFrame, capacity: int = CAPACITY, length: str = "length", group_rows: int = GROUP_ROWS) -> DataFrame:
    """pieces with sequence_id (long) and offset (long): its place, gapless from 0 within a sequence.

    A null length counts as 0; a length outside 0..capacity is an error. Input columns of the names sequence_id and
    offset are replaced. An empty input gives an empty result. Groups are of one size whatever keys the pieces have.
    """
    pieces = materialize(pieces.drop("sequence_id", "offset"), "pieces")
    groups = max(1, -(-pieces.count() // group_rows))
    tag = spare("pack_group", pieces.columns)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long"

    def place(group: pd.DataFrame) -> pd.DataFrame:
        number = int(group[tag].iloc[0])
        group = group.drop(columns=tag).reset_index(drop=True)
        sizes = group[length].fillna(0).to_numpy(np.int64)
        if len(sizes) and (sizes.min() < 0 or sizes.max() > capacity):
            raise ValueError(f"lengths must be in 0..{capacity}")
        sequence, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        for n, items in enumerate(pack_sizes(sizes, capacity)):
            sequence[items] = (number << 32) + n
            offset[items] = np.concatenate([[0], np.cumsum(sizes[items])[:-1]])
        return group.assign(sequence_id=sequence, offset=offset)

    # the row numbers of a written table are the same in every attempt of a task
    dealt = pieces.withColumn(tag, F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
    return dealt.groupBy(tag).applyInPandas(place, schema)


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """Documents cut, tokenised and packed: one row per piece."""
    return pack(token_pieces(docs, tokenizer, end_id, capacity), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves, from packed pieces that carry their ids: sequence_id, n_tokens, ids (little-endian bytes).

    A sequence has at most `capacity` tokens, so the pieces gathered for one are bounded.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "piece", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda made, part: F.concat(made, part["ids"]))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), joined.alias("ids"))
