"""Near-duplicate vectors by collision-counting projections.

Vectors are projected onto many random lines. Two vectors collide on a line if one lies in a window around the other.
Links (cosine of at least the threshold) collide on a line with a known probability, so windows, number of lines and the
count of collisions that a pair must reach are calibrated to a wanted recall. Lines are taken in groups: a vector is
indexed in the grid cell of its values on a group's lines and asks in every cell that its window touches. In a cell the
first line is sorted, windows give pairs, collisions over all lines are counted, and pairs that reach the count are
verified by their cosine in double precision. A pair is taken in the first group in which it collides on every line,
so it is counted once; tasks return sums of links and a spanning forest, never pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexweave.llm.common import least_reachable, materialize
from lexweave.llm.simhash import forest

THRESHOLD = 0.98
#: Half a window, in standard deviations of the difference of two vectors at the threshold.
WINDOW = 2.0
#: Share of links at the threshold that may be missed by the grid, and by the count of collisions.
MISS = 5e-4
#: Vectors of a cell from which its queries are dealt to several tasks, each with the cell's vectors.
LARGE_CELL = 4096
PAIRS = 1 << 20


def plan(n: int) -> tuple[int, int, int]:
    """Lines per group, groups, and collisions asked for, for n vectors: cells get finer as n grows, recall stays."""
    lines = max(3, math.ceil(math.log(max(n, 1) / 10_000) / math.log(4)))
    hit = math.erf(WINDOW / math.sqrt(2))
    groups = math.ceil(math.log(MISS) / math.log(1 - hit**lines))
    m, missed, least = lines * groups, 0.0, 0
    while missed + (p := math.comb(m, least) * hit**least * (1 - hit) ** (m - least)) <= MISS:
        missed, least = missed + p, least + 1
    return lines, groups, max(least, lines)


def directions(dim: int, m: int, seed: int) -> np.ndarray:
    made = np.random.default_rng([seed, dim]).standard_normal((dim, m))
    return made / np.linalg.norm(made, axis=0)


def half_window(dim: int, threshold: float) -> float:
    return WINDOW * math.sqrt((2 - 2 * threshold) / dim)


def cell_links(q: dict, x: dict, group: int, lines: int, least: int, w: float, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links (row of q, row of x) with the smaller rep in q; q and x hold rep, line (projections) and vec (unit vectors)."""
    order = np.argsort(x["line"][:, group * lines], kind="stable")
    sorted_line = x["line"][order, group * lines]
    centre = q["line"][:, group * lines]
    low, high = np.searchsorted(sorted_line, centre - w, "left"), np.searchsorted(sorted_line, centre + w, "right")
    s = 0
    while s < len(centre):
        ends = np.cumsum(high[s:] - low[s:])
        e = s + max(1, int(np.searchsorted(ends, PAIRS, "right")))
        many = high[s:e] - low[s:e]
        a = np.repeat(np.arange(s, e), many)
        b = order[np.repeat(low[s:e] - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())]
        s = e
        keep = q["rep"][a] < x["rep"][b]
        a, b = a[keep], b[keep]
        for k in range(1, lines):
            keep = np.abs(q["line"][a, group * lines + k] - x["line"][b, group * lines + k]) <= w
            a, b = a[keep], b[keep]
        for t in range(0, len(a), PAIRS // 16):
            i, j = a[t : t + PAIRS // 16], b[t : t + PAIRS // 16]
            hits = np.abs(q["line"][i] - x["line"][j]) <= w
            first = hits.reshape(len(i), -1, lines).all(axis=2).argmax(axis=1)
            keep = (hits.sum(axis=1) >= least) & (first == group)
            i, j = i[keep], j[keep]
            keep = np.einsum("ij,ij->i", q["vec"][i], x["vec"][j]) >= threshold
            yield i[keep], j[keep]


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, seed: int = 7) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id (smallest vec_id reachable) and kept (vec_id = component_id).

    vectors: vec_id, embedding, label. Only vectors of equal labels (not null) and lengths are compared. A null or zero
    vector, one with null or non-finite components, or one without a label links with nothing. Equal vectors are one row
    that carries its number of copies. Rows that repeat a vec_id count as vectors of their own. A null vec_id takes part
    and never names a component that has another; kept is then false. Empty input, empty result.
    """
    kind = vectors.schema["embedding"].dataType.simpleString()
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", F.col("label").cast("string").alias("label"))
    usable = F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.exists("embedding", lambda v: v != 0)
    usable = usable & ~F.exists("embedding", lambda v: v.isNull() | F.isnan(v.cast("double")) | (F.abs(v.cast("double")) == float("inf")))
    usable = F.coalesce(usable, F.lit(False))
    reps = rows.where(usable).groupBy("label", "embedding").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    reps = materialize(reps, "vectors").withColumn("rep", F.monotonically_increasing_id())
    reps = materialize(reps, "vector-reps")
    lines, groups, least = plan(reps.count())
    m = lines * groups

    def unit(embedding: pa.Array) -> np.ndarray:
        made = embedding.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(embedding), -1)
        made /= np.abs(made).max(axis=1, keepdims=True)
        return made / np.sqrt((made * made).sum(axis=1, keepdims=True))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each vector once in its own cell of every group and, as a query, in every cell that its window touches."""
        for batch in batches:
            sizes = np.array([len(v) for v in batch.column("embedding")], np.int64)
            for dim in np.unique(sizes).tolist():
                part = batch.take(pa.array(np.flatnonzero(sizes == dim)))
                labels = part.column("label").to_pylist()
                w = half_window(dim, threshold)
                line = unit(part.column("embedding")) @ directions(dim, m, seed)

                def named(at: np.ndarray, which: np.ndarray, query: bool, g: int, part=part, labels=labels, dim=dim) -> pa.RecordBatch:
                    key = [f"{labels[i]}:{dim}:{g}:{'.'.join(map(str, c))}" for i, c in zip(which.tolist(), at.tolist())]
                    made = part.take(pa.array(which))
                    columns = [pa.array(key, pa.string()), pa.array(np.full(len(which), query)), made.column("rep"), made.column("copies"), made.column("embedding")]
                    return pa.RecordBatch.from_arrays(columns, ["cell", "query", "rep", "copies", "embedding"])

                everyone = np.arange(len(labels))
                for g in range(groups):
                    own = line[:, g * lines : (g + 1) * lines]
                    low, high = np.floor((own - w) / (4 * w)).astype(np.int64), np.floor((own + w) / (4 * w)).astype(np.int64)
                    yield named(np.floor(own / (4 * w)).astype(np.int64), everyone, False, g)
                    for turn in range(1 << lines):
                        upper = np.array([turn >> k & 1 for k in range(lines)], bool)
                        meant = (~upper | (high > low)).all(axis=1)
                        yield named(np.where(upper, high, low)[meant], everyone[meant], True, g)

    schema = f"cell string, query boolean, rep long, copies long, embedding {kind}"
    dealt = materialize(reps.select("label", "rep", "copies", "embedding").mapInArrow(deal, schema), "vector-cells")
    large = dealt.where(~F.col("query")).groupBy("cell").count().where(F.col("count") > LARGE_CELL)
    large = materialize(large.select("cell", F.ceil(F.col("count") / LARGE_CELL).cast("int").alias("slices")), "large-cells")
    dealt = dealt.join(large, "cell", "left").withColumn("slices", F.coalesce("slices", F.lit(1)))
    slices = F.when(F.col("query"), F.array(F.pmod(F.xxhash64("rep"), F.col("slices")).cast("int"))).otherwise(F.sequence(F.lit(0), F.col("slices") - 1))
    dealt = dealt.withColumn("slice", F.explode(slices)).drop("slices")

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            cells, parts = batch.column("cell").to_pylist(), batch.column("slice").to_numpy()
            starts = [0, *(k for k in range(1, len(cells)) if cells[k] != cells[k - 1] or parts[k] != parts[k - 1])]
            for a, b in zip(starts, [*starts[1:], len(cells)]):
                now = (cells[a], int(parts[a]))
                if key is not None and now != key:
                    yield from cell(key[0], held)
                    held = []
                key = now
                held.append(batch.slice(a, b - a))
        if held:
            yield from cell(key[0], held)

    def cell(name: str, parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frame = pa.Table.from_batches(parts).combine_chunks()
        asks = frame.column("query").to_numpy()
        if asks.all() or not asks.any() or len(frame) < 3:
            return
        dim, group = map(int, name.rsplit(":", 3)[1:3])
        w = half_window(dim, threshold)
        unit_vectors = unit(frame.column("embedding").chunk(0))
        line = unit_vectors @ directions(dim, m, seed)
        rep, copies = frame.column("rep").to_numpy(), frame.column("copies").to_numpy()
        q, x = np.flatnonzero(asks), np.flatnonzero(~asks)
        side = lambda at: {"rep": rep[at], "line": line[at], "vec": unit_vectors[at]}
        nodes, back = np.unique(rep, return_inverse=True)
        total = np.zeros(len(nodes), np.int64)

        def found() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for i, j in cell_links(side(q), side(x), group, lines, least, w, threshold):
                i, j = q[i], x[j]
                np.add.at(total, back[i], copies[j])
                np.add.at(total, back[j], copies[i])
                yield back[i], back[j]

        label = forest(len(nodes), found())
        linked = np.flatnonzero(total)
        if len(linked):
            yield pa.RecordBatch.from_arrays([pa.array(nodes[linked]), pa.array(nodes[label[linked]]), pa.array(total[linked])], ["a", "b", "n"])

    found = dealt.repartition("cell", "slice").sortWithinPartitions("cell", "slice").mapInArrow(links, "a long, b long, n long")
    found = materialize(found, "vector-links")
    sums = found.groupBy("a").agg(F.sum("n").alias("n"))
    roots = least_reachable(found)
    nodes = reps.join(sums, reps.rep == sums.a, "left").join(roots, reps.rep == roots.node, "left")
    nodes = materialize(nodes.select("label", "embedding", "least", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "rep").alias("root")), "vector-nodes")
    names = materialize(nodes.groupBy("root").agg(F.min("least").alias("component_id")), "vector-components")
    named = materialize(nodes.join(names, "root").select("label", "embedding", "n_links", "component_id"), "vector-named")
    linked = rows.where(usable).join(named, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionAll(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
