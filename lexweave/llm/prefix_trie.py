"""Trie of shared conversation prefixes by hashing blocks of turns.

Conversations are cut into blocks of BLOCK turns. Rows are grouped by (what came before a block, the block), so that
conversations which share whole blocks are one row after a count that combines before the shuffle. Only where siblings
diverge, that is where several different blocks follow the same beginning, are their single turns compared; a block
that has no sibling gives its turns as nodes at once.

A turn is the first 120 bits of the SHA-256 of role and text, and a beginning of d turns is the exclusive or of 128-bit
hashes of (place, turn), which a running aggregate can build in pieces: a conversation that holds a third of all rows
is ordered by range partitions and summed in segments, never in one task. No text is shuffled.

The smallest member names a node. A conversation that names a node names every deeper node it passes, so (conv_id,
depth) identifies nodes, and sums over a subtree are sums over its members of one number each: the total of the nodes
that the member names, less what the node's own conversation names above it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexweave.llm.common import let, materialize, words

#: Turns of a block, and turns of a segment, a multiple of it, within which one task runs along a conversation.
BLOCK, SEGMENT = 4, 1024
#: Donors are the conversations whose id is a multiple of FAMILY; at most GIVEN - 1 of their turns are taken over.
FAMILY, GIVEN = 20, 4
#: Bytes of ids hashed or passed on at once.
PIECE = 1 << 20


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, a, b (digest of role and text) and n_words of every row whose conv_id is not null."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    whole = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)

    def part(digest: Column, start: int) -> Column:
        return F.conv(F.substring(digest, start, 15), 16, 10).cast("long")

    digest = let(whole, lambda d: F.struct(part(d, 1).alias("a"), part(d, 16).alias("b")))
    rows = conversations.where(F.col("conv_id").isNotNull())
    rows = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), digest.alias("d"), F.size(words(F.col("text"))).cast("long").alias("n_words"))
    return rows.select("conv_id", "turn", "d.a", "d.b", "n_words")


def placed(conversations: DataFrame) -> DataFrame:
    """Turns with their place in their conversation (`pos`, from 0), and h, given and length of the rebuilt conversation.

    Turns are in the order of `turn`, null first, then of their digests. Range partitions and counts per partition give
    the places, so that one long conversation is spread over many tasks.
    """
    rows = materialize(turns(conversations).withColumn("row", F.monotonically_increasing_id()), "turns")
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("a"), F.col("b"), F.col("row")]
    at = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    at = materialize(at.select("conv_id", "a", "b", "n_words", "at", F.shiftright("at", 33).alias("part")), "ordered")
    runs = at.groupBy("conv_id", "part").agg(F.min("at").alias("start"), F.count("*").alias("n"))
    conv = Window.partitionBy("conv_id")
    before = F.sum("n").over(conv.orderBy("part")) - F.col("n")
    runs = materialize(runs.select("conv_id", "part", "start", before.alias("before"), F.sum("n").over(conv).alias("total")), "runs")
    donors = runs.where((F.col("conv_id") % FAMILY == 0) & (F.col("before") == 0)).select(F.col("conv_id").alias("donor"), F.col("total").alias("stock"))
    h = F.crc32(F.col("conv_id").cast("string")) % GIVEN
    runs = runs.withColumns({"donor": F.col("conv_id") - F.col("conv_id") % FAMILY, "h": h}).join(donors, "donor", "left")
    given = F.least("h", F.coalesce("stock", F.lit(0).cast("long")))
    runs = runs.withColumn("given", given).withColumn("length", F.col("given") + F.greatest(F.col("total") - F.col("h"), F.lit(0)))
    pos = F.col("at") - F.col("start") + F.col("before")
    runs = runs.select("conv_id", "part", "start", "before", "donor", "h", "given", "length")
    return at.join(runs, ["conv_id", "part"]).select("conv_id", pos.alias("pos"), "a", "b", "n_words", "donor", "h", "given", "length")


def rebuilt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations (conv_id, pos, a, b, n_words, length), and (conv_id, length) of all of them."""
    columns = ["conv_id", "pos", "a", "b", "n_words", "length"]
    own = rows.where("pos >= h").withColumn("pos", F.col("pos") - F.col("h") + F.col("given"))
    first = F.struct(*(F.col(c) for c in columns[1:5]))
    heads = rows.where((F.col("conv_id") % FAMILY == 0) & (F.col("pos") < GIVEN - 1)).groupBy(F.col("conv_id").alias("donor")).agg(F.array_sort(F.collect_list(first)).alias("head"))
    convs = rows.where("pos = 0").select("conv_id", "donor", "given", "length")
    taken = convs.where("given > 0").join(heads, "donor").select("conv_id", "length", F.explode(F.expr("slice(head, 1, cast(given as int))")).alias("t"))
    return own.select(columns).unionAll(taken.select("conv_id", "t.*", "length").select(columns)), convs.select("conv_id", "length")


def running(rows: DataFrame, place: str, long: Column, values: dict[str, Column], total) -> DataFrame:
    """rows with values aggregated by `total` from the start of their conversation to their place, inclusive.

    A task runs along one segment; only of conversations that are `long` are totals of whole segments carried forward.
    """
    rows = rows.withColumn("seg", F.floor(F.col(place) / SEGMENT))
    parts = rows.where(long).groupBy("conv_id", "seg").agg(*(total(v).alias(f"{name}_seg") for name, v in values.items()))
    earlier = Window.partitionBy("conv_id").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("conv_id", "seg", *(total(f"{name}_seg").over(earlier).alias(f"{name}_in") for name in values))
    along = Window.partitionBy("conv_id", "seg").orderBy(place).rowsBetween(Window.unboundedPreceding, 0)
    found = rows.join(parts, ["conv_id", "seg"], "left").withColumns({name: total(v).over(along) for name, v in values.items()})
    return found


def blocks(rows: DataFrame) -> DataFrame:
    """One row per block of a rebuilt conversation: block, p1 and p2 (what came before), steps (pos, x1, x2, n_words in order)."""
    z1, z2 = F.xxhash64("pos", "a", "b"), F.xxhash64(F.lit("second"), "b", "a", "pos")
    rows = rows.select("conv_id", "pos", "n_words", "length", z1.alias("z1"), z2.alias("z2"))
    rows = running(rows, "pos", F.col("length") > SEGMENT, {"x1": F.col("z1"), "x2": F.col("z2")}, F.bit_xor)
    for k in "12":
        rows = rows.withColumn(f"x{k}", F.col(f"x{k}").bitwiseXOR(F.coalesce(f"x{k}_in", F.lit(0).cast("long"))))
    before = [F.max(F.when(F.col("pos") % BLOCK == 0, F.col(f"x{k}").bitwiseXOR(F.col(f"z{k}")))).alias(f"p{k}") for k in "12"]
    steps = F.array_sort(F.collect_list(F.struct("pos", "x1", "x2", "n_words"))).alias("steps")
    found = rows.groupBy("conv_id", "seg", F.floor(F.col("pos") / BLOCK).alias("block"), "length").agg(*before, steps)
    return found.select("conv_id", "block", "p1", "p2", "steps", "length")


def nodes(members: DataFrame, sums: list[str]) -> DataFrame:
    """Nodes below the root with conv_id (the least member), depth, x1, x2, q1, q2 (the parent's), n_words and sums over members.

    members: rows of blocks with the columns to be summed.
    """
    start = ["block", "p1", "p2"]
    added = [F.sum(name).alias(name) for name in sums]
    kinds = materialize(members.groupBy(*start, "steps").agg(F.min("conv_id").alias("conv_id"), *added), "kinds")
    split = kinds.where("block > 0").groupBy(*start).count().where("count > 1").select(*start, F.lit(True).alias("split"))
    later = kinds.where("block > 0").join(split, start, "left")
    # all first blocks have the root before them
    known = kinds.where("block = 0").withColumn("split", F.lit(True)).unionByName(later)
    prior = lambda k: F.when(F.col("i") == 0, F.col(f"p{k}")).otherwise(F.expr(f"steps[i - 1].x{k}"))
    turn = known.select("*", F.posexplode("steps").alias("i", "s"))
    keys = ["depth", "x1", "x2", "q1", "q2", "n_words"]
    turn = turn.select((F.col("s.pos") + 1).alias("depth"), "s.x1", "s.x2", prior(1).alias("q1"), prior(2).alias("q2"), "s.n_words", "conv_id", "split", *sums)
    refined = turn.where("split").groupBy(*keys).agg(F.min("conv_id").alias("conv_id"), *added)
    return turn.where("split is null").select(*keys, "conv_id", *sums).unionAll(refined.select(*keys, "conv_id", *sums))


def digests(ends: DataFrame) -> DataFrame:
    """conv_id, depth and ends_sha256 of nodes from rows (conv_id, depth, member): SHA-256 of the members in order, comma-joined.

    Members are sorted and written out in parallel; pieces of up to PIECE bytes then stream through the hash of their node,
    which is a sequence by its nature, so that memory stays bounded for any number of members.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, least, held, size, out = None, None, [], 0, []

        def close() -> None:
            if held:
                out.append((*key, least, ",".join(held).encode()))
                held.clear()

        for batch in batches:
            for conv, depth, member in zip(*(column.to_pylist() for column in batch.columns)):
                if (conv, depth) != key or size > PIECE:
                    close()
                    key, least, size = (conv, depth), member, 0
                held.append(str(member))
                size += len(held[-1]) + 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["conv_id", "depth", "least", "ids"])
                out = []
        close()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["conv_id", "depth", "least", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, out = None, None, []
        for batch in batches:
            for conv, depth, ids in zip(*(column.to_pylist() for column in batch.columns)):
                if (conv, depth) == key:
                    state.update(b",")
                else:
                    if key:
                        out.append((*key, state.hexdigest()))
                    key, state = (conv, depth), hashlib.sha256()
                state.update(ids)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["conv_id", "depth", "ends_sha256"])
                out = []
        if key:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*key, state.hexdigest())], ["conv_id", "depth", "ends_sha256"])

    ends = materialize(ends.select("conv_id", "depth", "member"), "ends")
    order = ["conv_id", "depth", "member"]
    cut = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(pieces, "conv_id long, depth long, least long, ids binary")
    cut = cut.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "least").select("conv_id", "depth", "ids")
    return cut.mapInArrow(hashed, "conv_id long, depth long, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """Nodes of the trie of rebuilt conversations: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Null role and text are empty; rows with a null conv_id belong to no conversation and are left out; equal turns are
    ordered by digest, repeated rows stay. A conversation may end up without turns: it is a member of the root alone.
    Empty input, empty result.
    """
    rows, convs = rebuilt(materialize(placed(conversations), "placed"))
    cut = materialize(blocks(rows), "blocks")
    zero = F.lit(0).cast("long")
    found = materialize(nodes(cut.withColumn("n_convs", F.lit(1).cast("long")), ["n_convs"]), "nodes")
    least, count = convs.agg(F.min("conv_id"), F.count("*")).first()

    above = found.select((F.col("depth") + 1).alias("depth"), F.col("x1").alias("q1"), F.col("x2").alias("q2"), F.col("conv_id").alias("parent_conv_id"))
    deep = found.where("depth > 1").join(above, ["depth", "q1", "q2"])
    below = found.where("depth = 1").withColumn("parent_conv_id", F.lit(least).cast("long"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", (F.col("n_words") * (F.col("n_convs") - 1)).alias("saved")]
    linked = materialize(deep.select(*columns).unionAll(below.select(*columns)), "linked")
    kids = linked.groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    kids = materialize(kids, "children")
    counted = materialize(linked.join(kids, ["conv_id", "depth"], "left").withColumn("n_children", F.coalesce("n_children", zero)), "counted")

    # what each conversation names: tokens saved, and the leaf at its end, if it is one
    named = materialize(counted.groupBy("conv_id").agg(F.sum("saved").alias("tokens"), F.max((F.col("n_children") == 0).cast("long")).alias("n_leaves")), "named")
    key = ["conv_id", "depth"]
    totals = nodes(cut.join(named, "conv_id"), ["tokens", "n_leaves"]).select(*key, "tokens", "n_leaves")
    passed = running(counted.where("n_convs > 1"), "depth", F.lit(True), {"passed": F.col("saved")}, F.sum)
    passed = passed.select(*key, (F.col("passed") + F.coalesce("passed_in", zero) - F.col("saved")).alias("passed"))
    # a node of several members has both; below it, one member saves nothing and ends in one leaf
    several = counted.where("n_convs > 1").join(totals, key).join(passed, key)
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    several = several.withColumn("saved_tokens", F.col("tokens") - F.col("passed")).select(columns)
    single = counted.where("n_convs = 1").withColumns({"n_leaves": F.lit(1).cast("long"), "saved_tokens": zero}).select(columns)
    root = named.agg(F.sum("tokens").alias("saved_tokens"), F.sum("n_leaves").alias("n_leaves"))
    tops = F.lit(counted.where("depth = 1").count()).cast("long")
    root = root.select(
        F.lit(least).cast("long"), zero, F.lit(None).cast("long"), F.lit(count).cast("long"), tops, F.coalesce("n_leaves", zero + 1), F.coalesce("saved_tokens", zero)
    ).where(F.lit(count > 0))

    last = cut.where(F.col("block") == F.floor((F.col("length") - 1) / BLOCK)).select(F.col("conv_id").alias("member"), F.element_at("steps", -1).alias("s"))
    last = last.select("member", (F.col("s.pos") + 1).alias("depth"), "s.x1", "s.x2")
    ends = found.select(*key, "x1", "x2").join(last, ["depth", "x1", "x2"]).select(*key, "member")
    ends = ends.unionAll(convs.where("length = 0").select(F.lit(least).cast("long"), zero, "conv_id"))
    none = F.lit(hashlib.sha256().hexdigest())
    found = several.unionAll(single).unionAll(root).join(digests(ends), key, "left")
    return found.select(*columns, F.coalesce("ends_sha256", none).alias("ends_sha256"))
