"""Order across tasks: places in a group and the next mark behind a row, for groups of any size.

Rows are dealt to tasks by ranges of (keys, order) and sorted there, so that a group which holds most of all rows lies
in many tasks side by side. What one task has to know of those before it is carried in one row per task (the border).
No task ever holds a group, and the only window without partitions runs over the borders, of which there are at most as
many as partitions.
"""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexweave.session import materialize

_BITS = 33  # monotonically_increasing_id keeps the partition above these bits


def dealt(df: DataFrame, order: Sequence[Column], label: str, made: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """df in range partitions by order, with _at (rising along the order) and _part; written once.

    Ranges are found by reading df once more, so that costly columns and filters are better made of the rows as dealt.
    """
    at = made(df.repartitionByRange(*order).sortWithinPartitions(*order)).withColumn("_at", F.monotonically_increasing_id())
    return materialize(at.withColumn("_part", F.shiftright("_at", _BITS)), label)


def followed(rows: DataFrame, entry: Column, count: int, name: str) -> DataFrame:
    """Rows of dealt with `no`, the place among all rows from 0, and `name`, the entries of up to count rows behind each.

    What lies behind the last rows of a task comes from the first rows of the tasks behind it: one row per task.
    """
    local = F.col("_at") - F.call_function("shiftleft", F.col("_part"), F.lit(_BITS))
    firsts = F.array_sort(F.collect_list(F.when(local < count, F.struct("_at", entry.alias("entry"))))).getField("entry")
    ends = materialize(rows.groupBy("_part").agg(F.count("*").alias("_n"), firsts.alias("_firsts")), "borders")
    across = Window.orderBy("_part")
    next_ones = F.slice(F.flatten(F.collect_list("_firsts").over(across.rowsBetween(1, count))), 1, count)
    ends = ends.select("_part", (F.sum("_n").over(across) - F.col("_n")).alias("_before"), next_ones.alias("_next"))
    # From the last row to the first, so that looks at all rows behind can go on in the same order without another sort.
    along = Window.partitionBy("_part").orderBy(F.desc("_at")).rowsBetween(-count, -1)
    seen = rows.withColumn("_seen", F.reverse(F.collect_list(entry).over(along))).join(ends, "_part")
    behind = F.slice(F.concat("_seen", "_next"), 1, count)
    return seen.select(*rows.columns, (local + F.col("_before")).alias("no"), behind.alias(name))


def places(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """df with `name`, the place of a row in its group along order, from 0. Ties take any order; null keys are a group.

    Rows on the same keys and order are spread as they come, so no group of equal rows is bound to one task.
    """
    rows = dealt(df.withColumn("_row", F.monotonically_increasing_id()), [F.col(c) for c in (*keys, *order, "_row")], "places")
    key = F.struct(*keys)
    # rows a group has in each task, and its first one there; only a task's first group can have begun before it
    runs = rows.groupBy("_part", *keys).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    ends = runs.groupBy("_part").agg(
        F.min_by(key, "_first").alias("_head"), F.max_by(F.struct(key.alias("key"), F.col("_n").alias("n")), "_first").alias("_tail")
    )
    # a group that goes on in the next task is the tail of all tasks it has been in so far
    along, across = Window.partitionBy("_tail.key").orderBy("_part"), Window.orderBy("_part")
    ends = materialize(ends, "borders").withColumn("_so_far", F.struct("_tail.key", F.sum("_tail.n").over(along).alias("n")))
    entering = ends.select("_part", "_head", F.lag("_so_far").over(across).alias("_in")).where(F.col("_head").eqNullSafe(F.col("_in.key")))
    entering = entering.select("_part", F.col("_head").alias("_key"), F.col("_in.n").alias("_before"))
    runs = runs.withColumn("_key", key)
    firsts = runs.join(entering, (runs["_part"] == entering["_part"]) & runs["_key"].eqNullSafe(entering["_key"]), "left")
    firsts = firsts.select(runs["_part"].alias("_p"), *[runs[k].alias(f"_k_{k}") for k in keys], "_first", "_before")
    same = F.col("_part") == F.col("_p")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    place = F.col("_at") - F.col("_first") + F.coalesce("_before", F.lit(0))
    return rows.join(firsts, same).select(*df.columns, place.alias(name))


def next_behind(rows: DataFrame, marks: DataFrame, keys: Sequence[str], place: str, name: str) -> DataFrame:
    """rows with `name`: the least place of a mark of the same keys that lies behind the row's own place, else null.

    rows and marks have keys and place; a mark at the row's own place is not behind it. Both are put in one order, from
    the last place to the first, and the mark seen last is carried along it.
    """
    held = rows.select(*keys, F.col(place).alias("_place"), F.lit(0).alias("_mark"), F.struct(*rows.columns).alias("_own"))
    seen = marks.select(*keys, F.col(place).alias("_place")).distinct().withColumn("_mark", F.lit(1))
    mixed = held.unionByName(seen, allowMissingColumns=True)
    order = [*(F.col(k) for k in keys), F.col("_place").desc(), F.col("_mark")]
    mixed = dealt(mixed, order, "asof")
    key = F.struct(*keys)
    mark = F.when(F.col("_mark") == 1, F.col("_place"))
    along = Window.partitionBy("_part", *keys).orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.max_by(F.struct(key.alias("key"), F.col("_place").alias("place")), F.when(F.col("_mark") == 1, F.col("_at")))
    ends = mixed.groupBy("_part").agg(last.alias("_last"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    entering = materialize(ends.select("_part", F.last("_last", ignorenulls=True).over(before).alias("_in")), "borders")
    found = mixed.withColumn("_seen", F.last(mark, ignorenulls=True).over(along)).where("_mark = 0").join(entering, "_part")
    carried = F.when(key.eqNullSafe(F.col("_in.key")), F.col("_in.place"))
    return found.select("_own.*", F.coalesce("_seen", carried).alias(name))
