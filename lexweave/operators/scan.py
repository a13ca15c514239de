"""Ordered computations along a document, without ever putting a whole document into one task.

A window over a document sorts all its lines in one task. Here a document is cut into chunks instead. Each chunk is
summarised (one row), the summaries are combined in chunk order, and what enters a chunk from the left or the right
is joined back to its lines. Lines are shuffled once, by (document, chunk), and the only per-document window runs
over one row per chunk.
"""

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexweave.session import materialize


def ordered_scan(
    df: DataFrame,
    keys: Sequence[str],
    chunk: str,
    order: Sequence[str],
    *,
    last: dict[str, Column] | None = None,
    sums: dict[str, Column] | None = None,
    mins: dict[str, Column] | None = None,
    lead: dict[str, Column] | None = None,
    lag: dict[str, Column] | None = None,
    label: str | None = None,
    placed: bool = False,
) -> DataFrame:
    """Add running columns to df, per keys and along order.

    ``chunk`` must not decrease along order. ``last`` carries the most recent non-null value up to and including the
    row, ``sums`` is the running total including the row, ``lead`` / ``lag`` look one row ahead / back. Values given
    to lead and lag must not be null.

    With a ``label`` the rows are worked out and written once, and the summaries are read from the first and last rows of
    the chunks; without one df is read twice, which suits few or narrow rows. ``placed`` says that all rows of a chunk
    are in one partition already.
    """
    last, sums, mins, lead, lag = last or {}, sums or {}, mins or {}, lead or {}, lag or {}
    inputs = {f"_in_{name}": value for name, value in {**last, **sums, **mins, **lead, **lag}.items()}
    position = F.struct(*order)

    here = Window.partitionBy(*keys, chunk).orderBy(*order)
    upto = here.rowsBetween(Window.unboundedPreceding, 0)
    local = {f"_l_{n}": F.last(f"_in_{n}", ignorenulls=True).over(upto) for n in last}
    local |= {f"_l_{n}": F.sum(f"_in_{n}").over(upto) for n in sums}
    local |= {f"_l_{n}": F.min(f"_in_{n}").over(upto) for n in mins}
    local |= {f"_l_{n}": F.lead(f"_in_{n}").over(here) for n in lead}
    local |= {f"_l_{n}": F.lag(f"_in_{n}").over(here) for n in lag}
    # Rows are shuffled as they come; the inputs are worked out behind the shuffle.
    base = (df if placed else df.repartition(*[F.col(k) for k in (*keys, chunk)])).withColumns(inputs)
    if label:
        at_edge = {"_opens": F.lag(F.lit(True)).over(here).isNull(), "_ends": F.lead(F.lit(True)).over(here).isNull()}
        edges = {f"_s_{n}": F.when(F.col("_opens" if n in lead else "_ends"), F.col(f"_in_{n}")) for n in (*lead, *lag)}
        written = materialize(base.withColumns(local | at_edge).withColumns(edges).drop(*inputs), label)
        carried = [F.col(f"_l_{n}").alias(f"_s_{n}") for n in (*last, *sums, *mins)]
        summary = written.where("_ends").select(*keys, chunk, *carried, *[f"_s_{n}" for n in lag])
        if lead:
            firsts = written.where("_opens").select(*keys, chunk, *[f"_s_{n}" for n in lead])
            summary = summary.join(firsts, [*keys, chunk])
        rows = written.drop("_opens", "_ends", *edges)
    else:
        summary = df.withColumns(inputs).groupBy(*keys, chunk).agg(*chunk_ends(position, last, sums, mins, lead, lag))
        rows = base.withColumns(local).drop(*inputs)

    along = Window.partitionBy(*keys).orderBy(chunk)
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    entering = [F.last(f"_s_{n}", ignorenulls=True).over(before).alias(f"_e_{n}") for n in last]
    entering += [F.coalesce(F.sum(f"_s_{n}").over(before), F.lit(0)).alias(f"_e_{n}") for n in sums]
    entering += [F.min(f"_s_{n}").over(before).alias(f"_e_{n}") for n in mins]
    entering += [F.lead(f"_s_{n}").over(along).alias(f"_e_{n}") for n in lead]
    entering += [F.lag(f"_s_{n}").over(along).alias(f"_e_{n}") for n in lag]
    summary = summary.select(*keys, chunk, *entering)

    if label:
        # Its size is known once it is written: the planner broadcasts it or not.
        summary = materialize(summary, f"{label}-borders")
    joined = rows.join(summary, [*keys, chunk])

    out = {n: F.col(f"_l_{n}") + F.col(f"_e_{n}") for n in sums}
    out |= {n: F.least(f"_l_{n}", f"_e_{n}") for n in mins}
    out |= {n: F.coalesce(f"_l_{n}", f"_e_{n}") for n in (*last, *lead, *lag)}
    names = list(out)
    return joined.withColumns(out).drop(*(f"_l_{n}" for n in names), *(f"_e_{n}" for n in names))


def chunk_ends(position: Column, last: Iterable[str], sums: Iterable[str], mins: Iterable[str], lead: Iterable[str], lag: Iterable[str]) -> list[Column]:
    """What a chunk hands on, worked out from its rows in any order."""
    parts = []
    for name in last:
        value = F.col(f"_in_{name}")
        parts.append(F.max_by(value, F.when(value.isNotNull(), position)).alias(f"_s_{name}"))
    for name in sums:
        parts.append(F.sum(f"_in_{name}").alias(f"_s_{name}"))
    for name in mins:
        parts.append(F.min(f"_in_{name}").alias(f"_s_{name}"))
    for name in lead:
        parts.append(F.min_by(f"_in_{name}", position).alias(f"_s_{name}"))
    for name in lag:
        parts.append(F.max_by(f"_in_{name}", position).alias(f"_s_{name}"))
    return parts


def position_in_group(df: DataFrame, keys: Sequence[str], chunk: str, order: Sequence[str], name: str) -> DataFrame:
    """Number the rows of each group from 1; a group holding a large share of all rows is spread over its chunks."""
    return ordered_scan(df, keys, chunk, order, sums={name: F.lit(1).cast("bigint")})
