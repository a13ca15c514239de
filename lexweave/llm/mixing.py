"""Mixing sources to target weights by Poisson replication, in DataFrame functions only.

Every source has a target repetition rate: its target number of documents over the number it has. Each document draws
its number of copies from a Poisson distribution of that mean, by inverting the distribution at a number in [0, 1) made
from a hash of seed and document. Copies are exploded and the whole corpus is ordered by another hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexweave.llm.common import materialize, spare

#: Targets follow the number of documents of a source to this power: below 1, small sources gain and large ones lose.
ALPHA = 0.5
#: Rows up to which the table of rates is sent to every task; beyond it, it is joined by shuffle.
SMALL_RATES = 10_000


def uniform(*parts: Column | str) -> Column:
    """A number in [0, 1) from the first 52 bits of the MD5 of the parts joined by colons."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("bigint").cast("double") / float(1 << 52)


def rates(docs: DataFrame, source: str = "source", alpha: float = ALPHA, total: float | None = None, weights: dict[str, float] | None = None) -> DataFrame:
    """source (null: its own), n_docs, weight and rate. Weights are the given ones (0 for sources not named) or n_docs ** alpha.

    total is the number of documents wanted, by default as many as there are. Counting combines before the shuffle, so
    a source with a third of all rows costs one row per task.
    """
    counted = docs.groupBy(F.col(source).alias("source")).agg(F.count(F.lit(1)).alias("n_docs"))
    if weights is None:
        weight = F.pow(F.col("n_docs").cast("double"), F.lit(alpha))
    else:
        weight = F.coalesce(*[F.when(F.col("source") == name, F.lit(float(w))) for name, w in sorted(weights.items())], F.lit(0.0))
    counted = materialize(counted.withColumn("weight", weight), "source-counts")
    sums = counted.agg(F.sum("weight"), F.sum("n_docs")).first()
    all_weight, all_docs = float(sums[0] or 0.0), float(sums[1] or 0)
    wanted = all_docs if total is None else float(total)
    rate = F.col("weight") * (wanted / all_weight if all_weight else 0.0) / F.col("n_docs")
    return materialize(counted.withColumn("rate", rate), "source-rates")


def copies(u: Column, rate: Column) -> Column:
    """The Poisson quantile at u: the number of k with P(X <= k) <= u.

    The sum runs as far as the probability that is left can be told from 0 in double precision.
    """
    last = F.ceil(rate + 12 * F.sqrt(rate) + 30).cast("int")
    start = F.struct(F.exp(-rate).alias("p"), F.exp(-rate).alias("sum"), F.lit(0).alias("n"))

    def step(s: Column, k: Column) -> Column:
        p = s["p"] * rate / k
        return F.when(u < s["sum"], s).otherwise(F.struct(p.alias("p"), (s["sum"] + p).alias("sum"), (s["n"] + 1).alias("n")))

    return F.aggregate(F.sequence(F.lit(1), last), start, step, lambda s: s["n"])


def mix(docs: DataFrame, source: str = "source", seed: str = "0", alpha: float = ALPHA, total: float | None = None, weights: dict[str, float] | None = None, named: bool = False) -> DataFrame:
    """docs replicated to the target weights and shuffled; with `named`, also copy (from 0), rate and position (a hash in sort order).

    Repeated rows (same doc_id) draw the same number. A null doc_id draws as the text "?". A rate of 0 drops a source;
    rates must be below 700, where exp(-rate) is still a number, and a larger one is an error. Empty input, empty result.
    """
    taken = list(docs.columns)
    table = rates(docs, source, alpha, total, weights)
    sizes = table.agg(F.count(F.lit(1)), F.max("rate")).first()
    if (sizes[1] or 0) >= 700:
        raise ValueError("a source would be repeated 700 times or more")
    ident, rate, copy, place, joined = (spare(name, taken) for name in ("draw_id", "rate", "copy", "position", "rate_source"))
    table = table.select(F.col("source").alias(joined), F.col("rate").alias(rate))
    if sizes[0] <= SMALL_RATES:
        table = F.broadcast(table)
    drawn = docs.join(table, docs[source].eqNullSafe(table[joined])).drop(joined)
    drawn = drawn.withColumn(ident, F.coalesce(F.col("doc_id").cast("string"), F.lit("?")))
    n = copies(uniform(F.lit(seed), F.col(ident)), F.col(rate))
    made = drawn.select("*", F.posexplode(F.array_repeat(F.lit(True), n)).alias(copy, spare("present", taken)))
    made = made.withColumn(place, F.md5(F.concat_ws(":", F.lit(seed), F.lit("place"), F.col(ident), F.col(copy).cast("string"))))
    # rows are dealt by a hash of a hash, so every partition is a random part of the corpus, in random order
    return made.repartition(place).sortWithinPartitions(place).select(*taken, *([copy, rate, place] if named else []))
