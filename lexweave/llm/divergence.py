"""Divergence of the sources of each language from one another and from the language, on exact sparse count vectors.

The steps are those of a CountVectorizer per language (minDF, vocabSize at its largest integer) whose document vectors a
Summarizer adds up by source, followed by an evaluation of pairs that touches only terms both sources hold:

* A task turns its documents into sparse rows (document, term, count) over a dictionary of the terms it has met, adds
  the rows of a source up, and merges such sums batch by batch, so that a source with a third of all documents leaves a
  task as one sum.
* The vocabulary is a table (lang, term), not an array on the driver: it grows with the corpus, and a fitted
  CountVectorizerModel would hold it in the driver and send it to every executor. Terms in fewer than min_docs
  documents of a language are dropped where the sums of a term meet; every other term stays.
* With p(t) a source's share of term t and p0 its share of a term it has not, the sum over all V terms of f(p, q) is
  V f(p0, q0), plus for each term of one side f(p, q0) - f(p0, q0) and its mirror, plus for each term of both sides
  f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0). The middle part needs only how often each share occurs in a source.

All arithmetic is in whole numbers.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexweave.llm.common import materialize, small_batches

#: Documents of a language that a kept term occurs in, and the last rank of the terms reported.
MIN_DOCS, TOP_TERMS = 3, 200
#: Shares are counted in parts of this.
SCALE = 1_000_000_000
#: Terms in a task's dictionary, or entries of its sums, from which the sums are handed on and begun anew.
FULL = 2_000_000
#: Pairs of sources evaluated at once.
PAIRS = 1 << 20
SUMS = "lang string, source string, term string, n long, docs long"

#: Bytes of a text to bytes of its terms: A-Z in lower case, other ASCII that is no letter to spaces, the rest as it is.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    """Terms of a whole text in order; none for null."""
    return (text or "").encode("utf-8", "surrogatepass").translate(FOLD).split()


def merged(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted distinct keys and the sum of each array of values over equal keys."""
    if not len(keys):
        return (keys, *values)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return (keys[starts], *(np.add.reduceat(v[order], starts) for v in values))


class GroupSums:
    """Sums of sparse document vectors by (lang, source), and the number of documents that hold each term."""

    def __init__(self) -> None:
        self.vocabulary: defaultdict[bytes, int] = defaultdict(itertools.count().__next__)
        self.groups: defaultdict[tuple[str, str], int] = defaultdict(itertools.count().__next__)
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.entries = 0

    def vectors(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document vectors as coordinates: place of the document, number of the term, count."""
        found = [terms(text) for text in texts]
        flat = np.fromiter(map(self.vocabulary.__getitem__, itertools.chain.from_iterable(found)), np.int64)
        doc = np.repeat(np.arange(len(found)), [len(words) for words in found])
        key, count = merged(doc << 32 | flat, np.ones(len(flat), np.int64))
        return key >> 32, key & 0xFFFFFFFF, count

    def add(self, langs: list[str], sources: list[str], texts: list[str | None]) -> None:
        group = np.fromiter(map(self.groups.__getitem__, zip(langs, sources)), np.int64, len(texts))
        doc, term, count = self.vectors(texts)
        made = merged(group[doc] << 32 | term, count, np.ones(len(count), np.int64))
        self.parts.append(made)
        self.entries += len(made[0])
        if self.entries > 2 * FULL:
            self.merge()

    def merge(self) -> None:
        if len(self.parts) > 1:
            self.parts = [merged(*(np.concatenate(column) for column in zip(*self.parts)))]
        self.entries = sum(len(part[0]) for part in self.parts)

    def full(self) -> bool:
        return len(self.vocabulary) > FULL or self.entries > FULL and len(self.parts) == 1

    def batches(self) -> Iterator[pa.RecordBatch]:
        """The sums as rows of SUMS, and for each group a row with an empty term."""
        self.merge()
        if not self.groups:
            return
        none = np.zeros(len(self.groups), np.int64)
        rows = [(np.arange(len(self.groups)), none - 1, none, none)]
        if self.parts:
            key, n, docs = self.parts[0]
            rows.append((key >> 32, key & 0xFFFFFFFF, n, docs))
        langs, sources = (pa.array(column, pa.string()) for column in zip(*self.groups))
        words = pa.array([*self.vocabulary, b""], pa.binary()).cast(pa.string())
        for group, term, n, docs in rows:
            term = np.where(term < 0, len(words) - 1, term)
            for at in range(0, len(group), 1 << 16):
                part = slice(at, at + (1 << 16))
                columns = [langs.take(pa.array(group[part])), sources.take(pa.array(group[part])), words.take(pa.array(term[part]))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(n[part]), pa.array(docs[part])], ["lang", "source", "term", "n", "docs"])


def group_sums(docs: DataFrame) -> DataFrame:
    """Rows of SUMS, several for a term of a group: count and documents of a term in a part of the group's documents."""
    small_batches(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = GroupSums()
        for batch in batches:
            sums.add(*(batch.column(k).to_pylist() for k in range(3)))
            if sums.full():
                yield from sums.batches()
                sums = GroupSums()
        yield from sums.batches()

    empty = F.lit("")
    rows = docs.select(F.coalesce("lang", empty).alias("lang"), F.coalesce("source", empty).alias("source"), F.coalesce("text", empty).alias("text"))
    return rows.mapInArrow(work, SUMS)


def kept_sums(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """Group vectors over the vocabulary: lang, source, term, n, with n_lang and n_sources of the term and `lead` on one of its rows.

    Each group has one more row, with an empty term. Sums of a term meet in one task, at most one for each task before
    and source; no text is shuffled.
    """
    sums = group_sums(docs).repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")
    over = {"n_lang": F.sum("n"), "n_docs": F.sum("docs"), "n_sources": F.count("*"), "least": F.min("source")}
    found = sums.withColumns({name: made.over(term) for name, made in over.items()})
    found = found.where((F.col("n_docs") >= min_docs) | (F.col("term") == ""))
    return found.select("lang", "source", "term", "n", "n_lang", "n_sources", (F.col("source") == F.col("least")).alias("lead"))


def share(n: Column, total: Column, size: Column) -> Column:
    """1 + floor(SCALE (n + 1) / (total + size)), at most SCALE + 1."""
    wide = lambda c: c.cast("decimal(20,0)")
    top = F.lit(SCALE).cast("decimal(10,0)") * wide(n + 1)
    return F.call_function("div", top, wide(total + size)) + 1


def apart(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q)."""
    return F.call_function("div", (p - q) * (p - q), q)


def both_sides(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over terms that both groups of a pair hold, from rows (lang, term, gid, p, p0) in the order of lang and term."""

    def f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return (p - q) ** 2 // q

    def evaluate(rows: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        gid, p, p0 = (rows.column(k).to_numpy() for k in (2, 3, 4))
        many = np.diff(np.append(starts, len(gid)))
        first, width = np.repeat(starts, many), np.repeat(many, many)
        # rows in runs of about PAIRS pairs: each row meets all rows of its term
        run = np.cumsum(width) // PAIRS
        names, place = np.unique(gid, return_inverse=True)
        for lows in np.split(np.arange(len(gid)), np.flatnonzero(np.diff(run)) + 1):
            a = np.repeat(lows, width[lows])
            ends = np.cumsum(width[lows])
            b = np.arange(len(a)) - np.repeat(ends - width[lows], width[lows]) + first[a]
            a, b = a[a != b], b[a != b]
            if not len(a):
                continue
            value = f(p[a], p[b]) - f(p[a], p0[b]) - f(p0[a], p[b]) + f(p0[a], p0[b])
            key, value = merged(place[a] * len(names) + place[b], value)
            yield pa.RecordBatch.from_arrays([pa.array(names[key // len(names)]), pa.array(names[key % len(names)]), pa.array(value)], ["a", "b", "value"])

    held = None
    for batch in batches:
        held = pa.concat_tables([held, pa.Table.from_batches([batch])]).combine_chunks() if held is not None else pa.Table.from_batches([batch])
        if held.num_rows < 2:
            continue
        new = pc.or_(pc.not_equal(held.column(0)[1:], held.column(0)[:-1]), pc.not_equal(held.column(1)[1:], held.column(1)[:-1]))
        starts = np.flatnonzero(np.concatenate([[True], np.asarray(new.to_numpy(), bool)]))
        # the last term may go on in the next batch
        yield from evaluate(held.slice(0, starts[-1]), starts[:-1])
        held = held.slice(starts[-1])
    if held is not None and held.num_rows:
        yield from evaluate(held, np.zeros(1, np.int64))


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: how far each source is from the others (`pair`) and in which terms (`term`).

    Null text, lang and source are ''. Repeated rows are documents of their own. A group without kept terms has pairs,
    with value 0 where its language keeps no term. A source that is alone in its language has no pairs. Equal values are
    ranked by item. Empty input, empty result.
    """
    kept = materialize(kept_sums(docs, min_docs), "terms")
    langs = kept.groupBy("lang").agg(F.sum("n").alias("total_lang"), F.count_if(F.col("lead") & (F.col("term") != "")).alias("size"))
    groups = materialize(kept.groupBy("lang", "source").agg(F.sum("n").alias("total")).join(langs, "lang"), "totals")
    groups = groups.withColumn("p0", F.when(F.col("size") > 0, share(F.lit(0), F.col("total"), F.greatest("size", F.lit(1)))))
    groups = materialize(groups.withColumn("gid", F.monotonically_increasing_id()), "groups")

    found = kept.where("term <> ''").join(groups, ["lang", "source"])
    shares = {"p": share(F.col("n"), F.col("total"), F.col("size")), "q": share(F.col("n_lang"), F.col("total_lang"), F.col("size"))}
    scored = materialize(found.select("lang", "source", "term", "n_sources", "gid", "p0", *(c.alias(name) for name, c in shares.items())), "shares")

    p, q, a0, b0 = F.col("p"), F.col("q"), F.col("p0"), F.col("other_p0")
    others = groups.select("lang", F.col("gid").alias("other"), F.col("source").alias("item"), F.col("p0").alias("other_p0"))
    counted = scored.groupBy("lang", "gid", "p0", "p").agg(F.count("*").alias("times"))
    met = counted.join(others, "lang").where("gid <> other")
    ways = F.array(
        F.struct(F.col("gid").alias("a"), F.col("other").alias("b"), (F.col("times") * (apart(p, b0) - apart(a0, b0))).alias("value")),
        F.struct(F.col("other").alias("a"), F.col("gid").alias("b"), (F.col("times") * (apart(b0, p) - apart(b0, a0))).alias("value")),
    )
    single = met.select(F.explode(ways).alias("w")).select("w.*")
    shared = scored.where("n_sources > 1").select("lang", "term", "gid", "p", "p0").repartition("lang", "term").sortWithinPartitions("lang", "term")
    sums = single.unionAll(shared.mapInArrow(both_sides, "a long, b long, value long")).groupBy("a", "b").agg(F.sum("value").alias("more"))
    base = groups.join(others, "lang").where("gid <> other")
    base = base.select("lang", "source", "item", F.col("gid").alias("a"), F.col("other").alias("b"), F.coalesce(F.col("size") * apart(a0, b0), F.lit(0)).alias("base"))
    pairs = base.join(sums, ["a", "b"], "left").select("lang", "source", F.lit("pair").alias("part"), "item", (F.col("base") + F.coalesce("more", F.lit(0))).alias("value"))

    above = scored.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), apart(p, q).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = above.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(order)).unionAll(ranked)
