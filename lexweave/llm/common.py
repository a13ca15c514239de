"""Helpers shared by the operators of this folder."""

import re
import string
import uuid
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexweave.session import materialize, scratch_root

#: White space of the word definition used throughout: space and \x09-\x0D. Words are runs of anything else.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows per Arrow batch: texts may be long, so batches are kept small.
BATCH_ROWS = 2000


def documents(spark: SparkSession, folder: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch of texts holds in memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def new_folder(spark: SparkSession, label: str) -> str:
    """A folder of its own below the shared scratch folder (a URI or a path, not made yet)."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def spare(name: str, taken: list[str]) -> str:
    """A column name that no column of taken has, whatever its case."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name += "_"
    return name


def words(text: Column) -> Column:
    """Words of a text as an array; empty for a null or blank text."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def let(value: Column, body) -> Column:
    """body(value) with value computed once per row: a lambda variable is not evaluated again for each use."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def least_reachable(edges: DataFrame) -> DataFrame:
    """Connected components of undirected edges (a, b): each node that has an edge, with the smallest node reachable.

    Every round takes the smallest label among neighbours and then follows labels once (pointer jumping), so long
    chains need a number of rounds that grows with the logarithm of their length. Labels are written to the shared
    folder each round: the lineage stays short and lost executors cost one round. Hubs are only ever keys of joins
    whose both sides are scans, which adaptive execution splits, or of minima, which combine before the shuffle.
    """
    both = materialize(
        edges.where("a <> b").select("a", "b").unionAll(edges.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        "edges",
    )
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("root")), "labels")
    while True:
        near = both.join(labels, both.b == labels.node).select(both.a.alias("node"), "root")
        lower = materialize(near.unionAll(labels).groupBy("node").agg(F.min("root").alias("root")), "labels")
        jump = lower.select(F.col("node").alias("root"), F.col("root").alias("beyond"))
        after = materialize(lower.join(jump, "root").select("node", F.col("beyond").alias("root")), "labels")
        before = labels.select("node", F.col("root").alias("was"))
        moved = after.join(before, "node").where("root <> was").limit(1).count()
        labels = after
        if not moved:
            return labels


def contracted(edges: DataFrame) -> DataFrame:
    """The same as least_reachable, for links of which a component has many: node and root.

    Each round points every node at its smallest neighbour, follows the pointers to their ends, and then moves the links
    to these ends, where loops and repeated links fall away. Later rounds and their joins see only what is left, so all
    rounds together join about two rows for each different link of the first.
    """
    a, b = F.col("a"), F.col("b")
    rest = materialize(edges.where("a <> b").select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct(), "links")
    steps = []
    while True:
        both = rest.unionAll(rest.select(b.alias("a"), a.alias("b")))
        roots = materialize(both.groupBy(a.alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("root")), "roots")
        while True:
            # only pointers at nodes that point on have to be followed
            onward = roots.where("node <> root").select(F.col("node").alias("root"), F.col("root").alias("beyond"))
            moved = materialize(roots.join(onward, "root", "left").select("node", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "roots")
            roots = moved.select("node", "root")
            if moved.where("moved").isEmpty():
                break
        steps.append(roots)
        at_a, at_b = roots.select(F.col("node").alias("a"), F.col("root").alias("ra")), roots.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        ends = rest.join(at_a, "a").join(at_b, "b").where("ra <> rb")
        rest = materialize(ends.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "links")
        if rest.isEmpty():
            break
    found = steps.pop()
    while steps:
        beyond = found.where("node <> root").select(F.col("node").alias("root"), F.col("root").alias("beyond"))
        found = materialize(steps.pop().join(beyond, "root", "left").select("node", F.coalesce("beyond", "root").alias("root")), "roots")
    return found


class WordTokens(dict):
    """Token ids, as little-endian unsigned 32-bit bytes, of pieces of text whose tokens do not depend on their surroundings.

    New pieces are first taken apart into parts that many pieces share; parts not known yet are encoded by the tokenizers
    library, many in one text with a mark between them whose token no part holds. Pieces are remembered; the memory is emptied when it holds limit
    pieces. One instance lives as long as its Python worker.
    """

    made: dict = {}

    def __init__(self, path: str, limit: int = 1_200_000):
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.limit = limit

    @classmethod
    def of(cls, path: str) -> "WordTokens":
        if path not in cls.made:
            cls.made[path] = cls(path)
        return cls.made[path]

    def learn(self, pieces: list[str], way: "Splitting") -> None:
        parts = {piece: way.fold(piece) for piece in pieces}
        new = list({part for folded in parts.values() for part in folded if part not in self})
        joined = [part for part in new if way.joins.fullmatch(part)]
        self.single([part for part in new if not way.joins.fullmatch(part)])
        (mark,) = self.tokenizer.encode(way.glue, add_special_tokens=False).ids
        runs = [joined[i : i + 1000] for i in range(0, len(joined), 1000)]
        for run, made in zip(runs, self.tokenizer.encode_batch_fast([way.glue.join(run) for run in runs], add_special_tokens=False)):
            ids = np.array(made.ids, "<u4")
            ends = np.flatnonzero(ids == mark)
            if len(ends) + 1 != len(run):
                raise ValueError("parts of joined texts cannot be told apart")
            data, begins = ids.tobytes(), [0, *(4 * ends + 4).tolist()]
            for part, a, b in zip(run, begins, [*(4 * ends).tolist(), len(data)]):
                self[part] = data[a:b]
        for piece, folded in parts.items():
            self[piece] = self[folded[0]] if len(folded) == 1 else self[folded[0]] + self[folded[1]]

    def single(self, parts: list[str]) -> None:
        for part, made in zip(parts, self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)):
            self[part] = np.array(made.ids, "<u4").tobytes()

    def encode(self, texts: list[str], way: "Splitting") -> list[bytes]:
        """Ids of each whole text."""
        if len(self) > self.limit:
            self.clear()
        cuts = [way.cut(text) for text in texts]
        missing = [piece for piece in set().union(*cuts) if piece not in self]
        if missing:
            self.learn(missing, way)
        take = self.__getitem__
        made = [b"".join(map(take, pieces)) for pieces in cuts]
        for piece in missing:
            if len(piece) > 64:
                self.pop(piece, None)
        return made


def stops_apart(piece: str) -> tuple[str, ...]:
    """A piece that ends in a letter and ASCII punctuation, as these two parts: both splitting rules divide there."""
    base = piece.rstrip(string.punctuation)
    return (base, piece[len(base) :]) if base and base != piece and base[-1].isalpha() else (piece,)


def lowered_stops_apart(piece: str) -> tuple[str, ...]:
    """The same for tokenizers that lower case. Latin-1 letters have one lower-case form, whatever the rule set."""
    try:
        piece.encode("latin-1")
    except UnicodeEncodeError:
        return stops_apart(piece)
    return stops_apart(piece.lower())


def lowered_words_cut(text: str) -> list[str]:
    """Pieces for tokenizers that drop white space: nothing they match spans a space or a line feed."""
    return text.replace("\n", " ").split(" ")


ODD_SPACE = re.compile(r"[^\S \n]")
SPACED = re.compile(r" ?[^ \n]+|[ \n]+(?![^ \n])|[ \n]+")


def byte_level_cut(text: str) -> list[str]:
    """Pieces for the byte-level splitting rule in which one space belongs to the word behind it.

    White space other than spaces and line feeds can merge with them into one token, so such a text is one piece.
    """
    return [text] if ODD_SPACE.search(text) else SPACED.findall(text)


@dataclass(frozen=True)
class Splitting:
    """How texts of a kind of tokenizer are taken apart without a change to their tokens.

    cut: independent pieces of a text in order; fold: shared parts of a piece; joins: parts that may stand in one text
    with glue, which is one token, between them.
    """

    cut: Callable[[str], list[str]]
    fold: Callable[[str], tuple[str, ...]]
    joins: re.Pattern
    glue: str


LOWERED_WORDS = Splitting(lowered_words_cut, lowered_stops_apart, re.compile(r"[^\s|]+"), " | ")
BYTE_LEVEL = Splitting(byte_level_cut, stops_apart, re.compile(r" ?\S+"), "\n")
