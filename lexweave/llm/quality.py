"""Quality rules as weak supervision, in DataFrame functions only.

Rules look at counts of a text and vote good, bad or abstain. Expectation-maximisation over the table of vote patterns
(at most 3 ** rules rows, whatever the corpus) estimates the share of bad documents and, for each rule, how often it
votes what on good and on bad documents. A document is kept if its posterior probability of being good is at least the
threshold, instead of having to pass every rule.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexweave.llm.common import let, materialize, words

SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
GOOD, BAD, ABSTAIN = 1, -1, 0
#: Bounds of the estimated accuracies. Each kind of junk breaks a rule of its own, which agreement alone cannot tell from
#: a rule that errs; so a bad vote is taken to be rare on good documents, and on bad ones neither negligible nor the rule.
MOST_FALSE, LEAST_HIT, MOST_HIT = 0.001, 0.1, 0.4


@dataclass(frozen=True)
class Rule:
    """value is a SQL expression over the counts (null: abstain); bad if it is outside [bad_below, bad_above], good if within [good_from, good_to]."""

    name: str
    value: str
    good_from: float
    good_to: float
    bad_below: float = -math.inf
    bad_above: float = math.inf
    when: str = "true"

    def vote(self) -> Column:
        v = F.expr(f"cast({self.value} as double)")
        bad = (v < self.bad_below) | (v > self.bad_above)
        good = (v >= self.good_from) & (v <= self.good_to)
        return F.when(F.expr(f"not ({self.when})") | v.isNull(), ABSTAIN).when(bad, BAD).when(good, GOOD).otherwise(ABSTAIN).cast("tinyint")


RULES = (
    Rule("few symbols", "try_divide(n_symbols, n_words)", 0, 0.02, bad_above=0.1),
    Rule("little repetition", "try_divide(n_repeat_words, n_words)", 0, 0.2, bad_above=0.5),
    Rule("no repeated lines", "try_divide(n_dup_lines, n_lines)", 0, 0.1, bad_above=0.4, when="n_lines >= 4"),
    Rule("mostly lower case", "try_divide(n_upper, word_chars)", 0, 0.15, bad_above=0.4, when="n_words >= 20"),
    Rule("words of usual length", "try_divide(word_chars, n_words)", 3.5, 7.5, bad_below=2.5, bad_above=11),
    Rule("few exclamations", "try_divide(n_marks, n_words)", 0, 0.05, bad_above=0.3, when="n_words >= 20"),
    Rule("varied words", "try_divide(n_kinds, sqrt(n_words))", 3.0, math.inf, bad_below=1.5, when="n_words >= 50"),
)


def repeat_words(made: Column) -> Column:
    """Words in windows of three that occur twice or more in the array of words; linear in its length but for one sort.

    Windows are compared by XXH64 of their words. Texts whose windows all differ are done after one distinct. Otherwise
    hash and place are packed into one long, so that equal windows are neighbours after a sort of longs; the place gets
    as many bits as the text needs.
    """

    def windows(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    def covered(starts: Column) -> Column:
        gaps = F.transform(starts, lambda p, i: F.least(F.lit(3).cast("long"), F.coalesce(F.get(starts, i + 1) - p, F.lit(3).cast("long"))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)

    def count(h: Column) -> Column:
        bits = F.ceil(F.log2(F.size(h) + 1)).cast("int")
        pack = F.sort_array(F.transform(h, lambda v, i: shift_left(v, bits).bitwiseOR(i.cast("long"))))

        def starts(packed: Column) -> Column:
            same = lambda a, b: shift_right(a, bits) == shift_right(b, bits)
            hit = F.filter(packed, lambda v, i: F.coalesce(same(v, F.get(packed, i - 1)), F.lit(False)) | F.coalesce(same(v, F.get(packed, i + 1)), F.lit(False)))
            return F.sort_array(F.transform(hit, lambda v: v - shift_left(shift_right(v, bits), bits)))

        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(let(pack, lambda p: let(starts(p), covered)))

    return F.when(F.size(made) < 4, F.lit(0).cast("long")).otherwise(let(windows(made), count))


def shift_left(v: Column, bits: Column) -> Column:
    return F.call_function("shiftleft", v, bits)


def shift_right(v: Column, bits: Column) -> Column:
    return F.call_function("shiftright", v, bits)


def counts(text: Column) -> Column:
    """Struct of all counts of a text (null: no words), made of one pass over its words."""
    body = F.coalesce(text, F.lit(""))

    def of_words(w: Column) -> Column:
        joined = F.array_join(w, "")
        lines = F.filter(F.split(body, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
        return let(
            F.struct(joined.alias("joined"), lines.alias("lines")),
            lambda s: F.struct(
                F.size(w).cast("long").alias("n_words"),
                F.length(s["joined"]).cast("long").alias("word_chars"),
                (F.length(s["joined"]) - F.length(F.translate(s["joined"], SYMBOLS, ""))).cast("long").alias("n_symbols"),
                (F.size(s["lines"]) - F.size(F.array_distinct(s["lines"]))).cast("long").alias("n_dup_lines"),
                repeat_words(w).alias("n_repeat_words"),
                F.size(s["lines"]).cast("long").alias("n_lines"),
                F.length(F.regexp_replace(s["joined"], r"[^\p{Lu}]+", "")).cast("long").alias("n_upper"),
                (F.length(s["joined"]) - F.length(F.translate(s["joined"], "!?", ""))).cast("long").alias("n_marks"),
                F.size(F.array_distinct(w)).cast("long").alias("n_kinds"),
            ),
        )

    return let(words(body), of_words)


def counted(docs: DataFrame, *kept: Column) -> DataFrame:
    """The kept columns and c, the counts of each text.

    They come out of a generator of one row: a filter on c must not be pushed below it, where every use of a count would
    count all words again.
    """
    return docs.select(*kept, F.explode(F.array(counts(F.col("text")))).alias("c"))


def base_failed(of: str = "") -> Column:
    return F.expr(f"{of}n_words < 50 or 100 * {of}n_repeat_words > 50 * {of}n_words")


def vote_columns(rules: tuple[Rule, ...]) -> list[Column]:
    return [rule.vote().alias(f"vote_{k}") for k, rule in enumerate(rules)]


@dataclass(frozen=True)
class Model:
    """share: of bad documents; rates[k][kind][vote]: how often rule k votes -1, 0, 1 on bad (0) and good (1) documents."""

    share: float
    rates: tuple

    def posterior(self) -> Column:
        """Probability of being good, from the columns vote_<k>.

        The log ratios are one array constant, so that rounds with other numbers share their compiled code.
        """
        ratios = F.array(*[F.array(*[F.lit(math.log(good[v] / bad[v])) for v in (BAD, ABSTAIN, GOOD)]) for bad, good in self.rates])
        votes = F.array(*[F.col(f"vote_{k}") for k in range(len(self.rates))])
        said = F.zip_with(votes, ratios, lambda vote, by: F.get(by, vote.cast("int") + 1))
        odds = F.aggregate(said, F.lit(math.log((1 - self.share) / self.share)), lambda a, b: a + b)
        return 1 / (1 + F.exp(-odds))


def informed(rate: dict, low: float = 0.0, high: float = 1.0) -> dict:
    """The rates with that of bad votes moved into [low, high] and the others scaled to what is left."""
    bad = min(max(rate[BAD], low), high)
    rest = (1 - bad) / (rate[ABSTAIN] + rate[GOOD])
    return {BAD: bad, ABSTAIN: rate[ABSTAIN] * rest, GOOD: rate[GOOD] * rest}


def fit(votes: DataFrame, n_rules: int, rounds: int = 25) -> Model:
    """Expectation-maximisation over vote_<k> columns. Start: a bad vote is rare on good documents and common on bad ones.

    The corpus is read once, for the number of documents of each vote pattern; a round is an aggregate over that bounded
    table, and only its 1 + 6 * n_rules sums reach the driver. Every rate has one pseudo-document of its starting value,
    so an empty corpus gives the starting model; rates of bad votes stay within their bounds.
    """
    names = [f"vote_{k}" for k in range(n_rules)]
    start = Model(0.1, tuple(({BAD: 0.3, ABSTAIN: 0.15, GOOD: 0.55}, {BAD: 0.001, ABSTAIN: 0.149, GOOD: 0.85}) for _ in names))
    patterns = materialize(votes.groupBy(*names).count().coalesce(1), "vote-patterns")
    sums = [F.sum(kind).alias(kind) for kind in ("bad", "good")]
    sums += [F.expr(f"sum({kind}) filter (where {n} = {v})").alias(f"{kind}_{n}_{v + 1}") for n in names for v in (BAD, ABSTAIN, GOOD) for kind in ("bad", "good")]
    model = start
    for _ in range(rounds):
        weighed = patterns.withColumn("good", model.posterior() * F.col("count")).withColumn("bad", F.col("count") - F.col("good"))
        row = weighed.agg(*sums).first().asDict()
        row = {key: value or 0.0 for key, value in row.items()}

        def rate(kind: str, name: str, k: int, row: dict = row) -> dict:
            prior = start.rates[k][kind == "good"]
            return {v: (row[f"{kind}_{name}_{v + 1}"] + prior[v]) / (row[kind] + 1) for v in (BAD, ABSTAIN, GOOD)}

        after = Model(
            (row["bad"] + start.share) / (row["bad"] + row["good"] + 1),
            tuple((informed(rate("bad", name, k), low=LEAST_HIT, high=MOST_HIT), informed(rate("good", name, k), high=MOST_FALSE)) for k, name in enumerate(names)),
        )
        settled = abs(after.share - model.share) < 1e-5
        model = after
        if settled:
            break
    return model


def score(docs: DataFrame, rules: tuple[Rule, ...] = RULES, threshold: float = 0.5) -> DataFrame:
    """Per document: doc_id, all counts, votes, base_failed, p_good and kept (false if base_failed, else p_good >= threshold).

    Nulls count as empty texts, repeated rows stay, empty input gives an empty result.
    """
    small = counted(docs, F.col("doc_id")).select("doc_id", "c.*")
    small = materialize(small.select("*", *vote_columns(rules)), "quality")
    model = fit(small, len(rules))
    good = model.posterior()
    return small.select("*", base_failed().alias("base_failed"), good.alias("p_good"), (~base_failed() & (good >= threshold)).alias("kept"))


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES, threshold: float = 0.5) -> DataFrame:
    """docs without the documents that the rules reject, with the columns of docs.

    The counts are made twice, once for the vote patterns and once to apply the model: no text is shuffled or written.
    """
    model = fit(counted(docs).select("c.*").select(*vote_columns(rules)), len(rules))
    inner = counted(docs, F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"))
    inner = inner.select("row", "c.*").select("row", *COUNTS, *vote_columns(rules))
    return inner.where(~base_failed() & (model.posterior() >= threshold)).select("row.*")
