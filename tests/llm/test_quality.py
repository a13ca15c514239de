import re
from collections import Counter

from pyspark.sql import functions as F

from lexweave.llm import quality
from tests.llm.helpers import WORD, docs, odd_texts, prose


def brute(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def corpus():
    good = ["\n".join(prose(100 * s + k, 12) + "." for k in range(8)) for s in range(60)]
    shout = [prose(s, 80).upper().replace(" ", "!! ") for s in range(300, 306)]
    marks = [prose(s, 80).replace(" ", "### ") for s in range(310, 316)]
    lines = ["\n".join([prose(s, 12)] * 9) for s in range(320, 326)]
    return good, shout + marks + lines


def test_counts(spark):
    texts = [*odd_texts(), "a b c a b c a b c", "a b c d a b c", "x\ny\nx\n\nx", "#a *b|c", "a a a a", "a a a"]
    made = docs(spark, texts).select("doc_id", quality.counts(F.col("text")).alias("c")).collect()
    assert {r["doc_id"]: tuple(r["c"][n] for n in quality.COUNTS) for r in made} == {i: brute(t) for i, t in enumerate(texts)}


def test_model_keeps_good_and_drops_junk(spark):
    good, junk = corpus()
    scored = quality.score(docs(spark, good + junk).withColumn("vote_0", F.lit("x"))).collect()
    assert {r["doc_id"] for r in scored if r["kept"]} == set(range(len(good)))
    short = quality.score(docs(spark, ["too short", None])).collect()
    assert [r["kept"] for r in short] == [False, False] and all(r["base_failed"] for r in short)


def test_em_matches_plain_arithmetic(spark):
    good, junk = corpus()
    table = quality.score(docs(spark, good + junk))
    model = quality.fit(table, len(quality.RULES), rounds=3)
    votes = Counter(tuple(r[f"vote_{k}"] for k in range(len(quality.RULES))) for r in table.collect())
    start = ({-1: 0.3, 0: 0.15, 1: 0.55}, {-1: 0.001, 0: 0.149, 1: 0.85})
    share, rates = 0.1, [start for _ in quality.RULES]
    for _ in range(3):
        weight = {}
        for pattern in votes:
            bad, fine = share, 1 - share
            for k, v in enumerate(pattern):
                bad, fine = bad * rates[k][0][v], fine * rates[k][1][v]
            weight[pattern] = fine / (bad + fine)
        total = {0: sum((1 - weight[p]) * n for p, n in votes.items()), 1: sum(weight[p] * n for p, n in votes.items())}
        after = []
        for k in range(len(rates)):
            pair = []
            for kind, (low, high) in ((0, (quality.LEAST_HIT, quality.MOST_HIT)), (1, (0.0, quality.MOST_FALSE))):
                raw = {v: (sum((weight[p] if kind else 1 - weight[p]) * n for p, n in votes.items() if p[k] == v) + start[kind][v]) / (total[kind] + 1) for v in (-1, 0, 1)}
                bad = min(max(raw[-1], low), high)
                pair.append({-1: bad, 0: raw[0] * (1 - bad) / (raw[0] + raw[1]), 1: raw[1] * (1 - bad) / (raw[0] + raw[1])})
            after.append(tuple(pair))
        share, rates = (total[0] + 0.1) / (total[0] + total[1] + 1), after
    assert abs(model.share - share) < 1e-9
    assert all(abs(model.rates[k][kind][v] - rates[k][kind][v]) < 1e-9 for k in range(len(rates)) for kind in (0, 1) for v in (-1, 0, 1))


def test_filter_keeps_columns_and_handles_empty(spark):
    good, junk = corpus()
    table = docs(spark, good + junk).withColumn("n_words", F.lit("clash")).withColumn("row", F.lit(1)).withColumn("c", F.lit(2))
    kept = quality.keep_good(table.unionAll(table))
    assert kept.columns == table.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(2 * list(range(len(good))))
    assert quality.keep_good(table.where("doc_id < 0")).count() == 0 and quality.score(table.where("doc_id < 0")).count() == 0
