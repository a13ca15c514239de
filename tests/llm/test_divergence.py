from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from lexweave.llm import divergence as dv
from tests.llm.helpers import docs, prose

DOCS = "doc_id long, text string, lang string, source string, term string, n long, p double"
SCALE = 10**9


def words(text):
    made, word = [], ""
    for c in [*(text or ""), " "]:
        if "a" <= c.lower() <= "z" and ord(c) < 128 or ord(c) >= 128:
            word += c.lower() if ord(c) < 128 else c
        elif word:
            made.append(word)
            word = ""
    return made


def brute(rows, min_docs=3, top=200):
    """Every share of every kept term in every group, and every pair, term by term."""
    rows = [(lang or "", source or "", words(text)) for _, text, lang, source in rows]
    out = []
    for lang in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == lang]
        held = Counter(w for r in mine for w in set(r[2]))
        kept = sorted(w for w in held if held[w] >= min_docs)

        def shares(of):
            n = Counter(w for r in of for w in r[2] if w in set(kept))
            return n, {w: 1 + SCALE * (n[w] + 1) // (sum(n.values()) + len(kept)) for w in kept}

        _, q = shares(mine)
        groups = {s: shares([r for r in mine if r[1] == s]) for s in {r[1] for r in mine}}
        for s, (n, p) in groups.items():
            pairs = [(t, sum((p[w] - o[w]) ** 2 // o[w] for w in kept)) for t, (_, o) in groups.items() if t != s]
            terms = [(w, (p[w] - q[w]) ** 2 // q[w]) for w in kept if n[w] and p[w] > q[w]]
            for part, found, last in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda r: (-r[1], r[0].encode()))
                out += [(lang, s, part, item, value, k) for k, (item, value) in enumerate(found[:last], start=1)]
    return sorted(out)


def run(spark, rows, **more):
    table = spark.createDataFrame([(*r, "clash", 7, 0.5) for r in rows], DOCS)
    return sorted(tuple(r) for r in dv.divergence(table, **more).collect())


ROWS = [
    (1, "The cat sat. THE cat ran; the dog", "en", "a"),
    (2, "the cat and the bird, Äpfel äpfel", "en", "b"),
    (3, "a cat, the cat! the end the the", "en", "a"),
    (4, None, "en", "c"),
    (5, "", "en", None),
    (5, "", "en", None),
    (6, "der hund und der hund", "de", "a"),
    (7, "12 34 !?", "de", "b"),
    (8, "the cat", None, None),
    (9, "the cat", None, "x"),
    (None, "the cat", None, "x"),
    (10, "Äpfel Äpfel the É\u0080x", "en", "b"),
    (11, "Äpfel bird bird the É\u0080x", "en", "d"),
    (12, "É\u0080x", "en", "d"),
    (13, "solo solo", "xx", "only"),
]


def test_terms():
    assert [w.decode() for w in dv.terms("It's A_b9Ç[Ü]\U0001f600x^y`z{q}\x7fr")] == words("It's A_b9Ç[Ü]\U0001f600x^y`z{q}\x7fr")
    assert dv.terms(None) == []


def test_equals_brute_force(spark):
    assert run(spark, ROWS) == brute(ROWS)
    assert run(spark, ROWS, min_docs=1, top=2) == brute(ROWS, 1, 2)


def test_a_hot_source_and_long_texts(spark, monkeypatch):
    monkeypatch.setattr(dv, "PAIRS", 5)
    rows = [(i, prose(i % 40, 30), ("en", "de")[i % 3 == 0], "hot" if i % 2 else f"s{i % 7}") for i in range(160)]
    rows += [(1000, "word " * 20000 + prose(3, 2000), "en", "long")] * 2
    assert run(spark, rows) == brute(rows)


def test_empty(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None, None, None)]) == []


def test_vectors_and_sums_are_those_of_the_library(spark):
    texts = [prose(i % 9, 40) for i in range(60)]
    rows = docs(spark, texts, source=lambda i: f"s{i % 4}").withColumn("words", F.split("text", " "))
    model = CountVectorizer(inputCol="words", outputCol="v", minDF=3, vocabSize=2**31 - 1).fit(rows)
    sums = model.transform(rows).groupBy("source").agg(Summarizer.sum(F.col("v")).alias("v")).collect()
    want = {(r["source"], w): int(n) for r in sums for w, n in zip(model.vocabulary, r["v"].toArray()) if n}
    got = {(r["source"], r["term"]): r["n"] for r in dv.kept_sums(rows).where("term <> ''").collect()}
    assert got == want


def test_sums_are_handed_on_when_full(monkeypatch):
    monkeypatch.setattr(dv, "FULL", 50)
    texts, whole, found = [prose(i % 13, 25) for i in range(90)], Counter(), Counter()
    for text in texts:
        whole.update(text.split())
    sums = dv.GroupSums()
    for at in range(0, 90, 10):
        sums.add(["en"] * 10, ["s"] * 10, texts[at : at + 10])
        if sums.full() or at == 80:
            for row in pa.Table.from_batches(sums.batches()).to_pylist():
                found[row["term"]] += row["n"]
            sums = dv.GroupSums()
    assert found.pop("") == 0 and found == whole


def test_merged():
    keys, n = dv.merged(np.array([3, 1, 3, 2]), np.array([1, 2, 3, 4]))
    assert keys.tolist() == [1, 2, 3] and n.tolist() == [2, 4, 4]
