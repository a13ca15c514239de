import hashlib
import math

import pytest
from pyspark.sql import functions as F

from lexweave.llm import mixing
from tests.llm.helpers import docs


def quantile(u, rate):
    p = total = math.exp(-rate)
    k = 0
    while u >= total and k < 5000:
        k += 1
        p *= rate / k
        total += p
    return k


def drawn(seed, doc):
    return int(hashlib.md5(f"{seed}:{doc}".encode()).hexdigest()[:13], 16) / (1 << 52)


def test_copies_are_poisson_quantiles(spark):
    table = docs(spark, ["t"] * 400, source=lambda i: "hot" if i % 4 else f"s{i % 5}")
    n = {}
    for r in table.collect():
        n[r["source"]] = n.get(r["source"], 0) + 1
    scale = 400 / sum(math.sqrt(v) for v in n.values())
    want = sorted((r["doc_id"], c) for r in table.collect() for c in range(quantile(drawn("7", r["doc_id"]), scale * math.sqrt(n[r["source"]]) / n[r["source"]])))
    made = mixing.mix(table, seed="7", named=True)
    assert sorted((r["doc_id"], r["copy"]) for r in made.collect()) == want
    assert mixing.mix(table, seed="7").columns == table.columns


def test_targets_are_met(spark):
    table = docs(spark, ["t"] * 3000, source=lambda i: "big" if i % 10 else "small")
    made = mixing.mix(table, weights={"big": 1, "small": 1}, total=4000).groupBy("source").count().collect()
    assert all(abs(r["count"] - 2000) < 250 for r in made) and len(made) == 2
    assert mixing.mix(table, weights={"big": 1}).where("source = 'small'").count() == 0
    with pytest.raises(ValueError, match="700"):
        mixing.mix(table, total=10_000_000)


def test_odd_rows(spark):
    table = docs(spark, [None, "a", "a", ""]).withColumns({"rate": F.lit("clash"), "Copy": F.lit(1), "source": F.lit(None).cast("string")})
    table = table.unionAll(table.withColumn("doc_id", F.lit(None).cast("long")))
    made = mixing.mix(table, total=80)
    assert made.columns == table.columns and made.where("doc_id is null").count() % 4 == 0 and made.where("doc_id = 1").count() == quantile(drawn("0", 1), 10.0)
    assert mixing.mix(table.where("doc_id < 0")).count() == 0


def test_large_rate_table_is_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SMALL_RATES", 0)
    table = docs(spark, ["t"] * 50, source=lambda i: f"s{i % 3}")
    made = mixing.mix(table)
    monkeypatch.undo()
    assert sorted(r["doc_id"] for r in made.collect()) == sorted(r["doc_id"] for r in mixing.mix(table).collect())
