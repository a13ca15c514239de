import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexweave.llm import simhash
from lexweave.llm.common import contracted, least_reachable
from tests.llm.helpers import components, docs, fingerprint, odd_texts, prose


def test_fingerprints_follow_the_rule(spark):
    texts = [*odd_texts(), "A b C", "ÉA İx y z", "x  y\x1cz q"]
    found = {r["doc_id"]: r["fp"] & (1 << 64) - 1 for r in simhash.fingerprints(docs(spark, texts)).collect()}
    assert found == {i: fingerprint(t) for i, t in enumerate(texts)}


def test_gray_neighbours_differ_in_one_bit():
    codes = np.array([i ^ i >> 1 for i in range(1000)], np.uint64)
    assert (simhash.gray_rank(codes) == np.arange(1000)).all()


@pytest.mark.parametrize("seed,buckets", [(0, 1), (1, 7), (2, 300)])
def test_index_finds_all_pairs(seed, buckets):
    draw = random.Random(seed)
    codes = [draw.getrandbits(64) for _ in range(40)]
    codes += [c ^ (1 << draw.randrange(64)) ^ (1 << draw.randrange(64)) ^ (draw.random() < 0.5) for c in codes for _ in range(6)]
    codes = np.array(sorted(set(codes)), np.uint64)
    bucket = np.array([int(c) % buckets for c in codes])
    order = np.lexsort((simhash.gray_rank(codes), bucket))
    index = simhash.GrayIndex(bucket[order], codes[order])
    got = {tuple(sorted((int(index.codes[a]), int(index.codes[b])))) for q, o in index.pairs(np.arange(len(codes)), 3) for a, b in zip(q, o)}
    want = {(int(a), int(b)) for a in codes for b in codes if a < b and int(a) % buckets == int(b) % buckets and (int(a) ^ int(b)).bit_count() <= 3}
    assert got == want


@pytest.mark.parametrize("large", [1, 10_000])
def test_links_close_to_all_components(spark, large):
    draw = random.Random(5)
    base = [draw.getrandbits(64) for _ in range(30)]
    codes = set(base)
    for c in base[:12]:
        for _ in range(10):
            c ^= 1 << draw.randrange(64)
            codes.add(c)
    signed = lambda c: c - (1 << 64) if c >> 63 else c
    prints = spark.createDataFrame([(signed(c), signed(c), 0) for c in codes], "node long, fp long, bucket long")
    links = simhash.near_links(prints, 3, large=large)
    roots = {r["node"]: r["root"] for r in least_reachable(links).collect()}
    want = components([signed(c) for c in codes], lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 3)
    assert {n: roots.get(n, n) for n in want} == want


def test_chain_of_links(spark):
    chain = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r["root"] for r in least_reachable(chain).collect()} == {0}
    assert least_reachable(chain.where("a < 0")).count() == 0


def test_documents_and_duplicates(spark):
    texts = [*odd_texts(), prose(9, 300), prose(9, 300), prose(9, 300).replace("a", "A"), prose(10, 300)]
    table = docs(spark, texts, start=5).withColumn("fp", F.lit("clash")).withColumn("kept_hash", F.lit(1))
    found = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(table).collect()}
    prints = {5 + i: fingerprint(t) for i, t in enumerate(texts)}
    assert found == components(list(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    kept = simhash.deduplicate(table.unionAll(table))
    assert kept.columns == table.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(found.values()))


def test_null_ids_and_empty_input(spark):
    same = prose(3, 100)
    table = spark.createDataFrame([(None, same), (7, same), (None, prose(4, 100)), (None, prose(4, 100))], "doc_id long, text string")
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in simhash.near_duplicates(table).collect()) == [(0, 0), (0, 0), (0, 7), (7, 7)]
    assert sorted(r["doc_id"] or 0 for r in simhash.deduplicate(table).collect()) == [0, 7]
    assert simhash.deduplicate(table.where("doc_id = 1")).count() == 0


def test_tables_find_more_near_copies(spark):
    words = prose(21, 400).split(" ")
    draw = random.Random(2)
    texts = [" ".join(words)]
    for _ in range(12):
        copy = list(words)
        for at in draw.sample(range(400), 4):
            copy[at] = "changed" + str(draw.random())
        texts.append(" ".join(copy))
    texts += [prose(s, 400) for s in range(500, 520)]
    few = simhash.deduplicate(docs(spark, texts)).count()
    kept = {r["doc_id"] for r in simhash.deduplicate(docs(spark, texts), distance=4, tables=12).collect()}
    assert few > 21 and kept == {0, *range(13, 33)}
    first = simhash.simhashes(texts[0], tables=5)
    assert first[0] == fingerprint(texts[0]) and len(set(first)) == 5
    apart = [[(a ^ b).bit_count() for a, b in zip(first, simhash.simhashes(t, tables=5))] for t in texts[13:]]
    assert all(20 < np.mean(d) < 44 for d in apart)


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_contracted_components(spark, seed):
    draw = random.Random(seed)
    nodes = draw.sample(range(10**6), 120)
    edges = [draw.sample(nodes, 2) for _ in range(70)] + [(nodes[0], n) for n in nodes[1:20]] + [(nodes[3], nodes[3])]
    edges += [(1000 + k, 1001 + k) for k in range(300)] + [(9000 - k, 8999 - k) for k in range(0, 200, 2)] + edges[:5]
    found = {r["node"]: r["root"] for r in contracted(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {frozenset(e) for e in edges}
    known = sorted({n for a, b in edges if a != b for n in (a, b)})
    label = {n: n for n in known}
    while True:
        before = dict(label)
        for a, b in (tuple(e) for e in linked if len(e) == 2):
            label[a] = label[b] = min(label[a], label[b])
        if before == label:
            break
    assert found == label


def test_contracted_without_links(spark):
    assert contracted(spark.createDataFrame([(1, 1)], "a long, b long")).collect() == []


def test_tables_unite_nodes_that_share_or_nearly_share_a_fingerprint(spark):
    draw = random.Random(8)
    base = [draw.getrandbits(63) for _ in range(30)]
    codes = {}
    for node in range(90):
        codes[node] = [base[(node + 7 * t) % 30] ^ (draw.random() < 0.3) << draw.randrange(60) if draw.random() < 0.4 else draw.getrandbits(63) for t in range(3)]
    rows = [(node, code, t) for node, made in codes.items() for t, code in enumerate(made)]
    found = {r["node"]: r["root"] for r in simhash.joined_tables(spark.createDataFrame(rows, "node long, fp long, bucket long"), 2).collect()}
    want = components(list(codes), lambda a, b: any((x ^ y).bit_count() <= 2 for x, y in zip(codes[a], codes[b])))
    assert {n: found.get(n, n) for n in codes} == want
