import hashlib
import re
import zlib

import pytest
from pyspark.sql import functions as F

from lexweave.llm import prefix_trie as pt
from tests.llm.helpers import prose

TURNS = "conv_id long, turn long, role string, text string, depth long, n_convs string, pos double"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def order(row):
    _, turn, role, text = row
    role, text = role or "", text or ""
    return (turn is not None, turn or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:30])


def brute(rows):
    own = {}
    for row in sorted((r for r in rows if r[0] is not None), key=order):
        own.setdefault(row[0], []).append((row[2] or "", row[3] or ""))
    made = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        made[c] = tuple(own.get(c - c % 20, [])[:h] + mine[h:])
    paths = {turns[:d] for turns in made.values() for d in range(len(turns) + 1)}
    out = []
    members = {p: sorted(c for c, turns in made.items() if turns[: len(p)] == p) for p in paths}
    for p in paths:
        below = [q for q in paths if q[: len(p)] == p]
        leaves = [q for q in below if not any(len(r) == len(q) + 1 and r[: len(q)] == q for r in below)]
        saved = sum((len(members[q]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", q[-1][1])) for q in below if q)
        ends = ",".join(str(c) for c in members[p] if made[c] == p)
        out.append(
            (members[p][0], len(p), members[p[:-1]][0] if p else None, len(members[p]), sum(len(q) == len(p) + 1 for q in below), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(out, key=str)


def run(spark, rows):
    table = spark.createDataFrame([(*r, 1, "clash", 0.5) for r in rows], TURNS)
    return sorted((tuple(r) for r in pt.prefix_trie(table).select(COLUMNS).collect()), key=str)


def talk(c, texts, start=0):
    return [(c, start + k, "user" if k % 2 == 0 else "assistant", t) for k, t in enumerate(texts)]


def test_shared_blocks_and_branches(spark):
    whole = [prose(k, 3 + k % 4) for k in range(11)]
    rows = []
    for c in range(60, 85):
        rows += talk(c, whole[: 1 + c % 11] + ([prose(c, 4)] if c % 3 else []))
    rows += talk(100, whole) + talk(120, whole[:8]) + talk(121, whole[:8]) + talk(142, whole[:1]) + talk(163, [])
    assert run(spark, rows) == brute(rows)


def test_nulls_ties_repeats_and_odd_texts(spark):
    rows = [
        (0, None, None, None), (0, None, "user", "first"), (0, 3, "user", ""), (0, 3, "user", ""), (0, 3, "a", "x y"), (0, 3, "ax", " y"),
        (None, 1, "user", "nobody"), (1, 0, "user", None), (2, 0, None, "Ab\x0bcd\x85ef"), (3, 5, "user", "word " * 5000), (4, -2, "user", "one"), (4, -1, "user", "two"),
        (40, 0, "user", "same"), (41, 0, "user", "same"), (42, 0, "user", "same"), (43, 0, "user", "same"), (10**15, 0, "user", "far"), (10**15 + 7, 0, "user", "far"),
    ]
    assert run(spark, rows) == brute(rows)


def test_long_conversations_go_through_segments(spark, monkeypatch):
    monkeypatch.setattr(pt, "SEGMENT", 8)
    monkeypatch.setattr(pt, "PIECE", 20)
    whole = [f"t{k} {'w ' * (k % 5)}" for k in range(70)]
    rows = talk(20, whole) + talk(25, whole) + talk(31, whole[:40] + ["other"] * 9) + talk(40, whole[:17]) + talk(47, whole[:64])
    rows += [r for c in range(200, 240) for r in talk(c, ["hello", "copy of all", "end"])]
    assert run(spark, rows) == brute(rows)


def test_empty_and_turnless(spark):
    assert run(spark, []) == []
    c = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 3)
    assert run(spark, talk(c, ["gone", "too"])) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_blocks_without_siblings_are_not_refined(spark):
    rows = [r for c in range(0, 80, 20) for r in talk(c, [f"t{k}" for k in range(12)])]
    placed = pt.placed(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    cut = pt.blocks(pt.rebuilt(placed)[0])
    assert cut.select("block", "p1", "p2", "steps").distinct().count() == 3
    found = pt.nodes(cut.withColumn("n_convs", F.lit(1)), ["n_convs"])
    assert [r["n_convs"] for r in found.collect()] == [4] * 12


@pytest.mark.parametrize("c", [0, 1, 19, 20, 12345, 10**12])
def test_h_is_the_crc_of_the_decimal(spark, c):
    got = spark.range(1).select(F.crc32(F.lit(c).cast("string")).alias("h")).first()["h"]
    assert got == zlib.crc32(str(c).encode())
