import random

import pytest

from lexweave.operators import alignment as L
from lexweave.operators import asof


@pytest.fixture(params=[1, 3, 40])
def partitions(spark, request):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(request.param))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", old)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def rows(seed, n):
    """One group holds most of the rows, others few, some keys are null."""
    made = random.Random(seed)
    return [(made.choice(["hot"] * 12 + ["a", "b", None]), made.randint(0, 9) if made.random() < 0.9 else None, made.randint(0, n)) for _ in range(n)]


def test_places_count_along_every_group(spark, partitions):
    data = rows(1, 400)
    got = asof.places(spark.createDataFrame(data, "doc string, k int, at int"), ["doc"], ["at", "k"], "place").collect()
    by = {}
    for r in got:
        by.setdefault(r["doc"], []).append((r["place"], r["at"], -1 if r["k"] is None else r["k"]))
    assert {doc: len(v) for doc, v in by.items()} == {doc: sum(d == doc for d, _, _ in data) for doc in by}
    for found in by.values():
        found.sort()
        assert [p for p, _, _ in found] == list(range(len(found)))
        assert [x[1:] for x in found] == sorted(x[1:] for x in found)


@pytest.mark.parametrize("keys", [["doc"], ["doc", "k"]])
def test_next_behind_is_the_least_place_behind(spark, partitions, keys):
    data, marks = rows(2, 300), rows(3, 60)
    left = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "id int, doc string, k int, at int")
    right = spark.createDataFrame(marks, "doc string, k int, at int")
    got = {r["id"]: r["behind"] for r in asof.next_behind(left, right, keys, "at", "behind").collect()}
    assert len(got) == len(data)
    for i, (doc, k, at) in enumerate(data):
        later = [m for d, j, m in marks if d == doc and (keys == ["doc"] or j == k) and m > at]
        assert got[i] == (min(later) if later else None), (i, doc, k, at)


def test_asof_on_empty_tables(spark):
    empty = spark.createDataFrame([], "doc string, at int")
    one = spark.createDataFrame([("d", 1)], "doc string, at int")
    assert asof.places(empty, ["doc"], ["at"], "place").collect() == []
    assert asof.next_behind(empty, one, ["doc"], "at", "behind").collect() == []
    assert [r["behind"] for r in asof.next_behind(one, empty, ["doc"], "at", "behind").collect()] == [None]


def longest_common(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_alignment_is_the_longest_common_sequence(spark):
    made = random.Random(5)
    pages = [("d", p, made.choices("a b c the of x y z".split(), k=made.randint(0, 60))) for p in range(40)]
    cards = [("d", f"c{c}", made.choices("a b c the of x y z q".split(), k=made.randint(0, 12))) for c in range(25)]
    for c in range(25, 40):
        page = pages[c][2]
        cards.append(("d", f"c{c}", [w for w in page if made.random() > 0.1] + ["lost"] * made.randint(0, 3)))
    cards += [("e", "other", ["a"]), ("d", "the", ["the"] * 9)]
    for floor in (0.5, 0.82, 1.0):
        found = L.align(spark.createDataFrame(cards, "doc string, card_id string, words array<string>"), spark.createDataFrame(pages, "doc string, page int, words array<string>"), floor)
        got = {(r["card_id"], r["page"]): (r["matched"], r["words"]) for r in found.collect()}
        want = {}
        for doc, c, words in cards:
            for other, p, held in pages:
                n = longest_common(words, held)
                if doc == other and n and n / len(words) >= floor - 1e-12:
                    want[c, p] = (n, len(words))
        assert got == want


def test_longest_rise():
    assert L.longest_rise([]) == 0
    assert L.longest_rise([[5], [1, 6], [2], [3, 4]]) == 3
    assert L.longest_rise([[1, 2, 3]] * 3) == 3 and L.longest_rise([[1, 2, 3]]) == 1
