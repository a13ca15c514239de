import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lexweave.llm import packing
from tests.llm.helpers import docs, odd_texts, prose

PATH = public_tokenizers.path("word_bpe_49k.json")


def check_places(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in by.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return by


def test_pieces_are_the_tokenizers_ids(spark):
    texts = [*odd_texts(), prose(2, 5000)]
    packed = packing.pack_documents(docs(spark, texts), PATH).collect()
    check_places(packed, 2048)
    own = Tokenizer.from_file(PATH)
    for i, text in enumerate(texts):
        ids = np.array(own.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        pieces = sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packed if r["doc_id"] == i)
        assert [p[0] for p in pieces] == list(range(-(-len(ids) // 2048)))
        assert [(s, n, c) for _, s, n, c in pieces] == [(a, len(ids[a : a + 2048]), zlib.crc32(ids[a : a + 2048].tobytes())) for a in range(0, len(ids), 2048)]


def test_sequences_hold_their_ids(spark):
    pieces = packing.token_pieces(docs(spark, [prose(s, 300) for s in range(6)]), PATH, capacity=256, with_ids=True)
    packed = packing.pack(pieces, 256)
    made = {r["sequence_id"]: r for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        assert bytes(made[r["sequence_id"]]["ids"])[4 * r["offset"] : 4 * (r["offset"] + r["length"])] == bytes(r["ids"])


@pytest.mark.parametrize("seed", range(4))
def test_search_never_loses_items_or_adds_bins(seed):
    draw = np.random.default_rng(seed)
    sizes = draw.integers(1, 101, 300)
    before = packing.best_fit(sizes, 100)
    after = packing.improve([list(b) for b in before], sizes, 100)
    assert sorted(i for b in after for i in b) == list(range(300))
    assert max(sizes[b].sum() for b in after) <= 100
    assert len(after) <= len(before)


def test_exchanges_empty_a_bin():
    # one for one: 6 for 5 fills the second bin and leaves 5 for the space that the third has
    assert len(packing.improve([[0], [1, 2], [3]], np.array([6, 5, 4, 5]), 10)) == 2
    sizes = np.random.default_rng(9).integers(1, 60, 80)
    before = packing.best_fit(sizes, 100)
    after = packing.improve([list(b) for b in before], sizes, 100)
    assert sum(int(sizes[b].sum()) ** 2 for b in after) >= sum(int(sizes[b].sum()) ** 2 for b in before)


def test_edges(spark):
    empty = docs(spark, [])
    assert packing.pack_documents(empty, PATH).count() == 0
    table = spark.createDataFrame([(1, None, 7, 8), (2, 10, 7, 8), (2, 10, 7, 8), (3, 0, 7, 8)], "id long, length long, offset int, pack_group int")
    made = packing.pack(table, 10).collect()
    check_places([r.asDict() | {"length": r["length"] or 0} for r in made], 10)
    assert len(made) == 4 and {r["pack_group"] for r in made} == {8} and len({r["sequence_id"] for r in made if r["length"]}) == 2
    with pytest.raises(Exception, match="lengths must be"):
        packing.pack(table.withColumn("length", F.lit(11)), 10).collect()


def test_groups_are_filled_alike_whatever_the_keys(spark):
    same = spark.range(4000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(300).cast("long").alias("length"))
    made = packing.pack(same, 2048, group_rows=500).collect()
    assert len(check_places(made, 2048)) <= 4000 / 6 + 8
