"""Alignment of cards with pages: how much of a card a page holds in the card's own order.

A positional word index tells on which pages, and where on them, the words of the cards stand. Matched places (place in
the card, place on the page) are seeds; the longest chain of seeds that rises on both sides is what the page confirms.
Its length over the words of the card is the confirmed share. Words added, lost or broken on the page cost just
themselves, and words that occur there in another order do not count.

cards: doc, card_id, words (array, in order). pages: doc, page, words.
"""

from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexweave.session import materialize

#: Share of a card's words that a page has to hold in order, at least, to be reported.
FLOOR = 0.82
FOUND = "doc string, card_id string, page long, matched long, words long"


def card_places(cards: DataFrame) -> DataFrame:
    """doc, card_id, i, word and total (words of the card): one row per word of a card."""
    return cards.select("doc", "card_id", F.size("words").cast("long").alias("total"), F.posexplode("words").alias("i", "word"))


def word_index(pages: DataFrame, words: DataFrame) -> DataFrame:
    """Positional index: doc, word, page and the places of the word there, for the words (doc, word) asked for.

    Other words leave right behind the scan. An entry holds the places of one word on one page.
    """
    held = pages.select("doc", "page", F.posexplode("words").alias("at", "word")).join(words, ["doc", "word"], "left_semi")
    return held.groupBy("doc", "word", "page").agg(F.sort_array(F.collect_list("at")).alias("places"))


def needed(total: Column, floor: float) -> Column:
    """Words that a chain must hold for a share of floor."""
    return F.greatest(F.ceil(total * floor - F.lit(1e-9)), F.lit(1)).cast("long")


def candidates(places: DataFrame, index: DataFrame, floor: float) -> DataFrame:
    """doc, card_id, page: every pair that can reach floor, and few others.

    A chain may leave out total - needed words of a card, so among one word more there is one that it holds. The words
    on the fewest pages are taken, wherever they stand in the card.
    """
    pages = index.groupBy("doc", "word").agg(F.count("*").alias("pages"))
    rarest = Window.partitionBy("doc", "card_id").orderBy(F.coalesce("pages", F.lit(0)), "word", "i")
    known = places.join(pages, ["doc", "word"], "left").withColumn("rank", F.row_number().over(rarest))
    keys = known.where((F.col("rank") <= F.col("total") - needed(F.col("total"), floor) + 1) & F.col("pages").isNotNull())
    return keys.select("doc", "card_id", "word").distinct().join(index.select("doc", "word", "page"), ["doc", "word"]).select("doc", "card_id", "page").distinct()


def longest_rise(steps: list[list[int]]) -> int:
    """Length of the longest strictly rising sequence that takes at most one place from each step, in the order of steps."""
    tops: list[int] = []
    for places in steps:
        # from the last place to the first, so that a step never follows itself
        for place in reversed(places):
            k = bisect_left(tops, place)
            tops[k : k + 1] = [place]
    return len(tops)


def chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        matched = [longest_rise(steps) for steps in batch.column(4).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(matched, pa.int64()), batch.column(3)], ["doc", "card_id", "page", "matched", "words"])


def align(cards: DataFrame, pages: DataFrame, floor: float = FLOOR) -> DataFrame:
    """doc, card_id, page, matched, words, share for all pairs with a share of at least floor (above 0).

    Cards and pages of different docs are not compared. Cards without words have no pairs. Pages come once each.
    """
    places = materialize(card_places(cards), "card-places")
    index = materialize(word_index(pages, places.select("doc", "word").distinct()), "word-index")
    pairs = materialize(candidates(places, index, floor), "aligned-candidates")
    # seeds of each pair: no more entries than the card has words
    seeds = pairs.join(places, ["doc", "card_id"]).join(index, ["doc", "word", "page"])
    held = seeds.groupBy("doc", "card_id", "page", "total").agg(F.sort_array(F.collect_list(F.struct("i", "places"))).getField("places").alias("steps"))
    held = held.where(F.size("steps") >= needed(F.col("total"), floor))
    rows = held.select("doc", F.col("card_id").cast("string"), F.col("page").cast("long"), "total", "steps").mapInArrow(chains, FOUND)
    kept = rows.where(F.col("matched") >= needed(F.col("words"), floor))
    return kept.withColumn("share", F.col("matched") / F.col("words"))
