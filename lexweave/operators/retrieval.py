"""Ranking of pages against questions and scoring against expected answers."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexweave.functions import text as X
from lexweave.session import materialize
from lexweave.sources.pages import aliases, listing, scalar

GRAM = 3
#: Pages for each place of a ranking from which its floor is taken.
SEEDS = 16


def page_search(pages: DataFrame) -> DataFrame:
    """path, names, links and searchable text of parsed pages."""
    lists = [listing(name) for name in ("wikilinks", "parent_chain", "child_clauses", "definitions")]
    singles = F.array_compact(F.array(*[scalar(name) for name in ("parent_clause", "source_clause", "instrument_slug")]))
    return pages.select(
        "path",
        F.coalesce(scalar("clause_id"), scalar("slug"), scalar("instrument_slug"), F.col("stem")).alias("target_id"),
        aliases().alias("aliases"),
        F.array_distinct(F.concat(*lists, singles)).alias("links"),
        F.concat_ws("\n", "stem", F.nullif("search", F.lit("")), "body").alias("haystack"),
    )


def has_inner_word(question: Column) -> Column:
    """The question has a word that neither starts nor ends it; every text holding the question holds that word."""
    return question.rlike(r"[^A-Za-z0-9][A-Za-z0-9]+[^A-Za-z0-9]")


def leading_gram(question: Column) -> Column:
    return F.substring(question, 1, GRAM)


def short_runs(chars: str, n: int) -> Column:
    """Runs of n characters (fewer at the end) from an array of characters."""
    return F.transform(
        F.sequence(F.lit(0), F.size(chars) - 1), lambda i: F.concat_ws("", *[F.get(chars, i + k) for k in range(n)])
    )


def inner_words_needed(question: Column) -> Column:
    """Distinct words that every text holding the question shares with it, at least."""
    bare = F.regexp_replace(F.regexp_replace(question, r"^[A-Za-z0-9]+", ""), r"[A-Za-z0-9]+$", "")
    return F.size(F.array_distinct(X.words(bare)))


def long_phrases(pages: DataFrame, questions: DataFrame, overlaps: DataFrame) -> DataFrame:
    """Pairs (question_id, path) where a question with an inner word occurs in the page text.

    Such a page shares all inner words of the question, so pairs that share fewer words never meet the page texts.
    """
    text = questions.select("question_id", F.lower("question").alias("question"))
    inner = text.where(has_inner_word(F.col("question"))).withColumn("needed", inner_words_needed(F.col("question")))
    likely = overlaps.join(inner, "question_id").where(F.col("overlap") >= F.col("needed"))
    hay = pages.select("path", F.lower("haystack").alias("hay"))
    return likely.join(hay, "path").where(F.contains("hay", "question")).select("question_id", "path")


def short_phrases(pages: DataFrame, questions: DataFrame) -> DataFrame:
    """The same for questions without an inner word: they may sit inside longer words and are found by three characters."""
    text = questions.select("question_id", F.lower("question").alias("question"))
    short = text.where(~has_inner_word(F.col("question")) & (F.col("question") != ""))
    hay = pages.select("path", F.lower("haystack").alias("hay"))
    if short.isEmpty():
        return short.select("question_id", F.lit(None).cast("string").alias("path")).where(F.lit(False))
    keyed = short.withColumn("gram", leading_gram(F.col("question")))
    spread = hay.select("path", F.split("hay", "").alias("_chars"))
    runs = F.concat(*[short_runs("_chars", n) for n in range(1, GRAM + 1)])
    exploded = spread.select("path", F.explode(F.array_distinct(runs)).alias("gram"))
    found = exploded.join(keyed, "gram").join(hay, "path").where(F.contains("hay", "question"))
    return found.select("question_id", "path").distinct()


def unsent(held: DataFrame) -> DataFrame:
    """held for a join that never sends it whole to every task by way of the driver.

    Words repeat from page to page, so that a file of them is a small part of their size in memory and would pass for a
    small table.
    """
    return held.hint("merge")


def by_rarity(asked: DataFrame, held: DataFrame) -> DataFrame:
    """question_id, word, pages (that hold it), ord (1 is the rarest) and n (words of the question that any page holds)."""
    known = asked.join(held.groupBy("word").agg(F.count("*").alias("pages")), "word")
    question = Window.partitionBy("question_id")
    return known.withColumns({"ord": F.row_number().over(question.orderBy("pages", "word")), "n": F.count("*").over(question)})


def overlaps_of(pairs: DataFrame, asked: DataFrame, held: DataFrame) -> DataFrame:
    """Words shared by each pair (question_id, path), of which none comes twice; pairs without any are left out.

    A pair meets the words of its question and those asked of its page as two lists, so that it is one row and not one for each word.
    A word that a question or a page has in several rows counts with each of them.
    """
    def listed(rows: DataFrame, key: str, name: str) -> DataFrame:
        lists = rows.groupBy(key).agg(F.collect_list("word").alias(name))
        return lists.withColumn(f"{name}_once", F.size(F.array_distinct(name)) == F.size(name))

    met = pairs.join(listed(asked, "question_id", "_asked"), "question_id").join(unsent(listed(held, "path", "_held")), "path")
    times = F.aggregate("_asked", F.lit(0), lambda n, w: n + F.size(F.filter("_held", lambda h: h == w)))
    shared = F.when(F.col("_asked_once") & F.col("_held_once"), F.size(F.array_intersect("_asked", "_held"))).otherwise(times)
    return met.select("question_id", "path", shared.cast("bigint").alias("overlap")).where("overlap > 0")


def score_floors(asked: DataFrame, held: DataFrame, questions: DataFrame, top_k: int) -> DataFrame:
    """question_id, needed (see inner_words_needed) and floor: pages with fewer shared words are not among its best, whatever else they hold.

    The pages that hold most of a question's rarest words, top_k of them, are scored in full; the least of these scores
    is a bound. Where the question as a whole may add to a score, the bound is not above the words that takes.
    """
    before = F.sum("pages").over(Window.partitionBy("question_id").orderBy("ord")) - F.col("pages")
    rare = asked.withColumn("before", before).where((F.col("before") < SEEDS * top_k) & (F.col("pages") <= SEEDS * SEEDS * top_k))
    met = rare.join(unsent(held), "word").groupBy("question_id", "path").agg(F.count("*").alias("met"))
    best = Window.partitionBy("question_id").orderBy(F.desc("met"), "path")
    near = met.withColumn("k", F.row_number().over(best)).where(F.col("k") <= top_k).select("question_id", "path")
    bound = overlaps_of(near, asked, held).groupBy("question_id").agg(F.when(F.count("*") >= top_k, F.min("overlap")).alias("bound"))
    text = F.lower("question")
    needed = F.when(has_inner_word(text), inner_words_needed(text))
    known = questions.select("question_id", needed.alias("needed")).join(bound, "question_id", "left")
    return known.select("question_id", "needed", F.greatest(F.least(F.coalesce("bound", F.lit(1)), "needed"), F.lit(1)).alias("floor"))


def contenders(asked: DataFrame, held: DataFrame, floors: DataFrame, top_k: int) -> DataFrame:
    """Pairs (question_id, path) that can be among the top_k of a question.

    The most frequent words of a question, half as many as its floor and at least one, are not looked up: a page that
    reaches the floor holds the rest of the floor among the others. Where the floor is one word, a page that holds only
    the most frequent word can count if it is among the first top_k of that word by path. So a word that is on all pages
    and in all questions brings top_k rows. Nothing is left out where a single word may carry the whole question.
    """
    left_out = F.when(F.coalesce("needed", F.lit(0)) == 1, F.lit(0)).otherwise(F.greatest(F.floor(F.col("floor") / 2), F.lit(1)))
    plan = asked.join(floors, "question_id").withColumn("last", F.col("n") - left_out)
    enough = F.greatest(F.col("floor") - left_out, F.lit(1))
    kept = plan.where("ord <= last").select("question_id", "word", enough.alias("enough"))
    found = kept.join(unsent(held), "word").groupBy("question_id", "path", "enough").agg(F.count("*").alias("met")).where("met >= enough")
    common = plan.where("floor = 1 and ord > last").select("question_id", "word")
    first = Window.partitionBy("word").orderBy("path")
    firsts = held.join(common.select("word").distinct(), "word", "left_semi").withColumn("k", F.row_number().over(first)).where(F.col("k") <= top_k)
    listed = common.join(firsts, "word").select("question_id", "path")
    return found.select("question_id", "path").unionAll(listed).distinct()


def rank_pages(pages: DataFrame, questions: DataFrame, top_k: int = 5) -> DataFrame:
    """Best pages per question: shared words, plus two when the whole question occurs; ties by path.

    pages: path, haystack. questions: question_id, question. Pages are scored in full only if they can be among the
    best; see contenders. The words of a page are read once.
    """
    asked = questions.select("question_id", F.explode(F.array_distinct(X.words(F.col("question")))).alias("word"))
    held = pages.select("path", F.explode(F.array_distinct(X.words(F.col("haystack")))).alias("word"))
    held = materialize(held.join(asked.select("word").distinct(), "word", "left_semi"), "asked-words")
    asked = materialize(by_rarity(asked, held), "asked")
    floors = materialize(score_floors(asked, held, questions, top_k), "floors")
    short = materialize(short_phrases(pages, questions), "short-phrases")
    pairs = contenders(asked, held, floors, top_k).unionAll(short).distinct()
    overlaps = materialize(overlaps_of(pairs, asked, held), "contenders")
    phrases = long_phrases(pages, questions, overlaps).unionAll(short)
    scored = (
        overlaps.unionByName(phrases.withColumn("overlap", F.lit(2).cast("bigint")))
        .groupBy("question_id", "path")
        .agg(F.sum("overlap").cast("double").alias("score"))
    )
    best = Window.partitionBy("question_id").orderBy(F.desc("score"), "path")
    ranked = scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top_k)
    # The empty question occurs everywhere: the first pages in path order (top_k of them), all with the phrase score.
    blank = questions.where(F.col("question") == "").select("question_id")
    if blank.isEmpty():
        return ranked
    first = F.array(*[F.lit(row.path) for row in pages.select("path").orderBy("path").take(top_k)]).cast("array<string>")
    listed = blank.select("question_id", F.posexplode(first).alias("rank", "path"))
    return ranked.unionByName(
        listed.select("question_id", "path", F.lit(2.0).alias("score"), (F.col("rank") + 1).alias("rank"))
    )


def identity_index(pages: DataFrame) -> DataFrame:
    """Page behind each name; the first page in path order wins."""
    named = pages.select("path", "links", F.explode("aliases").alias("alias"))
    order = F.split("path", "/")
    return named.groupBy("alias").agg(F.min_by(F.struct("path", "links"), order).alias("p")).select("alias", "p.*")


def evaluate(pages: DataFrame, questions: DataFrame, hits: DataFrame) -> DataFrame:
    """Expected identifiers a question misses, and whether it passes.

    A clause must exist and be among the hits; parents and definitions must exist and be linked from the page of an
    expected clause. questions: question_id, expected_clause_ids, expected_parent_ids, expected_definition_ids.
    """
    index = identity_index(pages)
    kinds = ("clause", "parent", "definition")
    expected = None
    for kind in kinds:
        part = questions.select(
            "question_id", F.lit(kind).alias("kind"), F.posexplode(f"expected_{kind}_ids").alias("ord", "alias")
        )
        expected = part if expected is None else expected.unionByName(part)
    hit_names = hits.join(pages.select("path", "aliases"), "path").select("question_id", F.explode("aliases").alias("alias"))
    hit_names = hit_names.distinct().withColumn("_hit", F.lit(True))
    clauses = expected.where("kind = 'clause'").select("question_id", "alias").distinct()
    linked = (
        clauses.join(index, "alias")
        .select("question_id", F.explode("links").alias("alias"))
        .distinct()
        .withColumn("_linked", F.lit(True))
    )
    known = index.select("alias", F.lit(True).alias("_known"))
    reached = F.when(F.col("kind") == "clause", F.col("_hit")).otherwise(F.col("_linked"))
    missing = (
        expected.join(known, "alias", "left")
        .join(hit_names, ["question_id", "alias"], "left")
        .join(linked, ["question_id", "alias"], "left")
        .where(F.col("_known").isNull() | reached.isNull())
    )
    entry = F.struct("ord", "alias")
    lists = missing.groupBy("question_id").agg(
        *[
            F.transform(
                F.sort_array(F.collect_list(F.when(F.col("kind") == kind, entry))), lambda e: e["alias"]
            ).alias(f"missing_{kind}_ids")
            for kind in kinds
        ]
    )
    out = questions.select("question_id").join(lists, "question_id", "left")
    empty = F.array().cast("array<string>")
    out = out.withColumns({f"missing_{k}_ids": F.coalesce(f"missing_{k}_ids", empty) for k in kinds})
    passed = F.size(F.concat(*[F.col(f"missing_{k}_ids") for k in kinds])) == 0
    return out.withColumn("passed", passed)
