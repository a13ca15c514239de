"""Audit of unit cards against the pages of their source.

cards: doc, card_id, unit_type, source_text, page_start, page_end, parent_chain, child_ids, warning_ids.
pages: doc, page, text.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexweave.functions import patterns as P
from lexweave.functions import text as X
from lexweave.operators import asof
from lexweave.operators.retrieval import short_runs
from lexweave.session import materialize, passing

# Thresholds of the page confirmation and of the verdict.
LONG_TEXT_WORDS, EDGE_WORDS = 14, 8
TEXT_COVERAGE, LINE_COVERAGE, SHORT_LINE_WORDS = 0.82, 0.9, 5
RECALL_FLOOR, SEGMENT_SLACK, ANCHOR_PAGES, NEAR_LINES = 0.78, 8, 3, 6
REPEATABLE_WORDS = 8


def clean_page_lines(text: Column) -> Column:
    """Trimmed lines without blank lines and printed page numbers."""
    return F.filter(F.transform(X.split_lines(text), X.strip), lambda line: (line != "") & ~line.rlike(r"(?U)^\d+$"))


def first_words(normal: Column) -> Column:
    return F.array_join(F.slice(F.split(normal, " "), 1, EDGE_WORDS), " ")


def last_words(normal: Column) -> Column:
    return F.array_join(F.slice(F.split(normal, " "), -EDGE_WORDS, EDGE_WORDS), " ")


def is_long(normal: Column) -> Column:
    return F.size(F.split(normal, " ")) >= LONG_TEXT_WORDS


def normal_pages(pages: DataFrame) -> DataFrame:
    """Pages with their normal form and distinct words."""
    return with_words(pages.withColumn("hay", X.audit_norm(F.col("text"))))


def with_words(pages: DataFrame) -> DataFrame:
    """Pages in normal form (hay) with their distinct words."""
    return pages.withColumn("hay_words", F.array_distinct(X.audit_words(F.col("hay"))))


def normal_cards(cards: DataFrame) -> DataFrame:
    lines = F.filter(F.transform(X.split_lines(F.col("source_text")), X.strip), lambda line: line != "")
    entry = lambda n: F.struct(n.alias("n"), X.audit_words(n).alias("words"))
    return cards.select(
        "doc", "card_id", X.audit_norm(F.col("source_text")).alias("needle"),
        F.transform(F.transform(lines, X.audit_norm), entry).alias("lines"),
    ).withColumn("words", X.audit_words(F.col("needle")))


def coverage(words: Column, present: Column) -> Column:
    return F.size(F.filter(words, lambda w: F.array_contains(present, w))) / F.size(words)


def inner_words(text: Column) -> Column:
    """Words of a text that do not touch its ends: whole words of any text that contains it."""
    trimmed = F.regexp_replace(F.regexp_replace(text, r"^[a-z0-9]+", ""), r"[a-z0-9]+$", "")
    return X.audit_words(trimmed)


def word_keys(words: Column) -> Column:
    """Words as numbers that stand for them and their document. Two words that share a number only bring more candidates."""
    return F.transform(words, lambda w: F.xxhash64(F.col("doc"), w))


def held_words(pages: DataFrame, words: Column) -> DataFrame:
    """What each page holds: _key, page."""
    known = pages.where(F.col("doc").isNotNull() & F.col("page").isNotNull())
    each = known.select("doc", "page", F.explode(words).alias("_w"))
    return each.select(F.xxhash64("doc", "_w").alias("_key"), "page")


def search_keys(cards: DataFrame, frequency: DataFrame) -> DataFrame:
    """Words of which a page must hold at least one to be confirmed for a card: _c, _key.

    Each way of confirmation gives words and a number of them that is enough: one inner word for containment (of the
    whole text, or of its first or last words), and for coverage so many that not all of them may be missing. The
    rarest words are taken, so common words hardly ever become keys. A card's words are counted once, whatever number of
    ways they serve, and move as numbers.
    """
    cards = with_longest_line(cards.where(F.col("doc").isNotNull() & F.col("card_id").isNotNull()))
    needle, line = F.col("needle"), F.col("_line.n")
    # sorted words lie in runs, which gives each word and how often it occurs (m); words of the line alone have m = 0
    runs = cards.withColumn("_s", F.sort_array("words"))
    runs = runs.withColumn("_starts", F.filter(F.transform("_s", lambda w, i: F.when((i == 0) | (w != F.get("_s", i - 1)), i)), lambda i: i.isNotNull()))
    run = F.transform("_starts", lambda at, j: F.struct(F.xxhash64("doc", F.get("_s", at)).alias("_key"), (F.coalesce(F.get("_starts", j + 1), F.size("_s")) - at).alias("m")))
    rest = F.transform(F.array_except("_line.words", "words"), lambda w: F.struct(F.xxhash64("doc", w).alias("_key"), F.lit(0).alias("m")))
    each = runs.select("_c", F.explode(F.when(line.isNull(), run).otherwise(F.concat(run, rest))).alias("_w")).select("_c", "_w.*")
    counted = each.join(frequency, "_key", "left")
    ranked = counted.groupBy("_c").agg(F.sort_array(F.collect_list(F.struct(F.coalesce("pages", F.lit(0)).alias("n"), "_key", "m"))).alias("_all"))
    slack = lambda words, share: (F.floor(F.size(words) * (1 - share) + 1e-9) + 1).cast("int")
    taken = lambda words, enough, when: F.when(when, F.slice(F.array_intersect(F.col("_all").getField("_key"), word_keys(words)), F.lit(1), enough))
    # a word that occurs often counts as often towards what is enough
    enough = slack(F.col("words"), TEXT_COVERAGE)
    none = F.struct(F.lit(0).alias("m"), F.lit(0).alias("k"))
    first = F.aggregate("_all", none, lambda a, w: F.when(a["m"] >= enough, a).otherwise(F.struct((a["m"] + w["m"]).alias("m"), (a["k"] + 1).alias("k"))), lambda a: a["k"])
    one, yes = F.lit(1), F.lit(True)
    scopes = F.array(
        taken(inner_words(needle), one, yes),
        taken(F.col("words"), one, F.size("words") <= SHORT_LINE_WORDS),
        taken(inner_words(first_words(needle)), one, is_long(needle)),
        taken(inner_words(last_words(needle)), one, is_long(needle)),
        F.when(is_long(needle), F.filter(F.slice("_all", F.lit(1), first), lambda w: w["m"] > 0).getField("_key")),
        taken(inner_words(line), one, line.isNotNull()),
        taken(inner_words(first_words(line)), one, line.isNotNull() & is_long(line)),
        taken(inner_words(last_words(line)), one, line.isNotNull() & is_long(line)),
        taken(F.col("_line.words"), slack(F.col("_line.words"), LINE_COVERAGE), line.isNotNull()),
    )
    return cards.join(ranked, "_c").select("_c", F.explode(F.array_distinct(F.flatten(F.array_compact(scopes)))).alias("_key"))


def confirmed(present: Column) -> Column:
    """The page confirms the card: containment, short heading, every line, first or last words, or word coverage.

    present: the distinct words of the page.
    """
    needle, words, hay = F.col("needle"), F.col("words"), F.col("hay")
    holds_all = lambda ws: F.forall(ws, lambda w: F.array_contains(present, w))
    edges = lambda n: is_long(n) & (F.contains(hay, first_words(n)) | F.contains(hay, last_words(n)))
    line_ok = lambda e: (
        F.contains(hay, e["n"])
        | (F.size(e["words"]) == 0)
        | ((F.size(e["words"]) <= SHORT_LINE_WORDS) & holds_all(e["words"]))
        | edges(e["n"])
        | (coverage(e["words"], present) >= LINE_COVERAGE)
    )
    heading = (
        (F.size(words) <= SHORT_LINE_WORDS)
        & (F.size(words) >= 2)
        & (F.length(F.get(words, 0)) == 1)
        & F.get(words, 0).rlike("^[a-z]$")
        & holds_all(words)
    )
    return (
        F.contains(hay, needle)
        | heading
        | ((F.size("lines") > 1) & F.forall("lines", line_ok))
        | edges(needle)
        | (is_long(needle) & (F.size(words) > 0) & (coverage(words, present) >= TEXT_COVERAGE))
    )


def with_longest_line(cards: DataFrame) -> DataFrame:
    """Add the line with most words of a text of several lines; all lines have to be confirmed, so this one has to."""
    longest = F.element_at(F.array_sort("lines", lambda a, b: F.size(a["words"]) - F.size(b["words"])), -1)
    return cards.withColumn("_line", F.when(F.size("lines") > 1, longest))


def short_keys(cards: DataFrame) -> DataFrame:
    """Keys of texts that have no inner word: their first three characters, which any text holding them holds too."""
    line, needle = F.col("_line.n"), F.col("needle")
    texts = F.array_compact(
        F.array(
            needle, F.when(is_long(needle), first_words(needle)), F.when(is_long(needle), last_words(needle)),
            line, F.when(is_long(line), first_words(line)), F.when(is_long(line), last_words(line)),
        )
    )
    few = F.filter(texts, lambda t: (t != "") & (F.size(inner_words(t)) == 0))
    grams = F.array_distinct(F.transform(few, lambda t: F.substring(t, 1, 3)))
    return with_longest_line(cards).select("_c", "doc", F.explode(grams).alias("gram"))


def page_grams(pages: DataFrame) -> DataFrame:
    chars = pages.select("doc", "page", F.split("hay", "").alias("_c"))
    runs = F.concat(*[short_runs("_c", n) for n in (1, 2, 3)])
    return chars.select("doc", "page", F.explode(F.array_distinct(runs)).alias("gram"))


def candidate_pairs(cards: DataFrame, held: DataFrame, pages: DataFrame, reach: int = 0) -> DataFrame:
    """(_c, page) pairs that can possibly be confirmed; no pair outside them can be. A word also speaks for the reach pages before."""
    keys = search_keys(cards, held.groupBy("_key").agg(F.count("*").alias("pages")))
    pairs = keys.join(held, "_key").select("_c", "page")
    if reach:
        pairs = pairs.select("_c", F.explode(F.sequence(F.col("page") - reach, "page")).alias("page"))
    short = short_keys(cards)
    if not short.isEmpty():
        pairs = pairs.unionByName(short.join(page_grams(pages), ["doc", "gram"]).select("_c", "page"))
    # Several lines without any word are confirmed by every page of the document.
    wordless = cards.where((F.size("lines") > 1) & (F.size("words") == 0)).select("_c", "doc")
    pairs = pairs.unionByName(wordless.join(pages.select("doc", "page"), "doc").select("_c", "page"))
    return pairs.distinct()


def direct_pages(cards: DataFrame, pages: DataFrame) -> DataFrame:
    """Pages that confirm a card on their own."""
    pairs = candidate_pairs(cards, held_words(pages, F.col("hay_words")), pages)
    # Words of a page are a multiple of its text, which moves alone. They are worked out once for each pair, in an array of one.
    words = F.array(F.array_distinct(X.audit_words(F.col("hay"))))
    return (
        pairs.join(cards, "_c")
        .join(pages.select("doc", "page", "hay"), ["doc", "page"])
        .where((F.col("needle") != "") & (F.contains("hay", "needle") | F.exists(words, confirmed)))
        .select("doc", "card_id", "page")
    )


def flat_pages(pages: DataFrame) -> DataFrame:
    """Normal form and words of each page without printed page numbers, and what matters where it meets its neighbours."""
    flat = pages.select("doc", "page", F.array_join(clean_page_lines(F.col("text")), " ").alias("flat"))
    return flat.select(
        "doc", "page", X.audit_norm(F.col("flat")).alias("left"),
        F.col("flat").rlike(r"full[-\u2013\u2014]$").alias("_full"), F.col("flat").startswith("time").alias("_time"),
    )


def joined_pages(side: DataFrame) -> DataFrame:
    """Each page joined with the next one: hay, left, right, and the word that a hyphen breaks between them (across).

    Every page is normalised once; the normal form of a pair differs from its two halves only where they meet: a word
    broken by a hyphen is put together there.
    """
    after = side.select("doc", (F.col("page") - 1).alias("page"), F.col("left").alias("right"), F.col("_time").alias("_then"))
    both = side.drop("_time").join(after, ["doc", "page"])
    broken = F.col("left").rlike(r"(?U)\w-$") & F.col("right").rlike(r"(?U)^\w")
    hay = (
        F.when(F.col("_full") & F.col("_then"), F.concat("left", "right"))
        .when(broken, F.concat(F.expr("left(left, length(left) - 1)"), "right"))
        .otherwise(F.trim(F.concat_ws(" ", "left", "right")))
    )
    across = F.concat(F.regexp_extract("left", r"([a-z0-9]+)-$", 1), F.regexp_extract("right", r"^([a-z0-9]+)", 1))
    return both.select("doc", "page", hay.alias("hay"), "left", "right", F.when(broken, across).alias("across"))


def spanning_pages(cards: DataFrame, pages: DataFrame) -> DataFrame:
    """First pair of neighbouring pages that together hold a card no single page confirms.

    A pair holds the words of both pages, so that the words of single pages are looked up, each once.
    """
    mine = pages.join(cards.select("doc").distinct(), "doc", "left_semi")
    side = materialize(flat_pages(mine), "audit-flat-pages")
    both = joined_pages(side)
    broken = both.where(F.col("left").endswith("-") & F.col("across").isNotNull())
    own = held_words(side, F.array_distinct(X.audit_words(F.col("left")))).unionByName(held_words(broken, F.array("across")))
    own = materialize(own, "audit-flat-words")
    needle = F.col("needle")
    split = is_long(needle) & F.contains("left", first_words(needle)) & F.contains("right", last_words(needle))
    hit = (
        candidate_pairs(cards, own, both, 1)
        .join(cards, "_c")
        .join(both, ["doc", "page"])
        .where((needle != "") & (F.contains("hay", "needle") | split))
    )
    first = hit.groupBy("doc", "card_id").agg(F.min("page").alias("page"))
    return first.select("doc", "card_id", F.explode(F.array("page", F.col("page") + 1)).alias("page"))


def found_pages(cards: DataFrame, pages: DataFrame) -> DataFrame:
    """Pages on which each card is found: doc, card_id, pages (sorted)."""
    normal = materialize(normal_cards(cards).withColumn("_c", F.monotonically_increasing_id()), "audit-cards")
    # words of pages are a multiple of their text: they are taken from it where they are asked for
    hay = materialize(pages.select("doc", "page", X.audit_norm(F.col("text")).alias("hay")), "audit-pages")
    direct = materialize(direct_pages(normal, with_words(hay)), "audit-direct")
    open_cards = materialize(
        normal.join(direct.select("doc", "card_id").distinct(), ["doc", "card_id"], "left_anti"), "audit-open"
    )
    found = direct if open_cards.isEmpty() else direct.unionByName(spanning_pages(open_cards, pages))
    return found.groupBy("doc", "card_id").agg(F.sort_array(F.collect_set("page")).alias("pages"))


def settled_pages(cards: DataFrame, pages: DataFrame) -> DataFrame:
    """Cards whose text stands as a whole on the page of their anchor: doc, card_id, pages (of anchors).

    Such a page confirms its card, within its anchor. Identifiers that several cards share count if all of them do so.
    """
    asked = cards.select("doc", "card_id", "source_text", "page_start", F.coalesce("page_end", "page_start").alias("_end"))
    sides = pages.select(F.col("doc").alias("_doc"), "page", "text")
    needle = X.audit_norm(F.col("source_text"))
    held = (needle != "") & F.contains(X.audit_norm(F.col("text")), needle) & (F.col("page_start") <= F.col("_end"))
    tried = asked.join(sides, (F.col("doc") == F.col("_doc")) & (F.col("page_start") == F.col("page")), "left")
    tried = tried.select("doc", "card_id", "page", F.coalesce(held, F.lit(False)).alias("_held"))
    settled = tried.groupBy("doc", "card_id").agg(F.sort_array(F.collect_set("page")).alias("pages"), F.bool_and("_held").alias("_all"))
    return settled.where("_all").drop("_all")


def anchored_pages(cards: DataFrame, pages: DataFrame) -> DataFrame:
    """Pages on which each card is found, as far as an anchor needs to know: doc, card_id, pages (sorted).

    A card found on the page of its anchor is right wherever else it may stand; all others are searched for on all pages.
    """
    settled = materialize(settled_pages(cards, pages), "audit-settled")
    others = cards.join(settled, ["doc", "card_id"], "left_anti")
    return settled.unionByName(found_pages(others, pages))


def segment_pages(pages: DataFrame) -> DataFrame:
    """Per page with text: its place among all pages (no, without gaps), its lines, its numbered lines and its headings, the
    next heading behind the page within the same task (next_head) and, for pages with numbers, the six lines after it.

    Pages are dealt by ranges of (doc, page) and moved once more; each sees the first lines of the six rows behind it, whatever
    their numbers.
    """
    known = pages.where(F.col("doc").isNotNull() & F.col("page").isNotNull())
    lines = lambda rows: rows.select("doc", "page", clean_page_lines(F.col("text")).alias("lines")).where(F.size("lines") > 0)
    dealt = asof.dealt(known.select("doc", "page", "text"), [F.col("doc"), F.col("page")], "segment-lines", lines)
    return materialize(marked_pages(dealt), "segment-pages")


def marked_pages(dealt: DataFrame) -> DataFrame:
    """Pages with lines, as dealt, and what segment_pages says of them."""
    held = asof.followed(dealt, F.struct("doc", F.slice("lines", 1, NEAR_LINES).alias("top")), NEAR_LINES, "behind")
    ahead = F.filter("behind", lambda b: b["doc"] == F.col("doc")).getField("top")
    held = held.withColumn("ahead", F.slice(F.flatten(ahead), 1, NEAR_LINES)).drop("behind")
    after = lambda i: F.coalesce(F.get("lines", i + 1), F.get("ahead", i + 1 - F.size("lines")), F.lit(""))
    heading = lambda line, i: (
        line.rlike(r"(?U)^[A-Z]\.\s+[A-Z]")
        | ((F.length(line) <= 55) & line.rlike("[A-Za-z]") & ~line.rlike(r"[.;:,]$") & after(i).rlike(r"^[A-Z]\.$"))
        | line.rlike(r"(?U)^Section\s+\d+:")
        | line.rlike(r"(?U)^Part\s+[IVX]+:")
    )
    places = lambda found: F.filter(found, lambda i: i.isNotNull())
    numbered = F.transform("lines", lambda line, i: F.struct(X.present(F.regexp_extract(line, r"(?U)^(\d+)\.\s", 1)).try_cast("bigint").alias("number"), i.alias("i")))
    marked = held.withColumns(
        {
            "heads": places(F.transform("lines", lambda line, i: F.when(heading(line, i), i))),
            "numbers": F.filter(numbered, lambda s: s["number"].isNotNull()),
        }
    )
    # The same order as that of the rows behind, so that these wide rows are sorted once. The next heading may be of another document.
    later = Window.partitionBy("_part").orderBy(F.desc("_at")).rowsBetween(Window.unboundedPreceding, -1)
    next_one = F.last(F.when(F.size("heads") > 0, F.struct("doc", first_head().alias("head"))), ignorenulls=True).over(later)
    marked = marked.withColumn("ahead", F.when(F.size("numbers") > 0, F.col("ahead"))).withColumn("_next", next_one)
    marked = marked.withColumn("next_head", F.when(F.col("_next.doc") == F.col("doc"), F.col("_next.head")))
    return marked.drop("_at", "_next")


def first_head() -> Column:
    """Place of the first heading of a page."""
    return F.when(F.size("heads") > 0, F.struct("no", F.get("heads", F.lit(0)).alias("i")))


def segment_openers(facts: DataFrame) -> DataFrame:
    """Numbered lines: doc, page, number, place, the six lines from there (near) and the next heading (stop)."""
    firsts = facts.groupBy("_part").agg(F.min(F.when(F.size("heads") > 0, F.struct("no", F.get("heads", F.lit(0)).alias("i"), "doc"))).alias("_first"))
    later = Window.orderBy(F.desc("_part")).rowsBetween(Window.unboundedPreceding, -1)
    entering = materialize(firsts.select("_part", F.last("_first", ignorenulls=True).over(later).alias("_in")), "borders")
    each = facts.where(F.size("numbers") > 0).select("doc", "page", "no", "_part", "lines", "ahead", "heads", "next_head", F.explode("numbers").alias("n"))
    near = F.array_join(F.slice(F.concat("lines", "ahead"), F.col("n.i") + 1, F.lit(NEAR_LINES)), " ")
    place = lambda i: F.struct("no", i.alias("i"))
    own = F.get(F.filter("heads", lambda h: h > F.col("n.i")), F.lit(0))
    carried = F.when(F.col("_in.doc") == F.col("doc"), F.struct("_in.no", "_in.i"))
    return each.join(entering, "_part").select(
        "doc", "page", F.col("n.number").alias("number"), place(F.col("n.i")).alias("place"), near.alias("near"),
        F.coalesce(F.when(own.isNotNull(), place(own)), "next_head", carried).alias("stop"),
    )


def anchored(cards: DataFrame, openers: DataFrame) -> DataFrame:
    """cards with `from_page`: the first page from their anchor on that has their number, if any."""
    ahead = cards.withColumn("before", F.struct((F.col("page_start") - 1).alias("page"), F.lit(2147483647).alias("i")))
    marks = openers.select("doc", "number", F.struct("page", "place.i").alias("before"))
    found = asof.next_behind(ahead, marks, ["doc", "number"], "before", "opener")
    return found.where("opener is not null").withColumn("from_page", F.col("opener.page")).drop("before", "opener")


def candidate_starts(cards: DataFrame, openers: DataFrame) -> DataFrame:
    """Lines with the number of a card on the ANCHOR_PAGES pages from its from_page."""
    near = cards.withColumn("page", F.explode(F.sequence("from_page", F.col("from_page") + ANCHOR_PAGES - 1))).join(openers, ["doc", "page", "number"])
    return near.select("doc", "card_id", "number", "page_start", "head", "near", "place", "stop")


def best_starts(candidates: DataFrame) -> DataFrame:
    """One start per card and number; words are compared only where there are several candidates."""
    keys = ["doc", "card_id", "number"]
    shared = F.size(F.array_intersect(X.audit_words(X.audit_norm(F.col("head"))), X.audit_words(X.audit_norm(F.col("near")))))
    counted = candidates.withColumn("_n", F.count("*").over(Window.partitionBy(*keys)))
    rank = F.struct(F.when(F.col("_n") > 1, shared).otherwise(0).alias("overlap"), "place")
    return counted.groupBy(*keys).agg(F.max_by(F.struct("place", "stop"), rank).alias("s")).select(*keys, "s.*")


def clause_segments(cards: DataFrame, pages: DataFrame) -> DataFrame:
    """Source segment of each numbered clause: doc, card_id, segment.

    The start is the line with the clause's number, on the anchor page or one of the ANCHOR_PAGES - 1 after it, whose six
    lines share most words with the head of the card (the later one on a tie). Where none of these pages has the number,
    the first page behind them that has it takes the place of the anchor. The end is the next number or heading, on
    whatever page it stands, or else the end of the document. Gaps between page numbers cost nothing: spans are of places.
    """
    facts = segment_pages(pages.withColumn("page", F.col("page").cast("bigint")))
    openers, text = materialize(segment_openers(facts), "segment-openers"), F.col("source_text")
    number = F.regexp_extract("source_text", r"(?U)^\s*(\d+)\.\s+", 1)
    head = F.array_join(F.slice(F.split(X.plainly_collapsed(text, P.UNUSUAL, X.collapse(text)), " "), 1, 18), " ")
    wanted = cards.where((F.col("unit_type") == "clause") & (number != "") & (F.col("page_start") > 0)).select(
        "doc", "card_id", number.cast("bigint").alias("number"), F.col("page_start").cast("bigint").alias("page_start"), head.alias("head")
    )
    starts = materialize(candidate_starts(wanted.withColumn("from_page", F.col("page_start")), openers), "segment-near")
    far = materialize(wanted.join(starts, ["doc", "card_id", "number", "page_start"], "left_anti"), "segment-far")
    if not far.isEmpty():
        starts = starts.unionByName(candidate_starts(anchored(far, openers), openers))
    starts = best_starts(starts).withColumn("number", F.col("number") + 1)
    numbers = asof.next_behind(starts, openers.select("doc", "number", "place"), ["doc", "number"], "place", "next_number")
    last = facts.groupBy("doc").agg(F.max("no").alias("last"))
    bounded = numbers.select("doc", "card_id", "place", F.least("stop", "next_number").alias("end")).join(last, "doc")
    each = bounded.withColumn("no", F.explode(F.sequence("place.no", F.coalesce("end.no", "last")))).join(facts.select("no", "lines"), "no")
    begin = F.when(F.col("no") == F.col("place.no"), F.col("place.i")).otherwise(F.lit(0))
    stop = F.when(F.col("no") == F.col("end.no"), F.col("end.i")).otherwise(F.size("lines"))
    kept = each.select("doc", "card_id", F.struct("no", F.slice("lines", begin + 1, stop - begin).alias("lines")).alias("p"))
    gathered = kept.groupBy("doc", "card_id").agg(F.flatten(F.sort_array(F.collect_list("p")).getField("lines")).alias("lines"))
    return gathered.select("doc", "card_id", F.array_join("lines", " ").alias("segment"))


def word_counts(texts: DataFrame, keys: list[str], text: Column) -> DataFrame:
    """Words of normalised texts and how often each occurs: keys, word, n. Counts combine before the shuffle."""
    return texts.select(*keys, F.explode(X.audit_words(X.audit_norm(text))).alias("word")).groupBy(*keys, "word").agg(F.count("*").alias("n"))


def recall_of_counts(pairs: DataFrame, keys: list[str], source: DataFrame, card: DataFrame) -> DataFrame:
    """Token recall of pairs (keys) from word counts of both sides under the same keys; see token_recall."""
    none = F.lit(0).cast("bigint")
    sides = source.select(*keys, "word", F.col("n").alias("s"), none.alias("c")).unionAll(card.select(*keys, "word", none.alias("s"), F.col("n").alias("c")))
    per_word = sides.groupBy(*keys, "word").agg(F.sum("s").alias("s"), F.sum("c").alias("c"))
    totals = per_word.groupBy(*keys).agg(F.sum("s").alias("_s"), F.sum("c").alias("_c"), F.sum(F.least("s", "c")).alias("_m"))
    held = pairs.select(*keys).join(totals, keys, "left").select(*keys, F.coalesce("_s", none).alias("segment_tokens"), F.coalesce("_c", none).alias("card_tokens"), "_m")
    blank = (F.col("segment_tokens") == 0) | (F.col("card_tokens") == 0)
    return held.select(*keys, "segment_tokens", "card_tokens", F.when(blank, F.lit(1.0)).otherwise(F.col("_m") / F.col("segment_tokens")).alias("recall"))


def token_recall(pairs: DataFrame, keys: list[str], source: Column, card: Column) -> DataFrame:
    """Share of the source words the card holds, counted with repetition; 1.0 where either side has no words.

    Words are counted per pair and word, with partial sums before the shuffle.
    """
    sides = pairs.select(*keys, X.audit_words(X.audit_norm(source)).alias("_s"), X.audit_words(X.audit_norm(card)).alias("_c"))
    spread = sides.select(
        *keys,
        F.explode_outer(
            F.concat(
                F.transform("_s", lambda w: F.struct(w.alias("word"), F.lit(1).alias("s"), F.lit(0).alias("c"))),
                F.transform("_c", lambda w: F.struct(w.alias("word"), F.lit(0).alias("s"), F.lit(1).alias("c"))),
            )
        ).alias("t"),
    )
    per_word = spread.groupBy(*keys, "t.word").agg(F.sum("t.s").alias("s"), F.sum("t.c").alias("c"))
    totals = per_word.groupBy(*keys).agg(
        F.coalesce(F.sum("s"), F.lit(0)).alias("segment_tokens"),
        F.coalesce(F.sum("c"), F.lit(0)).alias("card_tokens"),
        F.sum(F.least("s", "c")).alias("_m"),
    )
    recall = F.when((F.col("segment_tokens") == 0) | (F.col("card_tokens") == 0), F.lit(1.0)).otherwise(
        F.col("_m") / F.col("segment_tokens")
    )
    return totals.withColumn("recall", recall).drop("_m")


def numbered_words(words: Column) -> Column:
    """Words with the number of times they occurred before, so that repeated ones differ; in any order, linear but for a sort."""
    def numbered(sorted_words: Column) -> Column:
        starts = F.filter(F.transform(sorted_words, lambda w, i: F.when((i == 0) | (w != F.get(sorted_words, i - 1)), i)), lambda i: i.isNotNull())
        return F.get(F.transform(F.array(starts), lambda ats: F.flatten(F.transform(ats, lambda at, j: F.transform(
            F.sequence(F.lit(0), F.coalesce(F.get(ats, j + 1), F.size(sorted_words)) - at - 1), lambda k: F.concat_ws(":", F.get(sorted_words, at), k)
        )))), F.lit(0))

    # arrays of one array, so that the inner one is worked out once and named several times
    return F.get(F.transform(F.array(F.sort_array(words)), numbered), F.lit(0))


def with_recall(rows: DataFrame, source: Column, card: Column) -> DataFrame:
    """Rows with segment_tokens, card_tokens and recall of each row by itself; see token_recall. Nothing is shuffled."""
    met = F.size(F.array_intersect(numbered_words(F.col("_s")), numbered_words(F.col("_c"))))
    shared = F.when(F.col("_s") == F.col("_c"), F.size("_s")).otherwise(met)
    blank = (F.col("segment_tokens") == 0) | (F.col("card_tokens") == 0)
    sides = rows.withColumns({"_s": X.audit_words(X.audit_norm(source)), "_c": X.audit_words(X.audit_norm(card))})
    known = F.col("_s").isNotNull() & F.col("_c").isNotNull()
    count = lambda words: F.when(known, F.size(words)).otherwise(0).cast("bigint")
    counted = sides.withColumns({"segment_tokens": count("_s"), "card_tokens": count("_c")})
    return counted.withColumn("recall", F.when(blank, F.lit(1.0)).otherwise(shared / F.col("segment_tokens"))).drop("_s", "_c")


def duplicate_texts(cards: DataFrame) -> DataFrame:
    """Cards whose normalised source text several cards carry: card_id, text_hash, n.

    Texts are normalised once; only identifiers and hashes are written and shuffled.
    """
    normal = F.nullif(X.audit_norm(F.col("source_text")), F.lit(""))
    hashed = materialize(cards.select("card_id", F.sha2(normal, 256).alias("text_hash")), "text-hashes").where("text_hash is not null")
    groups = hashed.groupBy("text_hash").agg(F.count("*").alias("n")).where("n > 1")
    return hashed.join(groups, "text_hash")


# What identifiers look like behind the slug of their document.
NUMBERED, LETTERED, COLLIDED = r"^part-ii-section-(\d+)$", r"^part-i-section-([a-z])$", r"^part-i-section-([a-z])-clause-\d+-p\d+$"


def tail(card_id: Column, doc: Column) -> Column:
    """The part of an identifier behind the slug of its document; null for one of another document."""
    return F.when(F.startswith(card_id, F.concat(doc, F.lit("-"))), F.substr(card_id, F.length(doc) + 2))


def bit_of(letter: Column) -> Column:
    """a is the lowest of 26 bits; null for an empty string."""
    return F.when(letter != "", F.call_function("shiftleft", F.lit(1), F.ascii(letter) - 97))


def letters_of(bits: Column) -> Column:
    """Letters of a bitmap, in order."""
    return F.transform(F.filter(F.sequence(F.lit(0), F.lit(25)), lambda i: F.call_function("getbit", bits, i) == 1), lambda i: F.chr(i + 97))


def set_facts(cards: DataFrame) -> DataFrame:
    """One row per document: numbered sections of Part II (their number), letters of Part I, those missing between them, and
    letters of Part I sections that own clauses with a page suffix, by a clause's identifier or by their children.

    Letters are bits and numbers are bitmaps, so that partial results are small and combine before the shuffle, however
    many cards a document has.
    """
    own, child = tail(F.col("card_id"), F.col("doc")), lambda c: tail(c, F.col("doc"))
    letter = F.regexp_extract(own, LETTERED, 1)
    host = F.coalesce(X.present(F.regexp_extract(own, COLLIDED, 1)), F.when(F.exists("child_ids", lambda c: F.coalesce(child(c).rlike(COLLIDED), F.lit(False))), letter))
    number = F.regexp_extract(own, NUMBERED, 1).try_cast("bigint")
    rows = cards.select("doc", number.alias("number"), bit_of(letter).alias("letter"), bit_of(host).alias("host"))
    parts = rows.groupBy("doc", F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position("number"))).alias("numbers"), F.bit_or("letter").alias("letters"), F.bit_or("host").alias("hosts")
    )
    zero = F.lit(0)
    facts = parts.groupBy("doc").agg(
        F.sum(F.when(F.col("bucket").isNotNull(), F.col("numbers")).otherwise(zero)).alias("numbered_sections"),
        letters_of(F.coalesce(F.bit_or("letters"), zero)).alias("letters"), letters_of(F.coalesce(F.bit_or("hosts"), zero)).alias("hosts"),
    )
    return facts.withColumn("missing_letters", missing_letters(F.col("letters")))


def missing_letters(letters: Column) -> Column:
    """Letters absent between the first and the last one present."""
    span = F.transform(F.sequence(F.ascii(F.array_min(letters)), F.ascii(F.array_max(letters))), F.chr)
    return F.when(F.size(letters) > 0, F.array_except(span, letters)).otherwise(F.array().cast("array<string>"))


def collision_hosts(cards: DataFrame) -> DataFrame:
    """doc and card_id of the Part I sections that own clauses with a page suffix."""
    hosts = set_facts(cards).select("doc", F.explode("hosts").alias("letter"))
    return hosts.select("doc", F.concat("doc", F.lit("-part-i-section-"), "letter").alias("card_id"))


def marker_count(text: Column, before: str) -> Column:
    return F.regexp_count(text, F.lit(f"(?U)(?:{before})\\s*{P.AUDIT_MARKER}\\.\\s+"))


def keeps_list(card_text: Column, segment: Column) -> Column:
    """The card has at least as many list items on lines of their own as the segment shows in its running text."""
    inline = F.regexp_count(segment, F.lit(f"(?U)\\s{P.AUDIT_MARKER}\\.\\s+"))
    return (inline == 0) | (marker_count(card_text, "^|\\n") >= inline)


def anchor_issue() -> Column:
    """What is wrong with the page anchor of a card; columns pages, page_start, page_end."""
    end = F.coalesce("page_end", "page_start")
    within = F.exists("pages", lambda p: p.between(F.col("page_start"), end))
    listed = F.concat(F.lit("["), F.array_join("pages", ", "), F.lit("]"))
    return (
        F.when(F.coalesce(F.size("pages"), F.lit(0)) <= 0, "Source text not confirmed on the extracted PDF text layer")
        .when(F.col("page_start").isNull(), "Missing source page anchor")
        .when(
            ~within,
            F.concat(
                F.lit("Source text found only on PDF page(s) "), listed, F.lit(", not anchored page "),
                F.col("page_start"), F.lit("-"), end,
            ),
        )
    )


# Findings and the fix asked for, by rule.
FINDINGS = {
    "anchor": (None, "Re-anchor to the PDF page containing the source text and re-run source-text verification."),
    "misfiled": (None, None),
    "gap": (None, "Add the missing Part I section card and correct the affected child metadata."),
    "omission": (None, "Regenerate this clause from the full PDF clause segment, preserving nested list items and page-spanning text."),
    "flat_section": (
        "Part II numeric section hierarchy is flattened; card is parented directly under Part II or a page-suffixed letter section instead of Section N.",
        "Add numbered Section parent cards and reparent/rename this card under its true Section N heading.",
    ),
    "flat_list": (
        "Nested source list structure is flattened into paragraph text, which loses legal hierarchy even where words are present.",
        "Represent lower-alpha/roman subclauses as nested structure or separate child units with source page attribution.",
    ),
    "warning": (
        "Unresolved-reference warning is accurately carried as review metadata and should remain visible for import review.",
        "Resolve the target if a stable Clause Card exists; otherwise keep the unresolved warning attached.",
    ),
    "duplicate": (None, "Confirm this is a legitimate repeated heading/text, or deduplicate if it is an artifact copy."),
    "none": ("No source-fidelity, anchor, hierarchy, duplicate, or warning issue found in this audit.", "None."),
}
LETTER_GAP = (
    "Part I lettered section sequence is missing Section {} from the generated hierarchy; "
    "an adjacent section is carrying its clauses."
)
COLLISION_GAP = (
    "This lettered Part I section carries collision-suffixed child clauses that belong to a "
    "missing sibling section; remove them from this section's child metadata."
)


def ladder(scored: DataFrame) -> DataFrame:
    """Verdict, severity, findings and confidence of each card.

    scored: unit_type, anchor_issue, misfiled (letter of the section that wrongly carries the card, or null), gap_issue,
    segment, segment_tokens, card_tokens, recall, flat_section, source_text, warning_ids, duplicate_ids and pages. What is read
    from the texts may come as has_segment and flattened instead (see with_text_facts). Blocking findings win over
    structural ones, those over minor.
    """
    if "flattened" not in scored.columns:
        scored = with_text_facts(scored)
    host, following = F.upper("misfiled"), F.upper(F.chr(F.ascii("misfiled") + 1))
    misfiled = F.col("misfiled").isNotNull()
    has_segment = F.col("has_segment")
    omission = has_segment & (F.col("recall") < RECALL_FLOOR) & (F.col("segment_tokens") > F.col("card_tokens") + SEGMENT_SLACK)
    anchor = F.col("anchor_issue").isNotNull()
    early_block = anchor | misfiled
    blocked = early_block | omission
    gap = F.col("gap_issue").isNotNull() & ~early_block
    flat_section = F.col("flat_section") & ~blocked
    flat_list = F.col("flattened") & ~blocked
    warned = F.size("warning_ids") > 0
    structural = gap | flat_section | flat_list
    copies = F.array_distinct("duplicate_ids")
    duplicate = (F.size(copies) > 1) & (F.col("unit_type") == "clause") & (F.col("card_tokens") > REPEATABLE_WORDS) & ~blocked
    share = F.concat(F.format_string("%.0f", F.bround(F.col("recall") * 100, 0)), F.lit("%"))
    said = {
        "anchor": (anchor, F.col("anchor_issue")),
        "misfiled": (
            misfiled,
            F.concat(
                F.lit("Part I Section "), following, F.lit(" clause is misidentified as Section "), host,
                F.lit("; title, slug, parent, and hierarchy are wrong."),
            ),
        ),
        "gap": (gap, F.col("gap_issue")),
        "omission": (
            omission,
            F.concat(
                F.lit("Card source text omits or splices required PDF clause text; card captures about "), share,
                F.lit(" of the extracted clause segment."),
            ),
        ),
        "flat_section": (flat_section, None),
        "flat_list": (flat_list, None),
        "warning": (warned, None),
        "duplicate": (
            duplicate,
            F.concat(
                F.lit("Exact source text is shared with another card: "), F.array_join("duplicate_ids", ", "), F.lit(".")
            ),
        ),
    }
    fixes = {
        "misfiled": F.concat(
            F.lit("Create/use the Part I Section "), following, F.lit(" parent and move this clause under it with the correct clause ID/title.")
        )
    }
    pick = lambda side: F.array_distinct(
        F.array_compact(
            F.array(
                *[
                    F.when(when, fixes.get(rule, F.lit(FINDINGS[rule][side])) if side == 1 else F.lit(FINDINGS[rule][side]) if own is None else own)
                    for rule, (when, own) in said.items()
                ]
            )
        )
    )
    any_issue = F.size("_issues") > 0
    verdict = (
        F.when(blocked, "BLOCKED_UNSAFE_TO_IMPORT")
        .when(structural, "NEEDS_STRUCTURAL_FIX")
        .when(warned | duplicate, "NEEDS_MINOR_FIX")
        .otherwise("PASS")
    )
    severity = F.when(blocked, "P0").when(structural, "P1").otherwise("P2")
    confidence = (
        F.when((F.col("verdict") == "PASS") & F.col("unit_type").isin("part", "section"), "medium-high")
        .when((F.coalesce(F.size("pages"), F.lit(0)) > 0) & ~anchor, "high")
        .otherwise("medium")
    )
    return (
        scored.withColumns({"_issues": pick(0), "_fixes": pick(1), "verdict": verdict, "severity": severity})
        .withColumns(
            {
                "issue": F.when(any_issue, F.array_join("_issues", " ")).otherwise(F.lit(FINDINGS["none"][0])),
                "required_fix": F.when(any_issue, F.array_join("_fixes", " ")).otherwise(F.lit(FINDINGS["none"][1])),
                "confidence": confidence,
            }
        )
        .drop("_issues", "_fixes", "has_segment", "flattened")
    )


def with_text_facts(rows: DataFrame) -> DataFrame:
    """Rows with has_segment and flattened: lists of the segment are lost in the text of the card."""
    has_segment = F.coalesce(F.col("segment"), F.lit("")) != ""
    flattened = F.col("segment").rlike(P.NESTED_MARKER) & ~keeps_list(F.col("source_text"), F.col("segment"))
    return rows.withColumns({"has_segment": has_segment, "flattened": has_segment & flattened})


def with_shared_recall(rows: DataFrame, cards: DataFrame, segments: DataFrame) -> DataFrame:
    """Rows whose recall is that of all cards of their identifier together, where several share it."""
    keys, names = ["doc", "card_id"], ("segment_tokens", "card_tokens", "recall")
    known = cards.where(F.col("doc").isNotNull() & F.col("card_id").isNotNull())
    repeated = materialize(known.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1").select(*keys), "audit-repeated")
    if repeated.isEmpty():
        return rows
    texts = known.select(*keys, "source_text").join(repeated, keys, "left_semi").join(segments, keys, "left")
    recalls = token_recall(texts, keys, F.coalesce("segment", F.lit("")), F.col("source_text"))
    recalls = recalls.select(*keys, F.lit(True).alias("_all"), *[F.col(name).alias(f"_{name}") for name in names])
    picked = [F.when(F.col("_all"), F.col(f"_{name}")).otherwise(F.col(name)).alias(name) for name in names]
    return rows.join(recalls, keys, "left").select(*[c for c in rows.columns if c not in names], *picked)


def audit(cards: DataFrame, pages: DataFrame) -> DataFrame:
    """Audit rows of cards of any number of documents; identifiers start with the slug of their document (doc).

    Facts about a document are one small row, joined once.
    """
    spark = cards.sparkSession
    cards = materialize(cards, "audit-input")
    found = passing(spark, lambda: anchored_pages(cards, pages), "audit-found")
    segments = passing(spark, lambda: clause_segments(cards, pages), "audit-segments")
    # short texts may repeat, so that only longer ones are compared
    long_texts = cards.where(F.size(X.audit_words(X.audit_norm(F.col("source_text")))) > REPEATABLE_WORDS)
    copies = duplicate_texts(long_texts)
    members = copies.groupBy("text_hash").agg(F.sort_array(F.collect_list("card_id")).alias("duplicate_ids"))
    shared = passing(spark, lambda: copies.select("card_id", "text_hash").join(members, "text_hash").drop("text_hash"), "audit-copies")
    own = tail(F.col("card_id"), F.col("doc"))
    numbered = lambda c: F.coalesce(tail(c, F.col("doc")).rlike(NUMBERED), F.lit(False))
    flat = (
        F.when(~F.coalesce(own.startswith("part-ii"), F.lit(False)), F.lit(False))
        .when(own == "part-ii", F.coalesce("numbered_sections", F.lit(0)) == 0)
        .otherwise(~numbered(F.col("card_id")) & ~F.exists("parent_chain", numbered))
    )
    before, after = LETTER_GAP.split("{}")
    missing = F.array_join(F.transform("missing_letters", F.upper), ", ")
    gap = F.when((own == "part-i") & (F.size("missing_letters") > 0), F.concat(F.lit(before), missing, F.lit(after))).when(
        F.array_contains("hosts", X.present(F.regexp_extract(own, LETTERED, 1))), F.lit(COLLISION_GAP)
    )
    empty = F.array().cast("array<string>")
    # All that needs the texts is worked out where cards and segments meet, so that only narrow rows go on.
    texts = cards.join(segments, ["doc", "card_id"], "left").join(found, ["doc", "card_id"], "left")
    texts = with_recall(with_text_facts(texts), F.coalesce("segment", F.lit("")), F.col("source_text"))
    key = F.col("doc").isNotNull() & F.col("card_id").isNotNull()
    scores = [F.when(key, F.col(name)).alias(name) for name in ("segment_tokens", "card_tokens", "recall")]
    texts = texts.select(*[c for c in texts.columns if c not in ("segment_tokens", "card_tokens", "recall")], *scores)
    texts = with_shared_recall(texts, cards, segments)
    scored = (
        texts.join(shared, "card_id", "left")
        .join(materialize(set_facts(cards), "set-facts"), "doc", "left")
        .withColumns(
            {
                "duplicate_ids": F.coalesce("duplicate_ids", empty),
                "anchor_issue": anchor_issue(),
                "misfiled": X.present(F.regexp_extract(own, COLLIDED, 1)),
                "gap_issue": gap,
                "flat_section": flat,
            }
        )
    )
    return ladder(scored.drop("letters", "hosts", "missing_letters", "numbered_sections"))


def tallies(rows: DataFrame) -> DataFrame:
    """One row: cards reviewed, passed, needing fixes and blocked, and the verdict on the whole set."""
    blocked = F.count_if(F.col("verdict").isin("BLOCKED_UNSAFE_TO_IMPORT", "CANNOT_VERIFY_FROM_ATTACHMENTS"))
    fixes = F.count_if(F.col("verdict").isin("NEEDS_MINOR_FIX", "NEEDS_STRUCTURAL_FIX"))
    return rows.agg(
        F.when(blocked > 0, "FAIL").when(fixes > 0, "PASS_WITH_FIXES").otherwise("PASS").alias("full_verdict"),
        F.count("*").alias("reviewed"),
        F.count_if(F.col("verdict") == "PASS").alias("passed"),
        fixes.alias("needs_fixes"),
        blocked.alias("blocked"),
        F.count_if(F.col("severity") == "P1").alias("p1_count"),
        F.count_if((F.col("severity") == "P2") & (F.col("verdict") != "PASS")).alias("p2_count"),
    )


def finding_patterns(rows: DataFrame) -> DataFrame:
    """P1 findings by their first sentence, most frequent first."""
    sentence = F.concat(F.regexp_replace(F.split_part("issue", F.lit(". "), F.lit(1)), r"\.+$", ""), F.lit("."))
    return (
        rows.where(F.col("severity") == "P1")
        .groupBy(sentence.alias("pattern"))
        .agg(F.count("*").alias("cards"), F.min("card_id").alias("first_card"))
        .orderBy(F.desc("cards"), "first_card")
    )
