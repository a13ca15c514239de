"""Steps whose cost once grew beyond their input: what they send, and how often they read a text."""

import os
import re

from pyspark.sql import functions as F

from lexweave import session
from lexweave.functions import patterns as P
from lexweave.functions import text as X
from lexweave.operators import asof
from lexweave.operators import audit as A
from lexweave.operators import bylaws as B
from lexweave.operators import lines as L
from lexweave.operators import policy
from lexweave.operators import references as R
from lexweave.operators import retrieval as Q
from lexweave.operators.flows import flow_parts
from lexweave.session import materialize


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_words_of_pages_are_never_broadcast(spark):
    pages = spark.createDataFrame([(f"p{i}", f"red lamp {i} sky") for i in range(40)], "path string, haystack string")
    questions = spark.createDataFrame([("q1", "a red lamp 7"), ("q2", "sky 3")], "question_id string, question string")
    asked = questions.select("question_id", F.explode(F.array_distinct(X.words(F.col("question")))).alias("word"))
    held = materialize(pages.select("path", F.explode(X.words(F.col("haystack"))).alias("word")), "held")
    asked = materialize(Q.by_rarity(asked, held), "asked")
    floors = materialize(Q.score_floors(asked, held, questions, 2), "floors")
    pairs = Q.contenders(asked, held, floors, 2)
    assert plan_of(Q.overlaps_of(materialize(pairs, "pairs"), asked, held)).count("SortMergeJoin") == 1
    assert plan_of(pairs).count("SortMergeJoin") == 1
    assert plan_of(Q.score_floors(asked, held, questions, 2)).count("SortMergeJoin") >= 2
    best = {(r.question_id, r["rank"]): r.path for r in Q.rank_pages(pages, questions, 2).collect()}
    assert best["q1", 1] == "p7" and best["q2", 1] == "p3" and len(best) == 4


def test_resolution_reads_each_clause_once(spark):
    empty = "cast(null as int)"
    units = spark.createDataFrame(
        [("d", "d-section-7", "section", "7", "Section 7: x", 1), ("d", "d-clause-1", "clause", "1", "1. Subject to Section 7.", 2),
         ("d", "d-clause-2", "clause", "2", "2. This is \u017fubject to §.", 3), ("d", "d-clause-3", "clause", "(b) x", "3. Amended by section (b) x.", 4)],
        "slug string, clause_id string, unit_type string, number string, text string, block_ord bigint",
    ).selectExpr("*", "0 as offset", "0L as chunk", *[f"{empty} as {c}" for c in ("page", "page_end", "line_start", "line_end")])
    documents = spark.createDataFrame([("d", "D", 0)], "slug string, title string, doc_ord bigint")
    resolved = R.resolve(R.references(units), units, documents)
    assert "read with" not in plan_of(resolved)
    rows = {r.source_unit_id: (r.reference_type, r.reference_text, r.resolved_target_id) for r in resolved.collect()}
    assert rows == {"d-clause-1": ("subject_to", "7", "d-section-7"), "d-clause-2": ("subject_to", "§", None), "d-clause-3": ("amends", "(b) x", "d-clause-3")}


KEYS = ["7", "Section 7", "acts-1-part-i", "a--b", "-a", "a.", "7.2", " 7 ", "ARTICLE  x y", "a.-b", "a\n", "", "(b)", "clause-7", "policy\u00a0IV", "\u00c4b", None]


def test_plain_keys_are_those_of_the_long_way(spark):
    def key(text):
        strip = lambda t: re.sub(rf"^[{P.WHITE}]+|[{P.WHITE}]+\Z", "", t)
        bare = re.sub(r"^(?:section|article|policy|clause)\s+", "", strip(text).lower())
        return re.sub(r"^-+|-+$", "", re.sub(r"[^A-Za-z0-9.]+", "-", strip(bare))).lower()

    rows = spark.createDataFrame([(k,) for k in KEYS], "k string").select("k", X.unit_key(F.col("k")).alias("u")).collect()
    assert {r.k: r.u for r in rows} == {k: None if k is None else key(k) for k in KEYS}


LINES = ["  a \u00a0b\u200bc\u201cd\u201d ", "x\u3000\ty", "\ufeff", "plain text only", "a  b", " \x85\u2028z\x1c", "", "\u00e9 \u00e9"]


def test_clean_lines_and_margins(spark):
    table = str.maketrans("\u200b\ufeff\u201c\u201d", "  \"\"")
    clean = lambda t: re.sub(f"[{P.WHITE}]+", " ", t.translate(table)).strip(" ")
    rows = spark.createDataFrame([(k,) for k in LINES], "k string")
    rows = rows.select("k", X.clean_line(F.col("k")).alias("c"), X.strip(F.col("k")).alias("s")).collect()
    assert [r.c for r in rows] == [clean(k) for k in LINES]
    assert [r.s for r in rows] == [re.sub(rf"^[{P.WHITE}]+|[{P.WHITE}]+\Z", "", k) for k in LINES]


def test_parts_are_cut_where_the_pattern_says(spark):
    lines = ["b. charges: i. discount 5;", "12. The buyer takes 3 units:", "a; ii.", "x: abcdefg. y", "x:\u00a0b. y", "1. A. b", ""]
    rows = spark.createDataFrame([(k,) for k in lines], "k string")
    rows = rows.select(flow_parts(F.col("k")).getField("part").alias("p"), F.filter(F.split("k", P.RUN_IN), lambda p: p != "").alias("q")).collect()
    assert [r.p for r in rows] == [r.q for r in rows] and rows[0].p == ["b. charges:", "i. discount 5;"]


def test_segments_are_spans_of_pages_that_exist(spark):
    far = 10**10
    pages = [("d", 1, "1. One opens;"), ("d", 2, " \n7"), ("d", far, "goes on;"), ("d", 2 * far, "and on\n2. Two opens;"), ("e", 1, "B.\n2. Other;"), (None, 4, "x"), ("e", None, "1. y")]
    pages += [("f", i * far, f"{i + 1}. Rule {i} on\nline{i}") for i in range(9)] + [("f", 9 * far, "Hall"), ("f", 9 * far + 1, "Z.")]
    cards = [("d", "c1", "1. One opens;", 1), ("d", "c2", "2. Two opens;", 7), ("e", "c3", "2. Other;", 1), ("f", "c4", "9. Rule 8 on", 2), ("f", "c5", "3. Rule 2 on", 2 * far)]
    cards = spark.createDataFrame([(d, c, "clause", t, p) for d, c, t, p in cards], "doc string, card_id string, unit_type string, source_text string, page_start bigint")
    got = A.clause_segments(cards, spark.createDataFrame(pages, "doc string, page bigint, text string").repartition(5)).collect()
    assert {r.card_id: r.segment for r in got} == {
        "c1": "1. One opens; goes on; and on", "c2": "2. Two opens;", "c3": "2. Other;", "c4": "9. Rule 8 on line8", "c5": "3. Rule 2 on line2"
    }


def test_rows_see_those_behind_them_across_tasks(spark):
    rows = spark.range(23).selectExpr("id", "shiftleft(id div 4, 33) + id % 4 as _at", "id div 4 as _part").repartition(3)
    got = asof.followed(rows, F.col("id"), 6, "behind").orderBy("id").collect()
    assert [(r.id, r.no, r.behind) for r in got] == [(i, i, list(range(i + 1, min(i + 7, 23)))) for i in range(23)]


def test_words_of_a_card_are_counted_once(spark):
    text = "all red lamps " + "glow " * 9 + "over q1 and q2"
    cards = spark.createDataFrame([("d", "c", text + "\nsecond line"), ("d", "s", "alpha beta-\ngamma delta"), (None, "n", "x y")], "doc string, card_id string, source_text string")
    pages = [("d", i, f"all red lamps over and {i}") for i in range(30)] + [("d", 40, text), ("d", 50, "alpha beta-"), ("d", 51, "17\ngamma delta"), (None, 1, "x y")]
    pages = spark.createDataFrame(pages, "doc string, page bigint, text string")
    normal = materialize(A.normal_cards(cards).withColumn("_c", F.monotonically_increasing_id()), "cards")
    held = A.held_words(A.normal_pages(pages), F.col("hay_words"))
    keys = A.search_keys(normal, held.groupBy("_key").agg(F.count("*").alias("pages")))
    # a word that occurs nine times is enough for coverage, so that common words never become keys
    common = pages.where("doc = 'd'").select(F.explode(F.split(F.lit("all red lamps over and"), " ")).alias("w"), F.xxhash64("doc", "w").alias("_key"))
    assert keys.join(common, "_key").count() == 0
    assert plan_of(keys).count("Generate") == 3
    got = {r.card_id: r.pages for r in A.found_pages(cards, pages).collect()}
    assert got == {"c": [40], "s": [50, 51]}


def test_lines_of_a_text_are_those_of_the_long_way(spark):
    texts = ["a  b\nc", "a   b", "a    b \n  c", "\ta", "a\r\nb\rc", None, "", "1.\u200b x\ny  ", "\u00e9  z\u2028q", "  ", "a\n\n b ", "\u201cq\u201d  \x1f\x1cw"]
    table = str.maketrans("\u200b\ufeff\u201c\u201d", "  \"\"")

    def lines(text):
        plain = re.sub(P.INLINE_SPACE, " ", text.translate(table))
        return [line.strip(" ") for line in re.split(P.LINE_BREAK, plain)]

    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", X.cleaned_lines(F.col("t")).alias("l")).collect()
    assert {r.t: r.l for r in rows} == {t: None if t is None else lines(t) for t in texts}


PAGES = ["Part I: Trade\nSection 1: One\nA. Goods\n1. x\n1. y\n7\nA. Goods\n1. z", "12\nTable of contents", "goes on\nSection 1: One\nA. Goods\n1. z"]


def test_marks_of_lines_are_worked_out_once(spark, page_blocks):
    found = B.pieces(L.neighbouring_blocks(page_blocks(PAGES), 5))
    assert plan_of(found).count("table of contents") == 1
    rows = found.orderBy("block_ord", "offset").select("kind", F.col("entries.line").alias("l")).collect()
    assert [r.kind for r in rows] == ["part", "section", "letter", "clause", "clause", "letter", "clause", "text", "section", "letter", "clause"]
    assert [r.l for r in rows if r.kind == "text"] == [["goes on"]]


def test_tags_of_headings_lie_apart(spark, page_blocks):
    heads = B.outline(page_blocks(PAGES)).heads
    apart = [f for f in heads.inputFiles() if "bylaw-heading-tags" in f]
    assert [(r.pos.block_ord, r.tag) for r in spark.read.parquet(*apart).orderBy("pos").collect()] == [(1, "-p1"), (3, "-p3")]
    part = "sample-part-i"
    first, again = f"{part}-section-1", f"{part}-section-1-p3"
    assert [r.clause_id for r in heads.orderBy("block_ord", "offset").collect()] == [
        part, first, f"{first}-a", f"{first}-a-clause-1", f"{first}-a-clause-1-p1", f"{first}-a-p1", f"{first}-a-p1-clause-1",
        again, f"{again}-a", f"{again}-a-clause-1",
    ]


def test_tags_of_policies_lie_apart(spark, page_blocks, documents):
    text = "Section 1: One\nI. TERMS\n(a) x\n(a) y\nI. TERMS\n(a) z"
    units = policy.parse_policies(documents(), page_blocks([text])).units
    assert any("policy-heading-tags" in f for f in units.inputFiles())
    first = "sample-section-1-policy-i"
    assert [r.clause_id for r in units.where("not is_top_level").orderBy("block_ord", "offset").collect()] == [
        "sample-section-1", first, f"{first}-provision-a", f"{first}-provision-a-p1", f"{first}-p1", f"{first}-p1-provision-a"
    ]


def shuffle_blocks(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {blocks.apply(i).name() for i in range(blocks.size()) if blocks.apply(i).name().startswith("shuffle_")}


def test_steps_leave_no_files_behind(spark):
    before = shuffle_blocks(spark)
    rows = materialize(spark.range(1000).groupBy(F.col("id") % 7).count(), "counted")
    assert rows.count() == 7 and spark.conf.get(session.CLEANUP, None) != "true"
    made = []

    def steps():
        made.append(materialize(rows.repartition(3), "step"))
        made.append(session.passing(spark, lambda: materialize(made[0], "inner-step"), "inner"))
        return made[1].groupBy().count()

    kept = session.passing(spark, steps, "outer")
    assert kept.first()["count"] == 7 and rows.count() == 7
    (path,), gone = kept.inputFiles(), [f for m in made for f in m.inputFiles()]
    assert "outer-" in path and gone and not any(os.path.exists(f.removeprefix("file:").removeprefix("//")) for f in gone)
    wrote = {b for b in shuffle_blocks(spark) - before if b.endswith(".data")}
    assert len(wrote) <= 8, wrote  # those of the counts here, none of the tables


def test_cards_on_the_page_of_their_anchor_are_not_searched_for(spark):
    row = "doc string, card_id string, source_text string, page_start int, page_end int"
    cards = [("d", "own", "red lamps", 1, None), ("d", "far", "red lamps", 7, 7), ("d", "none", "blue lamps", 1, 1), ("d", "loose", "red lamps", None, None), ("d", "back", "red lamps", 1, 0),
             ("d", "twice", "red lamps", 1, 1), ("d", "twice", "green lamps", 1, 1), (None, "null", "red lamps", 1, 1), ("d", "empty", "", 1, 1), ("d", "no", None, 1, 1)]
    cards = spark.createDataFrame(cards, row)
    pages = spark.createDataFrame([("d", 1, "all red lamps glow"), ("d", 2, "red lamps again"), ("d", 3, "green lamps"), (None, 1, "red lamps")], "doc string, page bigint, text string")
    got = {r.card_id: r.pages for r in A.anchored_pages(cards, pages).collect()}
    everywhere = {r.card_id: r.pages for r in A.found_pages(cards, pages).collect()}
    assert got == {**everywhere, "own": [1]}
    assert everywhere["own"] == everywhere["far"] == [1, 2] and everywhere["twice"] == [1, 2, 3]


def test_recall_of_a_row_is_that_of_counted_words(spark):
    texts = ["a b b c", "b b b x", "", "A, a! a\nb-\nc", "d", None]
    rows = spark.createDataFrame([(i, s or "", c) for i, (s, c) in enumerate((s, c) for s in texts for c in texts)], "k int, s string, c string")
    names = ("k", "segment_tokens", "card_tokens", "recall")
    counted = A.with_recall(rows, F.col("s"), F.col("c")).select(*names)
    assert "Exchange" not in plan_of(counted)
    assert sorted(counted.collect()) == sorted(A.token_recall(rows, ["k"], F.col("s"), F.col("c")).select(*names).collect())


def test_plain_texts_are_collapsed_as_others(spark):
    texts = ["A b\nc", "a  b", "a   b", " x\n\ny ", "full- time", "wo-\nrd", "a - b", "a-b", "\u201cQ\u201d\u2014z", "\tt", "a\r\nb", "", None, "\n", "\u00c9- x", "a\x00b", "tail-", "x\u00a0 y"]
    plain = lambda t: t.translate(str.maketrans("\u2019\u2018\u201c\u201d\u2013\u2014\u00a0", "''\"\"-- ")).replace("full- time", "full-time")
    norm = lambda t: re.sub(f"[{P.WHITE}]+", " ", re.sub(r"(?<=\w)-\s+(?=\w)", "", plain(t))).strip(" ").lower()
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", X.audit_norm(F.col("t")).alias("n")).collect()
    assert [r.n for r in rows] == [None if t is None else norm(t) for t in texts]


def test_audit_reads_texts_in_one_place(spark):
    card = "doc string, card_id string, unit_type string, source_text string, page_start int, page_end int, parent_chain array<string>, child_ids array<string>, warning_ids array<string>"
    text = "1. The members of this club vote once in a year."
    cards = [("d", "d-c1", "clause", text, 1, 1, ["d"], [], []), ("d", "d-c2", "clause", text, 1, 1, ["d"], [], []),
             ("d", "d-c3", "clause", "2. They do.", 1, 1, ["d"], [], []), ("d", "d-c3", "clause", "2. They do. They go.", 1, 1, ["d"], [], [])]
    pages = spark.createDataFrame([("d", 1, f"{text}\n2. They do. They go.\n3. End.")], "doc string, page int, text string")
    rows = A.audit(spark.createDataFrame(cards, card), pages)
    got = sorted((r.card_id, r.verdict, r.segment_tokens, r.card_tokens, r.duplicate_ids) for r in rows.collect())
    # cards of one identifier are counted together, each with the segments of both
    assert got == [("d-c1", "NEEDS_MINOR_FIX", 11, 11, ["d-c1", "d-c2"]), ("d-c2", "NEEDS_MINOR_FIX", 11, 11, ["d-c1", "d-c2"])] + [("d-c3", "PASS", 10, 8, [])] * 2


REFERRING = [
    "Part I: Trade\nSection 1: One\nA. Goods\n1. Subject\nto section 7.\n2. The buyer takes:\na. three; b. four;\nii. five.\n3. Except as said.\n4. Under\nSection 1.2 it\nis read with\nthe Code.",
    "5. None.\n6. This is de\nspite all.\n7. Plain.\na. amended by\nsection 9.", "goes on despite section 3.\n8. \u017fubject to \u00a7.",
]


def test_only_clauses_that_can_refer_get_a_text(spark, page_blocks):
    found = B.outline(page_blocks(REFERRING))
    whole = B.unit_rows(found, ("clause",)).orderBy("block_ord", "offset").collect()
    some = B.unit_rows(found, ("clause",), may=R.may_refer).orderBy("block_ord", "offset").collect()
    assert [r.text for r in whole][:3] == ["1. Subject to section 7.", "2. The buyer takes:\na. three;\nb. four;\n  ii. five.", "3. Except as said."]
    assert [r.clause_id for r in some] == [r.clause_id for r in whole]
    assert {r.number for r in some if not r.text} == {"2", "5", "6"}
    assert all(r == w for r, w in zip(some, whole) if r.text)
    of = lambda rows: [(r.source_unit_id, r.reference_type, r.reference_text) for r in R.references(rows).orderBy("ref_ord").collect()]
    assert of(B.unit_rows(found, ("clause",), may=R.may_refer)) == of(B.unit_rows(found, ("clause",)))
    assert [t for _, t, _ in of(B.unit_rows(found, ("clause",)))] == ["subject_to", "exception_to", "read_with", "section_reference", "despite", "amends", "subject_to"]


def test_pages_are_sorted_once_for_all_looks_behind(spark):
    pages = [("a", 1, ["1. One", "Part I: X"]), ("a", 2, ["2. Two"]), ("a", 5, ["go on"]), ("b", 1, ["3. Three"]), ("b", 2, ["Section 1: Y", "A. B"]), ("c", 1, ["4. Four"])]
    for width in (1, 2, 9):
        rows = [(d, n, lines, (i // width << 33) + i % width, i // width) for i, (d, n, lines) in enumerate(pages)]
        dealt = materialize(spark.createDataFrame(rows, "doc string, page bigint, lines array<string>, _at bigint, _part bigint"), "dealt")
        marked = A.marked_pages(dealt)
        # each row is sorted once; before, once for the rows behind it and again for the next heading
        assert len(re.findall(r"Sort \[[^\]]*_at#", plan_of(marked))) == 1
        openers = A.segment_openers(materialize(marked, "marked")).collect()
        stops = {r.number: r.stop and (r.stop.no, r.stop.i) for r in openers}
        assert stops == {1: (0, 1), 2: None, 3: (4, 0), 4: None}


def test_a_pair_of_page_and_question_is_one_row(spark):
    asked = spark.createDataFrame([("q", "red"), ("q", "lamp"), ("q", "sky"), ("twice", "red"), ("twice", "red"), (None, "red")], "question_id string, word string")
    held = spark.createDataFrame([("p", "red"), ("p", "lamp"), ("again", "red"), ("again", "red"), ("other", "moon"), (None, "red")], "path string, word string")
    pairs = [(q, p) for q in ("q", "twice", None) for p in ("p", "again", "other", None)]
    got = Q.overlaps_of(spark.createDataFrame(pairs, "question_id string, path string"), asked, held)
    assert plan_of(got).count("Generate") == 0 and not re.search(r"Join \[[^\]]*word#", plan_of(got))
    assert {(r.question_id, r.path): r.overlap for r in got.collect()} == {("q", "p"): 2, ("q", "again"): 2, ("twice", "p"): 2, ("twice", "again"): 4}
