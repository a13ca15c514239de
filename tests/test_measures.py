import json
import random
import re

import pytest
from pyspark.sql import functions as F

from lexweave.operators import audit as A
from lexweave.operators import retrieval as Q
from lexweave.operators.quality import compare_quality
from lexweave.operators.register import release_batches, warning_links
from lexweave.sources import ocr_json as O

RESPONSE = {
    "job_id": "j1", "duration": 8.0, "usage": {"num_pages": 1},
    "result": {
        "type": "full",
        "chunks": [
            {"content": "x", "blocks": [
                {"id": "b1", "type": "paragraph", "text": "Garbled tex7.", "page": 3, "bbox": [0.1, 0.2, 0.3, 0.4], "confidence": "low", "parse_confidence": 0.42},
                {"id": "b2", "text": "", "page": "4", "original_page": 9, "confidence": "High", "bbox": [0.1, "bad"]},
            ]},
            {"content": "own block", "page": 5, "confidence": 0.8},
            {"content": "", "blocks": []},
            {"blocks": [{"text": "no page", "confidence": "medium"}]},
        ],
    },
}


def test_ocr_response(spark):
    responses = spark.createDataFrame([("scan", json.dumps(RESPONSE))], "slug string, json string")
    blocks = O.response_blocks(responses)
    rows = blocks.orderBy("block_ord").collect()
    assert [r.block_id for r in rows] == ["b1", "b2", "scan-p5-c2-b1", "scan-punknown-c4-b1"]
    assert [r.confidence for r in rows] == [0.42, 1.0, 0.8, 0.75]
    assert [(r.page, r.original_page) for r in rows] == [(3, 3), (4, 9), (5, 5), (None, None)]
    assert [r.bbox for r in rows] == [[0.1, 0.2, 0.3, 0.4], None, None, None]
    assert [(w.category, w.page) for w in O.block_warnings(blocks).orderBy("block_ord").collect()] == [
        ("ocr_low_confidence", 3), ("ocr_empty", 4)
    ]
    head = O.response_headers(responses, blocks).first()
    assert (head.status, head.page_count, head.duration, head.warning_count) == ("review_required", 1, 8.0, 2)


@pytest.mark.parametrize(
    "status, name, message, category",
    [
        (401, "ApiError", "", "provider_auth"), (None, "PermissionDenied", "", "provider_auth"), (429, "E", "", "provider_rate_limit"),
        (None, "E", "Rate limit hit", "provider_rate_limit"), (504, "E", "", "provider_timeout"), (442, "E", "", "pdf_password_protected"),
        (415, "E", "", "pdf_corrupt_or_unsupported"), (None, "ConnectionError", "", "provider_connection"),
        (422, "E", "", "provider_validation"), (500, "E", "", "provider_api_error"), (None, "E", "", "unknown_provider_error"),
    ],
)
def test_error_categories(spark, status, name, message, category):
    df = spark.createDataFrame([(status, name, message)], "s int, n string, m string")
    assert df.select(O.error_category(F.col("s"), F.col("n"), F.col("m"))).first()[0] == category


def test_quality_decisions(spark):
    base = {
        "provider": "local", "success": True, "page_count": 10, "page_anchor_coverage": 10, "part_headings": 2, "lettered_sections": 5,
        "numbered_clauses": 9, "definitions": 1, "duplicate_heading_ids": 0, "missing_heading_ids": 0, "hierarchy_transition_errors": 0,
        "unresolved_reference_warnings": 3, "material_warnings": 2, "source_hash": "a", "deterministic_id_fingerprint": "f",
    }
    other = base | {"provider": "ocr"}
    cases = [
        (other, "ocr", ["candidate_structurally_equivalent"]),
        (other | {"material_warnings": 1, "unresolved_reference_warnings": 1}, "ocr", ["material_warnings_reduced", "unresolved_reference_warnings_reduced"]),
        (other | {"success": False, "source_hash": "b", "definitions": 0, "missing_heading_ids": 1}, "local",
         ["candidate_failed", "source_hash_changed", "definitions_lost", "missing_heading_ids_increased"]),
    ]
    fields = ", ".join(f"{k}: {'boolean' if isinstance(v, bool) else 'int' if isinstance(v, int) else 'string'}" for k, v in base.items())
    order = list(base)
    rows = [(i, tuple(base[k] for k in order), tuple(c[k] for k in order)) for i, (c, _, _) in enumerate(cases)]
    df = spark.createDataFrame(rows, f"i int, local struct<{fields}>, candidate struct<{fields}>")
    got = compare_quality(df).orderBy("i").collect()
    assert [(r.selected_provider, r.reasons) for r in got] == [(p, reasons) for _, p, reasons in cases]


def test_ranking_matches_brute_force(spark):
    rng = random.Random(11)
    vocabulary = ["board", "vote", "Member", "notice", "a", "seal", "clause", "xboard", "été", "7"]
    pages = [(f"p/{i:02}.md", " ".join(rng.choices(vocabulary, k=rng.randint(0, 8)))) for i in range(30)]
    questions = [(f"q{i}", " ".join(rng.choices(vocabulary, k=rng.randint(1, 5)))) for i in range(12)]
    questions += [("short", "oar"), ("one", "b"), ("inner", "oard vo"), ("none", "zzz"), ("empty", ""), ("sign", "é")]
    got = {}
    hits = Q.rank_pages(
        spark.createDataFrame(pages, "path string, haystack string"), spark.createDataFrame(questions, "question_id string, question string"), 4
    )
    for row in hits.orderBy("question_id", "rank").collect():
        got.setdefault(row.question_id, []).append((row.path, row.score))
    word = lambda t: {w.lower() for w in re.findall("[A-Za-z0-9]+", t)}
    for name, question in questions:
        scores = [(float(len(word(question) & word(h)) + (2 if question.lower() in h.lower() else 0)), p) for p, h in pages]
        best = sorted(((-s, p) for s, p in scores if s > 0))[:4]
        assert got.get(name, []) == [(p, -s) for s, p in best], name


NUMBERS = [f"w{i}" for i in range(1, 21)]
PAGES = {
    1: "A. NAME\nThe club is named Sample Society and keeps\nthat name for all time.\n1",
    2: "B.\nOBJECTS\nThe objects of the club are to row, to sing and to keep the boat house in good order for the members who\n2",
    3: "pay their dues before the first day of May in every year.\nMembers may vote.\n3",
    4: "Members may vote.\n" + " ".join(NUMBERS) + "\n4",
}
FOUND = [
    ("", []),
    (".", [1, 2, 3, 4]),
    ("The club is named Sample Society and keeps that name for all time.", [1]),
    ("the CLUB \n is named", [1]),
    ("the club was named", []),
    # a heading whose letter stands above its title, and words alone without a letter
    ("B OBJECTS", [2]),
    ("OBJECTS B", []),
    ("Members may vote.", [3, 4]),
    # the first or the last eight words of at least fourteen
    ("The objects of the club are to row but other words follow from here on", [2]),
    ("Wholly other words stand here at first pay their dues before the first day of", [3]),
    ("The objects of the club are to row but other words", []),
    # 17 and 16 of 20 words, in another order
    (" ".join([*NUMBERS[:2:-1], "x", "y", "z"]), [4]),
    (" ".join([*NUMBERS[:3:-1], "x", "y", "z", "q"]), []),
    # every line for itself: short ones by their words, longer ones as they stand or by nine tenths of their words
    ("Members may vote.\nw3 w9", [4]),
    ("Members may vote.\nnowhere at all", []),
    ("Members may vote.\n" + " ".join([*NUMBERS[:9], "x"]), [4]),
    ("Members may vote.\n" + " ".join([*NUMBERS[:8], "x", "y"]), []),
    # over the end of a page, where its number stands
    ("the members who pay their dues", [2, 3]),
    ("the members who 2 pay their dues", []),
]


def test_found_pages(spark):
    cards = spark.createDataFrame([("d", f"c{i}", t) for i, (t, _) in enumerate(FOUND)], "doc string, card_id string, source_text string")
    pages = spark.createDataFrame([("d", n, t) for n, t in PAGES.items()], "doc string, page int, text string")
    got = {r.card_id: list(r.pages) for r in A.found_pages(cards, pages).collect()}
    for i, (text, want) in enumerate(FOUND):
        assert got.get(f"c{i}", []) == want, text


def test_segments_and_recall(spark):
    pages = [
        ("d", 1, "Section 3: Rules\nA. VOTES\n1. Each member votes\na. once;\nb. in person.\n2. The chair counts.\n1"),
        ("d", 2, "and declares.\nB.\nQuorum\n1. Ten members\nform a quorum.\nOther heading\nC.\nLast\n1. Each member leaves."),
    ]
    cards = [
        ("d", "a1", "clause", "1. Each member votes\na. once;\nb. in person.", 1, 1),
        ("d", "a2", "clause", "2. The chair counts. and declares.", 1, 2),
        ("d", "b1", "clause", "1. Ten members form a quorum.", 2, 2),
        ("d", "sec", "section", "1. Not a clause", 1, 1),
        ("d", "lost", "clause", "9. Nowhere", 1, 1),
    ]
    df = spark.createDataFrame(cards, "doc string, card_id string, unit_type string, source_text string, page_start int, page_end int")
    page_df = spark.createDataFrame(pages, "doc string, page int, text string")
    got = {r.card_id: r.segment for r in A.clause_segments(df, page_df).collect()}
    assert got == {
        "a1": "1. Each member votes a. once; b. in person.",
        # A letter whose title follows on the next line ends a segment only through a short line before it.
        "a2": "2. The chair counts. and declares. B. Quorum 1. Ten members form a quorum.",
        "b1": "1. Ten members form a quorum.",
    }
    pairs = spark.createDataFrame([(1, "a b b c", "b b b x"), (2, "", "a"), (3, "a", "a")], "k int, s string, c string")
    recall = {r.k: r.recall for r in A.token_recall(pairs, ["k"], F.col("s"), F.col("c")).collect()}
    assert recall == {1: 0.5, 2: 1.0, 3: 1.0}


def test_audit_of_a_small_set(spark):
    pages = [(5, "Part I: BASICS\nA. NAME\n1. The club is named Sample and it keeps that name.\nC. SEAL\n1. Kept safe.\n"),
             (6, "Part II: RULES\nSection 1: Votes\n1. Members vote.\n")]
    def card(cid, kind, text, start, chain, children=(), warnings=()):
        return ("club", cid, kind, text, start, start, list(chain), list(children), list(warnings))
    cards = [
        card("club-part-i", "part", "Part I: BASICS", 5, ["club"]),
        card("club-part-i-section-a", "section", "A. NAME", 5, ["club", "club-part-i"]),
        card("club-part-i-section-a-clause-1", "clause", "1. The club is named Sample and it keeps that name.", 5, ["club", "club-part-i"], warnings=["w-1"]),
        card("club-part-i-section-c", "section", "C. SEAL", 5, ["club", "club-part-i"], children=["club-part-i-section-c-clause-1-p5"]),
        card("club-part-i-section-c-clause-1-p5", "clause", "1. Kept safe.", 5, ["club", "club-part-i"]),
        card("club-part-ii", "part", "Part II: RULES", 6, ["club"]),
        card("club-part-ii-section-1", "section", "Section 1: Votes", 6, ["club", "club-part-ii"]),
        card("club-part-ii-section-1-clause-1", "clause", "1. Members vote.", 6, ["club", "club-part-ii", "club-part-ii-section-1"]),
        card("club-part-ii-x", "clause", "1. Members vote.", 5, ["club", "club-part-ii"]),
    ]
    df = spark.createDataFrame(
        cards, "doc string, card_id string, unit_type string, source_text string, page_start int, page_end int, "
        "parent_chain array<string>, child_ids array<string>, warning_ids array<string>",
    )
    page_df = spark.createDataFrame([("club", n, t) for n, t in pages], "doc string, page int, text string")
    rows = {r.card_id: r for r in A.audit(df, page_df).collect()}
    short = {k.removeprefix("club-"): (r.verdict.split("_")[0], r.severity, r.confidence) for k, r in rows.items()}
    assert short == {
        "part-i": ("NEEDS", "P1", "high"),
        "part-i-section-a": ("PASS", "P2", "medium-high"),
        "part-i-section-a-clause-1": ("NEEDS", "P2", "high"),
        "part-i-section-c": ("NEEDS", "P1", "high"),
        "part-i-section-c-clause-1-p5": ("BLOCKED", "P0", "high"),
        "part-ii": ("PASS", "P2", "medium-high"),
        "part-ii-section-1": ("PASS", "P2", "medium-high"),
        "part-ii-section-1-clause-1": ("PASS", "P2", "high"),
        "part-ii-x": ("BLOCKED", "P0", "medium"),
    }
    assert "missing Section B" in rows["club-part-i"].issue
    total = A.tallies(A.audit(df, page_df)).first()
    assert (total.full_verdict, total.reviewed, total.passed, total.needs_fixes, total.blocked) == ("FAIL", 9, 4, 3, 2)


def test_batches_and_register_links(spark):
    cards = spark.range(63).select(
        F.format_string("c-%02d", "id").alias("card_id"), F.col("id").cast("int").alias("page"), (F.col("id") % 2).alias("section_key")
    )
    got = release_batches(cards).orderBy("batch").collect()
    assert [(r.batch, r.cards, r.first_page, r.last_page, r.sections) for r in got] == [(1, 25, 0, 24, 2), (2, 25, 25, 49, 2), (3, 13, 50, 62, 2)]
    old = spark.createDataFrame([("c1", "w1"), ("c1", "w0"), ("", "w2")], "source_clause string, warning_id string")
    assert [(r.card_id, r.warning_ids) for r in warning_links(old).collect()] == [("c1", ["w0", "w1"])]
