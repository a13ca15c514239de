import random

import pytest
from pyspark.sql import functions as F

from lexweave.operators.bylaws import outline, parse_bylaws, unit_rows
from lexweave.operators.flows import flow_parts, with_flow_text


@pytest.fixture(scope="module")
def parse(page_blocks, documents):
    def run(*pages, page_count=None):
        parsed = parse_bylaws(documents(), page_blocks(list(pages), page_count=page_count))
        return {row.clause_id: row for row in parsed.units.collect()}, parsed.errors

    return run


Z = "​"


def test_bare_letter_takes_mixed_case_title_from_next_line(parse):
    units, _ = parse(
        f"Part I: An Act\nG.{Z}SEALS\n1.{Z} The seal is kept.\n2.{Z} Deeds need the seal.\nH.{Z}{Z}\nBy Rules\n"
        f"Subject to the rules, the board may\n1.{Z} form groups; and\n2.{Z} meet.\n"
    )
    section = units["sample-part-i-section-h"]
    assert (section.title, section.unit_type) == ("By Rules", "section")
    assert section.text == "H. By Rules\nSubject to the rules, the board may"
    assert units["sample-part-i-section-h-clause-1"].parent_clause_id == "sample-part-i-section-h"
    assert "By Rules" not in units["sample-part-i-section-g-clause-2"].text
    assert not [cid for cid in units if "-p1" in cid]


def test_printed_page_number_between_letter_and_title_defeats_the_heading(parse):
    units, _ = parse("Part I: X\nA. FIRST\n1. One.\nB.\n7\nSecond Title\n2. Two.\n")
    assert "sample-part-i-section-b" not in units
    assert units["sample-part-i-section-a-clause-1"].text == "1. One. B. Second Title"


def test_numbered_section_joins_wrapped_title_and_parents_letters(parse):
    units, _ = parse(
        f"Part II: Rules\nSection 8: Board Seats\nand Duties\nA.{Z}SEATS\nDirectors speak for these wards:\n"
        f"1.{Z} Faculty seats\na.{Z} These are elected:\ni.{Z} Arts seat\nii.{Z} Trade seat\n"
    )
    section = units["sample-part-ii-section-8"]
    assert (section.number, section.title) == ("8", "Board Seats and Duties")
    assert section.text == "Section 8: Board Seats and Duties"
    letter = units["sample-part-ii-section-8-a"]
    assert letter.parent_clause_id == section.clause_id
    assert letter.text == "A. SEATS\nDirectors speak for these wards:"
    clause = units["sample-part-ii-section-8-a-clause-1"]
    assert clause.text == "1. Faculty seats\na. These are elected:\n  i. Arts seat\n  ii. Trade seat"
    assert clause.parent_chain == ["sample", "sample-part-ii", "sample-part-ii-section-8", "sample-part-ii-section-8-a"]
    assert clause.title == "SEATS 1"


def test_clause_directly_below_numbered_section(parse):
    units, _ = parse("Part II: Rules\nSection 6: Elections\n1. Held in spring.\n2. Seats are filled.\n")
    assert units["sample-part-ii-section-6-clause-1"].parent_clause_id == "sample-part-ii-section-6"


def test_long_letter_lists_stay_letters(parse):
    items = "".join(f"{c}.{Z} duty {c};\n" for c in "abcdefghijklm")
    units, _ = parse(f"Part II: R\nSection 8: B\nB.{Z}DUTIES\n1.{Z} All shall:\n{items}2.{Z} Report.\n")
    text = units["sample-part-ii-section-8-b-clause-1"].text
    assert all(f"\n{c}. duty {c};" in text for c in "abcdefghijklm")


def test_page_spans_bare_markers_and_run_in_items(parse):
    units, _ = parse(
        "Part II: R\nSection 12: C\nD. BODY\n4. The group works under a board of\n",
        f"Directors.\n5. The board guides:\nvii.{Z} Arts: the arts club;\nviii.{Z}\nTrade: the trade club;\n"
        "b. Other wards: xiii. River seat: the centre;\n",
    )
    spanning, after = units["sample-part-ii-section-12-d-clause-4"], units["sample-part-ii-section-12-d-clause-5"]
    assert (spanning.page, spanning.page_end) == (1, 2)
    assert spanning.text.endswith("a board of Directors.")
    assert (after.page, after.page_end) == (2, None)
    assert after.text == (
        "5. The board guides:\n  vii. Arts: the arts club;\n  viii. Trade: the trade club;\n"
        "b. Other wards:\n  xiii. River seat: the centre;"
    )


def test_section_body_stays_with_the_section(parse):
    units, _ = parse("Part II: R\nSection 7: V\nA. START\n1. Any time.\nB. STEPS\na. Only in fall.\nb. Soon.\nC. VOTE\n1. Open.\n")
    assert units["sample-part-ii-section-7-b"].text == "B. STEPS\na. Only in fall.\nb. Soon."
    assert units["sample-part-ii-section-7-a-clause-1"].text == "1. Any time."


def test_act_title_reaches_all_lettered_sections_after_it(parse):
    units, _ = parse("Part I: C\nAn Act to Found a Club\nA. NAME\nThe act may be cited.\nB. WORDS\n1. \"rule\" means a rule;\nPart II: D\nA. OTHER\n1. x\n")
    assert units["sample-part-i-section-a"].metadata == {"act_title": "An Act to Found a Club"}
    assert units["sample-part-i-section-b"].metadata == {"act_title": "An Act to Found a Club"}
    assert units["sample-part-ii-section-a"].metadata is None
    assert units["sample-part-i-section-a"].text == "A. NAME\nThe act may be cited."


def test_collisions_take_page_and_counter_and_pass_on_to_children(parse):
    units, _ = parse(
        "Part I: A\nSection 1: S\n1. a\n1. b\n", "1. c\n1. d\n1. e\nSection 1: T\nA. X\n1. f\n", "Part I: B\nSection 1: U\n1. g\n"
    )
    base = "sample-part-i-section-1"
    assert {units[k].text for k in (f"{base}-clause-1", f"{base}-clause-1-p1")} == {"1. a", "1. b"}
    assert [units[f"{base}-clause-1-p2{s}"].text for s in ("", "-2", "-3")] == ["1. c", "1. d", "1. e"]
    assert units[f"{base}-p2-a-clause-1"].parent_chain == ["sample", "sample-part-i", f"{base}-p2", f"{base}-p2-a"]
    assert units["sample-part-i-p3-section-1-clause-1"].text == "1. g"


def test_front_pages_are_dropped_only_for_long_documents(parse):
    pages = ["Part I: Contents\nSection 1: Old\n1. x"] + ["3"] * 3 + ["Part II: Real\nSection 2: New\n1. y"]
    units, _ = parse(*pages, page_count=40)
    assert [u for u in units if "part-i-" in u or u.endswith("part-i")] == []
    units, _ = parse(*pages)
    assert "sample-part-i-section-1-clause-1" in units


@pytest.mark.parametrize("stated, dropped", [(0, False), (4, True), (1, True), (None, True)])
def test_the_manifest_states_the_front_pages(page_blocks, documents, stated, dropped):
    pages = ["Part I: Contents\nSection 1: Old\n1. x"] + ["3"] * 3 + ["Part II: Real\nSection 2: New\n1. y"]
    blocks = page_blocks(pages, page_count=40).withColumn("front_pages", F.lit(stated).cast("int"))
    units = {u.clause_id for u in parse_bylaws(documents(), blocks).units.collect()}
    assert ("sample-part-i-section-1-clause-1" not in units) is dropped and "sample-part-ii-section-2-clause-1" in units


def test_lines_after_dates_and_dropped_lines(parse):
    units, errors = parse(
        "stray\nPart I: A\nlost text\nSection 1: S\nlost too\nA. X\n1. one\nAdopted: May 1990\n(q) dropped\nkept text\n(z) kept inside\nB. Y\n(a) dropped\nAdopted: June 1991\nbody\n"
    )
    assert units["sample-part-i-section-1-a-clause-1"].text == "1. one\nkept text (z) kept inside"
    assert units["sample-part-i-section-1-b"].text == "B. Y\nbody"
    assert errors.count() == 0


def test_clause_without_section_is_an_error(parse):
    units, errors = parse("Part I: A\n1. too early\nSection 1: S\n2. fine\n")
    assert [row.line for row in errors.collect()] == ["1. too early"]
    assert "sample-part-i-section-1-clause-2" in units


def test_list_markers_match_a_sequential_reading(spark):
    """Settling all markers at once equals reading them one by one with the next expected letter."""
    rng = random.Random(3)
    rows, want = [], {}
    for n in range(60):
        lines, out, expected = [], [], "a"
        for i in range(rng.randint(1, 30)):
            marker = rng.choice(["a", "b", "c", "d", "h", "i", "j", "k", "l", "m", "u", "v", "w", "x", "ii", "iv", "", expected])
            if not marker:
                lines.append(f"text {i}")
                out.append(("" if not out else " ") + f"text {i}")
                continue
            letter = len(marker) == 1 and (marker == expected or marker not in "ivxlcdm")
            expected = chr(min(ord(marker) + 1, 122)) if letter else expected
            lines.append(f"{marker}. item {i}")
            out.append(("\n" if out else "") + ("" if letter else "  ") + f"{marker}. item {i}")
        rows += [(n, i, line) for i, line in enumerate(lines)]
        want[n] = "".join(out)
    df = spark.createDataFrame(rows, "n int, i int, line string")
    grouped = df.withColumn("p", F.explode(flow_parts(F.col("line")))).groupBy("n").agg(
        F.sort_array(F.collect_list(F.struct("i", F.lit(0).alias("flow"), "p.part", "p.code"))).alias("parts")
    )
    got = {r.n: r.text for r in with_flow_text(grouped, "parts", "text").collect()}
    assert got == want


def test_structure_is_read_without_texts(page_blocks, documents):
    pages = ["Part I: X\nAn Act\nA. FIRST\nOpening line.\n1. One\na. sub;", "b. more.\nAdopted: May\nB. SECOND\n1. Two."]
    found = outline(page_blocks(pages))
    whole = {u.clause_id: u for u in parse_bylaws(documents(), page_blocks(pages)).units.collect() if not u.is_top_level}
    bare = unit_rows(found, texts=False)
    names = ["clause_id", "parent_clause_id", "parent_chain", "number", "title", "unit_ord", "page", "metadata"]
    assert {tuple(map(str, r)) for r in bare.select(*names).collect()} == {tuple(str(u[n]) for n in names) for u in whole.values()}
    plan = bare.select("clause_id", "parent_chain")._jdf.queryExecution().executedPlan().toString()
    assert "entries" not in plan
    # text and last page go on over the border of a page
    clause = whole["sample-part-i-section-a-clause-1"]
    assert (clause.text, clause.page_end) == ("1. One\na. sub;\nb. more.", 2)
