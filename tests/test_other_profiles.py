import random

import pytest

from lexweave.operators import references as R
from lexweave.operators.generic import parse_generic
from lexweave.operators.invariants import unit_issues
from lexweave.operators.policy import parse_policies
from lexweave.sources.markdown import heading_stack, markdown_blocks, source_lines


def test_policy_dates_bodies_and_roman_lookalikes(page_blocks, documents):
    pages = [
        "Intro\nSection 1: Stances\nI. CARDS\n(a) No cards are sold\nat any desk.\n1. kept in the body\n(b) Space may be lent.\n"
        "Adopted: March 2002\nlater line\n1. dropped here\nAmended: May 2010\n(c) Added late.\nAmended: June 2011\n(d) Last.\n",
        "II. TRAVEL\n(a) Go by train.\nc. looks roman\n(b) Walk.\n",
    ]
    parsed = parse_policies(documents(), page_blocks(pages))
    units = {u.clause_id: u for u in parsed.units.collect()}
    first = "sample-section-1-policy-i"
    assert units[f"{first}-provision-a"].text == "(a) No cards are sold at any desk. 1. kept in the body"
    assert units[f"{first}-provision-b"].text == "(b) Space may be lent. later line"
    dates = {"adopted_date": "March 2002", "amended_dates": "June 2011"}
    assert units[first].metadata == dates
    assert units[f"{first}-provision-a"].metadata == dates and units[f"{first}-provision-c"].metadata == dates
    assert units[f"{first}-provision-d"].metadata is None
    assert units[f"{first}-provision-a"].parent_chain == ["sample", "sample-section-1", first]
    # Any case of roman digits opens a policy, so "c. looks roman" is one.
    assert units["sample-section-1-policy-c"].title == "looks roman"
    assert units["sample-section-1-policy-c-provision-b"].text == "(b) Walk."
    assert parsed.errors.count() == 0


def test_policy_order_errors(page_blocks, documents):
    parsed = parse_policies(documents(), page_blocks(["Section 1: S\n(a) early\nAdopted: May 2000\nI. P\n(a) fine\n"]))
    assert sorted(r.line for r in parsed.errors.collect()) == ["(a) early", "Adopted: May 2000"]


SOURCE = """# Fictional fixture: Sample Rules

## Section 1 - Notices

1.1 Lists must be kept.

1.2 "Listed member" means a member on the list.
1.3 Notices are read with the Other Policy.
plain text is not kept

#### Notes

Nothing numbered here.

## Article 4: Shifts
4.1 Subject to section 1.1.
"""


@pytest.fixture(scope="module")
def generic(spark):
    files = spark.createDataFrame([("sample", SOURCE)], "slug string, text string")
    docs = spark.createDataFrame(
        [("sample", "Sample Rules", 0), ("other", "Other Policy", 1)], "slug string, title string, doc_ord bigint"
    )
    blocks = markdown_blocks(files)
    return blocks, parse_generic(docs.where("slug = 'sample'"), blocks), docs


def test_markdown_blocks(generic):
    blocks = {b.block_id: b for b in generic[0].collect()}
    assert list(blocks["sample-L1-L1"].heading_path) == ["Fictional fixture: Sample Rules"]
    assert blocks["sample-L7-L9"].text.splitlines()[2] == "plain text is not kept"
    assert list(blocks["sample-L13-L13"].heading_path) == ["Fictional fixture: Sample Rules", "Section 1 - Notices", "Notes"]
    assert (blocks["sample-L16-L16"].block_type, blocks["sample-L5-L5"].block_type) == ("body", "body")


def test_generic_units_definitions_and_references(generic):
    _, parsed, docs = generic
    units = {u.clause_id: u for u in parsed.units.collect()}
    assert set(units) == {"sample", "sample-section-1", "sample-1.1", "sample-1.2", "sample-1.3", "sample-article-4", "sample-4.1"}
    assert units["sample-1.3"].parent_chain == ["sample", "sample-section-1"] and units["sample-1.3"].line_start == 8
    assert units["sample-article-4"].title == "Shifts"
    assert [r.block_id for r in parsed.unparsed.collect()] == ["sample-L13-L13"]
    terms = R.definitions(parsed.units).collect()
    assert [(t.term, t.slug, t.source_unit_id, t.definition_text) for t in terms] == [
        ("Listed member", "listed-member", "sample-1.2", '"Listed member" means a member on the list.')
    ]
    refs = {r.reference_type: r for r in R.resolve(R.references(parsed.units), parsed.units, docs).collect()}
    assert refs["read_with"].resolved_target_slug == "other" and refs["read_with"].reference_id == "sample-1.3-read_with-1"
    assert refs["subject_to"].reference_text == "1.1" and refs["subject_to"].resolved_target_id == "sample-1.1"
    alone = {r.reference_type: r for r in R.resolve(R.references(parsed.units), parsed.units, docs.where("slug = 'sample'")).collect()}
    assert alone["read_with"].resolution_status == "unresolved"
    assert unit_issues(parsed.units).count() == 0


def test_reference_types(spark):
    text = (
        "1. Despite section 2, this amends section 3.1. It supersedes the old code. Except on Sunday. "
        "It prevails over an older rule. See under section 4.2 here. Read with the Code"
    )
    df = spark.createDataFrame([(text,)], "text string")
    found = df.select(R.reference_matches(df.text).alias("m")).first().m
    assert [(m.reference_type, m.reference_text) for m in found] == [
        ("read_with", "Code"),
        ("despite", "2, this amends section 3"),
        ("exception_to", "on Sunday"),
        ("amends", "3.1"),
        ("supersedes", "the old code"),
        ("higher_authority_than", "older rule"),
        ("section_reference", "4.2"),
    ]


def test_heading_stack_matches_a_running_list(spark):
    rng = random.Random(5)
    texts, want = [], {}
    for n in range(25):
        lines, stack, paths = [], [], []
        for i in range(rng.randint(1, 25)):
            level = rng.randint(1, 6)
            lines += ["#" * level + f" t{i}", "body"]
            stack = stack[: level - 1] + [f"t{i}"]
            paths.append(list(stack))
        texts.append((f"d{n}", "\n".join(lines)))
        want[f"d{n}"] = paths
    got = {}
    df = heading_stack(source_lines(spark.createDataFrame(texts, "slug string, text string"))).where("level is not null")
    for row in df.orderBy("slug", "line_no").collect():
        got.setdefault(row.slug, []).append(list(row.heading_path))
    assert got == want
