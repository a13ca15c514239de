"""The whole audit on bylaws of several documents, one of which holds most pages, with its SQL.

Every order is a clause on a page of its own, in a lettered section of Part I or a numbered section of Part II. Cards are
made from the same orders, some with a defect: text that is nowhere printed (k % 23), items left out (k % 7) or run
together (k % 5), an anchor that is wrong (k % 17) or missing (k % 19), identifiers with a page suffix (k % 13), clauses
outside their section (k % 11), open references (k % 29) and a second card of the same text (k % 31). The audit gets cards
and pages alone; the SQL knows the defects.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexweave.operators import audit as A
from lexweave.plans import corpus as C
from lexweave.session import materialize
from lexweave.sources.tables import table

ROW = "doc", "card_id", "verdict", "severity", "issue", "required_fix", "confidence"
CARD = "doc", "card_id", "unit_type", "source_text", "page_start", "page_end", "parent_chain", "child_ids", "warning_ids"


def orders(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order: k, doc, places in the hierarchy, the lines of its page and its defects."""
    k = F.col("k")
    item = lambda e, i: F.concat(F.chr(i + 97), F.lit(". part "), e["p"], F.lit(" of "), k, F.lit(";"))
    rows = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("k"), F.struct(F.col("l_linenumber").alias("j"), F.col("l_partkey").alias("p")).alias("e"))
    # what is written is small; all else is made from it where it is read
    rows = materialize(rows.groupBy("k").agg(F.sort_array(F.collect_list("e")).alias("e")), "audit-orders")
    made = {
        "items": F.transform("e", item),
        "doc": F.when(k % 10 < 6, "acts-0").otherwise(F.concat(F.lit("acts-"), k % 10)),
        "second": k % 4 >= 2,
        "letter": F.chr((k % 9) * 2 + 97),
        "section": F.concat(F.lit(""), k % 30),
        "first": F.concat(k % 50 + 1, *[F.concat(F.lit(word), k) for word in (". Order ", " keeps q", " and m", " with r", " on these lines s")], F.lit(":")),
        "page": k + 1,
    }
    rows = rows.withColumns(made)
    collided, loose = ~F.col("second") & (k % 13 == 0), F.col("second") & (k % 11 == 0)
    part = F.concat("doc", F.when(F.col("second"), "-part-ii").otherwise("-part-i"))
    own = F.concat(part, F.lit("-section-"), F.when(F.col("second"), F.col("section")).otherwise(F.col("letter")))
    return rows.withColumns(
        {
            "heading": F.when(F.col("second"), F.concat(F.lit("Section "), "section", F.lit(": Order "), k)).otherwise(F.concat(F.upper("letter"), F.lit(". ORDER "), k)),
            "part": part, "own": own, "collided": collided,
            "card_id": F.concat(F.when(loose, part).otherwise(own), F.lit("-clause-"), k, F.when(collided, F.concat(F.lit("-p"), k)).otherwise("")),
            "parent_chain": F.when(loose, F.array("doc", part)).otherwise(F.array("doc", part, own)),
        }
    )


def bylaw_audit(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Cards and pages."""
    rows = orders(spark, folder)
    k, none = F.col("k"), F.array().cast("array<string>")
    text = (
        F.when(k % 23 == 0, F.concat(k % 50 + 1, F.lit(". Nothing of zz"), k, F.lit(" is printed.")))
        .when(k % 7 == 0, F.col("first"))
        .when(k % 5 == 0, F.array_join(F.concat(F.array("first"), "items"), " "))
        .otherwise(F.array_join(F.concat(F.array("first"), "items"), "\n"))
    )
    start = F.when(k % 17 == 0, F.lit(10**9)).when(k % 19 > 0, F.col("page"))
    clauses = rows.select(
        "doc", F.explode(F.when(k % 31 == 0, F.array("card_id", F.concat("card_id", F.lit("-again")))).otherwise(F.array("card_id"))).alias("card_id"), F.lit("clause").alias("unit_type"),
        text.alias("source_text"), start.alias("page_start"), start.alias("page_end"), "parent_chain", none.alias("child_ids"),
        F.when(k % 29 == 0, F.array(F.concat(F.lit("w-"), k))).otherwise(none).alias("warning_ids"),
    )
    firsts = rows.groupBy("doc", "part", "own").agg(F.min_by("heading", "k").alias("heading"), F.min("page").alias("page"), F.min(F.when(F.col("collided"), F.col("card_id"))).alias("child"))
    sections = firsts.select(
        "doc", F.col("own").alias("card_id"), F.lit("section").alias("unit_type"), F.col("heading").alias("source_text"), F.col("page").alias("page_start"), F.col("page").alias("page_end"),
        F.array("doc", "part").alias("parent_chain"), F.array_compact(F.array("child")).alias("child_ids"), none.alias("warning_ids"),
    )
    titles = ("-part-i", "Part I: GENERAL RULES"), ("-part-ii", "Part II: SPECIAL RULES")
    docs = rows.select("doc").distinct()
    parts = docs.select("doc", F.explode(F.array(*[F.struct(F.lit(s).alias("s"), F.lit(t).alias("t")) for s, t in titles])).alias("x")).select(
        "doc", F.concat("doc", "x.s").alias("card_id"), F.lit("part").alias("unit_type"), F.col("x.t").alias("source_text"), F.lit(1).cast("bigint").alias("page_start"),
        F.lit(1).cast("bigint").alias("page_end"), F.array("doc").alias("parent_chain"), none.alias("child_ids"), none.alias("warning_ids"),
    )
    pages = rows.select("doc", "page", F.array_join(F.concat(F.array("heading", "first"), "items"), "\n").alias("text"))
    front = docs.select("doc", F.lit(1).cast("bigint").alias("page"), F.lit("\n".join(t for _, t in titles)).alias("text"))
    cards = clauses.select(*CARD).unionByName(sections.select(*CARD)).unionByName(parts.select(*CARD))
    return cards, pages.unionByName(front)


def rows_of(spark: SparkSession, folder: str) -> DataFrame:
    return C.built(spark, folder, "audit-rows", lambda: A.audit(*bylaw_audit(spark, folder)).select(*ROW))


def audit_rows(spark: SparkSession, folder: str) -> DataFrame:
    return rows_of(spark, folder)


def audit_tallies(spark: SparkSession, folder: str) -> DataFrame:
    return A.tallies(rows_of(spark, folder))


def audit_patterns(spark: SparkSession, folder: str) -> DataFrame:
    return A.finding_patterns(rows_of(spark, folder))


def set_facts(spark: SparkSession, folder: str) -> DataFrame:
    facts = A.set_facts(bylaw_audit(spark, folder)[0])
    return facts.select("doc", "numbered_sections", *[F.array_join(name, "").alias(name) for name in ("letters", "hosts", "missing_letters")])


def collision_hosts(spark: SparkSession, folder: str) -> DataFrame:
    return A.collision_hosts(bylaw_audit(spark, folder)[0])


BYLAWS = """
WITH o AS (SELECT l_orderkey AS k, count(*) AS m FROM lineitem GROUP BY l_orderkey),
c AS (SELECT *, CASE WHEN k % 10 < 6 THEN 'acts-0' ELSE 'acts-' || (k % 10) END AS doc, k % 4 >= 2 AS second, chr(CAST(97 + k % 9 * 2 AS INTEGER)) AS letter, k % 30 AS section FROM o),
facts AS (SELECT doc, count(DISTINCT section) FILTER (second) AS numbered_sections,
    coalesce(list_sort(list(DISTINCT letter) FILTER (NOT second)), []) AS letters, coalesce(list_sort(list(DISTINCT letter) FILTER (NOT second AND k % 13 = 0)), []) AS hosts FROM c GROUP BY doc),
facts2 AS (SELECT *, CASE WHEN len(letters) = 0 THEN [] ELSE list_filter(list_transform(range(ascii(letters[1]), ascii(letters[-1]) + 1), lambda x: chr(CAST(x AS INTEGER))),
    lambda x: NOT list_contains(letters, x)) END AS missing FROM facts)
"""
AUDIT = BYLAWS + """, n AS (
  SELECT *, doc || CASE WHEN second AND k % 11 = 0 THEN '-part-ii' WHEN second THEN '-part-ii-section-' || section ELSE '-part-i-section-' || letter END
    || '-clause-' || k || CASE WHEN NOT second AND k % 13 = 0 THEN '-p' || k ELSE '' END AS id FROM c
), a AS (
  SELECT n.*, id AS card_id, false AS again FROM n UNION ALL SELECT n.*, id || '-again', true FROM n WHERE k % 31 = 0
), d AS (
  SELECT *, CASE WHEN k % 23 = 0 THEN 'Source text not confirmed on the extracted PDF text layer'
      WHEN k % 17 = 0 THEN 'Source text found only on PDF page(s) [' || (k + 1) || '], not anchored page 1000000000-1000000000'
      WHEN k % 19 = 0 THEN 'Missing source page anchor' END AS anchor,
    NOT second AND k % 13 = 0 AND NOT again AS misfiled, k % 17 > 0 AND k % 19 > 0 AS located,
    CASE WHEN k % 23 = 0 THEN 6 WHEN k % 7 = 0 THEN 13 ELSE 13 + 5 * m END AS card_tokens,
    CASE WHEN k % 23 = 0 THEN 2 WHEN k % 7 = 0 THEN 13 ELSE 13 + 5 * m END / (13 + 5 * m) AS recall FROM a
), e AS (
  SELECT *, located AND recall < 0.78 AND 13 + 5 * m > card_tokens + 8 AS omission FROM d
), f AS (
  SELECT *, anchor IS NOT NULL OR misfiled OR omission AS blocked, k % 29 = 0 AS warned FROM e
), g AS (
  SELECT *, second AND k % 11 = 0 AND NOT blocked AS flat_section, located AND (k % 7 = 0 OR k % 5 = 0) AND NOT blocked AS flat_list,
    k % 31 = 0 AND card_tokens > 8 AND NOT blocked AS duplicate FROM f
), clauses AS (
  SELECT doc, card_id, 'clause' AS unit_type, blocked, flat_section OR flat_list AS structural, warned OR duplicate AS minor, k % 23 <> 0 AND anchor IS NULL AS sure,
    concat_ws(' ', anchor,
      CASE WHEN misfiled THEN 'Part I Section ' || upper(chr(ascii(letter) + 1)) || ' clause is misidentified as Section ' || upper(letter) || '; title, slug, parent, and hierarchy are wrong.' END,
      CASE WHEN omission THEN 'Card source text omits or splices required PDF clause text; card captures about ' || CAST(round_even(recall * 100, 0) AS BIGINT) || '% of the extracted clause segment.' END,
      CASE WHEN flat_section THEN 'Part II numeric section hierarchy is flattened; card is parented directly under Part II or a page-suffixed letter section instead of Section N.' END,
      CASE WHEN flat_list THEN 'Nested source list structure is flattened into paragraph text, which loses legal hierarchy even where words are present.' END,
      CASE WHEN warned THEN 'Unresolved-reference warning is accurately carried as review metadata and should remain visible for import review.' END,
      CASE WHEN duplicate THEN 'Exact source text is shared with another card: ' || id || ', ' || id || '-again.' END) AS found,
    concat_ws(' ', CASE WHEN anchor IS NOT NULL THEN 'Re-anchor to the PDF page containing the source text and re-run source-text verification.' END,
      CASE WHEN misfiled THEN 'Create/use the Part I Section ' || upper(chr(ascii(letter) + 1)) || ' parent and move this clause under it with the correct clause ID/title.' END,
      CASE WHEN omission THEN 'Regenerate this clause from the full PDF clause segment, preserving nested list items and page-spanning text.' END,
      CASE WHEN flat_section THEN 'Add numbered Section parent cards and reparent/rename this card under its true Section N heading.' END,
      CASE WHEN flat_list THEN 'Represent lower-alpha/roman subclauses as nested structure or separate child units with source page attribution.' END,
      CASE WHEN warned THEN 'Resolve the target if a stable Clause Card exists; otherwise keep the unresolved warning attached.' END,
      CASE WHEN duplicate THEN 'Confirm this is a legitimate repeated heading/text, or deduplicate if it is an artifact copy.' END) AS fix FROM g
), heads AS (
  SELECT DISTINCT c.doc, c.doc || '-part-i-section-' || letter AS card_id, 'section' AS unit_type, CASE WHEN list_contains(hosts, letter) THEN
    'This lettered Part I section carries collision-suffixed child clauses that belong to a missing sibling section; remove them from this section''s child metadata.' END AS gap
  FROM c JOIN facts2 USING (doc) WHERE NOT second
  UNION ALL SELECT DISTINCT doc, doc || '-part-ii-section-' || section, 'section', NULL FROM c WHERE second
  UNION ALL SELECT doc, doc || '-part-i', 'part', CASE WHEN len(missing) > 0 THEN 'Part I lettered section sequence is missing Section '
    || array_to_string(list_transform(missing, lambda x: upper(x)), ', ') || ' from the generated hierarchy; an adjacent section is carrying its clauses.' END FROM facts2
  UNION ALL SELECT doc, doc || '-part-ii', 'part', CASE WHEN numbered_sections = 0 THEN
    'Part II numeric section hierarchy is flattened; card is parented directly under Part II or a page-suffixed letter section instead of Section N.' END FROM facts2
), everything AS (
  SELECT * FROM clauses UNION ALL SELECT doc, card_id, unit_type, false, gap IS NOT NULL, false, true, coalesce(gap, ''),
    CASE WHEN gap IS NULL THEN '' WHEN gap LIKE 'Part II%' THEN 'Add numbered Section parent cards and reparent/rename this card under its true Section N heading.'
      ELSE 'Add the missing Part I section card and correct the affected child metadata.' END FROM heads
), final AS (
  SELECT doc, card_id, CASE WHEN blocked THEN 'BLOCKED_UNSAFE_TO_IMPORT' WHEN structural THEN 'NEEDS_STRUCTURAL_FIX' WHEN minor THEN 'NEEDS_MINOR_FIX' ELSE 'PASS' END AS verdict,
    CASE WHEN blocked THEN 'P0' WHEN structural THEN 'P1' ELSE 'P2' END AS severity,
    CASE WHEN found = '' THEN 'No source-fidelity, anchor, hierarchy, duplicate, or warning issue found in this audit.' ELSE found END AS issue,
    CASE WHEN fix = '' THEN 'None.' ELSE fix END AS required_fix,
    CASE WHEN NOT (blocked OR structural OR minor) AND unit_type <> 'clause' THEN 'medium-high' WHEN sure THEN 'high' ELSE 'medium' END AS confidence FROM everything
)
"""

QUERIES = {
    "audit_rows": (audit_rows, AUDIT + "SELECT * FROM final"),
    "audit_tallies": (
        audit_tallies,
        AUDIT + """, t AS (SELECT count(*) AS reviewed, count(*) FILTER (WHERE verdict = 'PASS') AS passed, count(*) FILTER (WHERE verdict LIKE 'NEEDS%') AS needs_fixes,
          count(*) FILTER (WHERE verdict LIKE 'BLOCKED%') AS blocked, count(*) FILTER (WHERE severity = 'P1') AS p1_count,
          count(*) FILTER (WHERE severity = 'P2' AND verdict <> 'PASS') AS p2_count FROM final)
        SELECT CASE WHEN blocked > 0 THEN 'FAIL' WHEN needs_fixes > 0 THEN 'PASS_WITH_FIXES' ELSE 'PASS' END AS full_verdict, * FROM t""",
    ),
    "audit_patterns": (
        audit_patterns,
        AUDIT + """SELECT rtrim(split_part(issue, '. ', 1), '.') || '.' AS pattern, count(*) AS cards, min(card_id) AS first_card FROM final WHERE severity = 'P1' GROUP BY 1""",
    ),
    "set_facts": (
        set_facts,
        BYLAWS + """SELECT doc, numbered_sections, array_to_string(letters, '') AS letters, array_to_string(hosts, '') AS hosts, array_to_string(missing, '') AS missing_letters FROM facts2""",
    ),
    "collision_hosts": (collision_hosts, BYLAWS + "SELECT doc, doc || '-part-i-section-' || unnest(hosts) AS card_id FROM facts2"),
}
