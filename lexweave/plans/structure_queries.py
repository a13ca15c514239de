"""Queries on the parsed structure, and the SQL that answers them from the base tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexweave.operators import invariants as I
from lexweave.operators import references as R
from lexweave.plans import corpus as C
from lexweave.sources.markdown import heading_stack, source_lines

# Base relations of the rendered bylaws. Clauses are numbered in document order (rn within their lettered section).
BYLAWS = """
WITH RECURSIVE sized AS (
  SELECT *, count(*) OVER (PARTITION BY l_suppkey, l_returnflag) AS n FROM lineitem
), said AS (
  SELECT l.*, 'acts-' || s_nationkey AS slug, l_suppkey % 5 AS part_no,
    CASE l_suppkey % 5 WHEN 0 THEN 'i' WHEN 1 THEN 'ii' WHEN 2 THEN 'iii' WHEN 3 THEN 'iv' ELSE 'v' END AS roman,
    CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS letter_no,
    CAST(l_suppkey * 2 + 10 AS INTEGER) AS page, s_name,
    l_orderkey % CAST(ceil(n / 4096.0) AS BIGINT) AS page_no,
    CAST(l_quantity AS BIGINT) AS amount, CAST(round(l_discount * 100) AS BIGINT) AS cents,
    CAST(round(l_tax * 100) AS BIGINT) AS tax,
    CASE WHEN l_linenumber = 1 THEN '"Lot ' || (l_partkey % 50) || '" means the goods of order ' || l_orderkey || '.'
      WHEN l_linenumber = 2 THEN 'Delivery is subject to section ' || (l_partkey % 40) || '.'
      WHEN l_linenumber = 4 THEN 'This is read with the Acts of NATION_' || (l_partkey % 30) || '.'
      WHEN l_linenumber = 5 THEN 'Returns prevail despite section ' || l_orderkey || ' and it prevails over the Trade Code.'
      ELSE 'The buyer takes ' || CAST(l_quantity AS BIGINT) || ' units:' END AS opening
  FROM sized l JOIN supplier ON s_suppkey = l_suppkey
), clauses AS (
  SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_returnflag ORDER BY page_no, l_orderkey, l_linenumber,
      l_partkey, l_quantity, l_discount, l_tax) AS rn,
    row_number() OVER (PARTITION BY l_suppkey, l_returnflag, l_orderkey ORDER BY page_no, l_linenumber, l_partkey,
      l_quantity, l_discount, l_tax) AS same_no,
    slug || '-part-' || roman AS part_id,
    slug || '-part-' || roman || '-section-' || l_suppkey AS section_id,
    slug || '-part-' || roman || '-section-' || l_suppkey || '-' || lower(l_returnflag) AS letter_id
  FROM said
), units AS (
  SELECT *, rn = n AS is_last,
    letter_id || '-clause-' || l_orderkey || CASE WHEN same_no = 1 THEN '' WHEN same_no = 2 THEN '-p' || page
      ELSE '-p' || page || '-' || (same_no - 1) END AS clause_id,
    l_orderkey || '. ' || opening || CASE WHEN l_linenumber IN (3, 6) THEN
      chr(10) || 'a. quantity ' || amount || ';' || chr(10) || 'b. charges:' || chr(10) || '  i. discount ' || cents || ';'
      || chr(10) || '  ii. tax ' || tax || ';' || chr(10) || 'c. carriage paid on arrival.' ELSE '' END
      || CASE WHEN rn = n THEN ' The list ends here.' ELSE '' END AS text
  FROM clauses
), letters AS (
  SELECT DISTINCT slug, part_no, roman, l_suppkey, s_name, l_returnflag, letter_no, page, part_id, section_id, letter_id
  FROM clauses
), sections AS (
  SELECT DISTINCT slug, part_no, roman, l_suppkey, s_name, page, part_id, section_id FROM letters
), parts AS (
  SELECT DISTINCT slug, part_no, roman, part_id FROM sections
), refs AS (
  SELECT slug, part_no, l_suppkey, letter_no, rn, clause_id, r.ord, r.kind, r.target,
    row_number() OVER (PARTITION BY slug ORDER BY part_no, l_suppkey, letter_no, rn, r.ord) AS ref_ord
  FROM (
    SELECT *, unnest(CASE
      WHEN l_linenumber = 2 THEN [{'ord': 1, 'kind': 'subject_to', 'target': '' || (l_partkey % 40)}]
      WHEN l_linenumber = 4 THEN [{'ord': 0, 'kind': 'read_with', 'target': 'Acts of NATION_' || (l_partkey % 30)}]
      WHEN l_linenumber = 5 THEN [
        {'ord': 2, 'kind': 'despite', 'target': l_orderkey || ' and it prevails over the Trade Code'},
        {'ord': 6, 'kind': 'higher_authority_than', 'target': 'Trade Code'}] END) AS r
    FROM units)
), known AS (
  SELECT DISTINCT 'acts-' || n_nationkey AS doc_slug, lower('Acts of ' || n_name) AS doc_key
  FROM nation JOIN supplier ON s_nationkey = n_nationkey
), numbered AS (
  SELECT slug, '' || l_suppkey AS key, section_id AS id, part_no, l_suppkey, 0 AS letter_no, 0 AS rn FROM sections
  UNION ALL
  SELECT slug, '' || l_orderkey, clause_id, part_no, l_suppkey, letter_no, rn FROM units
), targets AS (
  SELECT slug, key, arg_max(id, {'a': part_no, 'b': l_suppkey, 'c': letter_no, 'd': rn}) AS target_id
  FROM numbered GROUP BY slug, key
), resolved AS (
  SELECT r.*, clause_id || '-' || kind || '-' || ref_ord AS reference_id, doc_slug, target_id,
    CASE WHEN doc_slug IS NOT NULL OR target_id IS NOT NULL THEN 'resolved' ELSE 'unresolved' END AS status
  FROM refs r LEFT JOIN known ON doc_key = lower(r.target)
    LEFT JOIN targets t ON t.slug = r.slug AND t.key = lower(r.target)
)
""".replace("WITH RECURSIVE", "WITH")


def units_of(kind: str):
    """Units of a type, without text (but of headings) and last page."""
    def select(spark: SparkSession, folder: str) -> DataFrame:
        return C.bylaw_heads(spark, folder).where(F.col("unit_type") == kind)

    return select


def bylaw_parts(spark: SparkSession, folder: str) -> DataFrame:
    return units_of("part")(spark, folder).select("slug", "clause_id", "number", "title", "text", "page", "parent_clause_id")


def bylaw_sections(spark: SparkSession, folder: str) -> DataFrame:
    rows = units_of("section")(spark, folder).where(F.col("number").rlike("^[0-9]+$"))
    return rows.select("slug", "clause_id", "number", "title", "text", "page", "parent_clause_id")


def bylaw_lettered_sections(spark: SparkSession, folder: str) -> DataFrame:
    rows = C.bylaw_texts(spark, folder, "letter")
    act = F.try_element_at("metadata", F.lit("act_title"))
    return rows.select("slug", "clause_id", "number", "title", "text", "parent_clause_id", act.alias("act_title"))


def bylaw_clauses(spark: SparkSession, folder: str) -> DataFrame:
    return C.bylaw_texts(spark, folder, "clause").select("slug", "clause_id", "number", "title", "text", "parent_clause_id")


def bylaw_page_spans(spark: SparkSession, folder: str) -> DataFrame:
    return C.bylaw_texts(spark, folder, "clause").select("clause_id", "page", "page_end")


def bylaw_parent_chains(spark: SparkSession, folder: str) -> DataFrame:
    return units_of("clause")(spark, folder).select("clause_id", F.array_join("parent_chain", ">").alias("chain"))


def bylaw_children(spark: SparkSession, folder: str) -> DataFrame:
    from lexweave.sinks.render import children

    listed = children(C.bylaw_heads(spark, folder)).where(F.col("clause_id").isNotNull())
    return listed.select("clause_id", F.array_join("child_clauses", ",").alias("children"))


def bylaw_collisions(spark: SparkSession, folder: str) -> DataFrame:
    tagged = units_of("clause")(spark, folder).select(
        "slug", "clause_id", F.regexp_extract("clause_id", r"-clause-\d+(-p\d+(?:-\d+)?)?$", 1).alias("tag")
    )
    return tagged.where(F.col("tag") != "")


def bylaw_hierarchy(spark: SparkSession, folder: str) -> DataFrame:
    return I.hierarchy_counts(C.bylaw_structure(spark, folder))


def definitions(spark: SparkSession, folder: str) -> DataFrame:
    return R.definitions(C.bylaw_clause_texts(spark, folder)).select(
        "instrument_slug", "slug", "term", "definition_text", "source_unit_id"
    )


def references(spark: SparkSession, folder: str) -> DataFrame:
    return C.bylaw_references(spark, folder).select(
        "slug", "reference_id", "reference_type", "source_unit_id", "reference_text", "ref_ord"
    )


def reference_targets(spark: SparkSession, folder: str) -> DataFrame:
    keys = R.unit_targets(C.bylaw_heads(spark, folder).where(F.col("unit_type").isin("section", "clause")))
    return keys.where(F.col("target_key").rlike("^[0-9]+$"))


def reference_resolution(spark: SparkSession, folder: str) -> DataFrame:
    return C.bylaw_references(spark, folder).select(
        "reference_id", "resolution_status", "resolved_target_slug", "resolved_target_id"
    )


def reference_lists(spark: SparkSession, folder: str) -> DataFrame:
    lists = R.reference_lists(C.bylaw_references(spark, folder))
    names = ("read_with", "subject_to", "despite", "higher_authority_than", "unresolved_references")
    return lists.select("clause_id", *[F.array_join(n, ",").alias(n) for n in names])


def unresolved_references(spark: SparkSession, folder: str) -> DataFrame:
    refs = C.bylaw_references(spark, folder).where(F.col("resolution_status") == "unresolved")
    return refs.select(R.page_slug(refs).alias("page_slug"), "reference_type", "reference_text", "source_unit_id")


def reference_counts(spark: SparkSession, folder: str) -> DataFrame:
    return C.bylaw_references(spark, folder).groupBy("slug", "reference_type", "resolution_status").agg(
        F.count("*").alias("n")
    )


def damaged_units(spark: SparkSession, folder: str) -> DataFrame:
    """Bylaw units with faults: collision suffixes cut off, every seventh section gone, some parents cut off."""
    units = C.bylaw_structure(spark, folder)
    number = F.col("number").try_cast("bigint")
    kept = units.where(~((F.col("unit_type") == "section") & F.coalesce(number % 7 == 0, F.lit(False))))
    clause = F.col("unit_type") == "clause"
    return kept.withColumns(
        {
            "clause_id": F.when(clause, F.regexp_replace("clause_id", r"(-clause-\d+)-p\d+(?:-\d+)?$", "$1")).otherwise(
                F.col("clause_id")
            ),
            "parent_clause_id": F.when(clause & (number % 11 == 0), F.lit(None)).otherwise(F.col("parent_clause_id")),
            "parent_chain": F.when(clause & (number % 13 == 0), F.slice("parent_chain", 1, 3)).otherwise(F.col("parent_chain")),
        }
    )


def unit_invariants(spark: SparkSession, folder: str) -> DataFrame:
    return I.unit_issues(damaged_units(spark, folder)).groupBy("slug", "rule").agg(F.count("*").alias("n"))


def release_batches(spark: SparkSession, folder: str) -> DataFrame:
    from lexweave.operators.register import release_batches as batches

    cards = units_of("clause")(spark, folder).select(
        F.col("clause_id").alias("card_id"), "page", F.element_at("parent_chain", -1).alias("section_key")
    )
    return batches(cards)


def policy_provisions(spark: SparkSession, folder: str) -> DataFrame:
    rows = C.policy_units(spark, folder).where(F.col("unit_type") == "clause")
    value = lambda k: F.try_element_at("metadata", F.lit(k)).alias(k)
    return rows.select(
        "slug", "clause_id", "number", "title", "text", "parent_clause_id", value("adopted_date"), value("amended_dates")
    )


def policy_headings(spark: SparkSession, folder: str) -> DataFrame:
    rows = C.policy_units(spark, folder).where(F.col("unit_type").isin("section", "policy"))
    value = lambda k: F.try_element_at("metadata", F.lit(k)).alias(k)
    return rows.select(
        "slug", "clause_id", "unit_type", "number", "title", "parent_clause_id", value("adopted_date"), value("amended_dates")
    )


def markdown_heading_paths(spark: SparkSession, folder: str) -> DataFrame:
    C.register_documents(spark, folder)
    files = C.built(spark, folder, "register-files", lambda: None)
    stacked = heading_stack(source_lines(files)).where(F.col("level").isNotNull())
    return stacked.select("slug", "level", "line", F.array_join("heading_path", " > ").alias("heading_path"))


def markdown_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return C.register_blocks(spark, folder).groupBy("slug", "block_type").agg(
        F.count("*").alias("blocks"),
        F.sum(F.col("line_end") - F.col("line_start") + 1).cast("bigint").alias("lines"),
        F.sum(F.length("text")).alias("chars"),
    )


def generic_units(spark: SparkSession, folder: str) -> DataFrame:
    units = C.register(spark, folder).units.where(~F.col("is_top_level"))
    return units.select(
        "slug", "clause_id", "unit_type", "number", "title", "text", "parent_clause_id",
        F.array_join("parent_chain", ">").alias("chain"),
    )


def generic_unparsed(spark: SparkSession, folder: str) -> DataFrame:
    return C.register(spark, folder).unparsed.groupBy("slug").agg(F.count("*").alias("unparsed_blocks"))


ROMAN_50 = """
CASE (k % 50 + 1) // 10 WHEN 0 THEN '' WHEN 1 THEN 'X' WHEN 2 THEN 'XX' WHEN 3 THEN 'XXX' WHEN 4 THEN 'XL' ELSE 'L' END
|| CASE (k % 50 + 1) % 10 WHEN 0 THEN '' WHEN 1 THEN 'I' WHEN 2 THEN 'II' WHEN 3 THEN 'III' WHEN 4 THEN 'IV' WHEN 5 THEN 'V'
   WHEN 6 THEN 'VI' WHEN 7 THEN 'VII' WHEN 8 THEN 'VIII' ELSE 'IX' END
"""
POLICIES = f"""
WITH sized AS (
  SELECT *, o_custkey % 25 AS doc, o_custkey // 25 AS k, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders
), customers AS (
  SELECT DISTINCT o_custkey, 'policy-' || doc AS slug, k, k // 50 + 1 AS section_no, {ROMAN_50} AS roman,
    strftime(min(o_orderdate) OVER (PARTITION BY o_custkey), '%B %Y') AS adopted,
    CASE WHEN k % 2 = 0 THEN strftime(max(o_orderdate) OVER (PARTITION BY o_custkey), '%B %Y') END AS amended
  FROM sized
), provisions AS (
  SELECT o_custkey, chr(CAST(o_orderkey % 26 + 97 AS INTEGER)) AS letter, true AS dated,
    'Order ' || o_orderkey || ' is kept as ' || o_orderstatus || '.' || CASE WHEN o_orderstatus = 'F' THEN ' It is closed.' ELSE '' END AS said,
    o_orderkey % CAST(ceil(n / 4096.0) AS BIGINT) AS page_no, o_orderkey
  FROM sized
  UNION ALL
  SELECT o_custkey, 'z', false, 'Late additions follow.', 1000000000, 0 FROM customers WHERE k % 3 = 0
), ranked AS (
  SELECT p.*, c.slug, k, section_no, roman, adopted, amended,
    row_number() OVER (PARTITION BY p.o_custkey, letter ORDER BY page_no, o_orderkey) AS same_no,
    slug || '-section-' || section_no || '-policy-' || lower(roman) AS policy_id
  FROM provisions p JOIN customers c ON c.o_custkey = p.o_custkey
)
"""
REGISTERS = """
WITH entries AS (
  SELECT *, 'register-' || c_nationkey || '-' || (c_custkey // 1000) AS slug FROM customer
), docs AS (SELECT DISTINCT slug FROM entries)
"""

QUERIES = {
    "bylaw_parts": (
        bylaw_parts,
        BYLAWS + """SELECT slug, part_id AS clause_id, upper(roman) AS number, 'TRADE TERMS ' || upper(roman) AS title,
        'Part ' || upper(roman) || ': TRADE TERMS ' || upper(roman) AS text, 5 AS page, slug AS parent_clause_id FROM parts""",
    ),
    "bylaw_sections": (
        bylaw_sections,
        BYLAWS + """SELECT slug, section_id AS clause_id, '' || l_suppkey AS number,
        s_name || CASE WHEN l_suppkey % 4 = 0 THEN ' and affiliates' ELSE '' END AS title,
        'Section ' || l_suppkey || ': ' || s_name || CASE WHEN l_suppkey % 4 = 0 THEN ' and affiliates' ELSE '' END AS text,
        page, part_id AS parent_clause_id FROM sections""",
    ),
    "bylaw_lettered_sections": (
        bylaw_lettered_sections,
        BYLAWS + """SELECT slug, letter_id AS clause_id, l_returnflag AS number,
        CASE letter_no WHEN 1 THEN 'ACCEPTED GOODS' WHEN 2 THEN 'Open Orders' ELSE 'RETURNS' END AS title,
        CASE letter_no WHEN 1 THEN 'A. ACCEPTED GOODS' WHEN 2 THEN 'N. Open Orders'
          ELSE 'R. RETURNS' || chr(10) || 'Returned goods are listed here.' END AS text,
        section_id AS parent_clause_id, 'An Act about trade group ' || part_no AS act_title FROM letters""",
    ),
    "bylaw_clauses": (
        bylaw_clauses,
        BYLAWS + """SELECT slug, clause_id, '' || l_orderkey AS number,
        CASE letter_no WHEN 1 THEN 'ACCEPTED GOODS ' WHEN 2 THEN 'Open Orders ' ELSE 'RETURNS ' END || l_orderkey AS title,
        text, letter_id AS parent_clause_id FROM units""",
    ),
    "bylaw_page_spans": (
        bylaw_page_spans,
        BYLAWS + "SELECT clause_id, page, CASE WHEN is_last THEN page + 1 END AS page_end FROM units",
    ),
    "bylaw_parent_chains": (
        bylaw_parent_chains,
        BYLAWS + "SELECT clause_id, slug || '>' || part_id || '>' || section_id || '>' || letter_id AS chain FROM units",
    ),
    "bylaw_children": (
        bylaw_children,
        BYLAWS + """SELECT letter_id AS clause_id, string_agg(clause_id, ',' ORDER BY rn) AS children FROM units GROUP BY letter_id
        UNION ALL SELECT section_id, string_agg(letter_id, ',' ORDER BY letter_no) FROM letters GROUP BY section_id
        UNION ALL SELECT part_id, string_agg(section_id, ',' ORDER BY l_suppkey) FROM sections GROUP BY part_id
        UNION ALL SELECT slug, string_agg(part_id, ',' ORDER BY part_no) FROM parts GROUP BY slug""",
    ),
    "bylaw_collisions": (
        bylaw_collisions,
        BYLAWS + """SELECT slug, clause_id, '-p' || page || CASE WHEN same_no > 2 THEN '-' || (same_no - 1) ELSE '' END AS tag
        FROM units WHERE same_no > 1""",
    ),
    "bylaw_hierarchy": (
        bylaw_hierarchy,
        BYLAWS + """SELECT slug, clause_count, (SELECT count(*) FROM parts p WHERE p.slug = c.slug)
        + (SELECT count(*) FROM sections s WHERE s.slug = c.slug) + (SELECT count(*) FROM letters l WHERE l.slug = c.slug)
        AS context_count, true AS usable FROM (SELECT slug, count(*) AS clause_count FROM units GROUP BY slug) c
        UNION ALL SELECT DISTINCT 'acts-' || s_nationkey, 0, 0, false FROM supplier
        WHERE 'acts-' || s_nationkey NOT IN (SELECT slug FROM units)""",
    ),
    "definitions": (
        definitions,
        BYLAWS + """SELECT slug AS instrument_slug, 'lot-' || lot AS slug, 'Lot ' || lot AS term,
        '"Lot ' || lot || '" means the goods of order ' || l_orderkey || '.' || CASE WHEN is_last THEN ' The list ends here.' ELSE '' END
        AS definition_text, clause_id AS source_unit_id
        FROM (SELECT *, l_partkey % 50 AS lot, row_number() OVER (PARTITION BY slug, l_partkey % 50
          ORDER BY part_no, l_suppkey, letter_no, rn) AS first_no FROM units WHERE l_linenumber = 1) WHERE first_no = 1""",
    ),
    "references": (
        references,
        BYLAWS + """SELECT slug, reference_id, kind AS reference_type, clause_id AS source_unit_id, target AS reference_text, ref_ord
        FROM resolved""",
    ),
    "reference_targets": (
        reference_targets,
        BYLAWS + "SELECT slug, key AS target_key, target_id AS resolved_target_id FROM targets",
    ),
    "reference_resolution": (
        reference_resolution,
        BYLAWS + """SELECT reference_id, status AS resolution_status, doc_slug AS resolved_target_slug,
        target_id AS resolved_target_id FROM resolved""",
    ),
    "reference_lists": (
        reference_lists,
        BYLAWS + ", listed AS (SELECT *, coalesce(doc_slug, target_id, target) AS shown FROM resolved)" + """
        SELECT clause_id,
          coalesce(string_agg(shown, ',' ORDER BY ref_ord) FILTER (WHERE kind = 'read_with' AND status = 'resolved'), '') AS read_with,
          coalesce(string_agg(shown, ',' ORDER BY ref_ord) FILTER (WHERE kind = 'subject_to' AND status = 'resolved'), '') AS subject_to,
          coalesce(string_agg(shown, ',' ORDER BY ref_ord) FILTER (WHERE kind = 'despite' AND status = 'resolved'), '') AS despite,
          coalesce(string_agg(shown, ',' ORDER BY ref_ord) FILTER (WHERE kind = 'higher_authority_than' AND status = 'resolved'), '')
            AS higher_authority_than,
          coalesce(string_agg(clause_id || '-' || replace(kind, '_', '-') || '-' || ref_ord, ',' ORDER BY ref_ord)
            FILTER (WHERE status = 'unresolved'), '') AS unresolved_references
        FROM listed GROUP BY clause_id""",
    ),
    "unresolved_references": (
        unresolved_references,
        BYLAWS + """SELECT clause_id || '-' || replace(kind, '_', '-') || '-' || ref_ord AS page_slug, kind AS reference_type,
        target AS reference_text, clause_id AS source_unit_id FROM resolved WHERE status = 'unresolved'""",
    ),
    "reference_counts": (
        reference_counts,
        BYLAWS + """SELECT slug, kind AS reference_type, status AS resolution_status, count(*) AS n FROM resolved
        GROUP BY ALL""",
    ),
    "unit_invariants": (
        unit_invariants,
        BYLAWS + """, damaged AS (
          SELECT *, letter_id || '-clause-' || l_orderkey AS cid, l_suppkey % 7 = 0 AS orphaned,
            l_orderkey % 11 = 0 AS no_parent, l_orderkey % 13 = 0 AS short_chain FROM units)
        SELECT slug, 'duplicate_clause_id' AS rule, count(*) AS n FROM
          (SELECT slug, cid FROM damaged GROUP BY slug, cid HAVING count(*) > 1) GROUP BY slug
        UNION ALL SELECT slug, 'no_parent', count(*) FROM damaged WHERE no_parent GROUP BY slug
        UNION ALL SELECT slug, 'missing_parent', count(*) FROM letters WHERE l_suppkey % 7 = 0 GROUP BY slug
        UNION ALL SELECT slug, 'parent_not_in_chain', count(*) FROM damaged WHERE short_chain AND NOT no_parent GROUP BY slug
        UNION ALL SELECT slug, 'missing_chain_id', count(*) FROM
          (SELECT slug FROM damaged WHERE orphaned UNION ALL SELECT slug FROM letters WHERE l_suppkey % 7 = 0) GROUP BY slug""",
    ),
    "release_batches": (
        release_batches,
        BYLAWS + """SELECT (i - 1) // 25 + 1 AS batch, count(*) AS cards, min(page) AS first_page, max(page) AS last_page,
        count(DISTINCT letter_id) AS sections
        FROM (SELECT *, row_number() OVER (ORDER BY clause_id) AS i FROM units) GROUP BY 1""",
    ),
    "policy_provisions": (
        policy_provisions,
        POLICIES + """SELECT slug, policy_id || '-provision-' || letter || CASE WHEN same_no = 1 THEN '' WHEN same_no = 2
          THEN '-p' || (k + 10) ELSE '-p' || (k + 10) || '-' || (same_no - 1) END AS clause_id,
        '(' || letter || ')' AS number, 'TERMS OF CUSTOMER ' || o_custkey || ' (' || letter || ')' AS title,
        '(' || letter || ') ' || said AS text, policy_id AS parent_clause_id,
        CASE WHEN dated THEN adopted END AS adopted_date, CASE WHEN dated THEN amended END AS amended_dates FROM ranked""",
    ),
    "policy_headings": (
        policy_headings,
        POLICIES + """SELECT slug, slug || '-section-' || section_no || '-policy-' || lower(roman) AS clause_id, 'policy' AS unit_type,
        roman AS number, 'TERMS OF CUSTOMER ' || o_custkey AS title, slug || '-section-' || section_no AS parent_clause_id,
        adopted AS adopted_date, amended AS amended_dates FROM customers
        UNION ALL SELECT DISTINCT slug, slug || '-section-' || section_no, 'section', '' || section_no, 'Accounts ' || section_no,
        slug, NULL, NULL FROM customers""",
    ),
    "markdown_heading_paths": (
        markdown_heading_paths,
        REGISTERS + """SELECT slug, 1 AS level, '# R' || substr(slug, 2) AS line, 'R' || substr(replace(slug, 'register-', 'register '), 2)
        AS heading_path FROM docs WHERE false
        UNION ALL SELECT slug, 1, '# Register ' || substr(slug, 10), 'Register ' || substr(slug, 10) FROM docs
        UNION ALL SELECT slug, 2, '## Section ' || c_custkey || ' - ' || c_name,
          'Register ' || substr(slug, 10) || ' > Section ' || c_custkey || ' - ' || c_name FROM entries
        UNION ALL SELECT slug, 4, '#### Remarks on ' || c_custkey,
          'Register ' || substr(slug, 10) || ' > Section ' || c_custkey || ' - ' || c_name || ' > Remarks on ' || c_custkey
          FROM entries WHERE c_custkey % 2 = 0""",
    ),
    "markdown_blocks": (
        markdown_blocks,
        REGISTERS + """, pieces AS (
          SELECT slug, 'heading' AS block_type, 1 AS lines, '# Register ' || substr(slug, 10) AS t FROM docs
          UNION ALL SELECT slug, 'heading', 1, '## Section ' || c_custkey || ' - ' || c_name FROM entries
          UNION ALL SELECT slug, 'heading', 1, '#### Remarks on ' || c_custkey FROM entries WHERE c_custkey % 2 = 0
          UNION ALL SELECT slug, 'body', 2, 'No remark is made here.' || chr(10) || 'None at all.' FROM entries WHERE c_custkey % 2 = 0
          UNION ALL SELECT slug, 'body', 2, c_custkey || '.1 The account holds ' || CAST(floor(c_acctbal) AS BIGINT)
            || ' units, read with register-' || c_nationkey || '-0.' || chr(10) || c_custkey || '.2 "Segment ' || c_mktsegment
            || '" means the trade of customer ' || c_custkey || '.' FROM entries)
        SELECT slug, block_type, count(*) AS blocks, CAST(sum(lines) AS BIGINT) AS lines, CAST(sum(length(t)) AS BIGINT) AS chars
        FROM pieces GROUP BY ALL""",
    ),
    "generic_units": (
        generic_units,
        REGISTERS + """SELECT slug, slug || '-section-' || c_custkey AS clause_id, 'section' AS unit_type, '' || c_custkey AS number,
          c_name AS title, 'Section ' || c_custkey || ' - ' || c_name AS text, slug AS parent_clause_id, slug AS chain FROM entries
        UNION ALL SELECT slug, slug || '-' || c_custkey || '.1', 'clause', c_custkey || '.1', NULL,
          c_custkey || '.1 The account holds ' || CAST(floor(c_acctbal) AS BIGINT) || ' units, read with register-' || c_nationkey || '-0.',
          slug || '-section-' || c_custkey, slug || '>' || slug || '-section-' || c_custkey FROM entries
        UNION ALL SELECT slug, slug || '-' || c_custkey || '.2', 'clause', c_custkey || '.2', NULL,
          c_custkey || '.2 "Segment ' || c_mktsegment || '" means the trade of customer ' || c_custkey || '.',
          slug || '-section-' || c_custkey, slug || '>' || slug || '-section-' || c_custkey FROM entries""",
    ),
    "generic_unparsed": (
        generic_unparsed,
        REGISTERS + "SELECT slug, count(*) AS unparsed_blocks FROM entries WHERE c_custkey % 2 = 0 GROUP BY slug",
    ),
}
