"""Queries on source text, extraction, retrieval and audit measures, with their SQL."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexweave.functions import text as X
from lexweave.operators import alignment as L
from lexweave.operators import audit as A
from lexweave.operators import retrieval as Q
from lexweave.operators.lines import explode_lines
from lexweave.operators.quality import compare_quality
from lexweave.operators.register import warning_links, warning_register
from lexweave.plans import corpus as C
from lexweave.plans.structure_queries import BYLAWS
from lexweave.session import materialize
from lexweave.sinks.files import manifest_header
from lexweave.sinks.sidecars import exact_text
from lexweave.sources import manifest as M
from lexweave.sources import ocr_json as O
from lexweave.sources.tables import table

SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
BREAK = r"\r\n|[\n\r\x0b\f\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]"
LINES = rf"""
WITH cut AS (SELECT doc_id, lang, source, string_split_regex(text, '{BREAK}') AS parts FROM documents),
rows AS (SELECT doc_id, lang, source, unnest(parts) AS raw, generate_subscripts(parts, 1) AS line_no FROM cut),
cleaned AS (SELECT *, trim(regexp_replace(translate(raw, chr(8203) || chr(65279) || chr(8220) || chr(8221), '  ""'), '{SPACE}+', ' ', 'g')) AS line FROM rows),
kept AS (SELECT * FROM cleaned WHERE line <> '' AND NOT regexp_matches(line, '(?i)^(\p{{Nd}}*|table of contents|last amended:.*)$'))
"""


def document_lines(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "lang", "source", "text")
    return explode_lines(docs).where(~X.skip_line(F.col("line")))


def source_lines(spark: SparkSession, folder: str) -> DataFrame:
    return document_lines(spark, folder).select("doc_id", (F.col("offset") + 1).cast("bigint").alias("line_no"), "line")


def line_profile(spark: SparkSession, folder: str) -> DataFrame:
    line = F.col("line")
    return document_lines(spark, folder).groupBy("lang", "source").agg(
        F.count("*").alias("lines"),
        F.count_if(X.heading_like(line)).alias("heading_like"),
        F.sum(X.word_count(line)).cast("bigint").alias("words"),
        F.sum(F.length(line)).cast("bigint").alias("chars"),
    )


def exact_texts(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select(
        F.col("conv_id").cast("string").alias("slug"), F.col("turn").alias("block_ord"), "text"
    )
    return exact_text(turns).select("slug", F.length("text").alias("chars"), F.sha2("text", 256).alias("sha256"))


def content_hashes(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select(F.concat(F.lit("doc-"), "doc_id").alias("slug"), "text")
    items = table(spark, folder, "benchmark").select(F.concat(F.lit("item-"), "item_id").alias("slug"), "text")
    return docs.unionByName(items).select("slug", F.sha2("text", 256).alias("sha256"))


def ocr_responses(spark: SparkSession, folder: str) -> DataFrame:
    """One OCR response per conversation: odd turns as blocks, even turns as bare chunks, some of them empty."""
    turns = table(spark, folder, "conversations")
    n = F.length("text")
    text = F.when(F.col("turn") % 7 == 3, F.lit("  ")).otherwise(F.col("text"))
    label = F.when(n % 4 == 0, "High").when(n % 4 == 1, "medium").when(n % 4 == 2, "low")
    score = F.when(n % 4 == 3, (n % 100) / 100)
    block = lambda key: F.struct(
        F.when(F.col("turn") % 3 == 0, F.concat(F.lit("b"), F.col("turn"))).alias("id"), text.alias(key),
        F.col("turn").alias("page"), label.alias("confidence"), score.alias("parse_confidence"),
    )
    as_json = lambda s: F.to_json(s)
    chunk = F.when(
        F.col("turn") % 2 == 1, F.concat(F.lit('{"content":"outer","blocks":['), as_json(block("text")), F.lit("]}"))
    ).otherwise(as_json(block("content")))
    chunks = F.array_join(F.sort_array(F.collect_list(F.struct("turn", chunk.alias("c")))).getField("c"), ",")
    return turns.groupBy("conv_id").agg(chunks.alias("c"), F.count("*").alias("n")).select(
        F.concat(F.lit("conv-"), "conv_id").alias("slug"),
        F.concat(F.lit('{"job_id":"j'), "conv_id", F.lit('","duration":1.5,"usage":{"num_pages":'), "n",
                 F.lit('},"result":{"type":"full","chunks":['), "c", F.lit("]}}")).alias("json"),
    )


def ocr_blocks(spark: SparkSession, folder: str) -> DataFrame:
    blocks = O.response_blocks(ocr_responses(spark, folder))
    return blocks.select(
        "slug", "block_id", "block_type", "text", "page", "original_page", F.round("confidence", 6).alias("confidence"),
        F.array_join("warnings", ",").alias("warnings"),
    )


def ocr_status(spark: SparkSession, folder: str) -> DataFrame:
    responses = ocr_responses(spark, folder)
    return O.response_headers(responses, O.response_blocks(responses))


def extraction_headers(spark: SparkSession, folder: str) -> DataFrame:
    """What an extraction reports when answers are missing, broken, doubled or without text, per conversation."""
    number = F.substr("slug", F.lit(6)).cast("bigint")
    slugs = table(spark, folder, "conversations").select(F.concat(F.lit("conv-"), "conv_id").alias("slug")).distinct()
    answers = ocr_responses(spark, folder).where(number % 6 > 0)
    broken = F.when(number % 6 == 1, F.lit('{"result":')).when(number % 6 == 2, F.lit('{"result":{"type":"full","chunks":[]}}')).otherwise(F.col("json"))
    answers = answers.withColumn("json", broken)
    answers = answers.unionAll(answers.where(number % 6 == 3))
    blocks, warned = O.extract_responses(slugs, answers)
    sizes = blocks.groupBy("slug").agg(F.count("*").alias("blocks"))
    first = F.filter("w", lambda w: w["severity"] == "error")
    return slugs.join(warned, "slug", "left").join(sizes, "slug", "left").select(
        "slug",
        F.when(F.size(first) > 0, "failed").when(F.size("w") > 0, "review_required").otherwise("ok").alias("status"),
        F.get(first, F.lit(0))["category"].alias("category"),
        F.coalesce("blocks", F.lit(0)).alias("blocks"),
        F.coalesce(F.size(F.filter("w", lambda w: w["severity"] == "warning")), F.lit(0)).alias("warnings"),
    )


def ocr_failures(spark: SparkSession, folder: str) -> DataFrame:
    code = F.element_at(F.array(*[F.lit(c) for c in (401, 429, 504, 442, 415, 422, 500)]), (F.col("event_id") % 9 + 1).cast("int"))
    events = table(spark, folder, "events").select(
        F.concat(F.lit("e"), "event_id").alias("slug"),
        F.when(F.col("event_id") % 9 < 7, code).alias("status_code"),
        F.when(F.col("event_type") == "error", "ConnectionError").otherwise("ValueError").alias("error_name"),
        F.when(F.col("user_id") % 5 == 0, "Request timed out").otherwise("no detail").alias("error_message"),
    )
    return O.failed_extractions(events).groupBy("category", "status", "severity", "provider_code").agg(F.count("*").alias("n"))


def manifest_rules(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    rows = orders.select(
        F.col("o_orderkey").cast("string").alias("slug"),
        F.when(F.col("o_orderkey") % 5 == 0, "ordinance").otherwise("policy").alias("document_type"),
        F.when(F.col("o_orderstatus") == "F", "active").when(F.col("o_orderstatus") == "O", "draft").otherwise("pending").alias("status"),
        F.lit("public").alias("confidentiality"),
        F.when(F.col("o_orderkey") % 3 > 0, F.lit("2001-01-01")).alias("effective_date"),
        F.when(F.col("o_orderkey") % 2 > 0, F.lit("Reviewer")).alias("reviewed_by"),
        F.when(F.col("o_custkey") % 2 == 0, F.array(F.lit("Effective_date unknown"), F.lit("nobody reviewed it")))
        .otherwise(F.array(F.lit("reviewed_by is open"))).alias("metadata_notes"),
    )
    return M.manifest_issues(rows)


def corpus_header(spark: SparkSession, folder: str) -> DataFrame:
    docs = C.bylaw_documents(spark, folder).select(
        "confidentiality", F.lit("trade-acts").alias("corpus_id"), F.col("slug").alias("corpus_version"),
        F.lit(None).cast("string").alias("target_namespace"), F.lit("public-record").alias("classification"),
        F.lit("production_batch").alias("sync_eligibility"),
    )
    return manifest_header(docs).withColumn("confidentiality_scope", F.array_join("confidentiality_scope", ","))


QUALITY_SQL_RULES = """
CASE WHEN NOT c.success THEN 'candidate_failed' END,
CASE WHEN c.source_hash <> l.source_hash THEN 'source_hash_changed' END,
CASE WHEN c.deterministic_id_fingerprint <> l.deterministic_id_fingerprint THEN 'deterministic_id_fingerprint_changed' END,
CASE WHEN c.page_count < l.page_count THEN 'page_count_reduced' END,
CASE WHEN c.page_anchor_coverage < l.page_anchor_coverage THEN 'page_anchor_coverage_reduced' END,
CASE WHEN c.part_headings < l.part_headings THEN 'part_headings_lost' END,
CASE WHEN c.lettered_sections < l.lettered_sections THEN 'lettered_sections_lost' END,
CASE WHEN c.numbered_clauses < l.numbered_clauses THEN 'numbered_clauses_lost' END,
CASE WHEN c.definitions < l.definitions THEN 'definitions_lost' END,
CASE WHEN c.duplicate_heading_ids > l.duplicate_heading_ids THEN 'duplicate_heading_ids_increased' END,
CASE WHEN c.missing_heading_ids > l.missing_heading_ids THEN 'missing_heading_ids_increased' END,
CASE WHEN c.hierarchy_transition_errors > l.hierarchy_transition_errors THEN 'hierarchy_transition_errors_increased' END,
CASE WHEN c.material_warnings > l.material_warnings THEN 'material_warnings_increased' END"""
QUALITY_SQL_GAINS = """
CASE WHEN c.material_warnings < l.material_warnings THEN 'material_warnings_reduced' END,
CASE WHEN c.unresolved_reference_warnings < l.unresolved_reference_warnings THEN 'unresolved_reference_warnings_reduced' END"""


def quality_summaries(spark: SparkSession, folder: str) -> DataFrame:
    """Measures of each language of a source, standing for the extractions to be compared."""
    n = F.col("n_chars")
    return table(spark, folder, "documents").groupBy("source", "lang").agg(
        F.concat(F.lit("reader-"), F.first("lang")).alias("provider"),
        (F.max(n) > 4000).alias("success"),
        F.lit(10).alias("page_count"),
        F.min(n).alias("page_anchor_coverage"),
        F.count_if(n > 100).alias("part_headings"),
        F.lit(3).alias("lettered_sections"),
        F.max(n).alias("numbered_clauses"),
        F.lit(4).alias("definitions"),
        F.count_if(n < 50).alias("duplicate_heading_ids"),
        F.count_if(n < 30).alias("missing_heading_ids"),
        F.lit(0).alias("hierarchy_transition_errors"),
        F.count_if(n % 7 == 0).alias("material_warnings"),
        F.count_if(n % 11 == 0).alias("unresolved_reference_warnings"),
        F.lit("same").alias("source_hash"),
        (F.count("*") % 2).cast("string").alias("deterministic_id_fingerprint"),
    )


def extraction_quality(spark: SparkSession, folder: str) -> DataFrame:
    measures = quality_summaries(spark, folder)
    names = [c for c in measures.columns if c != "source"]
    one = measures.select("source", F.col("lang").alias("local_lang"), F.struct(*names).alias("local"))
    two = measures.select("source", F.col("lang").alias("candidate_lang"), F.struct(*names).alias("candidate"))
    pairs = one.join(two, "source").where(F.col("local_lang") != F.col("candidate_lang"))
    return compare_quality(pairs).select(
        "source", "local_lang", "candidate_lang", "selected_provider", "decision", F.array_join("reasons", ",").alias("reasons")
    )


def document_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as searchable pages; each links to its source and language, which have pages of their own."""
    docs = table(spark, folder, "documents")
    name = F.concat(F.lit("doc-"), F.col("doc_id"))
    own = docs.select(
        F.concat(F.lit("docs/"), name, F.lit(".md")).alias("path"), F.array(name).alias("aliases"),
        F.array("source", "lang").alias("links"), F.concat_ws("\n", name, F.col("text")).alias("haystack"),
    )
    sources = docs.select("source").distinct().select(
        F.concat(F.lit("sources/"), "source", F.lit(".md")).alias("path"), F.array("source").alias("aliases"),
        F.array().cast("array<string>").alias("links"), F.col("source").alias("haystack"),
    )
    return own.unionByName(sources)


def gold_questions(spark: SparkSession, folder: str) -> DataFrame:
    item = F.col("item_id")
    ids = lambda *cols: F.array(*[F.concat(F.lit("doc-"), c.cast("string")) for c in cols])
    return table(spark, folder, "benchmark").select(
        F.concat(F.lit("q"), item).alias("question_id"), F.col("text").alias("question"),
        ids(item, item * 9).alias("expected_clause_ids"),
        F.array(F.concat(F.lit("src"), (item % 25).cast("string"))).alias("expected_parent_ids"),
        F.array(F.lit("en"), F.concat(F.lit("src"), (item % 3).cast("string"))).alias("expected_definition_ids"),
    )


def ranked_pages(spark: SparkSession, folder: str) -> DataFrame:
    pages = C.built(spark, folder, "document-pages", lambda: document_pages(spark, folder))
    questions = C.built(spark, folder, "gold-questions", lambda: gold_questions(spark, folder))
    return C.built(spark, folder, "gold-hits", lambda: Q.rank_pages(pages, questions, 5)).select(
        "question_id", "rank", "path", "score"
    )


def gold_results(spark: SparkSession, folder: str) -> DataFrame:
    hits = ranked_pages(spark, folder)
    pages = C.built(spark, folder, "document-pages", lambda: document_pages(spark, folder))
    questions = C.built(spark, folder, "gold-questions", lambda: gold_questions(spark, folder))
    out = Q.evaluate(pages, questions, hits)
    joined = {c: F.array_join(c, ",") for c in out.columns if c.startswith("missing_")}
    return out.withColumns(joined)


# Norm of the audit in SQL: no lookaround there, so word-hyphen-space-word is rewritten twice.
def sql_norm(col: str) -> str:
    plain = f"replace(translate({col}, '\u2019\u2018\u201c\u201d\u2013\u2014 ', '''''\"\"-- '), 'full- time', 'full-time')"
    word = r"[\p{L}\p{M}\p{N}_]"
    for _ in range(2):
        plain = rf"regexp_replace({plain}, '({word})-{SPACE}+({word})', '\1\2', 'g')"
    return f"lower(trim(regexp_replace({plain}, '{SPACE}+', ' ', 'g')))"


def document_cards(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(F.col("doc_id").alias("card_id"), F.col("text").alias("source_text"))


def duplicate_texts(spark: SparkSession, folder: str) -> DataFrame:
    found = A.duplicate_texts(document_cards(spark, folder))
    return found.groupBy("text_hash").agg(
        F.array_join(F.sort_array(F.collect_list("card_id")), ",").alias("ids"), F.max("n").alias("n")
    ).drop("text_hash")


def word_recall(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    counts = materialize(A.word_counts(docs, ["doc_id"], F.col("text")), "word-counts")
    before = F.col("doc_id") - 1
    pairs = docs.select("doc_id").join(docs.select(before.alias("doc_id")), "doc_id")
    return A.recall_of_counts(pairs, ["doc_id"], counts, counts.withColumn("doc_id", before)).select(
        "doc_id", "segment_tokens", "card_tokens", F.round("recall", 6).alias("recall")
    )


def clause_segments(spark: SparkSession, folder: str) -> DataFrame:
    """Segments of clauses that run over as many pages as an order has items; a customer's orders are one document."""
    items = table(spark, folder, "lineitem").join(table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    own = Window.partitionBy("o_custkey").orderBy("o_orderkey", "l_linenumber")
    items = items.select(
        F.concat(F.lit("cust-"), "o_custkey").alias("doc"), F.concat(F.lit("order-"), "o_orderkey").alias("card_id"), "o_orderkey", "l_linenumber",
        F.dense_rank().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")).alias("n"), F.row_number().over(own).alias("page"),
        F.row_number().over(Window.partitionBy("o_custkey", "o_orderkey").orderBy("l_linenumber")).alias("i"),
    )
    opening = F.concat(F.col("n"), F.lit(". Order "), "o_orderkey", F.lit(" opens;"))
    more = F.concat(F.lit("item "), "l_linenumber", F.lit(" of order "), "o_orderkey", F.lit(" follows;"))
    items = materialize(items.withColumn("text", F.when(F.col("i") == 1, opening).otherwise(more)), "order-pages")
    cards = items.where("i = 1").select("doc", "card_id", F.lit("clause").alias("unit_type"), F.col("text").alias("source_text"), F.col("page").alias("page_start"))
    return A.clause_segments(cards, items.select("doc", "page", "text"))


def book_segments(spark: SparkSession, folder: str) -> DataFrame:
    """Segments in one book that holds nine tenths of all pages; every clause starts five pages behind its anchor.

    Each order opens with a heading and a number, which repeats every fifty orders, and has a page per item. Page numbers
    have gaps.
    """
    items = table(spark, folder, "lineitem").where("l_orderkey is not null").groupBy(F.col("l_orderkey").alias("k")).agg(F.collect_set("l_linenumber").alias("all"))
    items = items.select("k", F.array_min("all").alias("first"), F.explode("all").alias("item"))
    doc = F.when(F.col("k") % 10 > 0, F.lit("book")).otherwise(F.concat(F.lit("leaf-"), F.col("k") % 7))
    number = F.col("k") % 50 + 1
    opening = F.concat(F.lit("Section "), F.col("k"), F.lit(": order\n"), number, F.lit(". Order "), F.col("k"), F.lit(" opens;"))
    more = F.concat(F.lit("item "), "item", F.lit(" of order "), F.col("k"), F.lit(" follows;"))
    page = F.col("k") * 16 + F.col("item")
    pages = items.select(doc.alias("doc"), "k", page.alias("page"), F.when(F.col("item") == F.col("first"), opening).otherwise(more).alias("text"), (F.col("item") == F.col("first")).alias("opens"))
    pages = materialize(pages, "book-pages")
    cards = pages.where("opens").select(
        "doc", F.concat(F.lit("order-"), "k").alias("card_id"), F.lit("clause").alias("unit_type"),
        F.concat(number, F.lit(". Order "), F.col("k"), F.lit(" opens;")).alias("source_text"), F.greatest(F.col("page") - 5, F.lit(1)).alias("page_start"),
    )
    return A.clause_segments(cards, pages.select("doc", "page", "text"))


def page_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """How much of each benchmark passage every document holds in order, where it is at least the floor."""
    cards = table(spark, folder, "benchmark").select(F.lit("all").alias("doc"), F.col("item_id").cast("string").alias("card_id"), X.audit_words(X.audit_norm(F.col("text"))).alias("words"))
    pages = table(spark, folder, "documents").select(F.lit("all").alias("doc"), F.col("doc_id").alias("page"), X.audit_words(X.audit_norm(F.col("text"))).alias("words"))
    found = L.align(cards, pages)
    return found.select(F.col("card_id").cast("bigint").alias("item_id"), F.col("page").alias("doc_id"), "matched", "words", F.round("share", 6).alias("share"))


def confirmed_pages(spark: SparkSession, folder: str) -> DataFrame:
    cards = table(spark, folder, "benchmark").select(
        F.lit("all").alias("doc"), F.col("item_id").alias("card_id"), F.col("text").alias("source_text")
    )
    pages = table(spark, folder, "documents").select(F.lit("all").alias("doc"), F.col("doc_id").alias("page"), "text")
    found = A.found_pages(cards, pages)
    return found.select("card_id", F.array_join("pages", ",").alias("pages"))


CONFIRMED = f"""
WITH cards AS (
  SELECT item_id AS card_id, {sql_norm('text')} AS needle,
    list_filter(list_transform(string_split_regex(text, '{BREAK}'), lambda x: {sql_norm('x')}), lambda x: x <> '') AS lines
  FROM benchmark
), c AS (
  SELECT *, regexp_extract_all(needle, '[a-z0-9]+') AS words, string_split(needle, ' ') AS ws FROM cards WHERE needle <> ''
), pages AS (
  SELECT doc_id AS page, {sql_norm('text')} AS hay, array_to_string(list_filter(list_transform(
    string_split_regex(text, '{BREAK}'), lambda x: regexp_replace(regexp_replace(x, '^{SPACE}+', ''), '{SPACE}+$', '')),
    lambda x: x <> '' AND NOT regexp_matches(x, '^\\p{{Nd}}+$')), ' ') AS flat FROM documents
), p AS (SELECT *, list_distinct(regexp_extract_all(hay, '[a-z0-9]+')) AS held FROM pages
), pairs AS (
  SELECT card_id, page, needle, lines, words, ws, hay, held,
    len(list_filter(words, lambda w: list_contains(held, w))) / len(words) AS cover,
    array_to_string(ws[1:8], ' ') AS head, array_to_string(ws[-8:], ' ') AS tail
  FROM c CROSS JOIN p
), direct AS (
  SELECT card_id, page FROM pairs WHERE contains(hay, needle)
    OR (len(words) BETWEEN 2 AND 5 AND regexp_matches(words[1], '^[a-z]$') AND cover = 1)
    OR (len(ws) >= 14 AND (contains(hay, head) OR contains(hay, tail) OR cover >= 0.82))
    OR (len(lines) > 1 AND len(list_filter(lines, lambda n: NOT (
      contains(hay, n) OR len(regexp_extract_all(n, '[a-z0-9]+')) = 0
      OR (len(regexp_extract_all(n, '[a-z0-9]+')) <= 5 AND list_has_all(held, regexp_extract_all(n, '[a-z0-9]+')))
      OR (len(string_split(n, ' ')) >= 14 AND (contains(hay, array_to_string(string_split(n, ' ')[1:8], ' '))
        OR contains(hay, array_to_string(string_split(n, ' ')[-8:], ' '))))
      OR len(list_filter(regexp_extract_all(n, '[a-z0-9]+'), lambda w: list_contains(held, w)))
        / len(regexp_extract_all(n, '[a-z0-9]+')) >= 0.9))) = 0)
), joined AS (
  SELECT a.page, {sql_norm("a.flat || ' ' || b.flat")} AS hay, {sql_norm('a.flat')} AS l, {sql_norm('b.flat')} AS r
  FROM pages a JOIN pages b ON b.page = a.page + 1
), spanning AS (
  SELECT card_id, min(page) AS page FROM c CROSS JOIN joined
  WHERE card_id NOT IN (SELECT card_id FROM direct) AND (contains(hay, needle) OR (len(ws) >= 14
    AND contains(l, array_to_string(ws[1:8], ' ')) AND contains(r, array_to_string(ws[-8:], ' ')))) GROUP BY card_id
), found AS (
  SELECT card_id, page FROM direct UNION ALL SELECT card_id, unnest([page, page + 1]) FROM spanning
)
SELECT card_id, string_agg(page, ',' ORDER BY page) AS pages FROM (SELECT DISTINCT card_id, page FROM found) GROUP BY card_id
"""


# The longest rising sequence by piles: a place goes on the first pile whose top is not below it. Places of a word are
# taken from the last to the first. A pair whose words, counted with repetition, fall short cannot reach the floor.
ALIGNED = f"""
WITH c AS (SELECT item_id, regexp_extract_all({sql_norm('text')}, '[a-z0-9]+') AS words FROM benchmark),
p AS (SELECT doc_id, regexp_extract_all({sql_norm('text')}, '[a-z0-9]+') AS words FROM documents),
cw AS (SELECT item_id, len(words) AS words, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM c),
pw AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS j FROM p),
cn AS (SELECT item_id, word, max(words) AS words, count(*) AS n FROM cw GROUP BY item_id, word),
pn AS (SELECT doc_id, word, count(*) AS n FROM pw WHERE word IN (SELECT word FROM cw) GROUP BY doc_id, word),
near AS (SELECT item_id, doc_id FROM cn JOIN pn ON cn.word = pn.word GROUP BY item_id, doc_id HAVING sum(least(cn.n, pn.n)) >= 0.82 * max(cn.words) - 1e-9),
m AS (SELECT near.item_id, near.doc_id, max(cw.words) AS words, list([j] ORDER BY i, j DESC) AS steps
      FROM near JOIN cw ON near.item_id = cw.item_id JOIN pw ON near.doc_id = pw.doc_id AND cw.word = pw.word GROUP BY ALL),
t AS (SELECT item_id, doc_id, words, CAST(len(list_reduce(list_prepend(CAST([] AS BIGINT[]), steps),
        lambda tops, s: list_concat(list_concat(list_filter(tops, lambda x: x < s[1]), s), tops[len(list_filter(tops, lambda x: x < s[1])) + 2:]))) AS BIGINT) AS matched FROM m)
SELECT item_id, doc_id, matched, CAST(words AS BIGINT) AS words, round(matched / words, 6) AS share FROM t WHERE matched >= 0.82 * words - 1e-9
"""


def section_letter_gaps(spark: SparkSession, folder: str) -> DataFrame:
    letters = C.bylaw_heads(spark, folder).where((F.col("unit_type") == "section") & F.col("number").rlike("^[A-Z]$"))
    present = letters.groupBy("parent_clause_id").agg(F.sort_array(F.collect_set(F.lower("number"))).alias("letters"))
    return present.select(
        "parent_clause_id", F.array_join("letters", "").alias("letters"),
        F.array_join(A.missing_letters(F.col("letters")), "").alias("missing"),
    )


def scored_cards(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as scored audit cards, with flags, anchors, segments and warnings derived from their columns."""
    k = F.col("p_partkey")
    cid = F.concat(F.lit("card-"), k)
    empty = F.array().cast("array<string>")
    found = F.when(k % 17 == 0, F.array().cast("array<bigint>")).otherwise(F.array(k % 40 + 1, k % 40 + 9))
    return table(spark, folder, "part").select(
        cid.alias("card_id"),
        F.when(k % 4 == 0, "section").otherwise("clause").alias("unit_type"),
        found.alias("pages"),
        F.when(k % 19 > 0, (F.col("p_size") % 40 + 1).cast("bigint")).alias("page_start"),
        F.when(k % 3 > 0, (F.col("p_size") % 40 + 30).cast("bigint")).alias("page_end"),
        F.when(k % 41 == 0, "h").alias("misfiled"),
        F.when(k % 23 == 0, F.lit("A lettered section is missing.")).alias("gap_issue"),
        F.when(k % 5 == 0, "The board shall: a. meet; b. vote; ii. report.").when(k % 5 == 1, "The board shall meet.").alias("segment"),
        (k % 60).alias("segment_tokens"), (k % 31).alias("card_tokens"), ((k % 100) / 100).alias("recall"),
        (k % 13 == 0).alias("flat_section"),
        F.when(k % 10 == 0, "The board shall:\na. meet;\nb. vote;\n  ii. report.").otherwise("The board shall: a. meet.").alias("source_text"),
        F.when(k % 29 == 0, F.array(F.lit("w1"))).otherwise(empty).alias("warning_ids"),
        F.when(k % 37 == 0, F.array(cid, F.lit("card-x"))).otherwise(empty).alias("duplicate_ids"),
    ).withColumn("anchor_issue", A.anchor_issue())


def verdicts(spark: SparkSession, folder: str) -> DataFrame:
    return A.ladder(scored_cards(spark, folder)).select("card_id", "verdict", "severity", "issue", "required_fix", "confidence")


def verdict_tallies(spark: SparkSession, folder: str) -> DataFrame:
    return A.tallies(A.ladder(scored_cards(spark, folder)))


def finding_patterns(spark: SparkSession, folder: str) -> DataFrame:
    return A.finding_patterns(A.ladder(scored_cards(spark, folder)))


VERDICTS = """
WITH base AS (
  SELECT p_partkey AS k, 'card-' || p_partkey AS card_id, CASE WHEN p_partkey % 4 = 0 THEN 'section' ELSE 'clause' END AS unit_type,
    p_partkey % 17 = 0 AS unfound, p_partkey % 40 + 1 AS f1, p_partkey % 40 + 9 AS f2,
    CASE WHEN p_partkey % 19 > 0 THEN p_size % 40 + 1 END AS s,
    CASE WHEN p_partkey % 3 > 0 THEN p_size % 40 + 30 ELSE CASE WHEN p_partkey % 19 > 0 THEN p_size % 40 + 1 END END AS e
  FROM part
), a AS (
  SELECT *, CASE WHEN unfound THEN 'Source text not confirmed on the extracted PDF text layer'
      WHEN s IS NULL THEN 'Missing source page anchor'
      WHEN NOT (f1 BETWEEN s AND e OR f2 BETWEEN s AND e) THEN 'Source text found only on PDF page(s) [' || f1 || ', ' || f2
        || '], not anchored page ' || s || '-' || e END AS anchor,
    k % 41 = 0 AS misfiled, k % 5 < 2 AND k % 100 < 78 AND k % 60 > k % 31 + 8 AS omission
  FROM base
), b AS (
  SELECT *, anchor IS NOT NULL OR misfiled OR omission AS blocked, anchor IS NOT NULL OR misfiled AS early FROM a
), g AS (
  SELECT *, k % 23 = 0 AND NOT early AS gap, k % 13 = 0 AND NOT blocked AS flat_section,
    k % 5 = 0 AND k % 10 <> 0 AND NOT blocked AS flat_list, k % 29 = 0 AS warned,
    k % 37 = 0 AND unit_type = 'clause' AND k % 31 > 8 AND NOT blocked AS duplicate FROM b
), rows AS (
  SELECT *, CASE WHEN blocked THEN 'BLOCKED_UNSAFE_TO_IMPORT' WHEN gap OR flat_section OR flat_list THEN 'NEEDS_STRUCTURAL_FIX'
      WHEN warned OR duplicate THEN 'NEEDS_MINOR_FIX' ELSE 'PASS' END AS verdict,
    CASE WHEN blocked THEN 'P0' WHEN gap OR flat_section OR flat_list THEN 'P1' ELSE 'P2' END AS severity,
    concat_ws(' ', anchor, CASE WHEN misfiled THEN 'Part I Section I clause is misidentified as Section H; title, slug, parent, and hierarchy are wrong.' END,
      CASE WHEN gap THEN 'A lettered section is missing.' END,
      CASE WHEN omission THEN 'Card source text omits or splices required PDF clause text; card captures about ' || (k % 100)
        || '% of the extracted clause segment.' END,
      CASE WHEN flat_section THEN 'Part II numeric section hierarchy is flattened; card is parented directly under Part II or a page-suffixed letter section instead of Section N.' END, CASE WHEN flat_list THEN 'Nested source list structure is flattened into paragraph text, which loses legal hierarchy even where words are present.' END,
      CASE WHEN warned THEN 'Unresolved-reference warning is accurately carried as review metadata and should remain visible for import review.' END,
      CASE WHEN duplicate THEN 'Exact source text is shared with another card: ' || card_id || ', card-x.' END) AS found,
    concat_ws(' ', CASE WHEN anchor IS NOT NULL THEN 'Re-anchor to the PDF page containing the source text and re-run source-text verification.' END, CASE WHEN misfiled THEN 'Create/use the Part I Section I parent and move this clause under it with the correct clause ID/title.' END,
      CASE WHEN gap THEN 'Add the missing Part I section card and correct the affected child metadata.' END, CASE WHEN omission THEN 'Regenerate this clause from the full PDF clause segment, preserving nested list items and page-spanning text.' END,
      CASE WHEN flat_section THEN 'Add numbered Section parent cards and reparent/rename this card under its true Section N heading.' END, CASE WHEN flat_list THEN 'Represent lower-alpha/roman subclauses as nested structure or separate child units with source page attribution.' END,
      CASE WHEN warned THEN 'Resolve the target if a stable Clause Card exists; otherwise keep the unresolved warning attached.' END, CASE WHEN duplicate THEN 'Confirm this is a legitimate repeated heading/text, or deduplicate if it is an artifact copy.' END) AS fix
  FROM g
), final AS (
  SELECT card_id, verdict, severity, CASE WHEN found = '' THEN 'No source-fidelity, anchor, hierarchy, duplicate, or warning issue found in this audit.' ELSE found END AS issue,
    CASE WHEN fix = '' THEN 'None.' ELSE fix END AS required_fix,
    CASE WHEN verdict = 'PASS' AND unit_type = 'section' THEN 'medium-high' WHEN NOT unfound AND anchor IS NULL THEN 'high'
      ELSE 'medium' END AS confidence FROM rows
)
"""


def reference_register(spark: SparkSession, folder: str) -> DataFrame:
    from lexweave.operators.references import page_slug

    refs = C.bylaw_references(spark, folder).where(F.col("resolution_status") == "unresolved")
    page = page_slug(refs)
    rows = refs.select(
        F.concat(F.lit("legal/unresolved-references/"), page, F.lit(".md")).alias("path"), "reference_text", "reference_type",
        "resolution_status", F.col("source_unit_id").alias("source_clause"), F.col("line_start").alias("source_line_start"),
        F.col("line_end").alias("source_line_end"), page.alias("warning_id"), F.sha2(page, 256).alias("sha256"),
    )
    return warning_register(rows)


def warned_clauses(spark: SparkSession, folder: str) -> DataFrame:
    return warning_links(reference_register(spark, folder)).withColumn("warning_ids", F.array_join("warning_ids", ","))


QUERIES = {
    "source_lines": (source_lines, LINES + "SELECT doc_id, line_no, line FROM kept"),
    "line_profile": (
        line_profile,
        LINES + r"""SELECT lang, source, count(*) AS lines,
        count(*) FILTER (WHERE regexp_matches(line, '^((?i:Part\s+[IVXLCDM]+\s*:\s*.|Section\s+\d+\s*:\s*.|[IVXLCDM]+\.\s*.|\([a-z]\)|Adopted:\s*.|Amended:\s*.)|[A-Z]\.|\s*\d+\.)')) AS heading_like,
        CAST(sum(len(string_split(line, ' '))) AS BIGINT) AS words, CAST(sum(length(line)) AS BIGINT) AS chars FROM kept GROUP BY ALL""",
    ),
    "exact_texts": (
        exact_texts,
        """SELECT '' || conv_id AS slug, length(t) AS chars, sha256(t) AS sha256 FROM (SELECT conv_id,
        coalesce(string_agg(text, chr(10) || chr(10) ORDER BY turn, text) FILTER (WHERE text <> '') || chr(10), '') AS t
        FROM conversations GROUP BY conv_id)""",
    ),
    "content_hashes": (
        content_hashes,
        """SELECT 'doc-' || doc_id AS slug, sha256(text) AS sha256 FROM documents
        UNION ALL SELECT 'item-' || item_id, sha256(text) FROM benchmark""",
    ),
    "ocr_blocks": (
        ocr_blocks,
        """WITH t AS (SELECT *, length(text) AS n, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS chunk_no,
          CASE WHEN turn % 7 = 3 THEN '  ' ELSE text END AS shown FROM conversations),
        s AS (SELECT *, CASE WHEN n % 4 = 0 THEN 1.0 WHEN n % 4 = 1 THEN 0.75 WHEN n % 4 = 2 THEN 0.0 ELSE (n % 100) / 100.0 END AS conf FROM t)
        SELECT 'conv-' || conv_id AS slug, CASE WHEN turn % 3 = 0 THEN 'b' || turn ELSE 'conv-' || conv_id || '-p' ||
          CASE WHEN turn = 0 THEN 'unknown' ELSE '' || turn END || '-c' || chunk_no || '-b1' END AS block_id, 'text' AS block_type,
          shown AS text, CAST(turn AS INTEGER) AS page, CAST(turn AS INTEGER) AS original_page, CAST(round(conf, 6) AS DOUBLE) AS confidence,
          concat_ws(',', CASE WHEN trim(shown) = '' THEN 'ocr_empty' END, CASE WHEN conf < 0.75 THEN 'ocr_low_confidence' END) AS warnings
        FROM s WHERE turn % 2 = 1 OR shown <> ''""",
    ),
    "ocr_status": (
        ocr_status,
        """WITH s AS (SELECT conv_id, CASE WHEN turn % 7 = 3 OR trim(text) = '' THEN 1 ELSE 0 END
          + CASE WHEN length(text) % 4 = 2 OR (length(text) % 4 = 3 AND length(text) % 100 < 75) THEN 1 ELSE 0 END AS w FROM conversations)
        SELECT 'conv-' || conv_id AS slug, 'j' || conv_id AS job_id, CAST(count(*) AS INTEGER) AS page_count, 1.5 AS duration, 'full' AS result_type,
          CAST(sum(w) AS BIGINT) AS warning_count, CASE WHEN sum(w) > 0 THEN 'review_required' ELSE 'ok' END AS status FROM s GROUP BY conv_id""",
    ),
    "clause_segments": (
        clause_segments,
        """WITH l AS (SELECT o_custkey AS c, o_orderkey AS k, l_linenumber AS item,
          dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n,
          row_number() OVER (PARTITION BY o_custkey, o_orderkey ORDER BY l_linenumber) AS i FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
        SELECT 'cust-' || c AS doc, 'order-' || k AS card_id, string_agg(CASE WHEN i = 1 THEN n || '. Order ' || k || ' opens;'
          ELSE 'item ' || item || ' of order ' || k || ' follows;' END, ' ' ORDER BY i) AS segment FROM l GROUP BY c, k""",
    ),
    "book_segments": (
        book_segments,
        """WITH l AS (SELECT DISTINCT l_orderkey AS k, l_linenumber AS item FROM lineitem),
        r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY item) AS i FROM l)
        SELECT CASE WHEN k % 10 > 0 THEN 'book' ELSE 'leaf-' || (k % 7) END AS doc, 'order-' || k AS card_id,
          string_agg(CASE WHEN i = 1 THEN (k % 50 + 1) || '. Order ' || k || ' opens;' ELSE 'item ' || item || ' of order ' || k || ' follows;' END, ' ' ORDER BY i) AS segment
        FROM r GROUP BY k""",
    ),
    "extraction_headers": (
        extraction_headers,
        """WITH t AS (SELECT *, conv_id % 6 AS k, CASE WHEN turn % 7 = 3 THEN '  ' ELSE text END AS shown, length(text) AS n FROM conversations),
        s AS (SELECT *, CASE WHEN trim(shown) = '' THEN 1 ELSE 0 END + CASE WHEN n % 4 = 2 OR (n % 4 = 3 AND n % 100 < 75) THEN 1 ELSE 0 END AS w FROM t),
        g AS (SELECT conv_id, k, sum(w) AS w, count(*) AS n, max(CASE WHEN trim(shown) <> '' THEN 1 ELSE 0 END) AS full_text FROM s GROUP BY conv_id, k)
        SELECT 'conv-' || conv_id AS slug,
          CASE WHEN k IN (0, 1, 2, 3) OR full_text = 0 THEN 'failed' WHEN w > 0 THEN 'review_required' ELSE 'ok' END AS status,
          CASE WHEN k = 0 THEN 'unknown_provider_error' WHEN k IN (1, 3) THEN 'provider_validation'
            WHEN k = 2 OR full_text = 0 THEN 'partial_extraction' END AS category,
          CASE WHEN k > 3 THEN n ELSE 0 END AS blocks, CAST(CASE WHEN k > 3 THEN w ELSE 0 END AS INTEGER) AS warnings FROM g""",
    ),
    "ocr_failures": (
        ocr_failures,
        """WITH e AS (SELECT [401, 429, 504, 442, 415, 422, 500][event_id % 9 + 1] AS code, event_type = 'error' AS conn, user_id % 5 = 0 AS slow FROM events)
        SELECT CASE WHEN code = 401 THEN 'provider_auth' WHEN code = 429 THEN 'provider_rate_limit' WHEN code = 504 OR slow THEN 'provider_timeout'
          WHEN code = 442 THEN 'pdf_password_protected' WHEN code = 415 THEN 'pdf_corrupt_or_unsupported' WHEN conn THEN 'provider_connection'
          WHEN code = 422 THEN 'provider_validation' WHEN code IS NOT NULL THEN 'provider_api_error' ELSE 'unknown_provider_error' END AS category,
          'failed' AS status, 'error' AS severity, CAST(code AS VARCHAR) AS provider_code, count(*) AS n FROM e GROUP BY ALL""",
    ),
    "manifest_rules": (
        manifest_rules,
        """SELECT '' || o_orderkey AS slug, 'document_type outside its domain' AS issue FROM orders WHERE o_orderkey % 5 = 0
        UNION ALL SELECT '' || o_orderkey, 'status outside its domain' FROM orders WHERE o_orderstatus NOT IN ('F', 'O')
        UNION ALL SELECT '' || o_orderkey, 'effective_date is null and not explained' FROM orders WHERE o_orderkey % 3 = 0 AND o_custkey % 2 <> 0
        UNION ALL SELECT '' || o_orderkey, 'reviewed_by is null and not explained' FROM orders WHERE o_orderkey % 2 = 0 AND o_custkey % 2 = 0""",
    ),
    "corpus_header": (
        corpus_header,
        """SELECT 'trade-acts' AS corpus_id, CASE WHEN count(DISTINCT s_nationkey) = 1 THEN min('acts-' || s_nationkey) ELSE 'fixture-v1' END AS corpus_version,
        CAST(NULL AS VARCHAR) AS target_namespace, 'public-record' AS classification, 'production_batch' AS sync_eligibility, true AS sync_eligible,
        string_agg(DISTINCT CASE WHEN s_nationkey % 2 = 0 THEN 'public' ELSE 'internal' END, ',' ORDER BY CASE WHEN s_nationkey % 2 = 0 THEN 'public' ELSE 'internal' END)
        AS confidentiality_scope FROM supplier""",
    ),
    "extraction_quality": (
        extraction_quality,
        f"""WITH m AS (SELECT source, lang, 'reader-' || lang AS provider, max(n_chars) > 4000 AS success, 10 AS page_count,
          min(n_chars) AS page_anchor_coverage, count(*) FILTER (WHERE n_chars > 100) AS part_headings, 3 AS lettered_sections,
          max(n_chars) AS numbered_clauses, 4 AS definitions, count(*) FILTER (WHERE n_chars < 50) AS duplicate_heading_ids,
          count(*) FILTER (WHERE n_chars < 30) AS missing_heading_ids, 0 AS hierarchy_transition_errors,
          count(*) FILTER (WHERE n_chars % 7 = 0) AS material_warnings, count(*) FILTER (WHERE n_chars % 11 = 0) AS unresolved_reference_warnings,
          'same' AS source_hash, '' || (count(*) % 2) AS deterministic_id_fingerprint FROM documents GROUP BY source, lang),
        d AS (SELECT l.source, l.lang AS local_lang, c.lang AS candidate_lang, l.provider AS lp, c.provider AS cp,
          concat_ws(',', {QUALITY_SQL_RULES}) AS worse, concat_ws(',', {QUALITY_SQL_GAINS}) AS gains
          FROM m l JOIN m c ON l.source = c.source AND l.lang <> c.lang)
        SELECT source, local_lang, candidate_lang, CASE WHEN worse <> '' THEN lp ELSE cp END AS selected_provider,
          CASE WHEN worse <> '' THEN 'local_retained' ELSE 'candidate_selected' END AS decision,
          CASE WHEN worse <> '' THEN worse WHEN gains <> '' THEN gains ELSE 'candidate_structurally_equivalent' END AS reasons FROM d""",
    ),
}

HITS = """
WITH pages AS (
  SELECT 'docs/doc-' || doc_id || '.md' AS path, 'doc-' || doc_id AS alias, [source, lang] AS links, 'doc-' || doc_id || chr(10) || text AS hay FROM documents
  UNION ALL SELECT DISTINCT 'sources/' || source || '.md', source, [], source FROM documents
), w AS (SELECT path, unnest(list_distinct(list_transform(regexp_extract_all(hay, '[A-Za-z0-9]+'), lambda x: lower(x)))) AS word FROM pages),
qw AS (SELECT item_id, unnest(list_distinct(list_transform(regexp_extract_all(text, '[A-Za-z0-9]+'), lambda x: lower(x)))) AS word FROM benchmark),
overlap AS (SELECT item_id, path, count(*) AS n FROM w JOIN qw USING (word) GROUP BY ALL),
phrase AS (SELECT item_id, path, 2 AS n FROM benchmark JOIN pages ON contains(lower(hay), lower(text))),
scored AS (SELECT item_id, path, CAST(sum(n) AS DOUBLE) AS score FROM (SELECT * FROM overlap UNION ALL SELECT * FROM phrase) GROUP BY ALL),
hits AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, path) AS rank FROM scored QUALIFY rank <= 5)
"""
QUERIES |= {
    "ranked_pages": (ranked_pages, HITS + "SELECT 'q' || item_id AS question_id, rank, path, score FROM hits"),
    "gold_results": (
        gold_results,
        HITS + """, want AS (
          SELECT item_id, 'clause' AS kind, 1 AS ord, 'doc-' || item_id AS alias FROM benchmark
          UNION ALL SELECT item_id, 'clause', 2, 'doc-' || (item_id * 9) FROM benchmark
          UNION ALL SELECT item_id, 'parent', 1, 'src' || (item_id % 25) FROM benchmark
          UNION ALL SELECT item_id, 'definition', 1, 'en' FROM benchmark
          UNION ALL SELECT item_id, 'definition', 2, 'src' || (item_id % 3) FROM benchmark
        ), missing AS (
          SELECT item_id, kind, ord, alias FROM want WHERE alias NOT IN (SELECT alias FROM pages)
            OR (kind = 'clause' AND NOT EXISTS (SELECT 1 FROM hits h JOIN pages p ON p.path = h.path WHERE h.item_id = want.item_id AND p.alias = want.alias))
            OR (kind <> 'clause' AND NOT EXISTS (SELECT 1 FROM pages p WHERE p.alias IN ('doc-' || want.item_id, 'doc-' || (want.item_id * 9))
              AND list_contains(p.links, want.alias)))
        )
        SELECT 'q' || item_id AS question_id,
          coalesce(string_agg(m.alias, ',' ORDER BY m.ord) FILTER (WHERE m.kind = 'clause'), '') AS missing_clause_ids,
          coalesce(string_agg(m.alias, ',' ORDER BY m.ord) FILTER (WHERE m.kind = 'parent'), '') AS missing_parent_ids,
          coalesce(string_agg(m.alias, ',' ORDER BY m.ord) FILTER (WHERE m.kind = 'definition'), '') AS missing_definition_ids,
          count(m.alias) = 0 AS passed
        FROM benchmark LEFT JOIN missing m USING (item_id) GROUP BY item_id""",
    ),
    "duplicate_texts": (
        duplicate_texts,
        f"""SELECT string_agg(doc_id, ',' ORDER BY doc_id) AS ids, count(*) AS n FROM
        (SELECT doc_id, {sql_norm('text')} AS needle FROM documents) WHERE needle <> '' GROUP BY needle HAVING count(*) > 1""",
    ),
    "word_recall": (
        word_recall,
        f"""WITH d AS (SELECT doc_id, regexp_extract_all({sql_norm('text')}, '[a-z0-9]+') AS words FROM documents),
        w AS (SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(words) AS word FROM d) GROUP BY ALL),
        m AS (SELECT a.doc_id, sum(least(a.n, b.n)) AS m FROM w a JOIN w b ON b.doc_id = a.doc_id + 1 AND a.word = b.word GROUP BY a.doc_id)
        SELECT a.doc_id, CAST(len(a.words) AS BIGINT) AS segment_tokens, CAST(len(b.words) AS BIGINT) AS card_tokens,
          CASE WHEN len(a.words) = 0 OR len(b.words) = 0 THEN 1.0 ELSE CAST(round(coalesce(m, 0) / len(a.words), 6) AS DOUBLE) END AS recall
        FROM d a JOIN d b ON b.doc_id = a.doc_id + 1 LEFT JOIN m ON m.doc_id = a.doc_id""",
    ),
    "confirmed_pages": (confirmed_pages, CONFIRMED),
    "page_alignment": (page_alignment, ALIGNED),
    "section_letter_gaps": (
        section_letter_gaps,
        BYLAWS + """, present AS (SELECT section_id AS parent_clause_id, list_sort(list(DISTINCT lower(l_returnflag))) AS l FROM letters GROUP BY 1)
        SELECT parent_clause_id, array_to_string(l, '') AS letters, array_to_string(list_filter(
          list_transform(range(ascii(l[1]), ascii(l[-1]) + 1), lambda x: chr(CAST(x AS INTEGER))), lambda c: NOT list_contains(l, c)), '') AS missing FROM present""",
    ),
    "verdicts": (verdicts, VERDICTS + "SELECT * FROM final"),
    "verdict_tallies": (
        verdict_tallies,
        VERDICTS + """, t AS (SELECT count(*) AS reviewed, count(*) FILTER (WHERE verdict = 'PASS') AS passed,
          count(*) FILTER (WHERE verdict LIKE 'NEEDS%') AS needs_fixes, count(*) FILTER (WHERE verdict LIKE 'BLOCKED%') AS blocked,
          count(*) FILTER (WHERE severity = 'P1') AS p1_count, count(*) FILTER (WHERE severity = 'P2' AND verdict <> 'PASS') AS p2_count FROM final)
        SELECT CASE WHEN blocked > 0 THEN 'FAIL' WHEN needs_fixes > 0 THEN 'PASS_WITH_FIXES' ELSE 'PASS' END AS full_verdict, * FROM t""",
    ),
    "finding_patterns": (
        finding_patterns,
        VERDICTS + """SELECT rtrim(split_part(issue, '. ', 1), '.') || '.' AS pattern, count(*) AS cards, min(card_id) AS first_card
        FROM final WHERE severity = 'P1' GROUP BY 1""",
    ),
    "warning_links": (
        warned_clauses,
        BYLAWS + """, u AS (SELECT *, clause_id || '-' || replace(kind, '_', '-') || '-' || ref_ord AS page FROM resolved WHERE status = 'unresolved')
        SELECT clause_id AS card_id, string_agg(page, ',' ORDER BY page) AS warning_ids FROM u GROUP BY clause_id""",
    ),
    "reference_register": (
        reference_register,
        BYLAWS + """, u AS (SELECT *, clause_id || '-' || replace(kind, '_', '-') || '-' || ref_ord AS page FROM resolved WHERE status = 'unresolved')
        SELECT 'legal/unresolved-references/' || page || '.md' AS path, sha256(target) AS reference_text_sha256, kind AS reference_type,
          status AS resolution_status, sha256(page) AS sha256, clause_id AS source_clause, clause_id AS affected_clause,
          CAST(NULL AS INTEGER) AS source_line_start, CAST(NULL AS INTEGER) AS source_line_end, page AS warning_id FROM u""",
    ),
}
