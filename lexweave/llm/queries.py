"""One query per operator, over the whole of its table, with SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexweave.llm import divergence, embeddings, html_text, language, mixing, packing, prefix_trie, quality, secrets, simhash, token_counts, token_files, warc
from lexweave.llm.common import documents


def op1_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(documents(spark, folder), public_tokenizers.path("word_bpe_49k.json"), end_id=0)


def op2_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, folder))
    return found.select("doc_id", simhash.hex64(F.col("fp")).alias("fingerprint"), "component_id")


def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    scored = quality.score(documents(spark, folder))
    return scored.select("doc_id", *quality.COUNTS, "base_failed", "p_good", "kept")


def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, folder), public_tokenizers.path("piece_bpe_32k.model"))


def op5_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_vectors(documents(spark, folder, "embeddings"))


def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(documents(spark, folder), named=True).drop("rate")


def op7_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.digest(secrets.scan(documents(spark, folder), F.concat_ws("/", "source", "lang"), F.col("source")))


def op8_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive_pages(documents(spark, folder, "pages")).drop("url", "payload")


def op9_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.token_table(documents(spark, folder), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


def op10_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.main_text(documents(spark, folder, "pages"))


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_trie(documents(spark, folder, "conversations"))


def op12_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.divergence(documents(spark, folder))


def op13_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(documents(spark, folder))


MIXING_SQL = """
WITH n AS (SELECT source, count(*) AS n_docs FROM documents GROUP BY source),
t AS (SELECT sum(sqrt(n_docs)) AS all_weight, sum(n_docs) AS all_docs FROM n),
r AS (SELECT n.source, sqrt(n_docs) * (all_docs / all_weight) / n_docs AS rate FROM n, t),
k AS (SELECT unnest(range(0, 2000)) AS k),
p AS (SELECT source, k, CASE WHEN k = 0 THEN exp(-rate) ELSE exp(-rate + k * ln(rate) - lgamma(k + 1)) END AS p
      FROM r, k WHERE k <= rate + 12 * sqrt(rate) + 30),
c AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS below FROM p),
u AS (SELECT *, ('0x' || substr(md5('0:' || coalesce(CAST(doc_id AS VARCHAR), '?')), 1, 13))::BIGINT / 4503599627370496.0 AS u FROM documents),
m AS (SELECT u.*, c.k FROM u JOIN c ON u.source IS NOT DISTINCT FROM c.source AND u.u >= c.below)
SELECT doc_id, text, lang, source, n_chars, CAST(k AS INTEGER) AS copy,
       md5('0:place:' || coalesce(CAST(doc_id AS VARCHAR), '?') || ':' || CAST(k AS VARCHAR)) AS position
FROM m
"""

WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, upper(sha1(coalesce(html, ''))) AS h FROM pages),
f AS (SELECT h, min(page_id) AS first_id FROM p GROUP BY h)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 8), lambda i: array_to_string(list_transform([15, 10, 5, 0],
           lambda b: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(((('0x' || substr(p.h, 1 + 5 * i, 5))::BIGINT >> b) & 31) AS INTEGER), 1)), '')), '') AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS NOT DISTINCT FROM first_id THEN NULL ELSE first_id END AS refers_to
FROM p JOIN f ON p.h = f.h
"""

LINKS_SQL = """
WITH RECURSIVE v AS (
    SELECT row_number() OVER () AS row, vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
u AS (SELECT *, list_dot_product(e, e) AS s FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL)) = 0
      AND len(list_filter(e, lambda x: isnan(x) OR isinf(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (SELECT a.row AS a, a.vec_id AS id, b.row AS b, b.vec_id AS other FROM u a JOIN u b ON a.label = b.label AND a.row <> b.row AND len(a.e) = len(b.e)
      WHERE list_dot_product(a.e, b.e) >= 0.98 * sqrt(a.s) * sqrt(b.s)),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a),
reach AS (SELECT a AS root, b AS at FROM l UNION SELECT reach.root, l.b FROM reach JOIN l ON reach.at = l.a),
c AS (SELECT root, min(v.vec_id) AS least FROM reach JOIN v ON reach.at = v.row GROUP BY root)
SELECT v.vec_id, coalesce(n.n_links, 0) AS n_links, coalesce(least(c.least, v.vec_id), v.vec_id) AS component_id,
       coalesce(v.vec_id = coalesce(least(c.least, v.vec_id), v.vec_id), false) AS kept
FROM v LEFT JOIN n ON v.row = n.a LEFT JOIN c ON v.row = c.root
"""

TRIE_SQL = r"""
WITH RECURSIVE o AS (
    SELECT conv_id, sha256(CAST(length(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, '')) AS d, turn,
           CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_words FROM conversations WHERE conv_id IS NOT NULL),
t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, substr(d, 1, 30)) AS pos FROM o),
c AS (SELECT conv_id, conv_id - conv_id % 20 AS donor,
             xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))),
                 lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda r, i: xor(r >> 1, 3988292384 * (r & 1))))) % 4 AS h
      FROM t GROUP BY conv_id),
r AS (SELECT c.conv_id, 0 AS part, t.pos, t.d, t.n_words FROM c JOIN t ON t.conv_id = c.donor AND t.pos <= c.h
      UNION ALL SELECT c.conv_id, 1, t.pos, t.d, t.n_words FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos > c.h),
b AS (SELECT c.conv_id, coalesce(list(struct_pack(d := r.d, n := r.n_words) ORDER BY part, pos) FILTER (r.d IS NOT NULL), []) AS turns
      FROM c LEFT JOIN r ON r.conv_id = c.conv_id GROUP BY c.conv_id),
p AS (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS depth FROM b),
n AS (SELECT turns[1:depth] AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
             sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(turns) = depth), '')) AS ends_sha256
      FROM p GROUP BY ALL),
k AS (SELECT n.*, q.conv_id AS parent_conv_id FROM n LEFT JOIN n q ON q.depth = n.depth - 1 AND q.path = n.path[1:n.depth - 1]),
j AS (SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
w AS (SELECT k.*, coalesce(j.n_children, 0) AS n_children, CASE WHEN k.depth = 0 THEN 0 ELSE (n_convs - 1) * k.path[k.depth].n END AS saved
      FROM k LEFT JOIN j ON j.path = k.path),
u AS (SELECT path, saved, n_children, unnest(range(0, depth + 1)) AS up FROM w),
s AS (SELECT path[1:up] AS path, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves FROM u GROUP BY ALL)
SELECT w.conv_id, CAST(w.depth AS BIGINT) AS depth, w.parent_conv_id, w.n_convs, w.n_children, s.n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, w.ends_sha256
FROM w JOIN s ON s.path = w.path
"""

DIVERGENCE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
w AS (SELECT row, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
k AS (SELECT lang, term, count(*) AS n_lang FROM w GROUP BY lang, term HAVING count(DISTINCT row) >= 3),
c AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN k ON w.lang = k.lang AND w.term = k.term GROUP BY ALL),
v AS (SELECT lang, count(*) AS size, sum(n_lang) AS total FROM k GROUP BY lang),
g AS (SELECT d.lang, d.source, coalesce(max(t.total), 0) AS total FROM (SELECT DISTINCT lang, source FROM d) d
      LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY lang, source) t ON d.lang = t.lang AND d.source = t.source GROUP BY d.lang, d.source),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
             1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.total + v.size)::HUGEINT AS p,
             1 + (1000000000::HUGEINT * (k.n_lang + 1)) // (v.total + v.size)::HUGEINT AS q
      FROM g JOIN v ON g.lang = v.lang JOIN k ON g.lang = k.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
u AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
      UNION ALL SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // q AS BIGINT) FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM u)
SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= 200
"""

#: name -> (query, SQL or None)
QUERIES = {
    "op1_best_fit_packing": (op1_best_fit_packing, None),
    "op2_simhash_near_dedup": (op2_simhash_near_dedup, None),
    "op3_quality_rules": (op3_quality_rules, None),
    "op4_token_counts": (op4_token_counts, None),
    "op5_embedding_near_dedup": (op5_embedding_near_dedup, LINKS_SQL),
    "op6_mixing": (op6_mixing, MIXING_SQL),
    "op7_secret_scan": (op7_secret_scan, None),
    "op8_warc": (op8_warc, WARC_SQL),
    "op9_token_files": (op9_token_files, None),
    "op10_html_extraction": (op10_html_extraction, None),
    "op11_prefix_trie": (op11_prefix_trie, TRIE_SQL),
    "op12_source_divergence": (op12_source_divergence, DIVERGENCE_SQL),
    "op13_language_id": (op13_language_id, None),
}
