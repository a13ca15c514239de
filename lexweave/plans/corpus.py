"""Compiled corpora over the tables of a data folder.

A corpus is compiled once per application and folder into Parquet tables in the shared scratch folder; every query then
reads those tables, as one would query a compiled knowledge base.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexweave.operators import bylaws as B
from lexweave.operators import references as R
from lexweave.operators.generic import ParsedGeneric, parse_generic
from lexweave.operators.identity import UNIT_COLUMNS, first_blocks, instrument_rows
from lexweave.operators.policy import parse_policies
from lexweave.session import materialize
from lexweave.sinks import render
from lexweave.sources import rendered
from lexweave.sources.markdown import markdown_blocks
from lexweave.sources.pages import parse_pages

GENERATED_AT = "2000-01-01T00:00:00+00:00"
_built: dict[tuple, object] = {}


def built(spark: SparkSession, folder: str, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """Result of make as a table, made at most once per application and folder."""
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _built:
        _built[key] = materialize(make(), name)
    return _built[key]


def bylaw_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return built(spark, folder, "bylaw-blocks", lambda: rendered.bylaw_blocks(spark, folder))


def bylaw_documents(spark: SparkSession, folder: str) -> DataFrame:
    return rendered.bylaw_documents(spark, folder)


def bylaw_outline(spark: SparkSession, folder: str) -> B.Outline:
    key = (spark.sparkContext.applicationId, folder, "bylaw-outline")
    if key not in _built:
        _built[key] = B.outline(bylaw_blocks(spark, folder))
    return _built[key]


def bylaw_heads(spark: SparkSession, folder: str) -> DataFrame:
    """Units of the bylaws (without the documents) for those who need neither text nor last page."""
    return B.unit_rows(bylaw_outline(spark, folder), texts=False)


def bylaw_texts(spark: SparkSession, folder: str, *kinds: str) -> DataFrame:
    """Units of some kinds (part, section, letter, clause), whole."""
    return B.unit_rows(bylaw_outline(spark, folder), kinds)


def bylaw_clause_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Clauses with their texts, written once: filters on a text would work it out anew."""
    columns = ("slug", "chunk", "block_ord", "offset", "clause_id", "unit_type", "text", "page", "page_end", "line_start", "line_end")
    return built(spark, folder, "bylaw-clause-texts", lambda: bylaw_texts(spark, folder, "clause").select(*columns))


def bylaw_structure(spark: SparkSession, folder: str) -> DataFrame:
    """Documents and units, without text and last page."""
    def make() -> DataFrame:
        roots = instrument_rows(bylaw_documents(spark, folder).select("slug", "title"), first_blocks(bylaw_blocks(spark, folder)))
        return roots.select(*UNIT_COLUMNS).unionByName(bylaw_heads(spark, folder)).drop("text", "page_end")

    return built(spark, folder, "bylaw-structure", make)


def bylaw_units(spark: SparkSession, folder: str) -> DataFrame:
    def make() -> DataFrame:
        roots = instrument_rows(bylaw_documents(spark, folder).select("slug", "title"), first_blocks(bylaw_blocks(spark, folder)))
        return roots.select(*UNIT_COLUMNS).unionByName(bylaw_texts(spark, folder, *B.HEADS))

    return built(spark, folder, "bylaw-units", make)


def bylaw_references(spark: SparkSession, folder: str) -> DataFrame:
    columns = ("slug", "chunk", "block_ord", "offset", "clause_id", "unit_type", "number", "text", "page", "page_end", "line_start", "line_end")
    target = ("slug", "clause_id", "number", "block_ord", "offset")

    def make() -> DataFrame:
        # Identifiers of all clauses, and the texts of those that can hold a reference, come from one pass.
        clauses = materialize(B.unit_rows(bylaw_outline(spark, folder), ("clause",), may=R.may_refer).select(*columns), "bylaw-reference-texts")
        above = B.unit_rows(bylaw_outline(spark, folder), ("part", "section", "letter"), texts=False)
        roots = instrument_rows(bylaw_documents(spark, folder).select("slug", "title"), first_blocks(bylaw_blocks(spark, folder)))
        known = roots.select(*target).unionByName(above.select(*target)).unionByName(clauses.select(*target))
        return R.resolve(R.references(clauses.where(F.col("text") != "")), known, bylaw_documents(spark, folder))

    return built(spark, folder, "bylaw-references", make)


def policy_units(spark: SparkSession, folder: str) -> DataFrame:
    return built(
        spark, folder, "policy-units",
        lambda: parse_policies(
            rendered.policy_documents(spark, folder),
            materialize(rendered.policy_blocks(spark, folder), "policy-blocks"),
        ).units,
    )


def register_documents(spark: SparkSession, folder: str) -> DataFrame:
    files = built(spark, folder, "register-files", lambda: rendered.register_files(spark, folder))
    return files.select(
        "slug", "title", "doc_ord",
        F.sha2("text", 256).alias("source_hash"),
        F.lit("legislation").alias("document_type"),
        F.lit("Customers").alias("jurisdiction"),
        F.lit(50).alias("authority_rank"),
        F.lit("active").alias("status"),
        F.lit("public").alias("confidentiality"),
        F.concat(F.lit("sources/"), F.col("slug"), F.lit(".md")).alias("source_path"),
    )


def register_blocks(spark: SparkSession, folder: str) -> DataFrame:
    def make() -> DataFrame:
        register_documents(spark, folder)
        return markdown_blocks(built(spark, folder, "register-files", lambda: rendered.register_files(spark, folder)))

    return built(spark, folder, "register-blocks", make)


def register(spark: SparkSession, folder: str) -> ParsedGeneric:
    key = (spark.sparkContext.applicationId, folder, "register")
    if key not in _built:
        parsed = parse_generic(register_documents(spark, folder), register_blocks(spark, folder))
        _built[key] = ParsedGeneric(materialize(parsed.units, "register-units"), parsed.unparsed)
    return _built[key]


def register_references(spark: SparkSession, folder: str) -> DataFrame:
    def make() -> DataFrame:
        units = register(spark, folder).units
        return R.resolve(R.references(units), units, register_documents(spark, folder))

    return built(spark, folder, "register-references", make)


def register_files(spark: SparkSession, folder: str) -> DataFrame:
    """Rendered pages of the registers: path, content, file_type, slug, clause_id."""

    def make() -> DataFrame:
        units, docs = register(spark, folder).units, register_documents(spark, folder)
        refs = register_references(spark, folder)
        terms = R.definitions(units)
        return (
            render.unit_pages(units, docs, terms, refs, GENERATED_AT)
            .unionByName(render.instrument_pages(units, docs, GENERATED_AT))
            .unionByName(scoped(render.definition_pages(terms, docs, GENERATED_AT)))
            .unionByName(render.unresolved_pages(refs, docs, GENERATED_AT))
        )

    return built(spark, folder, "register-pages", make)


def scoped(pages: DataFrame) -> DataFrame:
    """Definition pages below a folder of their document: the same term of two documents keeps two pages."""
    return pages.withColumn("path", F.concat(F.lit("legal/definitions/"), "slug", F.lit("/"), F.element_at(F.split("path", "/"), -1)))


def register_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Register pages as a reader of the files sees them: frontmatter and body parsed back."""
    return built(
        spark, folder, "register-parsed",
        lambda: parse_pages(
            register_files(spark, folder).select(
                "path", F.sha2("content", 256).alias("sha256"), F.col("content").alias("text")
            )
        ),
    )


def bylaw_cards(spark: SparkSession, folder: str) -> DataFrame:
    """Audit cards of the rendered bylaws."""
    units = bylaw_units(spark, folder).where(~F.col("is_top_level"))
    empty = F.array().cast("array<string>")
    return units.select(
        F.col("slug").alias("doc"), F.col("clause_id").alias("card_id"), "unit_type", F.col("text").alias("source_text"),
        F.col("page").alias("page_start"), F.coalesce("page_end", "page").alias("page_end"), "parent_chain",
        empty.alias("child_ids"), empty.alias("warning_ids"),
    )


def bylaw_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Source pages of the rendered bylaws: the blocks of a page in order."""
    blocks = bylaw_blocks(spark, folder)
    text = F.array_join(F.sort_array(F.collect_list(F.struct("block_ord", "text"))).getField("text"), "\n")
    return blocks.groupBy(F.col("slug").alias("doc"), "page").agg(text.alias("text"))


