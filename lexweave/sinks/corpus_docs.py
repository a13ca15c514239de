"""Root pages of a corpus (how to resolve, schema, index) and its schema pack."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexweave.operators.validate import REQUIRED_FIELDS
from lexweave.sinks.render import FOLDERS, page


def _root_page(df: DataFrame, name: str, title: str, kind: str, links: list[str], generated_at: str, body: list) -> DataFrame:
    fields = {
        "title": F.lit(title),
        "type": F.lit(kind),
        "status": F.lit("production_readiness"),
        "generated_at": F.lit(generated_at),
        "confidentiality": F.lit("internal"),
        "wikilinks": F.array(*map(F.lit, links)),
    }
    none = F.lit(None).cast("string")
    return df.select(
        F.lit(name).alias("path"), page(df, fields, [F.concat(F.lit("# "), F.lit(title)), "", *body]).alias("content"),
        F.lit("generated_file").alias("file_type"), none.alias("slug"), none.alias("clause_id"),
    )


def root_pages(documents: DataFrame, generated_at: str, manifest_hash: str) -> DataFrame:
    """RESOLVER.md, schema.md and index.md; the index lists all documents by slug."""
    line = F.concat(
        F.lit("- `"), "slug", F.lit("`: "), "title", F.lit(" (`"), "document_type", F.lit("`, authority rank `"),
        F.col("authority_rank").cast("string"), F.lit("`, status `"), "status", F.lit("`)."),
    )
    listed = documents.agg(F.array_join(F.sort_array(F.collect_list(F.struct("slug", line.alias("l")))).getField("l"), "\n").alias("lines"))
    kinds = "\n".join(f"- `{kind}`: {', '.join(sorted(fields))}." for kind, fields in REQUIRED_FIELDS.items())
    folders = "\n".join(f"- `{kind}` pages live below `legal/clauses/{folder}/`." for kind, folder in FOLDERS.items())
    resolver = [
        "## Source Text", "",
        "Find the page by clause ID, slug or file name, read its `## Source Text` in full, then its parent chain and definitions.",
        "Answers cite the clause ID, the source version and the effective date, and name open references and exceptions.", "",
        "## Folders", "", folders,
    ]
    schema = ["## Required fields", "", kinds]
    index = [
        "## Documents", "", F.col("lines"), "", "## Use", "",
        "The pages repeat source text; the source stays authoritative. Publication needs an approval outside this corpus.", "",
        F.lit(f"- Source manifest hash: `{manifest_hash}`."),
    ]
    return (
        _root_page(listed, "RESOLVER.md", "Corpus Resolver", "corpus_resolver", ["index", "schema"], generated_at, resolver)
        .unionByName(_root_page(listed, "schema.md", "Corpus Schema", "corpus_schema", ["RESOLVER", "index"], generated_at, schema))
        .unionByName(_root_page(listed, "index.md", "Corpus Index", "corpus_index", ["RESOLVER", "schema"], generated_at, index))
    )


def schema_pack() -> dict:
    """Page types and their required fields, as data for a schema pack file."""
    return {"version": "0.1.0", "types": {kind: sorted(fields) for kind, fields in REQUIRED_FIELDS.items()}}
