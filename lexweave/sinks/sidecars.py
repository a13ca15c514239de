"""Extraction and structure sidecars: one JSON text per document, and its exact text."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def exact_text(blocks: DataFrame) -> DataFrame:
    """Text of each document as it was extracted: its non-empty blocks in order, a blank line between, a final line end."""
    kept = blocks.groupBy("slug").agg(
        F.sort_array(F.collect_list(F.when(F.col("text") != "", F.struct("block_ord", "text")))).alias("_b")
    )
    joined = F.array_join("_b.text", "\n\n")
    return kept.select("slug", F.when(F.size("_b") > 0, F.concat(joined, F.lit("\n"))).otherwise("").alias("text"))


def extraction_sidecars(extractions: DataFrame, blocks: DataFrame) -> DataFrame:
    """path and content of the extraction sidecars: header fields and ordered blocks as JSON, and the exact text."""
    names = [c for c in blocks.columns if c not in ("slug", "chunk", "provider", "page_count")]
    listed = blocks.groupBy("slug").agg(
        F.sort_array(F.collect_list(F.struct("block_ord", *[c for c in names if c != "block_ord"]))).alias("blocks")
    )
    rows = extractions.join(listed, "slug", "left")
    options = {"ignoreNullFields": "false", "pretty": "true"}
    header = F.struct(*[F.col(c) for c in extractions.columns], F.col("blocks"))
    sidecars = rows.select(
        F.concat(F.lit(".raw/extraction/"), "slug", F.lit(".json")).alias("path"),
        F.concat(F.to_json(header, options), F.lit("\n")).alias("content"), F.lit("raw_extraction").alias("file_type"),
        "slug", F.lit(None).cast("string").alias("clause_id"),
    )
    suffix = F.when(F.col("provider") == "markdown", ".md").otherwise(".txt")
    texts = exact_text(blocks).join(extractions.select("slug", "provider"), "slug").select(
        F.concat(F.lit(".raw/extraction/"), "slug", suffix).alias("path"), F.col("text").alias("content"),
        F.lit("raw_extraction").alias("file_type"), "slug", F.lit(None).cast("string").alias("clause_id"),
    )
    return sidecars.unionByName(texts)


def structure_sidecars(units: DataFrame, definitions: DataFrame, refs: DataFrame) -> DataFrame:
    """path and content of the structure sidecars: units, definitions and references of a document as JSON."""

    def listed(df: DataFrame, key: str, order: list[str], name: str) -> DataFrame:
        rest = [c for c in df.columns if c not in (key, *order, "chunk")]
        return df.groupBy(F.col(key).alias("slug")).agg(
            F.sort_array(F.collect_list(F.struct(*order, F.to_json(F.struct(*rest)).alias("row")))).getField("row").alias(name)
        )

    rows = (
        listed(units, "slug", ["block_ord", "offset"], "units")
        .join(listed(definitions, "instrument_slug", ["block_ord", "offset"], "definitions"), "slug", "left")
        .join(listed(refs, "slug", ["ref_ord"], "references"), "slug", "left")
    )
    part = lambda name: F.concat(F.lit(f'"{name}":['), F.array_join(F.coalesce(name, F.array().cast("array<string>")), ","), F.lit("]"))
    content = F.concat(F.lit("{"), F.concat_ws(",", part("units"), part("definitions"), part("references")), F.lit("}\n"))
    return rows.select(
        F.concat(F.lit(".raw/extraction/"), "slug", F.lit(".structure.json")).alias("path"), content.alias("content"),
        F.lit("raw_extraction").alias("file_type"), "slug", F.lit(None).cast("string").alias("clause_id"),
    )
