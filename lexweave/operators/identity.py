"""Unit identifiers, collision suffixes and parent chains."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexweave.operators.lines import POSITION
from lexweave.operators.scan import position_in_group
from lexweave.session import materialize


def pos() -> Column:
    return F.struct(*POSITION)


def collision_tags(heads: DataFrame, level: str) -> DataFrame:
    """Suffixes of heads whose identifier is already taken: slug, level, pos, tag.

    Siblings collide when parent, level and number agree. The first keeps its identifier, later ones take the page
    ('-p7'), and further ones on the same page also a counter ('-p7-2'). Only colliding heads are shuffled, and a
    hot group is numbered chunk by chunk. Heads without a page take their ordinal among the document's units.
    """
    key = ["slug", "parent_key", level, "id_part"]
    page = F.coalesce(F.nullif("page", F.lit(0)).cast("bigint"), F.col("unit_ord") + 1)
    # Nearly all heads are ruled out by a number of their key; texts of keys are shuffled for the rest alone.
    code = F.xxhash64(*key)
    twice = materialize(heads.groupBy(code.alias("_code")).agg(F.count("*").alias("_n")).where("_n > 1").select("_code"), "repeated-codes")
    names = dict.fromkeys([*key, "chunk", *POSITION, "page", "unit_ord"])
    heads = materialize(heads.select(*names, code.alias("_code")).join(twice, "_code", "left_semi").drop("_code"), "repeated-heads")
    repeated = heads.groupBy(*key).agg(F.count("*").alias("_n"), F.min(pos()).alias("_first")).where("_n > 1")
    members = heads.select(*key, "chunk", *POSITION, page.alias("_page")).join(repeated, key)
    later = members.where(pos() != F.col("_first"))
    counted = position_in_group(later, [*key, "_page"], "chunk", POSITION, "_again")
    counter = F.when(F.col("_again") > 1, F.concat(F.lit("-"), F.col("_again").cast("string"))).otherwise(F.lit(""))
    return counted.select(
        "slug", level, pos().alias("pos"), F.concat(F.lit("-p"), F.col("_page").cast("string"), counter).alias("tag")
    )


def heading_tags(tags: DataFrame, label: str) -> DataFrame:
    """Tags of headings above clauses, which every unit below them looks up; written apart, as those of clauses grow with
    the clauses and would send all units below a heading to one place."""
    return materialize(tags.where(F.col("kind") != "clause").drop("kind"), label)


def attach_tag(df: DataFrame, tags: DataFrame, position: Column, name: str) -> DataFrame:
    """Look up the collision suffix of the head at the given position; empty where it has none."""
    probe = tags.select(F.col("slug").alias("_slug"), F.col("pos").alias("_pos"), F.col("tag").alias(name))
    hit = (df["slug"] == F.col("_slug")) & (position == F.col("_pos"))
    return df.join(probe, hit, "left").drop("_slug", "_pos").fillna({name: ""})


def instrument_rows(documents: DataFrame, first_blocks: DataFrame) -> DataFrame:
    """Root unit of each document, anchored at its first block."""
    return documents.join(first_blocks, "slug", "left").select(
        "slug",
        F.lit(0).cast("bigint").alias("unit_ord"),
        F.lit(-1).cast("bigint").alias("block_ord"),
        F.lit(-1).alias("offset"),
        F.lit(-1).cast("bigint").alias("chunk"),
        F.col("slug").alias("clause_id"),
        F.lit("instrument").alias("unit_type"),
        F.lit(None).cast("string").alias("number"),
        F.col("title"),
        F.col("title").alias("text"),
        "page",
        F.lit(None).cast("int").alias("page_end"),
        "original_page",
        "line_start",
        "line_end",
        F.lit(None).cast("string").alias("source_block_id"),
        F.lit(None).cast("string").alias("parent_clause_id"),
        F.array().cast("array<string>").alias("parent_chain"),
        F.array().cast("array<string>").alias("heading_path"),
        F.lit(True).alias("is_top_level"),
        F.lit(None).cast("map<string,string>").alias("metadata"),
    )


UNIT_COLUMNS = (
    "slug", "unit_ord", "block_ord", "offset", "chunk", "clause_id", "unit_type", "number", "title", "text", "page",
    "page_end", "original_page", "line_start", "line_end", "source_block_id", "parent_clause_id", "parent_chain",
    "heading_path", "is_top_level", "metadata",
)


def first_blocks(blocks: DataFrame) -> DataFrame:
    """Anchor of the first block of each document."""
    anchor = F.struct("page", "original_page", "line_start", "line_end")
    first = F.min_by(anchor, F.col("block_ord")).alias("_a")
    return blocks.groupBy("slug").agg(first).select("slug", "_a.*")


def path_id(slug: Column, *parts: Column) -> Column:
    return F.concat(slug, *[p for part in parts for p in (F.lit("-"), part)])


def chain_of(*ids: Column) -> Column:
    """Ancestors from the root down; levels that do not apply are null and left out."""
    return F.filter(F.array(*ids), lambda x: x.isNotNull())
