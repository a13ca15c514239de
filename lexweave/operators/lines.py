"""From text blocks to ordered, cleaned lines with their neighbours."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexweave.functions import patterns as P
from lexweave.functions import text as X
from lexweave.operators.scan import ordered_scan
from lexweave.session import materialize

BLOCKS_PER_CHUNK = 1024
POSITION = ("block_ord", "offset")


def block_chunk(width: int = BLOCKS_PER_CHUNK) -> Column:
    """Default chunk of a block: runs of consecutive blocks. Sources with uneven blocks bring their own column."""
    return F.floor(F.col("block_ord") / width)


def with_chunk(blocks: DataFrame) -> DataFrame:
    return blocks if "chunk" in blocks.columns else blocks.withColumn("chunk", block_chunk())


def clean_lines(text: Column) -> Column:
    """Cleaned non-empty lines of a text: offset inside it, line, and whether it looks like a heading or list item."""
    cleaned = F.transform(
        X.cleaned_lines(text), lambda line, i: F.struct(i.cast("int").alias("offset"), line.alias("line"))
    )
    kept = F.filter(cleaned, lambda entry: entry["line"] != "")
    return F.transform(
        kept,
        lambda entry: F.struct(
            entry["offset"].alias("offset"),
            entry["line"].alias("line"),
            X.heading_like(entry["line"]).alias("like"),
            entry["line"].rlike(P.LIST_ITEM).alias("item"),
        ),
    )


def explode_lines(blocks: DataFrame) -> DataFrame:
    """One row per cleaned line. Blocks need a text; all other columns are kept."""
    return blocks.select("*", F.explode(clean_lines(F.col("text"))).alias("_line")).select(
        *[c for c in blocks.columns if c != "text"], "_line.offset", "_line.line"
    )


def neighbouring_blocks(blocks: DataFrame, front_pages: int) -> DataFrame:
    """Blocks with their cleaned lines (_lines), the line after the last of them (_next) and the one before (_prev).

    Only the first and last line of each block travel through the ordered scan. ``front`` marks blocks on title and
    contents pages. How many pages these are is said by a column front_pages of the blocks; where it is absent or null
    they are the pages below front_pages of a locally extracted PDF with more than ten pages.
    """
    usual = F.when((F.col("provider") == "local_pdf") & (F.coalesce(F.col("page_count"), F.lit(0)) > 10), F.lit(front_pages - 1)).otherwise(F.lit(0))
    stated = F.col("front_pages") if "front_pages" in blocks.columns else F.lit(None).cast("int")
    last = F.coalesce(stated, usual)
    is_front = F.coalesce((last > 0) & (F.col("page") <= last), F.lit(False))
    # Cleaning is the costly step; its result is kept, as the scan below reads it twice.
    cleaned = with_chunk(blocks).select(
        "slug", "chunk", "block_ord", "block_id", "page", "original_page", "line_start", is_front.alias("front"),
        clean_lines(F.col("text")).alias("_lines"),
    )
    cleaned = materialize(cleaned, "clean-lines").where(F.size("_lines") > 0)
    return ordered_scan(
        cleaned,
        ["slug"],
        "chunk",
        ["block_ord"],
        lead={"_next": bare(F.element_at("_lines", 1))},
        lag={"_prev": behind(F.element_at("_lines", -1))},
    )


def bare(entry: Column) -> Column:
    return F.struct(*[entry[c].alias(c) for c in ("line", "like", "item")])


def behind(entry: Column) -> Column:
    return F.struct(*[entry[c].alias(c) for c in ("line", "like", "item")], F.col("front"))


def line_after(entry: Column, i: Column) -> Column:
    """The line after the i-th of a block; only lines that look like headings ask for it."""
    return F.when(entry["like"], F.when(i + 1 < F.size("_lines"), bare(F.get("_lines", i + 1))).otherwise(F.col("_next")))


def line_before(i: Column) -> Column:
    """The line before the i-th of a block, if it looks like a heading or stands in another block."""
    return F.when(i == 0, F.col("_prev")).when(F.get("_lines", i - 1)["like"], behind(F.get("_lines", i - 1)))


def lines_with_neighbours(blocks: DataFrame, front_pages: int) -> DataFrame:
    """Cleaned lines with the line before and after, also across block borders; see neighbouring_blocks."""
    # Neighbours are put into the array before it is exploded: a row must not carry its whole block.
    entries = F.transform(
        "_lines", lambda e, i: F.struct(e.alias("here"), line_after(e, i).alias("next"), line_before(i).alias("prev"))
    )
    kept = ("slug", "chunk", "block_ord", "block_id", "page", "original_page", "line_start", "front")
    return (
        neighbouring_blocks(blocks, front_pages).select(*kept, entries.alias("_entries"))
        .select(*kept, F.explode("_entries").alias("_e"))
        .select(
            "slug",
            "chunk",
            "block_ord",
            "_e.here.offset",
            "_e.here.line",
            "_e.here.like",
            "_e.here.item",
            "_e.next",
            "_e.prev",
            "block_id",
            "page",
            "original_page",
            (F.col("line_start") + F.col("_e.here.offset")).alias("line_no"),
            "front",
        )
    )
