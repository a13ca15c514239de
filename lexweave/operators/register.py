"""Register of unresolved references, and release batches of cards."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BATCH_SIZE = 25


def warning_register(unresolved: DataFrame) -> DataFrame:
    """Register rows with digests of the reference text and of the page.

    unresolved: path, reference_text, reference_type, resolution_status, source_clause, source_line_start,
    source_line_end, warning_id and sha256 (of the page file).
    """
    return unresolved.select(
        "path",
        F.sha2(F.coalesce("reference_text", F.lit("")), 256).alias("reference_text_sha256"),
        "reference_type",
        "resolution_status",
        "sha256",
        "source_clause",
        F.col("source_clause").alias("affected_clause"),
        "source_line_start",
        "source_line_end",
        "warning_id",
    )


def warning_links(register: DataFrame) -> DataFrame:
    """Warning identifiers per affected clause; older registers use other key names."""
    def first_of(*names):
        return F.coalesce(*[F.nullif(F.col(n), F.lit("")) for n in names if n in register.columns])

    clause = first_of("affected_clause", "affected_clause_id", "clause_id", "source_clause")
    links = register.select(clause.alias("card_id"), first_of("warning_id", "id").alias("warning_id")).dropna()
    return links.groupBy("card_id").agg(F.sort_array(F.collect_list("warning_id")).alias("warning_ids"))


def release_batches(cards: DataFrame, chunks: int = 4096) -> DataFrame:
    """Cards in release order cut into batches of 25: batch, cards, first and last page, number of sections.

    cards: card_id, page, section_key. Numbering runs over range partitions of the identifiers: each is numbered on
    its own and shifted by the size of those before it.
    """
    from lexweave.session import materialize

    ordered = cards.repartitionByRange(F.col("card_id")).withColumn("_slice", F.spark_partition_id())
    sliced = materialize(ordered, "batch-slices")
    sizes = sliced.groupBy("_slice").agg(F.count("*").alias("_n"))
    along = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("_slice", F.coalesce(F.sum("_n").over(along), F.lit(0)).alias("_shift"))
    inside = F.row_number().over(Window.partitionBy("_slice").orderBy("card_id"))
    numbered = sliced.join(shifts, "_slice").withColumn("_i", inside + F.col("_shift") - 1)
    return (
        numbered.groupBy((F.floor(F.col("_i") / BATCH_SIZE) + 1).alias("batch"))
        .agg(
            F.count("*").alias("cards"),
            F.min("page").alias("first_page"),
            F.max("page").alias("last_page"),
            F.count_distinct("section_key").alias("sections"),
        )
    )
