"""Checks on the unit tree: identifiers, parents, chains, and a usable hierarchy per document."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _issue(df: DataFrame, rule: str, detail: Column) -> DataFrame:
    return df.select("slug", "clause_id", F.lit(rule).alias("rule"), detail.cast("string").alias("detail"))


def unit_issues(units: DataFrame) -> DataFrame:
    """One row per broken rule of a unit (or, for duplicates, of an identifier)."""
    below = units.where(~F.col("is_top_level"))
    ids = units.select("slug", F.col("clause_id").alias("known_id"))

    duplicates = units.groupBy("slug", "clause_id").agg(F.count("*").alias("n")).where("n > 1")
    named = below.where(F.coalesce("parent_clause_id", F.lit("")) != "")
    wanted = named.select("slug", F.col("parent_clause_id").alias("known_id")).distinct()
    lost = wanted.join(ids, ["slug", "known_id"], "left_anti").withColumnRenamed("known_id", "parent_clause_id")
    links = below.select("slug", "clause_id", F.explode("parent_chain").alias("known_id"))
    lost_links = links.select("slug", "known_id").distinct().join(ids, ["slug", "known_id"], "left_anti")
    # Only identifiers that are really missing go back to the rows, so busy parents never meet in one join key.
    return (
        _issue(duplicates, "duplicate_clause_id", F.col("n"))
        .unionByName(
            _issue(below.where(F.coalesce("parent_clause_id", F.lit("")) == ""), "no_parent", F.lit(None))
        )
        .unionByName(
            _issue(named.join(lost, ["slug", "parent_clause_id"]), "missing_parent", F.col("parent_clause_id"))
        )
        .unionByName(_issue(below.where(F.size("parent_chain") == 0), "empty_chain", F.lit(None)))
        .unionByName(_issue(links.join(lost_links, ["slug", "known_id"]), "missing_chain_id", F.col("known_id")))
        .unionByName(
            _issue(
                named.where((F.size("parent_chain") > 0) & ~F.expr("array_contains(parent_chain, parent_clause_id)")),
                "parent_not_in_chain",
                F.col("parent_clause_id"),
            )
        )
    )


def hierarchy_counts(units: DataFrame) -> DataFrame:
    """Clause and context units per document, and whether both are there."""
    clause = F.col("unit_type") == "clause"
    context = F.col("unit_type").isin("part", "section", "policy")
    counts = units.groupBy("slug").agg(
        F.count_if(clause).alias("clause_count"), F.count_if(context).alias("context_count")
    )
    return counts.withColumn("usable", (F.col("clause_count") > 0) & (F.col("context_count") > 0))
