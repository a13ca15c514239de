"""Definitions and cross-references of clauses, and their resolution."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexweave.functions import patterns as P
from lexweave.functions import text as X
from lexweave.operators.scan import ordered_scan
from lexweave.session import materialize


def clauses_of(units: DataFrame) -> DataFrame:
    return units.where(F.col("unit_type") == "clause")


def definitions(units: DataFrame) -> DataFrame:
    """First definition of each term of a document; only clauses are read."""
    text = F.col("text")
    quoted = text.rlike(P.QUOTED_DEFINITION)
    pick = lambda i: F.when(quoted, X.group(text, P.QUOTED_DEFINITION, i)).otherwise(
        X.group(text, P.PLAIN_DEFINITION, i)
    )
    found = clauses_of(units).where(quoted | text.rlike(P.PLAIN_DEFINITION)).select(
        F.col("slug").alias("instrument_slug"),
        "chunk", "block_ord", "offset",
        X.strip(pick(2)).alias("term"),
        X.strip(pick(1)).alias("definition_text"),
        F.col("clause_id").alias("source_unit_id"),
        "page", "page_end", "line_start", "line_end",
    ).withColumn("slug", X.slugify(F.col("term")))
    payload = [c for c in found.columns if c not in ("instrument_slug", "slug")]
    place = F.struct("block_ord", "offset")
    return found.groupBy("instrument_slug", "slug").agg(F.min_by(F.struct(*payload), place).alias("d")).select(
        "instrument_slug", "slug", "d.*", F.lit("instrument").alias("scope")
    )


def reference_matches(text: Column) -> Column:
    """First match of each reference type in a clause: array<struct<ord, reference_type, reference_text>>.

    Each pattern runs once, where its word can occur at all: a match never has an empty target. Beyond ASCII other
    letters may stand for those of the word, so that such texts are always read.
    """
    low, wide = F.lower(text), F.octet_length(text) > F.length(text)
    found = [
        F.struct(
            F.lit(i).alias("ord"), F.lit(name).alias("reference_type"),
            F.when(wide | F.contains(low, F.lit(P.REFERENCE_WORDS[name])), X.group(text, pattern, 1)).alias("target"),
        )
        for i, (name, pattern) in enumerate(P.REFERENCES)
    ]
    hits = F.filter(F.array(*found), lambda x: x["target"] != "")
    return F.transform(hits, lambda x: F.struct(x["ord"].alias("ord"), x["reference_type"].alias("reference_type"), X.strip(x["target"]).alias("reference_text")))


def may_refer(text: Column) -> Column:
    """What every text with a reference passes, and every text that holds such a text; see reference_matches."""
    low, found = F.lower(text), F.octet_length(text) > F.length(text)
    for word in P.REFERENCE_WORDS.values():
        found = found | F.contains(low, F.lit(word))
    return found


def references(units: DataFrame) -> DataFrame:
    """Unresolved references with their document-wide ordinal, in unit order and type order."""
    matched = clauses_of(units).select(
        "slug", "chunk", "block_ord", "offset", F.col("clause_id").alias("source_unit_id"),
        "page", "page_end", "line_start", "line_end",
        F.explode(reference_matches(F.col("text"))).alias("m"),
    ).select("*", F.col("m.ord").alias("pattern_ord"), "m.reference_type", "m.reference_text").drop("m")
    numbered = ordered_scan(
        matched, ["slug"], "chunk", ["block_ord", "offset", "pattern_ord"], sums={"ref_ord": F.lit(1).cast("bigint")}, label="references"
    )
    label = F.concat_ws("-", "source_unit_id", "reference_type", F.col("ref_ord").cast("string"))
    return numbered.withColumn("reference_id", label)


def document_targets(documents: DataFrame) -> DataFrame:
    """Key and slug of every known document, by title and by slug; the latest entry of a key wins.

    documents: slug, title and doc_ord, the place in the manifest.
    """
    keys = documents.select(
        F.col("slug").alias("target_slug"), "doc_ord",
        F.posexplode(F.array(X.reference_key(F.col("title")), X.reference_key(F.col("slug")))).alias("k", "doc_key"),
    )
    return keys.groupBy("doc_key").agg(F.max_by("target_slug", F.struct("doc_ord", "k")).alias("resolved_target_slug"))


def unit_targets(units: DataFrame) -> DataFrame:
    """Key and identifier of every unit of a document, by identifier, number and 'section number'; the latest wins."""
    number = X.present(F.col("number"))
    # "section 7" has the key of "7", so that it is no key of its own beside a plain number.
    label = F.when(~number.rlike(P.PLAIN_KEY), F.concat(F.lit("section "), number))
    labels = F.array_compact(F.array(F.col("clause_id"), number, label))
    keys = units.select(
        "slug", "clause_id", "block_ord", "offset", F.posexplode(labels).alias("k", "label")
    ).withColumn("target_key", X.unit_key(F.col("label")))
    return keys.groupBy("slug", "target_key").agg(
        F.max_by("clause_id", F.struct("block_ord", "offset", "k")).alias("resolved_target_id")
    )


def resolve(refs: DataFrame, units: DataFrame, documents: DataFrame) -> DataFrame:
    """Resolve references against all known documents and the units of their own document."""
    keyed = refs.withColumns(
        {"doc_key": X.reference_key(F.col("reference_text")), "target_key": X.unit_key(F.col("reference_text"))}
    )
    keyed = materialize(keyed, "keyed-references")
    # Only keys that are asked for take part: the target side shrinks before it is shuffled for the outer join.
    asked = keyed.select("slug", "target_key").distinct()
    targets = unit_targets(units).join(asked, ["slug", "target_key"], "left_semi")
    hit = F.col("resolved_target_slug").isNotNull() | F.col("resolved_target_id").isNotNull()
    return (
        keyed.join(document_targets(documents), "doc_key", "left")
        .join(targets, ["slug", "target_key"], "left")
        .withColumn("resolution_status", F.when(hit, "resolved").otherwise("unresolved"))
        .drop("doc_key", "target_key")
    )


def page_slug(refs: DataFrame) -> Column:
    """Page of a reference: unit, type and the trailing number of the reference identifier."""
    tail = F.coalesce(X.present(F.regexp_extract(refs["reference_id"], r"-(\d+)$", 1)), F.lit("1"))
    return F.concat_ws("-", refs["source_unit_id"], F.translate(refs["reference_type"], "_", "-"), tail)


def reference_lists(refs: DataFrame) -> DataFrame:
    """Per clause: resolved targets by type, and the pages of its unresolved references, in reference order."""
    target = F.coalesce("resolved_target_slug", "resolved_target_id", "reference_text")
    entry = F.struct("ref_ord", "reference_type", "resolution_status", target.alias("target"), page_slug(refs).alias("page_slug"))
    grouped = refs.groupBy("source_unit_id").agg(F.sort_array(F.collect_list(entry)).alias("_r"))

    def targets(name: str) -> Column:
        mine = F.filter("_r", lambda r: (r["reference_type"] == name) & (r["resolution_status"] == "resolved"))
        return F.transform(mine, lambda r: r["target"])

    lists = {name: targets(name) for name, _ in P.REFERENCES[:-1]}
    lists["exceptions"] = lists.pop("exception_to")
    unresolved = F.filter("_r", lambda r: r["resolution_status"] == "unresolved")
    lists["unresolved_references"] = F.transform(unresolved, lambda r: r["page_slug"])
    return grouped.select(F.col("source_unit_id").alias("clause_id"), *[v.alias(k) for k, v in lists.items()])
