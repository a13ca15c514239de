"""Policy profile: Section N > roman policy > (a) provision, with adoption and amendment dates."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexweave.functions import patterns as P
from lexweave.functions import text as X
from lexweave.operators.bylaws import Parsed
from lexweave.operators.identity import (
    UNIT_COLUMNS, attach_tag, chain_of, collision_tags, first_blocks, heading_tags, instrument_rows, path_id, pos,
)
from lexweave.operators.lines import POSITION, lines_with_neighbours
from lexweave.operators.scan import ordered_scan
from lexweave.session import materialize

FRONT_PAGES = 4
ROOT = {"block_ord": -1, "offset": -1}


def classify(lines: DataFrame) -> DataFrame:
    line = F.col("line")
    kind = (
        F.when(~F.col("like"), "text")
        .when(line.rlike(P.POLICY_SECTION), "section")
        .when(line.rlike(P.POLICY_ROMAN), "policy")
        .when(line.rlike(P.PROVISION), "clause")
        .when(line.rlike(P.ADOPTED) | line.rlike(P.AMENDED), "date")
        .when(line.rlike(P.PART) | line.rlike(P.LETTER), "stop")
        .otherwise("text")
    )
    return lines.where(~F.col("front") & ~X.skip_line(line)).withColumn("kind", kind).drop("prev", "next", "item", "front")


def headings_in_force(lines: DataFrame) -> DataFrame:
    kind, line, place = F.col("kind"), F.col("line"), F.struct(*POSITION)

    def heading(name: str, pattern: str):
        fields = (
            place.alias("pos"),
            X.group(line, pattern, 1).alias("number"),
            X.strip(X.group(line, pattern, 2)).alias("title"),
        )
        return F.when(kind == name, F.struct(*fields))

    is_head = kind.isin("section", "policy", "clause")
    last = {
        "section": heading("section", P.POLICY_SECTION),
        "policy": heading("policy", P.POLICY_ROMAN),
        "head": F.when(is_head, F.struct(place.alias("pos"), kind.alias("kind"))),
        "flow": F.when(kind != "text", F.struct(place.alias("pos"), kind.alias("kind"))),
    }
    scanned = ordered_scan(
        lines, ["slug"], "chunk", POSITION, last=last, sums={"unit_ord": is_head.cast("bigint")}
    ).where(F.col("section").isNotNull())
    return scanned.withColumn("policy", F.when(F.col("policy.pos") > F.col("section.pos"), F.col("policy")))


def parse_policies(documents: DataFrame, blocks: DataFrame) -> Parsed:
    """Units of policy documents; same inputs as the bylaws profile."""
    lines = materialize(classify(lines_with_neighbours(blocks, FRONT_PAGES)), "policy-lines")
    scanned = materialize(headings_in_force(lines), "policy-scan")
    kind, line, slug = F.col("kind"), F.col("line"), F.col("slug")

    stray = scanned.where(kind.isin("clause", "date") & F.col("policy").isNull())
    errors = stray.select(
        "slug", *POSITION, "line",
        F.when(kind == "clause", "lettered provision before a roman policy heading")
        .otherwise("date line before a roman policy heading").alias("message"),
    )

    letter = F.lower(X.group(line, P.PROVISION, 1))
    number = (
        F.when(kind == "section", F.col("section.number"))
        .when(kind == "policy", F.upper("policy.number"))
        .otherwise(F.concat(F.lit("("), letter, F.lit(")")))
    )
    own = (
        F.when(kind == "section", F.concat(F.lit("section-"), F.col("section.number")))
        .when(kind == "policy", F.concat(F.lit("policy-"), F.lower("policy.number")))
        .otherwise(F.concat(F.lit("provision-"), letter))
    )
    root = F.struct(F.lit(ROOT["block_ord"]).cast("bigint").alias("block_ord"), F.lit(ROOT["offset"]).alias("offset"))
    above = F.when(kind == "section", root).when(kind == "policy", F.col("section.pos")).otherwise(F.col("policy.pos"))
    heads = scanned.where(
        kind.isin("section", "policy") | ((kind == "clause") & F.col("policy").isNotNull())
    ).withColumns({"number": number, "id_part": own, "parent_key": above})
    heads = materialize(heads, "policy-heads")

    tags = materialize(collision_tags(heads, "kind"), "policy-tags")
    above = heading_tags(tags, "policy-heading-tags")
    heads = attach_tag(heads, above, F.col("section.pos"), "section_tag")
    heads = attach_tag(heads, above, F.col("policy.pos"), "policy_tag")
    heads = attach_tag(heads, tags.where(F.col("kind") == "clause"), pos(), "own_tag")

    section_id = path_id(slug, F.concat(F.lit("section-"), F.col("section.number"), F.col("section_tag")))
    policy_id = path_id(section_id, F.concat(F.lit("policy-"), F.lower("policy.number"), F.col("policy_tag")))
    clause_title = F.concat_ws(" ", F.col("policy.title"), F.col("number"))

    # Provision text: everything up to the next structural line, then lines that do not look like headings.
    inside = (kind == "clause") | (
        (kind == "text")
        & (F.col("head.kind") == "clause")
        & ((F.col("flow.kind") == "clause") | ~F.col("like"))
    )
    body = (
        scanned.where(inside)
        .groupBy(slug.alias("_bslug"), F.col("head.pos").alias("_bpos"))
        .agg(F.sort_array(F.collect_list(F.struct(pos().alias("pos"), "line"))).alias("_l"))
        .select("_bslug", "_bpos", F.array_join(F.col("_l.line"), " ").alias("body"))
    )

    # The latest date lines of a policy hold for the policy and for every provision read before the last of them.
    value = lambda pattern: X.strip(X.group(line, pattern, 1))
    dated = scanned.where((kind == "date") & F.col("policy").isNotNull())
    latest = lambda pattern: F.max_by(value(pattern), F.when(line.rlike(pattern), pos()))
    dates = dated.groupBy(slug.alias("_dslug"), F.col("policy.pos").alias("_dpos")).agg(
        latest(P.ADOPTED).alias("adopted_date"), latest(P.AMENDED).alias("amended_dates"), F.max(pos()).alias("date_pos")
    )
    entries = F.filter(
        F.array(
            F.struct(F.lit("adopted_date").alias("k"), F.col("adopted_date").alias("v")),
            F.struct(F.lit("amended_dates").alias("k"), F.col("amended_dates").alias("v")),
        ),
        lambda e: e["v"].isNotNull(),
    )
    applies = kind.isin("policy", "clause") & (slug == F.col("_dslug")) & (F.col("policy.pos") == F.col("_dpos"))
    units = (
        heads.withColumns({"section_id": section_id, "policy_id": F.when(F.col("policy").isNotNull(), policy_id)})
        .join(body, (slug == F.col("_bslug")) & (pos() == F.col("_bpos")), "left")
        .join(dates, applies & (pos() < F.col("date_pos")), "left")
        .withColumns(
            {
                "parent_clause_id": F.when(kind == "section", slug)
                .when(kind == "policy", F.col("section_id"))
                .otherwise(F.col("policy_id")),
                "parent_chain": F.when(kind == "section", chain_of(slug))
                .when(kind == "policy", chain_of(slug, F.col("section_id")))
                .otherwise(chain_of(slug, F.col("section_id"), F.col("policy_id"))),
                "clause_id": F.when(kind == "section", F.col("section_id"))
                .when(kind == "policy", F.col("policy_id"))
                .otherwise(path_id(F.col("policy_id"), F.concat(F.col("id_part"), F.col("own_tag")))),
                "unit_type": kind,
                "title": F.when(kind == "section", F.col("section.title"))
                .when(kind == "policy", F.col("policy.title"))
                .otherwise(clause_title),
                "text": F.coalesce("body", "line"),
                "page_end": F.lit(None).cast("int"),
                "line_start": F.col("line_no"),
                "line_end": F.col("line_no"),
                "source_block_id": F.col("block_id"),
                "heading_path": F.array().cast("array<string>"),
                "is_top_level": F.lit(False),
                "metadata": F.when(F.size(entries) > 0, F.map_from_entries(entries)),
            }
        )
    )
    roots = instrument_rows(documents.select("slug", "title"), first_blocks(blocks))
    return Parsed(roots.select(*UNIT_COLUMNS).unionByName(units.select(*UNIT_COLUMNS)), errors)
