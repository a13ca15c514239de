"""Bylaws profile: Part > Section N > lettered section > numbered clause, with nested lists.

The line-by-line reading of such a document is expressed as facts about lines: what kind a line is, which headings
are in force where it stands (an ordered scan), and which flow of text it belongs to (the last structural line before
it). Units are the heading and clause lines; blocks are cut there, and a unit takes its text from its own piece and from
pieces without a head behind it.
"""

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexweave.functions import patterns as P
from lexweave.functions import text as X
from lexweave.operators.flows import flow_parts, with_flow_text
from lexweave.operators.identity import (
    UNIT_COLUMNS, attach_tag, chain_of, collision_tags, first_blocks, heading_tags, instrument_rows, path_id, pos,
)
from lexweave.operators.lines import POSITION, line_after, neighbouring_blocks
from lexweave.operators.scan import ordered_scan
from lexweave.session import materialize

FRONT_PAGES = 5
HEADS = ("part", "section", "letter", "clause")


@dataclass(frozen=True)
class Parsed:
    """Units of one profile and the lines that break its order."""

    units: DataFrame
    errors: DataFrame


def letter_heading(line: Column, following: Column) -> Column:
    """A lettered line opens a section when its title is upper case or short, or stands alone on the next line."""
    title = X.group(line, P.LETTER, 2)
    own_title = (title != "") & (X.all_upper(title) | (X.word_count(title) <= 6))
    text = following["line"]
    next_title = (
        (title == "")
        & following.isNotNull()
        & ~following["like"]
        & ~following["item"]
        & (X.word_count(text) <= 6)
        & text.rlike(r"\p{IsUppercase}")
    )
    return line.rlike(P.LETTER) & (own_title | F.coalesce(next_title, F.lit(False)))


def continues_title(following: Column) -> Column:
    """A wrapped section title goes on with a lower-case line that is neither a heading nor a list item."""
    wrapped = ~following["like"] & ~following["item"] & following["line"].rlike(r"^\p{IsLowercase}")
    return F.coalesce(wrapped, F.lit(False))


def takes_next(line: Column, following: Column) -> Column:
    """The heading on this line also uses up the following line as (part of) its title."""
    bare_letter = (X.group(line, P.LETTER, 2) == "") & letter_heading(line, following)
    return (line.rlike(P.NUMBERED_SECTION) & continues_title(following)) | bare_letter


def may_take_next(line: Column) -> Column:
    """What every numbered section and lettered line has in common; one look at plain characters."""
    return line.startswith("Section") | (F.substring(line, 2, 1) == ".")


def line_kind(line: Column, like: Column, following: Column) -> Column:
    """Kind of a line: part, section, letter, clause, date, or text.

    Every structural line looks like a heading, so plain lines (nearly all) settle on one flag.
    """
    return (
        F.when(~like, "text")
        # Only clauses begin with a digit, and most of these lines are clauses.
        .when(line.rlike(P.CLAUSE), "clause")
        .when(line.rlike(P.PART), "part")
        .when(line.rlike(P.NUMBERED_SECTION), "section")
        .when(letter_heading(line, following), "letter")
        .when(line.rlike(P.ADOPTED) | line.rlike(P.AMENDED), "date")
        .otherwise("text")
    )


def pieces(blocks: DataFrame) -> DataFrame:
    """Blocks cut before each heading and clause line; front and skipped lines are dropped.

    A piece is a row: its first line, and the lines up to the next piece in one array (entries). Where a block begins
    with other lines, its first piece has no head and goes on with the unit before it. Blocks come with _lines, _next
    and _prev. All is done inside the arrays, so that no line is ever a row.
    """

    def marked(e: Column, i: Column) -> Column:
        line, following = e["line"], line_after(e, i)
        # Blocks of front pages are gone, so that a line before in the same block is on none. No skipped line looks like a heading.
        before = lambda name: F.when(i == 0, F.col("_prev")[name]).otherwise(F.get("_lines", i - 1)[name])
        on_front = F.when(i == 0, F.col("_prev")["front"]).otherwise(F.lit(False))
        used_up = F.when(
            before("like") & ~on_front & ~e["like"],
            F.when(may_take_next(before("line")), takes_next(before("line"), e)),
        )
        return F.struct(
            e["offset"].alias("offset"), line.alias("line"), e["like"].alias("like"), e["item"].alias("item"),
            line_kind(line, e["like"], following).alias("kind"), F.when(e["like"] & may_take_next(line), following).alias("next"),
            (~F.coalesce(used_up, F.lit(False)) & (e["like"] | ~X.skip_line(line))).alias("kept"),
        )

    is_head = lambda e: e["kind"].isin(*HEADS)
    own = ("slug", "chunk", "block_ord", "block_id", "page", "original_page", "line_start")
    # Each array is a column of its own that is named at least twice, so that it is worked out once per block.
    rows = blocks.where(~F.col("front")).select(*own, F.transform("_lines", marked).alias("_marked"))
    # No filter on the arrays: it would move below them and work them out a second time. Empty ones have no starts.
    rows = rows.select(*own, F.filter("_marked", lambda e: e["kept"]).alias("_kept"))
    starts = F.array_compact(F.transform("_kept", lambda e, i: F.when((i == 0) | is_head(e), i)))
    rows = rows.select(*own, "_kept", starts.alias("_starts"))

    def entry(e: Column) -> Column:
        # The first line of a flow must not look like a heading; anything may follow it.
        opens = F.when(~e["like"], F.lit(True)).otherwise(e["item"] & (e["kind"] == "text"))
        return F.struct(F.col("page"), e["kind"].alias("kind"), e["line"].alias("line"), opens.alias("opens"))

    def piece(start: Column, j: Column) -> Column:
        length = F.coalesce(F.get("_starts", j + 1), F.size("_kept")) - start
        return F.struct(F.get("_kept", start).alias("first"), F.transform(F.slice("_kept", start + 1, length), entry).alias("entries"))

    rows = rows.select(*own, F.explode(F.transform("_starts", piece)).alias("_p"))
    first, kind, line = F.col("_p.first"), F.col("_p.first.kind"), F.col("_p.first.line")
    # Act titles stand below a Part or numbered section, maybe in another block.
    act = F.when(
        ~kind.isin("clause", "letter"),
        F.get(F.filter("_p.entries", lambda e: (e["kind"] == "text") & is_act_line(e["line"])), F.lit(0))["line"],
    )
    return rows.select(
        "slug", "chunk", "block_ord", first["offset"].alias("offset"), kind.alias("kind"), F.when(kind != "clause", line).alias("line"),
        F.when(kind == "clause", F.substring_index(line, ".", 1)).alias("clause_number"),
        F.when(kind.isin("section", "letter"), first["next"]).alias("next"), act.alias("act"), "_p.entries",
        "block_id", "page", "original_page", (F.col("line_start") + first["offset"]).alias("line_no"),
    )


def headings_in_force(rows: DataFrame) -> DataFrame:
    """Add the part, section and letter each piece stands under, the unit it belongs to (head) and whether a piece
    without a head follows; pieces before the first Part are dropped."""
    line, following, kind = F.col("line"), F.col("next"), F.col("kind")
    place = F.struct(*POSITION)
    title = F.when(kind == "part", X.group(line, P.PART, 2)).when(kind == "section", X.group(line, P.NUMBERED_SECTION, 2))
    title = title.when(kind == "letter", F.coalesce(X.present(X.group(line, P.LETTER, 2)), following["line"]))
    wrapped = F.when((kind == "section") & continues_title(following), F.concat_ws(" ", F.col("_title"), following["line"]))
    number = F.when(kind == "part", X.group(line, P.PART, 1)).when(kind == "section", X.group(line, P.NUMBERED_SECTION, 1))
    number = number.when(kind == "letter", X.group(line, P.LETTER, 1))
    # Each step is named more than once, so that it is worked out once and its code stays small enough to be compiled.
    rows = rows.withColumns({"_number": number, "_title": title})
    heading = F.struct(
        place.alias("pos"), F.col("_number").alias("number"), number_id(F.col("_number")).alias("key"),
        X.strip(F.coalesce(wrapped, F.col("_title"))).alias("title"),
    )
    rows = rows.withColumn("own", F.when(F.col("_number").isNotNull(), heading)).drop("_number", "_title")
    last = {name: F.when(kind == name, F.col("own")) for name in ("part", "section", "letter")}
    is_head = kind.isin(*HEADS)
    last["head"] = F.when(is_head, F.struct(place.alias("pos"), kind.alias("kind")))
    scanned = ordered_scan(
        rows, ["slug"], "chunk", POSITION, last=last, sums={"unit_ord": is_head.cast("bigint")},
        lead={"goes_on": ~is_head}, label="bylaw-scan", placed=True,
    ).where(F.col("part").isNotNull())
    # A higher heading closes the lower ones.
    section = F.when(F.col("section.pos") > F.col("part.pos"), F.col("section"))
    scanned = scanned.withColumn("section", section)
    ceiling = F.coalesce("section.pos", "part.pos")
    return scanned.withColumn("letter", F.when(F.col("letter.pos") > ceiling, F.col("letter")))


def is_act_line(line: Column) -> Column:
    return F.lower(line).startswith("an act")


def number_id(number: Column) -> Column:
    """Identifier of a heading number; plain letters and digits need no rewriting."""
    return F.when(number.rlike("^[A-Za-z0-9]+$"), F.lower(number)).otherwise(X.identifier(number))


def unit_heads(scanned: DataFrame) -> DataFrame:
    """Heading and clause lines with their number, own part of the identifier and parent."""
    kind = F.col("kind")
    own = F.col("section").isNotNull() & F.col("letter").isNull()
    number = (
        F.when(kind == "part", F.upper(F.col("part.number")))
        .when(kind == "section", F.col("section.number"))
        .when(kind == "letter", F.col("letter.number"))
        .otherwise(F.col("clause_number"))
    )
    # Keys of sections and letters are in their headings.
    key = (
        F.when(kind == "section", F.col("section.key")).when(kind == "letter", F.col("letter.key"))
        .otherwise(number_id(F.when(kind == "part", F.upper(F.col("part.number"))).otherwise(F.col("clause_number"))))
    )
    prefix = (
        F.when(kind == "part", "part-")
        .when(kind == "section", "section-")
        .when((kind == "letter") & F.col("section").isNull(), "section-")
        .when(kind == "letter", "")
        .otherwise("clause-")
    )
    above = (
        F.when(kind == "part", F.lit(None))
        .when(kind == "section", F.col("part.pos"))
        .when(kind == "letter", F.coalesce("section.pos", "part.pos"))
        .otherwise(F.coalesce("letter.pos", "section.pos"))
    )
    clause_title = F.concat_ws(" ", F.when(own, F.col("section.title")).otherwise(F.col("letter.title")), F.col("number"))
    return (
        scanned.where(kind.isin(*HEADS))
        .withColumn("number", number)
        .withColumns(
            {
                "id_part": F.concat(prefix, key),
                "parent_pos": above,
                # Heads without a parent share one key instead of a null one, so that joins keep them.
                "parent_key": F.coalesce(above, F.struct(F.lit(-1).cast("bigint").alias("block_ord"), F.lit(-1).alias("offset"))),
                "title": F.when(kind == "part", F.col("part.title"))
                .when(kind == "section", F.col("section.title"))
                .when(kind == "letter", F.col("letter.title"))
                .otherwise(clause_title),
                "heading": F.when(kind == "part", F.col("line"))
                .when(
                    kind == "section",
                    F.concat_ws(" ", F.col("line"), F.when(continues_title(F.col("next")), F.col("next.line"))),
                )
                .when(kind == "letter", F.concat(F.col("number"), F.lit(". "), F.col("letter.title"))),
            }
        )
        .drop("head", "next", "act", "clause_number", "own")
    )


def flows_inside(entries: str) -> Column:
    """Lines of the text of a letter or clause, by flow: each structural line opens a flow.

    All lines of the flow of the clause itself count; of others those from the first on that may open a flow.
    """
    starts = F.filter(F.sequence(F.lit(0), F.size(entries) - 1), lambda i: (i == 0) | (F.get(entries, i)["kind"] != "text"))

    def flow(start: Column, j: Column) -> Column:
        return F.slice(entries, start + 1, F.coalesce(F.get(starts, j + 1), F.size(entries)) - start)

    def kept(lines: Column) -> Column:
        opener = F.array_position(F.transform(lines, lambda e: e["opens"]), True)
        rest = F.when(opener > 0, F.slice(lines, opener.cast("int"), F.size(lines))).otherwise(F.slice(lines, 1, 0))
        return F.when(F.get(lines, F.lit(0))["kind"] == "clause", lines).otherwise(rest)

    # Nearly all units are one flow.
    single = F.forall(F.slice(entries, 2, F.size(entries)), lambda e: e["kind"] == "text")
    return F.when(single, F.array(kept(F.col(entries)))).otherwise(F.transform(F.transform(starts, flow), kept))


def with_body(heads: DataFrame, may: Callable[[Column], Column] | None = None) -> DataFrame:
    """Add the text (body) of letters and clauses; see unit_rows for may.

    Most clauses are one line without a run-in item, which is their text. It begins with a digit, so that it is no item.
    """
    owner, line = F.col("kind").isin("letter", "clause"), F.get("entries", F.lit(0))["line"]
    asked = F.lit(True) if may is None else may(F.array_join(F.transform("entries", lambda e: e["line"]), " "))
    plain = (F.col("kind") == "clause") & (F.size("entries") == 1) & (F.get("entries", F.lit(0))["kind"] == "clause") & ~line.rlike(P.MAYBE_RUN_IN)
    heads = heads.withColumn("_asked", F.coalesce(owner & asked, F.lit(False))).withColumn("_line", F.when(F.col("_asked") & plain, line))
    found = heads.withColumn("_flows", F.when(F.col("_asked") & F.col("_line").isNull(), flows_inside("entries")))
    line_parts = lambda e, k: F.transform(
        flow_parts(e["line"]), lambda p: F.struct(k.alias("flow"), p["part"].alias("part"), p["code"].alias("code"))
    )
    parts = F.flatten(F.transform("_flows", lambda f, k: F.flatten(F.transform(f, lambda e: line_parts(e, k)))))
    found = found.withColumn("_parts", F.when(F.size(F.flatten("_flows")) > 0, parts))
    found = with_flow_text(found, "_parts", "_body").withColumn("body", F.coalesce("_line", "_body"))
    return found.drop("_flows", "_parts", "_line", "_body", "_asked")


def act_titles(scanned: DataFrame) -> DataFrame:
    """First 'An Act ...' line of each Part that stands before any lettered section or clause flow."""
    return (
        scanned.where(F.col("head.kind").isin("part", "section") & F.col("act").isNotNull())
        .groupBy("slug", F.col("part.pos").alias("part_pos"))
        .agg(F.min(pos()).alias("act_pos"), F.min_by("act", pos()).alias("act_title"))
    )


@dataclass(frozen=True)
class Outline:
    """Heads of units with identifier, parent and chain; pieces with the lines between them; and stray clauses."""

    heads: DataFrame
    scanned: DataFrame
    errors: DataFrame


def outline(blocks: DataFrame) -> Outline:
    """Structure of bylaws documents, without the texts of their units."""
    scanned = headings_in_force(pieces(neighbouring_blocks(blocks, FRONT_PAGES)))
    heads = unit_heads(scanned)
    errors = heads.where((F.col("kind") == "clause") & F.col("parent_pos").isNull()).select(
        "slug", *POSITION, F.get("entries", F.lit(0))["line"].alias("line"), F.lit("numbered clause before a section heading").alias("message")
    )
    # Only clauses can be without a parent, behind the first Part.
    heads = heads.where((F.col("kind") != "clause") | F.col("section").isNotNull() | F.col("letter").isNotNull())

    tags = materialize(collision_tags(heads, "kind"), "bylaw-tags")
    above = heading_tags(tags, "bylaw-heading-tags")
    for place, name in (("part", "part_tag"), ("section", "section_tag"), ("letter", "letter_tag")):
        heads = attach_tag(heads, above, F.col(f"{place}.pos"), name)
    heads = attach_tag(heads, tags.where(F.col("kind") == "clause"), pos(), "own_tag")

    slug = F.col("slug")
    part_id = path_id(slug, F.concat(F.lit("part-"), F.col("part.key"), F.col("part_tag")))
    section_id = path_id(part_id, F.concat(F.lit("section-"), F.col("section.number"), F.col("section_tag")))
    low = F.lower("letter.number")
    letter_id = F.when(
        F.col("section").isNotNull(), path_id(section_id, F.concat(low, F.col("letter_tag")))
    ).otherwise(path_id(part_id, F.concat(F.lit("section-"), low, F.col("letter_tag"))))
    heads = heads.withColumns(
        {
            "part_id": part_id,
            "section_id": F.when(F.col("section").isNotNull(), section_id),
            "letter_id": F.when(F.col("letter").isNotNull(), letter_id),
        }
    )
    kind = F.col("kind")
    parent = (
        F.when(kind == "part", slug)
        .when(kind == "section", F.col("part_id"))
        .when(kind == "letter", F.coalesce("section_id", "part_id"))
        .otherwise(F.coalesce("letter_id", "section_id"))
    )
    clause_id = (
        F.when(kind == "part", F.col("part_id"))
        .when(kind == "section", F.col("section_id"))
        .when(kind == "letter", F.col("letter_id"))
        .otherwise(path_id(F.col("parent_clause_id"), F.concat(F.col("id_part"), F.col("own_tag"))))
    )
    chain = (
        F.when(kind == "part", chain_of(slug))
        .when(kind == "section", chain_of(slug, F.col("part_id")))
        .when(kind == "letter", chain_of(slug, F.col("part_id"), F.col("section_id")))
        .otherwise(chain_of(slug, F.col("part_id"), F.col("section_id"), F.col("letter_id")))
    )
    heads = heads.withColumn("parent_clause_id", parent).withColumn("clause_id", clause_id).withColumn("parent_chain", chain)
    return Outline(heads, scanned, errors)


def unit_rows(found: Outline, kinds: Sequence[str] = HEADS, texts: bool = True, may: Callable[[Column], Column] | None = None) -> DataFrame:
    """Units of some kinds in the common layout. Without texts they have their headings only and no last page, and the lines between
    the heads are not read. Where may is false of the lines of a unit, put together with blanks, its text is left out: a text holds
    nothing but these lines, with a blank or a line feed between them."""
    kind, slug = F.col("kind"), F.col("slug")
    heads = found.heads.where(kind.isin(*kinds))
    if texts:
        # Few units go on in another piece; only these are shuffled.
        loose = found.scanned.where(~kind.isin(*HEADS) & F.col("head.kind").isin("letter", "clause"))
        more = loose.groupBy(slug.alias("_bslug"), F.col("head.pos").alias("_bpos")).agg(
            F.sort_array(F.collect_list(F.struct(pos().alias("pos"), "entries"))).getField("entries").alias("_more")
        )
        longer = heads.where(F.col("goes_on")).join(more, (slug == F.col("_bslug")) & (pos() == F.col("_bpos")), "left")
        longer = longer.withColumn("entries", F.concat("entries", F.coalesce(F.flatten("_more"), F.slice("entries", 1, 0)))).drop("_bslug", "_bpos", "_more")
        last_page = F.array_max(F.transform(F.flatten(flows_inside("entries")), lambda e: e["page"]))
        longer = longer.withColumn("last_page", F.when(kind.isin("letter", "clause"), last_page))
        # A piece lies on one page.
        heads = heads.where(~F.coalesce("goes_on", F.lit(False))).withColumn("last_page", F.col("page"))
        heads = with_body(heads.unionByName(longer), may)
    else:
        heads = heads.withColumns({"body": F.lit(None).cast("string"), "last_page": F.lit(None).cast("int")})
    acts = act_titles(found.scanned).withColumnRenamed("slug", "_slug")
    return (
        heads.join(
            acts,
            (slug == F.col("_slug"))
            & (F.col("part.pos") == F.col("part_pos"))
            & (kind == "letter")
            & (pos() > F.col("act_pos")),
            "left",
        )
        .withColumns(
            {
                "unit_type": F.when(kind.isin("part", "clause"), kind).otherwise("section"),
                "text": F.concat_ws("\n", "heading", "body"),
                "page_end": F.when(F.col("last_page") > F.col("page"), F.col("last_page")),
                "line_start": F.col("line_no"),
                "line_end": F.col("line_no"),
                "source_block_id": F.col("block_id"),
                "heading_path": F.array().cast("array<string>"),
                "is_top_level": F.lit(False),
                "metadata": F.when(F.col("act_title").isNotNull(), F.create_map(F.lit("act_title"), F.col("act_title"))),
            }
        )
        .select(*UNIT_COLUMNS)
    )


def parse_bylaws(documents: DataFrame, blocks: DataFrame) -> Parsed:
    """Units of bylaws documents.

    documents: slug, title. blocks: slug, block_ord, block_id, text, page, original_page, line_start, line_end,
    provider, page_count and optionally chunk.
    """
    found = outline(blocks)
    roots = instrument_rows(documents.select("slug", "title"), first_blocks(blocks))
    # Filters on a text would work it out anew, so that it is written.
    return Parsed(roots.select(*UNIT_COLUMNS).unionByName(materialize(unit_rows(found), "bylaw-units")), found.errors)
