"""Legal documents rendered from the star schema, so that structure can be parsed back and checked at any size.

Bylaws: one document per nation, Parts by supplier key modulo five, a numbered section per supplier, a lettered
section per return flag and a clause per line item. Policies: a document per 1/25 of the customers, sections of fifty
customers, a policy per customer and a provision per order. The rendered order is arbitrary but fixed; busy sections
are cut into pages of about PAGE_ROWS rows by order key, so no page depends on how skewed the suppliers are.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexweave.functions import text as X
from lexweave.session import materialize
from lexweave.sources.tables import table

PAGE_ROWS = 4096
# Positions are packed into one number: part, section, lettered section, page.
PART, SECTION, LETTER = 1 << 59, 1 << 29, 1 << 27
SECTIONS_PER_CHUNK, PAGES_PER_CHUNK, USUAL_PAGES = 64, 16, 256
LETTER_TITLES = {"A": "ACCEPTED GOODS", "N": "Open Orders", "R": "RETURNS"}


def bylaw_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Manifest rows of the rendered bylaws, one per nation that has sections."""
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    used = table(spark, folder, "supplier").select(F.col("s_nationkey").alias("n_nationkey")).distinct()
    named = nation.join(used, "n_nationkey", "left_semi").join(
        region, nation["n_regionkey"] == region["r_regionkey"]
    )
    number = F.col("n_nationkey").cast("string")
    return named.select(
        F.concat(F.lit("acts-"), number).alias("slug"),
        F.concat(F.lit("Acts of "), F.col("n_name")).alias("title"),
        F.col("n_nationkey").cast("bigint").alias("doc_ord"),
        F.lit("bylaw").alias("document_type"),
        F.lit("bylaws").alias("profile"),
        F.col("r_name").alias("jurisdiction"),
        (F.lit(10) + F.col("n_regionkey")).alias("authority_rank"),
        F.lit("active").alias("status"),
        F.when(F.col("n_nationkey") % 2 == 0, "public").otherwise("internal").alias("confidentiality"),
        F.concat(F.lit("sources/acts-"), number, F.lit(".pdf")).alias("source_path"),
        F.lit("local_pdf").alias("provider"),
        F.lit(100).alias("page_count"),
    )


def item_lines() -> Column:
    """Clause line of a line item, followed by list lines on every third line number."""
    key = F.col("l_orderkey").cast("string")
    cents = F.round(F.col("l_discount") * 100).cast("bigint").cast("string")
    tax = F.round(F.col("l_tax") * 100).cast("bigint").cast("string")
    amount = F.col("l_quantity").cast("bigint").cast("string")
    kind = F.col("l_linenumber")
    brand = F.concat(F.lit("\"Lot "), (F.col("l_partkey") % 50).cast("string"), F.lit("\" means the goods of order "), key, F.lit("."))
    said = (
        F.when(kind == 1, brand)
        .when(kind == 2, F.concat(F.lit("Delivery is subject to section "), (F.col("l_partkey") % 40).cast("string"), F.lit(".")))
        .when(kind == 4, F.concat(F.lit("This is read with the Acts of NATION_"), (F.col("l_partkey") % 30).cast("string"), F.lit(".")))
        .when(kind == 5, F.concat(F.lit("Returns prevail despite section "), key, F.lit(" and it prevails over the Trade Code.")))
        .otherwise(F.concat(F.lit("The buyer takes "), amount, F.lit(" units:")))
    )
    clause = F.concat(key, F.lit(".\u200b "), said)
    listed = F.concat(
        F.lit("\na.\u200b quantity "), amount, F.lit(";\nb. charges: i. discount "), cents, F.lit(";\nii. tax "), tax,
        F.lit(";\nc. carriage\npaid on arrival."),
    )
    return F.when(kind.isin(3, 6), F.concat(clause, listed)).otherwise(clause)


def bylaw_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """Text blocks of the rendered bylaws: headings, pages of clauses, and a last line on the page after."""
    home = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name", "s_nationkey")
    items = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_returnflag"
    )
    size = items.groupBy("l_suppkey", "l_returnflag").agg(F.count("*").alias("_n"))
    groups = size.join(home, "l_suppkey").select(
        "l_suppkey",
        "l_returnflag",
        "s_name",
        "s_nationkey",
        F.ceil(F.col("_n") / PAGE_ROWS).alias("pages"),
        (F.col("l_suppkey") % 5).alias("part_no"),
        F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 2).otherwise(3).alias("letter_no"),
    )
    slug = F.concat(F.lit("acts-"), F.col("s_nationkey").cast("string"))
    part_at = F.col("part_no") * PART
    section_at = part_at + (F.col("l_suppkey") + 1) * SECTION
    letter_at = section_at + F.col("letter_no") * LETTER
    groups = materialize(with_busy_groups(groups, ["s_nationkey", "part_no"], F.col("l_suppkey") + 1), "lettered-sections")

    entry = F.struct(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount", "l_tax", item_lines().alias("text")
    )
    pages = (
        items.join(groups, ["l_suppkey", "l_returnflag"])
        .withColumn("page_no", F.col("l_orderkey") % F.col("pages"))
        .groupBy("s_nationkey", "part_no", "l_suppkey", "letter_no", "pages", "busy", "page_no")
        .agg(F.array_join(F.sort_array(F.collect_list(entry)).getField("text"), "\n").alias("text"))
        .select(
            slug.alias("slug"),
            (letter_at + F.col("page_no") + 1).alias("block_ord"),
            (F.col("l_suppkey") * 2 + 10).cast("int").alias("page"),
            "text",
            "busy",
        )
    )
    sections = groups.select("s_nationkey", "part_no", "l_suppkey", "s_name", "busy").distinct()
    parts = sections.select("s_nationkey", "part_no").distinct()
    documents = parts.select("s_nationkey").distinct()
    title = F.concat(F.lit("Section "), F.col("l_suppkey").cast("string"), F.lit(": "), F.col("s_name"))
    letter_title = F.when(F.col("letter_no") == 1, f"A.\u200b{LETTER_TITLES['A']}").when(
        F.col("letter_no") == 2, f"N.\u200b\n{LETTER_TITLES['N']}"
    ).otherwise(f"R. {LETTER_TITLES['R']}\nReturned goods are listed here.")
    roman = X.roman(F.col("part_no") + 1)
    blocks = [
        documents.select(
            slug.alias("slug"), F.lit(-1).cast("bigint").alias("block_ord"), F.lit(2).alias("page"),
            F.lit("Table of Contents\nPart I: Old Terms\nSection 1: Old Section\n2\nLast amended: May 1999").alias("text"),
            F.lit(False).alias("busy"),
        ),
        parts.select(
            slug.alias("slug"), part_at.alias("block_ord"), F.lit(5).alias("page"),
            F.concat(F.lit("Part "), roman, F.lit(": TRADE TERMS "), roman, F.lit("\nAn Act about trade group "),
                     F.col("part_no").cast("string")).alias("text"),
            F.lit(False).alias("busy"),
        ),
        sections.select(
            slug.alias("slug"), section_at.alias("block_ord"), (F.col("l_suppkey") * 2 + 10).cast("int").alias("page"),
            F.when(F.col("l_suppkey") % 4 == 0, F.concat(title, F.lit("\nand affiliates"))).otherwise(title).alias("text"), "busy",
        ),
        groups.select(
            slug.alias("slug"), letter_at.alias("block_ord"), (F.col("l_suppkey") * 2 + 10).cast("int").alias("page"),
            letter_title.alias("text"), "busy",
        ),
        groups.select(
            slug.alias("slug"), (letter_at + F.col("pages") + 1).alias("block_ord"),
            (F.col("l_suppkey") * 2 + 11).cast("int").alias("page"), F.lit("12\nThe list ends here.").alias("text"), "busy",
        ),
        pages,
    ]
    return as_blocks(blocks, SECTIONS_PER_CHUNK * SECTION)


def with_busy_groups(groups: DataFrame, keys: list[str], number: Column) -> DataFrame:
    """Mark sections whose neighbourhood (64 consecutive numbers) has far more pages than usual."""
    numbered = groups.withColumn("_group", F.floor(number / SECTIONS_PER_CHUNK))
    total = numbered.groupBy(*keys, "_group").agg((F.sum("pages") > USUAL_PAGES).alias("busy"))
    return numbered.join(total, [*keys, "_group"]).drop("_group")


def as_blocks(parts: list[DataFrame], wide: int) -> DataFrame:
    """Union of block rows with the chunk each belongs to.

    A chunk is a stretch of positions: usually a whole neighbourhood of sections, in busy neighbourhoods sixteen
    pages. Both clear the low digits of the position, so chunks never decrease along the document.
    """
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    width = F.when(F.col("busy"), F.lit(PAGES_PER_CHUNK)).otherwise(F.lit(wide)).cast("bigint")
    return out.select(
        "slug",
        "block_ord",
        F.concat(F.col("slug"), F.lit("-b"), F.col("block_ord")).alias("block_id"),
        "text",
        "page",
        F.col("page").alias("original_page"),
        F.lit(None).cast("int").alias("line_start"),
        F.lit(None).cast("int").alias("line_end"),
        F.lit("local_pdf").alias("provider"),
        F.lit(100).alias("page_count"),
        (F.col("block_ord") - F.pmod(F.col("block_ord"), width)).alias("chunk"),
    )


def policy_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Manifest rows of the rendered policies."""
    used = table(spark, folder, "orders").select((F.col("o_custkey") % 25).alias("n")).distinct()
    number = F.col("n").cast("string")
    return used.select(
        F.concat(F.lit("policy-"), number).alias("slug"),
        F.concat(F.lit("Account Policy "), number).alias("title"),
        F.col("n").alias("doc_ord"),
    )


CUSTOMER = 1 << 28
CUSTOMERS_PER_SECTION = 50


def policy_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """Text blocks of the rendered policies: provisions per order, then dates, then some late provisions."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    month = lambda col: F.date_format(col, "MMMM yyyy")
    customers = orders.groupBy("o_custkey").agg(
        F.ceil(F.count("*") / PAGE_ROWS).alias("pages"),
        month(F.min("o_orderdate")).alias("adopted"),
        month(F.max("o_orderdate")).alias("amended"),
    ).withColumns({"doc": F.col("o_custkey") % 25, "k": F.floor(F.col("o_custkey") / 25)})
    customers = materialize(with_busy_groups(customers, ["doc"], F.col("k")), "policy-customers")
    slug = F.concat(F.lit("policy-"), F.col("doc").cast("string")).alias("slug")
    at = F.col("k") * CUSTOMER
    page = (F.col("k") + 10).cast("int").alias("page")

    letter = F.chr(F.col("o_orderkey") % 26 + 97)
    said = F.concat(F.lit("("), letter, F.lit(") Order "), F.col("o_orderkey").cast("string"), F.lit(" is kept as "),
                    F.col("o_orderstatus"), F.lit("."))
    said = F.when(F.col("o_orderstatus") == "F", F.concat(said, F.lit("\nIt is closed."))).otherwise(said)
    pages = (
        orders.select("o_orderkey", "o_custkey", said.alias("said"))
        .join(customers, "o_custkey")
        .withColumn("page_no", F.col("o_orderkey") % F.col("pages"))
        .groupBy("doc", "k", "busy", "page_no")
        .agg(F.array_join(F.sort_array(F.collect_list(F.struct("o_orderkey", "said"))).getField("said"), "\n").alias("text"))
        .select(slug, (at + F.col("page_no") + 2).alias("block_ord"), page, "text", "busy")
    )
    number = F.floor(F.col("k") / CUSTOMERS_PER_SECTION)
    sections = customers.select("doc", number.alias("section")).distinct()
    section_no = (F.col("section") + 1).cast("string")
    dates = F.concat(F.lit("Adopted: "), F.col("adopted"))
    dates = F.when(F.col("k") % 2 == 0, F.concat(dates, F.lit("\nAmended: "), F.col("amended"))).otherwise(dates)
    blocks = [
        sections.select(
            slug, (F.col("section") * CUSTOMERS_PER_SECTION * CUSTOMER).alias("block_ord"),
            (F.col("section") * CUSTOMERS_PER_SECTION + 10).cast("int").alias("page"),
            F.concat(F.lit("Section "), section_no, F.lit(": Accounts "), section_no).alias("text"),
            F.lit(False).alias("busy"),
        ),
        customers.select(
            slug, (at + 1).alias("block_ord"), page,
            F.concat(X.roman(F.col("k") % CUSTOMERS_PER_SECTION + 1), F.lit(". TERMS OF CUSTOMER "),
                     F.col("o_custkey").cast("string")).alias("text"),
            "busy",
        ),
        pages,
        customers.select(slug, (at + CUSTOMER // 2).cast("bigint").alias("block_ord"), page, dates.alias("text"), "busy"),
        customers.where(F.col("k") % 3 == 0).select(
            slug, (at + CUSTOMER // 2 + 1).cast("bigint").alias("block_ord"), page,
            F.lit("(z) Late additions follow.").alias("text"), "busy",
        ),
    ]
    return as_blocks(blocks, SECTIONS_PER_CHUNK * CUSTOMER)


REGISTER_SIZE = 1000


def register_files(spark: SparkSession, folder: str) -> DataFrame:
    """Markdown registers of customers: one text per nation and thousand customer keys."""
    customers = table(spark, folder, "customer")
    key = F.col("c_custkey").cast("string")
    balance = F.floor("c_acctbal").cast("bigint").cast("string")
    entry = F.concat(
        F.lit("## Section "), key, F.lit(" - "), F.col("c_name"), F.lit("\n\n"),
        key, F.lit(".1 The account holds "), balance, F.lit(" units, read with register-"), F.col("c_nationkey").cast("string"), F.lit("-0.\n"),
        key, F.lit(".2 \"Segment "), F.col("c_mktsegment"), F.lit("\" means the trade of customer "), key, F.lit(".\n\n"),
        F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("#### Remarks on "), key, F.lit("\n\nNo remark is made here.\nNone at all.\n\n"))).otherwise(F.lit("")),
    )
    volume = F.floor(F.col("c_custkey") / REGISTER_SIZE)
    grouped = customers.select("c_nationkey", volume.alias("volume"), "c_custkey", entry.alias("entry")).groupBy(
        "c_nationkey", "volume"
    ).agg(F.sort_array(F.collect_list(F.struct("c_custkey", "entry"))).alias("e"))
    name = F.concat(F.col("c_nationkey").cast("string"), F.lit("-"), F.col("volume").cast("string"))
    return grouped.select(
        F.concat(F.lit("register-"), name).alias("slug"),
        F.concat(F.lit("Register "), name).alias("title"),
        (F.col("c_nationkey").cast("bigint") * 1000000000 + F.col("volume")).alias("doc_ord"),
        F.concat(F.lit("# Register "), name, F.lit("\n\n"), F.array_join("e.entry", "")).alias("text"),
    )
