"""Assembly of running text: list items keep their own line, roman items are indented below letters."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexweave.functions import patterns as P

# A single letter that is also a roman digit is a list letter only when it follows its predecessor in the running
# list; (predecessor, letter) pairs in the order they have to be settled. Settled letters are written in upper case.
AMBIGUOUS = (("b", "c"), ("C", "d"), ("h", "i"), ("k", "l"), ("L", "m"), ("u", "v"), ("w", "x"))
PLAIN_LETTERS = "abefghjknopqrstuwyz"


def flow_parts(line: Column) -> Column:
    """Parts of a line, split before list markers that follow ';', ':' or '.': array<struct<part, code>>.

    The code is '-' for running text, '#' for a roman marker of two or more letters, else the marker letter.
    """
    cut = F.when(line.rlike(P.MAYBE_RUN_IN), F.split(line, P.RUN_IN)).otherwise(F.array(line))
    parts = F.filter(cut, lambda part: part != "")
    marker = lambda part: F.regexp_extract(part, P.LIST_ITEM, 1)
    code = lambda part: (
        F.when(marker(part) == "", F.lit("-")).when(F.length(marker(part)) > 1, F.lit("#")).otherwise(marker(part))
    )
    return F.transform(parts, lambda part: F.struct(part.alias("part"), code(part).alias("code")))


def settle_markers(codes: Column) -> Column:
    """Decide list letters in a string of part codes, two characters per part ('|' first where a flow starts).

    Each ambiguous letter is settled by one pass: the first one after its predecessor, with no other letter of the
    list and no flow border in between, continues the list and turns into upper case. The rest stay roman.
    """
    for before, letter in AMBIGUOUS:
        codes = F.regexp_replace(codes, f"({before}[^{PLAIN_LETTERS}|{letter}]*){letter}", f"$1{letter.upper()}")
    return codes


def with_flow_text(df: DataFrame, parts: str, out: str) -> DataFrame:
    """Text of the flows in a column array<struct<flow, part, code>>; flows and items go on lines of their own.

    All steps are linear in the text. The code string is settled in a column of its own, so that it is computed once
    per row and not once per part.
    """
    border = lambda i: (i > 0) & (F.get(parts, i - 1)["flow"] != F.get(parts, i)["flow"])
    codes = F.transform(parts, lambda e, i: F.concat(F.when(border(i), F.lit("|")).otherwise(F.lit("-")), e["code"]))
    code = lambda i: F.get("_codes", i * 2 + 1)
    opening = lambda i: (
        F.when(i == 0, F.lit(""))
        .when((F.get("_codes", i * 2) == "|") | (code(i) != "-"), F.lit("\n"))
        .otherwise(F.lit(" "))
    )
    indent = lambda i: F.when(code(i).rlike("^[#cdilmvx]$"), F.lit("  ")).otherwise(F.lit(""))
    text = F.array_join(F.transform(parts, lambda e, i: F.concat(opening(i), indent(i), e["part"])), "")
    coded = df.withColumn("_coded", F.array_join(codes, ""))
    return (
        coded.withColumn("_codes", F.split(settle_markers(F.col("_coded")), ""))
        .withColumn(out, text)
        .drop("_coded", "_codes")
    )
