"""Column expressions shared by all jobs; nothing here leaves the JVM."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexweave.functions import patterns as P


def present(col: Column) -> Column:
    """Null instead of an empty string."""
    return F.nullif(col, F.lit(""))


def group(col: Column, pattern: str, index: int) -> Column:
    return F.regexp_extract(col, pattern, index)


def strip(col: Column) -> Column:
    return F.btrim(col, F.lit(P.WHITE_CHARACTERS))


def exchange(col: Column, chars: str, others: str) -> Column:
    """Each of chars replaced by the one of others in its place, which is none of chars; cheaper than translate, which
    looks up every character of the text."""
    for one, other in zip(chars, others, strict=True):
        col = F.replace(col, F.lit(one), F.lit(other))
    return col


def collapse(col: Column) -> Column:
    return F.trim(F.regexp_replace(col, P.SPACE, " "))


def plainly_collapsed(col: Column, unusual: str, otherwise: Column) -> Column:
    """The text collapsed by plain replacing, unless it holds what unusual says or long runs of white space.

    Nearly all texts are printed ASCII and line feeds, for which this does the same as the pattern at a fraction of the cost.
    """
    single = F.replace(F.replace(col, F.lit("\n"), F.lit(" ")), F.lit("  "), F.lit(" "))
    usual = ~col.rlike(unusual) & ~F.contains(single, F.lit("  "))
    return F.when(usual, F.trim(single)).otherwise(otherwise)


def clean_line(col: Column) -> Column:
    """Zero-width characters become spaces, curly double quotes straight ones, runs of white space one space."""
    return collapse(exchange(col, "\u200b\ufeff\u201c\u201d", "  \"\""))


def cleaned_lines(col: Column) -> Column:
    """Lines of a text as clean_line makes them; the text is cleaned as a whole, which is cheaper than line by line."""

    def lines(plain: Column) -> Column:
        # Nearly all texts are printed ASCII, where plain replacing and cutting does the same at a fraction of the cost.
        single = F.replace(plain, F.lit("  "), F.lit(" "))
        usual = ~plain.rlike(P.UNUSUAL) & ~F.contains(single, F.lit("  "))
        return F.when(usual, F.split(single, "\n")).otherwise(split_lines(F.regexp_replace(plain, P.INLINE_SPACE, " ")))

    # An array of one text, so that the text is worked out once and named several times.
    plain = F.array(exchange(col, "\u200b\ufeff\u201c\u201d", "  \"\""))
    return F.transform(F.get(F.transform(plain, lines), F.lit(0)), lambda line: F.trim(line))


def split_lines(col: Column) -> Column:
    return F.split(col, P.LINE_BREAK)


def skip_line(col: Column) -> Column:
    return col.rlike(P.SKIP)


def heading_like(col: Column) -> Column:
    return col.rlike(P.HEADING_LIKE)


def word_count(cleaned: Column) -> Column:
    """Number of words of a line that has already been through clean_line."""
    return F.when(cleaned == "", F.lit(0)).otherwise(F.size(F.split(cleaned, " ")))


def all_upper(col: Column) -> Column:
    return col.rlike(r"\p{IsUppercase}") & ~col.rlike(r"\p{IsLowercase}")


def identifier(col: Column) -> Column:
    dashed = F.regexp_replace(strip(col), r"[^A-Za-z0-9.]+", "-")
    return F.lower(F.regexp_replace(dashed, r"^-+|-+$", ""))


def slugify(col: Column) -> Column:
    dashed = F.regexp_replace(F.lower(col), r"[^a-z0-9]+", "-")
    return F.coalesce(present(F.regexp_replace(dashed, r"^-+|-+$", "")), F.lit("definition"))


def reference_key(col: Column) -> Column:
    return F.lower(plainly_collapsed(col, P.UNUSUAL, collapse(col)))


def unit_key(col: Column) -> Column:
    """Key of a unit's identifier, number or label; what is written as a key already only loses its upper case."""
    bare = F.regexp_replace(F.lower(strip(col)), r"(?U)^(?:section|article|policy|clause)\s+", "")
    return F.when(col.rlike(P.PLAIN_KEY), F.lower(col)).otherwise(identifier(bare))


def audit_norm(col: Column) -> Column:
    """Normal form used by the audit: plain quotes and dashes, joined hyphenation, lower case."""
    plain = exchange(col, "\u2019\u2018\u201c\u201d\u2013\u2014\u00a0", "''\"\"-- ")
    plain = F.replace(plain, F.lit("full- time"), F.lit("full-time"))
    plain = F.regexp_replace(plain, P.PAGE_HYPHEN, "")
    return F.lower(plainly_collapsed(col, P.UNUSUAL_HYPHEN, collapse(plain)))


def words(col: Column) -> Column:
    """Lower-cased runs of ASCII letters and digits, in text order."""
    return F.transform(F.regexp_extract_all(col, F.lit("([A-Za-z0-9]+)"), F.lit(1)), F.lower)


def audit_words(normal: Column) -> Column:
    return F.regexp_extract_all(normal, F.lit("([a-z0-9]+)"), F.lit(1))


def ordered_distinct(col: Column) -> Column:
    """Distinct non-empty entries in first-seen order."""
    return F.array_distinct(F.filter(col, lambda x: x.isNotNull() & (x != "")))


def wikilink(col: Column) -> Column:
    return F.concat(F.lit("[["), col, F.lit("]]"))


def wikilink_list(col: Column) -> Column:
    joined = F.array_join(F.transform(col, wikilink), ", ")
    return F.when(F.size(col) > 0, joined).otherwise(F.lit("none"))


def link_target(col: Column) -> Column:
    """Page named by a wikilink: alias after '|' and fragment after '#' dropped."""
    return strip(F.split_part(F.split_part(strip(col), F.lit("|"), F.lit(1)), F.lit("#"), F.lit(1)))


def roman(number: Column) -> Column:
    """Roman numeral of a number between 1 and 99, by digit."""
    tens = F.element_at(F.split(F.lit(" ,X,XX,XXX,XL,L,LX,LXX,LXXX,XC"), ","), (F.floor(number / 10) % 10 + 1).cast("int"))
    ones = F.element_at(F.split(F.lit(" ,I,II,III,IV,V,VI,VII,VIII,IX"), ","), (number % 10 + 1).cast("int"))
    return F.concat(F.trim(tens), F.trim(ones))
