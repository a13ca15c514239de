"""Line grammar of the supported documents, in the Java regex dialect.

All patterns here are fixed values: results depend on them character by character. Every pattern is meant for
rlike / regexp_extract; groups are addressed by position and listed beside each pattern. The flag set (?iU) means
case-insensitive with Unicode classes, (?d) keeps "." and "$" to plain line feeds.
"""

import re

LINE_BREAK = r"\r\n|[\n\r\x0b\f\x1c\x1d\x1e\x85\u2028\u2029]"
# White space as one class of ranges, which is matched faster than the Unicode property.
WHITE = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WHITE_CHARACTERS = "".join(c for c in map(chr, range(0x3001)) if re.match(f"[{WHITE}]", c))
# White space that is not already a single blank; lone blanks are left alone and cost nothing. Printed ASCII, which is
# nearly all of a text, is ruled out by one range.
SPACE = rf"(?=[^!-~])(?:[{WHITE.replace('x20', 'x1f')}][{WHITE}]*| [{WHITE}]+)"
# The same without the characters that break lines.
INLINE = r"\t\x1f\x20\xa0\u1680\u2000-\u200a\u202f\u205f\u3000"
INLINE_SPACE = rf"(?=[^!-~])(?:[{INLINE.replace('x20', 'x1f')}][{INLINE}]*| [{INLINE}]+)"
# What neither breaks a line as a plain line feed does nor is printed ASCII.
UNUSUAL = r"[^\n -~]"
# The same, or a hyphen before white space.
UNUSUAL_HYPHEN = r"[^\n -~]|-[\n ]"

# Headings and numbered lines.
LABELLED_HEADING = r"(?iU)^(Section|Article|Policy|Schedule|Appendix)\s+([A-Za-z0-9.]+)(?:\s*[-:]\s*(.+))?$"  # label, number, title
DOTTED_UNIT = r"(?U)^\s*(\d+(?:\.\d+)+)\s+(.+?)\s*$"  # number, text
CLAUSE = r"(?U)^\s*(\d+)\.\s*(.*)$"  # number, text
PART = r"(?iU)^Part\s+([IVXLCDM]+)\s*:\s*(.+)$"  # roman, title
LETTER = r"(?U)^([A-Z])\.\s*(.*)$"  # letter, title
NUMBERED_SECTION = r"(?U)^Section\s+(\d+)\s*:\s*(.+)$"  # number, title
POLICY_SECTION = r"(?iU)^Section\s+(\d+)\s*:\s*(.+)$"  # number, title
POLICY_ROMAN = r"(?iU)^([IVXLCDM]+)\.\s*(.+)$"  # roman, title
PROVISION = r"(?iU)^\(([a-z])\)\s*(.*)$"  # letter, text
ADOPTED = r"(?iU)^Adopted:\s*(.+)$"  # value
AMENDED = r"(?iU)^Amended:\s*(.+)$"  # value
# Any line of the forms Part, letter, Section, roman, (x), Adopted, Amended or numbered clause.
HEADING_LIKE = (
    r"(?U)^(?:(?i:Part\s+[IVXLCDM]+\s*:\s*.|Section\s+\d+\s*:\s*.|[IVXLCDM]+\.\s*.|\([a-z]\)|Adopted:\s*.|Amended:\s*.)"
    r"|[A-Z]\.|\s*\d+\.)"
)
MARKDOWN_HEADING = r"(?U)^(#{1,6})\s+(.+?)\s*$"  # hashes, text

# List items.
LIST_ITEM = r"(?U)^([a-z]|[ivxlcdm]{2,6})\.(?:\s+(\S.*))?$"  # marker, text
# What every line with a run-in item holds; nearly all lines settle on it.
MAYBE_RUN_IN = r"[;:.][^!-~]+[a-z]{1,6}\."
RUN_IN = r"(?U)(?<=[;:.])\s+(?=(?:[a-z]|[ivxlcdm]{2,6})\.(?:\s+\S|$))"

# Lines that carry no content.
SKIP = r"(?iU)^(?:\p{Nd}*|table of contents|last amended:.*)$"

# Definitions: whole sentence, term.
QUOTED_DEFINITION = r"(?idU)^\s*(?:\d+(?:\.\d+)*\.?\s+)?([\"\u201c]([^\"\u201d]+)[\"\u201d]\s+means\s+.+)"
PLAIN_DEFINITION = r"(?dU)^\s*(?:\d+(?:\.\d+)*\.?\s+)?(([A-Z][A-Za-z0-9 -]{1,80})\s+means\s+.+)"

# Cross-references in the fixed order of their types; the target is group 1.
REFERENCES = (
    ("read_with", r"(?idU)\bread with\s+(?:the\s+)?(\d+(?:\.\d+)+|.+?)(?:\.|$)"),
    ("subject_to", r"(?idU)\bsubject to\s+(?:section\s+)?(\d+(?:\.\d+)+|.+?)(?:\.|$)"),
    ("despite", r"(?idU)\bdespite\s+(?:section\s+)?(\d+(?:\.\d+)+|.+?)(?:\.|$)"),
    ("exception_to", r"(?idU)\bexcept(?:ion to)?\s+(?:section\s+)?(\d+(?:\.\d+)+|.+?)(?:\.|$)"),
    ("amends", r"(?idU)\b(?:amends|amended by)\s+(?:section\s+)?(\d+(?:\.\d+)+|.+?)(?:\.|$)"),
    ("supersedes", r"(?idU)\bsupersedes\s+(?:section\s+)?(\d+(?:\.\d+)+|.+?)(?:\.|$)"),
    ("higher_authority_than", r"(?idU)\bprevails over\s+(?:an?\s+|the\s+)?(\d+(?:\.\d+)+|.+?)(?:\.|$)"),
    ("section_reference", r"(?iU)\bunder section\s+(\d+(?:\.\d+)+)\b"),
)

# What every match of a reference in ASCII holds, in lower case.
REFERENCE_WORDS = {
    "read_with": "read with",
    "subject_to": "subject to",
    "despite": "despite",
    "exception_to": "except",
    "amends": "amend",
    "supersedes": "supersedes",
    "higher_authority_than": "prevails over",
    "section_reference": "under section",
}

# Letters, digits and single hyphens and dots between them.
PLAIN_KEY = r"^[A-Za-z0-9]+(?:[.-][A-Za-z0-9]+)*+\z"

WIKILINK = r"\[\[([^\]]+)\]\]"
WORD = r"[A-Za-z0-9]+"

# Audit.
NESTED_MARKER = r"(?U)\s(?:[a-z]|i|ii|iii|iv|v|vi|vii|viii|ix|x|xi|xii|xiii)\.\s+"
AUDIT_MARKER = r"(?:[a-z]|i{2,3}|iv|v|vi{1,3}|ix|x|xi{1,3})"
PAGE_HYPHEN = r"(?U)-(?<=\w-)\s+(?=\w)"  # starts at the hyphen, so the look behind runs only there
