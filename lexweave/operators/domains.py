"""Domain rules of all records as a table of constraints, compiled into one pass over the rows of a record.

A constraint names a record, a field, a kind and what that kind needs: a list of values, or a pattern. Rows that break
constraints come out once per broken one; the rows themselves are read once, whatever the number of constraints.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexweave.sources.manifest import DOMAINS

ONE_OF, MATCHES, EACH_MATCHES, FIELDS = "one_of", "matches", "each_matches", "fields"
SHA256 = r"^[0-9a-f]{64}\z"
SAFE_STEM = r"^[A-Za-z0-9][A-Za-z0-9_.-]*\z"


@dataclass(frozen=True)
class Constraint:
    """A rule on one field; `optional` fields may be null."""

    record: str
    field: str
    kind: str
    domain: tuple[str, ...] | str
    optional: bool = False


# The domains of the fields of each record.
CONSTRAINTS = [
    *(Constraint("document", name, ONE_OF, values, name == "sync_eligibility") for name, values in DOMAINS.items()),
    Constraint("document", "profile", MATCHES, r"(?i)^(?:generic|.*bylaw.*|.*polic.*)\z", True),
    Constraint("document", "slug", MATCHES, SAFE_STEM),
    Constraint("extraction", "status", ONE_OF, ("ok", "review_required", "partial", "failed")),
    Constraint("extraction", "provider", ONE_OF, ("markdown", "ocr", "local_pdf")),
    Constraint("extraction", "source_hash", MATCHES, SHA256),
    Constraint("warning", "severity", ONE_OF, ("info", "warning", "error")),
    Constraint(
        "warning", "category", ONE_OF,
        ("missing_provider_key", "provider_auth", "provider_rate_limit", "provider_timeout", "provider_connection", "provider_api_error", "provider_validation",
         "pdf_password_protected", "pdf_corrupt_or_unsupported", "ocr_empty", "ocr_low_confidence", "partial_extraction", "unknown_provider_error"),
    ),
    Constraint(
        "unit", "unit_type", ONE_OF,
        ("instrument", "part", "section", "article", "policy", "schedule", "appendix", "clause", "paragraph", "subparagraph", "unknown"),
    ),
    Constraint(
        "reference", "reference_type", ONE_OF,
        ("read_with", "subject_to", "despite", "exception_to", "amends", "supersedes", "higher_authority_than", "section_reference"),
    ),
    Constraint("reference", "resolution_status", ONE_OF, ("resolved", "unresolved")),
    Constraint(
        "file", "file_type", ONE_OF,
        ("generated_file", "legal_instrument", "legal_clause", "legal_definition", "unresolved_reference", "raw_provenance", "import_manifest"),
    ),
    Constraint("file", "sha256", MATCHES, SHA256),
    Constraint("release", "validation_status", ONE_OF, ("pending", "passed", "failed")),
    Constraint("release", "sync_eligibility", ONE_OF, DOMAINS["sync_eligibility"]),
    Constraint("release", "source_manifest_hash", MATCHES, SHA256),
    Constraint("issue", "severity", ONE_OF, ("error", "warning")),
]


def broken(rule: Constraint) -> Column:
    """Whether a row breaks a rule; a null does unless the field is optional."""
    value = F.col(rule.field)
    if rule.kind == ONE_OF:
        wrong = ~value.isin(*rule.domain)
    elif rule.kind == MATCHES:
        wrong = ~value.rlike(rule.domain)
    elif rule.kind == EACH_MATCHES:
        wrong = F.exists(value, lambda v: ~F.coalesce(v.rlike(rule.domain), F.lit(False)))
    elif rule.kind == FIELDS:
        wrong = F.size(F.array_except(value, F.array(*map(F.lit, rule.domain)))) > 0
    else:
        raise ValueError(f"unknown kind of constraint: {rule.kind}")
    return F.coalesce(wrong, F.lit(not rule.optional))


def shown(rule: Constraint) -> Column:
    """The value of a field as text; of a list the entries that break the rule."""
    value = F.col(rule.field)
    if rule.kind == FIELDS:
        return F.array_join(F.array_sort(F.array_except(value, F.array(*map(F.lit, rule.domain)))), ",")
    if rule.kind == EACH_MATCHES:
        return F.array_join(F.filter(value, lambda v: ~F.coalesce(v.rlike(rule.domain), F.lit(False))), ",", "null")
    return value.cast("string")


def domain_issues(rows: DataFrame, record: str, key: str, rules: list[Constraint] | None = None) -> DataFrame:
    """record, key, field, rule and value of each constraint that a row breaks.

    Constraints on fields that the rows have not are broken by every row, unless the field is optional.
    """
    own = [rule for rule in (CONSTRAINTS if rules is None else rules) if rule.record == record]
    if not own:
        raise ValueError(f"no constraints on records of kind {record}")
    absent = [rule.field for rule in own if rule.field not in rows.columns]
    rows = rows.withColumns({name: F.lit(None).cast("string") for name in absent})
    entry = lambda rule: F.struct(F.lit(rule.field).alias("field"), F.lit(rule.kind).alias("rule"), shown(rule).alias("value"))
    found = F.array_compact(F.array(*[F.when(broken(rule), entry(rule)) for rule in own]))
    return rows.select(F.lit(record).alias("record"), F.col(key).cast("string").alias("key"), F.explode(found).alias("i")).select("record", "key", "i.*")
