"""Source manifests, gold questions and import manifests (YAML)."""

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Domains of manifest fields.
DOMAINS = {
    "document_type": ("bylaw", "policy", "collective_agreement", "legislation"),
    "status": ("active", "draft", "superseded", "archived"),
    "confidentiality": ("public", "internal", "restricted", "confidential"),
    "sync_eligibility": ("blocked", "staging_only", "production_pilot", "production_batch"),
}
DOCUMENT_SCHEMA = (
    "source_path string, document_type string, title string, slug string, jurisdiction string, authority_rank int, "
    "status string, confidentiality string, effective_date string, owner string, version string, reviewed_by string, "
    "metadata_notes array<string>, profile string, corpus_id string, corpus_version string, target_namespace string, "
    "classification string, sync_eligibility string, review_date string, front_pages int, doc_ord bigint"
)
FIELDS = tuple(part.split()[0] for part in DOCUMENT_SCHEMA.split(", "))[:-1]
REQUIRED = FIELDS[:13]
NULLABLE = ("effective_date", "reviewed_by")
DEFAULTS = {"profile": "generic", "corpus_id": "corpus", "corpus_version": "fixture-v1", "sync_eligibility": "blocked"}


class ManifestError(ValueError):
    pass


def profile_kind(profile: Column) -> Column:
    """Parser behind a profile name: names that speak of bylaws or policies select those parsers."""
    low = F.lower(profile)
    return (
        F.when(F.contains(low, F.lit("bylaw")), "bylaws").when(F.contains(low, F.lit("polic")), "policy").otherwise("generic")
    )


def _check(entry: dict) -> None:
    unknown = set(entry) - set(FIELDS)
    missing = [name for name in REQUIRED if name not in entry]
    if unknown or missing:
        raise ManifestError(f"unknown fields {sorted(unknown)}, missing fields {missing}")
    if type(entry["authority_rank"]) is not int:
        raise ManifestError("authority_rank must be a whole number")
    pages = entry.get("front_pages")
    if pages is not None and (type(pages) is not int or pages < 0):
        raise ManifestError("front_pages must be a whole number of title and contents pages, or null")
    for name, allowed in DOMAINS.items():
        if name in entry and entry[name] not in allowed:
            raise ManifestError(f"{name} must be one of {allowed}")
    notes = "\n".join(entry["metadata_notes"]).lower()
    for name in NULLABLE:
        if entry[name] is None and name not in notes:
            raise ManifestError(f"{name} is null and must be explained in metadata_notes")


def load_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a source manifest with their order in it; a hand-written file, read on the driver."""
    import yaml

    data = yaml.safe_load(Path(path).read_text(encoding="utf-8"))
    if not isinstance(data, dict) or set(data) != {"documents"}:
        raise ManifestError("a manifest holds a list of documents and nothing else")
    rows = []
    for i, entry in enumerate(data["documents"]):
        _check(entry)
        rows.append(tuple((DEFAULTS | entry).get(name) for name in FIELDS) + (i,))
    return spark.createDataFrame(rows, DOCUMENT_SCHEMA)


def manifest_issues(documents: DataFrame) -> DataFrame:
    """The same rules for manifests that already are tables: one row per broken rule."""
    notes = F.lower(F.array_join("metadata_notes", "\n"))
    rules = [
        F.when(~F.col(name).isin(*allowed), F.lit(f"{name} outside its domain")) for name, allowed in DOMAINS.items()
        if name in documents.columns
    ]
    rules += [
        F.when(F.col(name).isNull() & ~F.contains(notes, F.lit(name)), F.lit(f"{name} is null and not explained"))
        for name in NULLABLE
        if name in documents.columns
    ]
    return documents.select("slug", F.explode(F.array_compact(F.array(*rules))).alias("issue"))


def load_questions(spark: SparkSession, path: str) -> DataFrame:
    """Gold questions; a hand-written file, read on the driver."""
    import yaml

    data = yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}
    if not isinstance(data.get("questions"), list):
        raise ManifestError("gold questions file must contain a questions list")
    lists = ("expected_clause_ids", "expected_parent_ids", "expected_definition_ids")
    rows = [(q["id"], q["question"], *[q.get(name) or [] for name in lists]) for q in data["questions"]]
    return spark.createDataFrame(
        rows, "question_id string, question string, " + ", ".join(f"{name} array<string>" for name in lists)
    )


def manifest_entries(spark: SparkSession, path: str) -> DataFrame:
    """File entries of an import manifest: path, file_type, sha256, sync_eligible, source_document_slug, clause_id.

    The file list grows with the corpus, so it is not parsed on the driver: the text is cut into records before every
    entry, and each record is read with plain field patterns (entries hold scalars only).
    """
    records = spark.read.option("lineSep", "\n- path: ").text(path)
    field = lambda name: F.nullif(
        F.regexp_replace(F.regexp_extract("value", rf"(?m)^  {name}: (.*)$", 1), r"^(['\"])(.*)\1$", "$2"), F.lit("null")
    )
    opening = F.regexp_replace(F.split_part("value", F.lit("\n"), F.lit(1)), r"^- path: ", "")
    first = F.regexp_replace(opening, r"^(['\"])(.*)\1$", "$2")
    return records.where(F.col("value").rlike(r"(?m)^  sha256: ")).select(
        first.alias("path"), field("file_type").alias("file_type"), field("sha256").alias("sha256"),
        (field("sync_eligible") == "true").alias("sync_eligible"),
        F.nullif(field("source_document_slug"), F.lit("")).alias("source_document_slug"),
        F.nullif(field("clause_id"), F.lit("")).alias("clause_id"),
    )


def load_env(folder: str | None = None) -> Path | None:
    """Read the nearest .env file upwards; variables that are already set keep their value."""
    start = Path(folder or ".").resolve()
    for place in (start, *start.parents):
        candidate = place / ".env"
        if candidate.is_file():
            for line in candidate.read_text(encoding="utf-8").splitlines():
                name, found, value = line.partition("=")
                if found and name.strip() and not name.lstrip().startswith("#"):
                    os.environ.setdefault(name.strip().removeprefix("export "), value.strip().strip("'\""))
            return candidate
    return None
