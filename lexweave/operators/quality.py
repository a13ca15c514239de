"""Choice between two extractions of the same source, by the structure each of them keeps."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Measure, and the reason given when the candidate is worse. Order matters.
MUST_NOT_FALL = (
    ("page_count", "page_count_reduced"),
    ("page_anchor_coverage", "page_anchor_coverage_reduced"),
    ("part_headings", "part_headings_lost"),
    ("lettered_sections", "lettered_sections_lost"),
    ("numbered_clauses", "numbered_clauses_lost"),
    ("definitions", "definitions_lost"),
)
MUST_NOT_RISE = (
    ("duplicate_heading_ids", "duplicate_heading_ids_increased"),
    ("missing_heading_ids", "missing_heading_ids_increased"),
    ("hierarchy_transition_errors", "hierarchy_transition_errors_increased"),
    ("material_warnings", "material_warnings_increased"),
)
MUST_NOT_CHANGE = (
    ("source_hash", "source_hash_changed"),
    ("deterministic_id_fingerprint", "deterministic_id_fingerprint_changed"),
)
WELCOME = (
    ("material_warnings", "material_warnings_reduced"),
    ("unresolved_reference_warnings", "unresolved_reference_warnings_reduced"),
)


def compare_quality(pairs: DataFrame) -> DataFrame:
    """Decision per pair of summaries in the struct columns local and candidate."""
    local, other = (lambda m: F.col(f"local.{m}")), (lambda m: F.col(f"candidate.{m}"))
    worse = [F.when(~other("success"), F.lit("candidate_failed"))]
    worse += [F.when(other(m) != local(m), F.lit(reason)) for m, reason in MUST_NOT_CHANGE]
    worse += [F.when(other(m) < local(m), F.lit(reason)) for m, reason in MUST_NOT_FALL]
    worse += [F.when(other(m) > local(m), F.lit(reason)) for m, reason in MUST_NOT_RISE]
    better = [F.when(other(m) < local(m), F.lit(reason)) for m, reason in WELCOME]
    kept = pairs.withColumns({"_worse": F.array_compact(F.array(*worse)), "_better": F.array_compact(F.array(*better))})
    retained = F.size("_worse") > 0
    gains = F.when(F.size("_better") > 0, F.col("_better")).otherwise(F.array(F.lit("candidate_structurally_equivalent")))
    return kept.withColumns(
        {
            "selected_provider": F.when(retained, local("provider")).otherwise(other("provider")),
            "decision": F.when(retained, "local_retained").otherwise("candidate_selected"),
            "reasons": F.when(retained, F.col("_worse")).otherwise(gains),
        }
    ).drop("_worse", "_better")
