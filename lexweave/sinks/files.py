"""Writing of rendered files below a shared folder, and the import manifest that lists them."""

import os
import uuid
from collections.abc import Iterator
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexweave.operators.validate import unsafe_path
from lexweave.sinks.single import write_single

WRITTEN = "path string, file_type string, sha256 string, sync_eligible boolean, source_document_slug string, clause_id string"
NOT_SYNCED = ("raw_provenance", "raw_extraction", "raw_source", "schema_pack")


def write_files(files: DataFrame, root: str) -> DataFrame:
    """Write path / content rows below root and return what was written; nothing happens before an action runs.

    root must be mounted on every worker. Each file is written under a temporary name and then renamed, so a task that
    runs twice leaves the same file. Line ends are plain line feeds, and digests are taken of the bytes written.
    """
    checked = files.select(
        F.when(unsafe_path(F.col("path")), F.raise_error(F.concat(F.lit("unsafe export path: "), F.col("path"))))
        .otherwise(F.col("path"))
        .alias("path"),
        F.col("content").cast("binary").alias("content"), "file_type", "slug", "clause_id",
    )

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            digests = []
            for path, content in zip(batch["path"], batch["content"]):
                data, target = bytes(content), os.path.join(root, path)
                os.makedirs(os.path.dirname(target), exist_ok=True)
                staged = f"{target}.{uuid.uuid4().hex}"
                with open(staged, "wb") as handle:
                    handle.write(data)
                os.replace(staged, target)
                digests.append(sha256(data).hexdigest())
            yield pd.DataFrame(
                {
                    "path": batch["path"],
                    "file_type": batch["file_type"],
                    "sha256": digests,
                    "sync_eligible": ~batch["file_type"].isin(NOT_SYNCED),
                    "source_document_slug": batch["slug"],
                    "clause_id": batch["clause_id"],
                }
            )

    return checked.mapInPandas(write, WRITTEN)


def shared_value(name: str) -> Column:
    """The value all documents share, else null."""
    return F.when(F.count_distinct(name) == 1, F.min(name))


def manifest_header(documents: DataFrame) -> DataFrame:
    """One row of corpus-wide values: shared values or their defaults, and the confidentiality levels in use."""
    eligibility = F.coalesce(shared_value("sync_eligibility"), F.lit("blocked"))
    return documents.agg(
        F.coalesce(shared_value("corpus_id"), F.lit("corpus")).alias("corpus_id"),
        F.coalesce(shared_value("corpus_version"), F.lit("fixture-v1")).alias("corpus_version"),
        shared_value("target_namespace").alias("target_namespace"),
        shared_value("classification").alias("classification"),
        eligibility.alias("sync_eligibility"),
        eligibility.isin("production_pilot", "production_batch").alias("sync_eligible"),
        F.sort_array(F.collect_set("confidentiality")).alias("confidentiality_scope"),
    )


def manifest_lines(written: DataFrame) -> DataFrame:
    """YAML text of each file entry."""
    value = lambda name: F.coalesce(F.col(name).cast("string"), F.lit("null"))
    names = ("file_type", "sha256", "sync_eligible", "source_document_slug", "clause_id")
    fields = [F.concat(F.lit(f"\n  {name}: "), value(name)) for name in names]
    return written.select("path", F.concat(F.lit("- path: "), F.col("path"), *fields).alias("value"))


#: Where the head of an import manifest ends and its list of files begins.
FILES = b"\nfiles:\n"


def manifest_head(header: dict) -> str:
    import yaml

    return yaml.safe_dump(header, sort_keys=False, default_flow_style=False).rstrip("\n") + FILES.decode()


def write_manifest(header: dict, written: DataFrame, target: str) -> None:
    """Write the import manifest as one YAML file: the header, then the entries in the order of their paths."""
    write_single(manifest_lines(written), ["path"], manifest_head(header), target)
