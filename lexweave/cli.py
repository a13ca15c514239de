"""Command line: init, compile, config-check, validate, report, gold, audit. Run with python -m lexweave.cli or spark-submit."""

import argparse
import importlib.util
import json
import os
import sys
from pathlib import Path

from lexweave.session import build_session
from lexweave.sources.manifest import ManifestError, load_env

SAMPLE_SOURCE = "# Fictional fixture: Sample Bylaw\n\n## Section 1 - Notices\n\n1.1 Notices must be posted in writing.\n"
SAMPLE_MANIFEST = """documents:
  - source_path: sources/sample-bylaw.md
    document_type: bylaw
    title: Sample Bylaw
    slug: sample-bylaw
    jurisdiction: Sample Association
    authority_rank: 40
    status: draft
    confidentiality: public
    effective_date: null
    owner: Records Office
    version: v1
    reviewed_by: null
    metadata_notes:
      - effective_date and reviewed_by are open for this fictional sample.
"""


def init(target: str) -> int:
    """Create an empty corpus project; refuses a folder that already holds something."""
    root = Path(target)
    if root.exists() and any(root.iterdir()):
        print(f"Error: {target} is not empty", file=sys.stderr)
        return 1
    for folder in ("sources", "corpus/.raw/sources", "corpus/.raw/extraction", "corpus/.raw/provenance", "corpus/legal"):
        (root / folder).mkdir(parents=True, exist_ok=True)
    (root / "sources" / "sample-bylaw.md").write_text(SAMPLE_SOURCE, encoding="utf-8", newline="\n")
    (root / "sources" / "manifest.yaml").write_text(SAMPLE_MANIFEST, encoding="utf-8", newline="\n")
    print(f"Corpus project created: {target}")
    return 0


def config_check() -> int:
    found = lambda name: importlib.util.find_spec(name) is not None
    print(f"Local .env: {'present' if load_env() else 'not found'}")
    print(f"OCR key: {'configured' if os.environ.get('OCR_API_KEY') else 'missing'}")
    print(f"Local PDF reader: {'available' if found('fitz') or found('PyPDF2') else 'missing'}")
    print(f"YAML: {'available' if found('yaml') else 'missing'}")
    return 0


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="lexweave", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("init").add_argument("target")
    commands.add_parser("config-check")
    compile_args = commands.add_parser("compile")
    compile_args.add_argument("source", help="project folder with sources/manifest.yaml")
    compile_args.add_argument("output")
    compile_args.add_argument("--ocr-responses", help="Parquet table of OCR responses (slug, json) for PDF sources")
    for name in ("validate", "report"):
        commands.add_parser(name).add_argument("output")
    gold = commands.add_parser("gold")
    gold.add_argument("output")
    gold.add_argument("questions")
    gold.add_argument("--top-k", type=int, default=5)
    audit = commands.add_parser("audit")
    audit.add_argument("output")
    audit.add_argument("--pages", required=True, help="Parquet table of source pages (page, text)")
    audit.add_argument("--doc", required=True, help="slug that the card identifiers start with")
    audit.add_argument("--rows", help="file for the audit rows (CSV); summary and patterns go beside it")
    audit.add_argument("--register", help="warning register (JSON rows) whose warnings the cards carry")
    register = commands.add_parser("register")
    register.add_argument("output")
    register.add_argument("target", help="folder for the register files")
    audit.add_argument("--fail-on-findings", action="store_true")
    args = parser.parse_args(argv)

    if args.command == "init":
        return init(args.target)
    load_env()
    if args.command == "config-check":
        return config_check()

    from lexweave import jobs

    spark = build_session()
    try:
        if args.command == "compile":
            responses = spark.read.parquet(args.ocr_responses) if args.ocr_responses else None
            manifest = str(Path(args.source) / "sources" / "manifest.yaml")
            counts = jobs.compile_corpus(spark, manifest, args.source, args.output, ocr_responses=responses)
            print(f"Compiled {counts['documents']} source document(s) into {args.output} with {counts['files']} generated corpus file(s)")
        elif args.command == "validate":
            result = jobs.validate_corpus(spark, args.output, update=True)
            print(f"Validation {result['validation_status']}: {result['blocking_error_count']} error(s), {result['warning_count']} warning(s)")
            for found in result["issues"] if result["blocking_error_count"] else []:
                print(f"- {found['severity']}: {found['category']} [{found['path']}] {found['message']}", file=sys.stderr)
            return 1 if result["blocking_error_count"] else 0
        elif args.command == "report":
            print(jobs.corpus_report(spark, args.output), end="")
        elif args.command == "gold":
            jobs.gold_evaluation(spark, args.output, args.questions, args.top_k).show(truncate=False)
        elif args.command == "register":
            print(json.dumps(jobs.write_register(spark, args.output, args.target), indent=2))
        elif args.command == "audit":
            result = jobs.audit_corpus(spark, args.output, spark.read.parquet(args.pages), args.doc, args.rows, args.register)
            print(json.dumps(result, indent=2))
            return 2 if args.fail_on_findings and (result["blocked"] or result["p1_count"]) else 0
    except (jobs.CompileError, ManifestError) as error:
        print(f"Error: {error}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
