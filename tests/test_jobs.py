import csv
import shutil
from pathlib import Path

import pytest
import yaml

from lexweave import jobs
from lexweave.cli import init
from lexweave.sources import manifest as M
from lexweave.sources.manifest import ManifestError, load_manifest
from lexweave.sources.pages import read_frontmatter

SOURCES = {
    "rules.md": "# Fictional fixture: Club Rules\n\n## Section 1 - Members\n\n1.1 The club keeps a list of listed members.\n\n"
    "1.2 \"Listed member\" means a student on the member list.\n\n1.3 Notices are read with the Notice Policy.\n",
    "policy.md": "# Fictional fixture: Notice Policy\n\n## Policy 2 - Timing\n\n2.1 A notice is posted three days before a meeting.\n",
    "act.md": "# Fictional fixture: Safety Act\n\n## Section 7 - Exits\n\n7.1 Exits stay clear.\n7.2 This prevails over a conflicting room policy.\n",
}
PDF_PAGES = ["Part I: BASICS\nA. NAME\n1. The club is named Sample.\n2. Subject to section 1.\n", "B. SEAL\n1. Kept safe.\n"]
QUESTIONS = [
    {"id": "listed", "question": "What does listed member mean?", "expected_clause_ids": ["rules-1.2"],
     "expected_parent_ids": ["rules-section-1"], "expected_definition_ids": ["listed-member"]},
    {"id": "notice", "question": "When is a notice posted before a meeting?", "expected_clause_ids": ["policy-2.1"],
     "expected_parent_ids": ["policy-policy-2"], "expected_definition_ids": []},
]
BASE = {
    "jurisdiction": "Sample Club", "authority_rank": 40, "status": "active", "confidentiality": "public", "effective_date": None,
    "owner": "Records", "version": "v1", "reviewed_by": None, "metadata_notes": ["effective_date open", "reviewed_by open"],
}


def manifest_entries():
    kinds = {"rules": ("bylaw", "Club Rules"), "policy": ("policy", "Notice Policy"), "act": ("legislation", "Safety Act")}
    entries = [
        BASE | {"source_path": f"sources/{slug}.md", "document_type": kind, "title": title, "slug": slug}
        for slug, (kind, title) in kinds.items()
    ]
    return entries + [
        BASE | {"source_path": "sources/club.pdf", "document_type": "bylaw", "title": "Club Bylaws", "slug": "club", "profile": "club_bylaws_v1"}
    ]


@pytest.fixture(scope="module")
def project(tmp_path_factory):
    root = tmp_path_factory.mktemp("project")
    (root / "sources").mkdir()
    for name, text in SOURCES.items():
        (root / "sources" / name).write_text(text, encoding="utf-8")
    (root / "sources" / "club.pdf").write_bytes("\f".join(PDF_PAGES).encode())
    (root / "sources" / "manifest.yaml").write_text(yaml.safe_dump({"documents": manifest_entries()}), encoding="utf-8")
    (root / "gold.yaml").write_text(yaml.safe_dump({"questions": QUESTIONS}), encoding="utf-8")
    return root


@pytest.fixture(scope="module")
def compiled(spark, project):
    out = project / "compiled"
    counts = jobs.compile_corpus(
        spark, str(project / "sources" / "manifest.yaml"), str(project), str(out), generated_at="2026-01-01T00:00:00+00:00",
        reader=lambda content: content.decode().split("\f"),
    )
    return out, counts


def test_compiled_files(compiled):
    out, counts = compiled
    assert counts["documents"] == 4 and counts["legal_instrument"] == 4 and counts["legal_definition"] == 1
    text = (out / "legal/clauses/bylaws/rules-1.3.md").read_text(encoding="utf-8")
    assert text.startswith("---\ntitle: Club Rules 1.3\ntype: legal_clause\nunit_type: clause\nclause_id: rules-1.3\nslug: rules-1.3\n")
    assert "parent_chain:\n- rules\n- rules-section-1\n" in text and "read_with:\n- policy\n" in text
    assert text.endswith(
        "## Source Text\n\n1.3 Notices are read with the Notice Policy.\n\n## Legal Context\n\n- Instrument: [[rules]].\n"
        "- Parent chain: [[rules]], [[rules-section-1]].\n- Child clauses: none.\n- Definitions defined here: none.\n"
        "- Resolved read-with references: [[policy]].\n- Unresolved references: none.\n\n## Retrieval Hints\n\n"
        "- Query by clause ID `rules-1.3` and instrument `rules`.\n"
    )
    section = (out / "legal/clauses/bylaws/rules-section-1.md").read_text(encoding="utf-8")
    assert "- Child clauses: [[rules-1.1]], [[rules-1.2]], [[rules-1.3]].\n\n## Retrieval Hints\n\n- Query by parent context" in section
    assert (out / "legal/definitions/listed-member.md").is_file()
    opened = list((out / "legal/unresolved-references").glob("*.md"))
    assert sorted(p.stem for p in opened) == ["act-7.2-higher-authority-than-1"]
    club = (out / "legal/clauses/bylaws/club-part-i-section-a-clause-2.md").read_text(encoding="utf-8")
    assert "subject_to:\n- club-part-i-section-b-clause-1\n" in club
    assert (out / ".raw/sources/club.pdf").is_file() and (out / ".raw/extraction/rules.md").read_text().startswith("# Fictional")
    assert b"\r" not in (out / "index.md").read_bytes()


def test_compiled_corpus_is_valid_and_passes_gold(spark, project, compiled):
    out, _ = compiled
    before = yaml.safe_load((out / "import-manifest.yaml").read_text(encoding="utf-8"))
    assert before["validation_status"] == "pending"
    result = jobs.validate_corpus(spark, str(out), update=True)
    after = yaml.safe_load((out / "import-manifest.yaml").read_text(encoding="utf-8"))
    assert after == before | {"validation_status": "passed"}
    paths = [e["path"] for e in after["files"]]
    assert paths == sorted(paths) and all((out / p).is_file() for p in paths)
    entries = M.manifest_entries(spark, str(out / "import-manifest.yaml")).collect()
    assert sorted((r.path, r.sha256, r.file_type) for r in entries) == sorted((e["path"], e["sha256"], e["file_type"]) for e in after["files"])
    assert (result["validation_status"], result["blocking_error_count"], result["warning_count"]) == ("passed", 0, 1), result["issues"]
    assert result["legal_clause_count"] == 15 and result["provenance_count"] == 9
    assert "Validation status: passed" in jobs.corpus_report(spark, str(out))
    gold = jobs.gold_evaluation(spark, str(out), str(project / "gold.yaml"), 8).collect()
    assert all(r.passed for r in gold), gold
    register = jobs.build_register(spark, str(out)).collect()
    assert [(r.warning_id, r.affected_clause) for r in register] == [("act-7.2-higher-authority-than-1", "act-7.2")]
    pages = spark.createDataFrame(list(enumerate(PDF_PAGES, 1)), "page int, text string")
    assert jobs.write_register(spark, str(out), str(project / "register")) == {"metadata_only": True, "warning_count": 1}
    table = spark.read.text(str(project / "register" / "warning-register.md")).collect()
    assert [r.value.split(" | ")[1] for r in table] == ["act-7.2"]
    warned = str(project / "register" / "warning-register.json")
    audit = jobs.audit_corpus(spark, str(out), pages, "club", str(project / "audit"), warned)
    with open(project / "audit", newline="", encoding="utf-8") as handle:
        rows = list(csv.DictReader(handle))
    assert audit["reviewed"] == 15 and [r["card_id"] for r in rows] == sorted({r["card_id"] for r in rows}) and len(rows) == 15
    assert all(r["file_name"] == r["card_id"] + ".md" and r["verdict"] and r["hierarchy"].endswith(r["card_id"]) for r in rows)
    assert spark.read.json(str(project / "audit-summary")).first().reviewed == 15
    assert (out / ".raw/validation-issues").is_dir()


def test_extractions_are_reported(spark):
    from lexweave.sources import ocr_json, pdf

    files = spark.createDataFrame([("blank", b" \x0c "), ("good", b"a\x0cb"), ("bad", b"x!"), ("empty", b"")], "slug string, content binary")

    def reader(content):
        if b"!" in content:
            raise ValueError("broken")
        return content.decode().split("\f") if content else []

    found = {r.slug: r.category for r in pdf.pdf_errors(pdf.pdf_pages(files, reader)).collect()}
    assert found == {"blank": "partial_extraction", "bad": "pdf_corrupt_or_unsupported", "empty": "partial_extraction"}
    assert pdf.read_pages(b"x", (reader_that_fails, lambda content: ["ok"])) == ["ok"]
    with pytest.raises(ValueError, match="no; .*no"):
        pdf.read_pages(b"x", (reader_that_fails, reader_that_fails))
    slugs = spark.createDataFrame([("none",), ("odd",), ("two",), ("full",)], "slug string")
    text = '{"result":{"chunks":[{"content":"words"}]}}'
    answers = spark.createDataFrame([("odd", "{"), ("two", text), ("two", text), ("full", text), ("other", text)], "slug string, json string")
    blocks, warned = ocr_json.extract_responses(slugs, answers)
    assert {r.slug: r.w[0].category for r in warned.collect()} == {"none": "unknown_provider_error", "odd": "provider_validation", "two": "provider_validation"}
    assert [r.slug for r in blocks.collect()] == ["full"]


def reader_that_fails(content):
    raise RuntimeError("no")


@pytest.mark.parametrize(
    "change, category",
    [
        (lambda d: (d / "legal/clauses/bylaws/rules-section-1.md").unlink(), {"broken_wikilink", "missing_parent", "manifest_file"}),
        (lambda d: edit(d / "legal/clauses/bylaws/rules-1.1.md", "slug: rules-1.1\n", "slug: rules-1.2\n"), {"duplicate_slug", "manifest_hash"}),
        (lambda d: edit(d / "legal/clauses/bylaws/rules-1.1.md", "jurisdiction: Sample Club\n", ""), {"missing_required_field", "manifest_hash"}),
        (lambda d: edit(d / "index.md", "---\n", "", 1), {"frontmatter", "broken_wikilink", "manifest_hash"}),
        (lambda d: (d / "import-manifest.yaml").unlink(), {"manifest_file"}),
    ],
)
def test_damage_is_found(spark, compiled, tmp_path, change, category):
    copy = tmp_path / "copy"
    shutil.copytree(compiled[0], copy)
    change(copy)
    result = jobs.validate_corpus(spark, str(copy))
    assert result["validation_status"] == "failed"
    errors = {i["category"] for i in result["issues"] if i["severity"] == "error"}
    assert errors <= category and errors, result["issues"]


def edit(path: Path, old: str, new: str, count: int = -1):
    text = path.read_text(encoding="utf-8")
    assert old in text
    path.write_text(text.replace(old, new, count), encoding="utf-8")


@pytest.mark.parametrize(
    "change",
    [
        {"effective_date": None, "metadata_notes": ["reviewed_by open"]}, {"authority_rank": "40"}, {"status": "pending"},
        {"colour": "red"}, {"owner": ...},
    ],
)
def test_manifest_errors(spark, tmp_path, change):
    entry = manifest_entries()[0] | change
    entry = {k: v for k, v in entry.items() if v is not ...}
    path = tmp_path / "manifest.yaml"
    path.write_text(yaml.safe_dump({"documents": [entry]}), encoding="utf-8")
    with pytest.raises(ManifestError):
        load_manifest(spark, str(path))


def test_source_path_must_stay_inside(spark, project, tmp_path):
    path = tmp_path / "manifest.yaml"
    path.write_text(yaml.safe_dump({"documents": [manifest_entries()[0] | {"source_path": "../outside.md"}]}), encoding="utf-8")
    with pytest.raises(jobs.CompileError, match="escapes"):
        jobs.compile_corpus(spark, str(path), str(project), str(tmp_path / "out"))


def test_frontmatter_reading():
    assert read_frontmatter("no fence")["error"] and read_frontmatter("---\na: 1\n")["error"]
    assert read_frontmatter("---\n- 1\n---\nx")["error"] == "frontmatter must parse to a mapping"
    assert read_frontmatter("---\na: [\n---\nx")["error"] == "has invalid YAML frontmatter"
    page = read_frontmatter("---\na: text\nb: [x, 2]\nc: null\nd: 2020-01-01\n---\nbody\nmore")
    assert page["kinds"] == {"a": "string", "b": "list", "c": "null", "d": "other"}
    assert (page["lists"], page["search"], page["body"]) == ({"b": ["x"]}, "text\nx\n2", "body\nmore")


def test_init_refuses_a_used_folder(tmp_path):
    assert init(str(tmp_path / "new")) == 0 and init(str(tmp_path / "new")) == 1
