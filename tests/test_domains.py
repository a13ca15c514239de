import pytest

from lexweave.operators import domains as D

GOOD = {"document_type": "bylaw", "status": "active", "confidentiality": "public", "slug": "a.b-c_1", "sync_eligibility": None, "profile": None}


def issues(spark, rows, record="document", rules=None, types=None):
    names = list(rows[0])
    schema = ", ".join(f"`{n}` {(types or {}).get(n, 'string')}" for n in names)
    df = spark.createDataFrame([(str(i), *r.values()) for i, r in enumerate(rows)], f"key string, {schema}")
    return sorted((r["key"], r["field"], r["rule"], r["value"]) for r in D.domain_issues(df, record, "key", rules).collect())


def test_documents(spark):
    rows = [
        GOOD, GOOD | {"document_type": "Bylaw"}, GOOD | {"status": None}, GOOD | {"profile": "student_bylaws_v1"}, GOOD | {"profile": "POLICY"}, GOOD | {"profile": "other"},
        GOOD | {"sync_eligibility": "now"}, GOOD | {"slug": "../up"}, GOOD | {"slug": "a\n"}, GOOD | {"slug": "", "confidentiality": "secret"},
    ]
    assert issues(spark, rows) == [
        ("1", "document_type", "one_of", "Bylaw"), ("2", "status", "one_of", None), ("5", "profile", "matches", "other"), ("6", "sync_eligibility", "one_of", "now"),
        ("7", "slug", "matches", "../up"), ("8", "slug", "matches", "a\n"), ("9", "confidentiality", "one_of", "secret"), ("9", "slug", "matches", ""),
    ]


def test_hashes_and_absent_fields(spark):
    good = "0123456789abcdef" * 4
    rows = [{"sha256": good}, {"sha256": good.upper()}, {"sha256": good[1:]}, {"sha256": good + "\n"}, {"sha256": None}]
    found = issues(spark, rows, "file")
    assert [f for f in found if f[1] == "file_type"] == [(str(i), "file_type", "one_of", None) for i in range(5)]
    assert [f[0] for f in found if f[1] == "sha256"] == ["1", "2", "3", "4"]


def test_lists_and_unknown_fields(spark):
    rules = [D.Constraint("row", "names", D.FIELDS, ("a", "b")), D.Constraint("row", "stems", D.EACH_MATCHES, D.SAFE_STEM, True)]
    rows = [{"names": ["a"], "stems": ["x"]}, {"names": ["b", "z", "c"], "stems": None}, {"names": [], "stems": ["ok", "no no", None]}]
    types = {"names": "array<string>", "stems": "array<string>"}
    assert issues(spark, rows, "row", rules, types) == [("1", "names", "fields", "c,z"), ("2", "stems", "each_matches", "no no,null")]


def test_all_domains_are_there_and_unknown_kinds_fail(spark):
    assert len({(c.record, c.field) for c in D.CONSTRAINTS if c.kind == D.ONE_OF}) == 15
    with pytest.raises(ValueError):
        issues(spark, [GOOD], "nothing")
    with pytest.raises(ValueError):
        issues(spark, [GOOD], "document", [D.Constraint("document", "slug", "odd", "")])
