import json

import pytest

from lexweave.sources.register import read_register

ROWS = [
    {"affected_clause": "c1", "warning_id": "w1"}, {"affected_clause": "", "clause_id": "c2", "id": "w2"}, {"affected_clause_id": "c3", "source_clause": "x", "warning_id": "w3"},
    {"source_clause": "c4", "warning_id": "", "id": 4}, {"warning_id": "w5"}, {"affected_clause": "c6"}, {"affected_clause": None, "source_clause": "c7", "id": "w7", "note": [1, {"a": 2}]},
]
LINKS = [("c1", "w1"), ("c2", "w2"), ("c3", "w3"), ("c4", "4"), ("c7", "w7")]
TABLE = "# Register\n\n| Warning ID | Clause | Type |\n|---|:--|---|\n| w1 | c1 | read_with |\n|w2|c2|\n| | c3 | x |\n| w4 |\ntext | w5 | c5 |\n| w6 | c6 | a | b |\n"
TABLE_LINKS = [("c1", "w1"), ("c2", "w2"), ("c6", "w6")]


def links(spark, path):
    return sorted(map(tuple, read_register(spark, str(path)).collect()))


@pytest.mark.parametrize("form", ["rows", "list", "pretty", "warnings", "items", "one"])
def test_json_in_all_its_forms(spark, tmp_path, form):
    data = {"list": ROWS, "pretty": ROWS, "warnings": {"n": 7, "warnings": ROWS}, "items": {"items": ROWS}, "one": ROWS[0]}.get(form)
    text = "\n".join(map(json.dumps, ROWS)) if form == "rows" else json.dumps(data, indent=2 if form == "pretty" else None)
    (tmp_path / "register.json").write_text(text)
    (tmp_path / "register.md").write_text(TABLE)
    assert links(spark, tmp_path / "register.json") == (LINKS[:1] if form == "one" else LINKS)


@pytest.mark.parametrize("text", [None, "", "[]", "{}", "not json", '[{"affected_clause": "c1"}]'])
def test_markdown_where_json_gives_nothing(spark, tmp_path, text):
    if text is not None:
        (tmp_path / "register.json").write_text(text)
    (tmp_path / "register.md").write_text(TABLE)
    for name in ("register", "register.json", "register.md"):
        assert links(spark, tmp_path / name) == TABLE_LINKS


def test_no_register(spark, tmp_path):
    assert links(spark, tmp_path / "none") == []
