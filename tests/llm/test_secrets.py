import hashlib
import re

from pyspark.sql import functions as F

from lexweave.llm import secrets
from tests.llm.helpers import docs, odd_texts, prose

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
HEX = "0123456789abcdef0123"
KEY = "AKIA" + "Q7" * 8
BARE = "aB3" * 9


def base(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    return sorted(found + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16])


TEXTS = [
    *odd_texts(),
    f"\U0001f600 Token = '{HEX}' and {KEY} é{HEX}",
    "token: secret = abcdefghijklmnop",
    "password==abcdefghijklm PASSWD : short",
    f"api_key:{'x' * 12} apikey='{'y' * 11}' {KEY}{KEY}",
    f"AKIAAKIA{'A' * 9} {HEX}g{HEX}",
    f"{prose(1, 3000)} secret=\"{BARE}\"",
]


def scan(table):
    return secrets.digest(secrets.scan(table, F.concat_ws("/", "source", "lang"), F.col("source")))


def test_base_spans(spark):
    found = {r["doc_id"]: r for r in scan(docs(spark, TEXTS)).collect()}
    assert len(found) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        want = base(text)
        listed = ",".join(f"{secrets.BASE_KINDS[k]}:{a}:{b}" for a, k, b in want)
        assert found[i]["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest(), text
        assert tuple(found[i][f"n_{n}"] for n in secrets.BASE_KINDS) == tuple(sum(k == j for _, k, _ in want) for j in range(3))
        assert {s for s in listed.split(",") if s} <= set(found[i]["spans"].split(","))


def test_ownership_separates_examples(spark):
    texts = [f"use {BARE} here", f"use {BARE} here", f"see {BARE[::-1]} now", f"{HEX}", f"{HEX}"]
    table = docs(spark, texts, source=lambda i: ("a", "b", "a", "a", "b")[i]).withColumn("row", F.lit("clash"))
    found = {r["doc_id"]: r for r in scan(table).collect()}
    assert [found[i]["spans"] for i in range(3)] == ["", "", "bare:4:31"]
    assert (found[3]["n_examples"], found[3]["n_owned"], found[2]["n_owned"]) == (1, 0, 1)
    clean = secrets.redact(table, F.col("source"), F.col("source"))
    assert clean.columns == table.columns
    assert {r["doc_id"]: r["text"] for r in clean.collect()} == {0: texts[0], 1: texts[1], 2: "see <SECRET> now", 3: "<EXAMPLE_KEY>", 4: "<EXAMPLE_KEY>"}


def test_redaction(spark):
    table = docs(spark, TEXTS)
    made = {r["doc_id"]: r for r in secrets.redact(table.unionAll(table), F.col("source"), F.col("source")).collect()}
    for i, text in enumerate(TEXTS):
        if not base(text) and "bare" not in (scan(docs(spark, [text])).first()["spans"] if i > 9 else ""):
            assert made[i]["text"] == text
            continue
        assert not base(made[i]["text"]) and made[i]["n_chars"] == len(made[i]["text"])
    assert made[10]["text"] == "\U0001f600 <SECRET>' and <SECRET> é<SECRET>"
    assert secrets.redact(table.unionAll(table), F.col("source"), F.col("source")).count() == 2 * len(TEXTS)


def test_empty(spark):
    empty = docs(spark, [])
    assert scan(empty).count() == 0 and secrets.redact(empty, F.lit("r"), F.lit("o")).count() == 0
