import random
import zlib

import numpy as np
import pytest

from lexweave.llm import language as lg

DOCS = "doc_id long, text string, lang string, source string, lang_pred string, place double"
#: Word parts of four made-up languages in two families that look alike within a family.
PARTS = {
    "en": "the and ing wh ly ough tion ed th er",
    "de": "der und ung sch lich keit ge en ch er",
    "fr": "les que eau oux ment tion le ai on es",
    "es": "los que ión ado mente ción el ar os as",
}


def text(seed, lang, n):
    made = random.Random(f"{seed}{lang}")
    return " ".join("".join(made.choices(PARTS[lang].split(), k=made.randint(1, 4))) for _ in range(n))


def table(spark, rows):
    return spark.createDataFrame([(*r, "s", "clash", 1.0) for r in rows], DOCS)


def counts(t):
    """n-grams by their definition."""
    marks = "\0" + "".join(c if c.isalpha() else "\0" for c in t.lower()) + "\0"
    kept = "".join(c for i, c in enumerate(marks) if c != "\0" or i == 0 or marks[i - 1] != "\0")
    found = {}
    for i in range(1, len(kept)):
        for n in range(1, min(4, i + 1) + 1):
            gram = kept[i - n + 1 : i + 1]
            found[gram] = found.get(gram, 0) + 1
    return found


@pytest.mark.parametrize("chunk", [1, 2, 7, 1 << 20])
@pytest.mark.parametrize("t", ["Hello, wörld!! x", "..a..", "ab", "\U00010400\U0001f600 日本", "x" * 50 + " . "])
def test_features_count_the_grams_of_whole_texts(monkeypatch, chunk, t):
    monkeypatch.setattr(lg, "CHUNK", chunk)
    place, value = lg.features(t)
    total = sum(counts(t).values())
    want = np.zeros(lg.DIMENSIONS)
    for gram, n in counts(t).items():
        codes = np.array([ord(c) for c in gram], np.uint32)
        code = np.zeros(1, np.uint32)
        for k, c in enumerate(codes[::-1]):
            code = code + (np.array([c], np.uint32) + np.uint32(k + 1)) * lg.MIX[k]
        want[int(((code ^ code >> np.uint32(15)) * np.uint32(0x2C1B3C6D) >> np.uint32(17))[0])] += n
    got = np.zeros(lg.DIMENSIONS)
    got[place] = value**2 * total
    assert np.allclose(got, want) and abs((value**2).sum() - 1) < 1e-9


def test_no_letters():
    for t in (None, "", " \n", "12 ?! \U0001f600"):
        assert len(lg.features(t)[0]) == 0


def test_families():
    assert [lg.family(x) for x in ("en", "de-AT", "pt_BR", "zz", "")] == ["germanic", "germanic", "romance", "only zz", "only "]


def test_votes_and_ties():
    # three names, features pick the margins: a beats b, b beats c, c beats a
    m = lg.Machines(["a", "b", "c"], np.array([[1.0, -1.5, 1.0]]), np.zeros(3))
    assert m.decide(np.array([0]), np.array([1.0]))[0] == "c"
    assert lg.Machines(["a"], np.zeros((1, 0)), np.zeros(0)).decide(np.array([0]), np.array([1.0])) == ("a", 1.0)


def test_languages_are_learned_and_held_out_texts_found(spark):
    rows = [(i, text(i, lang, 1 + i % 60), lang) for i, lang in enumerate(list(PARTS) * 60)]
    rows += [(5000, None, "en"), (5001, "", "en"), (5002, "1234 !!", None), (None, text(1, "fr", 30), "fr"), (5003, text(9, "de", 8000), None)]
    rows += [rows[3], rows[3]]
    got = lg.identify(table(spark, rows), sample=100).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    truth = {i: lang for i, _, lang in rows[:240]}
    unseen = [i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2]
    assert [i for i in truth if by[i]["held_out"]] == unseen
    assert sum(by[i]["lang_pred"] == truth[i] for i in unseen) >= 0.9 * len(unseen)
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 for i in (5000, 5001, 5002))
    assert by[None]["lang_pred"] == "fr" and not by[None]["held_out"] and by[5003]["lang_pred"] == "de"
    assert all(0 <= r["score"] <= 1 for r in got)


def test_labels_of_held_out_documents_are_not_read(spark):
    rows = [(i, text(i, lang, 20), lang) for i, lang in enumerate(list(PARTS) * 20)]
    other = [(i, t, "xx" if zlib.crc32(str(i).encode()) % 4 == 2 else lang) for i, t, lang in rows]
    find = lambda rows: sorted(map(tuple, lg.identify(table(spark, rows), sample=30).collect()))
    assert find(rows) == find(other)


def test_one_language_none_and_empty(spark):
    assert {r["lang_pred"] for r in lg.identify(table(spark, [(i, "abc def", "en") for i in range(8)])).collect()} == {"en"}
    assert [tuple(r) for r in lg.identify(table(spark, [(1, "abc", None)])).collect()] == [(1, False, "und", 0.0)]
    assert lg.identify(table(spark, [])).collect() == []


def test_the_sample_is_bounded(spark):
    rows = [(i, f"t{i}", "en" if i % 50 else "de") for i in range(1000)]
    got = lg.drawn(table(spark, rows).select("doc_id", "text", "lang"), 40).groupBy("lang").count().collect()
    assert {r["lang"]: r["count"] for r in got} == {"en": 40, "de": 20}
