import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lexweave.llm import token_files as tf
from tests.llm.helpers import docs, odd_texts, prose

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("values", [[], [0], [0, 0, 0], [5], list(range(300)), [0] * 200 + [10**12], [2**40 + i * i for i in range(500)]])
def test_elias_fano(values):
    made = tf.EliasFano.from_bytes(tf.EliasFano.of(np.array(values, np.int64)).to_bytes())
    assert made.values().tolist() == values
    assert [made.select(i) for i in range(len(values))] == values
    with pytest.raises(IndexError):
        made.select(len(values))


def test_elias_fano_space():
    values = np.sort(np.random.default_rng(1).integers(0, 1 << 30, 20_000))
    bits = 8 * len(tf.EliasFano.of(values).to_bytes())
    assert bits < 20_000 * (2 + np.log2((1 << 30) / 20_000) + 1.5)
    made = tf.EliasFano.of(values)
    assert all(made.select(int(i)) == values[i] for i in np.random.default_rng(2).integers(0, 20_000, 500))


def test_round_trip(spark, tmp_path):
    texts = [*odd_texts(), "a\t b\n\n  c", " x", "x \n", "it's, done.", *(prose(s, 200) for s in range(8))]
    table = docs(spark, texts, start=-4).unionAll(spark.createDataFrame([(None, "null id", "en", "s", 7)], "doc_id long, text string, lang string, source string, n_chars long"))
    files = tf.write_tokens(table.repartition(3), str(tmp_path / "t"), PATH, 2, file_text=4000)
    found = sorted(tf.read_tokens(files, with_ids=True).collect(), key=lambda r: r["start"])
    own = Tokenizer.from_file(PATH)
    want = [(None, "null id"), *((i - 4, t) for i, t in enumerate(texts))]
    at = 0
    for r, (doc, text) in zip(found, want, strict=True):
        ids = own.encode(text or "", add_special_tokens=False).ids + [2]
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids"]) == (doc, at, len(ids), ids)
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    paths = sorted(r["uri"] for r in files.collect() if r["n_docs"])
    assert len(paths) > 1
    last = tf.TokenFile(paths[-1])
    assert last.doc_id(len(last) - 1) == len(texts) - 5 and last.ids(len(last) - 1).tolist() == found[-1]["ids"]


def test_edges(spark, tmp_path):
    empty = docs(spark, [])
    assert tf.token_table(empty, PATH).count() == 0
    same = docs(spark, ["same text"] * 3).selectExpr("1L as doc_id", "text", "'x' as part", "'y' as text_hash")
    found = tf.token_table(same, PATH).collect()
    assert sorted(r["start"] for r in found) == [0, 3, 6] and {r["doc_id"] for r in found} == {1}
    assert tf.write_file(str(tmp_path / "f"), iter([(3, np.array([70000, 1], "<u4").tobytes())]), 4) == (1, 2)
    assert tf.TokenFile(str(tmp_path / "f")).ids(0).tolist() == [70000, 1]
    (tmp_path / "bad").write_bytes(b"LWTOKEN1" + b"\0" * 80)
    with pytest.raises(ValueError, match="no complete"):
        tf.TokenFile(str(tmp_path / "bad"))
