import re

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from lexweave.llm import mixing, quality, secrets
from tests.llm.helpers import components, docs, fingerprint, prose
from tests.llm.test_mixing import drawn, quantile

SECRET = 'token = "0123456789abcdef0123"'


def corpus():
    good = ["\n".join(prose(40 * s + k, 15) + "." for k in range(6)) for s in range(40)]
    good[3] += f"\n{SECRET}"
    junk = [prose(s, 80).replace(" ", "### ") for s in range(900, 904)]
    return good + junk + good[:10] + ["too short", None, ""]


def test_stages_and_run(spark, tmp_path):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "secret_scan", "source_mix", "pack"]
    texts = corpus()
    docs(spark, texts, source=lambda i: f"s{i % 2}").write.parquet(str(tmp_path / "documents.parquet"))
    held = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns = held.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        held = stage(spark, held, str(tmp_path))
        assert held.columns == columns, name
        held.write.parquet(str(tmp_path / name))
        held = spark.read.parquet(str(tmp_path / name))
    # brute force: good documents, first of equal ones, without secrets, repeated by their drawn numbers
    prints = {i: fingerprint(t) for i, t in enumerate(texts) if i < 40 or 44 <= i < 54}
    kept = sorted(set(components(list(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3).values()))
    clean = {i: texts[i].replace(SECRET, '<SECRET>"') for i in kept}
    n = {s: sum(i % 2 == s for i in kept) for s in (0, 1)}
    scale = len(kept) / sum(v**0.5 for v in n.values())
    copies = {i: quantile(drawn("0", i), scale * n[i % 2] ** 0.5 / n[i % 2]) for i in kept}
    assert sorted((r["doc_id"], r["text"], r["n_chars"]) for r in held.collect()) == sorted((i, clean[i], len(clean[i])) for i in kept for _ in range(copies[i]))
    own = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = sorted((i, len(own.encode(clean[i], add_special_tokens=False).ids) + 1) for i in kept for _ in range(copies[i]))
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r["doc_id"], r["length"]) for r in packed) == want
    assert len({r["sequence_id"] for r in packed}) <= -(-sum(w for _, w in want) // 2048) + 1


def test_native_stages_have_no_python(spark):
    table = docs(spark, corpus(), source=lambda i: f"s{i % 2}")
    for made in (quality.score(table), quality.keep_good(table), secrets.scan(table, F.col("source"), F.col("source")), secrets.redact(table, F.col("source"), F.col("source")), mixing.mix(table)):
        assert not re.search("Python|Pandas|Arrow", made._jdf.queryExecution().toString())


def test_empty_documents(spark, tmp_path):
    docs(spark, []).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
