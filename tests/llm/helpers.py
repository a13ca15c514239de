"""Small tables and brute-force versions for the tests of the corpus operators."""

import random
import re

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, start=0, source=None):
    rows = [(start + i, t, "en", source(i) if source else "s0", None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def prose(seed, n_words):
    made = random.Random(seed)
    return " ".join("".join(made.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(made.randint(2, 8))) for _ in range(n_words))


def odd_texts():
    """Null, empty, blank, very long, repeated and unusual texts."""
    return [None, "", " \n\t ", "one", "one two", "Ab\x0bcd\x85ef gh", "word " * 3000, prose(1, 400), prose(1, 400), "\U0001f600 日本語\n\n x\r\ny"]


def fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: bytes([m[0][0] + 32]), (text or "").encode()))
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes, linked):
    """Smallest node reachable from each node, by comparing all pairs."""
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a in nodes:
            for b in nodes:
                if a < b and linked(a, b) and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return label


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.select(*columns).collect())
