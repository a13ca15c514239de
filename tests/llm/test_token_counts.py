import random

import public_tokenizers
from tokenizers import Tokenizer, models

from lexweave.llm.token_counts import SPACE, Counter, count_tokens, vocabulary
from tests.llm.helpers import docs, odd_texts, prose

PATH = public_tokenizers.path("piece_bpe_32k.model")


def library(pieces):
    return Tokenizer(models.Unigram([("<unk>", 0.0), *pieces], unk_id=0, byte_fallback=False))


def expected(tokenizer, text):
    return len(tokenizer.encode(SPACE + text.replace(" ", SPACE)).ids) if text else 0


def test_counts_equal_the_library(spark):
    texts = [*odd_texts(), " lead", "trail  ", "a  b", "   ", *(prose(s, 60) for s in range(20))]
    own = library(vocabulary(PATH))
    found = {r["doc_id"]: r["n_tokens"] for r in count_tokens(docs(spark, texts), PATH).collect()}
    assert found == {i: expected(own, t or "") for i, t in enumerate(texts)}
    assert count_tokens(docs(spark, []), PATH).count() == 0


def test_ties_and_unknowns_equal_the_library():
    draw = random.Random(1)
    for _ in range(200):
        pieces = list({"".join(draw.choice("abc" + SPACE) for _ in range(draw.randint(1, 4))): float(draw.randint(-4, -1)) for _ in range(draw.randint(1, 12))}.items())
        counter, own = Counter(pieces), library(pieces)
        counter.unknown = min(0.0, *(s for _, s in pieces)) - 10  # the library counts its unknown piece, of score 0, too
        for _ in range(10):
            text = "".join(draw.choice("abcd ") for _ in range(draw.randint(1, 15)))
            assert counter.count(text) == expected(own, text)
    assert Counter([]).count("ab c") == 1
