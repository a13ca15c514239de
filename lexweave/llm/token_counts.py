"""Token counts by a count-only Viterbi search over a unigram vocabulary.

An Aho-Corasick automaton lists the vocabulary pieces at every place of a text; dynamic programming over places carries
the best score and its number of tokens, and no path. Ties are those of the tokenizers library's unigram model: starts
are tried in rising order and a later one wins only with a strictly higher score, so the longest of equal pieces stays.
A character that no single-character piece covers is an unknown token; neighbouring unknown tokens are one.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexweave.llm.common import small_batches

SPACE = "▁"
#: What an unknown character scores below the lowest piece (a fixed value of the unigram model).
UNKNOWN_PENALTY = 10.0


def vocabulary(path: str) -> list[tuple[str, float]]:
    """Ordinary pieces of a SentencePiece model file and their scores, in order of id."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    return [(model.id_to_piece(i), model.get_score(i)) for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]


class Counter:
    """Token counts of texts. A text is normalised to one SPACE for each space, with one in front.

    If SPACE is a piece and none has SPACE behind another character, a best path passes the front of every run of
    spaces, and the counts of words with the spaces before them add up. Counts of short words are remembered, at most
    `limit` of them.
    """

    made: dict = {}

    def __init__(self, pieces: list[tuple[str, float]], limit: int = 1_500_000):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        best: dict[str, float] = {}
        for piece, score in pieces:
            if piece:
                best.setdefault(piece, score)
        for piece, score in best.items():
            self.automaton.add_word(piece, (len(piece), score))
        if best:
            self.automaton.make_automaton()
        self.empty = not best
        self.unknown = min(best.values(), default=0.0) - UNKNOWN_PENALTY
        #: Texts are searched whole if a piece spans a word's front, or if SPACE is unknown and joins other unknown tokens.
        self.whole = SPACE not in best or any(SPACE in piece.lstrip(SPACE) for piece in best)
        self.limit, self.known = limit, {}

    @classmethod
    def of(cls, path: str) -> "Counter":
        if path not in cls.made:
            cls.made[path] = cls(vocabulary(path))
        return cls.made[path]

    def viterbi(self, text: str) -> int:
        """Tokens of the best path over an already normalised text."""
        n = len(text)
        ending: list[list] = [[] for _ in range(n + 1)]
        if not self.empty:
            for at, found in self.automaton.iter(text):
                ending[at + 1].append(found)  # longest first: starts rise
        # of the best path that ends at each place: score, tokens, and whether the last one is unknown
        score, tokens, open_end = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        for end in range(1, n + 1):
            top, count, odd = None, 0, False
            for length, value in ending[end]:
                start = end - length
                if start > 0 and tokens[start] == 0:
                    continue
                reached = score[start] + value
                if top is None or reached > top:
                    top, count, odd = reached, tokens[start] + 1, False
            if not ending[end] or ending[end][-1][0] > 1:
                reached = score[end - 1] + self.unknown
                if top is None or reached > top:
                    top, count, odd = reached, tokens[end - 1] + (not open_end[end - 1]), True
            score[end], tokens[end], open_end[end] = top, count, odd
        return tokens[n]

    def count(self, text: str) -> int:
        if not text:
            return 0
        if self.whole:
            return self.viterbi(SPACE + text.replace(" ", SPACE))
        if len(self.known) > self.limit:
            self.known.clear()
        known, total, blank = self.known, 0, ""
        for word in text.split(" "):
            piece = blank + SPACE + word
            if not word:
                blank += SPACE
                continue
            blank = ""
            held = known.get(piece)
            if held is None:
                held = self.viterbi(piece)
                if len(piece) <= 64:
                    known[piece] = held
            total += held
        return total + (self.viterbi(blank) if blank else 0)


def count_tokens(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id and n_tokens of every whole text; null or empty: 0. Repeated rows stay; empty input, empty result.

    model_path is a SentencePiece model file that every worker can read; its ordinary pieces and their scores are the
    unigram vocabulary.
    """
    small_batches(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter.of(model_path)
        for batch in batches:
            counts = [counter.count(text or "") for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], ["doc_id", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(work, "doc_id long, n_tokens long")
