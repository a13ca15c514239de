"""Language identification in two steps: the family of a language first, then the language within its family.

A text is the square roots of the shares of its letter n-grams (one to four letters, with one mark for any run of
other characters), hashed to DIMENSIONS places. Families, and the languages within each family, are told apart by
one-versus-one linear support vector machines: each votes for one of its two sides, most votes win, equal votes are
decided by the sum of margins and then by name.

The machines are fitted by Spark on a bounded sample: at most `sample` documents of each language, drawn by a hash of
doc_id over all of them, and from each as many short pieces as SHORT names, so that short texts are learned too.
Everything else covers all documents and whole texts. The model's size does not depend on the corpus: 128 kB for each
pair of families and each pair of languages within a family.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LinearSVC
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexweave.llm.common import materialize, small_batches

#: Families of languages by ISO 639-1 code. A language not listed is a family of its own.
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nl nn no sv yi",
    "romance": "ca co es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd gv kw",
    "hellenic": "el",
    "indo-aryan": "as bn gu hi mr ne or pa sa sd si ur",
    "iranian": "fa ku ps tg",
    "uralic": "et fi hu se",
    "turkic": "az kk ky tk tr tt ug uz",
    "semitic": "am ar he mt ti",
    "dravidian": "kn ml ta te",
    "austronesian": "fj haw id jv mg mi ms sm su tl",
    "sinitic": "yue zh",
    "japonic": "ja",
    "koreanic": "ko",
    "kra-dai": "lo th",
    "austroasiatic": "km vi",
    "bantu": "lg ln nd ny rn rw sn st sw tn ts xh zu",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

DIMENSIONS = 1 << 15
LONGEST = 4
#: Documents of a language that are learned from, at most, and the numbers of words of the pieces cut from each.
SAMPLE, SHORT = 1500, (1, 3, 10)
ITERATIONS, REGULARISATION = 40, 1e-4
#: Characters worked on at once.
CHUNK = 1 << 20
UNKNOWN = "und"
#: Odd multipliers of the letters of an n-gram, from its last letter back.
MIX = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F], np.uint32)


class Letters:
    """Which code points are letters; made once per worker."""

    table: np.ndarray | None = None

    @classmethod
    def of(cls, codes: np.ndarray) -> np.ndarray:
        if cls.table is None:
            cls.table = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
        return cls.table[codes]


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of a whole text's vector, whose squares add up to 1; none without letters."""
    count = np.zeros(DIMENSIONS, np.int64)
    text = (text or "").lower()
    letters, carry = 0, np.zeros(1, np.uint32)
    for at in range(0, len(text), CHUNK):
        codes = np.frombuffer(text[at : at + CHUNK].encode("utf-32-le", "surrogatepass"), "<u4")
        letter = Letters.of(codes)
        letters += int(np.count_nonzero(letter))
        codes = np.where(letter, codes, 0).astype(np.uint32)
        whole = np.concatenate([carry, codes])
        # a run of other characters is one mark
        new = np.concatenate([np.ones(len(carry), bool), (codes != 0) | (whole[len(carry) - 1 : -1] != 0)])
        count += grams(whole[new], len(carry))
        carry = whole[new][-LONGEST + 1 :]
    if not letters:
        return np.zeros(0, np.int32), np.zeros(0)
    if carry[-1]:
        count += grams(np.append(carry, np.uint32(0)), len(carry))
    place = np.flatnonzero(count)
    return place.astype(np.int32), np.sqrt(count[place] / count.sum())


def grams(codes: np.ndarray, known: int) -> np.ndarray:
    """Counts of the hashed n-grams that end behind the first `known` codes."""
    found, code = [], np.zeros(len(codes), np.uint32)
    for n in range(LONGEST):
        if n >= len(codes):
            break
        code = code[1:] if n else code
        code = code + (codes[: len(codes) - n] + np.uint32(n + 1)) * MIX[n]
        made = code[max(0, known - n) :]
        found.append((made ^ made >> np.uint32(15)) * np.uint32(0x2C1B3C6D) >> np.uint32(17))
    return np.bincount(np.concatenate(found), minlength=DIMENSIONS) if found else np.zeros(DIMENSIONS, np.int64)


def family(lang: str) -> str:
    """Family of a language code such as en, en-GB or pt_BR."""
    return FAMILY_OF.get(lang.replace("_", "-").split("-")[0].lower(), f"only {lang}")


@dataclass(frozen=True)
class Machines:
    """One-versus-one machines between the names of one level; with a single name there are none."""

    names: list[str]
    weights: np.ndarray
    bias: np.ndarray

    def decide(self, place: np.ndarray, value: np.ndarray) -> tuple[str, float]:
        """The name that wins and the logistic of its least margin."""
        if len(self.names) == 1:
            return self.names[0], 1.0
        margins = value @ self.weights[place] + self.bias
        votes, sums = np.zeros(len(self.names)), np.zeros(len(self.names))
        least = np.full(len(self.names), np.inf)
        for margin, (a, b) in zip(margins, itertools.combinations(range(len(self.names)), 2)):
            votes[a if margin > 0 else b] += 1
            for side, m in ((a, margin), (b, -margin)):
                sums[side] += m
                least[side] = min(least[side], m)
        best = max(range(len(self.names)), key=lambda k: (votes[k], sums[k], -k))
        return self.names[best], float(1 / (1 + np.exp(-2 * least[best])))


@dataclass(frozen=True)
class LanguageModel:
    families: Machines | None
    within: dict[str, Machines]

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language of a whole text and a score from 0 to 1; UNKNOWN and 0 where it has no letter or nothing was learned."""
        place, value = features(text)
        if self.families is None or not len(place):
            return UNKNOWN, 0.0
        group, sure = self.families.decide(place, value)
        lang, surer = self.within[group].decide(place, value)
        return lang, sure * surer


def held_out() -> Column:
    """Whether a document is kept from learning: crc32 of doc_id as text, mod 4, is 2; false for a null doc_id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def drawn(rows: DataFrame, sample: int) -> DataFrame:
    """At most `sample` rows of each lang, those with the smallest hashes of doc_id.

    Counts come first, so that a hash bound leaves a small multiple of the sample before any text is moved or sorted.
    """
    space = 1 << 30
    bound = rows.groupBy("lang").agg(F.least(F.lit(float(space)), F.ceil(F.lit(4.0 * sample * space) / F.count("*"))).alias("bound"))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(space))
    near = rows.withColumn("place", place).join(materialize(bound, "languages"), "lang").where("place <= bound")
    first = Window.partitionBy("lang").orderBy("place", "doc_id", "text")
    return near.withColumn("k", F.row_number().over(first)).where(F.col("k") <= sample).select("lang", "text")


def examples(rows: DataFrame) -> DataFrame:
    """lang, place and value of each text and of short pieces of it; texts without letters are left out."""

    def pieces(text: str) -> Iterator[str]:
        yield text
        words = text.split()
        for k, size in enumerate(SHORT):
            at = len(text) * (k + 1) % max(1, len(words) - size + 1)
            yield " ".join(words[at : at + size])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [(lang, *features(piece)) for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for piece in pieces(text)]
            made = [row for row in made if len(row[1])]
            langs, places, values = zip(*made) if made else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(places, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float64()))], ["lang", "place", "value"]
            )

    return rows.mapInArrow(work, "lang string, place array<int>, value array<double>")


def machines(rows: DataFrame, names: list[str]) -> Machines:
    """Machines between all pairs of names from rows (name, vector)."""
    weights, bias = [], []
    svm = LinearSVC(featuresCol="vector", maxIter=ITERATIONS, regParam=REGULARISATION, standardization=False, tol=1e-5)
    for a, b in itertools.combinations(names, 2):
        two = rows.where(F.col("name").isin(a, b)).select((F.col("name") == a).cast("double").alias("label"), "vector")
        fitted = svm.fit(two)
        weights.append(fitted.coefficients.toArray().astype(np.float32))
        bias.append(fitted.intercept)
    return Machines(names, np.array(weights, np.float32).reshape(-1, DIMENSIONS).T.copy(), np.array(bias))


def fit(docs: DataFrame, sample: int = SAMPLE) -> LanguageModel:
    """Learn from the text and lang of docs; rows without either are left out."""
    small_batches(docs.sparkSession)
    rows = docs.select("doc_id", "text", "lang").where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    learned = materialize(examples(drawn(rows, sample)), "examples")
    langs = sorted(r["lang"] for r in learned.select("lang").distinct().collect())
    if not langs:
        return LanguageModel(None, {})
    vector = F.udf(lambda place, value: SparseVector(DIMENSIONS, place, value), VectorUDT())
    learned = learned.withColumn("vector", vector("place", "value"))
    groups = {g: sorted(lang for lang in langs if family(lang) == g) for g in sorted({family(lang) for lang in langs})}
    named = F.create_map(*(F.lit(x) for lang in langs for x in (lang, family(lang))))
    families = machines(learned.withColumn("name", named[F.col("lang")]), list(groups))
    return LanguageModel(families, {g: machines(learned.withColumn("name", F.col("lang")), members) for g, members in groups.items()})


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row, from its whole text alone."""
    small_batches(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = zip(*map(model.predict, batch.column(2).to_pylist())) if batch.num_rows else ((), ())
            columns = [batch.column(0), batch.column(1), pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), "text")
    return rows.mapInArrow(work, "doc_id long, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Languages of all documents, learned from those that are not held out.

    A null text or one without a letter is UNKNOWN with score 0, as is every text if nothing could be learned. Repeated
    rows stay. Other columns are not read. Empty input, empty result.
    """
    return predict(docs, fit(docs.where(~held_out()), sample))
