"""Toxicity (operator 9): gradient-boosted trees over dense features, calibrated by isotonic regression.

Labelled rows that are not held out are dealt by the fold of their id: two folds yield the lexicon, one the trees, one
the calibration, so that no step learns from rows that an earlier one has fitted.

* The lexicon holds words, and beginnings of words, that occur in toxic rows far more often than by chance (a
  likelihood-ratio statistic that allows for the number of terms tried). It is bounded in size.
* Features of a text: densities of lexicon words and beginnings, how near they stand to words of the second
  person, capitals, punctuation, rates of obfuscated words and of those that hide a lexicon word, length.
* Spark ML trains the trees and the calibration; scoring is one pass over all whole texts.

Defined results: a null text counts as empty; empty texts get the score of their all-zero features. Without training rows of
both labels every score is the share of label 1 among them (0 without any). Rows without doc_id are scored and
count as not held out. Repeated rows are scored each. Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from countypanel.llm.common import held_out, stored, table, text_of, tidy, training_rows

#: At most so many labelled rows train lexicon, trees and calibration together.
TRAINING_ROWS = 16_000
LEXICON_TERMS = 600
THRESHOLD = 0.5

LEXICON_FOLDS, TREE_FOLD, CALIBRATION_FOLD = (1, 2), 3, 4
BEGINNINGS = (4, 5, 6)

# Words of the second person in English, German, French and Spanish.
SECOND_PERSON = [
    "you", "your", "yours", "yourself", "u", "ur", "du", "dich", "dir", "dein", "deine", "deiner", "ihr", "euch", "euer", "tu",
    "te", "toi", "ton", "ta", "tes", "vous", "votre", "vos", "tú", "ti", "tus", "usted", "ustedes", "vosotros", "vuestro",
]
# Letters that digits and signs stand for.
STAND_INS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})

FEATURES = [
    "word_density", "beginning_density", "hits", "nearness", "second_person", "capitals", "capital_words", "shouts",
    "punctuation", "obfuscated", "hidden_density", "length",
]

_EDGES = ".,;:!?\"'()[]{}<>*#%&$|-–—…«»“”‘’¿¡"
_MIXED = re.compile(r"[^\W\d_][\d@$!*.]+[^\W\d_]|(\w)\1\1")
_JUNK = re.compile(r"[^\w]|_")
_AGAIN = re.compile(r"(.)\1+")
_WORD, _BEGINNING, _PERSON, _CAPITAL, _OBFUSCATED, _HIDDEN = 1, 2, 4, 8, 16, 32
_CLASS = bytes(ord("U") if 65 <= b <= 90 else ord("x") if chr(b) in "!?" else ord("p") if b < 128 and not chr(b).isalnum() and not chr(b).isspace()
               else ord("o") for b in range(256))


class Measure:
    """The features of texts under one lexicon."""

    def __init__(self, words: list[str], beginnings: list[str], known_words: int = 100_000) -> None:
        self.words, self.beginnings = frozenset(words), frozenset(beginnings)
        self.folded = {_AGAIN.sub(r"\1", w): w for w in words}
        self.known: dict[str, int] = {}
        self.known_words = known_words

    def kind(self, raw: str) -> int:
        word = raw.strip(_EDGES).lower()
        out = 0
        if word in self.words:
            out |= _WORD
        elif any(word[:n] in self.beginnings for n in BEGINNINGS if len(word) > n):
            out |= _BEGINNING
        if word in SECOND_PERSON:
            out |= _PERSON
        if len(raw) > 1 and raw.isupper():
            out |= _CAPITAL
        if _MIXED.search(word):
            out |= _OBFUSCATED
            if not out & (_WORD | _BEGINNING):
                plain = _JUNK.sub("", word.translate(STAND_INS))
                bare = _JUNK.sub("", word)
                if plain in self.words or bare in self.words or _AGAIN.sub(r"\1", plain) in self.folded:
                    out |= _HIDDEN
        return out

    def features(self, text: str) -> list[float]:
        words = text.split()
        if len(self.known) > self.known_words:
            self.known.clear()
        known = self.known
        for w in set(words):
            if w not in known:
                known[w] = self.kind(w)
        marked = [(i, k) for i, k in enumerate(map(known.__getitem__, words)) if k]
        n = len(words) or 1
        count = {b: sum(1 for _, k in marked if k & b) for b in (_WORD, _BEGINNING, _PERSON, _CAPITAL, _OBFUSCATED, _HIDDEN)}
        hits = np.array([i for i, k in marked if k & (_WORD | _BEGINNING | _HIDDEN)])
        persons = np.array([i for i, k in marked if k & _PERSON])
        nearness = 0.0
        if len(hits) and len(persons):
            at = np.searchsorted(persons, hits)
            left = hits - persons[np.maximum(at - 1, 0)]
            right = persons[np.minimum(at, len(persons) - 1)] - hits
            nearness = float((1 / (1 + np.minimum(np.abs(left), np.abs(right)))).mean())
        raw = text.encode()
        kinds, size = raw.translate(_CLASS), len(raw) or 1
        return [
            count[_WORD] / n, count[_BEGINNING] / n, math.log1p(len(hits)), nearness, count[_PERSON] / n, kinds.count(b"U") / size,
            count[_CAPITAL] / n, kinds.count(b"x") / size, kinds.count(b"p") / size, count[_OBFUSCATED] / n, count[_HIDDEN] / n,
            math.log1p(len(words)),
        ]


def lexicon(rows: DataFrame, max_terms: int = LEXICON_TERMS) -> tuple[list[str], list[str]]:
    """The words and the beginnings of words that mark rows (text, label) of label 1; at most max_terms together."""
    words = F.array_distinct(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"))
    terms = [F.transform(words, lambda w: F.struct(F.lit(0).alias("n"), w.alias("term")))]
    for n in BEGINNINGS:
        longer = F.filter(words, lambda w, n=n: F.length(w) > n)
        terms.append(F.transform(F.array_distinct(F.transform(longer, lambda w, n=n: F.substring(w, 1, n))),
                                 lambda t, n=n: F.struct(F.lit(n).alias("n"), t.alias("term"))))
    total = rows.agg(F.count("*").alias("all"), F.sum("label").alias("ones")).first()
    if not total["all"] or total["ones"] in (0, total["all"]):
        return [], []
    base = total["ones"] / total["all"]
    counted = stored(
        rows.select("label", F.explode(F.concat(*terms)).alias("t")).where("t.term <> ''")
        .groupBy("t.n", "t.term").agg(F.count("*").alias("rows"), F.sum("label").alias("ones")).where("ones >= 3"), "terms",
    )
    tried = max(counted.count(), 2)
    ones, others = F.col("ones"), F.col("rows") - F.col("ones")
    gain = 2 * (ones * F.log(ones / (F.col("rows") * base))
                + F.when(others > 0, others * F.log(others / (F.col("rows") * (1 - base)))).otherwise(0.0))
    found = (
        counted.withColumn("gain", gain).where((ones > F.col("rows") * 0.6) & (F.col("gain") > 2 * math.log(tried) + 6))
        .orderBy(F.desc("gain"), "n", "term").limit(max_terms).collect()
    )
    return [r.term for r in found if r.n == 0], [r.term for r in found if r.n]


def measured(docs: DataFrame, terms: tuple[list[str], list[str]], keep: list[str]) -> DataFrame:
    """The columns keep and the features of every row of docs (text must not be null)."""
    schema = StructType([docs.schema[c] for c in keep] + [StructField(f, DoubleType()) for f in FEATURES])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Measure(*terms)
        for batch in batches:
            rows = np.array([own.features(t) for t in batch.column(len(keep)).to_pylist()], np.float64).reshape(-1, len(FEATURES))
            columns = [batch.column(i) for i in range(len(keep))] + [pa.array(c) for c in rows.T]
            yield pa.RecordBatch.from_arrays(columns, [*keep, *FEATURES])

    return docs.select(*keep, "text").mapInArrow(tidy(run), schema)


@dataclass
class Model:
    terms: tuple[list[str], list[str]]
    constant: float | None = None
    trees: object = None
    calibration: object = None

    def score(self, rows: DataFrame, keep: str = "doc_id") -> DataFrame:
        """The column keep of rows (which have the features) and their score."""
        if self.constant is not None:
            return rows.select(keep, F.lit(self.constant).alias("score"))
        out = self.trees.transform(_vector(rows)).withColumn("p", vector_to_array("probability")[1])
        if self.calibration is None:
            return out.select(keep, F.col("p").alias("score"))
        return self.calibration.transform(out).select(keep, F.least(F.greatest("score", F.lit(0.0)), F.lit(1.0)).alias("score"))


def _vector(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)


def fit(docs: DataFrame, labels: DataFrame, *, max_rows: int = TRAINING_ROWS, label: str = "toxic") -> Model:
    """A model from at most max_rows labelled rows of docs, none of them held out."""
    rows = stored(training_rows(docs, labels, label, max_rows), "training")
    terms = lexicon(rows.where(F.col("fold").isin(*LEXICON_FOLDS)))
    learned = stored(measured(rows.where(~F.col("fold").isin(*LEXICON_FOLDS)), terms, ["doc_id", "label", "fold"]), "features")
    tally = {(r.fold, r.label): r.n for r in rows.groupBy("fold", "label").agg(F.count("*").alias("n")).collect()}
    if not (tally.get((TREE_FOLD, 0)) and tally.get((TREE_FOLD, 1))):
        ones = sum(n for (_, y), n in tally.items() if y)
        return Model(terms, constant=ones / max(1, sum(tally.values())))
    trees = GBTClassifier(labelCol="label", maxIter=20, maxDepth=3, stepSize=0.3, seed=7).fit(
        _vector(learned.where(F.col("fold") == TREE_FOLD)).coalesce(2)
    )
    calibration = None
    if tally.get((CALIBRATION_FOLD, 0)) and tally.get((CALIBRATION_FOLD, 1)):
        held = trees.transform(_vector(learned.where(F.col("fold") == CALIBRATION_FOLD))).select(
            F.col("label").cast("double").alias("label"), vector_to_array("probability")[1].alias("p")
        )
        calibration = IsotonicRegression(featuresCol="p", labelCol="label", predictionCol="score").fit(held)
    return Model(terms, trees=trees, calibration=calibration)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row of docs."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    return model.score(measured(texts, model.terms, ["doc_id"]))


def keep_civil(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, with all their columns, whose text scores below threshold."""
    rows = docs.select(F.struct("*").alias("row"), text_of().alias("text"))
    return model.score(measured(rows, model.terms, ["row"]), "row").where(F.col("score") < threshold).select("row.*")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = scored(docs, fit(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
