"""Toxicity by non-negative positive-unlabelled learning (nnPU).

Positives are documents whose label says toxic; unlabelled text is any document. A linear classifier in numpy is trained
with the class-prior-corrected risk  prior * E_P[l(z)] + max(0, E_U[l(-z)] - prior * E_P[l(-z)])  with the logistic loss
l; while the second term is negative, the step goes up along it instead, so that the classifier does not overfit the
positives. The prior is the share of toxic labels. Features are a text's distinct words and their beginnings, hashed; a
feature's value is the number of distinct words that have it. The ``features`` ones that stand out most among positives
are kept.

The classifier is fitted on bounded samples, chosen by a hash of the id: at most about ``positives`` confirmed documents
and ``unlabelled`` others (parameters of ``train``); counts and prior are over all labels of the training fold. Scoring
reads every whole text. The model (``features`` weights) goes to the tasks as a broadcast.

Defined results: a null or empty text has no features and gets the score of the bias; ids that are null or not labelled
are unlabelled; an id with several labels is toxic if one says so; labels without toxic are ignored; without positives
or without documents to learn from every score is 0; repeated rows are each scored; an empty table gives an empty table;
extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import exp

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.llm.common import fold, hashed_share, mapped, slices, table
from fleetscope.session import ship_package

FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
POSITIVES, UNLABELLED = 2500, 5000
FEATURES = 4096
#: Hashed features.
_BITS = 20
#: Lengths, in bytes, of the beginnings of a word that are features.
_BEGINNINGS = range(4, 9)
#: Words whose score a worker keeps; the cache is emptied when full.
_CACHE = 200_000
_LETTERS = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def distinct_words(text: str | None) -> set[bytes]:
    return set(text.lower().encode().translate(_LETTERS).split()) if text else set()


def word_features(word: bytes) -> list[int]:
    """Of the word itself and of its beginnings."""
    mask = (1 << _BITS) - 1
    return [zlib.crc32(word) & mask, *(zlib.crc32(b"^" + word[:n]) & mask for n in _BEGINNINGS if n < len(word))]


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and values."""
    found = [f for word in distinct_words(text) for f in word_features(word)]
    return np.unique(np.array(found, np.int32), return_counts=True)


@dataclass
class Model:
    weights: dict[int, float]
    bias: float


class Scorer:
    """Scores texts in one worker process; a word's score is the sum of its features' weights."""

    def __init__(self, model: Model):
        self.model = model
        self.known: dict[bytes, float] = {}

    def score(self, text: str | None) -> float:
        words, known, weights = distinct_words(text), self.known, self.model.weights
        if len(known) + len(words) > _CACHE:
            known.clear()
        for word in words.difference(known):
            known[word] = sum(weights.get(f, 0.0) for f in word_features(word))
        z = self.model.bias + sum(sorted(map(known.__getitem__, words)))  # sorted: the sum does not depend on set order
        return 1 / (1 + exp(-z)) if z > -700 else 0.0


# -- training ------------------------------------------------------------------------------------------------------

def fit(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, positive: np.ndarray, prior: float, keep: int = FEATURES,
        least: int = 3, lift: float = 2.0, steps: int = 400, rate: float = 0.05, decay: float = 1e-3,
        few: float = 0.3) -> Model:
    """nnPU over a sparse matrix given by (row, feature, value); ``positive`` tells the confirmed rows. A feature must be
    in ``least`` of them and be ``lift`` times as frequent there as in the others. Weights are held near zero by ``decay``
    or, with few positives, by ``few`` / their number."""
    n, n_p = len(positive), int(positive.sum())
    n_u = n - n_p
    if not n_p or not n_u or not 0 < prior < 1:
        return Model({}, -np.inf if not n_p else float(np.log(prior / (1 - prior))) if 0 < prior < 1 else 0.0)
    size, decay = 1 << _BITS, max(decay, few / n_p)
    in_p = np.bincount(cols[positive[rows]], minlength=size)
    in_u = np.bincount(cols[~positive[rows]], minlength=size)
    share_p, share_u = (in_p + 0.5) / (n_p + 1), (in_u + 0.5) / (n_u + 1)
    stands_out = np.sqrt(n_p) * (share_p - share_u) / np.sqrt(share_u * (1 - share_u) + 1e-9)
    stands_out[(in_p < least) | (share_p < lift * share_u)] = 0
    chosen = np.argsort(-stands_out, kind="stable")[:keep]
    chosen = np.sort(chosen[stands_out[chosen] > 0])
    place = np.full(size, -1, np.int32)
    place[chosen] = np.arange(len(chosen))
    col = place[cols]
    row, val, col = rows[col >= 0], values[col >= 0].astype(float), col[col >= 0]

    k = len(chosen)
    weights, bias = np.zeros(k), float(np.log(prior / (1 - prior)))
    first, second = np.zeros(k + 1), np.zeros(k + 1)
    for step in range(1, steps + 1):
        z = bias + np.bincount(row, weights[col] * val, n)
        p = 1 / (1 + np.exp(-np.clip(z, -35, 35)))
        as_negative = np.logaddexp(0, z)
        negative_risk = as_negative[~positive].mean() - prior * as_negative[positive].mean()
        of_positive = np.where(positive, prior * (p - 1) / n_p, 0)
        of_negative = np.where(positive, -prior * p / n_p, p / n_u)
        slope = of_positive + of_negative if negative_risk >= 0 else -of_negative
        grad = np.append(np.bincount(col, slope[row] * val, k) + decay * weights, slope.sum())
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad ** 2
        move = rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
        weights -= move[:k]
        bias -= move[k]
    return Model(dict(zip(chosen.tolist(), weights.tolist())), float(bias))


def _featured(rows: DataFrame) -> DataFrame:
    """(id, positive, text) -> (id, positive, features, counts)"""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 2):
            found = [features(t) for t in part.column(2).to_pylist()]
            ends = pa.array(np.cumsum([0, *(len(f) for f, _ in found)]), pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate([x[k] for x in found]), pa.int32()))
                     for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *lists],
                                             names=["id", "positive", "features", "counts"])

    return rows.mapInArrow(run, "id string, positive boolean, features array<int>, counts array<int>")


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", toxic_col: str = "toxic",
          folds: int = FOLDS, held_out: int = HELD_OUT, positives: int = POSITIVES, unlabelled: int = UNLABELLED,
          keep: int = FEATURES) -> Model:
    """A model from the rows of ``docs`` and ``labels`` that are not in the held-out fold."""
    ship_package(docs.sparkSession)
    own = F.col(id_col).isNotNull() & (fold(F.col(id_col), folds) != held_out)
    labels = labels.filter(own & F.col(toxic_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(toxic_col).alias("y"))
    docs = docs.filter(own).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    n, n_p = labels.agg(F.count("*"), F.count(F.when(F.col("y") == 1, 1))).first()
    n_u = docs.select("id").count()
    if not n_p or not n_u:
        return Model({}, -np.inf)
    # the ids of the sampled positives are bounded by ``positives``
    confirmed = labels.filter((F.col("y") == 1) & hashed_share(F.col("id"), positives / n_p)).select("id").distinct()
    confirmed = docs.join(F.broadcast(confirmed.orderBy(F.xxhash64("id"), "id").limit(2 * positives)), "id", "left_semi").withColumn("positive", F.lit(True))
    others = docs.filter(hashed_share(F.col("id"), unlabelled / n_u)).withColumn("positive", F.lit(False))
    rows = confirmed.unionByName(others).select(F.col("id").cast("string").alias("id"), "positive", "text")
    # an id that repeats counts once, so that the sample is bounded whatever the ids
    sample = _featured(rows).dropDuplicates(["id", "positive"]).orderBy("positive", "id").drop("id").toArrow()
    sizes = pa.chunked_array(sample["features"]).combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
    flat = [sample[c].combine_chunks().flatten().to_numpy() for c in ("features", "counts")]
    return fit(np.repeat(np.arange(len(sizes), dtype=np.int32), sizes), flat[0], flat[1],
               sample["positive"].to_numpy().astype(bool), n_p / n, keep)


# -- scoring -------------------------------------------------------------------------------------------------------

_SCORERS: dict[int, Scorer] = {}


def scores(spark: SparkSession, model: Model):
    """A column function: text -> score between 0 and 1."""
    ship_package(spark)
    return _score(spark.sparkContext.broadcast(model))


def _score(model: Broadcast):
    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        key = hash((model.value.bias, *model.value.weights.items()))
        if key not in _SCORERS:
            _SCORERS.clear()
            _SCORERS[key] = Scorer(model.value)
        return mapped(texts, _SCORERS[key].score, pa.float64())

    return score


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row of ``docs``."""
    score = scores(docs.sparkSession, model)
    return docs.select(id_col, score(F.col(text_col).cast("string")).alias("score"))


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows whose score reaches the threshold."""
    return docs.filter(scores(docs.sparkSession, model)(F.col(text_col).cast("string")) < threshold)


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score_documents(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
