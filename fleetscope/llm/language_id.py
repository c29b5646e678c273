"""Language identification in two steps: the family first, then one-versus-one linear support vector machines between
the languages of that family.

Features are hashed counts of one to three bytes of the lower-cased letters, with blanks between words; their square
roots are scaled to length one. A softmax regression predicts the family. Within a family each pair of languages has a
linear SVM (squared hinge loss); the language with the most votes wins, ties go to the larger sum of margins and then to
the earlier name. Both are trained in numpy on a sample of labelled rows: at most about ``per_language`` rows a language
and ``rows`` in all, chosen by a hash of the id (parameters of ``train``). Families of languages are a fixed table; a
language that it lacks is a family of its own.

The score is the family's probability times the mean probability of the won comparisons, 1 for a family of one.

Defined results: ``und`` with score 0 for a null text and for one without a letter, and for all texts if there is nothing
to learn from; null languages are not learned from; ids that are null are learned from like others; repeated rows are
each predicted; extra columns are not read; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.llm.common import fold, slices, table
from fleetscope.session import ship_package

FOLDS, HELD_OUT = 5, 0
UNKNOWN = "und"
ROWS, PER_LANGUAGE = 4000, 1000
#: Languages that a model may have, as the sample and the model grow with them: of more label values the most frequent are
#: learned, of equally frequent ones the first by name.
MAX_LANGUAGES = 500
DIMENSIONS = 4096
#: Bytes of a text that are counted at once.
_RUN = 1 << 20

# Families of written languages by their codes.
FAMILIES = {
    "germanic": ["af", "da", "de", "en", "fo", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"],
    "romance": ["ast", "ca", "co", "es", "fr", "gl", "it", "la", "oc", "pt", "ro", "sc"],
    "slavic": ["be", "bg", "bs", "cs", "hr", "hsb", "mk", "pl", "ru", "sh", "sk", "sl", "sr", "uk"],
    "baltic": ["lt", "lv"],
    "uralic": ["et", "fi", "hu", "se"],
    "turkic": ["az", "kk", "ky", "tk", "tr", "tt", "ug", "uz"],
    "indo-aryan": ["bn", "gu", "hi", "mr", "ne", "pa", "sa", "si", "ur"],
    "dravidian": ["kn", "ml", "ta", "te"],
    "semitic": ["am", "ar", "he", "mt"],
    "sinitic": ["yue", "zh"],
}
_FAMILY = {code: name for name, codes in FAMILIES.items() for code in codes}

_LETTER = re.compile(r"[^\W\d_]")
_BLANK = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def family(language: str) -> str:
    code = re.split("[-_]", language.lower())[0]
    return _FAMILY.get(code, f"only {language}")


def has_letter(text: str | None) -> bool:
    """Whether a character is a letter (Unicode categories L)."""
    return bool(text) and any(m[0].isalpha() for m in _LETTER.finditer(text))


def vector(text: str) -> np.ndarray:
    """Counts of one to three bytes in DIMENSIONS bins, their square roots scaled to length one."""
    clean = b" " + b" ".join(text.lower().encode().translate(_BLANK).split()) + b" "
    counts = np.zeros(DIMENSIONS, np.int64)
    for at in range(0, len(clean), _RUN):
        a = np.frombuffer(clean[at:at + _RUN + 2], np.uint8).astype(np.uint32)  # two more: no gram is lost
        two = a[:-1] * np.uint32(257) + a[1:] + np.uint32(65536)
        three = two[:-1] * np.uint32(263) + a[2:] + np.uint32(1 << 25)
        for grams in (a[:_RUN], two[:_RUN], three[:_RUN]):
            counts += np.bincount((grams * np.uint32(2654435761)) >> np.uint32(20), minlength=DIMENSIONS)
    x = np.sqrt(counts.astype(np.float32))
    return x / max(float(np.sqrt(x @ x)), 1e-9)


@dataclass
class Model:
    languages: list[str]
    families: list[str]
    family_weights: np.ndarray  # (DIMENSIONS + 1, families)
    pairs: dict[str, list[tuple[int, int]]] = field(default_factory=dict)  # by family, numbers of languages
    pair_weights: dict[str, np.ndarray] = field(default_factory=dict)  # (DIMENSIONS + 1, pairs)

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Languages and scores for the rows of x."""
        z = x @ self.family_weights[:-1] + self.family_weights[-1]
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        best = p.argmax(axis=1)
        names: list[str] = [""] * len(x)
        score = p[np.arange(len(x)), best].astype(float)
        for k, name in enumerate(self.families):
            rows = np.flatnonzero(best == k)
            own = [i for i, language in enumerate(self.languages) if family(language) == name]
            if len(own) == 1 or not len(rows):
                for r in rows:
                    names[r] = self.languages[own[0]]
                continue
            margins = x[rows] @ self.pair_weights[name][:-1] + self.pair_weights[name][-1]
            votes = np.zeros((len(rows), len(self.languages)))
            total = np.zeros_like(votes)
            sure = np.zeros_like(votes)
            for c, (i, j) in enumerate(self.pairs[name]):
                m = margins[:, c].astype(float)
                votes[:, i] += m >= 0
                votes[:, j] += m < 0
                total[:, i] += m
                total[:, j] -= m
                sure[:, i] += 1 / (1 + np.exp(-2 * m))
                sure[:, j] += 1 / (1 + np.exp(2 * m))
            votes[:, [i for i in range(len(self.languages)) if i not in own]] = -1
            won = np.array([max(own, key=lambda i: (votes[r, i], total[r, i], -i)) for r in range(len(rows))])
            for r, i in zip(rows, won):
                names[r] = self.languages[i]
            score[rows] *= sure[np.arange(len(rows)), won] / (len(own) - 1)
        return names, np.clip(score, 0.0, 1.0)


def _adam(slope, shape: tuple[int, int], steps: int = 300, rate: float = 0.1) -> np.ndarray:
    """Minimises a smooth loss by its gradient ``slope(weights)``."""
    w = np.zeros(shape, np.float32)
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        g = slope(w)
        first = 0.9 * first + 0.1 * g
        second = 0.999 * second + 0.001 * g * g
        w -= rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    return w


def fit(x: np.ndarray, y: list[str], decay: float = 1e-5) -> Model | None:
    """``x``: rows of :func:`vector`; ``y``: their languages."""
    languages = sorted(set(y))
    if not languages:
        return None
    families = sorted({family(language) for language in languages})
    at = {language: i for i, language in enumerate(languages)}
    number = np.array([at[language] for language in y])
    of = np.array([families.index(family(language)) for language in languages])[number]
    x1 = np.hstack([x, np.ones((len(x), 1), np.float32)])

    # every language has the same weight, however many rows it has
    share = (1 / np.bincount(number)[number]).astype(np.float32)[:, None]
    share /= share.sum()
    hot = np.eye(len(families), dtype=np.float32)[of]

    def softmax_slope(w: np.ndarray) -> np.ndarray:
        z = x1 @ w
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        return x1.T @ ((p - hot) * share) + decay * w

    model = Model(languages, families, _adam(softmax_slope, (x1.shape[1], len(families))))
    for name in families:
        own = [i for i, language in enumerate(languages) if family(language) == name]
        pairs = list(combinations(own, 2))
        weights = []
        for i, j in pairs:
            rows = np.flatnonzero((number == i) | (number == j))
            a, sign = x1[rows], np.where(number[rows] == i, 1, -1).astype(np.float32)[:, None]
            part = share[rows] / share[rows].sum()

            def hinge_slope(w: np.ndarray) -> np.ndarray:
                return a.T @ (-2 * sign * np.maximum(0, 1 - sign * (a @ w)) * part) + decay * w

            weights.append(_adam(hinge_slope, (a.shape[1], 1)))
        if pairs:
            model.pairs[name], model.pair_weights[name] = pairs, np.hstack(weights)
    return model


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = FOLDS,
          held_out: int = HELD_OUT, rows: int = ROWS, per_language: int = PER_LANGUAGE,
          languages: int = MAX_LANGUAGES) -> Model | None:
    """A model from the labelled rows outside the held-out fold; None if there are none."""
    ship_package(docs.sparkSession)
    known = docs.filter(F.col(lang_col).isNotNull() & (fold(F.col(id_col), folds) != held_out)).select(
        F.col(id_col).cast("string").alias("id"), F.col(lang_col).cast("string").alias("lang"),
        F.col(text_col).cast("string").alias("text"))
    counted = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages)
    sizes = {r.lang: r["count"] for r in counted.collect()}
    if not sizes:
        return None
    known = known.filter(F.col("lang").isin(list(sizes)))
    most = min(per_language, max(1, rows // len(sizes)))
    shares = F.create_map(*(F.lit(v) for lang, n in sizes.items() for v in (lang, int(min(1.0, most / n) * (1 << 30)))))
    chosen = known.filter(F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(1 << 30)) < shares[F.col("lang")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 2):
            texts = part.column(2).to_pylist()
            x = [vector(t).tobytes() if has_letter(t) else None for t in texts]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(x, pa.binary())],
                                             names=["id", "lang", "x"])

    # an id that repeats counts once, so that the sample is bounded whatever the ids
    sample = (chosen.mapInArrow(run, "id string, lang string, x binary").filter("x is not null")
              .dropDuplicates(["id", "lang"]).orderBy("lang", "id").select("lang", "x").toArrow())
    vectors = [np.frombuffer(v, np.float32) for v in sample["x"].to_pylist()]
    return fit(np.vstack(vectors), sample["lang"].to_pylist()) if vectors else None


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every row of ``docs``."""
    spark = docs.sparkSession
    ship_package(spark)
    sent = spark.sparkContext.broadcast(model)
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for part in slices(batches, 1):
            texts = part.column(1).to_pylist()
            names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            at = [k for k, t in enumerate(texts) if model is not None and has_letter(t)]
            if at:
                found, score = model.predict(np.vstack([vector(texts[k]) for k in at]))
                scores[at] = score
                for k, name in zip(at, found):
                    names[k] = name
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names, pa.string()), pa.array(scores)],
                                             names=["id", "lang_pred", "score"])

    kind = picked.schema["id"].dataType.simpleString()
    return picked.mapInArrow(run, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = predict(docs, train(docs))
    return found.select("doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score")
