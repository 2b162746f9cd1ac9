"""Ordinal quality grades: cumulative-link regression on hashed text features.

A document has a grade 0, 1 or 2 (of the labels ``quality`` and not ``toxic``,
how many hold). The model is the proportional-odds one: one weight vector shared
by all grades and ordered thresholds,

    P(grade > k) = logistic(w . x - t_k),   t_0 < t_1,

fitted by the likelihood of the grades themselves, P(grade > k - 1) - P(grade > k);
so a text gets an expected grade and the probability of the top grade, and is
kept if the latter reaches a limit.

Features, hashed to 2**20 places: each distinct bare word of the text (1 if it
occurs), and each word form (letters, capitals, digits and other signs in runs)
with its share of the text's words, so that a few telling words count in a text
of any length and the look of the whole text counts by its share.

The model is fitted on the driver on at most ``SAMPLE`` labelled documents, the
first in the order of a hash of the id, so the choice is the same on any layout
and of a bound that does not grow with the data. All documents are scored, whole.

Results: NULL and empty texts have no features. Labels with a NULL are not used;
a document with several labels counts with each. Without any usable label there
is no model: grades are NULL and all documents are kept. Repeated rows stay
repeated.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, IntegerType, StructField, StructType

from tidemark.llm.brown import held

PLACES = 1 << 20
SAMPLE = 6_000
GRADES = 3
LIMIT = 0.6
SIGNAL = 4.0  # standard errors by which a feature's documents must differ in their share of the top grade
LEAST_DOCUMENTS = 10  # a feature of fewer sampled documents has no weight
FORM_SCALE = 4.0
PENALTY = 3e-4
STEPS = 300
_CACHE = 300_000
_RUNS = [(re.compile(rb"[a-z\x80-\xff]+"), b"a"), (re.compile(rb"[A-Z]+"), b"A"), (re.compile(rb"[0-9]+"), b"0"), (re.compile(rb"(.)\1+"), rb"\1")]


def word_form(word: bytes) -> bytes:
    for pattern, sign in _RUNS:
        word = pattern.sub(sign, word)
    return word[:8]


def bare(word: bytes) -> bytes:
    """A word in lower case, without the signs around it."""
    return word.lower().strip(b".,;:!?\"'()[]")


def place(kind: bytes, value: bytes) -> int:
    return xxhash.xxh3_64_intdigest(kind + value) % PLACES


def features(text: str | None) -> dict[int, float]:
    """Place and value of the features of a text."""
    words = (text or "").encode("utf-8", "replace").split()
    out: dict[int, float] = {}
    forms: dict[bytes, int] = {}
    for w in words:
        f = word_form(w)
        forms[f] = forms.get(f, 0) + 1
    for w in set(map(bare, words)):
        out[place(b"w", w)] = 1.0
    for f, n in forms.items():
        out[place(b"f", f)] = FORM_SCALE * n / len(words)
    return out


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray


_FEATURES = StructType([StructField("places", ArrayType(IntegerType())), StructField("values", ArrayType(FloatType()))])


@F.arrow_udf(_FEATURES)
def features_of(texts: pa.Array) -> pa.Array:
    found = [features(t.as_py()) for t in texts]
    return pa.StructArray.from_arrays(
        [pa.array([list(f) for f in found], pa.list_(pa.int32())), pa.array([list(f.values()) for f in found], pa.list_(pa.float32()))],
        names=["places", "values"],
    )


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -700, 700)))


def thresholds_of(free: np.ndarray) -> np.ndarray:
    """Thresholds from free numbers: the first as it is, then logarithms of the gaps, so that they ascend."""
    return np.cumsum(np.concatenate([free[:1], np.exp(free[1:])]))


def loss(z: np.ndarray, grade: np.ndarray, free: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Minus the log-likelihood of the grades, its slope by each ``z`` and its slope by each free number.

    A grade lies between two thresholds, ``P = logistic(z - low) - logistic(z - high)``, which is
    ``logistic(z - low) * logistic(high - z) * (1 - exp(low - high))``: no difference of near numbers.
    """
    cuts = thresholds_of(free)
    ends = np.concatenate([[-np.inf], cuts, [np.inf]])
    low, high = ends[grade], ends[grade + 1]
    value = np.logaddexp(0, low - z) + np.logaddexp(0, z - high) - np.log(-np.expm1(low - high))
    below, above = _logistic(low - z), _logistic(z - high)
    near = 1 / np.expm1(high - low)  # by the gap: 0 for the outer grades
    by_cut = np.bincount(grade, below + near, GRADES + 1)[1:GRADES] - np.bincount(grade, above + near, GRADES + 1)[: GRADES - 1]
    # A free number moves its own threshold and all behind it.
    by_free = np.cumsum(by_cut[::-1])[::-1] * np.concatenate([[1.0], np.exp(free[1:])])
    return float(value.sum()), above - below, by_free


def fit_rows(rows: list[tuple[np.ndarray, np.ndarray, int]]) -> Model | None:
    """Maximum likelihood with an L2 penalty, by Adam on all rows at once.

    ``rows`` has the places, values and grade of each document. The likelihood of a
    grade is that of lying between its two thresholds (``loss``), so the slopes of
    neighbouring thresholds depend on each other. Only features that tell the top
    grade from the others get a weight, as the many rare words of a long text would
    add up otherwise.
    """
    if not rows:
        return None
    counts = np.bincount(np.concatenate([r[0] for r in rows]), minlength=PLACES)
    top = np.array([r[2] == GRADES - 1 for r in rows], float)
    in_top = np.bincount(np.concatenate([r[0] for r in rows]), np.repeat(top, [len(r[0]) for r in rows]), PLACES)
    share = np.clip(top.mean(), 1e-3, 1 - 1e-3)
    signal = np.abs(in_top - counts * share) / np.sqrt(np.maximum(counts, 1) * share * (1 - share))
    used = np.flatnonzero((counts >= min(LEAST_DOCUMENTS, len(rows))) & (signal >= SIGNAL))
    column = np.full(PLACES, -1, np.int64)
    column[used] = np.arange(len(used))
    row_of = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    col_of, values = column[np.concatenate([r[0] for r in rows])], np.concatenate([r[1] for r in rows]).astype(float)
    row_of, values, col_of = row_of[col_of >= 0], values[col_of >= 0], col_of[col_of >= 0]
    grade, n = np.array([r[2] for r in rows]), len(rows)
    above = (grade[:, None] > np.arange(GRADES - 1)).astype(float)
    odds = np.clip(above.mean(0), 1 / (n + 2), 1 - 1 / (n + 2))
    start = -np.log(odds / (1 - odds))
    w, free = np.zeros(len(used)), np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 1e-3))])
    first, second, rate = [np.zeros_like(w), np.zeros_like(free)], [np.zeros_like(w), np.zeros_like(free)], 0.05
    for step in range(1, STEPS + 1):
        z = np.bincount(row_of, values * w[col_of], minlength=n)
        _, by_z, by_free = loss(z, grade, free)
        slopes = [np.bincount(col_of, values * by_z[row_of], minlength=len(used)) / n + PENALTY * w, by_free / n]
        for i, (target, slope) in enumerate(zip((w, free), slopes)):
            first[i] = 0.9 * first[i] + 0.1 * slope
            second[i] = 0.999 * second[i] + 0.001 * slope * slope
            target -= rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    weights = np.zeros(PLACES, np.float32)
    weights[used] = w
    return Model(weights, thresholds_of(free))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Model | None:
    """A model of the first ``sample`` labelled documents in the order of a hash of the key."""
    graded = labels.select(
        labels[key].alias("id"), (labels["quality"].cast("int") + (1 - labels["toxic"].cast("int"))).alias("grade")
    ).filter("id IS NOT NULL AND grade BETWEEN 0 AND 2")
    chosen = graded.orderBy(F.xxhash64("id"), "id", "grade").limit(sample)
    texts = docs.select(docs[key].alias("id"), docs[text].cast("string").alias("text"))
    rows = texts.join(F.broadcast(chosen), "id").select("id", "grade", features_of(F.col("text")).alias("f"))
    found = sorted(
        ((r.id, r.grade, r.f.places, r.f["values"]) for r in rows.orderBy(F.xxhash64("id"), "id", "grade").limit(sample).collect())
    )
    return fit_rows([(np.array(p, np.int64), np.array(v, np.float32), g) for _, g, p, v in found])


class Grader(dict):
    """Scores texts; as a dict it holds weight and form of the words seen lately."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model
        self.form_weight: dict[bytes, float] = {}

    def __missing__(self, word: bytes) -> tuple[float, float]:
        f = word_form(word)
        value = float(self.model.weights[place(b"w", bare(word))]), FORM_SCALE * float(self.model.weights[place(b"f", f)])
        if len(word) <= 64:
            if len(self) >= _CACHE:
                self.clear()
            self[word] = value
        return value

    def score(self, text: str | None) -> float:
        words = (text or "").encode("utf-8", "replace").split()
        if not words:
            return 0.0
        forms = sum(self[w][1] for w in words)
        # Each distinct bare word counts once: of its spellings one is looked up.
        return sum(self[w][0] for w in {bare(w): w for w in set(words)}.values()) + forms / len(words)


_GRADE = StructType([StructField("expected_grade", DoubleType()), StructField("top_probability", DoubleType())])


def graded(docs: DataFrame, model: Model, text: Column) -> Column:
    """struct: expected grade, and probability of the top grade, of a text."""
    name, shared = uuid.uuid4().hex, docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(_GRADE)
    def grade(texts: pa.Array) -> pa.Array:
        grader = held(name, lambda: Grader(shared.value))
        z = np.array([grader.score(t.as_py()) for t in texts], float)
        above = _logistic(z[:, None] - grader.model.thresholds)
        return pa.StructArray.from_arrays(
            [pa.array(above.sum(1), pa.float64()), pa.array(above[:, -1], pa.float64())], names=["expected_grade", "top_probability"]
        )

    return grade(text)


def classified(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, ``expected_grade``, ``top_probability``, ``kept``."""
    model = fit(docs, labels, key, text)
    rows = docs.select(docs[key].alias("id"), docs[text].cast("string").alias("text"))
    if model is None:
        none = F.lit(None).cast("double")
        return rows.select(F.col("id").alias(key), none.alias("expected_grade"), none.alias("top_probability"), F.lit(True).alias("kept"))
    found = rows.select("id", graded(rows, model, F.col("text")).alias("g")).select("id", "g.*")
    return found.select(F.col("id").alias(key), "expected_grade", "top_probability", (F.col("top_probability") >= LIMIT).alias("kept"))
