"""Text quality by ordinal regression with a cumulative link.

Ratings are ordered grades: 0 toxic, 1 poor, 2 good. A text's hashed words share one weight
each; their sum is its score s, and ordered thresholds turn it into grades:
P(grade <= k) = sigmoid(t_k - s). From these come the expected grade and the tail
probability P(grade >= 2) that selection uses.

The model is fitted on a bounded sample of labelled rows (``MAX_ROWS``, chosen by a hash of
the id), scoring reads every text whole.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, DoubleType, StructField, StructType

from .common import as_bytes, with_columns

#: Bound of the sample the model is fitted on.
MAX_ROWS = 10_000
BUCKETS = 1 << 20
#: Buckets kept for the shape of a text; words use the others.
SHAPES = 64
#: Value of a shape in the score; a word's is 1. Few shapes say what many words only hint at.
SHAPE_VALUE = 6.0
#: Bytes of the word beginnings that have weights of their own, for inflected forms.
BEGINNINGS = (4, 5)
#: A word needs so many rows of the sample to get a weight.
LEAST_ROWS = 8
GRADES = 3
STEPS = 120

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_UPPER = re.compile(rb"[A-Z]+")
_SYMBOL = re.compile(rb"[!-/:-@\[-`{-~]")


def features(text: bytes) -> np.ndarray:
    """Buckets of the distinct words, their beginnings and the text's shape, sorted."""
    low = text.lower()
    words = _WORD.findall(low)
    distinct = set(words)
    parts = distinct.union(*[{word[:n] + b"*" for word in distinct} for n in BEGINNINGS])
    found = {SHAPES + crc32(part) % (BUCKETS - SHAPES) for part in parts}
    tenth = lambda part, whole: min(9, 10 * part // max(1, whole))
    symbols = len(_SYMBOL.findall(low))
    repeats = sum(a == b for a, b in zip(words, words[1:], strict=False))
    found.add(tenth(3 * symbols, len(low)))
    found.add(10 + tenth(repeats, len(words)))
    found.add(20 + tenth(len(distinct), len(words)))
    found.add(30 + min(12, len(low.split()).bit_length()))
    found.add(43 + tenth(sum(map(len, _UPPER.findall(text))), len(low)))
    return np.array(sorted(found), dtype=np.int32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def score(self, buckets: np.ndarray) -> float:
        return float(self.weights[buckets].sum())

    def grades(self, scores: np.ndarray) -> np.ndarray:
        """Probabilities of the grades, a row for each score."""
        upto = _sigmoid(self.thresholds[None, :] - scores[:, None])
        return np.diff(np.concatenate([np.zeros((len(scores), 1)), upto, np.ones((len(scores), 1))], axis=1), axis=1)


def fit(rows: list[np.ndarray], grades: np.ndarray, l2: float = 3e-3, steps: int = STEPS, rate: float = 0.1) -> Model:
    """Maximum likelihood by gradient descent (Adam). Without two grades every text is of the top grade."""
    seen = np.bincount(grades, minlength=GRADES) if len(grades) else np.zeros(GRADES)
    if (seen > 0).sum() < 2:
        return Model(np.zeros(BUCKETS), np.full(GRADES - 1, -50.0))
    flat = np.concatenate(rows)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    used = np.bincount(flat, minlength=BUCKETS) >= LEAST_ROWS
    flat, owner = flat[used[flat]], owner[used[flat]]
    names, flat = np.unique(flat, return_inverse=True)
    value = np.where(names < SHAPES, SHAPE_VALUE, 1.0)
    share = (np.cumsum(seen)[:-1] + 1) / (len(grades) + 2)
    start = np.log(share / (1 - share))
    # The thresholds stay in order: a first one, and logarithms of the steps between them.
    values = np.concatenate([np.zeros(len(names)), start[:1], np.log(np.maximum(np.diff(start), 0.1))])
    mean, square = np.zeros_like(values), np.zeros_like(values)
    n = len(names)
    for step in range(1, steps + 1):
        scores = np.bincount(owner, weights=(values[: len(names)] * value)[flat], minlength=len(rows))
        gaps = np.exp(values[n + 1 :])
        thresholds = np.cumsum(np.concatenate([values[n : n + 1], gaps]))
        edges = np.concatenate([[-np.inf], thresholds, [np.inf]])
        high, low = _sigmoid(edges[grades + 1] - scores), _sigmoid(edges[grades] - scores)
        # d log(high - low): the link's slopes at the two borders of the grade.
        part = np.maximum(high - low, 1e-12)
        to_high, to_low = high * (1 - high) / part, low * (1 - low) / part
        by_score = -(to_high - to_low)
        by_threshold = np.array(
            [to_high[grades == k].sum() - to_low[grades == k + 1].sum() for k in range(len(thresholds))]
        )
        slope = np.empty_like(values)
        slope[:n] = np.bincount(flat, weights=by_score[owner], minlength=n) * value / len(rows) - l2 * values[:n]
        slope[n] = by_threshold.sum() / len(rows)
        slope[n + 1 :] = np.cumsum(by_threshold[::-1])[::-1][1:] * gaps / len(rows)
        mean = 0.9 * mean + 0.1 * slope
        square = 0.999 * square + 0.001 * slope**2
        values = values + rate * (1 - step / (steps + 1)) * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    weights = np.zeros(BUCKETS)
    weights[names] = values[:n] * value
    return Model(weights, np.cumsum(np.concatenate([values[n : n + 1], np.exp(values[n + 1 :])])))


def grade_of(labels: DataFrame) -> DataFrame:
    """(doc_id, grade): toxic 0, poor 1, good 2; of repeated labels the lowest, unlabelled left out."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
    return (
        labels.select(F.col("doc_id").cast("long").alias("_id"), grade.alias("_grade"))
        .where(F.col("_id").isNotNull() & F.col("_grade").isNotNull())
        .groupBy("_id")
        .agg(F.min("_grade").alias("_grade"))
    )


def train(docs: DataFrame, graded: DataFrame, max_rows: int = MAX_ROWS, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on at most ``max_rows`` of the graded ids. Of rows with the same id one counts."""
    # The sample has at most max_rows ids, so its broadcast is bounded.
    sample = graded.orderBy(F.xxhash64("_id"), "_id").limit(max_rows)
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(sample), "_id")

    def make(batches):
        for batch in batches:
            yield {"_buckets": pa.array([features(t).tobytes() for t in as_bytes(batch["_text"])], pa.binary())}

    made = with_columns(rows, ["_text"], StructType([StructField("_buckets", BinaryType())]), make).drop("_text")
    found = made.groupBy("_id").agg(F.max("_buckets").alias("b"), F.first("_grade").alias("g")).orderBy("_id").collect()
    return fit([np.frombuffer(r.b, np.int32) for r in found], np.array([r.g for r in found], dtype=np.int64))


def grade(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Add ``score``, ``expected_grade`` (0 to 2), ``p_poor`` = P(grade <= 1) and ``p_good`` = P(grade >= 2).

    Every text gets a grade; a null text is graded as the empty one. Ties, repeated rows
    and empty tables need no care: a row's grade depends on its text alone. Input columns
    with the names of added ones are replaced.
    """
    held = docs.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.thresholds))
    names = ["score", "expected_grade", "p_poor", "p_good"]

    def make(batches):
        weights, thresholds = held.value
        own = Model(weights, thresholds)
        for batch in batches:
            scores = np.array([own.score(features(t)) for t in as_bytes(batch[text_col])], dtype=np.float64)
            chances = own.grades(scores)
            expected = chances @ np.arange(GRADES)
            columns = (scores, expected, 1 - chances[:, -1], chances[:, -1])
            yield {name: pa.array(column, pa.float64()) for name, column in zip(names, columns, strict=True)}

    return with_columns(docs, [text_col], StructType([StructField(name, DoubleType()) for name in names]), make)
