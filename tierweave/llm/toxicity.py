"""Toxicity by cumulative-link ordinal regression over sparse text features."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierweave.llm.common import small_batches, staged

#: Labelled rows that are learned from: so many of each grade at most, those with the smallest hash of their id.
SAMPLE_PER_GRADE = 4_000
#: Features that may carry weight, by their association with grades above 0; each is in so many sampled texts at least.
MOST_KEYS, LEAST_TEXTS, LEAST_CHI2 = 1_500, 4, 30.0
#: A word counts as itself and by its beginnings of these lengths, so that its derivations are known too.
BEGINNINGS = (4, 5, 6, 7)
#: Keys whose counts a task holds before it hands them on.
HELD = 1_000_000
WORD = re.compile(r"[^\W\d_]+")
#: Largest grade that labels may have.
MOST_GRADES = 16


def severity_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, grade): 0 not toxic, 1 toxic, 2 toxic and of low quality as well. Rows without doc_id or toxic label are left out."""
    grade = F.when(F.col("toxic") == 0, 0).when(F.col("quality") == 0, 2).otherwise(1)
    return labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").select("doc_id", grade.alias("grade"))


def _keys(word: str) -> list[str]:
    return [word, *(word[:k] + "*" for k in BEGINNINGS if len(word) > k)]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per key, in how many texts of grade 0 and above it is."""
    held: dict[str, list[int]] = {}

    def rows() -> pa.RecordBatch:
        columns = [pa.array(held.keys(), pa.string()), *(pa.array([n[k] for n in held.values()], pa.int64()) for k in (0, 1))]
        return pa.RecordBatch.from_arrays(columns, ["key", "good", "bad"])

    for batch in batches:
        for text, grade in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for key in {k for w in set(WORD.findall((text or "").lower())) for k in _keys(w)}:
                held.setdefault(key, [0, 0])[grade > 0] += 1
            if len(held) > HELD:
                yield rows()
                held.clear()
    yield rows()


def _reader(vocabulary: dict[str, int]):
    """A function from a text to (feature, value) pairs. Each key has two: how often it is there, and how densely."""
    heads = {k[: BEGINNINGS[0]] for k in vocabulary} | {k[:-1] for k in vocabulary if k.endswith("*")}

    def read(text: str | None) -> list[tuple[int, float]]:
        words = WORD.findall((text or "").lower())
        found: dict[int, int] = {}
        for w in words:
            if w[: BEGINNINGS[0]] in heads:
                for key in _keys(w):
                    if (at := vocabulary.get(key)) is not None:
                        found[at] = found.get(at, 0) + 1
        out = []
        for at, n in sorted(found.items()):
            out.append((2 * at, 1.0 + float(np.log(min(n, 20)))))
            out.append((2 * at + 1, min(5.0, 100.0 * n / (len(words) + 20))))
        return out

    return read


def _vectors(vocabulary: dict[str, int]):
    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = _reader(vocabulary)
        for batch in batches:
            own = [read(t) for t in batch.column(0).to_pylist()]
            at = pa.array([[k for k, _ in v] for v in own], pa.list_(pa.int32()))
            values = pa.array([[x for _, x in v] for v in own], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(1), at, values], ["grade", "at", "values"])

    return vectors


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def fit_ordinal(grades: np.ndarray, row: np.ndarray, at: np.ndarray, values: np.ndarray, n_features: int, shares: np.ndarray, decay: float = 2e-4, steps: int = 500, rate: float = 0.05) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) of P(grade <= j) = sigmoid(threshold_j - weights x), with one weight vector for all thresholds.

    Thresholds stay in order, as the differences are exponentials. Full gradients of the mean log likelihood with a ridge penalty, by Adam;
    grades are weighted so that they count by their shares among all labels, whatever the sample's are.
    """
    n, n_grades = len(grades), len(shares)
    weight = (shares / np.maximum(np.bincount(grades, minlength=n_grades), 1))[grades]
    p = np.zeros(n_features + n_grades - 1)
    p[n_features] = 1.0
    m, v = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, steps + 1):
        w, raw = p[:n_features], p[n_features:]
        theta = np.cumsum(np.concatenate((raw[:1], np.exp(raw[1:]))))
        score = np.bincount(row, values * w[at], minlength=n)
        upper = np.concatenate((theta, [np.inf]))[grades] - score
        lower = np.concatenate(([-np.inf], theta))[grades] - score
        high, low = np.where(np.isinf(upper), 1.0, _sigmoid(upper)), np.where(np.isinf(lower), 0.0, _sigmoid(lower))
        gap = np.maximum(high - low, 1e-12)
        d_high, d_low = high * (1 - high) / gap * weight, low * (1 - low) / gap * weight
        g_score = d_high - d_low
        g_theta = np.zeros(n_grades - 1)
        inside = grades < n_grades - 1
        np.add.at(g_theta, grades[inside], -d_high[inside])
        np.add.at(g_theta, grades[grades > 0] - 1, d_low[grades > 0])
        g_raw = np.cumsum(g_theta[::-1])[::-1].copy()
        g_raw[1:] *= np.exp(raw[1:])
        g = np.concatenate((np.bincount(at, values * g_score[row], minlength=n_features) + decay * w, g_raw))
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    raw = p[n_features:]
    return p[:n_features], np.cumsum(np.concatenate((raw[:1], np.exp(raw[1:]))))


def train(docs: DataFrame, grades: DataFrame, per_grade: int = SAMPLE_PER_GRADE) -> Model:
    """A model from a bounded sample of labelled rows: at most per_grade rows of each grade.

    The ids of the sample are at most MOST_GRADES x per_grade rows and are broadcast; what reaches the driver is the chosen keys and
    the sample's values of them. Without rows above grade 0, or without any, there are no weights.
    """
    small_batches(docs.sparkSession)
    graded = staged(grades.where(F.col("grade").between(0, MOST_GRADES - 1)))
    found = sorted(r[0] for r in graded.select("grade").distinct().collect())
    if not found or found[-1] == 0:
        return Model({}, [], [35.0])
    order = F.xxhash64("doc_id")
    chosen = reduce(DataFrame.unionByName, [graded.where(F.col("grade") == g).orderBy(order, "doc_id").limit(per_grade) for g in found])
    texts = staged(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "grade"))
    totals = {r[0]: r[1] for r in texts.groupBy((F.col("grade") > 0).alias("t")).count().collect()}
    bad, good = totals.get(True, 0), totals.get(False, 0)
    counts = texts.mapInArrow(_counts, "key string, good bigint, bad bigint").groupBy("key").agg(F.sum("good").alias("g"), F.sum("bad").alias("b"))
    # Only keys that go with higher grades: counter-evidence of harmless words would let a long text hide an insult.
    expected = (F.col("b") + F.col("g")) * F.lit(bad / max(1, bad + good))
    rated = counts.where(F.col("b") >= LEAST_TEXTS).withColumn("chi2", (F.col("b") - expected) ** 2 / expected).where(F.col("b") > expected)
    keys = [r[0] for r in rated.where(F.col("chi2") >= LEAST_CHI2).orderBy(F.desc("chi2"), "key").limit(MOST_KEYS).collect()]
    vocabulary = {k: i for i, k in enumerate(keys)}
    rows = texts.mapInArrow(_vectors(vocabulary), "grade int, at array<int>, values array<double>").collect()
    row = np.repeat(np.arange(len(rows)), [len(r[1]) for r in rows])
    flat = lambda k, kind: np.array([x for r in rows for x in r[k]], kind)
    numbers = {r[0]: r[1] for r in graded.groupBy("grade").count().collect()}
    shares = np.array([numbers.get(g, 0) for g in range(found[-1] + 1)]) / sum(numbers.values())
    weights, thresholds = fit_ordinal(np.array([r[0] for r in rows], np.int64), row, flat(1, np.int64), flat(2, float), 2 * len(keys), shares)
    return Model(vocabulary, [float(w) for w in weights], [float(t) for t in thresholds])


class Model(NamedTuple):
    """What was learned: the place of each key, two weights a key, and the thresholds between grades."""

    vocabulary: dict[str, int]
    weights: list[float]
    thresholds: list[float]


def _predict(model: Model):
    edges, weights = np.array(model.thresholds), model.weights

    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        read = _reader(model.vocabulary)
        for batch in batches:
            scores = np.array([sum(weights[k] * x for k, x in read(t)) for t in batch.to_pylist()], float)
            above = 1.0 - _sigmoid(edges[None, :] - scores[:, None])
            whole = np.concatenate((np.ones((len(batch), 1)), above, np.zeros((len(batch), 1))), axis=1)
            grade = np.argmax(whole[:, :-1] - whole[:, 1:], axis=1) if len(batch) else np.zeros(0, int)
            columns = [pa.array(above.sum(axis=1)), pa.array(above[:, 0]), pa.array(grade, pa.int32())]
            yield pa.StructArray.from_arrays(columns, ["expected_severity", "p_toxic", "grade"])

    return predict


def score_toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of docs: doc_id, expected_severity, p_toxic, grade (the likeliest), toxic (p_toxic of one half or more).

    The expected severity is the sum of the chances to pass each threshold. Null and empty texts have no features and get the grade of a
    text without any. Repeated rows come back as often as given, an empty table gives an empty result, and columns that are
    not named are never read. No shuffle.
    """
    small_batches(docs.sparkSession)
    found = F.arrow_udf(_predict(model), "struct<expected_severity: double, p_toxic: double, grade: int>")(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("doc_id"), found.alias("found")).select("doc_id", "found.*")
    return rows.withColumn("toxic", F.col("p_toxic") >= 0.5)
