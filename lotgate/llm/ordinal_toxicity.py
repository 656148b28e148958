"""Toxicity severity by cumulative-link ordinal regression.

Grades are ordered, 0 (clean) to K. One weight vector over hashed words and
their stems is
shared by all thresholds: ``P(grade > j) = sigmoid(w.x - t_j)`` with
``t_0 < t_1 < ...`` (kept ordered by ``t_j = t_0 + sum exp(g_i)``). A text's
expected severity is the sum of these probabilities.

The model is fitted on a bounded sample of graded documents (*sample* rows, in
order of a hash of the id), by Adam on the whole sample with an L2 penalty; the
sample's features are all that reaches the driver. Every document is scored,
in one pass without a shuffle, with the weights as a broadcast of fixed size.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import column, text_blocks
from .features import hashed_grams

BUCKETS = 1 << 18
SAMPLE = 8000
STEMS = (4, 6)  # first bytes of words, for inflected or joined forms
MIN_DOCS = 10
STEPS, RATE, PENALTY = 200, 0.1, 2e-4
TOXIC = 0.3  # p_toxic from which a text is called toxic


@dataclass
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray

    def exceed(self, scores: np.ndarray) -> np.ndarray:
        """(rows, thresholds): the probability of a grade above each."""
        return 1 / (1 + np.exp(-np.clip(scores[:, None] - self.thresholds, -40, 40)))


def fit(doc: np.ndarray, bucket: np.ndarray, value: np.ndarray, grade: np.ndarray, buckets: int = BUCKETS) -> OrdinalModel:
    """Fit on sparse entries (document number, bucket, value) and grades."""
    top = max(1, int(grade.max(initial=0)))
    frequent = np.bincount(bucket, minlength=buckets) >= MIN_DOCS
    used = np.flatnonzero(frequent)
    number = np.zeros(buckets, np.int64)
    number[used] = np.arange(len(used))
    keep = frequent[bucket]
    doc, feature, value = doc[keep], number[bucket[keep]], value[keep]
    n = max(1, len(grade))
    share = np.array([(np.sum(grade > j) + 0.5) / (n + 1) for j in range(top)])
    start = np.maximum.accumulate(-np.log(share / (1 - share)) + 1e-3 * np.arange(top))
    theta = np.concatenate([np.zeros(len(used)), start[:1], np.log(np.maximum(np.diff(start), 1e-3))])
    first, second = np.zeros_like(theta), np.zeros_like(theta)

    def thresholds(x):
        return x[len(used)] + np.append(0, np.cumsum(np.exp(x[len(used) + 1:])))

    for step in range(1, STEPS + 1):
        w, t = theta[:len(used)], thresholds(theta)
        score = np.bincount(doc, w[feature] * value, n)
        above = 1 / (1 + np.exp(-np.clip(score[:, None] - t, -40, 40)))
        edge = np.concatenate([np.ones((n, 1)), above, np.zeros((n, 1))], 1)
        slope = edge * (1 - edge)
        rows = np.arange(n) if len(grade) else np.zeros(0, int)
        p = np.maximum(edge[rows, grade] - edge[rows, grade + 1], 1e-12)
        # d log P / d score, and through each threshold with the opposite sign.
        d_score = (slope[rows, grade] - slope[rows, grade + 1]) / p
        d_t = np.array([-np.sum(np.where(grade == j + 1, slope[rows, grade] / p, 0) - np.where(grade == j, slope[rows, grade + 1] / p, 0)) for j in range(top)])
        gradient = np.zeros_like(theta)
        gradient[:len(used)] = np.bincount(feature, d_score[doc] * value, len(used)) / n - PENALTY * w
        gradient[len(used)] = d_t.sum() / n
        for j in range(1, top):
            gradient[len(used) + j] = d_t[j:].sum() / n * np.exp(theta[len(used) + j])
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient * gradient
        theta = theta + RATE * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    weights = np.zeros(buckets)
    weights[used] = theta[:len(used)]
    return OrdinalModel(weights, thresholds(theta))


def _entries(texts: list[bytes], buckets: int):
    """(document, bucket, log(1 + count)) of each distinct hashed word or stem."""
    doc, bucket = hashed_grams(texts, buckets, (1,), stems=STEMS)
    pair, count = np.unique(doc * buckets + bucket, return_counts=True)
    return pair // buckets, pair % buckets, np.log1p(count)


def _features(buckets: int):
    def run(batches):
        for batch, texts in text_blocks(batches):
            doc, bucket, value = _entries(texts, buckets)
            cut = np.searchsorted(doc, np.arange(len(texts) + 1))
            yield pa.RecordBatch.from_arrays([
                column(batch, "doc_id"), column(batch, "grade"),
                pa.array([bucket[a:b].astype(np.int32).tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary()),
                pa.array([value[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary())], ["doc_id", "grade", "buckets", "values"])
    return run


def _score(model, buckets: int):
    def run(batches):
        m = model.value
        for batch, texts in text_blocks(batches):
            doc, bucket, value = _entries(texts, buckets)
            above = m.exceed(np.bincount(doc, m.weights[bucket] * value, len(texts)))
            p = -np.diff(np.concatenate([np.ones((len(above), 1)), above, np.zeros((len(above), 1))], 1), axis=1)
            yield pa.RecordBatch.from_arrays([
                column(batch, "doc_id"), pa.array(above.sum(1)), pa.array(p.argmax(1).astype(np.int32)), pa.array(above[:, 0]),
                pa.array(above[:, 0] >= TOXIC)], ["doc_id", "severity", "grade", "p_toxic", "toxic"])
    return run


def toxic_grades(rows: list[tuple[int, np.ndarray]], buckets: int = BUCKETS) -> np.ndarray:
    """Grades 0, 1, 2 for (toxic 0/1, distinct buckets) rows whose labels know
    only toxic or not: buckets that are far commoner in toxic rows mark
    severity, and toxic rows with more marks than the median are grade 2."""
    toxic = np.array([t for t, _ in rows], bool)
    count = [sum((np.bincount(b, minlength=buckets) for t, b in rows if bool(t) == kind), np.zeros(buckets, np.int64)) for kind in (False, True)]
    odds = (count[1] + 0.1) / (toxic.sum() + 1) / ((count[0] + 0.1) / ((~toxic).sum() + 1))
    mark = (count[1] >= max(MIN_DOCS, toxic.sum() // 50)) & (odds > 20)
    marks = np.array([mark[b].sum() for _, b in rows])
    median = np.median(marks[toxic]) if toxic.any() else 0
    return np.where(toxic, 1 + (marks > median), 0).astype(np.int64)


def severity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, severity, grade, p_toxic, toxic) for each row of *docs* (doc_id,
    text), learned from *labels* (doc_id, and grade 0..K or toxic 0/1).

    severity is the expected grade, grade the likeliest, p_toxic the
    probability of any grade above 0. A null text has no words and gets the
    base rate; null ids, grades or labels train nothing; of repeated labels of
    a document the highest counts, and rows with equal doc_id train as one. Equal texts get equal results. Without
    labels every text gets the same low severity. An empty table gives no rows.
    """
    spark = docs.sparkSession
    graded = "grade" in labels.columns
    given = (labels.select("doc_id", F.col("grade" if graded else "toxic").cast("int").alias("grade")).dropna()
             .groupBy("doc_id").agg(F.max("grade").alias("grade")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    # The sample is bounded by its parameter, so it is broadcast to the scan; of
    # the rows of an id that text stays whose hash is least.
    rows = (texts.join(F.broadcast(given.withColumn("doc_id", F.col("doc_id").cast("long"))), "doc_id")
            .groupBy("doc_id", "grade").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least"))
            .select("doc_id", "grade", "least.text").mapInArrow(_features(buckets), "doc_id long, grade int, buckets binary, values binary").collect())
    rows.sort(key=lambda r: (r["doc_id"], r["buckets"]))
    found = [np.frombuffer(r["buckets"], np.int32).astype(np.int64) for r in rows]
    grade = np.array([r["grade"] for r in rows], np.int64)
    if not graded:
        grade = toxic_grades(list(zip(grade, found)), buckets)
    model = fit(np.repeat(np.arange(len(rows)), [len(x) for x in found]), np.concatenate([np.zeros(0, np.int64), *found]),
                np.concatenate([np.zeros(0), *(np.frombuffer(r["values"]) for r in rows)]), grade, buckets)
    return texts.mapInArrow(_score(spark.sparkContext.broadcast(model), buckets),
                            "doc_id long, severity double, grade int, p_toxic double, toxic boolean")
