"""A quality score from positive and unlabelled texts, by the non-negative risk estimator.

Trusted texts (label 1) are the positives; texts taken from the table at large, whatever their label,
stand for the unlabelled web.  With class prior p the risk is
    p R+(P)  +  max(0, R-(U) - p R-(P)),
and where the second part turns negative the step goes against it instead, so a flexible model does
not profit from pushing trusted texts out.  The prior is estimated from the same two samples: a logistic
model of positives against unlabelled texts gives the ratio of their densities, which is 1 / p wherever no
negative lies, so p is one over the ratio's median among the positives.  No negative label is read.  The model is logistic in the features of text_stats.doc_features and their squares.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import crc_fold, id_text, slices
from starloom.llm.text_stats import DOC_FEATURES, doc_features

TRUSTED, UNLABELLED = 6000, 12000
FOLDS, HELD = 4, 2


@dataclass(frozen=True)
class QualityModel:
    weights: np.ndarray
    prior: float

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(expand(features) @ self.weights, -30, 30)))


def expand(x: np.ndarray) -> np.ndarray:
    return np.hstack([x, x[:, 1:] ** 2])


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, rounds: int = 1500, rate: float = 0.05, decay: float = 2e-4) -> QualityModel:
    """Non-negative positive-unlabelled risk with the logistic loss, full batches, Adam steps."""
    k = 2 * len(DOC_FEATURES) - 1
    w = np.zeros(k)
    w[0] = np.log(prior / (1 - prior)) if 0 < prior < 1 else 2.0
    if not len(positive) or not len(unlabelled):
        return QualityModel(w, prior)
    p, u = expand(positive), expand(unlabelled)
    v, s = np.zeros(k), np.zeros(k)
    for it in range(1, rounds + 1):
        zp, zu = p @ w, u @ w
        up, uu = 1 / (1 + np.exp(-np.clip(zp, -30, 30))), 1 / (1 + np.exp(-np.clip(zu, -30, 30)))
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        grad_negative = u.T @ uu / len(u) - prior * (p.T @ up / len(p))
        g = -grad_negative if negative < 0 else prior * (p.T @ (up - 1) / len(p)) + grad_negative
        g = g + decay * np.concatenate([[0.0], w[1:]])
        v, s = 0.9 * v + 0.1 * g, 0.999 * s + 0.001 * g * g
        w = w - rate * (v / (1 - 0.9**it)) / (np.sqrt(s / (1 - 0.999**it)) + 1e-8)
    return QualityModel(w, prior)


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, ridge: float = 1e-3) -> float:
    """The share of positives among the unlabelled, from the density ratio at the positives; 0.5 without either."""
    if not len(positive) or not len(unlabelled):
        return 0.5
    x = expand(np.concatenate([positive, unlabelled]))
    y = np.repeat([1.0, 0.0], [len(positive), len(unlabelled)])
    w = np.zeros(x.shape[1])
    for _ in range(25):  # Newton steps
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w -= np.linalg.solve((x * (q * (1 - q))[:, None]).T @ x / len(x) + ridge * np.eye(len(w)), x.T @ (q - y) / len(x) + ridge * w)
    ratio = np.exp(np.clip(expand(positive) @ w, -30, 30)) * len(unlabelled) / len(positive)
    return float(np.clip(1 / np.median(ratio), 0.02, 0.98))


def _features(texts: DataFrame, keep: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = [np.array(doc_features(t), dtype=np.float64).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.record_batch([batch.column("doc_id"), batch.column(keep), pa.array(x, pa.binary())], names=["doc_id", keep, "x"])

    return texts.select("doc_id", keep, "text").mapInArrow(run, f"doc_id long, {keep} int, x binary")


def train(docs: DataFrame, labels: DataFrame, trusted: int = TRUSTED, unlabelled: int = UNLABELLED, folds: int = FOLDS, held: int = HELD) -> QualityModel:
    """Fit on at most ``trusted`` positives and ``unlabelled`` texts, both first in hash order.

    Only labels of documents outside the held-out fold are read, and of those only which are
    positive; the unlabelled texts are drawn from the same folds without their labels.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").alias("q")).where(F.col("doc_id").isNotNull() & F.col("q").isin(0, 1) & (crc_fold("doc_id", folds) != held))
    some = known.where("q = 1").select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(trusted).withColumn("kind", F.lit(1))
    other = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where(crc_fold("doc_id", folds) != held).orderBy(F.xxhash64("doc_id", F.lit(7)), "doc_id").limit(unlabelled).withColumn("kind", F.lit(0))
    drawn = F.broadcast(some.unionByName(other).distinct())  # at most trusted + unlabelled ids
    got = _features(id_text(docs).join(drawn, "doc_id"), "kind").collect()
    got.sort(key=lambda r: (r.doc_id, r.kind, r.x))
    rows = {v: np.array([np.frombuffer(r.x) for r in got if r.kind == v]).reshape(-1, len(DOC_FEATURES)) for v in (0, 1)}
    return fit(rows[1], rows[0], estimate_prior(rows[1], rows[0]))


def score(docs: DataFrame, model: QualityModel, threshold: float = 0.7, folds: int = FOLDS, held: int = HELD) -> DataFrame:
    """doc_id, held_out, score, predicted for every text; null and empty texts are scored as empty.

    Texts are read whole whatever their length; a score of exactly the threshold counts as 1; repeated rows repeat.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            s = model.score(np.array([doc_features(t) for t in batch.column("text").to_pylist()]))
            yield pa.record_batch([batch.column("doc_id"), pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32), pa.int32())], names=["doc_id", "score", "predicted"])

    scored = id_text(docs).mapInArrow(run, "doc_id long, score double, predicted int")
    return scored.select("doc_id", F.coalesce(crc_fold("doc_id", folds) == held, F.lit(False)).alias("held_out"), "score", "predicted")
