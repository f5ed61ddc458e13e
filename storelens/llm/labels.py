"""Bounded samples of labelled documents and logistic regression, for the learned scores."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Labelled rows that a model is fitted on.
SAMPLE_ROWS = 20_000


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves ``fold``; null ids count as the text ``null``."""
    text = F.coalesce(doc_id.cast("string"), F.lit("null"))
    return F.crc32(text.cast("binary")) % folds == fold


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, folds: int, fold: int,
                    rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id, text, label`` of about ``rows`` labelled documents that are not held out, chosen by
    a hash of their id. Ids with several labels count as 1 if any label is."""
    known = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("doc_id"), folds, fold))
        .groupBy("doc_id").agg(F.max("label").alias("label"))
    )
    step = max(1, -(-known.count() // rows))
    # About ``rows`` ids, each sent to every task.
    drawn = known.filter(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(step)) == 0)
    return documents.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Weights and, last, the intercept of a logistic regression, by Newton's method."""
    design = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    weights = np.zeros(design.shape[1])
    penalty = ridge * np.eye(design.shape[1])
    penalty[-1, -1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        gradient = design.T @ (p - y) + penalty @ weights
        hessian = (design * (p * (1 - p))[:, None]).T @ design + penalty
        step = np.linalg.solve(hessian, gradient)
        weights -= step * min(1.0, 5.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return weights
