"""Bounded samples of labelled rows, and small fits on them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.stages import fold


def sampled_labels(labels: DataFrame, mark: str, train: Column, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, label) of about ``per_class`` training rows of each label, chosen by a hash of the id, and all rows' counts.

    Only the labels are read. The sample grows to its bound and no further, so it may be broadcast.
    Rows without id or with a label other than 0 and 1 are not used.
    """
    known = labels.select("doc_id", F.col(mark).cast("int").alias("label")).filter(
        F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & train
    )
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    unit = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("sample")), F.lit(1 << 40)) / float(1 << 40)
    share = F.when(F.col("label") == 1, min(1.0, per_class / max(counts.get(1, 0), 1))).otherwise(
        min(1.0, per_class / max(counts.get(0, 0), 1))
    )
    return known.filter(unit < share).dropDuplicates(["doc_id"]), counts


def with_sample(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """(doc_id, text, label) of sampled documents; the sample has a fixed bound, so it goes to every task."""
    ids = F.broadcast(sample.select(F.col("doc_id").alias("_id"), "label"))
    return docs.select("doc_id", "text").join(ids, F.col("doc_id") == F.col("_id")).select("doc_id", "text", "label")


def train_fold(parts: int, held_out: int) -> Column:
    return fold("doc_id", parts) != held_out


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, ridge: float = 1.0, rounds: int = 30):
    """Coefficients of a ridge logistic regression by Newton's method; the last column of ``x`` may be ones."""
    w = np.zeros(x.shape[1])
    weight = np.ones(len(y)) if weight is None else weight
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(
            (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1]), x.T @ (weight * (y - p)) - ridge * w
        )
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))
