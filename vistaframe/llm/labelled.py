"""Labelled documents for the classifiers: a bounded sample that leaves out the held-out fold."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vistaframe.llm.common import held_out

#: Labelled documents that a classifier learns from, at most: the first by hash of their id.
SAMPLE = 4000


def sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, fold: int, size: int = SAMPLE) -> list[tuple[bytes, int, str | None]]:
    """(text, label, language) of at most size documents that have a label and aren't held out; the language is for thresholds only.

    A doc_id that is labelled both 0 and 1 isn't learnt from; of several texts of one doc_id the smallest is.
    """
    named = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), folds, fold))
    agreed = named.groupBy("doc_id").agg(F.min(label).alias("_label"), F.max(label).alias("_most")).where("_label = _most").drop("_most")
    chosen = agreed.orderBy(F.xxhash64("doc_id"), "doc_id").limit(size)
    language = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    rows = docs.select("doc_id", F.col("text").cast("binary"), language.alias("lang")).join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "_label", "lang")
    rows = rows.groupBy("doc_id").agg(F.min(F.struct("text", "_label", "lang")).alias("r")).orderBy("doc_id").collect()
    return [(bytes(r["r"]["text"] or b""), r["r"]["_label"], r["r"]["lang"]) for r in rows]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def platt(z: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """a > 0 and b of the logistic sigmoid(a z + b) that fits labels y, by damped Newton steps with a weak prior."""
    a, b = 1.0, 0.0
    for _ in range(rounds):
        p = sigmoid(a * z + b)
        g = np.array([np.sum((p - y) * z) + 1e-2 * (a - 1), np.sum(p - y) + 1e-2 * b])
        w = p * (1 - p) + 1e-6
        h = np.array([[np.sum(w * z * z) + 1e-2, np.sum(w * z)], [np.sum(w * z), np.sum(w) + 1e-2]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 2.0 / max(1e-9, float(np.abs(step).max())))
        a, b = max(1e-3, a - step[0]), b - step[1]
    return float(a), float(b)
