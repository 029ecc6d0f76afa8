"""Labelled samples of bounded size and a logistic curve, for the classifiers that are fitted here."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import picked


def sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-x)) if x >= 0 else math.exp(x) / (1 + math.exp(x))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Newton's method; the ridge keeps the weights finite where the classes part completely."""
    weights = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -35, 35)))
        gradient = x.T @ (y - p) - ridge * weights
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(hessian, gradient)
        weights = weights + step
        if np.abs(step).max() < 1e-9:
            break
    return weights


def sampled(
    df: DataFrame,
    labels: DataFrame,
    label: str,
    learn: Column | None,
    size: int,
    doc_id: str = "doc_id",
    text: str = "text",
    values: Sequence[int] = (0, 1),
) -> DataFrame:
    """(doc_id, text, label): at most ``size`` documents of each label, by the smallest hash of doc_id.

    ``learn`` is a condition on doc_id. The ids are chosen from the label table alone, so no text is
    shuffled; their broadcast is bounded by ``size``.
    """
    known = picked(labels, doc_id=doc_id, label=label).where(
        F.col("doc_id").isNotNull() & F.col("label").isin(list(values))
    )
    if learn is not None:
        known = known.where(learn)
    clear = known.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
    clear = clear.where("label = other").select(F.col("doc_id").alias("of"), "label")
    order = [F.xxhash64("of"), "of"]
    chosen = [clear.where(F.col("label") == v).orderBy(*order).limit(size) for v in values]
    rows = picked(df, doc_id=doc_id, text=text).where("text <> ''")
    few = rows.join(F.broadcast(reduce(DataFrame.unionByName, chosen)), F.col("doc_id") == F.col("of"))
    # of texts under one id the one with the smallest hash, in whichever order they are read
    order = F.struct(F.xxhash64("text"), "text")
    return few.groupBy("doc_id", "label").agg(F.min_by("text", order).alias("text")).select("doc_id", "text", "label")
