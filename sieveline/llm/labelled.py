"""The bounded sample of labelled rows that a classifier is fitted on, and calibration."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.llm.common import held_out, only
from sieveline.storage import cut

SAMPLE = 8_000


def training_rows(docs: DataFrame, labels: DataFrame, target: str, bound: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(text, y, part)`` of at most ``bound`` labelled ids that aren't held out, the first by a hash of the id.

    ``part`` (0 to 9) deals the rows into fitting and calibration. An id with several labels
    has the largest; ids and labels that are null are left out. The ids, bounded, are
    broadcast, and the rows are written once, so the documents are read once.
    """
    ids = only(labels, id_col, target).select(F.col(id_col).alias("doc_id"), F.col(target).alias("y")).where(~held_out() & F.col("y").isNotNull())
    ids = cut(ids.groupBy("doc_id").agg(F.max("y").alias("y")))
    share = min(1.0, 2 * bound / max(1, ids.count()))
    # Hashes are even, so twice as many as are wanted lie below this one: the order is worked out for these alone.
    low = ids.where(F.xxhash64("doc_id") <= F.lit(min((1 << 63) - 1, int(share * 2.0**64) - (1 << 63)))) if share < 1 else ids
    ids = low.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    part = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(10)).cast("int").alias("part")
    texts = only(docs, id_col, text_col).toDF("doc_id", "text")
    return cut(texts.join(F.broadcast(ids), "doc_id").select(F.coalesce("text", F.lit("")).alias("text"), F.col("y").cast("int").alias("y"), part))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def platt(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of the logistic curve through (margin, label), by Newton's method with a small ridge."""
    x = np.stack([margins, np.ones(len(margins))], axis=1)
    # Targets drawn in a little, as few margins may be perfectly split.
    n1, n0 = y.sum(), (1 - y).sum()
    t = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (p - t) + 1e-6 * w)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pooled adjacent violators: steps (x ascending) and their rising values, drawn in from 0 and 1."""
    order = np.argsort(x, kind="stable")
    xs, first = np.unique(x[order], return_index=True)
    sums = np.add.reduceat(y[order].astype(float), first)
    counts = np.diff(np.append(first, len(x))).astype(float)
    blocks: list[list[float]] = []
    for at, s, n in zip(xs, sums, counts):
        blocks.append([at, s, n])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            _, s2, n2 = blocks.pop()
            blocks[-1][1] += s2
            blocks[-1][2] += n2
    b = np.array(blocks)
    return b[:, 0], (b[:, 1] + 0.5) / (b[:, 2] + 1)
