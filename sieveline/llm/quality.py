"""Quality classifier: naive Bayes support vectors.

A text's features are indicators of its n-grams: three bytes (hashed), six character
classes, and how words follow on one another. Each indicator is scaled by the log ratio
of its smoothed counts in the two classes; a linear model with hinge loss is fitted on
the scaled features by dual coordinate descent, and its margins become probabilities
through a logistic curve fitted on rows kept for that.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.llm.common import held_out, only, pieces_of
from sieveline.llm.labelled import SAMPLE, platt, sigmoid, training_rows

BYTE_GRAMS, CLASS_GRAMS = 1 << 17, 1 << 18
EXTRA = BYTE_GRAMS + CLASS_GRAMS
DIM = EXTRA + 64
THRESHOLD = 0.3
#: Character classes: 0 lower, 1 upper, 2 digit, 3 space, 4 other white space, 5 common marks, 6 other ASCII, 7 beyond ASCII.
CLASS = np.full(256, 6, dtype=np.uint32)
for _name, _chars in ((0, b"abcdefghijklmnopqrstuvwxyz"), (1, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (2, b"0123456789"), (3, b" "), (4, b"\t\n\r\x0b\x0c"), (5, b".,;:'\"-()?")):
    CLASS[list(_chars)] = _name
CLASS[128:] = 7


def active(text: str, held: np.ndarray) -> np.ndarray:
    """The numbers of the text's features. ``held``: DIM flags, all false before and after."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    for i in range(0, len(data), 1 << 20):
        part = data[i : i + (1 << 20) + 5].astype(np.uint32)
        if len(part) > 2:
            three = part[:-2] | part[1:-1] << np.uint32(8) | part[2:] << np.uint32(16)
            held[(three * np.uint32(2654435761)) >> np.uint32(15)] = True
        if len(part) > 5:
            c = CLASS[part]
            six = c[:-5]
            for k in range(1, 6):
                six = six << np.uint32(3) | c[k : len(c) - 5 + k]
            held[six + np.uint32(BYTE_GRAMS)] = True
    words = text.split()
    if words:
        same = sum(map(eq, words, words[1:])) / len(words)
        held[EXTRA + min(10, int(same * 20))] = True
        held[EXTRA + 16 + min(12, len(words).bit_length())] = True
        held[EXTRA + 32 + min(15, int(sum(map(len, words)) / len(words)))] = True
    found = np.flatnonzero(held)
    held[found] = False
    return found.astype(np.int32)


def fit(rows: list[np.ndarray], y: np.ndarray, calibrate: np.ndarray, smooth: float = 1.0, c: float = 1.0, epochs: int = 8, seed: int = 17) -> tuple[np.ndarray, float, float]:
    """Weights over the indicators, and the slope and intercept of the logistic curve."""
    prior = float(y.mean()) if len(y) else 0.5
    constant = (np.zeros(DIM, np.float32), 0.0, float(np.log((prior + 1e-3) / (1 - prior + 1e-3))))
    use = np.flatnonzero(~calibrate)
    if len(use) < 10 or len(np.unique(y[use])) < 2 or len(np.unique(y[calibrate])) < 2:
        return constant
    p, q = np.full(DIM, smooth), np.full(DIM, smooth)
    for i in use:
        (p if y[i] else q)[rows[i]] += 1
    ratio = np.log(p / p.sum()) - np.log(q / q.sum())
    values = [ratio[r] / max(1e-9, np.linalg.norm(ratio[r])) for r in rows]
    sign = np.where(y == 1, 1.0, -1.0)
    weight = np.where(y == 1, 0.5 / max(1e-9, y[use].mean()), 0.5 / max(1e-9, 1 - y[use].mean())) * c
    w, alpha, bias = np.zeros(DIM), np.zeros(len(rows)), 0.0
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(use):
            r, v = rows[i], values[i]
            gradient = sign[i] * (w[r] @ v + bias) - 1
            new = min(max(alpha[i] - gradient / 2, 0.0), weight[i])  # the row's norm and its bias are both 1
            if new != alpha[i]:
                step = (new - alpha[i]) * sign[i]
                w[r] += step * v
                bias += step
                alpha[i] = new
    scaled = (w * ratio).astype(np.float32)
    margin = np.array([_margin(r, scaled, ratio.astype(np.float32)) + bias for r in rows])
    slope, intercept = platt(margin[calibrate], y[calibrate])
    # The bias is the same for all texts, so it goes into the intercept.
    return np.stack([scaled, ratio.astype(np.float32)]), slope, intercept + slope * bias


def _margin(r: np.ndarray, scaled: np.ndarray, ratio: np.ndarray) -> float:
    return float(scaled[r].sum(dtype=np.float64) / max(1e-9, float(np.linalg.norm(ratio[r]))))


def train(docs: DataFrame, labels: DataFrame, target: str = "quality", bound: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> tuple[np.ndarray, float, float]:
    """The model, fitted on at most ``bound`` labelled rows that aren't held out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(DIM, dtype=bool)
        for part in pieces_of(batches, 0, 8 << 20):
            yield pa.RecordBatch.from_arrays([pa.array([active(t, held).tobytes() for t in part.column(0).to_pylist()], pa.binary()), part.column(1), part.column(2)], names=["x", "y", "part"])

    got = training_rows(docs, labels, target, bound, id_col, text_col).mapInArrow(run, "x binary, y int, part int").toPandas()
    rows = [np.frombuffer(x, dtype=np.int32) for x in got["x"]]
    y, part = got["y"].to_numpy(np.int64), got["part"].to_numpy(np.int64)
    order = sorted(range(len(rows)), key=lambda i: (rows[i].tobytes(), y[i], part[i]))  # the same model whatever order the rows came in
    return fit([rows[i] for i in order], y[order], part[order] >= 8)


def scored(docs: DataFrame, model: tuple[np.ndarray, float, float], threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every row.

    Null and empty texts have no features and get the score of the intercept. Repeated rows
    get the same score each; an empty table gives an empty result.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    weights, slope, intercept = model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(DIM, dtype=bool)
        for part in pieces_of(batches, 1, 2 << 20):
            texts = part.column(1).to_pylist()
            margin = np.array([_margin(active(t or "", held), *weights) for t in texts]) if weights.ndim == 2 else np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sigmoid(slope * margin + intercept))], names=["doc_id", "score"])

    out = only(docs, id_col, text_col).mapInArrow(run, f"doc_id {kind}, score double")
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def classified(docs: DataFrame, labels: DataFrame, target: str = "quality", threshold: float = THRESHOLD, bound: int = SAMPLE) -> DataFrame:
    """:func:`scored` by the model of :func:`train`. Without labels of both kinds every row has the score of the prior, 0.5 without any."""
    return scored(docs, train(docs, labels, target, bound), threshold)


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, bound: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, all columns, without the rows that the classifier rejects.

    A null text counts as empty; rows are judged by their text alone, so equal ones go or
    stay alike. An empty table stays empty.
    """
    weights, slope, intercept = train(docs, labels, "quality", bound, id_col, text_col)
    names = docs.columns
    at = names.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(DIM, dtype=bool)
        for part in pieces_of(batches, at, 2 << 20):
            texts = part.column(at).to_pylist()
            margin = np.array([_margin(active(t or "", held), *weights) for t in texts]) if weights.ndim == 2 else np.zeros(len(texts))
            yield part.filter(pa.array(sigmoid(slope * margin + intercept) >= threshold))

    return docs.mapInArrow(keep, docs.schema)
