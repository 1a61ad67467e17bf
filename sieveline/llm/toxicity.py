"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

Features are densities of a lexicon of insults and of word stems learnt from the labelled
rows, the nearness of second-person words to them, and rates of capitals, punctuation and
obfuscation. Trees are grown on histograms of the features' quantiles.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.llm.common import held_out, only, pieces_of
from sieveline.llm.labelled import isotonic, training_rows

SAMPLE, THRESHOLD = 20_000, 0.5
#: Of the stems that so many toxic rows have and whose log odds are so high, at most so many are learnt.
STEMS, SEEN, ODDS = 400, 8, 2.5
#: General insults, and second-person words of four languages.
LEXICON = frozenset(
    "idiot idiots moron morons stupid dumb trash garbage scum loser losers clown pathetic worthless disgusting filth filthy fool foolish imbecile cretin vermin pig "
    "jerk bastard bitch whore slut shit crap hell damn kill die hate ugly freak coward liar sucker dimwit halfwit nitwit dunce brainless hopeless useless".split()
)
SECOND = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch tu te ton ta tes toi vous votre tú ti tus usted vosotros".split())
WORD = re.compile(r"[^\W_]+(?:[*@$!1-9]+[^\W_]+)*")
HIDDEN = re.compile(r"[^\W\d_]+[*@$!1-9]+[^\W\d_]+|(?<!\w)(?:[^\W\d_][ .\-]){3,}[^\W\d_](?!\w)")
ASCII = re.compile(r"[\x00-\x7f]+")
MARKS, MANY = re.compile(r"[^\w\s]"), re.compile(r"([!?*$#%&])\1")
STEM_LENGTHS = (4, 5, 6, 7, 8)
N_FEATURES = 16


def stems(word: str) -> list[str]:
    return [word[:n] for n in STEM_LENGTHS if len(word) >= n]


def features(text: str, weights: dict[str, float], shortest: frozenset[str]) -> list[float]:
    """``weights``: learnt stems; ``shortest``: their first four letters, which sort out most words."""
    low = text.lower()
    words = WORD.findall(low)
    n = max(1, len(words))
    hits, learnt, best, strong = [], 0.0, 0.0, 0
    kinds = set()
    for i, w in enumerate(words):
        if w in LEXICON:
            hits.append(i)
        if w[:4] in shortest:
            own = max((weights[s] for s in stems(w) if s in weights), default=0.0)
            if own > 0:
                learnt += own
                strong += 1
                kinds.add(w)
                best = max(best, own)
                if not hits or hits[-1] != i:
                    hits.append(i)
    near = sum(any(w in SECOND for w in words[max(0, i - 4) : i + 5]) for i in hits)
    letters = max(1, len(text))
    upper = _capitals(text)
    return [
        len(hits) / n, np.log1p(len(hits)), learnt / n, np.log1p(learnt), best, strong / n, np.log1p(len(kinds)), near / max(1, len(hits)), near / n,
        upper / letters, len(MARKS.findall(text)) / letters, text.count("!") / letters, len(MANY.findall(text)) / n, len(HIDDEN.findall(low)) / n, np.log1p(len(words)), letters / n,
    ]


def _capitals(text: str) -> int:
    """The number of capitals of any alphabet; A to Z are counted as bytes."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    return int(np.count_nonzero((raw >= 65) & (raw <= 90))) + sum(map(str.isupper, ASCII.sub("", text)))


class Trees:
    """Boosted trees on binned features; ``predict`` gives log odds."""

    def __init__(self, rounds: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, least: float = 4.0, ridge: float = 1.0):
        self.rounds, self.depth, self.rate, self.bins, self.least, self.ridge = rounds, depth, rate, bins, least, ridge
        self.edges: list[np.ndarray] = []
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.start = 0.0

    def _bin(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], axis=1)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins)[1:-1])) for j in range(x.shape[1])]
        b = self._bin(x)
        rate = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
        self.start = float(np.log(rate / (1 - rate)))
        f = np.full(len(y), self.start)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-f))
            g, h = y - p, p * (1 - p)
            size = 2 ** (self.depth + 1) - 1
            feature, cut, value = np.full(size, -1), np.zeros(size, int), np.zeros(size)
            node = np.zeros(len(y), int)
            for level in range(self.depth):
                first, n = 2**level - 1, 2**level
                gain = np.zeros(n)
                live = node >= first
                at = node[live] - first
                total_g, total_h = np.bincount(at, g[live], n), np.bincount(at, h[live], n)
                base = total_g**2 / (total_h + self.ridge)
                for j in range(x.shape[1]):
                    k = at * self.bins + b[live, j]
                    left_g = np.bincount(k, g[live], n * self.bins).reshape(n, -1).cumsum(1)[:, :-1]
                    left_h = np.bincount(k, h[live], n * self.bins).reshape(n, -1).cumsum(1)[:, :-1]
                    right_g, right_h = total_g[:, None] - left_g, total_h[:, None] - left_h
                    s = left_g**2 / (left_h + self.ridge) + right_g**2 / (right_h + self.ridge) - base[:, None]
                    s[(left_h < self.least / 4) | (right_h < self.least / 4)] = -1
                    top = s.argmax(1)
                    better = s[np.arange(n), top] > np.maximum(gain, 1e-6)
                    gain[better] = s[np.arange(n), top][better]
                    feature[first : first + n][better], cut[first : first + n][better] = j, top[better]
                split = live & (feature[node] >= 0)
                rows = np.flatnonzero(split)
                own = node[rows]
                node[rows] = 2 * own + 1 + (b[rows, feature[own]] > cut[own])
            value = np.bincount(node, g, size) / (np.bincount(node, h, size) + self.ridge) * self.rate
            self.trees.append((feature, cut, value))
            f += value[node]
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        f = np.full(len(x), self.start)
        if not len(x) or not self.trees:
            return f
        b = self._bin(x)
        rows = np.arange(len(x))
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), int)
            for _ in range(self.depth):
                j = feature[node]
                node = np.where(j >= 0, 2 * node + 1 + (b[rows, np.maximum(j, 0)] > cut[node]), node)
            f += value[node]
        return f


def learn_stems(rows: DataFrame, most: int = STEMS, seen: int = SEEN, odds: float = ODDS) -> dict[str, float]:
    """Stems that toxic rows have far oftener than others, with their log odds. Counts cover all of ``rows``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces_of(batches, 0, 4 << 20):
            own = [({s for w in set(WORD.findall(t.lower())) for s in stems(w)}, y) for t, y in zip(part.column(0).to_pylist(), part.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array([s for o, _ in own for s in o], pa.string()), pa.array([y for o, y in own for _ in o], pa.int32())], names=["stem", "y"])

    totals = rows.agg(F.sum("y"), F.count(F.lit(1))).first()
    bad, good = (totals[0] or 0), totals[1] - (totals[0] or 0)
    if not bad or not good:
        return {}
    counted = rows.select("text", "y").mapInArrow(run, "stem string, y int").groupBy("stem").agg(F.sum("y").alias("a"), F.count(F.lit(1)).alias("n"))
    value = F.log((F.col("a") + 0.5) / (bad + 1)) - F.log((F.col("n") - F.col("a") + 0.5) / (good + 1))
    kept = counted.where(F.col("a") >= seen).withColumn("value", value).where(F.col("value") >= odds).orderBy(F.desc(F.col("value") * F.sqrt("a")), "stem").limit(most)
    return {r["stem"]: float(r["value"]) for r in kept.select("stem", "value").collect()}


def train(docs: DataFrame, labels: DataFrame, target: str = "toxic", bound: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> dict:
    """The model, fitted on at most ``bound`` labelled rows that aren't held out.

    Stems are learnt on parts 0 to 4 of the rows, trees on 5 to 7, the calibration on 8 and
    9, so that no step sees the features of rows that an earlier one has learnt by heart.
    """
    rows = training_rows(docs, labels, target, bound, id_col, text_col)
    weights = learn_stems(rows.where("part < 5"))
    shortest = frozenset(s[:4] for s in weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces_of(batches, 0, 4 << 20):
            x = [np.array(features(t, weights, shortest)).tobytes() for t in part.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()), part.column(1), part.column(2)], names=["x", "y", "part"])

    got = rows.where("part >= 5").mapInArrow(run, "x binary, y int, part int").toPandas()
    x = np.array([np.frombuffer(r) for r in got["x"]]).reshape(-1, N_FEATURES)
    y, part = got["y"].to_numpy(np.int64), got["part"].to_numpy(np.int64)
    order = np.lexsort((*x.T, y, part))
    x, y, part = x[order], y[order], part[order]
    trees = Trees()
    if len(np.unique(y[part < 8])) == 2 and (part >= 8).any():
        trees.fit(x[part < 8], y[part < 8])
        curve = isotonic(trees.predict(x[part >= 8]), y[part >= 8])
    else:
        prior = (float(y.sum()) + 0.5) / (len(y) + 1)
        curve = (np.array([0.0]), np.array([prior]))
    return {"weights": weights, "shortest": shortest, "trees": trees, "curve": curve}


def calibrated(log_odds: np.ndarray, curve: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The curve's value at each point, in straight lines between its steps; the log odds break ties within one."""
    steps, values = curve
    return np.clip(np.interp(log_odds, steps, values) + 1e-6 * np.tanh(log_odds / 8), 0.0, 1.0)


def scored(docs: DataFrame, model: dict, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every row.

    Null and empty texts get the score of a text without words. Repeated rows get the same
    score each; an empty table gives an empty result.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces_of(batches, 1, 4 << 20):
            x = np.array([features(t or "", model["weights"], model["shortest"]) for t in part.column(1).to_pylist()]).reshape(-1, N_FEATURES)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(calibrated(model["trees"].predict(x), model["curve"]))], names=["doc_id", "score"])

    out = only(docs, id_col, text_col).mapInArrow(run, f"doc_id {kind}, score double")
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def classified(docs: DataFrame, labels: DataFrame, target: str = "toxic", threshold: float = THRESHOLD, bound: int = SAMPLE) -> DataFrame:
    """:func:`scored` by the model of :func:`train`. Without labels of both kinds every row has the score of the prior, 0.5 without any."""
    return scored(docs, train(docs, labels, target, bound), threshold)
