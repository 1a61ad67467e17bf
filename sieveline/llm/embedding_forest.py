"""Embedding near-duplicates by a forest of random-projection trees with spill.

Each tree splits a bounded sample of the vectors by random directions, at the median of
each node's projections, until its leaves are small. Every vector is then led down every
tree; at a split it goes to both sides if its projection lies within ``spill`` of the
threshold. The spill is half the deviation that the projections of two vectors just as
similar as the threshold have from each other, so a pair is torn apart at a split with a
probability of about 1 %. A node that would send more than a quarter of its vectors both
ways is no longer split: they are near one another, and splits would part links. Vectors of
one label that share a leaf are compared exactly, in double precision. A pair that shares
several leaves counts in the first of them only. A leaf of many vectors is compared in
pairs of bounded chunks, so nothing is capped.

Equal vectors are one before the search and count with their number. Links are summed
where they are found; what leaves a group is one count and one link to a representative
for each vector, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.llm.common import groups_of, only
from sieveline.operators.components import connected_components
from sieveline.operators.joins import join_dealt
from sieveline.storage import cut

THRESHOLD, TREES = 0.98, 6
#: Vectors that the trees are fitted on, the fewest of them that a node is split for, and of all vectors about the most in a leaf.
SAMPLE, SAMPLE_LEAF, LEAF = 32_768, 8, 256
#: The share of a node's vectors that may go to both sides.
BOTH = 0.25
CHUNK, BROADCAST_LEAVES = 2_048, 100_000


class Tree:
    """Nodes in arrays: direction, threshold, and two children; a child below 0 is leaf ``-child - 1``."""

    def __init__(self, sample: np.ndarray, depth: int, spill: float, rng: np.random.Generator):
        self.spill, self.leaves = spill, 0
        self._directions: list[np.ndarray] = []
        self._rest: list[tuple[float, int, int]] = []
        self.root = self._grow(sample, depth, rng)
        self.directions = np.array(self._directions).reshape(-1, sample.shape[1])
        self.middles, self.children = np.array([m for m, _, _ in self._rest]), np.array([c for _, *c in self._rest]).reshape(-1, 2)
        del self._directions, self._rest

    def _grow(self, rows: np.ndarray, left: int, rng: np.random.Generator) -> int:
        if left > 0 and len(rows) >= SAMPLE_LEAF:
            direction = rng.standard_normal(rows.shape[1])
            direction /= np.linalg.norm(direction)
            at = rows @ direction
            middle = float(np.median(at))
            if (at < middle).any() and (np.abs(at - middle) <= self.spill).mean() <= max(BOTH, 1.5 / len(rows)):
                place = len(self._rest)
                self._directions.append(direction)
                self._rest.append((middle, 0, 0))
                self._rest[place] = (middle, self._grow(rows[at < middle], left - 1, rng), self._grow(rows[at >= middle], left - 1, rng))
                return place
        self.leaves += 1
        return -self.leaves

    def lead(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and the leaf numbers that they reach, one level at a time."""
        rows, nodes = np.arange(len(unit)), np.full(len(unit), self.root)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        while len(rows):
            done = nodes < 0
            found.append((rows[done], -nodes[done] - 1))
            rows, nodes = rows[~done], nodes[~done]
            at = np.concatenate([np.einsum("ij,ij->i", unit[rows[i : i + 8192]], self.directions[nodes[i : i + 8192]]) for i in range(0, len(rows), 8192)] or [np.zeros(0)])
            at -= self.middles[nodes]
            low, high = at < self.spill, at >= -self.spill
            rows, nodes = np.concatenate([rows[low], rows[high]]), np.concatenate([self.children[nodes[low], 0], self.children[nodes[high], 1]])
        return np.concatenate([r for r, _ in found]), np.concatenate([x for _, x in found])


def _units(vectors: pa.ListArray, width: int) -> np.ndarray:
    unit = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
    return unit / np.linalg.norm(unit, axis=1, keepdims=True)


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, trees: int = TREES, seed: int = 17, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row ``(vec_id, n_links, component_id, kept)`` per row of ``vectors``.

    A null label or vector, a zero vector, and a null or non-finite component link with
    nothing: such a row is its own component. So are vectors of different lengths.
    ``n_links`` counts the rows that are linked directly, equal ones included;
    ``component_id`` is the smallest id reachable, null if the row has none. Repeated rows
    are rows of their own. An empty table gives an empty result.
    """
    kind = vectors.schema[id_col].dataType.simpleString()
    values = vectors.schema[vector_col].dataType.simpleString()
    good = F.col("label").isNotNull() & F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("v", lambda x: x != 0)
    named = only(vectors, id_col, vector_col, label_col).toDF("vec_id", "v", "label")
    # Zeros of either sign are equal.
    key = F.xxhash64("label", F.transform(F.col("v"), lambda x: x.cast("double") + F.lit(0.0)))
    rows = named.withColumn("key", F.when(F.coalesce(good, F.lit(False)), key))
    distinct = cut(rows.where("key is not null").groupBy("key").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n"), F.first("label").alias("label"), F.first("v").alias("v")))
    total = distinct.count()
    commonest = distinct.groupBy(F.size("v").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    width = commonest["width"] if commonest else 1

    usual = distinct.where(F.size("v") == width)
    share = min(1.0, 2 * SAMPLE / max(1, total))  # most rows need not be sorted for the sample
    drawn = usual.where(F.pmod(F.xxhash64("key", F.lit(1)), F.lit(1 << 20)) < share * (1 << 20)).orderBy(F.xxhash64("key")).limit(SAMPLE).select(F.col("v").cast("array<double>").alias("v")).toPandas()["v"]
    sample = np.stack(drawn.to_list()) if len(drawn) else np.zeros((0, width))
    sample = sample / np.linalg.norm(sample, axis=1, keepdims=True) if len(sample) else sample
    depth = max(0, int(np.ceil(np.log2(max(1, total / LEAF)))))
    spill = float(np.sqrt(max(0.0, 2 - 2 * threshold) / width) / 2)
    rng = np.random.default_rng(seed)
    forest = [Tree(sample, depth, spill, rng) for _ in range(trees)]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = batch.column(3)
            sizes = pa.compute.list_value_length(every).to_numpy(zero_copy_only=False)
            own, other = np.flatnonzero(sizes == width), np.flatnonzero(sizes != width)
            row, leaf = [other], [trees << 20 | sizes[other]]  # other lengths: a leaf for each, compared in full
            if len(own):
                unit = _units(every.take(pa.array(own)), width)
                for t, tree in enumerate(forest):
                    r, x = tree.lead(unit)
                    row.append(own[r])
                    leaf.append(t << 20 | x)
            r, x = np.concatenate(row), np.concatenate(leaf)
            order = np.lexsort((x, r))
            offsets = np.append(0, np.cumsum(np.bincount(r, minlength=batch.num_rows)))
            leaves = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(x[order].astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns, leaves], names=["key", "label", "n", "v", "leaves"])

    label = vectors.schema[label_col].dataType.simpleString()
    led = cut(distinct.select("key", "label", "n", "v").mapInArrow(route, f"key bigint, label {label}, n bigint, v {values}, leaves array<int>"))
    spread = led.select("label", F.explode("leaves").alias("leaf"), "leaves", "key", "n", "v")
    large = cut(spread.groupBy("label", "leaf").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > CHUNK).select("label", "leaf", F.ceil(F.col("m") / CHUNK).cast("int").alias("k")))
    few = large.count() <= BROADCAST_LEAVES
    dealt = (
        spread.join(F.broadcast(large) if few else large, ["label", "leaf"], "left")
        .withColumn("k", F.coalesce("k", F.lit(1)))
        .withColumn("own", F.pmod(F.xxhash64("key"), F.col("k")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
        .select("label", "leaf", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "key", "n", "leaves", "v")
    )
    keys = ["label", "leaf", "i", "j"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups_of(batches, len(keys)):
            out = _links(group, threshold)
            if out is not None:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=["a", "b", "n"])

    found = cut(dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(compare, "a bigint, b bigint, n bigint"))
    counts = found.where("n > 0").groupBy(F.col("a").alias("key")).agg(F.sum("n").alias("more"))
    stars = connected_components(found.where("n = 0").select("a", "b")).select(F.col("node").alias("key"), "component")
    joined = distinct.select("key", "n", "least").join(counts, "key", "left").join(stars, "key", "left")
    each = cut(joined.select("key", "n", "least", (F.col("n") - 1 + F.coalesce("more", F.lit(0))).alias("n_links"), F.coalesce("component", "key").alias("component")))
    ids = cut(each.groupBy("component").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("m")))
    each = cut(join_dealt(each.drop("least"), ids, "component", "m", total).select("key", "n", "n_links", "component_id"))
    linked = join_dealt(rows.where("key is not null").select("vec_id", "key"), each, "key", "n", vectors.count()).select("vec_id", "n_links", F.col("component_id").cast(kind).alias("component_id"))
    alone = rows.where("key is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _links(group: pa.RecordBatch, threshold: float) -> tuple[np.ndarray, ...] | None:
    """Of a pair of chunks ``(a, b, n)``: each linked vector and how many its links are (b = 0), and a link to a representative (n = 0)."""
    if group.num_rows < 2:
        return None
    _, leaf, i, j, own, key, n = (group.column(c).to_numpy(zero_copy_only=False) for c in range(7))
    n, vectors, leaves = n.astype(np.float64), group.column(8), group.column(7)
    unit = _units(vectors, len(vectors[0]))
    first = np.flatnonzero(own == i[0]) if i[0] != j[0] else np.arange(len(key))
    second = np.flatnonzero(own == j[0]) if i[0] != j[0] else first
    counts, label, before = np.zeros(len(key)), np.arange(len(key)), None
    for b in range(0, len(first), 512):
        x = first[b : b + 512]
        near = unit[x] @ unit[second].T >= threshold
        near &= x[:, None] != second[None, :]
        if not near.any():
            continue
        before = _before(leaves, leaf[0]) if before is None else before
        p, q = np.nonzero(near)
        p, q = x[p], second[q]
        new = ~before(p, q)
        p, q = p[new], q[new]
        counts += np.bincount(p, n[q], len(key))
        if first is not second:
            counts += np.bincount(q, n[p], len(key))
        label = _merge(label, p, q)
    linked, moved = np.flatnonzero(counts), np.flatnonzero(label != np.arange(len(key)))
    if not len(linked):
        return None
    return np.concatenate([key[linked], key[moved]]), np.concatenate([np.zeros(len(linked), np.int64), key[label[moved]]]), np.concatenate([counts[linked], np.zeros(len(moved))]).astype(np.int64)


def _before(leaves: pa.ListArray, leaf: int):  # noqa: ANN202
    """Whether rows share a leaf before this one. Rows with the same leaves are alike, and vectors near one another mostly have the same."""
    offsets, flat = leaves.offsets.to_numpy() - leaves.offsets[0].as_py(), leaves.flatten().to_numpy()
    sets = [flat[a:b][flat[a:b] < leaf].tobytes() for a, b in zip(offsets.tolist(), offsets[1:].tolist())]
    number: dict[bytes, int] = {}
    kind = np.array([number.setdefault(s, len(number)) for s in sets])
    held = [frozenset(np.frombuffer(s, dtype=flat.dtype).tolist()) for s in number]
    known: dict[int, bool] = {}

    def shared(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        pairs, place = np.unique(kind[p] * len(held) + kind[q], return_inverse=True)
        for pair in pairs.tolist():
            if pair not in known:
                known[pair] = not held[pair // len(held)].isdisjoint(held[pair % len(held)])
        return np.array([known[pair] for pair in pairs.tolist()], dtype=bool)[place]

    return shared


def near_duplicates_sql(threshold: float = THRESHOLD) -> str:
    """The same over a table ``embeddings`` by comparing all pairs of a label, for DuckDB."""
    return f"""WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
u AS (SELECT vec_id, label, list_transform(e, lambda x: x / sqrt(list_inner_product(e, e))) AS e FROM v
      WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND list_inner_product(e, e) > 0),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_inner_product(a.e, b.e) >= {threshold}),
r AS (SELECT vec_id AS x, vec_id AS y FROM v UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
c AS (SELECT x AS vec_id, min(y) AS component_id FROM r GROUP BY 1), n AS (SELECT x AS vec_id, count(*) AS n_links FROM l GROUP BY 1)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept FROM c LEFT JOIN n USING (vec_id)"""


def _merge(label: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    while True:
        a, b = label[x], label[y]
        if (a == b).all():
            return label
        new = label.copy()
        np.minimum.at(new, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(new, new[new]):
            new = new[new]
        label = new
