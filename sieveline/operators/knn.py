"""Top-k cosine neighbours of unit vectors.

Clips are packed into blocks, one matrix each, and every block is compared with all blocks
that matter to it. Blocks aren't copied into a shuffle: a task holds one block of queries,
reads the others from the shared folder one after the other, and keeps each query's best k
so far. Products are taken in single precision, where only those that may be among the best
k, by a bound of the error, are worked out again in double precision, so results are exact.
Of a block's equal vectors only those of the first k + 1 ids are compared, as ties go by id;
so a vector that much of a table has costs no more than others, and stays a query everywhere.
``exact`` compares all blocks. ``probe`` compares a clip with the clips of its nearest cells
alone, which are those of k-means centres fitted on a bounded sample; cells of many clips
are several blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate
from math import ceil, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sieveline.functions.vectors import clamp
from sieveline.operators.numbering import WITHIN
from sieveline.storage import cut

#: The most clips of a block, and the fewest that are worth a task of their own.
BLOCK, SMALL_BLOCK = 8192, 512
#: The rows of queries that are multiplied at once, and the columns, few enough that the products stay in a core's cache.
SLAB, TILE = 1024, 512
#: The pairs that are worked out again at once, the tasks for each core, and the most blocks that one task reads.
TRIED, TASKS, READ = 1 << 17, 3, 128
#: Ties are broken by id among similarities equal to so many places.
PLACES = 12
OUT = "item_id string, neighbor_id string, similarity double"
#: The most clips that centres are fitted on, the fewest for each of them, and the rounds of it.
SAMPLE, PER_CELL, ROUNDS = 50_000, 39, 10


class _Best:
    """The best ``k`` so far of one block of queries, from the blocks that :meth:`see` is given."""

    def __init__(self, ids: np.ndarray, m: np.ndarray, near: np.ndarray | None, k: int) -> None:
        self.ids, self.m, self.near, self.k = ids, m, near, k
        self.single, self.length = m.astype(np.float32), _longest(m)
        self.found = np.full((len(m), k), -np.inf)
        self.whom = np.full((len(m), k), None, dtype=object)

    def see(self, ids: np.ndarray, m: np.ndarray, cell: int) -> None:
        rows = np.arange(len(self.m)) if self.near is None else np.flatnonzero((self.near == cell).any(1))
        if not len(rows) or not len(m):
            return
        single = m.astype(np.float32).T
        # Twice the bound of the error of a product of rounded vectors in single precision.
        slack = (m.shape[1] + 8) * 2.0**-23 * self.length * _longest(m) + 10.0**-PLACES
        codes = pd.factorize(np.concatenate([self.ids, ids]))[0]
        own, others = codes[: len(self.ids)], codes[len(self.ids) :]
        asking = self.single if len(rows) == len(self.m) else self.single[rows]
        for i in range(0, len(rows), SLAB):
            part = rows[i : i + SLAB]
            least = self.found[part, -1]
            fresh = least == -np.inf
            if fresh.any():
                least[fresh] = self._bound(asking[i : i + SLAB][fresh], own[part[fresh]], others, single)
            # Rounded down, so that none is lost by it.
            floor = np.nextafter((least - slack).astype(np.float32), np.float32(-np.inf))[:, None]
            near = [(row, col + j) for j, row, col in _reaching(asking[i : i + SLAB], single, floor)]
            row, col = (np.concatenate(x) for x in zip(*near))
            other = own[part[row]] != others[col]  # a clip is no neighbour of itself
            row, col = row[other], col[other]
            for at in range(0, len(row), TRIED):
                self._take(part, row[at : at + TRIED], col[at : at + TRIED], ids, m)

    def _bound(self, asking: np.ndarray, own: np.ndarray, others: np.ndarray, single: np.ndarray) -> np.ndarray:
        """What each query's best ``k`` of these reach, by products in single precision; minus infinity if there are fewer."""
        if single.shape[1] <= self.k:
            return np.full(len(own), -np.inf)
        s = asking @ single
        order = np.argsort(others, kind="stable")
        first, last = np.searchsorted(others[order], own, "left"), np.searchsorted(others[order], own, "right")
        for r in np.flatnonzero(last > first):
            s[r, order[first[r] : last[r]]] = -np.inf
        s = np.where(np.isfinite(s), s, np.float32(-np.inf))
        s.partition(s.shape[1] - self.k, axis=1)
        return s[:, s.shape[1] - self.k]

    def _take(self, part: np.ndarray, row: np.ndarray, col: np.ndarray, ids: np.ndarray, m: np.ndarray) -> None:
        row = part[row]
        touched = np.unique(row)
        held_row, held_col = np.nonzero(self.found[touched] > -np.inf)
        held_row = touched[held_row]
        rows = np.concatenate([held_row, row])
        found = np.concatenate([self.found[touched][self.found[touched] > -np.inf], np.einsum("ij,ij->i", self.m[row], m[col])])
        whom = np.concatenate([self.whom[held_row, held_col], ids[col]])
        rounded = -np.round(found, PLACES)
        order = np.lexsort((rounded, rows))
        same = (np.diff(rows[order]) == 0) & (np.diff(rounded[order]) == 0)
        if same.any():
            tied = order[np.concatenate([same, [False]]) | np.concatenate([[False], same])]
            place = np.zeros(len(rows), dtype=np.int64)
            place[tied] = np.unique(whom[tied].astype(str), return_inverse=True)[1]
            order = np.lexsort((place, rounded, rows))
        rows = rows[order]
        rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
        kept = rank < self.k
        rows, rank, order = rows[kept], rank[kept], order[kept]
        self.found[rows, rank], self.whom[rows, rank] = found[order], whom[order]

    def rows(self) -> pa.RecordBatch:
        row, col = np.nonzero(self.found > -np.inf)
        return pa.RecordBatch.from_arrays([pa.array(self.ids[row], pa.string()), pa.array(self.whom[row, col], pa.string()), pa.array(self.found[row, col])], names=["item_id", "neighbor_id", "similarity"])


def _reaching(asking: np.ndarray, single: np.ndarray, floor: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first column, rows, columns after it)`` of the finite products that reach their row's floor, tile by tile."""
    n, room = len(asking), np.empty(len(asking) * TILE, dtype=np.float32)
    for j in range(0, single.shape[1], TILE):
        tile = single[:, j : j + TILE]
        s = np.matmul(asking, tile, out=room[: n * tile.shape[1]].reshape(n, -1))
        row, col = np.divmod(_places(s >= floor), s.shape[1])
        fine = np.isfinite(s[row, col])
        yield j, row[fine], col[fine]


def _places(few: np.ndarray) -> np.ndarray:
    """The flat places of the few that are true; eight are looked at together."""
    flat = few.ravel()
    whole = len(flat) // 8 * 8
    eights = np.flatnonzero(flat[:whole].view(np.uint64))
    near = (eights[:, None] * 8 + np.arange(8)).ravel()
    return np.concatenate([near[flat[near]], whole + np.flatnonzero(flat[whole:])])


def _longest(m: np.ndarray) -> float:
    """The length of the longest vector, of those that are finite."""
    lengths = np.sqrt(np.einsum("ij,ij->i", m, m))
    return float(lengths[np.isfinite(lengths)].max(initial=1.0))


def _findable(ids: np.ndarray, m: np.ndarray, k: int) -> np.ndarray:
    """Which rows may be among the best ``k`` of any query: of equal vectors, those of the first ``k + 1`` ids, as the query may be one of them."""
    raw, width = m.tobytes(), m.shape[1] * m.itemsize
    same = pd.factorize(np.array([raw[i * width : (i + 1) * width] for i in range(len(m))], dtype=object))[0]
    if np.bincount(same).max() <= k + 1:
        return np.ones(len(m), dtype=bool)
    named = pd.factorize(ids, sort=True)[0]
    order = np.lexsort((named, same))
    group = np.diff(same[order], prepend=-1) != 0
    place = np.cumsum(group | (np.diff(named[order], prepend=-1) != 0))
    place -= place[group][np.cumsum(group) - 1]
    kept = np.empty(len(m), dtype=bool)
    kept[order] = place <= k
    return kept | (named < 0)


def _packed(rows: DataFrame, n_blocks: int, k: int) -> DataFrame:
    """``(block, cell, ids, matrix, near, probed, told)``, one row for each block of ``(block, cell, item_id, vec, near)``; its first ``told`` clips are those that may be found."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, list[tuple]] = {}
        for batch in batches:
            blocks = batch.column(0).to_numpy()
            for block in np.unique(blocks).tolist():
                own = batch.filter(pa.array(blocks == block))
                parts.setdefault(block, []).append((own.column(1)[0].as_py(), own.column(2), own.column(3).flatten().to_numpy(zero_copy_only=False), own.column(4).flatten().to_numpy(zero_copy_only=False)))
        for block, own in parts.items():
            ids = pa.concat_arrays([p[1] for p in own])
            near = np.concatenate([p[3] for p in own]).astype(np.int32).reshape(len(ids), -1)
            m = np.concatenate([p[2] for p in own]).reshape(len(ids), -1)
            kept = _findable(ids.to_numpy(zero_copy_only=False), m, k)
            if not kept.all():
                order = np.argsort(~kept, kind="stable")
                ids, m, near = ids.take(pa.array(order)), m[order], near[order]
            columns = [pa.array([block], pa.int32()), pa.array([own[0][0]], pa.int32()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), pa.array([m.tobytes()]), pa.array([near.tobytes()]), pa.array([np.unique(near).tolist()], pa.list_(pa.int32())), pa.array([int(kept.sum())], pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=["block", "cell", "ids", "matrix", "near", "probed", "told"])

    dealt = rows.select("block", "cell", "item_id", "vec", "near").repartitionById(n_blocks, "block")
    return cut(dealt.mapInArrow(pack, "block int, cell int, ids array<string>, matrix binary, near binary, probed array<int>, told int"))


def _compared(packed: DataFrame, n_blocks: int, k: int, everywhere: bool) -> DataFrame:
    """Each clip's best ``k`` of every part of the blocks; a query block's own rows come with the first block of a part alone."""
    cores = packed.sparkSession.sparkContext.defaultParallelism
    parts = min(n_blocks, max(ceil(TASKS * cores / n_blocks), ceil(n_blocks / READ)))
    told = packed.select("cell", "ids", "matrix", "told").coalesce(parts).withColumn("first", F.monotonically_increasing_id().bitwiseAND(F.lit(WITHIN)) == 0)
    asked = packed.select("block", *(F.col(c).alias(f"q_{c}") for c in ("ids", "matrix", "near", "probed")))
    both = told.crossJoin(asked.hint("shuffle_replicate_nl"))
    if not everywhere:
        both = both.where(F.col("first") | F.array_contains("q_probed", F.col("cell")))
    seen = both.select("block", "cell", "ids", "matrix", "told", *(F.when(F.col("first"), F.col(f"q_{c}")) for c in ("ids", "matrix", "near")))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict[int, _Best] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                block, cell, ids, raw, told, own, own_raw, near = (batch.column(c)[i] for c in range(8))
                state = states.get(block.as_py())
                if state is None:
                    own = _texts(own)
                    probes = None if everywhere else np.frombuffer(near.as_buffer(), dtype=np.int32).reshape(len(own), -1)
                    state = states[block.as_py()] = _Best(own, np.frombuffer(own_raw.as_buffer()).reshape(len(own), -1).copy(), probes, k)
                ids, n = _texts(ids), told.as_py()
                state.see(ids[:n], np.frombuffer(raw.as_buffer()).reshape(len(ids), -1)[:n], cell.as_py())
        for state in states.values():
            yield state.rows()

    return seen.mapInArrow(compare, OUT)


def _texts(ids: pa.ListScalar) -> np.ndarray:
    return ids.values.to_numpy(zero_copy_only=False)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("item_id").orderBy(F.desc(F.round("similarity", PLACES)), "neighbor_id")
    clamped = clamp(F.col("similarity"), -1.0, 1.0)
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).withColumn("similarity", clamped)


def blocks_for(n: int, cores: int, block: int = BLOCK) -> int:
    """Few enough that vectors are copied little, many enough that there are two pairs of blocks for each core."""
    for_cores = min(ceil(n / SMALL_BLOCK), ceil(2 * sqrt(cores)))
    return max(1, ceil(n / block), for_cores)


def exact(clips: DataFrame, k: int = 10, block: int = BLOCK) -> DataFrame:
    """``(item_id, neighbor_id, similarity, rank)``: the k nearest other clips, ties by id."""
    n_blocks = blocks_for(clips.count(), clips.sparkSession.sparkContext.defaultParallelism, block)
    dealt = clips.select(F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)).cast("int").alias("block"), F.lit(0).alias("cell"), "item_id", "vec", F.array(F.lit(0)).alias("near"))
    return _ranked(_compared(_packed(dealt, n_blocks, k), n_blocks, k, True), k)


def centres_of(sample: np.ndarray, cells: int, seed: int) -> np.ndarray:
    """Directions that k-means puts ``cells`` centres in, by cosine."""
    rng = np.random.default_rng(seed)
    centres = sample[np.sort(rng.choice(len(sample), cells, replace=False))].copy()
    for _ in range(ROUNDS):
        near = (sample @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, sample)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(length > 1e-12, sums / np.maximum(length, 1e-12), centres)
    return centres


def probe(clips: DataFrame, k: int = 10, cells: int = 100, probes: int = 10, sample: int = SAMPLE, seed: int = 17, chunk: int = BLOCK) -> DataFrame:
    """As :func:`exact`, but each clip is compared with those of its ``probes`` nearest cells only; with all cells it is exact."""
    drawn = clips.select("vec").orderBy(F.xxhash64("item_id")).limit(sample).toPandas()["vec"].to_list()
    fitted = np.stack(drawn) if drawn else np.zeros((1, 1))
    cells = max(1, min(cells, max(1, len(drawn) // PER_CELL)))
    centres, probes = centres_of(fitted, cells, seed), min(probes, cells)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                s = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1) @ centres.T
                near = np.argsort(-s, axis=1, kind="stable")[:, :probes].astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(near) + 1, dtype=np.int32) * probes), pa.array(near.ravel()))
                yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=["item_id", "vec", "near"])

    rows = cut(clips.select("item_id", "vec").mapInArrow(nearest, "item_id string, vec array<double>, near array<int>")).withColumn("cell", F.get("near", F.lit(0)))
    counts = {r["cell"]: ceil(r["count"] / chunk) for r in rows.groupBy("cell").count().collect()}  # a row for each cell
    n_blocks = max(1, sum(counts.values()))
    starts = zip(counts, accumulate(counts.values(), initial=0))
    parts = clips.sparkSession.createDataFrame([(c, at, counts[c]) for c, at in starts], "cell int, at int, n int")
    block = F.col("at") + F.pmod(F.xxhash64("item_id"), F.col("n")).cast("int")
    dealt = rows.join(F.broadcast(parts), "cell").select(block.alias("block"), "cell", "item_id", "vec", "near")
    return _ranked(_compared(_packed(dealt, n_blocks, k), n_blocks, k, probes == cells), k)


def nearest_neighbor(clips: DataFrame, neighbors: DataFrame) -> DataFrame:
    """``(item_id, nearest_item_id, similarity)`` for every clip; nulls without a neighbour."""
    first = neighbors.where("rank = 1").select("item_id", F.col("neighbor_id").alias("nearest_item_id"), "similarity")
    return clips.select("item_id").join(first, "item_id", "left")


def recall(found: DataFrame, truth: DataFrame) -> float:
    """The share of the true neighbours that a search found."""
    n = truth.count()
    return found.select("item_id", "neighbor_id").join(truth.select("item_id", "neighbor_id"), ["item_id", "neighbor_id"]).count() / n if n else 1.0
