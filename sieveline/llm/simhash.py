"""SimHash near-duplicates, searched through segment popcounts.

A fingerprint is cut into 32 segments of two bits and mapped to the vector of their bit
counts. One flipped bit moves one count by one, so the Manhattan distance of two vectors
is a lower bound of the Hamming distance of their fingerprints. The search for pairs
within ``radius`` is therefore a range join in a grid of popcount vectors: the 32
dimensions go into bands, and by the pigeonhole principle a pair within Manhattan
distance ``radius`` lies within ``radius // bands`` in one band at least. One side is put
into its own cell of each band, the other also into all cells at that distance. What
meets in a cell is verified by the exact Hamming distance.

Exact copies, and texts with one fingerprint, are one row before the search. A cell is
dealt in chunks of bounded size, every pair of its chunks is one group, and a group emits
a spanning forest of its links, so a cell's rows stay linear in its members.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations, product
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.llm.common import SPACES, TO_LOWER, only, pieces_of, release
from sieveline.operators.components import connected_components
from sieveline.operators.joins import join_dealt
from sieveline.storage import cut

SEED = 42
WORD = re.compile(f"[^{re.escape(SPACES)}]+")
SEGMENTS, SEGMENT_BITS = 32, 2
#: Members of a cell that one group compares with one another.
CHUNK = 4096
#: Cells of more than a chunk that may be broadcast (20 bytes each); with more they are joined by a shuffle.
BROADCAST_CELLS = 100_000


def fingerprint(text: str | None, words: int = 4) -> int:
    """The 64-bit SimHash of a whole text; 0 for null and for a text without words."""
    found = WORD.findall((text or "").translate(TO_LOWER))
    if not found:
        return 0
    raw = [w.encode("utf-8", "surrogatepass") for w in found]
    shingles = map(b" ".join, zip(*(raw[i:] for i in range(words)))) if len(raw) >= words else [b" ".join(raw)]
    digest = xxhash.xxh64_digest
    hashes = np.frombuffer(b"".join([digest(s, SEED) for s in shingles]), dtype=np.uint8).reshape(-1, 8)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 65536):  # keeps the unpacked bits of a very long text small
        ones += np.unpackbits(hashes[i : i + 65536], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4) -> DataFrame:
    """``(doc_id, fp)`` for every row; ``fp`` holds the 64 bits as a signed long."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces_of(batches, 1, 2 << 20):
            fps = np.array([fingerprint(t, words) for t in part.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return only(docs, id_col, text_col).mapInArrow(run, f"doc_id {kind}, fp bigint")


def _moves(size: int, radius: int) -> list[list[tuple[int, int]]]:
    """All changes of up to ``radius`` steps of one in a vector of ``size`` counts, as (place, change) lists."""
    found: list[list[tuple[int, int]]] = [[]]
    for n in range(1, radius + 1):
        for places in combinations(range(size), n):
            for steps in product(*[[s for s in range(-radius, radius + 1) if s]] * n):
                if sum(map(abs, steps)) <= radius:
                    found.append(list(zip(places, steps)))
    return found


def _popcounts(fps: np.ndarray) -> np.ndarray:
    """A row of SEGMENTS counts for each fingerprint."""
    shifts = np.arange(SEGMENTS, dtype=np.uint64) * np.uint64(SEGMENT_BITS)
    return np.bitwise_count((fps[:, None] >> shifts) & np.uint64((1 << SEGMENT_BITS) - 1)).astype(np.int64)


def _cells(fps: DataFrame, radius: int, bands: int) -> DataFrame:
    """``(band, cell, fp, home)``: each fingerprint in its own cells (home) and in the cells within reach."""
    reach = radius // bands
    spans = [np.arange(SEGMENTS)[i::bands] for i in range(bands)]
    base = SEGMENT_BITS + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 4096):
                own = batch.column(0).slice(begin, 4096).to_numpy(zero_copy_only=False).view(np.uint64)
                counts = _popcounts(own)
                for band, span in enumerate(spans):
                    weights = base ** np.arange(len(span), dtype=np.int64)
                    part = counts[:, span]
                    home = part @ weights
                    for move in _moves(len(span), reach):
                        legal = np.ones(len(own), dtype=bool)
                        cell = home.copy()
                        for place, step in move:
                            legal &= (part[:, place] + step >= 0) & (part[:, place] + step <= SEGMENT_BITS)
                            cell += step * weights[place]
                        n = int(legal.sum())
                        if n:
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(np.full(n, band, np.int32)), pa.array(cell[legal]), pa.array(own[legal].view(np.int64)), pa.array(np.full(n, not move))],
                                names=["band", "cell", "fp", "home"],
                            )
        release()

    return fps.select("fp").mapInArrow(run, "band int, cell bigint, fp bigint, home boolean")


def _forest(cell: np.ndarray, side: np.ndarray, home: np.ndarray, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the same components as all links within ``radius`` inside each cell; linear in the rows.

    The rows are in order of ``cell``. Sides 1 and 2 meet each other only, rows of side 0 all of their cell.
    """
    nodes, place = np.unique(fp, return_inverse=True)
    label = np.arange(len(nodes))
    first = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
    size = np.diff(np.append(first, len(cell)))
    of = np.repeat(np.arange(len(first)), size)
    mine = np.flatnonzero(home & (size[of] > 1))
    reach = np.cumsum(size[of[mine]])
    done = 0
    while done < len(mine):
        upto = max(done + 1, int(np.searchsorted(reach, (reach[done - 1] if done else 0) + (1 << 20), "right")))
        a, done = mine[done:upto], upto
        n = size[of[a]]
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        x, y = np.repeat(a, n), np.repeat(first[of[a]], n) + within
        near = (np.bitwise_count(fp[x] ^ fp[y]) <= radius) & ((side[x] == 0) | (side[x] != side[y]))
        label = _merge(label, [np.stack([place[x[near]], place[y[near]]])])
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _merge(label: np.ndarray, pairs: list[np.ndarray]) -> np.ndarray:
    """The labels after the pairs are joined: each node has the smallest place in its component."""
    if not pairs:
        return label
    x, y = np.concatenate(pairs, axis=1)
    while True:
        a, b = label[x], label[y]
        if (a == b).all():
            return label
        low, high = np.minimum(a, b), np.maximum(a, b)
        new = label.copy()
        np.minimum.at(new, high, low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        label = new[label]


def bands_for(n: int, radius: int) -> int:
    """Bands that a pair within ``radius`` lies in one step of each other in one of; fewer, with longer cells, once these would meet too often.

    Fewer bands copy a fingerprint to more cells, more let more of them meet. Of random
    counts of two bits, two are equal with probability 3/8. A comparison within a cell costs
    about a fiftieth of a row that is shuffled.
    """

    def cost(bands: int) -> float:
        size, reach = SEGMENTS // bands, radius // bands
        # Per step either way about two thirds of the counts have room.
        moves = sum(comb(size, k) * comb(reach, k) * (4 / 3) ** k for k in range(reach + 1))
        return bands * moves * (n + 0.02 * n * n * 0.375**size)

    least = min(2, radius + 1)
    return min(range(least, max(least, (radius + 2) // 2) + 1), key=cost)


def links(fps: DataFrame, radius: int = 4, bands: int | None = None, chunk: int = CHUNK) -> DataFrame:
    """``(a, b)`` over distinct fingerprints: a spanning set of all links within ``radius``. The number of bands changes the work, not the result."""
    bands = bands or bands_for(fps.count(), radius)
    cells = _cells(fps, radius, bands)
    large = cut(cells.groupBy("band", "cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > chunk).select("band", "cell", F.ceil(F.col("n") / chunk).cast("int").alias("k")))
    n_large = large.count()
    if n_large:
        # A chunk meets each chunk of its cell once: its rows go to the pair (own, other) for every other.
        dealt = (
            cells.join(F.broadcast(large) if n_large <= BROADCAST_CELLS else large, ["band", "cell"], "left")
            .withColumn("k", F.coalesce("k", F.lit(1)))
            .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("k")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
            .select("band", "cell", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2).alias("side"), "fp", "home")
        )
    else:
        dealt = cells.select("band", "cell", F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("side"), "fp", "home")
    keys = ["band", "cell", "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def found(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
            if rows.shape[1] > 1:
                group = np.cumsum(np.append(0, (rows[:4, 1:] != rows[:4, :-1]).any(axis=0)))
                a, b = _forest(group, rows[4], rows[6].astype(bool), rows[5].view(np.uint64), radius)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(np.stack([batch.column(c).cast(pa.int64()).to_numpy(zero_copy_only=False) for c in range(7)]))
            if sum(h.shape[1] for h in held) < 1 << 16:
                continue
            rows = np.concatenate(held, axis=1)
            ends = np.flatnonzero((rows[:4, 1:] != rows[:4, :-1]).any(axis=0))
            if len(ends):  # what follows the last end may go on in the next batch
                yield from found(np.ascontiguousarray(rows[:, : ends[-1] + 1]))
                rows = np.ascontiguousarray(rows[:, ends[-1] + 1 :])
            held = [rows]
        if held:
            yield from found(np.concatenate(held, axis=1))
        held.clear()
        release()

    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, radius: int = 4, words: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row ``(doc_id, fingerprint, component_id)`` for each row of ``docs``.

    Null, empty and wordless texts have fingerprint zero and link like any other. Repeated
    rows stay repeated and share a component. ``component_id`` is the smallest id that is
    not null in the component, so it is null only if all its ids are. An empty table gives
    an empty result.
    """
    rows = cut(fingerprints(docs, id_col, text_col, words))
    distinct = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")))
    stars = connected_components(links(distinct, radius)).select(F.col("node").alias("fp"), "component")
    named = cut(distinct.join(stars, "fp", "left").select("fp", "n", F.coalesce("component", "fp").alias("component"), "least"))
    ids = cut(named.groupBy("component").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("m")))
    each = cut(join_dealt(named.drop("least"), ids, "component", "m", named.count()).select("fp", "n", "component_id"))
    out = join_dealt(rows, each, "fp", "n", rows.count())
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
