"""Substring deduplication by content-defined chunks.

A gear hash rolls over the UTF-8 bytes of a text; its value at a word's start depends on
the 16 bytes before it alone. A chunk begins where that value is the least among the
``reach`` words on either side, so cuts depend on nearby content only, chunks vary in
length, and an insertion moves no cut beyond its surroundings. Equal values all begin a
chunk, so one word over and over is cut at each; equal chunks in a row are then joined to
one with the digest of the first, and such stretches match whatever their lengths.
A stretch without a cut is cut every ``longest`` words.

A window is a chunk and those that follow it, as many as ``min_words`` words take. Windows
are compared by a 64-bit digest made of their chunks' digests, so what repeats is a stretch
of ``min_words`` words or more that two places share as a whole. Windows that overlap make
up a passage. Of each repeated window the copy in the longest passage stays, of equal ones
that of the smallest key; what no such copy covers goes, if it has ``min_words`` words. So
every repeated window is left whole in one place, and no shorter span is cut out.

The key of a document is a hash of id and text: equal rows count as one document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.llm.common import SPACES, checked, fresh, pieces_of, release
from sieveline.storage import cut

REACH, LONGEST, MIN_WORDS = 3, 64, 25
#: A digest is heavy if it has over a share of one in so many of all windows; there are fewer than that, so they may be broadcast.
HEAVY = 10_000
#: Rows with spans, few in a document, that may be broadcast.
SPANNED = 100_000
#: Multipliers that make a window's digest of its chunks' digests.
BASE, MIX = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9
#: The gear table follows from a rule: hashes of the byte values.
GEAR = np.array([xxhash.xxh32_intdigest(bytes([i]), 7) for i in range(256)], dtype=np.uint32)
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[list(SPACES.encode())] = True


def cuts(raw: bytes, reach: int = REACH, longest: int = LONGEST) -> tuple[np.ndarray, np.ndarray]:
    """The places of the words that begin a chunk (as numbers of words), and all words' places in bytes."""
    data = np.frombuffer(raw, dtype=np.uint8)
    space = IS_SPACE[data]
    first = ~space
    first[1:] &= space[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return starts, starts
    rolled = GEAR[data]
    for s in (1, 2, 4, 8):
        wider = rolled.copy()
        wider[s:] += rolled[:-s] << np.uint32(s)
        rolled = wider
    value = rolled[np.maximum(starts - 1, 0)] * np.uint32(0x9E3779B1)
    least = np.ones(len(value), dtype=bool)
    for s in range(1, reach + 1):
        least[s:] &= value[s:] <= value[:-s]
        least[:-s] &= value[:-s] <= value[s:]
    least[0] = True
    found = np.flatnonzero(least)
    gaps = np.diff(np.append(found, len(starts)))
    if (gaps > longest).any():
        found = np.concatenate([np.arange(a, a + n, longest) for a, n in zip(found, gaps)])
    return found, starts


def key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    return F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))


def _windows(raw: bytes, min_words: int) -> tuple[np.ndarray, ...] | None:
    """``(digest, begin, word, size, words)`` of each window: where it begins, in bytes and in words, and how far it goes."""
    found, starts = cuts(raw)
    if len(starts) < min_words:
        return None
    begin = starts[found]
    end = np.append(begin[1:], len(raw))
    digest = xxhash.xxh3_64_intdigest
    own = np.array([digest(raw[a:b].rstrip()) for a, b in zip(begin.tolist(), end.tolist())], dtype=np.uint64)
    new = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
    begin, word, own = begin[new], found[new], own[new]
    end, upto = np.append(begin[1:], len(raw)), np.append(word[1:], len(starts))
    last = np.searchsorted(upto, word + min_words)
    last = last[last < len(own)]
    n = len(last)
    # The digests of a window's chunks as digits: sums over prefixes, less what stands before the window.
    power = np.cumprod(np.append(np.uint64(1), np.full(len(own), BASE, dtype=np.uint64)))
    inverse = np.cumprod(np.append(np.uint64(1), np.full(len(own), pow(BASE, -1, 1 << 64), dtype=np.uint64)))
    sums = np.append(np.uint64(0), np.cumsum(own * power[:-1]))
    mixed = (sums[last + 1] - sums[:n]) * inverse[:n] + (last + 1 - np.arange(n)).astype(np.uint64)
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(MIX)
    return mixed ^ (mixed >> np.uint64(29)), begin[:n], word[:n], end[last] - begin[:n], upto[last] - word[:n]


def windows(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(k, digest, place, extent)``: every window of every whole text. ``place`` holds where it begins in bytes and in words, ``extent`` how far it goes, 32 bits each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces_of(batches, 1, 1 << 20):
            out = []
            for k, text in zip(part.column(0).to_numpy(), part.column(1).to_pylist()):
                own = _windows((text or "").encode("utf-8", "surrogatepass"), min_words)
                if own is not None:
                    digest, begin, word, size, words = own
                    out.append((np.full(len(digest), k), digest.view(np.int64), begin << 32 | word, size << 32 | words))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], names=["k", "digest", "place", "extent"])

    rows = docs.select(key(id_col, text_col).alias("k"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(run, "k bigint, digest bigint, place bigint, extent bigint")


def _with_runs(hits: DataFrame) -> DataFrame:
    """``(k, place, extent, digest, run)``, arrays of a document's repeated windows in order, with the words of the passage that each is part of."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = batch.column(1)
            place, extent, _ = own = [c.to_numpy() for c in hits.flatten().flatten()]
            offsets = hits.offsets.to_numpy() - hits.offsets[0].as_py()
            begin, word = place >> 32, place & 0xFFFFFFFF
            new = np.zeros(len(place) + 1, dtype=bool)
            new[1:-1] = begin[1:] >= (begin + (extent >> 32))[:-1]  # none reaches beyond a later one
            new[offsets] = True
            first = np.flatnonzero(new[:-1])
            last = np.append(first[1:], len(place)) - 1
            words = (word + (extent & 0xFFFFFFFF))[last] - word[first]
            columns = [*own, np.repeat(words, last - first + 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.ListArray.from_arrays(pa.array(offsets), pa.array(c)) for c in columns)], names=["k", "place", "extent", "digest", "run"])
        release()

    by_doc = hits.groupBy("k").agg(F.sort_array(F.collect_set(F.struct("place", "extent", "digest"))).alias("hits"))  # a set: equal rows are one document
    return by_doc.mapInArrow(run, "k bigint, place array<bigint>, extent array<bigint>, digest array<bigint>, run array<bigint>")


def _lost(place: list[int], extent: list[int], kept: set[int], min_words: int) -> tuple[int, int, list[dict]]:
    """The words of a document's repeated windows, of those what it loses, and the spans that it loses."""
    low = 0xFFFFFFFF
    total, seen = 0, 0  # words, and the first word that isn't counted yet
    mine: list[list[int]] = []  # stretches that stay or not: [begin, word, end, word after]
    others: list[list[int]] = []
    for p, x in zip(place, extent):
        own = [p >> 32, p & low, (p >> 32) + (x >> 32), (p & low) + (x & low)]
        total += own[3] - max(own[1], seen)
        seen = own[3]
        held = mine if p in kept else others
        if held and own[0] <= held[-1][2]:
            held[-1][2:] = own[2:]
        else:
            held.append(own)
    spans, words, i = [], 0, 0
    for begin, word, end, after in others:
        while i < len(mine) and mine[i][2] <= begin:
            i += 1
        at, j = (begin, word), i
        while at[0] < end:
            stays = mine[j] if j < len(mine) and mine[j][0] < end else None
            to = (stays[0], stays[1]) if stays else (end, after)
            if to[1] - at[1] >= min_words:
                spans.append({"begin": at[0], "size": to[0] - at[0]})
                words += to[1] - at[1]
            if not stays:
                break
            at, j = (stays[2], stays[3]), j + 1
    return total, words, spans


def passages(docs: DataFrame, min_words: int = MIN_WORDS, within: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(k, repeated_words, removed_words, spans)`` for each document with a repeated passage.

    A window repeats if two documents have it; with ``within`` also if one has it twice.
    ``spans`` are the places ``(begin, size)``, in bytes, that the document loses; a
    document that keeps all its text has none. Null, empty and wordless texts have no
    windows; an empty table gives an empty result.
    """
    rows = cut(windows(docs, min_words, id_col, text_col))
    where = F.struct("k", "place") if within else F.col("k")
    counted = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min(where).alias("least"), F.max(where).alias("most"))
    repeated = cut(counted.where(F.col("least") != F.col("most")).select("digest", "n"))
    heavy = repeated.where(F.col("n") > rows.count() / HEAVY).select("digest")
    light = rows.join(F.broadcast(heavy), "digest", "left_anti").join(repeated.select("digest"), "digest", "left_semi")
    hits = light.unionByName(rows.join(F.broadcast(heavy), "digest", "left_semi"))
    held = cut(_with_runs(hits))
    each = held.select("k", F.explode(F.arrays_zip("place", "digest", "run")).alias("x")).select("k", "x.*")
    keepers = each.groupBy("digest").agg(F.min(F.struct((-F.col("run")).alias("run"), "k", "place")).alias("x")).select("x.k", "x.place")
    mine = keepers.groupBy("k").agg(F.collect_list("place").alias("kept"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (b.slice(i, 500) for b in batches for i in range(0, b.num_rows, 500)):
            out = [_lost(p, x, set(m or ()), min_words) for p, x, m in zip(*(part.column(c).to_pylist() for c in (1, 2, 3)))]
            total, gone, spans = ([r[c] for r in out] for c in range(3))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.list_(pa.struct([("begin", pa.int64()), ("size", pa.int64())])))],
                names=["k", "repeated_words", "removed_words", "spans"],
            )
        release()

    return held.select("k", "place", "extent").join(mine, "k", "left").mapInArrow(run, "k bigint, repeated_words bigint, removed_words bigint, spans array<struct<begin:bigint,size:bigint>>")


def repeats(docs: DataFrame, min_words: int = MIN_WORDS, within: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_spans, repeated_words, removed_words, spans)`` of each row whose text has a passage that another document has too (with ``within`` also one that it has twice).

    Rows without one aren't listed. Equal rows are listed alike; null ids are ids like any
    other.
    """
    found = passages(docs, min_words, within, id_col, text_col)
    ids = docs.select(key(id_col, text_col).alias("k"), F.col(f"`{id_col}`").alias("doc_id"))
    return ids.join(found, "k").select("doc_id", F.size("spans").cast("long").alias("n_spans"), "repeated_words", "removed_words", "spans")


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS, within: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, all columns, with the repeated passages cut out of the texts but for one copy of each.

    A row whose text had words and has none left is dropped; every other row stays.
    """
    found = passages(docs, min_words, within, id_col, text_col).where(F.size("spans") > 0)
    k, spans = fresh(docs, "k"), fresh(docs, "spans")

    names = docs.columns
    at = names.index(text_col)

    def rest(text: str, own: list[dict]) -> str | None:
        raw, kept, done = text.encode("utf-8", "surrogatepass"), [], 0
        for s in own:
            kept.append(raw[done : s["begin"]])
            done = s["begin"] + s["size"]
        left = b"".join([*kept, raw[done:]]).decode("utf-8", "surrogatepass")
        return left if left.strip() else None

    def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces_of(batches, at, 1 << 20):
            *own, spans = part.columns
            own[at] = pa.array(map(rest, own[at].to_pylist(), spans.to_pylist()), pa.string())
            yield pa.RecordBatch.from_arrays(own, names=names).filter(own[at].is_valid())

    joined = docs.withColumn(k, key(id_col, text_col)).join(checked(found.select(F.col("k").alias(k), F.col("spans").alias(spans)), SPANNED), k, "left")
    own = [F.col(f"`{c}`") for c in docs.columns]
    whole = joined.where(F.col(spans).isNull()).select(*own)
    changed = joined.where(F.col(spans).isNotNull()).select(*own, spans).mapInArrow(shorten, docs.schema)
    return whole.unionByName(changed)
