"""Benchmark decontamination, with DataFrame functions alone.

A text's words are its runs of letters and digits, lower-cased; its shingles are five
words (all of them, if an item has fewer). The windows of a text are as long as an item,
and lie where a shingle of that item falls on the same shingle of the text. A window
that would begin before the text or end after it, as where a copy is cut off by the text's
edge, is moved back to that edge; if the text is shorter than the item, the whole text is
the window. Every window gets the 64-bit SimHash of its words, each with the number of its
occurrence.

Windows and items meet in a multi-index of eight 8-bit blocks. Two fingerprints that
differ in ``radius`` bits or fewer differ in ``radius // 8`` or fewer in one block at
least, so each item is entered under all values of each block within that many flips, and
a window looks up its own eight blocks: every pair within the radius is found. The radius
follows from the similarity asked for, see :func:`radius_for`. The pairs are verified by
the exact similarity of their weighted shingles, a shingle's weight being the number of
times it occurs: the sum of the smaller weights over the sum of the larger.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations
from math import acos, comb, pi

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.llm.common import checked, fresh, only
from sieveline.storage import cut

SHINGLE, SIMILARITY = 5, 0.8
#: The share of pairs of just the similarity asked for that may differ in more bits than the radius.
MISSED = 2e-5
BLOCKS, BLOCK_BITS = 8, 8
#: Up to so many distinct shingles of all items are looked up in the plan itself; more are joined.
IN_PLAN = 20_000


def radius_for(similarity: float, missed: float = MISSED) -> int:
    """The bits that the fingerprints of a window and an item of ``similarity`` differ in, all but a share ``missed`` of such pairs.

    Of two lists of shingles with that similarity, the share ``c = 2 s / (1 + s)`` is common;
    shared shingles cover at least as large a share of the words, so ``c`` bounds the cosine
    of the words from below. A bit of a SimHash then differs with probability
    ``acos(c) / pi`` at most, and the number of such bits is binomial.
    """
    bits = BLOCKS * BLOCK_BITS
    p = acos(min(1.0, 2 * similarity / (1 + similarity))) / pi
    above, radius = 1.0, -1
    while above > missed and radius < bits:
        radius += 1
        above = sum(comb(bits, k) * p**k * (1 - p) ** (bits - k) for k in range(radius + 1, bits + 1))
    return radius


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _shingles(words: Column, size: Column, k: int) -> Column:
    """The hashes of all ``k`` neighbouring words, in order; none for fewer words."""
    at = lambda i: F.xxhash64(*(F.get(words, i + j) for j in range(k)))
    return F.when(size >= k, F.transform(F.sequence(F.lit(0), size - k), at)).otherwise(F.array().cast("array<bigint>"))


def simhash(hashes: Column) -> Column:
    """The 64-bit SimHash of an array of hashes: a bit is set if it is set in over half of them.

    Bits are counted two at a time, in the halves of one long.
    """
    half = 0x0000000100000001
    counts = F.transform(F.sequence(F.lit(0), F.lit(31)), lambda b: F.aggregate(hashes, F.lit(0).cast("long"), lambda s, h: s + F.call_function("shiftrightunsigned", h, b).bitwiseAND(F.lit(half))))
    most = F.size(hashes)
    low = lambda c: F.when(c.bitwiseAND(F.lit(0xFFFFFFFF)) * 2 > most, F.lit(1)).otherwise(F.lit(0)).cast("long")
    high = lambda c: F.when(F.shiftright(c, 32) * 2 > most, F.lit(1)).otherwise(F.lit(0)).cast("long")
    bits = F.zip_with(counts, F.sequence(F.lit(0), F.lit(31)), lambda c, b: F.call_function("shiftleft", low(c), b).bitwiseOR(F.call_function("shiftleft", high(c), b + 32)))
    return F.aggregate(bits, F.lit(0).cast("long"), lambda s, x: s.bitwiseOR(x))


def _tagged(hashes: Column, ordered: Column) -> Column:
    """Distinct hashes for equal ones, by the number of the occurrence, the first as it is: a bag as a set. ``ordered``: a column of the sorted hashes."""
    which = lambda h, i: i + 1 - F.array_position(ordered, h)
    numbered = F.transform(ordered, lambda h, i: F.when(which(h, i) == 0, h).otherwise(F.xxhash64(h, which(h, i).cast("long"))))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), hashes).otherwise(numbered)


def _blocks(fp: Column, flips: int) -> Column:
    """``(block, value)`` of each block, and of each value within ``flips`` flipped bits of it."""
    masks = [sum(1 << b for b in bits) for n in range(flips + 1) for bits in combinations(range(BLOCK_BITS), n)]
    every = F.array(*(F.lit(m).cast("long") for m in masks))
    own = lambda i: F.call_function("shiftrightunsigned", fp, i * BLOCK_BITS).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1))
    entered = lambda i: F.transform(every, lambda m: F.struct(i.alias("block"), own(i).bitwiseXOR(m).alias("value")))
    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(BLOCKS - 1)), entered))


def _items(benchmark: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    rows = only(benchmark, id_col, text_col).select(F.col(id_col).alias("item_id"), words_of(F.col(text_col)).alias("w")).where("size(w) > 0")
    rows = rows.withColumn("n", F.size("w"))
    own = rows.withColumn("k", F.least("n", F.lit(k)))
    hashes = reduce(lambda rest, j: F.when(F.col("k") == j, _shingles(F.col("w"), F.col("n"), j)).otherwise(rest), range(1, k), _shingles(F.col("w"), F.col("n"), k))
    words = F.transform("w", lambda w: F.xxhash64(w))
    known = cut(own.select("item_id", "n", "k", hashes.alias("hashes"), words.alias("words")).withColumn("ordered", F.sort_array("hashes")).withColumn("sorted", F.sort_array("words")))
    return known.select("item_id", "n", "k", "hashes", simhash(_tagged(F.col("words"), F.col("sorted"))).alias("fp"), _tagged(F.col("hashes"), F.col("ordered")).alias("tags"))


def _ends_of_equal(hits: Column, hashes: Column) -> Column:
    """The places of shared shingles, of a stretch of equal ones the first and the last: windows within such a stretch are equal."""
    at = lambda p: F.get(hashes, p)
    return F.filter(hits, lambda p: ~F.coalesce((at(p) == at(p - 1)) & (at(p) == at(p + 1)), F.lit(False)))


def leaks(
    docs: DataFrame, benchmark: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY, radius: int | None = None,
    id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", in_plan: int = IN_PLAN,
) -> DataFrame:
    """``(doc_id, item_id, start, n_words, distance, similarity)``: each document and item with a window of at least ``similarity``.

    The most similar window is given, of equal ones the first; ``start`` counts words from
    0, and ``n_words`` are the window's: the item's, or the text's if it is shorter. Null, empty and wordless texts and items match nothing. An item of fewer words than
    a shingle is one shingle. Rows with equal ids give one row; a null id is an id of its
    own. Equal items are items of their own. Empty tables give an empty result. ``radius``
    is that of the similarity, if none is given.
    """
    radius = radius_for(similarity) if radius is None else radius
    items = cut(_items(benchmark, shingle, item_id_col, item_text_col))
    offered = cut(items.select("k", "n", F.posexplode("hashes").alias("offset", "h")).select("k", "n", "offset", "h").distinct())
    sizes = [r["k"] for r in items.select("k").distinct().collect()]  # at most ``shingle`` rows
    # The row numbers also keep the optimizer from moving a filter below, and so evaluating an array anew for each of its elements.
    rows = only(docs, id_col, text_col).select(F.col(id_col).alias("doc_id"), words_of(F.col(text_col)).alias("w"), F.monotonically_increasing_id().alias("row"))
    found = []
    for k in sorted(sizes):
        own = offered.where(F.col("k") == k).drop("k")
        known = own.select("h").distinct()
        hashed = rows.select("doc_id", "w", _shingles(F.col("w"), F.size("w"), k).alias("hs"), F.monotonically_increasing_id().alias("row"))
        few = known.limit(in_plan + 1).collect()
        if len(few) <= in_plan:
            listed = [r["h"] for r in few]
            places = F.filter(F.transform("hs", lambda h, i: F.when(h.isin(listed), i)), lambda i: i.isNotNull())
            hit = hashed.select("doc_id", "w", "hs", places.alias("hits"), F.monotonically_increasing_id().alias("row")).where("size(hits) > 0")
        else:
            each = cut(hashed)
            met = each.select("row", F.posexplode("hs").alias("p", "h")).join(known, "h", "left_semi")
            hit = each.join(met.groupBy("row").agg(F.array_sort(F.collect_set("p")).alias("hits")), "row")
        hit = cut(hit.select("row", "doc_id", "w", "hs", "hits"))
        at = hit.select("row", F.explode(_ends_of_equal(F.col("hits"), F.col("hs"))).alias("p"), "hs").select("row", "p", F.get("hs", F.col("p")).alias("h"), (F.size("hs") + k - 1).alias("size"))
        start = F.greatest(F.lit(0), F.least(F.col("p") - F.col("offset"), F.col("size") - F.col("n")))
        starts = at.join(own, "h").select("row", start.alias("start"), "n").distinct()
        within = starts.groupBy("row").agg(F.collect_set(F.struct("start", "n")).alias("at"))
        windows = hit.join(within, "row").select("doc_id", "w", "hs", F.explode("at").alias("x"))
        found.append(
            windows.select(
                "doc_id",
                F.lit(k).alias("k"),
                F.col("x.start").alias("start"),
                F.col("x.n").alias("n"),
                F.transform(F.slice("w", F.col("x.start") + 1, F.col("x.n")), lambda w: F.xxhash64(w)).alias("words"),
                F.slice("hs", F.col("x.start") + 1, F.col("x.n") - k + 1).alias("hashes"),
            )
        )
    if not found:
        kind, item = docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_id_col].dataType.simpleString()
        return docs.sparkSession.createDataFrame([], f"doc_id {kind}, item_id {item}, start int, n_words int, distance int, similarity double")
    windows = cut(reduce(DataFrame.unionByName, found).withColumn("ordered", F.sort_array("hashes")).withColumn("sorted", F.sort_array("words")).withColumn("row", F.monotonically_increasing_id()))
    tags = _tagged(F.col("hashes"), F.col("ordered")).alias("tags")
    prints = cut(windows.select("row", "doc_id", "k", "start", "n", F.size("words").alias("n_words"), simhash(_tagged(F.col("words"), F.col("sorted"))).alias("fp"), tags))
    probes = prints.select("row", "k", "n", "fp", F.inline(_blocks(F.col("fp"), 0)))
    index = items.select("item_id", "k", "n", F.col("fp").alias("item_fp"), "tags", F.inline(_blocks(F.col("fp"), radius // BLOCKS)))
    distance = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))
    met = probes.join(index.drop("tags"), ["block", "value", "k", "n"]).where(distance <= radius).select("row", "item_id", "item_fp", distance.alias("distance")).distinct()
    pairs = prints.select("row", "doc_id", "start", "n", "n_words", "tags").join(met, "row")
    theirs = items.select(F.col("item_id").alias("theirs"), F.col("fp").alias("their_fp"), F.col("n").alias("their_n"), F.col("tags").alias("item_tags"))
    pairs = pairs.join(theirs, F.col("item_id").eqNullSafe(F.col("theirs")) & (F.col("item_fp") == F.col("their_fp")) & (F.col("n") == F.col("their_n")))
    shared = F.size(F.array_intersect("tags", "item_tags"))
    same = (shared / (F.size("tags") + F.size("item_tags") - shared)).alias("similarity")
    kept = pairs.select("doc_id", "item_id", "start", "n_words", "distance", same).where(F.col("similarity") >= similarity)
    best = F.max(F.struct("similarity", (-F.col("start")).alias("before"), "n_words", "distance")).alias("best")
    return kept.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", (-F.col("best.before")).alias("start"), "best.n_words", "best.distance", "best.similarity")


def without_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:  # noqa: ANN003
    """``docs``, all columns, without the rows that hold an item, see :func:`leaks`.

    A row goes by its id and text together: another row of the same id, or one without an
    id, stays if its own text holds none. Equal rows go or stay alike. Null and empty texts
    stay; without items every row does.
    """
    key = fresh(docs, "key")
    keyed = docs.withColumn(key, F.xxhash64(F.col(f"`{id_col}`").isNull(), F.col(f"`{id_col}`"), F.col(f"`{text_col}`")))
    bad = leaks(keyed, benchmark, id_col=key, text_col=text_col, **how).select(F.col("doc_id").alias(key)).distinct()
    return keyed.join(checked(bad), key, "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))
