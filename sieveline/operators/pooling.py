"""Frame vectors to one unit vector per clip."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.functions.vectors import clamp, dot, doubles, l2_normalize

MODES = ("mean", "none")


def pool(frames: DataFrame, mode: str = "mean") -> DataFrame:
    """``(item_id, vec)`` from ``(item_id, frame_index, embedding)``: the mean of the frames or frame 0, of length 1.

    Clips whose frames differ in dimension make the query fail.
    """
    if mode not in MODES:
        raise ValueError(f"pooling mode {mode!r} can't pool a clip; use one of {', '.join(MODES)}")
    f = frames.select("item_id", "frame_index", doubles("embedding").alias("e")).where("size(e) > 0")
    if mode == "none":
        return f.groupBy("item_id").agg(F.min_by("e", "frame_index").alias("e")).select("item_id", l2_normalize(F.col("e")).alias("vec"))
    ordered = f.groupBy("item_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("frame_index", "e"))), lambda x: x["e"]).alias("es"))
    same = F.size(F.array_distinct(F.transform("es", F.size))) == 1
    total = F.aggregate(F.slice("es", 2, F.size("es")), F.get("es", F.lit(0)), lambda s, x: F.zip_with(s, x, lambda a, b: a + b))
    summed = ordered.select("item_id", F.size("es").alias("n"), F.when(same, total).otherwise(F.raise_error(F.lit("frames differ in dimension"))).alias("total"))
    mean = summed.select("item_id", F.transform("total", lambda x: x / F.col("n")).alias("mean"))
    return mean.select("item_id", l2_normalize(F.col("mean")).alias("vec"))


def uniform(clips: DataFrame) -> DataFrame:
    """``clips``, whose vectors have one dimension; an error if they have several."""
    sizes = sorted(r["n"] for r in clips.select(F.size("vec").alias("n")).distinct().limit(5).collect())
    if len(sizes) > 1:
        raise RuntimeError(f"vectors of several dimensions: {', '.join(map(str, sizes))}")
    return clips


def max_frame_similarity(a: Column, b: Column) -> Column:
    """The largest cosine between a frame of ``a`` and a frame of ``b``, both arrays of unit vectors."""
    return F.array_max(F.transform(a, lambda x: F.array_max(F.transform(b, lambda y: clamp(dot(x, y), -1.0, 1.0)))))
