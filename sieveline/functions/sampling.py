"""How many frames of a clip to take, where, and which of them to show."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def frames_for(duration: Column, buckets: Sequence[tuple[float, int]] = (), default: int = 5) -> Column:
    """The count of the first bucket (longest duration, count) that holds the duration; the default for null and beyond."""
    return reduce(lambda rest, b: F.when(duration <= b[0], b[1]).otherwise(rest), reversed(list(buckets)), F.lit(default))


def sample_offsets(duration: Column, count: Column) -> Column:
    """Seconds at which to take ``count`` frames: the middle for one, else evenly from start to end."""
    return F.when(count == 1, F.array(duration / 2)).otherwise(F.transform(F.sequence(F.lit(0), count - 1), lambda i: i / (count - 1) * duration))


def seek_ladder(duration: Column, offset: Column, is_last: Column) -> Column:
    """Attempts ``(mode, seconds)`` in order: from the end for a last frame, else at the offset; then nearer the start; then 0."""
    step = lambda mode, s: F.struct(F.lit(mode).alias("mode"), s.cast("double").alias("seconds"))
    margin = F.greatest(duration * 0.5, F.lit(0.01))
    first = F.when(is_last, F.array(*(step("from_end", F.least(F.lit(m), margin)) for m in (0.1, 0.25, 0.5, 1.0)))).otherwise(F.array(step("from_start", offset)))
    nearer = F.filter(F.array(*(step("from_start", offset * f) for f in (0.95, 0.85, 0.5))), lambda x: x["seconds"] > 0.01)
    return F.concat(first, nearer, F.array(step("from_start", F.lit(0.0))))


def representative(paths: Column, count: int) -> Column:
    """``count`` of the paths: all if there are no more, the middle one, or evenly spread with halves to even."""
    n = F.size(paths)
    if count == 1:
        spread = F.slice(paths, F.floor(n / 2).cast("int") + 1, 1)
    else:
        spread = F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda i: F.get(paths, F.bround(i * (n - 1) / F.lit(count - 1)).cast("int")))
    return F.when(n <= count, paths).otherwise(spread)


def safe_id(item_id: Column) -> Column:
    """Letters, digits and ``-_.`` stay; others become ``_``."""
    text = F.regexp_replace(item_id, r"[^\p{L}\p{N}._-]", "_")
    return F.when(text == "", "_unnamed").otherwise(text)
