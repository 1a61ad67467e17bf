"""Row numbers without bringing all rows into one task."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.storage import cut

#: Fixed value: the low bits of a monotonically increasing id count rows within a partition.
WITHIN = (1 << 33) - 1


def numbered(df: DataFrame, name: str, first: int = 1) -> DataFrame:
    """``df`` and a column ``name`` with its rows' numbers, in the order of its partitions and of the rows in them.

    Partitions are counted, and each one's rows go on where the one before ends; only the
    counts, one for each partition, reach the driver. ``df`` is written first, so that its
    rows keep their order.
    """
    kept = cut(df)
    part, place = "__part", "__place"
    placed = kept.withColumn(part, F.spark_partition_id()).withColumn(place, F.monotonically_increasing_id().bitwiseAND(F.lit(WITHIN)))
    counts = sorted((r[part], r["count"]) for r in placed.groupBy(part).count().collect())
    before = accumulate((n for _, n in counts), initial=first)
    offsets = df.sparkSession.createDataFrame([(p, b) for (p, _), b in zip(counts, before)], f"{part} int, __before long")
    return placed.join(F.broadcast(offsets), part).select(*(F.col(f"`{c}`") for c in df.columns), (F.col(place) + F.col("__before")).alias(name))
