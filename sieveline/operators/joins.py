"""Joins that hold when a few keys have most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is heavy if it has over a share of one in so many of all rows; there are fewer than that, so they may be broadcast.
HEAVY = 10_000


def join_dealt(big: DataFrame, each: DataFrame, on: str, n: str, total: int) -> DataFrame:
    """``big`` and what ``each`` has for its key, however many rows of one key there are.

    ``each`` has one row for every key of ``big``, with the number of the key's rows in column
    ``n``, of ``total`` in all. The rows of heavy keys stay where they are and meet a
    broadcast of fewer than ``HEAVY`` rows; only the others are shuffled.
    """
    heavy = F.col(n) > total / HEAVY
    most = F.broadcast(each.where(heavy).drop(n))
    light = big.join(most.select(on), on, "left_anti").join(each.where(~heavy).drop(n), on)
    return light.unionByName(big.join(most, on))
