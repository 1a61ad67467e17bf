"""Expressions over vectors held as arrays, summed from left to right in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TINY = 1e-12


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def doubles(v: Column | str) -> Column:
    return _col(v).cast("array<double>")


def dot(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(F.zip_with(_col(a), _col(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def l2_normalize(v: Column | str) -> Column:
    """``v`` over its length, which is worked out once; a zero vector stays zero."""
    v = doubles(v)
    length = F.greatest(F.sqrt(dot(v, v)), F.lit(TINY))
    return F.get(F.transform(F.array(length), lambda n: F.transform(v, lambda x: x / n)), F.lit(0))


def clamp(x: Column, low: float, high: float) -> Column:
    return F.least(F.lit(high), F.greatest(F.lit(low), x))


def novelty(similarity: Column) -> Column:
    """1 less the nearest similarity, within 0 and 1; 1 without a neighbour."""
    return clamp(1 - F.coalesce(similarity, F.lit(0.0)), 0.0, 1.0)
