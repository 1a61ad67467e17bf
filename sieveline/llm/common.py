"""What several operators of this subpackage share."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  pa.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.storage import cut

#: Fixed values of the words' definition: ASCII white space, and A-Z against a-z.
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TO_LOWER = str.maketrans(UPPER, LOWER)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def only(df: DataFrame, *names: str) -> DataFrame:
    """These columns and no others, so that further columns of a caller can't clash with an operator's own."""
    return df.select(*(F.col(f"`{n}`") for n in names))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have, whatever the case of its letters."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


#: Rows of a few numbers that may be broadcast, some 20 MB; with more they are joined by a shuffle.
FEW = 500_000


def checked(df: DataFrame, rows: int = FEW) -> DataFrame:
    """``df``, worked out once, for the smaller side of a join: to be broadcast if it has ``rows`` rows at most."""
    df = cut(df)
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def groups_of(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    """The groups of rows with equal values in the first ``keys`` columns, of batches in the order of those."""
    held: pa.RecordBatch | None = None
    for batch in batches:
        if held is not None:
            batch = pa.concat_batches([held, batch])
        if not batch.num_rows:
            continue
        changes = np.zeros(batch.num_rows - 1, dtype=bool)
        for c in range(keys):
            changes |= pa.compute.not_equal(batch.column(c)[1:], batch.column(c)[:-1]).to_numpy(zero_copy_only=False)
        ends = [0, *(np.flatnonzero(changes) + 1).tolist()]
        for a, b in zip(ends, ends[1:]):
            yield batch.slice(a, b - a)
        held = batch.slice(ends[-1])
    if held is not None and held.num_rows:
        yield held
    release()


def held_out(doc_id: str = "doc_id") -> Column:
    """True where crc32 of the id as text leaves 0 modulo 5; a null id counts as held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def pieces_of(batches: Iterator[pa.RecordBatch], column: int, most: int) -> Iterator[pa.RecordBatch]:
    """The batches cut into slices whose texts hold about ``most`` bytes at the largest; a longer text has a slice of its own."""
    for batch in batches:
        lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
        begin = held = 0
        for i, n in enumerate(lengths):
            if held and held + n > most:
                yield batch.slice(begin, i - begin)
                begin, held = i, 0
            held += n
        if begin < len(lengths):
            yield batch.slice(begin)
    release()


def release() -> None:
    """Gives memory that this worker process has freed back to the system: it lives on for other tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass
