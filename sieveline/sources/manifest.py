"""Manifests: reading, and dealing their rows into clips and rejected rows."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from datetime import datetime
from pathlib import PurePosixPath

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sieveline.operators.numbering import numbered
from sieveline.storage import cut, exists

# The fields that a manifest must have, those that are stripped, and the texts of the reasons.
REQUIRED = ("item_id", "session_id", "parent_video_id", "worker_id", "timestamp", "clip_path")
TRIMMED = REQUIRED[:-1]
LISTS = ("clips", "items", "records", "data")
#: Timestamps and numbers that are certain to be good; what it doesn't know goes to Python's own rules.
CERTAIN = r"^(\d{4}-(0[1-9]|1[0-2])-(0[1-9]|1\d|2[0-8])([T ]([01]\d|2[0-3]):[0-5]\d(:[0-5]\d)?(Z|[+-]([01]\d|2[0-3]):[0-5]\d)?)?|[+-]?\d+(\.\d*)?([eE][+-]?\d+)?)$"
CERTAIN_NUMBER = r"^[+-]?\d{1,300}(\.\d*)?$"


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text; a short row's are empty. ``row_number`` counts data rows from 1."""
    return csv_rows(spark, path, "row_number")


def csv_rows(spark: SparkSession, path: str, number: str | None = None) -> DataFrame:
    """As :func:`read_csv`, with the rows' numbers under another name, or without."""
    rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)  # reads the names alone
    found = _csv_rows(spark, path)
    if found is None:
        whole = rows.select(*(F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in rows.columns))
        return numbered(whole, number) if number else whole
    return found.select(*(F.coalesce(F.get("fields", F.lit(i)), F.lit("")).alias(c) for i, c in enumerate(rows.columns)), *([F.col("row_number").alias(number)] if number else []))


#: A well-formed field with the comma before it, and a whole record of them.
_FIELD = re.compile(r',(?:"((?:[^"]|"")*)"|([^",]*))')
_RECORD = re.compile(r'(?:,(?:"(?:[^"]|"")*+"|[^",]*+))++')


def _csv_fields(record: str) -> list[str] | None:
    """The fields of a record; none if it is malformed."""
    if '"' not in record:
        return record.split(",")
    record = "," + record
    return [q.replace('""', '"') or plain for q, plain in _FIELD.findall(record)] if _RECORD.fullmatch(record) else None


def _csv_rows(spark: SparkSession, path: str) -> DataFrame | None:
    """``(fields, row_number)`` of a CSV file's data rows, read by its splits.

    Whether a line begins a record follows from the number of quotes before it, which is even
    then, if all records are well-formed. None if one isn't, if lines end in some other way than
    the first, or if there is more than one file; such are read as a whole by Spark's own rules.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), "value")
    head = lines.where("at = 0").select("value").head()
    first = head["value"] if head else ""
    crlf = first.endswith("\r")
    if not first or "\r" in first.removesuffix("\r"):
        return None

    def ended(record: str) -> str:
        return record.removesuffix("\r").replace("\r\n", "\n") if crlf else record

    def blank(values: pa.Array) -> np.ndarray:
        sizes = pc.binary_length(values).to_numpy(zero_copy_only=False)
        return (sizes == 0) | ((sizes == 1) & pc.equal(values, "\r").to_numpy(zero_copy_only=False)) if crlf else sizes == 0

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each split, the records that begin in it if it begins outside of quotes, and if inside; and its quotes' parity."""
        told: dict[tuple[str, int], list[int]] = {}
        for batch in batches:
            for key, values in _by_split(batch):
                quotes = pc.count_substring(values, '"').to_numpy(zero_copy_only=False)
                own = told.setdefault(key, [0, 0, 0])
                before = (own[2] + np.cumsum(quotes) - quotes) % 2
                filled = ~blank(values)
                own[0] += int((filled & (before == 0)).sum())
                own[1] += int((filled & (before == 1)).sum())
                own[2] = int(own[2] + quotes.sum()) % 2
        rows = [(*key, *own) for key, own in told.items()]
        yield pa.RecordBatch.from_pylist([dict(zip(("file", "at", "outside", "inside", "odd"), r)) for r in rows], schema=pa.schema([("file", pa.string()), ("at", pa.int64()), ("outside", pa.int64()), ("inside", pa.int64()), ("odd", pa.int64())]))

    splits = sorted(tuple(r) for r in lines.mapInArrow(counted, "file string, at long, outside long, inside long, odd long").collect())  # one for each split
    if len({file for file, *_ in splits}) > 1:
        return None
    begins, inside, number = {}, 0, 0
    for file, at, *starts, odd in splits:
        begins[file, at] = (inside, number)
        number, inside = number + starts[inside], (inside + odd) % 2
    if inside:
        return None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Records with their numbers from 1, the header's first; those that go on beyond a split in parts, and malformed ones without fields."""
        open_: dict[tuple[str, int], tuple[int, int, list[str]]] = {}
        for batch in batches:
            rows: list[tuple] = []
            for key, values in _by_split(batch):
                quoted, n, held = open_.get(key) or (*begins[key], [])
                for value, odd in zip(values.to_pylist(), (pc.count_substring(values, '"').to_numpy(zero_copy_only=False) % 2).tolist()):
                    if not quoted:
                        if value in ("", "\r") and (crlf or not value):
                            continue
                        n += 1
                    quoted ^= odd
                    if quoted or held or (n == begins[key][1] and begins[key][0]):
                        held.append(value)
                        if quoted:
                            continue
                        value, held = "\n".join(held), []
                        if n == begins[key][1]:  # it began in a split before
                            rows.append((n, key[1], value, None))
                            continue
                    rows.append((n, -1, None, _csv_fields(ended(value))))
                open_[key] = quoted, n, held
            if rows:
                yield _csv_batch(rows)
        rows = [(n, at, "\n".join(held), None) for (_, at), (_, n, held) in open_.items() if held]
        if rows:
            yield _csv_batch(rows)

    found = cut(lines.mapInArrow(read, "n long, part long, text string, fields array<string>"))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("part", "text"))), lambda p: p["text"])
    torn = found.where("part >= 0").groupBy("n").agg(F.array_join(parts, "\n").alias("text"))

    def mended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _csv_batch([(n, -1, None, _csv_fields(ended(t))) for n, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())])

    every = found.where("part = -1").unionByName(cut(torn.mapInArrow(mended, "n long, part long, text string, fields array<string>")))
    if not every.where("fields IS NULL").isEmpty():
        return None
    return every.where("n > 1").select("fields", (F.col("n") - 1).alias("row_number"))


def _by_split(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.Array]]:
    """Runs of rows of one split of a file, from ``(file, at, value)``."""
    if not batch.num_rows:
        return
    at, files = batch.column(1).to_numpy(zero_copy_only=False), batch.column(0)
    ends = [*(np.flatnonzero((np.diff(at) != 0) | pc.not_equal(files[1:], files[:-1]).to_numpy(zero_copy_only=False)) + 1).tolist(), batch.num_rows]
    for start, end in zip([0, *ends], ends):
        yield (files[start].as_py(), int(at[start])), batch.column(2)[start:end]


def _csv_batch(rows: list[tuple]) -> pa.RecordBatch:
    n, part, text, fields = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(n, pa.int64()), pa.array(part, pa.int64()), pa.array(text, pa.string()), pa.array(fields, pa.list_(pa.string()))], names=["n", "part", "text", "fields"])


def _fields(records: DataFrame) -> DataFrame:
    """Columns of the records' fields, from ``(r, row_number)`` with a variant; what is no text is none in a required field, and JSON text in one of the manifest's own."""
    kind = F.schema_of_variant("r")
    checked = F.when(kind.startswith("OBJECT"), F.col("r")).otherwise(F.raise_error(F.concat(F.lit("a record of the manifest is no object: row "), F.col("row_number").cast("string"))).cast("variant"))
    rows = cut(records.select("row_number", F.from_json(F.to_json(checked), "map<string,string>").alias("m"), F.map_from_arrays(F.array(*map(F.lit, REQUIRED)), F.array(*(F.schema_of_variant(F.variant_get("r", f"$.{c}", "variant")) for c in REQUIRED))).alias("kinds")))
    names = {r["name"] for r in rows.select(F.explode(F.map_keys("m")).alias("name")).distinct().collect()}  # as many as the manifest has columns
    own = sorted(names - {*REQUIRED, "duration_seconds", "row_number"})
    text = lambda c: F.when(F.col("kinds")[c] == "STRING", F.col("m")[c])
    return rows.select(*(text(c).alias(c) for c in REQUIRED), F.col("m")["duration_seconds"].alias("duration_seconds"), *(F.col("m")[c].alias(c) for c in own), "row_number")


class _Pieces:
    """JSON text that arrives in pieces, of which little more is held than the value being read."""

    #: Characters that are asked for at once.
    chunk = 1 << 16

    def __init__(self, pieces: Iterator[str]) -> None:
        self.pieces, self.text, self.at, self.decoder = pieces, "", 0, json.JSONDecoder(strict=False)

    def more(self, least: int = 0) -> bool:
        got, n = [self.text[self.at :]], 0
        while n < max(least, self.chunk) and (piece := next(self.pieces, None)) is not None:
            got.append(piece)
            n += len(piece)
        self.text, self.at = "".join(got), 0
        return n > 0

    def peek(self) -> str:
        """The next character that isn't blank; none at the end."""
        while True:
            while self.at < len(self.text):
                if not self.text[self.at] in " \t\r\n":
                    return self.text[self.at]
                self.at += 1
            if not self.more():
                return ""

    def take(self, wanted: str) -> str:
        found = self.peek()
        if not found or found not in wanted:
            raise ValueError(f"the manifest is no JSON: {found!r} where one of {wanted} is due")
        self.at += 1
        return found

    def value(self) -> str:
        """The text of the next value."""
        self.peek()
        while True:
            try:
                _, end = self.decoder.raw_decode(self.text, self.at)
                # A number that ends the text may go on.
                if end < len(self.text) or not self.more():
                    text, self.at = self.text[self.at : end], end
                    return text
            except ValueError:
                if not self.more(len(self.text) - self.at + 1):
                    raise

    def listed(self) -> Iterator[str]:
        self.take("[")
        if self.peek() == "]":
            self.take("]")
            return
        while True:
            yield self.value()
            if self.take(",]") == "]":
                return


def _records(text: _Pieces) -> Iterator[tuple[int, int, str | None]]:
    """``(place, row_number, record)`` of the lists that may hold the records; row 0, without a record, says that a list is there."""
    if text.peek() == "[":
        yield 0, 0, None
        yield from ((0, n, r) for n, r in enumerate(text.listed(), 1))
    elif text.peek() == "{":
        text.take("{")
        seen, more = set(), text.peek() != "}"
        while more:
            name = json.loads(text.value(), strict=False)
            text.take(":")
            if name in seen:
                raise ValueError(f"the manifest has {name!r} twice")
            seen.add(name)
            if name in LISTS and text.peek() == "[":
                yield LISTS.index(name), 0, None
                yield from ((LISTS.index(name), n, r) for n, r in enumerate(text.listed(), 1))
            else:
                text.value()
            more = text.peek() != "}"
            if more:
                text.take(",")
        text.take("}")
    else:
        text.value()
    if text.peek():
        raise ValueError("the manifest goes on after its end")


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def pieces() -> Iterator[str]:
        before, first = -1, True
        for batch in batches:
            for at, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if at < before:
                    raise RuntimeError("the parts of the manifest come out of order")
                yield value if first else "," + value
                before, first = at, False

    def batch(rows: list) -> pa.RecordBatch:
        places, numbers, texts = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(places, pa.int32()), pa.array(numbers, pa.int64()), pa.array(texts, pa.string())], names=["place", "row_number", "record"])

    rows = []
    for row in _records(_Pieces(pieces())):
        rows.append(row)
        if len(rows) == 5000:
            yield batch(rows)
            rows = []
    if rows:
        yield batch(rows)


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """A list of objects, or an object with one under ``clips``, ``items``, ``records`` or ``data``.

    One task finds where records begin and end, and holds one of them at a time; they are
    read by all.
    """
    parts = spark.read.option("lineSep", ",").text(path).select(F.col("_metadata.file_block_start").alias("at"), "value")
    found = cut(parts.coalesce(1).mapInArrow(_streamed, "place int, row_number long, record string").repartition(max(2, spark.sparkContext.defaultParallelism)))
    place = found.agg(F.min("place")).first()[0]
    if place is None:
        raise ValueError("a manifest holds a list of records")
    return _fields(found.where((F.col("place") == place) & (F.col("row_number") > 0)).select(F.parse_json("record").alias("r"), "row_number"))


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """An object on each line that isn't blank."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    return _fields(numbered(lines, "row_number").select(F.parse_json("value").alias("r"), "row_number"))


def read(spark: SparkSession, path: str) -> DataFrame:
    readers = {".csv": read_csv, ".json": read_json, ".jsonl": read_json_lines}
    suffix = PurePosixPath(path).suffix.lower()
    if suffix not in readers:
        raise ValueError(f"manifest type {suffix!r} isn't known; use {', '.join(readers)}")
    if not exists(spark, path):
        raise FileNotFoundError(f"manifest not found: {path}")
    return readers[suffix](spark, path)


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def _blank(c: Column) -> Column:
    return c.isNull() | (strip(c) == "")


@F.pandas_udf(T.BooleanType())
def _timestamp(values: pd.Series) -> pd.Series:
    def good(v: str | None) -> bool | None:
        if v is None:
            return None
        for rule in (float, lambda x: datetime.fromisoformat(x.replace("Z", "+00:00"))):
            try:
                rule(v)
                return True
            except ValueError:
                pass
        return False

    return values.map(good)


@F.pandas_udf(T.DoubleType())
def _number(values: pd.Series) -> pd.Series:
    def value(v: str | None) -> float | None:
        try:
            return None if v is None else float(v)
        except ValueError:
            return None

    return values.map(value)


def _anchored(path: Column, input_dir: str | None) -> Column:
    return path if input_dir is None else F.when(path.startswith("/"), path).otherwise(F.concat(F.lit(input_dir.rstrip("/") + "/"), path))


def files_of(rows: DataFrame, input_dir: str | None = None) -> DataFrame:
    """``(path)`` of the manifest's media that are files, looked up where its rows are."""

    @F.pandas_udf(T.BooleanType())
    def there(paths: pd.Series) -> pd.Series:
        return paths.map(lambda p: p is not None and os.path.isfile(p))

    named = rows.select(_anchored(F.col("clip_path"), input_dir).alias("path")).distinct()
    return named.where(there("path"))


def classified(rows: DataFrame, input_dir: str | None = None, existing: DataFrame | None = None) -> DataFrame:
    """Every row with ``reason``: null for a clip, else why it is rejected.

    Missing fields come first, then an id that an accepted row before has, then bad
    fields, then a path that ``existing`` (``path``) doesn't list.
    """
    missing = F.concat_ws(", ", *(F.when(_blank(F.col(c)), F.lit(c)) for c in REQUIRED))
    r = rows.select("*", missing.alias("__missing"), *(strip(F.col(c)).alias(f"__{c}") for c in TRIMMED))
    sure = F.col("__timestamp").rlike(CERTAIN)
    stamp = F.coalesce(sure, F.lit(False)) | F.coalesce(_timestamp(F.when(~sure, F.col("__timestamp"))), F.lit(False))
    if "duration_seconds" in rows.columns:
        d = strip(F.col("duration_seconds").cast("string"))
        plain = d.rlike(CERTAIN_NUMBER)
        r = r.withColumn("__given", F.coalesce(d != "", F.lit(False))).withColumn("__duration", F.coalesce(F.when(plain, d.try_cast("double")), _number(F.when(~plain & (d != ""), d))))
    else:
        r = r.withColumn("__given", F.lit(False)).withColumn("__duration", F.lit(None).cast("double"))
    bad = F.concat_ws("; ", F.when(~stamp, "timestamp: neither ISO-8601 nor a number"), F.when(F.col("__given") & F.col("__duration").isNull(), "duration_seconds: not a number"), F.when(F.col("__duration") <= 0, "duration_seconds: not positive"))
    r = r.withColumn("__bad", bad).withColumn("__path", _anchored(F.col("clip_path"), input_dir))
    if existing is not None:
        r = r.join(existing.select(F.col("path").alias("__path"), F.lit(True).alias("__there")).distinct(), "__path", "left")
        r = r.withColumn("__bad", F.when(F.col("__bad") != "", F.col("__bad")).when(F.col("__there").isNull(), F.concat(F.lit("clip_path not found: "), "__path")).otherwise(""))
    fine = (F.col("__missing") == "") & (F.col("__bad") == "")
    # Rows without an id are none's duplicates, so they aren't brought together.
    r = cut(r)
    first = r.where(fine).groupBy(F.col("__item_id").alias("__id")).agg(F.min("row_number").alias("__first"))
    r = r.join(first, (F.col("__item_id") == F.col("__id")) & (F.col("__missing") == ""), "left")
    reason = (
        F.when(F.col("__missing") != "", F.concat(F.lit("missing required field(s): "), "__missing"))
        .when(F.col("row_number") > F.col("__first"), F.concat(F.lit("duplicate item_id (first seen at row "), F.col("__first").cast("string"), F.lit(")")))
        .when(F.col("__bad") != "", F.col("__bad"))
    )
    names = [c for c in rows.columns if c not in (*TRIMMED, "clip_path", "duration_seconds", "row_number")]
    return r.select("row_number", *(F.col(f"__{c}").alias(c) for c in TRIMMED), F.col("__path").alias("clip_path"), F.col("__duration").alias("duration_seconds"), *names, reason.alias("reason"))


def clips(dealt: DataFrame) -> DataFrame:
    return dealt.where("reason is null").drop("reason")


def rejected(dealt: DataFrame) -> DataFrame:
    return dealt.where("reason is not null").select("row_number", F.coalesce("item_id", F.lit("")).alias("item_id"), "reason")
