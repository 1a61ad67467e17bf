"""The corpus pipeline: five stages over ``documents``, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.llm import bpe, decontamination, quality, simhash, substring_dedup
from sieveline.llm.common import checked, fresh, table
from sieveline.shipping import ship
from sieveline.storage import cut, remove, shared_folder


#: Bytes of a slice, and of what a worker keeps, in the last stage: it shares the executors' memory with what other stages left.
SLICE, KEPT_BYTES = 2 << 20, 24 << 20


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the rows that the classifier rejects, by their texts alone; a null text counts as empty. Repeated rows and null ids change nothing."""
    ship(spark)
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group stays: the one with the smallest id, or without an id if none has one.

    Of rows with equal ids the one with the smallest hash stays, of rows with equal texts
    besides any one. Null, empty and wordless texts are one group.
    """
    ship(spark)
    key = fresh(docs, "key")
    keyed = docs.withColumn(key, F.xxhash64(F.col("doc_id").isNull(), "doc_id", "text"))
    rows = keyed.select(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.col(key).alias("key")).alias("row"), "text")
    found = simhash.near_duplicates(rows, id_col="row")
    marked = cut(found.groupBy(F.col("doc_id.key").alias(key)).agg(F.min(F.col("doc_id") == F.col("component_id")).alias("stays"), F.count(F.lit(1)).alias("n")))
    out = keyed.join(checked(marked.where("not stays").select(key)), key, "left_anti")
    twice = checked(marked.where("stays and n > 1").select(key))
    if not twice.isEmpty():  # only equal rows are moved
        out = out.join(twice, key, "left_anti").unionByName(out.join(twice, key, "left_semi").dropDuplicates([key]))
    return out.select(*(F.col(f"`{c}`") for c in docs.columns))


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the passages that another document has too, but for one whole copy of each; ``n_chars`` follows the text.

    A row goes only if it had words and none are left. Null and empty texts stay, equal
    rows are one document and stay alike.
    """
    ship(spark)
    out = substring_dedup.without_repeats(docs)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the rows that hold a benchmark item, by id and text together; null and empty texts stay."""
    ship(spark)
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts, and digests of the ids and of the bytes that they decode to, of every row; a null text counts as empty."""
    import public_tokenizers

    ship(spark)
    return bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, slice_bytes=SLICE, kept_bytes=KEPT_BYTES)


STAGES = [
    ("quality_filter", quality_filter),
    ("simhash_dedup", simhash_dedup),
    ("drop_repeats", drop_repeats),
    ("decontaminate", decontaminate),
    ("encode", encode),
]

#: A stage learns a model and another encodes by merges, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, one after the other; between them the documents are Parquet in the shared folder, of which only the last stays."""
    import uuid

    at = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{at}/{name}")
        docs = spark.read.parquet(f"{at}/{name}")
        if before:
            remove(spark, before)
        before = f"{at}/{name}"
    return docs
