"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sieveline.llm import bpe, decontamination, embedding_forest, license_scan, quality, simhash, substring_dedup, token_counts, toxicity, url_filters
from sieveline.llm.common import table


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every url of ``pages``: host, path, the longest rule that fits, and the verdict. Null urls and such without ``://`` have empty parts and are judged like any other; repeated rows stay repeated."""
    return url_filters.judged(table(spark, sf_dir, "pages"))


def op2_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of ``documents`` with its fingerprint and the smallest id that links reach. Null, empty and wordless texts have fingerprint zero and link like any other."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of ``documents`` with its score. Null and empty texts have that of a text without features; without labels all have 0.5."""
    return quality.classified(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_embedding_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of ``embeddings`` with its links and component. Rows without a label, and bad vectors, are alone."""
    return embedding_forest.near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of ``documents`` with its bytes and tokens; a null text has none."""
    import public_tokenizers

    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document and item of ``benchmark`` with a window of similarity 0.8 or more; null, empty and wordless texts match nothing."""
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of ``documents`` with its phrases and licenses; a null text counts as empty."""
    return license_scan.licenses(table(spark, sf_dir, "documents"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of ``documents`` with the digests of its ids and of the bytes that they decode to; a null text has no ids."""
    import public_tokenizers

    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of ``documents`` with its score. Null and empty texts have that of a text without words; without labels all have 0.5."""
    return toxicity.classified(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``documents`` that share a passage with another document, and what each loses; null and empty texts share nothing."""
    return substring_dedup.repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_spans", "repeated_words", "removed_words")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        op1_url_filters, op2_simhash_near_duplicates, op3_quality, op4_embedding_near_duplicates, op5_token_counts,
        op6_decontamination, op7_license_scan, op8_byte_bpe, op9_toxicity, op10_substring_dedup,
    )
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return {"op1_url_filters": url_filters.judged_sql(), "op4_embedding_near_duplicates": embedding_forest.near_duplicates_sql()}
