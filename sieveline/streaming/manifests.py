"""Manifest rows that arrive in files, checked as they come."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from sieveline.operators.numbering import numbered
from sieveline.sources import manifest
from sieveline.storage import cut


def ingest(spark: SparkSession, folder: str, out: str, checkpoint: str, schema: str) -> StreamingQuery:
    """Each new CSV file is dealt into ``out/clips`` and ``out/rejected``; ids are unique within a batch, and its rows are numbered from 1."""

    def deal(batch: DataFrame, number: int) -> None:
        dealt = cut(manifest.classified(numbered(batch, "row_number")))
        manifest.clips(dealt).write.mode("overwrite").parquet(f"{out}/clips/batch={number}")
        manifest.rejected(dealt).write.mode("overwrite").parquet(f"{out}/rejected/batch={number}")

    return spark.readStream.schema(schema).option("header", True).option("escape", '"').csv(folder).writeStream.foreachBatch(deal).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
