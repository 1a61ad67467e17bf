"""Novelty, penalty, score, and who redundancy comes from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.functions.vectors import novelty
from sieveline.storage import cut


def clip_scores(nearest: DataFrame, assigned: DataFrame) -> DataFrame:
    """``(item_id, novelty, max_similarity, nearest_item_id, cluster_size)``."""
    sizes = assigned.select("item_id", F.col("size").alias("cluster_size"))
    rows = nearest.join(sizes, "item_id", "left")
    return rows.select("item_id", novelty(F.col("similarity")).alias("novelty"), F.coalesce("similarity", F.lit(0.0)).alias("max_similarity"), "nearest_item_id", F.coalesce("cluster_size", F.lit(1)).alias("cluster_size"))


def summary(scores: DataFrame, assigned: DataFrame, max_points: float = 15.0, exponent: float = 1.5) -> DataFrame:
    """One row: ``score, avg_novelty, cluster_penalty, total_clips, duplicate_clusters, clipped_clips``; zeros without clips."""
    total = scores.agg(F.count(F.lit(1)).alias("total_clips"), F.coalesce(F.avg("novelty"), F.lit(0.0)).alias("avg_novelty"))
    large = assigned.where("size > 1 and item_id = component")
    cost = large.agg(F.coalesce(F.sum(F.pow("size", F.lit(exponent))), F.lit(0.0)).alias("cost"), F.count(F.lit(1)).alias("duplicate_clusters"), F.coalesce(F.sum("size"), F.lit(0)).alias("clipped_clips"))
    both = total.join(cost)  # two rows of one
    penalty = F.when(F.col("total_clips") > 0, F.col("cost") / F.col("total_clips")).otherwise(0.0)
    rows = both.withColumn("cluster_penalty", penalty)
    return rows.select(F.greatest(F.lit(0.0), (F.col("avg_novelty") - F.col("cluster_penalty")) * max_points).alias("score"), "avg_novelty", "cluster_penalty", "total_clips", "duplicate_clusters", "clipped_clips")


def redundancy_by(scores: DataFrame, manifest: DataFrame, attribute: str) -> DataFrame:
    """``(key, clips, clustered_clips, mean_novelty, redundancy_rate, share)`` per value of ``attribute``."""
    rows = scores.join(manifest.select("item_id", F.col(attribute).cast("string").alias("key")), "item_id")
    groups = cut(rows.groupBy("key").agg(F.count(F.lit(1)).alias("clips"), F.count_if(F.col("cluster_size") > 1).alias("clustered_clips"), F.avg("novelty").alias("mean_novelty")))
    total = groups.agg(F.sum("clustered_clips")).first()[0]
    share = F.col("clustered_clips") / F.lit(total) if total else F.lit(0.0)
    return groups.select("key", "clips", "clustered_clips", "mean_novelty", (F.col("clustered_clips") / F.col("clips")).alias("redundancy_rate"), share.alias("share"))
