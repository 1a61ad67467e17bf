"""Similar pairs, their graph, and its clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sieveline.operators.components import connected_components
from sieveline.operators.numbering import numbered


def unique_pairs(neighbors: DataFrame) -> DataFrame:
    """``(a, b, similarity)``, a before b, the larger of both directions; exact opposites are no pair."""
    ends = neighbors.select(F.least("item_id", "neighbor_id").alias("a"), F.greatest("item_id", "neighbor_id").alias("b"), "similarity")
    return ends.groupBy("a", "b").agg(F.max("similarity").alias("similarity")).where("similarity > -1")


def edges(pairs: DataFrame, threshold: float) -> DataFrame:
    return pairs.where(F.col("similarity") >= threshold)


def assignment(clips: DataFrame, edges: DataFrame) -> DataFrame:
    """``(item_id, component, size)``; ``component`` is the smallest id of the cluster, a clip without edges its own."""
    found = connected_components(edges).select(F.col("node").alias("item_id"), "component")
    each = clips.select("item_id").join(found, "item_id", "left").select("item_id", F.coalesce("component", "item_id").alias("component"))
    sizes = each.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    return each.join(sizes, "component").select("item_id", "component", "size")


def clusters(assigned: DataFrame, edges: DataFrame, least: int = 1) -> DataFrame:
    """``(cluster_id, first_member, size, max_similarity, mean_similarity)`` of clusters of ``least`` clips or more, the largest first, from 0; 0.0 without edges.

    The rows come in that order. They are sorted and numbered by ranges, not in one task.
    """
    inside = edges.join(assigned.select(F.col("item_id").alias("a"), "component"), "a").groupBy("component").agg(F.max("similarity").alias("top"), F.avg("similarity").alias("mean"))
    rows = assigned.where((F.col("size") >= least) & (F.col("item_id") == F.col("component"))).select("component", "size").join(inside, "component", "left")
    named = rows.select(F.col("component").alias("first_member"), "size", F.coalesce("top", F.lit(0.0)).alias("max_similarity"), F.coalesce("mean", F.lit(0.0)).alias("mean_similarity"))
    each = numbered(named.orderBy(F.desc("size"), "first_member"), "cluster_id", first=0)
    return each.select(F.col("cluster_id").cast("int").alias("cluster_id"), "first_member", "size", "max_similarity", "mean_similarity")


def members(assigned: DataFrame, clusters: DataFrame) -> DataFrame:
    """``(cluster_id, item_id)`` of the clips of these clusters."""
    return assigned.select("item_id", F.col("component").alias("first_member")).join(clusters.select("cluster_id", "first_member"), "first_member").select("cluster_id", "item_id")


def preview(assigned: DataFrame, shown: int = 6) -> DataFrame:
    """``(first_member, members)``: a cluster's first ids, joined by commas, with dots if it has more.

    No more than one id beyond those shown is brought together for a cluster.
    """
    place = F.row_number().over(Window.partitionBy("component").orderBy("item_id"))
    few = assigned.where("size > 1").withColumn("place", place).where(F.col("place") <= shown + 1)
    listed = few.groupBy("component").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "item_id"))), lambda x: x["item_id"]).alias("ids"))
    return listed.select(F.col("component").alias("first_member"), F.concat(F.array_join(F.slice("ids", 1, shown), ", "), F.when(F.size("ids") > shown, " ...").otherwise("")).alias("members"))


def flagged(assigned: DataFrame, least: int = 3) -> DataFrame:
    """``(item_id)`` of all but the first member of each cluster of ``least`` clips or more."""
    return assigned.where((F.col("size") >= least) & (F.col("item_id") != F.col("component"))).select("item_id")


def force(pairs: DataFrame, merged: DataFrame, threshold: float) -> DataFrame:
    """``pairs`` with each pair of ``merged`` ``(a, b)`` set to the threshold, so that it is an edge."""
    put = merged.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return pairs.join(put, ["a", "b"], "left_anti").unionByName(put.withColumn("similarity", F.lit(float(threshold))))
