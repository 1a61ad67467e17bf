"""Delivery-diversity analytics on Spark: ingest, pool, search, cluster, review, score and report."""

__version__ = "0.1.0"
