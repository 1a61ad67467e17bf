"""Readers of manifests, caches and tables."""
