"""Which search a configuration asks for."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame

from sieveline.config import Search
from sieveline.operators import knn


class Index(Protocol):
    """Finds the neighbours of clips ``(item_id, vec)``: ``(item_id, neighbor_id, similarity, rank)``."""

    name: str

    def neighbors(self, clips: DataFrame, k: int) -> DataFrame: ...


@dataclass(frozen=True)
class Exact:
    name: str = "exact"

    def neighbors(self, clips: DataFrame, k: int) -> DataFrame:
        return knn.exact(clips, k)


@dataclass(frozen=True)
class Cells:
    """``nlist`` cells, fewer for few clips, of which the ``nprobe`` nearest are searched."""

    nlist: int = 100
    nprobe: int = 10
    seed: int = 17
    name: str = "cells"

    def neighbors(self, clips: DataFrame, k: int) -> DataFrame:
        return knn.probe(clips, k, self.nlist, self.nprobe, seed=self.seed)


def index_for(how: Search, seed: int = 17) -> Index:
    """``flat`` and ``hnsw`` are searched exactly, ``ivf`` by cells."""
    return Cells(how.nlist, how.nprobe, seed) if how.index_type == "ivf" else Exact()
