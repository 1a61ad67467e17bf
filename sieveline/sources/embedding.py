"""Vectors of frames: a deterministic stub, models behind an interface, and their Parquet cache."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any, Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.config import Embeddings
from sieveline.functions.vectors import l2_normalize
from sieveline.storage import cut, exists, remove

log = logging.getLogger(__name__)

# The stub's digests of a payload, and the numbers in each.
BLOCKS, WORDS = 8, 8
SCHEMA = "item_id string, frame_index int, embedding array<float>, error string"


class Embedder(Protocol):
    """Turns the files of one clip's frames into one row each."""

    name: str
    dim: int

    def embed(self, paths: Sequence[str]) -> np.ndarray: ...


def stub_vectors(payloads: DataFrame) -> DataFrame:
    """``(item_id, vec)`` from ``(item_id, payload)``: 64 numbers of the SHA-256 of payload and counter, of length 1."""
    counters = [i.to_bytes(4, "little") for i in range(BLOCKS)]
    digests = payloads.select("item_id", F.array(*(F.sha2(F.concat(F.coalesce("payload", F.lit(b"")), F.lit(c)), 256) for c in counters)).alias("hs"))
    little = lambda h, j: F.concat(*(F.substring(h, j * 8 + p, 2) for p in (7, 5, 3, 1)))
    numbers = F.flatten(F.transform("hs", lambda h: F.array(*(F.conv(little(h, j), 16, 10).cast("double") / 4294967296.0 - 0.5 for j in range(WORDS)))))
    return digests.select("item_id", numbers.alias("e")).select("item_id", l2_normalize("e").alias("vec"))


class Stub:
    """The same vectors for files: of the picture at 16 by 16 pixels where Pillow is there, else of the file's bytes, else of its name."""

    name, dim = "stub", BLOCKS * WORDS

    @staticmethod
    def _payload(path: str) -> bytes:
        try:
            from PIL import Image

            with Image.open(path) as picture:
                return picture.convert("RGB").resize((16, 16)).tobytes()
        except Exception:  # noqa: BLE001  no library, or no picture
            pass
        try:
            with open(path, "rb") as f:
                return f.read()
        except OSError:
            return path.rpartition("/")[2].encode()

    def embed(self, paths: Sequence[str]) -> np.ndarray:
        from hashlib import sha256

        raw = [b"".join(sha256(p + i.to_bytes(4, "little")).digest() for i in range(BLOCKS)) for p in map(self._payload, paths)]
        numbers = np.frombuffer(b"".join(raw), dtype="<u4").reshape(len(raw), -1) / 2.0**32 - 0.5
        return (numbers / np.linalg.norm(numbers, axis=1, keepdims=True)).astype(np.float32)


def device_of(wanted: str, torch: Any = None) -> str:
    """``cuda`` if it is wanted or left open and there, else ``cpu``, with a warning if it was wanted."""
    if wanted != "cpu":
        if torch is None:
            try:
                import torch
            except ImportError:
                torch = None
        if torch is not None and torch.cuda.is_available():
            return "cuda"
        if wanted == "cuda":
            log.warning("no CUDA device: the CPU is used")
    return "cpu"


@dataclass
class Pictures:
    """A vision model of a public library, loaded in the worker that uses it."""

    model_name: str
    kind: str
    batch_size: int = 32
    device: str = "auto"
    dim: int = 0

    @property
    def name(self) -> str:
        return f"{self.kind}-{self.model_name}".replace("/", "_")

    def _loaded(self) -> tuple:
        if "_model" not in self.__dict__:
            try:
                import torch
                from transformers import AutoImageProcessor, AutoModel
            except ImportError as e:
                raise RuntimeError(f"{self.kind} needs the packages torch and transformers; the stub needs none") from e
            where = device_of(self.device, torch)
            self._model = AutoModel.from_pretrained(self.model_name).to(where).eval(), AutoImageProcessor.from_pretrained(self.model_name), torch, where
        return self._model

    def embed(self, paths: Sequence[str]) -> np.ndarray:
        model, prepare, torch, where = self._loaded()
        from PIL import Image

        out = []
        for i in range(0, len(paths), self.batch_size):
            pictures = [Image.open(p).convert("RGB") for p in paths[i : i + self.batch_size]]
            with torch.inference_mode():
                given = prepare(images=pictures, return_tensors="pt").to(where)
                made = model.get_image_features(**given) if self.kind == "clip" else model(**given).last_hidden_state[:, 0]
            out.append(made.float().cpu().numpy())
        return np.concatenate(out)


def chosen(how: Embeddings) -> tuple[Embedder, Embedder | None]:
    """The embedder that the score follows, and the one whose vectors are only kept, if any.

    If the secondary drives, the primary isn't made at all.
    """
    secondary = Pictures(how.secondary_clip.model_name, "clip", how.batch_size, how.device) if how.secondary_clip.enabled else None
    if how.driver == "secondary" and secondary is not None:
        return secondary, None
    return Stub() if how.backend == "stub" else Pictures(how.model_name, how.backend, how.batch_size, how.device), secondary


def embed(frames: DataFrame, make: Callable[[], Embedder], cache: DataFrame | None = None) -> DataFrame:
    """``(item_id, frame_index, embedding, error)`` of frames ``(item_id, paths)``; rows of ``cache`` with as many frames are taken as they are.

    A clip that can't be embedded, or not with one row for each frame, gets one row with an
    error.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = make()
        for part in parts:
            rows = []
            for item, paths in zip(part["item_id"], part["paths"]):
                try:
                    made = np.asarray(own.embed(list(paths)), dtype=np.float32)
                    if made.ndim != 2 or len(made) != len(paths):
                        raise ValueError(f"{made.shape} for {len(paths)} frames")
                    rows += [(item, i, v, None) for i, v in enumerate(made)]
                except RuntimeError:  # the model itself isn't there
                    raise
                except Exception as e:  # noqa: BLE001  one clip's failure is its own
                    rows.append((item, None, None, str(e) or type(e).__name__))
            yield pd.DataFrame(rows, columns=["item_id", "frame_index", "embedding", "error"]).astype({"frame_index": "Int32"})

    if cache is None:
        return frames.select("item_id", "paths").mapInPandas(run, SCHEMA)
    held = cache.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
    good = frames.join(held, "item_id").where(F.col("n") == F.size("paths")).select("item_id")
    fresh = frames.join(good, "item_id", "left_anti").select("item_id", "paths").mapInPandas(run, SCHEMA)
    return cache.join(good, "item_id", "left_semi").select("item_id", "frame_index", "embedding", F.lit(None).cast("string").alias("error")).unionByName(fresh)


def embedded(frames: DataFrame, embedder: Embedder, cache_dir: str, force: bool = False) -> DataFrame:
    """:func:`embed` through the cache of that embedder, ``cache_dir/embeddings/embedder=<name>``, which then holds the vectors of all these clips.

    The cache is read, written anew beside itself, and replaced.
    """
    spark = frames.sparkSession
    at = f"{cache_dir.rstrip('/')}/embeddings/embedder={embedder.name}"
    before = spark.read.parquet(at) if exists(spark, at) else None
    rows = cut(embed(frames, lambda: embedder, None if force else before))
    new = rows.where("error is null").drop("error")
    if before is not None:
        new = cut(before.join(new.select("item_id").distinct(), "item_id", "left_anti").select(*new.columns).unionByName(new))
    if not new.isEmpty():
        remove(spark, at)
        new.write.parquet(at)
    return rows
