"""Frames of clips: probing, extraction by an external command, and the folder that keeps them.

Clips are dealt over the executors and each is worked on by child processes there, so the
cache folder and the media have to be shared. A clip's failure is a row with an error and
never ends the stage. The commands are parameters: tests and other tools put their own in
place of ``ffprobe`` and ``ffmpeg``.
"""

from __future__ import annotations

import json
import shutil
import subprocess
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.config import Frames
from sieveline.functions import sampling

SCHEMA = "item_id string, paths array<string>, reused boolean, error string"


@dataclass(frozen=True)
class Tools:
    """The commands; each is the beginning of an argument list."""

    probe: tuple[str, ...] = ("ffprobe",)
    grab: tuple[str, ...] = ("ffmpeg",)
    probe_seconds: float = 60.0

    def required(self) -> Tools:
        lost = [c[0] for c in (self.probe, self.grab) if shutil.which(c[0]) is None]
        if lost:
            raise RuntimeError(f"not on the path: {', '.join(lost)}; frames can't be extracted without")
        return self

    def seconds_of(self, path: str) -> float | None:
        """The length of a media file; none if it can't be told or isn't positive."""
        asked = [*self.probe, "-v", "error", "-show_entries", "format=duration", "-of", "json", path]
        try:
            told = subprocess.run(asked, capture_output=True, text=True, timeout=self.probe_seconds, check=True)
            seconds = float(json.loads(told.stdout)["format"]["duration"])
        except (OSError, subprocess.SubprocessError, ValueError, KeyError, TypeError):
            return None
        return seconds if seconds > 0 else None

    def take(self, path: str, seek: Sequence[str], size: tuple[int, int], quality: int, out: Path, seconds: float) -> str | None:
        """One frame to ``out``; what went wrong, or none. A command that can't be run, or hangs, raises."""
        asked = [*self.grab, "-nostdin", "-y", *seek, "-i", path, "-frames:v", "1", "-vf", f"scale={size[0]}:{size[1]}", "-q:v", str(quality), str(out)]
        told = subprocess.run(asked, capture_output=True, text=True, timeout=seconds, check=False)
        if told.returncode == 0 and _filled(out):
            return None
        return (told.stderr or "").strip().rpartition("\n")[2] or "no message"


def _filled(path: Path) -> bool:
    return path.is_file() and path.stat().st_size > 0


def probed(clips: DataFrame, tools: Tools, workers: int) -> DataFrame:
    """``clips`` with ``seconds``: the duration that they state, else what the probe tells, else null."""
    stated = clips.where(F.col("duration_seconds").isNotNull()).select("item_id", "clip_path", F.col("duration_seconds").alias("seconds"))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield part.assign(seconds=[tools.seconds_of(p) for p in part["clip_path"]]).astype({"seconds": "float64"})

    asked = clips.where(F.col("duration_seconds").isNull()).select("item_id", "clip_path").repartition(workers).mapInPandas(run, "item_id string, clip_path string, seconds double")
    return stated.unionByName(asked.withColumn("seconds", F.when(~F.isnan("seconds"), F.col("seconds"))))


def _extract(path: str, folder: Path, offsets: Sequence[float] | None, seeks: Sequence[Sequence[dict]] | None, how: Frames, tools: Tools) -> str | None:
    """The frames of one clip as files; what went wrong, or none."""
    if not Path(path).is_file():
        return f"clip not found: {path}"
    if offsets is None or seeks is None:
        return "the clip's duration can't be read"
    folder.mkdir(parents=True, exist_ok=True)
    for i, (offset, tries) in enumerate(zip(offsets, seeks)):
        said: str | None = "no message"
        for seek in tries:
            where = ["-sseof", f"-{seek['seconds']:.3f}"] if seek["mode"] == "from_end" else ["-ss", f"{seek['seconds']:.3f}"]
            try:
                said = tools.take(path, where, how.resize, how.jpeg_quality, folder / f"frame_{i:02d}.jpg", how.timeout_seconds)
            except subprocess.TimeoutExpired:
                return f"timed out at {offset:.2f} s"
            except OSError as e:
                return f"{tools.grab[0]} can't be run: {e.strerror or e}"
            if said is None:
                break
        if said is not None:
            return f"no frame near {offset:.2f} s: {said}"
    return None


def extracted(clips: DataFrame, cache_dir: str, how: Frames, force: bool = False, tools: Tools | None = None) -> DataFrame:
    """``(item_id, paths, reused, error)`` of clips ``(item_id, clip_path, duration_seconds)``.

    Each clip's frames lie in a folder of their own under ``cache_dir``; if all of them are
    there and aren't empty they are taken as they are, unless ``force``. A clip without a
    duration is probed.
    """
    tools, top = tools or Tools(), Path(cache_dir) / "frames"
    n = sampling.frames_for(F.col("seconds"), [(b.max_seconds, b.count) for b in how.duration_buckets], how.count)
    counted = probed(clips, tools, how.workers).withColumn("n", n)
    placed = counted.withColumn("offsets", F.when(F.col("seconds").isNotNull(), sampling.sample_offsets(F.col("seconds"), F.col("n"))))
    last = lambda i: (i == F.col("n") - 1) & (F.col("n") > 1)
    seeks = F.transform("offsets", lambda o, i: sampling.seek_ladder(F.col("seconds"), o, last(i)))
    planned = placed.select("item_id", "clip_path", sampling.safe_id(F.col("item_id")).alias("folder"), "n", "offsets", F.to_json(seeks).alias("seeks"))  # JSON, as lists of several lengths can't pass otherwise

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for item, path, folder, n, offsets, seeks in part.itertuples(index=False):
                paths = [top / folder / f"frame_{i:02d}.jpg" for i in range(n)]
                reused = not force and all(map(_filled, paths))
                error = None if reused else _extract(path, top / folder, offsets, seeks and json.loads(seeks), how, tools)
                out.append((item, [] if error else list(map(str, paths)), reused, error))
            yield pd.DataFrame(out, columns=["item_id", "paths", "reused", "error"])

    return planned.repartition(how.workers).mapInPandas(run, SCHEMA)


def usable(frames: DataFrame) -> DataFrame:
    """The clips that have frames."""
    return frames.where(F.col("error").isNull() & (F.size("paths") > 0))


def encoded(contents: Column) -> Column:
    """``data:`` URLs of an array of image files' contents, in base64, as a model that judges pairs takes them."""
    return F.transform(contents, lambda x: F.concat(F.lit("data:image/jpeg;base64,"), F.translate(F.base64(x), "\r\n", "")))  # without line ends


def thumbnails(clusters: DataFrame, frames: DataFrame, folder: str) -> DataFrame:
    """``(cluster_id, path)``: the middle frame of each cluster's first member, copied to ``folder``.

    ``clusters`` holds ``(cluster_id, first_member)``. A cluster whose member has no frames,
    or whose copy fails, is left out.
    """
    middle = sampling.representative(F.col("paths"), 1)
    rows = clusters.select("cluster_id", F.col("first_member").alias("item_id")).join(usable(frames), "item_id").select("cluster_id", F.element_at(middle, 1).alias("source"))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        Path(folder).mkdir(parents=True, exist_ok=True)
        for part in parts:
            out = []
            for number, source in part.itertuples(index=False):
                to = Path(folder) / f"cluster_{number:04d}.jpg"
                try:
                    shutil.copyfile(source, to)
                except OSError:
                    continue
                out.append((number, f"{Path(folder).name}/{to.name}"))
            yield pd.DataFrame(out, columns=["cluster_id", "path"]).astype({"cluster_id": "int32"})

    return rows.mapInPandas(run, "cluster_id int, path string")
