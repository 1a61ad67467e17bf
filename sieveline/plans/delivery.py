"""A delivery scored from end to end: vectors to scores, and a whole run from a manifest to its reports."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field, replace
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.config import Config
from sieveline.environment import Environment
from sieveline.operators import clusters as cl
from sieveline.operators import knn, pooling, review, scoring
from sieveline.operators.search import Exact, Index, index_for
from sieveline.plans import report
from sieveline.sources import embedding, manifest
from sieveline.sources import frames as media
from sieveline.sources.judge import ChatJudge
from sieveline.storage import cut

log = logging.getLogger(__name__)

JudgeFn = Callable[[str, str, list[str], list[str]], str]


@dataclass(frozen=True)
class Delivery:
    """What each stage made; ``edges`` and ``assigned`` follow any forced merges, ``neighbors`` never does."""

    clips: DataFrame
    neighbors: DataFrame
    pairs: DataFrame
    edges: DataFrame
    assigned: DataFrame
    scores: DataFrame


def clustered(found: Delivery, threshold: float, merged: DataFrame | None = None) -> Delivery:
    """``found`` with its clusters and scores made from its pairs; ``merged`` pairs ``(a, b)`` are forced together."""
    pairs = found.pairs if merged is None else cl.force(found.pairs, merged, threshold)
    edges = cut(cl.edges(pairs, threshold))
    assigned = cut(cl.assignment(found.clips, edges))
    scores = scoring.clip_scores(knn.nearest_neighbor(found.clips, found.neighbors), assigned)
    return replace(found, edges=edges, assigned=assigned, scores=scores)


def searched(clips: DataFrame, k: int = 10, index: Index | None = None) -> Delivery:
    """``clips`` ``(item_id, vec)`` with their neighbours, every clip a cluster of its own."""
    clips = cut(clips)
    neighbors = cut((index or Exact()).neighbors(clips, k))
    alone = clips.select("item_id", F.col("item_id").alias("component"), F.lit(1).cast("long").alias("size"))
    pairs = cl.unique_pairs(neighbors)
    return Delivery(clips, neighbors, pairs, pairs.limit(0), alone, scoring.clip_scores(knn.nearest_neighbor(clips, neighbors), alone))


def score(clips: DataFrame, threshold: float = 0.91, k: int = 10, merged: DataFrame | None = None, index: Index | None = None) -> Delivery:
    """``clips`` ``(item_id, vec)`` searched, clustered and scored; ``merged`` pairs ``(a, b)`` are forced together."""
    return clustered(searched(clips, k, index), threshold, merged)


@dataclass
class Run:
    """What a run did: counts, the score, seconds of each stage, and the files that it wrote."""

    ingested: int = 0
    rejected: int = 0
    scored: int = 0
    score: float = 0.0
    max_points: float = 0.0
    duplicate_clusters: int = 0
    clipped_clips: int = 0
    review: dict = field(default_factory=lambda: {"enabled": False})
    seconds: dict[str, float] = field(default_factory=dict)
    files: dict[str, str] = field(default_factory=dict)

    @contextmanager
    def stage(self, name: str) -> Iterator[None]:
        log.info("%s", name)
        began = time.perf_counter()
        try:
            yield
        finally:
            self.seconds[name] = round(time.perf_counter() - began, 3)
            log.info("%s: %.2f s", name, self.seconds[name])


def reviewed(found: Delivery, frames: DataFrame, how: Config, judge: JudgeFn) -> tuple[dict, DataFrame]:
    """The counters and verdicts of the review of the pairs below the threshold, and the pairs to be merged."""
    r = how.borderline_review
    zone = cut(review.gray_zone(found.pairs, *r.gray_zone))
    chosen = cut(review.stratified(zone, r.max_pairs, how.random_seed))
    told = cut(review.judged(chosen, frames, judge, r.frames_per_clip, r.max_retries))
    verdicts = cut(review.verdicts(told))
    counts = review.counters(zone.count(), chosen.count(), told, verdicts).first().asDict()
    # At most as many rows as the settings let a judge see.
    rows = [{"item_a": v["a"], "item_b": v["b"], "similarity": round(v["similarity"], 4), "verdict": v["verdict"], "confidence": round(v["confidence"], 3), "reason": v["reason"]} for v in review.ordered(verdicts).collect()]
    return {"enabled": True, **counts, "verdicts": rows}, review.merged(verdicts)


def _vectors_of(clips: DataFrame, how: Config, force: bool, tools: media.Tools | None, run: Run) -> tuple[DataFrame, DataFrame]:
    """Frames of the clips that have any, and their vectors ``(item_id, frame_index, embedding)``."""
    with run.stage("frames"):
        frames = cut(media.usable(media.extracted(clips, how.cache_dir, how.frames, force, (tools or media.Tools()).required())))
    with run.stage("embeddings"):
        driver, aside = embedding.chosen(how.embeddings)
        rows = embedding.embedded(frames, driver, how.cache_dir, force)
        if aside is not None:
            embedding.embedded(frames, aside, how.cache_dir, force)
    return frames, rows.where("error is null").drop("error")


def run(
    spark: SparkSession, manifest_path: str, how: Config, outside: Environment | None = None, vectors: DataFrame | None = None, force: bool = False, judge: JudgeFn | None = None, tools: media.Tools | None = None
) -> Run:
    """A manifest to its reports in ``how.output_dir``.

    ``vectors`` ``(item_id, frame_index, embedding)`` take the place of extraction and
    embedding. A delivery of which nothing can be scored gets a report with score zero. A
    review that fails leaves the clusters as they were, and says so in the report.
    """
    out, done = Path(how.output_dir), Run(max_points=how.scoring.max_points)
    out.mkdir(parents=True, exist_ok=True)
    if how.borderline_review.enabled and judge is None:
        if outside is None:
            raise RuntimeError("the review needs a judge")
        judge = ChatJudge(outside.judge.required(), how.borderline_review.model, how.borderline_review.max_output_tokens)
    for note in how.notes():
        log.info("no effect: %s", note)

    with done.stage("ingest"):
        rows = manifest.read(spark, manifest_path)
        dealt = cut(manifest.classified(rows, outside.input_dir if outside else None, manifest.files_of(rows, outside.input_dir if outside else None) if vectors is None else None))
        clips, rejected = manifest.clips(dealt), manifest.rejected(dealt)
        done.ingested, done.rejected = clips.count(), rejected.count()

    frames = found = None
    if done.ingested:
        if vectors is None:
            frames, vectors = _vectors_of(clips, how, force, tools, done)
        with done.stage("pooling"):
            own = pooling.uniform(cut(pooling.pool(vectors.join(clips.select("item_id"), "item_id", "left_semi"), how.pooling.mode)))
        if not own.isEmpty():
            with done.stage("search"):
                found = searched(own, how.search.top_k, index_for(how.search, how.random_seed))
            with done.stage("clustering"):
                found = clustered(found, how.clustering.similarity_threshold)
            if how.borderline_review.enabled:
                with done.stage("review"):
                    done.review, found = _corrected(found, frames, how, judge)

    with done.stage("scoring"):
        said = report.assembled(spark, found, clips, rejected, how, frames, str(out / "thumbnails") if how.report.thumbnails else None)
    with done.stage("report"):
        done.files = report.written(said, str(out), done.review, done.seconds)
    s = said.summary
    done.score, done.scored, done.duplicate_clusters, done.clipped_clips = s["score"], s["clips_scored"], s["duplicate_clusters"], s["clips_in_duplicate_clusters"]
    return done


def _corrected(found: Delivery, frames: DataFrame | None, how: Config, judge: JudgeFn | None) -> tuple[dict, Delivery]:
    try:
        if frames is None or judge is None:
            raise RuntimeError("there are no frames to review")
        said, merged = reviewed(found, frames, how, judge)
        return said, clustered(found, how.clustering.similarity_threshold, merged) if said["merged"] else found
    except Exception as e:  # noqa: BLE001  the review advises, and never ends a run
        log.error("the review failed, so the clusters stay as they were: %s", e)
        return {"enabled": True, "error": str(e)}, found
