"""``sieveline``: a manifest to a report of how diverse its delivery is.

Exit 0: scored. 1: nothing could be scored. 2: the configuration, the manifest or what the
run needs is missing or wrong.
"""

from __future__ import annotations

import argparse
import logging
import os
import sys
from dataclasses import replace

from pyspark.sql import SparkSession

from sieveline import config
from sieveline.environment import Environment
from sieveline.plans import delivery
from sieveline.shipping import ship

SCORED, NOTHING, USAGE = 0, 1, 2


def _fail(e: object) -> int:
    print(f"error: {e}", file=sys.stderr)
    return USAGE


def settled(path: str | None, output_dir: str | None, outside: Environment) -> config.Config:
    """The configuration, with folders from the arguments first, then from the environment, then its own."""
    how = config.load(path)
    folders = {"output_dir": output_dir or outside.output_dir, "cache_dir": outside.cache_dir}
    return replace(how, **{k: os.path.abspath(os.path.expanduser(v)) for k, v in folders.items() if v})


def main(args: list[str] | None = None, **parts) -> int:  # noqa: ANN003
    """``parts`` go to the run: a judge, or the commands that take frames."""
    p = argparse.ArgumentParser(prog="sieveline", description=__doc__)
    p.add_argument("--manifest", help="CSV, JSON or JSON lines; else what the environment names")
    p.add_argument("--config", help="YAML")
    p.add_argument("--output-dir")
    p.add_argument("--vectors", help="Parquet of item_id, frame_index, embedding, in place of extraction and embedding")
    p.add_argument("--force", action="store_true", help="extract and embed anew")
    p.add_argument("--log-level", choices=["DEBUG", "INFO", "WARNING", "ERROR"])
    a = p.parse_args(args)
    try:
        outside = Environment.load()
        how = settled(a.config, a.output_dir, outside)
    except Exception as e:  # noqa: BLE001  whatever is wrong with the settings
        return _fail(e)
    logging.basicConfig(level=a.log_level or how.log_level, format="%(levelname)s %(message)s")
    path = a.manifest or outside.manifest
    if path is None:
        return _fail("no manifest: pass --manifest or set SIEVELINE_MANIFEST")
    builder = SparkSession.builder.appName("sieveline")
    if outside.storage.family and not outside.storage.missing():
        for k, v in outside.storage.hadoop().items():
            builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ship(spark)
    try:
        vectors = spark.read.parquet(a.vectors) if a.vectors else None
        done = delivery.run(spark, path, how, outside, vectors, a.force, **parts)
    except (FileNotFoundError, RuntimeError) as e:
        return _fail(e)
    print(f"score {done.score:.2f} of {done.max_points:.0f}")
    for name in ("ingested", "rejected", "scored", "duplicate_clusters", "clipped_clips"):
        print(f"{name}: {getattr(done, name)}")
    for name, file in done.files.items():
        print(f"{name}: {file}")
    if not done.scored:
        print("warning: nothing could be scored", file=sys.stderr)
        return NOTHING
    return SCORED


if __name__ == "__main__":
    sys.exit(main())
