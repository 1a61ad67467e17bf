"""Whole runs, with commands of this test in place of those that read media."""

import csv
import json
import logging
import stat
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from sieveline import cli, config, environment
from sieveline.plans import delivery
from sieveline.sources import embedding, frames

HEAD = ["item_id", "session_id", "parent_video_id", "worker_id", "timestamp", "clip_path", "duration_seconds"]
PROBE = """import json, sys
seconds = open(sys.argv[-1]).read().split()[0]
print(json.dumps({"format": {"duration": seconds}})) if seconds != "bad" else sys.exit(1)
"""
GRAB = """import sys
a = sys.argv
seek, clip, out = a[a.index("-i") - 2 : a.index("-i")], a[a.index("-i") + 1], a[-1]
words = open(clip).read().split()
if words[1] == "dark" or (words[1] == "short" and seek[0] == "-sseof" and seek[1] != "-1.000"):
    sys.exit("first line\\ncan't decode")
open(out, "w").write(words[1] + ("" if words[1] == "same" else out.split("/")[-2] + seek[1]))
"""


@pytest.fixture
def tools(tmp_path):
    made = []
    for name, text in (("probe.py", PROBE), ("grab.py", GRAB)):
        at = tmp_path / name
        at.write_text(text)
        at.chmod(at.stat().st_mode | stat.S_IXUSR)
        made.append((sys.executable, str(at)))
    return frames.Tools(*made)


@pytest.fixture
def folder(tmp_path):
    """Nine clips: three with the same pictures, three others, one that can't be decoded, one without a length, one file that is not there."""
    media = {"s1": "8 same", "s2": "8 same", "s3": "8 same", "u1": "9 one", "u2": "9 two", "u3": "4 short", "x1": "5 dark", "x2": "bad one"}
    rows = []
    for i, (name, text) in enumerate(media.items()):
        (tmp_path / f"{name}.mp4").write_text(text)
        rows.append([name, "ses1" if i < 3 else "ses2", "p", "wa" if i < 3 else "wb", "2030-01-01", f"{name}.mp4", "8" if i % 2 == 0 and name != "x2" else ""])
    rows += [["gone", "ses2", "p", "wb", "2030-01-01", "gone.mp4", "3"], ["s1", "ses2", "p", "wb", "2030-01-01", "s1.mp4", "3"]]
    with open(tmp_path / "m.csv", "w", newline="") as f:
        csv.writer(f).writerows([HEAD, *rows])
    return tmp_path


def made(folder, **more):
    given = {"output_dir": str(folder / "out"), "cache_dir": str(folder / "cache"), "frames": {"count": 3, "workers": 2}, "embeddings": {"backend": "stub"}, "clustering": {"similarity_threshold": 0.91}}
    return config.build(config.Config, given | more)


def outside(folder):
    return environment.Environment(environment.Storage(), environment.Judge(), input_dir=str(folder))


def test_a_whole_run(spark, folder, tools):
    done = delivery.run(spark, str(folder / "m.csv"), made(folder), outside(folder), tools=tools)
    said = json.loads((folder / "out" / "report.json").read_text())
    assert (done.ingested, done.rejected, done.scored, done.duplicate_clusters, done.clipped_clips) == (8, 2, 6, 1, 3)
    assert list(done.seconds) == ["ingest", "frames", "embeddings", "pooling", "search", "clustering", "scoring", "report"] and list(said["timings_seconds"]) == list(done.seconds)[:-1]
    (only,) = said["duplicate_clusters"]
    assert only["members"] == ["s1", "s2", "s3"] and only["flagged"] and only["max_similarity"] == 1.0 and only["thumbnail"] == "thumbnails/cluster_0000.jpg"
    assert (folder / "out" / "thumbnails" / "cluster_0000.jpg").read_text() == "same"
    assert said["clips_flagged_for_removal"] == ["s2", "s3"] and said["summary"]["manifest_rows"] == 10 and said["config"]["embedding_backend"] == "stub"
    assert [s["item_id"] for s in said["clip_scores"]][:3] == ["s1", "s2", "s3"] and len(said["clip_scores"]) == 6 and said["clip_scores"][0]["cluster_id"] == 0
    assert said["redundancy_by_worker"][0] == {"key": "wa", "clips": 3, "clustered_clips": 3, "mean_novelty": 0.0, "redundancy_rate": 1.0, "share_of_delivery_redundancy": 1.0}
    assert [r["reason"].split(":")[0].split(" (")[0] for r in said["rejected_clips"]] == ["clip_path not found", "duplicate item_id"]
    penalty = 3**1.5 / 6
    assert said["summary"]["cluster_penalty"] == pytest.approx(penalty, abs=1e-6) and said["borderline_review"] == {"enabled": False}
    told = (folder / "out" / "report.md").read_text()
    assert "s1, s2, s3" in told and "gone" in told and "## Seconds by stage" in told and "| wa | 3 | 3 | 100% | 100% |" in told
    assert (folder / "out" / "rejected_clips.csv").read_text().splitlines()[0] == "row_number,item_id,reason"


def test_frames_are_kept_and_told_of(spark, folder, tools):
    clips = spark.createDataFrame([(n, str(folder / f"{n}.mp4"), d) for n, d in (("s1", 8.0), ("u3", None), ("x1", 5.0), ("x2", None), ("gone", 3.0))], "item_id string, clip_path string, duration_seconds double")
    how = config.Frames(count=3, workers=2, duration_buckets=(config.Bucket(4.0, 2),))
    first = {r["item_id"]: r for r in frames.extracted(clips, str(folder / "cache"), how, tools=tools).collect()}
    assert [len(first[n]["paths"]) for n in ("s1", "u3", "x1", "x2", "gone")] == [3, 2, 0, 0, 0] and not any(r["reused"] for r in first.values())
    assert "can't decode" in first["x1"]["error"] and "duration" in first["x2"]["error"] and "not found" in first["gone"]["error"]
    assert open(first["u3"]["paths"][1]).read() == "shortu3-1.000"  # the last frame, from the end, at the fourth try
    again = {r["item_id"]: r for r in frames.extracted(clips, str(folder / "cache"), how, tools=tools).collect()}
    assert {n: r["reused"] for n, r in again.items()} == {"s1": True, "u3": True, "x1": False, "x2": False, "gone": False}
    assert not frames.extracted(clips, str(folder / "cache"), how, force=True, tools=tools).where("reused").count()
    lost = frames.Tools(("nowhere-probe",), ("nowhere-grab",))
    with pytest.raises(RuntimeError, match="nowhere-probe"):
        lost.required()
    assert lost.seconds_of("x") is None and "can't be run" in frames.extracted(clips.where("item_id = 's1'"), str(folder / "other"), how, tools=lost).first()["error"]
    slow = frames.Tools(tools.probe, (sys.executable, "-c", "import time; time.sleep(30)"))
    assert "timed out" in frames.extracted(clips.where("item_id = 's1'"), str(folder / "other"), config.Frames(timeout_seconds=0.5), tools=slow).first()["error"]


def test_vectors_are_kept_by_embedder(spark, tmp_path):
    class Counting:
        name, dim = "counting", 2

        def embed(self, paths):
            if "bad" in paths[0]:
                raise ValueError("unreadable")
            return np.ones((len(paths) + ("odd" in paths[0]), 2)) * len(paths[0])

    rows = spark.createDataFrame([("a", ["p1", "p2"]), ("b", ["bad"]), ("c", ["odd"])], "item_id string, paths array<string>")
    got = {(r["item_id"], r["frame_index"]): (r["embedding"], r["error"]) for r in embedding.embedded(rows, Counting(), str(tmp_path)).collect()}
    assert got[("a", 0)] == ([2.0, 2.0], None) and got[("b", None)][1] == "unreadable" and "for 1 frames" in got[("c", None)][1]
    kept = f"{tmp_path}/embeddings/embedder=counting"
    assert spark.read.parquet(kept).count() == 2
    changed = spark.createDataFrame([("a", ["longer1", "longer2"]), ("d", ["p"])], "item_id string, paths array<string>")
    assert {r["embedding"][0] for r in embedding.embedded(changed, Counting(), str(tmp_path)).where("item_id = 'a'").collect()} == {2.0}  # as many frames: the kept ones
    assert {r["embedding"][0] for r in embedding.embedded(changed, Counting(), str(tmp_path), force=True).where("item_id = 'a'").collect()} == {7.0}
    more = spark.createDataFrame([("a", ["p1", "p2", "p3"])], "item_id string, paths array<string>")
    assert embedding.embedded(more, Counting(), str(tmp_path)).count() == 3 and spark.read.parquet(kept).groupBy("item_id").count().count() == 2


def test_embedders_are_chosen(caplog):
    stub, none = embedding.chosen(config.Embeddings(backend="stub"))
    assert stub.name == "stub" and none is None
    primary, aside = embedding.chosen(config.Embeddings(secondary_clip=config.Secondary(True)))
    assert primary.name == "dinov2-facebook_dinov2-base" and aside.name == "clip-openai_clip-vit-large-patch14"
    driver, none = embedding.chosen(config.Embeddings(driver="secondary", secondary_clip=config.Secondary(True)))
    assert driver.name.startswith("clip-") and none is None

    class Torch:
        class cuda:
            is_available = staticmethod(lambda: True)

    assert embedding.device_of("auto", Torch) == "cuda" and embedding.device_of("cpu", Torch) == "cpu"
    with caplog.at_level(logging.WARNING):
        assert embedding.device_of("cuda") == "cpu" and "CUDA" in caplog.text


def test_the_stub_is_the_same_in_sql(spark, tmp_path):
    (tmp_path / "f").write_bytes(b"some bytes")
    table = spark.createDataFrame([("a", bytearray(b"some bytes")), ("b", bytearray(b"missing"))], "item_id string, payload binary")
    want = {r["item_id"]: r["vec"] for r in embedding.stub_vectors(table).collect()}
    got = embedding.Stub().embed([str(tmp_path / "f"), str(tmp_path / "missing")])
    assert np.allclose(got, [want["a"], want["b"]], atol=1e-6)


def test_review_merges_and_never_ends_a_run(spark, folder, tools):
    how = made(folder, clustering={"similarity_threshold": 0.999}, borderline_review={"enabled": True, "gray_zone": [0.0, 0.999], "max_pairs": 1000, "max_retries": 0})
    said = delivery.run(spark, str(folder / "m.csv"), how, outside(folder), tools=tools, judge=lambda a, b, x, y: '{"verdict": "REDUNDANT", "confidence": 1}')
    assert said.review["merged"] == said.review["considered"] > 0 and said.review["errors"] == 0 and said.clipped_clips > 3
    assert "## Review" in (folder / "out" / "report.md").read_text()
    novelty = {s["item_id"]: s["novelty"] for s in json.loads((folder / "out" / "report.json").read_text())["clip_scores"]}
    plain = delivery.run(spark, str(folder / "m.csv"), made(folder, clustering={"similarity_threshold": 0.999}), outside(folder), tools=tools)
    assert plain.clipped_clips == 3 and novelty == {s["item_id"]: s["novelty"] for s in json.loads((folder / "out" / "report.json").read_text())["clip_scores"]}
    vectors = spark.createDataFrame([(n, 0, [1.0, float(i)]) for i, n in enumerate(("s1", "s2"))], "item_id string, frame_index int, embedding array<double>")
    failed = delivery.run(spark, str(folder / "m.csv"), how, outside(folder), vectors=vectors, judge=lambda *x: "")
    assert "no frames" in failed.review["error"] and failed.scored == 2
    with pytest.raises(RuntimeError, match="OPENAI_API_KEY"):
        delivery.run(spark, str(folder / "m.csv"), how, outside(folder), vectors=vectors)


@pytest.mark.parametrize("what", ["rows", "frames", "vectors"])
def test_nothing_to_score_is_reported(spark, folder, tools, what):
    lines = (folder / "m.csv").read_text().splitlines()
    keep = {"rows": lines[:1] + lines[9:10], "frames": [lines[0], *(x for x in lines if x.startswith("x"))], "vectors": lines[:3]}[what]
    (folder / "n.csv").write_text("\n".join(keep) + "\n")
    vectors = spark.createDataFrame([], "item_id string, frame_index int, embedding array<float>") if what == "vectors" else None
    done = delivery.run(spark, str(folder / "n.csv"), made(folder), outside(folder), vectors=vectors, tools=tools)
    said = json.loads((folder / "out" / "report.json").read_text())
    assert (done.scored, done.score) == (0, 0.0) and said["summary"]["clips_scored"] == 0 and said["clip_scores"] == [] and said["duplicate_clusters"] == []
    assert "Nothing could be scored" in (folder / "out" / "report.md").read_text()


def test_exit_codes(spark, folder, tools, monkeypatch, capsys):
    monkeypatch.chdir(folder)
    monkeypatch.setenv("SIEVELINE_INPUT_DIR", str(folder))
    (folder / "c.yaml").write_text("output_dir: out\nfloor: 1\n")
    assert cli.main(["--manifest", "m.csv", "--config", "c.yaml"]) == 2 and "floor" in capsys.readouterr().err
    (folder / "c.yaml").write_text("output_dir: out\ncache_dir: cache\nframes: {count: 2, workers: 2}\nembeddings: {backend: stub}\n")
    assert cli.main(["--config", "c.yaml"]) == 2 and "no manifest" in capsys.readouterr().err
    assert cli.main(["--manifest", "none.csv", "--config", "c.yaml"]) == 2 and "not found" in capsys.readouterr().err
    assert cli.main(["--manifest", str(folder / "m.csv"), "--config", "c.yaml"], tools=frames.Tools(("nowhere-probe",), ("nowhere-grab",))) == 2
    assert cli.main(["--manifest", str(folder / "m.csv"), "--config", "c.yaml", "--output-dir", str(folder / "o2")], tools=tools) == 0
    assert "scored: 6" in capsys.readouterr().out and (folder / "o2" / "report.json").is_file()
    (folder / "n.csv").write_text(",".join(HEAD) + "\n")
    assert cli.main(["--manifest", str(folder / "n.csv"), "--config", "c.yaml"], tools=tools) == 1
    with pytest.raises(ZeroDivisionError):  # a fault of the program itself isn't hidden
        monkeypatch.setattr(delivery, "run", lambda *a, **k: 1 / 0)
        cli.main(["--manifest", str(folder / "m.csv"), "--config", "c.yaml"])


def test_long_tables_are_cut_in_markdown_alone(spark, folder):
    n = 120
    with open(folder / "big.csv", "w", newline="") as f:
        csv.writer(f).writerows([HEAD, *([f"c{i:03d}", f"s{i // 3}", "p", f"w{i // 3}", "5", "x.mp4", ""] for i in range(n)), *(["", "s", "p", "w", "5", "x", ""] for _ in range(30))])
    rng = np.random.default_rng(8)
    base = rng.standard_normal((n // 3, 16))
    vectors = spark.createDataFrame([(f"c{i:03d}", 0, base[i // 3].tolist()) for i in range(n)], "item_id string, frame_index int, embedding array<double>")
    done = delivery.run(spark, str(folder / "big.csv"), made(folder), outside(folder), vectors=vectors)
    said, told = json.loads((folder / "out" / "report.json").read_text()), (folder / "out" / "report.md").read_text()
    assert done.duplicate_clusters == len(said["duplicate_clusters"]) == 40 and len(said["clips_flagged_for_removal"]) == 80 and len(said["rejected_clips"]) == 30
    assert told.count("Showing 25 of 40") == 3 and "Showing 50 of 80" in told and "Showing 25 of 30" in told
    assert [c["cluster_id"] for c in said["duplicate_clusters"]] == list(range(40)) and all(len(c["members"]) == 3 for c in said["duplicate_clusters"])
    mixed = vectors.unionByName(spark.createDataFrame([("c000", 1, [1.0])], vectors.schema)).where("item_id <> 'c000' or frame_index = 1")
    with pytest.raises(RuntimeError, match="dimensions"):
        delivery.run(spark, str(folder / "big.csv"), made(folder), outside(folder), vectors=mixed.withColumn("embedding", F.col("embedding")))
