import csv
import json
import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from sieveline import config, environment
from sieveline.operators import clusters, knn, pooling, review, scoring
from sieveline.operators.components import connected_components
from sieveline.operators.numbering import numbered
from sieveline.operators.search import Cells, Exact, index_for
from sieveline.plans import delivery, queries, report
from sieveline.sources import manifest
from sieveline.sources.judge import ChatJudge
from sieveline.streaming import manifests

HEAD = "item_id,session_id,parent_video_id,worker_id,timestamp,clip_path,duration_seconds"


def unit(*xs):
    n = sum(x * x for x in xs) ** 0.5
    return [x / n for x in xs]


@pytest.fixture
def clips(spark):
    rows = [("a", unit(1, 0, 0.0)), ("b", unit(1, 0, 0.0)), ("c", unit(1, 0.1, 0.0)), ("d", unit(0, 1, 0.0)), ("e", unit(0, 0, 1.0))]
    return spark.createDataFrame(rows, "item_id string, vec array<double>")


def test_components_match_union_find(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 480)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    alone = {a for a, b in edges if a == b}
    assert all(got.get(x, x) == find(x) for x in parent) and set(parent) - set(got) <= alone


def test_components_of_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_scores_in_closed_form(spark, clips):
    d = delivery.score(clips, 0.91)
    row = scoring.summary(d.scores, d.assigned).first()
    assert row["cluster_penalty"] == pytest.approx(3**1.5 / 5)
    assert (row["duplicate_clusters"], row["clipped_clips"], row["total_clips"]) == (1, 3, 5)
    assert [r["item_id"] for r in clusters.flagged(d.assigned).orderBy("item_id").collect()] == ["b", "c"]
    people = clips.select("item_id", F.lit("w").alias("worker_id"), F.lit("s").alias("session_id"))
    said = report.assembled(spark, d, people, spark.createDataFrame([], "row_number long, item_id string, reason string"), config.Config())
    assert said.tables["redundancy_by_worker"].first()["share"] == 1.0 and said.summary["flagged_for_removal"] == 2


def test_empty_delivery_scores_zero(spark):
    d = delivery.score(spark.createDataFrame([], "item_id string, vec array<double>"))
    assert scoring.summary(d.scores, d.assigned).first()["score"] == 0


def test_blocks_don_t_change_neighbours(spark, clips):
    key = lambda df: sorted((r["item_id"], r["rank"], r["neighbor_id"]) for r in df.collect())
    assert key(knn.exact(clips, 3)) == key(knn.exact(clips, 3, block=2))
    assert key(knn.probe(clips, 3, cells=1)) == key(knn.exact(clips, 3)) == key(knn.probe(clips, 3, chunk=2))
    assert knn.blocks_for(0, 8) == 1 and knn.blocks_for(100_000, 8) == 13 and knn.blocks_for(5000, 8) == 6
    assert knn.exact(clips.limit(0)).count() == 0 and knn.probe(clips.limit(0)).count() == 0 and knn.exact(clips.limit(1)).count() == 0


def test_copies_of_a_vector_are_compared_up_to_the_first_ids(spark):
    """a vector that much of a table has was compared with all its copies."""
    rng = np.random.default_rng(6)
    vecs = rng.standard_normal((900, 6))
    for share in (0.5, 0.2):
        vecs[rng.random(900) < share] = rng.standard_normal(6)
    vecs /= np.linalg.norm(vecs, axis=1, keepdims=True)
    ids = [f"c{i:04d}" for i in rng.permutation(900)]
    table = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, vecs)], "item_id string, vec array<double>")
    dealt = table.select(F.lit(0).alias("block"), F.lit(0).alias("cell"), "item_id", "vec", F.array(F.lit(0)).alias("near"))
    assert knn._packed(dealt, 1, 5).first()["told"] == len(np.unique(vecs, axis=0)) + 2 * 5
    found = knn._findable(np.array(["b", "a", "a", "c", "d"], dtype=object), np.ones((5, 2)), 1)
    assert found.tolist() == [True, True, True, False, False]
    s = np.round(vecs @ vecs.T, 12)
    best = {i: [ids[y] for y in sorted((y for y in range(900) if y != x), key=lambda y: (-s[x, y], ids[y]))[:5]] for x, i in enumerate(ids)}
    for got in (knn.exact(table, 5), knn.exact(table, 5, block=97), knn.probe(table, 5, cells=4, probes=4, chunk=100)):
        rows = {}
        for r in got.orderBy("item_id", "rank").collect():
            rows.setdefault(r["item_id"], []).append(r["neighbor_id"])
        assert rows == best


def test_cells_find_most_neighbours(spark):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((40, 24))
    vecs = centres[rng.integers(0, 40, 3000)] + 0.5 * rng.standard_normal((3000, 24))
    vecs /= np.linalg.norm(vecs, axis=1, keepdims=True)
    table = spark.createDataFrame([(f"c{i:04d}", v.tolist()) for i, v in enumerate(vecs)], "item_id string, vec array<double>")
    truth = knn.exact(table, 10)
    assert knn.recall(Cells(nlist=50, nprobe=8).neighbors(table, 10), truth) > 0.95 and knn.recall(Cells(nlist=50, nprobe=50).neighbors(table, 10), truth) == 1.0
    assert isinstance(index_for(config.Search(index_type="ivf", nlist=7)), Cells) and isinstance(index_for(config.Search(index_type="hnsw")), Exact)


def test_forced_pair_becomes_an_edge(spark, clips):
    merged = spark.createDataFrame([("e", "d")], "a string, b string")
    d = delivery.score(clips, 0.91, merged=merged)
    assert {r["item_id"]: r["component"] for r in d.assigned.collect()}["e"] == "d"


def test_pooling(spark):
    f = spark.createDataFrame([("a", 0, [3.0, 4.0]), ("a", 1, [3.0, -4.0]), ("z", 0, [0.0, 0.0])], "item_id string, frame_index int, embedding array<float>")
    got = {r["item_id"]: r["vec"] for r in pooling.pool(f).collect()}
    assert got == {"a": [1.0, 0.0], "z": [0.0, 0.0]}
    assert {r["item_id"]: r["vec"] for r in pooling.pool(f, "none").collect()}["a"] == pytest.approx([0.6, 0.8])
    with pytest.raises(ValueError):
        pooling.pool(f, "maxpair")


def test_manifest(spark, tmp_path):
    rows = ["a,s,v,w,2031-02-03T04:05:06Z,x.mp4,12.5", "a,s,v,w,2031-02-03,y.mp4,", "b,,v,w,1923456789.25,/abs.mp4,", "c,s,v,w,next week,x.mp4,-3", "c,s,v,w,2026-W31-6,x.mp4,", "d,s,v,w,nan,x.mp4,1_0", 'e,s,v,w,1d,"x"".mp4",', ",s,v,w,5,x.mp4,", ",s,v,w,5,x.mp4,"]
    (tmp_path / "m.csv").write_text("\ufeff" + "\n".join([HEAD, *rows]) + "\n", encoding="utf-8")
    dealt = manifest.classified(manifest.read(spark, str(tmp_path / "m.csv")), "/in")
    got = {r["row_number"]: r for r in dealt.collect()}
    assert [n for n in sorted(got) if got[n]["reason"] is None] == [1, 5, 6]
    assert got[2]["reason"] == "duplicate item_id (first seen at row 1)" and got[3]["reason"].endswith("session_id")
    assert "timestamp" in got[4]["reason"] and "duration" in got[4]["reason"] and "timestamp" in got[7]["reason"]
    assert got[1]["clip_path"] == "/in/x.mp4" and got[3]["clip_path"] == "/abs.mp4" and got[6]["duration_seconds"] == 10.0
    assert got[8]["reason"] == got[9]["reason"] == "missing required field(s): item_id"
    with pytest.raises(ValueError):
        manifest.read(spark, "m.txt")
    with pytest.raises(FileNotFoundError):
        manifest.read(spark, str(tmp_path / "none.csv"))


def test_media_that_is_not_there(spark, tmp_path):
    (tmp_path / "x.mp4").write_bytes(b"x")
    (tmp_path / "m.csv").write_text("\n".join([HEAD, "a,s,v,w,5,x.mp4,", "b,s,v,w,5,y.mp4,"]))
    rows = manifest.read(spark, str(tmp_path / "m.csv"))
    got = {r["item_id"]: r["reason"] for r in manifest.classified(rows, str(tmp_path), manifest.files_of(rows, str(tmp_path))).collect()}
    assert got["a"] is None and got["b"].startswith("clip_path not found")


@pytest.mark.parametrize("kind", ["json", "jsonl"])
def test_json_manifest(spark, tmp_path, kind):
    one = dict(zip(HEAD.split(","), ["a", "s", "v", "w", "5", "x.mp4", None])) | {"site": "north", "lane": 4, "more": {"x": [1]}}
    rows = [one, {**one, "item_id": 7}, {**one, "item_id": "b", "duration_seconds": 2.5, "site": None}]
    (tmp_path / f"m.{kind}").write_text(json.dumps({"items": rows}) if kind == "json" else "\n\n".join(map(json.dumps, rows)))
    dealt = manifest.classified(manifest.read(spark, str(tmp_path / f"m.{kind}"))).orderBy("row_number").collect()
    assert dealt[0]["reason"] is None and "item_id" in dealt[1]["reason"] and dealt[2]["duration_seconds"] == 2.5 and [r["row_number"] for r in dealt] == [1, 2, 3]
    assert (dealt[0]["site"], dealt[0]["lane"], dealt[0]["more"], dealt[2]["site"]) == ("north", "4", '{"x":[1]}', None)
    (tmp_path / f"n.{kind}").write_text("[1]" if kind == "json" else "1")
    with pytest.raises(Exception, match="no object"):
        manifest.read(spark, str(tmp_path / f"n.{kind}")).collect()


def test_rows_are_numbered_across_partitions(spark):
    rows = spark.range(1000).repartition(7).orderBy(F.desc("id"))
    assert [(r["n"], r["id"]) for r in numbered(rows, "n").orderBy("n").collect()] == [(i + 1, 999 - i) for i in range(1000)]
    assert numbered(spark.range(0), "n").count() == 0


def test_manifests_that_arrive_in_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.csv").write_text("\n".join([HEAD, "a,s,v,w,5,x.mp4,", "a,s,v,w,5,x.mp4,", "b,s,v,w,when,x.mp4,"]))
    schema = ", ".join(f"{c} string" for c in HEAD.split(","))
    for _ in range(2):  # the second run finds nothing new
        manifests.ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state"), schema).awaitTermination()
    assert [r["item_id"] for r in spark.read.parquet(f"{tmp_path}/out/clips").collect()] == ["a"] and spark.read.parquet(f"{tmp_path}/out/rejected").count() == 2


def test_review(spark):
    pairs = spark.createDataFrame([(f"a{i}", f"b{i}", 0.8 + i / 1000) for i in range(100)], "a string, b string, similarity double")
    kept = review.stratified(pairs, 20).collect()
    assert len(kept) == 20 and {int((r["similarity"] - 0.8) / 0.099 * 3.999) for r in kept} == {0, 1, 2, 3}
    assert sorted(kept) == sorted(review.stratified(pairs, 20).collect()) and review.stratified(pairs, 0).count() == 0 and review.stratified(pairs, 100).count() == 100
    assert review.shares({0: 1, 1: 50, 2: 50, 3: 899}, 20) == {0: 1, 1: 1, 2: 1, 3: 17} and sum(review.shares({0: 5, 1: 5}, 1).values()) == 1


def test_a_judge_that_fails(spark):
    pairs = spark.createDataFrame([("a", "b", 0.85), ("a", "c", 0.84), ("a", "d", 0.83), ("a", "e", 0.82)], "a string, b string, similarity double")
    frames = spark.createDataFrame([(i, [f"{i}{n}" for n in range(5)]) for i in "abcd"], "item_id string, paths array<string>")

    def judge(a, b, left, right):
        if b == "c":
            raise ValueError("busy")
        return '{"verdict": "redundant", "confidence": 7}' if (len(left), right) == (1, ["b2"]) else "who knows"

    told = review.judged(pairs, frames, judge, shown=1, retries=2, pause=lambda s: None)
    said = review.verdicts(told).collect()
    assert [(r["b"], r["verdict"], r["confidence"]) for r in said] == [("b", "REDUNDANT", 1.0), ("c", "UNKNOWN", 0.0), ("d", "UNKNOWN", 0.0)] and said[1]["reason"] == "judge failed: busy"
    assert {r["b"]: (r["attempts"], r["error"]) for r in told.collect()} == {"b": (1, None), "c": (3, "busy"), "d": (1, None), "e": (0, "no frames")}
    assert review.counters(9, 4, told, review.verdicts(told)).first().asDict() == {"considered": 9, "reviewed": 3, "skipped_for_cap": 5, "errors": 3, "merged": 1}
    assert [(r["a"], r["b"]) for r in review.merged(review.verdicts(told)).collect()] == [("a", "b")]


def test_chat_judge(tmp_path):
    (tmp_path / "f.jpg").write_bytes(b"pixels")
    sent = []
    answer = json.dumps({"choices": [{"message": {"content": "REDUNDANT"}}]}).encode()
    judge = ChatJudge(environment.Judge(environment.Secret("k1"), "http://there/v1/", "org"), "m", 20, send=lambda r: sent.append(r) or answer)
    assert judge("a", "b", [str(tmp_path / "f.jpg")], []) == "REDUNDANT"
    body = json.loads(sent[0].data)
    assert sent[0].full_url == "http://there/v1/chat/completions" and sent[0].headers["Authorization"] == "Bearer k1" and body["max_tokens"] == 20 and "cGl4ZWxz" in body["messages"][0]["content"][2]["image_url"]["url"]
    with pytest.raises(RuntimeError, match="OPENAI_API_KEY"):
        ChatJudge(environment.Judge(), "m")("a", "b", [], [])


def test_search_moves_no_matrix_and_keeps_ties(spark):
    rng = np.random.default_rng(8)
    few = rng.normal(size=(40, 6))
    few /= np.linalg.norm(few, axis=1, keepdims=True)
    rows = [(f"c{i:03d}", few[i % 40].tolist()) for i in rng.permutation(120).tolist()]  # each vector three times
    rows += [("c000", few[7].tolist()), ("zero", [0.0] * 6), ("bad", [float("nan")] * 6)]
    table = spark.createDataFrame(rows, "item_id string, vec array<double>")
    found = knn.exact(table, 4, block=9)
    assert "CartesianProduct" in found._jdf.queryExecution().executedPlan().toString()
    want = set()
    for own, v in rows:
        others = sorted((-round(float(np.dot(v, w)), 12) + 0.0, other) for other, w in rows if other != own and np.isfinite(np.dot(v, w)))
        want |= {(own, other, n + 1) for n, (_, other) in enumerate(others[:4])} if own != "c000" else set()
    got = {(r["item_id"], r["neighbor_id"], r["rank"]) for r in found.collect()}
    assert {g for g in got if g[0] != "c000"} == want
    assert knn.probe(table.where("item_id <> 'bad'"), 4, cells=3, probes=3).where("rank = 1").count() == 121


def test_products_of_a_block_stay_small():
    rng = np.random.default_rng(8)
    m = rng.normal(size=(3 * 2048, 16))
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    ids = np.array([f"c{i:05d}" for i in range(len(m))], dtype=object)
    best = knn._Best(ids[:2048], m[:2048], None, 3)
    best.see(ids[:2048], m[:2048], 0)
    best.see(ids[2048:4096], m[2048:4096], 0)
    tracemalloc.start()
    best.see(ids[4096:], m[4096:], 0)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 2048 * knn.SLAB * 4  # less than the products of all columns
    s = np.round(m[:2048] @ m.T, 12)
    s[np.arange(2048), np.arange(2048)] = -2
    assert (best.whom == ids[np.argsort(-s, axis=1, kind="stable")[:, :3]]).all()


def test_sample_reads_its_pairs_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(parts):
        for part in parts:
            seen.add(len(part))
            yield part

    pairs = spark.range(100).selectExpr("concat('a', id) AS a", "concat('b', id) AS b", "id / 100 AS similarity").mapInPandas(counted, "a string, b string, similarity double")
    assert review.stratified(pairs, 20).count() == 20 and seen.value == 100


@pytest.mark.parametrize("xs, bands", [([[1.0, 0.0], [0.0, 1.0]], []), ([[1.0, 0.0], [0.375, 0.9270248]], [(3, 1)])])
def test_bands_of_a_zone_without_width(spark, tmp_path, xs, bands):
    rows = [(i, x, 1) for i, x in enumerate(xs)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert [tuple(r) for r in queries.review_bands(spark, str(tmp_path)).collect()] == bands


def test_report_is_told_in_pieces(spark, clips):
    d = delivery.score(clips, 0.91)
    people = clips.select("item_id", F.lit("w").alias("worker_id"), F.lit("s").alias("session_id"))
    said = report.assembled(spark, d, people, spark.createDataFrame([(3, 'x"\n', "é")], "row_number long, item_id string, reason string"), config.Config())
    rows = report.pieces(said, {"enabled": False}, {}, "now").orderBy("n").collect()
    text = "".join(r["payload"] for r in rows)
    told = json.loads(text)
    assert len(rows) > 20 and max(len(r["payload"]) for r in rows) < 1500 and text == json.dumps(told, indent=2, ensure_ascii=False) + "\n"
    assert told["duplicate_clusters"][0]["members"] == ["a", "b", "c"] and told["rejected_clips"] == [{"row_number": 3, "item_id": 'x"\n', "reason": "é"}] and len(told["clip_scores"]) == 5


def test_json_manifest_is_read_record_by_record(spark, tmp_path):
    held = []

    def pieces(n):
        yield '{"note": {"clips": [1]}, "data": [7], "clips": ['
        for i in range(n):
            held.append(text.text)
            yield ("," if i else "") + ' {"a": "x, ]} \\"' + str(i)
            yield '"}'
        yield "]}"

    text = manifest._Pieces(None)
    text.pieces, text.chunk = pieces(2000), 1
    found = list(manifest._records(text))
    assert [json.loads(r)["a"] for p, n, r in found if p == 0 and n] == [f'x, ]}} "{i}' for i in range(2000)] and max(map(len, held)) < 200
    assert list(manifest._records(manifest._Pieces(iter(["[1", "2,3", "4", " ]"])))) == [(0, 0, None), (0, 1, "12"), (0, 2, "34")]
    for bad in ("[1 2]", "[1]]", "[1,", "", "{} 1"):
        with pytest.raises(ValueError):
            list(manifest._records(manifest._Pieces(iter([bad]))))
    for name, body in (("list", "[]"), ("none", '{"x": []}')):
        (tmp_path / f"{name}.json").write_text(body)
    assert manifest.read(spark, f"{tmp_path}/list.json").count() == 0
    with pytest.raises(ValueError):
        manifest.read(spark, f"{tmp_path}/none.json")


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_csv_manifest_is_read_by_splits(spark, tmp_path, end):
    long = '"' + "a, b\n" * 40 + '""c"'  # longer than a split
    lines = ["h1,h2,h3", *(f'{i},"x, ""{i}""",' if i % 7 else f"{i},{long}," for i in range(60)), "", "short", "h1,h2,h3"]
    (tmp_path / "m.csv").write_bytes((end.join(lines) + end).encode())
    want = [(str(i), f'x, "{i}"' if i % 7 else "a, b\n" * 40 + '"c', "", i + 1) for i in range(60)]
    want += [("short", "", "", 61), ("h1", "h2", "h3", 62)]
    whole = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.minPartitionNum": "1", "spark.sql.files.openCostInBytes": "0"}
    kept = {k: spark.conf.get(k, None) for k in whole}
    try:
        for k, v in whole.items():
            spark.conf.set(k, v)
        rows = manifest.read_csv(spark, str(tmp_path / "m.csv"))
        assert rows.select(F.spark_partition_id()).distinct().count() > 10
        assert [tuple(r) for r in rows.orderBy("row_number").collect()] == want
    finally:
        for k, v in kept.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    (tmp_path / "n.csv").write_text('h1,h2\n5" a,b\nc,"d"\n')  # a quote inside a field
    assert [tuple(r) for r in manifest.read_csv(spark, str(tmp_path / "n.csv")).orderBy("row_number").collect()] == [('5" a', "b", 1), ("c", "d", 2)]


def test_report_reaches_the_driver_in_chunks(spark, clips, tmp_path, monkeypatch):
    d = delivery.score(clips, 0.91)
    people = clips.select("item_id", F.lit("w").alias("worker_id"), F.lit("s").alias("session_id"))
    rejected = spark.range(3000).coalesce(1).select((F.col("id") + 1).alias("row_number"), F.concat(F.lit('x,"\n'), "id").alias("item_id"), F.lit("é").alias("reason"))
    said = report.assembled(spark, d, people, rejected, config.Config())
    seen, plain = [], type(clips).toLocalIterator

    def counted(self, *args, **kwargs):
        for row in plain(self, *args, **kwargs):
            seen.append(row)
            yield row

    monkeypatch.setattr(type(clips), "toLocalIterator", counted)
    files = report.written(said, str(tmp_path))
    assert len(seen) < 300
    with open(files["rejected_csv"], encoding="utf-8", newline="") as f:
        rows = list(csv.DictReader(f))
    assert rows == [{"row_number": str(i + 1), "item_id": f'x,"\n{i}', "reason": "é"} for i in range(3000)]
    with open(files["json"], encoding="utf-8") as f:
        assert [r["row_number"] for r in json.load(f)["rejected_clips"]] == list(range(1, 3001))
