"""The registered queries over the reference data model, and their SQL for DuckDB."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline import config
from sieveline.functions import sampling
from sieveline.functions.vectors import l2_normalize
from sieveline.operators import clusters as cl
from sieveline.operators import knn, pooling, review, scoring
from sieveline.operators.numbering import numbered
from sieveline.operators.search import Cells
from sieveline.plans import delivery, report
from sieveline.sources import embedding, manifest
from sieveline.sources import frames as media
from sieveline.storage import copied, cut, joined, remove, shared_folder

K, THRESHOLD, LOW, FLAG = 10, 0.40, 0.35, 3
PLACES = 6


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _item(clip: str) -> F.Column:
    return F.format_string("clip_%06d", F.expr(clip))


def _frames(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    return rows.select(_item(f"vec_id div {n}").alias("item_id"), F.expr(f"cast(vec_id % {n} as int)").alias("frame_index"), "embedding")


def _clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "embeddings").select(_item("vec_id").alias("item_id"), l2_normalize("embedding").alias("vec"))


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    return rows.select(_item("vec_id").alias("item_id"), F.concat(F.lit("w"), F.col("label").cast("string")).alias("worker_id"), F.concat(F.lit("s"), (F.col("vec_id") % 7).cast("string")).alias("session_id"))


def _scored(spark: SparkSession, sf_dir: str) -> delivery.Delivery:
    return delivery.score(_clips(spark, sf_dir), THRESHOLD, K)


def _neighbors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn.exact(_clips(spark, sf_dir), K)


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*(F.round(c, PLACES).alias(c) if c in names else F.col(c) for c in df.columns))


def _long(df: DataFrame) -> DataFrame:
    """Vectors as rows, rounded."""
    return df.select("item_id", F.posexplode("vec").alias("place", "value")).select("item_id", "place", F.round("value", PLACES).alias("value"))


def _dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _table(spark, sf_dir, "events")
    pick = lambda *cases, other: F.expr("case " + " ".join(f"when event_id % {m} = {r} then {v}" for m, r, v in cases) + f" else {other} end")
    return e.select(
        (F.col("event_id") + 1).alias("row_number"),
        pick((97, 5, "'  '"), (11, 3, "concat(' item_', event_id - 1, ' ')"), other="concat('item_', event_id)").alias("item_id"),
        pick((89, 7, "''"), other="concat('s', user_id % 7)").alias("session_id"),
        F.concat(F.lit("v"), F.col("user_id").cast("string")).alias("parent_video_id"),
        pick((83, 2, "null"), other="concat('w', user_id % 20)").alias("worker_id"),
        pick((13, 4, "'next monday'"), (17, 4, "concat('19234', event_id, '.5')"), other="'2031-05-06T07:08:09Z'").alias("timestamp"),
        F.concat(F.lit("clips/"), F.col("event_id").cast("string"), F.lit(".mp4")).alias("clip_path"),
        pick((19, 6, "'-3'"), (23, 6, "' '"), (29, 6, "'12.5'"), other="''").alias("duration_seconds"),
    )


def ingest_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = manifest.clips(manifest.classified(_dirty(spark, sf_dir), "/media"))
    return rows.select("row_number", "item_id", "worker_id", "timestamp", "clip_path", "duration_seconds")


def ingest_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.rejected(manifest.classified(_dirty(spark, sf_dir), "/media"))


def ingest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = manifest.classified(_dirty(spark, sf_dir), "/media")
    return dealt.groupBy(F.col("reason").isNull().alias("valid")).agg(F.count(F.lit(1)).alias("n"))


def l2_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _long(_clips(spark, sf_dir))


def mean_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _long(pooling.pool(_frames(spark, sf_dir, 5), "mean"))


def single_frame_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _long(pooling.pool(_frames(spark, sf_dir, 5), "none"))


def max_frame_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _frames(spark, sf_dir, 2).groupBy("item_id").agg(F.collect_list(l2_normalize("embedding")).alias("fs"))
    after = f.select(F.format_string("clip_%06d", F.substring("item_id", 6, 20).cast("long") - 1).alias("item_id"), F.col("item_id").alias("other_id"), F.col("fs").alias("gs"))
    return f.join(after, "item_id").select("item_id", "other_id", F.round(pooling.max_frame_similarity(F.col("fs"), F.col("gs")), PLACES).alias("similarity"))


def knn_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_neighbors(spark, sf_dir), "similarity")


def nearest_neighbor(spark: SparkSession, sf_dir: str) -> DataFrame:
    clips = _clips(spark, sf_dir)
    return _rounded(knn.nearest_neighbor(clips, knn.exact(clips, 1)), "similarity")


def clip_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_scored(spark, sf_dir).scores, "novelty", "max_similarity")


def unique_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(cl.unique_pairs(_neighbors(spark, sf_dir)), "similarity")


def threshold_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(cl.edges(cl.unique_pairs(_neighbors(spark, sf_dir)), THRESHOLD), "similarity")


def gray_zone_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(review.gray_zone(cl.unique_pairs(_neighbors(spark, sf_dir)), LOW, THRESHOLD), "similarity")


def connected_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).assigned


def clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _scored(spark, sf_dir)
    return _rounded(cl.clusters(d.assigned, d.edges), "max_similarity", "mean_similarity")


def diversity_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _scored(spark, sf_dir)
    return _rounded(scoring.summary(d.scores, d.assigned), "score", "avg_novelty", "cluster_penalty")


def _redundancy(spark: SparkSession, sf_dir: str, attribute: str) -> DataFrame:
    rows = scoring.redundancy_by(_scored(spark, sf_dir).scores, _manifest(spark, sf_dir), attribute)
    return _rounded(rows, "mean_novelty", "redundancy_rate", "share")


def redundancy_by_worker(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _redundancy(spark, sf_dir, "worker_id")


def redundancy_by_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _redundancy(spark, sf_dir, "session_id")


def flagged_for_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.flagged(_scored(spark, sf_dir).assigned, FLAG)


def _confirmed(spark: SparkSession, sf_dir: str, pairs: DataFrame) -> DataFrame:
    """The pairs of the gray zone that a judge by rule confirms: those of one worker."""
    who = _manifest(spark, sf_dir).select("item_id", "worker_id")
    zone = review.gray_zone(pairs, LOW, THRESHOLD)
    return zone.join(who.toDF("a", "wa"), "a").join(who.toDF("b", "wb"), "b").where("wa = wb").select("a", "b")


def forced_merge_recluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    clips = _clips(spark, sf_dir)
    pairs = cl.unique_pairs(knn.exact(clips, K))
    return cl.assignment(clips, cl.edges(cl.force(pairs, _confirmed(spark, sf_dir, pairs), THRESHOLD), THRESHOLD))


def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    zone = review.gray_zone(cl.unique_pairs(_neighbors(spark, sf_dir)), LOW, THRESHOLD)
    return _rounded(review.stratified(zone, 50), "similarity")


def frames_for_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.when(F.col("event_id") % 10 != 0, F.col("event_id") % 120)
    return _table(spark, sf_dir, "events").select("event_id", sampling.frames_for(d, [(10.0, 2), (60.0, 4)], 5).alias("n_frames"))


def sample_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _table(spark, sf_dir, "events").select("event_id", (F.col("event_id") % 120 + 1).cast("double").alias("d"), (F.col("event_id") % 5 + 1).cast("int").alias("n"))
    out = e.select("event_id", F.posexplode(sampling.sample_offsets(F.col("d"), F.col("n"))).alias("place", "value"))
    return out.select("event_id", "place", F.round("value", PLACES).alias("seconds"))


def representative_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _table(spark, sf_dir, "events").select("event_id", F.transform(F.sequence(F.lit(0), (F.col("event_id") % 9).cast("int")), lambda i: F.concat(F.lit("f"), i.cast("string"))).alias("paths"))
    return e.select("event_id", F.array_join(sampling.representative(F.col("paths"), 1), ",").alias("one"), F.array_join(sampling.representative(F.col("paths"), 4), ",").alias("four"))


#: Replies of a judge, by the row's number; Spark and DuckDB read this alike.
_REPLY = """CASE (conv_id + turn) % 12
  WHEN 0 THEN concat('{"verdict": "redundant", "confidence": ', (conv_id % 15) / 10.0, ', "reason": "r', turn, '"}')
  WHEN 1 THEN concat('```json ', '{"verdict": "Distinct", "confidence": 0.9, "reason": "x"}', ' ```')
  WHEN 2 THEN concat('I say ', '{"verdict": " REDUNDANT ", "confidence": -3, "reason": "y"}', ' because')
  WHEN 3 THEN 'I think these are REDUNDANT.' WHEN 4 THEN 'redundant or distinct' WHEN 5 THEN 'Distinct, surely' WHEN 6 THEN '{"verdict": "same"}'
  WHEN 7 THEN '{"verdict": "distinct"' WHEN 8 THEN '{"verdict": "DISTINCT", "confidence": "high"}' WHEN 9 THEN concat('{"verdict": "REDUNDANT", "confidence": 0.25, "reason": "', repeat('long ', 100), '"}')
  WHEN 10 THEN substr(text, 1, 60) ELSE '' END"""


def verdict_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = review.verdict(F.expr(_REPLY))
    c = _table(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", v["verdict"].alias("verdict"), F.round(v["confidence"], PLACES).alias("confidence"), v["reason"].alias("reason"))


def stub_embed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _long(embedding.stub_vectors(_table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("item_id"), F.col("text").cast("binary").alias("payload"))))


def document_delivery_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default threshold on hash vectors of texts, where equal texts are duplicates."""
    docs = _table(spark, sf_dir, "documents").select(F.format_string("doc_%012d", "doc_id").alias("item_id"), F.col("text").cast("binary").alias("payload"))
    d = delivery.score(embedding.stub_vectors(docs), 0.91, K)
    return _rounded(scoring.summary(d.scores, d.assigned), "score", "avg_novelty", "cluster_penalty")


def knn_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The search by cells, all of which are probed, so that it misses nothing."""
    return _rounded(Cells(nlist=8, nprobe=8).neighbors(_clips(spark, sf_dir), K), "similarity")


def knn_default_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The neighbours that the search by cells finds with its default settings."""
    return _rounded(Cells().neighbors(_clips(spark, sf_dir), K), "similarity")


def diversity_score_exponents(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _scored(spark, sf_dir)
    each = [scoring.summary(d.scores, d.assigned, exponent=e).select(F.lit(e).alias("exponent"), "score", "cluster_penalty") for e in (1.0, 2.0, 4.0)]
    return _rounded(reduce(DataFrame.unionByName, each), "score", "cluster_penalty")


def review_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many pairs each band of a sample has."""
    zone = cut(review.gray_zone(cl.unique_pairs(_neighbors(spark, sf_dir)), LOW, THRESHOLD))
    kept = cut(review.stratified(zone, 50))
    ends = zone.agg(F.min("similarity").alias("low"), F.max("similarity").alias("high"))  # nulls of an empty zone
    band = F.least(F.lit(3), F.floor(F.try_divide(F.col("similarity") - F.col("low"), F.col("high") - F.col("low")) * 4)).cast("int")
    return kept.join(F.broadcast(ends)).groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("n"))


def _rule(a: str, b: str, left: list[str], right: list[str]) -> str:
    """A judge by rule: it follows the last digits, and fails for some pairs."""
    n = int(a[-1]) + int(b[-1])
    if n % 5 == 0:
        raise ValueError("out of order")
    return "no idea" if n % 5 == 1 else '{"verdict": "%s", "confidence": 0.75, "reason": "%d and %d frames"}' % ("redundant" if n % 5 < 4 else "DISTINCT", len(left), len(right))


def _told(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    zone = cut(review.gray_zone(cl.unique_pairs(_neighbors(spark, sf_dir)), LOW, THRESHOLD))
    chosen = cut(review.stratified(zone, 50))
    clips = _table(spark, sf_dir, "embeddings").where("vec_id % 11 <> 0")
    frames = clips.select(_item("vec_id").alias("item_id"), F.transform(F.sequence(F.lit(0), F.lit(4)), lambda i: F.concat(F.lit("f"), i.cast("string"))).alias("paths"))
    told = cut(review.judged(chosen, frames, _rule, shown=2, retries=1, pause=lambda s: None))
    return zone, chosen, told, review.verdicts(told)


def review_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_told(spark, sf_dir)[3], "similarity")


def review_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    zone, chosen, told, verdicts = _told(spark, sf_dir)
    return review.counters(zone.count(), chosen.count(), told, verdicts)


def _read_back(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """The clips of the dirty manifest after it went through a file."""
    at = f"{shared_folder(spark)}/manifest-{uuid.uuid4().hex}"
    rows, head = _dirty(spark, sf_dir).orderBy("row_number").drop("row_number"), ""
    if kind == "csv":
        # Every field in quotes, as the writer would drop blanks and nulls alike.
        line = F.concat_ws(",", *(F.concat(F.lit('"'), F.coalesce(c, F.lit("")), F.lit('"')) for c in rows.columns))
        lines, head = rows.select(line.alias("value")), ",".join(rows.columns) + "\n"
    elif kind == "jsonl":
        lines = rows.select(F.to_json(F.struct(*rows.columns)).alias("value"))
    else:
        each = numbered(rows, "n")
        record = F.concat(F.when(F.col("n") > 1, ",").otherwise(""), F.to_json(F.struct(*rows.columns)))
        ends = spark.createDataFrame([(0, '{"clips":['), ((1 << 63) - 1, "]}")], "n long, value string")
        lines = each.select("n", record.alias("value")).unionByName(ends).orderBy("n").select("value")
    lines.write.text(at)
    named = f"{at}.{kind}"
    joined(spark, at, named, head)
    remove(spark, at)
    dealt = manifest.clips(manifest.classified(manifest.read(spark, named), "/media"))
    return dealt.select("row_number", "item_id", "worker_id", "timestamp", "clip_path", "duration_seconds")


def manifest_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read_back(spark, sf_dir, "csv")


def manifest_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read_back(spark, sf_dir, "json")


def manifest_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read_back(spark, sf_dir, "jsonl")


def row_ordinals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows numbered by range partitions, and by the order of an id."""
    return numbered(_table(spark, sf_dir, "events").repartition(7).orderBy("event_id").select("event_id"), "row_number")


def seek_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _table(spark, sf_dir, "events").select("event_id", (F.col("event_id") % 120 / 7.0).alias("d"))
    tries = sampling.seek_ladder(F.col("d"), F.col("d") * (F.col("event_id") % 4) / 3, F.col("event_id") % 4 == 3)
    return e.select("event_id", F.posexplode(tries).alias("place", "t")).select("event_id", "place", F.col("t.mode").alias("mode"), F.round("t.seconds", PLACES).alias("seconds"))


def safe_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.when(F.col("event_id") % 50 == 0, "").otherwise(F.concat("event_type", F.lit("/ ü."), F.col("event_id").cast("string"), F.lit("-_:*")))
    return _table(spark, sf_dir, "events").select("event_id", sampling.safe_id(name).alias("folder"))


def _assembled(spark: SparkSession, sf_dir: str) -> report.Assembled:
    how = config.Config(clustering=config.Clustering(similarity_threshold=THRESHOLD))
    rejected = cut(manifest.rejected(manifest.classified(_dirty(spark, sf_dir), "/media")))
    return report.assembled(spark, _scored(spark, sf_dir), _manifest(spark, sf_dir), rejected, how)


def report_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _assembled(spark, sf_dir).summary
    return spark.createDataFrame([tuple(s.values())], ", ".join(f"{k} {'double' if isinstance(v, float) else 'long'}" for k, v in s.items()))


def report_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = _assembled(spark, sf_dir)
    rows = said.tables["duplicate_clusters"].join(said.previews, "first_member").withColumn("flagged", F.col("size") >= FLAG)
    return _rounded(rows, "max_similarity", "mean_similarity")


def report_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _assembled(spark, sf_dir).members


def report_clip_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(numbered(_assembled(spark, sf_dir).tables["clip_scores"], "place"), "novelty", "max_similarity")


def orderings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The places of rows in the orders that results come in."""
    d = _scored(spark, sf_dir)
    zone = review.gray_zone(d.pairs, LOW, THRESHOLD)
    pair = F.concat_ws(" ", "a", "b")
    each = {
        "clips": d.clips.orderBy("item_id").select(F.col("item_id").alias("key")),
        "pairs": d.pairs.orderBy("a", "b").select(pair.alias("key")),
        "candidates": review.ordered(zone).select(pair.alias("key")),
        "workers": report.worst_first(scoring.redundancy_by(d.scores, _manifest(spark, sf_dir), "worker_id")).select("key"),
        "clusters": cl.clusters(d.assigned, d.edges, 2).orderBy("cluster_id").select(F.col("first_member").alias("key")),
        "flagged": cl.flagged(d.assigned, FLAG).orderBy("item_id").select(F.col("item_id").alias("key")),
    }
    return reduce(DataFrame.unionByName, (numbered(df, "place").withColumn("kind", F.lit(kind)) for kind, df in each.items()))


def report_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON report in pieces, whose texts joined by ``n`` are the report."""
    return report.pieces(_assembled(spark, sf_dir), {"enabled": False}, {}, "")


def report_json_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The duplicate clusters that the JSON report tells of, read from it."""
    schema = "cluster_id int, size bigint, max_similarity double, flagged boolean, members array<string>"
    told = report_payload(spark, sf_dir).where("name = 'duplicate_clusters'").groupBy("row").agg(F.array_sort(F.collect_list(F.struct("n", "payload"))).alias("ps"))
    text = F.ltrim(F.array_join(F.transform("ps", lambda p: p["payload"]), ""), F.lit(",\n "))
    rows = told.select(F.from_json(text, schema, {"mode": "FAILFAST"}).alias("c")).select("c.*")
    return rows.select("cluster_id", "size", F.round("max_similarity", 4).alias("max_similarity"), "flagged", F.array_join("members", " ").alias("members"))


def rejected_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rejected rows as the run writes them, read back."""
    at = f"{shared_folder(spark)}/rejected-{uuid.uuid4().hex}.csv"
    with tempfile.TemporaryDirectory() as folder:
        copied(spark, report.written(_assembled(spark, sf_dir), folder)["rejected_csv"], at)
    return manifest.csv_rows(spark, at).select(F.col("row_number").cast("long").alias("row_number"), "item_id", "reason")


def unclean_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sessions that the Markdown report shows: those with clustered clips."""
    return redundancy_by_session(spark, sf_dir).where("clustered_clips > 0").select("key", "clustered_clips")


def empty_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = delivery.score(_clips(spark, sf_dir).limit(0), THRESHOLD, K)
    return scoring.summary(d.scores, d.assigned)


def lone_clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery.score(_clips(spark, sf_dir).where("item_id = 'clip_000007'"), THRESHOLD, K).scores


def survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clips whose frames were taken without an error."""
    clips = _table(spark, sf_dir, "embeddings").select(_item("vec_id").alias("item_id"), "vec_id")
    paths = F.when(F.col("vec_id") % 4 != 0, F.array(F.concat(F.lit("f"), F.col("vec_id").cast("string")))).otherwise(F.array().cast("array<string>"))
    frames = clips.select("item_id", paths.alias("paths"), F.lit(False).alias("reused"), F.when(F.col("vec_id") % 6 == 0, "no frame").alias("error"))
    return clips.join(media.usable(frames), "item_id", "left_semi").select("item_id")


def data_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").where("text is not null")
    return docs.select("doc_id", F.element_at(media.encoded(F.array(F.col("text").cast("binary"))), 1).alias("url"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        diversity_score, ingest_valid, ingest_rejected, ingest_counts, l2_normalized, mean_pool, single_frame_pool, max_frame_pair, knn_topk, nearest_neighbor, clip_scores,
        unique_pairs, threshold_edges, gray_zone_pairs, connected_components, clusters, redundancy_by_worker, redundancy_by_session, flagged_for_removal,
        forced_merge_recluster, stratified_sample, frames_for_duration, sample_offsets, representative_frames, verdict_parse, stub_embed_documents,
        document_delivery_score, knn_probe, knn_default_cells, diversity_score_exponents, review_bands, review_verdicts, review_counters, manifest_csv, manifest_json, manifest_json_lines,
        row_ordinals, seek_ladder, safe_ids, report_summary, report_clusters, report_members, report_clip_scores, orderings, report_payload,
        report_json_clusters, rejected_csv, unclean_groups, empty_delivery, lone_clip, survivors, data_urls,
    )
    return {f.__name__: f for f in own}


_UNIT = "list_transform({e}, lambda x: x / greatest(sqrt(list_inner_product({e}, {e})), 1e-12))"
_VECS = f"""
v AS (SELECT format('clip_{{:06d}}', vec_id) AS item_id, 'w' || label AS worker_id, 's' || (vec_id % 7) AS session_id, embedding::DOUBLE[] AS e FROM embeddings),
u AS (SELECT item_id, worker_id, session_id, {_UNIT.format(e="e")} AS vec FROM v)"""


def _near(k: int, low: str = _VECS) -> str:
    return f"""{low},
dots AS (SELECT a.item_id, b.item_id AS neighbor_id, least(1.0, greatest(-1.0, list_inner_product(a.vec, b.vec))) AS similarity FROM u a JOIN u b ON a.item_id <> b.item_id),
nn AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY round(similarity, 12) DESC, neighbor_id) AS rank FROM dots QUALIFY rank <= {k}),
pairs AS (SELECT least(item_id, neighbor_id) AS a, greatest(item_id, neighbor_id) AS b, max(similarity) AS similarity FROM nn GROUP BY 1, 2 HAVING max(similarity) > -1)"""


def _graph(edges: str, near: str) -> str:
    return f"""WITH RECURSIVE {near},
edges AS ({edges}),
ends AS (SELECT a AS x, b AS y FROM edges UNION ALL SELECT b, a FROM edges),
reach AS (SELECT item_id AS x, item_id AS y FROM u UNION SELECT r.x, e.y FROM reach r JOIN ends e ON r.y = e.x),
comp AS (SELECT x AS item_id, min(y) AS component FROM reach GROUP BY 1),
assigned AS (SELECT item_id, component, count(*) OVER (PARTITION BY component) AS size FROM comp),
scores AS (SELECT a.item_id, least(1.0, greatest(0.0, 1 - coalesce(n.similarity, 0))) AS novelty, coalesce(n.similarity, 0.0) AS max_similarity, n.neighbor_id AS nearest_item_id, a.size AS cluster_size
           FROM assigned a LEFT JOIN nn n ON n.item_id = a.item_id AND n.rank = 1)"""


_DIRTY = """
d AS (SELECT event_id + 1 AS row_number,
  CASE WHEN event_id % 97 = 5 THEN '  ' WHEN event_id % 11 = 3 THEN ' item_' || (event_id - 1) || ' ' ELSE 'item_' || event_id END AS item_id,
  CASE WHEN event_id % 89 = 7 THEN '' ELSE 's' || (user_id % 7) END AS session_id,
  CASE WHEN event_id % 83 = 2 THEN NULL ELSE 'w' || (user_id % 20) END AS worker_id,
  CASE WHEN event_id % 13 = 4 THEN 'next monday' WHEN event_id % 17 = 4 THEN '19234' || event_id || '.5' ELSE '2031-05-06T07:08:09Z' END AS timestamp,
  '/media/clips/' || event_id || '.mp4' AS clip_path,
  CASE WHEN event_id % 19 = 6 THEN '-3' WHEN event_id % 23 = 6 THEN ' ' WHEN event_id % 29 = 6 THEN '12.5' ELSE '' END AS duration FROM events),
c AS (SELECT row_number, trim(item_id) AS item_id, worker_id, timestamp, clip_path, CASE WHEN trim(duration) <> '' THEN duration::DOUBLE END AS duration_seconds,
  concat_ws(', ', CASE WHEN trim(item_id) = '' THEN 'item_id' END, CASE WHEN session_id = '' THEN 'session_id' END, CASE WHEN worker_id IS NULL THEN 'worker_id' END) AS missing,
  concat_ws('; ', CASE WHEN timestamp = 'next monday' THEN 'timestamp: neither ISO-8601 nor a number' END, CASE WHEN trim(duration) <> '' AND duration::DOUBLE <= 0 THEN 'duration_seconds: not positive' END) AS bad FROM d),
f AS (SELECT *, min(CASE WHEN missing = '' AND bad = '' THEN row_number END) OVER (PARTITION BY item_id) AS first FROM c),
r AS (SELECT *, CASE WHEN missing <> '' THEN 'missing required field(s): ' || missing WHEN row_number > first THEN 'duplicate item_id (first seen at row ' || first || ')' WHEN bad <> '' THEN bad END AS reason FROM f)"""

_FRAMES = "f AS (SELECT format('clip_{{:06d}}', vec_id // {n}) AS item_id, (vec_id % {n})::INT AS frame_index, embedding::DOUBLE[] AS e FROM embeddings)"


def _spread(table: str) -> str:
    return f"SELECT item_id, (i - 1)::INT AS place, round(vec[i], {PLACES}) AS value FROM (SELECT item_id, vec, unnest(range(1, len(vec) + 1)) AS i FROM {table})"


_SUMMARY = f"""SELECT round(greatest(0.0, (n - p) * 15.0), {PLACES}) AS score, round(n, {PLACES}) AS avg_novelty, round(p, {PLACES}) AS cluster_penalty, t AS total_clips, dc AS duplicate_clusters, cc AS clipped_clips
FROM (SELECT avg(novelty) AS n, count(*) AS t FROM scores),
     (SELECT coalesce(sum(size ** 1.5), 0.0) / (SELECT count(*) FROM scores) AS p, count(*) AS dc, coalesce(sum(size), 0)::BIGINT AS cc FROM assigned WHERE size > 1 AND item_id = component)"""


_DOC_VECS = f"""
h AS (SELECT format('doc_{{:012d}}', doc_id) AS item_id, k, sha256(encode(text) || unhex(format('{{:02x}}000000', k))) AS hex FROM documents, range(0, 8) t(k)),
w AS (SELECT item_id, k * 8 + j AS i, substr(hex, j * 8 + 1, 8) AS x FROM h, range(0, 8) s(j)),
l AS (SELECT item_id, list(('0x' || substr(x, 7, 2) || substr(x, 5, 2) || substr(x, 3, 2) || substr(x, 1, 2))::BIGINT / 4294967296.0::DOUBLE - 0.5 ORDER BY i) AS e FROM w GROUP BY 1),
u AS (SELECT item_id, {_UNIT.format(e="e")} AS vec FROM l)"""


def _sampled(zone: str, cap: int = 50, seed: int = 17) -> str:
    """``zone`` and ``sampled``, with bands: the fixed rule, band by band."""
    return f"""zone AS ({zone}), ends AS (SELECT min(similarity) AS lo, max(similarity) - min(similarity) AS width, count(*) AS n FROM zone),
banded AS (SELECT z.*, least(3, floor((similarity - lo) / width * 4))::INT AS band FROM zone z, ends),
sizes AS (SELECT band, count(*) AS m, row_number() OVER (ORDER BY count(*), band) AS pos FROM banded GROUP BY 1),
takes AS (SELECT 0::BIGINT AS pos, -1 AS band, {cap}::BIGINT AS room, (SELECT n FROM ends) AS rest, 0::BIGINT AS take
  UNION ALL SELECT s.pos, s.band, t.room - t.take, t.rest - coalesce((SELECT m FROM sizes WHERE pos = t.pos), 0),
    least(t.room - t.take, s.m, greatest(1, round_even((t.room - t.take) * s.m / (t.rest - coalesce((SELECT m FROM sizes WHERE pos = t.pos), 0)), 0)::BIGINT)) FROM takes t JOIN sizes s ON s.pos = t.pos + 1),
lots AS (SELECT *, row_number() OVER (PARTITION BY band ORDER BY sha256('{seed}|' || a || '|' || b)) AS lot FROM banded),
sampled AS (SELECT lots.* FROM lots JOIN takes USING (band) WHERE lot <= take OR (SELECT n FROM ends) <= {cap})"""


_JUDGED = """
digits AS (SELECT *, (right(a, 1)::INT + right(b, 1)::INT) % 5 AS d, substr(a, 6)::INT % 11 <> 0 AND substr(b, 6)::INT % 11 <> 0 AS shown FROM sampled),
judged AS (SELECT a, b, similarity, shown, CASE WHEN d < 2 THEN 'UNKNOWN' WHEN d < 4 THEN 'REDUNDANT' ELSE 'DISTINCT' END AS verdict, CASE WHEN d < 2 THEN 0.0 ELSE 0.75 END::DOUBLE AS confidence,
  CASE d WHEN 0 THEN 'judge failed: out of order' WHEN 1 THEN 'unparseable reply: no idea' ELSE '2 and 2 frames' END AS reason FROM digits)"""


def oracle_sql() -> dict[str, str]:
    near, vecs = _near(K), _VECS
    over = f"SELECT * FROM pairs WHERE similarity >= {THRESHOLD}"
    graph = _graph(over, near)
    zone = f"SELECT a, b, similarity FROM pairs WHERE similarity >= {LOW} AND similarity < {THRESHOLD}"
    rate = lambda who: f"""{graph}, g AS (SELECT v.{who} AS key, count(*) AS clips, count(*) FILTER (cluster_size > 1) AS clustered_clips, avg(novelty) AS m FROM scores s JOIN v USING (item_id) GROUP BY 1)
SELECT key, clips, clustered_clips, round(m, {PLACES}) AS mean_novelty, round(clustered_clips / clips, {PLACES}) AS redundancy_rate,
       round(CASE WHEN sum(clustered_clips) OVER () > 0 THEN clustered_clips / sum(clustered_clips) OVER () ELSE 0.0 END, {PLACES}) AS share FROM g"""  # noqa: E731
    merged = f"""SELECT a, b, similarity FROM pairs WHERE similarity >= {THRESHOLD}
UNION ALL SELECT p.a, p.b, {THRESHOLD} FROM ({zone}) p JOIN v x ON x.item_id = p.a JOIN v y ON y.item_id = p.b WHERE x.worker_id = y.worker_id"""
    out = {
        "diversity_score": f"{graph} {_SUMMARY}",
        "ingest_valid": f"WITH {_DIRTY} SELECT row_number, item_id, worker_id, timestamp, clip_path, duration_seconds FROM r WHERE reason IS NULL",
        "ingest_rejected": f"WITH {_DIRTY} SELECT row_number, item_id, reason FROM r WHERE reason IS NOT NULL",
        "ingest_counts": f"WITH {_DIRTY} SELECT reason IS NULL AS valid, count(*) AS n FROM r GROUP BY 1",
        "l2_normalized": f"WITH {vecs} {_spread('u')}",
        "mean_pool": f"""WITH {_FRAMES.format(n=5)},
m AS (SELECT item_id, i, sum(e[i] ORDER BY frame_index) / count(*) AS x FROM (SELECT *, unnest(range(1, len(e) + 1)) AS i FROM f) GROUP BY 1, 2),
l AS (SELECT item_id, list(x ORDER BY i) AS e FROM m GROUP BY 1), p AS (SELECT item_id, {_UNIT.format(e="e")} AS vec FROM l) {_spread("p")}""",
        "single_frame_pool": f"WITH {_FRAMES.format(n=5)}, l AS (SELECT item_id, arg_min(e, frame_index) AS e FROM f GROUP BY 1), p AS (SELECT item_id, {_UNIT.format(e='e')} AS vec FROM l) {_spread('p')}",
        "max_frame_pair": f"""WITH {_FRAMES.format(n=2)}, p AS (SELECT item_id, {_UNIT.format(e="e")} AS vec, substr(item_id, 6)::BIGINT AS c FROM f)
SELECT a.item_id, b.item_id AS other_id, round(max(least(1.0, greatest(-1.0, list_inner_product(a.vec, b.vec)))), {PLACES}) AS similarity FROM p a JOIN p b ON b.c = a.c + 1 GROUP BY 1, 2""",
        "knn_topk": f"WITH {near} SELECT item_id, neighbor_id, round(similarity, {PLACES}) AS similarity, rank::INT AS rank FROM nn",
        "nearest_neighbor": f"WITH {_near(1)} SELECT u.item_id, neighbor_id AS nearest_item_id, round(similarity, {PLACES}) AS similarity FROM u LEFT JOIN nn USING (item_id)",
        "clip_scores": f"{graph} SELECT item_id, round(novelty, {PLACES}) AS novelty, round(max_similarity, {PLACES}) AS max_similarity, nearest_item_id, cluster_size FROM scores",
        "unique_pairs": f"WITH {near} SELECT a, b, round(similarity, {PLACES}) AS similarity FROM pairs",
        "threshold_edges": f"WITH {near} SELECT a, b, round(similarity, {PLACES}) AS similarity FROM pairs WHERE similarity >= {THRESHOLD}",
        "gray_zone_pairs": f"WITH {near} SELECT a, b, round(similarity, {PLACES}) AS similarity FROM ({zone})",
        "connected_components": f"{graph} SELECT item_id, component, size FROM assigned",
        "clusters": f"""{graph}, inside AS (SELECT component, max(similarity) AS top, avg(similarity) AS mean FROM edges JOIN comp ON comp.item_id = edges.a GROUP BY 1)
SELECT (row_number() OVER (ORDER BY size DESC, component) - 1)::INT AS cluster_id, component AS first_member, size, round(coalesce(top, 0.0), {PLACES}) AS max_similarity, round(coalesce(mean, 0.0), {PLACES}) AS mean_similarity
FROM (SELECT DISTINCT component, size FROM assigned) LEFT JOIN inside USING (component)""",
        "redundancy_by_worker": rate("worker_id"),
        "redundancy_by_session": rate("session_id"),
        "flagged_for_removal": f"{graph} SELECT item_id FROM assigned WHERE size >= {FLAG} AND item_id <> component",
        "forced_merge_recluster": f"{_graph(merged, near)} SELECT item_id, component, size FROM assigned",
        "frames_for_duration": "WITH d AS (SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN event_id % 120 END AS d FROM events) SELECT event_id, CASE WHEN d <= 10 THEN 2 WHEN d <= 60 THEN 4 ELSE 5 END AS n_frames FROM d",
        "sample_offsets": f"""WITH d AS (SELECT event_id, event_id % 120 + 1.0::DOUBLE AS d, (event_id % 5 + 1)::INT AS n FROM events), o AS (SELECT *, unnest(range(0, n)) AS i FROM d)
SELECT event_id, i::INT AS place, round(CASE WHEN n = 1 THEN d / 2 ELSE i / (n - 1) * d END, {PLACES}) AS seconds FROM o""",
        "representative_frames": """WITH d AS (SELECT event_id, (event_id % 9 + 1)::INT AS n FROM events)
SELECT event_id, CASE WHEN n <= 1 THEN 'f0' ELSE 'f' || (n // 2) END AS one,
  CASE WHEN n <= 4 THEN list_aggregate(list_transform(range(0, n), lambda i: 'f' || i), 'string_agg', ',')
       ELSE list_aggregate(list_transform(range(0, 4), lambda i: 'f' || round_even(i * (n - 1) / 3.0::DOUBLE, 0)::INT), 'string_agg', ',') END AS four FROM d""",
        "stub_embed_documents": f"""WITH h AS (SELECT doc_id::VARCHAR AS item_id, k, sha256(encode(text) || unhex(format('{{:02x}}000000', k))) AS hex FROM documents, range(0, 8) t(k)),
w AS (SELECT item_id, k * 8 + j AS i, substr(hex, j * 8 + 1, 8) AS x FROM h, range(0, 8) s(j)),
n AS (SELECT item_id, i, ('0x' || substr(x, 7, 2) || substr(x, 5, 2) || substr(x, 3, 2) || substr(x, 1, 2))::BIGINT / 4294967296.0::DOUBLE - 0.5 AS x FROM w),
l AS (SELECT item_id, list(x ORDER BY i) AS e FROM n GROUP BY 1), p AS (SELECT item_id, {_UNIT.format(e="e")} AS vec FROM l) {_spread("p")}""",
        "verdict_parse": f"""WITH r AS (SELECT conv_id, turn, {_REPLY} AS reply FROM conversations), j AS (SELECT *, regexp_extract(reply, '(?s)\\{{.*\\}}') AS body FROM r),
p AS (SELECT *, CASE WHEN json_valid(body) THEN body END AS b FROM j),
f AS (SELECT *, upper(json_extract_string(b, '$.verdict')) AS said, try_cast(coalesce(json_extract_string(b, '$.confidence'), '0') AS DOUBLE) AS sure, upper(reply) LIKE '%REDUNDANT%' AS same, upper(reply) LIKE '%DISTINCT%' AS new FROM p),
g AS (SELECT *, coalesce(said IN ('REDUNDANT', 'DISTINCT') AND sure IS NOT NULL, false) AS good FROM f)
SELECT conv_id, turn, CASE WHEN good THEN said WHEN same AND NOT new THEN 'REDUNDANT' WHEN new AND NOT same THEN 'DISTINCT' ELSE 'UNKNOWN' END AS verdict,
  CASE WHEN good THEN round(least(1.0, greatest(0.0, sure)), {PLACES}) WHEN same <> new THEN 0.5 ELSE 0.0 END::DOUBLE AS confidence,
  CASE WHEN good THEN substr(coalesce(json_extract_string(b, '$.reason'), ''), 1, 400) WHEN same <> new THEN 'unstructured reply' ELSE 'unparseable reply: ' || substr(trim(coalesce(reply, '')), 1, 120) END AS reason FROM g""",
        "knn_probe": f"WITH {near} SELECT item_id, neighbor_id, round(similarity, {PLACES}) AS similarity, rank::INT AS rank FROM nn",
        "document_delivery_score": f"""{_graph("SELECT * FROM pairs WHERE similarity >= 0.91", _near(K, _DOC_VECS))} {_SUMMARY}""",
        "stratified_sample": f"WITH RECURSIVE {near}, {_sampled(zone)} SELECT a, b, round(similarity, {PLACES}) AS similarity FROM sampled",
        "review_bands": f"WITH RECURSIVE {near}, {_sampled(zone)} SELECT band, count(*) AS n FROM sampled GROUP BY 1",
        "review_verdicts": f"WITH RECURSIVE {near}, {_sampled(zone)}, {_JUDGED} SELECT a, b, round(similarity, {PLACES}) AS similarity, verdict, confidence, reason FROM judged WHERE shown",
        "review_counters": f"""WITH RECURSIVE {near}, {_sampled(zone)}, {_JUDGED}
SELECT (SELECT count(*) FROM zone) AS considered, count(*) FILTER (shown) AS reviewed, (SELECT count(*) FROM zone) - count(*) AS skipped_for_cap,
  count(*) FILTER (NOT shown OR verdict = 'UNKNOWN') AS errors, count(*) FILTER (shown AND verdict = 'REDUNDANT') AS merged FROM judged""",
        "diversity_score_exponents": f"""{graph} SELECT exponent, round(greatest(0.0, (n - p) * 15.0), {PLACES}) AS score, round(p, {PLACES}) AS cluster_penalty
FROM (SELECT avg(novelty) AS n FROM scores), (SELECT e::DOUBLE AS exponent, coalesce(sum(size ** e) FILTER (size > 1), 0.0) / (SELECT count(*) FROM scores) AS p FROM (VALUES (1.0), (2.0), (4.0)) t(e), assigned WHERE item_id = component GROUP BY 1)""",
        "row_ordinals": "SELECT event_id, row_number() OVER (ORDER BY event_id) AS row_number FROM events",
        "seek_ladder": f"""WITH e AS (SELECT event_id, (event_id % 120 / 7.0)::DOUBLE AS d, event_id % 4 AS i FROM events), o AS (SELECT *, d * i / 3 AS o FROM e),
t AS (SELECT event_id, CASE WHEN i = 3 THEN list_transform([0.1, 0.25, 0.5, 1.0]::DOUBLE[], lambda m: {{'mode': 'from_end', 'seconds': least(m, greatest(d * 0.5, 0.01))}}) ELSE [{{'mode': 'from_start', 'seconds': o}}] END
  || list_filter(list_transform([0.95, 0.85, 0.5]::DOUBLE[], lambda f: {{'mode': 'from_start', 'seconds': o * f}}), lambda x: x.seconds > 0.01) || [{{'mode': 'from_start', 'seconds': 0.0::DOUBLE}}] AS tries FROM o)
SELECT event_id, (i - 1)::INT AS place, tries[i].mode AS mode, round(tries[i].seconds, {PLACES}) AS seconds FROM (SELECT *, unnest(range(1, len(tries) + 1)) AS i FROM t)""",
        "safe_ids": "SELECT event_id, CASE WHEN event_id % 50 = 0 THEN '_unnamed' ELSE regexp_replace(event_type || '/ ü.' || event_id || '-_:*', '[^\\p{L}\\p{N}._-]', '_', 'g') END AS folder FROM events",
        "report_summary": f"""{graph}, sc AS (SELECT avg(novelty) AS n, count(*) AS t FROM scores), pen AS (SELECT coalesce(sum(size ** 1.5), 0.0) / (SELECT t FROM sc) AS p, count(*) AS dc, coalesce(sum(size), 0)::BIGINT AS cc FROM assigned WHERE size > 1 AND item_id = component),
{_DIRTY.strip()}, x AS (SELECT count(*) AS refused FROM r WHERE reason IS NOT NULL)
SELECT round(greatest(0.0, (n - p) * 15.0), 4) AS score, 15.0::DOUBLE AS max_points, round(greatest(0.0, n - p), 4) AS score_fraction, round(n, 6) AS avg_novelty, round(p, 6) AS cluster_penalty, t AS total_clips, dc AS duplicate_clusters, cc AS clips_in_duplicate_clusters,
  t + refused AS manifest_rows, t AS clips_ingested, refused AS clips_rejected, t AS clips_scored, (SELECT count(*) FROM assigned WHERE size >= {FLAG} AND item_id <> component) AS flagged_for_removal FROM sc, pen, x""",
        "report_clusters": f"""{graph}, inside AS (SELECT component, max(similarity) AS top, avg(similarity) AS mean FROM edges JOIN comp ON comp.item_id = edges.a GROUP BY 1),
listed AS (SELECT component, size, list(item_id ORDER BY item_id) AS ids FROM assigned WHERE size > 1 GROUP BY 1, 2)
SELECT (row_number() OVER (ORDER BY size DESC, component) - 1)::INT AS cluster_id, component AS first_member, size, round(top, {PLACES}) AS max_similarity, round(mean, {PLACES}) AS mean_similarity,
  array_to_string(ids[1:6], ', ') || CASE WHEN len(ids) > 6 THEN ' ...' ELSE '' END AS members, size >= {FLAG} AS flagged FROM listed JOIN inside USING (component)""",
        "report_members": f"""{graph}, n AS (SELECT component, (row_number() OVER (ORDER BY size DESC, component) - 1)::INT AS cluster_id FROM assigned WHERE size > 1 AND item_id = component)
SELECT cluster_id, item_id FROM n JOIN assigned USING (component)""",
        "report_clip_scores": f"""{graph}, n AS (SELECT component, (row_number() OVER (ORDER BY size DESC, component) - 1)::INT AS cluster_id FROM assigned WHERE item_id = component)
SELECT item_id, round(novelty, {PLACES}) AS novelty, round(max_similarity, {PLACES}) AS max_similarity, nearest_item_id, cluster_size, cluster_id, row_number() OVER (ORDER BY novelty, item_id) AS place FROM scores JOIN assigned USING (item_id) JOIN n USING (component)""",
        "orderings": f"""{graph}, g AS (SELECT v.worker_id AS key, count(*) FILTER (cluster_size > 1) AS c, count(*) FILTER (cluster_size > 1) / count(*) AS r FROM scores s JOIN v USING (item_id) GROUP BY 1)
SELECT 'clips' AS kind, row_number() OVER (ORDER BY item_id) AS place, item_id AS key FROM u
UNION ALL SELECT 'pairs', row_number() OVER (ORDER BY a, b), a || ' ' || b FROM pairs
UNION ALL SELECT 'candidates', row_number() OVER (ORDER BY similarity DESC, a, b), a || ' ' || b FROM ({zone})
UNION ALL SELECT 'workers', row_number() OVER (ORDER BY c DESC, r DESC, key), key FROM g
UNION ALL SELECT 'clusters', row_number() OVER (ORDER BY size DESC, component), component FROM assigned WHERE size > 1 AND item_id = component
UNION ALL SELECT 'flagged', row_number() OVER (ORDER BY item_id), item_id FROM assigned WHERE size >= {FLAG} AND item_id <> component""",
    }
    out["report_json_clusters"] = f"""{graph}, inside AS (SELECT component, max(similarity) AS top FROM edges JOIN comp ON comp.item_id = edges.a GROUP BY 1),
listed AS (SELECT component, size, string_agg(item_id, ' ' ORDER BY item_id) AS members FROM assigned WHERE size > 1 GROUP BY 1, 2)
SELECT (row_number() OVER (ORDER BY size DESC, component) - 1)::INT AS cluster_id, size, round(top, 4) AS max_similarity, size >= {FLAG} AS flagged, members FROM listed JOIN inside USING (component)"""
    out["rejected_csv"] = out["ingest_rejected"]
    out["unclean_groups"] = f"SELECT key, clustered_clips FROM ({out['redundancy_by_session']}) WHERE clustered_clips > 0"
    out["empty_delivery"] = "SELECT 0.0::DOUBLE AS score, 0.0::DOUBLE AS avg_novelty, 0.0::DOUBLE AS cluster_penalty, 0::BIGINT AS total_clips, 0::BIGINT AS duplicate_clusters, 0::BIGINT AS clipped_clips"
    out["lone_clip"] = "SELECT 'clip_000007' AS item_id, 1.0::DOUBLE AS novelty, 0.0::DOUBLE AS max_similarity, NULL::VARCHAR AS nearest_item_id, 1::BIGINT AS cluster_size"
    out["survivors"] = "SELECT format('clip_{:06d}', vec_id) AS item_id FROM embeddings WHERE vec_id % 4 <> 0 AND vec_id % 6 <> 0"
    out["data_urls"] = "SELECT doc_id, 'data:image/jpeg;base64,' || base64(encode(text)) AS url FROM documents WHERE text IS NOT NULL"
    out |= dict.fromkeys(("manifest_csv", "manifest_json", "manifest_json_lines"), out["ingest_valid"])
    return out
