"""Each stage of the corpus pipeline on awkward rows, and the whole of it."""

import hashlib
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sieveline.llm import bpe

WORDS = [a + b for a in "ba ce di fo gu ha je ki lo mu".split() for b in "r st n th l ng d m x".split()]
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Documents of known kinds, with their labels and benchmark, written as the tables are."""
    rng = random.Random(31)
    at = str(tmp_path_factory.mktemp("tables"))
    good = {i: prose(rng, 120) for i in range(300)}
    bad = {i: "".join(rng.choice("#$%&!?") * 3 + rng.choice("xyz") for _ in range(80)) for i in range(300, 400)}
    item, passage = prose(rng, 40), prose(rng, 80)
    good |= {500: f"{prose(rng, 60)} {item} {prose(rng, 60)}", 501: f"{prose(rng, 90)} {passage} {prose(rng, 50)}", 502: f"{prose(rng, 50)} {passage} {prose(rng, 90)}", 503: good[7], 504: good[8] + " end"}
    rows = [(i, t, "en", "s", len(t)) for i, t in (good | bad).items()]
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(i, int(i < 300), 0) for i in range(400)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame([(0, item), (1, None)], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return at, good, passage


def test_the_whole_pipeline(spark, tables):
    at, good, passage = tables
    out = {r["doc_id"]: r for r in corpus_pipeline.run(spark, at).collect()}
    assert set(out) == set(good) - {500, 503, 504}
    assert sum(out[i]["decoded_sha256"] == hashlib.sha256(good[i].encode()).hexdigest() for i in out) == len(out) - 1  # one of two loses its passage
    assert {r["n_tokens"] for r in out.values()} > {0} or min(r["n_tokens"] for r in out.values()) > 0


def test_stages_by_hand(spark, tables):
    at, good, passage = tables
    docs = spark.read.parquet(f"{at}/documents.parquet")
    left = {r["doc_id"] for r in corpus_pipeline.quality_filter(spark, docs, at).collect()}
    assert left == set(good)
    texts = {r["doc_id"]: r for r in corpus_pipeline.drop_repeats(spark, docs.where("doc_id in (1, 2, 501, 502)"), at).collect()}
    assert sum(passage in texts[i]["text"] for i in (501, 502)) == 1 and all(r["n_chars"] == len(r["text"]) for r in texts.values()) and texts[1]["text"] == good[1]


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_a_stage_on_awkward_rows(spark, tables, name):
    at, good, passage = tables
    stage = dict(corpus_pipeline.STAGES)[name]
    rows = [(1, None), (2, ""), (3, " \n"), (None, good[1]), (None, good[2]), (5, good[3]), (5, good[3]), (5, good[4]), (6, " ".join(good[i] for i in range(200))), (7, "x" * 40000)]
    docs = spark.createDataFrame([(i, t, "en", None, None, "clash", 1, 2) for i, t in rows], COLUMNS + ", key string, k int, spans int")
    out = stage(spark, docs, at)
    kept = out.collect()
    if name == "encode":
        path = public_tokenizers.path("byte_bpe_50k.tiktoken")
        assert len(kept) == len(rows) and kept[0].asDict().keys() == {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}
        assert {r["n_tokens"] for r in kept if r["doc_id"] in (1, 2)} == {0} and bpe.vocabulary(path, public_tokenizers.PATTERN)
    else:
        assert out.columns == docs.columns and {(r["key"], r["k"], r["spans"]) for r in kept} <= {("clash", 1, 2)}
    if name == "simhash_dedup":
        assert sorted((str(r["doc_id"]), r["text"] or "") for r in kept) == sorted([("1", ""), ("None", good[1]), ("None", good[2]), ("5", good[3]), ("5", good[4]), ("6", rows[8][1]), ("7", rows[9][1])])
    if name == "decontaminate":
        assert len(kept) == len(rows)
    if name == "drop_repeats":  # long text 6 holds copies of others: of each one whole copy is left
        assert len(kept) >= len(rows) - 5 and all(sum(good[i][60:600] in (r["text"] or "") for r in kept) >= 1 for i in (1, 2, 3, 4))
    assert stage(spark, docs.limit(0), at).count() == 0


def test_null_columns_and_empty_tables(spark, tables, tmp_path):
    at, good, _ = tables
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(None, None, None, None, None), (1, good[1], None, None, None)], COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.where(F.col("ids_sha256").isNull()).count() == 0 and out.where("doc_id = 1").count() == 1
