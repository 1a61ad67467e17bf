import pytest

from sieveline import cli, config, environment


@pytest.mark.parametrize(
    "given",
    [
        {"frames": {"cuont": 3}}, {"nothing": 1}, {"frames": {"count": 0}}, {"frames": {"count": 65}}, {"frames": {"count": 2.5}}, {"frames": {"count": True}}, {"frames": {"workers": 129}}, {"frames": {"resize": [0, 5]}}, {"frames": {"jpeg_quality": 1}},
        {"frames": {"timeout_seconds": 0}}, {"frames": {"duration_buckets": [{"max_seconds": 9, "count": 2}, {"max_seconds": 5, "count": 2}]}}, {"frames": {"count": 1, "duration_buckets": [{"max_seconds": 9, "count": 2}]}}, {"frames": 7},
        {"embeddings": {"backend": "other"}}, {"embeddings": {"batch_size": 0}}, {"embeddings": {"device": "tpu"}}, {"embeddings": {"driver": "secondary"}}, {"pooling": {"mode": "maxpair"}}, {"pooling": {"mode": "median"}},
        {"search": {"top_k": 1001}}, {"search": {"nprobe": 0}}, {"search": {"hnsw_m": 1}}, {"clustering": {"similarity_threshold": 1.1}}, {"clustering": {"flag_cluster_size": 1}}, {"scoring": {"penalty_exponent": 4.5}}, {"scoring": {"max_points": 0}},
        {"borderline_review": {"gray_zone": [0.9, 0.8]}}, {"borderline_review": {"enabled": True, "gray_zone": [0.8, 0.95]}}, {"borderline_review": {"max_pairs": -1}}, {"borderline_review": {"frames_per_clip": 9}}, {"borderline_review": {"max_retries": 11}},
        {"borderline_review": {"enabled": "yes"}}, {"log_level": "LOUD"}, {"random_seed": "x"},
    ],
)
def test_settings_out_of_range(given):
    with pytest.raises(ValueError):
        config.build(config.Config, given)


def test_settings_are_read(tmp_path):
    at = tmp_path / "c.yaml"
    at.write_text("output_dir: out\nframes: {count: 3, duration_buckets: [{max_seconds: 5, count: 2}, {max_seconds: .inf, count: 7}]}\nclustering: {similarity_threshold: 1}\nborderline_review: {gray_zone: [0.8, 0.99]}\n")
    made = config.load(str(at))
    assert made.output_dir == str(tmp_path / "out") and made.frames.duration_buckets[1].max_seconds == float("inf") and made.clustering.similarity_threshold == 1.0
    assert config.load(str(at), frames={"count": 2}).frames.duration_buckets == ()  # overrides replace whole entries
    for text in ("+inf", " .INF ", "inf"):
        assert config.Bucket(text, 2).max_seconds == float("inf")
    with pytest.raises(Exception):
        made.frames.count = 4
    at.write_text("[1]")
    with pytest.raises(ValueError):
        config.load(str(at))
    at.write_text("")
    assert config.load(str(at)).frames.count == 5


def test_what_changes_nothing_is_told():
    one = config.build(config.Config, {"frames": {"count": 1}, "pooling": {"mode": "none"}, "embeddings": {"driver": "secondary", "secondary_clip": {"enabled": True}}, "search": {"index_type": "hnsw", "nlist": 7, "hnsw_m": 9}, "borderline_review": {"enabled": True, "frames_per_clip": 3}})
    heads = [n.split(":")[0] for n in one.notes()]
    assert heads == ["frames", "pooling.mode none", "borderline_review.frames_per_clip", "frames.duration_buckets", "embeddings.backend dinov2", "search.index_type hnsw", "search.nlist and nprobe", "search.hnsw_m"]
    assert config.build(config.Config, {"search": {"index_type": "ivf", "nlist": 7}, "frames": {"duration_buckets": [{"max_seconds": 5, "count": 2}]}, "borderline_review": {"enabled": True}}).notes() == []


def test_env_files(tmp_path, monkeypatch):
    text = "# A=0\n\n export A = 'x y' \nB=\"q\" r\nC=$A\nD='\n=5\nnone\nE=a=b\nexport\tF=\"\"\n"
    assert environment.parse(text) == {"A": "x y", "B": '"q" r', "C": "$A", "D": "'", "E": "a=b", "F": ""}
    inner = tmp_path / "a" / "b"
    inner.mkdir(parents=True)
    (tmp_path / ".env.local").write_text("K=far")
    assert environment.find(inner, {}) == tmp_path / ".env.local"
    (tmp_path / ".env").write_text("K=near\nL=2")
    assert environment.find(inner, {}) == tmp_path / ".env" and environment.find(inner, {environment.ENV_FILE: str(tmp_path / "none")}) is None
    own = {"K": "set"}
    assert environment.fill(start=inner, environ=own)[1] == ["L"] and own == {"K": "set", "L": "2"}
    assert environment.fill(start=inner, environ=own, override=True)[1] == ["K", "L"] and own["K"] == "near"


def test_credentials_stay_in_their_family():
    do = {"DO_SPACES_ACCESS_KEY": "da", "DO_SPACES_SECRET_KEY": "ds"}
    aws = {"AWS_ACCESS_KEY_ID": "aa", "AWS_SECRET_ACCESS_KEY": "as", "AWS_ENDPOINT_URL": "https://aws", "AWS_REGION": "r"}
    both = environment.Storage.of(do | aws | {"S3_BUCKET": "b"})
    assert (both.family, both.endpoint, both.ignored, both.bucket) == ("digitalocean", None, ("aws",), "b") and both.missing() == ["DO_SPACES_ENDPOINT"]
    assert environment.Storage.of(do | aws, "aws").hadoop() == {"spark.hadoop.fs.s3a.access.key": "aa", "spark.hadoop.fs.s3a.secret.key": "as", "spark.hadoop.fs.s3a.endpoint": "https://aws", "spark.hadoop.fs.s3a.endpoint.region": "r"}
    assert environment.Storage.of(aws, "s3").missing() == ["S3_ACCESS_KEY", "S3_SECRET_KEY", "S3_ENDPOINT_URL"]
    half = environment.Storage.of({"AWS_ACCESS_KEY_ID": "aa", "DO_SPACES_ENDPOINT": " "})
    assert half.family is None and half.access_key.reveal() == "aa"
    with pytest.raises(ValueError):
        environment.Storage.of({}, "tape")
    with pytest.raises(RuntimeError, match="DO_SPACES_ACCESS_KEY"):
        environment.Storage.of({}).required()
    own = {"AWS_ACCESS_KEY_ID": "kept"}
    assert environment.Storage.of(aws).mirror(own) == ["AWS_SECRET_ACCESS_KEY", "AWS_DEFAULT_REGION", "AWS_ENDPOINT_URL"] and own["AWS_ACCESS_KEY_ID"] == "kept"


def test_secrets_are_never_shown(tmp_path, capsys, monkeypatch):
    own = {"S3_ACCESS_KEY": "topsecret", "S3_SECRET_KEY": "topsecret", "S3_ENDPOINT_URL": "https://e", "OPENAI_API_KEY": "topsecret"}
    made = environment.Environment.load(start=tmp_path, environ=dict(own))
    assert "topsecret" not in f"{made!r}{made.described()}{made.storage.access_key}" and made.described()["judge.api_key"] == "set" and made.judge.required()
    for name in ("S3_ACCESS_KEY", "OPENAI_API_KEY", "AWS_ACCESS_KEY_ID", "DO_SPACES_ACCESS_KEY"):
        monkeypatch.delenv(name, raising=False)
    assert environment.main(["--env-file", str(tmp_path / "none"), "--require", "judge", "--require", "storage"]) == 1
    assert "topsecret" not in capsys.readouterr().out


def test_folders_from_argument_environment_and_file(tmp_path):
    (tmp_path / "c.yaml").write_text("output_dir: own\ncache_dir: kept\n")
    outside = environment.Environment.load(start=tmp_path, environ={"SIEVELINE_OUTPUT_DIR": "/env/out", "SIEVELINE_INPUT_DIR": "/in", "SIEVELINE_MANIFEST": "m.csv"})
    settled = lambda given, out: cli.settled(str(tmp_path / "c.yaml"), given, out)
    assert settled("/arg", outside).output_dir == "/arg" and settled(None, outside).output_dir == "/env/out" and settled(None, outside).cache_dir == str(tmp_path / "kept")
    bare = environment.Environment.load(start=tmp_path, environ={})
    assert settled(None, bare).output_dir == str(tmp_path / "own") and (outside.input_dir, outside.manifest, bare.manifest) == ("/in", "m.csv", None)
