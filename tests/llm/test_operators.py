"""The operators of the subpackage against brute force and on awkward rows."""

import base64
import hashlib
import random
import re
import tempfile
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from sieveline.llm import bpe, decontamination, embedding_forest, labelled, license_scan, quality, simhash, substring_dedup, token_counts, toxicity, url_filters
from sieveline.llm.common import held_out
from sieveline.operators import joins

DOCS = "doc_id long, text string, lang string, source string, n_chars long, k string, row string"
WORDS = [a + b for a in "ba ce di fo gu ha je ki lo mu".split() for b in "r st n th l ng d m x".split()]


def docs(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", 1, "clash", "clash") for i, t in texts], DOCS)


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def awkward(spark):
    rng = random.Random(1)
    return docs(spark, [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (None, "two words"), (5, prose(rng, 20000)), (6, "x" * 50000), (7, "É ñ 漢字 😀   a  b "), (8, "<|endoftext|> a")])


@pytest.fixture(scope="module")
def empty(spark):
    return docs(spark, [])


def test_fingerprint_is_its_definition():
    rng = random.Random(2)
    for text in [prose(rng, 40) + " É", "a b", "", None, "A A A A A A"]:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", low)
        hs = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]), 42) for i in range(max(1, len(words) - 3))] if words else []
        want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))
        assert simhash.fingerprint(text) == want


@pytest.mark.parametrize("chunk", [4096, 7])
def test_links_join_what_brute_force_joins(spark, chunk):
    rng = random.Random(3)
    fps = [rng.getrandbits(64) for _ in range(60)]
    fps += [f ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 6))) for f in fps for _ in range(4)]
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in fps:
        for b in fps:
            if (a ^ b).bit_count() <= 4 and find(a) != find(b):
                parent[find(a)] = find(b)
    signed = lambda f: f - (1 << 64) if f >> 63 else f
    rows = spark.createDataFrame([(signed(f),) for f in set(fps)], "fp long")
    got = simhash.links(rows, 4, chunk=chunk).collect()
    joined = {f: f for f in fps}

    def top(x):
        while joined[x] != x:
            x = joined[x]
        return x

    for r in got:
        joined[top(r["a"] % (1 << 64))] = top(r["b"] % (1 << 64))
    groups = lambda f: sorted(sorted(x for x in set(fps) if f(x) == r) for r in {f(x) for x in fps})
    assert groups(find) == groups(top)


def test_near_duplicates_of_awkward_rows(spark, awkward, empty):
    got = simhash.near_duplicates(awkward).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == 10 and by[1]["fingerprint"] == "0" * 16 and {by[i]["component_id"] for i in (1, 2, 3)} == {1} and by[None]["component_id"] is None
    assert simhash.near_duplicates(empty).count() == 0


def test_url_filters(spark):
    urls = ["http://a.ORG", "http://a.org/x", "x.example.org/es/", "http://www.example.org/es/1?x", "http://example.org/en/12", "https://b.com/de/", "https://com/fr/a#b", None, "", "ftp://h/login", "http://q/a?x=1&utm_medium=cpc"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = [(r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filters.judged(pages).orderBy("page_id").collect()]
    assert got == [
        ("a.org", "", None, "allow"), ("a.org", "/x", "org/", "allow"), ("", "", None, "allow"), ("www.example.org", "/es/1", "example.org/es/", "block"), ("example.org", "/en/12", "example.org/en/1", "block"),
        ("b.com", "/de/", "com/de/", "block"), ("com", "/fr/a", "com/fr/", "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("h", "/login", None, "block"), ("q", "/a", None, "block"),
    ]
    for p in url_filters.PATTERNS:  # the index loses nothing that running every pattern would find
        assert all(t in url_filters.TOKEN.findall(p) for t in url_filters.tokens_of(p))
    assert url_filters.judged(pages.limit(0)).count() == 0


def test_classifiers(spark, awkward, empty):
    rng = random.Random(4)
    rows, marks = [], []
    for i in range(400):
        text, bad = prose(rng, 60), i % 4 == 0
        rows.append((i, text.upper().replace(" ", "!! ") + " stupid idiot you moron" if bad else text))
        marks.append((i, int(not bad), int(bad)))
    labels = spark.createDataFrame([*marks, (9999, None, None)], "doc_id long, quality int, toxic int")
    for op, target in ((quality, 1), (toxicity, 2)):
        got = op.classified(docs(spark, rows), labels).collect()
        out = [r["predicted"] == marks[r["doc_id"]][target] for r in got if r["held_out"]]
        assert sum(out) >= 0.95 * len(out) and all(0 <= r["score"] <= 1 for r in got)
        more = op.classified(awkward.unionByName(docs(spark, [(i + 100, t) for i, t in rows])), spark.createDataFrame([(a + 100, b, c) for a, b, c in marks], "doc_id long, quality int, toxic int"))
        assert more.count() == 410 and more.where("score is null").count() == 0
        assert op.classified(empty, labels).count() == 0 and op.classified(awkward, labels.limit(0)).count() == 10
    assert spark.range(3).select(held_out("id").alias("h")).count() == 3


def test_embeddings_match_brute_force(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((40, 16))
    vecs = np.concatenate([base, base[:20] + 0.02 * rng.standard_normal((20, 16)), base[:5], base[:1] + 0.01 * rng.standard_normal((60, 16))])
    labels = rng.integers(0, 2, len(vecs)).tolist()
    rows = [(i, [float(np.float32(x)) for x in v], la) for i, (v, la) in enumerate(zip(vecs, labels))]
    rows += [(200, [0.0] * 16, 0), (201, None, 0), (202, [float("nan")] * 16, 0), (203, [None] * 16, 1), (204, rows[0][1], None), (205, [1.0], 0), (206, [2.0], 0)]
    got = {r["vec_id"]: r for r in embedding_forest.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    u = np.array([r[1] for r in rows[: len(vecs)]])
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    near = (u @ u.T >= 0.98) & (np.array(labels)[:, None] == np.array(labels)[None, :])
    np.fill_diagonal(near, False)
    assert [got[i]["n_links"] for i in range(len(vecs))] == near.sum(1).tolist()
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i in (200, 201, 202, 203, 204)) and got[206]["component_id"] == 205
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_forest.near_duplicates(none).count() == 0


def test_token_counts(spark, awkward, empty, monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.json")
    own = Tokenizer.from_file(path)
    got = token_counts.token_counts(awkward, path).collect()
    want = sorted((t["doc_id"] or -1, len((t["text"] or "").encode()), len(own.encode(t["text"] or "", add_special_tokens=False).ids)) for t in awkward.collect())
    assert sorted((r["doc_id"] or -1, r["n_bytes"], r["n_tokens"]) for r in got) == want
    assert token_counts.token_counts(empty, path).count() == 0
    rng = random.Random(15)
    texts = [prose(rng, 4000), "x" * 9000, prose(rng, 900) + "é\u3000 a\u00a0 b \n c “d” e" * 50 + "<|endoftext|> a <|endoftext|>", None, "漢字" * 3000]
    for batch in (token_counts.BATCH, 40):
        monkeypatch.setattr(token_counts, "BATCH", batch)
        counted = token_counts.Counter(path).count(pa.array(texts))
        assert counted.tolist() == [len(own.encode(t or "", add_special_tokens=False).ids) for t in texts]
        assert token_counts.Counter(path).count(pa.array([None, ""], pa.string())).tolist() == [0, 0]
    assert token_counts.token_counts(awkward, public_tokenizers.path("piece_bpe_32k.model")).count() == 10


def test_bpe_is_the_library_s(spark, awkward, empty, monkeypatch):
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(6)
    texts = ["".join(rng.choice("ab  \n\t'stéñ1.! \x1c\x85漢😀") for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += ["漢字" * 700, "ab" * 900, "a" * 333, " x" * 300, "".join(rng.choice("abcdefghij0123456789+/") for _ in range(5000)), ""]
    vocab = bpe.Vocabulary(path, pattern, kept_bytes=20_000)  # begins anew again and again
    held = []
    for i in range(0, len(texts), 100):
        part = texts[i : i + 100]
        ids, ends = vocab.encode(pa.array(part))
        assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == [library.encode_ordinary(t) for t in part]
        assert bytes(vocab.decode(ids)).decode() == "".join(part)
        held.append(vocab.held)
    assert max(held) <= 20_000 + 300 * sum(map(len, texts[-206:]))  # the bound, and one slice
    for many in (1, 10**9):  # buckets by arrays alone, and place by place alone
        monkeypatch.setattr(bpe, "MANY", many)
        ids, ends = bpe.Vocabulary(path, pattern).encode(pa.array([*texts, None]))
        assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == [library.encode_ordinary(t or "") for t in [*texts, None]]
    for r in bpe.digests(awkward, path, pattern).join(awkward.select("doc_id", "text").distinct(), "doc_id").collect():
        ids = library.encode_ordinary(r["text"] or "")
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()
    assert bpe.digests(empty, path, pattern).count() == 0
    for r in bpe.encoded(awkward, path, pattern).join(awkward.select("doc_id", "text").distinct(), "doc_id").collect():
        assert r["ids"] == library.encode_ordinary(r["text"] or "") and bytes(r["decoded"]).decode() == (r["text"] or "")


@pytest.mark.parametrize("many", [1, 48])
def test_bpe_of_ranks_that_fall(monkeypatch, many):
    """Merges whose result has a lower rank than their parts, against the lowest rank first, from the left."""
    monkeypatch.setattr(bpe, "MANY", many)
    rng = random.Random(16)
    for _ in range(30):
        texts = {bytes([i]) for i in range(256)} | {bytes(rng.choice(b"abc") for _ in range(rng.randint(2, 4))) for _ in range(25)}
        order = [bytes([i]) for i in range(256)] + rng.sample(sorted(t for t in texts if len(t) > 1), sum(len(t) > 1 for t in texts))
        ranks = {t: i for i, t in enumerate(order)}

        def plain(raw, ranks=ranks):
            own = [raw[i : i + 1] for i in range(len(raw))]
            if raw in ranks:
                return [ranks[raw]]
            while True:
                found = min(((ranks[a + b], i) for i, (a, b) in enumerate(zip(own, own[1:])) if a + b in ranks), default=None)
                if found is None:
                    return [ranks[x] for x in own]
                i = found[1]
                own[i : i + 2] = [own[i] + own[i + 1]]

        with tempfile.NamedTemporaryFile("wb", suffix=".tiktoken") as f:
            f.writelines(base64.b64encode(t) + b" %d\n" % i for t, i in ranks.items())
            f.flush()
            words = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 30))) for _ in range(80)]
            ids, ends = bpe.Vocabulary(f.name, public_tokenizers.PATTERN).encode(pa.array(words))
        assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == [plain(w.encode()) for w in words]


@pytest.mark.parametrize("in_plan", [20_000, 0])
def test_leaks(spark, awkward, empty, in_plan):
    rng = random.Random(7)
    items = [(i, prose(rng, n)) for i, n in enumerate([12, 30, 60, 30, 3])] + [(8, None), (9, "")]
    near = items[2][1].split()
    near[0] = "other"
    rows = [(100, f"{prose(rng, 50)} {items[0][1]} {prose(rng, 9)}"), (101, items[1][1].upper()), (102, f"{prose(rng, 70)}\n{' '.join(near)}!"), (103, prose(rng, 500)), (104, "zz " + items[4][1] + " zz"), (105, " ".join(items[3][1].split()[:15]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in decontamination.leaks(docs(spark, rows).unionByName(awkward), bench, in_plan=in_plan).collect()}
    assert set(got) == {(100, 0), (101, 1), (102, 2), (104, 4)}
    assert got[100, 0]["start"] == 50 and got[100, 0]["similarity"] == 1 and got[102, 2]["similarity"] == pytest.approx(55 / 57)
    kept = decontamination.without_leaks(docs(spark, rows), bench)
    assert sorted(r["doc_id"] for r in kept.collect()) == [103, 105] and kept.columns == docs(spark, rows).columns
    assert decontamination.leaks(empty, bench).count() == 0 and decontamination.leaks(awkward, bench.limit(0)).count() == 0


def test_license_scan(spark, awkward, empty):
    texts = ["x Licensed under the\nApache License, Version 2.0.", "CC-BY cc by", "All rights reserved. Copyright (c) 2020 A B. All rights reserved", "the General Public License", "nothing", "permission is hereby denied"]
    got = [(r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"]) for r in license_scan.licenses(docs(spark, list(enumerate(texts)))).orderBy("doc_id").collect()]
    assert got == [(0, None, None, "", "apache-2.0"), (2, 0, 2, "cc-by", "cc-by"), (2, 0, 8, "reserved", "notice,reserved"), (1, 1, 1, "gpl", "gpl"), (0, None, None, "", ""), (0, None, None, "", "")]
    assert license_scan.licenses(awkward).count() == 10 and license_scan.licenses(empty).count() == 0
    a = license_scan.Automaton("a [b [c]] {2} d")
    assert [a.accept(x.split(), 0) for x in ("a d", "a b c d", "a x y d", "a x y z d", "b")] == [2, 4, 4, None, None]
    for wrong in ("[a", "a]", "[a] {2}"):
        with pytest.raises(ValueError):
            license_scan.Scanner([("x", wrong)])


def test_license_templates_need_their_whole_wording():
    scanner = license_scan.Scanner()
    for label, template in license_scan.TEMPLATES:
        words = re.sub(r"\[[^\[\]]*\]", "", re.sub(r"\[[^\[\]]*\]", "", re.sub(r"\{\d+\}", "", template))).split()
        whole = " ".join(words)
        assert label in scanner.scan(f"A b. {whole.upper()}, c")[5].split(",")
        for i in {0, len(words) // 2, len(words) - 1} - ({0} if label == "mit" else set()):
            assert label not in scanner.scan(" ".join([*words[:i], "other", *words[i + 1 :]]))[5].split(",")


def test_license_automata_against_all_expansions():
    rng = random.Random(22)

    def grow(depth):
        out = []
        for _ in range(rng.randint(1, 4)):
            kind = rng.randrange(4 if depth < 2 else 2)
            out.append("{%d}" % rng.randint(1, 2) if kind == 2 else ["["] + grow(depth + 1) + ["]"] if kind == 3 else rng.choice("ab"))
        return out

    def expand(parts):
        ways = [()]
        for p in parts:
            own = [()] + expand(p[1:-1]) if isinstance(p, list) else [("*",) * k for k in range(int(p[1]) + 1)] if p[0] == "{" else [(p,)]
            ways = [x + y for x in ways for y in own]
        return ways

    flat = lambda p: " ".join(flat(x) if isinstance(x, list) else x for x in p)
    for _ in range(150):
        parts = ["a", *grow(0)]
        automaton, ways = license_scan.Automaton(flat(parts)), expand(parts)
        words = [rng.choice("aabbc") for _ in range(12)]
        for at in range(12):
            ends = [at + len(x) for x in ways if len(x) <= 12 - at and all(y in ("*", w) for y, w in zip(x, words[at:]))]
            assert automaton.accept(words, at) == max(ends, default=None)


def test_license_phrases_against_brute_force(spark):
    rng = random.Random(23)
    vocab = "cc by general public license all rights reserved CC-BY x copyright mit under the é".split()
    rows = [(i, "".join(rng.choice(vocab) + rng.choice([" ", " ", "-", ", ", "\n"]) for _ in range(rng.choice([0, 3, 40, 400])))) for i in range(60)]
    rows.append((60, " ".join(rng.choice(vocab) for _ in range(30000))))
    got = {r["doc_id"]: r for r in license_scan.licenses(docs(spark, [*rows, (61, None)])).collect()}
    for i, text in rows:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        starts = [(j, label) for p, label in license_scan.PHRASES for j in range(len(words)) if words[j : j + len(p.split())] == p.split()]
        r = got[i]
        places = [j for j, _ in starts]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (len(words), len(starts), min(places, default=None), max(places, default=None))
        assert r["base_labels"] == ",".join(sorted({x for _, x in starts})) and set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
    assert got[61]["n_words"] == 0


def test_substring_dedup(spark, awkward, empty):
    rng = random.Random(8)
    shared = prose(rng, 80)
    rows = [(i, f"{prose(rng, 90)} {shared} {prose(rng, 70)}" if i < 5 else prose(rng, 200)) for i in range(12)]
    table = docs(spark, rows)
    got = substring_dedup.repeats(table).collect()
    assert {r["doc_id"] for r in got} == set(range(5)) and sum(r["removed_words"] == 0 for r in got) == 1
    left = {r["doc_id"]: r["text"] for r in substring_dedup.without_repeats(table).collect()}
    assert len(left) == 12 and all(left[i] == t for i, t in rows[5:])
    middle = " ".join(shared.split()[25:55])
    assert sum(middle in left[i] for i in range(5)) == 1
    out = substring_dedup.without_repeats(awkward)
    assert out.count() == 10 and out.columns == awkward.columns and substring_dedup.without_repeats(empty).count() == 0
    assert substring_dedup.without_repeats(table.unionByName(table)).count() == 24


def test_substring_dedup_of_one_word_over_and_over(spark):
    rng = random.Random(9)
    table = docs(spark, [(i, f"{prose(rng, 40)} {w * n}{prose(rng, 40)}") for i, (w, n) in enumerate([("the ", 90), ("the ", 300), ("red the ", 70), ("red the ", 200), ("lone ", 200)])])
    got = substring_dedup.repeats(table).collect()
    assert {r["doc_id"] for r in got} == {0, 1, 2, 3} and sum(r["removed_words"] > 0 for r in got) == 2


def test_leaks_against_every_window(spark):
    """Items with words changed, dropped and put in, of a similarity about 0.8, against all windows of the item's length."""
    rng = random.Random(19)
    sizes = [13, 22, 31, 49, 76, 80]
    items = [(i, prose(rng, sizes[i % 6])) for i in range(60)]
    items += [(60, " ".join(["the"] * 30 + ["of"] * 10)), (61, items[0][1])]
    rows = []
    for i, (_, t) in enumerate(items):
        for _ in range(6):
            w = t.split()
            spare = max(1, len(w) // 8)
            how = rng.randrange(4)
            if how == 0:  # the edges
                n = rng.randint(0, spare)
                w[: n // 2] = prose(rng, n // 2).split()
                w[len(w) - (n - n // 2) :] = prose(rng, n - n // 2).split()
            elif how == 1:
                w[rng.randrange(len(w))] = "changed"
            elif how == 2:
                at = rng.randrange(len(w))
                w[at:at] = prose(rng, rng.randint(1, 3)).split()
            else:
                del w[rng.randrange(len(w))]
            rows.append((len(rows), f"{prose(rng, rng.choice([0, 5, 40]))} {' '.join(w)} {prose(rng, rng.choice([0, 5, 40]))}"))
    bag = lambda w: Counter(zip(*(w[j:] for j in range(5))))
    want = set()
    for d, t in rows:
        w = t.split()
        for i, x in items:
            own, n = bag(x.split()), len(x.split())
            if not own.keys() & bag(w).keys():
                continue
            for s in range(max(1, len(w) - n + 1)):
                other = bag(w[s : s + n])
                if sum((own & other).values()) >= 0.8 * sum((own | other).values()):
                    want.add((d, i))
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.leaks(docs(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == want and len(want) > 200
    assert decontamination.radius_for(0.8) == 23 and decontamination.radius_for(1.0) == 0


def test_rows_without_leaks_go_by_id_and_text(spark):
    rng = random.Random(20)
    item = prose(rng, 40)
    table = docs(spark, [(1, item), (1, prose(rng, 50)), (None, item), (None, prose(rng, 50)), (2, item), (2, item), (3, None)]).withColumnRenamed("k", "key")
    kept = decontamination.without_leaks(table, spark.createDataFrame([(0, item), (0, item)], "item_id long, text string"))
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "3", "None"] and kept.columns == table.columns and {r["key"] for r in kept.collect()} == {"clash"}


def test_leaks_of_short_items_in_a_row(spark):
    rng = random.Random(10)
    items = [(i, prose(rng, 7)) for i in range(9)]
    text = " ".join(t for _, t in items)
    got = decontamination.leaks(docs(spark, [(1, text)]), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {r["item_id"] for r in got} == set(range(9))


@pytest.mark.parametrize("in_plan", [decontamination.IN_PLAN, 2])
def test_leaks_that_the_text_s_edges_cut_off(spark, in_plan):
    rng = random.Random(11)
    items = [(i, prose(rng, n)) for i, n in enumerate([60, 60, 30, 14])]
    own = [t.split() for _, t in items]
    rows = [(1, f"{' '.join(own[0][3:])} {prose(rng, 40)}"), (2, f"{prose(rng, 40)} {' '.join(own[1][:-3])}"), (3, " ".join(own[2][1:])), (4, " ".join(own[3][:-1])), (5, " ".join(own[2][:20])), (6, " ".join(own[0][20:]) + " " + prose(rng, 40))]
    got = decontamination.leaks(docs(spark, rows), spark.createDataFrame(items, "item_id long, text string"), in_plan=in_plan).collect()
    found = {(r["doc_id"], r["item_id"]): (r["start"], r["n_words"], r["similarity"]) for r in got}
    assert found == {(1, 0): (0, 60, pytest.approx(53 / 59)), (2, 1): (37, 60, pytest.approx(53 / 59)), (3, 2): (0, 29, pytest.approx(25 / 26)), (4, 3): (0, 13, pytest.approx(9 / 10))}


def test_substring_dedup_within_one_document(spark):
    rng = random.Random(12)
    twice = prose(rng, 80)
    rows = [(1, f"{prose(rng, 40)} {twice} {prose(rng, 50)} {twice} {prose(rng, 40)} {twice}"), (2, prose(rng, 200))]
    table = docs(spark, rows)
    assert substring_dedup.repeats(table.unionByName(table)).count() == 0  # equal rows are one document
    got = substring_dedup.repeats(table.unionByName(table), within=True).collect()
    assert [r["doc_id"] for r in got] == [1, 1] and all(r["n_spans"] == 2 for r in got)
    left = {r["doc_id"]: r["text"] for r in substring_dedup.without_repeats(table, within=True).collect()}
    middle = " ".join(twice.split()[20:60])
    assert left[1].count(middle) == 1 and left[2] == rows[1][1]


def test_substring_dedup_keeps_one_whole_copy(spark):
    rng = random.Random(17)
    p = prose(rng, 60).split()
    parts = [p[a : a + n] for a in range(0, 30, 3) for n in (13, 20, 30, 30)]
    rows = [(i, f"{prose(rng, 70)} {' '.join(p)} {prose(rng, 60)}") for i in range(2)] + [(10 + i, f"{prose(rng, 50)} {' '.join(x)} {prose(rng, 50)}") for i, x in enumerate(parts)]
    left = {r["doc_id"]: r["text"] for r in substring_dedup.without_repeats(docs(spark, rows)).collect()}
    assert sum(" ".join(p) in x for x in left.values()) == 1 and sum(" ".join(p[15:50]) in x for x in left.values()) == 1
    assert all(len(rows[i][1].split()) - len(x.split()) in (0, *range(25, 61)) for i, x in ((j, left[j]) for j in range(2)))
    assert all(left[i] == t for i, t in rows[2:] if len(parts[i - 10]) < 25)


@pytest.mark.parametrize("heavy", [10_000, 3])
def test_substring_dedup_against_all_shared_windows(spark, monkeypatch, heavy):
    """What two documents share is listed; every window that repeats stays whole somewhere; nothing else is touched."""
    monkeypatch.setattr(substring_dedup, "HEAVY", heavy)
    rng = random.Random(18)
    pool = [prose(rng, n) for n in (51, 60, 80, 120, 200)]
    long = pool[4].split()
    pool += [" ".join(long[:90]), " ".join(long[60:150]), " ".join(long[100:])]
    rows = []
    for i in range(70):
        own = [prose(rng, rng.randint(30, 90))]
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            own += [rng.choice(pool), prose(rng, rng.randint(0, 60))]
        rows.append((i, " ".join(own)))
    holders = {}
    for i, t in rows:
        w = t.split()
        for j in range(len(w) - 50):
            holders.setdefault(tuple(w[j : j + 51]), set()).add(i)
    sharing = {i for h in holders.values() if len(h) > 1 for i in h}
    table = docs(spark, rows)
    listed = {r["doc_id"]: r for r in substring_dedup.repeats(table).collect()}
    short = {r[0] for r in rows} - sharing
    assert sharing <= set(listed) and len(set(listed) & short) <= 1
    assert all(s["size"] > 0 for r in listed.values() for s in r["spans"])
    left = {r["doc_id"]: r["text"] for r in substring_dedup.without_repeats(table).collect()}
    place = {}
    for i, t in rows:
        digest, begin, _, size, _ = substring_dedup._windows(t.encode(), substring_dedup.MIN_WORDS) or ((),) * 5
        for d, b, s in zip(digest, begin, size):
            place.setdefault(int(d), []).append((i, t.encode()[b : b + s].decode().strip()))
    for own in place.values():
        if len({i for i, _ in own}) > 1:
            assert len({x for _, x in own}) == 1 and any(own[0][1] in left.get(i, "") for i, _ in own)
    for i, t in rows:
        gone = len(t.split()) - len(left.get(i, "").split())
        assert gone == (listed[i]["removed_words"] if i in listed else 0) and (gone == 0 or gone >= substring_dedup.MIN_WORDS)
    words_of = [w for t in left.values() for w in zip(*(t.split()[j:] for j in range(51)))]
    assert len(words_of) - len(set(words_of)) < 0.1 * sum(len(h) - 1 for h in holders.values() if len(h) > 1)


def test_capitals_have_one_definition_at_every_length():
    for text in ["É Ñ a B ç", "Ça VA Été ÑU 漢 " * 400, "ABC def " * 600, ""]:
        assert toxicity.features(text, {}, frozenset())[9] == sum(map(str.isupper, text)) / max(1, len(text))


def test_one_row_of_each_group_goes_on_in_the_pipeline(spark, empty):
    rng = random.Random(13)
    a, b, c, d, e = (prose(rng, 300) for _ in range(5))
    table = docs(spark, [(3, a), (3, a), (2, a + " end"), (7, b), (7, b), (None, a), (None, c), (None, c), (None, c), (5, d), (6, e), (6, c[::-1])])
    out = corpus_pipeline.simhash_dedup(spark, table, "")
    want = [("2", a + " end"), ("5", d), ("6", c[::-1]), ("6", e), ("7", b), ("None", c)]
    assert sorted((str(r["doc_id"]), r["text"]) for r in out.collect()) == sorted(want) and out.columns == table.columns
    assert corpus_pipeline.simhash_dedup(spark, empty, "").count() == 0


def test_trees_split_whatever_the_longest_vector(spark, monkeypatch):
    rng = np.random.default_rng(14)
    base = rng.standard_normal((80, 16))
    vecs = np.concatenate([base, base + 0.01 * rng.standard_normal((80, 16))])
    rows = [(i, [float(np.float32(x)) for x in v], 0) for i, v in enumerate(vecs)] + [(900, [1.0] * 17, 0)]
    grown = []

    class Watched(embedding_forest.Tree):
        def __init__(self, *how):
            super().__init__(*how)
            grown.append(self.leaves)

    monkeypatch.setattr(embedding_forest, "LEAF", 20)
    monkeypatch.setattr(embedding_forest, "Tree", Watched)
    got = {r["vec_id"]: r for r in embedding_forest.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    u = np.array([r[1] for r in rows[:-1]])
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    near = u @ u.T >= 0.98
    np.fill_diagonal(near, False)
    assert len(grown) == embedding_forest.TREES and all(n >= 4 for n in grown)
    assert [got[i]["n_links"] for i in range(len(vecs))] == near.sum(1).tolist() and got[900]["n_links"] == 0


@pytest.mark.parametrize("chunk", [2048, 300])
def test_forest_against_all_pairs(spark, monkeypatch, chunk):
    """10,000 vectors with pairs on both sides of the threshold, and a clump of 700 near one another; far fewer comparisons than pairs."""
    monkeypatch.setattr(embedding_forest, "CHUNK", chunk)
    rng = np.random.default_rng(21)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    base = unit(rng.standard_normal((8000, 64)))
    cosine = rng.uniform(0.96, 1.0, 1300)[:, None]
    aside = rng.standard_normal((1300, 64))
    aside = unit(aside - (aside * base[:1300]).sum(1, keepdims=True) * base[:1300])
    clump = unit(base[7000] + rng.standard_normal((700, 64)) * 0.009)
    vecs = np.concatenate([base, cosine * base[:1300] + np.sqrt(1 - cosine**2) * aside, clump]).astype(np.float32)
    labels = np.concatenate([np.arange(8000) % 3, np.where(np.arange(1300) % 10 == 0, 5, np.arange(1300) % 3), np.full(700, 7000 % 3)])
    rows = spark.createDataFrame([(i, v.tolist(), int(la), "x") for i, (v, la) in enumerate(zip(vecs, labels))], "vec_id long, embedding array<float>, label int, key string")
    got = {r["vec_id"]: r for r in embedding_forest.near_duplicates(rows).collect()}
    u = unit(vecs.astype(np.float64))
    near = (u @ u.T >= 0.98) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(near, False)
    want = near.sum(1)
    assert len(got) == len(vecs) and sum(got[i]["n_links"] for i in got) >= 0.9999 * want.sum() and all(got[i]["n_links"] <= want[i] for i in got)
    assert want.sum() > 400_000 and sum(got[i]["component_id"] == i for i in got) == sum(got[i]["kept"] for i in got)
    rng = np.random.default_rng(17)
    spill = float(np.sqrt(0.04 / 64) / 2)
    forest = [embedding_forest.Tree(u, 6, spill, rng) for _ in range(embedding_forest.TREES)]
    compared = sum((np.bincount(tree.lead(u[labels == la])[1]) ** 2).sum() / 2 for tree in forest for la in range(3))
    assert compared < 0.5 * sum((labels == la).sum() ** 2 / 2 for la in range(3))


def test_embeddings_of_awkward_rows(spark):
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (2, [-0.0, 1.0], 2), (3, [0.0, 1.0], 2), (4, [0.0, 2.0], 2), (5, [], 2), (None, None, None)]
    got = sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"]), r["kept"]) for r in embedding_forest.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect())
    assert got == [("1", 2, "1", True), ("1", 2, "1", True), ("2", 2, "2", True), ("3", 2, "2", False), ("4", 2, "2", False), ("5", 0, "5", True), ("None", 0, "None", False), ("None", 2, "1", False)]


def test_dual_coordinate_descent_reaches_the_optimum():
    """The weights minimise the hinge loss with its ridge: against a plain subgradient method, and by the gap to the dual."""
    rng = np.random.default_rng(24)
    n, dims = 60, 30
    rows = [np.sort(rng.choice(dims, rng.integers(3, 9), replace=False)).astype(np.int32) for _ in range(n)]
    y = np.array([int(5 in r or rng.random() < 0.3) for r in rows])
    calibrate = np.arange(n) % 5 == 0
    use = np.flatnonzero(~calibrate)
    weights, slope, _ = quality.fit(rows, y, calibrate, epochs=400)
    p, q = np.ones(quality.DIM), np.ones(quality.DIM)
    for i in use:
        for f in rows[i]:
            (p if y[i] else q)[f] += 1
    ratio = np.log(p / p.sum()) - np.log(q / q.sum())
    assert np.allclose(weights[1], ratio, atol=1e-5) and slope > 0
    x = np.zeros((n, dims + 1))
    for i, r in enumerate(rows):
        x[i, r] = ratio[r] / np.linalg.norm(ratio[r])
    x[:, dims] = 1
    sign, cost = np.where(y == 1, 1.0, -1.0), np.where(y == 1, 0.5 / y[use].mean(), 0.5 / (1 - y[use].mean()))
    loss = lambda w: 0.5 * w @ w + (cost[use] * np.maximum(0, 1 - sign[use] * (x[use] @ w))).sum()
    w, best = np.zeros(dims + 1), np.inf
    for t in range(1, 40000):
        out = sign[use] * (x[use] @ w) < 1
        w = w - (w - ((cost * sign)[use][out, None] * x[use][out]).sum(0)) / t
        best = min(best, loss(w))
    with np.errstate(divide="ignore", invalid="ignore"):
        own = np.where(ratio[:dims] != 0, weights[0][:dims] / ratio[:dims], 0.0)
    bias = min((loss(np.append(own, b)), b) for b in np.linspace(-3, 3, 6001))[1]
    assert loss(np.append(own, bias)) <= best * 1.002


def test_features_of_quality_are_all_n_grams():
    held = np.zeros(quality.DIM, dtype=bool)
    text = "Ab 1.\tÉ" * 3
    raw = text.encode()
    want = {(int.from_bytes(raw[i : i + 3], "little") * 2654435761 % 2**32) >> 15 for i in range(len(raw) - 2)}
    got = quality.active(text, held)
    assert set(got[got < quality.BYTE_GRAMS].tolist()) == want and not held.any()
    long = "xyz é " * 300_000  # longer than the parts that it is read in
    assert set(quality.active(long, held).tolist()) >= set(quality.active("xyz é " * 3, held)[:-3].tolist()) - set(range(quality.EXTRA, quality.DIM))
    assert not len(quality.active("", held))


def test_trees_split_where_the_gain_is_largest():
    rng = np.random.default_rng(25)
    x = rng.integers(0, 12, (200, 4)).astype(float)
    y = (x[:, 2] + rng.normal(0, 2, 200) > 6).astype(int)
    model = toxicity.Trees(rounds=1, depth=1, least=0.0).fit(x, y)
    p = y.mean()
    g, h = p - y, np.full(200, p * (1 - p))

    def gain(left):
        part = lambda m: g[m].sum() ** 2 / (h[m].sum() + model.ridge)
        return part(left) + part(~left) - part(np.ones(200, bool))

    best = max(gain(x[:, j] < c) for j in range(4) for c in range(1, 12))
    feature, cut, value = model.trees[0]
    left = model._bin(x)[:, feature[0]] <= cut[0]
    assert gain(left) == pytest.approx(best)
    leaf = lambda m: -g[m].sum() / (h[m].sum() + model.ridge) * model.rate
    assert np.allclose(model.predict(x), model.start + np.where(left, leaf(left), leaf(~left)))


def test_isotonic_steps_against_min_max():
    rng = np.random.default_rng(26)
    x, y = np.round(rng.normal(size=80), 1), rng.integers(0, 2, 80)
    at, value = labelled.isotonic(x, y)
    xs = np.unique(x)
    sums, counts = np.array([y[x == v].sum() for v in xs]), np.array([(x == v).sum() for v in xs])
    mean = lambda i, j: sums[i : j + 1].sum() / counts[i : j + 1].sum()
    want = [max(min(mean(i, j) for j in range(k, len(xs))) for i in range(k + 1)) for k in range(len(xs))]
    block = np.searchsorted(at, xs, side="right") - 1
    pooled = [sums[block == b].sum() / counts[block == b].sum() for b in range(len(at))]
    assert np.allclose([pooled[b] for b in block], want) and (np.diff(value) >= 0).all()


def test_training_rows_are_the_first_by_hash(spark):
    rng = random.Random(27)
    table = docs(spark, [(i, prose(rng, 5)) for i in range(3000)] + [(5, None), (None, "x")])
    labels = spark.createDataFrame([(i, i % 2) for i in range(3000)] + [(7, 1), (None, 1), (8, None)], "doc_id long, quality int")
    drawn = sorted(tuple(r) for r in labelled.training_rows(table, labels, "quality", 200).collect())
    ids = labels.where("doc_id is not null and quality is not null and crc32(cast(cast(doc_id as string) as binary)) % 5 <> 0").groupBy("doc_id").agg({"quality": "max"}).toDF("doc_id", "y")
    first = ids.selectExpr("doc_id", "y", "xxhash64(doc_id) as h").orderBy("h", "doc_id").limit(200)
    want = sorted((r["text"] or "", r["y"], r["part"]) for r in table.join(first, "doc_id").selectExpr("text", "y", "cast(pmod(xxhash64(doc_id, 1), 10L) as int) as part").collect())
    assert drawn == want and len(drawn) >= 200


def test_url_filters_of_awkward_rows(spark):
    long = "http://a.example.org/es/" + "x/" * 40000 + "login?" + "p=1&" * 20000
    rows = [(1, long), (1, long), (None, "HTTP://EXAMPLE.ORG/en/1"), (2, "://"), (3, "http://?q#f"), (4, "http://notexample.org/es/"), (5, "http://org"), (6, "http://fr.com/fr/de/")]
    pages = spark.createDataFrame([(i, u, "clash", "clash") for i, u in rows], "page_id long, url string, host string, verdict string")
    got = sorted((str(r["page_id"]), r["host"], r["path"][:8], r["rule"], r["verdict"]) for r in url_filters.judged(pages).collect())
    assert got == sorted([("1", "a.example.org", "/es/x/x/", "example.org/es/", "block")] * 2 + [("None", "example.org", "/en/1", "example.org/en/1", "block"), ("2", "", "", None, "allow"), ("3", "", "", None, "allow"), ("4", "notexample.org", "/es/", "org/", "allow"), ("5", "org", "", None, "allow"), ("6", "fr.com", "/fr/de/", "com/fr/", "allow")])


def test_features_of_very_long_texts_are_rates():
    weights = {"stup": 3.0}
    part = "You STUPID fool! i d i o t, h*te. "
    one, many = (toxicity.features(part * n, weights, frozenset(["stup"])) for n in (1, 5000))
    assert [round(a, 2) for i, a in enumerate(one) if i in (0, 2, 5, 9, 11, 13)] == [round(a, 2) for i, a in enumerate(many) if i in (0, 2, 5, 9, 11, 13)]


def test_leaks_of_equal_items_and_of_a_radius(spark):
    rng = random.Random(28)
    item = prose(rng, 30)
    bench = spark.createDataFrame([(1, item), (1, item), (2, item), (None, item)], "item_id long, text string")
    got = sorted((str(r["doc_id"]), str(r["item_id"])) for r in decontamination.leaks(docs(spark, [(1, item), (1, item), (None, item)]), bench).collect())
    assert got == sorted((d, i) for d in ("1", "None") for i in ("1", "2", "None"))
    near = item.split()[:-1] + ["other"]
    assert decontamination.leaks(docs(spark, [(1, " ".join(near))]), bench, radius=0).count() == 0


@pytest.mark.parametrize("heavy", [10_000, 2])
def test_near_duplicates_against_all_pairs(spark, monkeypatch, heavy):
    """Chains and stars of texts with few words changed, and many copies of one, against every pair of fingerprints."""
    monkeypatch.setattr(joins, "HEAVY", heavy)
    rng = random.Random(29)
    rows = []
    for _ in range(25):
        words = prose(rng, 150).split()
        for _ in range(rng.randint(1, 8)):
            rows.append((rng.randrange(10**6), " ".join(words)))
            words[rng.randrange(150)] = rng.choice(WORDS)
    rows += [(10**6 + i, rows[0][1]) for i in range(40)]
    got = {r["doc_id"]: r for r in simhash.near_duplicates(docs(spark, rows)).collect()}
    fps = {i: simhash.fingerprint(t) for i, t in rows}
    top = {i: i for i in fps}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in fps:
        for b in fps:
            if (fps[a] ^ fps[b]).bit_count() <= 4 and find(a) != find(b):
                top[max(find(a), find(b))] = min(find(a), find(b))
    assert {i: (r["fingerprint"], r["component_id"]) for i, r in got.items()} == {i: (f"{fps[i]:016x}", find(i)) for i in fps}
    assert 3 < len({find(i) for i in fps}) < len(fps) - 40
