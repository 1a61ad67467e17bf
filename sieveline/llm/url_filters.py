"""URL filters: host rules, and patterns indexed by their rarest literal token.

A pattern is literal text with ``*`` for any run of characters and ``^`` for one that is
neither letter nor digit, or the end. Its tokens are the runs of letters and digits that
it states in full, bounded on both sides; a URL that the pattern fits has each of them.
Each pattern is filed under the token that the fewest URLs have, a URL's own tokens fetch
candidate patterns, and only these run their regular expressions. A pattern without such
a token is a candidate for every URL.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.llm.common import TO_LOWER, only

#: Fixed values: (verdict, host and path) of the host rules.
HOST_RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
#: The default block patterns: sign-in and shop pages, trackers, listings, adult and betting sites.
PATTERNS = (
    "/login^", "/signin^", "/register^", "/cart^", "/checkout^", "/wp-admin^", "/cgi-bin/", "^utm_medium=cpc^", "^sessionid=", "^page=*^ref=", "^sort=*^filter=",
    "/tag/", "/search^", "/casino^", ".casino^", "/porn", ".xxx^", "/poker^", "/viagra^", "/track^*id=", "doubleclick.net^", "/print/", "^replytocom=", "/feed^", "/ads/",
)
TOKEN = re.compile("[a-z0-9]+")


def to_regex(pattern: str) -> str:
    """The pattern as a regular expression over lower-cased URLs."""
    return "".join({"*": ".*", "^": "([^a-z0-9]|$)"}.get(c) or re.escape(c) for c in pattern.translate(TO_LOWER))


def tokens_of(pattern: str) -> list[str]:
    """The tokens that every URL has which the pattern fits."""
    text = pattern.translate(TO_LOWER)
    return [m[0] for m in TOKEN.finditer(text) if m.start() and m.end() < len(text) and text[m.start() - 1] != "*" and text[m.end()] != "*"]


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty for null and for a text without ``://``."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    host = re.match("[^/?#]*", rest)[0]
    return host.translate(TO_LOWER), re.match("[^?#]*", rest[len(host) :])[0]


class HostRules:
    """The longest rule that fits: its host is the URL's or a parent of it, and its path begins the URL's."""

    def __init__(self, rules: Iterable[tuple[str, str]]):
        self.by_host: dict[str, list[tuple[str, str, str]]] = {}
        for verdict, rule in rules:
            host, slash, path = rule.partition("/")
            self.by_host.setdefault(host, []).append((slash + path, rule, verdict))

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        labels = host.split(".") if host else []
        fits = [(rule, verdict) for i in range(len(labels)) for start, rule, verdict in self.by_host.get(".".join(labels[i:]), ()) if path.startswith(start)]
        return max(fits, key=lambda f: (len(f[0]), f[0]), default=None)


def judged(pages: DataFrame, host_rules: Iterable[tuple[str, str]] = HOST_RULES, patterns: Iterable[str] = PATTERNS, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``(page_id, host, path, rule, verdict, pattern)`` of every row.

    The verdict is that of the host rule, else ``block`` where a pattern fits (the first
    that does is given), else ``allow``. A null URL, and one without ``://``, has an empty
    host and path, so no host rule fits it. Repeated rows stay repeated; an empty table
    gives an empty result.
    """
    patterns = list(patterns)
    urls = only(pages, id_col, url_col)
    literal = sorted({t for p in patterns for t in tokens_of(p)})
    counts: dict[str, int] = {}
    if literal:  # one row per token of a rule at most
        own = F.array_intersect(F.split(F.lower(F.col(url_col)), "[^a-z0-9]+"), F.array(*map(F.lit, literal)))
        counts = dict(urls.select(F.explode(own).alias("t")).groupBy("t").count().collect())
    index: dict[str, list[int]] = {}
    for i, p in enumerate(patterns):
        index.setdefault(min(tokens_of(p), key=lambda t: (counts.get(t, 0), t), default=""), []).append(i)
    regexes = [to_regex(p) for p in patterns]
    host_rules = list(host_rules)
    kind = pages.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = [re.compile(r, re.S) for r in regexes]
        rules = HostRules(host_rules)
        always = index.get("", [])
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            for url in batch.column(1).to_pylist():
                host, path = split_url(url)
                found = rules.find(host, path)
                low = (url or "").translate(TO_LOWER)
                some = {i for t in set(TOKEN.findall(low)) for i in index.get(t, ())}
                fit = next((i for i in sorted(some.union(always)) if compiled[i].search(low)), None)
                verdict = found[1] if found else "allow" if fit is None else "block"
                for x, v in zip(out, (host, path, found and found[0], verdict, None if fit is None else patterns[fit])):
                    x.append(v)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.string()) for x in out)], names=["page_id", "host", "path", "rule", "verdict", "pattern"])

    return urls.mapInArrow(run, f"page_id {kind}, host string, path string, rule string, verdict string, pattern string")


def judged_sql(host_rules: Iterable[tuple[str, str]] = HOST_RULES, patterns: Iterable[str] = PATTERNS) -> str:
    """The same over table ``pages``, in DuckDB's SQL, every pattern run on every URL."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    ordered = sorted(host_rules, key=lambda r: (-len(r[1]), r[1]))
    fits = lambda rule: (lambda h, p: f"(host = {quote(h)} OR ends_with(host, {quote('.' + h)})) AND starts_with(path, {quote('/' + p)})")(*rule.split("/", 1))
    pick = lambda i: " ".join(f"WHEN {fits(r[1])} THEN {quote(r[i])}" for r in ordered)
    lower = "translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    found = " ".join(f"WHEN regexp_matches(low, {quote('(?s)' + to_regex(p))}) THEN {quote(p)}" for p in patterns)
    return f"""
WITH parts AS (
  SELECT page_id, coalesce({lower}, '') AS low,
         CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
cut AS (
  SELECT page_id, low, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts),
found AS (
  SELECT page_id, host, path, CASE {pick(1)} END AS rule, CASE {pick(0)} END AS said, CASE {found} END AS pattern FROM cut)
SELECT page_id, host, path, rule, coalesce(said, CASE WHEN pattern IS NULL THEN 'allow' ELSE 'block' END) AS verdict, pattern FROM found"""
