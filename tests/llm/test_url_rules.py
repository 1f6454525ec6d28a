"""URL rules: parsing, given rules, mining and matching against brute force."""
from itertools import combinations

import duckdb
import pytest
from pyspark.sql import functions as F

from martlight.llm import queries, url_rules as ur
from tests.llm.common import SF, rows

URLS = [
    (1, "https://www.Example.NET/en/1?page=2#top"), (2, "http://example.net/de"), (3, "http://example.net/en"),
    (4, "ftp://a.b.org/fr/x.html"), (5, "http://org/fr/"), (6, "http://notexample.com/de/"),
    (7, "http://x.example.com/de/"), (8, "http://example.com/DE/"), (9, "no scheme"), (10, None), (11, ""),
    (12, "http://host?x=/en/"), (13, "http://u:p@h.net:80/en/"), (14, "http://h.net"), (15, "a://b://c/net/"),
    (16, "http://x.net/" + "long/" * 20_000), (None, "http://y.net/en/"), (1, "http://z.com/"), (1, "http://z.com/"),
]


def parse(url):
    """(host, path) by the contract's words."""
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:cut], rest[cut:]
    end = min([tail.find(c) for c in "?#" if c in tail], default=len(tail))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), tail[:end]


def given(host, path):
    best = None
    for rule, verdict in ur.RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            if best is None or len(rule) > len(best[0]):
                best = rule, verdict
    return best


def pages(spark, data=URLS):
    df = spark.createDataFrame(data, "page_id long, url string")
    return df.select("*", *[F.lit(1).alias(c) for c in ("row", "tokens", "token", "verdict", "rule", "host")])


def test_parts_and_given_rules(spark):
    got = {(r["page_id"], r["url"]): r for r in pages(spark).select(
        "page_id", "url", *[c.alias(n) for c, n in zip(ur.parts(F.col("url")), ("h", "p"))]).withColumn(
        "g", ur.given_rule(F.col("h"), F.col("p"))).collect()}
    for i, url in URLS:
        r = got[i, url]
        assert (r["h"], r["p"]) == parse(url), url
        want = given(*parse(url))
        assert (None if r["g"] is None else tuple(r["g"])) == want, url


def brute_rules(data, support, confidence):
    """Association rules by counting every token combination."""
    n = len(data)
    count, with_verdict = {}, {}
    for tokens, verdict in data:
        for k in range(1, len(tokens) + 1):
            for c in combinations(sorted(tokens), k):
                count[c] = count.get(c, 0) + 1
                with_verdict[c, verdict] = with_verdict.get((c, verdict), 0) + 1
    least = -(-support * n // 1)
    kept = {(c, v): m / count[c] for (c, v), m in with_verdict.items()
            if m >= least and m / count[c] >= confidence}
    return {(c, v): (s, with_verdict[c, v] / n) for (c, v), s in kept.items()
            if not any(kept.get((c[:i] + c[i + 1:], v), -1) >= s for i in range(len(c)) if len(c) > 1)}


def test_query_equals_brute_force(spark):
    raw = duckdb.sql(f"SELECT page_id, url FROM '{SF}/pages.parquet'").fetchall()
    tok = {r["page_id"]: r["t"] for r in spark.read.parquet(f"{SF}/pages.parquet").select(
        "page_id", ur.tokens(F.col("url"), *ur.parts(F.col("url"))).alias("t")).collect()}
    rules = brute_rules([(tok[i], given(*parse(u))[1]) for i, u in raw if given(*parse(u))],
                        ur.MIN_SUPPORT, ur.MIN_CONFIDENCE)
    assert rules
    got = {r["page_id"]: r for r in queries.op2_url_rules(spark, SF).collect()}
    assert len(got) == len(raw)
    for i, url in raw:
        r, g = got[i], given(*parse(url))
        assert (r["host"], r["path"]) == parse(url)
        if g:
            assert (r["rule"], r["verdict"]) == g
            continue
        hits = [(s, len(c), sup, " & ".join(c), v) for (c, v), (s, sup) in rules.items() if set(c) <= set(tok[i])]
        want = max(hits)[-1] if hits else ur.DEFAULT
        assert r["rule"] is None and r["verdict"] == want, (url, r, max(hits, default=None))
        assert r["mined_rule"] == (max(hits)[-2] if hits else None)


def test_awkward_rows(spark):
    out = ur.judge(pages(spark)).collect()
    assert len(out) == len(URLS)
    assert all(r["verdict"] in ("allow", "block") for r in out)
    assert sorted((r["host"], r["path"]) for r in out) == sorted(parse(u) for _, u in URLS)


@pytest.mark.parametrize("data", [[], [(1, None), (2, "x")], [(1, "http://a.com/")]])
def test_nothing_to_learn_from(spark, data):
    out = rows(ur.judge(pages(spark, data)).select("page_id", "rule", "verdict", "mined_rule"))
    assert sorted(out) == [(i, None, ur.DEFAULT, None) for i, _ in data]


def test_tokens_of_a_url(spark):
    r = spark.createDataFrame([("HTTPS://www.Shop.example.com/en/a.html/?a=1&b&a=2#x",)], "url string").select(
        ur.tokens(F.col("url"), *ur.parts(F.col("url"))).alias("t")).first()
    assert set(r["t"]) == {"scheme=https", "top=com", "site=example.com", "first=www", "second=shop", "path=en",
                           "folder", "fragment", "query=a", "query=b"}
