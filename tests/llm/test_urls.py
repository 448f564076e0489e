"""URL rules against a plain reading of them, features against plain counts, and the trees on held-out hosts."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from brute import SF
from respan.llm import queries
from respan.llm.urlfilter import Rule, fit_urls, judge_urls, lexical

ODD = [
    None, "", "no scheme.net/x", "http://", "http://A.NET", "http://a.net/", "https://net/x", "http://knet/x", "HTTP://x.example.NET/en/1?u=http://b.org/fr/", "http://example.net/en", "http://example.net/en/",
    "http://example.net?/en/", "http://a.net#/en/", "x://y://z.net/", "http://a.org/fr/é?q=1&&r=2&s#t", "http://a.ORG/FR/1", "http://example.com/de/1", "http://badexample.com/de/1", "http://a.net:80/x", "http://a.net./x", "http://\n.net/x", "ftp://" + "a" * 30_000 + ".com/de/" + "b/" * 20_000, "http://.../", "http://a..net/x",
]


def parts(url):
    _, found, rest = (url or "").partition("://")
    end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host, rest = rest[:end], rest[end:]
    path = rest[: min((rest.find(c) for c in "?#" if c in rest), default=len(rest))]
    return ("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path) if found else ("", "")


def rule_of(host, path, rules):
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.pattern), default=None)


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate([*ODD, *ODD])], "page_id long, url string").withColumns({c: F.lit("x") for c in ("host", "rule", "score", "features", "__host", "action")})
    got = judge_urls(pages, None, queries.URL_RULES)
    assert got.columns == ["page_id", "url", "features", "__host", "action", "host", "path", "rule", "score", "verdict"]
    for r in got.collect():
        host, path = parts(r.url)
        rule = rule_of(host, path, queries.URL_RULES)
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule.pattern if rule else None, rule.action if rule else "allow"), r.url
    assert got.count() == 2 * len(ODD)
    assert judge_urls(pages.limit(0), None, queries.URL_RULES).isEmpty()


def test_features(spark):
    for r in lexical(spark.createDataFrame([(u,) for u in ODD], "url string"), "url").collect():
        u = r.url or ""
        host, path = parts(u)
        entropy = -sum(c / len(u) * math.log2(c / len(u)) for c in Counter(u).values()) if u else 0.0
        assert r.f_entropy == pytest.approx(entropy, abs=1e-6)
        assert (r.f_length, r.f_host_length, r.f_path_length, r.f_hyphens) == (len(u), len(host), len(path), host.count("-"))
        assert r.f_digit_ratio == pytest.approx(sum("0" <= c <= "9" for c in u) / len(u) if u else 0)
        assert r.f_depth == sum(x != "" for x in path.split("/")) - (path != "" and not path.startswith("/"))


def test_trees_on_held_out_hosts(spark):
    rng = random.Random(5)
    name = lambda n: "".join(rng.choices("abcdefghij", k=n))

    def url(bad):
        host = f"{name(4)}-{name(4)}-{rng.randint(100, 999)}.{'cheap' if rng.random() < 0.5 else 'shop'}.example.biz" if bad else f"www.{name(7)}.example.edu"
        query = "?" + "&".join(f"{name(2)}={rng.randint(0, 10**6)}" for _ in range(rng.randint(3, 6))) if bad else ""
        return f"http://{host}/{name(5)}/{query}"

    labelled = [(url(b), b) for b in [True, False] * 300] + [(None, True), ("http://x.y/", None)] + [("http://www.hot.example.edu/", False)] * 300
    model = fit_urls(spark.createDataFrame(labelled, "url string, blocked boolean"))
    fresh = [(url(b), b) for b in [True, False] * 100]
    got = judge_urls(spark.createDataFrame(fresh, "url string, blocked boolean"), model, [Rule("allow", "nothing.here/")]).collect()
    assert sum((r.verdict == "block") == r.blocked for r in got) >= 0.95 * len(got)
    assert all(r.rule is None and 0 <= r.score <= 1 for r in got)
    again = judge_urls(spark.createDataFrame([(u,) for u in ODD], "url string"), model, queries.URL_RULES)
    assert again.where("verdict in ('block', 'allow')").count() == len(ODD)


def test_without_labels_of_both_kinds(spark):
    urls = spark.createDataFrame([("http://a.b/",), ("http://c.d/",)], "url string")
    assert fit_urls(urls.withColumn("blocked", F.lit(None).cast("boolean"))) is None
    for flag, verdict in ((True, "block"), (False, "allow")):
        model = fit_urls(urls.withColumn("blocked", F.lit(flag)))
        assert {r.verdict for r in judge_urls(urls, model, queries.URL_RULES).collect()} == {verdict}


def test_query(spark):
    got = queries.op12_url_filter(spark, SF).collect()
    given = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert sorted(r.page_id for r in got) == sorted(given)
    for r in got:
        host, path = parts(given[r.page_id])
        rule = rule_of(host, path, queries.URL_RULES)
        assert (r.host, r.path, r.rule) == (host, path, rule.pattern if rule else None)
        assert r.verdict == rule.action if rule else r.verdict in ("allow", "block")
