"""URL rules against a loop, and the trees on held-out URLs."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from ledgerlake.llm import urlfilter
from ledgerlake.llm.common import lowest_hashes
from ledgerlake.llm.queries import URL_RULES

SCHEMA = "page_id long, url string, html string, host string, rule string, suffix string"


def split(url: str | None) -> tuple[str, str]:
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    at = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, path = rest[:at], rest[at:]
    end = min([path.find(c) for c in "?#" if c in path] or [len(path)])
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path[:end]


def rule_of(host: str, path: str):
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text), default=None)


URLS = [
    None, "", "nothing", "http://", "HTTP://WWW.Example.COM/en/1", "http://example.com/en/x", "http://example.com", "http://a.example.com/de/",
    "http://notexample.com/en/", "http://x.net/es/1?a=b", "http://x.net/fr", "http://net/fr/", "a://b://c.com/x", "http://É.com/ü#f", "http://x.org/en/",
    "http://x.com?q=1/2", "http://x.com#a/b", "http://evil.com\n/x", "http://u@x.com:80/", "http://www.example.com/en/",
]


def test_hosts_paths_and_rules(spark, stage):
    rows = [(i, u, "h", "clash", "clash", "clash") for i, u in enumerate(URLS)] + [(0, None, "h", "c", "c", "c"), (None, "http://x.org/", "", "", "", "")]
    got = urlfilter.filtered(spark.createDataFrame(rows, SCHEMA), URL_RULES, stage).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.page_id is not None:
            host, path = split(URLS[r.page_id])
            rule = rule_of(host, path)
            assert (r.host, r.path, r.rule) == (host, path, rule and rule.text)
            assert r.verdict in ("allow", "block") and (rule is None or r.verdict == rule.verdict)


def test_trees_on_held_out_urls(spark, stage):
    r = random.Random(7)
    good = lambda: f"http://{r.choice(['news', 'blog'])}.site{r.randrange(9)}.org/{r.choice('abc')}/{r.randrange(99)}"
    bad = lambda: f"http://{r.randrange(10**8)}-win.x{r.randrange(10**5)}.biz/?id={r.randrange(10**9)}&t={r.randrange(10**6)}"
    rows = [(good(), 0) for _ in range(150)] + [(bad(), 1) for _ in range(150)]
    urls = urlfilter.parsed(spark.createDataFrame([(i, u, b) for i, (u, b) in enumerate(rows)], "page_id long, url string, blocked int"), ())
    labelled = urls.withColumn("blocked", (urls.page_id >= 150).cast("int"))
    model = urlfilter.learn(labelled.where("page_id % 3 <> 1"), stage)
    got = urlfilter.judged(labelled.where("page_id % 3 = 1"), model).collect()
    assert sum((x.learned == "block") == (x.blocked == 1) for x in got) >= 0.97 * len(got)


def test_nothing_to_learn(spark, stage):
    empty = spark.createDataFrame([], SCHEMA)
    assert urlfilter.filtered(empty, URL_RULES, stage).collect() == []
    one = spark.createDataFrame([(1, "http://x.org/", "", "", "", "")], SCHEMA)
    assert urlfilter.filtered(one, URL_RULES, stage).first().verdict == "allow"


def test_the_sample_is_the_lowest_hashes_of_different_urls(spark, stage):
    """One URL fills a third of the rows; what is learned from does not depend on that, nor on the partitions."""
    rows = [(i, f"http://s{i % 50}.org/{i % 700}") for i in range(4000)] + [(i, "http://hot.org/en/") for i in range(2000)]
    urls = urlfilter.parsed(spark.createDataFrame(rows, "page_id long, url string").repartition(7), ())
    labelled = urls.withColumn("blocked", F.crc32(urls.url.cast("binary")) % 2 == 0).withColumn("blocked", F.col("blocked").cast("int"))
    kept = lowest_hashes(labelled, "url", 100)
    n = kept.select("url").distinct().count()
    assert 100 <= n <= 150
    assert kept.agg(F.max(F.xxhash64("url"))).first()[0] < labelled.join(kept, "url", "left_anti").agg(F.min(F.xxhash64("url"))).first()[0]
    assert lowest_hashes(labelled, "url", 10_000).count() == len(rows)
    models = [urlfilter.learn(x, stage, 100) for x in (labelled, labelled.dropDuplicates(["url"]).repartition(3))]
    assert models[0].rate == models[1].rate
    assert models[0].suffixes.count() == 1


def test_very_long_urls(spark, stage):
    rows = [(i, f"http://example.com/en/{'a-1?' * 20_000}{i}") for i in range(3)] + [(9, "x" * 100_000), (10, "http://x.net/es/1")]
    got = urlfilter.filtered(spark.createDataFrame([(*r, "", "", "", "") for r in rows], SCHEMA), URL_RULES, stage).collect()
    assert {(r.page_id, r.verdict) for r in got if r.rule} == {(i, "block") for i in (0, 1, 2, 10)}
