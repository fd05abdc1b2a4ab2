"""URL filters: parts of URLs, rules, and the posterior against the same sums in Python."""

import math

import pytest
from pyspark.sql import functions as F

from rankwell.llm import queries, url_filter

URLS = [
    ("http://WWW.Example.ORG/es/a?x#y", "www.example.org", "/es/a", "example.org/es/", "block"),
    ("https://example.org/en/12", "example.org", "/en/12", "example.org/en/1", "block"),
    ("https://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
    ("https://notexample.org?q=/es/", "notexample.org", "", None, None),
    ("ftp://a.com/fr/://x", "a.com", "/fr/://x", "com/fr/", "allow"),
    ("http://com/de/x", "com", "/de/x", "com/de/", "block"),
    ("http://xcom/de/x", "xcom", "/de/x", None, None),
    ("example.org/es/", "", "", None, None),
    ("://", "", "", None, None),
    ("http://ÄB.net\n/p", "Äb.net\n", "/p", None, None),
    ("", "", "", None, None),
    (None, "", "", None, None),
]


def test_parts_and_rules(spark):
    rows = [(i, u) for i, (u, *_) in enumerate(URLS)] + [(None, "http://a.com/fr/"), (4, URLS[4][0])]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit("mine"))
    none = spark.createDataFrame([], "doc_id long, bad int")
    got = url_filter.judge(pages, none).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.page_id is not None:
            _, host, path, rule, verdict = URLS[r.page_id]
            assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict or "allow")
            assert r.bad_rate == 0.5


def test_posterior(spark):
    counts = {"a.x.com": (40, 38), "b.x.com": (30, 2), "y.com": (10, 1), "z.co.uk": (3, 3), "new.x.com": (0, 0), "q.org": (50, 0)}
    rows = []
    for host, (n, bad) in counts.items():
        rows += [(host, int(i < bad)) for i in range(n)] + [(host, None)]
    got = {r.host: r for r in url_filter.reputation(spark.createDataFrame(rows, "host string, bad int")).collect()}

    def strength(level):  # rows of n, bad, prior
        level = [x for x in level if x[0]]
        over = sum(n * (b / n - p) ** 2 - p * (1 - p) for n, b, p in level)
        under = sum((n - 1) * p * (1 - p) for n, b, p in level)
        rho = min(max(over / under, 1 / 1001), 1 / 2)
        return 1 / rho - 1

    def level(keys, prior):
        sums = {}
        for host, (n, bad) in counts.items():
            k = keys(host)
            sums[k] = (sums.get(k, (0, 0))[0] + n, sums.get(k, (0, 0))[1] + bad)
        of = {keys(h): prior(h) for h in counts}
        m = strength([(n, b, of[k]) for k, (n, b) in sums.items()])
        return {k: ((b + m * of[k]) / (n + m), n + m) for k, (n, b) in sums.items()}

    def suffix(h):
        return "co.uk" if h.endswith("co.uk") else h.split(".")[-1]

    def domain(h):
        return ".".join(h.split(".")[-3 if suffix(h) == "co.uk" else -2 :])

    total, bad = sum(n for n, _ in counts.values()), sum(b for _, b in counts.values())
    s = level(suffix, lambda h: (bad + 1) / (total + 2))
    d = level(domain, lambda h: s[suffix(h)][0])
    hosts = level(lambda h: h, lambda h: d[domain(h)][0])
    for host, (rate, weight) in hosts.items():
        assert got[host].mean == pytest.approx(rate)
        assert got[host].bound == pytest.approx(rate - 1.645 * math.sqrt(rate * (1 - rate) / (weight + 1)))
    assert got["a.x.com"].bound > 0.5 > got["b.x.com"].mean


def test_bad_hosts_are_blocked(spark):
    pages = spark.createDataFrame([(i, f"http://{'bad' if i % 2 else 'good'}.net/{i}") for i in range(200)], "page_id long, url string")
    outcomes = spark.createDataFrame([(i, i % 2) for i in range(0, 150)] + [(3, 0), (None, 1), (5, None)], "doc_id long, bad int")
    verdicts = {(r.host, r.verdict) for r in url_filter.judge(pages, outcomes).collect()}
    assert verdicts == {("bad.net", "block"), ("good.net", "allow")}


def test_empty_table(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judge(none, spark.createDataFrame([(1, 1)], "doc_id long, bad int")).count() == 0


def test_query_blocks_a_planted_host(spark, tmp_path):
    """Pages that no rule fits go by how the rules judged the other pages of their host."""
    urls = [f"http://spam.com/{'de' if i % 10 else 'fr'}/{i}" for i in range(60)] + [f"http://spam.com/en/{i}" for i in range(20)]
    for h in range(12):
        urls += [f"http://h{h}.com/{'de' if i % 10 == 0 else 'fr'}/{i}" for i in range(30)] + [f"http://h{h}.com/en/1"]
    urls += [f"http://h{h}.org/en/{i}" for h in range(6) for i in range(10)] + ["http://unseen.net/en/1"]
    spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").write.parquet(str(tmp_path / "pages.parquet"))
    rows = queries.QUERIES["op7_url_filter"](spark, str(tmp_path)).collect()
    assert len(rows) == len(urls)
    assert {r.host for r in rows if r.rule is None and r.verdict == "block"} == {"spam.com"}
    assert sum(r.rule is None and r.verdict == "block" for r in rows) == 20


def test_query_blocks_some_hosts(spark):
    rows = queries.QUERIES["op7_url_filter"](spark, "/root/testdata/sf0.1").collect()
    free = [r for r in rows if r.rule is None]
    assert 0 < sum(r.verdict == "block" for r in free) < len(free) / 2
