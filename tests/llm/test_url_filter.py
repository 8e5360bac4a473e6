import pytest

from tablelearn.llm import url_filter
from tablelearn.llm.queries import RULES

URLS = [
    None,
    "",
    "no scheme",
    "http://",
    "https://NET/",
    "https://net",
    "https://a.b.Net/x?y#z",
    "https://xnet/",
    "ftp://Example.NET/en/1",
    "https://www.example.net/en",
    "https://www.example.net/fr/?q=https://example.com/de/",
    "https://m.example.com/de/5#top",
    "https://m.example.com/de?x",
    "https://org/fr/",
    "https://a..org/fr/x",
    "https://org./fr/x",
    "https://a.org?fr/",
    "x://y://net/",
    "https://ÄÖ.example.com/de/ü",
    "https://" + "a." * 3000 + "net/" + "p" * 5000,
]


def brute(url, rules, default="allow"):
    rest = (url or "").split("://", 1)[1] if "://" in (url or "") else ""
    host = rest
    for c in "/?#":
        host = host.split(c, 1)[0]
    path = rest[len(host) :].split("?", 1)[0].split("#", 1)[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else default


def judged(spark, urls, rules):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, host string, keys string")
    return {r.page_id: tuple(r)[1:] for r in url_filter.judge_urls(pages, url_filter.rule_table(spark, rules)).collect()}


@pytest.mark.parametrize("first", [url_filter.FIRST, (1, 1)])
def test_odd_urls(spark, monkeypatch, first):
    monkeypatch.setattr(url_filter, "FIRST", first)
    assert judged(spark, URLS, RULES) == {i: brute(u, RULES) for i, u in enumerate(URLS)}


@pytest.mark.parametrize("bound", [0, 16])
def test_every_level_is_measured(spark, monkeypatch, bound):
    """With a bit a rule the first level takes 8 bytes, and what it lets through wants more than 16."""
    monkeypatch.setattr(url_filter, "FIRST", (1, 1))
    monkeypatch.setattr(url_filter, "MAX_FILTER_BYTES", bound)
    with pytest.raises(ValueError, match="more than"):
        judged(spark, [f"https://w{i}.net/" for i in range(400)], RULES)


def test_many_rules_and_urls_stay_exact(spark):
    rules = [(f"h{i}.example", f"/p{i % 7}/", "block" if i % 3 else "allow") for i in range(150)]
    urls = [f"https://w.h{i}.example/p{i % 5}/x{i}" for i in range(400)] * 2
    assert judged(spark, urls, rules) == {i: brute(u, rules) for i, u in enumerate(urls)}


def test_a_cascade_has_levels_and_is_exact(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "FIRST", (1, 1))
    monkeypatch.setattr(url_filter, "LATER", (1, 1))
    listed = spark.range(100).selectExpr("cast(id as string) AS key")
    universe = spark.range(3000).selectExpr("cast(id as string) AS key")
    cascade = url_filter.build_cascade(listed, universe)
    assert len(cascade.levels) > 2
    from pyspark.sql import functions as F

    assert sorted(int(r.key) for r in universe.where(cascade.holds(F.col("key"))).collect()) == list(range(100))


def test_empty_tables(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judge_urls(pages, url_filter.rule_table(spark, RULES)).collect() == []
    assert {r[3] for r in judged(spark, URLS, []).values()} == {"allow"}
