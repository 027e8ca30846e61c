from __future__ import annotations

import re

from pyspark.sql import functions as F

from streakline.llm import urls

ODD = [
    None,
    "",
    "no scheme",
    "http://",
    "HTTP://WWW.Example.COM/en/1",
    "http://example.com/en/x?q=/es/",
    "http://www.example.com/en/x#f",
    "http://example.com/en",
    "http://a.b.net/es/1",
    "http://net/fr/",
    "http://planet/fr/",
    "http://x.org?http://net/es/",
    "a://b://c/d",
    "http://cheap-pills.org/x/",
    "https://www.cheap-pills.org/x.html",
    "https://m.cheap-pills.org/y",
    "http://ÄÖ.com/ü\nz",
    "http://h.org/" + "p" * 5000,
]


def judge(url, listed):
    rest = url.partition("://")[2] if url and "://" in url else ""
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in re.match(r"[^/?#]*", rest)[0])
    path = re.match(r"[^/?#]*([^?#]*)", rest)[1]
    best = None
    for verdict, h, p in urls.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            best = max(best or (0, "", ""), (len(h + p), h + p, verdict))
    form = re.sub(r"^(www|m)\.", "", host) + re.sub(r"(\.html)?/*$", "", path) if host else None
    return host, path, best and best[1], best[2] if best else "block" if form in listed else "allow"


def test_odd(spark):
    rows = [(i, u, "h", "p") for i, u in enumerate(ODD)] + [(4, ODD[4], None, None), (None, ODD[8], None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, path string")
    listed = spark.createDataFrame([("cheap-pills.org/x",), ("other.org",), (None,), ("other.org",)], "key string")
    found = sorted(map(tuple, urls.judge_urls(pages, listed).collect()), key=str)
    want = [(i, *judge(u, {"cheap-pills.org/x", "other.org"})) for i, u, *_ in rows]
    assert found == sorted(want, key=str)


def test_list_of_the_query(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    listed = {r["key"] for r in urls.urls_by_words(pages).collect()}
    want = [(r["page_id"], *judge(r["url"], listed)) for r in pages.collect()]
    assert sorted(map(tuple, urls.judge_urls(pages, urls.urls_by_words(pages)).collect())) == sorted(want)


def test_filter_never_drops_a_listed_key_and_passes_few_others(spark):
    keys = spark.range(20_000).select(F.concat(F.lit("host/"), F.col("id")).alias("key"))
    blocks = 20_000 // urls.KEYS_PER_BLOCK
    table = urls.bloom_blocks(keys.where("key < 'host/15'"), blocks)
    passed = urls.possible_hits(keys, table, blocks)
    listed = keys.where("key < 'host/15'").count()
    assert passed.where("key < 'host/15'").count() == listed
    assert passed.count() - listed < 0.05 * (20_000 - listed)


def test_large_filters_are_joined_by_block(spark, sf, monkeypatch):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    want = sorted(map(tuple, urls.judge_urls(pages, urls.urls_by_words(pages)).collect()))
    monkeypatch.setattr(urls, "BROADCAST_BLOCKS", 0)
    assert sorted(map(tuple, urls.judge_urls(pages, urls.urls_by_words(pages)).collect())) == want


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert urls.judge_urls(pages, urls.urls_by_words(pages)).collect() == []
