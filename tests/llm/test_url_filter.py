import pytest
from pyspark.sql import functions as F

from storyweave.llm import url_filter

CASES = [
    ("https://WWW.Shop.com/a?b#c", "www.shop.com", "/a", "com/"), ("http://x.com", "x.com", "", None), ("http://com/a", "com", "/a", "com/"),
    ("http://a.example.com/en/1", "a.example.com", "/en/1", "example.com/en/"), ("http://www.example.com/en/1", "www.example.com", "/en/1", "www.example.com/en/"),
    ("http://m.www.example.com/en/", "m.www.example.com", "/en/", "www.example.com/en/"), ("http://badexample.com/en/1", "badexample.com", "/en/1", "com/"),
    ("http://a.net/es/1", "a.net", "/es/1", "net/es/"), ("http://a.net/esx", "a.net", "/esx", None), ("http://a.net?/es/", "a.net", "", None),
    ("no address", "", "", None), (None, "", "", None), ("", "", "", None), ("a://b://c.com/x", "b:", "//c.com/x", None), ("http://É.com/é\n/x#y", "É.com", "/é\n/x", "com/"),
]


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "x", 1, "x") for i, u in enumerate(urls)], "page_id bigint, url string, host string, id int, verdict string")


def test_host_path_and_rule(spark):
    got = {r.page_id: (r.host, r.path, r.rule) for r in url_filter.judge(pages(spark, [c[0] for c in CASES])).collect()}
    assert got == {i: c[1:] for i, c in enumerate(CASES)}


def test_model_tells_hosts_apart(spark):
    urls = [f"http://news.paper{i}.com/story/{i}" for i in range(120)] + [f"http://casino{i}.net/es/bonus/{i}" for i in range(120)]
    urls += ["http://news.paperx.org/story/5", "http://casino.org/bonus/77", None, "", "http://" + "z" * 200_000]
    got = {r.page_id: r for r in url_filter.judge(pages(spark, urls)).collect()}
    assert got[240].verdict == "allow" and got[241].verdict == "block" and got[240].score > got[241].score
    assert got[242].verdict == got[243].verdict == "allow" and got[244].verdict in ("allow", "block")


@pytest.mark.parametrize("urls", [[], ["http://a.org/x"] * 3, ["http://a.com/x", "http://b.org/y"]])
def test_nothing_to_learn_from(spark, urls):
    rows = url_filter.judge(pages(spark, urls))
    assert rows.count() == len(urls) and rows.filter(F.col("verdict") != "allow").count() == 0
