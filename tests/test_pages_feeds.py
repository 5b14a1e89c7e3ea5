from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from storyweave.functions.html import container_text
from storyweave.operators import articles
from storyweave.schemas import SELECTORS
from storyweave.sources import feeds, registry, tables


@pytest.mark.parametrize("page,config,expected", [
    ("<header><p>top</p></header><main id='story7'><p>rain fell</p><p>all day</p></main>", [{"id": "story7"}], "rain fell all day"),
    ("<div class='wide prose-v2'><p>river</p><p>it's high</p></div>", [{"class_": "prose", "regex": True}], "river it's high"),
    ("<div class='longread'><p>a</p></div>", [{"class_": "prose", "regex": True}, {"class_": "long.*", "regex": True}], "a"),
    ("<section name='articleBody'><p>x&amp;y</p></section>", [{"name": "section", "attrs": [("name", "articleBody")]}], "x&y"),
    ("<div class='ad'>no paragraph</div>", [{"class_": "ad"}], ""),
    ("<p>a</p>", [{"id": "q"}], None),
    ("<div class='a b'><p>1</p></div>", [{"class_": "a b"}], "1"),
    ("<div class='ab'><p>1</p></div>", [{"class_": "a"}], None),
    ("<article><p>a<p>b</p>c<script>no</script></article><p>z</p>", [{"name": "article"}], "abc b"),
    ("<article></span><p>a<br/>b</article>c", [{"name": "article"}], "ab"),
])
def test_container_text(page, config, expected):
    assert container_text(page, config) == expected


def test_unclosed_paragraphs_can_be_closed():
    assert container_text("<article><p>a<p>b</article>", [{"name": "article"}], close_paragraphs=True) == "a b"


def test_parse_pages_joins_selectors_of_the_feed(spark):
    feeds_ = registry.normalise_selector_config(spark.createDataFrame(
        [("f1", '{"id": "m"}'), ("f2", '[{"id": "q"}, {"class_": "B.dy", "regex": true}]')], "id string, parser_config string"))
    arts = spark.createDataFrame([("a1", "f1"), ("a2", "f2"), ("a3", "f2")], "id string, rss_feed_id string")
    raw = spark.createDataFrame([("a1", "<div id=m><p>one</p></div>"), ("a2", "<div class=Body><p>two</p></div>"),
                                 ("a3", "<p>none</p>")], "article_id string, content string")
    parsed = articles.parse_pages(articles.with_selectors(raw, arts, feeds_), F.lit("2024-01-01").cast("timestamp"))
    assert {(r.article_id, r.content) for r in parsed.collect()} == {("a1", "one"), ("a2", "two")}


RSS = """<rss xmlns:dc="d"><channel><title>T</title>{items}</channel></rss>"""
ITEM = "<item><title>A</title><link>https://a.com/{n}?y=1</link><description>{s}</description>{date}<dc:creator>Me</dc:creator></item>"
DATE = "<pubDate>Tue, 05 Apr 2022 10:00:00 EST</pubDate>"


RDF = ('<?xml version="1.0"?><rdf:RDF xmlns:rdf="r" xmlns="http://purl.org/rss/1.0/" xmlns:dc="d"><channel rdf:about="c"><title>Old</title></channel>'
       "<item><title>First</title><link>https://r.com/1</link><dc:date>2022-04-05T10:00:00Z</dc:date><dc:creator>You</dc:creator></item></rdf:RDF>")
ENTITIES = ("<rss><channel><title>Caf&eacute;&nbsp;news</title><item><title>A &mdash; B &unheard; C &amp; D</title><link>https://e.com/1?a=1&b=2</link>"
            f"{DATE}</item></channel></rss>")


def test_other_layouts_and_entities(spark):
    entries = {r.rss_feed_id: r for r in feeds.flatten_entries(feeds.parse_feed_xml(responses(spark)).feeds).filter("rss_feed_id in ('8', '9')").collect()}
    assert (entries["8"].title, entries["8"].link, entries["8"].author, entries["8"].published) == ("First", "https://r.com/1", "You", "2022-04-05T10:00:00Z")
    assert entries["9"].title == "A \u2014 B &unheard; C & D" and entries["9"].link == "https://e.com/1?a=1&b=2"


def test_clusters_written_twice_are_there_once(spark, tmp_path):
    from storyweave.operators.clusters import Clusters

    found = Clusters(spark.createDataFrame([("c1", 1)], "id string, x int"), spark.createDataFrame([("c1", "a"), ("c1", "b")], "cluster_id string, article_id string"),
                     spark.createDataFrame([("c1", "t", 1.0)], "cluster_id string, term string, weight double"))
    more = Clusters(found.clusters.union(spark.createDataFrame([("c2", 2)], "id string, x int")), found.links, found.keywords)
    for run in (found, found, more):
        tables.write_clusters(run, str(tmp_path))
    assert {n: spark.read.parquet(str(tmp_path / n)).count() for n in tables.CLUSTER_TABLES} == {
        "articlecluster": 2, "articleclusterlink": 2, "articleclusterkeyword": 1}


def responses(spark):
    ok = RSS.format(items="".join(ITEM.format(n=n, s="&lt;p&gt;hi&lt;/p&gt;" if n else "", date=DATE) for n in range(3)))
    dateless = RSS.format(items=ITEM.format(n=1, s="s", date=""))
    atom = ('<feed xmlns="http://www.w3.org/2005/Atom"><title>AT</title><entry><title>E</title><link rel="self" href="s"/>'
            '<link rel="alternate" href="https://b.com/1"/><published>2022-04-05T10:00:00Z</published></entry></feed>')
    rows = [("1", 1, "u1", 200, ok, None), ("2", 2, "u2", 200, atom, None), ("3", 3, "u3", 200, dateless, None),
            ("4", 4, "u4", 301, None, "new"), ("5", 5, "u5", 410, None, None), ("6", 6, "u6", 500, None, None),
            ("7", 7, "u7", 200, "no xml", None), ("8", 8, "u8", 200, RDF, None), ("9", 9, "u9", 200, ENTITIES, None)]
    return spark.createDataFrame(rows, "rss_feed_id string, source_id int, url string, status int, body string, href string")


def test_feeds_to_articles(spark):
    parsed = feeds.parse_feed_xml(responses(spark).filter("rss_feed_id < '8'"))
    assert {(r.rss_feed_id, r.reason) for r in parsed.rejects.collect()} == {("3", "entry without date"), ("7", "no title")}
    made = feeds.entries_to_articles(feeds.flatten_entries(parsed.feeds), F.lit("2024-01-01").cast("timestamp"))
    valid, _ = feeds.split_valid(made)
    got = sorted((r.url, r.summary, r.authors, str(r.published_at)) for r in valid.collect())
    assert got == [("https://a.com/0", "A", "Me", "2022-04-05 15:00:00"), ("https://a.com/1", "hi", "Me", "2022-04-05 15:00:00"),
                   ("https://a.com/2", "hi", "Me", "2022-04-05 15:00:00"), ("https://b.com/1", "E", None, "2022-04-05 10:00:00")]


def test_feed_updates(spark):
    known = spark.createDataFrame([(str(i), i, f"u{i}", True) for i in range(1, 7)], "id string, source_id int, url string, is_okay boolean")
    got = {r.id: (r.url, r.is_okay) for r in feeds.apply_feed_updates(known, responses(spark)).collect()}
    assert got["4"] == ("new", True) and got["5"] == ("u5", False) and got["6"] == ("u6", True)


def test_registry_reload_adds_only_new_rows(spark, tmp_path):
    (tmp_path / "s.json").write_text('[{"id": 0, "name": "A", "url": "a"}, {"id": 1, "name": "B"}]')
    (tmp_path / "t.json").write_text('[{"id": 0, "name": "A", "url": "other"}, {"id": 9, "name": "Z", "extra": 1}]')
    (tmp_path / "f.json").write_text('[{"source_id": 0, "url": "u", "parser_config": {"id": "x"}, "note": "N"},'
                                     ' {"source_id": 1, "url": "v", "parser_config": [{"class_": "c", "regex": true}, {"id": "y"}]}]')
    old = registry.load_registry(spark, str(tmp_path / "s.json"), "source")
    new = registry.load_registry(spark, str(tmp_path / "t.json"), "source")
    assert [r.name for r in tables.insert_ignore(new, old, ["name"], [F.col("id")]).collect()] == ["Z"]
    loaded = {r.url: r for r in registry.load_registry(spark, str(tmp_path / "f.json"), "rssfeed").collect()}
    assert [s.id for s in loaded["u"].parser_config] == ["x"] and loaded["v"].parser_config[0].regex
    assert registry.select_sources(old, ["all", "A"]).count() == 2 and registry.select_sources(old, ["A"]).count() == 1
    assert spark.createDataFrame([], f"c {SELECTORS.simpleString()}").count() == 0


def test_insert_ignore_and_upsert(spark):
    old = spark.createDataFrame([(1, "old")], "k int, v string")
    new = spark.createDataFrame([(1, "x"), (2, "b"), (2, "a"), (3, None)], "k int, v string")
    inserted = tables.insert_ignore(new, old, ["k"], [F.col("v")])
    assert {tuple(r) for r in inserted.collect()} == {(2, "a"), (3, None)} and tables.rows_added(inserted) == 2
    assert {tuple(r) for r in tables.upsert(new, old, ["k"], [F.col("v")]).collect()} == {(1, "x"), (2, "b"), (3, None)}


def test_dedupe_titles(spark):
    schema = "title string, source_id int, url string, added_at timestamp_ltz"
    at = "2024-01-01 {:02d}:00:00"
    old = spark.createDataFrame([("t1", 1, "u1", at.format(9)), ("t2", 1, "u2", at.format(9)), ("t3", 1, "u3", at.format(4)),
                                 ("t2", 1, "n2", at.format(9))], "title string, source_id int, url string, added_at string")
    new = spark.createDataFrame([("t1", 1, "n1", at.format(10)), ("t1", 2, "n4", at.format(10)), ("t2", 1, "u2", at.format(10)),
                                 ("t3", 1, "n3", at.format(10)), ("t9", 1, "n9", at.format(10)), ("t9", 1, "m9", at.format(10)),
                                 (None, 1, "z", at.format(10))], "title string, source_id int, url string, added_at string")
    cast = lambda df: df.withColumn("added_at", F.col("added_at").cast("timestamp"))
    kept = articles.dedupe_titles(cast(new), cast(old), F.lit(at.format(10)).cast("timestamp"), timedelta(hours=6))
    # t1 went to another URL; t2 has two old URLs, one of them different; t3 is exactly six hours old.
    assert {r.url for r in kept.collect()} == {"n4", "n3", "n9", "m9", "z"}
    assert schema


def test_accept_pages(spark):
    fetched = spark.createDataFrame([(1, 200, "a"), (2, 404, None), (3, None, None)], "article_id int, status int, content string")
    assert [r.article_id for r in articles.accept_pages(fetched, F.lit("2024-01-01").cast("timestamp")).collect()] == [1]
    assert {r.status: r.responses for r in articles.fetch_report(fetched).collect()} == {200: 1, 404: 1, None: 1}
