"""Every operator as a named query over a data folder. All of them read whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storyweave.functions import text, times
from storyweave.functions.html import extract_container_text
from storyweave.operators import articles, clusters, lookup, report, search, similarity, terms
from storyweave.operators.windows import RUN, Panes, batch_scan, sliding_windows, window_scan, windows_scan
from storyweave.plans import views
from storyweave.plans.views import table
from storyweave.schemas import CLUSTER, CLUSTER_KEYWORD
from storyweave.session import shared_folder, staged
from storyweave.sources import feeds, registry, tables
from storyweave.streaming import chain

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DAY = timedelta(days=1)
LONG = timedelta(days=3650)
THRESHOLD = 0.45
STOP_WORDS = ("the", "of", "and", "in", "is", "to", "de", "la", "le", "les", "und", "der", "die", "el", "que", "et")

_stored: dict[tuple, DataFrame] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def stored(spark: SparkSession, folder: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Tables one step of the chain stores for the next are written once per session and folder."""
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _stored:
        _stored[key] = staged(build(), name)
    return _stored[key]


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def termcount(spark: SparkSession, folder: str) -> DataFrame:
    return stored(spark, folder, "termcount", lambda: terms.term_counts(views.parsedcontent(spark, folder)))


def daily(spark: SparkSession, folder: str) -> DataFrame:
    """Term counts of each closed day."""
    return sliding_windows(termcount(spark, folder), DAY, DAY)


def daily_corpus(spark: SparkSession, folder: str) -> similarity.Corpus:
    return similarity.collapse_copies(terms.tfidf_vectors(daily(spark, folder)))


def daily_clusters(spark: SparkSession, folder: str) -> clusters.Clusters:
    """The stored cluster, link and keyword tables of the daily runs."""
    names = ("clusters", "links", "keywords")
    key = (spark.sparkContext.applicationId, folder)
    if (*key, "clusters") not in _stored:
        found = clusters.cluster_articles(daily(spark, folder), "threshold", {"threshold": THRESHOLD})
        for name in names:
            stored(spark, folder, name, lambda: getattr(found, name))
    return clusters.Clusters(*[_stored[(*key, name)] for name in names])


def shown(df: DataFrame, *columns: str | Column) -> DataFrame:
    """Window bounds and other times as text."""
    picked = [F.col(c) if isinstance(c, str) else c for c in (columns or df.columns)]
    out = df.select(*picked)
    kinds = dict(out.dtypes)
    return out.select(*[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) if kinds[c].startswith("timestamp") else F.col(c)
                        for c in out.columns])


# Sources and sinks

@query
def load_registry(spark, folder):
    rows = views.source(spark, folder).withColumn("extra", F.lit("ignored"))
    path = fresh_path(spark, "registry")
    (rows.agg(F.to_json(F.sort_array(F.collect_list(F.struct("id", "name", "extra")))).alias("value"))
     .write.text(path))
    return registry.load_registry(spark, path, "source").select("id", "name")


@query
def select_sources(spark, folder):
    return registry.select_sources(views.source(spark, folder), ["src1", "src2", "src3"])


def _feeds(spark, folder) -> DataFrame:
    one = F.concat(F.lit('{"id": "'), F.col("name"), F.lit('"}'))
    two = F.concat(F.lit("["), one, F.lit(', {"class_": "story", "regex": true}]'))
    return registry.normalise_selector_config(views.source(spark, folder).select(
        F.col("name").alias("id"), F.col("id").alias("source_id"),
        F.concat(F.lit("https://"), F.col("name"), F.lit(".example.com/feed")).alias("url"),
        F.when(F.col("id") < 5, two).otherwise(one).alias("parser_config"), F.lit(True).alias("is_okay")))


@query
def normalise_selector_config(spark, folder):
    return _feeds(spark, folder).select("id", F.posexplode("parser_config").alias("position", "s")).select(
        "id", "position", F.col("s.id").alias("selector_id"), F.col("s.class_").alias("selector_class"),
        F.coalesce("s.regex", F.lit(False)).alias("regex"))


def _feed_responses(spark, folder) -> DataFrame:
    status = F.when(F.col("source_id") < 2, 301).when(F.col("source_id") < 4, 410).when(F.col("source_id") < 5, 503).otherwise(200)
    return _feeds(spark, folder).select(
        F.col("id").alias("rss_feed_id"), "source_id", "url", status.alias("status"),
        F.concat("url", F.lit("/new")).alias("href"))


@query
def route_feed_responses(spark, folder):
    return feeds.route_feed_responses(_feed_responses(spark, folder)).select("rss_feed_id", "status", "action")


@query
def apply_feed_updates(spark, folder):
    updated = feeds.apply_feed_updates(_feeds(spark, folder), _feed_responses(spark, folder))
    return updated.select("id", "url", "is_okay")


@query
def select_feeds(spark, folder):
    updated = feeds.apply_feed_updates(_feeds(spark, folder), _feed_responses(spark, folder))
    names = ["src1", "src2", "src4", "src7", "src11"]
    return registry.select_feeds(updated, views.source(spark, folder), names).select("id", "source_id", "url")


@query
def window_scan_half_day(spark, folder):
    rows = window_scan(views.article(spark, folder), "2024-01-01 06:00:00", "2024-01-01 18:00:00")
    return shown(rows, "article_id", "url", "added_at")


@query
def batch_scan_one_tag(spark, folder):
    return shown(batch_scan(views.article(spark, folder), "2024-01-01 12:00:00"), "article_id", "url", "added_at")


@query
def insert_ignore(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type", "value", F.col("ts").alias("added_at"))
    present = events.filter("value > 50")
    return shown(tables.insert_ignore(events, present, ["user_id", "event_type"], [F.col("added_at"), F.col("event_id")]))


@query
def rows_added(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type", "value", F.col("ts").alias("added_at"))
    new = tables.insert_ignore(events, events.filter("value > 50"), ["user_id", "event_type"], [F.col("added_at"), F.col("event_id")])
    return new.agg(F.count("*").alias("rows_added"))


@query
def upsert(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type", "value")
    return tables.upsert(events.filter("value > 50"), events.filter("value <= 50"), ["user_id", "event_type"], [F.col("event_id")])


def _page_responses(spark, folder) -> DataFrame:
    pages = table(spark, folder, "pages")
    status = F.when(F.col("url").contains("?"), 404).when(F.length("html") < 2000, F.lit(None)).otherwise(200)
    return pages.select(F.col("page_id").alias("article_id"), status.alias("status"), F.col("html").alias("content"))


@query
def accept_pages(spark, folder):
    kept = articles.accept_pages(_page_responses(spark, folder), F.lit("2024-01-01 00:00:00").cast("timestamp"))
    return shown(kept.select("article_id", F.length("content").alias("length"), "added_at"))


@query
def fetch_report(spark, folder):
    return articles.fetch_report(_page_responses(spark, folder))


@query
def write_clusters(spark, folder):
    path = fresh_path(spark, "clusters")
    found = daily_clusters(spark, folder)
    # The same run twice, as when it is repeated after a failure.
    for _ in range(2):
        tables.write_clusters(found, path)
    kept = spark.read.schema(found.clusters.schema).parquet(f"{path}/articlecluster")
    links = spark.read.schema(found.links.schema).parquet(f"{path}/articleclusterlink")
    words = spark.read.schema(found.keywords.schema).parquet(f"{path}/articleclusterkeyword")
    sizes = links.groupBy(F.col("cluster_id").alias("id")).agg(F.count("*").alias("size"))
    terms_of = words.groupBy(F.col("cluster_id").alias("id")).agg(F.count("*").alias("keywords"))
    return shown(kept.join(sizes, "id").join(terms_of, "id"))


# Feed bodies and pages

def _feed_bodies(spark, folder) -> DataFrame:
    """One feed response per document, in the two formats, made from its columns."""
    day = F.date_format(views.slot_time(F.col("doc_id")), "dd MMM yyyy HH:mm:ss")
    link = F.concat(F.lit("https://"), F.col("source"), F.lit(".example.com/a/"), F.col("doc_id"), F.lit("?ref=feed"))
    summary = F.concat(F.lit("&lt;p&gt;"), F.col("lang"), F.lit(" &amp;amp; "), F.col("n_chars"), F.lit("&lt;/p&gt;"))
    rss = F.concat(
        F.lit("<rss><channel><title>"), "source", F.lit("</title><item><title>Story "), "doc_id", F.lit("</title><link>"), link,
        F.lit("</link><description>"), F.when(F.col("lang") != "es", summary).otherwise(""), F.lit("</description><pubDate>"),
        day, F.lit(" EST</pubDate></item></channel></rss>"))
    atom = F.concat(
        F.lit('<feed xmlns="http://www.w3.org/2005/Atom"><title>'), "source", F.lit("</title><entry><title>Story "), "doc_id",
        F.lit('</title><link rel="alternate" href="'), link, F.lit('"/><summary>'), summary, F.lit("</summary>"),
        F.when(F.col("lang") == "de", F.lit("")).otherwise(F.concat(
            F.lit("<published>"), F.date_format(views.slot_time(F.col("doc_id")), "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit("</published>"))),
        F.lit("</entry></feed>"))
    return table(spark, folder, "documents").select(
        F.col("doc_id").cast("string").alias("rss_feed_id"), F.substring("source", 4, 10).cast("int").alias("source_id"),
        F.lit("https://x.example.com/feed").alias("url"), F.lit(200).alias("status"), F.lit(None).cast("string").alias("href"),
        F.when(F.col("lang").isin("de", "fr"), atom).otherwise(rss).alias("body"))


@query
def parse_feed_entries(spark, folder):
    return feeds.flatten_entries(feeds.parse_feed_xml(_feed_bodies(spark, folder)).feeds)


@query
def rejected_feeds(spark, folder):
    return feeds.parse_feed_xml(_feed_bodies(spark, folder)).rejects


@query
def entries_to_articles(spark, folder):
    entries = feeds.flatten_entries(feeds.parse_feed_xml(_feed_bodies(spark, folder)).feeds)
    made = feeds.entries_to_articles(entries, F.lit("2024-06-01 00:00:00").cast("timestamp"))
    valid, _ = feeds.split_valid(made)
    return shown(valid)


@query
def extract_container(spark, folder):
    """Pages through an ordered list of selectors; the first misses every page."""
    config = registry.selectors(F.lit('[{"id": "main"}, {"name": "article"}]'))
    pages = views.rawcontent(spark, folder).withColumn("parser_config", config)
    return extract_container_text(pages)


@query
def parse_pages(spark, folder):
    """A container without paragraphs gives empty text; pages without the container are left out."""
    config = registry.selectors(F.lit('{"class_": "^ad$", "regex": true}'))
    pages = views.rawcontent(spark, folder).withColumn("parser_config", config)
    parsed = articles.parse_pages(pages, F.lit("2024-01-01 00:00:00").cast("timestamp"))
    return shown(parsed)


@query
def dedupe_titles(spark, folder):
    every = views.article(spark, folder)
    kept = articles.dedupe_titles(every, every, F.lit("2024-01-01 00:00:00").cast("timestamp"), timedelta(hours=6))
    return shown(kept, "article_id", "source_id", "url", "added_at")


# Text and time functions

@query
def strip_markup(spark, folder):
    return views.rawcontent(spark, folder).select("article_id", text.strip_markup(F.col("content")).alias("content"))


@query
def clean_text(spark, folder):
    return views.rawcontent(spark, folder).select("article_id", text.clean_text(F.col("content")).alias("content"))


@query
def strip_query(spark, folder):
    return table(spark, folder, "pages").select("page_id", text.strip_query(F.col("url")).alias("url"), text.is_url(F.col("url")).alias("is_url"))


@query
def parse_time(spark, folder):
    events = table(spark, folder, "events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    layouts = [("EEE, dd MMM yyyy HH:mm:ss", " EST"), ("EEE, d MMM yyyy HH:mm", " EDT"), ("yyyy-MM-dd'T'HH:mm:ss'Z'", ""), ("HH:mm:ss", ""),
               ("yyyy-MM-dd HH:mm:ss", "+02:00"), ("dd MMM yy HH:mm:ss", " GMT"), ("EEE, dd MMM yyyy HH:mm:ss", " PST"), ("EEE MMM d HH:mm:ss yyyy", ""),
               ("yyyyMMdd'T'HHmmss'Z'", ""), ("EEE, dd MMM yyyy HH:mm:ss", " +0000 (UTC)"), ("MM.dd.yyyy HH:mm", ""), ("dd MMM yyyy HH:mm:ss", " UT")]
    kind = F.pmod("event_id", F.lit(len(layouts)))
    written = F.coalesce(*[F.when(kind == i, F.concat(F.date_format("ts", layout), F.lit(zone))) for i, (layout, zone) in enumerate(layouts)])
    parsed = times.parse_time(written, F.lit("2024-06-01 00:00:00").cast("timestamp"))
    return shown(events.select("event_id", parsed.alias("parsed")))


@query
def format_time(spark, folder):
    at = F.col("ts").cast("timestamp")
    return table(spark, folder, "events").select("event_id", times.format_time(at).alias("written"), times.day_string(at).alias("day"))


@query
def interval_eq(spark, folder):
    events = table(spark, folder, "events").select(F.col("ts").cast("timestamp").alias("begin"), "event_id", "event_type")
    end = F.when(F.col("event_type") == "click", F.col("begin") + F.expr("interval 24 hours")).otherwise(F.col("begin") + F.expr("interval 1 hour"))
    return events.withColumn("end", end).select("event_id", times.interval_eq(F.col("begin"), F.col("end"), {"days": 1}).alias("is_day"))


@query
def tokenise(spark, folder):
    """Tokens per document, repeats kept, stop words dropped."""
    docs = views.parsedcontent(spark, folder)
    return docs.select("article_id", F.size(text.tokenise(F.col("content"), STOP_WORDS)).alias("tokens"))


@query
def text_match(spark, folder):
    return text.text_match(table(spark, folder, "documents"), ["text"], ["the", "and"]).select("doc_id")


# Terms

@query
def term_counts(spark, folder):
    return terms.term_counts(views.parsedcontent(spark, folder)).select("article_id", "term", "count")


@query
def term_counts_stop_words(spark, folder):
    counts = terms.term_counts(views.parsedcontent(spark, folder), text.tokenizer(STOP_WORDS))
    return counts.select("article_id", "term", "count")


@query
def lemma_counts(spark, folder):
    counts = termcount(spark, folder)
    plural = counts.filter(F.length("term") > 3).filter(F.col("term").endswith("s")).select(F.col("term").alias("form")).distinct()
    lemmas = plural.withColumn("lemma", F.expr("substring(form, 1, length(form) - 1)"))
    return text.lemmatise(counts, lemmas).select("article_id", "term", "count")


@query
def sliding_window_counts(spark, folder):
    """Articles in the day before every sixth hour."""
    rows = sliding_windows(views.article(spark, folder), DAY, timedelta(hours=6))
    return shown(rows.groupBy(*RUN).agg(F.count("*").alias("articles")))


@query
def doc_frequency(spark, folder):
    counts = daily(spark, folder)
    return shown(terms.doc_frequency(counts).join(terms.article_total(counts), RUN))


@query
def tfidf(spark, folder):
    weights = terms.tfidf(daily(spark, folder))
    return shown(weights.withColumn("weight", F.round("weight", 6)))


# Similarity and clusters

@query
def similar_pairs(spark, folder):
    pairs = similarity.similar_pairs(terms.tfidf_vectors(daily(spark, folder)), THRESHOLD)
    return shown(pairs.withColumn("cosine", F.round("cosine", 6)))


def _labels(spark, folder, method: str, **parameters) -> DataFrame:
    corpus = daily_corpus(spark, folder)
    return shown(clusters.label_members(corpus, clusters.METHODS[method](corpus, **parameters)))


# Sizes so small that each window is many blocks.
SMALL_BLOCKS = similarity.Limits(block_postings=20_000, block_articles=40)


@query
def similar_pairs_blocks(spark, folder):
    pairs = similarity.similar_pairs(terms.tfidf_vectors(daily(spark, folder)), THRESHOLD, SMALL_BLOCKS)
    return shown(pairs.withColumn("cosine", F.round("cosine", 6)))


@query
def threshold_clusters_blocks(spark, folder):
    return _labels(spark, folder, "threshold", threshold=THRESHOLD, limits=SMALL_BLOCKS)


@query
def dbscan_clusters_blocks(spark, folder):
    return _labels(spark, folder, "dbscan", eps=1.0, min_samples=3, limits=SMALL_BLOCKS)


@query
def threshold_clusters(spark, folder):
    """Labels in every closed day, single articles included."""
    return _labels(spark, folder, "threshold", threshold=THRESHOLD)


@query
def cluster_count(spark, folder):
    corpus = daily_corpus(spark, folder)
    found = clusters.threshold_components(corpus, 0.6)
    return shown(clusters.cluster_count(found))


@query
def threshold_clusters_wide(spark, folder):
    """One window holding every article, where hot terms and large components show."""
    at = views.slot_time(F.lit(0))
    counts = termcount(spark, folder).withColumns({"begin": at, "end": at + F.lit(LONG)})
    corpus = similarity.collapse_copies(terms.tfidf_vectors(counts))
    labels = clusters.threshold_components(corpus, THRESHOLD)
    return clusters.label_members(corpus, labels).select("article_id", "label")


@query
def sweep_counts(spark, folder):
    _, counts = clusters.threshold_sweep(daily_corpus(spark, folder))
    return shown(counts.select(*RUN, "step", "cluster_count"))


def _plateau(spark, folder, arbitration: str) -> DataFrame:
    _, counts = clusters.threshold_sweep(daily_corpus(spark, folder))
    chosen = clusters.plateau_choice(counts, arbitration)
    return shown(chosen.withColumn("threshold", F.round("threshold", 6)))


@query
def plateau_coarse(spark, folder):
    return _plateau(spark, folder, clusters.COARSE)


@query
def plateau_fine(spark, folder):
    return _plateau(spark, folder, clusters.FINE)


@query
def sweep_clusters(spark, folder):
    return _labels(spark, folder, "sweep", arbitration=clusters.FINE)


@query
def dbscan_clusters(spark, folder):
    """Cosine 0.5 and three articles make a core; noise is left out."""
    return _labels(spark, folder, "dbscan", eps=1.0, min_samples=3)


@query
def ward_clusters(spark, folder):
    return _labels(spark, folder, "ward", distance_threshold=0.2)


@query
def fixed_k_clusters(spark, folder):
    return _labels(spark, folder, "fixed_k", k=2)


@query
def story_clusters(spark, folder):
    """The stored tables of the daily runs: each cluster of two or more with its members."""
    found = daily_clusters(spark, folder)
    joined = found.clusters.join(found.links, found.clusters["id"] == found.links["cluster_id"])
    return shown(joined, "id", "type", *RUN, "added_at", "article_id")


def _sliding_members(spark, folder, size: timedelta, slide: timedelta) -> DataFrame:
    found = clusters.cluster_sliding(termcount(spark, folder), size, slide, "threshold", {"threshold": THRESHOLD})
    return shown(found.clusters.join(found.links, found.clusters["id"] == found.links["cluster_id"]), "id", *RUN, "article_id")


@query
def story_clusters_12h_hourly(spark, folder):
    """Windows of half a day ending every hour, by panes."""
    return _sliding_members(spark, folder, timedelta(hours=12), timedelta(hours=1))


@query
def story_clusters_3d_6h(spark, folder):
    """Windows of three days ending every six hours, by panes."""
    return _sliding_members(spark, folder, timedelta(days=3), timedelta(hours=6))


@query
def sliding_tfidf(spark, folder):
    """Weights in windows of half a day ending every six hours."""
    vectors = terms.sliding_tfidf_vectors(termcount(spark, folder), timedelta(hours=12), timedelta(hours=6))
    return shown(terms.explode_vectors(vectors).select(*RUN, "article_id", "term", F.round("weight", 6).alias("weight")))


@query
def cluster_keywords(spark, folder):
    found = daily_clusters(spark, folder)
    return found.keywords.withColumn("weight", F.round("weight", 6))


# Report

@query
def cluster_source_count(spark, folder):
    found = daily_clusters(spark, folder)
    return report.source_count(found.links, views.article(spark, folder), views.source(spark, folder))


@query
def latest_added_at(spark, folder):
    return shown(report.latest_added_at(daily_clusters(spark, folder).clusters, {"days": 1}))


def _latest(spark, folder):
    found = daily_clusters(spark, folder)
    every, named = views.article(spark, folder), views.source(spark, folder)
    return found, every, named, report.latest_clusters(found.clusters, found.links, every, named, {"hours": 24})


@query
def latest_clusters(spark, folder):
    return shown(_latest(spark, folder)[-1], "id", "type", *RUN, "added_at", "size")


@query
def cluster_members(spark, folder):
    found, every, named, top = _latest(spark, folder)
    return report.cluster_members(top, found.links, every, named)


@query
def latest_document(spark, folder):
    """The published document read back from its file, one row per cluster."""
    found, every, named, top = _latest(spark, folder)
    document = report.prep_latest(report.collect_cluster(top, found.links, found.keywords, every, named))
    out = fresh_path(spark, "published")
    path = tables.publish_json(document, out, {"days": 1})
    shape = T.StructType([T.StructField("value", T.StringType())])
    schema = document.schema["document"].dataType
    read = spark.read.schema(shape).text(path).select(F.from_json("value", schema).alias("d"))
    return read.select(F.col("d.added_at").alias("added_at"), F.posexplode("d.clusters").alias("position", "c")).select(
        "added_at", "position", F.col("c.source_count").alias("source_count"), F.size("c.topics").alias("topics"),
        F.size("c.articles").alias("articles"), F.col("c.articles")[0]["url"].alias("newest"))


# Lookup

def _lookups(spark, folder) -> DataFrame:
    """Page addresses, which no article has; article addresses with a query string; and pieces of them."""
    pages = table(spark, folder, "pages").select((F.col("page_id") * 3).alias("query_id"), "url")
    every = views.article(spark, folder)
    whole = every.select((F.col("article_id") * 3 + 1).alias("query_id"), F.concat("url", F.lit("?utm=x")).alias("url"))
    piece = every.select((F.col("article_id") * 3 + 2).alias("query_id"), F.expr("substring(url, 9, 200)").alias("url"))
    return pages.unionByName(whole).unionByName(piece)


@query
def find_article(spark, folder):
    return lookup.find_article(_lookups(spark, folder), views.article(spark, folder))


@query
def find_article_like(spark, folder):
    """Addresses with a sign that matches any letter."""
    every = views.article(spark, folder)
    asked = every.select(F.col("article_id").alias("query_id"), F.replace("url", F.lit("src"), F.lit("s_c")).alias("url"))
    return lookup.find_article(asked, every, like_semantics=True)


def _lookup_run(spark, folder):
    found = daily_clusters(spark, folder)
    every = views.article(spark, folder)
    asked = _lookups(spark, folder)
    hits = staged(lookup.find_article(asked, every), "hits")
    return asked, hits, lookup.related_articles(hits, found.clusters, found.links, every, views.source(spark, folder))


@query
def related_articles(spark, folder):
    _, _, related = _lookup_run(spark, folder)
    return shown(related, "query_id", "position", "article_id", "url", "date", "title", "source")


@query
def response_count(spark, folder):
    _, hits, related = _lookup_run(spark, folder)
    return lookup.response_count(hits, related)


@query
def search_log(spark, folder):
    asked, hits, related = _lookup_run(spark, folder)
    stamped = asked.withColumn("timestamp", views.slot_time(F.col("query_id")))
    return shown(lookup.search_log(stamped, hits, related))


# Streams

def _document_stream(spark, folder) -> DataFrame:
    """The documents as a stream, whether the table is one file or a folder of files; a stream takes a single file only by a pattern."""
    schema = table(spark, folder, "documents").schema
    return spark.readStream.schema(schema).parquet(f"{folder}/documents.parque[t]")


_KINDS = {"article_id": T.LongType(), "term": T.StringType(), "count": T.LongType(), "content": T.StringType(),
          "added_at": T.TimestampType(), "source_id": T.IntegerType(), "url": T.StringType(), "title": T.StringType()}


def _schema(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, _KINDS[n]) for n in names])


@query
def stream_term_counts(spark, folder):
    """Documents to parsed content to term counts, each stage following the table before it."""
    root = fresh_path(spark, "chain")
    parsed, counts = _schema("article_id", "content", "added_at"), _schema("article_id", "term", "count", "added_at")
    docs = _document_stream(spark, folder).select(
        F.col("doc_id").alias("article_id"), F.col("text").alias("content"), views.slot_time(F.col("doc_id")).alias("added_at"))
    chain.chain(docs, lambda batch: batch, f"{root}/parsedcontent", parsed, ["article_id"], [F.col("added_at")], f"{root}/cp1")
    upstream = spark.readStream.schema(parsed).parquet(f"{root}/parsedcontent")
    chain.stream_term_counts(upstream, f"{root}/termcount", counts, f"{root}/cp2")
    return tables.table_at(spark, f"{root}/termcount", counts).select("article_id", "term", "count")


@query
def stream_dedupe_titles(spark, folder):
    """All articles, then all again under other addresses, some retitled: re-posted titles are left out."""
    root = fresh_path(spark, "titles")
    schema = _schema("article_id", "source_id", "url", "title", "added_at")
    first = views.article(spark, folder).select(*schema.fieldNames())
    tables.append(first, f"{root}/articles")
    later = F.col("doc_id") + 1_000_000
    again = _document_stream(spark, folder).select(
        F.col("doc_id").alias("article_id"), F.substring("source", 4, 10).cast("int").alias("source_id"),
        F.concat(F.lit("https://new.example.com/"), F.col("doc_id")).alias("url"),
        F.when(F.col("lang") == "en", F.substring("text", 1, 60)).otherwise(F.concat(F.lit("Re "), F.substring("text", 1, 60))).alias("title"),
        views.slot_time(later).alias("added_at"))
    chain.stream_dedupe_titles(again, f"{root}/articles", schema, f"{root}/cp", LONG)
    return shown(tables.table_at(spark, f"{root}/articles", schema))


# Tables laid out by hash prefix of the key and by day

EVENT_LAYOUT = tables.Layout(("user_id", "event_type"), parts=8)
ARTICLE_LAYOUT = tables.Layout(("url",), parts=8)
COUNT_LAYOUT = tables.Layout(("article_id", "term"), parts=4)


def _laid_out(spark, folder, name: str, rows: DataFrame, layout: tables.Layout) -> DataFrame:
    """The rows as a stored table with this layout, written once per session and folder."""
    key = (spark.sparkContext.applicationId, folder, f"{name}-laid-out")
    if key not in _stored:
        path = fresh_path(spark, name)
        tables.append(rows, path, layout)
        _stored[key] = tables.table_at(spark, path, rows.schema, layout)
    return _stored[key]


@query
def insert_ignore_laid_out(spark, folder):
    """A batch against a stored table of which only the parts of the batch's keys are read."""
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type", "value", F.col("ts").cast("timestamp").alias("added_at"))
    stored_events = _laid_out(spark, folder, "events", events.filter("value > 50"), EVENT_LAYOUT)
    present = EVENT_LAYOUT.touched(stored_events, events)
    return shown(tables.insert_ignore(events, present, list(EVENT_LAYOUT.keys), [F.col("added_at"), F.col("event_id")]))


@query
def window_scan_laid_out(spark, folder):
    every = _laid_out(spark, folder, "articles", views.article(spark, folder), ARTICLE_LAYOUT)
    return shown(window_scan(every, "2024-01-01 06:00:00", "2024-01-01 18:00:00"), "article_id", "url", "added_at")


@query
def dedupe_titles_laid_out(spark, folder):
    every = _laid_out(spark, folder, "articles", views.article(spark, folder), ARTICLE_LAYOUT)
    kept = articles.dedupe_titles(views.article(spark, folder), every, F.lit("2024-01-01 00:00:00").cast("timestamp"), timedelta(hours=6))
    return shown(kept, "article_id", "source_id", "url", "added_at")


@query
def windows_scan_laid_out(spark, folder):
    """Term counts of two listed windows, of which one lies across midnight."""
    counts = _laid_out(spark, folder, "termcount", termcount(spark, folder), COUNT_LAYOUT)
    asked = spark.createDataFrame([("2024-01-01 06:00:00", "2024-01-01 18:00:00"), ("2024-01-01 22:00:00", "2024-01-02 04:00:00")], "begin string, end string")
    rows = windows_scan(counts, asked.select(*[F.col(c).cast("timestamp").alias(c) for c in RUN]))
    return shown(rows, *RUN, "article_id", "term", "count")


# The whole chain, from articles to the published document

def _story_pages(spark, folder) -> DataFrame:
    """A page around each document's text, its container named as the feed's selectors of its source say; every tenth has none."""
    text = F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    main = F.concat(F.lit('<div id="'), "source", F.lit('">'))
    # The first selector of these feeds misses, the second one finds the class by a pattern.
    other = F.concat(F.lit('<section class="wide '), F.when(F.col("doc_id") % 2 == 0, "story-text").otherwise("story"), F.lit('">'))
    fallback = (F.substring("source", 4, 10).cast("int") < 5) & (F.col("doc_id") % 3 == 0)
    start = F.when(F.col("doc_id") % 10 == 0, "<div>").when(fallback, other).otherwise(main)
    page = F.concat(F.lit('<html><head><title>x</title></head><body><div class="ad"><p>buy</p></div>'), start, F.lit("<h1>Head</h1><p>"), text,
                    F.lit("</p></div></section><p>after</p></body></html>"))
    return table(spark, folder, "documents").select(F.col("doc_id").alias("article_id"), F.col("source").alias("rss_feed_id"), page.alias("content"),
                                                   F.lit(200).alias("status"))


@query
def extract_by_feed(spark, folder):
    """Pages through the selectors of their own feeds, joined as a stage of the chain does it."""
    pages = _story_pages(spark, folder).filter("content is not null")
    owners = pages.select(F.col("article_id").alias("id"), "rss_feed_id")
    chosen = articles.with_selectors(pages.select("article_id", "content"), owners, _feeds(spark, folder))
    return articles.drop_failed(extract_container_text(chosen), "content")


def _run_chain(spark, folder, root: str, docs: DataFrame) -> clusters.Clusters:
    """Every stage from new articles to cluster tables, each following the table before it, with checkpoints below ``root``."""
    article = T.StructType([T.StructField("article_id", T.LongType()), T.StructField("rss_feed_id", T.StringType()), T.StructField("url", T.StringType()),
                            T.StructField("added_at", T.TimestampType())])
    content, counts = _schema("article_id", "content", "added_at"), _schema("article_id", "term", "count", "added_at")
    by_url, by_article, by_term = tables.Layout(("url",), 4), tables.Layout(("article_id",), 4), tables.Layout(("article_id", "term"), 4)

    def upstream(name: str, schema: T.StructType) -> DataFrame:
        return spark.readStream.schema(schema).parquet(f"{root}/{name}")

    made = docs.select(F.col("doc_id").alias("article_id"), F.col("source").alias("rss_feed_id"),
                       F.concat(F.lit("https://"), "source", F.lit(".example.com/a/"), "doc_id").alias("url"), views.slot_time(F.col("doc_id")).alias("added_at"))
    chain.chain(made, lambda batch: batch, f"{root}/article", article, ["url"], [F.col("added_at")], f"{root}/cp-article", by_url)
    chain.stream_raw_pages(upstream("article", article), _story_pages(spark, folder).select("article_id", "status", "content"),
                           f"{root}/rawcontent", content, f"{root}/cp-raw", by_article)
    owners = lambda: tables.table_at(spark, f"{root}/article", article, by_url).select(F.col("article_id").alias("id"), "rss_feed_id")
    chain.stream_parsed_pages(upstream("rawcontent", content), owners, _feeds(spark, folder), f"{root}/parsedcontent", content, f"{root}/cp-parsed",
                              f"{root}/rejected", by_article)
    chain.stream_term_counts(upstream("parsedcontent", content), f"{root}/termcount", counts, f"{root}/cp-counts", layout=by_term)
    chain.stream_clusters(upstream("termcount", counts), lambda: tables.table_at(spark, f"{root}/termcount", counts, by_term), Panes(DAY, DAY),
                          "threshold", {"threshold": THRESHOLD}, f"{root}/clusters", f"{root}/cp-clusters")
    links = T.StructType([T.StructField("cluster_id", T.StringType()), T.StructField("article_id", T.LongType())])
    return clusters.Clusters(*tables.cluster_tables(spark, f"{root}/clusters", (CLUSTER, links, CLUSTER_KEYWORD)))


@query
def chain_clusters(spark, folder):
    """Documents come in two parts; the second changes windows that the first has filled already. The members after both."""
    root = fresh_path(spark, "chain")
    docs = table(spark, folder, "documents")
    early = F.pmod("doc_id", F.lit(5)) < 3
    for part in (early, ~early):
        docs.filter(part).write.mode("append").parquet(f"{root}/documents")
        found = _run_chain(spark, folder, root, spark.readStream.schema(docs.schema).parquet(f"{root}/documents"))
    return shown(found.clusters.join(found.links, found.clusters["id"] == found.links["cluster_id"]), "id", *RUN, "article_id")


# Searches, the document in lines, the stored log, registry files of every table

@query
def search_all_words(spark, folder):
    """For each benchmark text the documents that hold its first three words, through a stored index."""
    index = search.build_index(table(spark, folder, "documents"), "doc_id", ["text"], fresh_path(spark, "index"))
    words = F.slice(text.tokenise(F.col("text")), 1, 3)
    asked = table(spark, folder, "benchmark").select(F.col("item_id").alias("query_id"), F.array_join(words, " ").alias("words"))
    return search.search(index, asked)


@query
def latest_document_lines(spark, folder):
    """All members of the published document, read back from its one file."""
    found, every, named, top = _latest(spark, folder)
    top = staged(top, "top")
    path = tables.publish_lines(report.document_lines(top, found.links, found.keywords, every, named), fresh_path(spark, "published"), {"days": 1})
    member = "struct<title: string, url: string, source: string, date: string>"
    shape = f"added_at string, clusters array<struct<source_count: long, topics: array<struct<term: string, weight: double>>, articles: array<{member}>>>"
    read = spark.read.schema(shape).option("multiLine", True).json(path)
    return read.select("added_at", F.posexplode("clusters").alias("place", "c")).select(
        "added_at", "place", F.col("c.source_count").alias("source_count"), F.size("c.topics").alias("topics"),
        F.posexplode("c.articles").alias("position", "a")).select("added_at", "place", "source_count", "topics", "position", "a.*")


@query
def append_search_log(spark, folder):
    """The log of two runs in its stored table: one row per lookup and run."""
    asked, hits, related = _lookup_run(spark, folder)
    related = staged(related.select("query_id"), "related")  # what a log reads of it, worked out once for both runs
    path = fresh_path(spark, "log")
    for hour in (0, 1):
        at = views.slot_time(F.col("query_id")) + F.make_dt_interval(hours=F.lit(hour))
        tables.append_search_log(lookup.search_log(asked.withColumn("timestamp", at), hits, related), path)
    return shown(spark.read.parquet(path).select("query_id", "timestamp", "status_code", "target_url", "client_id", "referer", "response_count"))


def _registry_file(spark, rows: DataFrame, name: str) -> DataFrame:
    """The rows as a JSON array file, read back as a registry table."""
    path = fresh_path(spark, name)
    rows.agg(F.to_json(F.sort_array(F.collect_list(F.struct(*rows.columns)))).alias("value")).write.text(path)
    return registry.load_registry(spark, path, name)


@query
def load_registry_feeds(spark, folder):
    """Feeds of the sources, some with one selector and some with a list, and a key that no table has."""
    one = F.concat(F.lit('{"id": "'), F.col("name"), F.lit('"}'))
    config = F.when(F.col("id") < 5, F.concat(F.lit("["), one, F.lit(', {"class_": "story", "regex": true}]'))).otherwise(one)
    rows = views.source(spark, folder).select(F.col("id").alias("source_id"), F.concat(F.lit("https://"), "name", F.lit(".example.com/feed")).alias("url"),
                                              config.alias("parser_config"), F.lit("centre").alias("rating"))
    feeds_ = _registry_file(spark, rows, "rssfeed")
    return feeds_.select("id", "source_id", "url", "is_okay", F.posexplode("parser_config").alias("position", "s")).select(
        "id", "source_id", "url", "is_okay", "position", F.col("s.id").alias("selector_id"), F.col("s.class_").alias("selector_class"))


@query
def load_registry_bias(spark, folder):
    rows = views.source(spark, folder).select(F.col("id").alias("source_id"), F.lit("ALLSIDES").alias("type"),
                                              F.element_at(F.array(F.lit("left"), F.lit("centre"), F.lit("right")), F.pmod("id", F.lit(3)).cast("int") + 1).alias("value"))
    return _registry_file(spark, rows, "bias")


@query
def threshold_clusters_stop_words(spark, folder):
    """Labels of every closed day from term counts without stop words."""
    counts = terms.term_counts(views.parsedcontent(spark, folder), text.tokenizer(STOP_WORDS))
    corpus = similarity.collapse_copies(terms.tfidf_vectors(sliding_windows(counts, DAY, DAY)))
    return shown(clusters.label_members(corpus, clusters.threshold_components(corpus, THRESHOLD)))


@query
def related_counts(spark, folder):
    """The number of related articles of each lookup, without listing them."""
    found = daily_clusters(spark, folder)
    hits = lookup.find_article(_lookups(spark, folder), views.article(spark, folder))
    return lookup.related_counts(hits, found.clusters, found.links)


@query
def find_repeated(spark, folder):
    """Home pages and repeated addresses: each is looked for once, however often it is asked for."""
    every = views.article(spark, folder)
    home = every.select((F.col("article_id") * 2).alias("query_id"), F.concat(F.substring_index("url", "/a/", 1), F.lit("?page="), "article_id").alias("url"))
    again = every.select((F.col("article_id") * 2 + 1).alias("query_id"), F.concat(F.lit("src1.example.com/a/"), F.pmod("article_id", F.lit(7))).alias("url"))
    return lookup.find_article(home.unionByName(again), every)


@query
def parse_rdf_entries(spark, folder):
    """Entries of RSS 1.0 bodies, with names of characters that HTML knows and XML does not."""
    day = F.date_format(views.slot_time(F.col("doc_id")), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    body = F.concat(
        F.lit('<?xml version="1.0"?><rdf:RDF xmlns="http://purl.org/rss/1.0/" xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#"'
              ' xmlns:dc="http://purl.org/dc/elements/1.1/"><channel><title>'), "source", F.lit("</title></channel><item><title>Caf&eacute;&nbsp;"), "doc_id",
        F.lit(" &amp; &unknown;</title><link>https://example.com/"), "doc_id", F.lit("</link><description>&euro; "), "n_chars",
        F.lit("</description><dc:date>"), day, F.lit("</dc:date><dc:creator>"), "lang", F.lit("</dc:creator></item></rdf:RDF>"))
    bodies = table(spark, folder, "documents").select(
        F.col("doc_id").cast("string").alias("rss_feed_id"), F.substring("source", 4, 10).cast("int").alias("source_id"),
        F.lit("https://x.example.com/feed").alias("url"), F.lit(200).alias("status"), body.alias("body"))
    return feeds.flatten_entries(feeds.parse_feed_xml(bodies).feeds)
