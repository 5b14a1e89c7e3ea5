"""Feed bodies to articles."""

from __future__ import annotations

from dataclasses import dataclass
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storyweave.functions.text import clean_text, is_url, strip_query
from storyweave.functions.times import parse_time

# Layouts of the three feed formats, as far as their elements are used.
RSS = ("channel STRUCT<title: STRING, item: ARRAY<STRUCT<title: STRING, link: STRING, description: STRING, "
       "pubDate: STRING, author: STRING, creator: STRING>>>")
RDF = ("channel STRUCT<title: STRING>, item ARRAY<STRUCT<title: STRING, link: STRING, description: STRING, "
       "date: STRING, creator: STRING>>")
ATOM = ("title STRING, entry ARRAY<STRUCT<title: STRING, link: ARRAY<STRUCT<_href: STRING, _rel: STRING>>, "
        "summary: STRING, published: STRING, author: ARRAY<STRUCT<name: STRING>>>>")


# Names of characters that HTML knows and XML does not; any other name stays as text.
ENTITIES = ("nbsp", "copy", "reg", "trade", "hellip", "mdash", "ndash", "lsquo", "rsquo", "ldquo", "rdquo", "bull", "middot",
            "laquo", "raquo", "euro", "pound", "yen", "cent", "sect", "deg", "plusmn", "times", "aacute", "agrave", "acirc", "auml",
            "ccedil", "eacute", "egrave", "ecirc", "euml", "iacute", "ntilde", "oacute", "ocirc", "ouml", "szlig", "uacute", "uuml")


def _without_entities(body: Column) -> Column:
    told = body
    for name in ENTITIES:
        told = F.replace(told, F.lit(f"&{name};"), F.lit(chr(name2codepoint[name])))
    # Most bodies have none of these names: one look saves them a pass for each.
    body = F.when(body.rlike("&(?!(?:amp|lt|gt|quot|apos);)[a-z]+;"), told).otherwise(body)
    return F.regexp_replace(body, r"&(?!(?:amp|lt|gt|quot|apos|#\d+|#x[0-9A-Fa-f]+);)", "&amp;")


def route_feed_responses(responses: DataFrame) -> DataFrame:
    """``action`` of each fetched feed: parse (200), move (301), disable (410) or drop."""
    status = F.col("status")
    return responses.withColumn("action", F.when(status == 200, "parse").when(status == 301, "move")
                                .when(status == 410, "disable").otherwise("drop"))


def apply_feed_updates(feeds: DataFrame, responses: DataFrame) -> DataFrame:
    """Moved feeds take the new address, gone ones are not okay any more."""
    routed = (route_feed_responses(responses).filter(F.col("action").isin("move", "disable"))
              .groupBy(F.col("rss_feed_id").alias("id"))
              .agg(F.max(F.when(F.col("action") == "move", F.col("href"))).alias("moved"),
                   F.max(F.col("action") == "disable").alias("gone")))
    return (feeds.join(routed, "id", "left")
            .withColumns({"url": F.coalesce("moved", "url"),
                          "is_okay": F.when(F.col("gone"), F.lit(False)).otherwise(F.col("is_okay"))})
            .select(*feeds.columns))


def _rss(parsed: Column) -> Column:
    return F.transform(parsed["channel"]["item"], lambda i: F.struct(
        i["title"].alias("title"), i["description"].alias("summary"), i["pubDate"].alias("published"),
        i["link"].alias("link"), F.coalesce(i["author"], i["creator"]).alias("author")))


def _rdf(parsed: Column) -> Column:
    return F.transform(parsed["item"], lambda i: F.struct(
        i["title"].alias("title"), i["description"].alias("summary"), i["date"].alias("published"),
        i["link"].alias("link"), i["creator"].alias("author")))


def _atom(parsed: Column) -> Column:
    def link(entry: Column) -> Column:
        main = F.filter(entry["link"], lambda l: l["_rel"].isNull() | (l["_rel"] == "alternate"))
        return F.get(main, F.lit(0))["_href"]

    return F.transform(parsed["entry"], lambda e: F.struct(
        e["title"].alias("title"), e["summary"].alias("summary"),
        e["published"].alias("published"), link(e).alias("link"),
        F.get(e["author"], F.lit(0))["name"].alias("author")))


@dataclass(frozen=True)
class Feeds:
    """``feeds`` with their entries, and ``rejects(rss_feed_id, reason)``."""

    feeds: DataFrame
    rejects: DataFrame


def parse_feed_xml(responses: DataFrame) -> Feeds:
    """Fetched feeds ``(rss_feed_id, source_id, url, status, body)`` to a title and an array of entries.

    A feed is dropped whole when it has no title or one of its entries has no date.
    """
    # Elements with a namespace prefix keep it in their name; the author of an RSS item is usually dc:creator.
    body = F.regexp_replace(_without_entities(F.col("body")), r"<(/?)dc:(creator|date)", "<$1$2")
    parsed = (route_feed_responses(responses).filter("action = 'parse'")
              .withColumn("body", body)
              .withColumn("is_atom", F.col("body").rlike(r"(?s)^\s*(<\?xml.*?\?>)?\s*(<!--.*?-->\s*)*<feed[\s>]"))
              .withColumn("is_rdf", F.col("body").rlike(r"(?s)^\s*(<\?xml.*?\?>)?\s*(<!--.*?-->\s*)*<rdf:RDF[\s>]"))
              .withColumn("rdf", F.when(F.col("is_rdf"), F.from_xml("body", RDF)))
              .withColumn("rss", F.when(~F.col("is_atom") & ~F.col("is_rdf"), F.from_xml("body", RSS)))
              .withColumn("atom", F.when(F.col("is_atom"), F.from_xml("body", ATOM))))
    listed = parsed.select(
        "rss_feed_id", "source_id", "url",
        F.coalesce(F.col("rss.channel.title"), F.col("rdf.channel.title"), F.col("atom.title")).alias("title"),
        F.coalesce(_rss(F.col("rss")), _rdf(F.col("rdf")), _atom(F.col("atom")), F.array()).alias("entries"))
    dateless = F.exists("entries", lambda e: e["published"].isNull())
    told = listed.withColumn("reason", F.when(F.col("title").isNull(), "no title").when(dateless, "entry without date"))
    return Feeds(told.filter("reason is null").drop("reason"),
                 told.filter("reason is not null").select("rss_feed_id", "reason"))


def flatten_entries(feeds: DataFrame) -> DataFrame:
    """One row per entry of every feed."""
    return feeds.select("rss_feed_id", "source_id", F.inline("entries"))


def entries_to_articles(entries: DataFrame, runtime: Column) -> DataFrame:
    """Cleaned articles; an empty summary falls back to the cleaned title; the URL loses its query string."""
    title = clean_text(F.col("title"))
    summary = F.when(F.length("summary") > 0, clean_text(F.col("summary"))).otherwise(title)
    url = strip_query(F.col("link"))
    return entries.select(
        F.sha2(url, 256).alias("id"), "rss_feed_id", "source_id", url.alias("url"), summary.alias("summary"),
        title.alias("title"), clean_text(F.col("author")).alias("authors"),
        parse_time(F.col("published"), runtime).alias("published_at"), runtime.alias("added_at"))


def split_valid(articles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Articles with a title, a web address and a readable date, and the quarantine with the reason."""
    reason = (F.when(F.col("title").isNull(), "no title")
              .when(F.coalesce(~is_url(F.col("url")), F.lit(True)), "bad url")
              .when(F.col("published_at").isNull(), "unreadable date"))
    told = articles.withColumn("reason", reason)
    return told.filter("reason is null").drop("reason"), told.filter("reason is not null")
