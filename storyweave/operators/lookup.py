"""Related articles for a table of looked-up URLs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storyweave.functions.text import strip_query
from storyweave.functions.times import interval_eq
from storyweave.operators.ranking import ranked

GRAM = 12
STEP = 4  # from one substring that a lookup offers to the next: what is rare in at most GRAM - STEP + 1 letters lies in one of them whole


def _grams(url: Column, size: Column, step: int = 1) -> Column:
    """The different substrings of a size that begin at every ``step``-th letter, and the last one."""
    last = F.length(url) - size + 1
    places = F.when(last >= 1, F.concat(F.sequence(F.lit(1), last, F.lit(step)), F.array(last)) if step > 1 else F.sequence(F.lit(1), last))
    return F.array_distinct(F.transform(places, lambda i: F.substring(url, i, size)))


def _containing(missed: DataFrame, articles: DataFrame, sizes: list[int], held: Column) -> DataFrame:
    """Lookups joined to the articles holding them. Each lookup is represented by the rarest substring of its
    piece, of those it offers; an article that holds the piece holds all of them. Counting needs one row per substring and task, and the
    join only sees the rare ones."""
    cuts = F.flatten(F.array(*[_grams(F.col("article_url"), F.lit(n)) for n in sizes]))
    listed = articles.select("article_id", F.col("url").alias("article_url")).withColumn(
        "gram", F.explode(F.filter(cuts, lambda g: g.isNotNull())))
    size = F.least(F.length("piece"), F.lit(GRAM))
    asked = missed.withColumn("gram", F.explode(_grams(F.col("piece"), size, STEP)))
    spread = (listed.join(asked.select("gram").distinct(), "gram", "left_semi")
              .groupBy("gram").agg(F.count("*").alias("held")))
    # A substring no article holds settles a lookup at once: it is the rarest and joins nothing.
    rarest = (asked.join(spread, "gram", "left").groupBy("needle")
              .agg(F.min_by("gram", F.struct(F.coalesce("held", F.lit(0)), "gram")).alias("gram")))
    return rarest.join(listed, "gram").filter(held).select("needle", "article_id", "article_url")


def find_article(queries: DataFrame, articles: DataFrame, like_semantics: bool = False) -> DataFrame:
    """``(query_id, url, article_id)`` for ``queries(query_id, url, ...)``: the article whose URL contains the
    looked-up one, its query string cut off; null where there is none.

    An equal URL is preferred and found by an equality join; otherwise the smallest URL is taken. With
    ``like_semantics`` the signs ``%`` and ``_`` of a looked-up URL match anything, as in SQL's LIKE; substrings are
    then taken from its longest piece between such signs.
    """
    # Looked-up URLs that are the same but for their query strings are one needle, searched once.
    asked = queries.select(strip_query(F.col("url")).alias("needle")).filter("needle is not null").distinct()
    urls = articles.select("article_id", F.col("url").alias("article_url"))
    exact = (asked.join(urls, F.col("needle") == F.col("article_url"))
             .select("needle", "article_id", "article_url"))
    pieces = F.split("needle", "[%_]") if like_semantics else F.array("needle")
    longest = F.array_max(F.transform(pieces, lambda p: F.struct(F.length(p).alias("n"), p.alias("p"))))["p"]
    missed = asked.join(exact.select("needle"), "needle", "left_anti").withColumn("piece", longest)
    if like_semantics:
        pattern = F.concat(F.lit("%"), F.replace("needle", F.lit("\\"), F.lit("\\\\")), F.lit("%"))
        held = F.like(F.col("article_url"), pattern)
    else:
        held = F.col("article_url").contains(F.col("needle"))
    partial = _containing(missed.filter(F.length("piece") >= GRAM), articles, [GRAM], held)
    short = missed.filter(F.length("piece").between(1, GRAM - 1))
    # Articles are only cut to the sizes that short pieces have: GRAM - 1 numbers at most go through the driver.
    sizes = sorted(r[0] for r in short.select(F.length("piece")).distinct().collect())
    if sizes:
        partial = partial.unionByName(_containing(short, articles, sizes, held))
    # Nothing but signs, or nothing at all, asks for a length only; one article per length answers it.
    blank = missed.filter(F.length("piece") == 0).withColumn("least", F.length(F.replace("needle", F.lit("%"), F.lit(""))))
    by_length = (urls.groupBy(F.length("article_url").alias("length"))
                 .agg(F.min(F.struct("article_url", "article_id")).alias("first")))
    any_match = (blank.join(by_length, F.col("length") >= F.col("least"))
                 .select("needle", "first.article_id", "first.article_url"))
    found = (exact.unionByName(partial).unionByName(any_match).groupBy("needle")
             .agg(F.min_by("article_id", F.struct("article_url", "article_id")).alias("article_id")))
    told = queries.select("query_id", "url", strip_query(F.col("url")).alias("needle"))
    return told.join(found, "needle", "left").select("query_id", "url", "article_id")


def related_articles(found: DataFrame, clusters: DataFrame, links: DataFrame, articles: DataFrame,
                     sources: DataFrame, cluster_range: dict[str, int] | None = None) -> DataFrame:
    """``(query_id, url, date, title, source, added_at, article_id, position)``: the other articles sharing a
    cluster of the range (one day) with the found one, newest first."""
    others = _others(found, clusters, links, cluster_range)
    named = sources.select(F.col("id").alias("source_id"), F.col("name").alias("source"))
    rows = (others.join(articles.select("article_id", "source_id", "url", "published_at", "title", "added_at"), "article_id")
            .join(named, "source_id")
            .select("asked", "url", F.col("published_at").alias("date"), "title", "source", "added_at", "article_id"))
    placed = ranked(rows, ["asked"], [F.desc("added_at"), F.col("article_id")])
    hits = found.filter("article_id is not null").select("query_id", F.col("article_id").alias("asked"))
    return hits.join(placed, "asked").select("query_id", "url", "date", "title", "source", "added_at", "article_id", "position")


def _others(found: DataFrame, clusters: DataFrame, links: DataFrame, cluster_range: dict[str, int] | None = None) -> DataFrame:
    """``(asked, article_id)``: for each article found, once however many lookups found it, the others of its clusters of the range."""
    daily = clusters.filter(interval_eq(F.col("begin"), F.col("end"), cluster_range or {"days": 1})).select(
        F.col("id").alias("cluster_id"))
    of_day = links.join(daily, "cluster_id", "left_semi")
    asked = found.filter("article_id is not null").select(F.col("article_id").alias("asked")).distinct()
    mine = asked.join(of_day.withColumnRenamed("article_id", "asked"), "asked")
    return mine.join(of_day, "cluster_id").filter("article_id <> asked").select("asked", "article_id").distinct()


def related_counts(found: DataFrame, clusters: DataFrame, links: DataFrame, cluster_range: dict[str, int] | None = None) -> DataFrame:
    """``response_count`` straight from the clusters: counted for each article found, without listing or ranking what is related."""
    counts = _others(found, clusters, links, cluster_range).groupBy("asked").agg(F.count("*").alias("response_count"))
    hits = found.filter("article_id is not null").select("query_id", F.col("article_id").alias("asked"))
    return hits.join(counts, "asked", "left").select("query_id", F.coalesce("response_count", F.lit(0).cast("long")).alias("response_count"))


def response_count(found: DataFrame, related: DataFrame) -> DataFrame:
    """``(query_id, response_count)`` for every lookup that found its article, 0 where nothing is related."""
    counts = related.groupBy("query_id").agg(F.count("*").alias("response_count"))
    return (found.filter("article_id is not null").select("query_id").join(counts, "query_id", "left")
            .withColumn("response_count", F.coalesce("response_count", F.lit(0).cast("long"))))


def search_log(queries: DataFrame, found: DataFrame, related: DataFrame) -> DataFrame:
    """One log row per lookup: 200 with the number of results, or 404 without.

    ``queries`` may hold ``timestamp``, ``client_id`` and ``referer``.
    """
    known = set(queries.columns)
    blank = {"timestamp": F.current_timestamp(), "client_id": F.lit(None).cast("string"),
             "referer": F.lit(None).cast("string")}
    asked = queries.withColumns({c: v for c, v in blank.items() if c not in known})
    return (asked.join(found.select("query_id", "article_id"), "query_id", "left")
            .join(response_count(found, related), "query_id", "left")
            .select("query_id", "timestamp", F.when(F.col("article_id").isNull(), 404).otherwise(200).alias("status_code"),
                    F.col("url").alias("target_url"), "client_id", "referer", "response_count"))
