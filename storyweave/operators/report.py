"""The latest clusters by number of distinct sources, and the published document."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storyweave.functions.times import day_string, format_time, interval_eq
from storyweave.operators.ranking import ranked


def latest_added_at(clusters: DataFrame, cluster_range: dict[str, int]) -> DataFrame:
    """One row: the last ``added_at`` among clusters of the range."""
    of_range = clusters.filter(interval_eq(F.col("begin"), F.col("end"), cluster_range))
    return of_range.agg(F.max("added_at").alias("added_at"))


def latest_run(clusters: DataFrame, cluster_range: dict[str, int]) -> DataFrame:
    """Clusters of the range added last. The one-row maximum makes the join a filter."""
    of_range = clusters.filter(interval_eq(F.col("begin"), F.col("end"), cluster_range))
    return of_range.join(F.broadcast(latest_added_at(clusters, cluster_range)), "added_at").select(*clusters.columns)


def source_count(links: DataFrame, articles: DataFrame, sources: DataFrame) -> DataFrame:
    """``(cluster_id, size)``: distinct sources of each cluster's articles."""
    known = sources.select(F.col("id").alias("source_id"))
    return (links.join(articles.select("article_id", "source_id"), "article_id").join(known, "source_id")
            .select("cluster_id", "source_id").distinct()
            .groupBy("cluster_id").agg(F.count("*").alias("size")))


def top_clusters(sized: DataFrame, limit: int = 10) -> DataFrame:
    return sized.orderBy(F.desc("size"), "id").limit(limit)


def latest_clusters(clusters: DataFrame, links: DataFrame, articles: DataFrame, sources: DataFrame,
                    cluster_range: dict[str, int], limit: int = 10) -> DataFrame:
    """The cluster rows of the last run with ``size``, the ``limit`` largest."""
    latest = latest_run(clusters, cluster_range)
    wanted = links.join(latest.select(F.col("id").alias("cluster_id")), "cluster_id", "left_semi")
    sizes = source_count(wanted, articles, sources)
    return top_clusters(latest.join(sizes, latest["id"] == sizes["cluster_id"]).drop("cluster_id"), limit)


def cluster_members(top: DataFrame, links: DataFrame, articles: DataFrame, sources: DataFrame) -> DataFrame:
    """``(cluster_id, position, title, url, source, date)``: members newest first, ties by article."""
    named = sources.select(F.col("id").alias("source_id"), F.col("name").alias("source"))
    members = (links.join(top.select(F.col("id").alias("cluster_id")), "cluster_id", "left_semi")
            .join(articles.select("article_id", "source_id", "title", "url", "published_at"), "article_id")
            .join(named, "source_id"))
    return ranked(members, ["cluster_id"], [F.desc("published_at"), F.col("article_id")]).select(
        "cluster_id", "position", "title", "url", "source", day_string(F.col("published_at")).alias("date"))


def collect_cluster(top: DataFrame, links: DataFrame, keywords: DataFrame, articles: DataFrame,
                    sources: DataFrame) -> DataFrame:
    """One row per top cluster: ``(id, added_at, size, topics, articles)``.

    The members of a cluster become one array because the published document nests them so, and only for the few
    clusters of the report. ``cluster_members`` gives the same members as rows, whatever the size of a cluster.
    """
    wanted = top.select(F.col("id").alias("cluster_id"))
    topic = F.struct((-F.col("weight")).alias("order"), "term", "weight")
    topics = (keywords.join(wanted, "cluster_id", "left_semi").groupBy("cluster_id")
              .agg(F.sort_array(F.collect_list(topic)).alias("topics")))
    named = sources.select(F.col("id").alias("source_id"), F.col("name").alias("source"))
    member = F.struct((-F.unix_micros("published_at")).alias("order"), "article_id", "title", "url", "source",
                      day_string(F.col("published_at")).alias("date"))
    members = (links.join(wanted, "cluster_id", "left_semi")
               .join(articles.select("article_id", "source_id", "title", "url", "published_at"), "article_id")
               .join(named, "source_id").groupBy("cluster_id")
               .agg(F.sort_array(F.collect_list(member)).alias("articles")))
    return (top.join(topics, top["id"] == topics["cluster_id"], "left").drop("cluster_id")
            .join(members, top["id"] == members["cluster_id"], "left").drop("cluster_id")
            .select("id", "added_at", "size",
                    F.transform("topics", lambda t: F.struct(t["term"].alias("term"), t["weight"].alias("weight"))).alias("topics"),
                    F.transform("articles", lambda a: F.struct(
                        a["title"].alias("title"), a["url"].alias("url"), a["source"].alias("source"),
                        a["date"].alias("date"))).alias("articles")))


def prep_latest(gathered: DataFrame) -> DataFrame:
    """One row holding the report: ``(document)`` with ``added_at`` and ``clusters``, largest first.

    Without any cluster the list is empty and ``added_at`` null.
    """
    entry = F.struct((-F.col("size")).alias("order"), "id", "topics", "articles", F.col("size").alias("source_count"))
    listed = F.transform(F.sort_array(F.collect_list(entry)), lambda c: F.struct(
        c["topics"].alias("topics"), c["articles"].alias("articles"), c["source_count"].alias("source_count")))
    return gathered.agg(F.max("added_at").alias("added_at"), listed.alias("clusters")).select(
        F.struct(format_time(F.col("added_at")).alias("added_at"), "clusters").alias("document"))


def document_lines(top: DataFrame, links: DataFrame, keywords: DataFrame, articles: DataFrame, sources: DataFrame) -> DataFrame:
    """The document of ``prep_latest`` as ``(place, line)``: written in order of ``place`` the lines are one JSON object.

    A member is a line of its own and no row holds a cluster; a cluster's first line has its topics, ten at most. ``top`` has the
    few clusters of the report.
    """
    text = lambda column: F.to_json(column, {"ignoreNullFields": "false"})
    order = Window.orderBy(F.desc("size"), "id")  # of the report's few clusters only
    placed = top.select(F.col("id").alias("cluster_id"), "size", F.row_number().over(order).alias("rank"))
    topic = F.struct((-F.col("weight")).alias("order"), "term", "weight")
    wanted = placed.select("cluster_id")
    topics = (keywords.join(wanted, "cluster_id", "left_semi").groupBy("cluster_id").agg(F.sort_array(F.collect_list(topic)).alias("t"))
              .select("cluster_id", F.transform("t", lambda t: F.struct(t["term"].alias("term"), t["weight"].alias("weight"))).alias("topics")))
    comma = lambda first: F.when(first, "").otherwise(",")
    place = lambda rank, part, position: F.struct(rank.alias("rank"), F.lit(part).alias("part"), position.cast("long").alias("position")).alias("place")
    rank, none = F.col("rank"), F.lit(0)
    heads = placed.join(topics, "cluster_id", "left").select(place(rank, 0, none), F.concat(
        comma(rank == 1), F.lit('{"source_count":'), "size", F.lit(',"topics":'), F.coalesce(text(F.col("topics")), F.lit("[]")), F.lit(',"articles":[')).alias("line"))
    members = cluster_members(top, links, articles, sources).join(placed.select("cluster_id", "rank"), "cluster_id").select(
        place(rank, 1, F.col("position")), F.concat(comma(F.col("position") == 1), text(F.struct("title", "url", "source", "date"))).alias("line"))
    tails = placed.select(place(rank, 2, none), F.lit("]}").alias("line"))
    added = top.agg(F.max("added_at").alias("added_at"))
    moment = F.coalesce(F.concat(F.lit('"'), format_time(F.col("added_at")), F.lit('"')), F.lit("null"))
    begin = added.select(place(F.lit(0), 0, none), F.concat(F.lit('{"added_at":'), moment, F.lit(',"clusters":[')).alias("line"))
    end = added.select(place(F.lit((1 << 31) - 1), 2, none), F.lit("]}").alias("line"))
    return begin.unionByName(heads).unionByName(members).unionByName(tails).unionByName(end)
