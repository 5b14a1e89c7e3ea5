"""Articles and pages between the feeds and the term counts."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storyweave.functions.html import extract_container_text
from storyweave.session import checkpointed
from storyweave.sources.tables import in_days


def dedupe_titles(new: DataFrame, existing: DataFrame, runtime: Column,
                  look_back: timedelta = timedelta(hours=6)) -> DataFrame:
    """New articles without a recent one of the same title and source under another URL.

    Two recent URLs per title and source tell whether one differs from the new one, so the hashed side has one
    row per key however often a title was posted. Repeats inside the new batch are kept.
    """
    days = in_days(existing, runtime - F.lit(look_back))
    recent = (days.filter(F.col("added_at") > runtime - F.lit(look_back)).groupBy("title", "source_id")
              .agg(F.min("url").alias("first_url"), F.max("url").alias("last_url")))
    other = (new["title"] == recent["title"]) & (new["source_id"] == recent["source_id"]) & (
        (new["url"] != recent["first_url"]) | (new["url"] != recent["last_url"]))
    return new.join(recent, other, "left_anti")


TITLED = ["title", "source_id"]


def fresh_titles(new: DataFrame, present: DataFrame, look_back: timedelta) -> DataFrame:
    """The rows of ``new`` to add, each at its own tag ``added_at``: those whose URL is not there yet, unless a row with the
    same title and source was added within the look-back before the tag. An address is taken to keep its title and source.

    What is decided is tags, one row for each title, source and tag however many articles have it: after a kept tag the next one kept is the
    first that lies the look-back or more behind it. These pointers are followed by doubling. Titles are cut at every multiple of the
    look-back, as no tag reaches further than into the following piece, so a title's tags need not be in one task.
    """
    length = look_back // timedelta(microseconds=1)
    unseen = new.join(present.select("url"), "url", "left_anti").withColumn("at", F.unix_micros("added_at"))
    titled = unseen.filter("title is not null and source_id is not null")
    since = unseen.agg((F.min("at") - length).alias("since"))
    recent = present.withColumn("at", F.unix_micros("added_at")).crossJoin(F.broadcast(since)).filter("at > since")  # one row
    entries = _unblocked(titled.select(*TITLED, "at", "url").distinct(), recent.select(*TITLED, "at").distinct(), length)
    while True:
        entries = checkpointed(entries)
        kept = entries.join(_kept_tags(entries.select(*TITLED, "at").distinct(), length), [*TITLED, "at"], "left_semi")
        # An address counts at its first kept tag only. A tag that is left without any is not kept, so what follows it is decided anew.
        first = checkpointed(kept.groupBy(*TITLED, "url").agg(F.min("at").alias("at")))
        void = (kept.select(*TITLED, "at").distinct().join(first, [*TITLED, "at"], "left_anti")
                .groupBy(*TITLED).agg(F.min("at").alias("at")))
        void = checkpointed(void)
        if void.isEmpty():
            break
        entries = entries.join(void, [*TITLED, "at"], "left_anti")
    found = titled.join(first, [*TITLED, "url", "at"], "left_semi")
    # Without a title or source a row is like no other.
    alone = unseen.filter("title is null or source_id is null")
    return found.select(*new.columns).unionByName(alone.select(*new.columns))


def _piece(length: int) -> Column:
    return F.floor(F.col("at") / length)


def _unblocked(entries: DataFrame, earlier: DataFrame, length: int) -> DataFrame:
    """Entries at tags before which, less than ``length`` away, none of the tags ``earlier`` lies."""
    tags = entries.select(*TITLED, "at").distinct().withColumn("old", F.lit(None).cast("long"))
    before = Window.partitionBy(*TITLED, "piece").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    both = tags.unionByName(earlier.withColumn("old", F.col("at"))).withColumn("piece", _piece(length))
    within = both.withColumn("last", F.max("old").over(before)).filter("old is null and last is null")
    ends = earlier.withColumn("piece", _piece(length) + 1).groupBy(*TITLED, "piece").agg(F.max("at").alias("end"))
    free = (within.join(ends, [*TITLED, "piece"], "left").filter((F.col("end") <= F.col("at") - length) | F.col("end").isNull())
            .select(*TITLED, "at"))
    return entries.join(free, [*TITLED, "at"], "left_semi")


def _kept_tags(tags: DataFrame, length: int) -> DataFrame:
    """``(title, source_id, at)``: each title's first tag, and after a kept one the first that is ``length`` or more later."""
    placed = tags.withColumn("piece", _piece(length))
    # The next tag is asked for at ``at + length``, in the next piece: there the first from that moment on, or the first of a later piece.
    asked = placed.select(*TITLED, (F.col("piece") + 1).alias("piece"), (F.col("at") + length).alias("at"), F.col("at").alias("asker"))
    here = placed.withColumn("asker", F.lit(None).cast("long"))
    onward = Window.partitionBy(*TITLED, "piece").orderBy("at").rangeBetween(0, Window.unboundedFollowing)
    near = here.unionByName(asked).withColumn("next", F.min(F.when(F.col("asker").isNull(), F.col("at"))).over(onward)).filter("asker is not null")
    pieces = placed.groupBy(*TITLED, "piece").agg(F.min("at").alias("start")).withColumn("old", F.lit(True))
    wanted = near.filter("next is null").select(*TITLED, "piece").distinct().select(
        *TITLED, "piece", F.lit(None).cast("long").alias("start"), F.lit(False).alias("old"))
    later = Window.partitionBy(*TITLED).orderBy("piece").rangeBetween(1, Window.unboundedFollowing)
    far = pieces.unionByName(wanted).withColumn("far", F.min("start").over(later)).filter("not old").select(*TITLED, "piece", "far")
    jump = checkpointed(near.join(far, [*TITLED, "piece"], "left").select(
        *TITLED, F.col("asker").alias("at"), F.coalesce("next", "far").alias("next")).filter("next is not null"))
    kept = checkpointed(tags.groupBy(*TITLED).agg(F.min("at").alias("at")))
    while not jump.isEmpty():
        # Twice as far each time: what is kept so far, and what lies one jump from it.
        reached = kept.join(jump, [*TITLED, "at"]).select(*TITLED, F.col("next").alias("at"))
        kept = checkpointed(kept.union(reached).distinct())
        step = jump.select(*TITLED, F.col("at").alias("next"), F.col("next").alias("after"))
        jump = checkpointed(jump.join(step, [*TITLED, "next"]).select(*TITLED, "at", F.col("after").alias("next")))
    return kept


def accept_pages(responses: DataFrame, runtime: Column) -> DataFrame:
    """Fetched pages with status 200 as ``(article_id, content, added_at)``."""
    return responses.filter("status = 200").select("article_id", "content", runtime.alias("added_at"))


def fetch_report(responses: DataFrame) -> DataFrame:
    """How many responses had each status; no status means the fetch failed."""
    return responses.groupBy("status").agg(F.count("*").alias("responses"))


def with_selectors(raw: DataFrame, articles: DataFrame, feeds: DataFrame) -> DataFrame:
    """Raw pages with the selectors of their article's feed."""
    feed_of = articles.select(F.col("id").alias("article_id"), "rss_feed_id")
    config = feeds.select(F.col("id").alias("rss_feed_id"), "parser_config")
    return raw.join(feed_of, "article_id").join(config, "rss_feed_id").select(*raw.columns, "parser_config")


def parse_pages(pages: DataFrame, runtime: Column) -> DataFrame:
    """Pages ``(article_id, content, parser_config)`` to ``(article_id, content, added_at)``; pages where no selector
    finds its container are left out."""
    told = extract_container_text(pages.select("article_id", "content", "parser_config"))
    return drop_failed(told, "content").select("article_id", "content", runtime.alias("added_at"))


def drop_failed(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def quarantine(df: DataFrame, column: str) -> DataFrame:
    """What ``drop_failed`` leaves out."""
    return df.filter(F.col(column).isNull())
