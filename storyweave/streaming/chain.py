"""Stages chained by new rows: each follows the files its upstream table gains."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storyweave.functions.text import Tokenizer, tokenise
from storyweave.functions.html import extract_container_text
from storyweave.operators.articles import accept_pages, drop_failed, fresh_titles, quarantine, with_selectors
from storyweave.operators.clusters import cluster_articles
from storyweave.operators.terms import term_counts
from storyweave.operators.windows import Panes, windows_scan
from storyweave.session import checkpointed, staged
from storyweave.sources.tables import Layout, append, in_days, insert_ignore, replace_windows, table_at

Stage = Callable[[DataFrame], DataFrame]


def follow(upstream: DataFrame, target: str, checkpoint: str, stage: Callable[[DataFrame, int], None]) -> None:
    """Run a stage on every batch of new upstream rows there is, then stop.

    The checkpoint remembers what has been read; a batch repeated after a failure is harmless because stages
    insert only keys that are not there yet.
    """
    query = (upstream.writeStream.foreachBatch(stage).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).queryName(target.rstrip("/").rsplit("/", 1)[-1]).start())
    query.awaitTermination()


def chain(upstream: DataFrame, stage: Stage, target: str, schema: T.StructType, keys: list[str],
          order: list[Column], checkpoint: str, layout: Layout | None = None) -> None:
    """New upstream rows through ``stage`` into the table at ``target``, ignoring keys already there.

    Rows carry the ``added_at`` of their upstream batch, which stays their tag down the chain. Of a target with a ``layout`` (by its
    keys) only the parts that the batch's keys fall into are read.
    """
    def run(batch: DataFrame, _: int) -> None:
        if batch.isEmpty():
            return
        present, made = table_at(batch.sparkSession, target, schema, layout), stage(batch)
        if layout:
            made = staged(made, "stage")
            present = layout.touched(present, made)
        append(insert_ignore(made, present, keys, order).select(*schema.fieldNames()), target, layout)

    follow(upstream, target, checkpoint, run)


def stream_raw_pages(upstream: DataFrame, responses: DataFrame, target: str, schema: T.StructType, checkpoint: str,
                     layout: Layout | None = None) -> None:
    """New articles to the pages fetched for them with status 200, under the articles' tag.

    ``responses(article_id, status, content)`` stands for the fetch: what it holds when the batch runs.
    """
    def pages(batch: DataFrame) -> DataFrame:
        tags = batch.select("article_id", F.col("added_at").alias("tag"))
        return accept_pages(responses.join(tags, "article_id"), F.col("tag"))

    chain(upstream, pages, target, schema, ["article_id"], [F.col("added_at")], checkpoint, layout)


def stream_parsed_pages(upstream: DataFrame, articles: Callable[[], DataFrame], feeds: DataFrame, target: str, schema: T.StructType,
                        checkpoint: str, rejected: str | None = None, layout: Layout | None = None) -> None:
    """New raw pages to the text that the selectors of their article's feed find; pages without a container go to ``rejected``.

    ``articles`` gives the article table as it is when the batch runs, ``feeds`` its selectors.
    """
    def parsed(batch: DataFrame) -> DataFrame:
        told = staged(extract_container_text(with_selectors(batch, articles(), feeds), keep=("added_at",)), "parsed")
        if rejected:
            empty = T.StructType([schema["article_id"], schema["added_at"]])
            present = table_at(batch.sparkSession, rejected, empty)
            bad = quarantine(told, "content").select(*empty.fieldNames())
            append(insert_ignore(bad, present, ["article_id"], [F.col("added_at")]), rejected)
        return drop_failed(told, "content")

    chain(upstream, parsed, target, schema, ["article_id"], [F.col("added_at")], checkpoint, layout)


def stream_clusters(upstream: DataFrame, counts: Callable[[], DataFrame], panes: Panes, method: str, parameters: dict, target: str,
                    checkpoint: str) -> None:
    """New term counts to the clusters of the windows that hold their tags; only these windows are computed anew, from ``counts``, the
    stored table, and take the place of what was there of them."""
    def recompute(batch: DataFrame, _: int) -> None:
        if batch.isEmpty():
            return
        windows = checkpointed(panes.holding(batch))
        found = cluster_articles(windows_scan(counts(), windows), method, parameters)
        replace_windows(found, windows, target)

    follow(upstream, target, checkpoint, recompute)


def stream_term_counts(upstream: DataFrame, target: str, schema: T.StructType, checkpoint: str,
                       tokens: Tokenizer = tokenise, layout: Layout | None = None) -> None:
    """Parsed content to term counts; articles are independent, so a batch needs only its own rows."""
    chain(upstream, lambda batch: term_counts(batch, tokens), target, schema, ["article_id", "term"],
          [F.col("added_at")], checkpoint, layout)


def stream_dedupe_titles(upstream: DataFrame, target: str, schema: T.StructType, checkpoint: str,
                         look_back: timedelta = timedelta(hours=6), layout: Layout | None = None) -> None:
    """New articles into the article table, without those re-posted under another URL within the look-back.

    Each row is compared with what was added in the look-back before its own tag, earlier rows of the same batch included, so
    the result does not depend on how rows fall into batches. Articles of one tag do not displace each other.
    """
    def run(batch: DataFrame, _: int) -> None:
        if batch.isEmpty():
            return
        present = table_at(batch.sparkSession, target, schema, layout)
        known = layout.touched(present, batch) if layout else present  # by url: the table's key
        first = batch.agg(F.min("added_at")).first()[0]
        recent = in_days(present, F.lit(first) - F.lit(look_back))
        fresh = fresh_titles(batch.join(known.select("url"), "url", "left_anti"), recent, look_back)
        append(insert_ignore(fresh, known, ["url"], [F.col("added_at"), F.col("url")]).select(*schema.fieldNames()), target, layout)

    follow(upstream, target, checkpoint, run)
