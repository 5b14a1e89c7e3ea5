"""Mixing sources to target weights by fitting token budgets with subset sums.

Sources weigh 5, 2, 1, repeating in code point order (null last), and share the number of words of all documents. A target stops at
three times its source's size; the excess is shared again by weight. A source whose target is at least its size is taken
whole that many times; for the remaining budget documents are counted by exact length, the same share of each length is
taken, and what is then missing is fitted by bounded-knapsack dynamic programming over the lengths left. Of each length the
documents with the smallest seeded hashes are taken, so reruns agree.

Sizes are numbers of words between ASCII white space; null and empty texts have size 0, are counted and take 0 words. Rows that
repeat a doc_id are documents of their own. A null source is a source. An empty table gives an empty table; only doc_id, text
and source are read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storyweave.llm.common import staged
from storyweave.operators.ranking import ranked

WEIGHTS = (5, 2, 1)
MOST = 3  # times a document, and so a source, is taken at most
SEED = 17
BUDGET = 1 << 15  # words that are left to the dynamic programme


def words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``(source, place, source_size, target)`` of ``sizes(source, size)``, one row per source."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = ranked(totals, [], [F.col("source").asc_nulls_last()], "place")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int"))
    placed = staged(placed.withColumn("weight", weight), "sources")
    total = placed.agg(F.sum("source_size")).first()[0] or 0
    share, cap = 0.0, MOST * F.col("source_size")
    while total:
        above = F.col("weight") * share > cap
        full, open_weight = placed.agg(F.sum(F.when(above, cap).otherwise(0)), F.sum(F.when(above, 0.0).otherwise(F.col("weight")))).first()
        new = (total - full) / open_weight if open_weight else share
        if new <= share:
            break
        share = new
    return placed.select("source", "place", "source_size", F.least(F.col("weight") * F.lit(share), cap.cast("double")).alias("target"))


def subset_counts(lengths: np.ndarray, counts: np.ndarray, budget: int, limit: int = BUDGET) -> np.ndarray:
    """How many documents of each length to take for a sum near ``budget``; ``budget`` is at most the sum of all."""
    lengths, counts = lengths.astype(np.int64), counts.astype(np.int64)
    taken = np.zeros(len(lengths), np.int64)
    total = int((lengths * counts).sum())
    if budget <= 0 or not total:
        return taken
    if budget >= total:
        return np.where(lengths > 0, counts, 0)
    taken = np.array([int(c) * budget // total if n else 0 for n, c in zip(lengths, counts)], np.int64)
    rest = budget - int((taken * lengths).sum())
    for i in np.argsort(-lengths, kind="stable"):
        if rest <= limit or not lengths[i]:
            break
        more = min(int(counts[i] - taken[i]), (rest - limit) // int(lengths[i]))
        taken[i] += more
        rest -= more * int(lengths[i])
    return taken + _knapsack(lengths, counts - taken, rest)


def _knapsack(lengths: np.ndarray, left: np.ndarray, budget: int) -> np.ndarray:
    """Bounded subset sum: counts whose sum is the largest that ``budget`` allows, or the next above it if that is nearer."""
    items = []  # (length index, multiple): powers of two and a remainder make up each count
    for i in np.flatnonzero((left > 0) & (lengths > 0) & (lengths <= budget)):
        rest, size = min(int(left[i]), budget // int(lengths[i])), 1
        while rest > 0:
            items.append((i, min(size, rest)))
            rest, size = rest - size, size * 2
    by = np.full(budget + 1, -1, np.int64)  # the first item with which a sum is reached
    reached = np.zeros(budget + 1, bool)
    reached[0] = True
    for k, (i, times) in enumerate(items):
        step = times * int(lengths[i])
        if step <= budget:
            new = reached[:-step] & ~reached[step:]
            by[step:][new] = k
            reached[step:] |= new
            if reached[budget]:
                break
    taken, at = np.zeros(len(lengths), np.int64), int(np.flatnonzero(reached)[-1])
    miss = budget - at
    while at:
        i, times = items[by[at]]
        taken[i] += times
        at -= times * int(lengths[i])
    over = np.flatnonzero((left > taken) & (lengths > 0))
    if len(over) and (i := over[np.argmin(np.abs(lengths[over] - miss))]) is not None and abs(int(lengths[i]) - miss) < miss:
        taken[i] += 1
    return taken


def _taken(docs: DataFrame, weights: tuple[int, ...], seed: int) -> DataFrame:
    """What ``mix`` returns, with ``text_hash`` beside it."""
    sizes = staged(docs.select("doc_id", "source", words().alias("size"), F.xxhash64("text").alias("text_hash")), "sizes")
    sources = targets(sizes, weights).withColumnRenamed("source", "of")
    known = staged(sizes.join(sources, sizes["source"].eqNullSafe(F.col("of"))).drop("of"), "sized")

    def fitted(one: pd.DataFrame) -> pd.DataFrame:
        one = one.sort_values("size")
        target, total = int(round(one["target"].iloc[0])), int(one["source_size"].iloc[0])
        whole = target // total if total else 0
        some = subset_counts(one["size"].to_numpy(), one["n"].to_numpy(), target - whole * total)
        return pd.DataFrame({"place": one["place"], "size": one["size"], "whole": whole, "some": some})

    # One row per source and length: the lengths of a source differ, so they grow at most as the root of its words.
    by_length = known.groupBy("place", "size").agg(F.count("*").alias("n"), F.first("target").alias("target"), F.first("source_size").alias("source_size"))
    plan = by_length.groupBy("place").applyInPandas(fitted, "place int, size bigint, whole bigint, some bigint")
    ordered = ranked(known.withColumn("draw", F.xxhash64(F.lit(seed), "doc_id")), ["place", "size"], [F.col("draw"), F.col("doc_id"), F.col("text_hash")], "nth")
    return (ordered.join(staged(plan, "plan"), ["place", "size"])
            .withColumn("copies", F.col("whole") + (F.col("nth") <= F.col("some")).cast("bigint"))
            .select("doc_id", "source", "size", "text_hash", "source_size", "target", "copies"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, seed: int = SEED) -> DataFrame:
    """``(doc_id, source, size, source_size, target, copies)`` of each row; a row takes ``copies`` times its size."""
    return _taken(docs, weights, seed).drop("text_hash")


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, seed: int = SEED) -> DataFrame:
    """The documents that the mix takes, with their columns, a row for each time, those with a null doc_id too. Rows alike in
    doc_id, source and text count as one that is taken as often as all of them."""
    taken = (_taken(docs, weights, seed).filter("copies > 0").groupBy("doc_id", "source", "text_hash")
             .agg(F.sum("copies").cast("int").alias("copies")))
    # Within one struct, the input's columns can have any names.
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = (whole.select("row", F.col("row.doc_id").alias("doc"), F.col("row.source").alias("of"), F.xxhash64("row.text").alias("key"))
            .dropDuplicates(["doc", "of", "key"]))
    same = F.col("doc").eqNullSafe(F.col("doc_id")) & F.col("of").eqNullSafe(F.col("source")) & (F.col("key") == F.col("text_hash"))
    return rows.join(taken, same).select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
