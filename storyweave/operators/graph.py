"""Spanning forests and components of weighted graphs, per window, as rounds of joins and aggregates.

Boruvka's rounds: every component takes its best outgoing edge (highest cosine, then smallest pair), which a
total order of the edges makes part of the maximum spanning forest; components joined by taken edges are
contracted. Each round at least halves the components that still have an edge, so the number of rounds is
logarithmic, as is the number of pointer doublings within one; all windows advance together. Windows of few edges
go to a task each, which takes the same edges in the same order by union-find.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storyweave.operators.windows import RUN
from storyweave.session import checkpointed, staged

DOUBLINGS = 2  # per check whether every node has reached its root
WINDOW_EDGES = 1_000_000  # edges of a window that one task may hold


def _both_ways(edges: DataFrame) -> DataFrame:
    ends = F.array(F.struct(F.col("u").alias("node"), F.col("v").alias("other")),
                   F.struct(F.col("v").alias("node"), F.col("u").alias("other")))
    return edges.select(*RUN, "cosine", "a", "b", F.inline(ends))


def spanning_forest(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(forest, labels)`` of ``edges(begin, end, a, b, cosine)``, a < b.

    ``forest`` has the columns of ``edges``; ``labels(begin, end, article_id, label)`` gives every article with
    an edge the smallest article it is connected to. Windows of at most ``WINDOW_EDGES`` edges are worked out by a task each.
    """
    held = staged(edges.select(*RUN, "a", "b", "cosine"), "edges")
    sizes = held.groupBy(*RUN).agg(F.count("*").alias("edges"))
    large = staged(sizes.filter(F.col("edges") > WINDOW_EDGES).select(*RUN), "large_windows")
    if large.isEmpty():
        return _in_tasks(held)
    small = _in_tasks(held.join(large, RUN, "left_anti"))
    return tuple(a.unionByName(b) for a, b in zip(small, _by_rounds(held.join(large, RUN, "left_semi"))))


def _in_tasks(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``spanning_forest`` of windows that a task holds whole."""
    run, kind = [edges.schema[c] for c in RUN], edges.schema["a"].dataType
    labelled = T.StructType([*run, T.StructField("article_id", kind), T.StructField("label", kind)])
    grouped = edges.groupBy(*RUN)
    return grouped.applyInArrow(_joined(False), edges.schema), grouped.applyInArrow(_joined(True), labelled)


def _joined(labels: bool):
    """The task of one window: the edges it takes, best first, or the labels these give."""

    def run(window: pa.Table) -> pa.Table:
        window = window.combine_chunks()
        m, bounds = window.num_rows, [window.column(c)[0] for c in RUN]
        ends = pa.concat_arrays([window.column(c).combine_chunks() for c in ("a", "b")]).dictionary_encode()
        by_id = pc.sort_indices(ends.dictionary)
        rank = np.empty(len(by_id), np.int64)
        rank[by_id.to_numpy()] = np.arange(len(by_id))
        places = rank[ends.indices.to_numpy()]
        a, b = places[:m], places[m:]
        parent, taken = list(range(len(by_id))), []

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for i in np.lexsort((b, a, -window.column("cosine").to_numpy())).tolist():
            x, y = sorted((root(int(a[i])), root(int(b[i]))))
            if x != y:
                parent[y] = x  # a root is the smallest of its articles
                taken.append(i)
        if not labels:
            return window.take(pa.array(taken, pa.int64()))
        names, roots = ends.dictionary.take(by_id), [root(x) for x in range(len(by_id))]
        return pa.table([*[pa.repeat(v, len(names)) for v in bounds], names, names.take(pa.array(roots, pa.int64()))], names=[*RUN, "article_id", "label"])

    return run


def _by_rounds(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``spanning_forest`` of windows of any size."""
    order = F.struct((-F.col("cosine")).alias("c"), "a", "b")
    live = checkpointed(edges.select(*RUN, F.col("a").alias("u"), F.col("b").alias("v"), "cosine", "a", "b"))
    taken, hops = [], []
    while not live.isEmpty():
        picks = (_both_ways(live).groupBy(*RUN, "node")
                 .agg(F.min_by(F.struct("other", "a", "b", "cosine"), order).alias("pick"))
                 .select(*RUN, "node", "pick.*"))
        first = checkpointed(_parents(picks))
        taken.append(first.select(*RUN, "a", "b", "cosine"))
        up = _climb(first)
        hops.append(up)
        live = checkpointed(_contract(live, up, order))
    forest = reduce(DataFrame.unionByName, taken).distinct() if taken else edges.select(*RUN, "a", "b", "cosine")
    return forest, _labels(edges, hops)


def _parents(picks: DataFrame) -> DataFrame:
    """The picks with ``ancestor``, the node at the other end. Of two nodes that picked the same edge, and so each
    other, the smaller becomes a root."""
    pair = picks.groupBy(*RUN, "a", "b").agg(
        F.first("cosine").alias("cosine"), F.count("*").alias("picked"), F.collect_list(F.struct("node", "other")).alias("ends"))
    is_root = (F.col("picked") == 2) & (F.col("node") < F.col("other"))
    return (pair.select(*RUN, "a", "b", "cosine", "picked", F.inline("ends"))
            .withColumn("ancestor", F.when(is_root, F.col("node")).otherwise(F.col("other")))
            .select(*RUN, "node", "ancestor", "a", "b", "cosine"))


def _climb(first: DataFrame) -> DataFrame:
    """``(node, ancestor)`` with the root as ancestor, by doubling the steps until nothing moves."""
    up = first.select(*RUN, "node", "ancestor", F.lit(True).alias("moved"))
    while not up.filter("moved").isEmpty():
        for _ in range(DOUBLINGS):
            step = up.select(*RUN, F.col("node").alias("ancestor"), F.col("ancestor").alias("next"))
            up = up.join(step, [*RUN, "ancestor"]).select(
                *RUN, "node", F.col("next").alias("ancestor"), (F.col("next") != F.col("ancestor")).alias("moved"))
        up = checkpointed(up)
    return up.drop("moved")


def _contract(live: DataFrame, up: DataFrame, order) -> DataFrame:
    """Edges between the contracted components; of parallel ones the best."""
    def end(name: str) -> DataFrame:
        return up.select(*RUN, F.col("node").alias(name), F.col("ancestor").alias(f"{name}_up"))

    moved = (live.join(end("u"), [*RUN, "u"]).join(end("v"), [*RUN, "v"]).filter("u_up <> v_up")
             .select(*RUN, F.least("u_up", "v_up").alias("u"), F.greatest("u_up", "v_up").alias("v"),
                     "cosine", "a", "b"))
    return (moved.groupBy(*RUN, "u", "v").agg(F.min_by(F.struct("cosine", "a", "b"), order).alias("best"))
            .select(*RUN, "u", "v", "best.*"))


def _labels(edges: DataFrame, hops: list[DataFrame]) -> DataFrame:
    if not hops:
        return edges.select(*RUN, F.col("a").alias("article_id"), F.col("a").alias("label"))
    # From the last round, the smallest, back to the first: each step stays as small as its round.
    roots = hops[-1]
    for up in reversed(hops[:-1]):
        later = roots.select(*RUN, F.col("node").alias("ancestor"), F.col("ancestor").alias("root"))
        roots = checkpointed(up.join(later, [*RUN, "ancestor"], "left")
                             .select(*RUN, "node", F.coalesce("root", "ancestor").alias("ancestor")))
    labels = roots.select(*RUN, F.col("node").alias("article_id"), F.col("ancestor").alias("root"))
    smallest = labels.groupBy(*RUN, "root").agg(F.min("article_id").alias("label"))
    return labels.join(smallest, [*RUN, "root"]).select(*RUN, "article_id", "label")


def components(edges: DataFrame) -> DataFrame:
    """``(begin, end, article_id, label)`` of every article with an edge; label = smallest member."""
    return spanning_forest(edges)[1]
