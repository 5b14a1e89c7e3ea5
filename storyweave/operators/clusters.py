"""Clustering of each window's articles, and what is derived from the clusters.

Every method works on the representatives of a ``Corpus`` and returns ``(begin, end, article_id, label)``, the
label being the smallest article of the cluster; the copies of a representative share its label. An article on
its own is its own label, and noise is left out.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storyweave.operators import similarity
from storyweave.operators.graph import components, spanning_forest
from storyweave.operators.similarity import Corpus, Limits, collapse_copies
from storyweave.operators.windows import RUN, Panes
from storyweave.session import checkpointed, staged

COARSE, FINE = "COARSE", "FINE"


def _complete(corpus: Corpus, labels: DataFrame) -> DataFrame:
    return (corpus.reps.select(*RUN, "article_id").join(labels, [*RUN, "article_id"], "left")
            .withColumn("label", F.coalesce("label", "article_id")))


# Threshold components and the sweep over thresholds

def threshold_components(corpus: Corpus, threshold: float = 0.4, limits: Limits = Limits()) -> DataFrame:
    """Connected articles, an edge standing for cosine >= threshold; at a threshold of 0 or less for any cosine above 0."""
    return _complete(corpus, components(similarity.edges(corpus.reps, threshold, "forest", limits)))


def thresholds(start: float, stop: float, steps: int) -> list[float]:
    return [float(t) for t in np.linspace(start, stop, steps)]


def threshold_sweep(corpus: Corpus, start: float = 0.2, stop: float = 0.6, steps: int = 40,
                    limits: Limits = Limits()) -> tuple[DataFrame, DataFrame]:
    """``(forest, counts)``; ``counts(begin, end, step, threshold, cluster_count)`` has single articles counted.

    The maximum spanning forest at the lowest threshold, cut at t, spans the components at t; so the number of
    clusters at t is the number of articles less the forest edges reaching t.
    """
    forest, _ = spanning_forest(similarity.edges(corpus.reps, start, "forest", limits))
    return forest, sweep_counts(corpus.reps, forest, thresholds(start, stop, steps))


def sweep_counts(nodes: DataFrame, forest: DataFrame, levels: list[float]) -> DataFrame:
    ladder = F.array(*map(F.lit, levels))
    reached = (forest.withColumn("step", F.size(F.filter(ladder, lambda t: t <= F.col("cosine"))) - 1)
               .groupBy(*RUN, "step").agg(F.count("*").alias("edges")))
    grid = nodes.groupBy(*RUN).agg(F.count("*").alias("n")).select(
        *RUN, "n", F.posexplode(ladder).alias("step", "threshold"))
    above = Window.partitionBy(*RUN).orderBy(F.desc("step"))
    return (grid.join(reached, [*RUN, "step"], "left")
            .withColumn("joined", F.sum(F.coalesce("edges", F.lit(0))).over(above))
            .select(*RUN, "step", "threshold", (F.col("n") - F.col("joined")).alias("cluster_count")))


def plateau_choice(counts: DataFrame, arbitration: str = COARSE, drop_bottom: bool = True) -> DataFrame:
    """``(begin, end, threshold, cluster_count, length)``: the lowest threshold of the longest run of equal counts.

    Counts never fall as the threshold rises, so equal counts are one run. The lowest run is left out unless it
    is the only one; of equally long runs COARSE takes the lowest, FINE the highest.
    """
    if arbitration not in (COARSE, FINE):
        raise ValueError(f"unknown arbitration {arbitration!r}")
    run = Window.partitionBy(*RUN)
    runs = (counts.groupBy(*RUN, "cluster_count").agg(F.count("*").alias("length"), F.min("threshold").alias("threshold"))
            .withColumn("place", F.row_number().over(run.orderBy("threshold")))
            .withColumn("runs", F.count("*").over(run)))
    if drop_bottom:
        runs = runs.filter("place > 1 or runs = 1")
    tie = F.asc("threshold") if arbitration == COARSE else F.desc("threshold")
    return (runs.withColumn("rank", F.row_number().over(run.orderBy(F.desc("length"), tie)))
            .filter("rank = 1").select(*RUN, "threshold", "cluster_count", "length"))


def sweep_components(corpus: Corpus, start: float = 0.2, stop: float = 0.6, steps: int = 40,
                     arbitration: str = COARSE, drop_bottom: bool = True, limits: Limits = Limits()) -> DataFrame:
    forest, counts = threshold_sweep(corpus, start, stop, steps, limits)
    forest = checkpointed(forest)
    chosen = plateau_choice(counts, arbitration, drop_bottom)
    cut = forest.join(chosen.select(*RUN, "threshold"), RUN).filter("cosine >= threshold").drop("threshold")
    return _complete(corpus, components(cut))


# Density clustering

def dbscan(corpus: Corpus, eps: float = 0.5, min_samples: int = 5, emit_noise: bool = False,
           limits: Limits = Limits()) -> DataFrame:
    """Density clusters on Euclidean distance: for unit vectors distance <= eps means cosine >= 1 - eps^2/2.

    A core article has ``min_samples`` articles within eps, itself and copies counted. Cores within eps of each
    other share a cluster; another article joins the smallest label among its cores, or is noise. With
    ``emit_noise`` all noise forms one cluster labelled -1.
    """
    bar = 1 - eps * eps / 2
    if bar <= 0:
        return _dense_everywhere(corpus, min_samples, emit_noise)
    told = staged(similarity.dense_edges(corpus.reps, bar, min_samples, limits), "core_pairs")
    core = told.filter("a_core and a <=> b").select(*RUN, F.col("a").alias("article_id"))
    linked = components(told.filter("a_core and b_core and a < b").select(*RUN, "a", "b", "cosine"))
    labels = staged(core.join(linked, [*RUN, "article_id"], "left")
                    .withColumn("label", F.coalesce("label", "article_id")), "core_labels")
    mixed = told.filter("not (a_core and b_core)").select(
        *RUN, F.when(F.col("a_core"), F.col("a")).otherwise(F.col("b")).alias("core"),
        F.when(F.col("a_core"), F.col("b")).otherwise(F.col("a")).alias("article_id"))
    border = (mixed.join(labels.withColumnRenamed("article_id", "core"), [*RUN, "core"])
              .groupBy(*RUN, "article_id").agg(F.min("label").alias("label")))
    clustered = labels.unionByName(border)
    if not emit_noise:
        return clustered
    noise = corpus.reps.join(clustered, [*RUN, "article_id"], "left_anti")
    kind = corpus.reps.schema["article_id"].dataType
    return clustered.unionByName(noise.select(*RUN, "article_id", F.lit(-1).cast(kind).alias("label")))


def _dense_everywhere(corpus: Corpus, min_samples: int, emit_noise: bool) -> DataFrame:
    """Unit vectors without a negative weight are at most the root of 2 apart, so each window is one cluster, or all noise."""
    held = corpus.reps.groupBy(*RUN).agg(F.sum("copies").alias("articles"), F.min("article_id").alias("label"))
    kind = corpus.reps.schema["article_id"].dataType
    enough = F.col("articles") >= min_samples
    named = held.withColumn("label", F.when(enough, F.col("label")).otherwise(F.lit(-1).cast(kind)))
    if not emit_noise:
        named = named.filter(enough)
    return corpus.reps.select(*RUN, "article_id").join(named.select(*RUN, "label"), RUN)


# Ward clustering below a distance

def _ward_square(size_a: Column, size_b: Column, norm_a: Column, norm_b: Column, dot: Column) -> Column:
    gap = norm_a / (size_a * size_a) + norm_b / (size_b * size_b) - 2 * dot / (size_a * size_b)
    return F.round(2 * size_a * size_b / (size_a + size_b) * F.greatest(gap, F.lit(0.0)), similarity.DIGITS)


def ward_threshold(corpus: Corpus, distance_threshold: float, limits: Limits = Limits()) -> DataFrame:
    """Ward clusters merged only below ``distance_threshold``.

    Each round merges, all at once, the clusters that are each other's nearest; Ward's distance is reducible,
    so this ends in the same clusters as one merge at a time. Two clusters at least T from a third stay at
    least T from it when they merge at less than T, so pairs at T or more need never be looked at again.
    """
    if distance_threshold ** 2 >= 2:
        raise ValueError("articles without a common term are the root of 2 apart: at that distance all of a window is one cluster")
    ceiling = round(distance_threshold ** 2, similarity.DIGITS)
    near = similarity.edges(corpus.reps, 1 - distance_threshold ** 2 / 2, "pairs", limits).select(*RUN, "a", "b")
    near = staged(near, "ward_pairs")
    nodes = near.select(*RUN, F.explode(F.array("a", "b")).alias("article_id")).distinct()
    # A cluster is its number of articles and the sum of their vectors.
    sums = staged(corpus.reps.join(nodes, [*RUN, "article_id"]).select(
        *RUN, "article_id", F.col("copies").alias("size"), F.transform("vector", lambda e: F.struct(
            e["term"].alias("term"), (e["weight"] * F.col("copies")).alias("weight"))).alias("vector")), "ward_sums")
    labels = nodes.withColumn("label", F.col("article_id"))
    live = checkpointed(_ward_pairs(near, sums, ceiling))
    while not live.isEmpty():
        merges = checkpointed(_mutual_nearest(live))
        moved = _relabel(live, merges)
        sums = staged(_merge_sums(sums, merges), "ward_sums")
        same = moved.filter("not changed").select(*RUN, "a", "b", "square")
        fresh = _ward_pairs(moved.filter("changed").select(*RUN, "a", "b").distinct(), sums, ceiling)
        live = checkpointed(same.unionByName(fresh))
        step = merges.select(*RUN, F.col("b").alias("label"), F.col("a").alias("into"))
        labels = checkpointed(labels.join(step, [*RUN, "label"], "left")
                              .select(*RUN, "article_id", F.coalesce("into", "label").alias("label")))
    return _complete(corpus, labels)


def _ward_pairs(pairs: DataFrame, sums: DataFrame, ceiling: float) -> DataFrame:
    dots = similarity.pair_dots(pairs, sums)
    norm = F.aggregate("vector", F.lit(0.0), lambda acc, e: acc + e["weight"] * e["weight"])

    def end(name: str) -> DataFrame:
        return sums.select(*RUN, F.col("article_id").alias(name), F.col("size").alias(f"{name}_size"),
                           norm.alias(f"{name}_norm"))

    square = _ward_square(*[F.col(c) for c in ("a_size", "b_size", "a_norm", "b_norm", "dot")])
    return (dots.join(end("a"), [*RUN, "a"]).join(end("b"), [*RUN, "b"]).withColumn("square", square)
            .filter(F.col("square") < ceiling).select(*RUN, "a", "b", "square"))


def _mutual_nearest(live: DataFrame) -> DataFrame:
    """Pairs picked from both ends. The order of pairs is total, so the very nearest pair is always among them."""
    order = F.struct("square", "a", "b")
    ends = F.explode(F.array("a", "b")).alias("node")
    picks = live.select(*RUN, "a", "b", "square", ends).groupBy(*RUN, "node").agg(F.min(order).alias("pick"))
    return (picks.groupBy(*RUN, F.col("pick.a").alias("a"), F.col("pick.b").alias("b"))
            .agg(F.count("*").alias("votes")).filter("votes = 2").drop("votes"))


def _relabel(live: DataFrame, merges: DataFrame) -> DataFrame:
    """Pairs with the larger end of each merge renamed, told whether either end took part in one."""
    steps = merges.select(*RUN, F.explode(F.array(
        F.struct(F.col("a").alias("node"), F.col("a").alias("into")),
        F.struct(F.col("b").alias("node"), F.col("a").alias("into")))).alias("m")).select(*RUN, "m.*")

    def end(name: str) -> DataFrame:
        return steps.select(*RUN, F.col("node").alias(name), F.col("into").alias(f"{name}_into"))

    x, y = F.coalesce("a_into", "a"), F.coalesce("b_into", "b")
    return (live.join(end("a"), [*RUN, "a"], "left").join(end("b"), [*RUN, "b"], "left").filter(x != y)
            .select(*RUN, F.least(x, y).alias("a"), F.greatest(x, y).alias("b"), "square",
                    (F.col("a_into").isNotNull() | F.col("b_into").isNotNull()).alias("changed")))


def _merge_sums(sums: DataFrame, merges: DataFrame) -> DataFrame:
    step = merges.select(*RUN, F.col("b").alias("article_id"), F.col("a").alias("into"))
    kept = merges.select(*RUN, F.col("a").alias("article_id"), F.col("a").alias("into"))
    told = sums.join(step.unionByName(kept), [*RUN, "article_id"], "left")
    still = told.filter("into is null").drop("into")
    joining = told.filter("into is not null").withColumn("article_id", F.col("into")).drop("into")
    sizes = joining.groupBy(*RUN, "article_id").agg(F.sum("size").alias("size"))
    vectors = (joining.select(*RUN, "article_id", F.inline("vector"))
               .groupBy(*RUN, "article_id", "term").agg(F.sum("weight").alias("weight"))
               .groupBy(*RUN, "article_id").agg(F.sort_array(F.collect_list(F.struct("term", "weight"))).alias("vector")))
    return still.unionByName(sizes.join(vectors, [*RUN, "article_id"]))


# A fixed number of clusters

ROUNDS = 10


def fixed_k_clusters(corpus: Corpus, k: int = 2, rounds: int = ROUNDS, limits: Limits = Limits()) -> DataFrame:
    """k groups in each window by bisecting k-means; fewer where a window has fewer different articles.

    Every window is cut by itself, all windows at once: k - 1 times each cuts its group of the largest squared error in two, beginning from two
    articles far apart and moving to the nearer centre at most ``rounds`` times. A window within the limits of a block is cut by a
    task; of larger ones centres are rows by window and term.
    This stands in for a whole-corpus Ward tree, whose result it does not reproduce.
    """
    whole = limits.blocks(F.col("postings"), F.col("n")) == 1
    windows = staged(corpus.reps.groupBy(*RUN).agg(F.coalesce(F.sum(F.size("vector")), F.lit(0)).alias("postings"), F.count("*").alias("n"))
                     .select(*RUN, whole.alias("whole")), "windows")
    small, large = windows.filter("whole").select(*RUN), windows.filter("not whole").select(*RUN)
    if large.isEmpty():
        return _bisect_in_tasks(corpus.reps.join(small, RUN, "left_semi"), k, rounds)
    cut = _bisect_by_joins(corpus.reps.join(large, RUN, "left_semi"), k, rounds)
    return cut if small.isEmpty() else cut.unionByName(_bisect_in_tasks(corpus.reps.join(small, RUN, "left_semi"), k, rounds))


def _bisect_in_tasks(reps: DataFrame, k: int, rounds: int) -> DataFrame:
    """``fixed_k_clusters`` of windows that a task holds whole: their vectors are shuffled once."""
    entries = {"terms": F.transform("vector", lambda e: e["term"]), "weights": F.transform("vector", lambda e: e["weight"])}
    held = reps.withColumns(entries).select(*RUN, "article_id", "copies", "terms", "weights").filter("article_id is not null")
    kind = reps.schema["article_id"]
    schema = T.StructType([*[reps.schema[c] for c in RUN], kind, T.StructField("label", kind.dataType)])

    def run(window: pa.Table) -> pa.Table:
        window = window.combine_chunks()
        ids, lists = window.column("article_id").combine_chunks(), window.column("terms").combine_chunks()
        rank = np.empty(len(ids), np.int64)
        rank[pc.sort_indices(ids).to_numpy()] = np.arange(len(ids))
        copies = window.column("copies").to_numpy().astype(float)
        codes = pa.array(lists.flatten()).dictionary_encode().indices.to_numpy(zero_copy_only=False)
        weights = window.column("weights").combine_chunks().flatten().to_numpy()
        owner = np.repeat(np.arange(len(ids)), pc.list_value_length(lists).to_numpy())
        group = _bisected(rank, copies, codes, weights, owner, k, rounds)
        first = np.full(k, len(ids))
        np.minimum.at(first, group, rank)
        by_rank = np.argsort(rank)
        return pa.table([*[window.column(c) for c in RUN], ids, ids.take(pa.array(by_rank[first[group]]))], names=[*RUN, "article_id", "label"])

    return held.groupBy(*RUN).applyInArrow(run, schema)


def _bisected(rank: np.ndarray, copies: np.ndarray, codes: np.ndarray, weights: np.ndarray, owner: np.ndarray, k: int, rounds: int) -> np.ndarray:
    """The group of each article of one window; ``rank`` is the order of their ids."""
    n_terms, group = int(codes.max(initial=-1)) + 1, np.zeros(len(rank), np.int64)
    massed = weights * copies[owner]

    def total(held: np.ndarray) -> np.ndarray:
        return np.bincount(codes[held[owner]], weights=massed[held[owner]], minlength=n_terms)

    def error(held: np.ndarray) -> float:
        centre = total(held)
        return round(float((weights * massed)[held[owner]].sum() - centre @ centre / copies[held].sum()), 6)

    def vector(article: int) -> np.ndarray:
        return np.bincount(codes[owner == article], weights=weights[owner == article], minlength=n_terms)

    def dots(centre: np.ndarray) -> np.ndarray:
        return np.bincount(owner, weights=weights * centre[codes], minlength=len(rank))

    for step in range(1, k):
        errors = [error(group == g) for g in range(step)]
        widest = int(np.argmax(errors))
        if errors[widest] <= 0:
            break
        held = group == widest
        members = np.flatnonzero(held)

        def farthest(article: int) -> int:
            near = np.round(dots(vector(article))[members], similarity.DIGITS)
            return int(members[np.lexsort((rank[members], near))[0]])

        one = farthest(int(members[np.argmin(rank[members])]))
        centres = [vector(one), vector(farthest(one))]
        sides = None
        for _ in range(rounds):
            away = [np.round(c @ c - 2 * dots(c), similarity.DIGITS) for c in centres]
            now = held & (away[1] < away[0])
            if sides is not None and (now == sides).all():
                break
            sides = now
            centres = [total(half) / max(copies[half].sum(), 1) for half in (held & ~now, now)]
        group[sides] = step
    return group


def _bisect_by_joins(reps: DataFrame, k: int, rounds: int) -> DataFrame:
    """``fixed_k_clusters`` of windows of any size."""
    rows = staged(reps.select(*RUN, "article_id", "copies", F.inline("vector")).select(
        *RUN, "article_id", "copies", "term", "weight"), "points")
    groups = reps.select(*RUN, "article_id", "copies", F.lit(0).alias("group"))
    for step in range(1, k):
        groups = checkpointed(groups)
        chosen = _widest_group(rows, groups)
        if chosen.isEmpty():
            break
        members = groups.join(chosen, [*RUN, "group"], "left_semi").select(*RUN, "article_id", "copies")
        moved = _halves(rows.join(members, [*RUN, "article_id"], "left_semi"), checkpointed(members), rounds)
        groups = groups.join(moved.filter("side = 1").select(*RUN, "article_id", F.lit(step).alias("cut")), [*RUN, "article_id"], "left").select(
            *RUN, "article_id", "copies", F.coalesce("cut", "group").alias("group"))
    smallest = groups.groupBy(*RUN, "group").agg(F.min("article_id").alias("label"))
    return groups.join(smallest, [*RUN, "group"]).select(*RUN, "article_id", "label")


def _widest_group(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """``(begin, end, group)``: of each window the group of the largest squared error, if any has one at all."""
    square = F.col("weight") * F.col("weight") * F.col("copies")
    placed = rows.join(groups.select(*RUN, "article_id", "group"), [*RUN, "article_id"])
    held = groups.groupBy(*RUN, "group").agg(F.sum("copies").alias("n"))
    sums = (placed.groupBy(*RUN, "group", "term").agg(F.sum(F.col("weight") * F.col("copies")).alias("sum"), F.sum(square).alias("square"))
            .groupBy(*RUN, "group").agg(F.sum("square").alias("square"), F.sum(F.col("sum") * F.col("sum")).alias("centre")))
    error = F.round(F.col("square") - F.col("centre") / F.col("n"), 6)
    order = F.struct((-F.col("error")).alias("e"), "group")
    return (sums.join(held, [*RUN, "group"]).withColumn("error", error).filter("error > 0")
            .groupBy(*RUN).agg(F.min_by("group", order).alias("group")))


def _halves(rows: DataFrame, members: DataFrame, rounds: int) -> DataFrame:
    """``(begin, end, article_id, side)``: side 0 or 1 of every member of the one group given for each window."""
    rows = staged(rows, "half_points")

    def scores(centres: DataFrame) -> DataFrame:
        """Products of each member with the two centres ``(begin, end, term, c0, c1)``."""
        dots = (rows.join(centres, [*RUN, "term"]).groupBy(*RUN, "article_id")
                .agg(F.sum(F.col("weight") * F.col("c0")).alias("d0"), F.sum(F.col("weight") * F.col("c1")).alias("d1")))
        return members.join(dots, [*RUN, "article_id"], "left").fillna(0.0, ["d0", "d1"])

    def vector(article: DataFrame, name: str) -> DataFrame:
        return rows.join(article, [*RUN, "article_id"], "left_semi").select(*RUN, "term", F.col("weight").alias(name))

    def farthest(article: DataFrame) -> DataFrame:
        told = scores(vector(article, "c0").withColumn("c1", F.lit(0.0)))
        order = F.struct(F.round("d0", similarity.DIGITS), "article_id")
        return checkpointed(told.groupBy(*RUN).agg(F.min_by("article_id", order).alias("article_id")))

    one = farthest(members.groupBy(*RUN).agg(F.min("article_id").alias("article_id")))
    other = farthest(one)
    centres = vector(one, "c0").join(vector(other, "c1"), [*RUN, "term"], "full").fillna(0.0, ["c0", "c1"])
    sides = None
    for _ in range(rounds):
        centres = checkpointed(centres)
        norms = centres.groupBy(*RUN).agg(F.sum(F.col("c0") * F.col("c0")).alias("q0"), F.sum(F.col("c1") * F.col("c1")).alias("q1"))
        nearer = F.round(F.col("q1") - 2 * F.col("d1"), similarity.DIGITS) < F.round(F.col("q0") - 2 * F.col("d0"), similarity.DIGITS)
        now = checkpointed(scores(centres).join(norms, RUN).select(*RUN, "article_id", "copies", nearer.cast("int").alias("side")))
        if sides is not None and now.join(sides.select(*RUN, "article_id", "side"), [*RUN, "article_id", "side"], "left_anti").isEmpty():
            break
        sides = now
        shares = sides.groupBy(*RUN).agg(F.sum(F.when(F.col("side") == 0, F.col("copies"))).alias("n0"), F.sum(F.when(F.col("side") == 1, F.col("copies"))).alias("n1"))
        part = lambda side: F.sum(F.when(F.col("side") == side, F.col("weight") * F.col("copies")).otherwise(0.0))
        centres = (rows.join(sides.select(*RUN, "article_id", "side"), [*RUN, "article_id"]).groupBy(*RUN, "term")
                   .agg(part(0).alias("s0"), part(1).alias("s1")).join(shares, RUN)
                   .select(*RUN, "term", *[F.coalesce(F.try_divide(f"s{i}", f"n{i}"), F.lit(0.0)).alias(f"c{i}") for i in (0, 1)]))
    return now.select(*RUN, "article_id", "side")


# One run: dispatch, clusters with members and keywords

Method = Callable[..., DataFrame]

METHODS: dict[str, Method] = {
    "threshold": threshold_components,
    "sweep": sweep_components,
    "dbscan": dbscan,
    "ward": ward_threshold,
    "fixed_k": fixed_k_clusters,
}


def register_method(name: str, method: Method) -> None:
    """Add a clustering method: ``method(corpus, **parameters) -> (begin, end, article_id, label)``."""
    METHODS[name] = method


@dataclass(frozen=True)
class Clusters:
    """``clusters(id, type, parameters, begin, end, added_at)``, ``links(cluster_id, article_id)`` and
    ``keywords(cluster_id, term, weight)``."""

    clusters: DataFrame
    links: DataFrame
    keywords: DataFrame


def with_copies(corpus: Corpus, labels: DataFrame) -> DataFrame:
    """``(begin, end, article_id, label, copies)`` of the labelled representatives."""
    return labels.join(corpus.reps.select(*RUN, "article_id", "copies"), [*RUN, "article_id"])


def label_members(corpus: Corpus, labels: DataFrame) -> DataFrame:
    """Labels of all articles, copies too."""
    rep = labels.select(*RUN, F.col("article_id").alias("rep"), "label")
    return corpus.members.join(rep, [*RUN, "rep"]).select(*RUN, "article_id", "label")


def drop_singletons(labelled: DataFrame) -> DataFrame:
    """Labels of more than one article. Sizes are summed first, so a large cluster is one row per task."""
    sizes = labelled.groupBy(*RUN, "label").agg(F.sum("copies").alias("size")).filter("size > 1")
    return labelled.join(sizes, [*RUN, "label"])


def cluster_count(labelled: DataFrame) -> DataFrame:
    """Distinct labels per window, single articles included."""
    return (labelled.select(*RUN, "label").distinct().groupBy(*RUN)
            .agg(F.count("*").alias("cluster_count")))


def keyword_weights(corpus: Corpus, labelled: DataFrame) -> DataFrame:
    """Mean weight of each term over the members of its cluster, absent terms counting as 0."""
    rows = corpus.reps.select(*RUN, "article_id", F.inline("vector")).filter("weight > 0")
    return (labelled.select(*RUN, "article_id", "label", "copies", "size").join(rows, [*RUN, "article_id"])
            .groupBy(*RUN, "label", "term")
            .agg((F.sum(F.col("weight") * F.col("copies")) / F.max("size")).alias("weight")))


def top_keywords(weights: DataFrame, limit: int = 10, cluster: tuple[str, ...] = (*RUN, "label")) -> DataFrame:
    """The heaviest terms of each cluster, ties by term. Spark limits each group before the shuffle."""
    order = Window.partitionBy(*cluster).orderBy(F.desc(F.round("weight", 9)), "term")
    return weights.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= limit)


def cluster_id(method: Column, parameters: Column) -> Column:
    parts = [method, parameters, *[F.unix_micros(c).cast("string") for c in RUN], F.col("label").cast("string")]
    return F.sha2(F.concat_ws("|", *parts), 256)


def cluster_articles(counts: DataFrame, method: str, parameters: dict | None = None,
                     runtime: datetime | Column | None = None, limit: int = 10) -> Clusters:
    """Cluster every window of ``counts(begin, end, article_id, term, count)``.

    ``added_at`` of a cluster is ``runtime``, or the end of its window when none is given.
    """
    from storyweave.operators.terms import tfidf_vectors

    return cluster_vectors(tfidf_vectors(counts), method, parameters, runtime, limit)


def cluster_sliding(counts: DataFrame, size: timedelta, slide: timedelta, method: str, parameters: dict | None = None,
                    runtime: datetime | Column | None = None, limit: int = 10) -> Clusters:
    """Cluster every window of ``size`` ending on a multiple of ``slide`` over ``counts(article_id, term, count, added_at)``."""
    from storyweave.operators.terms import sliding_tfidf_vectors

    vectors = sliding_tfidf_vectors(counts, size, slide)
    if METHODS[method] is threshold_components:
        given = parameters or {}
        links = similarity.sliding_links(counts, Panes(size, slide), given.get("threshold", 0.4), given.get("limits", Limits()))
        if links is not None:
            members = links.filter("cosine is null").select(*RUN, F.col("b").alias("article_id"), F.col("a").alias("rep"))
            reps = members.groupBy(*RUN, F.col("rep").alias("article_id")).agg(F.count("*").alias("copies"))
            corpus = Corpus(members, reps)
            labels = _complete(corpus, components(links.filter("cosine is not null")))
            # Vectors are worked out for keywords only.
            return _found(corpus, labels, Corpus(members, reps.join(vectors.dropDuplicates([*RUN, "article_id"]), [*RUN, "article_id"])),
                          method, given, runtime, limit)
    return cluster_vectors(vectors, method, parameters, runtime, limit)


def cluster_vectors(vectors: DataFrame, method: str, parameters: dict | None = None,
                    runtime: datetime | Column | None = None, limit: int = 10) -> Clusters:
    """``cluster_articles`` from the windows' TF-IDF vectors."""
    parameters = parameters or {}
    corpus = collapse_copies(vectors)
    return _found(corpus, METHODS[method](corpus, **parameters), corpus, method, parameters, runtime, limit)


def _found(corpus: Corpus, labels: DataFrame, weighed: Corpus, method: str, parameters: dict, runtime: datetime | Column | None, limit: int) -> Clusters:
    """The three tables of labelled representatives; ``weighed`` has their vectors."""
    labelled = staged(drop_singletons(with_copies(corpus, labels)), "labelled")
    kind, text = F.lit(method), F.lit(json.dumps(parameters, sort_keys=True))
    added = F.col("end") if runtime is None else F.lit(runtime).cast("timestamp")
    key = cluster_id(kind, text)
    clusters = labelled.select(*RUN, "label").distinct().select(
        key.alias("id"), kind.alias("type"), text.alias("parameters"), *RUN, added.alias("added_at"))
    links = label_members(corpus, labelled).select(key.alias("cluster_id"), "article_id")
    words = top_keywords(keyword_weights(weighed, labelled), limit)
    return Clusters(clusters, links, words.select(key.alias("cluster_id"), "term", "weight"))
