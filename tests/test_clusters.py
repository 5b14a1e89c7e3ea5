import itertools
import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from storyweave.operators import clusters, report, similarity, terms
from storyweave.operators.graph import components, spanning_forest
from storyweave.operators.similarity import Limits
from storyweave.operators.windows import RUN, single_run, sliding_windows
from storyweave.session import staged

# Small limits force several blocks on a handful of articles.
LIMITS = [Limits(), Limits(block_postings=150, block_articles=16)]


def counts_of(spark, docs, end="2024-01-02"):
    rows = [(f"{i:03d}", t, c) for i, doc in docs.items() for t, c in doc.items()]
    df = spark.createDataFrame(rows, "article_id string, term string, count long")
    return df.withColumns({"begin": F.lit("2024-01-01").cast("timestamp"), "end": F.lit(end).cast("timestamp")})


def random_docs(seed, n=40):
    rng = random.Random(seed)
    docs = {}
    for i in range(n):
        topic = rng.randrange(6)
        words = [f"t{topic}_{rng.randrange(8)}" for _ in range(rng.randrange(2, 12))]
        words += [f"common{rng.randrange(3)}" for _ in range(rng.randrange(6))] + [f"rare{rng.randrange(60)}" for _ in range(rng.randrange(4))]
        docs[i] = {w: words.count(w) for w in set(words)}
    for i in range(n, n + 8):  # copies
        docs[i] = dict(docs[rng.randrange(n)])
    return docs


def exact(docs):
    """Dense TF-IDF cosines."""
    names = sorted(docs)
    vocab = sorted({t for d in docs.values() for t in d})
    tf = np.array([[docs[i].get(t, 0) for t in vocab] for i in names], dtype=float)
    df = np.array([sum(t in docs[i] for i in names) for t in vocab])
    w = tf * (np.log((1 + len(names)) / (1 + df)) + 1)
    norm = np.sqrt((w * w).sum(1, keepdims=True))
    w = np.divide(w, norm, out=np.zeros_like(w), where=norm > 0)
    return names, np.round(w @ w.T, 9), w


def partition(links):
    """Connected groups of (x, y) links."""
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for x, y in links:
        parent[root(x)] = root(y)
    groups = {}
    for x in list(parent):
        groups.setdefault(root(x), set()).add(x)
    return {frozenset(g) for g in groups.values()}


def groups_of(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.label, set()).add(int(r.article_id))
    assert all(int(label) == min(members) for label, members in out.items())
    return {frozenset(g) for g in out.values()}


def members(corpus, labels):
    return groups_of(clusters.label_members(corpus, labels))


def corpus_of(spark, docs):
    return similarity.collapse_copies(terms.tfidf_vectors(counts_of(spark, docs)))


def test_term_counts(spark):
    docs = spark.createDataFrame([(1, "storm storm coast"), (2, "storm coast flood"), (3, "")], "article_id int, content string")
    docs = docs.withColumn("added_at", F.lit("2024-01-01").cast("timestamp"))
    got = {(r.article_id, r.term, r["count"]) for r in terms.term_counts(docs).collect()}
    assert got == {(1, "storm", 2), (1, "coast", 1), (2, "storm", 1), (2, "coast", 1), (2, "flood", 1)}


def test_tfidf_with_a_zero_row(spark):
    counts = counts_of(spark, {0: {"a": 0}, 1: {"b": 1}, 2: {"c": 2, "b": 1}})
    weights = {(r.article_id, r.term): r.weight for r in terms.tfidf(counts).collect()}
    b, c = math.log(4 / 3) + 1, 2 * (math.log(4 / 2) + 1)
    assert weights[("000", "a")] == 0 and weights[("001", "b")] == 1
    assert weights[("002", "c")] == pytest.approx(c / math.hypot(b, c))


def test_zero_vectors_are_near_nothing(spark):
    corpus = corpus_of(spark, {0: {"a": 0}, 1: {"a": 0}, 2: {"b": 1}, 3: {"b": 1}})
    assert members(corpus, clusters.threshold_components(corpus, 0.4)) == {frozenset({0}), frozenset({1}), frozenset({2, 3})}


@pytest.mark.parametrize("seed,threshold,limits", [(1, 0.45, LIMITS[0]), (2, 0.6, LIMITS[1]), (3, 0.3, LIMITS[1])])
def test_similarity_join_equals_all_pairs(spark, seed, threshold, limits):
    docs = random_docs(seed)
    names, cos, _ = exact(docs)
    corpus = corpus_of(spark, docs)
    reps = {int(r.article_id): r.copies for r in corpus.reps.collect()}
    want = {(a, b): cos[a, b] for a, b in itertools.combinations(names, 2) if a in reps and b in reps and cos[a, b] >= threshold}
    got = [(int(r.a), int(r.b), r.cosine) for r in similarity.edges(corpus.reps, threshold, "pairs", limits).collect()]
    assert len(got) == len(want) and {(a, b): c for a, b, c in got} == pytest.approx(want)
    forest = [(int(r.a), int(r.b)) for r in similarity.edges(corpus.reps, threshold, "forest", limits).collect()]
    assert set(forest) <= set(want) and partition(forest) == partition(want)
    near = {int(r.article_id): r.neighbours for r in similarity.degrees(corpus.reps, threshold, limits).collect()}
    counted = {}
    for a, b in want:
        counted[a] = counted.get(a, 0) + reps[b]
        counted[b] = counted.get(b, 0) + reps[a]
    assert near == counted


@pytest.mark.parametrize("limits", LIMITS[1:2])
def test_threshold_components_and_copies(spark, limits):
    docs = random_docs(4)
    names, cos, _ = exact(docs)
    want = partition([(a, a) for a in names] + [(a, b) for a, b in itertools.combinations(names, 2) if cos[a, b] >= 0.45])
    corpus = corpus_of(spark, docs)
    assert members(corpus, clusters.threshold_components(corpus, 0.45, limits=limits)) == want


def test_forest_thinned_in_tasks_has_the_same_components(spark, monkeypatch):
    docs = {i: {"x": 20, f"own{i}": 1, "y": 3 + i % 5} for i in range(60)}
    names, cos, _ = exact(docs)
    pairs = similarity.edges(corpus_of(spark, docs).reps, 0.5, "pairs")
    forest = similarity.edges(corpus_of(spark, docs).reps, 0.5, "forest")
    assert pairs.count() == 60 * 59 // 2 and forest.count() == 59


def edges_of(spark, triples):
    df = spark.createDataFrame(triples, "a string, b string, cosine double")
    return df.withColumns({"begin": F.lit("2024-01-01").cast("timestamp"), "end": F.lit("2024-01-02").cast("timestamp")})


def test_long_chain_is_one_component_in_any_order(spark):
    ids = [f"{i:03d}" for i in range(50)]
    chain = [(a, b, 0.5 + 0.001 * i) for i, (a, b) in enumerate(zip(ids, ids[1:]))]
    random.Random(5).shuffle(chain)
    forest, labels = spanning_forest(edges_of(spark, chain))
    assert forest.count() == 49 and groups_of(labels) == {frozenset(range(50))}


def test_spanning_forest_is_maximal(spark):
    rng = random.Random(6)
    triples = [(f"{a:03d}", f"{b:03d}", round(rng.random(), 2)) for a, b in itertools.combinations(range(25), 2) if rng.random() < 0.3]
    forest, _ = spanning_forest(edges_of(spark, triples))
    got = [(r.a, r.b, r.cosine) for r in forest.collect()]
    for t in (0.0, 0.3, 0.6, 0.9):
        assert partition([e[:2] for e in got if e[2] >= t]) == partition([e[:2] for e in triples if e[2] >= t])
    assert len(got) == sum(len(g) - 1 for g in partition([e[:2] for e in triples]))


def test_no_edges(spark):
    assert components(edges_of(spark, [])).count() == 0


def test_plateau_choice(spark):
    def chosen(counts, **options):
        rows = [(i, 0.2 + 0.1 * i, c) for i, c in enumerate(counts)]
        df = spark.createDataFrame(rows, "step int, threshold double, cluster_count long").withColumns(
            {"begin": F.lit("2024-01-01").cast("timestamp"), "end": F.lit("2024-01-02").cast("timestamp")})
        r = clusters.plateau_choice(df, **options).first()
        return round(r.threshold, 6), r.cluster_count

    assert chosen([1, 1, 1, 4, 4, 7, 8]) == (0.5, 4)
    assert chosen([1, 1, 1, 4, 4, 7, 8], drop_bottom=False) == (0.2, 1)
    assert chosen([1, 4, 4, 7, 7, 8], arbitration=clusters.COARSE) == (0.3, 4)
    assert chosen([1, 4, 4, 7, 7, 8], arbitration=clusters.FINE) == (0.5, 7)
    assert chosen([3, 3, 3]) == (0.2, 3)
    with pytest.raises(ValueError):
        chosen([1], arbitration="other")


def test_sweep_finds_the_plateau_of_four_groups(spark):
    docs = {}
    for g in range(4):
        for i in range(4):
            docs[g * 4 + i] = {**{f"g{g}_{w}": 6 for w in range(4)}, "shared": 14, f"own{g}_{i}": 1}
    names, cos, _ = exact(docs)
    corpus = corpus_of(spark, docs)
    _, counts = clusters.threshold_sweep(corpus)
    got = {r.step: r.cluster_count for r in counts.collect()}
    levels = clusters.thresholds(0.2, 0.6, 40)
    assert got == {i: len(partition([(a, a) for a in names] + [(a, b) for a, b in itertools.combinations(names, 2) if cos[a, b] >= t])) for i, t in enumerate(levels)}
    assert members(corpus, clusters.sweep_components(corpus, arbitration=clusters.FINE)) == {frozenset(range(g * 4, g * 4 + 4)) for g in range(4)}


def naive_dbscan(docs, bar, min_samples):
    names, cos, _ = exact(docs)
    near = {a: [b for b in names if a == b or cos[a, b] >= bar] for a in names}
    core = {a for a in names if len(near[a]) >= min_samples}
    groups = partition([(a, b) for a in core for b in near[a] if b in core])
    label = {v: min(g) for g in groups for v in g}
    border = {a: min(label[b] for b in near[a] if b in core) for a in names if a not in core and core & set(near[a])}
    out = {}
    for v, l in {**label, **border}.items():
        out.setdefault(l, set()).add(v)
    return out, set(names) - set(label) - set(border)


@pytest.mark.parametrize("seed,eps,min_samples,limits", [(7, 1.0, 4, LIMITS[0]), (9, 1.1, 5, LIMITS[1])])
def test_dbscan_equals_definition(spark, seed, eps, min_samples, limits):
    docs = random_docs(seed)
    want, noise = naive_dbscan(docs, 1 - eps * eps / 2, min_samples)
    corpus = corpus_of(spark, docs)
    got = {}
    for r in clusters.label_members(corpus, clusters.dbscan(corpus, eps, min_samples, True, limits)).collect():
        got.setdefault(int(r.label), set()).add(int(r.article_id))
    assert got.pop(-1, set()) == noise
    assert got == want


def naive_ward(points, limit):
    """One merge at a time, the nearest pair first."""
    groups = {i: [i] for i in range(len(points))}
    while len(groups) > 1:
        best = None
        for x, y in itertools.combinations(sorted(groups), 2):
            a, b = points[groups[x]], points[groups[y]]
            gap = 2 * len(a) * len(b) / (len(a) + len(b)) * ((a.mean(0) - b.mean(0)) ** 2).sum()
            if best is None or (round(gap, 9), x, y) < best:
                best = (round(gap, 9), x, y)
        if best[0] >= round(limit ** 2, 9):
            break
        groups[best[1]] += groups.pop(best[2])
    return {frozenset(g) for g in groups.values()}


@pytest.mark.parametrize("seed,limit,limits", [(10, 1.0, LIMITS[0]), (11, 0.8, LIMITS[1])])
def test_ward_equals_one_merge_at_a_time(spark, seed, limit, limits):
    docs = random_docs(seed, 24)
    _, _, w = exact(docs)
    corpus = corpus_of(spark, docs)
    assert members(corpus, clusters.ward_threshold(corpus, limit, limits)) == naive_ward(w, limit)


def plain_bisecting(points: dict[int, np.ndarray], k: int, rounds: int = clusters.ROUNDS) -> set[frozenset]:
    """The same cuts with dense vectors, one window at a time."""
    groups = [sorted(points)]
    while len(groups) < k:
        error = [round(float(((np.array([points[i] for i in g]) - np.mean([points[i] for i in g], axis=0)) ** 2).sum()), 6) for g in groups]
        if max(error) <= 0:
            break
        at = error.index(max(error))
        ids = groups[at]
        far = lambda i: min(ids, key=lambda j: (round(float(points[i] @ points[j]), 9), j))
        one = far(ids[0])
        c = [points[one], points[far(one)]]
        side = None
        for _ in range(rounds):
            new = [int(round(c[1] @ c[1] - 2 * points[i] @ c[1], 9) < round(c[0] @ c[0] - 2 * points[i] @ c[0], 9)) for i in ids]
            if new == side:
                break
            side = new
            c = [np.mean([points[i] for i, s in zip(ids, side) if s == h], axis=0) if h in side else np.zeros_like(c[0]) for h in (0, 1)]
        groups[at] = [i for i, s in zip(ids, side) if not s]
        groups.append([i for i, s in zip(ids, side) if s])
    return {frozenset(g) for g in groups}


@pytest.mark.parametrize("k", [3])
def test_each_window_is_bisected_by_itself(spark, k):
    docs, later = random_docs(31, 24), random_docs(32, 18)
    both = counts_of(spark, docs).unionByName(counts_of(spark, later, "2024-01-03"))
    corpus = similarity.collapse_copies(terms.tfidf_vectors(both))
    labels = clusters.label_members(corpus, clusters.fixed_k_clusters(corpus, k)).collect()
    for day, own in (("2024-01-02", docs), ("2024-01-03", later)):
        _, _, w = exact(own)
        want = plain_bisecting({i: np.asarray(row) for i, row in enumerate(w)}, k)
        found: dict = {}
        for r in labels:
            if str(r.end).startswith(day):
                found.setdefault(r.label, set()).add(int(r.article_id))
        assert {frozenset(g) for g in found.values()} == want


def test_fewer_different_articles_than_groups(spark):
    corpus = corpus_of(spark, {0: {"a": 1}, 1: {"a": 1}, 2: {"b": 2, "c": 1}})
    assert members(corpus, clusters.fixed_k_clusters(corpus, 5)) == {frozenset({0, 1}), frozenset({2})}


def test_keywords_are_means_over_all_members(spark):
    docs = random_docs(33, 12)
    _, _, w = exact(docs)
    vocab = sorted({t for d in docs.values() for t in d})
    corpus = corpus_of(spark, docs)
    labelled = clusters.drop_singletons(clusters.with_copies(corpus, clusters.threshold_components(corpus, 0.05)))
    words = clusters.top_keywords(clusters.keyword_weights(corpus, labelled), limit=3).collect()
    groups = [sorted(g) for g in members(corpus, clusters.threshold_components(corpus, 0.05)) if len(g) > 1]
    want = set()
    for g in groups:
        mean = np.asarray(w)[g].mean(axis=0)
        best = sorted(range(len(mean)), key=lambda i: (-round(float(mean[i]), 9), vocab[i]))[:3]
        want |= {(g[0], vocab[i], round(float(mean[i]), 6)) for i in best if mean[i] > 0}
    assert {(int(r.label), r.term, round(r.weight, 6)) for r in words} == want


def test_thresholds_at_their_limits(spark):
    docs = {0: {"a": 1, "b": 1}, 1: {"b": 1, "c": 1}, 2: {"z": 1}, 3: {"z": 1}, 4: {"y": 1}}
    corpus = corpus_of(spark, docs)
    assert members(corpus, clusters.threshold_components(corpus, 0.0)) == {frozenset({0, 1}), frozenset({2, 3}), frozenset({4})}
    assert members(corpus, clusters.dbscan(corpus, 1.5, 5)) == {frozenset(range(5))}
    assert members(corpus, clusters.dbscan(corpus, 1.5, 6)) == set()
    assert clusters.dbscan(corpus, 1.5, 6, emit_noise=True).filter("label = -1").count() == 4
    with pytest.raises(ValueError, match="common term"):
        clusters.ward_threshold(corpus, 1.5)


def test_windows_are_closed_and_run_apart(spark):
    rows = [(1, "2024-01-01 00:00:00"), (2, "2024-01-01 12:00:00"), (3, "2024-01-02 00:00:00")]
    df = spark.createDataFrame(rows, "article_id int, t string").select("article_id", F.col("t").cast("timestamp").alias("added_at"))
    from datetime import timedelta

    got = {(str(r.end)[:10], r.article_id) for r in sliding_windows(df, timedelta(days=1), timedelta(days=1)).collect()}
    assert got == {("2024-01-01", 1), ("2024-01-02", 1), ("2024-01-02", 2), ("2024-01-02", 3), ("2024-01-03", 3)}
    assert single_run(df, "2024-01-01 12:00:00", "2024-01-02 00:00:00").count() == 2


def test_empty_window(spark):
    found = clusters.cluster_articles(counts_of(spark, {0: {"a": 1}}).filter("false"), "threshold", {"threshold": 0.45})
    assert found.clusters.count() == found.links.count() == found.keywords.count() == 0
    gathered = spark.createDataFrame([], "added_at timestamp, size long, id string, topics array<struct<term: string, weight: double>>,"
                                         " articles array<struct<title: string, url: string, source: string, date: string>>")
    document = report.prep_latest(gathered).select(F.to_json("document").alias("j")).first().j
    assert json.loads(document)["clusters"] == []


def test_two_windows_in_one_run_and_a_custom_method(spark):
    docs = {0: {"a": 1, "b": 1}, 1: {"a": 1, "b": 1, "c": 1}, 2: {"z": 1}}
    both = counts_of(spark, docs).unionByName(counts_of(spark, {i: docs[i] for i in (0, 2)}, "2024-01-03"))
    found = clusters.cluster_articles(both, "threshold", {"threshold": 0.3})
    assert found.clusters.count() == 1 and {r.article_id for r in found.links.collect()} == {"000", "001"}
    clusters.register_method("all_in_one", lambda corpus, **_: corpus.reps.select(
        *RUN, "article_id", F.lit("000").alias("label")))
    assert clusters.cluster_articles(both, "all_in_one").clusters.count() == 2


def plan_of(df):
    return df._jdf.queryExecution().toString()


def test_windows_weighed_in_tasks_or_by_joins_are_the_same(spark, monkeypatch):
    counts = counts_of(spark, random_docs(6)).unionByName(counts_of(spark, random_docs(7)).withColumn("end", F.lit("2030-01-01").cast("timestamp")).limit(200))
    told = lambda: sorted((str(r.end), r.article_id, r.term, r["count"], round(r.weight, 9)) for r in terms.explode_vectors(terms.tfidf_vectors(counts)).collect())
    in_tasks = told()
    assert "Join Inner" not in plan_of(terms.tfidf_vectors(counts))  # no frequencies are shuffled
    for rows in (0, 200):
        monkeypatch.setattr(terms, "WINDOW_ROWS", rows)
        assert told() == in_tasks


def test_tokens_are_counted_where_they_are(spark):
    rows = [(1, "storm storm Coast"), (2, None), (3, ""), (4, "b a"), (4, "a"), (None, "x x"), (None, "x")]
    docs = spark.createDataFrame(rows, "article_id int, content string").withColumn("added_at", F.lit("2024-01-01").cast("timestamp"))
    got = terms.term_counts(docs.filter("article_id < 4"))
    assert "Exchange hashpartitioning(article_id" not in plan_of(got)
    assert {tuple(r)[:3] for r in terms.term_counts(docs).collect()} == {(1, "storm", 2), (1, "coast", 1), (4, "a", 2), (4, "b", 1), (None, "x", 3)}


def test_small_blocks_of_a_window_stay_in_one_task(spark, monkeypatch):
    reps, small = corpus_of(spark, random_docs(5)).reps, Limits(block_postings=150, block_articles=16)
    assert similarity.block_copies(reps, 0.3, small).select("lo", "hi").distinct().count() == 1
    found = lambda keep: sorted(similarity.edges(reps, 0.3, keep, small).collect())
    pairs, near = found("pairs"), sorted(similarity.degrees(reps, 0.3, small).collect())
    assert pairs == sorted(similarity.edges(reps, 0.3, "pairs").collect())
    monkeypatch.setattr(similarity, "TASK_BLOCKS", 1)
    assert similarity.block_copies(reps, 0.3, small).select("lo", "hi").distinct().count() > 1
    assert found("pairs") == pairs and sorted(similarity.degrees(reps, 0.3, small).collect()) == near


def test_windows_bisected_in_tasks_or_by_joins_are_the_same(spark):
    corpus = corpus_of(spark, random_docs(8))
    cut = lambda limits: sorted(clusters.fixed_k_clusters(corpus, 3, limits=limits).collect())
    assert "FlatMapGroupsInArrow" in plan_of(clusters.fixed_k_clusters(corpus, 3))
    assert cut(Limits()) == cut(Limits(block_articles=1))


def test_windows_of_few_edges_need_no_rounds(spark, monkeypatch):
    """Two windows with ties, a chain and a repeated edge: a task each finds the forest and labels that rounds of joins find."""
    rng = random.Random(5)
    rows = [(w, f"{a:02d}", f"{b:02d}", rng.choice([0.5, 0.6, 0.7])) for w in (1, 2) for a, b in itertools.combinations(range(14), 2) if rng.random() < 0.12]
    rows += [(2, f"{i:02d}", f"{i + 1:02d}", 0.4) for i in range(40, 60)] + [rows[0], rows[0]]
    edges = spark.createDataFrame(rows, "w int, a string, b string, cosine double").select(
        F.timestamp_seconds("w").alias("begin"), F.timestamp_seconds(F.col("w") + 1).alias("end"), "a", "b", "cosine")
    found = lambda: [sorted(map(tuple, part.collect())) for part in spanning_forest(edges)]
    monkeypatch.setattr("storyweave.operators.graph.WINDOW_EDGES", 0)
    want = found()
    monkeypatch.setattr("storyweave.operators.graph.WINDOW_EDGES", 25)
    assert found() == want  # one window by rounds, one in a task
    monkeypatch.undo()
    monkeypatch.setattr("storyweave.operators.graph.checkpointed", None)
    assert found() == want and len(want[0]) < len(rows)


def test_densities_of_a_whole_window_need_no_second_shuffle(spark, monkeypatch):
    """Densities and the forest among core articles come from one task; in windows of many blocks from two steps, with the same result."""
    corpus, small = corpus_of(spark, random_docs(9)), Limits(block_postings=150, block_articles=16)
    found = lambda limits: sorted(clusters.label_members(corpus, clusters.dbscan(corpus, 1.0, 3, True, limits)).select("article_id", "label").collect())
    steps = similarity.degrees
    monkeypatch.setattr(similarity, "degrees", None)
    whole = found(Limits())
    monkeypatch.setattr(similarity, "degrees", steps)
    monkeypatch.setattr(similarity, "TASK_BLOCKS", 1)
    assert whole == found(small) and len({label for _, label in whole}) > 2


def test_blocks_are_stored_once_and_read_by_the_tasks(spark, monkeypatch):
    """No article is copied for the pairs of blocks that it is compared in, and each pair of blocks is compared once."""
    reps, small = corpus_of(spark, random_docs(10)).reps, Limits(block_postings=60, block_articles=6)
    whole = sorted(similarity.edges(reps, 0.3).collect())
    monkeypatch.setattr(similarity, "TASK_BLOCKS", 1)
    kept = {}
    monkeypatch.setattr(similarity, "staged", lambda df, name, *by: kept.setdefault(name, staged(df, name, *by)))
    assert sorted(similarity.edges(reps, 0.3, "pairs", small).collect()) == whole
    assert kept["placed"].count() == reps.count() and "terms" not in kept["strips"].columns
    pairs = [(r.lo, o.hi) for r in kept["strips"].collect() for o in r.others]
    n = kept["blocks"].count()
    assert n > similarity.STRIP and len(pairs) == len(set(pairs)) == n * (n + 1) // 2
