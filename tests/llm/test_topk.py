import math
import random

import numpy as np
import pytest

from storyweave.llm import topk


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 2.0) for i, v in rows], "vec_id bigint, embedding array<double>, score int, shard string, bound double")


def brute(rows, k=20, every=20):
    known = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            scaled = [math.floor(64 * x) for x in v]
            known[i] = min(known.get(i, scaled), scaled)
    out = set()
    for q in known:
        if q % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(known[q], v)), i) for i, v in known.items() if i != q and len(v) == len(known[q]))
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])}
    return out


@pytest.mark.parametrize("shard,block", [(100, 7), (8192, 2048)])
def test_against_all_products(spark, shard, block):
    draw = random.Random(5)
    rows = [(i, [round(draw.gauss(0, 1), 1) for _ in range(8)]) for i in range(900)]
    rows += [(1000 + i, rows[3][1]) for i in range(60)]  # ties
    got = topk.top_k(vectors(spark, rows), shard=shard, block=block)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert {tuple(r) for r in got.collect()} == brute(rows)


def test_odd_rows(spark):
    rows = [(0, [1.0, 2.0]), (20, None), (40, [float("nan"), 1.0]), (60, [None, 1.0]), (80, [0.0, 0.0]), (1, [1.0, 2.0]), (2, [-1.5, 0.01]),
            (1, [1.0, 1.0]), (None, [1.0, 1.0]), (100, [3.0]), (101, [4.0]), (120, [1e7, 1.0]), (121, [float("inf"), 1.0])]
    got = [tuple(r) for r in topk.top_k(vectors(spark, rows)).collect()]
    assert set(got) == brute(rows) and len(got) == len(set(got))
    assert topk.top_k(vectors(spark, [])).count() == 0
    assert topk.top_k(vectors(spark, [(0, [1e300]), (1, [1e300])])).first().score == (1 << 63) - 1


def test_tree_leaves_nodes_out():
    draw = np.random.default_rng(0)
    points = np.concatenate([draw.normal(loc=40 * c, size=(500, 4)).round() for c in range(8)])
    tree = topk.BallTree(points, np.arange(len(points)), leaf=50)
    found = topk.search(tree, points[-3:], np.arange(len(points))[-3:], np.full(3, -np.inf), 5)
    for own, query, scored in zip(range(len(points) - 3, len(points)), points[-3:], found):
        want = sorted((-int(s), i) for i, s in enumerate(points @ query) if i != own)[:5]
        assert scored == want
