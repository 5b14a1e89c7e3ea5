import numpy as np
from helpers import groups_of

from storyweave.llm import embedding_dedup, queries

KIND = "vec_id bigint, embedding array<double>, label int, node string, v string, home string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", "x", "x") for i, v in rows], KIND)


def brute(rows, threshold=0.9):
    """Links and groups over the rows, by position; unusable vectors link with nothing."""
    good = [k for k, (i, v) in enumerate(rows) if i is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    points = np.array([rows[k][1] for k in good], float)
    unit = points / np.linalg.norm(points, axis=1)[:, None]
    near = unit @ unit.T >= threshold
    links = {(good[a], good[b]) for a, b in zip(*np.nonzero(np.triu(near, 1)))}
    n = {k: 0 for k in range(len(rows))}
    for a, b in links:
        n[a] += 1
        n[b] += 1
    return links, n, groups_of(links, range(len(rows)))


def planted(seed=1, n=1500, dim=24):
    """Noise, and families around seeds at cosines from 0.85 up."""
    draw = np.random.default_rng(seed)
    points = [draw.normal(size=dim) for _ in range(n)]
    for family in range(60):
        centre = draw.normal(size=dim)
        centre /= np.linalg.norm(centre)
        for _ in range(2 + family % 9):
            noise = draw.normal(size=dim)
            noise /= np.linalg.norm(noise)
            points.append(3 * (centre + draw.uniform(0, 0.4) * noise))
    return [(i, p.tolist()) for i, p in enumerate(points)]


def test_recall_and_precision(spark):
    rows = planted()
    links, counts, _ = brute(rows)
    got = {r.vec_id: r for r in embedding_dedup.groups(vectors(spark, rows), per_list=100, block=64, sample=600).collect()}
    found = sum(r.n_links for r in got.values())
    assert len(links) > 200 and 0.9 * 2 * len(links) <= found <= 2 * len(links)
    assert all(got[i].n_links <= counts[i] for i in counts)
    print("recall", found / (2 * len(links)))


def test_few_vectors_are_exact(spark):
    rows = planted(seed=2, n=300)
    rows += [(5000 + i, rows[310][1]) for i in range(50)] + [(6000, [-x for x in rows[310][1]])]
    rows += [(7000, None), (7001, [0.0] * 24), (7002, [float("nan")] * 24), (7003, [None] + [1.0] * 23), (7004, [1.0] * 5), (7005, [float("inf")] + [0.0] * 23),
             (7006, []), (7007, [1e300] + [0.0] * 23), (7008, [1e-300] + [0.0] * 23)]
    plain = [(i, v if v is not None and len(v) == 24 else None) for i, v in rows]
    plain = [(i, [1.0] + [0.0] * 23) if i in (7007, 7008) else (i, v) for i, v in plain]
    _, counts, label = brute(plain)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.groups(vectors(spark, rows), probes=64, per_list=50).collect()}
    assert got == {rows[k][0]: (counts[k], rows[label[k]][0], label[k] == k) for k in range(len(rows))}


def test_repeated_and_null_ids(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.0]), (2, [1.0, 0.1]), (3, [0.0, 1.0]), (4, [-0.0, 1.0])]
    got = sorted(map(tuple, embedding_dedup.groups(vectors(spark, rows)).collect()), key=repr)
    assert got == sorted([(1, 2, 1, True), (1, 2, 1, True), (None, 0, None, False), (2, 2, 1, False), (3, 1, 3, True), (4, 1, 3, False)], key=repr)
    assert embedding_dedup.groups(vectors(spark, [])).count() == 0


def test_table(spark):
    assert queries.QUERIES["op7_embedding_dedup"](spark, "/root/testdata/sf0.001").filter("n_links < 0").count() == 0


def test_every_length_links(spark):
    rows = planted(seed=4, n=120, dim=8)[:260] + [(1000 + i, v[:5]) for i, v in planted(seed=5, n=60, dim=8)[:150]] + [(2000, [2.0]), (2001, [1.0]), (2002, [-1.0] * 3)]
    want = {}
    for size in (8, 5, 1, 3):
        own = [r for r in rows if len(r[1]) == size]
        _, counts, label = brute(own)
        want |= {own[k][0]: (counts[k], own[label[k]][0], label[k] == k) for k in range(len(own))}
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.groups(vectors(spark, rows), probes=64, per_list=50).collect()}
    assert got == want and sum(n > 0 for n, _, _ in want.values()) > 100
