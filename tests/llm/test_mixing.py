from collections import defaultdict

import numpy as np
from helpers import docs, odd_rows
from hypothesis import given, settings
from hypothesis import strategies as st

from storyweave.llm import mixing, queries

SMALL = "/root/testdata/sf0.01"


def plain_targets(sizes):
    """By the rule's words: share by weight, stop at three times, share the excess again."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, open_, out = sum(sizes.values()), set(order), {}
    while open_:
        rest = total - sum(out.values())
        share = {s: rest * weight[s] / sum(weight[o] for o in open_) for s in open_}
        above = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not above:
            return out | share
        out |= {s: 3.0 * sizes[s] for s in above}
        open_ -= above
    return out


def test_whole_table(spark):
    rows = queries.QUERIES["op6_mixing"](spark, SMALL).collect()
    source = {r.doc_id: r.source for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[source[r.doc_id]] += r["size"]
        taken[source[r.doc_id]] += r.taken
        assert r.taken <= 3 * r["size"] and (r["size"] == 0 or r.taken % r["size"] == 0)
    want = plain_targets(dict(sizes))
    for r in rows:
        assert r.source_size == sizes[source[r.doc_id]] and abs(r.target - want[source[r.doc_id]]) < 1e-6
    assert all(abs(taken[s] - want[s]) <= 2 for s in want)
    again = queries.QUERIES["op6_mixing"](spark, SMALL).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_sources_that_stop_at_three_times(spark):
    rows = [(i, "w " * 10, "en", "a", 20) for i in range(3)] + [(10 + i, "w " * 10, "en", s, 20) for i, s in enumerate(["b", "c", None] * 20)]
    got = {(r.source): (r.source_size, r.target) for r in mixing.mix(docs(spark, rows)).collect()}
    sizes = {s: v[0] for s, v in got.items()}
    want = plain_targets(sizes)
    assert got["a"][1] == 90.0 and all(abs(got[s][1] - want[s]) < 1e-9 for s in want) and None in got


def test_odd_rows(spark):
    given_ = docs(spark, odd_rows())
    got = mixing.mix(given_)
    assert got.count() == given_.count()
    sizes = {r.doc_id: r["size"] for r in got.collect()}
    assert sizes[3] == sizes[4] == sizes[5] == 0 and sizes[7] == 80_000
    kept = mixing.mixed_documents(given_)
    assert kept.columns == given_.columns
    assert mixing.mix(docs(spark, [])).count() == 0 and mixing.mixed_documents(docs(spark, [])).count() == 0
    assert [r.copies for r in mixing.mix(docs(spark, [(1, None), (2, "")])).collect()] == [0, 0]


def test_documents_as_often_as_taken(spark):
    rows = [(i, f"w{i} " * (i % 7 + 1), "en", "abcd"[i % 4], 5) for i in range(80)]
    taken = {r.doc_id: r.copies for r in mixing.mix(docs(spark, rows)).collect()}
    count = defaultdict(int)
    for r in mixing.mixed_documents(docs(spark, rows)).collect():
        count[r.doc_id] += 1
    assert count == {d: n for d, n in taken.items() if n}


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 6), min_size=1, max_size=8), st.floats(0, 1), st.sampled_from([5, 1 << 15]))
def test_subset_sums(counts, part, limit):
    lengths, n = np.array(sorted(counts)), np.array([counts[x] for x in sorted(counts)])
    total = int((lengths * n).sum())
    budget = int(total * part)
    taken = mixing.subset_counts(lengths, n, budget, limit)
    assert (taken >= 0).all() and (taken <= n).all()
    reach = {0}
    for x, c in zip(lengths, n):
        reach = {r + k * x for r in reach for k in range(c + 1)}
    # The same share of each length comes first; what that leaves open is fitted as well as the lengths left allow.
    fixed = np.array([c * budget // total for c in n])
    left = {0}
    for x, c in zip(lengths, n - fixed):
        left = {r + k * x for r in left for k in range(c + 1)}
    rest = budget - int((fixed * lengths).sum())
    if limit > total:
        assert abs(int((taken * lengths).sum()) - budget) <= min(abs(r - rest) for r in left if r <= rest)
    else:
        assert abs(int((taken * lengths).sum()) - budget) <= lengths.max()


def test_repeated_and_null_numbers_keep_their_texts(spark):
    """One source, so all is taken: each text as often as it came, whatever its doc_id."""
    rows = [(1, "aa bb cc"), (1, "dd ee ff"), (1, "aa bb cc"), (None, "gg hh ii"), (None, "jj kk ll"), (2, "mm")]
    table = docs(spark, rows).selectExpr("*", "'x' as size_", "'x' as copies_", "'x' as doc_", "'x' as row", "'x' as key", "'x' as text_hash")
    out = mixing.mixed_documents(table)
    assert out.columns == table.columns
    assert sorted((r.doc_id or 0, r.text) for r in out.collect()) == sorted((d or 0, t) for d, t in rows)
