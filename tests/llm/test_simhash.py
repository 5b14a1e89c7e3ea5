import random
import re

import numpy as np
import pytest
import xxhash
from helpers import docs, groups_of, odd_rows

from storyweave.llm import queries, simhash

SMALL = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    parts = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(p.encode(), seed=42).intdigest() for p in parts]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    prints = {doc: plain_fingerprint(text) for doc, text in rows}
    links = {(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 4}
    want = {doc: (f"{prints[doc]:016x}", c) for doc, c in groups_of(links, prints).items()}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.QUERIES["op3_simhash"](spark, SMALL).collect()}
    assert got == want and len(links) > 5


@pytest.mark.parametrize("tile", [3, 4096])
def test_all_links_at_the_radius(spark, tile):
    """Chains of fingerprints four and five bits apart, in one cell and across cells."""
    draw = random.Random(3)
    prints = [draw.getrandbits(64) for _ in range(40)]
    for start in list(prints):
        x = start
        for step in range(4):
            for bit in draw.sample(range(64), 4 + step // 3):
                x ^= 1 << bit
            prints.append(x)
    prints = sorted({np.uint64(x).view(np.int64).item() for x in [*prints, 0, (1 << 64) - 1]})
    found = {(a, b) for i, a in enumerate(prints) for b in prints[i + 1:] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 4}
    edges = simhash.links(spark.createDataFrame([(x,) for x in prints], "bits bigint"), tile=tile).collect()
    assert {(min(e), max(e)) for e in map(tuple, edges)} <= found
    assert groups_of({tuple(e) for e in edges}, prints) == groups_of(found, prints)


def test_odd_rows(spark):
    given = docs(spark, odd_rows())
    got = {(r.doc_id, r.bits): r.component_id for r in simhash.groups(given).collect()}
    assert got[(4, 0)] == got[(5, 0)] == got[(3, 0)] == got[(None, 0)] == 3
    same = simhash.fingerprint_of("the same text of some length, told once more")
    assert got[(2, np.uint64(same).view(np.int64).item())] == 1
    kept = simhash.keep_one(given)
    assert kept.columns == given.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [1, 3, 6, 7, 9]
    assert kept.filter("doc_id is null").count() == 2
    assert simhash.groups(docs(spark, [])).count() == 0 and simhash.keep_one(docs(spark, [])).count() == 0


def test_a_number_with_texts_of_different_groups_keeps_one_of_each(spark):
    """Rows that share a doc_id are told apart by their texts; null numbers stay."""
    first, second = "one text about the sea and its many ships", "quite another story of hills, woods and old towns by the road"
    rows = [(2, first), (2, second), (2, first), (3, second), (4, first), (None, first), (None, first)]
    out = sorted(((r.doc_id or 0, r.text) for r in simhash.keep_one(docs(spark, rows)).collect()))
    assert out == sorted([(2, first), (2, second), (0, first), (0, first)])
