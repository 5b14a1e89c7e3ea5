"""Importance resampling against a plain version."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from storyweave.llm import importance
from helpers import docs, odd_rows

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text: str | None, most: int = 1) -> list[bytes]:
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return [" ".join(words[i:i + n]).encode() for n in range(1, most + 1) for i in range(len(words) - n + 1)]


def plain(rows: list[tuple], target: list[str], most: int = 1, buckets: int = 10_000, least: int = 20, percent: int = 10) -> list[tuple]:
    bucket = lambda f: zlib.crc32(f) % buckets
    s = Counter(bucket(f) for _, text in rows for f in features(text, most))
    t = Counter(bucket(f) for text in target for f in features(text, most))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets))))
    out = []
    for doc, text in rows:
        own = features(text, most)
        weight = sum(gain(bucket(f)) for f in own) // len(own) if own else 0
        score = None
        if doc is not None:
            h = int(hashlib.sha256(f"2024:{doc}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc, len(own), weight, score, None, len(features(text)) >= least and doc is not None])
    able = sorted((r for r in out if r[5]), key=lambda r: (-r[3], r[0], r[1], r[2]))
    for place, row in enumerate(able[:percent * len(able) // 100], 1):
        row[4] = place
    return sorted(map(str, (tuple(r[:5]) for r in out)))


def many(n: int = 120) -> list[tuple]:
    rng = np.random.default_rng(7)
    words = ["alpha", "Beta", "gamma-delta", "ÉTÉ", "x_y", "10.5", "naïve", "zoo", "The", "of"]
    return [(int(i), " ".join(rng.choice(words, rng.integers(0, 60)))) for i in range(n)]


@pytest.mark.parametrize("most,buckets", [(1, 10_000), (3, 50)])
def test_odd_rows_equal_the_plain_version(spark, most, buckets):
    rows = odd_rows() + many() + [(500, "same words here " * 10), (500, "same words here " * 10), (501, "Ⅷ\x00ab\x7fcd\x80")]
    target = ["alpha zoo the of", None, "", "ÉTÉ été 10.5 Alpha"]
    known = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    got = importance.resample(docs(spark, rows).repartition(3), known, most=most, buckets=buckets)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(str(tuple(r)) for r in got.collect()) == plain(rows, target, most, buckets)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert importance.resample(docs(spark, []), none).count() == 0
    got = importance.resample(docs(spark, many(30)), none, percent=50)
    assert sorted(str(tuple(r)) for r in got.collect()) == plain(many(30), [], percent=50)


def test_interning_survives_equal_keys():
    words = importance.Words.of([b"one two one three two one", b"one", b"a-very-long-word" + b"x" * 40 + b" a"])
    start, end, _ = words.grams(2)
    for hashed in (lambda b: 5, lambda b: len(b), lambda b: (1 << 64) - 1):
        table = importance.Interned(words.data, start, end, 97, hashed)
        grams = [words.data[a:b] for a, b in zip(start.tolist(), end.tolist())]
        slots = table.slots.tolist()
        assert len(set(zip(grams, slots))) == len(set(grams)) == len(set(slots))
        assert [table.counts[s] for s in slots] == [grams.count(g) for g in grams]
        assert [table.buckets[s] for s in slots] == [zlib.crc32(g) % 97 for g in grams]
    empty = importance.Interned(b"", np.zeros(0, np.int64), np.zeros(0, np.int64), 97)
    assert not len(empty.slots)
