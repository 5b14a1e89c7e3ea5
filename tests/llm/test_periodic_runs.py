"""Periodic runs against a search by definition."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from storyweave.llm import periodic_runs
from storyweave.llm.queries import QUERIES
from helpers import docs, odd_rows


def plain_runs(words: list, least: int = 6, times: int = 4) -> list[tuple]:
    """Every maximal stretch of each period, smallest period first; a stretch has the smallest of its periods."""
    found = {}
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            if length >= 2 * q:
                found.setdefault((start, length), q)
    return sorted(((s, n, q) for (s, n), q in found.items() if n >= max(least, times * q)), key=lambda r: (r[0], r[2]))


def plain_row(text: str | None) -> tuple:
    words = (text or "").encode().split()
    runs = plain_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    told = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (len(runs), *told, hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def plain_planted(doc: int | None, text: str | None) -> str | None:
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc).encode()) if doc is not None else 1
    if h % 10 or not words:
        return text
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return b" ".join(words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)).decode()


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_the_definition(seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(150):
        words = [rng.choice(b"abcd"[:rng.randint(1, 4)].decode()).encode() for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            at, q = rng.randint(0, len(words)), rng.randint(1, 5)
            block = [rng.choice([b"x", b"y", b"a"]) for _ in range(q)]
            words[at:at] = (block * 9)[:rng.randint(q, 9 * q)]
        texts.append(words)
    for least, times in ((6, 4), (2, 2), (1, 3)):
        got = periodic_runs.runs_of(texts, least, times)
        assert [list(map(tuple, g.tolist())) for g in got] == [plain_runs(w, least, times) for w in texts]


def test_long_runs_and_their_neighbours():
    fib = [b"a", b"ab"]
    while len(fib[-1]) < 600:
        fib.append(fib[-1] + fib[-2])
    texts = [[b"w"] * 5000, [b"a", b"b"] * 700 + [b"a"], [bytes([c]) for c in fib[-1]], [], [b"one"]]
    for least, times in ((6, 4), (2, 2)):
        got = periodic_runs.runs_of(texts, least, times)
        assert got[0].tolist() == [[0, 5000, 1]] and got[1].tolist() == [[0, 1401, 2]]
        assert list(map(tuple, got[2].tolist())) == plain_runs(texts[2], least, times)
        assert not len(got[3]) and not len(got[4])


@pytest.mark.parametrize("size", [10, 200_000])
def test_rows_of_odd_tables(spark, size):
    rows = [r for r in odd_rows() if len(r[1] or "") < 10_000] + [(20, "go " * 900), (21, "x a b a b a b a b a b y\tz  z z z z z z"), (22, "é é " * 8)]
    rows.append((23, " ".join(f"w{i}" for i in range(3000)) + " again and" * 50))
    table = docs(spark, rows)
    got = sorted(map(str, periodic_runs.run_digests(table, words=size).collect()))
    from pyspark.sql import Row

    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert got == sorted(str(Row(**dict(zip(names, (d, *plain_row(t)))))) for d, t in rows)
    texts = {r.doc_id: (r.text, [tuple(x) for x in r.runs]) for r in periodic_runs.find_runs(table).collect()}
    assert texts[20] == ("go", [(0, 900, 1)]) and texts[23][0].endswith("w2999 again and") and texts[4] == ("", [])


def test_empty_table(spark):
    assert periodic_runs.run_digests(docs(spark, [])).count() == 0
    assert periodic_runs.find_runs(docs(spark, [])).count() == 0


def test_query_on_the_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op12_periodic_runs"](spark, folder).collect()}
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    short = [(d, plain_planted(d, t)) for d, t in rows if len((t or "").split()) < 1200]
    assert len(short) > 100 and sum(got[d][0] > 0 for d, _ in short) > 5
    assert {d: got[d] for d, _ in short} == {d: plain_row(t) for d, t in short}


def test_planting_leaves_rows_without_number_or_text(spark):
    rows = [(None, "a b c"), (None, None), *[(i, t) for i in range(40) for t in (None, "", " ", "one", "b c d e f g h i j k l m n o p")]]
    got = sorted(str((r.doc_id, " ".join((r.text or "").split()))) for r in periodic_runs.planted(docs(spark, rows)).collect())
    assert got == sorted(str((d, " ".join((plain_planted(d, t) or "").split()))) for d, t in rows)
