"""Periodic runs of words: maximal repetitions found by the branching-tandem test on an enhanced suffix array.

A run is a stretch of consecutive words with smallest period q, no neighbouring word extending it with that period, and of
``max(least, times * q)`` words at least. All documents of an Arrow batch are worked on at once in numpy, their words numbered apart, so
no repeat goes over a document's end:

* suffix array, inverse and longest common prefixes by prefix doubling; only suffixes still tied are sorted again;
* for each interval of common prefix d, the suffixes of all its children but the largest are tested: suffix i and suffix i + d (or i - d) in
  the same interval make a square of period d, branching if they go on differently;
* a branching square is the right end of a run; it is rotated to the left as far as the words agree, by the doubling's ranks;
* of the runs with the same ends the one with the smallest period is kept.

Null text has no words and so no run, like an empty one or one of white space. Rows that repeat a doc_id give a row each. Texts are worked on
whole: a batch holds as many documents as fit ``WORDS``, a longer document is a batch of its own, and memory grows with it. An empty table
gives an empty table; only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST = 6  # words of a run at least,
TIMES = 4  # and so many periods
WORDS = 200_000  # words worked on at once, but for longer documents
_NUMBERS = ("n_runs", "start", "length", "period", "exponent_milli")
_DIGESTS = ("runs_sha256", "collapsed_sha256")
_RUNS = ("array<struct<start: bigint, length: bigint, period: bigint>>",
         pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])))


def numbered(documents: list[list[bytes]]) -> np.ndarray:
    """Words as numbers, apart for each document, with a number of its own at each document's end."""
    out, first = [], 0
    for words in documents:
        known: dict[bytes, int] = {}
        out.append(np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words)) + first)
        out.append(np.array([first + len(known)]))
        first += len(known) + 1
    return np.concatenate(out) if out else np.zeros(0, np.int64)


class SuffixArray:
    """Suffixes of ``symbols`` in order. The last symbol of each document is unique, so equal stretches lie within documents.

    ``ranks[k][i]`` is the same for suffixes alike in their first 2^k symbols.
    """

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        self.symbols = symbols
        order = np.argsort(symbols, kind="stable")
        heads = np.ones(n, bool)
        heads[1:] = symbols[order[1:]] != symbols[order[:-1]]
        rank = np.empty(n, np.int64)
        rank[order] = np.maximum.accumulate(np.where(heads, np.arange(n), 0))
        self.ranks, width = [rank], 1
        while True:
            alone = heads & np.append(heads[1:], True)
            tied = order[~alone]
            if not len(tied):
                break
            # Tied suffixes agree in more symbols than a document's end would let them, so what follows is within the array.
            first, then = rank[tied], rank[tied + width]
            resorted = np.lexsort((then, first))
            tied, first, then = tied[resorted], first[resorted], then[resorted]
            places = np.flatnonzero(~alone)
            order[places] = tied
            new = np.ones(len(tied), bool)
            new[1:] = (first[1:] != first[:-1]) | (then[1:] != then[:-1])
            heads[places] = new
            rank = rank.copy()
            rank[tied] = np.maximum.accumulate(np.where(new, places, 0))
            self.ranks.append(rank)
            width *= 2
        self.order, self.inverse = order, np.empty(n, np.int64)
        self.inverse[order] = np.arange(n)

    def common(self) -> np.ndarray:
        """Longest common prefix of each suffix and the one before it in order; 0 for the first."""
        out = np.zeros(len(self.order), np.int64)
        at = np.flatnonzero(self.ranks[0][self.order[1:]] == self.ranks[0][self.order[:-1]]) + 1
        a, b = self.order[at - 1], self.order[at]
        for k in range(len(self.ranks) - 1, -1, -1):
            step = np.where(self.ranks[k][a] == self.ranks[k][b], 1 << k, 0)
            out[at] += step
            a, b = a + step, b + step
        return out

    def agreeing_before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols before a and before b are the same, for a < b."""
        out = np.zeros(len(a), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            left, right = a - out - (1 << k), b - out - (1 << k)
            room = left >= 0
            same = np.zeros(len(a), bool)
            same[room] = self.ranks[k][left[room]] == self.ranks[k][right[room]]
            out += np.where(same, 1 << k, 0)
        return out


def _minima(values: np.ndarray) -> list[np.ndarray]:
    """Level k at i: the least of the 2^k values from i on, as far as there are any above 0 so many in a row."""
    levels = [values]
    while len(levels[-1]) > 1 << (len(levels) - 1) and levels[-1].any():
        last, step = levels[-1], 1 << (len(levels) - 1)
        levels.append(np.minimum(last[:-step], last[step:]))
    return levels


def _reach(levels: list[np.ndarray], at: np.ndarray, bar: np.ndarray, way: int) -> np.ndarray:
    """How many values next to ``at``, going left (-1: from at - 1) or right (1: from at + 1), are at least ``bar``."""
    out = np.zeros(len(at), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        size = 1 << k
        begin = at - out - size if way < 0 else at + out + 1
        room = (begin >= 0) & (begin < len(levels[k]))
        more = np.zeros(len(at), bool)
        more[room] = levels[k][begin[room]] >= bar[room]
        out += np.where(more, size, 0)
    return out


def branching_squares(array: SuffixArray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(start, period)`` of the squares whose next word differs from the one a period before it."""
    cuts = np.flatnonzero(lcp > 0)  # each parts two children of the interval with prefix lcp around it
    depth = lcp[cuts]
    levels = _minima(lcp)
    low = cuts - 1 - _reach(levels, cuts, depth, -1)
    high = cuts + _reach(levels, cuts, depth, 1)
    # The child that ends before each cut, and after an interval's last cut the child that ends with the interval.
    before = _reach(levels, cuts, depth + 1, -1)
    after = _reach(levels, cuts, depth + 1, 1)
    final = cuts + after == high
    node = np.concatenate([np.arange(len(cuts)), np.flatnonzero(final)])
    first = np.concatenate([cuts - 1 - before, cuts[final]])
    last = np.concatenate([cuts - 1, high[final]])
    # Children of an interval together, the largest last: that one is left out.
    rank = np.lexsort((last - first, high[node], low[node]))
    node, first, last = node[rank], first[rank], last[rank]
    largest = np.ones(len(node), bool)
    largest[:-1] = (low[node[1:]] != low[node[:-1]]) | (high[node[1:]] != high[node[:-1]])
    node, first, last = node[~largest], first[~largest], last[~largest]
    sizes = last - first + 1
    shift = np.cumsum(sizes) - sizes
    member = np.repeat(first - shift, sizes) + np.arange(int(sizes.sum()))
    owner = np.repeat(node, sizes)
    suffix, d, low, high = array.order[member], depth[owner], low[owner], high[owner]
    n, symbols = len(array.order), array.symbols

    def squares(start: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Where the suffix ``other`` is in the interval too and goes on differently from ``start``."""
        inside = (other >= 0) & (other < n)
        ok = np.flatnonzero(inside)
        place = array.inverse[other[ok]]
        ok = ok[(place >= low[ok]) & (place <= high[ok])]
        return ok[symbols[suffix[ok] + d[ok]] != symbols[other[ok] + d[ok]]]

    ahead, behind = squares(suffix, suffix + d), squares(suffix, suffix - d)
    start = np.concatenate([suffix[ahead], suffix[behind] - d[behind]])
    period = np.concatenate([d[ahead], d[behind]])
    found = np.unique(np.stack([start, period], axis=1), axis=0)
    return found[:, 0], found[:, 1]


def runs_of(documents: list[list[bytes]], least: int = LEAST, times: int = TIMES) -> list[np.ndarray]:
    """For each document its runs as rows (start, length, period), by start, then period."""
    none = np.zeros((0, 3), np.int64)
    symbols = numbered(documents)
    array = SuffixArray(symbols)
    lcp = array.common()
    if not lcp.any():
        return [none] * len(documents)
    start, period = branching_squares(array, lcp)
    end = start + 2 * period
    start = start - array.agreeing_before(start, start + period)
    rank = np.lexsort((period, end, start))
    start, end, period = start[rank], end[rank], period[rank]
    kept = np.ones(len(start), bool)
    kept[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    kept &= end - start >= np.maximum(least, times * period)
    start, end, period = start[kept], end[kept], period[kept]
    rank = np.lexsort((period, start))
    found = np.stack([start, end - start, period], axis=1)[rank]
    ends = np.cumsum([len(words) + 1 for words in documents])
    begins = np.concatenate([[0], ends[:-1]])
    cut = np.searchsorted(found[:, 0], np.concatenate([begins, ends[-1:]]))
    return [found[a:b] - np.array([at, 0, 0]) for at, a, b in zip(begins, cut, cut[1:])]


def dropped(n: int, runs: np.ndarray) -> np.ndarray:
    """True for the words that lie in a run after its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change)[:n] > 0


def _worked(texts: list[bytes | None], size: int) -> Iterator[list[list[bytes]]]:
    """The words of each text, in groups of ``size`` words or of one longer text."""
    group, held = [], 0
    for text in texts:
        words = (text or b"").split()  # of bytes: at ASCII white space only
        if group and held + len(words) > size:
            yield group
            group, held = [], 0
        group.append(words)
        held += len(words) + 1
    if group:
        yield group


def _each(docs: DataFrame, row, columns: dict[str, tuple[str, pa.DataType]], least: int, times: int, words: int) -> DataFrame:
    """``row(words, runs)`` of each document as the columns beside doc_id."""
    kind = dict(docs.dtypes)["doc_id"]

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, rows = batch.column("text").cast(pa.binary()).to_pylist(), []
            for group in _worked(texts, words):
                rows += [row(own, runs) for own, runs in zip(group, runs_of(group, least, times))]
            if rows:
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c, t) for c, (_, t) in zip(zip(*rows), columns.values())]], names=["doc_id", *columns])

    return docs.select("doc_id", "text").mapInArrow(found, f"doc_id {kind}, " + ", ".join(f"{c} {t}" for c, (t, _) in columns.items()))


def find_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES, words: int = WORDS) -> DataFrame:
    """``(doc_id, text, runs)``: the text with repeated periods left out, its words joined by a blank, and the runs
    ``(start, length, period)`` of the text given, in words."""
    def row(own: list[bytes], runs: np.ndarray) -> tuple:
        gone = dropped(len(own), runs)
        kept = b" ".join(w for w, g in zip(own, gone.tolist()) if not g)
        return kept.decode(), [{"start": s, "length": n, "period": q} for s, n, q in runs.tolist()]

    return _each(docs, row, {"text": ("string", pa.string()), "runs": _RUNS}, least, times, words)


def run_digests(docs: DataFrame, least: int = LEAST, times: int = TIMES, words: int = WORDS) -> DataFrame:
    """``find_runs`` as digests: the number of runs, the longest (then first, then of smallest period), and a SHA-256 of all runs
    and of the text without repeats. Without a run start, length, period and exponent are null."""
    def row(own: list[bytes], runs: np.ndarray) -> tuple:
        gone = dropped(len(own), runs)
        kept = b" ".join(w for w, g in zip(own, gone.tolist()) if not g) if len(runs) else b" ".join(own)
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs.tolist())
        top = min(runs.tolist(), key=lambda r: (-r[1], r[0], r[2]), default=None)
        told = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
        return (len(runs), *told, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())

    return _each(docs, row, dict.fromkeys(_NUMBERS, ("bigint", pa.int64())) | dict.fromkeys(_DIGESTS, ("string", pa.string())), least, times, words)


def planted(docs: DataFrame) -> DataFrame:
    """Every tenth document by checksum of its doc_id made periodic from one of its words on: the input of the query.

    With h the CRC-32 of the doc_id in decimals, g = h / 10 and n words, word i >= a = g % n becomes word a + (i - a) % p of the text, where
    p = 1 + (n - a) / (3 + g % 8). A null doc_id or text stays as it is.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    told = docs.select("doc_id", "text", (F.pmod(h, F.lit(10)) == 0).alias("chosen"), F.floor(h / 10).alias("g"))
    told = told.withColumn("words", F.when(F.col("chosen"), words))
    n = F.size("words")
    told = told.withColumn("a", F.when(n > 0, F.pmod(F.col("g"), n).cast("int")))
    told = told.withColumn("p", (1 + F.floor((n - F.col("a")) / (3 + F.pmod(F.col("g"), F.lit(8))))).cast("int"))
    a, p = F.col("a"), F.col("p")

    def moved(i: Column) -> Column:
        return F.get(F.col("words"), F.when(i < a, i).otherwise(a + F.pmod(i - a, p)))

    changed = F.array_join(F.transform(F.sequence(F.lit(0), n - 1), moved), " ")
    return told.select("doc_id", F.when(a.isNotNull(), changed).otherwise(F.col("text")).alias("text"))
