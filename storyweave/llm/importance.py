"""Importance resampling towards a target distribution, by hashed n-gram counts.

Texts are lower-cased (A-Z), cut into words (runs of digits, letters and anything beyond ASCII), and counted by runs of 1 to ``most``
words, joined by one space, each in the bucket of its CRC-32. A bucket's gain is the logarithm of its share in the target over its share in
the corpus, add-one smoothed, in thousandths and floored; a document's weight is the floored mean of the gains of its n-grams. Weight plus
Gumbel noise drawn from the document's number is its score, and the highest scores are drawn, which samples without replacement
in proportion to the exponential of the weights.

In a task the n-grams of each Arrow batch are interned in an open-addressed numpy table: keys are XXH64 values, a slot is taken only by n-grams whose
bytes are verified equal, and holds bucket and count; each occurrence keeps its slot's number. Counting adds up slots by
bucket; weighing gathers the gains of the occurrences' slots. Two passes over the texts, each with a table per batch; what leaves a
task of the first is a row per bucket, ``buckets`` of them at most, and the gains, as many, go to all tasks of the second.

Null text has no words; a document without n-grams has weight 0. Documents of fewer than ``least`` words, and those with a null doc_id, which has no
noise, are counted in the corpus but never drawn; the latter's score is null. Rows that repeat a doc_id are documents of
their own with the same noise; ties go to the smaller doc_id, then by number of n-grams and weight. Texts are read whole. Empty tables
give an empty table, and an empty target gains by smoothing alone; only doc_id and text are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storyweave.llm.common import staged
from storyweave.operators.ranking import ranked

MOST = 1  # words of an n-gram at most
BUCKETS = 10_000
LEAST = 20  # words of a document that can be drawn
PERCENT = 10
SEED = 2024
_SCALE = 1000
_WORDS = 1 << 18  # words of a batch worked on at once, but for longer documents


def _classes() -> np.ndarray:
    """For each byte, itself lower-cased if it belongs to a word, else a space."""
    table = np.full(256, 0x20, np.uint8)
    for low, high, shift in ((0x30, 0x39, 0), (0x41, 0x5A, 0x20), (0x61, 0x7A, 0), (0x80, 0xFF, 0)):
        table[low:high + 1] = np.arange(low, high + 1) + shift
    return table


_BYTES = _classes()


@dataclass
class Words:
    """The words of several texts, one after another: ``data`` with a space between each two, and where they lie in it."""

    data: bytes
    starts: np.ndarray
    ends: np.ndarray
    counts: np.ndarray  # words of each text

    @classmethod
    def of(cls, texts: list[bytes | None]) -> Words:
        # Bytes of a code point beyond ASCII are all from 128 on, so words are cut by bytes.
        cut = [(t or b"").translate(_BYTES.tobytes()).split() for t in texts]
        words = [w for own in cut for w in own]
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1
        return cls(b" ".join(words), ends - sizes, ends, np.array([len(own) for own in cut], np.int64))

    def grams(self, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(start, end, text)`` of every run of up to ``most`` words that lies in one text."""
        text = np.repeat(np.arange(len(self.counts)), self.counts)
        spans = []
        for n in range(1, most + 1):
            first = np.arange(max(0, len(text) - n + 1))
            first = first[text[first] == text[first + n - 1]]
            spans.append((self.starts[first], self.ends[first + n - 1], text[first]))
        return tuple(np.concatenate(parts) for parts in zip(*spans))


class Interned:
    """An open-addressed table of the different byte strings among ``data[start:end]``.

    All strings probe at once: those that find a free slot claim it, and one of the claimants gets it; those whose slot holds their key and, byte for
    byte, their string are placed; the others go on to the next slot. ``slots`` tells each string's slot, ``counts`` and ``buckets`` are by slot.
    """

    def __init__(self, data: bytes, start: np.ndarray, end: np.ndarray, buckets: int, hashed=xxhash.xxh64_intdigest):
        n = len(start)
        size = 1 << max(4, (2 * n - 1).bit_length() if n else 4)
        keys = np.fromiter((hashed(data[a:b]) for a, b in zip(start.tolist(), end.tolist())), np.uint64, n)
        self.keys, self.owner = np.zeros(size, np.uint64), np.full(size, -1, np.int64)
        self.slots = np.empty(n, np.int64)
        # Padded, so that eight bytes can be read from anywhere in it.
        view = np.ndarray((len(data) + 1,), "<u8", data + bytes(8), strides=(1,))
        sizes, waiting = end - start, np.arange(n)
        place = (keys & np.uint64(size - 1)).astype(np.int64)
        while len(waiting):
            at = place[waiting]
            free = self.owner[at] < 0
            self.owner[at[free]] = waiting[free]  # of several claimants the last
            self.keys[at[free]] = keys[self.owner[at[free]]]
            first = self.owner[at]
            same = np.flatnonzero((self.keys[at] == keys[waiting]) & (sizes[first] == sizes[waiting]))
            same = same[self._equal(view, start[waiting[same]], start[first[same]], sizes[waiting[same]])]
            self.slots[waiting[same]] = at[same]
            left = np.ones(len(waiting), bool)
            left[same] = False
            waiting = waiting[left]
            place[waiting] = (place[waiting] + 1) & (size - 1)
        self.counts = np.bincount(self.slots, minlength=size)
        self.buckets = np.zeros(size, np.int64)
        used = np.flatnonzero(self.owner >= 0)
        spans = zip(start[self.owner[used]].tolist(), end[self.owner[used]].tolist())
        self.buckets[used] = np.fromiter((zlib.crc32(data[a:b]) for a, b in spans), np.int64, len(used)) % buckets

    @staticmethod
    def _equal(view: np.ndarray, a: np.ndarray, b: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Whether strings of the same size are the same, eight bytes at a time; the last eight without what follows them."""
        out, live, at = np.ones(len(a), bool), np.flatnonzero((sizes > 0) & (a != b)), 0
        while len(live):
            rest = sizes[live] - at
            over = np.maximum(8 - rest, 0).astype(np.uint64) * np.uint64(8)
            differ = ((view[a[live] + at] ^ view[b[live] + at]) << over) != 0
            out[live[differ]] = False
            at += 8
            live = live[~differ & (rest > 8)]
        return out


def _batches(texts: list[bytes | None], size: int) -> Iterator[list[bytes | None]]:
    """Texts in groups of about ``size`` words, told by their bytes, or of one longer text."""
    group, held = [], 0
    for text in texts:
        length = len(text or b"") // 6
        if group and held + length > size:
            yield group
            group, held = [], 0
        group.append(text)
        held += length
    if group:
        yield group


def _texts(batch: pa.RecordBatch) -> list[bytes | None]:
    return batch.column("text").cast(pa.binary()).to_pylist()


def bucket_counts(docs: DataFrame, most: int = MOST, buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, n)``: the n-grams of all texts in each bucket that has any."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for group in _batches(_texts(batch), _WORDS):
                words = Words.of(group)
                start, end, _ = words.grams(most)
                table = Interned(words.data, start, end, buckets)
                # Whole numbers below 2^53, so exact as the doubles that bincount adds.
                total += np.bincount(table.buckets, weights=table.counts, minlength=buckets).astype(np.int64)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], names=["bucket", "n"])

    return docs.select("text").mapInArrow(counted, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, most: int = MOST, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of each bucket; what reaches the driver is a row per bucket of each side."""
    sides = []
    for docs in (corpus, target):
        counts = np.zeros(buckets, np.int64)
        for bucket, n in bucket_counts(docs, most, buckets).collect():
            counts[bucket] = n
        sides.append(counts)
    s, t = sides
    odds = (t + 1).astype(np.float64) * float(s.sum() + buckets) / ((s + 1).astype(np.float64) * float(t.sum() + buckets))
    return np.floor(_SCALE * np.log(odds)).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, most: int = MOST) -> DataFrame:
    """``(doc_id, n_words, n_features, weight)`` of each row, given the gain of each bucket."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value = shared.value
        for batch in batches:
            parts = []
            for group in _batches(_texts(batch), _WORDS):
                words = Words.of(group)
                start, end, text = words.grams(most)
                table = Interned(words.data, start, end, len(value))
                of_slot = value[table.buckets]
                total = np.zeros(len(group), np.int64)
                np.add.at(total, text, of_slot[table.slots])
                features = np.bincount(text, minlength=len(group))
                parts.append((words.counts, features, np.where(features > 0, total // np.maximum(features, 1), 0)))
            if parts:
                columns = [pa.array(np.concatenate(p).astype(np.int64)) for p in zip(*parts)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", "n_words", "n_features", "weight"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(weighed, f"doc_id {kind}, n_words bigint, n_features bigint, weight bigint")


def noise(seed: int = SEED) -> Column:
    """Gumbel noise in thousandths from the first 32 bits of a SHA-256 of seed and doc_id; null for a null doc_id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-float(_SCALE)) * F.log(-F.log((h + F.lit(0.5)) / F.lit(float(1 << 32)))))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least: int = LEAST, most: int = MOST,
             buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """``(doc_id, n_features, weight, score, rank)`` of each row; rank counts the drawn documents from 1 and is null for others."""
    weights = weigh(docs, gains(docs, target, most, buckets), most)
    scored = staged(weights.withColumn("score", (F.col("weight") + noise(seed)).cast("bigint")), "scored")
    able = (F.col("n_words") >= least) & F.col("doc_id").isNotNull()
    drawn = percent * scored.filter(able).count() // 100
    placed = ranked(scored.withColumn("out", ~able), ["out"], [F.desc("score"), F.col("doc_id"), F.col("n_features"), F.col("weight")], "place")
    rank = F.when(~F.col("out") & (F.col("place") <= drawn), F.col("place").cast("bigint"))
    return placed.select("doc_id", "n_features", "weight", "score", rank.alias("rank"))
