"""Quality classifier by co-training: a text view and a metadata view teach each other, then their calibrated scores combine.

The text view is a logistic model on the style of the whole text (letters, marks, repetition, word and line shapes); the metadata view
one on source, language and length. Both start from the labelled documents. In each round every unlabelled document that one
view is confident about becomes a weighted example for the other view. At last a logistic model of the two views' log-odds, fitted on
labelled documents that neither view learnt from, calibrates and combines them into the probability of good quality.

Features are written once; each Newton step is a job that adds up the gradient and Hessian over all documents, a few thousand
numbers whatever the size, so no sample is drawn and no document's data reach the driver. Labels: a document labelled more than
once counts as good if half of its labels say so; labels of null quality or doc_id are left out.

A null text counts as empty, an empty text has features zero. Null source, language or length are values of their own. A row with a
null doc_id is scored like any other but has no label. Rows that repeat a doc_id are scored each and learnt from each. With
fewer than two classes among the labels every document has the score 1 and is kept. An empty table gives an empty table.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storyweave.llm.common import staged

ROUNDS = 3
STEPS = 6  # Newton steps on the labelled documents,
MORE = 2  # and in each round after
CONFIDENT = 0.97
PSEUDO = 0.2  # weight of a pseudo-label
RIDGE = 1.0
CUT = 0.5
HELD = 4  # one of so many labelled documents only calibrates
BROADCAST_IDS = 2_000_000
_TEXT, _SOURCES, _LANGS, _LENGTHS = 24, 32, 8, 12
_META = _SOURCES + _LANGS + _LENGTHS + 2
_UPPER, _LOWER, _DIGIT = (np.isin(np.arange(256), [*range(*r)]) for r in ((65, 91), (97, 123), (48, 58)))
_SPACE = np.isin(np.arange(256), [32, *range(9, 14)])
_MARK = (np.arange(256) > 32) & (np.arange(256) < 127) & ~_UPPER & ~_LOWER & ~_DIGIT
_CHUNK = 1 << 22


def text_features(text: str | None) -> np.ndarray:
    """Shares and rates of the whole text, most of them between 0 and 1; the first is 1."""
    out = np.zeros(_TEXT)
    out[0] = 1
    data = (text or "").encode("utf-8", "replace")
    words = data.split()
    if not words:
        return out
    counts = np.zeros(256, np.int64)
    for at in range(0, len(data), _CHUNK):
        counts += np.bincount(np.frombuffer(data, np.uint8, min(_CHUNK, len(data) - at), at), minlength=256)
    n, size = len(words), max(1, int(counts[~_SPACE].sum()))
    letters = max(1, int(counts[_UPPER | _LOWER].sum()))
    lengths = np.fromiter(map(len, words), np.int64, n)
    last = np.frombuffer(bytes(w[-1] for w in words), np.uint8)
    bare = sum(not w.isalnum() and not any(c > 127 or chr(c).isalnum() for c in w) for w in words if len(w) <= 3)
    seen = Counter(words)
    lines = data.split(b"\n")
    share = [
        counts[_UPPER].sum() / letters, counts[_DIGIT].sum() / size, counts[_MARK].sum() / size, counts[33] / size, counts[124] / n,
        counts[[35, 36, 37, 38, 42]].sum() / size, counts[[44, 46]].sum() / size, counts[128:].sum() / size,
        len(seen) / n, max(seen.values()) / n, sum(a == b for a, b in zip(words, words[1:])) / n, bare / n,
        _MARK[last].mean(), (last == 46).mean(), (last == 33).mean(), min(1.0, lengths.mean() / 20), min(1.0, lengths.std() / 20),
        min(1.0, lengths.max() / 100), min(1.0, np.log1p(n) / 12), min(1.0, len(lines) / n), 1 - len(set(lines)) / len(lines),
    ]
    out[1:1 + len(share)] = share
    out[22], out[23] = float(share[0] > 0.5), float(share[10] > 0.3)
    return out


def meta_features(source: str | None, lang: str | None, n_chars) -> np.ndarray:
    """One place for each hashed source and language and each doubling of the length."""
    out = np.zeros(_META)
    out[0] = 1
    size = max(0, int(n_chars)) if n_chars is not None else None
    out[1] = min(1.0, np.log1p(size) / 16) if size is not None else 0
    out[2 + (0 if source is None else 1 + zlib.crc32(str(source).encode()) % (_SOURCES - 1))] = 1
    out[2 + _SOURCES + (0 if lang is None else 1 + zlib.crc32(str(lang).encode()) % (_LANGS - 1))] = 1
    out[2 + _SOURCES + _LANGS + (0 if size is None else 1 + min(_LENGTHS - 2, size.bit_length() // 2))] = 1
    return out


def features(docs: DataFrame) -> DataFrame:
    """``(doc_id, text_view, meta_view)`` of each row."""
    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = [text_features(t.as_py()).astype(np.float32) for t in batch.column("text")]
            meta = [meta_features(*row).astype(np.float32) for row in zip(*[batch.column(c).to_pylist() for c in ("source", "lang", "n_chars")])]
            kind = pa.list_(pa.float32())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(text, kind), pa.array(meta, kind)], names=["doc_id", "text_view", "meta_view"])

    return docs.select("doc_id", "text", "source", "lang", "n_chars").mapInArrow(
        built, f"doc_id {dict(docs.dtypes)['doc_id']}, text_view array<float>, meta_view array<float>")


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


class Views:
    """The two views' coefficients, and those of their combination."""

    def __init__(self):
        self.text, self.meta, self.both = np.zeros(_TEXT), np.zeros(_META), np.array([0.0, 1.0, 0.0])

    def odds(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        x, y = _matrix(batch.column("text_view"), _TEXT), _matrix(batch.column("meta_view"), _META)
        return x, y, x @ self.text, y @ self.meta

    def combined(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.stack([np.ones(len(a)), a, b], axis=1)


def _newton_sums(rows: DataFrame, views: Views, kind: str) -> dict[int, float]:
    """Gradient and Hessian entries by number, added up over all rows. ``kind``: labelled, pseudo or both."""
    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}

        def add(name: str, x: np.ndarray, z: np.ndarray, y: np.ndarray, w: np.ndarray) -> None:
            p = _sigmoid(z)
            part = np.concatenate([x.T @ (w * (y - p)), ((x * (w * p * (1 - p))[:, None]).T @ x).ravel()])
            sums[name] = sums.get(name, 0) + part

        for batch in batches:
            label, held = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.float64) for c in ("label", "held"))
            x, y, a, b = views.odds(batch)
            known = ~np.isnan(label)
            if kind == "both":
                use = known & (held == 1)
                add("both", views.combined(a, b)[use], (views.combined(a, b) @ views.both)[use], label[use], np.ones(use.sum()))
                continue
            own = known & (held == 0)
            for name, mine, z, other in (("text", x, a, b), ("meta", y, b, a)):
                says = _sigmoid(other)
                sure = ~known & ((says >= CONFIDENT) | (says <= 1 - CONFIDENT)) & (kind == "pseudo")
                use = own | sure
                target, weight = np.where(own, label, says >= 0.5), np.where(own, 1.0, PSEUDO)
                add(name, mine[use], z[use], target[use], weight[use])
        for at, name in enumerate(("text", "meta", "both")):
            if name in sums:
                values = sums[name]
                numbers = np.arange(len(values), dtype=np.int64) + at * 1_000_000
                yield pa.RecordBatch.from_arrays([pa.array(numbers), pa.array(values)], names=["i", "v"])

    parts = rows.mapInArrow(summed, "i bigint, v double").groupBy("i").agg(F.sum("v").alias("v")).toArrow()
    return dict(zip(parts.column("i").to_pylist(), parts.column("v").to_pylist()))


def _step(theta: np.ndarray, sums: dict[int, float], first: int) -> np.ndarray:
    n = len(theta)
    values = np.array([sums.get(first + i, 0.0) for i in range(n + n * n)])
    gradient, hessian = values[:n] - RIDGE * theta, values[n:].reshape(n, n) + RIDGE * np.eye(n)
    move = np.linalg.solve(hessian, gradient)
    return theta + move * min(1.0, 10 / max(1e-9, np.abs(move).max()))


def fit(rows: DataFrame, rounds: int = ROUNDS) -> Views:
    """``rows(label, held, text_view, meta_view)``; label is null where there is none."""
    views = Views()
    for kind in ["labelled"] * STEPS + ["pseudo"] * (rounds * MORE) + ["both"] * STEPS:
        sums = _newton_sums(rows, views, kind)
        if kind == "both":
            views.both = _step(views.both, sums, 2_000_000)
        else:
            views.text, views.meta = _step(views.text, sums, 0), _step(views.meta, sums, 1_000_000)
    return views


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    known = (labels.filter("quality is not null and doc_id is not null").groupBy(F.col("doc_id").alias("doc_"))
             .agg((F.avg(F.col("quality").cast("double")) >= 0.5).cast("double").alias("label")))
    held = (F.pmod(F.xxhash64("doc_id"), F.lit(HELD)) == 0).cast("double").alias("held")
    return rows.join(known, F.col("doc_id") == F.col("doc_"), "left").select("doc_id", "label", held, "text_view", "meta_view")


def score(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """``(doc_id, p_text, p_meta, score, kept)`` of each row; score is the probability of good quality."""
    rows = staged(labelled(staged(features(docs), "features"), labels), "labelled")
    classes = rows.filter("label is not null").groupBy("label").count().collect()
    if len(classes) < 2:
        return rows.select("doc_id", *[F.lit(1.0).alias(c) for c in ("p_text", "p_meta", "score")], F.lit(True).alias("kept"))
    views = rows.sparkSession.sparkContext.broadcast(fit(rows))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = views.value
            _, _, a, b = own.odds(batch)
            p = _sigmoid(own.combined(a, b) @ own.both)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *map(pa.array, (_sigmoid(a), _sigmoid(b), p, p >= cut))], names=["doc_id", "p_text", "p_meta", "score", "kept"])

    kind = dict(docs.dtypes)["doc_id"]
    return rows.mapInArrow(scored, f"doc_id {kind}, p_text double, p_meta double, score double, kept boolean")


def keep_good(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """The documents that are not rejected. A null doc_id can't be told from another, so such rows stay; of rows that share a
    doc_id all go if all are rejected, else all stay."""
    bad = staged(score(docs, labels, cut).filter("doc_id is not null").groupBy("doc_id").agg(F.max("kept").alias("kept"))
                 .filter("not kept").select("doc_id"), "rejected")
    return docs.join(F.broadcast(bad) if bad.count() <= BROADCAST_IDS else bad, "doc_id", "left_anti").select(*docs.columns)
