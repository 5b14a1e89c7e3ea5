"""Language identification: multinomial naive Bayes over hashed character n-grams.

Letters are lower-cased, runs of anything else become one space, and all 1-, 2- and 3-grams of the result are hashed into
``BUCKETS``. Counts by language are summed over every training document; the matrix of log-probabilities (languages x
BUCKETS x 4 bytes) is broadcast, and a document's score is the sum of its n-grams' columns plus the log prior, turned into a probability.

A null text and one without a letter are ``und`` with score 0, as is every document when there is nothing to learn from. Texts are
read whole, in pieces of PIECE characters. Training reads text and lang of rows with a non-null lang outside the held-out fold;
prediction reads text alone. A null doc_id belongs to no fold: such a row is neither learnt from nor held out. Rows that
repeat count each. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 14
FOLDS = 5
SMOOTHING = 0.5
PIECE = 1 << 20
UNKNOWN = "und"
_SHIFT = np.uint32(18)
_FACTORS = np.array([2654435761, 2246822519, 3266489917], np.uint32)  # fixed values: odd, with bits well spread
_LENGTHS = (1, 2, 3)


def _lower_letters() -> np.ndarray:
    """For each character of the first plane its lower-case letter, or a space."""
    out = np.full(0x10000, 32, np.uint32)
    for code in range(0x10000):
        char = chr(code)
        if char.isalpha():
            lower = char.lower()
            out[code] = ord(lower) if len(lower) == 1 else code
    return out


_TABLE: list[np.ndarray] = []


def letters(text: str) -> np.ndarray:
    """The text's lower-case letters with single spaces around and between words; empty if it has no letter."""
    if not _TABLE:
        _TABLE.append(_lower_letters())
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    low = np.minimum(codes, 0xFFFF)
    found = _TABLE[0][low]
    high = np.flatnonzero(codes > 0xFFFF)
    for i in high:
        found[i] = codes[i] if chr(codes[i]).isalpha() else 32
    space = found == 32
    keep = ~space | np.concatenate([[True], ~space[:-1]])
    found = found[keep]
    if not (found != 32).any():
        return np.zeros(0, np.uint32)
    ends = [np.zeros(0, np.uint32) if found[i] == 32 else np.array([32], np.uint32) for i in (0, -1)]
    return np.concatenate([ends[0], found, ends[1]])


def grams(text: str) -> Iterator[np.ndarray]:
    """The buckets of the text's n-grams, piece by piece."""
    for at in range(0, max(len(text), 1), PIECE):
        codes = letters(text[at:at + PIECE])
        if len(codes):
            for n in _LENGTHS:
                if len(codes) >= n:
                    mixed = np.full(len(codes) - n + 1, n * 0x9E3779B1 % (1 << 32), np.uint32)
                    for i in range(n):
                        mixed = (mixed ^ codes[i:len(codes) - n + 1 + i]) * _FACTORS[i]
                        mixed ^= mixed >> np.uint32(15)
                    yield (mixed * _FACTORS[0]) >> _SHIFT


def fold(doc_id: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(FOLDS))


class Model:
    """Log-probabilities by language and bucket."""

    def __init__(self, names: list[str], counts: np.ndarray, documents: np.ndarray):
        self.names = names
        smooth = counts + SMOOTHING
        self.table = np.ascontiguousarray(np.log(smooth / smooth.sum(axis=1, keepdims=True)).T.astype(np.float32))
        self.prior = np.log(documents / documents.sum())

    def predict(self, text: str | None) -> tuple[str, float]:
        total, some = self.prior.copy(), False
        for found in grams(text or ""):
            some = True
            # A bucket once, times its count: the document as a sparse row.
            counts = np.bincount(found, minlength=BUCKETS)
            used = np.flatnonzero(counts)
            total += counts[used].astype(np.float64) @ self.table[used]
        if not some:
            return UNKNOWN, 0.0
        likely = np.exp(total - total.max())
        best = int(likely.argmax())
        return self.names[best], float(likely[best] / likely.sum())


def train(rows: DataFrame) -> Model | None:
    """From every row of ``(text, lang)`` with a non-null lang. Tasks add up their counts before the shuffle."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        docs: dict[str, int] = {}
        for batch in batches:
            for text, lang in zip(batch.column("text"), batch.column("lang").to_pylist()):
                docs[lang] = docs.get(lang, 0) + 1
                if lang not in sums:
                    sums[lang] = np.zeros(BUCKETS, np.int64)
                for found in grams(text.as_py() or ""):
                    sums[lang] += np.bincount(found, minlength=BUCKETS)
        for lang, counts in sums.items():
            used = np.flatnonzero(counts)
            buckets = np.concatenate([[-1], used])
            values = np.concatenate([[docs[lang]], counts[used]])
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(buckets)), pa.array(buckets.astype(np.int32)), pa.array(values)], names=["lang", "bucket", "n"])

    known = rows.filter("lang is not null").select("text", "lang")
    sums = known.mapInArrow(counted, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    # A row per language and bucket at most.
    table = sums.toArrow()
    if not table.num_rows:
        return None
    langs = table.column("lang").to_pylist()
    names = sorted(set(langs))
    at = {name: i for i, name in enumerate(names)}
    where = np.array([at[x] for x in langs])
    bucket, n = table.column("bucket").to_numpy(), table.column("n").to_numpy()
    counts = np.zeros((len(names), BUCKETS + 1))
    counts[where, bucket + 1] = n
    return Model(names, counts[:, 1:], counts[:, 0])


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``(doc_id, lang_pred, score)`` of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = shared.value
            found = [own.predict(t.as_py()) if own else (UNKNOWN, 0.0) for t in batch.column("text")]
            names, scores = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(scored, f"doc_id {dict(docs.dtypes)['doc_id']}, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` of each row, learnt from the rows that are not held out."""
    model = train(docs.filter("doc_id is not null").filter(fold() != 0).select("text", "lang"))
    held_out = F.coalesce(fold() == 0, F.lit(False)).alias("held_out")
    return predict(docs, model).select("doc_id", held_out, "lang_pred", "score")
