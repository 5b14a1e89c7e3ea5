"""Bounded-space online packing of documents into token windows.

A document becomes its token ids and the end id. What fills whole windows is cut off and emitted; the rest of the document, at
most a window, goes to the open window of the partition that it fits best. A partition keeps ``OPEN`` windows; when none fits,
the fullest is emitted and a new one opened. Windows still open at a partition's end are merged by the same rule after
one shuffle, in which emitted windows take part only as rows that pass through.

Null text counts as empty and gives one piece, the end id. Rows that repeat a doc_id are packed each. An empty table gives an empty
table; only doc_id and text are read. Windows are numbered from partition numbers, so a partition that runs again after
an executor is lost gives the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 1024
OPEN = 64
END = 0
_NUMBERS = 1 << 40  # windows of one partition
_FIELDS = "start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint, used bigint, closed boolean"


class Vocabulary:
    """Ids of texts by a byte-level BPE vocabulary, given as ``tokenizers``' JSON file.

    tiktoken, given the same vocabulary, finds the same ids four times as fast; a text that it can't cut (its matcher gives
    up on very long runs) or that contains the string of an added token goes to ``tokenizers``, which is left at its defaults:
    such a string is that token's one id.
    """

    _loaded: dict[str, Vocabulary] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        import tiktoken
        from public_tokenizers import PATTERN

        self.plain = Tokenizer.from_file(path)
        # In the file a byte is a printable character: itself if printable, else one from 256 on.
        printable = sorted(map(ord, ByteLevel.alphabet()))
        own = [c for c in printable if c < 256]
        others = sorted(set(range(256)) - set(own))
        byte = {chr(c): c for c in own} | {chr(256 + i): c for i, c in enumerate(others)}
        self.added = tuple(t.content for t in self.plain.get_added_tokens_decoder().values())
        ranks = {bytes(byte[c] for c in word): i for word, i in self.plain.get_vocab().items() if word not in self.added}
        self.fast = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        """One for each Python worker."""
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def ids(self, text: str) -> list[int]:
        if not any(t in text for t in self.added):
            try:
                return self.fast.encode_ordinary(text)
            except (ValueError, RuntimeError):
                pass
        return self.plain.encode(text, add_special_tokens=False).ids


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Windows:
    """Open windows of one partition, best fit first."""

    def __init__(self, first: int, size: int, most: int):
        self.size, self.most, self.next = size, most, first
        self.open: dict[int, list] = {}  # number: [used, pieces]

    def number(self) -> int:
        self.next += 1
        return self.next - 1

    def place(self, length: int, what) -> list:
        """Puts ``what`` in a window; gives the windows that this closes, as (number, used, [(offset, what)])."""
        best = max((n for n, w in self.open.items() if w[0] + length <= self.size), key=lambda n: (self.open[n][0], -n), default=None)
        closed = []
        if best is None:
            if len(self.open) >= self.most:
                full = max(self.open, key=lambda n: (self.open[n][0], -n))
                closed.append((full, *self.open.pop(full)))
            best = self.number()
            self.open[best] = [0, []]
        window = self.open[best]
        window[1].append((window[0], what))
        window[0] += length
        if window[0] == self.size:
            closed.append((best, *self.open.pop(best)))
        return closed

    def rest(self) -> list:
        return [(n, *w) for n, w in sorted(self.open.items())]


def place(docs: DataFrame, path: str | None = None, size: int = WINDOW, most: int = OPEN, end: int = END) -> DataFrame:
    """Pieces ``(doc_id, start, length, ids, doc_tokens, sequence_id, offset, used, closed)`` of each partition's windows.

    ``ids`` holds the piece's ids, four bytes each, smallest byte first; ``used`` is the window's number of tokens.
    """
    path = path or vocabulary()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Vocabulary.load(path)
        windows = Windows(TaskContext.get().partitionId() * _NUMBERS, size, most)

        def emitted(rows: list) -> pa.RecordBatch:
            columns = list(zip(*rows)) if rows else [[]] * 9
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        def out(closed: list, done: bool) -> list:
            return [(doc, start, length, ids, total, number, offset, used, done)
                    for number, used, pieces in closed for offset, (doc, start, length, ids, total) in pieces]

        schema = None
        for batch in batches:
            schema = schema or _schema(batch.schema.field("doc_id").type)
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = np.array([*encoder.ids(text.as_py() or ""), end], "<u4")
                whole = len(ids) // size * size
                for at in range(0, whole, size):
                    rows.append((doc, at, size, ids[at:at + size].tobytes(), len(ids), windows.number(), 0, size, True))
                if whole < len(ids):
                    piece = (doc, whole, len(ids) - whole, ids[whole:].tobytes(), len(ids))
                    rows += out(windows.place(len(ids) - whole, piece), True)
                if len(rows) >= 2000:
                    yield emitted(rows)
                    rows = []
            if rows:
                yield emitted(rows)
        if schema and windows.open:
            yield emitted(out(windows.rest(), False))

    return docs.select("doc_id", "text").mapInArrow(packed, f"doc_id {dict(docs.dtypes)['doc_id']}, {_FIELDS}")


def _schema(doc: pa.DataType) -> pa.Schema:
    kinds = {"doc_id": doc, "start": pa.int64(), "length": pa.int64(), "ids": pa.binary(), "doc_tokens": pa.int64(),
             "sequence_id": pa.int64(), "offset": pa.int64(), "used": pa.int64(), "closed": pa.bool_()}
    return pa.schema(kinds.items())


def merge_leftovers(pieces: DataFrame, size: int = WINDOW, most: int = OPEN) -> DataFrame:
    """``place``'s pieces with the windows left open merged into fewer: their pieces get a window's id and new offsets.

    Pieces of a window left open come together by its id; each task packs such windows best-fit into fuller ones.
    """
    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list] = {}
        used: dict[int, int] = {}
        schema = None
        for batch in batches:
            schema = batch.schema
            closed = batch.column("closed")
            yield batch.filter(closed)
            for row in batch.filter(pc.invert(closed)).to_pylist():
                waiting.setdefault(row["sequence_id"], []).append(row)
                used[row["sequence_id"]] = row["used"]
        windows, done = Windows(0, size, most), []
        for number in sorted(used, key=lambda n: (-used[n], n)):
            done += windows.place(used[number], number)
        for _, total, members in done + windows.rest():
            name = members[0][1]  # the window keeps the id of the first that it took
            rows = [row | {"sequence_id": name, "offset": row["offset"] + shift, "used": total, "closed": True}
                    for shift, number in members for row in waiting.pop(number)]
            yield pa.RecordBatch.from_pylist(rows, schema)

    out = pieces.repartition("sequence_id").mapInArrow(merged, pieces.schema)
    return out.drop("used", "closed")


def pack(docs: DataFrame, path: str | None = None, size: int = WINDOW, most: int = OPEN, end: int = END) -> DataFrame:
    """``(doc_id, start, length, ids, doc_tokens, sequence_id, offset)``: each id of each document in exactly one piece."""
    return merge_leftovers(place(docs, path, size, most, end), size, most)


def packed_digests(docs: DataFrame, path: str | None = None, size: int = WINDOW, most: int = OPEN) -> DataFrame:
    """``pack`` with a checksum in place of each piece's ids, taken before the shuffle so that no ids go through it."""
    checked = place(docs, path, size, most).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return merge_leftovers(checked, size, most).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
