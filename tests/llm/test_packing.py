import zlib

import numpy as np
import pytest
from helpers import docs, odd_rows
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from storyweave.llm import packing, queries

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(packing.vocabulary())


def check(rows, texts, tokenizer, size=1024):
    """Every id once, windows without gaps or overflow; gives the padded share."""
    pieces, windows = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for doc, text in texts.items():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        at = 0
        for p in sorted(pieces.pop(doc), key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids) and p.length > 0
            part = np.array(ids[at:at + p.length], "<u4").tobytes()
            assert p.ids_crc32 == zlib.crc32(part)
            at += p.length
        assert at == len(ids)
    assert not pieces
    padded = 0
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
        padded += size - at
    return padded / (size * len(windows))


def test_whole_table(spark, tokenizer):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert check(queries.QUERIES["op8_packing"](spark, SMALL).collect(), texts, tokenizer) < 0.05


def test_many_partitions_are_merged(spark, tokenizer):
    rows = [(i, "some words " * (i % 90 + 1)) for i in range(400)]
    df = docs(spark, rows).repartition(40)
    assert check(packing.packed_digests(df).collect(), dict(rows), tokenizer) < 0.15


def test_odd_rows(spark):
    rows = odd_rows()
    found = packing.packed_digests(docs(spark, rows)).collect()
    by_doc = {}
    for r in found:
        by_doc.setdefault(r.doc_id, []).append(r)
    assert sorted(p.doc_tokens for p in by_doc[None])[0] == 1 and by_doc[3][0].length == 1 and by_doc[4][0].doc_tokens == 1
    assert len(by_doc[2]) == 2 and len(by_doc[7]) > 100
    assert packing.packed_digests(docs(spark, [])).count() == 0


def test_ids_are_the_files(spark):
    vocabulary = packing.Vocabulary.load(packing.vocabulary())
    odd = ["", "a" * 5000, " " * 5000, "\n\n \t x", "naïve Ünïcode ½ ² 漢字 🙂‍", "<|endoftext|> end", "it's we'll THEY'VE", "\x00\x1c\x85  z"]
    for text in odd:
        assert vocabulary.ids(text) == vocabulary.plain.encode(text, add_special_tokens=False).ids


def test_ids_and_digests_agree(spark):
    rows = [(1, "some text here"), (2, "more " * 3000)]
    ids = {(r.doc_id, r.start): bytes(r.ids) for r in packing.pack(docs(spark, rows)).collect()}
    sums = {(r.doc_id, r.start): r.ids_crc32 for r in packing.packed_digests(docs(spark, rows)).collect()}
    assert {k: zlib.crc32(v) for k, v in ids.items()} == sums


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=80), st.integers(1, 5))
def test_windows_hold_everything_once(lengths, most):
    windows, seen = packing.Windows(0, 64, most), []
    done = []
    for i, n in enumerate(lengths):
        done += windows.place(n, (i, n))
        assert len(windows.open) <= most
    for _, used, parts in done + windows.rest():
        at = 0
        for offset, (i, n) in parts:
            assert offset == at
            at += n
            seen.append(i)
        assert at == used <= 64
    assert sorted(seen) == list(range(len(lengths)))


def test_added_tokens_have_their_own_id(spark, tokenizer):
    """Against a tokenizer fresh from the file, at its defaults."""
    rows = list(enumerate(["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>\n", "x<|endoftext|>y " * 700, "<|endoftext |> <|ENDOFTEXT|>", "none of them"]))
    vocabulary = packing.Vocabulary.load(packing.vocabulary())
    for _, text in rows:
        assert vocabulary.ids(text) == tokenizer.encode(text, add_special_tokens=False).ids
    assert vocabulary.ids("a <|endoftext|> b").count(50256) == 1 and len(vocabulary.ids("a <|endoftext|> b")) == 4
    check(packing.packed_digests(docs(spark, rows)).collect(), dict(rows), tokenizer)
