"""SimHash near-duplicates: exact comparison of all fingerprints, tile against tile, in numpy.

A text is lower-cased (A-Z), cut into words at ASCII white space, and hashed by four-word shingles, repeats included, with
XXH64. Bit i of the fingerprint is 1 if more than half of the hashes have it. Documents link at ``radius`` or fewer
differing bits; components of links are groups, named by their smallest doc_id.

Equal fingerprints are one node. Nodes are put into cells by the population counts of their four 16-bit quarters; two
fingerprints differ in at least as many bits as the counts of their quarters differ in sum, so only cells within the radius
are compared, by exclusive-or and bit counts over whole tiles. A tile pair leaves only a spanning forest of its links, so
groups of any size stay linear in what they write.

Null and empty texts, and those of white space only, have fingerprint zero and link like any other. Rows that repeat a doc_id
give a row each. A row with a null doc_id gets its fingerprint and its group's smallest doc_id (null if it has none). An
empty table gives an empty table; only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storyweave.llm.common import components, staged

SHINGLE = 4
SEED = 42
RADIUS = 4
TILE = 4096  # fingerprints in a tile, 32 KB
_QUARTERS = 4


def fingerprint_of(text: str | None) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    size = min(SHINGLE, len(words))
    joined, ends, at = b" ".join(words), [], -1
    for word in words:
        at += len(word) + 1
        ends.append(at)
    starts = [0, *[e + 1 for e in ends[:len(words) - size]]]
    hashed = xxhash.xxh64_intdigest
    hashes = np.fromiter((hashed(joined[a:b], SEED) for a, b in zip(starts, ends[size - 1:])), np.uint64, len(words) - size + 1)
    ones = np.zeros(64, np.int64)
    for part in range(0, len(hashes), 1 << 14):
        block = hashes[part:part + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, bits)`` of each row; bits is the fingerprint as a signed long."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint_of(t.as_py()) for t in batch.column("text")), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], names=["doc_id", "bits"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(hashed, f"doc_id {kind}, bits bigint")


def _quarter(i: int) -> str:
    return f"cast(bit_count(shiftrightunsigned(bits, {16 * i}) & 65535) as int)"


def _offsets(radius: int) -> list[tuple[int, ...]]:
    """Differences of two cells that may hold a link; of each difference and its opposite only one."""
    steps = [o for o in product(range(-radius, radius + 1), repeat=_QUARTERS) if sum(map(abs, o)) <= radius]
    return [o for o in steps if o >= (0,) * _QUARTERS]


def links(nodes: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Edges ``(a, b)`` that connect the different fingerprints ``nodes(bits)`` exactly as all their links do."""
    quarters = [f"q{i}" for i in range(_QUARTERS)]
    placed = nodes.selectExpr("bits", *[f"{_quarter(i)} as {q}" for i, q in enumerate(quarters)])
    # The fingerprint's hash deals a full cell out evenly over its tiles.
    sizes = placed.groupBy(*quarters).agg(F.count("*").alias("n")).withColumn("tiles", F.ceil(F.col("n") / tile).cast("int"))
    tiled = (placed.join(sizes.drop("n"), quarters).withColumn("t", F.pmod(F.xxhash64("bits"), F.col("tiles")).cast("int"))
             .groupBy(*quarters, "t").agg(F.collect_list("bits").alias("bits")))
    tiles = staged(tiled.withColumn("tile", F.concat_ws("-", *quarters, "t")), "tiles")
    here = tiles.select(*quarters, F.col("tile").alias("left"))
    moves = F.array(*[F.struct(*[F.lit(x).alias(f"d{i}") for i, x in enumerate(o)]) for o in _offsets(radius)])
    moved = (here.select("*", F.explode(moves).alias("d"))
             .select("left", *[(F.col(q) + F.col(f"d.d{i}")).alias(q) for i, q in enumerate(quarters)]))
    # Within a cell each pair of tiles once.
    pairs = (moved.join(tiles.select(*quarters, F.col("tile").alias("right")), quarters)
             .join(here.select(F.col("left").alias("own"), *[F.col(q).alias(f"own_{q}") for q in quarters]), F.col("left") == F.col("own"))
             .withColumn("same", F.expr(" and ".join(f"{q} = own_{q}" for q in quarters)))
             .filter("not same or left <= right").select("left", "right"))
    both = (pairs.join(tiles.select(F.col("tile").alias("left"), F.col("bits").alias("a")), "left")
            .join(tiles.select(F.col("tile").alias("right"), F.col("bits").alias("b")), "right").select("a", "b"))

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in zip(batch.column("a"), batch.column("b")):
                left, right = (x.values.to_numpy().view(np.uint64) for x in (a, b))
                found = forest(left, right, radius)
                if len(found):
                    yield pa.RecordBatch.from_arrays([pa.array(found[:, i].copy().view(np.int64)) for i in (0, 1)], names=["a", "b"])

    return both.mapInArrow(compared, "a bigint, b bigint")


def forest(left: np.ndarray, right: np.ndarray, radius: int, rows: int = 256) -> np.ndarray:
    """A spanning forest of the links between two tiles, as pairs of fingerprints."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    kept = []
    for at in range(0, len(left), rows):
        part = left[at:at + rows]
        near = np.bitwise_count(part[:, None] ^ right[None, :]) <= radius
        for i in np.flatnonzero(near.any(axis=1)):
            x = int(part[i])
            linked = right[near[i]]
            for y in map(int, linked):
                if x != y and (r := root(x)) != (s := root(y)):
                    parent[s] = r
                    kept.append((x, y))
    return np.array(kept, np.uint64).reshape(-1, 2)


def _grouped(docs: DataFrame, radius: int, tile: int) -> DataFrame:
    """``(doc_id, bits, node, least)`` of each row: the fingerprint, a number of its group, the group's smallest doc_id."""
    rows = staged(fingerprints(docs), "fingerprints")
    nodes = rows.groupBy("bits").agg(F.min("doc_id").alias("least"))
    # Hashes in place of the fingerprints: numbered at random, a chain of near ones takes few rounds; different longs have different hashes.
    edges = links(nodes.select("bits"), radius, tile).select(F.xxhash64("a").alias("a"), F.xxhash64("b").alias("b"))
    named = (nodes.withColumn("own", F.xxhash64("bits")).join(components(edges).withColumnRenamed("node", "own"), "own", "left")
             .select("bits", "least", F.coalesce("component", "own").alias("node")))
    labels = named.groupBy("node").agg(F.min("least").alias("least"))
    # One row per fingerprint on the other side, so a frequent fingerprint's rows can be split.
    return rows.join(named.drop("least").join(labels, "node"), "bits")


def groups(docs: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """``(doc_id, bits, component_id)`` of each row."""
    return _grouped(docs, radius, tile).select("doc_id", "bits", F.col("least").alias("component_id"))


def keep_one(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One row of each group, with its columns: of those of the group's smallest doc_id the one of the smallest text.

    Rows that repeat a doc_id with texts of different groups stay for each group. Rows with a null doc_id stay, all of them.
    """
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    known = whole.select("row", F.col("row.doc_id").alias("doc"), F.xxhash64("row.text").alias("text_hash"))
    # A document is named by its number and its text's hash here: the fingerprint passes any kind of doc_id through.
    keyed = docs.filter("doc_id is not null").select(F.struct("doc_id", F.xxhash64("text").alias("text_hash")).alias("doc_id"), "text")
    first = (_grouped(keyed, radius, TILE).filter("doc_id = least").select("doc_id").distinct()
             .select(F.col("doc_id.doc_id").alias("doc"), F.col("doc_id.text_hash").alias("text_hash")))
    found = known.filter("doc is not null").join(first, ["doc", "text_hash"], "left_semi").dropDuplicates(["doc", "text_hash"])
    return found.select("row.*").unionByName(docs.filter("doc_id is null"))
