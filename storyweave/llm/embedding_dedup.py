"""Embedding near-duplicates: product quantisation in inverted lists, table-lookup distances, exact cosine rerank.

Vectors are scaled to length 1. Coarse centroids cut them into inverted lists; what is left after subtracting the centroid is
coded by subspace. Each vector probes the lists of its ``PROBES`` nearest centroids. In a list, the distance of a query to a
coded vector is a sum of table entries; with the coded vector's own error, kept beside its code, that gives a lower bound of
the true distance, so no vector within reach is passed over. What the bound leaves is compared by cosine in double
precision. A pair can only be missed if neither vector probes the other's list; tests hold recall against brute force.

Centroids and codebooks are fitted on the ``SAMPLE`` vectors with the smallest hashes, gathered on the driver; every vector is
indexed. Equal vectors are one node that counts its copies. Lists are cut into blocks of ``BLOCK``, so a list that
holds a third of all vectors is many tasks; a task writes a count per node and a spanning forest of its links, not its pairs.

Vectors that are null, zero, or hold a null or non-finite component link with nothing. Vectors of different lengths do not link; each
length there is has an index of its own. Rows with a null vec_id link with nothing and name no group. Rows that repeat a vec_id are
vectors of their own. An empty table gives an empty table; only vec_id and embedding are read, never labels.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storyweave.llm.common import components, finite, staged

THRESHOLD = 0.9
SAMPLE = 8192
LIST = 1024  # vectors to a list on average,
LISTS = 4096  # up to so many lists
PROBES = 8
PARTS = 8  # subspaces
CODES = 64  # centroids of a subspace
BLOCK = 4096
_SEED = 5


def k_means(points: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    random = np.random.default_rng(_SEED)
    centres = points[random.choice(len(points), min(k, len(points)), replace=False)]
    for _ in range(rounds):
        near = nearest(points, centres)[:, 0]
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        counts = np.bincount(near, minlength=len(centres))
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


def nearest(points: np.ndarray, centres: np.ndarray, n: int = 1) -> np.ndarray:
    """The n nearest centres of each point, nearest first."""
    out = np.empty((len(points), min(n, len(centres))), np.int64)
    for at in range(0, len(points), 4096):
        far = (centres ** 2).sum(axis=1) - 2 * points[at:at + 4096] @ centres.T
        out[at:at + 4096] = np.argsort(far, axis=1, kind="stable")[:, :n] if n > 1 else np.argmin(far, axis=1)[:, None]
    return out


class Index:
    """Coarse centroids and a codebook per subspace; its size is bounded by LISTS, CODES and the vectors' length."""

    def __init__(self, sample: np.ndarray, lists: int, parts: int = PARTS, codes: int = CODES):
        self.centres = k_means(sample, lists)
        left = sample - self.centres[nearest(sample, self.centres)[:, 0]]
        self.cuts = np.linspace(0, sample.shape[1], min(parts, sample.shape[1]) + 1).astype(int)
        self.books = [k_means(left[:, a:b], codes) for a, b in zip(self.cuts, self.cuts[1:])]

    def encode(self, points: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The codes of each point and the distance between the point and what its codes stand for."""
        left = points - self.centres[home]
        codes = np.stack([nearest(left[:, a:b], book)[:, 0] for a, b, book in zip(self.cuts, self.cuts[1:], self.books)], axis=1)
        back = np.concatenate([book[codes[:, i]] for i, book in enumerate(self.books)], axis=1)
        return codes.astype(np.uint8), np.sqrt(((left - back) ** 2).sum(axis=1))

    def distances(self, queries: np.ndarray, cell: int, codes: np.ndarray) -> np.ndarray:
        """Distances of queries to the coded vectors of a list, by tables of query part to code."""
        left, out = queries - self.centres[cell], np.zeros((len(queries), len(codes)))
        for i, (a, b) in enumerate(zip(self.cuts, self.cuts[1:])):
            book = self.books[i]
            table = ((left[:, a:b] ** 2).sum(axis=1)[:, None] - 2 * left[:, a:b] @ book.T + (book ** 2).sum(axis=1))
            out += table[:, codes[:, i]]
        return np.sqrt(np.maximum(out, 0))


def _vectors(column: pa.ChunkedArray, size: int) -> np.ndarray:
    flat = column.combine_chunks()
    flat = flat.flatten() if isinstance(flat, pa.ListArray) else pa.concat_arrays([c.flatten() for c in column.chunks])
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def _unit(points: np.ndarray) -> np.ndarray:
    """Scaled by the largest component first, so that squares neither overflow nor vanish."""
    points = points / np.abs(points).max(axis=1, keepdims=True)
    return points / np.sqrt((points ** 2).sum(axis=1, keepdims=True))


def linked_pairs(index: Index, cell: int, queries: np.ndarray, rows: np.ndarray, codes: np.ndarray, error: np.ndarray,
                 allowed, threshold: float, step: int = 256):
    """Blocks ``(query numbers, row numbers)`` of the pairs that ``allowed`` admits and the cosine confirms."""
    reach = np.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-7
    for at in range(0, len(queries), step):
        part = queries[at:at + step]
        near = index.distances(part, cell, codes) - error[None, :] <= reach
        near &= allowed(slice(at, at + step))
        if near.mean() > 0.02:
            q, r = np.nonzero(near & (part @ rows.T >= threshold))
        else:
            q, r = np.nonzero(near)
            good = np.einsum("ij,ij->i", part[q], rows[r]) >= threshold
            q, r = q[good], r[good]
        if len(q):
            yield q + at, r


def links(nodes: DataFrame, size: int, total: int, threshold: float = THRESHOLD, probes: int = PROBES,
          per_list: int = LIST, sample: int = SAMPLE, block: int = BLOCK) -> DataFrame:
    """``(node, other, links)`` of ``nodes(node, copies, v)``: rows with a number of linked vectors, and rows with a linked node."""
    spark = nodes.sparkSession
    drawn = nodes.orderBy(F.xxhash64("node"), "node").limit(sample).select("v").toArrow()
    index = Index(_unit(_vectors(drawn.column("v"), size)), min(LISTS, max(1, -(-total // per_list))))
    shared = spark.sparkContext.broadcast(index)

    def indexed(batches):
        for batch in batches:
            points = _unit(_vectors(pa.chunked_array([batch.column("v")]), size))
            probed = nearest(points, shared.value.centres, probes)
            codes, error = shared.value.encode(points, probed[:, 0])
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("copies"), batch.column("v"), pa.array(probed[:, 0].astype(np.int32)),
                 pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error), pa.array(probed.astype(np.int32).tolist(), pa.list_(pa.int32()))],
                names=["node", "copies", "v", "home", "codes", "error", "probes"])

    coded = staged(nodes.select("node", "copies", "v").mapInArrow(
        indexed, "node bigint, copies bigint, v array<double>, home int, codes binary, error double, probes array<int>"), "coded")
    visits = coded.select("node", "copies", "v", "home", "probes", F.explode("probes").alias("cell"))
    blocks = (visits.groupBy("cell").agg(F.count("*").alias("q"), F.count(F.when(F.col("home") == F.col("cell"), 1)).alias("r"))
              .select("cell", *[F.greatest(F.lit(1), F.ceil(F.col(c) / block)).cast("int").alias(f"{c}_blocks") for c in "qr"]))
    blocks = F.broadcast(blocks)  # a row per list, LISTS at most

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        spread = df.join(blocks, "cell").withColumn(own, F.pmod(F.xxhash64("node"), F.col(f"{own}_blocks")).cast("int"))
        return spread.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1))).drop("q_blocks", "r_blocks")

    rows = dealt(coded.withColumn("cell", F.col("home")), "r", "q").drop("home")
    queries = dealt(visits, "q", "r").select(
        *[F.col(c).alias(f"ask_{c}") for c in ("cell", "r", "q", "node", "copies", "v", "home")])

    def compared(key: tuple, found: pa.Table, asked: pa.Table) -> pa.Table:
        if not found.num_rows or not asked.num_rows:
            return _answer([], [], [])
        cell = key[0].as_py()
        row_ids, ask_ids = found.column("node").to_numpy(), asked.column("ask_node").to_numpy()
        home = asked.column("ask_home").to_numpy()
        row_probes = _padded(found.column("probes"))
        # A pair that meets in both lists counts in the one with the larger number; in one list, from the smaller node.
        back = {int(h): (row_probes == h).any(axis=1) & (int(h) > cell) for h in np.unique(home)}

        def allowed(part: slice) -> np.ndarray:
            meets = ~np.stack([back[int(h)] for h in home[part]])
            here = home[part] == cell
            return np.where(here[:, None], ask_ids[part][:, None] < row_ids[None, :], meets)

        codes = np.frombuffer(b"".join(found.column("codes").to_pylist()), np.uint8).reshape(found.num_rows, -1)
        row_copies, ask_copies = found.column("copies").to_numpy(), asked.column("ask_copies").to_numpy()
        of_rows, of_asks = np.zeros(len(row_ids), np.int64), np.zeros(len(ask_ids), np.int64)
        forest = _Forest()
        for q, r in linked_pairs(shared.value, cell, _unit(_vectors(asked.column("ask_v"), size)), _unit(_vectors(found.column("v"), size)),
                                 codes, found.column("error").to_numpy(), allowed, threshold):
            np.add.at(of_asks, q, row_copies[r])
            np.add.at(of_rows, r, ask_copies[q])
            forest.add(ask_ids[q], row_ids[r])
        nodes_, counts = np.concatenate([ask_ids, row_ids]), np.concatenate([of_asks, of_rows])
        some = counts > 0
        return _answer(nodes_[some], counts[some], forest.kept)

    keys = ["cell", "r", "q"]
    return rows.groupBy(*keys).cogroup(queries.groupBy(*[f"ask_{k}" for k in keys])).applyInArrow(compared, "node bigint, other bigint, links bigint")


def _padded(probes: pa.ChunkedArray) -> np.ndarray:
    return np.array(probes.to_pylist(), np.int64)


class _Forest:
    """Keeps the links that connect what earlier ones did not."""

    def __init__(self):
        self.parent: dict[int, int] = {}
        self.kept: list[tuple[int, int]] = []

    def _root(self, x: int) -> int:
        while self.parent.setdefault(x, x) != x:
            self.parent[x] = x = self.parent[self.parent[x]]
        return x

    def add(self, left: np.ndarray, right: np.ndarray) -> None:
        for a, b in zip(left.tolist(), right.tolist()):
            x, y = self._root(a), self._root(b)
            if x != y:
                self.parent[y] = x
                self.kept.append((a, b))


def _answer(nodes, counts, edges) -> pa.Table:
    a, b = zip(*edges) if len(edges) else ([], [])
    return pa.table({
        "node": pa.array([*nodes, *a], pa.int64()), "other": pa.array([*[None] * len(nodes), *b], pa.int64()),
        "links": pa.array([*counts, *[None] * len(a)], pa.int64())})


def groups(vectors: DataFrame, threshold: float = THRESHOLD, probes: int = PROBES, per_list: int = LIST,
           sample: int = SAMPLE, block: int = BLOCK) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` of each row."""
    rows = vectors.select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    usable = F.col("vec_id").isNotNull() & finite("v") & F.coalesce(F.exists("v", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("v", F.when(usable, F.col("v")))
    # Minus zero is zero, so that equal vectors are equal keys.
    copies = (rows.filter("v is not null").withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))
              .groupBy("v").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies")))
    # Numbered once and written, so that a node keeps its number.
    nodes = staged(copies.withColumn("node", F.monotonically_increasing_id()).withColumn("dim", F.size("v")), "nodes")
    lengths = nodes.groupBy("dim").agg(F.count("*").alias("nodes")).orderBy("dim").collect()
    if not lengths:
        return rows.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").cast("bigint").alias("component_id"),
                           F.col("vec_id").isNotNull().alias("kept"))
    parts = [staged(links(nodes.filter(F.col("dim") == dim), dim, n, threshold, probes, per_list, sample, block), "links") for dim, n in lengths]
    found = reduce(DataFrame.union, parts)
    counted = found.filter("links is not null").groupBy("node").agg(F.sum("links").alias("far"))
    # Hashes of the numbers, each its own: numbered at random, a chain of near vectors takes few rounds.
    grouped = components(found.filter("other is not null").select(F.xxhash64("node").alias("a"), F.xxhash64("other").alias("b")))
    linked = (nodes.withColumn("own", F.xxhash64("node")).join(counted, "node", "left")
              .join(grouped.withColumnRenamed("node", "own"), "own", "left")
              .withColumn("n_links", (F.col("copies") - 1 + F.coalesce("far", F.lit(0))).cast("bigint"))
              .withColumn("component", F.coalesce("component", "own")))
    names = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    of_vector = linked.join(names, "component").select(F.col("v").alias("of"), "n_links", "component_id")
    out = rows.withColumn("key", F.transform("v", lambda x: x + F.lit(0.0))).join(of_vector, F.col("key") == F.col("of"), "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.cast("bigint").alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
