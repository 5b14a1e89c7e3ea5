"""Exact top-k by integer inner product: a ball tree per shard, branch and bound, k-th scores shared between shards.

Components become floor(64 * x). Rows are dealt into shards by a hash; a shard's task builds a ball tree over its rows. A
query first searches the shard it lies in; its k-th score there goes along to all other shards, where a node is left out for
the queries whose k-th score exceeds the node's bound q.c + |q| r. Queries come in blocks, so a task holds one shard and one block.

Rows with a null vec_id, a null vector or a null or non-finite component take no part; rows that repeat a vec_id count once, with the
smallest vector. Vectors are compared with vectors of the same length. Ties go to the smaller vec_id. An empty table gives an
empty table; only vec_id and embedding are read. Components of 2^20 and more in size are computed with exact Python
integers; scores beyond 64 bits become the largest or smallest long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storyweave.llm.common import finite, staged

K = 20
SCALE = 64
EVERY = 20
SHARD = 8192
BLOCK = 2048
LEAF = 256
_LONG = (1 << 63) - 1
_FOUND = "query_id bigint, vec_id bigint, score bigint"


class BallTree:
    """Nodes are slices of the rows in tree order; a node's children are the two halves of its slice."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, leaf: int = LEAF):
        self.points, self.ids, self.leaf = points, ids, leaf
        order = np.arange(len(points))
        self.nodes: list[tuple[int, int, np.ndarray, float]] = []
        self.children: dict[int, tuple[int, int]] = {}
        self._split(order, 0, len(points))
        self.points, self.ids = points[order], ids[order]

    def _split(self, order: np.ndarray, low: int, high: int) -> int:
        part = self.points[order[low:high]].astype(np.float64)
        centre = part.mean(axis=0)
        radius = float(np.sqrt(((part - centre) ** 2).sum(axis=1).max()))
        me = len(self.nodes)
        self.nodes.append((low, high, centre, radius))
        if high - low > self.leaf and radius > 0:
            far = part[np.argmax(((part - centre) ** 2).sum(axis=1))]
            away = part[np.argmax(((part - far) ** 2).sum(axis=1))]
            order[low:high] = order[low:high][np.argsort(part @ (far - away), kind="stable")]
            middle = (low + high) // 2
            self.children[me] = (self._split(order, low, middle), self._split(order, middle, high))
        return me


class Best:
    """The best k (score, id) of each query of a block so far."""

    def __init__(self, n: int, k: int, bound: np.ndarray):
        self.k, self.bound = k, bound.copy()
        self.found: list[list[tuple]] = [[] for _ in range(n)]

    def add(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        own = self.found[query]
        own.extend((-int(s), int(i)) for s, i in zip(scores, ids))
        own.sort()
        del own[self.k:]
        if len(own) == self.k:
            self.bound[query] = max(self.bound[query], -own[-1][0])


def search(tree: BallTree, queries: np.ndarray, own: np.ndarray, bound: np.ndarray, k: int) -> list[list[tuple]]:
    """For each query the rows that may be among its best k, as sorted (-score, id); ``bound`` is its k-th score so far."""
    best = Best(len(queries), k, bound)
    plain = queries.astype(np.float64)
    norms = np.sqrt((plain ** 2).sum(axis=1))
    centres = np.array([n[2] for n in tree.nodes])
    radii = np.array([n[3] for n in tree.nodes])
    # Rounding of the bound is far below 1e-6 of its parts; scores are whole numbers.
    bounds = plain @ centres.T + norms[:, None] * radii
    bounds += 1e-6 * (1 + np.abs(bounds))
    stack = [(0, np.arange(len(queries)))]
    while stack:
        node, active = stack.pop()
        active = active[bounds[active, node] >= best.bound[active]]
        if not len(active):
            continue
        if node in tree.children:
            left, right = tree.children[node]
            first = bounds[active, left].sum() >= bounds[active, right].sum()
            stack += [(right, active), (left, active)] if first else [(left, active), (right, active)]
            continue
        low, high, _, _ = tree.nodes[node]
        points, ids = tree.points[low:high], tree.ids[low:high]
        scores = queries[active] @ points.T
        for row, query in zip(scores, active):
            fits = np.flatnonzero((row >= best.bound[query]) & (ids != own[query]))
            if len(fits) > k:
                fits = fits[np.lexsort((ids[fits], -row[fits]))[:k]]
            if len(fits):
                best.add(query, row[fits], ids[fits])
    return best.found


def _matrix(vectors, size: int) -> np.ndarray:
    """Exact in doubles while all sums of products stay below 2^53; else Python integers."""
    flat = vectors.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    small = not len(flat) or (np.abs(flat).max() < 1 << 20 and size < 1 << 12)
    matrix = flat.reshape(-1, size) if size else np.zeros((len(vectors), 0), np.int64)
    return matrix.astype(np.float64) if small else matrix.astype(object)


def _rows(found: list[list[tuple]], queries: np.ndarray) -> pa.Table:
    flat = [(int(q), i, min(max(-s, -_LONG - 1), _LONG)) for q, own in zip(queries, found) for s, i in own]
    columns = list(zip(*flat)) if flat else [[], [], []]
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("query_id", "vec_id", "score"), columns)})


def _same(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (a, b) if a.dtype == b.dtype else (a.astype(object), b.astype(object))


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` for every vec_id divisible by ``every`` against all other rows."""
    scaled = F.transform("embedding", lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")))
    usable = vectors.select("vec_id", "embedding").filter("vec_id is not null").filter(finite("embedding"))
    rows = staged(usable.select("vec_id", scaled.alias("v")).groupBy("vec_id").agg(F.min("v").alias("v"))
                  .withColumn("dim", F.size("v")), "vectors")
    n, asked = rows.agg(F.count("*"), F.count(F.when(F.col("vec_id") % every == 0, 1))).first()
    shards, blocks = max(1, -(-n // shard)), max(1, -(-asked // block))
    # An independent hash for the block, or shards would hold few of the blocks.
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))

    def home(key: tuple, table: pa.Table) -> pa.Table:
        ids = table.column("vec_id").to_numpy()
        points = _matrix(table.column("v"), key[0].as_py())
        asks = np.flatnonzero(ids % every == 0)
        tree, found = BallTree(points, ids), []
        for at in range(0, len(asks), block):
            part = asks[at:at + block]
            found += search(tree, points[part], ids[part], np.full(len(part), -np.inf), k)
        return _rows(found, ids[asks])

    near = staged(rows.groupBy("dim", "shard").applyInArrow(home, _FOUND), "near")
    # The k-th score at home, where there are k.
    kth = near.groupBy("query_id").agg(F.min("score").alias("least"), F.count("*").alias("n")).select(
        F.col("query_id").alias("vec_id"), F.when(F.col("n") >= k, F.col("least").cast("double")).otherwise(F.lit(float("-inf"))).alias("bound"))
    asking = rows.filter(F.col("vec_id") % every == 0).join(kth, "vec_id", "left").fillna({"bound": float("-inf")})
    sent = (asking.withColumn("block", F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.lit(blocks)).cast("int"))
            .withColumn("to", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).filter("to <> shard")
            .select(F.col("dim").alias("q_dim"), F.col("to").alias("q_shard"), F.col("block").alias("q_block"),
                    F.col("vec_id").alias("asked"), F.col("v").alias("asked_v"), "bound"))
    copied = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select("dim", "shard", "block", "vec_id", "v")

    def away(key: tuple, points: pa.Table, queries: pa.Table) -> pa.Table:
        asked_ids = queries.column("asked").to_numpy() if queries.num_rows else np.zeros(0, np.int64)
        if not len(asked_ids) or not points.num_rows:
            return _rows([], asked_ids)
        size = key[0].as_py()
        left, right = _same(_matrix(queries.column("asked_v"), size), _matrix(points.column("v"), size))
        tree = BallTree(right, points.column("vec_id").to_numpy())
        found = search(tree, left, asked_ids, queries.column("bound").to_numpy(), k)
        return _rows(found, asked_ids)

    keys = ["dim", "shard", "block"]
    far = copied.groupBy(*keys).cogroup(sent.groupBy(*[f"q_{k}" for k in keys])).applyInArrow(away, _FOUND)
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id")))
    return near.union(far).withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
