"""What several operators share: reading tables, steps written to the shared folder, components of a graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storyweave.session import checkpointed, staged

__all__ = ["checkpointed", "components", "once", "staged", "table"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def once(df: DataFrame, *columns: str | Column) -> DataFrame:
    """``select`` that computes each column once a row, however often what follows names it: through an array of one."""
    return df.select(F.inline(F.array(F.struct(*columns))))


def has_rows(df: DataFrame) -> bool:
    return not df.isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` of every node with an edge in ``edges(a, b)``; the component is its smallest node.

    Distributed union-find: each round hooks every node to its smallest neighbour, follows one hook further and contracts the edges.
    Hooks go to smaller nodes only, so there are no cycles, and a component's smallest node is never hooked. Nodes should be
    numbered at random with regard to their links, as hashes are: a round then leaves a fixed share of them at most.
    """
    live = checkpointed(_contracted(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))))
    hops: list[DataFrame] = []
    while has_rows(live):
        ends = F.array(F.struct(F.col("u").alias("node"), F.col("v").alias("other")),
                       F.struct(F.col("v").alias("node"), F.col("u").alias("other")))
        up = checkpointed(live.select(F.inline(ends)).groupBy("node").agg(F.min("other").alias("other"))
                          .select("node", F.least("node", "other").alias("root")))
        after = up.select(F.col("node").alias("root"), F.col("root").alias("next"))
        up = checkpointed(up.join(after, "root").select("node", F.col("next").alias("root")))
        hops.append(up)
        end = {side: up.select(F.col("node").alias(side), F.col("root").alias(f"{side}_up")) for side in "uv"}
        live = checkpointed(_contracted(live.join(end["u"], "u").join(end["v"], "v")
                                        .select(F.col("u_up").alias("u"), F.col("v_up").alias("v"))))
    if not hops:
        return edges.select(F.col("a").alias("node"), F.col("a").alias("component")).limit(0)
    found = hops[-1]
    for up in reversed(hops[:-1]):
        later = found.select(F.col("node").alias("root"), F.col("root").alias("last"))
        found = up.join(later, "root", "left").select("node", F.coalesce("last", "root").alias("root"))
    return checkpointed(found.select("node", F.col("root").alias("component")))


def _contracted(pairs: DataFrame) -> DataFrame:
    return pairs.filter("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def finite(vector: str) -> Column:
    """True where the array of numbers is neither null nor holds a null or non-finite component."""
    ok = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    return F.coalesce(F.col(vector).isNotNull() & F.forall(vector, ok), F.lit(False))
