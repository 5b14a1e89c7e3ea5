"""Positions within groups, without gathering any group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storyweave.session import staged


def ranked(df: DataFrame, group: list[str], order: list[Column], name: str = "position") -> DataFrame:
    """``df`` with the place of each row in its group by ``order``, from 1.

    Rows are range-partitioned and sorted by group and order, so a large group lies on several partitions; a row's
    place is its place on the partition plus the group's rows on earlier ones.
    """
    keys = [*map(F.col, group), *order]
    placed = staged(df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumns(
        {"_part": F.spark_partition_id(), "_row": F.monotonically_increasing_id()}), "ranked")
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    spans = (placed.groupBy(*group, "_part").agg(F.min("_row").alias("_first"), F.count("*").alias("_rows"))
             .withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0))).drop("_rows"))
    place = (F.col("_before") + F.col("_row") - F.col("_first") + 1).cast("int")
    return placed.join(spans, [*group, "_part"]).withColumn(name, place).drop("_part", "_row", "_first", "_before")
