"""The reference's tables as views over the tables of a data folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_SLOT = 5 * 60 * 1_000_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def slot_time(number: Column) -> Column:
    """One article each five minutes from the start of 2024."""
    start = F.unix_micros(F.lit("2024-01-01 00:00:00").cast("timestamp"))
    return F.timestamp_micros(start + number * _SLOT)


def _source_id() -> Column:
    return F.substring("source", 4, 10).cast("int")


def source(spark: SparkSession, folder: str) -> DataFrame:
    return (table(spark, folder, "documents").select("source").distinct()
            .select(_source_id().alias("id"), F.col("source").alias("name")))


def article(spark: SparkSession, folder: str) -> DataFrame:
    url = F.concat(F.lit("https://"), F.col("source"), F.lit(".example.com/a/"), F.col("doc_id"))
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("article_id"), _source_id().alias("source_id"), url.alias("url"),
        F.substring("text", 1, 60).alias("title"), slot_time(F.col("doc_id")).alias("published_at"),
        slot_time(F.col("doc_id")).alias("added_at"))


def parsedcontent(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("article_id"), F.col("text").alias("content"),
        slot_time(F.col("doc_id")).alias("added_at"))


def rawcontent(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages").select(
        F.col("page_id").alias("article_id"), F.col("html").alias("content"),
        slot_time(F.col("page_id")).alias("added_at"))
