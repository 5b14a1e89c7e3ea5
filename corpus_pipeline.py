"""From raw documents to packed training sequences: each stage is one operator, its result the next one's documents."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from storyweave.llm import line_dedup, mixing, packing, quality, simhash
from storyweave.llm.common import table
from storyweave.session import apply_settings, shared_folder


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    apply_settings(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without lines that an earlier line says already."""
    apply_settings(spark)
    return line_dedup.drop_duplicate_lines(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    apply_settings(spark)
    return simhash.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's budget takes them."""
    apply_settings(spark)
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in token windows."""
    apply_settings(spark)
    return packing.packed_digests(docs)


STAGES = [("quality", good_documents), ("line_dedup", without_repeated_lines), ("simhash", one_of_each_group), ("mixing", mixed), ("packing", packed)]

#: SQL can't express the classifier, the MinHash links or the tokenizer; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = f"{shared_folder(spark).rstrip('/')}/pipeline/{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
