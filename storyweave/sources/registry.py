"""Registry files and the choice of sources and feeds."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storyweave.schemas import REGISTRY, SELECTORS


def load_registry(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A JSON array file as ``source``, ``rssfeed``, ``bias`` or ``accuracy``; keys not in the table are ignored."""
    rows = spark.read.schema(REGISTRY[table]).option("multiLine", True).json(path)
    if table != "rssfeed":
        return rows
    return rows.select(F.sha2("url", 256).alias("id"), "source_id", "url",
                       selectors(F.col("parser_config")).alias("parser_config"), F.lit(True).alias("is_okay"))


def selectors(config: Column) -> Column:
    """One object or a list of them, as JSON text, to an ordered list of selectors."""
    text = F.trim(config)
    listed = F.when(text.startswith("{"), F.concat(F.lit("["), text, F.lit("]"))).otherwise(text)
    return F.from_json(listed, SELECTORS)


def normalise_selector_config(feeds: DataFrame) -> DataFrame:
    return feeds.withColumn("parser_config", selectors(F.col("parser_config")))


def select_sources(sources: DataFrame, names: Iterable[str] = ("all",)) -> DataFrame:
    names = list(names)
    return sources if "all" in names else sources.filter(F.col("name").isin(names))


def select_feeds(feeds: DataFrame, sources: DataFrame, names: Iterable[str] = ("all",)) -> DataFrame:
    """Feeds in order, of the named sources."""
    okay = feeds.filter("is_okay")
    names = list(names)
    if "all" in names:
        return okay
    chosen = select_sources(sources, names).select(F.col("id").alias("source_id"))
    return okay.join(chosen, "source_id", "left_semi")
