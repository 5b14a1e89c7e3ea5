"""An inverted index over text columns and searches for all of several words."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storyweave.functions.text import Tokenizer, tokenise

PARTS = 64


@dataclass(frozen=True)
class Index:
    """``postings(term, doc_id)`` and ``terms(term, df)``, stored below ``folder`` in folders by a hash prefix of the term."""

    spark: SparkSession
    folder: str
    parts: int = PARTS

    def part(self) -> Column:
        return F.pmod(F.xxhash64("term"), F.lit(self.parts)).cast("int")

    def _read(self, name: str, wanted: DataFrame | None) -> DataFrame:
        rows = self.spark.read.parquet(f"{self.folder}/{name}")
        if wanted is not None:
            # At most ``parts`` numbers go through the driver; other folders are not read.
            rows = rows.filter(F.col("term_part").isin(sorted(r[0] for r in wanted.select(self.part()).distinct().collect())))
        return rows.drop("term_part")

    def postings(self, wanted: DataFrame | None = None) -> DataFrame:
        return self._read("postings", wanted)

    def terms(self, wanted: DataFrame | None = None) -> DataFrame:
        return self._read("terms", wanted)


def build_index(docs: DataFrame, key: str, columns: Iterable[str], folder: str, parts: int = PARTS, tokens: Tokenizer = tokenise) -> Index:
    """Index the tokens of all the columns together. A token's rows are spread over tasks by document, so a frequent one is not one task's."""
    index = Index(docs.sparkSession, folder.rstrip("/"), parts)
    words = F.array_distinct(F.flatten(F.array(*[tokens(F.coalesce(F.col(c), F.lit(""))) for c in columns])))
    rows = docs.select(F.col(key).alias("doc_id"), F.explode(words).alias("term")).withColumn("term_part", index.part())
    (rows.repartition("term_part", F.pmod(F.xxhash64("doc_id"), F.lit(8))).sortWithinPartitions("term_part", "term", "doc_id")
     .write.partitionBy("term_part").parquet(f"{index.folder}/postings"))
    known = index.postings().groupBy("term").agg(F.count("*").alias("df")).withColumn("term_part", index.part())
    known.repartition("term_part").sortWithinPartitions("term").write.partitionBy("term_part").parquet(f"{index.folder}/terms")
    return index


def search(index: Index, searches: DataFrame, tokens: Tokenizer = tokenise) -> DataFrame:
    """``(query_id, doc_id)``: the documents that hold all words of ``searches(query_id, words)``, a text; none for a search without words.

    Each search begins with the documents of its rarest word, so what is carried on is never more than that word's postings, and keeps
    those that also have each of its other words.
    """
    asked = searches.select("query_id", F.explode(F.array_distinct(tokens(F.col("words")))).alias("term"))
    known = asked.join(index.terms(asked), "term", "left")
    # A word that no document has leaves nothing: it is the rarest, and has no postings.
    plan = known.groupBy("query_id").agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "term")).alias("rarest"), F.count("*").alias("n"))
    begun = plan.select("query_id", "n", F.col("rarest.term").alias("term"))
    postings = index.postings(asked)
    found = begun.join(postings, "term").select("query_id", "n", "doc_id", F.col("term").alias("begun"))
    others = found.filter("n > 1").join(asked, "query_id").filter("term <> begun").select("query_id", "doc_id", "n", "term")
    # Each posting is there once, so the words a document has are counted by the rows that meet.
    rest = (others.join(postings, ["term", "doc_id"], "left_semi").groupBy("query_id", "doc_id", "n").agg(F.count("*").alias("held"))
            .filter("held = n - 1").select("query_id", "doc_id"))
    return found.filter("n = 1").select("query_id", "doc_id").unionByName(rest)
