"""Column functions on text and URLs."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Tokenizer = Callable[[Column], Column]

# Markup and entities removed from titles, authors and summaries.
MARKUP = r"<.*?>|&([a-z0-9]+|#[0-9]{1,6}|#x[0-9a-f]{1,6});"
TOKEN = r"[\p{L}\p{N}]+"


@F.pandas_udf(T.StringType())
def _nfkd(text: pd.Series) -> pd.Series:
    return text.map(lambda t: unicodedata.normalize("NFKD", t), na_action="ignore")


def strip_markup(column: Column) -> Column:
    # (?d): only \n ends a line, so `.` stops where the markup pattern is meant to stop.
    return F.regexp_replace(column, "(?d)" + MARKUP, "")


def clean_text(column: Column) -> Column:
    """Markup removed, then NFKD. ASCII text is its own NFKD, so only the rest is sent to Python."""
    bare = strip_markup(column)
    return F.coalesce(_nfkd(F.when(bare.rlike(r"[^\x00-\x7F]"), bare)), bare)


def strip_query(url: Column) -> Column:
    return F.substring_index(url, "?", 1)


def is_url(url: Column) -> Column:
    return url.rlike("^https?://")


def tokenise(content: Column, stop_words: Iterable[str] = ()) -> Column:
    """Lower-cased words in order, repeats kept, stop words dropped."""
    tokens = F.regexp_extract_all(F.lower(content), F.lit(TOKEN), F.lit(0))
    stops = sorted({w.lower() for w in stop_words})
    if not stops:
        return tokens
    return F.filter(tokens, lambda t: ~t.isin(stops))


def tokenizer(stop_words: Iterable[str] = ()) -> Tokenizer:
    stops = tuple(stop_words)
    return lambda content: tokenise(content, stops)


def english_stop_words(spark: SparkSession) -> list[str]:
    """Spark's own English list."""
    from pyspark.ml.feature import StopWordsRemover

    return StopWordsRemover.loadDefaultStopWords("english")


def lemmatise(counts: DataFrame, lemmas: DataFrame) -> DataFrame:
    """Replace each term by its lemma from ``lemmas(form, lemma)`` and add up the counts that meet.

    Spark broadcasts the dictionary when its size allows and otherwise shuffles it by term.
    """
    keys = [c for c in counts.columns if c not in ("term", "count")]
    unique = lemmas.groupBy("form").agg(F.min("lemma").alias("lemma"))
    return (counts.join(unique, counts["term"] == unique["form"], "left")
            .withColumn("term", F.coalesce("lemma", "term"))
            .groupBy(*keys, "term").agg(F.sum("count").alias("count"))
            .select(*counts.columns))


def text_match(df: DataFrame, columns: Iterable[str], words: Iterable[str]) -> DataFrame:
    """Rows having all the words among the tokens of the given columns together."""
    tokens = F.flatten(F.array(*[tokenise(F.coalesce(F.col(c), F.lit(""))) for c in columns]))
    wanted = sorted({w.lower() for w in words})
    return df.filter(F.size(F.array_intersect(tokens, F.array(*map(F.lit, wanted)))) == len(wanted))
