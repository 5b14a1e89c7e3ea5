import unicodedata

import pytest
from hypothesis import given, settings, HealthCheck
from hypothesis import strategies as st
from pyspark.sql import functions as F

from storyweave.functions import text, times


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "c string").select(column(F.col("c")).alias("r")).first().r


def test_clean_text_removes_tags_and_entities_and_normalises(spark):
    assert one(spark, "a<b\nc>d&amp;e&AMP;", text.clean_text) == "a<b\nc>de&AMP;"
    assert one(spark, "<p>ﬁn&#39; café&#x2f;</p>", text.clean_text) == unicodedata.normalize("NFKD", "ﬁn café")
    assert one(spark, None, text.clean_text) is None


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab<>&;#x1\n éﬁ①", max_size=30), min_size=20, max_size=40))
def test_clean_text_agrees_with_python(spark, samples):
    import re

    pattern = re.compile(text.MARKUP)
    df = spark.createDataFrame([(i, s) for i, s in enumerate(samples)], "i int, c string")
    got = {r.i: r.r for r in df.select("i", text.clean_text(F.col("c")).alias("r")).collect()}
    assert got == {i: unicodedata.normalize("NFKD", pattern.sub("", s)) for i, s in enumerate(samples)}


def test_tokens_keep_repeats_and_drop_stop_words(spark):
    assert one(spark, "The Fake, fake content!", lambda c: text.tokenise(c, ["the"])) == ["fake", "fake", "content"]
    assert len(text.english_stop_words(spark)) > 100


def test_lemmas_meet_and_add_up(spark):
    counts = spark.createDataFrame([(1, "story", 2), (1, "stories", 3), (1, "x", 1)], "article_id int, term string, count long")
    lemmas = spark.createDataFrame([("stories", "story")], "form string, lemma string")
    assert {(r.term, r["count"]) for r in text.lemmatise(counts, lemmas).collect()} == {("story", 5), ("x", 1)}


@pytest.mark.parametrize("written,expected", [
    ("2023-07-09 04:31:20.250000+00:00", "2023-07-09 04:31:20.250000+0000"),
    ("2023-07-09 04:31:20.250000", "2023-07-09 04:31:20.250000+0000"),
    ("", "2030-01-01 00:00:00.000000+0000"),
    ("not a date", None),
    ("Tue, 05 Apr 2022 10:00 EST", "2022-04-05 15:00:00.000000+0000"),
    ("Tue, 05 Apr 2022 10:00:00 EDT", "2022-04-05 14:00:00.000000+0000"),
    ("2022-04-05T10:00:00.5Z", "2022-04-05 10:00:00.500000+0000"),
    ("Apr 5, 2022 3:04 PM EDT", "2022-04-05 19:04:00.000000+0000"),
    ("2022-04-05T10:00:00+02:00", "2022-04-05 08:00:00.000000+0000"),
])
def test_parse_time(spark, written, expected):
    runtime = F.lit("2030-01-01").cast("timestamp")
    assert one(spark, written, lambda c: times.format_time(times.parse_time(c, runtime))) == expected


@pytest.mark.filterwarnings("ignore")
def test_parse_time_agrees_with_dateutil(spark):
    from datetime import datetime, timezone

    from dateutil import parser

    written = ["10:05:00", "9:07", "3:04 PM", "05 Apr 22 10:00:00 GMT", "05 Apr 99 10:00:00", "Tue, 05 Apr 2022 10:00:00 PST", "Tue, 05 Apr 2022 10:00:00 UT",
               "Tue Apr  5 10:00:00 2022", "20220405T100000Z", "20220405", "Tue, 05 Apr 2022 10:00:00 +0000 (UTC)", "05.04.2022 10:00", "25.04.2022 10:00",
               "2022-04-05", "April 5, 2022", "5 April 2022 10:00", "04/05/2022 3:04 PM", "2022/04/05 10:00:00.5", "2022-04-05T10:00:00-03:30"]
    runtime = datetime(2030, 1, 1, 12, 30, tzinfo=timezone.utc)
    df = spark.createDataFrame([(i, w) for i, w in enumerate(written)], "i int, c string")
    at = F.lit("2030-01-01 12:30:00").cast("timestamp")
    got = {r.i: r.r for r in df.select("i", F.unix_micros(times.parse_time(F.col("c"), at)).alias("r")).collect()}
    for i, text_ in enumerate(written):
        want = parser.parse(text_, default=datetime(2030, 1, 1))
        want = (want if want.tzinfo else want.replace(tzinfo=timezone.utc))
        assert got[i] == round(want.timestamp() * 1e6), text_
    assert runtime.year == 2030


def test_ranges(spark):
    assert times.format_range({"days": 1}) == "1 days"
    with pytest.raises(ValueError):
        times.format_range({"days": 1, "hours": 2})
    df = spark.sql("select timestamp '2024-01-01' as b, timestamp '2024-01-02' as e")
    assert df.filter(times.interval_eq(F.col("b"), F.col("e"), {"hours": 24})).count() == 1
    assert df.filter(times.interval_eq(F.col("b"), F.col("e"), {"hours": 12})).count() == 0


def test_text_match_and_urls(spark):
    df = spark.createDataFrame([("a storm hits", "x"), ("calm", None)], "title string, summary string")
    assert text.text_match(df, ["title", "summary"], ["Storm", "x"]).count() == 1
    assert one(spark, "https://a.b/c?d=1?e#f", text.strip_query) == "https://a.b/c"
