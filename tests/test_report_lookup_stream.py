import json
import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storyweave.operators import lookup, report
from storyweave.operators.clusters import Clusters
from storyweave.plans import catalog
from storyweave.sources import tables
from storyweave.streaming import chain


def fixture(spark):

    stamp = lambda df, *names: df.withColumns({n: F.col(n).cast("timestamp") for n in names})
    cl = stamp(spark.createDataFrame(
        [("c1", "threshold", "{}", "2024-01-01", "2024-01-02", "2024-01-02"), ("c2", "threshold", "{}", "2024-01-01", "2024-01-02", "2024-01-02"),
         ("old", "threshold", "{}", "2023-12-31", "2024-01-01", "2024-01-01"), ("half", "threshold", "{}", "2024-01-01 12:00:00", "2024-01-02", "2024-01-02")],
        "id string, type string, parameters string, begin string, end string, added_at string"), "begin", "end", "added_at")
    links = spark.createDataFrame([("c1", "a1"), ("c1", "a2"), ("c2", "a2"), ("c2", "a3"), ("c2", "a4"), ("old", "a1"), ("half", "a9"), ("half", "a1")],
                                  "cluster_id string, article_id string")
    arts = stamp(spark.createDataFrame(
        [(f"a{i}", i % 3, f"https://x.com/{i}", f"T{i}", f"2024-01-01 {10 + i}:00:00", f"2024-01-01 {10 + i}:30:00") for i in (1, 2, 3, 4, 9)],
        "article_id string, source_id int, url string, title string, published_at string, added_at string"), "published_at", "added_at")
    sources = spark.createDataFrame([(0, "s0"), (1, "s1"), (2, "s2")], "id int, name string")
    words = spark.createDataFrame([("c1", "w", 0.5), ("c2", "v", 0.2), ("c2", "u", 0.7)], "cluster_id string, term string, weight double")
    return Clusters(cl, links, words), arts, sources


def test_report(spark, tmp_path):
    found, arts, sources = fixture(spark)
    top = report.latest_clusters(found.clusters, found.links, arts, sources, {"hours": 24}, limit=10)
    assert [(r.id, r["size"]) for r in top.collect()] == [("c2", 3), ("c1", 2)]
    assert report.latest_clusters(found.clusters, found.links, arts, sources, {"days": 1}, limit=1).count() == 1
    document = report.prep_latest(report.collect_cluster(top, found.links, found.keywords, arts, sources))
    path = tables.publish_json(document, str(tmp_path), {"days": 1})
    assert path.endswith("latest_1_days.json")
    data = json.loads(spark.read.text(path).first().value)
    assert data["added_at"] == "2024-01-02 00:00:00.000000+0000"
    assert data["clusters"][0] == {
        "topics": [{"term": "u", "weight": 0.7}, {"term": "v", "weight": 0.2}],
        "articles": [{"title": f"T{i}", "url": f"https://x.com/{i}", "source": f"s{i % 3}", "date": "01-01-2024"} for i in (4, 3, 2)],
        "source_count": 3}
    rows = report.cluster_members(top, found.links, arts, sources).filter("cluster_id = 'c2'").orderBy("position").collect()
    assert [r.title for r in rows] == ["T4", "T3", "T2"]


def test_lookup(spark):
    found, arts, sources = fixture(spark)
    asked = spark.createDataFrame([(1, "https://x.com/2?q=1"), (2, "x.com/9"), (3, "https://nowhere.org/page"), (4, "/4"), (5, "https://x.com/_"), (6, "%")],
                                  "query_id int, url string")
    hits = lookup.find_article(asked, arts)
    assert {r.query_id: r.article_id for r in hits.collect()} == {1: "a2", 2: "a9", 3: None, 4: "a4", 5: None, 6: None}
    liked = {r.query_id: r.article_id for r in lookup.find_article(asked, arts, like_semantics=True).collect()}
    assert liked == {1: "a2", 2: "a9", 3: None, 4: "a4", 5: "a1", 6: "a1"}
    related = lookup.related_articles(hits, found.clusters, found.links, arts, sources)
    assert [r.article_id for r in related.filter("query_id = 1").orderBy("position").collect()] == ["a4", "a3", "a1"]
    log = {r.query_id: (r.status_code, r.response_count) for r in lookup.search_log(asked, hits, related).collect()}
    assert log[1] == (200, 3) and log[2] == (200, 0) and log[3] == (404, None)


def test_chain_is_idempotent_and_follows_new_rows(spark, tmp_path):
    parsed = T.StructType([T.StructField("article_id", T.LongType()), T.StructField("content", T.StringType()), T.StructField("added_at", T.TimestampType())])
    counts = T.StructType([T.StructField("article_id", T.LongType()), T.StructField("term", T.StringType()), T.StructField("count", T.LongType()), T.StructField("added_at", T.TimestampType())])
    source, target = str(tmp_path / "parsed"), str(tmp_path / "termcount")

    def arrive(*rows):
        df = spark.createDataFrame(rows, "article_id long, content string").withColumn("added_at", F.lit("2024-01-01").cast("timestamp"))
        df.write.mode("append").parquet(source)

    def run(checkpoint):
        chain.stream_term_counts(spark.readStream.schema(parsed).parquet(source), target, counts, str(tmp_path / checkpoint))
        return {(r.article_id, r.term, r["count"]) for r in chain.table_at(spark, target, counts).collect()}, chain.table_at(spark, target, counts).count()

    arrive((1, "a a b"))
    assert run("c1") == ({(1, "a", 2), (1, "b", 1)}, 2)
    arrive((1, "c"), (2, "a"))
    want = ({(1, "a", 2), (1, "b", 1), (1, "c", 1), (2, "a", 1)}, 4)
    assert run("c1") == want
    assert run("c1") == want
    assert run("fresh checkpoint") == want  # the whole stream again adds nothing


def test_stream_dedupe_titles(spark, tmp_path):
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("title", "url")] + [T.StructField("source_id", T.IntegerType()), T.StructField("added_at", T.TimestampType())])
    source, target = str(tmp_path / "new"), str(tmp_path / "article")

    def arrive(hour, *rows):
        df = spark.createDataFrame(rows, "title string, url string").withColumns(
            {"source_id": F.lit(1), "added_at": F.lit(f"2024-01-01 {hour:02d}:00:00").cast("timestamp")})
        df.write.mode("append").parquet(source)
        chain.stream_dedupe_titles(spark.readStream.schema(schema).parquet(source), target, schema, str(tmp_path / "cp"), timedelta(hours=6))
        return {r.url for r in chain.table_at(spark, target, schema).collect()}

    assert arrive(1, ("t", "u1"), ("t", "u2")) == {"u1", "u2"}
    assert arrive(3, ("t", "u3"), ("s", "u4"), ("s", "u4")) == {"u1", "u2", "u4"}
    assert arrive(12, ("t", "u5")) == {"u1", "u2", "u4", "u5"}


def test_stream_dedupe_does_not_depend_on_batches(spark):
    import random

    from storyweave.operators.articles import fresh_titles
    from storyweave.sources.tables import insert_ignore

    draw = random.Random(4)
    rows = []
    for hour in sorted(draw.choices(range(30), k=40)):
        title, source = draw.choice(["s", "t", None]), draw.choice([1, 2])
        rows.append((title, f"{title}{source}-{draw.randrange(6)}", source, hour))
    rows += [("q", "u100", 1, 1), ("q", "u300", 1, 3), ("q", "u900", 1, 12)]
    rows.sort(key=lambda r: r[3])
    kind = "title string, url string, source_id int, hour int"

    def table(part):
        return spark.createDataFrame(part, kind).withColumn("added_at", F.timestamp_seconds(F.col("hour") * 3600))

    def run(batches):
        present = table([])
        for part in batches:
            fresh = fresh_titles(table(part), present, timedelta(hours=6))
            added = insert_ignore(fresh, present, ["url"], [F.col("added_at"), F.col("title"), F.col("source_id")]).collect()
            present = table([*[tuple(r)[:4] for r in present.collect()], *[(r.title, r.url, r.source_id, r.hour) for r in added]])
        return {tuple(r)[:4] for r in present.collect()}

    hours = sorted({r[3] for r in rows})
    whole = run([rows])
    halves = [[r for r in rows if r[3] <= 12], [r for r in rows if r[3] > 12]]
    assert {u for t, u, *_ in whole if t == "q"} == {"u100", "u900"}
    assert whole == run(halves) == run([[r for r in rows if r[3] in hours[i:i + 6]] for i in range(0, len(hours), 6)])


def test_positions_of_a_group_larger_than_a_partition(spark):
    from storyweave.operators.ranking import ranked

    df = spark.range(2000).select(F.when(F.col("id") % 10 < 8, 0).otherwise(F.col("id") % 3).alias("g"), "id", (F.col("id") * 7919 % 101).alias("v"))
    got = {(r.g, r.id): r.position for r in ranked(df, ["g"], [F.desc("v"), F.col("id")]).collect()}
    rows = sorted(((r.g, -r.v, r.id) for r in df.collect()))
    want, last, place = {}, None, 0
    for g, _, i in rows:
        place = place + 1 if g == last else 1
        want[(g, i)], last = place, g
    assert got == want


def test_shared_folder_is_read_from_the_session(spark):
    from storyweave.session import shared_folder

    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def plain_titles(rows, present, length):
    """One row after another: (url, title, source, minute)."""
    seen, kept = {u for u, *_ in present}, []
    tags = {}
    for u, title, source, at in present:
        tags.setdefault((title, source), []).append(at)
    for at, u, title, source in sorted({(at, u, title, source) for u, title, source, at in rows if u not in seen}, key=lambda r: r[:2]):
        own = tags.get((title, source), [])
        if any(at - length < t < at for t in own + [k[3] for k in kept if k[1:3] == (title, source)]) or u in {k[0] for k in kept}:
            continue
        kept.append((u, title, source, at))
    return sorted(kept)


@pytest.mark.parametrize("seed,length", [(1, 30), (2, 12)])
def test_titles_in_the_look_back_as_one_row_after_another(spark, seed, length):
    from storyweave.operators.articles import fresh_titles

    rng = random.Random(seed)

    def row(base):
        u = f"{base}{rng.randrange(250)}"
        h = sum(map(ord, u)) % 3  # an address keeps its title and source; the first title holds a third of all rows
        return (u, f"t{h}", h % 2, rng.randrange(300))

    rows, present = [row("n") for _ in range(160)], [row("o") for _ in range(12)] + [row("n") for _ in range(5)]

    def table(found):
        df = spark.createDataFrame(found, "url string, title string, source_id int, minute long")
        return df.select("url", "title", "source_id", F.timestamp_seconds(F.col("minute") * 60 + 1_700_000_000).alias("added_at"))

    got = fresh_titles(table(rows), table(present), timedelta(minutes=length)).withColumn("m", (F.unix_seconds("added_at") - 1_700_000_000) / 60)
    assert sorted({(r.url, r.title, r.source_id, int(r.m)) for r in got.collect()}) == plain_titles(rows, present, length)


def test_rows_without_title_or_source_are_like_no_other(spark):
    from storyweave.operators.articles import fresh_titles

    df = spark.createDataFrame([("a", None, 1, "2024-01-01"), ("b", None, 1, "2024-01-02"), ("c", "t", None, "2024-01-01"), ("d", "t", 1, "2024-01-01")],
                               "url string, title string, source_id int, day string").select("url", "title", "source_id", F.col("day").cast("timestamp").alias("added_at"))
    assert {r.url for r in fresh_titles(df, df.limit(0), timedelta(days=9)).collect()} == {"a", "b", "c", "d"}


@pytest.mark.parametrize("files", [0, 3])
def test_documents_in_one_file_or_a_folder_of_files_are_a_stream(spark, tmp_path, files):
    docs = spark.createDataFrame([(i, f"storm coast w{i}", "en", "src1", 12) for i in range(9)], "doc_id long, text string, lang string, source string, n_chars long")
    if files:
        docs.repartition(files).write.parquet(str(tmp_path / "documents.parquet"))
    else:
        docs.toPandas().to_parquet(tmp_path / "documents.parquet")
    got = sorted(catalog.QUERIES["stream_term_counts"](spark, str(tmp_path)).collect())
    assert got == sorted((i, term, 1) for i in range(9) for term in ("storm", "coast", f"w{i}"))
    assert catalog.QUERIES["stream_dedupe_titles"](spark, str(tmp_path)).count() == 9


def test_lookups_offer_few_substrings_and_find_all(spark):
    """Pieces of every length and place; only every few letters a substring is offered, and still the last."""
    urls = [f"https://src{i % 3}.example.com/a/{i}-{'xyz'[i % 3] * (i % 5)}é{i * 37 % 101}" for i in range(12)]
    pieces = sorted({u[at:at + n] for u in urls for n in (1, 5, 11, 12, 13, 17, 26) for at in range(len(u) - n + 1)} | {"zz.example.org/none", "src9.example.com/a/1"})
    every = spark.createDataFrame(list(enumerate(urls)), "article_id long, url string")
    asked = spark.createDataFrame(list(enumerate(pieces)), "query_id long, url string")
    got = {r.url: r.article_id for r in lookup.find_article(asked, every).collect()}
    assert got == {p: min(((u, i) for i, u in enumerate(urls) if p in u), default=(None, None))[1] for p in pieces}
    offered = asked.filter(F.length("url") >= 12).select("url", lookup._grams(F.col("url"), F.lit(12), lookup.STEP).alias("grams")).collect()
    for row in offered:
        assert len(row.grams) <= (len(row.url) - 12) // 4 + 2
        assert all(any(row.url[at:at + 9] in g for g in row.grams) for at in range(len(row.url) - 8))


def test_both_logs_read_one_list_of_related(spark, tmp_path, monkeypatch):
    """append_search_log on tables of its own: what is related is stored once, not worked out for each run of the log."""
    docs = [(i, f"story number {i // 3} of the day about topic{i // 3} and {'abc'[i % 3]}", "en", f"src{i % 2}", 30) for i in range(12)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "https://other.example.org/page?x=1", "<p>a</p>")], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    real, seen = lookup.search_log, []

    def spy(asked, hits, related):
        seen.append(related.inputFiles())
        return real(asked, hits, related)

    monkeypatch.setattr(lookup, "search_log", spy)
    rows = catalog.append_search_log(spark, str(tmp_path)).collect()
    assert len(rows) == 2 * (2 * len(docs) + 1) and sum(r.status_code == 404 for r in rows) == 2
    assert {r.response_count for r in rows if r.status_code == 200} == {11}  # same topic or same letter: one cluster
    assert len(seen) == 2 and seen[0] == seen[1] and all("/staged/related-" in f for f in seen[0])


def test_articles_are_cut_to_the_sizes_asked_for(spark, monkeypatch):
    real, seen = lookup._containing, []
    monkeypatch.setattr(lookup, "_containing", lambda missed, articles, sizes, held: seen.append(sizes) or real(missed, articles, sizes, held))
    every = spark.createDataFrame([(1, "https://src1.example.com/a/1"), (2, "https://src2.example.com/a/2")], "article_id long, url string")
    for pieces, want in ((["src1.example.com/a/1"], [[12]]), (["src2", "a/1", "src1.example.com/a/1"], [[12], [3, 4]])):
        seen.clear()
        found = lookup.find_article(spark.createDataFrame(list(enumerate(pieces)), "query_id long, url string"), every)
        assert seen == want and {r.url: r.article_id for r in found.collect()} == {p: 2 if p == "src2" else 1 for p in pieces}
