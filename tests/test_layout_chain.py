"""Tables laid out by key and day, panes of sliding windows, and the stages that follow each other."""

import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storyweave.functions.html import container_text
from storyweave.operators import clusters, similarity, terms
from storyweave.operators.windows import RUN, Panes, sliding_windows, window_scan, windows_scan
from storyweave.sources import tables
from storyweave.streaming import chain

SCHEMA = T.StructType([T.StructField("url", T.StringType()), T.StructField("title", T.StringType()), T.StructField("added_at", T.TimestampType())])
LAYOUT = tables.Layout(("url",), parts=8)


def rows(spark, days, per_day, name="u"):
    found = [(f"{name}{d}-{i}", f"t{i}", datetime(2024, 1, 1 + d, 3)) for d in days for i in range(per_day)]
    return spark.createDataFrame(found, SCHEMA)


def files_of(df) -> int:
    return df.select(F.input_file_name()).distinct().count()


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_read_touched_folders_only(spark, tmp_path):
    path = str(tmp_path / "articles")
    tables.append(rows(spark, range(3), 40), path, LAYOUT)
    batch = rows(spark, [1], 1)

    def scans():
        stored = tables.table_at(spark, path, SCHEMA, LAYOUT)
        window = window_scan(stored, "2024-01-02 00:00:00", "2024-01-02 12:00:00")
        return LAYOUT.touched(stored, batch).filter("added_on <= date'2024-01-03'"), window

    touched, window = scans()
    assert "PartitionFilters: [isnotnull(key_part" in plan_of(touched).replace("\n", " ") and "added_on" in plan_of(window).split("PartitionFilters: [")[1].split("]")[0]
    before = [files_of(df) for df in scans()]
    assert touched.count() < 120 / 4 and window.count() == 40
    tables.append(rows(spark, range(3, 20), 40), path, LAYOUT)
    assert [files_of(df) for df in scans()] == before
    again = tables.insert_ignore(rows(spark, range(2, 22), 3), LAYOUT.touched(tables.table_at(spark, path, SCHEMA, LAYOUT), rows(spark, range(2, 22), 3)),
                                 ["url"], [F.col("added_at")])
    assert {r.url for r in again.collect()} == {f"u{d}-{i}" for d in (20, 21) for i in range(3)}


def test_listed_windows_prune_days(spark, tmp_path):
    path = str(tmp_path / "articles")
    tables.append(rows(spark, range(10), 5), path, LAYOUT)
    stored = tables.table_at(spark, path, SCHEMA, LAYOUT)
    windows = spark.createDataFrame([(datetime(2024, 1, d), datetime(2024, 1, d + 1)) for d in range(1, 9)], "begin timestamp, end timestamp")
    found = windows_scan(stored, windows.filter("begin = timestamp'2024-01-04'"))
    assert {r.url for r in found.collect()} == {f"u3-{i}" for i in range(5)} and found.columns == [*SCHEMA.fieldNames(), *RUN]
    assert "dynamicpruning" in plan_of(found).lower()


def test_compacting_keeps_every_row(spark, tmp_path):
    path = str(tmp_path / "articles")
    for i in range(4):
        tables.append(rows(spark, [0, 1], 30, f"b{i}-"), path, LAYOUT)
    before = sorted(tables.table_at(spark, path, SCHEMA, LAYOUT).collect())
    tables.compact(spark, path, SCHEMA, LAYOUT, "2024-01-01")
    spark.catalog.clearCache()
    after = tables.table_at(spark, path, SCHEMA, LAYOUT)
    assert sorted(after.collect()) == before
    assert files_of(after.filter("added_on = date'2024-01-01'")) <= LAYOUT.parts < files_of(after.filter("added_on = date'2024-01-02'"))


@pytest.mark.parametrize("hours,slide", [(12, 4), (6, 6), (5, 1)])
def test_panes_give_the_vectors_of_copied_rows(spark, hours, slide):
    rng = random.Random(hours)
    found = []
    for i in range(60):
        at = datetime(2024, 1, 1) + timedelta(minutes=30 * rng.randrange(96))  # half of them on a boundary
        found += [(i, t, rng.randrange(1, 4), at) for t in set(rng.choices("abcdefghij", k=4))]
    counts = spark.createDataFrame(found, "article_id int, term string, count long, added_at timestamp")
    size, step = timedelta(hours=hours), timedelta(hours=slide)

    def told(vectors):
        return sorted((str(r.end), r.article_id, r.term, r["count"], round(r.weight, 9)) for r in terms.explode_vectors(vectors).collect())

    got = terms.sliding_tfidf_vectors(counts, size, step)
    assert told(got) == told(terms.tfidf_vectors(sliding_windows(counts, size, step)))
    holding = Panes(size, step).holding(counts.filter("article_id = 5"))
    want = sliding_windows(counts.filter("article_id = 5"), size, step).select(*RUN).distinct()
    assert sorted(holding.collect()) == sorted(want.collect())


def _odd_counts(spark):
    """Articles without a number, terms and counts of null, an article of two times, one of null terms only, and rows without a time."""
    rng = random.Random(7)
    found = []
    for i in range(80):
        at = datetime(2024, 1, 1) + timedelta(minutes=30 * rng.randrange(144))
        found += [(i if i % 9 else None, t, rng.randrange(0, 4), at) for t in set(rng.choices(["a", "b", "c", "dé", "漢字", "g", ""], k=4))]
    at = datetime(2024, 1, 2, 3, 30)
    found += [(5, "a", 2, at), (5, "a", 1, at + timedelta(minutes=7)), (200, None, 3, at), (201, "a", None, at), (201, "b", 2, at), (202, None, 1, at), (202, "c", 1, at), (203, "a", 1, None),
              (204, "g", 0, at)]
    return spark.createDataFrame(found, "article_id int, term string, count long, added_at timestamp").repartition(3)


@pytest.mark.parametrize("rows,packed", [(2_000_000, 65_536), (2_000_000, 3), (90, 65_536), (60, 20), (0, 5)])
def test_stretches_and_joins_weigh_windows_alike(spark, monkeypatch, rows, packed):
    monkeypatch.setattr(terms, "STRETCH_ROWS", rows)
    monkeypatch.setattr(terms, "PACK_ROWS", packed)
    counts, size, step = _odd_counts(spark), timedelta(hours=6), timedelta(hours=2)

    def told(vectors):
        return sorted(str((r.begin, r.end, r.article_id, [(e.term, e["count"], round(e.weight, 9)) for e in r.vector])) for r in vectors.collect())

    panes = Panes(size, step)
    placed = counts.select("article_id", "term", "count", panes.pane().alias("pane")).filter("pane is not null")
    every = placed.select(F.explode(panes.stretches(3)).alias("stretch")).distinct()
    want = told(terms._sliding_by_joins(placed, panes, 3, every))
    got = told(terms.sliding_tfidf_vectors(counts, size, step))
    assert got == want and any("None" in x for x in got)


def test_sliding_windows_shuffle_packed_articles_only(spark):
    """Term counts go out once, packed by article, to the task of their windows; none is joined with frequencies."""
    found = plan_of(terms.sliding_tfidf_vectors(_odd_counts(spark), timedelta(hours=12), timedelta(hours=6)))
    assert "Join" not in found and "hashpartitioning(term" not in found and found.count("hashpartitioning(stretch") == 1


def test_sizes_that_slides_do_not_divide(spark):
    with pytest.raises(ValueError, match="multiple"):
        Panes(timedelta(hours=5), timedelta(hours=2))


PAGE = ('<body><div class="first"><p>one<p>two</p></div><article id="main"><section class="story big"><p>in <b>both</b></p></section><p>late</p></article>'
        '<section class="story"><p>never</p></section>')


@pytest.mark.parametrize("config,text", [
    ([{"id": "main"}, {"class_": "first"}], "in both late"), ([{"id": "none"}, {"class_": "first"}], "onetwo two"),
    ([{"class_": "^sto", "regex": True}], "in both"), ([{"id": "none"}, {"class_": "story"}, {"id": "main"}], "in both"),
    ([{"id": "none"}], None), ([], None), ([{"name": "body"}], "onetwo two in both late never")])
def test_all_selectors_in_one_reading(config, text):
    assert container_text(PAGE, config) == text


def test_reading_stops_where_the_first_container_ends():
    assert container_text(PAGE.split("late")[0] + "late</p></article>" + "<p>x" * 100_000, [{"id": "main"}]) == "in both late"


def test_chain_to_clusters_and_a_replay(spark, tmp_path):
    """Articles of two days, then more of the second: only its windows are written again, and a repeated run changes nothing."""
    article = T.StructType([T.StructField("article_id", T.LongType()), T.StructField("rss_feed_id", T.StringType()), T.StructField("added_at", T.TimestampType())])
    content = T.StructType([T.StructField("article_id", T.LongType()), T.StructField("content", T.StringType()), T.StructField("added_at", T.TimestampType())])
    count = T.StructType([T.StructField("article_id", T.LongType()), T.StructField("term", T.StringType()), T.StructField("count", T.LongType()),
                          T.StructField("added_at", T.TimestampType())])
    feeds = spark.createDataFrame([("f", [{"id": "main"}]), ("g", [{"class_": "story"}])], "id string, parser_config array<map<string,string>>").select(
        "id", F.from_json(F.to_json("parser_config"), "array<struct<name: string, id: string, class_: string, attrs: map<string,string>, regex: boolean>>").alias("parser_config"))
    by_article = tables.Layout(("article_id",), 2)

    def text(i):
        return f"shared{i % 2} story{i % 2} words{i % 2} own{i}"

    pages = [(i, 404 if i == 7 else 200, f"<div id='main' class='story'><p>{text(i)}</p></div>" if i != 6 else "<p>no container</p>") for i in range(12)]
    responses = spark.createDataFrame(pages, "article_id long, status int, content string")

    def run(root, checkpoint):
        at = lambda name, schema: spark.readStream.schema(schema).parquet(f"{root}/{name}")
        chain.stream_raw_pages(at("article", article), responses, f"{root}/raw", content, f"{checkpoint}/1", by_article)
        chain.stream_parsed_pages(at("raw", content), lambda: spark.read.schema(article).parquet(f"{root}/article").select(F.col("article_id").alias("id"), "rss_feed_id"),
                                  feeds, f"{root}/parsed", content, f"{checkpoint}/2", f"{root}/rejected", by_article)
        chain.stream_term_counts(at("parsed", content), f"{root}/counts", count, f"{checkpoint}/3")
        chain.stream_clusters(at("counts", count), lambda: tables.table_at(spark, f"{root}/counts", count), Panes(timedelta(days=1), timedelta(days=1)),
                              "threshold", {"threshold": 0.3}, f"{root}/clusters", f"{checkpoint}/4")

    def state(root):
        links = T.StructType([T.StructField("cluster_id", T.StringType()), T.StructField("article_id", T.LongType())])
        from storyweave.schemas import CLUSTER, CLUSTER_KEYWORD

        found = tables.cluster_tables(spark, f"{root}/clusters", (CLUSTER, links, CLUSTER_KEYWORD))
        return [sorted(map(str, df.collect())) for df in found]

    root = str(tmp_path / "chain")
    for part in (range(6), range(6, 12)):
        df = spark.createDataFrame([(i, "fg"[i % 2], datetime(2024, 1, 1 + (i >= 4), 5)) for i in part], article)
        df.coalesce(1).write.mode("append").parquet(f"{root}/article")
        run(root, f"{root}/cp")
        if part[0] == 0:
            untouched = state(root)
    both = spark.read.schema(count).parquet(f"{root}/counts")
    want = clusters.cluster_articles(sliding_windows(both, timedelta(days=1), timedelta(days=1)), "threshold", {"threshold": 0.3})
    done = state(root)
    assert done[:2] == [sorted(map(str, df.collect())) for df in (want.clusters, want.links)]
    assert done != untouched and len(done[0]) == 4
    assert [r.article_id for r in spark.read.parquet(f"{root}/rejected").collect()] == [6]
    assert {r.article_id for r in both.select("article_id").distinct().collect()} == set(range(12)) - {6, 7}
    run(root, str(tmp_path / "again"))
    assert state(root) == done


@pytest.mark.parametrize("hours,slide", [(12, 4), (5, 1)])
def test_neighbouring_windows_in_a_task_give_the_clusters_of_single_ones(spark, monkeypatch, hours, slide):
    rng = random.Random(hours)
    found = []
    for i in range(80):
        at, words = datetime(2024, 1, 1) + timedelta(minutes=30 * rng.randrange(96)), sorted(set(rng.choices("abcdefghij", k=3)))
        found += [(i if i else None, t, rng.randrange(0, 3) if i % 7 else 0, at) for t in words]
    counts = spark.createDataFrame(found, "article_id int, term string, count long, added_at timestamp")

    def told():
        got = clusters.cluster_sliding(counts, timedelta(hours=hours), timedelta(hours=slide), "threshold", {"threshold": 0.6})
        words = sorted((r.cluster_id, r.term, round(r.weight, 9)) for r in got.keywords.collect())
        return sorted(got.clusters.collect()), sorted(map(str, got.links.collect())), words

    together = told()
    assert together[1]
    parts = similarity.sliding_links(counts, Panes(timedelta(hours=hours), timedelta(hours=slide)), 0.6, similarity.Limits(block_articles=3))
    assert parts.count() > 0
    monkeypatch.setattr(similarity, "STRETCH_ROWS", 0)
    assert similarity.sliding_links(counts, Panes(timedelta(hours=hours), timedelta(hours=slide)), 0.6) is None
    assert told() == together


def files_in(folder):
    """The Parquet files of each folder below."""
    found = {}
    for file in Path(folder).rglob("part-*.parquet"):
        found.setdefault(file.parent.name, []).append(file.name)
    return found


def test_many_small_folders_are_written_by_several_tasks(spark, tmp_path):
    start = datetime(2024, 1, 1)
    rows = spark.createDataFrame([(i, start + timedelta(days=i % 40)) for i in range(400)], "k long, added_at timestamp")
    tables.append(rows, str(tmp_path / "table"), tables.Layout(("k",), 2))
    log = rows.select("k", F.col("added_at").alias("timestamp"))
    tables.append_search_log(log, str(tmp_path / "log"))
    for name in ("table", "log"):
        files = [file for found in files_in(tmp_path / name).values() for file in found]
        assert len({file.split("-")[1] for file in files}) > 1, name
    assert all(len(found) == 1 for found in files_in(tmp_path / "log").values())


def found_clusters(spark, windows, links):
    """Each window one cluster of so many links, dealt over eight tasks."""
    of = windows.select(F.unix_micros("end").cast("string").alias("id"), "begin", "end").repartition(8)
    members = of.select(F.col("id").alias("cluster_id"), F.explode(F.sequence(F.lit(1).cast("long"), F.lit(links))).alias("article_id")).repartition(8)
    words = members.select("cluster_id", F.col("article_id").cast("string").alias("term"), F.lit(1.0).alias("weight"))
    return clusters.Clusters(of, members, words)


def test_replaced_windows_get_a_file_each(spark, tmp_path, monkeypatch):
    start = datetime(2024, 1, 1)
    windows = spark.createDataFrame([(start + timedelta(days=i), start + timedelta(days=i + 1)) for i in range(12)], "begin timestamp, end timestamp")
    keep = tables.staged
    monkeypatch.setattr(tables, "staged", lambda df, name: keep(df.repartition(8), name))  # as many files as tasks of a larger table
    tables.replace_windows(found_clusters(spark, windows, 20), windows, str(tmp_path / "many"))
    for name in ("articlecluster", "articleclusterlink", "articleclusterkeyword"):
        found = files_in(tmp_path / "many" / name)
        assert len(found) == 12 and all(len(files) == 1 for files in found.values()), name
    assert spark.read.parquet(str(tmp_path / "many" / "articleclusterlink")).filter("cluster_id is not null").count() == 240
    tables.replace_windows(found_clusters(spark, windows.limit(1), 200), windows.limit(1), str(tmp_path / "one"))
    assert [len(files) > 1 for files in files_in(tmp_path / "one" / "articleclusterlink").values()] == [True]


def test_folders_are_listed_many_a_task(spark, tmp_path):
    for i in range(120):
        (tmp_path / "table" / f"day={i}").mkdir(parents=True)
    spark.range(3).coalesce(1).write.mode("overwrite").parquet(str(tmp_path / "table" / "day=0"))
    context = spark.sparkContext
    context.setJobGroup("listing", "listing")
    spark.read.schema("id long").parquet(str(tmp_path / "table"))
    context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    told = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    assert told and max(s.numTasks for s in told if s) <= 32
