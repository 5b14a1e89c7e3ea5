import corpus_pipeline
from helpers import docs, odd_rows

from storyweave.llm import mixing, packing, quality, simhash
from test_line_dedup import brute

SMALL = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_each_stage_against_a_plain_version(spark, tmp_path):
    given = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    before, results = given, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, before, SMALL).write.parquet(str(tmp_path / name))
        results[name] = (before, spark.read.parquet(str(tmp_path / name)))
        before = results[name][1]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "simhash", "mixing", "packing"]
    assert all(results[n][1].columns == COLUMNS for n in list(results)[:-1])

    docs_in, out = results["quality"]
    kept = {r.doc_id for r in quality.score(docs_in, labels).filter("kept").collect()}
    assert {r.doc_id: r.text for r in out.collect()} == {r.doc_id: r.text for r in docs_in.collect() if r.doc_id in kept}

    docs_in, out = results["line_dedup"]
    rows = {r.doc_id: r.text for r in docs_in.collect()}
    want, _ = brute(rows.items())
    plain = {d: "\n".join(x for no, x in enumerate(t.split("\n")) if want.get((d, no), (d, no)) == (d, no)) for d, t in rows.items()}
    got = {r.doc_id: r.text for r in out.collect()}
    assert sum(got[d] != plain[d] for d in plain) <= 2 and set(got) == set(plain)

    docs_in, out = results["simhash"]
    prints = {r.doc_id: simhash.fingerprint_of(r.text) for r in docs_in.collect()}
    assert {r.doc_id for r in out.collect()} <= set(prints)
    left = [prints[r.doc_id] for r in out.collect()]
    assert all((a ^ b).bit_count() > 4 for i, a in enumerate(left) for b in left[:i])

    docs_in, out = results["mixing"]
    copies = {r.doc_id: r.copies for r in mixing.mix(docs_in).collect()}
    seen = {}
    for r in out.collect():
        seen[r.doc_id] = seen.get(r.doc_id, 0) + 1
    assert seen == {d: n for d, n in copies.items() if n}

    docs_in, out = results["packing"]
    tokens = sum(len(packing.Vocabulary.load(packing.vocabulary()).ids(r.text)) + 1 for r in docs_in.collect())
    assert sum(r.length for r in out.collect()) == tokens


def test_run(spark):
    assert corpus_pipeline.run(spark, SMALL).count() > 100


def test_odd_rows_go_through_every_stage(spark, tmp_path):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (7, 0, 0)], "doc_id bigint, quality int, toxic int")
    for rows in (odd_rows(), []):
        folder = tmp_path / str(len(rows))
        labels.write.parquet(str(folder / "labels.parquet"))
        before = docs(spark, rows)
        for name, stage in corpus_pipeline.STAGES:
            stage(spark, before, str(folder)).write.parquet(str(folder / name))
            before = spark.read.parquet(str(folder / name))
