import random

from helpers import docs, odd_rows

from storyweave.llm import quality

TABLE = "/root/testdata/sf0.1"
LABELS = "doc_id bigint, quality int, toxic int"


def test_held_out_accuracy(spark):
    """Labels with some documents' taken away: the classifier still tells good from bad among those."""
    table = spark.read.parquet(f"{TABLE}/documents.parquet")
    labels = spark.read.parquet(f"{TABLE}/labels.parquet")
    hidden = labels.filter("pmod(xxhash64(doc_id, 7), 3) = 0")
    got = {r.doc_id: r for r in quality.score(table, labels.join(hidden, "doc_id", "left_anti")).collect()}
    truth = {r.doc_id: r.quality for r in hidden.collect()}
    good, bad = [d for d, q in truth.items() if q], [d for d, q in truth.items() if not q]
    assert len(bad) > 100
    kept = sum(got[d].kept for d in good) / len(good)
    gone = sum(not got[d].kept for d in bad) / len(bad)
    print("kept", kept, "gone", gone)
    assert kept >= 0.98 and gone >= 0.85
    calibrated = sum(got[d].score for d in truth) / len(truth)
    assert abs(calibrated - len(good) / len(truth)) < 0.05


def test_odd_rows(spark):
    given = docs(spark, odd_rows())
    none = spark.createDataFrame([], LABELS)
    assert quality.score(given, none).filter("kept and score = 1").count() == len(odd_rows())
    some = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 1, 0), (7, 0, 0), (None, 0, 0), (9, None, 0), (77, 0, 0)], LABELS)
    out = quality.keep_good(given, some)
    assert out.columns == given.columns and out.filter("doc_id is null").count() == 2
    assert quality.score(docs(spark, []), some).count() == 0 and quality.keep_good(docs(spark, []), some).count() == 0


def test_views_teach_each_other(spark):
    """Only a tenth is labelled; junk has a look and comes from one source."""
    draw = random.Random(1)
    vocabulary = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnrst"]
    rows, labels = [], []
    for i in range(600):
        bad = draw.random() < 0.3
        text = "BUY!! NOW!! " * 30 if bad else " ".join(draw.choices(vocabulary, k=60))
        rows.append((i, text, "en", "shop" if bad else draw.choice("abc"), len(text)))
        if i % 10 == 0:
            labels.append((i, int(not bad), 0))
    got = quality.score(docs(spark, rows), spark.createDataFrame(labels, LABELS)).collect()
    truth = {r[0]: r[3] != "shop" for r in rows}
    assert all(r.kept == truth[r.doc_id] for r in got)
    # The metadata view alone has learnt from the text view's pseudo-labels.
    assert all((r.p_meta >= 0.5) == truth[r.doc_id] for r in got)
