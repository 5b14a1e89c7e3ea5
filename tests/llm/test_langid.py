import zlib

from helpers import docs, odd_rows

from storyweave.llm import langid, queries

TABLE = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{TABLE}/documents.parquet").collect()}
    rows = queries.QUERIES["op10_language"](spark, TABLE).collect()
    assert {r.doc_id for r in rows} == set(truth)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert len(held) > 150 and sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.98 * len(held)


def test_unknown_and_odd(spark):
    rows = [(i, t, lang, "s", 1) for i, (t, lang) in enumerate([("the cat is here", "en"), ("der Hund ist da", "de"), ("le chat", None)] * 20)]
    rows += [(100, None, "en", "s", 1), (101, "12 !? 34", "de", None, None), (102, "", "de", "s", 1), (None, "the dog is there", "de", "s", 1), (103, "𝒳 🙂", "en", "s", 1)]
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(docs(spark, rows)).collect()}
    assert got[100] == got[101] == got[102] == ("und", 0.0)
    assert got[None][0] == "en" and got[0][0] == "en" and got[1][0] == "de" and got[103][0] in ("en", "de")
    assert langid.identify(docs(spark, odd_rows())).count() == len(odd_rows())
    assert langid.identify(docs(spark, [])).count() == 0
    unlabelled = docs(spark, [(1, "some text", None, "s", 9)])
    assert langid.identify(unlabelled).first().lang_pred == "und"


def test_counts_are_whole(spark):
    """A long text's grams are those of its pieces: the pieces' letters add up."""
    text = "abc déf " * 300_000
    assert sum(len(x) for x in langid.grams(text)) > 3 * 0.99 * len(text)
