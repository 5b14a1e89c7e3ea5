import pytest

import __spark_entry__ as contract
from compare import database, rows

SMALL = "/root/testdata/sf0.001"
CHECKED = ["term_counts", "similar_pairs", "threshold_clusters", "cluster_keywords", "latest_document", "related_articles", "stream_dedupe_titles"]


def test_every_sql_belongs_to_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_its_sql(spark, name):
    df = contract.queries()[name](spark, SMALL)
    cursor = database(SMALL).execute(contract.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows([tuple(r) for r in df.collect()], df.columns) == rows(cursor.fetchall(), columns)
