"""Runs registered queries next to their SQL: python tests/compare.py FOLDER [name ...]"""

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract  # noqa: E402
from storyweave.session import build_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def rows(records: list[tuple], names: list[str]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in records), key=repr)


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def main(folder: str, names: list[str]) -> int:
    spark = build_session(master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "16g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = database(folder), 0
    queries, sql = contract.queries(), contract.oracle_sql()
    for name in names or list(queries):
        start = time.time()
        try:
            df = queries[name](spark, folder)
            got = rows([tuple(r) for r in df.collect()], df.columns)
            took, verdict = time.time() - start, "rows only"
            if name in sql:
                start = time.time()
                cur = con.execute(sql[name])
                columns = [c[0] for c in cur.description]
                want = rows(cur.fetchall(), columns)
                same = sorted(columns) == sorted(df.columns) and got == want
                verdict = "ok" if same else f"DIFFERS {sorted(df.columns)} {sorted(columns)} {len(got)} {len(want)} {[x for x in zip(got, want) if x[0] != x[1]][:2]}"
                verdict += f" sql {time.time() - start:.1f}s"
        except Exception as error:
            took, verdict, got = time.time() - start, f"ERROR {str(error)[:600]}", []
        bad += "ok" not in verdict and verdict != "rows only"
        print(f"{name:28s} {took:6.1f}s {len(got):8d} rows  {verdict}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
