"""Queries that SQL can express, against DuckDB."""

import duckdb

from tollstream.llm.catalog import QUERIES, SQL

SF = "/root/testdata/sf0.001"


def test_sql_gives_the_same_rows(spark):
    con = duckdb.connect()
    for name in ("documents", "embeddings", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    for name, sql in SQL.items():
        got = QUERIES[name](spark, SF)
        columns = sorted(got.columns)
        want = con.execute(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall()
        assert sorted(map(str, (tuple(r) for r in got.select(columns).collect()))) == sorted(map(str, want)), name
