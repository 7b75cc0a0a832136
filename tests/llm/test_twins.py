"""Queries of the subpackage against their SQL on the smallest tables, and SQL twins on odd rows."""

import duckdb
import pytest
from pyspark.sql import functions as F

from vigil.llm import middle, queries, recompression, runs

DATA = "/root/testdata/sf0.001"
ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "a b " * 40), (4, "a b " * 40), (None, "a b " * 40), (-7, "x " * 20 + "<P>"), (2**62, "É\x0b字 " * 9)]


def rows(names, records):
    at = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(repr(round(r[i], 6)) if isinstance(r[i], float) else str(r[i]) for i in at) for r in records)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, duck, name):
    df, cursor = queries.QUERIES[name](spark, DATA), duck.execute(queries.SQL[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(df.columns) and rows(df.columns, df.collect()) == rows(names, cursor.fetchall())


@pytest.mark.parametrize("name", ["op11_substring_dedup", "op12_periodic_runs", "op13_fill_in_middle"])
def test_odd_rows_have_the_results_of_sql(spark, tmp_path, name):
    docs = spark.createDataFrame(ODD, "doc_id long, text string").withColumn("runs", F.lit(1)).withColumn("output", F.lit(2))
    docs.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    df, cursor = queries.QUERIES[name](spark, str(tmp_path)), con.execute(queries.SQL[name])
    found, wanted = df.collect(), cursor.fetchall()
    assert len(found) == len(ODD) and rows(df.columns, found) == rows([c[0] for c in cursor.description], wanted)
    assert {middle.op13_fill_in_middle, runs.op12_periodic_runs, recompression.op11_substring_dedup} <= set(queries.QUERIES.values())
