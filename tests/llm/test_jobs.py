"""The driver keeps something of every job: how many the near-duplicate join takes, with the check tool's settings."""

from contextlib import contextmanager

import pytest
from test_llm import DATA

from vigil.llm import components as labels
from vigil.llm import ngram_join


@contextmanager
def small_broadcasts(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "256k")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def jobs(spark) -> int:
    return spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs()


@pytest.mark.parametrize("few", [200_000, 0])
def test_components_with_and_without_broadcasts(spark, monkeypatch, few):
    monkeypatch.setattr(labels, "FEW", few, raising=False)
    path, star = [(i, i + 1) for i in range(100, 140)], [(7, i) for i in range(300, 330)]
    edges = [*path, *star, (310, 5), (50, 50), (60, 61), (61, 60), (60, 61)]
    with small_broadcasts(spark):
        found = labels.components(spark.createDataFrame(edges, "a long, b long"))
        assert {(r.node, r.component) for r in found.collect()} == (
            {(i, 100) for i in range(100, 141)} | {(i, 5) for i in (5, 7, *range(300, 330))} | {(50, 50), (60, 60), (61, 60)}
        )


def test_near_duplicates_in_few_jobs(spark, monkeypatch):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    docs = docs.unionByName(docs.limit(200).selectExpr("doc_id + 1000000 as doc_id", "concat(text, ' one more') as text"), allowMissingColumns=True)
    with small_broadcasts(spark):
        before = jobs(spark)
        first = {tuple(r) for r in ngram_join.near_duplicates(docs, 3, 90).collect()}
        assert jobs(spark) - before <= 75
        monkeypatch.setattr(labels, "FEW", 0)
        monkeypatch.setattr(ngram_join, "FEW_LABELS", 0)
        assert {tuple(r) for r in ngram_join.near_duplicates(docs, 3, 90).collect()} == first
        assert any(c < i for i, _, c in first)
