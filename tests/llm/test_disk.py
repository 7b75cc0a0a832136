"""What op9's lookups keep on disk at a time."""

import numpy as np
import pyarrow as pa
from test_llm import DATA
from test_requests import Frame

from vigil.llm import bigrams, lm


def test_bytes_of_a_request(monkeypatch):
    """Requests of one block, most of whose pairs are asked once, over eight buckets."""
    layout = bigrams.Layout(8, 16, np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), 10**7, 10**6)
    head = bigrams.Head(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0), -9.0, layout)
    monkeypatch.setattr(bigrams, "sent", lambda spark, value: value)
    monkeypatch.setattr(bigrams, "received", lambda value: value)
    monkeypatch.setattr(bigrams, "TaskContext", type("", (), {"get": lambda: type("", (), {"partitionId": lambda self: 0})()}))
    random = np.random.default_rng(1)
    text = [" ".join(map(str, random.integers(0, 5000, 500))) for _ in range(400)]
    batch = pa.record_batch({"doc_id": pa.array(np.arange(400)), "held_out": pa.array([False] * 400), "text": pa.array(text)})
    rows = pa.Table.from_batches(bigrams.asked_of(Frame(), head, bigrams.REQUEST)(iter([batch])))
    size = sum(len(x) for c in "abc" for x in rows[c].to_pylist())
    assert size / (400 * 501) < 8, size / (400 * 501)


def test_numbers_are_what_was_packed():
    for x in (np.zeros(0, np.uint32), np.arange(7, dtype=np.uint32) << 20, np.arange(-3, 4), np.linspace(-1e9, 1e-9, 11), np.array([2**64 - 1], np.uint64), np.arange(9)[::2]):
        y = bigrams.unpacked(bigrams.packed(x), x.dtype)
        assert y.dtype == x.dtype and np.array_equal(x, y)


def test_one_walk_asks_and_nothing_asked_is_kept(spark, monkeypatch):
    """The lookups walk the texts once; what the last turn asked is not stored beside the seating; counts go when gains are there."""
    states, kept = [], []
    monkeypatch.setattr(bigrams, "seating", lambda train, layout, own=bigrams.seating: states.append(own(train, layout)) or states[-1])
    monkeypatch.setattr(bigrams, "stored", lambda df, own=bigrams.stored: kept.append(own(df)) or kept[-1])
    monkeypatch.setattr(lm, "HEAD", 60)
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(30)
    found = bigrams.score(docs)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 2  # the other one deals words out
    (state,), base = states, spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    folder = state.seated.inputFiles()[0].rsplit("/", 1)[0]
    assert {r.kind for r in spark.read.parquet(folder).select("kind").distinct().collect()} == {bigrams.SEATED}
    path = base(kept[0].inputFiles()[0])  # of the counts
    assert not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    assert found.count() == 30
