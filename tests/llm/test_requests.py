"""What waits for a block of requests to be full, in a task of op9's lookups."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from vigil.llm import bigrams


class Frame:
    """Hands over what is passed to mapInArrow."""

    sparkSession, schema = None, {"doc_id": type("", (), {"dataType": type("", (), {"simpleString": lambda self: "long"})()})}

    def mapInArrow(self, run, schema):
        return run


@pytest.mark.parametrize("wanted, most", [(bigrams.REQUEST, 60), (bigrams.ASKED, 20)])
def test_bytes_a_token_of_a_block(monkeypatch, wanted, most):
    layout = bigrams.Layout(16, 16, np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), 10**7, 10**6)
    head = bigrams.Head(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0), -9.0, layout)
    monkeypatch.setattr(bigrams, "sent", lambda spark, value: value)
    monkeypatch.setattr(bigrams, "received", lambda value: value)
    monkeypatch.setattr(bigrams, "TaskContext", type("", (), {"get": lambda: type("", (), {"partitionId": lambda self: 0})()}))
    text = [" ".join(str(k % 5000) for k in range(i, i + 2000)) for i in range(400)]
    batches = [pa.record_batch({"doc_id": pa.array([i]), "held_out": pa.array([False]), "text": pa.array([t])}) for i, t in enumerate(text)]
    tokens = 400 * 2001
    if wanted == bigrams.ASKED:  # all words are of the head
        keys = np.unique(np.concatenate([w for b in batches for _, w, _, _ in bigrams.paths(b["text"], bigrams.Powers())]))
        head = head._replace(words=keys, counts=np.ones(len(keys), np.int64), gains=np.zeros(len(keys)))
    run = bigrams.asked_of(Frame(), head, wanted)
    tracemalloc.start()
    rows = pa.Table.from_batches(run(iter(batches)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    docs = [np.frombuffer(bigrams.unpacked(x, np.uint32), np.uint32) for x in rows["c"].to_pylist()]
    assert sum(len(x) for x in docs) == (tokens if wanted == bigrams.REQUEST else 0)
    assert peak / tokens <= most, peak / tokens
