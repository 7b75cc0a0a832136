"""The model of all words against plain counts and loops."""

import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from test_llm import DATA, DOCS, EDGES, remainder, tokens

from vigil.llm import bigrams, lm
from vigil.llm.common import Powers


@pytest.mark.parametrize("bucket, head", [(1_000_000, 2**19), (400, 60)])
def test_every_word_is_a_dish_and_a_context(spark, monkeypatch, bucket, head):
    """Counts, tables, base and score of all words and pairs by plain loops; with small buckets frequent contexts are dealt out."""
    states = []
    monkeypatch.setattr(bigrams, "seating", lambda train, layout, own=bigrams.seating: states.append((own(train, layout), layout)) or states[-1][0])
    monkeypatch.setattr(bigrams, "BUCKET", bucket)
    monkeypatch.setattr(lm, "HEAD", head)
    rows = [(r.doc_id, [*tokens(r.text), ""], r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").limit(80).collect()]
    found = {r.doc_id: r for r in bigrams.score(spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id long, text string")).collect()}
    count, pairs = Counter(), Counter()
    for i, x, _ in rows:
        if remainder(i, 10):
            count.update(x)
            pairs.update(zip(["", *x[:-1]], x, strict=True))
    n, v = sum(count.values()), len(count)
    assert len(count) > lm.CLASSES + 100 and len(found) == len(rows)

    (state, layout), = states
    assert len(layout.hot) == sum(c > bucket for c in count.values())
    key = {w: int(next(lm.word_keys(pa.array([w], pa.string()), Powers()))[0][0]) if w else 0 for _, x, _ in rows for w in x}
    seen, parent = {}, {}
    for part in state.pairs.unionByName(state.seated).unionByName(state.answers.filter("bucket >= 0")).toPandas().groupby("bucket"):
        table = {c: part[1][c].tolist() for c in bigrams.NAMES}
        table["who"] = [None if x != x else int(x) for x in table["who"]]
        room = bigrams.Room(table, layout, state.totals)
        p = room.parents(table, state.uniform, state.over)
        parent |= zip(room.words.tolist(), p.tolist(), strict=True)
        for u, w, c, t in zip(room.contexts[room.at].tolist(), room.words[room.word].tolist(), room.n.tolist(), room.t.tolist(), strict=True):
            assert (u, w) not in seen and 1 <= t <= c
            seen[u, w] = c, t
    assert {k: c for k, (c, _) in seen.items()} == {(key[u], key[w]): c for (u, w), c in pairs.items()}
    unknown = state.uniform / state.over
    assert set(parent) == {key[w] for w in count} and sum(parent.values()) + unknown == pytest.approx(1)
    customers, tables, of_word = Counter(), Counter(), Counter()
    for (u, w), (c, t) in seen.items():
        customers[u] += c
        tables[u] += t
        of_word[w] += t
    assert sum(of_word.values()) + lm.PARENT[1] == pytest.approx(state.over)
    assert any(t < c for c, t in seen.values()) and any(t > 1 for _, t in seen.values())

    (d, theta), better = lm.CONTEXT, 0.0

    def chance(u, w):
        c, t = seen.get((u, w), (0, 0))
        return (c - d * t + (theta + d * tables[u]) * parent.get(w, unknown)) / (theta + customers[u])

    for u in list(customers)[:5]:
        assert sum(chance(u, w) for w in parent) + chance(u, -1) == pytest.approx(1)
    for i, x, _ in rows:
        r = found[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (remainder(i, 10) == 0, len(x), sum(count[w] > 0 for w in x), n)
        assert r.base_score == pytest.approx(sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in x), rel=1e-9)
        assert r.score == pytest.approx(sum(math.log10(chance(key[u], key[w])) for u, w in zip(["", *x[:-1]], x, strict=True)), rel=1e-9)
        better += r.score - r.base_score if r.held_out else 0.0
    assert better > 0


def test_tables_of_pairs_are_those_of_a_plain_restaurant():
    """Mean tables of a context whose pairs are drawn as a bucket draws them, against lm's sampler."""
    layout = bigrams.Layout(16, 16, np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), 0, 0)
    n, words = np.array([6, 3, 1, 25], dtype=np.uint32), np.arange(1, 5, dtype=np.uint64)
    own = np.array([7, 4], dtype=np.uint64)
    row = {"bucket": [0], "kind": [bigrams.PAIRS], "who": [None], "a": [bigrams.packed(own)], "b": [bigrams.packed(np.arange(4, dtype=np.uint32))], "c": [bigrams.packed(n)], "d": [bigrams.packed(words)]}
    parent = np.array([0.1, 0.3, 0.05, 0.2])
    room, mean = bigrams.Room(row, layout, np.zeros(0)), np.zeros(4)
    other, plain = lm.Restaurant(n.astype(float), lm.CONTEXT, lm.stirling_once(lm.CONTEXT[0]), 1), np.zeros(4)
    for turn in range(-50, 3000):
        room.sweep(parent, turn + 50)
        other.sweep(parent)
        mean += room.t / 3000 if turn >= 0 else 0
        plain += other.t / 3000 if turn >= 0 else 0
    assert mean == pytest.approx(plain, rel=0.05)


def test_scores_are_of_the_mean_of_samples(spark, monkeypatch):
    """Tables of pairs are means over the last turn's seatings, and so are those that the parent's are drawn for."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(40).select("doc_id", "text")
    tables, own = [], bigrams.seating
    monkeypatch.setattr(bigrams, "seating", lambda train, layout: tables.append((own(train, layout), layout)) or tables[-1][0])
    assert all(math.isfinite(r.score) for r in bigrams.score(docs).collect())
    (state, layout), = tables
    found = []
    for row in state.seated.collect():
        assert row["d"][0] == bigrams.SAMPLES > 1
        found.append(bigrams.unpacked(row["a"], np.uint32) / row["d"][0])
    t = np.concatenate(found)
    assert t.min() >= 1 and np.any(t != np.round(t))
    assert t.sum() + lm.PARENT[1] == pytest.approx(state.over)


def test_edges_and_nothing(spark):
    rows = bigrams.score(spark.createDataFrame(EDGES, DOCS)).collect()
    assert len(rows) == len(EDGES) and all(math.isfinite(r.score) and r.score <= 0 for r in rows)
    assert [r.n_tokens for r in rows if r.doc_id in (1, 2, 3)] == [1, 1, 1]
    assert bigrams.score(spark.createDataFrame([], DOCS)).count() == 0
