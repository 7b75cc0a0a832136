"""Substring removal by recompression against a plain search of all windows."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigil.llm import recompression

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(rows, width=13):
    rows = [(i, WORD.findall(t or "")) for i, t in rows]
    place = lambda i: 2**63 if i is None else i
    first = {}
    for i, w in rows:
        for a in range(len(w) - width + 1):
            key = tuple(w[a : a + width])
            first[key] = min(first.get(key, 2**64), place(i))
    out = []
    for i, w in rows:
        gone = {b for a in range(len(w) - width + 1) if first[tuple(w[a : a + width])] < place(i) for b in range(a, a + width)}
        out.append((i, len(w), len(gone), " ".join(x for b, x in enumerate(w) if b not in gone)))
    return sorted(out, key=str)


def found(df, **options):
    return sorted(map(tuple, recompression.without_repeats(df, **options).collect()), key=str)


def texts(seed):
    """Texts of few and of many different words, with shared passages of all lengths, runs, copies and near copies."""
    rng = random.Random(seed)
    shared = [[rng.choice("abcdefgh") + str(rng.randint(0, 40)) for _ in range(rng.choice((12, 13, 14, 30, 80, 400, 1500)))] for _ in range(12)]
    out = []
    for _ in range(120):
        words = []
        for _ in range(rng.randint(0, 6)):
            kind = rng.random()
            words += [rng.choice("ab")] * rng.randint(0, 40) if kind < 0.2 else rng.choice(shared) if kind < 0.6 else [str(rng.randint(0, 10**6)) for _ in range(rng.randint(0, 60))]
        if out and rng.random() < 0.2:
            words = list(rng.choice(out))
            if words and rng.random() < 0.5:
                words[rng.randrange(len(words))] = "other"
        out.append(words)
    return [" ".join(w) for w in out]


@pytest.mark.parametrize(("seed", "chunk", "bucket", "width"), [(1, 1_000_000, 1 << 18, 13), (2, 2_000, 50, 13), (3, 1, 200, 13), (4, 20_000, 1_000, 3), (5, 3_000, 300, 40)])
def test_removed_words_are_those_of_a_plain_search(spark, monkeypatch, seed, chunk, bucket, width):
    monkeypatch.setattr(recompression, "CHUNK", chunk)
    monkeypatch.setattr(recompression, "BUCKET", bucket)
    rows = [(None if i % 50 == 7 else i * 7 % 101, t) for i, t in enumerate(texts(seed))]
    rows += [(900, None), (901, ""), (902, " \n\t"), (903, "one two"), (904, "x " * 30_000), (905, "x " * 13 + "y"), (905, "x " * 13 + "y"), (906, rows[0][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("chunk", F.lit("x")).withColumn("n_words", F.lit("y")).repartition(3)
    assert found(docs, width=width) == plain(rows, width)


def test_given_documents_equal_a_plain_search(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    wanted = plain([(r.doc_id, r.text) for r in docs.collect()])
    assert found(docs) == wanted and sum(r[2] for r in wanted) > 1_000


def test_nothing_gives_nothing(spark):
    assert recompression.without_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_windows_have_equal_names_where_their_words_are_equal():
    rng = np.random.default_rng(3)
    for most in (2, 4, 50):
        ids = rng.integers(1, most, 3_000).astype(np.uint64)
        doc = np.sort(rng.integers(0, 20, len(ids)))
        compressed = [t for t, *_ in zip((t for t, *_ in recompression.turns(recompression.mix64(ids), doc)), range(20))]
        starts = np.flatnonzero(doc[:-12] == doc[12:])
        names = recompression.window_names(compressed, starts, 13)
        groups = {}
        for name, a in zip(names.tolist(), starts):
            groups.setdefault(tuple(ids[a : a + 13].tolist()), set()).add(name)
        assert all(len(x) == 1 for x in groups.values()) and len(set(names.tolist())) == len(groups)


def test_high_symbols_cover_copies():
    """Of a passage of 3,000 words in other surroundings, most words lie in symbols that both copies have."""
    rng = np.random.default_rng(4)
    passage = rng.integers(0, 10**6, 3_000)
    one, other = (np.concatenate([rng.integers(0, 10**6, n), passage, rng.integers(0, 10**6, n)]).astype(np.uint64) for n in (40, 700))
    names = []
    for x in (one, other):
        steps = recompression.turns(recompression.mix64(x), np.zeros(len(x), dtype=np.int64))
        for _, (_, symbols, start) in zip(range(16), steps):
            pass
        names.append(dict(zip(symbols.tolist(), np.diff(np.append(start, len(x))).tolist())))
    assert sum(n for s, n in names[0].items() if s in names[1]) > 2_000
