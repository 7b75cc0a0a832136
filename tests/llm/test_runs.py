"""Periodic runs against a plain search of every period."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigil.llm import runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words, least=6, exponent=4):
    """Every stretch in which words q apart agree, for every q; of one stretch the smallest q."""
    found = {}
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, exponent * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted(((a, n, q) for (a, n), q in found.items()), key=lambda x: (x[0], x[2]))


def collapsed(words, found):
    gone = {i for a, n, q in found for i in range(a + q, a + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def planted(doc_id, text):
    words = WORD.findall(text or "")
    if doc_id is None or not words or zlib.crc32(str(doc_id).encode()) % 10:
        return words
    g, n = zlib.crc32(str(doc_id).encode()) // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def periodic_text(rng):
    out = []
    for _ in range(rng.randint(0, 6)):
        out += [rng.choice("abc") for _ in range(rng.randint(0, 12))]
        unit = [rng.choice("ab") for _ in range(rng.randint(1, 17))]
        out += (unit * rng.randint(1, 9))[: rng.randint(1, 120)]
    return " ".join(out)


def test_runs_equal_a_plain_search(spark):
    rng = random.Random(3)
    texts = [None, "", " \n\t", "a", "a a a a a", "a a a a a a", "A a A a A a A a", "x " * 40_000, "ä ö " * 5, *(periodic_text(rng) for _ in range(400))]
    docs = spark.createDataFrame([(None if i == 3 else i // 2, t) for i, t in enumerate(texts)], "doc_id long, text string").withColumn("runs", F.lit(1)).withColumn("found", F.lit("x"))
    found = runs.periodic_runs(docs).collect()
    assert len(found) == len(texts)
    wanted = []
    for i, t in enumerate(texts):
        words = WORD.findall(t or "")
        of = plain_runs(words) if len(words) < 5_000 else [(0, len(words), 1)]
        wanted.append((None if i == 3 else i // 2, len(words), of, collapsed(words, of)))
    assert sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in found), key=str) == sorted(wanted, key=str)


@pytest.mark.parametrize(("least", "exponent"), [(6, 4), (2, 4), (30, 5)])
def test_runs_of_many_texts_at_once(least, exponent):
    rng = random.Random(least)
    texts = [[rng.randint(0, 2) for _ in range(rng.randint(0, 60))] * rng.randint(1, 6) for _ in range(200)]
    ids = np.concatenate([[*t, -1 - i] for i, t in enumerate(texts)]).astype(np.int64)
    at, wanted = 0, []
    for t in texts:
        wanted += [(at + a, n, q) for a, n, q in plain_runs(t, least, exponent)]
        at += len(t) + 1
    assert [tuple(map(int, x)) for x in runs.runs_of(ids, least, exponent)] == wanted


def test_fewer_than_four_periods_are_refused(spark):
    with pytest.raises(ValueError, match="four periods"):
        runs.periodic_runs(spark.createDataFrame([], "doc_id long, text string"), exponent=3)


def test_query_equals_a_plain_search(spark):
    sf = "/root/testdata/sf0.001"
    found = {r.doc_id: r for r in runs.op12_periodic_runs(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(found) == len(docs)
    for d in docs:
        words, r = planted(d.doc_id, d.text), found[d.doc_id]
        of = plain_runs(words)
        best = max(of, key=lambda x: (x[1], -x[0], -x[2]), default=None)
        digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
        assert r.n_runs == len(of) and (r.start, r.length, r.period) == (best or (None,) * 3)
        assert r.exponent_milli == (best and 1000 * best[1] // best[2])
        assert r.runs_sha256 == digest("".join(f"{a},{n},{q}\n" for a, n, q in of)) and r.collapsed_sha256 == digest(collapsed(words, of))
    assert sum(r.n_runs > 0 for r in found.values()) > 5


def test_nothing_gives_nothing(spark):
    assert runs.periodic_runs(spark.createDataFrame([], "doc_id long, text string")).count() == 0
