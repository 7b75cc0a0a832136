"""The fill-in-the-middle transformation and its wavelet matrix against plain Python."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigil.llm import middle
from vigil.llm.wavelet import WaveletMatrix

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
EDGES = [
    (1, None), (2, ""), (3, " \n\t"), (4, "one two  "), (4, "one two  "), (5, "\n\nÉÉ 字 z\x0b"), (None, "no id here at all"), (7, "word " * 60_000), (8, "a <S> mark"), (9, "x"), (10, "a< b<S c <P"),
    *((i, "ä b\tc\nd <e f> " * (i % 7) + "<" * (i % 3)) for i in range(11, 150)),
]


def plain(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"42:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return doc_id, len(units), "plain", None, None, text
    if h[3] % 100 < 80:
        return doc_id, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def ordered(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize("rows", [EDGES, None])
def test_transformation_equals_plain_python(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string") if rows else spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    done = middle.fill_in_middle(docs)
    found = done.select("doc_id", "units", "form", "prefix_chars", "middle_chars", "output").collect()
    assert ordered(map(tuple, found)) == ordered(plain(r.doc_id, r.text) for r in docs.collect())
    assert {r.form for r in found} == {"plain", "spm", "psm"}
    assert done.filter(middle.restored(F.col("output"), F.col("form")) != F.col("text")).isEmpty()


@pytest.mark.parametrize("level", middle.LEVELS)
def test_levels_cut_at_their_boundaries(spark, level):
    text = "one two\n\nthree  four\nfive "
    docs = spark.range(200).selectExpr("id as doc_id", f"'{text}' as text", "'x' as form", "1 as cut")
    done = middle.fill_in_middle(docs, level, rate=100).collect()
    ends = {"word": [m.end() for m in UNIT.finditer(text)], "line": [8, 9, 21, 26], "character": range(1, 27)}[level]
    assert all(r.units == len(ends) and {r.prefix_chars, r.prefix_chars + r.middle_chars} <= {0, *ends} for r in done)
    assert {r.prefix_chars for r in done} == {0, *ends}


def test_nothing_gives_nothing(spark):
    assert middle.fill_in_middle(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_queries_of_the_matrix_are_those_of_a_scan():
    rng = np.random.default_rng(5)
    for n, most in ((1, 1), (64, 5), (300, 300), (129, 1000)):
        values = rng.integers(0, most, n)
        matrix = WaveletMatrix(values, 10)
        a, b = np.sort(rng.integers(0, n + 1, (2, 400)), axis=0)
        limit = rng.integers(0, 1000, 400)
        parts = [values[i:j] for i, j in zip(a, b)]
        assert matrix.count(int(values[0]), a, b).tolist() == [int((p == values[0]).sum()) for p in parts]
        assert matrix.below(limit, a, b).tolist() == [int((p < x).sum()) for p, x in zip(parts, limit)]
        assert matrix.successor(limit, a, b).tolist() == [min(p[p >= x], default=-1) for p, x in zip(parts, limit)]
        assert matrix.predecessor(limit, a, b).tolist() == [max(p[p < x], default=-1) for p, x in zip(parts, limit)]
        full = b > a
        k = rng.integers(0, 1 << 30, 400)[full] % (b - a)[full]
        assert matrix.smallest(k, a[full], b[full]).tolist() == [int(np.sort(p)[i]) for p, i in zip((p for p in parts if len(p)), k)]
