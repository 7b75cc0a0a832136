"""Quality scores by a regularised quadratic discriminant over document statistics.

Each text gives a few transformed statistics: shares of kinds of bytes, lengths
and repetition of words and lines. The labelled rows give, per class, a mean and
a covariance, shrunk towards the diagonal of the pooled one. A score is the
logistic of the difference of log densities (Mahalanobis distances by cached
Cholesky factors) plus the classes' log odds, cooled by the number of statistics.

Defined results: null and empty texts have statistics of their own (all 0) and
are scored like any other; labels that are null or whose document is missing are
left out; several labels of one document count each; with no rows of one class
every score is the share of label 1 in what there is, 0.5 without any; a null id
is in the part that is learned from, but joins no label; repeated rows are scored
each; columns beside doc_id and text are passed on untouched by ``kept``.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.common import Powers, byte_values, crc_bucket, separators, sigmoid, slices, stored, table, words

#: Kinds of bytes whose shares are statistics; others (spaces) only count for the length.
KINDS = ("lower", "upper", "digit", "point", "shout", "bar", "symbol", "line", "high")
STATISTICS = (*KINDS, "n_words", "word_length", "word_spread", "new_words", "new_lines", "line_words")
SHRINK, RIDGE = 0.1, 1e-3


def byte_kinds() -> np.ndarray:
    """The place of each byte's kind in KINDS; len(KINDS) for none."""
    out = np.full(256, len(KINDS), dtype=np.int64)
    for kind, members in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:?'\"()-", b"!", b"|", b"*%&$#@~^=+<>/\\_{}[]`", b"\n")):
        out[list(members)] = kind
    out[128:] = KINDS.index("high")
    return out


def distinct_share(doc: np.ndarray, hashes: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Distinct hashes of each document over its count; 0 where there are none."""
    order = np.lexsort((hashes, doc))
    doc, hashes = doc[order], hashes[order]
    first = np.ones(len(doc), dtype=bool)
    first[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
    return np.bincount(doc[first], minlength=len(count)) / np.maximum(count, 1)


def statistics(column: pa.Array, powers: Powers) -> np.ndarray:
    """A row of STATISTICS for each text."""
    kinds, values, blank, rows = byte_kinds(), byte_values(lower=True), separators(), []
    newline = np.zeros(256, dtype=bool)
    newline[0x0A] = True
    for part in slices(column):
        n = len(part.starts)
        size = part.ends - part.starts
        doc = np.repeat(np.arange(n, dtype=np.int64), size)
        counts = np.bincount(doc * (len(KINDS) + 1) + kinds[part.data], minlength=n * (len(KINDS) + 1)).reshape(n, -1)[:, : len(KINDS)]
        found, lines = words(part, values, blank, powers), words(part, values, newline, powers)
        n_words, n_lines = np.diff(found.bounds), np.diff(lines.bounds)
        total = np.bincount(found.doc, found.length, minlength=n)
        mean = total / np.maximum(n_words, 1)
        square = np.bincount(found.doc, found.length.astype(float) ** 2, minlength=n) / np.maximum(n_words, 1)
        rows.append(
            np.column_stack([
                np.sqrt(counts / np.maximum(size, 1)[:, None]),
                np.log1p(n_words),
                np.log1p(mean),
                np.log1p(np.sqrt(np.maximum(square - mean**2, 0))),
                distinct_share(found.doc, found.hash, n_words),
                distinct_share(lines.doc, lines.hash, n_lines),
                np.log1p(n_words / np.maximum(n_lines, 1)),
            ])
        )
    return np.concatenate(rows) if rows else np.zeros((0, len(STATISTICS)))


def with_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, statistics...) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            found = statistics(batch["text"], powers)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["held_out"], *(pa.array(x) for x in found.T)], names=["doc_id", "held_out", *STATISTICS])

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, " + ", ".join(f"{x} double" for x in STATISTICS)
    return docs.select("doc_id", "text", (crc_bucket("doc_id", 3) == 1).alias("held_out")).mapInArrow(run, schema)


class Discriminant(NamedTuple):
    """Per class the log prior, the mean and the inverse Cholesky factor; prior: the score without a class."""

    means: list[np.ndarray]
    factors: list[np.ndarray]
    constants: list[float]
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.means:
            return np.full(len(x), self.prior)
        densities = [c - 0.5 * np.square((x - m) @ f.T).sum(axis=1) for m, f, c in zip(self.means, self.factors, self.constants, strict=True)]
        return sigmoid((densities[1] - densities[0]) / np.sqrt(x.shape[1]))


def fit(labelled: DataFrame, label: str) -> Discriminant:
    """From the sums of the statistics and of their products, per class, over all labelled rows."""
    k = len(STATISTICS)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    sums = [F.sum(x).alias(f"s{i}") for i, x in enumerate(STATISTICS)]
    products = [F.sum(F.col(STATISTICS[i]) * F.col(STATISTICS[j])).alias(f"p{i}_{j}") for i, j in pairs]
    rows = {r[label]: r for r in labelled.filter(F.col(label).isin(0, 1)).groupBy(label).agg(F.count("*").alias("n"), *sums, *products).collect()}  # two rows
    total = sum(r["n"] for r in rows.values())
    prior = rows[1]["n"] / total if 1 in rows else 0.0 if total else 0.5
    if len(rows) < 2:
        return Discriminant([], [], [], prior)
    means, covariances = [], []
    for c in (0, 1):
        r, n = rows[c], rows[c]["n"]
        mean, product = np.array([r[f"s{i}"] for i in range(k)]) / n, np.zeros((k, k))
        for i, j in pairs:
            product[i, j] = product[j, i] = r[f"p{i}_{j}"] / n
        means.append(mean)
        covariances.append(product - np.outer(mean, mean))
    pooled = np.diag(sum(rows[c]["n"] * np.diag(covariances[c]) for c in (0, 1)) / total)
    factors, constants = [], []
    for c in (0, 1):
        shrunk = (1 - SHRINK) * covariances[c] + SHRINK * pooled + RIDGE * np.eye(k)
        cholesky = np.linalg.cholesky(shrunk)
        factors.append(np.linalg.inv(cholesky))
        constants.append(float(np.log(rows[c]["n"] / total) - np.log(np.diag(cholesky)).sum()))
    return Discriminant(means, factors, constants, prior)


def score(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """(doc_id, held_out, score) of every row of docs."""
    found = stored(with_statistics(docs))
    known = labels.select(F.col("doc_id").alias("__doc_id"), F.col(label).alias("__label"))
    model = fit(found.filter("not held_out").join(known, F.col("doc_id") == F.col("__doc_id")), "__label")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.column_stack([batch[name].to_numpy() for name in STATISTICS])
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["held_out"], pa.array(model.score(x))], names=["doc_id", "held_out", "score"])

    return found.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double")


def kept(docs: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of docs whose score is at least least. Rows without an id are judged, too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            yield batch.filter(pa.array(model.score(statistics(batch["text"], powers)) >= least))

    known = labels.select(F.col("doc_id").alias("__doc_id"), F.col("quality").alias("__label"))
    train = docs.filter(crc_bucket("doc_id", 3) != 1)
    model = fit(with_statistics(train).join(known, F.col("doc_id") == F.col("__doc_id")), "__label")
    return docs.mapInArrow(run, docs.schema)


def op5_quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
