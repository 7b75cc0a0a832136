"""Exact top-k by integer inner product, pruned by segment statistics from coarse to fine.

Vectors are cut into segments; of each segment a row keeps its mean and its
deviation. With n_s components in segment s, ||q - x||^2 is at least
sum n_s * ((mean difference)^2 + (deviation difference)^2), and the inner product,
(||q||^2 + ||x||^2 - ||q - x||^2) / 2, at most half the squared norms less half of
that. Queries meet the rows in blocks. In a block, the rows with the largest
coarse bounds are scored first and give each query a threshold: its k-th score.
Rows whose bound is below it go, level by level; the survivors are scored exactly.
Only rows whose bound shows that they cannot be among the k are left out.

Defined results: vectors that are null, empty, or hold null or non-finite
components take no part, nor do null ids; a query meets the rows with as many
components as it has; ties go to the smaller vec_id; a row that repeats a query's
id is the query's own and no candidate; repeated rows of other ids count each;
columns beside vec_id and embedding take no part. Scores are exact as long as they
fit 64 bits.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.common import stored, table
from vigil.llm.vectors import BLOCK, QUERY_BLOCK, best, is_query, usable

#: Segments of each level, coarse to fine.
LEVELS = (4, 8, 16)


def segment_features(x: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of the segments, each times the root of its length: inner products of two rows of these bound theirs."""
    parts = np.array_split(np.arange(x.shape[1]), min(segments, x.shape[1]))
    means = np.column_stack([x[:, p].mean(axis=1) * np.sqrt(len(p)) for p in parts])
    deviations = np.column_stack([x[:, p].std(axis=1) * np.sqrt(len(p)) for p in parts])
    return np.concatenate([means, deviations], axis=1)


def upper_bounds(q: np.ndarray, x: np.ndarray, segments: int) -> np.ndarray:
    """Upper bounds of inner products, from the lower bound of the squared distance."""
    a, b = segment_features(q, segments), segment_features(x, segments)
    norms_q, norms_x = np.square(q).sum(axis=1)[:, None], np.square(x).sum(axis=1)[None, :]
    least = np.square(a).sum(axis=1)[:, None] + np.square(b).sum(axis=1)[None, :] - 2 * (a @ b.T)
    return (norms_q + norms_x - least) / 2 + 1e-9 * (norms_q + norms_x + 1)


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products: by doubles if no sum can leave their whole numbers, else by 64-bit integers."""
    if q.size and x.size and np.abs(q).max() * np.abs(x).max() * q.shape[1] < 2**53:
        return (q @ x.T).astype(np.int64)
    return q.astype(np.int64) @ x.astype(np.int64).T


def block_best(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> list[list[tuple[int, int]]]:
    """For each query the k best (score, vec_id) of the block, own id left out."""
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], x[order]
    own = q_ids[:, None] == ids[None, :]
    bounds = upper_bounds(q, x, LEVELS[0])
    bounds[own] = -np.inf
    first = min(len(ids), 4 * k)
    seeds = np.argpartition(-bounds, first - 1, axis=1)[:, :first]
    exact = np.array([products(q[i : i + 1], x[seeds[i]])[0] for i in range(len(q))]).astype(float)
    exact[np.take_along_axis(own, seeds, axis=1)] = -np.inf
    threshold = np.sort(exact, axis=1)[:, -k] if first >= k else np.full(len(q), -np.inf)
    open_ = (bounds >= threshold[:, None]) & ~own
    for segments in LEVELS[1:]:
        if open_.mean() < 0.01:
            break
        open_ &= upper_bounds(q, x, segments) >= threshold[:, None]
    out = []
    for i in range(len(q)):
        left = np.flatnonzero(open_[i])
        scores = products(q[i : i + 1], x[left])[0]
        top = np.lexsort((ids[left], -scores))[:k]
        out.append([(int(scores[t]), int(ids[left[t]])) for t in top])
    return out


def top_k(vectors: DataFrame, every: int, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score) for the queries, whose vec_id is divisible by every."""
    whole = stored(usable(vectors).select("vec_id", F.transform("vector", lambda x: F.floor(x * 1024).cast("double")).alias("vector"), F.size("vector").alias("dim")))
    total, asked = whole.agg(F.count("*"), F.count_if(is_query(every))).first()
    blocks, query_blocks = max(1, ceil(total / BLOCK)), max(1, ceil(asked / QUERY_BLOCK))
    # ids mixed with the vector: one id many times does not fill one block
    rows = whole.withColumn("block", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(blocks))).withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    queries = whole.filter(is_query(every)).withColumn("query_block", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(query_blocks)).cast("int"))
    queries = queries.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    key = ["dim", "query_block", "block"]

    def search(asked: pa.Table, held: pa.Table) -> pa.Table:
        ids, found = [], []
        if len(asked) and len(held):
            q, x = (np.array(t["vector"].combine_chunks().flatten()).reshape(len(t), -1) for t in (asked, held))
            ids = asked["vec_id"].to_numpy()
            found = block_best(ids, q, held["vec_id"].to_numpy(), x, k)
        lists = [[{"score": s, "vec_id": v} for s, v in row] for row in found]
        return pa.table([pa.array(ids, pa.int64()), pa.array(lists, pa.list_(pa.struct([("score", pa.int64()), ("vec_id", pa.int64())])))], names=["query_id", "found"])

    found = queries.groupBy(*key).cogroup(rows.groupBy(*key)).applyInArrow(search, "query_id long, found array<struct<score:long,vec_id:long>>")
    return best(found, k)


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), every=100, k=10)


OP6_SQL = """
    WITH ok AS (
      SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
      WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    pairs AS (
      SELECT q.vec_id AS query_id, x.vec_id, list_inner_product(q.v, x.v)::BIGINT AS score
      FROM ok q JOIN ok x ON q.vec_id % 100 = 0 AND q.vec_id <> x.vec_id AND len(q.v) = len(x.v)),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM pairs)
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10"""
