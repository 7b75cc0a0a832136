"""Approximate nearest neighbours by learned partitions.

A bounded sample of vectors gives a neighbour graph, which is cut into balanced
parts: breadth-first growth from spread seeds, then rounds in which each vertex
moves to the part of most of its neighbours while that part has room. A softmax
classifier of the vectors learns the parts. Every row is indexed in the part that
the classifier finds most probable, and a query meets the rows of its PROBES most
probable parts; those are reranked by exact inner products. Parts that hold many
rows are dealt into blocks, so that a hot part is many tasks.

Defined results: vectors that are null, empty, zero, or hold null or non-finite
components take no part, nor do null ids; a query meets rows with as many
components as it has (an index is fitted per number of components, of the ones in
the sample; rows of others are in part 0 of theirs); ties go to the smaller
vec_id; a row that repeats a query's id is its own; where the parts probed hold
fewer than k rows, all parts are searched; columns beside vec_id and embedding
take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.common import stored, table
from vigil.llm.vectors import BLOCK, QUERY_BLOCK, best, is_query, usable

#: Vectors that the partition is fitted on at most; neighbours of each in the graph.
SAMPLE, NEIGHBOURS = 4000, 10
#: Parts, and how many of them a query probes.
PARTS, PROBES = 32, 24


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def neighbour_graph(x: np.ndarray, n: int) -> np.ndarray:
    """The n rows of largest inner product of each row, as [rows, n]."""
    near = x @ x.T
    np.fill_diagonal(near, -np.inf)
    n = min(n, len(x) - 1)
    return np.argpartition(-near, n - 1, axis=1)[:, :n] if n > 0 else np.zeros((len(x), 0), dtype=np.int64)


def balanced_parts(graph: np.ndarray, parts: int, seed: int = 7, rounds: int = 20) -> np.ndarray:
    """A part for each vertex, none above its share by more than a tenth, with few neighbours apart."""
    n, random = len(graph), np.random.default_rng(seed)
    most = ceil(1.1 * n / parts)
    part, size = np.full(n, -1), np.zeros(parts, dtype=np.int64)
    waves = [[int(s)] for s in random.choice(n, size=min(parts, n), replace=False)]
    waves += [[] for _ in range(parts - len(waves))]
    rest = list(random.permutation(n))
    while (part < 0).any():  # the parts grow in turn, each by the vertices next to it
        for p in np.argsort(size):
            if size[p] >= most:
                continue
            while waves[p] and part[waves[p][0]] >= 0:
                waves[p].pop(0)
            if not waves[p]:
                while rest and part[rest[-1]] >= 0:
                    rest.pop()
                if not rest:
                    break
                waves[p].append(int(rest.pop()))
            v = waves[p].pop(0)
            part[v], size[p] = p, size[p] + 1
            waves[p] += [int(u) for u in graph[v] if part[u] < 0]
    for _ in range(rounds):
        moved = 0
        for v in random.permutation(n):
            votes = np.bincount(part[graph[v]], minlength=parts)
            p = int(votes.argmax())
            if votes[p] > votes[part[v]] and size[p] < most:
                size[part[v]] -= 1
                part[v], size[p], moved = p, size[p] + 1, moved + 1
        if not moved:
            break
    return part


def classifier(x: np.ndarray, part: np.ndarray, graph: np.ndarray, parts: int, steps: int = 300, decay: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Weights and offsets of a softmax classifier; a row's target is the share of its neighbours, and itself, in each part."""
    target = np.zeros((len(x), parts))
    target[np.arange(len(x)), part] = 1
    for column in graph.T:
        target[np.arange(len(x)), part[column]] += 1
    target /= target.sum(axis=1, keepdims=True)
    w, b = np.zeros((x.shape[1], parts)), np.zeros(parts)
    speed_w, speed_b = np.zeros_like(w), np.zeros_like(b)
    for _ in range(steps):
        z = x @ w + b
        z = np.exp(z - z.max(axis=1, keepdims=True))
        error = (z / z.sum(axis=1, keepdims=True) - target) / len(x)
        speed_w, speed_b = 0.9 * speed_w + x.T @ error + decay * w, 0.9 * speed_b + error.sum(axis=0)
        w, b = w - 5 * speed_w, b - 5 * speed_b
    return w, b


def fit(sample: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    graph = neighbour_graph(sample, NEIGHBOURS)
    return classifier(sample, balanced_parts(graph, parts), graph, parts)


def routed(rows: DataFrame, models: dict[int, tuple[np.ndarray, np.ndarray]], probes: int) -> DataFrame:
    """rows with parts: the most probable ones, most probable first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, dim = [None] * len(batch), batch["dim"].to_numpy()
            for d in np.unique(dim):
                at = np.flatnonzero(dim == d)
                if int(d) not in models:
                    for i in at:
                        found[i] = [0]
                    continue
                w, b = models[int(d)]
                x = np.array(batch["vector"].take(pa.array(at)).flatten()).reshape(len(at), -1)
                top = np.argsort(-(unit(x) @ w + b), axis=1, kind="stable")[:, :probes]
                for i, parts in zip(at, top, strict=True):
                    found[i] = parts
            yield batch.append_column("parts", pa.array(found, pa.list_(pa.int32())))

    return rows.mapInArrow(run, "vec_id long, vector array<double>, dim int, parts array<int>")


def held_against(queries: DataFrame, rows: DataFrame, sizes: DataFrame, k: int) -> DataFrame:
    """The k best rows of each (query, part, block of the part), as lists. queries and rows have one part in each row."""
    key = ["dim", "part", "block", "query_block"]
    left = rows.join(sizes, ["dim", "part"])
    left = left.withColumn("block", F.pmod(F.xxhash64("vec_id", "vector"), "blocks")).withColumn("query_block", F.explode(F.expr("sequence(0L, query_blocks - 1)")))
    right = queries.join(sizes, ["dim", "part"])
    right = right.withColumn("query_block", F.pmod(F.xxhash64("vec_id", "vector"), "query_blocks")).withColumn("block", F.explode(F.expr("sequence(0L, blocks - 1)")))

    def search(asked: pa.Table, held: pa.Table) -> pa.Table:
        query_ids, found = [], []
        if len(asked) and len(held):
            q, x = (np.array(t["vector"].combine_chunks().flatten()).reshape(len(t), -1) for t in (asked, held))
            query_ids, ids = asked["vec_id"].to_numpy(), held["vec_id"].to_numpy()
            order = np.argsort(ids, kind="stable")
            ids, x = ids[order], x[order]
            for low in range(0, len(q), 256):
                near = q[low : low + 256] @ x.T
                near[query_ids[low : low + 256][:, None] == ids[None, :]] = -np.inf
                for i, row in enumerate(near):
                    far = np.partition(row, -k)[-k] if len(row) > k else -np.inf
                    # the last digits of a product depend on its neighbours in the block: those at the edge are settled one by one
                    left = np.flatnonzero((row >= far - 1e-9 * (1 + abs(far))) & (row > -np.inf)) if np.isfinite(far) else np.flatnonzero(row > -np.inf)
                    scores = np.einsum("ij,j->i", x[left], q[low + i])
                    top = np.lexsort((ids[left], -scores))[:k]
                    found.append([{"score": float(scores[t]), "vec_id": int(ids[left[t]])} for t in top])
        kind = pa.list_(pa.struct([("score", pa.float64()), ("vec_id", pa.int64())]))
        return pa.table([pa.array(query_ids, pa.int64()), pa.array(found, kind)], names=["query_id", "found"])

    columns = [*key, "vec_id", "vector"]
    pairs = right.select(*columns).groupBy(*key).cogroup(left.select(*columns).toDF(*columns).groupBy(*key))
    return pairs.applyInArrow(search, "query_id long, found array<struct<score:double,vec_id:long>>")


def search(vectors: DataFrame, every: int, k: int, parts: int = PARTS, probes: int = PROBES) -> DataFrame:
    """(query_id, rank, vec_id, score) for the queries, whose vec_id is divisible by every."""
    fine = usable(vectors).filter(F.exists("vector", lambda x: x != 0)).withColumn("dim", F.size("vector"))
    whole = stored(fine)
    picked = whole.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toArrow()
    models, dims = {}, picked["dim"].to_numpy()
    for d in np.unique(dims):
        at = np.flatnonzero(dims == d)
        if len(at) >= 4 * parts:
            models[int(d)] = fit(unit(np.array(picked["vector"].combine_chunks().take(pa.array(at)).flatten()).reshape(len(at), -1)), parts)
    found = stored(routed(whole.select("vec_id", "vector", "dim"), models, probes))
    rows = found.select("vec_id", "vector", "dim", F.col("parts")[0].alias("part"))
    asked = found.filter(is_query(every))
    near = asked.select("vec_id", "vector", "dim", F.explode("parts").alias("part"))
    counts = rows.groupBy("dim", "part").agg(F.count("*").alias("rows"))
    met = near.groupBy("dim", "part").agg(F.count("*").alias("queries"))
    sizes = counts.join(met, ["dim", "part"], "left").select("dim", "part", "rows", F.ceil(F.col("rows") / BLOCK).alias("blocks"), F.greatest(F.lit(1), F.ceil(F.coalesce("queries", F.lit(0)) / QUERY_BLOCK)).alias("query_blocks")).checkpoint()
    first = held_against(near, rows, sizes, k)
    # a query whose parts hold too few rows to give k answers meets the rest of the parts as well
    few = near.join(sizes, ["dim", "part"], "left").groupBy("vec_id").agg(F.sum("rows").alias("rows"), F.first("dim").alias("dim"))
    few = few.filter(F.coalesce("rows", F.lit(0)) <= k).select("vec_id", "dim")
    rest = asked.join(few.select("vec_id"), "vec_id", "left_semi").join(sizes.select("dim", "part"), "dim").filter(~F.array_contains("parts", F.col("part")))
    second = held_against(rest.select("vec_id", "vector", "dim", "part"), rows, sizes, k)
    return best(first.unionByName(second), k)


def op10_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), every=20, k=20)
