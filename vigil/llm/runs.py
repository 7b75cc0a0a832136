"""Periodic runs of words, by internal pattern matching: dyadic blocks look for themselves nearby.

A run is a maximal stretch of words that repeats with a smallest period q, at
least ``exponent`` times. Prefix doubling names all factors whose length is a
power of two, and ends in the suffix array of a slice of texts; the occurrences
of a factor are an interval of it. For each length L, every block of words from a
multiple of L on that occurs again asks for its next and its previous occurrence:
range successors and predecessors in a wavelet matrix over the suffix array. In
a run of period L/2 to L the occurrences of such a block are a progression whose
difference is the period, so the nearest occurrence tells it; a candidate is then
extended to both sides by comparing named factors, largest first, which also
verifies it. A block that lies in a run of length 4q or more has either its next
or its previous occurrence inside, so no run is missed.

Words are told apart exactly, by a dictionary of the slice. Each text ends in a
number of its own, so nothing goes on from one text to the next. Memory is some
4 bytes a word for each doubling, so it follows the slice or the longest text,
with the logarithm of its longest repeat.

Defined results: null and empty texts have no words and no runs; runs may overlap
or lie in each other, and all are given; repeated rows are searched each; columns
beside doc_id and text take no part; a null id is a row like any other; texts are
searched whole, whatever their length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.common import slices, table
from vigil.llm.wavelet import WaveletMatrix

LEAST, EXPONENT = 6, 4
#: Blocks that look for themselves at a time.
BLOCKS = 1 << 17


def dyadic_names(ids: np.ndarray) -> list[np.ndarray]:
    """names[k][i]: of the factor of 2**k numbers from i on. Equal factors have equal names, and a name is the place of its
    first factor in sorted order. The last array names every place apart. ids must end in a number that occurs once."""
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    first = np.concatenate([[True], ids[order][1:] != ids[order][:-1]])
    name = np.empty(n, dtype=np.int64)
    name[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    names, length = [name.astype(np.int32)], 1
    repeated = np.flatnonzero(np.bincount(name, minlength=n)[name] > 1)
    while len(repeated):
        old = name[repeated]
        key = old * n + name[repeated + length]  # a repeated factor holds no end of a text, so there is a next number
        order = np.argsort(key)
        key, old, repeated = key[order], old[order], repeated[order]
        at = np.arange(len(key))
        fresh = np.concatenate([[True], key[1:] != key[:-1]])
        group = np.concatenate([[True], old[1:] != old[:-1]])
        first = np.maximum.accumulate(np.where(fresh, at, 0))
        name[repeated] = old + first - np.maximum.accumulate(np.where(group, at, 0))
        repeated = repeated[np.bincount(first, minlength=len(key))[first] > 1]
        names.append(name.astype(np.int32))
        length *= 2
    return names


def extended(names: list[np.ndarray], one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many numbers agree from places one and two on (one < two), and how many before them."""
    ahead, back = np.zeros(len(one), dtype=np.int64), np.zeros(len(one), dtype=np.int64)
    for k in reversed(range(len(names) - 1)):
        name, step = names[k], 1 << k
        ahead += np.where(name[one + ahead] == name[two + ahead], step, 0)
        i, j = one - back - step, two - back - step
        back += np.where((i >= 0) & (name[np.maximum(i, 0)] == name[np.maximum(j, 0)]), step, 0)
    return ahead, back


def nearest_occurrences(names: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, distance) of blocks of 2, 4, 8, ... numbers and their next or previous occurrence, no further than their length; some blocks at a time."""
    n = len(names[0])
    suffixes = np.empty(n, dtype=np.int64)
    suffixes[names[-1]] = np.arange(n)
    matrix = WaveletMatrix(suffixes, n.bit_length())
    del suffixes
    for k in range(1, len(names) - 1):
        length, name = 1 << k, names[k]
        size = np.bincount(name, minlength=n)
        for first in range(0, n, length * BLOCKS):
            block = np.arange(first, min(n, first + length * BLOCKS), length)
            block = block[size[name[block]] > 1]
            low = name[block].astype(np.int64)
            high = low + size[low]
            after, before = matrix.successor(block + 1, low, high), matrix.predecessor(block, low, high)
            for place, distance, there in ((block, after - block, after >= 0), (before, block - before, before >= 0)):
                near = there & (distance <= length)
                yield place[near], distance[near]


def distinct_rows(rows: np.ndarray) -> np.ndarray:
    """The distinct rows, sorted; rows that repeat the one before go first, as blocks of one run tell it one after the other."""
    fresh = np.ones(len(rows), dtype=bool)
    fresh[1:] = (rows[1:] != rows[:-1]).any(axis=1)
    return np.unique(rows[fresh], axis=0)


def runs_of(ids: np.ndarray, least: int, exponent: int) -> np.ndarray:
    """Rows of (start, length, period), by start and then period, of all runs of the texts in ids."""
    names, found = dyadic_names(ids), [np.zeros((0, 3), dtype=np.int64)]
    for place, period in nearest_occurrences(names):
        ahead, back = extended(names, place, place + period)
        start, length = place - back, back + period + ahead
        kept = length >= np.maximum(least, exponent * period)
        found.append(distinct_rows(np.column_stack([start, length, period])[kept]))
    found = distinct_rows(np.concatenate(found))
    first = np.ones(len(found), dtype=bool)  # a stretch has its multiples of the period, too
    first[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
    found = found[first]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def run_finder(least: int, exponent: int):
    """A column function of a text: struct of its number of words, its runs, and its words without what runs repeat."""

    @F.arrow_udf("n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
    def find(text: pa.Array) -> pa.Array:
        counts, sizes, rows, collapsed = [], [], [np.zeros((0, 3), dtype=np.int64)], []
        for part in slices(text):
            texts = [part.data[a:b].tobytes().split() for a, b in zip(part.starts, part.ends)]  # at 20 and 09-0D
            count = np.array([len(x) for x in texts])
            ends = np.cumsum(count + 1) - 1
            ids = np.empty(ends[-1] + 1, dtype=np.int64)
            inside = np.ones(len(ids), dtype=bool)
            inside[ends] = False
            ids[ends] = -1 - np.arange(len(ends))
            ids[inside] = pa.array([w for x in texts for w in x], pa.binary()).dictionary_encode().indices.to_numpy()
            found = runs_of(ids, least, exponent)
            doc = np.searchsorted(ends, found[:, 0])
            steps = np.zeros(len(ids) + 1, dtype=np.int64)
            np.add.at(steps, found[:, 0] + found[:, 2], 1)
            np.add.at(steps, found[:, 0] + found[:, 1], -1)
            dropped = np.cumsum(steps) > 0
            begin = ends - count
            for i in range(len(texts)):
                gone = dropped[begin[i] : ends[i]]
                collapsed.append(b" ".join([w for w, d in zip(texts[i], gone) if not d] if gone.any() else texts[i]))
            found[:, 0] -= begin[doc]
            counts.append(count)
            sizes.append(np.bincount(doc, minlength=len(texts)))
            rows.append(found)
        offsets = np.concatenate([[0], np.cumsum(np.concatenate([np.zeros(0, dtype=np.int64), *sizes]))])
        all_rows = pa.StructArray.from_arrays([pa.array(x) for x in np.concatenate(rows).T], names=["start", "length", "period"])
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), all_rows)
        n_words = pa.array(np.concatenate([np.zeros(0, dtype=np.int64), *counts]), pa.int64())
        return pa.StructArray.from_arrays([n_words, lists, pa.array(collapsed, pa.binary()).cast(pa.string())], names=["n_words", "runs", "collapsed"])

    return find


def periodic_runs(docs: DataFrame, least: int = LEAST, exponent: int = EXPONENT) -> DataFrame:
    """(doc_id, n_words, runs, collapsed): runs of at least ``least`` words that hold their period ``exponent`` times.

    runs has start, length and period, by start and then period; collapsed has
    the words, joined by one space, that no run holds after its first period.
    """
    if exponent < 4:
        raise ValueError("blocks are only sure to meet themselves in runs of four periods or more")
    return docs.select("doc_id", run_finder(least, exponent)("text").alias("found")).select("doc_id", "found.*")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): every tenth document by the crc32 of its id repeats, from a word on, the words that follow."""
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    h = F.crc32(F.col("doc_id").cast("string"))
    chosen = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when((h % 10 == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]"), words).alias("words"))
    n = F.size("words")
    counted = chosen.withColumn("a", (F.col("g") % n).cast("int")).withColumn("p", (1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    left = n - F.col("a")
    repeated = F.slice(F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), F.ceil(left / F.col("p")).cast("int"))), F.lit(1), left)
    text = F.when(F.col("words").isNotNull(), F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), repeated), " ")).otherwise(F.col("text"))
    return counted.select("doc_id", text.alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_planted_runs(table(spark, sf_dir, "documents").select("doc_id", "text")))
    key = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    found = found.withColumn("best", F.array_max(key))
    length, start, period = F.col("best.length"), -F.col("best.start"), -F.col("best.period")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), start.alias("start"), length.alias("length"), period.alias("period"), F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


#: Equal stretches of five words of a document stand q words apart all along a run of period q; stretches that follow each other are one.
OP12_SQL = r"""
    WITH steps AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, i)) AS t),
    hashed AS (
      SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
        xor(list_reduce(list_transform(range(1, len(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT), lambda a, c: xor(a >> 8, t[(xor(a, c) & 255) + 1]), 4294967295), 4294967295) AS h
      FROM documents, steps),
    sized AS (SELECT *, len(words) AS n, coalesce(h % 10 = 0 AND len(words) > 0, false) AS planted, h // 10 AS g FROM hashed),
    placed AS (SELECT *, CASE WHEN planted THEN g % n ELSE n END AS a, CASE WHEN planted THEN 1 + (n - g % n) // (3 + g % 8) ELSE 1 END AS p FROM sized),
    texts AS (SELECT r, doc_id, list_transform(range(n), lambda i: words[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) AS words FROM placed),
    fives AS (SELECT r, i, array_to_string(words[i + 1:i + 5], ' ') AS k FROM (SELECT r, words, unnest(range(len(words) - 4)) AS i FROM texts WHERE len(words) >= 5)),
    pairs AS (SELECT x.r, x.i, y.i - x.i AS q FROM fives x JOIN fives y ON x.r = y.r AND x.k = y.k AND x.i < y.i),
    stretches AS (SELECT r, q, min(i) AS start, count(*) + 4 + q AS length FROM (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM pairs) GROUP BY r, q, island),
    runs AS (SELECT r, start, length, min(q) AS period FROM stretches WHERE length >= greatest(6, 4 * q) GROUP BY r, start, length),
    dropped AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM runs),
    kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS collapsed FROM (SELECT r, unnest(words) AS word, unnest(range(len(words))) AS i FROM texts) ANTI JOIN dropped USING (r, i) GROUP BY r),
    lists AS (SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines, max_by({'s': start, 'l': length, 'p': period}, (length, -start, -period)) AS best FROM runs GROUP BY r)
    SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best.s::BIGINT AS start, best.l::BIGINT AS length, best.p::BIGINT AS period, (1000 * best.l // best.p)::BIGINT AS exponent_milli,
           sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
    FROM texts LEFT JOIN lists USING (r) LEFT JOIN kept USING (r)"""
