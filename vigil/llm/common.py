"""Helpers shared by the operators: shared storage, text as byte columns, word hashes.

Text helpers work on whole Arrow batches with numpy. A batch is walked in slices
of about ``SLICE`` bytes, so the memory they take does not follow the batch. A
document is never cut: one longer than a slice is a slice of its own.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.sources.storage import shared_folder

SLICE = 250_000
#: Spark's setting that a query's shuffle files go when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
U64 = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, which becomes the session's checkpoint folder if it has none."""
    folder = shared_folder(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def stored(df: DataFrame) -> DataFrame:
    """df written as Parquet to the shared folder and read again: computed once, lineage cut.

    The shuffles of the writing are removed when it ends, and not when the driver next collects its garbage.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/stored-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Removes the folders of stored tables that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def with_row(df: DataFrame, *names: str) -> DataFrame:
    """The named columns, and the whole row as __row: no other name of df can clash with those that are added after."""
    return df.select(F.struct(*(F.col(f"`{x}`") for x in df.columns)).alias("__row"), *names)


def sent(spark: SparkSession, value: object) -> Broadcast:
    """value as a broadcast for received(): with the code of this package's classes, which tasks may not find otherwise."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def received(value: Broadcast) -> object:
    return cloudpickle.loads(value.value)


def crc_bucket(column: str, buckets: int):
    """crc32 of the column as text, modulo buckets; a null id is in bucket 0."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % buckets, F.lit(0))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers (the splitmix64 finalizer, fixed constants)."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> U64(30))
        x = x * U64(0xBF58476D1CE4E5B9)
        x = x ^ (x >> U64(27))
        x = x * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


def byte_values(lower: bool) -> np.ndarray:
    """A random 64-bit value for each byte; with lower, A-Z have those of a-z."""
    values = mix64(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
    if lower:
        values[65:91] = values[97:123]
    return values


def separators() -> np.ndarray:
    """Which bytes separate words: space and 09-0D. No byte of a longer UTF-8 sequence is one of them."""
    out = np.zeros(256, dtype=bool)
    out[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
    return out


class Powers:
    """Powers of an odd number and of its inverse modulo 2**64, as far as asked for."""

    BASE, INVERSE = 0x5851F42D4C957F2D, pow(0x5851F42D4C957F2D, -1, 2**64)

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=U64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            for name, base in (("up", self.BASE), ("down", self.INVERSE)):
                steps = np.full(n, base, dtype=U64)
                steps[0] = 1
                with np.errstate(over="ignore"):
                    setattr(self, name, np.cumprod(steps, dtype=U64))
        return self.up, self.down


class Slice(NamedTuple):
    """Some documents of a batch: rows first..last-1, their bytes, and where each starts and ends."""

    first: int
    last: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def slices(column: pa.Array | pa.ChunkedArray, most: int = SLICE) -> Iterator[Slice]:
    """The texts of an Arrow column (null as empty) as slices of bytes."""
    for chunk in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        if pa.types.is_large_string(chunk.type):
            kind = np.int64
        else:
            chunk, kind = chunk.cast(pa.string()), np.int32
        if chunk.null_count:
            chunk = chunk.fill_null("")
        _, at, data = chunk.buffers()
        offsets = np.frombuffer(at, dtype=kind)[chunk.offset : chunk.offset + len(chunk) + 1].astype(np.int64)
        data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
        first = 0
        while first < len(chunk):
            last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1)
            low = offsets[first]
            yield Slice(first, last, data[low : offsets[last]], offsets[first:last] - low, offsets[first + 1 : last + 1] - low)
            first = last


class Words(NamedTuple):
    """Words of a slice: the document (0 for the slice's first) of each, place, length, hash; bounds has where each document's words begin."""

    doc: np.ndarray
    start: np.ndarray
    length: np.ndarray
    hash: np.ndarray
    bounds: np.ndarray


def words(part: Slice, values: np.ndarray, is_separator: np.ndarray, powers: Powers) -> Words:
    """The maximal runs of bytes that are no separators, hashed by a polynomial over byte values and scrambled."""
    n = len(part.data)
    inside = ~is_separator[part.data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    full = part.starts < part.ends
    edges = part.starts[full]  # a word does not go on from one document to the next
    opens[edges] = inside[edges]
    edges = part.ends[full] - 1
    closes[edges] = inside[edges]
    start, stop = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    up, down = powers.to(n + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, dtype=U64)
        np.cumsum(values[part.data] * up[:n], out=sums[1:])
        hashed = mix64((sums[stop] - sums[start]) * down[start] + (stop - start).astype(U64))
    bounds = np.append(np.searchsorted(start, part.starts), len(start))
    return Words(np.repeat(np.arange(len(part.starts)), np.diff(bounds)), start, stop - start, hashed, bounds)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))
