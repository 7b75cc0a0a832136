"""Best-fit packing of tokenized documents into sequences, under several capacities at once.

Documents become ids of a public byte-level BPE vocabulary and an end id. Only
those longer than a sequence are cut, so that their pieces but the first are
full. Full pieces are sequences of their own. The others are dealt by a hash of
the document into shards of about SHARD pieces, more shards for more data, and
packed within their shard, longest first. A bin has three capacities left:
tokens, documents, and attention cost (the sum of squared lengths). Among the
bins that hold the piece under every one of them, the one with the least weighted
norm of what would be left takes it; or, as the other rule, the one with the
largest weighted dot product of what is left and what the piece needs.

Defined results: null and empty texts are the end id alone; a null id is packed
like any other; rows that repeat an id are packed each for itself (sequence ids
are unique, pieces of such rows cannot be told apart by their ids); columns
beside doc_id and text take no part; a special token's own text is that token, as
the vocabulary's file says; texts may be of any length and kind, a run of one
character a million times included.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from math import ceil
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.common import shared_dir, stored, table

SHARD = 4096
VOCABULARY, RANKS, SPECIAL, END = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken", {"<|endoftext|>": 50256}, 2


class Capacity(NamedTuple):
    """What a sequence holds at most, and how much each counts when a bin is chosen. By default tokens alone bind."""

    tokens: int = 1024
    documents: int = 1024
    attention: int = 1024 * 1024
    weights: tuple[float, float, float] = (1.0, 1e-3, 1e-3)
    rule: str = "norm"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids of the vocabulary. Its ranks give the ids of its tokenizers file, several times as fast, but not for very long
    runs of white space, on which their library gives up: such texts are left to the tokenizers file."""

    def __init__(self, vocabulary: str, ranks: str) -> None:
        import public_tokenizers
        import tiktoken

        with open(ranks, "rb") as f:
            known = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=known, special_tokens=SPECIAL)
        self.vocabulary, self.whole = vocabulary, None

    def ids(self, text: str) -> list[int]:
        try:
            return self.fast.encode(text, allowed_special="all")
        except ValueError:
            if self.whole is None:
                from tokenizers import Tokenizer

                self.whole = Tokenizer.from_file(self.vocabulary)
            return self.whole.encode(text, add_special_tokens=False).ids


def cuts(n: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: the first may be shorter, the others are full."""
    first = n % most or most
    return [(0, first)] + [(at, most) for at in range(first, n, most)]


def pieces(docs: DataFrame, most: int, vocabulary: str | None = None, ranks: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Encoder(vocabulary or vocabulary_path(), ranks or vocabulary_path(RANKS))
        for batch in batches:
            at, rows = [], []
            for i, text in enumerate(batch["text"]):
                ids = [*coder.ids(text.as_py() or ""), END]
                data = np.array(ids, dtype="<u4")
                for k, (start, length) in enumerate(cuts(len(ids), most)):
                    at.append(i)
                    rows.append((k, start, length, zlib.crc32(data[start : start + length].tobytes())))
            columns = np.array(rows, dtype=np.int64).reshape(-1, 4).T
            yield pa.RecordBatch.from_arrays([batch["doc_id"].take(pa.array(at, pa.int64())), pa.array(columns[0], pa.int32()), *(pa.array(x) for x in columns[1:])], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def best_fit(lengths: np.ndarray, capacity: Capacity) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, bin, offset): the order in which the pieces were taken, and the bin and place that each got."""
    most = np.array([capacity.tokens, capacity.documents, capacity.attention], dtype=float)
    weights = np.array(capacity.weights)
    needs = np.column_stack([lengths, np.ones(len(lengths)), lengths.astype(float) ** 2])
    least = needs.min(axis=0) if len(needs) else most
    order = np.argsort(-lengths, kind="stable")
    left, name = np.zeros((len(lengths) + 1, 3)), np.zeros(len(lengths) + 1, dtype=np.int64)
    n_open = n_bins = 0
    bins, offsets = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    for k, i in enumerate(order):
        need = needs[i]
        rest = left[:n_open] - need
        fits = np.flatnonzero((rest >= 0).all(axis=1))
        if len(fits):
            if capacity.rule == "dot":
                score = -(left[fits] / most * (need / most)) @ weights
            else:
                score = np.square(rest[fits] / most) @ weights
            b = fits[np.argmin(score)]
        else:
            b, n_open, n_bins = n_open, n_open + 1, n_bins + 1
            left[b], name[b] = most, n_bins - 1
        bins[k], offsets[k] = name[b], most[0] - left[b, 0]
        left[b] -= need
        if (left[b] < least).any():  # nothing fits any more: close it
            n_open -= 1
            left[b], name[b] = left[n_open], name[n_open]
    return order, bins, offsets


def pack(docs: DataFrame, capacity: Capacity | None = None, vocabulary: str | None = None, ranks: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece."""
    capacity = capacity or Capacity()
    shared_dir(docs.sparkSession)
    found = stored(pieces(docs, capacity.tokens, vocabulary, ranks))
    short = found.filter(F.col("length") < capacity.tokens)
    shards = max(1, ceil(short.count() / SHARD))
    # by the content's checksum as well: one id many times does not fill one shard
    dealt = short.withColumn("shard", F.pmod(F.xxhash64("doc_id", "ids_crc32", "length"), F.lit(shards)))

    def run(part: pa.Table) -> pa.Table:
        part = part.sort_by([("length", "descending"), ("doc_id", "ascending"), ("ids_crc32", "ascending")])
        order, bins, offsets = best_fit(part["length"].to_numpy(), capacity)
        taken = part.take(pa.array(order))
        sequence = (part["shard"][0].as_py() << 32) + bins
        return taken.drop_columns(["shard"]).append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offsets))

    kind = docs.schema["doc_id"].dataType.simpleString()
    packed = dealt.groupBy("shard").applyInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    full = found.filter(F.col("length") == capacity.tokens).withColumns({"sequence_id": -1 - F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})
    return packed.unionByName(full)


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
