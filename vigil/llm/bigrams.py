"""The Pitman-Yor bigram model of lm with every word as a dish and as a context: no vocabulary is cut.

A context u has the probabilities (c - d t) / (theta + c_u) + B_u P(w) with c customers and t tables of the dish w,
B_u = (theta + d t_u) / (theta + c_u), and P of the parent that all contexts share; the parent's base is uniform over all
training words and one for the rest. A pair of words that occurs once has one table; the others' tables are drawn. Pairs are
dealt into buckets by context, and those of a frequent context by the dish besides, so that no bucket follows one word. A turn
draws the parent's tables in buckets of words that the buckets of pairs ask, then the contexts' tables from the answers;
the tables of frequent contexts are summed between turns. The last turn draws SAMPLES seatings, and the parent's tables for
each; the score is that of their means.

The log-probability of a text is a sum over its words of log P and log B, and over its pairs that were seen of
log(1 + (c - d t) / ((theta + c_u) B_u P)). So words are looked up as in lm, the frequent ones in a broadcast, and pairs in
their buckets, a pair once for each block of texts. One walk over the texts asks for both.

Defined results: as in lm.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm import lm
from vigil.llm.common import U64, Powers, crc_bucket, dropped, mix64, received, sent, shared_dir, signed, stored, table

#: Tokens of a bucket of pairs, about, beyond which a context is dealt over several; of a bucket of words; of a block of texts.
BUCKET, WORDS, BLOCK = 1_000_000, 4_000_000, 2_000_000
TURNS, SAMPLES = 4, lm.SAMPLES
#: The key of a document's end; odd factors.
END, LEFT, PART = U64(0), U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F)
ROW = "bucket int, kind int, who long, a binary, b binary, c binary, d binary"
NAMES = ["bucket", "kind", "who", "a", "b", "c", "d"]
PAIRS, SEATED, ASKED, ANSWER, REQUEST, DOC, WORD = range(7)
#: What is known of a document, beside its row's who, which is its block.
OWN = ["doc_id", "held_out", "place", "n_tokens", "n_known", "base", "score"]


def packed(x: np.ndarray) -> bytes:
    """Numbers compressed, the first bytes of all before the second ones and so on: high bytes are mostly alike, low ones are noise."""
    return x.nbytes.to_bytes(8, "little") + pa.compress(np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.itemsize).T.tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, kind: type) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    data = pa.decompress(data[8:], decompressed_size=size, codec="zstd", asbytes=True) if size else b""
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def as_rows(rows: list[tuple]) -> pa.RecordBatch:
    """Rows of ROW; binaries that are left out are null."""
    kinds = [pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 4]
    return pa.RecordBatch.from_arrays([pa.array([r[k] if k < len(r) else None for r in rows], t) for k, t in enumerate(kinds)], names=NAMES)


class Layout(NamedTuple):
    """Buckets of pairs and of words; the frequent contexts, sorted, with their customers and parts; N, V and training documents."""

    buckets: int
    word_buckets: int
    hot: np.ndarray
    customers: np.ndarray
    parts: np.ndarray
    tokens: int
    distinct: int

    def place(self, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which frequent context each is, and whether it is one."""
        if not len(self.hot):
            return np.zeros(len(u), dtype=np.int64), np.zeros(len(u), dtype=bool)
        at = np.minimum(np.searchsorted(self.hot, u), len(self.hot) - 1)
        return at, self.hot[at] == u

    def bucket(self, u: np.ndarray, w: np.ndarray) -> np.ndarray:
        at, frequent = self.place(u)
        parts = np.where(frequent, self.parts[at], 1).astype(U64) if len(self.hot) else np.ones(len(u), dtype=U64)
        with np.errstate(over="ignore"):
            return (mix64(u + (mix64(w * PART) % parts) * LEFT) % U64(self.buckets)).astype(np.int64)

    def word_bucket(self, w: np.ndarray) -> np.ndarray:
        return (mix64(w + PART) % U64(self.word_buckets)).astype(np.int64)


def pair_keys(u: np.ndarray, w: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix64(u * LEFT + mix64(w * PART + U64(1)))


def paths(column: pa.Array, powers: Powers) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(u, w, document, bounds of the documents' words) of all tokens, an end after each document's words."""
    for keys, bounds in lm.word_keys(column, powers):
        w = np.insert(keys, bounds[1:], END)
        u = np.concatenate([[END], w[:-1]]).astype(U64)
        yield u, w, np.repeat(np.arange(len(bounds) - 1), np.diff(bounds) + 1), bounds


def runs(bucket: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(bucket, from, to) of a sorted array."""
    cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(bucket)]
    for low, high in zip(cuts[:-1], cuts[1:], strict=True):
        if low < high:
            yield int(bucket[low]), low, high


def counted(bucket: np.ndarray, u: np.ndarray, w: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct (bucket, u, w), sorted, with their sums of n."""
    order = np.lexsort((w, u, bucket))
    bucket, u, w, n = bucket[order], u[order], w[order], n[order]
    fresh = np.ones(len(u), dtype=bool)
    fresh[1:] = (u[1:] != u[:-1]) | (w[1:] != w[:-1]) | (bucket[1:] != bucket[:-1])
    first = np.flatnonzero(fresh)
    return bucket[first], u[first], w[first], np.add.reduceat(n, first) if len(first) else n


def pairs_of(train: DataFrame, layout: Layout) -> DataFrame:
    """A row for each bucket: its contexts and how many pairs each has, the place of each pair's word among the bucket's words, counts, the words."""
    shared = sent(train.sparkSession, layout)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, layout, gathered, size = Powers(), received(shared), [], 0

        def summed() -> pa.RecordBatch:
            u, w = (np.concatenate(x) for x in zip(*gathered, strict=True))
            gathered.clear()
            bucket, u, w, n = counted(layout.bucket(u, w), u, w, np.ones(len(u), dtype=np.uint32))
            return as_rows([(b, PAIRS, None, packed(u[i:j]), packed(w[i:j]), packed(n[i:j].astype(np.uint32))) for b, i, j in runs(bucket)])

        for batch in batches:
            for u, w, _, _ in paths(batch["text"], powers):
                gathered.append((u, w))
                size += len(u)
                if size >= BLOCK:
                    yield summed()
                    gathered, size = [], 0
        if size:
            yield summed()

    def merge(part: pa.Table) -> pa.Table:
        u, w, n = (np.concatenate([unpacked(x, t) for x in part[c].to_pylist()]) for c, t in (("a", U64), ("b", U64), ("c", np.uint32)))
        _, u, w, n = counted(np.zeros(len(u), dtype=np.int64), u, w, n.astype(np.int64))
        known, place = np.unique(w, return_inverse=True)
        contexts, sizes = np.unique(u, return_counts=True)
        own = np.concatenate([contexts, sizes.astype(U64)])
        return pa.Table.from_batches([as_rows([(part["bucket"][0].as_py(), PAIRS, None, packed(own), packed(place.astype(np.uint32)), packed(n.astype(np.uint32)), packed(known))])])

    return train.select("text").mapInArrow(run, ROW).groupBy("bucket").applyInArrow(merge, ROW)


class Room:
    """The pairs of a bucket with their seating: contexts, context of each pair, words, word of each pair, counts, tables."""

    def __init__(self, rows: dict[str, list], layout: Layout, totals: np.ndarray) -> None:
        pairs = [i for i, k in enumerate(rows["kind"]) if k == PAIRS][0]
        own = unpacked(rows["a"][pairs], U64)
        self.contexts = own[: len(own) // 2]
        self.at = np.repeat(np.arange(len(self.contexts)), own[len(own) // 2 :].astype(np.int64))
        self.word, self.n, self.words = unpacked(rows["b"][pairs], np.uint32), unpacked(rows["c"][pairs], np.uint32).astype(float), unpacked(rows["d"][pairs], U64)
        seated = [i for i, k in enumerate(rows["kind"]) if k == SEATED]
        self.t = unpacked(rows["a"][seated[0]], np.uint32) / int.from_bytes(rows["d"][seated[0]], "little") if seated else np.ones(len(self.n))
        self.layout, self.totals = layout, totals
        self.place, self.frequent = layout.place(self.contexts)

    def tables(self) -> np.ndarray:
        """t_u of the contexts, those of frequent ones as told."""
        out = np.bincount(self.at, self.t, minlength=len(self.contexts))
        out[self.frequent] = self.totals[self.place[self.frequent]]
        return out

    def customers(self) -> np.ndarray:
        out = np.bincount(self.at, self.n, minlength=len(self.contexts))
        out[self.frequent] = self.layout.customers[self.place[self.frequent]]
        return out

    def parents(self, rows: dict[str, list], uniform: float, over: float) -> np.ndarray:
        """P of the words, from the answers: C - d T of each."""
        bucket, out = self.layout.word_bucket(self.words), np.zeros(len(self.words))
        for kind, who, data in zip(rows["kind"], rows["who"], rows["a"], strict=True):
            if kind == ANSWER:
                out[bucket == who] = unpacked(data, np.float64)
        return (out + uniform) / over

    def sweep(self, parent: np.ndarray, seed: int) -> None:
        d, theta = lm.CONTEXT
        shape = theta / d + self.tables()
        room = lm.Restaurant(self.n, lm.CONTEXT, lm.stirling_once(d), seed)
        z = room.random.gamma(shape)
        for i in np.flatnonzero(self.frequent):  # the same in all buckets of the context
            z[i] = np.random.default_rng([int(self.contexts[i]), seed & 0xFF]).gamma(shape[i])
        room.draw(z[self.at] * parent[self.word])
        self.t = room.t

    def out(self, bucket: int, samples: list[np.ndarray]) -> list[tuple]:
        """The sum of the seatings and their number, with the mean tables of frequent contexts here, and for each bucket of words what it is asked: a row of tables for each seating."""
        total = np.sum(samples, axis=0)
        mine = np.bincount(self.at, total, minlength=len(self.contexts))[self.frequent] / len(samples)
        rows = [(bucket, SEATED, None, packed(total.astype(np.uint32)), self.place[self.frequent].tobytes(), mine.tobytes(), len(samples).to_bytes(1, "little"))]
        asked, tables = self.layout.word_bucket(self.words), np.array([np.bincount(self.word, t, minlength=len(self.words)) for t in samples], dtype=np.uint32)
        for b in np.unique(asked).tolist():
            rows.append((b, ASKED, bucket, packed(self.words[asked == b]), packed(tables[:, asked == b].ravel())))
        return rows


def seat_words(asked: DataFrame, tokens_out: bool, z: np.ndarray, base: float, turn: int) -> DataFrame:
    """Answers (C - d T of each word, in the order asked), and a row of bucket -1 with the sums of C and T and, if wanted, all words' own.

    All are means over the seatings that were asked for, of which z has one entry each.
    """

    def run(part: pa.Table) -> pa.Table:
        words, tables = [unpacked(x, U64) for x in part["a"].to_pylist()], [unpacked(x, np.uint32).reshape(len(z), -1) for x in part["b"].to_pylist()]
        known, inverse = np.unique(np.concatenate(words), return_inverse=True)
        own, sums, b = np.zeros(len(known)), np.zeros(2), part["bucket"][0].as_py()
        for k, sample in enumerate(np.concatenate(tables, axis=1)):
            c = np.bincount(inverse, sample)
            room = lm.Restaurant(c, lm.PARENT, lm.stirling_once(lm.PARENT[0]), (b << 8) + turn + k)
            room.draw(np.full(len(c), z[k] * base))
            own += (c - lm.PARENT[0] * room.t) / len(z)
            sums += np.array([c.sum(), room.t.sum()]) / len(z)
        rows = [(-1, ANSWER, b, sums.tobytes(), *((packed(known), packed(own)) if tokens_out else ()))]
        for bucket, at in zip(part["who"].to_pylist(), np.split(own[inverse], np.cumsum([len(x) for x in words])[:-1]), strict=True):
            rows.append((bucket, ANSWER, b, packed(at)))
        return pa.Table.from_batches([as_rows(rows)])

    return asked.groupBy("bucket").applyInArrow(run, ROW)


class Seating(NamedTuple):
    """pairs, seated and answers by bucket; the tables of frequent contexts; P of a word is (own + uniform) / over."""

    pairs: DataFrame
    seated: DataFrame
    answers: DataFrame
    totals: np.ndarray
    uniform: float
    over: float


def seating(train: DataFrame, layout: Layout) -> Seating:
    """Seatings of all training tokens: turns of words and contexts, of which the last has SAMPLES, and the words once more; their means."""
    spark = train.sparkSession
    pairs = stored(pairs_of(train, layout))
    shared, base, tables = sent(spark, layout), 1 / (layout.distinct + 1), 0.0
    d, theta = lm.PARENT

    def turned(rows: DataFrame, totals: np.ndarray, turn: int, uniform: float, over: float) -> DataFrame:
        def run(part: pa.Table) -> pa.Table:
            rows = {c: part[c].to_pylist() for c in NAMES}
            room, samples = Room(rows, received(shared), totals), []
            parent = room.parents(rows, uniform, over) if turn else None
            for k in range(SAMPLES if turn == TURNS else 1):
                if turn:
                    room.sweep(parent, (rows["bucket"][0] << 8) + turn + k)
                samples.append(room.t)
            return pa.Table.from_batches([as_rows(room.out(rows["bucket"][0], samples))])

        return stored(rows.groupBy("bucket").applyInArrow(run, ROW))

    rows, before, totals = pairs, (), np.zeros(len(layout.hot))
    random = np.random.default_rng(1)
    for turn in range(TURNS + 1):
        done = turned(rows, totals, turn, uniform if turn else 0.0, over if turn else 1.0)
        dropped(*before)
        totals = np.zeros(len(layout.hot))
        for r in done.filter(f"kind = {SEATED} and length(b) > 0").select("b", "c").collect():  # the frequent contexts of a bucket
            np.add.at(totals, np.frombuffer(r["b"], np.int64), np.frombuffer(r["c"], np.float64))
        answers = stored(seat_words(done.filter(f"kind = {ASKED}"), turn == TURNS, random.gamma(theta / d + tables, size=SAMPLES if turn == TURNS else 1) if turn else np.full(1, theta / d), base, turn))
        sums = sum((np.frombuffer(r["a"], np.float64) for r in answers.filter("bucket < 0").select("a").collect()), np.zeros(2))  # a row per bucket of words
        customers, tables = float(sums[0]), float(sums[1])
        uniform, over = (theta + d * tables) * base, theta + customers
        seated, before = done.filter(f"kind = {SEATED}"), (done, answers)
        rows = pairs.unionByName(seated).unionByName(answers.filter("bucket >= 0"))
    seated = stored(seated)  # without what was asked
    dropped(done)
    return Seating(pairs, seated, answers, totals, uniform, over)


def word_gains(state: Seating, counts: DataFrame, layout: Layout) -> DataFrame:
    """(word, n, gain) of all training words: log10 of P and of B."""
    shared, (d, theta), totals, uniform, over = sent(counts.sparkSession, layout), lm.CONTEXT, state.totals, state.uniform, state.over

    def own(part: pa.Table) -> pa.Table:
        room = Room({c: part[c].to_pylist() for c in NAMES}, received(shared), totals)
        back = np.log10((theta + d * room.tables()) / (theta + room.customers()))
        return pa.table({"word": signed(room.contexts), "back": back})

    def parents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, own in zip(batch["b"].to_pylist(), batch["c"].to_pylist(), strict=True):
                p = np.log10((unpacked(own, np.float64) + uniform) / over)
                yield pa.RecordBatch.from_arrays([pa.array(signed(unpacked(words, U64))), pa.array(p)], names=["word", "parent"])

    backs = state.pairs.unionByName(state.seated).groupBy("bucket").applyInArrow(own, "word long, back double").groupBy("word").agg(F.max("back").alias("back"))
    p = state.answers.filter("bucket < 0").mapInArrow(parents, "word long, parent double")
    return counts.join(p, "word", "left").join(backs, "word", "left").select("word", "n", (F.col("parent") + F.coalesce("back", F.lit(0.0))).alias("gain"))


class Head(NamedTuple):
    """The frequent words with counts and gains; the log10 of P of a word that was never seen; the layout."""

    words: np.ndarray
    counts: np.ndarray
    gains: np.ndarray
    unknown: float
    layout: Layout


def asked_of(docs: DataFrame, head: Head, *wanted: int) -> DataFrame:
    """Rows of the wanted kinds: DOC, one per document with what frequent words give; requests of a block of documents, which who names:
    REQUEST, of pairs by bucket, and ASKED, of words beyond the head by bucket of words, from -1 down.

    The requests are shuffled and never stored.
    """
    shared = sent(docs.sparkSession, head)
    names = [*NAMES, *OWN]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, head = Powers(), received(shared)
        layout, logs = head.layout, np.log10(head.counts + 0.1)
        types = [None, pa.bool_(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        block, place, gathered, size = TaskContext.get().partitionId() << 24, 0, {k: [] for k in (REQUEST, ASKED) if k in wanted}, 0

        def asked(kind: int, u: np.ndarray, w: np.ndarray, doc: np.ndarray, rare: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            """Bucket, key and document of what a slice asks: 16 bytes a request are what waits for the block to be full."""
            if kind == REQUEST:
                return layout.bucket(u, w).astype(np.int32), pair_keys(u, w), doc.astype(np.uint32)
            return (-1 - layout.word_bucket(w[rare])).astype(np.int32), w[rare], doc[rare].astype(np.uint32)

        def requests() -> Iterator[pa.RecordBatch]:
            for kind, slices in gathered.items():
                bucket, key, doc = (np.concatenate(x) for x in zip(*slices, strict=True))
                slices.clear()
                order = np.lexsort((key, bucket))
                bucket, key, doc, rows = bucket[order], key[order], doc[order], []
                for b, i, j in runs(bucket):
                    keys, times = np.unique(key[i:j], return_counts=True)
                    rows.append((b, kind, block, packed(np.diff(keys, prepend=U64(0))), packed(times.astype(np.uint32)), packed(doc[i:j])))
                rows = as_rows(rows)
                yield pa.RecordBatch.from_arrays([*rows.columns, *(pa.nulls(rows.num_rows, t) for t in types)], names=names)

        for batch in batches:
            types[0], row = batch["doc_id"].type, 0
            for u, w, doc, bounds in paths(batch["text"], powers):
                n = len(bounds) - 1
                if size >= BLOCK:
                    yield from requests()
                    block, place, size = block + 1, 0, 0
                at = np.minimum(np.searchsorted(head.words, w), max(0, len(head.words) - 1))
                inside = head.words[at] == w if len(head.words) else np.zeros(len(w), dtype=bool)
                for kind, slices in gathered.items():
                    slices.append(asked(kind, u, w, place + doc, ~inside))
                if DOC in wanted:
                    base = np.bincount(doc[inside], logs[at[inside]], minlength=n) if len(logs) else np.zeros(n)
                    gain = np.bincount(doc[inside], head.gains[at[inside]], minlength=n) if len(logs) else np.zeros(n)
                    part, places = batch.slice(row, n), np.arange(place, place + n)
                    bucket = layout.buckets + (mix64((block + places // 256).astype(U64)) % U64(4 * layout.buckets)).astype(np.int32)  # where nothing is asked
                    own = [pa.array(bucket), pa.array(np.full(n, DOC, dtype=np.int32)), pa.array(np.full(n, block)), *(pa.nulls(n, pa.binary()) for _ in range(4))]
                    own += [part["doc_id"], part["held_out"], pa.array(places.astype(np.int32)), pa.array(np.diff(bounds) + 1)]
                    own += [pa.array(np.bincount(doc[inside], minlength=n).astype(np.int64)), pa.array(base), pa.array(gain)]
                    yield pa.RecordBatch.from_arrays(own, names=names)
                size, row, place = size + len(u), row + n, place + n
        if size:
            yield from requests()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"{ROW}, doc_id {kind}, held_out boolean, place int, n_tokens long, n_known long, base double, score double")


def per_document(doc: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """The documents and their sums of the values."""
    if len(doc) and doc.max() < 8 * len(doc):
        places = np.flatnonzero(np.bincount(doc))
        return places, *(np.bincount(doc, x)[places] for x in values)
    places, inverse = np.unique(doc, return_inverse=True)
    return places, *(np.bincount(inverse, x, minlength=len(places)) for x in values)


def answered(rows: list[tuple], key: np.ndarray, *values: np.ndarray) -> list[tuple]:
    """(block, places, sums of each of the values of the keys asked) of each row; the last entry of the values is that of an unknown key."""
    out, order = [], np.argsort(key)
    key, values = key[order], [np.append(x[:-1][order], x[-1]) for x in values]
    for block, keys, times, doc in rows:
        keys, times, doc = np.cumsum(unpacked(keys, U64), dtype=U64), unpacked(times, np.uint32), unpacked(doc, np.uint32)
        at = np.searchsorted(key, keys)
        hit = at < len(key)
        hit[hit] = key[at[hit]] == keys[hit]
        at = np.repeat(np.where(hit, at, len(key)), times)
        places, *sums = per_document(doc, *(x[at] for x in values))
        out.append((block, packed(np.diff(places, prepend=0).astype(np.uint32)), *(packed(x) for x in sums)))
    return out


def looked_up(docs: DataFrame, state: Seating, rare: DataFrame, head: Head) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, base, score) of every document, of all its words and pairs."""
    spark, (d, theta), totals, unknown = docs.sparkSession, lm.CONTEXT, state.totals, head.unknown
    uniform, over = state.uniform, state.over
    shared = sent(spark, head.layout)
    names, id_type = ["bucket", "block", "places", "x", "y", "hits", *OWN], docs.schema["doc_id"].dataType.simpleString()

    def rows_of(part: pa.Table, kind: int) -> list[tuple]:
        return [tuple(r.values()) for r in part.filter(pc.equal(part["kind"], kind)).select(["who", "a", "b", "c"]).to_pylist()]

    def pairs(known: pa.Table, asked: pa.Table) -> list[tuple]:
        """Rows whose x and hits are null."""
        key, gain = np.zeros(0, dtype=U64), np.zeros(0)
        if known.num_rows:
            rows = {c: known[c].to_pylist() for c in NAMES}
            room = Room(rows, received(shared), totals)
            p, back = room.parents(rows, uniform, over), theta + d * room.tables()  # theta + c_u cancels out
            gain = np.log10(1 + (room.n - d * room.t) / (back[room.at] * p[room.word]))
            key = pair_keys(room.contexts[room.at], room.words[room.word])
        return [(block, places, None, y, None) for block, places, y in answered(rows_of(asked, REQUEST), key, np.append(gain, 0.0))]

    def words(known: pa.Table, asked: pa.Table) -> list[tuple]:
        rows = rows_of(known, WORD)
        key, n, gain = (np.concatenate([np.zeros(0, t), *(unpacked(r[k], t) for r in rows)]) for k, t in ((1, U64), (2, np.int64), (3, np.float64)))
        return answered(rows_of(asked, ASKED), key, np.log10(np.append(n, 0) + 0.1), np.append(gain, unknown), np.append(np.ones(len(key)), 0.0))

    def found(key: tuple, known: pa.Table, asked: pa.Table) -> pa.Table:
        bucket = key[0].as_py()  # beyond those of pairs are documents
        rows = (words if bucket < 0 else pairs)(known, asked)
        columns = list(zip(*rows, strict=True)) or [()] * 5
        own = asked.filter(pc.equal(asked["kind"], DOC))
        types = [pa.int32(), pa.int64(), *[pa.binary()] * 4]
        sums = [pa.array(x, t) for x, t in zip(([bucket] * len(rows), *columns), types, strict=True)] + [pa.nulls(len(rows), asked[c].type) for c in OWN]
        docs = [own["bucket"], own["who"], *(pa.nulls(own.num_rows, t) for t in types[2:]), *(own[c] for c in OWN)]
        return pa.concat_tables([pa.table(sums, names=names), pa.table(docs, names=names)])

    def bucketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        layout = received(shared)
        for batch in batches:
            word, n, gain = batch["word"].to_numpy().view(U64), batch["n"].to_numpy(), batch["gain"].to_numpy()
            bucket = -1 - layout.word_bucket(word)
            order = np.argsort(bucket, kind="stable")
            word, n, gain = word[order], n[order], gain[order]
            yield as_rows([(b, WORD, None, packed(word[i:j]), packed(n[i:j]), packed(gain[i:j])) for b, i, j in runs(bucket[order])])

    def summed(part: pa.Table) -> pa.Table:
        own = pc.is_valid(part["place"])
        docs, rows = part.filter(own), part.filter(pc.invert(own)).select(names[:6]).to_pylist()
        x, y, hits = np.zeros(docs.num_rows), np.zeros(docs.num_rows), np.zeros(docs.num_rows, dtype=np.int64)
        for r in sorted(rows, key=lambda r: r["bucket"]):
            places = np.cumsum(unpacked(r["places"], np.uint32), dtype=np.int64)
            y[places] += unpacked(r["y"], np.float64)
            if r["x"] is not None:
                x[places] += unpacked(r["x"], np.float64)
                hits[places] += unpacked(r["hits"], np.float64).astype(np.int64)
        at, (n, base, score) = docs["place"].to_numpy(), (docs[c].to_numpy() for c in ("n_known", "base", "score"))
        return pa.table([docs["doc_id"], docs["held_out"], docs["n_tokens"], pa.array(n + hits[at]), pa.array(base + x[at]), pa.array(score + y[at])], names=[c for c in OWN if c != "place"])

    known = state.pairs.unionByName(state.seated).unionByName(state.answers.filter("bucket >= 0")).unionByName(rare.mapInArrow(bucketed, ROW))
    own = f"doc_id {id_type}, held_out boolean, {{}}n_tokens long, n_known long, base double, score double"
    answers = known.groupBy("bucket").cogroup(asked_of(docs, head, DOC, REQUEST, ASKED).groupBy("bucket")).applyInArrow(
        found, "bucket int, block long, places binary, x binary, y binary, hits binary, " + own.format("place int, ")
    )
    return answers.groupBy("block").applyInArrow(summed, own.format(""))


def above(counts: DataFrame) -> int:
    """The count beyond which words are the head, which has lm.HEAD words at most."""
    words = 0
    for row in counts.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.desc("n")).collect():  # a row per distinct count
        words += row["words"]
        if words > lm.HEAD:
            return row["n"]
    return 0


def score(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    spark = docs.sparkSession
    shared_dir(spark)
    docs = docs.select("doc_id", (crc_bucket("doc_id", 10) == 0).alias("held_out"), "text")
    train = docs.filter("not held_out")
    ends = train.select("doc_id").count()
    counts = stored(lm.word_counts(train).unionByName(spark.range(1).selectExpr("id as word", f"{ends}L as n").filter("n > 0")))
    sums = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    tokens, distinct = sums[0], sums[1]
    hot = counts.filter(F.col("n") > BUCKET).toArrow()  # fewer than tokens / BUCKET
    order = np.argsort(hot["word"].to_numpy().view(U64))
    customers = hot["n"].to_numpy()[order]
    layout = Layout(max(16, ceil(tokens / BUCKET)), max(16, ceil(tokens / WORDS)), hot["word"].to_numpy().view(U64)[order], customers, -(-customers // BUCKET), tokens, distinct)
    state = seating(train, layout)
    gains = stored(word_gains(state, counts, layout))
    dropped(counts)
    least = above(gains)
    top = gains.filter(F.col("n") > least).toArrow()
    order = np.argsort(top["word"].to_numpy().view(U64))
    head = Head(top["word"].to_numpy().view(U64)[order], top["n"].to_numpy()[order], top["gain"].to_numpy()[order], float(np.log10(state.uniform / state.over)), layout)
    total = float(np.log10(tokens + 0.1 * (distinct + 1)))
    return looked_up(docs, state, gains.filter(F.col("n") <= least), head).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), (F.col("base") - F.col("n_tokens") * total).alias("base_score"), "score"
    )


def op9_pitman_yor_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
