"""Repeated passages by recompression: equal stretches of words get equal symbols, wherever they stand.

Recompression takes turns. A turn names each maximal run of one symbol by symbol
and length, then each pair of neighbours of which the first is of the left and
the second of the right class; a symbol's class is drawn anew for each turn from
a hash of the symbol. Whether two neighbours become one depends on the two alone,
so a stretch of words is compressed alike wherever it occurs, but for some
symbols at its ends. Names are hashes of what they stand for, so they are global:
all tasks of a round give the same names without asking each other.

Three rounds over Spark find every window of words that occurs in a document with
a smaller id:

1.  Texts become chunks of about CHUNK bytes. A chunk asks, for its symbols of the
    turns HIGH (some 100 and 1,000 words each), for the smallest document that
    has them: a shared one covers all its windows at once, so that copies are not
    looked at window by window. It asks too whether other chunks have its
    windows. A window is named by what its compression leaves: at each turn the
    symbols at its ends that the words around it might change are taken off, and
    the sequence of all that is taken off names it.
2.  Windows that others have, and that no shared symbol covers, are opened: their
    names go out in full, with a fingerprint of their words that does not come
    from the symbols, and the smallest document of each comes back.
3.  A chunk removes the words that covered or opened windows of smaller documents
    hold.

Leaving out covered windows loses nothing: in the smallest document that has a
window no symbol of a smaller one can cover it. In the first round 24 bits stand
for a window within its bucket (one in 64 is opened in vain), and 96 in the second; symbols have 128. Questions
go from chunks to buckets of the name and back, a name once for each chunk, so a
passage that all documents share is one entry for each chunk and no hot key. There
are more buckets for more words, each of about BUCKET windows; a row holds all that
a chunk asks a bucket, so there are at most as many rows as windows.

Defined results: null and empty texts have no words; texts of fewer words than a
window have none; rows that share an id do not remove each other's words; a null
id is larger than any other; columns beside doc_id and text take no part; texts
are taken whole, and a text longer than a chunk is a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.common import U64, Powers, byte_values, mix64, separators, slices, stored, table, words

WINDOW, CHUNK, BUCKET = 13, 1_000_000, 1 << 18
#: The turns whose symbols are asked for, if they have the words of two windows at least.
HIGH = (16, 24)
#: Odd factors and seeds of names.
LEFT, RIGHT, COUNT, CLASS, PRINT = (U64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB))
NONE = np.iinfo(np.int64).max


class Turn(NamedTuple):
    """Symbols before a turn, the runs among them, and which runs stay alone or begin a pair (heads); is_left: their classes."""

    symbols: np.ndarray
    runs: np.ndarray
    run_of: np.ndarray
    is_left: np.ndarray
    names: np.ndarray
    heads: np.ndarray
    place: np.ndarray


def turns(symbols: np.ndarray, doc: np.ndarray) -> Iterator[tuple[Turn, np.ndarray, np.ndarray]]:
    """Turn after turn: (turn, symbols after it, first word of each), without end. doc: of each word."""
    start = np.arange(len(symbols))
    number = 0
    while True:
        number += 1
        own = doc[start]
        fresh = np.ones(len(symbols), dtype=bool)
        fresh[1:] = (symbols[1:] != symbols[:-1]) | (own[1:] != own[:-1])
        runs = np.flatnonzero(fresh)
        count = np.diff(np.append(runs, len(symbols)))
        names = symbols[runs]
        with np.errstate(over="ignore"):
            many = count > 1
            names[many] = mix64(names[many] * COUNT + count[many].astype(U64))
            is_left = (mix64(names * CLASS + U64(number)) >> U64(63)) == 0
            own = own[runs]
            paired = is_left[:-1] & ~is_left[1:] & (own[:-1] == own[1:])
            first = np.append(paired, False)[: len(names)]
            head = np.ones(len(names), dtype=bool)
            head[1:] = ~paired
            heads = np.flatnonzero(head)
            after = names[heads]
            both = np.flatnonzero(first[heads])
            after[both] = mix64(after[both] * LEFT + mix64(names[heads[both] + 1] * RIGHT))
        turn = Turn(symbols, np.append(runs, len(symbols)), np.cumsum(fresh) - 1, is_left, names, heads, np.append(np.cumsum(head) - 1, len(heads)))
        symbols, start = after, start[runs[heads]]
        yield turn, symbols, start


def window_names(compressed: list[Turn], starts: np.ndarray, width: int) -> np.ndarray:
    """A name of each window of so many words, from the symbols that come off its ends turn by turn."""
    out = np.zeros(len(starts), dtype=U64)
    which, low, high = np.arange(len(starts)), starts, starts + width
    left, right = np.full(len(starts), LEFT), np.full(len(starts), RIGHT)
    with np.errstate(over="ignore"):
        for turn in compressed:
            one, other = turn.run_of[low], turn.run_of[high - 1]
            size = np.minimum(turn.runs[one + 1], high) - low
            left = left * LEFT + turn.symbols[low] + size.astype(U64) * COUNT
            size = high - np.maximum(turn.runs[other], low)
            last = one < other
            right = np.where(last, right * RIGHT + turn.symbols[high - 1] + size.astype(U64) * COUNT, right)
            low, high = one + 1, np.maximum(other, one + 1)
            off = (low < high) & ~turn.is_left[np.minimum(low, len(turn.names) - 1)]
            left = np.where(off, left * LEFT + turn.names[np.minimum(low, len(turn.names) - 1)], left)
            low = low + off
            off = (low < high) & turn.is_left[high - 1]
            right = np.where(off, right * RIGHT + turn.names[high - 1], right)
            high = high - off
            done = low >= high
            out[which[done]] = mix64(mix64(left[done]) * CLASS + right[done])
            if done.all():
                break
            which, left, right, low, high = which[~done], left[~done], right[~done], turn.place[low[~done]], turn.place[high[~done]]
    return out


class Chunk:
    """The words of a chunk's texts, their windows, and their symbols."""

    def __init__(self, row: dict, width: int, powers: Powers) -> None:
        data = pa.decompress(row["data"], decompressed_size=row["bytes"], codec="zstd") if row["bytes"] else b""
        texts = pa.StringArray.from_buffers(len(row["ids"]), pa.py_buffer(np.cumsum([0, *row["lengths"]], dtype=np.int32)), data if isinstance(data, pa.Buffer) else pa.py_buffer(data))
        part = next(slices(texts, most=row["bytes"] + 1))
        self.part, self.words = part, words(part, byte_values(lower=False), separators(), powers)
        self.ids = np.array([NONE if x is None else x for x in row["ids"]], dtype=np.int64)
        doc = self.words.doc
        self.doc, self.order = doc, self.ids[doc]
        n = len(doc)
        self.windows = np.flatnonzero(doc[: n - width + 1] == doc[width - 1 :]) if n >= width else np.zeros(0, dtype=np.int64)
        self.width, self.powers = width, powers

    def compress(self, most: int) -> None:
        """Turns for window names; with most, those of HIGH as well."""
        self.turns, self.symbols = [], []
        for number, (turn, symbols, start) in enumerate(turns(self.words.hash, self.doc), 1):
            if number <= self.width:  # a turn takes two symbols at least off a window
                self.turns.append(turn)
            if number in HIGH:
                self.symbols.append((symbols, start))
            if number >= most:
                break

    def names(self) -> np.ndarray:
        return window_names(self.turns, self.windows, self.width)

    def prints(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Fingerprints of stretches of words, from the words alone."""
        n = len(self.doc)
        up, down = self.powers.to(n + 1)
        with np.errstate(over="ignore"):
            sums = np.zeros(n + 1, dtype=U64)
            np.cumsum(mix64(self.words.hash ^ PRINT) * up[:n], out=sums[1:])
            return mix64((sums[end] - sums[start]) * down[start] + (end - start).astype(U64))

    def passages(self) -> tuple[np.ndarray, ...]:
        """(name, print, start, end) of the symbols of HIGH that have enough words."""
        start = np.concatenate([s for _, s in self.symbols])
        end = np.concatenate([np.append(s[1:], len(self.doc))[: len(s)] for _, s in self.symbols])
        name = np.concatenate([x for x, _ in self.symbols])
        long = end - start >= 2 * self.width
        start, end, name = start[long], end[long], name[long]
        return name, self.prints(start, end), start, end


def chunked(docs: DataFrame) -> DataFrame:
    """(chunk, n_words, ids, lengths, bytes, data): texts in chunks of CHUNK bytes, compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, k = TaskContext.get().partitionId() << 32, 0
        values, blank, powers = byte_values(lower=False), separators(), Powers()
        codec = pa.Codec("zstd", compression_level=5)  # texts are stored once and shuffled twice
        for batch in batches:
            ids = batch["doc_id"].cast(pa.int64())
            for part in slices(batch["text"], most=CHUNK):
                rows = {"chunk": [task + k], "n_words": [len(words(part, values, blank, powers).start)], "ids": [ids[part.first : part.last]], "lengths": [(part.ends - part.starts).tolist()], "bytes": [len(part.data)], "data": [codec.compress(part.data.tobytes(), asbytes=True)]}
                k += 1
                yield pa.RecordBatch.from_pydict(rows, schema=pa.schema([("chunk", pa.int64()), ("n_words", pa.int64()), ("ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("bytes", pa.int64()), ("data", pa.binary())]))

    return docs.select("doc_id", "text").mapInArrow(run, "chunk long, n_words long, ids array<long>, lengths array<long>, bytes long, data binary")


def shares(bucket: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The columns' entries for each bucket, in their order."""
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    parts = [np.split(c[order], cuts) for c in columns]
    for i, at in enumerate([0, *cuts] if len(bucket) else []):
        yield int(bucket[at]), [p[i] for p in parts]


def smallest_of(names: np.ndarray, prints: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """For each entry the smallest document among those of equal name and print."""
    order = np.lexsort((docs, prints, names))
    n, p = names[order], prints[order]
    first = np.ones(len(n), dtype=bool)
    first[1:] = (n[1:] != n[:-1]) | (p[1:] != p[:-1])
    out = np.empty(len(n), dtype=np.int64)
    out[order] = docs[order][np.maximum.accumulate(np.where(first, np.arange(len(n)), 0))]
    return out


def distinct(names: np.ndarray, prints: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, which, smallest): a place of each distinct name and print, the distinct one of each entry, and its smallest document here."""
    order = np.lexsort((docs, prints, names))
    n, p = names[order], prints[order]
    fresh = np.ones(len(n), dtype=bool)
    fresh[1:] = (n[1:] != n[:-1]) | (p[1:] != p[:-1])
    first = order[fresh]
    which = np.empty(len(n), dtype=np.int64)
    which[order] = np.cumsum(fresh) - 1
    return first, which, docs[first]


def opened_here(names: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Which windows another document of the same chunk has."""
    _, which, low = distinct(names, names, order)
    high = np.full(len(low), np.iinfo(np.int64).min)
    np.maximum.at(high, which, order)
    return (high > low)[which]


def short(names: np.ndarray) -> np.ndarray:
    """24 bits of each name, apart from those that choose the bucket."""
    return (names >> U64(40)).astype(np.uint32)


def flat(value: np.ndarray) -> bytes:
    return value.tobytes()


def in_three_bytes(values: np.ndarray) -> bytes:
    return values.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3].tobytes()


def from_three_bytes(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 3, 4), dtype=np.uint8)
    out[:, :3] = np.frombuffer(data, np.uint8).reshape(-1, 3)
    return out.view("<u4").ravel()


def numbers(column: pa.ChunkedArray, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """All entries of a column of binaries, and how many are of each row."""
    rows = column.to_pylist()
    size = np.dtype(kind).itemsize
    return np.frombuffer(b"".join(rows), dtype=kind), np.array([len(x) // size for x in rows], dtype=np.int64)


def first_questions(chunks: DataFrame, width: int, buckets: int) -> DataFrame:
    """(bucket, chunk, hashes, names, prints, docs): windows, 24 bits each, and high symbols."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            for row in batch.to_pylist():
                c = Chunk(row, width, powers)
                c.compress(max(HIGH))
                rows = {}
                names = np.unique(c.names())
                for bucket, (hashes,) in shares((names % U64(buckets)).astype(np.int64), short(names)):
                    rows[bucket] = [in_three_bytes(np.unique(hashes)), b"", b"", b""]
                name, mark, start, _ = c.passages()
                first, _, low = distinct(name, mark, c.order[start])
                name, mark = name[first], mark[first]
                for bucket, own in shares((name % U64(buckets)).astype(np.int64), name, mark, low):
                    rows.setdefault(bucket, [b""] * 4)[1:] = map(flat, own)
                yield pa.RecordBatch.from_arrays([pa.array(list(rows), pa.int32()), pa.array([row["chunk"]] * len(rows), pa.int64()), *(pa.array([r[k] for r in rows.values()], pa.binary()) for k in range(4))], names=["bucket", "chunk", "hashes", "names", "prints", "docs"])

    return chunks.mapInArrow(run, "bucket int, chunk long, hashes binary, names binary, prints binary, docs binary")


def first_answers(questions: DataFrame) -> DataFrame:
    """(chunk, bucket, hashes, names, docs): windows that other chunks have, and symbols that smaller documents of others have."""

    def answer(part: pa.Table) -> pa.Table:
        rows = part["hashes"].to_pylist()
        hashes, sizes = from_three_bytes(b"".join(rows)), [len(x) // 3 for x in rows]
        kept = np.sort(hashes)
        again = np.unique(kept[1:][kept[1:] == kept[:-1]])
        there = np.isin(hashes, again, assume_unique=False) if len(again) else np.zeros(len(hashes), dtype=bool)
        cuts = np.cumsum(sizes)
        names, sizes = numbers(part["names"], U64)
        marks, docs = numbers(part["prints"], U64)[0], numbers(part["docs"], np.int64)[0]
        low = smallest_of(names, marks, docs)
        smaller, name_cuts = low < docs, np.cumsum(sizes)
        rows, a, b = [], 0, 0
        for i, chunk in enumerate(part["chunk"].to_pylist()):
            h, s = there[a : cuts[i]], smaller[b : name_cuts[i]]
            if h.any() or s.any():
                rows.append((chunk, in_three_bytes(hashes[a : cuts[i]][h]), flat(names[b : name_cuts[i]][s]), flat(low[b : name_cuts[i]][s])))
            a, b = cuts[i], name_cuts[i]
        columns = list(zip(*rows)) if rows else [[]] * 4
        return pa.table({"chunk": pa.array(columns[0], pa.int64()), "bucket": pa.array([part["bucket"][0].as_py()] * len(rows), pa.int32()), **{x: pa.array(columns[k], pa.binary()) for k, x in ((1, "hashes"), (2, "names"), (3, "docs"))}})

    return questions.groupBy("bucket").applyInArrow(answer, "chunk long, bucket int, hashes binary, names binary, docs binary")


def with_answers(chunks: DataFrame, answers: DataFrame, *columns: str) -> DataFrame:
    """chunks with the list of their answers, null without any."""
    return chunks.join(answers.groupBy("chunk").agg(F.collect_list(F.struct(*columns)).alias("answers")), "chunk", "left")


def second_questions(answered: DataFrame, width: int, buckets: int) -> DataFrame:
    """(bucket, chunk, at, names, prints, docs): full names of opened windows, at: their places in the chunk's list.

    The row of bucket -1 is the chunk's own state: names has the words where
    opened windows start, prints the place in the list of each, docs the smallest
    document here of each in the list, and at the covered stretches.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            for row in batch.to_pylist():
                c = Chunk(row, width, powers)
                c.compress(max(HIGH))
                answers = row["answers"] or []
                covered = np.zeros(len(c.doc) + 1, dtype=np.int64)
                name, mark, start, end = c.passages()
                first, which, low = distinct(name, mark, c.order[start])
                told = {}
                for a in answers:
                    told |= zip(np.frombuffer(a["names"], U64).tolist(), np.frombuffer(a["docs"], np.int64).tolist())
                if told:
                    low = np.minimum(low, np.array([told.get(x, NONE) for x in name[first].tolist()], dtype=np.int64))
                shared = low[which] < c.order[start]
                start, end = start[shared], end[shared]
                stop = np.maximum(end - width + 1, start)
                np.add.at(covered, start, 1)
                np.add.at(covered, stop, -1)
                names = c.names()
                bucket = (names % U64(buckets)).astype(np.int64)
                known = np.concatenate([np.zeros(0, dtype=np.int64), *((a["bucket"] << 24) + from_three_bytes(a["hashes"]).astype(np.int64) for a in answers)])
                opened = opened_here(names, c.order[c.windows])
                opened |= np.isin((bucket << 24) + short(names).astype(np.int64), known)
                opened &= np.cumsum(covered)[c.windows] == 0
                windows, names, bucket = c.windows[opened], names[opened], bucket[opened]
                prints = (c.prints(windows, windows + width) >> U64(32)).astype(np.uint32)
                first, which, low = distinct(names, prints, c.order[windows])
                rows = [(-1, *(flat(x.astype(np.uint32)) for x in (np.column_stack([start, end]), windows, which)), flat(low))]
                rows += [(b, *map(flat, own)) for b, own in shares(bucket[first], np.arange(len(first)).astype(np.uint32), names[first], prints[first], low)]
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array([row["chunk"]] * len(rows), pa.int64()), *(pa.array(x, pa.binary()) for x in columns[1:])], names=["bucket", "chunk", "at", "names", "prints", "docs"])

    return answered.mapInArrow(run, "bucket int, chunk long, at binary, names binary, prints binary, docs binary")


def second_answers(questions: DataFrame) -> DataFrame:
    """(chunk, at, docs): of the windows that smaller documents of other chunks have, the smallest."""

    def answer(part: pa.Table) -> pa.Table:
        names, sizes = numbers(part["names"], U64)
        docs, at = numbers(part["docs"], np.int64)[0], numbers(part["at"], np.uint32)[0]
        low = smallest_of(names, numbers(part["prints"], np.uint32)[0], docs)
        smaller, cuts, rows, a = low < docs, np.cumsum(sizes), [], 0
        for chunk, b in zip(part["chunk"].to_pylist(), cuts):
            s = smaller[a:b]
            if s.any():
                rows.append((chunk, flat(at[a:b][s]), flat(low[a:b][s])))
            a = b
        columns = list(zip(*rows)) if rows else [[]] * 3
        return pa.table({"chunk": pa.array(columns[0], pa.int64()), "at": pa.array(columns[1], pa.binary()), "docs": pa.array(columns[2], pa.binary())})

    return questions.groupBy("bucket").applyInArrow(answer, "chunk long, at binary, docs binary")


def kept_words(answered: DataFrame, width: int) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of all documents, from chunks with their state and answers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            for row in batch.to_pylist():
                c = Chunk(row, width, powers)
                low = np.frombuffer(row["docs"], np.int64).copy()
                for a in row["answers"] or []:
                    low[np.frombuffer(a["at"], np.uint32)] = np.frombuffer(a["docs"], np.int64)
                windows, which = (np.frombuffer(row[x], np.uint32).astype(np.int64) for x in ("names", "prints"))
                windows = windows[low[which] < c.order[windows]]
                spans = np.frombuffer(row["at"], np.uint32).astype(np.int64).reshape(-1, 2)
                steps = np.zeros(len(c.doc) + 1, dtype=np.int64)
                np.add.at(steps, windows, 1)
                np.add.at(steps, windows + width, -1)
                np.add.at(steps, spans[:, 0], 1)
                np.add.at(steps, spans[:, 1], -1)
                gone = np.cumsum(steps[:-1]) > 0
                counts, removed = np.diff(c.words.bounds), np.bincount(c.doc[gone], minlength=len(c.ids))
                texts = [c.part.data[a:b].tobytes().split() for a, b in zip(c.part.starts, c.part.ends)]
                kept = [b" ".join([w for w, g in zip(t, gone[a : a + len(t)]) if not g] if r else t) for t, a, r in zip(texts, c.words.bounds, removed)]
                yield pa.RecordBatch.from_arrays([pa.array(row["ids"], pa.int64()), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])

    return answered.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string")


def without_repeats(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): each text's words, one space between, but for those in a window of so many that
    also starts in a document with a smaller id."""
    chunks = stored(chunked(docs))
    n = chunks.agg(F.sum("n_words")).first()[0] or 0
    buckets = n // BUCKET + 1
    answers = first_answers(first_questions(chunks.select("chunk", "ids", "lengths", "bytes", "data"), width, buckets))
    questions = stored(second_questions(with_answers(chunks, answers, "bucket", "hashes", "names", "docs"), width, buckets))
    answers = second_answers(questions.filter("bucket >= 0"))
    state = questions.filter("bucket < 0").drop("bucket")
    return kept_words(with_answers(chunks.join(state, "chunk"), answers, "at", "docs"), width)


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = without_repeats(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP11_SQL = r"""
    WITH texts AS (
      SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS place,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
      FROM documents),
    starts AS (SELECT r, place, words, unnest(range(1, len(words) - 11)) AS i FROM texts WHERE len(words) >= 13),
    windows AS (SELECT r, place, i, min(place) OVER (PARTITION BY array_to_string(words[i:i + 12], ' ')) AS first FROM starts),
    gone AS (SELECT DISTINCT r, unnest(range(i, i + 13)) AS i FROM windows WHERE first < place),
    singles AS (SELECT r, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM texts),
    kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS kept FROM singles ANTI JOIN gone USING (r, i) GROUP BY r),
    counts AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
    SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
    FROM texts LEFT JOIN kept USING (r) LEFT JOIN counts USING (r)"""
