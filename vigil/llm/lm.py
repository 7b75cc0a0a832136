"""Scoring texts by a hierarchical Pitman-Yor bigram model of bounded size; bigrams has that of all words, which op9 is.

Tokens are lower-cased words and one end per document. Every training token is
counted exactly. The DISHES most frequent words are dishes of the model, and so is
the end; any other word shares a dish with the words of its length, and is then
told apart by its own smoothed count. Each dish is also a context: a restaurant of
its own, whose customers are the bigram counts, and whose tables send customers to
the parent restaurant that all contexts share; the parent's base is uniform.

Tables are sampled by Gibbs: given all other tables, the number of tables of a
dish with c customers has the probabilities S(c, t) P^t (theta | d)_T, with
generalised Stirling numbers S and the parent's predictive probability P; a gamma
variable takes the last factor apart, so that the dishes of a restaurant are sampled
side by side. Contexts are sampled in Spark tasks against one state of the parent,
then the parent from their tables, and so on; each turn goes on from the seating of
the one before. The first turns are burn-in; predictive probabilities are averaged over
the samples of the last round. The restaurants' size is bounded by DISHES squared,
so the averaged model may be broadcast; counts of words are not bounded, so those
beyond the HEAD most frequent are looked up by a join.

Defined results: null and empty texts are one end token; a null id is learned
from not (its remainder counts as 0) and scored as held out; with no training rows
all words are unknown and N is 0; repeated rows count and are scored each; columns
beside doc_id and text take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import U64, Powers, byte_values, crc_bucket, received, sent, separators, shared_dir, signed, slices, stored, words

#: Words that are dishes; words whose counts are broadcast (16 bytes each); classes of other words, by length.
DISHES, HEAD, CLASSES = 2048, 2**19, 16
#: Discount and concentration of the contexts and of their parent.
CONTEXT, PARENT = (0.75, 5.0), (0.6, 20.0)
#: Rounds of contexts and parent before those that count, samples per round; customers up to which Stirling numbers are tabulated.
ROUNDS, SAMPLES, CUSTOMERS = 3, 3, 512
#: Words that a task gathers before it passes them on; looked-up words in a bucket, about.
GATHER, BUCKET = 4_000_000, 1_000_000


def word_keys(column: pa.Array, powers: Powers) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(keys, bounds) of slices of the column: 60 bits of a word's hash and 4 of its class; bounds of the documents."""
    values, blank = byte_values(lower=True), separators()
    for part in slices(column):
        found = words(part, values, blank, powers)
        yield (found.hash & ~U64(CLASSES - 1)) | np.minimum(found.length - 1, CLASSES - 1).astype(U64), found.bounds


def word_counts(train: DataFrame) -> DataFrame:
    """(word, n) of all training words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, gathered, size = Powers(), [], 0

        def summed() -> pa.RecordBatch:
            word, n = np.unique(np.concatenate(gathered), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(signed(word)), pa.array(n.astype(np.int64))], names=["word", "n"])

        for batch in batches:
            for keys, _ in word_keys(batch["text"], powers):
                gathered.append(keys)
                size += len(keys)
                if size >= GATHER:
                    yield summed()
                    gathered, size = [], 0
        if size:
            yield summed()

    return train.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Vocabulary(NamedTuple):
    """Head words (those with counts beyond above) with counts; the sorted dish words; N, V, end tokens; tokens and words of each class."""

    head: np.ndarray
    counts: np.ndarray
    dishes: np.ndarray
    dish_counts: np.ndarray
    tokens: int
    distinct: int
    ends: int
    class_tokens: np.ndarray
    class_words: np.ndarray
    above: int

    @property
    def end(self) -> int:
        return len(self.dishes) + CLASSES

    def dish(self, keys: np.ndarray) -> np.ndarray:
        """The dish of each word: its own place, or that of its class after them."""
        own = len(self.dishes) + (keys & U64(CLASSES - 1)).astype(np.int64)
        if not len(self.dishes):
            return own
        at = np.minimum(np.searchsorted(self.dishes, keys), len(self.dishes) - 1)
        return np.where(self.dishes[at] == keys, at, own)


def vocabulary(counts: DataFrame, documents: int) -> Vocabulary:
    """What is broadcast of the counts: at most HEAD words, those above a count that the counts' histogram gives."""
    histogram = counts.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.desc("n")).collect()  # a row per distinct count
    words_so_far, above = 0, 0
    for row in histogram:
        words_so_far += row["words"]
        if words_so_far > HEAD:
            above = row["n"]
            break
    top = counts.filter(F.col("n") > above).toArrow()
    head, n = top["word"].to_numpy().view(U64), top["n"].to_numpy()
    order = np.argsort(head)
    head, n = head[order], n[order]
    first = np.sort(np.lexsort((head, -n))[:DISHES])
    classes = counts.groupBy(F.col("word").bitwiseAND(CLASSES - 1).alias("c")).agg(F.sum("n").alias("tokens"), F.count("*").alias("words")).collect()
    class_tokens, class_words = np.zeros(CLASSES), np.zeros(CLASSES)
    for row in classes:
        class_tokens[row["c"]], class_words[row["c"]] = row["tokens"], row["words"]
    tokens, distinct = int(class_tokens.sum()) + documents, int(class_words.sum()) + (documents > 0)
    own = (head[first] & U64(CLASSES - 1)).astype(np.int64)
    class_tokens -= np.bincount(own, n[first], minlength=CLASSES)
    class_words -= np.bincount(own, minlength=CLASSES)
    return Vocabulary(head, n, head[first], n[first], tokens, distinct, documents, class_tokens, class_words, above)


def bigram_counts(train: DataFrame, known: Vocabulary) -> DataFrame:
    """(context, dish, n) of all training texts; a text begins in the context of the end."""
    shared = sent(train.sparkSession, known)
    width = known.end + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, vocabulary, gathered, size = Powers(), received(shared), [], 0

        def summed() -> pa.RecordBatch:
            pair, n = np.unique(np.concatenate(gathered), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array((pair // width).astype(np.int32)), pa.array((pair % width).astype(np.int32)), pa.array(n.astype(np.int64))], names=["context", "dish", "n"])

        for batch in batches:
            for keys, bounds in word_keys(batch["text"], powers):
                dish, context = with_ends(vocabulary.dish(keys), bounds, vocabulary.end)
                gathered.append(context * width + dish)
                size += len(dish)
                if size >= GATHER:
                    yield summed()
                    gathered, size = [], 0
        if size:
            yield summed()

    return train.select("text").mapInArrow(run, "context int, dish int, n long").groupBy("context", "dish").agg(F.sum("n").alias("n"))


def with_ends(dish: np.ndarray, bounds: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """(dish, context) of all tokens, an end after each document's words."""
    dish = np.insert(dish, bounds[1:], end)
    return dish, np.concatenate([[end], dish[:-1]]).astype(np.int64)


def stirling(discount: float) -> np.ndarray:
    """Logarithms of the generalised Stirling numbers S(c, t) for c and t up to CUSTOMERS."""
    out = np.full((CUSTOMERS + 1, CUSTOMERS + 1), -np.inf)
    out[0, 0] = 0
    t = np.arange(CUSTOMERS + 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        for c in range(CUSTOMERS):
            stay = out[c] + np.log(np.maximum(c - t * discount, 0))
            out[c + 1] = np.logaddexp(stay, np.concatenate([[-np.inf], out[c, :-1]]))
    return out


class Restaurant:
    """Customers c of some dishes, and the tables t that seat them: one each at first, or those of an earlier state."""

    CELLS = 1_000_000

    def __init__(self, customers: np.ndarray, settings: tuple[float, float], numbers: np.ndarray, seed: int, tables: np.ndarray | None = None) -> None:
        self.c, (self.d, self.theta), self.numbers = customers, settings, numbers
        self.random = np.random.default_rng(seed)
        self.t = np.ones(len(customers)) if tables is None else np.clip(tables, 1, customers)

    def sweep(self, parent: np.ndarray) -> None:
        """Samples all tables anew, given the parent's probabilities of the dishes.

        With z drawn from a gamma distribution of shape theta / d + all tables, the dishes no longer depend on each other:
        t has the weight S(c, t) (d z P)^t. Up to CUSTOMERS customers it is drawn from that, and beyond from its limit; the
        number of tables has no bound but c.
        """
        self.draw(self.random.gamma(self.theta / self.d + self.t.sum()) * parent)

    def draw(self, rate: np.ndarray) -> None:
        """Samples all tables, given z P of each dish."""
        share = np.maximum(self.d * rate, 1e-300)
        order = np.flatnonzero(self.c > 1)
        order = order[np.argsort(self.c[order], kind="stable")]
        seated = np.minimum(self.c, CUSTOMERS).astype(np.int64)
        low = 0
        while low < len(order):
            high = min(len(order), low + max(1, self.CELLS // CUSTOMERS))
            at = order[low:high]
            most = int(seated[at[-1]])
            weight = self.numbers[seated[at], 1 : most + 1] + np.arange(1, most + 1) * np.log(share[at])[:, None]
            weight -= weight.max(axis=1, keepdims=True)
            sums = np.cumsum(np.exp(weight), axis=1)
            self.t[at] = 1 + np.minimum(most - 1, (sums < self.random.random(len(at))[:, None] * sums[:, -1:]).sum(axis=1))
            low = high
        at = np.flatnonzero(self.c > CUSTOMERS)
        self.t[at] = self.of_many(self.c[at], share[at] / self.d)

    def of_many(self, c: np.ndarray, rate: np.ndarray) -> np.ndarray:
        """Tables of many customers. S(c, t) (d rate)^t is, up to a constant, the probability that t is Poisson with that rate
        and t sizes of the law whose generating function is 1 - (1 - x)^d sum to c; tilted to the x at which c is what they
        are expected to sum to, t is normal given the sum, or, where tables are few, 1 and a Poisson number."""
        low, high = np.full(len(c), -1000.0), np.zeros(len(c))
        for _ in range(60):  # halves for the logarithm of y = 1 - x: rate d x y^(d - 1) = c
            y = (low + high) / 2
            above = np.log(rate * self.d) + np.log1p(-np.exp(y)) + (self.d - 1) * y > np.log(c)
            low, high = np.where(above, y, low), np.where(above, high, y)
        y = np.exp((low + high) / 2)
        mean, x = rate * -np.expm1(self.d * np.log(y)), 1 - y
        spread = mean - c**2 / (rate * self.d * (x * y ** (self.d - 1) + x * x * (1 - self.d) * y ** (self.d - 2)))
        many = np.round(self.random.normal(mean + 1, np.sqrt(np.maximum(spread, 0))))
        return np.clip(np.where(mean < 30, 1 + self.random.poisson(np.minimum(mean, 30)), many), 1, c)

    def predictive(self, parent: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Probabilities of all dishes; own has the places of this restaurant's."""
        total = self.theta + self.c.sum()
        out = (self.theta + self.d * self.t.sum()) / total * parent
        out[own] += np.maximum(self.c - self.d * self.t, 0) / total
        return out


def sampled(counts: DataFrame, width: int) -> np.ndarray:
    """log10 of the averaged predictive probabilities, [context, dish].

    The seating goes on from turn to turn; the turns before the last are its burn-in, and the last one's samples are averaged.
    """
    base = np.full(width, 1 / width)
    parent, upper = base, {}

    def run(state: np.ndarray, last: bool, turn: int):
        def seat(part: pa.Table) -> pa.Table:
            context, dish = part["context"][0].as_py(), part["dish"].to_numpy()
            order = np.argsort(dish)
            dish, n, tables = dish[order], part["n"].to_numpy()[order].astype(float), part["tables"].to_numpy()[order]
            room = Restaurant(n, CONTEXT, stirling_once(CONTEXT[0]), context * 1000 + turn, tables)
            mean = np.zeros(width)
            for _ in range(SAMPLES):
                room.sweep(state[dish])
                if last:
                    mean += room.predictive(state, dish) / SAMPLES
            if last:
                return pa.table({"context": pa.array([context], pa.int32()), "row": pa.array([np.log10(mean).astype(np.float32).tobytes()], pa.binary())})
            return pa.table({"context": part["context"], "dish": pa.array(dish, pa.int32()), "n": pa.array(n.astype(np.int64)), "tables": pa.array(room.t)})

        return seat

    seated = counts.withColumn("tables", F.lit(1.0))
    for turn in range(ROUNDS):
        seated = stored(seated.groupBy("context").applyInArrow(run(parent, False, turn), "context int, dish int, n long, tables double"))
        tables = seated.groupBy("dish").agg(F.sum("tables").alias("tables")).orderBy("dish").collect()  # a row per dish
        dish, n = np.array([r["dish"] for r in tables], dtype=np.int64), np.array([r["tables"] for r in tables])
        room = Restaurant(n, PARENT, stirling_once(PARENT[0]), turn, np.array([upper.get(x, 1.0) for x in dish.tolist()]))
        mean = np.zeros(width)
        for _ in range(SAMPLES):
            room.sweep(base[dish])
            mean += room.predictive(base, dish) / SAMPLES
        parent, upper = mean, dict(zip(dish.tolist(), room.t, strict=True))
    rows = seated.groupBy("context").applyInArrow(run(parent, True, ROUNDS), "context int, row binary").collect()  # at most a row per dish
    out = np.tile(np.log10(parent).astype(np.float32), (width, 1))
    for row in rows:
        out[row["context"]] = np.frombuffer(row["row"], dtype=np.float32)
    return out


STIRLING: dict[float, np.ndarray] = {}


def stirling_once(discount: float) -> np.ndarray:
    if discount not in STIRLING:
        STIRLING[discount] = stirling(discount)
    return STIRLING[discount]


def partial_scores(docs: DataFrame, known: Vocabulary, model: np.ndarray, buckets: int) -> DataFrame:
    """A row per document with what head words and the model give, and packed rows of the words to look up.

    block and place tell a document from the others; bucket is -1 in its row.
    """
    shared = sent(docs.sparkSession, (known, model))
    names = ["doc_id", "held_out", "block", "place", "bucket", "n_tokens", "n_known", "base", "score", "words", "places"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, (vocabulary, model) = Powers(), received(shared)
        class_log = np.log10(np.maximum(vocabulary.class_tokens, 0) + 0.1 * (np.maximum(vocabulary.class_words, 0) + 1))
        count_log, end_log = np.log10(vocabulary.counts + 0.1), np.log10(vocabulary.ends + 0.1)
        first = TaskContext.get().partitionId() << 24
        block, place, gathered, size = first, 0, [], 0

        def requests() -> pa.RecordBatch:
            word, at = (np.concatenate(x) for x in zip(*gathered, strict=True))
            order = np.argsort(word)
            word, at = word[order], at[order]
            cut = np.searchsorted(((word >> U64(32)) * U64(buckets)) >> U64(32), np.arange(buckets + 1, dtype=U64))
            full = np.flatnonzero(cut[1:] > cut[:-1])
            n, kinds = len(full), dict(zip(names, docs_types, strict=True))
            columns = {"block": pa.array(np.full(n, block)), "bucket": pa.array(full, pa.int32())}
            columns["words"] = pa.array([word[cut[b] : cut[b + 1]].tobytes() for b in full], pa.binary())
            columns["places"] = pa.array([at[cut[b] : cut[b + 1]].tobytes() for b in full], pa.binary())
            return pa.RecordBatch.from_arrays([columns.get(x, pa.nulls(n, kinds[x])) for x in names], names=names)

        for batch in batches:
            docs_types = [batch["doc_id"].type, pa.bool_(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.binary()]
            row = 0
            for keys, bounds in word_keys(batch["text"], powers):
                n = len(bounds) - 1
                doc = np.repeat(np.arange(n), np.diff(bounds))
                dish = vocabulary.dish(keys)
                at = np.minimum(np.searchsorted(vocabulary.head, keys), max(0, len(vocabulary.head) - 1))
                inside = vocabulary.head[at] == keys if len(vocabulary.head) else np.zeros(len(keys), dtype=bool)
                logs = np.where(inside, count_log[at] if len(count_log) else 0.0, 0.0)
                other = dish >= len(vocabulary.dishes)
                own = np.where(other, logs - class_log[np.maximum(dish - len(vocabulary.dishes), 0)], 0.0)
                path, context = with_ends(dish, bounds, vocabulary.end)
                path_doc = np.repeat(np.arange(n), np.diff(bounds) + 1)
                score = np.bincount(path_doc, model[context, path], minlength=n) + np.bincount(doc, own, minlength=n)
                base = np.bincount(doc, logs, minlength=n) + end_log
                n_known = np.bincount(doc, inside, minlength=n).astype(np.int64) + (vocabulary.ends > 0)
                part = batch.slice(row, n)
                arrays = [part["doc_id"], part["held_out"], pa.array(np.full(n, block)), pa.array(np.arange(place, place + n, dtype=np.int32)), pa.array(np.full(n, -1, dtype=np.int32))]
                arrays += [pa.array(np.diff(bounds) + 1), pa.array(n_known), pa.array(base), pa.array(score), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=names)
                gathered.append((keys[~inside], (place + doc[~inside]).astype(np.uint32)))
                size, row, place = size + len(gathered[-1][0]), row + n, place + n
                if size >= GATHER // 4:
                    yield requests()
                    block, place, gathered, size = block + 1, 0, [], 0
        if size:
            yield requests()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, held_out boolean, block long, place int, bucket int, n_tokens long, n_known long, base double, score double, words binary, places binary")


def looked_up(requests: DataFrame, counts: DataFrame, buckets: int) -> DataFrame:
    """(block, place, log, known): per document the sum of log10(c + 0.1) over its words to look up, and how many are known."""
    # the bucket of a word: its upper half as an unsigned number, times buckets, over 2**32
    bucket = F.shiftright(F.shiftrightunsigned("word", 32) * F.lit(buckets), 32).cast("int")
    left = counts.select(bucket.alias("bucket"), "word", "n").groupBy("bucket")
    right = requests.select("bucket", "block", "words", "places").groupBy("bucket")

    def answer(known: pa.Table, asked: pa.Table) -> pa.Table:
        word, n = known["word"].to_numpy().view(U64), known["n"].to_numpy()
        order = np.argsort(word)
        word, n = word[order], n[order]
        rows = []
        for block, keys, at in zip(asked["block"].to_pylist(), asked["words"].to_pylist(), asked["places"].to_pylist(), strict=True):
            keys, at = np.frombuffer(keys, dtype=U64), np.frombuffer(at, dtype=np.uint32)
            if len(word):
                found = np.minimum(np.searchsorted(word, keys), len(word) - 1)
                c = np.where(word[found] == keys, n[found], 0)
            else:
                c = np.zeros(len(keys))
            place, inverse = np.unique(at, return_inverse=True)
            log, hit = np.bincount(inverse, np.log10(c + 0.1)), np.bincount(inverse, c > 0).astype(np.uint32)
            rows.append((block, place.tobytes(), log.tobytes(), hit.tobytes()))
        columns = list(zip(*rows, strict=True)) or [()] * 4
        return pa.table([pa.array(columns[0], pa.int64()), *(pa.array(x, pa.binary()) for x in columns[1:])], names=["block", "places", "logs", "hits"])

    def summed(part: pa.Table) -> pa.Table:
        place = np.concatenate([np.frombuffer(x, dtype=np.uint32) for x in part["places"].to_pylist()])
        log = np.concatenate([np.frombuffer(x, dtype=np.float64) for x in part["logs"].to_pylist()])
        hit = np.concatenate([np.frombuffer(x, dtype=np.uint32) for x in part["hits"].to_pylist()])
        logs, hits = np.bincount(place, log), np.bincount(place, hit)
        some = np.unique(place)
        return pa.table([pa.array(np.full(len(some), part["block"][0].as_py())), pa.array(some.astype(np.int32)), pa.array(logs[some]), pa.array(hits[some].astype(np.int64))], names=["block", "place", "log", "known"])

    answers = left.cogroup(right).applyInArrow(answer, "block long, places binary, logs binary, hits binary")
    return answers.groupBy("block").applyInArrow(summed, "block long, place int, log double, known long")


def score(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    shared_dir(docs.sparkSession)
    docs = docs.select("doc_id", (crc_bucket("doc_id", 10) == 0).alias("held_out"), "text")
    train = docs.filter("not held_out")
    counts = stored(word_counts(train))
    known = vocabulary(counts, train.select("doc_id").count())
    model = sampled(bigram_counts(train, known).checkpoint(), known.end + 1)
    rest = counts.filter(F.col("n") <= known.above)
    buckets = max(16, ceil(known.tokens * 0.25 / BUCKET))
    parts = stored(partial_scores(docs, known, model, buckets))
    found = looked_up(parts.filter("bucket >= 0"), rest, buckets)
    total = float(np.log10(known.tokens + 0.1 * (known.distinct + 1)))
    whole = parts.filter("bucket < 0").join(found, ["block", "place"], "left")
    log = F.coalesce("log", F.lit(0.0))
    return whole.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"), F.lit(known.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + log - F.col("n_tokens") * total).alias("base_score"), (F.col("score") + log).alias("score"),
    )
