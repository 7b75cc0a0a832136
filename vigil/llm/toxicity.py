"""Toxicity scores by the nearest labelled examples under exact TF-IDF cosine.

A bounded sample of labelled documents (SAMPLE a class, the smallest hashes of the id)
gives the examples, and all their terms, of either label, the vocabulary. Terms are
words and beginnings of words, each once more for texts that hold it often: a term's
frequency counts by the levels that it reaches. A term weighs its idf, over all
documents; terms that tell the labels apart beyond chance weigh as many times more
as their chi-square exceeds LEAST, since in a long text the few telling words would
not count otherwise. Texts are unit vectors of all their terms of the vocabulary.
Examples lie in an inverted index in blocks, with the largest weight of each frequent
term in each block. The queries of a slice of texts go together: rare terms are summed
over their postings, block maxima bound what frequent ones can add, and these are summed
in the blocks whose bound reaches the k-th similarity alone, so the neighbours are exact. They vote by the square of
similarity; votes are weighed so that the sample's class shares become those of all
labels learned from. A logistic curve from votes to labels, fitted to the examples
with each scored by the others, makes scores of the votes. The nearest examples' ids
come along as evidence.

Defined results: texts without a term of the vocabulary (null and empty ones, too)
get the share of label 1 among examples without one; ties between examples go to
the smaller id; an example is no neighbour of its own document; labels that are
null, not 0 or 1, or whose document is missing are left out, several labels of a
document count as the largest; with no labels all scores are 0.5, with one class
all are that class; a null id is scored as not held out; repeated rows are scored
each; columns beside doc_id and text take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.common import U64, Powers, Slice, byte_values, crc_bucket, mix64, received, sent, sigmoid, signed, slices, stored, table, words

#: Examples of each class; the chi-square beyond which a term weighs more; votes; examples in a block.
SAMPLE, LEAST, NEAREST, BLOCK = 1000, 10.0, 15, 32
#: Blocks that a query opens first; examples that hold a frequent term; examples in a task that scores them; terms in a chunk of counts.
OPENED, FREQUENT, SCORED, CHUNK = 8, 200, 500, 2**16
#: Bytes of the beginnings of longer words that are terms; occurrences that make one more term of a term.
BEGINNINGS, LEVELS = (5, 6, 7, 8), (1, 2, 4, 8)
#: Votes of the prior, beside those of the neighbours.
PRIOR_VOTES = 0.05


def not_alphanumeric() -> np.ndarray:
    """Bytes between words: ASCII but letters and digits."""
    out = np.ones(256, dtype=bool)
    out[128:] = False
    for a, b in ((48, 58), (65, 91), (97, 123)):
        out[a:b] = False
    return out


def occurrences(part: Slice, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of each word and beginning of a word; the last two bits of a hash are 0, for the level."""
    values, blank = byte_values(lower=True), not_alphanumeric()
    found = words(part, values, blank, powers)
    up, down = powers.to(len(part.data) + 1)
    docs, hashes = [found.doc], [found.hash]
    with np.errstate(over="ignore"):
        sums = np.zeros(len(part.data) + 1, dtype=U64)
        np.cumsum(values[part.data] * up[: len(part.data)], out=sums[1:])
        for n in BEGINNINGS:
            longer = found.length > n
            start = found.start[longer]
            docs.append(found.doc[longer])
            hashes.append(mix64((sums[start + n] - sums[start]) * down[start] + U64(n << 32)))
    return np.concatenate(docs), np.concatenate(hashes) & ~U64(3)


def term_table(column: pa.Array, powers: Powers) -> Iterator[np.ndarray]:
    """The distinct terms of each text."""
    for part in slices(column):
        doc, hashes = occurrences(part, powers)
        order = np.argsort(doc, kind="stable")
        cut = np.searchsorted(doc[order], np.arange(len(part.starts) + 1))
        for low, high in zip(cut[:-1], cut[1:], strict=True):
            term, n = np.unique(hashes[order[low:high]], return_counts=True)
            yield np.concatenate([term[n >= least] + U64(level) for level, least in enumerate(LEVELS)])


def known_labels(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) of the documents that there are and that are not held out: one row each, the largest label."""
    known = labels.filter((crc_bucket("doc_id", 3) != 1) & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    return known.join(docs.select("doc_id"), "doc_id", "left_semi")


def sample_ids(known: DataFrame) -> DataFrame:
    """(doc_id, toxic) of at most SAMPLE rows a class: the smallest hashes of the id."""
    picked = [known.filter(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE) for c in (0, 1)]
    return picked[0].unionByName(picked[1])


def example_terms(docs: DataFrame, picked: DataFrame) -> DataFrame:
    """(doc_id, toxic, terms) of the sample's documents, one for each id; of several texts of an id the least counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            terms = pa.array([signed(x) for x in term_table(batch["text"], powers)], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["toxic"], terms], names=["doc_id", "toxic", "terms"])

    # at most 2 * SAMPLE rows of an id and a label: a proven bound
    texts = docs.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(run, f"doc_id {kind}, toxic int, terms array<long>")


class Vocabulary(NamedTuple):
    """The examples' terms as sorted hashes, and how many examples of label 1 and 0 hold each."""

    terms: np.ndarray
    ones: np.ndarray
    zeros: np.ndarray

    def places(self) -> tuple[np.ndarray, np.ndarray]:
        """The terms' hashes without their levels, and for each of those the place of the term of each level, or -1."""
        bases, row = np.unique(self.terms & ~U64(3), return_inverse=True)
        place = np.full((len(bases), len(LEVELS)), -1, dtype=np.int32)
        place[row, (self.terms & U64(3)).astype(np.int64)] = np.arange(len(self.terms))
        return bases, place


def vocabulary(examples: DataFrame) -> Vocabulary:
    held = examples.select("toxic", F.explode("terms").alias("term")).groupBy("term").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
    table_ = held.toArrow()  # the terms of at most 2 * SAMPLE texts
    term = table_["term"].to_numpy().view(U64)
    order = np.argsort(term)
    return Vocabulary(term[order], table_["a"].to_numpy()[order].astype(float), table_["b"].to_numpy()[order].astype(float))


def found_terms(column: pa.Array, bases: np.ndarray, place: np.ndarray, powers: Powers) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(terms, cut) of slices of a column: places in the vocabulary, and where each document's begin."""
    for part in slices(column):
        n = len(part.starts)
        if not len(bases):
            yield np.zeros(0, dtype=np.int32), np.zeros(n + 1, dtype=np.int64)
            continue
        doc, hashes = occurrences(part, powers)
        at = np.minimum(np.searchsorted(bases, hashes), len(bases) - 1)
        hit = bases[at] == hashes
        pair, times = np.unique(doc[hit] * len(bases) + at[hit], return_counts=True)
        levels = np.where(times[:, None] >= np.array(LEVELS), place[pair % len(bases)], -1)
        row, column_ = np.nonzero(levels >= 0)
        yield levels[row, column_], np.searchsorted(pair[row] // len(bases), np.arange(n + 1))


def document_frequencies(docs: DataFrame, words_: Vocabulary) -> np.ndarray:
    """How many documents hold each term. A task counts all its documents first and passes on a row per chunk of terms."""
    size, shared = len(words_.terms), sent(docs.sparkSession, words_.places())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, n, (bases, place) = Powers(), np.zeros(size, dtype=np.int64), received(shared)
        for batch in batches:
            for terms, _ in found_terms(batch["text"], bases, place, powers):
                n += np.bincount(terms, minlength=size)
        chunks = list(range(0, size, CHUNK))
        yield pa.RecordBatch.from_arrays([pa.array(chunks, pa.int64()), pa.array([n[c : c + CHUNK].astype(np.int32).tobytes() for c in chunks], pa.binary())], names=["chunk", "counts"])

    def summed(part: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, dtype=np.int32).astype(np.int64) for x in part["counts"].to_pylist())
        return pa.table({"chunk": part["chunk"][:1], "counts": pa.array([total.tobytes()], pa.binary())})

    out = np.zeros(size)
    for row in docs.select("text").mapInArrow(run, "chunk long, counts binary").groupBy("chunk").applyInArrow(summed, "chunk long, counts binary").collect():  # 8 bytes a term
        counts = np.frombuffer(row["counts"], dtype=np.int64)
        out[row["chunk"] : row["chunk"] + len(counts)] = counts
    return out


def term_weights(words_: Vocabulary, ones: int, zeros: int, frequencies: np.ndarray, documents: int) -> np.ndarray:
    """The inverse document frequency of each term, times the chi-square of term and label over LEAST where that is more than 1."""
    a, b, total = words_.ones, words_.zeros, float(max(1, ones + zeros))
    cross = a * (zeros - b) - b * (ones - a)
    chi = total * cross * cross / (float(max(1, ones * zeros)) * (a + b) * (total - a - b + 0.5))
    return (np.log((1 + documents) / (1 + frequencies)) + 1) * np.maximum(1, chi / LEAST)


class Example(NamedTuple):
    doc_id: int
    toxic: int
    terms: np.ndarray


def weighted(terms: np.ndarray, weight: np.ndarray) -> np.ndarray:
    return weight[terms] / np.sqrt(np.square(weight[terms]).sum())


def ranges(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges start..stop-1, one range after the other, and how many each has."""
    n = stop - start
    return np.repeat(start - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum()), n


class Index:
    """Examples in blocks of similar ones: for each term its postings, and for terms of many postings the largest weight in each block.

    Postings are places alone; a weight there is the term's over the example's norm. What is made from them in a task is not broadcast.
    """

    def __init__(self, examples: list[Example], weight: np.ndarray) -> None:
        own = [weighted(e.terms, weight) for e in examples]
        order = sorted(range(len(examples)), key=lambda i: (int(examples[i].terms[own[i].argmax()]), -float(own[i].max()), examples[i].doc_id))
        self.ids = np.array([examples[i].doc_id for i in order], dtype=np.int64)
        self.toxic = np.array([examples[i].toxic for i in order], dtype=float)
        self.n_blocks, self.weight = -(-len(order) // BLOCK), weight
        self.norm = np.array([np.sqrt(np.square(weight[examples[i].terms]).sum()) for i in order])
        term = np.concatenate([examples[i].terms for i in order]) if order else np.zeros(0, dtype=np.int64)
        place = np.repeat(np.arange(len(order)), [len(examples[i].terms) for i in order])
        by_term = np.lexsort((place, term))
        self.place = place[by_term].astype(np.uint16)  # at most 2 * SAMPLE places
        self.of_term = np.searchsorted(term[by_term], np.arange(len(weight) + 1)).astype(np.int32)  # where the postings of each term begin
        self.value = None

    def prepare(self) -> None:
        """Weights of postings; the frequent terms' as dense rows over the examples, and the block maxima of these."""
        count = np.diff(self.of_term)
        self.value = np.repeat(self.weight, count) / self.norm[self.place]
        frequent = np.flatnonzero(count >= FREQUENT)
        self.dense_row = np.full(len(count), -1)
        self.dense_row[frequent] = np.arange(len(frequent))
        self.dense = np.zeros((len(frequent), self.n_blocks * BLOCK))
        at, n = ranges(self.of_term[frequent].astype(np.int64), self.of_term[frequent + 1].astype(np.int64))
        self.dense[np.repeat(np.arange(len(frequent)), n), self.place[at]] = self.value[at]
        self.most = self.dense.reshape(len(frequent), self.n_blocks, BLOCK).max(axis=2, initial=0)

    def nearest_rows(self, terms: np.ndarray, cut: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, place, similarity) of the k nearest examples with any term in common, exactly, of documents with these terms.

        Rare terms are summed over their postings. Frequent ones give each block a bound on top of that, and are summed in
        opened blocks alone: those of the OPENED largest bounds, and then all whose bound reaches the k-th similarity by then.
        """
        if self.value is None:
            self.prepare()
        n, width = len(cut) - 1, self.n_blocks * BLOCK
        doc, terms = np.repeat(np.arange(n), np.diff(cut)), terms.astype(np.int64)
        own = self.weight[terms]
        own = own / np.sqrt(np.bincount(doc, own * own, minlength=n))[doc]
        row = self.dense_row[terms]
        rare = row < 0
        at, m = ranges(self.of_term[terms[rare]].astype(np.int64), self.of_term[terms[rare] + 1].astype(np.int64))
        sums = np.bincount(np.repeat(doc[rare], m) * width + self.place[at], np.repeat(own[rare], m) * self.value[at], minlength=n * width).reshape(n, self.n_blocks, BLOCK)
        often = np.zeros((n, len(self.dense)))
        often[doc[~rare], row[~rare]] = own[~rare]
        bounds = sums.max(axis=2, initial=0) + often @ self.most
        found, opened = np.full((n, width), -1.0), np.zeros((n, self.n_blocks), dtype=bool)

        def open_(asked: np.ndarray) -> None:
            for b in np.flatnonzero(asked.any(axis=0)):
                who, cells = np.flatnonzero(asked[:, b]), slice(b * BLOCK, (b + 1) * BLOCK)
                found[who, cells] = sums[who, b] + often[who] @ self.dense[:, cells]
            opened[asked] = True

        first = np.zeros_like(opened)
        if self.n_blocks:
            np.put_along_axis(first, np.argsort(-bounds, axis=1, kind="stable")[:, :OPENED], True, axis=1)
        open_(first & (bounds > 0))
        kth = np.partition(found, -k, axis=1)[:, -k] if k <= width else np.full(n, -1.0)
        open_(~opened & (bounds > 0) & (bounds >= kth[:, None] - 1e-9))
        kth = np.partition(found, -k, axis=1)[:, -k] if k <= width else np.full(n, -1.0)
        who, place = np.nonzero((found > 0) & (found >= kth[:, None] - 1e-9))
        order = np.lexsort((self.ids[place], -np.round(found[who, place], 12), who))
        who, place = who[order], place[order]
        kept = np.arange(len(who)) - np.searchsorted(who, who) < k
        return who[kept], place[kept], found[who[kept], place[kept]]

    def nearest(self, terms: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and similarities of the k nearest examples of one document."""
        return self.nearest_rows(terms, np.array([0, len(terms)]), k)[1:]


class Voter(NamedTuple):
    """The index, the weight of a vote for either label, the prior, the votes of texts without terms, and the calibration."""

    index: Index
    votes: tuple[float, float]
    prior: float
    without: float
    slope: float = 1.0
    shift: float = 0.0

    def raw(self, ids: np.ndarray, terms: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, pa.Array]:
        """The share of votes for label 1 of each document, and the ids of the voters, nearest first. ids: a number that no example has for none."""
        n = len(ids)
        who, place, similar = self.index.nearest_rows(terms, cut, NEAREST + 1)
        other = self.index.ids[place] != ids[who]
        who, place, similar = who[other], place[other], similar[other]
        kept = np.arange(len(who)) - np.searchsorted(who, who) < NEAREST
        who, place, weight = who[kept], place[kept], np.square(similar[kept])
        toxic = self.index.toxic[place]
        for_, against = np.bincount(who, weight * toxic, minlength=n) * self.votes[1], np.bincount(who, weight * (1 - toxic), minlength=n) * self.votes[0]
        share = (for_ + PRIOR_VOTES * self.prior) / (for_ + against + PRIOR_VOTES)
        bare = (np.diff(cut) == 0) | (self.index.n_blocks == 0)
        voters = pa.ListArray.from_arrays(pa.array(np.searchsorted(who, np.arange(n + 1)), pa.int32()), pa.array(self.index.ids[place], pa.int64()))
        return np.where(bare, self.without, share), voters

    def score(self, ids: np.ndarray, terms: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, pa.Array]:
        share, voters = self.raw(ids, terms, cut)
        return sigmoid(self.slope * logit(share) + self.shift), voters


def logit(p):
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def calibration(shares: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve from the votes' logit to the label, by Newton's steps with a small ridge toward no change."""
    if len(np.unique(toxic)) < 2:
        return 1.0, 0.0
    x, at = np.column_stack([logit(shares), np.ones(len(shares))]), np.array([1.0, 0.0])
    for _ in range(25):
        p = sigmoid(x @ at)
        slope = x.T @ (weight * (toxic - p)) - (at - [1.0, 0.0])
        at = at + np.linalg.solve((x.T * (weight * p * (1 - p))) @ x + np.eye(2), slope)
    return float(max(at[0], 0.1)), float(at[1])


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, evidence) of every row; evidence: ids of the nearest examples, nearest first."""
    spark, docs = docs.sparkSession, docs.select("doc_id", "text")
    known = stored(known_labels(docs, labels))
    picked = stored(sample_ids(known))
    examples = stored(example_terms(docs, picked))
    words_ = vocabulary(examples)
    rows = examples.toArrow()  # at most 2 * SAMPLE texts' terms
    sampled = []
    for doc_id, toxic, terms in zip(rows["doc_id"].to_pylist(), rows["toxic"].to_pylist(), rows["terms"], strict=True):
        term = np.array(terms.values.to_numpy() if len(terms) else [], dtype=np.int64).view(U64)
        at = np.minimum(np.searchsorted(words_.terms, term), max(0, len(words_.terms) - 1))
        sampled.append(Example(doc_id, toxic, at[words_.terms[at] == term] if len(words_.terms) else at[:0]))
    ones = sum(e.toxic for e in sampled)
    zeros = len(sampled) - ones
    weight = term_weights(words_, ones, zeros, document_frequencies(docs, words_), docs.count())

    all_labels = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}  # two rows
    labelled = sum(all_labels.values())
    prior = all_labels.get(1, 0) / labelled if labelled else 0.5
    votes = (1 - prior) * len(sampled) / max(1, zeros), prior * len(sampled) / max(1, ones)
    bare = [e for e in sampled if not len(e.terms)]
    for_, against = sum(e.toxic for e in bare) * votes[1], sum(1 - e.toxic for e in bare) * votes[0]
    voter = Voter(Index([e for e in sampled if len(e.terms)], weight), votes, prior, (for_ + prior) / (for_ + against + 1))
    shared = sent(spark, (voter, *words_.places()))  # once: it is kept on the disk of the driver and of each executor

    def scored(rows: DataFrame, curve: tuple[float, float] | None) -> DataFrame:
        names = [x for x in rows.columns if x != "text"]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            powers, (model, bases, place) = Powers(), received(shared)
            model = model._replace(slope=curve[0], shift=curve[1]) if curve else model
            for batch in batches:
                # an example's own text is known by its id, and a null id is none of theirs
                ids, done, found = batch["doc_id"].cast(pa.int64()), 0, [(np.zeros(0), pa.array([], pa.list_(pa.int64())))]
                known, ids = ids.is_valid().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
                for terms, cut in found_terms(batch["text"], bases, place, powers):
                    own = slice(done, done := done + len(cut) - 1)
                    found.append((model.score if curve else model.raw)(np.where(known[own], ids[own], np.iinfo(np.int64).min), terms, cut))
                scores, evidence = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([*(batch[x] for x in names), pa.array(np.concatenate(scores)), pa.concat_arrays(evidence)], names=[*names, "score", "evidence"])

        kinds = ", ".join(f"{x} {rows.schema[x].dataType.simpleString()}" for x in names)
        return rows.mapInArrow(run, f"{kinds}, score double, evidence array<long>")

    # each example is scored by the others, and the curve from votes to labels is fitted to that
    again = docs.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).repartition(max(1, ceil(len(sampled) / SCORED)))
    own = scored(again, None).select("toxic", "score").toArrow()
    toxic = own["toxic"].to_numpy().astype(float)
    curve = calibration(own["score"].to_numpy(), toxic, np.where(toxic > 0, votes[1], votes[0]))
    return scored(docs.select("doc_id", (crc_bucket("doc_id", 3) == 1).alias("held_out"), "text"), curve)


def op4_toxicity_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int")).select("doc_id", "held_out", "score", "predicted", "evidence")
