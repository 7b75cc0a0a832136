"""N-gram Jaccard self-join by token-group matrices.

A document's set holds the distinct hashes (64 bits) of its word shingles. Sets
that are equal form one class and go on as one. What may link is found in two
steps, both by token-group matrices.

Coarse: for sets whose sizes lie in one range, two sets that link differ in at
most k shingles. Cut the hash space into m = k + s slices: they agree on s slices
at least. A slice with the shingles that a set has in it is a coarse token; of
its m coarse tokens a set keeps the first k + o in a fixed order (most shingles
first, then by hash), and two sets that link share o of those at least, for o up
to s. Frequent passages do no harm, as a coarse token holds other shingles
besides. Ranges overlap, so that any two sizes which can link lie in one range.
Sets that share too few tokens with all others together take no further part.

The rest are dealt into groups of similar ones: a token's hub is one of its sets,
the same one for most tokens of a family, and sets with the same hub, or hub of
a hub, are grouped. Links within the groups are found first, each group with the
hub's hub besides, so that a family of linked copies is one component by then.
The matrix holds each group's union of coarse tokens; two groups are opened for
each other if the unions share o tokens that sets of different components have.

Fine: in an opened pair of groups the smaller one's sets are queries to the larger
one. A query goes on only if its overlap with the union of that group's shingles
reaches the threshold times its size; then its exact overlaps with the members
decide. Links become a spanning forest there, and the components of all forests'
edges give the result.

All links are found but for one case: a token is cut to 32 bits within its bucket, and tokens of one set that are
equal then count once. For T tokens in B buckets that is T squared in 2**33 B, nothing for texts of less than some
ten million words, where two sets that link by the least number of tokens could be missed. Hashes of shingles have
64 bits, signatures of sets 128.

Defined results: null and empty texts, or texts without words, have empty sets of
size 0, and are components of their own; with fewer words than a shingle has, the
whole sequence is the one shingle; a null id gets a null component and takes no
part; rows that repeat an id are told apart by their sets, and ``one_of_each`` drops
all rows of an id if it drops one; columns beside doc_id and text are passed on
untouched by it.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigil.llm.common import U64, Powers, byte_values, mix64, separators, shared_dir, signed, slices, stored, table, words
from vigil.llm.components import components
from vigil.llm.components import FEW as FEW_LABELS

#: Sets in a group at most, and their shingles, about; larger groups of similar sets are split. Queries of a task, as groups.
GROUP, SHINGLES, QUERIES = 256, 500_000, 2
#: Coarse tokens in a bucket, about, and those that a task gathers before it passes them on.
BUCKET, FLUSH = 200_000, 250_000
#: Places in a block.
PLACE_BITS = 15
PLACES = 1 << PLACE_BITS
#: Rows up to which the sets to fetch are broadcast.
FEW = 1_000_000
#: Columns of a dense block when members are compared.
COLUMNS = 4096


def shingle_sets(column: pa.Array, width: int, powers: Powers) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    values, blank = byte_values(lower=True), separators()
    odd = [U64(pow(0xD1342543DE82EF95, i + 1, 2**64)) for i in range(width)]
    for part in slices(column):
        found = words(part, values, blank, powers)
        for low, high in zip(found.bounds[:-1], found.bounds[1:], strict=True):
            h, n = found.hash[low:high], max(1, high - low - width + 1)
            if not len(h):
                yield np.zeros(0, dtype=U64)
                continue
            with np.errstate(over="ignore"):
                sums = h[:n] * odd[0]
                for i in range(1, min(width, len(h))):
                    sums = sums + h[i : i + n] * odd[i]
                yield np.unique(mix64(sums + U64(min(width, len(h)))))


def signature(found: np.ndarray) -> tuple[int, int]:
    """128 bits that tell sets apart."""
    with np.errstate(over="ignore"):
        return int(signed(mix64(found).sum(dtype=U64).reshape(1))[0]), int(signed(np.bitwise_xor.reduce(mix64(found + U64(0x632BE59BD9B4E019))).reshape(1))[0])


class Ranges:
    """Ranges of set sizes. Class c holds sizes below bounds[c + 1]; range r is made of classes r - 1 and r."""

    def __init__(self, percent: int) -> None:
        self.percent, self.bounds = percent, [1]

    def of(self, n: int) -> tuple[int, int]:
        """The class of a size."""
        while self.bounds[-1] <= n:  # the least size that can no longer link with the class's least
            self.bounds.append(self.bounds[-1] * 100 // self.percent + 1)
        return int(np.searchsorted(self.bounds, n, side="right")) - 1

    def both(self, n: int) -> tuple[int, int]:
        c = self.of(n)
        return c, c + 1

    def differing(self, r: int) -> int:
        """Shingles in which two sets of range r that link can differ at most."""
        while len(self.bounds) < r + 2:
            self.bounds.append(self.bounds[-1] * 100 // self.percent + 1)
        return 2 * (self.bounds[r + 1] - 1) * (100 - self.percent) // (100 + self.percent)


def needed(k: int) -> int:
    """Coarse tokens that two sets which link must share at least: a tenth of k, and two."""
    return max(2, ceil(k / 10))


def coarse_tokens(found: np.ndarray, ranges: Ranges) -> Iterator[np.ndarray]:
    """The coarse tokens that a set keeps, in each of its two ranges."""
    with np.errstate(over="ignore"):
        sums = np.zeros(len(found) + 1, dtype=U64)
        np.cumsum(mix64(found), out=sums[1:])
        for r in ranges.both(len(found)):
            k = ranges.differing(r)
            if not k:  # only equal sets link
                yield np.zeros(0, dtype=U64)
                continue
            m = k + max(needed(k), ceil(0.3 * k))
            cut = np.searchsorted(((found >> U64(32)) * U64(m)) >> U64(32), np.arange(m + 1, dtype=U64))
            tokens = mix64(sums[cut[1:]] - sums[cut[:-1]] + mix64(np.arange(m, dtype=U64) + U64(r << 32)))
            yield tokens[np.lexsort((tokens, cut[:-1] - cut[1:]))[: k + needed(k)]]


def emitted(docs: DataFrame, width: int, percent: int, buckets: int) -> DataFrame:
    """Rows to be grouped by bucket: one for each document (bucket below 0), and packed coarse tokens of distinct sets.

    block and place make a node, which stands for a distinct set of a task. A token is 4 bytes within its bucket, a
    place 2, of which the top bit tells the range. The split into blocks follows the rows alone.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["bucket", "block", "tokens", "places", "doc_id", "node", "n_shingles", "sig_a", "sig_b", "need_a", "need_b"]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, ranges, seen, block = Powers(), Ranges(percent), set(), TaskContext.get().partitionId() << 24
        tokens, places, size = [], [], 0
        types = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), None, *[pa.int64()] * 6]

        def rows(n: int, columns: dict[str, pa.Array]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([columns.get(x, pa.nulls(n, t)) for x, t in zip(names, types, strict=True)], names=names)

        def packed() -> pa.RecordBatch:
            token, place = np.concatenate(tokens), np.concatenate(places)
            order = np.argsort(token)
            token, place = token[order], place[order]
            cut = np.searchsorted(((token >> U64(32)) * U64(buckets)) >> U64(32), np.arange(buckets + 1, dtype=U64))
            full, token = np.flatnonzero(cut[1:] > cut[:-1]), token.astype(np.uint32)
            return rows(len(full), {
                "bucket": pa.array(full, pa.int32()), "block": pa.array(np.full(len(full), block)),
                "tokens": pa.array([token[cut[b] : cut[b + 1]].tobytes() for b in full], pa.binary()), "places": pa.array([place[cut[b] : cut[b + 1]].tobytes() for b in full], pa.binary()),
            })

        for batch in batches:
            types[4], found = batch["doc_id"].type, []
            for doc, x in zip(batch["doc_id"].is_valid().to_pylist(), shingle_sets(batch["text"], width, powers), strict=True):
                key, needs = signature(x) if len(x) else (0, 0), [needed(ranges.differing(r)) for r in ranges.both(len(x))] if len(x) else [0, 0]
                node = None
                if doc and len(x) and key not in seen:
                    if size >= FLUSH or len(tokens) == 2 * PLACES:
                        yield packed()
                        tokens, places, size, block = [], [], 0, block + 1
                    seen.add(key)
                    place = len(tokens) // 2
                    node = (block << PLACE_BITS) | place
                    for own, bit in zip(coarse_tokens(x, ranges), (0, PLACES), strict=True):
                        tokens.append(own)
                        places.append(np.full(len(own), place + bit, dtype=np.uint16))
                        size += len(own)
                found.append((node, len(x), *key, *needs))
            columns = dict(zip(names[5:], (pa.array(x, pa.int64()) for x in zip(*found, strict=True)), strict=True)) if found else {}
            yield rows(len(found), {"bucket": pa.array(-1 - np.arange(len(found)) % buckets, pa.int32()), "doc_id": batch["doc_id"], **columns})
        if size:
            yield packed()

    return docs.mapInArrow(emit, f"bucket int, block long, tokens binary, places binary, doc_id {kind}, node long, n_shingles long, sig_a long, sig_b long, need_a long, need_b long")


def coarse_postings(docs: DataFrame, width: int, percent: int, buckets: int) -> DataFrame:
    """(doc_id, node, n_shingles, sig_a, sig_b, need_a, need_b) of every document, and (token, node, other) of coarse tokens that
    several nodes have; other tells that the token is of the second range."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "node", "n_shingles", "sig_a", "sig_b", "need_a", "need_b"]

    def shared(part: pa.Table) -> pa.Table:
        bucket = part["bucket"][0].as_py()
        if bucket < 0:
            n = part.num_rows
            return part.select(names).append_column("token", pa.nulls(n, pa.int64())).append_column("other", pa.nulls(n, pa.bool_()))
        token = np.concatenate([np.frombuffer(x, dtype=np.uint32) for x in part["tokens"].to_pylist()])
        at = [np.frombuffer(x, dtype=np.uint16).astype(np.int64) for x in part["places"].to_pylist()]
        place = np.concatenate(at)
        node = np.repeat(part["block"].to_numpy(), [len(x) for x in at]) << PLACE_BITS | (place & (PLACES - 1))
        order = np.argsort(token, kind="stable")
        token, node, other = token[order], node[order], place[order] >= PLACES
        fresh = np.ones(len(token) + 1, dtype=bool)
        fresh[1:-1] = token[1:] != token[:-1]
        several = ~(fresh[:-1] & fresh[1:])
        n, kinds = int(several.sum()), {"doc_id": part["doc_id"].type}
        columns = {x: pa.nulls(n, kinds.get(x, pa.int64())) for x in names}
        columns |= {"node": pa.array(node[several]), "token": pa.array((np.int64(bucket) << 32) + token[several].astype(np.int64)), "other": pa.array(other[several])}
        return pa.table([columns[x] for x in [*names, "token", "other"]], names=[*names, "token", "other"])

    rows = emitted(docs, width, percent, buckets).groupBy("bucket")
    return rows.applyInArrow(shared, f"doc_id {kind}, node long, n_shingles long, sig_a long, sig_b long, need_a long, need_b long, token long, other boolean")


def forest(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[int, int]]:
    """Those of the links (a, b) that a spanning forest needs."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = up
        return x

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        u, v = root(x), root(y)
        if u != v:
            parent[u] = v
            yield x, y


def places(within: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Where the hashes of a sorted set that also are in a sorted array stand there."""
    at = np.minimum(np.searchsorted(within, found), len(within) - 1)
    return at[within[at] == found]


def links(queries: list[np.ndarray], members: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the queries and members that link. First the overlap of a query with the members' union, then exact overlaps."""
    union = np.unique(np.concatenate(members))
    size, sizes = np.array([len(x) for x in queries]), np.array([len(x) for x in members])
    inside = [places(union, x) for x in queries]
    opened = np.flatnonzero(100 * np.array([len(x) for x in inside]) >= percent * size)
    if not len(opened):
        return opened, opened
    used = union[np.unique(np.concatenate([inside[i] for i in opened]))]
    sides = [places(used, queries[i]) for i in opened], [places(used, x) for x in members]
    overlap = np.zeros((len(opened), len(members)))
    for low in range(0, len(used), COLUMNS):  # a block's products are whole numbers that float32 holds; their sum is kept in float64
        blocks = []
        for side in sides:
            block = np.zeros((len(side), min(COLUMNS, len(used) - low)), dtype=np.float32)
            for i, at in enumerate(side):
                block[i, at[np.searchsorted(at, low) : np.searchsorted(at, low + COLUMNS)] - low] = 1
            blocks.append(block)
        overlap += blocks[0] @ blocks[1].T
    both = size[opened][:, None] + sizes[None, :] - overlap
    q, m = np.nonzero(100 * overlap >= percent * both)
    return opened[q], m


def within(members: DataFrame, percent: int) -> DataFrame:
    """(a, b) for the sets of each group (target, root, node, shingles) that links within it reach others from: b stands for
    all of them, and is the root if they reach that."""

    def run(part: pa.Table) -> pa.Table:
        ids, top = part["node"].to_numpy(), part["root"][0].as_py()
        sets = [np.frombuffer(x, dtype=U64) for x in part["shingles"].to_pylist()]
        q, m = links(sets, sets, percent)
        kept = q < m
        near: dict[int, list[int]] = {}
        for x, y in forest(ids[q[kept]], ids[m[kept]]):
            near.setdefault(x, []).append(y)
            near.setdefault(y, []).append(x)
        edges, left = [], set(near)
        for start in [top, *sorted(near)]:
            reached = [start] if start in left else []
            left.discard(start)
            for x in reached:  # grows while it is walked
                fresh = [y for y in near[x] if y in left]
                left.difference_update(fresh)
                reached += fresh
            edges += [(x, start) for x in reached[1:]]
        return pa.table([pa.array([x for x, _ in edges], pa.int64()), pa.array([y for _, y in edges], pa.int64())], names=["a", "b"])

    return members.groupBy("target").applyInArrow(run, "a long, b long")


def verified(sides: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) of a spanning forest of the links between the sides of each task (target, chunk, side, node, shingles)."""

    def run(part: pa.Table) -> pa.Table:
        side, ids = part["side"].to_numpy(), part["node"].to_numpy()
        sets = [np.frombuffer(x, dtype=U64) for x in part["shingles"].to_pylist()]
        first, second = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        edges = []
        if len(first) and len(second):
            q, m = links([sets[i] for i in first], [sets[i] for i in second], percent)
            a, b = ids[first[q]], ids[second[m]]
            edges = list(forest(a[a != b], b[a != b]))
        return pa.table([pa.array([x for x, _ in edges], pa.int64()), pa.array([y for _, y in edges], pa.int64())], names=["a", "b"])

    return sides.groupBy("target", "chunk").applyInArrow(run, "a long, b long")


def shingles_of(texts: DataFrame, width: int) -> DataFrame:
    """(node, group, shingles) of texts (node, group, sig_a, sig_b, text): 8 bytes a shingle. A text of another set, where an id repeats, is left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            for low in range(0, max(1, batch.num_rows), 200):
                part = batch.slice(low, 200)
                sets = list(shingle_sets(part["text"], width, powers))
                own = [i for i, key in enumerate(zip(part["sig_a"].to_pylist(), part["sig_b"].to_pylist(), strict=True)) if len(sets[i]) and signature(sets[i]) == key]
                at = pa.array(own, pa.int64())
                yield pa.RecordBatch.from_arrays([part["node"].take(at), part["group"].take(at), pa.array([sets[i].tobytes() for i in own], pa.binary())], names=["node", "group", "shingles"])

    return texts.select("node", "group", "sig_a", "sig_b", "text").mapInArrow(run, "node long, group long, shingles binary")


def hinted(df: DataFrame, few: bool) -> DataFrame:
    """df, broadcast if it has few rows: a join by shuffles would shuffle both sides, and Spark then broadcast the smaller one all the same."""
    return F.broadcast(df) if few else df


def hubs_of(entries: DataFrame) -> DataFrame:
    """(class, hub, n_shingles) from entries (token, class, need, n_shingles, hub): the one of its tokens' hubs that most of them have."""
    hubs = entries.repartition("class").groupBy("class", "hub").agg(F.count("*").alias("k"), F.first("n_shingles").alias("n_shingles"))
    return hubs.groupBy("class").agg(F.max_by("hub", F.struct("k", "hub")).alias("hub"), F.first("n_shingles").alias("n_shingles"))


def grouped(hubs: DataFrame, few: bool) -> DataFrame:
    """(class, group, root, size): groups of similar sets, from their hubs; size is the group's, about; few tells that the hubs may be broadcast.

    A set's root is the hub of its hub. The sets of a hub are
    groups of their own if they fill half of one at least; those of the root's other hubs are groups together.
    """
    up = hubs.select(F.col("class").alias("hub"), F.col("hub").alias("up"))
    weight = 1 / F.lit(GROUP) + F.col("n_shingles") / F.lit(SHINGLES)
    of_hub = hubs.groupBy("hub").agg(F.sum(weight).alias("of_hub")).join(hinted(up, few), "hub", "left").select("hub", "of_hub", F.coalesce("up", "hub").alias("root"))
    wide = hubs.withColumn("weight", weight).join(hinted(of_hub, few), "hub")
    rest = wide.filter("of_hub < 0.5").groupBy("root").agg(F.sum("weight").alias("of_root"))
    own = F.xxhash64(F.lit(1), "hub", F.pmod(F.xxhash64("class"), F.ceil("of_hub")))
    common = F.xxhash64(F.lit(0), "root", F.pmod(F.xxhash64("hub"), F.ceil("of_root")))
    large, whole = F.col("of_hub") >= 0.5, F.when(F.col("of_hub") >= 0.5, F.col("of_hub")).otherwise(F.col("of_root"))
    return wide.join(hinted(rest, few), "root", "left").select("class", F.when(large, own).otherwise(common).alias("group"), "root", (whole / F.ceil(whole)).alias("size"))


def near_duplicates(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of docs."""
    shared_dir(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # a shingle in six bytes of text; a set keeps about 2.6 k tokens in its two ranges
    buckets = max(8, ceil(size / 6 * 2.6 * (100 - percent) / (100 + percent) / BUCKET))
    rows = stored(coarse_postings(docs, width, percent, buckets))

    keys = ["sig_a", "sig_b", "n_shingles"]
    found = rows.filter("token IS NULL")
    classes = found.filter("n_shingles > 0").groupBy(*keys).agg(F.min("doc_id").alias("least"), F.min("node").alias("class"), F.count("*").alias("copies"))
    classes = stored(classes)
    nodes = found.filter("node IS NOT NULL").join(classes.select(*keys, "class"), keys).select("node", "class", "n_shingles", "need_a", "need_b")
    entries = rows.filter("token IS NOT NULL").select("token", "node", "other").join(nodes, "node").select("token", "class", "n_shingles", F.when(F.col("other"), F.col("need_b")).otherwise(F.col("need_a")).alias("need"))
    # equal sets that different tasks saw are one class
    entries = entries.repartition("token").groupBy("token", "class").agg(F.first("n_shingles").alias("n_shingles"), F.first("need").alias("need"))
    token, own = Window.partitionBy("token"), Window.partitionBy("class", "need")
    entries = entries.withColumns({"sets": F.count("*").over(token), "hub": F.min_by("class", F.xxhash64("class")).over(token)}).filter("sets > 1").drop("sets")
    entries = entries.repartition("class").withColumn("shared", F.count("*").over(own)).filter("shared >= need").drop("shared").checkpoint()

    hubs = hubs_of(entries).checkpoint()
    total = hubs.count()
    few, small = total <= FEW, total <= FEW_LABELS  # what is broadcast is of a checked size
    groups = grouped(hubs, small).checkpoint()
    names = found.filter("node IS NOT NULL").select("doc_id", "node", "sig_a", "sig_b").join(hinted(groups.select(F.col("class").alias("node"), "group"), small), "node")
    sets = stored(shingles_of(docs.join(hinted(names, few), "doc_id"), width))

    # first within groups, each with its root besides; what that links need not be opened again
    inside = groups.select(F.col("class").alias("node"), F.col("group").alias("target"), "root").union(groups.select("root", "group", "root")).distinct()
    first = within(inside.join(sets.drop("group"), "node"), percent).checkpoint()
    linked = first.toDF("class", "component")
    matrix = entries.select("token", "class", "need").join(hinted(groups.select("class", "group", "size"), small), "class").join(hinted(linked, small), "class", "left").withColumn("component", F.coalesce("component", "class"))
    matrix = matrix.groupBy("token", "need", "group").agg(F.first("size").alias("size"), F.min("component").alias("low"), F.max("component").alias("high"))
    left, right = matrix.toDF("token", "need", "g", "size_g", "low_g", "high_g"), matrix.drop("need").toDF("token", "h", "size_h", "low_h", "high_h")
    across = left.join(right, "token").filter("g < h AND NOT (low_g = high_g AND low_h = high_h AND low_g = low_h)")
    opened = across.groupBy("g", "h", "need").agg(F.count("*").alias("shared"), F.first("size_g").alias("size_g"), F.first("size_h").alias("size_h")).filter("shared >= need")

    # the smaller group's sets are queries to the larger one, in chunks
    larger = F.struct("size_g", "g") > F.struct("size_h", "h")
    pairs = opened.select(F.when(larger, F.col("g")).otherwise(F.col("h")).alias("target"), F.when(larger, F.col("h")).otherwise(F.col("g")).alias("group"), F.least("size_g", "size_h").alias("size"))
    pairs = pairs.repartition("target").distinct()  # a pair may be opened in two ranges
    pairs = pairs.withColumn("chunks", F.ceil(F.sum("size").over(Window.partitionBy("target")) / QUERIES)).checkpoint()
    asked = pairs.select("target", F.pmod(F.xxhash64("group"), "chunks").alias("chunk"), F.lit(0).alias("side"), "group")
    told = pairs.select("target", "chunks").distinct().select("target", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"), F.lit(1).alias("side"), F.col("target").alias("group"))
    second = verified(asked.unionByName(told).join(sets, "group").select("target", "chunk", "side", "node", "shingles"), percent)

    linked = components(first.unionByName(second).checkpoint()).toDF("class", "component")
    labelled = classes.join(linked, "class", "left").withColumn("component", F.coalesce("component", "class"))
    # sets that only rows without an id have are of no class, and get no component
    smallest = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    labelled = stored(labelled.join(smallest, "component", "left").select(*keys, "component_id", "copies"))  # it is read three times
    return with_components(found, labelled, keys)


def with_components(found: DataFrame, labelled: DataFrame, keys: list[str]) -> DataFrame:
    """(doc_id, n_shingles, component_id) of all rows. Sets that more than a ten-thousandth of the rows have are at most
    ten thousand, so they are broadcast, and no key of the other join is hot."""
    own = F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")
    total = found.count()
    often = F.col("copies") * 10_000 > total
    filled = found.filter("n_shingles > 0").select("doc_id", *keys)
    hot = F.broadcast(labelled.filter(often).drop("copies"))
    parts = [filled.join(hot, keys), filled.join(hot, keys, "left_anti").join(labelled.filter(~often), keys)]
    bare = found.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return parts[0].select("doc_id", "n_shingles", own).unionByName(parts[1].select("doc_id", "n_shingles", own)).unionByName(bare)


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """docs without near duplicates: of each component the row with the smallest id stays, and every row without an id."""
    found = near_duplicates(docs, width, percent)
    name = "_".join(["dropped", *docs.columns])  # none of theirs
    dropped = found.filter("component_id <> doc_id").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(dropped, F.col("doc_id") == F.col(f"`{name}`"), "left_anti")


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=90)
