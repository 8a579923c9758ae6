"""SimHash near-duplicates with a hierarchical index in Gray order.

Fingerprints. A text's words make shingles, each shingle a 64-bit hash, and a bit of the fingerprint is 1 if it is set
in more than half of the hashes. Equal fingerprints are merged first, so copies cost one node.

Index. Distinct fingerprints are sorted by Gray rank, in which neighbours tend to differ in few bits, and cut into
blocks of equal length. A block is a tree: groups of ``FANOUT`` neighbours, groups of groups, and so on. A node
keeps the bits that all its members share, as a mask and a pattern; bits that its parent shares already are factored
out, so that a search adds up differences on the way down and leaves a whole group as soon as the sum exceeds the limit.

Join. The block roots (at most ``MOST_BLOCKS`` masks and patterns, whatever the input) tell which pairs of blocks can
hold links at all. Each block is sent to the blocks it must be compared with, as one array, and searches their trees.
A task never lists all links of a dense group: it reduces them slice by slice to a forest, which has fewer links than
nodes and the same components. Components are then found by distributed star contraction.

Defined results: a NULL text counts as empty; texts without words have fingerprint zero and are linked like any other. A
component is named by its smallest id; NULL ids are ignored in that (NULL if there is no other). An empty table gives an
empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.llm import arrow
from tidemark.llm.common import col, free_name, written
from tidemark.llm.components import components

BITS = 64
#: Fingerprints in a block, and blocks at most: beyond that blocks grow, not their number.
BLOCK, MOST_BLOCKS = 8192, 16384
#: Children of a node, and queries of a block that search at once.
FANOUT, SLICE = 16, 256

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_LANES = np.uint64(0x0101010101010101)


# -- fingerprints ------------------------------------------------------------------------


def shingle_hashes(text: str, size: int, seed: int) -> list[int]:
    """XXH64 of each run of ``size`` words of the text; of all its words if they are fewer."""
    words = text.encode().translate(_LOWER).split()  # bytes split at exactly space, \t, \n, \v, \f, \r
    if not words:
        return []
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(b" ".join(words), seed)]
    whole, ends, at = b" ".join(words), [], -1
    for n in map(len, words):
        at += n + 1
        ends.append(at)
    starts = [0, *[e + 1 for e in ends]]
    digest = xxhash.xxh64_intdigest
    return [digest(whole[s:e], seed) for s, e in zip(starts, ends[size - 1:])]


def majority(hashes: list[list[int]]) -> np.ndarray:
    """The fingerprint of each list: bits set in over half of its members (0 for an empty list)."""
    lengths = np.array([len(h) for h in hashes], np.int64)
    out = np.zeros(len(hashes), np.uint64)
    full = np.flatnonzero(lengths)
    if not len(full):
        return out
    flat = np.fromiter((x for h in hashes for x in h), np.uint64, int(lengths.sum()))
    n = lengths[full]
    offset = np.cumsum(n) - n
    # a byte lane holds up to 255 set bits, so sums run over blocks of 255 hashes of one text
    blocks = -(-n // 255)
    first = np.cumsum(blocks) - blocks
    inside = np.arange(int(blocks.sum())) - np.repeat(first, blocks)
    starts = np.repeat(offset, blocks) + 255 * inside
    bits = np.empty((len(full), 8, 8), bool)
    for k in range(8):
        lanes = np.add.reduceat((flat >> np.uint64(k)) & _LANES, starts)
        counts = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), first, axis=0)
        bits[:, :, k] = 2 * counts > n[:, None]
    out[full] = np.packbits(bits, axis=2, bitorder="little").reshape(-1, 8).copy().view(np.uint64).ravel()
    return out


def fingerprints(docs: DataFrame, shingle: int, seed: int = 42, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(id, fp): the fingerprint as a signed long."""
    def run(batches):
        for batch in batches:
            for part, texts in arrow.pieces(batch, "text"):
                fps = majority([shingle_hashes(t, shingle, seed) for t in texts])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fps.view(np.int64))], ["id", "fp"])

    narrow = docs.select(col(id_col).alias("id"), col(text_col).alias("text"))
    return arrow.mapped(narrow, run, T.StructType([narrow.schema["id"], T.StructField("fp", T.LongType())]))


def gray_rank(fp: Column) -> Column:
    """Place of a fingerprint in Gray order, shifted so that signed order is unsigned order."""
    g = fp
    for k in (1, 2, 4, 8, 16, 32):
        g = g.bitwiseXOR(F.shiftrightunsigned(g, k))
    return g.bitwiseXOR(F.lit(-(1 << 63)))


# -- the index of a block ----------------------------------------------------------------


# Bits are counted in unsigned numbers: of a signed one, numpy counts those of the absolute value.


def unsigned(column) -> np.ndarray:
    return column.to_numpy().view(np.uint64)


def signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def shared(fps: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(mask, pattern) of the bits that all members of each group share."""
    ones, any_ = np.bitwise_and.reduceat(fps, starts), np.bitwise_or.reduceat(fps, starts)
    mask = ~(ones ^ any_)
    return mask, ones & mask


class Tree:
    """Levels from the groups of a block down to its fingerprints, which are in Gray order."""

    def __init__(self, fps: np.ndarray):
        self.fps, self.levels = fps, []
        size = FANOUT
        while True:
            starts = np.arange(0, len(fps), size)
            mask, pattern = shared(fps, starts)
            self.levels.append([mask, pattern])
            if len(starts) <= FANOUT:
                break
            size *= FANOUT
        self.levels.reverse()
        for above, below in zip(self.levels[-2::-1], self.levels[:0:-1]):  # factor out what the parent shares
            parent = np.arange(len(below[0])) // FANOUT
            below.append(below[0] & ~above[0][parent])
        self.levels[0].append(self.levels[0][0])

    def search(self, queries: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """All (query, member) within ``most`` bits, as two arrays of places."""
        top = len(self.levels[0][0])
        q = np.repeat(np.arange(len(queries)), top)
        node = np.tile(np.arange(top), len(queries))
        seen = np.zeros(len(q), np.uint8)
        for depth, (mask, pattern, own) in enumerate(self.levels):
            seen = seen + np.bitwise_count((queries[q] ^ pattern[node]) & own[node])
            live = seen <= most
            q, node, seen = q[live], node[live], seen[live]
            width = len(self.levels[depth + 1][0]) if depth + 1 < len(self.levels) else len(self.fps)
            parent = node
            node = (node[:, None] * FANOUT + np.arange(FANOUT)).ravel()
            q, seen, parent = np.repeat(q, FANOUT), np.repeat(seen, FANOUT), np.repeat(parent, FANOUT)
            inside = node < width
            q, node, seen, parent = q[inside], node[inside], seen[inside], parent[inside]
        rest = ~self.levels[-1][0][parent]
        near = seen + np.bitwise_count((queries[q] ^ self.fps[node]) & rest) <= most
        return q[near], node[near]


def forest(labels: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Merge the trees that links join; ``labels`` holds each node's root."""
    while True:
        a, b = labels[u], labels[v]
        apart = a != b
        if not apart.any():
            return labels
        u, v, a, b = u[apart], v[apart], a[apart], b[apart]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = labels[labels]
            if (up == labels).all():
                break
            labels = up


def link_blocks(tree: Tree, queries: np.ndarray, same: bool, most: int) -> tuple[np.ndarray, np.ndarray]:
    """A forest of the links between a block's members and the queries (``same``: the queries are the members)."""
    n = len(tree.fps)
    labels = np.arange(n if same else n + len(queries))
    for s in range(0, len(queries), SLICE):
        q, m = tree.search(queries[s:s + SLICE], most)
        labels = forest(labels, q + s + (0 if same else n), m)
    nodes = tree.fps if same else np.concatenate([tree.fps, queries])
    child = np.flatnonzero(labels != np.arange(len(labels)))
    return nodes[child], nodes[labels[child]]


# -- the join ----------------------------------------------------------------------------


def links(nodes: DataFrame, most: int) -> DataFrame:
    """A forest (u, v) over distinct fingerprints ``fp`` with the components of "at most ``most`` bits differ"."""
    spark = nodes.sparkSession
    n = min(MOST_BLOCKS, max(1, -(-nodes.count() // BLOCK)))
    schema = "block int, mask long, pattern long, fps array<long>"

    def build(batches):
        got = [np.stack([b.column(0).to_numpy(), b.column(1).to_numpy()]) for b in batches if b.num_rows]
        if got:
            block, fps = np.concatenate(got, axis=1)
            mask, pattern = shared(fps.view(np.uint64), np.zeros(1, int))
            yield pa.RecordBatch.from_arrays(
                [pa.array(block[:1].astype(np.int32)), signed(mask), signed(pattern),
                 pa.array([fps], pa.list_(pa.int64()))], ["block", "mask", "pattern", "fps"])

    rank = gray_rank(F.col("fp"))
    in_order = (nodes.select("fp").repartitionByRange(n, rank).sortWithinPartitions(rank)
                .select(F.spark_partition_id().cast("long").alias("block"), "fp"))
    blocks = written(arrow.mapped(in_order, build, schema), "simhash-blocks")
    roots = blocks.select("block", "mask", "pattern").toArrow()  # at most MOST_BLOCKS rows
    shared_roots = spark.sparkContext.broadcast(
        (roots.column(0).to_numpy(), unsigned(roots.column(1)), unsigned(roots.column(2))))

    def route(batches):
        to, mask, pattern = shared_roots.value
        for batch in batches:
            for i in range(batch.num_rows):
                own = batch.column(0)[i].as_py()
                both = mask & unsigned(batch.column(1))[i]
                near = np.bitwise_count((pattern ^ unsigned(batch.column(2))[i]) & both) <= most
                # each pair once, and about as many arrivals at every block
                once = np.where((to + own) % 2 == 0, to >= own, to < own)
                targets = to[near & once]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(targets, pa.int32()), pa.array(np.full(len(targets), own), pa.int32())],
                    ["block", "other"])

    pairs = arrow.mapped(blocks.select("block", "mask", "pattern"), route, "block int, other int")
    sent = (pairs.join(blocks.select(F.col("block").alias("other"), F.col("fps").alias("queries")), "other")
            .repartition(n, "block"))
    work = sent.join(blocks.select("block", "fps"), "block")

    def compare(batches):
        at, tree = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                block, other = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                if block != at:
                    at, tree = block, Tree(unsigned(batch.column(3)[i].values))
                u, v = link_blocks(tree, unsigned(batch.column(2)[i].values), block == other, most)
                if len(u):
                    yield pa.RecordBatch.from_arrays([signed(u), signed(v)], ["u", "v"])

    return arrow.mapped(work.select("block", "other", "queries", "fps"), compare, "u long, v long")


def near_duplicates(docs: DataFrame, shingle: int = 3, most: int = 2, seed: int = 42, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document: id, fingerprint (hex), component_id (smallest id reachable over links)."""
    prints = written(fingerprints(docs, shingle, seed, id_col, text_col), "simhash-prints")
    nodes = written(prints.groupBy("fp").agg(F.min("id").alias("least")), "simhash-nodes")
    found = written(components(links(nodes, most)), "simhash-components")
    rooted = nodes.join(found, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    names = written(rooted.join(smallest, "root").select("fp", "component_id"), "simhash-names")
    return prints.join(names, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, most: int = 2, seed: int = 42, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """One row of each component, with all columns: that of the smallest id, NULL last, and of rows with one id the first.

    Rows are told apart by a number of their own, so an id that is used twice takes no unrelated row along.
    """
    row = free_name(docs, "_row")
    rows = written(docs.withColumn(row, F.monotonically_increasing_id()), "simhash-rows")
    found = near_duplicates(rows, shingle, most, seed, row, text_col).select(F.col(row).alias("n"), "component_id")
    ids = rows.select(F.col(row).alias("n"), col(id_col).alias("id"))
    named = written(found.join(ids, "n").select("n", "component_id", F.struct(F.col("id").isNull().alias("a"), "id", "n").alias("o")),
                    "simhash-named")
    first = named.groupBy("component_id").agg(F.min("o").alias("first"))
    lost = written(named.join(first, "component_id").filter(F.col("n") != F.col("first.n")).select(F.col("n").alias("lost")),
                   "simhash-lost")
    # One way at every size: the texts are shuffled once by their row's number.
    return rows.join(lost.hint("merge"), rows[row] == lost["lost"], "left_anti").drop(row)
