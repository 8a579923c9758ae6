"""Nearest neighbours by inner product: stable projections, kd-trees, and a chi-square stopping test.

Reduction. With M the largest norm, a vector x gains the coordinate sqrt(M^2 - |x|^2) and a query is scaled to norm M: then
the largest inner product is the smallest distance. A few Gaussian (2-stable) projections map distances d to
d * sqrt(chi-square with ``DIMS`` degrees of freedom), whatever the vectors are.

Index. The upper levels of a kd-tree over the projections are fitted to a bounded sample and cut the space into cells;
every vector goes to its cell, and a cell that holds more than ``BLOCK`` vectors is dealt to several blocks by a hash.
Each block is a row: its vectors, and a kd-tree over them that is built when it is searched.

Search. A query first searches a block of its own cell, which bounds the distance d_k of its k-th neighbour. Then
groups of queries go to all other blocks that the bound does not rule out. Within a block leaves come in
ascending order of their projected distance r, and their vectors are verified by true inner products. The search stops when
P(chi-square <= r^2 / d_k^2) reaches ``CONFIDENCE``: each vector nearer than d_k would by then have been met with
that probability. A task holds a bin of neighbouring blocks, each with its tree, and takes its queries through all of them, the
bound tightening on the way; only the k best that beat it leave the task.

Traffic. Bins are as large as ``BIN_BYTES`` allows (and at least ``BINS``, so that all cores have work), and a strip of up to
``STRIP`` groups of queries shares one copy of a bin. With n vectors, q queries, b bins and s strips at most b * q + s * n
vectors are moved: in proportion to the rows until one bin or one strip is full, then q * n over the size of a bin and of a strip.

Copies. Of equal vectors the k + 1 with the smallest ids are kept before anything is shuffled: more can never be among the
k nearest of a query, itself left out.

Defined results: vectors that are NULL, empty, zero, hold NULL or non-finite components, have no id, or have another
length than the most frequent one take no part. Rows that repeat id and vector count once. No candidate shares its
query's id. Ties go to the smaller id. Empty tables give an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidemark.llm import arrow
from tidemark.llm.common import col, written

#: Projections (an even number), and the confidence of the stopping test.
DIMS, CONFIDENCE = 8, 0.95
#: Vectors in a block, vectors in a leaf, queries in a group.
BLOCK, LEAF, QUERIES = 4096, 256, 256
#: Bytes of vectors in a bin of blocks, bins at least (if there are as many blocks), groups of queries that share a bin's copy.
BIN_BYTES, BINS, STRIP = 64 << 20, 16, 256
#: Levels of the fitted tree at most (so 2 ** LEVELS cells), and vectors it is fitted to at most, about.
LEVELS, SAMPLE = 12, 20_000


def chi_square_quantile(p: float, dims: int) -> float:
    """The value that a chi-square of an even number of degrees of freedom exceeds with probability 1 - p."""
    def cdf(x):
        return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(dims // 2))

    low, high = 0.0, 1.0
    while cdf(high) < p:
        high *= 2
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if cdf(middle) < p else (low, middle)
    return high


class Projection:
    """Gaussian projections of vectors and queries after the reduction to distances."""

    def __init__(self, length: int, norm: float, seed: int, dims: int = DIMS):
        self.norm = norm
        self.matrix = np.random.default_rng(seed).normal(size=(length + 1, dims))

    def vectors(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(0.0, self.norm ** 2 - (x * x).sum(axis=1)))
        return x @ self.matrix[:-1] + rest[:, None] * self.matrix[-1]

    def queries(self, q: np.ndarray) -> np.ndarray:
        return self.scaled(q) @ self.matrix[:-1]

    def scaled(self, q: np.ndarray) -> np.ndarray:
        return q * (self.norm / np.sqrt((q * q).sum(axis=1)))[:, None]


class Cells:
    """The fitted upper levels: a complete tree of median splits along the widest dimension."""

    def __init__(self, sample: np.ndarray, levels: int):
        self.levels = levels
        n = 2 ** levels - 1
        self.dim, self.at = np.zeros(n, np.int64), np.zeros(n)
        groups = [np.arange(len(sample))]
        for node in range(n):
            rows = sample[groups[node]]
            if len(rows):
                self.dim[node] = d = int(np.argmax(rows.max(axis=0) - rows.min(axis=0)))
                self.at[node] = np.median(rows[:, d])
            left = rows[:, self.dim[node]] <= self.at[node]
            groups += [groups[node][left], groups[node][~left]]

    def of(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), np.int64)
        for _ in range(self.levels):
            node = 2 * node + 1 + (points[np.arange(len(points)), self.dim[node]] > self.at[node])
        return node - (2 ** self.levels - 1)


class Block:
    """A kd-tree over the projections of a block; leaves are runs of neighbouring rows with their boxes."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, points: np.ndarray, leaf: int = LEAF):
        order, self.ends, todo = [], [], [np.arange(len(ids))]
        while todo:
            rows = todo.pop()
            if len(rows) <= leaf:
                order.append(rows)
                self.ends.append(len(rows))
                continue
            p = points[rows]
            d = int(np.argmax(p.max(axis=0) - p.min(axis=0)))
            half = np.argpartition(p[:, d], len(rows) // 2)
            todo += [rows[half[len(rows) // 2:]], rows[half[:len(rows) // 2]]]
        order = np.concatenate(order)
        self.ends = np.cumsum(self.ends)
        self.starts = self.ends - np.diff(self.ends, prepend=0)
        self.ids, self.vectors = ids[order], vectors[order]
        points = points[order]
        self.low = np.minimum.reduceat(points, self.starts, axis=0)
        self.high = np.maximum.reduceat(points, self.starts, axis=0)

    def search(self, qid: int, query: np.ndarray, distances: np.ndarray, norm: float, k: int, bound: float,
               quantile: float) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) that may be among the k best; ``bound`` is a score that k others reach already.

        ``distances``: squared projected distance of the query to the box of each leaf.
        """
        length = math.sqrt(float(query @ query))
        scale = 2 * norm / length
        ids, scores = np.empty(0, np.int64), np.empty(0)
        for leaf in np.argsort(distances):
            gap = 2 * norm * norm - scale * bound  # squared distance of the k-th neighbour
            if distances[leaf] > quantile * max(gap, 0.0):
                break
            rows = slice(self.starts[leaf], self.ends[leaf])
            found = self.vectors[rows] @ query
            near = np.flatnonzero(found >= bound - 1e-9 * length * norm)
            if not len(near):
                continue
            near = near[self.ids[rows][near] != qid]
            # one order of summation for all rows, so that equal vectors score alike
            exact = (self.vectors[rows][near] * query).sum(axis=1)
            ids, scores = np.concatenate([ids, self.ids[rows][near]]), np.concatenate([scores, exact])
            if len(ids) > k:
                best = np.lexsort((ids, -scores))[:k]
                ids, scores = ids[best], scores[best]
            if len(ids) == k:
                bound = max(bound, float(scores.min()))
        keep = scores >= bound
        return ids[keep], scores[keep]


def _box_distances(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of each point to each box."""
    out = np.zeros((len(points), len(low)))
    for d in range(points.shape[1]):
        x = points[:, d:d + 1]
        gap = np.maximum(low[:, d] - x, x - high[:, d])
        out += np.square(np.maximum(gap, 0.0))
    return out


def _merged(one, other, k: int, bound: float):
    """The k best of two lists of (ids, scores), and the score that k of them reach."""
    ids, scores = np.concatenate([one[0], other[0]]), np.concatenate([one[1], other[1]])
    if len(ids) >= k:
        best = np.lexsort((ids, -scores))[:k]
        ids, scores = ids[best], scores[best]
        bound = max(bound, float(scores.min()))
    return (ids, scores), bound


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec) of the rows that take part."""
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = (vectors.select(col(id_col).alias("id"), col(vec_col).cast("array<double>").alias("vec"))
            .filter(F.col("id").isNotNull() & F.col("vec").isNotNull() & ~bad & F.exists("vec", lambda x: x != 0)))
    lengths = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("vec") == (lengths["n"] if lengths else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def _dealt(placed: DataFrame, most: int, salt: Column) -> DataFrame:
    """Add ``part``: a cell of many rows is dealt to parts of about ``most`` rows."""
    parts = placed.groupBy("cell").agg(F.ceil(F.count("*") / most).alias("parts"))  # one row per cell
    return (placed.join(F.broadcast(parts), "cell")
            .withColumn("part", F.pmod(F.xxhash64(salt), F.col("parts")).cast("int")).drop("parts"))


def search(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
           seed: int = 5, dims: int = DIMS, confidence: float = CONFIDENCE, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row for which ``is_query`` holds, of all others."""
    spark = vectors.sparkSession
    arrow.reach_workers(spark)
    schema = "query_id long, rank int, vec_id long, score double"
    rows = written(usable(vectors, id_col, vec_col).distinct(), "ann-rows")
    facts = rows.agg(F.count("*").alias("n"), F.max(F.size("vec")).alias("length"), F.max(F.sqrt(F.aggregate(
        "vec", F.lit(0.0), lambda a, x: a + x * x))).alias("norm")).first()
    if not facts["n"]:
        return spark.createDataFrame([], schema)
    n, length = facts["n"], facts["length"]
    projection = Projection(length, facts["norm"] * (1 + 1e-12), seed, dims)
    levels = min(LEVELS, max(0, math.ceil(math.log2(n / block))))
    portion = min(1.0, SAMPLE / n)
    picked = rows.filter(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 20)) < int(portion * (1 << 20))).select("vec")
    sample = _matrix(picked.toArrow().column(0).combine_chunks())  # about SAMPLE vectors
    cells = Cells(projection.vectors(sample.reshape(-1, length)), levels)
    quantile = chi_square_quantile(confidence, dims)
    tools = spark.sparkContext.broadcast((projection, cells))
    k1 = k + 1

    def place(as_query):
        def run(batches):
            projection, cells = tools.value
            for batch in batches:
                if batch.num_rows:
                    x = _matrix(batch.column(1))
                    points = projection.queries(x) if as_query else projection.vectors(x)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0), batch.column(1), pa.array(cells.of(points), pa.int32())], ["id", "vec", "cell"])
        return run

    placed = "id long, vec array<double>, cell int"
    first = W.partitionBy("vec").orderBy("id")
    once = rows.withColumn("nth", F.row_number().over(first)).filter(F.col("nth") <= k1).select("id", "vec")
    data = written(arrow.mapped(once, place(False), placed), "ann-placed")

    def pack(table: pa.Table) -> pa.Table:
        projection, _ = tools.value
        table = table.combine_chunks()
        points = projection.vectors(_matrix(table["vec"].chunk(0)))
        values = table["vec"].chunk(0).flatten()
        return pa.table({"cell": table["cell"].slice(0, 1), "part": table["part"].slice(0, 1),
                         "ids": pa.array([table["id"].chunk(0).to_numpy()], pa.list_(pa.int64())),
                         "vecs": pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values),
                         "low": pa.array([points.min(axis=0)], pa.list_(pa.float64())),
                         "high": pa.array([points.max(axis=0)], pa.list_(pa.float64()))})

    blocks = written(_dealt(data, block, F.col("id")).groupBy("cell", "part").applyInArrow(
        pack, "cell int, part int, ids array<long>, vecs array<double>, low array<double>, high array<double>"),
        "ann-blocks")
    asked = (vectors.filter(is_query).select(col(id_col).alias("id")).distinct())
    queries = written(arrow.mapped(rows.join(asked, "id").select("id", "vec"), place(True), placed), "ann-asked")

    def pack_queries(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        values = table["vec"].chunk(0).flatten()
        return pa.table({"q_cell": table["cell"].slice(0, 1), "q_part": table["part"].slice(0, 1),
                         "q_ids": pa.array([table["id"].chunk(0).to_numpy()], pa.list_(pa.int64())),
                         "q_vecs": pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)})

    groups = written(_dealt(queries, QUERIES, F.col("id")).groupBy("cell", "part").applyInArrow(
        pack_queries, "q_cell int, q_part int, q_ids array<long>, q_vecs array<double>"), "ann-queries")

    def compare(bounded):
        """A cogroup of blocks and groups of queries: the k best of each query; a block already searched is left out."""
        def run(blocks: pa.Table, groups: pa.Table) -> pa.Table:
            projection, _ = tools.value
            trees = []
            for batch in blocks.select(["cell", "part", "ids", "vecs"]).to_batches() if groups.num_rows else []:
                for i in range(batch.num_rows):
                    x = batch.column(3)[i].values.to_numpy().reshape(-1, length)
                    trees.append((batch.column(0)[i].as_py(), batch.column(1)[i].as_py(),
                                  Block(batch.column(2)[i].values.to_numpy(), x, projection.vectors(x))))
            parts = [[pa.array([], t) for t in kinds]]
            for batch in groups.select(["q_cell", "q_part", "q_ids", "q_vecs", *bounded]).to_batches() if trees else []:
                for i in range(batch.num_rows):
                    own = batch.column(0)[i].as_py()
                    q_ids = batch.column(2)[i].values.to_numpy()
                    q = batch.column(3)[i].values.to_numpy().reshape(-1, length)
                    bounds = batch.column(4)[i].values.to_numpy().copy() if bounded else np.full(len(q), -np.inf)
                    best = [(np.empty(0, np.int64), np.empty(0))] * len(q)
                    points = projection.queries(q)
                    for cell, part, tree in trees:
                        if bounded and (cell, part) == (own, 0):
                            continue
                        distances = _box_distances(points, tree.low, tree.high)
                        for j in range(len(q)):
                            ids, scores = tree.search(int(q_ids[j]), q[j], distances[j], projection.norm, k,
                                                      float(bounds[j]), quantile)
                            if len(ids):
                                best[j], bounds[j] = _merged(best[j], (ids, scores), k, float(bounds[j]))
                    sizes = [len(ids) for ids, _ in best]
                    parts.append([
                        pa.array(np.repeat(q_ids, sizes)), pa.array(np.repeat(np.arange(len(q)), sizes), pa.int32()),
                        pa.array(np.full(sum(sizes), own), pa.int32()),
                        pa.array(np.full(sum(sizes), batch.column(1)[i].as_py()), pa.int32()),
                        pa.array(np.concatenate([ids for ids, _ in best])), pa.array(np.concatenate([x for _, x in best]))])
            return pa.table([pa.concat_arrays(list(column)) for column in zip(*parts)],
                            ["query_id", "q_at", "q_cell", "q_part", "vec_id", "score"])
        return run

    kinds = pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.float64()
    out = "query_id long, q_at int, q_cell int, q_part int, vec_id long, score double"
    strip = F.floor(F.col("q_part") / STRIP)
    asking = groups.withColumn("strip", strip)
    homes = (blocks.filter("part = 0").join(asking.select(F.col("q_cell").alias("cell"), F.col("strip").alias("copy")).distinct(), "cell")
             .select("cell", "copy", "part", "ids", "vecs"))
    near = written(homes.groupBy("cell", "copy").cogroup(asking.groupBy("q_cell", "strip"))
                   .applyInArrow(compare([]), out), "ann-home")
    # the score that k candidates of the own cell reach already; none if there were fewer
    reached = near.groupBy("q_cell", "q_part", "q_at").agg(
        F.when(F.count("*") >= k, F.min("score")).otherwise(float("-inf")).alias("bound"))
    listed = reached.groupBy("q_cell", "q_part").agg(F.map_from_entries(F.collect_list(F.struct("q_at", "bound")))
                                                    .alias("known"))
    bounded = written(
        groups.join(listed, ["q_cell", "q_part"], "left").withColumn("bounds", F.transform(
            F.sequence(F.lit(0), F.size("q_ids") - 1),
            lambda i: F.coalesce(F.element_at("known", i), F.lit(float("-inf"))))).drop("known"), "ann-bounds")
    boxes = blocks.groupBy("cell").agg(
        F.max("part").alias("last"), *[F.min(F.col("low")[d]).alias(f"l{d}") for d in range(dims)],
        *[F.max(F.col("high")[d]).alias(f"h{d}") for d in range(dims)]).orderBy("cell").toArrow()  # one row per cell
    edges = [np.stack([boxes.column(f"{side}{d}").to_numpy() for d in range(dims)], axis=1) for side in "lh"]
    # blocks are numbered in the order of the tree, and neighbours share a bin
    sizes = boxes.column("last").to_numpy().astype(np.int64) + 1
    before = np.cumsum(sizes) - sizes
    total = int(sizes.sum())
    bins = min(total, max(BINS, math.ceil(n * length * 8 / BIN_BYTES)))
    numbered = spark.createDataFrame(list(zip(boxes.column("cell").to_pylist(), before.tolist())), "cell int, before long")
    room = spark.sparkContext.broadcast((boxes.column("cell").to_numpy(), before, sizes, *edges))

    def route(batches):
        """Each group of queries once for each bin that may hold a neighbour."""
        projection, _ = tools.value
        cells, before, sizes, low, high = room.value
        for batch in batches:
            for i in range(batch.num_rows):
                q = batch.column(3)[i].values.to_numpy().reshape(-1, length)
                bounds = batch.column(4)[i].values.to_numpy()
                scale = 2 * projection.norm / np.sqrt((q * q).sum(axis=1))
                gap = np.maximum(0.0, 2 * projection.norm ** 2 - scale * bounds)
                open_ = (_box_distances(projection.queries(q), low, high) <= quantile * gap[:, None]).any(axis=0)
                open_ &= (cells != batch.column(0)[i].as_py()) | (sizes > 1)  # its own only block is done
                reached = np.zeros(bins, bool)
                for first, last in zip(before[open_] * bins // total, (before[open_] + sizes[open_] - 1) * bins // total):
                    reached[first:last + 1] = True
                for to in np.flatnonzero(reached):
                    yield pa.RecordBatch.from_arrays([*batch.slice(i, 1).columns, pa.array([to], pa.int32())],
                                                     [*batch.schema.names, "bin"])

    asked_groups = groups.count()
    strips = max(1, math.ceil(asked_groups / STRIP))
    salted = F.pmod(F.xxhash64("q_cell", "q_part"), F.lit(strips)).cast("int")
    work = arrow.mapped(bounded.select("q_cell", "q_part", "q_ids", "q_vecs", "bounds"), route,
                        "q_cell int, q_part int, q_ids array<long>, q_vecs array<double>, bounds array<double>, bin int")
    # an explicit number of partitions: the work is in the searches, which sizes in bytes do not show
    tasks = 2 * bins * strips
    work = work.withColumn("strip", salted).repartition(tasks, "bin", "strip")
    held = (blocks.join(F.broadcast(numbered), "cell")
            .withColumn("bin", F.floor((F.col("before") + F.col("part")) * bins / total).cast("int"))
            .withColumn("strip", F.explode(F.sequence(F.lit(0), F.lit(strips - 1))))
            .select("bin", "strip", "cell", "part", "ids", "vecs").repartition(tasks, "bin", "strip"))
    far = held.groupBy("bin", "strip").cogroup(work.groupBy("bin", "strip")).applyInArrow(compare(["bounds"]), out)
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (near.unionByName(far).select("query_id", "vec_id", "score").distinct()
            .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
