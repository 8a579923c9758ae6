"""Jaccard similarity join on word shingles by a pigeonhole partition of the universe.

Sets. A text's distinct shingles, hashed to 64 bits. Equal sets (same size and 128-bit digest) are one node.

Partition. Sizes fall into bands (each half as wide again as the one before). A band has m segments, and a shingle's hash tells its
segment. Two sets r, s (|r| <= |s|) that reach the threshold differ in at most H = (1 - t) / (1 + t) * (|r| + |s|) shingles. If s
looks up its segments with thresholds v (-1: not at all, 0: the same subset, 1: the same up to one deletion) and the sum of
v + 1 exceeds H, then by the pigeonhole principle at least one lookup finds r.

Index. Every set enters the subset of each segment of its own band, and for the first few segments also the subsets with
one shingle deleted. It looks up partners in its own band and, where the threshold allows, in the band below.

Allocation. A fixed-size sketch over all sets estimates how often each subset occurs. Every set takes the cheapest lookups
that reach H + 1: it leaves out frequent subsets (above all empty segments) and makes up for them with
one-deletion lookups elsewhere.

Candidates. Entries travel to their keys in packed arrays, 12 bytes each, and only keys with a lookup and two sets or
more go on. Within a key nothing is paired with everything: the first set that looks up leads, all others are compared
with it, and those of its component are done. Where a key still holds several components, the next 15, 240, ... lead.
So a group of near copies costs one comparison each, and a pair is left out only if links join it already, or if
sizes or parities rule it out: a set's parity bits count its shingles modulo two by hash, and two sets differ in at least as
many shingles as their parities differ in bits. A set's sketch has two bits or more for a shingle; folded to ``PARITY`` words
it travels with the entries, whole it meets the sketches of the pairs that are left. Keys with the same entries give the same pairs, so
one of them stays.

Verification compares the shingles themselves, from whole texts. Membership filters of fixed size pick the texts that
take part at all, and those that the pairs of a round need.

Defined results: NULL and texts without words have an empty set, which is linked with nothing; fewer words than a shingle
make one shingle of them all. A component is named by its smallest id; NULL ids are ignored in that (NULL if there is no
other). Rows that repeat are nodes like others. An empty table gives an empty result.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidemark.llm import arrow
from tidemark.llm.common import col, written
from tidemark.llm.components import components
from tidemark.operators.membership import bitmaps, may_match

#: Counters of the sketch that estimates how often a subset occurs.
COUNTERS = 1 << 17
#: Entries that a task packs at once, and entries that meet in one partition, about.
PACKED, PARTITION = 250_000, 1_000_000
#: Bytes of text that are hashed at once, and of a batch that goes to Python, about.
PIECE, BATCH = 512 << 10, 4 << 20
#: A key with more entries than this (above the sketch's noise) is split.
SPLIT = 1_000_000
#: Words of 64 bits of the parities beside an entry, and of the longest sketch.
PARITY, LONGEST = 16, 256
#: Parity bits that are counted at once, 8 bytes each.
COUNTED = 1 << 20
#: Shingles that a comparing task keeps, about 100 bytes each.
KEPT = 250_000
#: Sets that lead in a key: one, then this many times as many in each round.
WIDEN = 16

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_U = np.uint64


def shingle_set(text: str, size: int) -> set[bytes]:
    words = text.encode().translate(_LOWER).split()  # bytes split at exactly space, \t, \n, \v, \f, \r
    if len(words) <= size:
        return {b" ".join(words)} if words else set()
    whole, starts, at = b" ".join(words), [0], 0
    for n in map(len, words):
        at += n + 1
        starts.append(at)
    return {whole[s:e - 1] for s, e in zip(starts, starts[size:])}


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input moves every bit of the output."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Bands:
    """Bands of sizes for a threshold in percent, and the segments of each."""

    def __init__(self, percent: int, largest: int):
        self.p = percent
        edges = [1]
        while edges[-1] <= largest:
            edges.append(max(edges[-1] + 1, -(-3 * edges[-1] // 2)))
        self.edges = np.array(edges, np.int64)
        top = self.edges[1:] - 1  # largest size of each band
        most = self.differ(top, top * 100 // percent)
        self.segments = most + 1 + most // 16
        self.deleted = np.where(most == 0, 0, np.minimum(self.segments, np.maximum(4, 1 + self.segments // 16)))
        self.top = top

    def differ(self, r, s):
        """The most shingles in which sets of these sizes may differ."""
        return (100 - self.p) * (r + s) // (100 + self.p)

    def of(self, n: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.edges, n, "right") - 1


class Entries:
    """Keys of some sets in one band each."""

    def __init__(self, bands: Bands, hashes: np.ndarray, n: np.ndarray, band: np.ndarray):
        m = bands.segments[band]
        base = np.cumsum(m) - m
        self.doc = np.repeat(np.arange(len(n)), m)  # of each segment
        owner = np.repeat(np.arange(len(n)), n)  # of each shingle
        seg = (hashes % m[owner].astype(_U)).astype(np.int64)
        at = base[owner] + seg
        order = np.argsort(at, kind="stable")
        self.count = np.bincount(at, minlength=len(self.doc))
        total = np.zeros(len(self.doc), _U)
        full = np.flatnonzero(self.count)
        if len(full):
            total[full] = np.add.reduceat(hashes[order], np.cumsum(self.count[full]) - self.count[full])
        number = np.arange(len(self.doc)) - base[self.doc]
        tag = mixed((band[self.doc].astype(_U) << _U(40)) + number.astype(_U) + _U(1))
        self.keys = mixed(total ^ tag)
        self.open = number < bands.deleted[band[self.doc]]  # segments with one-deletion keys
        inner = np.flatnonzero(self.open[at])
        self.of = at[inner]  # the segment of each one-deletion key
        self.less = mixed((total[self.of] - hashes[inner]) ^ tag[self.of])

    def allocate(self, need: np.ndarray, sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which segments are looked up, and which of them also up to one deletion: the cheapest that make up ``need``."""
        cost = sketch[place(self.keys)]
        cost = np.where(self.count == 0, np.iinfo(np.int64).max // 4, cost)
        more = np.bincount(self.of, sketch[place(self.less)], len(self.doc)).astype(np.int64)
        opened = np.flatnonzero(self.open)
        doc = np.concatenate([self.doc, self.doc[opened]])
        order = np.lexsort((np.concatenate([cost, np.maximum(cost, more)[opened]]), doc))
        start = np.searchsorted(doc[order], np.arange(len(need)))
        taken = np.zeros(len(doc), bool)
        taken[order] = np.arange(len(doc)) - start[doc[order]] < need[doc[order]]
        second = np.zeros(len(self.doc), bool)
        second[opened] = taken[len(self.doc):]
        return taken[:len(self.doc)], second


def place(keys: np.ndarray) -> np.ndarray:
    return (keys >> _U(64 - COUNTERS.bit_length() + 1)).astype(np.int64)


def _hashed(texts: list[str], shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text, one text after another, and how many each has. A shingle's hash mixes those of its words in order."""
    digest = xxhash.xxh64_intdigest
    split = [t.encode().translate(_LOWER).split() for t in texts]
    words = np.fromiter(map(len, split), np.int64, len(split))
    flat = np.fromiter(map(digest, chain.from_iterable(split)), np.uint64, int(words.sum()))
    n = np.where(words == 0, 0, np.maximum(1, words - shingle + 1))
    doc = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(doc)) + np.repeat(np.cumsum(words) - words - (np.cumsum(n) - n), n)
    out = np.zeros(len(doc), _U)
    short = np.repeat(words, n) < shingle
    for k in range(shingle):
        inside = ~short | (k < words[doc])
        out = np.where(inside, mixed(out + flat[np.minimum(at + k, len(flat) - 1)] + _U(k + 1)), out)
    order = np.lexsort((out, doc))
    out, doc = out[order], doc[order]
    new = np.append(True, (out[1:] != out[:-1]) | (doc[1:] != doc[:-1]))[:len(out)]
    return out[new], np.bincount(doc[new], minlength=len(n))


def parities(hashes: np.ndarray, n: np.ndarray) -> list[bytes]:
    """For sets of ``n`` hashes, one set after another: bits that each hash flips one of, from two for a hash up to the next power of two."""
    width = 64 * np.clip(1 << np.ceil(np.log2(np.maximum(1, n / 32))).astype(np.int64), PARITY, LONGEST)
    block = np.cumsum(width) // COUNTED
    cuts = [*np.flatnonzero(np.append(True, block[1:] != block[:-1])).tolist(), len(n)] if len(n) else []
    ends = np.append(0, np.cumsum(n))
    out = []
    for a, b in zip(cuts, cuts[1:]):
        start = np.cumsum(width[a:b]) - width[a:b]
        own = mixed(hashes[ends[a]:ends[b]] + _U(11)) & np.repeat(width[a:b] - 1, n[a:b]).astype(_U)
        odd = np.bincount(own.astype(np.int64) + np.repeat(start, n[a:b]), minlength=int(width[a:b].sum())) & 1
        packed = np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()
        out += [packed[x:x + w] for x, w in zip((start // 8).tolist(), (width[a:b] // 8).tolist())]
    return out


def folded(sketch: bytes, words: int) -> np.ndarray:
    """The sketch as one of so many words: what it would be with fewer bits."""
    return np.bitwise_xor.reduce(np.frombuffer(sketch, _U).reshape(-1, words), axis=0)


# -- sets --------------------------------------------------------------------------------


def _sets(docs: DataFrame, shingle: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """(row, id, n, d1, d2, parities, text), and one row per task with its part of the counters only."""
    names = ["row", "id", "n", "d1", "d2", "parities", "text", "counts"]

    def run(batches):
        start, done, counts = TaskContext.get().partitionId() << 33, 0, np.zeros(COUNTERS, np.int64)
        kind = None
        for batch in batches:
            kind = batch.schema.field(0).type
            for part, texts in arrow.pieces(batch, "text", PIECE):
                hashes, n = _hashed(texts, shingle)
                full = n > 0
                sums = [np.zeros(len(n), _U) for _ in range(2)]
                odd: list = [None] * len(n)
                if full.any():
                    first = (np.cumsum(n) - n)[full]
                    for k in range(2):
                        sums[k][full] = np.add.reduceat(hashes if k == 0 else mixed(hashes + _U(k)), first)
                    for k, bits in zip(np.flatnonzero(full).tolist(), parities(hashes, n[full])):
                        odd[k] = bits
                    bands = Bands(percent, int(n.max()))
                    own = Entries(bands, hashes, n[full], bands.of(n[full]))
                    for keys in (own.keys, own.less):
                        counts += np.bincount(place(keys), minlength=COUNTERS)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(start + done + np.arange(len(n))), part.column(0), pa.array(n),
                     *[pa.array(x.view(np.int64)) for x in sums], pa.array(odd, pa.binary()), part.column(1),
                     pa.nulls(len(n), pa.binary())], names)
                done += len(n)
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, pa.int64()), pa.nulls(1, kind), *[pa.nulls(1, pa.int64())] * 3, pa.nulls(1, pa.binary()), pa.nulls(1, pa.string()),
                 pa.array([np.minimum(counts, 2 ** 32 - 1).astype(np.uint32).tobytes()], pa.binary())], names)

    narrow = docs.select(col(id_col).alias("id"), col(text_col).alias("text"))
    schema = T.StructType([T.StructField("row", T.LongType()), T.StructField("id", narrow.schema["id"].dataType),
                           *[T.StructField(c, T.LongType()) for c in ("n", "d1", "d2")],
                           T.StructField("parities", T.BinaryType()), T.StructField("text", T.StringType()), T.StructField("counts", T.BinaryType())])
    return arrow.mapped(narrow, run, schema)


def _sketch(sets: DataFrame) -> np.ndarray:
    """The sum of all parts: ``COUNTERS`` numbers, whatever the input."""
    def add(batches):
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for part in batch.column(0):
                total += np.frombuffer(part.as_py(), np.uint32)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "n"])

    parts = arrow.mapped(sets.filter("counts is not null").select("counts"), add, "at long, n long")
    summed = parts.groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(COUNTERS, np.int64)
    out[summed.column(0).to_numpy()] = summed.column(1).to_numpy()
    return out


# -- candidates --------------------------------------------------------------------------


def _live(sets: DataFrame, shingle: int, percent: int, sketch: np.ndarray, largest: int, entries: int) -> DataFrame:
    """(key, node, asks, visits): the entries of keys that a lookup and another set share. ``asks``: the set looks the key up;
    ``visits``: it belongs to the band above."""
    parts = max(1, -(-entries // PARTITION))
    noise = 2 * int(sketch.mean())
    shared = sets.sparkSession.sparkContext.broadcast(sketch)

    def pack(batches):
        sketch, bands = shared.value, Bands(percent, largest)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size, base = 0, None

        def flush():
            keys, codes = (np.concatenate(x) for x in zip(*held))
            split = np.maximum(1, -(-(sketch[place(keys)] - noise) // SPLIT)).astype(_U)
            to = ((mixed(keys + _U(7)) + mixed(codes.astype(_U) >> _U(2)) % split) % _U(parts)).astype(np.int64)
            order = np.argsort(to, kind="stable")
            keys, codes, to, split = keys[order], codes[order], to[order], split[order]
            found, start = np.unique(to, return_index=True)
            cuts = [*start.tolist(), len(to)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found), pa.array([base] * len(found), pa.int64()),
                 pa.array([keys[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
                 pa.array([codes[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
                 pa.array([keys[a:b][split[a:b] > 1].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())],
                ["to", "base", "keys", "codes", "hot"])

        def task_runs():
            """(rows, texts) of one writing task each: rows of several files may share a batch."""
            for batch in batches:
                for part, texts in arrow.pieces(batch, "text", PIECE):
                    row = part.column(0).to_numpy()
                    cuts = [0, *(np.flatnonzero(np.diff(row >> 33)) + 1).tolist(), len(row)]
                    for a, b in zip(cuts, cuts[1:]):
                        yield row[a:b], texts[a:b]

        for row, texts in task_runs():
            hashes, n = _hashed(texts, shingle)
            if not len(hashes):
                continue
            if held and int(row[0]) >> 33 << 33 != base:
                yield from flush()
                held, size = [], 0
            base = int(row[0]) >> 33 << 33
            keep = n > 0
            offset, n = ((row[keep] - base) * 4).astype(np.uint32), n[keep]
            own, lowest = bands.of(n), bands.of(np.maximum(1, -(-percent * n // 100)))
            for step in range(int((own - lowest).max()) + 1):
                some = own - step >= lowest
                band = own[some] - step
                e = Entries(bands, hashes[np.repeat(some, n)], n[some], band)
                need = bands.differ(np.minimum(n[some], bands.top[band]), n[some]) + 1
                first, second = e.allocate(need, sketch)
                code = offset[some]
                if step:  # a visitor brings its lookups only
                    far, less = np.flatnonzero(first), np.flatnonzero(second[e.of])
                    keys = np.concatenate([e.keys[far], e.less[less]])
                    codes = np.concatenate([code[e.doc[far]], code[e.doc[e.of[less]]]]) + np.uint32(3)
                else:
                    keys = np.concatenate([e.keys, e.less])
                    codes = np.concatenate([code[e.doc] + first, code[e.doc[e.of]] + second[e.of]])
                held.append((keys, codes.astype(np.uint32)))
                size += len(keys)
            if size > PACKED:
                yield from flush()
                held, size = [], 0
        if held:
            yield from flush()

    def meet(batches):
        def groups(rows):
            keys = np.concatenate([np.frombuffer(r[2], np.uint64) for r in rows])
            codes = np.concatenate([np.frombuffer(r[3], np.uint32).astype(np.int64) + 4 * (r[1] >> 33 << 33) for r in rows])
            hot = np.unique(np.concatenate([np.frombuffer(r[4], np.uint64) for r in rows]))
            order = np.argsort(keys, kind="stable")
            keys, codes = keys[order], codes[order]
            start = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            size = np.diff(np.append(start, len(keys)))
            asks, visits, node = (codes & 1).astype(bool), (codes & 2).astype(bool), codes >> 2
            two = np.maximum.reduceat(node, start) != np.minimum.reduceat(node, start)
            good = two & np.logical_or.reduceat(asks, start) & np.logical_or.reduceat(~visits, start)
            good |= np.isin(keys[start], hot)  # the rest of a split key is elsewhere
            at = np.flatnonzero(np.repeat(good, size))
            for s in range(0, len(at), 100_000):
                x = at[s:s + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[x].view(np.int64)), pa.array(node[x]), pa.array(asks[x]),
                     pa.array(visits[x])], ["key", "node", "asks", "visits"])

        at, rows = None, []
        for batch in batches:
            for r in zip(*(c.to_pylist() for c in batch.columns)):
                if r[0] != at and rows:
                    yield from groups(rows)
                    rows = []
                at = r[0]
                rows.append(r)
        if rows:
            yield from groups(rows)

    packed = arrow.mapped(sets.filter("row is not null").select("row", "text"), pack,
                          "to long, base long, keys binary, codes binary, hot binary")
    return arrow.mapped(packed.repartition(parts, "to").sortWithinPartitions("to"), meet,
                        "key long, node long, asks boolean, visits boolean")


# -- verification and rounds -------------------------------------------------------------


def _near(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) that sizes and whole sketches allow: none whose sets reach the threshold are left out."""
    a = texts.select(F.col("row").alias("u"), F.col("n").alias("nu"), F.col("parities").alias("pu"))
    b = texts.select(F.col("row").alias("v"), F.col("n").alias("nv"), F.col("parities").alias("pv"))
    both = pairs.join(a, "u").join(b, "v").filter(F.least("nu", "nv") * 100 >= F.greatest("nu", "nv") * percent)

    def compare(batches):
        for batch in batches:
            left, right = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            apart = np.zeros(len(left), np.int64)
            for i, (pu, pv) in enumerate(zip(left, right)):
                words = min(len(pu), len(pv)) // 8
                apart[i] = int(np.bitwise_count(folded(pu, words) ^ folded(pv, words)).sum())
            keep = apart * (100 + percent) <= batch.column(4).to_numpy() * (100 - percent)
            yield batch.select([0, 1]).filter(pa.array(keep))

    return arrow.mapped(both.select("u", "v", "pu", "pv", F.expr("nu + nv").alias("n")), compare, "u long, v long")


def _verify(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (u, v) whose sets reach the threshold."""
    pairs = written(_near(pairs, texts, percent), "jaccard-near")
    ends = pairs.select(F.explode(F.array("u", "v")).alias("row"))
    texts = may_match(texts.select("row", "n", "text"), bitmaps(ends, F.col("row")), F.col("row")).filter("_may_match")
    a = texts.select(F.col("row").alias("u"), F.col("n").alias("nu"), F.col("text").alias("tu"))
    b = texts.select(F.col("row").alias("v"), F.col("n").alias("nv"), F.col("text").alias("tv"))
    both = (pairs.join(a, "u").join(b, "v").filter(F.least("nu", "nv") * 100 >= F.greatest("nu", "nv") * percent)
            .select("u", "v", "tu", "tv"))

    def compare(batches):
        at, leader = None, set()
        met: dict[int, set[bytes]] = {}  # sets met before: a set is compared with many leaders
        room = KEPT
        for batch in batches:
            out = []
            for u, v, tu, tv in zip(*(batch.column(i) for i in range(4))):
                if v.as_py() != at:
                    at, leader = v.as_py(), shingle_set(tv.as_py(), shingle)
                key = u.as_py()
                other = met.get(key)
                if other is None:
                    other = shingle_set(tu.as_py(), shingle)
                    if len(other) > room:
                        met.clear()
                        room = KEPT
                    if len(other) <= room:
                        met[key] = other
                        room -= len(other)
                same = len(leader & other)
                if 100 * same >= percent * (len(leader) + len(other) - same):
                    out.append((key, at))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], ["u", "v"])

    return arrow.mapped(both, compare, "u long, v long")


def _facts(texts: DataFrame) -> DataFrame:
    """(node, n, parities in words) of each text."""
    names = ["node", "n", *[f"b{k}" for k in range(PARITY)]]

    def run(batches):
        for batch in batches:
            words = np.array([folded(x, PARITY) for x in batch.column(2).to_pylist()], _U).reshape(-1, PARITY).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(words[:, k]) for k in range(PARITY)]], names)

    return arrow.mapped(texts.select("row", "n", "parities"), run, ", ".join(f"{c} long" for c in names))


def _possible(percent: int) -> Column:
    """Sizes and parities of two sets allow the threshold: none that reach it are left out."""
    apart = sum((F.bit_count(F.col(f"b{k}").bitwiseXOR(F.col(f"v_b{k}"))) for k in range(PARITY)), F.lit(0))
    return ((F.least("n", "v_n") * 100 >= F.greatest("n", "v_n") * percent)
            & (apart * (100 + percent) <= (F.col("n") + F.col("v_n")) * (100 - percent)))


def _roots(live: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(node, root) of the nodes with links; two nodes of a key that reach the threshold have one root.

    Sizes and parities join the entries after the first round, which leaves few of these.
    """
    spark = live.sparkSession
    links = tested = spark.createDataFrame([], "u long, v long")
    roots = spark.createDataFrame([], "node long, root long")
    live, served, upto, first = live.withColumn("root", F.col("node")), 0, 1, True
    known: list[str] = []
    while True:
        number = F.row_number().over(Window.partitionBy("key").orderBy("node"))
        lead = (live.filter("asks").select("key", F.col("node").alias("v"), F.col("visits").alias("v_visits"),
                                           F.col("root").alias("v_root"), *[F.col(c).alias(f"v_{c}") for c in known], number.alias("place"))
                .filter(f"place <= {upto}").filter(f"place > {served}").drop("place"))
        pairs = live.join(lead, "key").filter("root <> v_root and not (visits and v_visits)")
        pairs = (pairs.filter(_possible(percent)) if known else pairs).select(F.col("node").alias("u"), "v")
        if first:  # each set is compared with one leader before any other
            pairs = pairs.groupBy("u").agg(F.min("v").alias("v"))
        pairs = pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        pairs = written(pairs.join(tested, ["u", "v"], "left_anti"), "jaccard-pairs")
        found = written(_verify(pairs, texts, shingle, percent), "jaccard-links")
        tested = tested.unionByName(pairs)
        if not found.isEmpty():
            links = links.unionByName(found)
            roots = written(components(links), "jaccard-roots")
        if not first:
            served, upto = upto, upto * WIDEN
        # keys whose sets are all in one component, or have all led, are done; of keys with the same entries the smallest stays
        here = live.drop("root").join(roots, "node", "left").select("key", "node", "asks", "visits", *known, F.coalesce("root", "node").alias("root"))
        entry = ["node", "asks", "visits"]
        some = here.groupBy("key").agg(F.sum(F.col("asks").cast("int")).alias("n"), F.min("root").alias("a"), F.max("root").alias("b"),
                                       F.bit_xor(F.xxhash64(*entry)).alias("h1"), F.bit_xor(F.xxhash64(F.lit(1), *entry)).alias("h2"), F.count("*").alias("size"))
        some = some.filter((F.col("a") != F.col("b")) & (F.col("n") > served)).groupBy("size", "h1", "h2").agg(F.min("key").alias("key"))
        left = here.join(some.select("key"), "key", "left_semi")
        if first:
            facts = _facts(texts)
            left, known, first = left.join(facts, "node"), [c for c in facts.columns if c != "node"], False
        live = written(left, "jaccard-live")
        if live.isEmpty():
            return roots


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document: id, n_shingles, component_id (smallest id reachable over links, itself included)."""
    with arrow.batches_of(docs.sparkSession, BATCH):
        return _named(docs, shingle, percent, id_col, text_col)


def _named(docs: DataFrame, shingle: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    sets = written(_sets(docs, shingle, percent, id_col, text_col), "jaccard-sets")
    prints = sets.filter("row is not null").select("row", "id", "n", "d1", "d2")
    largest, shingles, rows = prints.agg(F.coalesce(F.max("n"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    # equal sets are one node, named by its first row
    nodes = written(prints.filter("n > 0").groupBy("n", "d1", "d2").agg(
        F.min("row").alias("node"), F.min("id").alias("least")), "jaccard-nodes")
    named = written(prints.join(nodes, ["n", "d1", "d2"], "left").select(
        "row", "id", "n", F.coalesce("node", "row").alias("node"), F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("id")).alias("least")),
        "jaccard-named")
    single = sets.filter("row is not null and n > 0")
    entries = written(_live(single, shingle, percent, _sketch(sets), largest, int(0.55 * shingles) + 8 * rows), "jaccard-entries")
    copies = named.filter("row <> node").select(F.col("row").alias("copy"), F.col("node").alias("first"))
    live = written(entries.join(copies, F.col("node") == F.col("copy"), "left").groupBy(
        "key", F.coalesce("first", "node").alias("node")).agg(F.max("asks").alias("asks"), F.min("visits").alias("visits")), "jaccard-live")
    some = may_match(single.select("row", "n", "parities", "text"), bitmaps(live, F.col("node")), F.col("row"))
    texts = written(some.filter("_may_match").drop("_may_match"), "jaccard-texts")
    found = _roots(live, texts, shingle, percent)
    rooted = nodes.join(found, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    names = rooted.groupBy("root").agg(F.min("least").alias("component"))
    component = written(rooted.join(names, "root").select("node", "component"), "jaccard-names")
    return named.join(component, "node", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")).alias("component_id"))
