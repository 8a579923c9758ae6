"""Spelling variants: words one edit apart, grouped under their most frequent form.

Words. Maximal runs of letters are lower-cased and counted; the counts are summed per piece of text before they are
shuffled.

Sorted lists. Two words one edit apart share the first or the last half of their letters. So the vocabulary is kept in
sorted order twice, once with each word reversed, and cut into blocks. A word is looked for only among the words that
begin with its first half (in the second list: end with its last half); a pair that both lists would find
counts in the first.

Scan. A word is compared with a sorted list by dynamic programming over a band of three cells per row, which is all that one
edit can reach. The rows of the letters that a list word shares with the one before it (their longest common prefix) are
reused. If all cells of a row exceed one edit, the range of words that share these letters is skipped. All words of a slice
advance side by side, each with its own place in the list and its own rows.

Routing. The same scan over the letters that all words of a block share (at most ``MOST_BLOCKS`` of them, cut at ``REACH``
letters) tells which blocks a word must be sent to. Found pairs are never listed: a task reduces them to a count and the best
word per word.

Roots follow forms by pointer doubling: a form has at least ``ratio`` times the occurrences, so chains are short and
have no cycles.

Defined results: NULL texts and NULL words say nothing; a NULL id counts as empty text; equal words in a vocabulary are
added up. Ties go to the word first in code-point order. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm import arrow
from tidemark.llm.common import col, written

#: Words in a block, and blocks at most: beyond that blocks grow, not their number.
BLOCK, MOST_BLOCKS = 16_384, 16_384
#: Letters of a block's shared prefix that are used for routing.
REACH = 64
#: Words that are looked for side by side, and cells of their rows.
SLICE, CELLS = 8192, 4_000_000
#: Distinct words that a task counts before it passes them on.
WORDS = 300_000

_LOWER = {c: c + 32 for c in range(65, 91)}


# -- words -------------------------------------------------------------------------------


def count_words(docs: DataFrame, letters: str = r"A-Za-zÀ-ÿ", least: int = 6, slip: int = 0,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of the runs of ``letters`` with A-Z lower-cased, if they have ``least`` code points.

    ``slip`` (0: none): where it divides the CRC-32 of ``<id>:<run>``, the run loses its code point at that CRC modulo its length.
    """
    def run(batches):
        find = re.compile(f"[{letters}]{{{max(1, least)},}}").findall
        counts: Counter = Counter()
        for batch in batches:
            for part, texts in arrow.pieces(batch, "text"):
                for doc_id, text in zip(part.column(0).to_pylist(), texts):
                    runs = find(text.translate(_LOWER) if not text.isascii() else text.lower())
                    if not slip:
                        counts.update(runs)
                        continue
                    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                    for word, n in Counter(runs).items():
                        h = zlib.crc32(word.encode(), start)
                        if h % slip == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1:]
                            if len(word) < least:
                                continue
                        counts[word] += n
                if len(counts) > WORDS:
                    yield _counted(counts)
                    counts.clear()
        if counts:
            yield _counted(counts)

    narrow = docs.select(col(id_col).cast("string").alias("id"), col(text_col).alias("text"))
    return arrow.mapped(narrow, run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _counted(counts: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                                      ["word", "n"])


# -- the scan ----------------------------------------------------------------------------


class SortedList:
    """Words in order, with the length of the prefix that each shares with the one before it."""

    def __init__(self, words: list[str]):
        n = len(words)
        self.lengths = np.fromiter(map(len, words), np.int64, n)
        self.at = np.cumsum(self.lengths) - self.lengths
        self.letters = np.append(np.frombuffer("".join(words).encode("utf-32-le"), np.uint32), 0)
        self.shared = np.zeros(n + 1, np.int64)
        self.shared[n] = -1
        pair, depth = np.arange(1, n), 0
        while len(pair):
            pair = pair[np.minimum(self.lengths[pair - 1], self.lengths[pair]) > depth]
            pair = pair[self.letters[self.at[pair - 1] + depth] == self.letters[self.at[pair] + depth]]
            depth += 1
            self.shared[pair] = depth
        # the next word that shares less with the one before it
        self.after = np.full(n + 1, n, np.int64)
        open_: list[int] = []
        for i, d in enumerate(self.shared.tolist()):
            while open_ and self.shared[open_[-1]] > d:
                self.after[open_.pop()] = i
            open_.append(i)

    def scan(self, words: list[str], first: np.ndarray, end: np.ndarray, prefixes: bool = False):
        """(word, list word) one edit apart, as two arrays of places, among ``first <= list word < end``.

        ``prefixes``: the list holds prefixes; found are those that some word at most one edit away may begin with.
        """
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        order, found, s = np.argsort(lengths, kind="stable"), [], 0
        while s < len(words):
            longest = int(lengths[order[min(s + SLICE, len(words)) - 1]])
            some = order[s:s + max(1, min(SLICE, CELLS // (longest + 3)))]
            q, w = self._slice([words[i] for i in some], lengths[some], first[some], end[some], prefixes)
            found.append((some[q], w))
            s += len(some)
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 2

    def _slice(self, words, length, first, end, prefixes):
        pad = "\0"
        letters = np.frombuffer("".join(f"{pad}{w}{pad}{pad}" for w in words).encode("utf-32-le"), np.uint32)
        begin = np.cumsum(length + 3) - length - 3
        # cell c of row d holds the edits from the first d letters of the list word to the first d - 1 + c of the word
        rows = np.full((len(words), int(length.max()) + 3, 3), 2, np.uint8)
        rows[:, 0, 1] = 0
        rows[length > 0, 0, 2] = 1
        place, depth = first.copy(), np.zeros(len(words), np.int64)
        live, found = np.flatnonzero(place < end), []
        while len(live):
            ended = depth[live] == self.lengths[place[live]]
            done, more = live[ended], live[~ended]
            if len(done):
                cell = length[done] - depth[done] + 1
                hit = done if prefixes else done[(cell >= 0) & (cell <= 2)
                                                 & (rows[done, depth[done], np.clip(cell, 0, 2)] == 1)]
                if len(hit):
                    found.append((hit, place[hit]))
                place[done] += 1
                depth[done] = self.shared[place[done]]
            if len(more):
                d, at = depth[more], begin[more]
                letter = self.letters[self.at[place[more]] + d]
                old = rows[more, d]
                new = np.empty_like(old)
                new[:, 0] = np.minimum(old[:, 1] + 1, old[:, 0] + (letter != letters[at + d]))
                new[:, 1] = np.minimum(np.minimum(old[:, 2] + 1, old[:, 1] + (letter != letters[at + d + 1])), new[:, 0] + 1)
                new[:, 2] = np.minimum(old[:, 2] + (letter != letters[at + np.minimum(d + 2, length[more] + 2)]), new[:, 1] + 1)
                np.minimum(new, 2, out=new)
                for c in range(3):
                    new[d + c > length[more], c] = 2
                near = new.min(axis=1) <= 1
                on, off = more[near], more[~near]
                rows[on, d[near] + 1] = new[near]
                depth[on] += 1
                if len(off):  # skip the range that shares these letters
                    kept, to = d[~near], place[off] + 1
                    while True:
                        inside = self.shared[to] > kept
                        if not inside.any():
                            break
                        to[inside] = self.after[to[inside]]
                    place[off], depth[off] = to, self.shared[to]
            live = live[place[live] < end[live]]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        q, w = (np.concatenate(x) for x in zip(*found))
        return q, w


def _ranges(words: list[str], find) -> tuple[np.ndarray, np.ndarray]:
    """The range that ``find`` gives for the first half of each word."""
    known: dict[str, tuple[int, int]] = {}
    out = np.empty((2, len(words)), np.int64)
    for i, w in enumerate(words):
        half = w[:len(w) // 2]
        if half not in known:
            known[half] = find(half)
        out[:, i] = known[half]
    return out[0], out[1]


def _with_half(keys: list[str]):
    def find(half: str):
        def cut(key):
            return key[:len(half)]
        return bisect_left(keys, half, key=cut), bisect_right(keys, half, key=cut)
    return find


class Router:
    """Which blocks of one sorted list may hold words one edit away from a given word."""

    def __init__(self, blocks: list[tuple[int, str, str]]):
        blocks = sorted(blocks, key=lambda b: b[1:])
        self.ids = np.array([b for b, _, _ in blocks], np.int64)
        self.low, self.high = [b[1] for b in blocks], [b[2] for b in blocks]
        self.list = SortedList([self._common(a, b) for a, b in zip(self.low, self.high)])

    @staticmethod
    def _common(a: str, b: str) -> str:
        n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        return a[:n]

    def _find(self, half: str):
        half = half[:REACH]

        def cut(key):
            return key[:len(half)]
        return bisect_left(self.high, half, key=cut), bisect_right(self.low, half, key=cut)

    def route(self, words: list[str]):
        """(word, block) as an array of places and one of ids."""
        q, b = self.list.scan(words, *_ranges(words, self._find), prefixes=True)
        return q, self.ids[b]


# -- the join ----------------------------------------------------------------------------


def near_words(vocabulary: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) for each word of (word, n) that has words one edit away: how many, and the most frequent."""
    spark = vocabulary.sparkSession
    blocks_wanted = min(MOST_BLOCKS, max(1, -(-vocabulary.count() // BLOCK)))
    both = vocabulary.select(F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("word").alias("key"), "n"),
        F.struct(F.lit(1).alias("side"), F.reverse("word").alias("key"), "n")))).select("col.*")
    in_order = (both.repartitionByRange(2 * blocks_wanted, "side", "key").sortWithinPartitions("side", "key")
                .select(F.spark_partition_id().alias("part"), "side", "key", "n"))

    def build(batches):
        part = 0
        sides = {0: ([], []), 1: ([], [])}
        for batch in batches:
            for p, side, key, n in zip(*(c.to_pylist() for c in batch.columns)):
                part = p
                sides[side][0].append(key)
                sides[side][1].append(n)
        for side, (keys, ns) in sides.items():
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([2 * part + side]), pa.array([side], pa.int32()), pa.array([keys[0][:REACH]]),
                     pa.array([keys[-1][:REACH]]), pa.array([keys], pa.list_(pa.string())),
                     pa.array([ns], pa.list_(pa.int64()))], ["block", "side", "low", "high", "keys", "ns"])

    blocks = written(arrow.mapped(in_order, build, "block long, side int, low string, high string, "
                                  "keys array<string>, ns array<long>"), "spelling-blocks")
    ends = blocks.select("side", "block", "low", "high").collect()  # at most 2 * MOST_BLOCKS + 1 rows
    shared = spark.sparkContext.broadcast([[tuple(r)[1:] for r in ends if r.side == s] for s in (0, 1)])

    def route(batches):
        routers = [Router(b) for b in shared.value]
        for batch in batches:
            for side, keys in zip(batch.column(0).to_pylist(), batch.column(1)):
                keys = keys.as_py()
                q, block = routers[side].route(keys)
                order = np.argsort(block, kind="stable")
                q, block = q[order], block[order]
                to, start = np.unique(block, return_index=True)
                for b, some in zip(to.tolist(), np.split(q, start[1:])):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([b]), pa.array([[keys[i] for i in some]], pa.list_(pa.string()))], ["block", "queries"])

    sent = arrow.mapped(blocks.select("side", "keys"), route, "block long, queries array<string>")
    work = sent.repartition(2 * blocks_wanted, "block").join(blocks.select("block", "side", "keys", "ns"), "block")

    def compare(batches):
        at = None
        for batch in batches:
            for i in range(batch.num_rows):
                block, queries, side = (batch.column(c)[i].as_py() for c in range(3))
                if block != at:
                    at, keys = block, batch.column(3)[i].as_py()
                    ns = batch.column(4)[i].values.to_numpy()
                    listed = SortedList(keys)
                    words = [k[::-1] for k in keys] if side else keys
                    rank = np.empty(len(keys), np.int64)
                    rank[sorted(range(len(keys)), key=words.__getitem__)] = np.arange(len(keys))
                q, w = listed.scan(queries, *_ranges(queries, _with_half(keys)))
                if side:  # pairs that share the first half are found in the other list
                    asked = [k[::-1] for k in queries]
                    halves = [x[:len(x) // 2] for x in asked]
                    new = np.fromiter((not words[b].startswith(halves[a]) for a, b in zip(q.tolist(), w.tolist())), bool, len(q))
                    q, w = q[new], w[new]
                else:
                    asked = queries
                if len(q):
                    order = np.lexsort((rank[w], -ns[w], q))
                    q, w = q[order], w[order]
                    word, start, n = np.unique(q, return_index=True, return_counts=True)
                    best = w[start]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([asked[j] for j in word], pa.string()), pa.array(n), pa.array(ns[best]),
                         pa.array([words[j] for j in best], pa.string())], ["word", "n_near", "best_n", "best"])

    found = arrow.mapped(work.select("block", "queries", "side", "keys", "ns"), compare,
                         "word string, n_near long, best_n long, best string")
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"),
                                      F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("top"))
            .select("word", "n_near", (-F.col("top.less")).alias("best_n"), F.col("top.best").alias("best")))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for every word of (word, form): where following forms ends."""
    links = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        further = links.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                        F.col("further").isNotNull().alias("moved"))
        further = written(further, "spelling-roots")
        if further.filter("moved").isEmpty():
            return further.select("word", "root")
        links = further.select("word", "root")


def variants(vocabulary: DataFrame, ratio: int = 5) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each word of (word, n): the form is the most frequent word one edit away, if it
    has at least ``ratio`` times the occurrences."""
    words = written(vocabulary.filter("word is not null").groupBy("word").agg(F.sum("n").alias("n")), "spelling-words")
    near = words.join(near_words(words), "word", "left")
    formed = F.col("best_n") >= ratio * F.col("n")
    known = written(near.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                                F.when(formed, F.col("best")).alias("form"),
                                F.when(formed, F.col("best_n")).alias("form_n")), "spelling-forms")
    root = roots(known.filter("form is not null"))
    return known.join(root, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
