"""BPE encoding and decoding by an index of pair occurrences.

A task takes its texts in pieces of bounded size. The words of a piece that its worker has not met before are laid
side by side as lists of symbols, and an index maps every pair that has a rank to all positions where it occurs.
The active ranks are applied in ascending order: each merges all live occurrences of its pair in all words at once,
and the neighbours of a merged symbol enter the index under their new pairs. Words met before come from a
bounded memory of the worker.

Decoding turns ids into the vocabulary's strings joined by one space, which is what the library does for a file
without a decoder.

Defined results: a NULL or empty text has no ids and decodes to the empty text. Strings of special tokens
inside a text become their ids, as the library does by default. Input columns named like those that are added are
replaced.
"""

from __future__ import annotations

from heapq import heapify, heappop, heappush
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from tidemark.llm import arrow
from tidemark.llm.common import without
from tidemark.llm.vocabulary import Memory, Vocabulary, load

#: Words of a generation of a worker's memory.
MEMORY = 450_000


class PairIndex:
    def __init__(self, vocabulary: Vocabulary, remember: int = MEMORY):
        self.v = vocabulary
        self.rank = {(a << 32) | b: r for r, (a, b, _) in enumerate(vocabulary.merges)}
        self.words = Memory(remember, self.encode)

    def encode(self, words: list[str]) -> list[tuple[int, ...]]:
        """The ids of each word."""
        v, get = self.v, self.rank.get
        sym: list[int] = []
        starts = [0]
        for w in words:
            raw = w.encode()
            sym.extend([v.plain[b] for b in raw])
            sym[-1] = v.end[raw[-1]]
            starts.append(len(sym))
        after, before = list(range(1, len(sym) + 1)), list(range(-1, len(sym) - 1))
        for s in starts[1:]:
            after[s - 1] = -1
        for s in starts[:-1]:
            before[s] = -1
        at: dict[int, list[int]] = {}
        for p, q in enumerate(after):
            if q > 0 and (r := get((sym[p] << 32) | sym[q])) is not None:
                at.setdefault(r, []).append(p)
        active = list(at)
        heapify(active)

        def enter(r, p):
            if r in at:
                at[r].append(p)
            else:
                at[r] = [p]
                heappush(active, r)

        while active:
            r = heappop(active)
            places = at.pop(r, None)
            if places is None:
                continue
            places.sort()
            a, b, new = v.merges[r]
            for i, p in enumerate(places):
                q = after[p]
                if sym[p] != a or q < 0 or sym[q] != b:
                    continue  # one of the two has been merged since
                sym[p], sym[q] = new, -1
                after[p] = n = after[q]
                lower = False
                if n >= 0:
                    before[n] = p
                    if (x := get((new << 32) | sym[n])) is not None:
                        enter(x, p)
                        lower = x < r
                if (m := before[p]) >= 0 and (x := get((sym[m] << 32) | new)) is not None:
                    enter(x, m)
                    lower = lower or x < r
                if lower:  # a pair of lower rank has come up: it goes first
                    if places[i + 1:]:
                        at[r] = places[i + 1:]
                        heappush(active, r)
                    break
        return [tuple([x for x in sym[s:e] if x >= 0]) for s, e in zip(starts, starts[1:])]

    def encode_texts(self, texts: list[str]) -> list[list[int]]:
        split = [list(self.v.pieces(t)) for t in texts]
        known = self.words.know({w for pieces in split for _, ws in pieces for w in ws}).__getitem__
        out = []
        for pieces in split:
            ids: list[int] = []
            for special, ws in pieces:
                if special is not None:
                    ids.append(special)
                ids.extend(chain.from_iterable(map(known, ws)))
            out.append(ids)
        return out


def encode(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "token_ids",
           decoded_col: str | None = None, remember: int = MEMORY) -> DataFrame:
    """All rows and columns, with the ids of the text and, if a name is given, what they decode to.

    ``remember`` bounds the words of a generation of a worker's memory: fewer take less memory and more time.
    """
    extra = [T.StructField(ids_col, T.ArrayType(T.IntegerType()))]
    extra += [T.StructField(decoded_col, T.StringType())] if decoded_col else []
    docs = without(docs, *(f.name for f in extra))

    def run(batches):
        encoder = arrow.kept(("bpe", path), lambda: PairIndex(load(path), remember))
        token = encoder.v.tokens.__getitem__
        for batch in batches:
            for part, texts in arrow.pieces(batch, text_col):
                ids = encoder.encode_texts(texts)
                more = [arrow.ints(ids)]
                if decoded_col:
                    more.append(pa.array([" ".join(map(token, x)) for x in ids], pa.string()))
                yield pa.RecordBatch.from_arrays([*part.columns, *more], [*part.schema.names, *(f.name for f in extra)])

    return arrow.mapped(docs, run, T.StructType([*docs.schema.fields, *extra]))


def decode(encoded: DataFrame, path: str, ids_col: str = "token_ids", decoded_col: str = "decoded") -> DataFrame:
    """All rows and columns, with the text that the ids stand for (NULL for NULL ids)."""
    encoded = without(encoded, decoded_col)

    def run(batches):
        token = load(path).tokens.__getitem__
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index(ids_col)).to_pylist()
            texts = pa.array([None if x is None else " ".join(map(token, x)) for x in ids], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], [*batch.schema.names, decoded_col])

    return arrow.mapped(encoded, run, T.StructType([*encoded.schema.fields,
                                                       T.StructField(decoded_col, T.StringType())]))
