"""Exact token counts of every prefix by dynamic programming.

BPE has this property: the encoding of a sequence of symbols is the only split into tokens whose neighbours are
compatible, that is, each pair of neighbours encodes to itself. So the last token of every prefix can be found from
those of shorter prefixes: it is the token that ends there and is compatible with the last token of what precedes it. The
count of a prefix is one more than the count before that token. One pass gives the counts of all prefixes; a question
for another length or budget is a lookup.

Words do not interact, so the table is kept per distinct word (in a bounded memory of the worker), and the count at a
place in a text is the sum over the words before it plus the entry of the word it cuts.

Places are characters of the normalised text (composed, lower case), which is what the vocabulary counts.

Defined results: a NULL or empty text has no tokens. Special strings inside a text count one token each. Input
columns named like those that are added are replaced.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate, islice

import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from tidemark.llm import arrow
from tidemark.llm.common import without
from tidemark.llm.vocabulary import Memory, Vocabulary, load

#: Words of a generation of a worker's memory, and pairs of tokens before it starts anew.
MEMORY = 600_000
PAIRS = 2_000_000


class PrefixCounter:
    def __init__(self, vocabulary: Vocabulary):
        self.v = v = vocabulary
        n = len(v.suffix)
        inner = {t: i for t, i in v.ids.items() if not t.endswith(v.suffix)}
        final = {t[:-n]: i for t, i in v.ids.items() if t.endswith(v.suffix)}
        # letters -> (token inside a word, token at a word's end), None where there is none
        self.tokens = {t: (inner.get(t), final.get(t)) for t in {*inner, *final}}
        self.longest = max(map(len, self.tokens))
        self.rank = {(a << 32) | b: r for r, (a, b, _) in enumerate(v.merges)}
        self.byte = {c: b for b, c in enumerate(v.letter)}
        self.pairs: dict[int, bool] = {}
        self.words = Memory(MEMORY, self.tables)

    def _symbols(self, token: int) -> list[int]:
        text = self.v.tokens[token]
        if token in self.v.special.values():
            return [token]
        ends = text.endswith(self.v.suffix)
        raw = [self.byte[c] for c in (text[:-len(self.v.suffix)] if ends else text)]
        ids = [self.v.plain[b] for b in raw]
        if ends:
            ids[-1] = self.v.end[raw[-1]]
        return ids

    def _merged(self, symbols: list[int]) -> list[int]:
        """A few symbols after all merges, lowest rank first."""
        rank = self.rank
        while True:
            best = at = None
            for i in range(len(symbols) - 1):
                r = rank.get((symbols[i] << 32) | symbols[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                return symbols
            symbols = [*symbols[:at], self.v.merges[best][2], *symbols[at + 2:]]

    def _compatible(self, key: int) -> bool:
        """Does a pair of tokens (left << 32 | right; left -1: none) encode to itself?"""
        if len(self.pairs) > PAIRS:
            self.pairs.clear()
        left, right = key >> 32, key & 0xFFFFFFFF
        if left < 0:
            fits = self._merged(self._symbols(right)) == [right]
        else:
            fits = self._merged(self._symbols(left) + self._symbols(right)) == [left, right]
        self.pairs[key] = fits
        return fits

    def tables(self, words: list[str]) -> Iterator[tuple[int, ...] | bytes]:
        """For each word, the token count of each of its prefixes, from one character to all."""
        return map(self._table, words)

    def _table(self, word: str) -> tuple[int, ...] | bytes:
        raw = word.encode()
        letters, n = "".join([self.v.letter[b] for b in raw]), len(raw)
        tokens, pair, longest = self.tokens.get, self.pairs.get, self.longest
        last, count, ends = [-1], [0], [0]  # of each prefix as the start of a longer word; counts as a whole word
        for i in range(1, n + 1):
            grow, end = i < n, True
            for j in range(i - longest if i > longest else 0, i):
                if (found := tokens(letters[j:i])) is None:
                    continue
                if grow and (token := found[0]) is not None:
                    if (fits := pair(key := (last[j] << 32) | token)) is None:
                        fits = self._compatible(key)
                    if fits:
                        now, grow = (token, count[j] + 1), False
                        if not end:
                            break
                if end and (token := found[1]) is not None:
                    if (fits := pair(key := (last[j] << 32) | token)) is None:
                        fits = self._compatible(key)
                    if fits:
                        ends.append(count[j] + 1)
                        end = False
                        if not grow:
                            break
            if grow or end:
                raise ValueError(f"no token ends at {i} of {word[:50]!r}")
            if i < n:
                last.append(now[0])
                count.append(now[1])
        if n > len(word):  # only whole characters end a prefix
            ends = [ends[i] for i in accumulate((len(c.encode()) for c in word), initial=0)]
        return bytes(ends[1:]) if n < 256 else tuple(ends[1:])

    def measure(self, texts: list[str], budget: int) -> tuple[list[int], list[int | None]]:
        """(tokens of each text, length of its longest prefix within the budget or None if all of it fits)."""
        split = [list(self.v.pieces(t)) for t in texts]
        known = self.words.know({w for pieces in split for _, ws in pieces for w in ws})
        totals, fits = [], []
        for text, pieces in zip(texts, split):
            n, fit = 0, None
            for i, (special, words) in enumerate(pieces):
                counts = [1] if special is not None else [known[w][-1] for w in words]
                size = sum(counts)
                if fit is None and n + size > budget:
                    fit = self._cut(text, pieces, i, bisect_right(list(accumulate(counts)), budget - n), budget, known)
                n += size
            totals.append(n)
            fits.append(fit)
        return totals, fits

    def _cut(self, text: str, pieces, piece: int, word: int, budget: int, known) -> int:
        """Where the budget ends: in or before a word of a piece; its count is looked up in the word's table."""
        parts = [p for i, p in enumerate(self.v.specials.split(text)) if p or i % 2]
        at = sum(len(p if special is not None else self.v.normal(p)) for p, (special, _) in zip(parts, pieces[:piece]))
        special, words = pieces[piece]
        if special is not None:
            return at + len(parts[piece]) - 1
        before = sum(1 if s is not None else sum(known[w][-1] for w in ws) for s, ws in pieces[:piece]) + sum(known[w][-1] for w in words[:word])
        start = next(islice(self.v.pattern.finditer(self.v.normal(parts[piece])), word, None)).start()
        table = known[words[word]]
        inside = next((i + 1 for i in range(len(table) - 1, -1, -1) if before + table[i] <= budget), 0)
        return at + start + inside

    def prefixes(self, text: str):
        """(where each word starts, tokens before it, its table, length of the normalised text)."""
        known = self.words.know({w for _, ws in self.v.pieces(text) for w in ws})
        starts, counts, tables, at, n = [], [], [], 0, 0
        for i, part in enumerate(self.v.specials.split(text)):
            if i % 2:  # a special string counts when it is complete
                starts.append(at)
                counts.append(n)
                tables.append((0,) * (len(part) - 1) + (1,))
                at, n = at + len(part), n + 1
                continue
            part = self.v.normal(part)
            for m in self.v.pattern.finditer(part):
                starts.append(at + m.start())
                counts.append(n)
                tables.append(known[m.group()])
                n += tables[-1][-1]
            at += len(part)
        return starts, counts, tables, at

    def count_at(self, stored, length: int) -> int:
        """Tokens of the first ``length`` characters, from what ``prefixes`` has stored."""
        starts, counts, tables, _ = stored
        k = bisect_right(starts, length - 1) - 1
        if k < 0:
            return 0
        inside = min(length - starts[k], len(tables[k]))
        return counts[k] + (tables[k][inside - 1] if inside else 0)

    def longest_within(self, stored, budget: int) -> int:
        """The length of the longest prefix of at most ``budget`` tokens."""
        starts, counts, tables, size = stored
        for k in range(bisect_right(counts, budget) - 1, -1, -1):
            t = tables[k]
            if counts[k] + t[-1] <= budget:  # the word fits, and the space after it
                return starts[k + 1] if k + 1 < len(starts) else size
            for i in range(len(t) - 1, -1, -1):
                if counts[k] + t[i] <= budget:
                    return starts[k] + i + 1
            if counts[k] <= budget:
                return starts[k]
        return 0 if starts else size


def _counter(path: str) -> PrefixCounter:
    return arrow.kept(("counts", path), lambda: PrefixCounter(load(path)))


def token_counts(docs: DataFrame, path: str, budget: int = 2048, text_col: str = "text",
                 keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns, with n_bytes, n_tokens, over_limit and fit_chars.

    ``fit_chars`` is the length of the longest prefix (of the normalised text) within the budget, read from the
    stored counts; NULL if the whole text fits.
    """
    fields = [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()),
              T.StructField("over_limit", T.BooleanType()), T.StructField("fit_chars", T.LongType())]
    keep = tuple(c for c in keep if c.lower() not in {f.name for f in fields})
    keep_fields = [docs.schema[c] for c in keep]

    def run(batches):
        counter = _counter(path)
        for batch in batches:
            for part, texts in arrow.pieces(batch, text_col):
                totals, fits = counter.measure(texts, budget)
                kept = [part.column(part.schema.get_field_index(c)) for c in keep]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(totals, pa.int64()),
                     pa.array([n > budget for n in totals], pa.bool_()), pa.array(fits, pa.int64())],
                    [*keep, *(f.name for f in fields)])

    return arrow.mapped(docs.select(*dict.fromkeys([*keep, text_col])), run, T.StructType([*keep_fields, *fields]))


def prefix_counts(docs: DataFrame, path: str, text_col: str = "text", out_col: str = "prefix_tokens") -> DataFrame:
    """All rows and columns, with the token count of every prefix of the normalised text (1, 2, ... characters)."""
    docs = without(docs, out_col)

    def run(batches):
        counter = _counter(path)
        for batch in batches:
            for part, texts in arrow.pieces(batch, text_col):
                lists = []
                for t in texts:
                    stored = counter.prefixes(t)
                    lists.append([counter.count_at(stored, i) for i in range(1, stored[3] + 1)])
                yield pa.RecordBatch.from_arrays([*part.columns, arrow.ints(lists)], [*part.schema.names, out_col])

    return arrow.mapped(docs, run, T.StructType([*docs.schema.fields,
                                              T.StructField(out_col, T.ArrayType(T.IntegerType()))]))
