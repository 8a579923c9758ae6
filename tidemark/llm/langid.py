"""Language identification of mixed texts: scripts, word scores, Viterbi.

Fitting counts the letter n-grams of words (with word ends) per language in a bounded sample of labelled texts, and which
scripts each language is written in. Prediction goes word by word:

* the word's script (a table of code-point ranges) leaves the languages that use it as candidates;
* each candidate's score is the log posterior of the word's n-grams;
* Viterbi finds the best sequence of languages under a penalty for each switch, all texts of a piece side by side.

Runs of one language are the spans. The predicted language is the one whose spans hold the most letters; the score is the
share of all letters that its spans hold, each word weighted by its posterior.

Defined results: NULL and texts without a letter are ``und`` with score 0 and no spans. Words in a script that no
language uses say nothing and add nothing to the score; a text of such words alone gets the first learned language with
score 0. Input columns named like those that are added are replaced. Ties go to the language first in code-point order. Without labelled texts all is ``und``.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window, functions as F, types as T

from tidemark.llm import arrow
from tidemark.llm.common import col, written

#: Labelled texts that are counted, and most frequent n-grams that are kept, both per language.
SAMPLE, GRAMS = 4000, 20_000
#: Weight of an n-gram's log probability (they overlap); cost of a switch in nats.
TEMPER, SWITCH = 0.6, 8.0
#: A language uses a script that holds at least this share of its letters.
SCRIPT_SHARE = 0.01
#: Words a worker remembers before it starts anew; bytes of text that are worked on at once.
MEMORY = 400_000
PIECE_BYTES = 3 << 20

# First code points of blocks of letters, and the script of each.
SCRIPTS = [
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
    (0x0600, "Arabic"), (0x0700, "Other"), (0x0750, "Arabic"), (0x0780, "Other"), (0x0900, "Devanagari"),
    (0x0980, "Bengali"), (0x0A00, "Other"), (0x0B80, "Tamil"), (0x0C00, "Other"), (0x0E00, "Thai"), (0x0E80, "Other"),
    (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x13A0, "Other"), (0x1D00, "Latin"),
    (0x1F00, "Greek"), (0x2000, "Latin"), (0x2C80, "Other"), (0x3040, "Kana"), (0x3100, "Han"), (0x3130, "Hangul"),
    (0x3190, "Han"), (0xA000, "Other"), (0xA640, "Cyrillic"), (0xA6A0, "Other"), (0xA720, "Latin"), (0xA800, "Other"),
    (0xAC00, "Hangul"), (0xD7FB, "Other"), (0xF900, "Han"), (0xFB00, "Latin"), (0xFB13, "Armenian"),
    (0xFB1D, "Hebrew"), (0xFB50, "Arabic"), (0xFE00, "Other"), (0xFE70, "Arabic"), (0xFF00, "Latin"), (0xFF66, "Kana"),
    (0xFFA0, "Hangul"), (0xFFE0, "Other"), (0x20000, "Han"), (0x3FFFF, "Other"),
]
NAMES = sorted({name for _, name in SCRIPTS})
_STARTS = np.array([s for s, _ in SCRIPTS])
_SCRIPT = np.array([NAMES.index(name) for _, name in SCRIPTS])

WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")


def scripts_of(words: list[str]) -> np.ndarray:
    """The script of each word's first letter."""
    first = np.fromiter([ord(w[0]) for w in words], np.int64, len(words))
    return _SCRIPT[np.searchsorted(_STARTS, first, "right") - 1]


def grams(word: str) -> list[str]:
    """Letters, pairs and triples; pairs and triples also with the ends of the word."""
    w = f" {word} "
    n = len(w)
    return [*word, *[w[i:i + 2] for i in range(n - 1)], *[w[i:i + 3] for i in range(n - 2)]]


@dataclass
class Model:
    langs: list[str]
    ids: dict[str, int]  # of the kept n-grams
    logp: np.ndarray  # (n-grams, languages)
    uses: np.ndarray  # (scripts, languages), bool

    def words(self, words: list[str]) -> np.ndarray:
        """The log posterior per language of each word, at least minus the cost of a switch."""
        known = self.ids.get
        lists = [[i for i in map(known, grams(w)) if i is not None] for w in words]
        flat = np.fromiter(chain.from_iterable(lists), np.int64)
        of = np.repeat(np.arange(len(words)), np.fromiter(map(len, lists), np.int64, len(lists)))
        sums = np.stack([np.bincount(of, self.logp[flat, k], len(words)) for k in range(len(self.langs))], axis=1) * TEMPER
        allowed = self.uses[scripts_of(words)]
        silent = ~allowed.any(axis=1)
        sums[silent] = 0
        sums[~allowed & ~silent[:, None]] = -1e9
        sums -= sums.max(axis=1, keepdims=True)
        sums -= np.log(np.exp(sums).sum(axis=1, keepdims=True))
        # no word says more against a language than a switch costs: one odd word never makes a span
        return np.maximum(sums, -SWITCH).astype(np.float32)


class Lexicon(dict):
    """Numbers of the words that a worker has met, and their scores and lengths; a missing word gets the next number."""

    def __init__(self, model: Model, most: int = MEMORY):
        super().__init__()
        self.model, self.most, self.new = model, most, []
        self.read = np.zeros(0, bool)
        self.scores = np.zeros((0, len(model.langs)), np.float32)
        self.letters = np.zeros(0, np.float32)

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self.new.append(word)
        return number

    def numbers(self, split: list[list[str]], n: int) -> np.ndarray:
        if len(self) > self.most:
            self.clear()
            self.scores, self.letters = self.scores[:0], self.letters[:0]
            self.read = self.read[:0]
        at = np.fromiter(map(self.__getitem__, chain.from_iterable(split)), np.int64, n)
        if self.new:
            self.scores = np.concatenate([self.scores, self.model.words(self.new)])
            self.letters = np.concatenate([self.letters, np.fromiter(map(len, self.new), np.float32)])
            self.read = np.concatenate([self.read, self.model.uses[scripts_of(self.new)].any(axis=1)])
            self.new = []
        return at


def viterbi(scores: np.ndarray, lengths: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best label of each word; texts lie one after another, ``lengths`` says how many words each has.

    All texts advance together, the longest first, so that those still running are a prefix.
    """
    order = np.argsort(-lengths, kind="stable")
    sorted_lengths = lengths[order]
    starts = (np.cumsum(lengths) - lengths)[order]
    steps = int(sorted_lengths[0]) if len(lengths) else 0
    running = np.searchsorted(-sorted_lengths, -np.arange(steps), "left")  # texts with a word at each step
    labels = np.zeros(len(scores), np.int32)
    if not steps:
        return labels
    n_langs = scores.shape[1]
    own = np.arange(n_langs, dtype=np.int32)
    came = np.empty((len(scores), n_langs), np.int32)  # best previous label, by word
    value = scores[starts[:running[0]]].copy()
    final = np.zeros(len(lengths), np.int32)
    for t in range(1, steps):
        a, before = running[t], running[t - 1]
        if a < before:
            final[a:before] = value[a:before].argmax(axis=1)
            value = value[:a]
        at = starts[:a] + t
        best = value.argmax(axis=1).astype(np.int32)
        value -= value[np.arange(a), best][:, None]
        stay = value >= -switch
        came[at] = np.where(stay, own, best[:, None])
        np.maximum(value, -switch, out=value)
        value += scores[at]
    final[:running[-1]] = value.argmax(axis=1)
    label = final
    for t in range(steps - 1, -1, -1):
        a = running[t]
        at = starts[:a] + t
        labels[at] = label[:a]
        if t:
            label[:a] = came[at, label[:a]]
    return labels


# -- fitting -----------------------------------------------------------------------------


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE,
        most_grams: int = GRAMS, id_col: str = "doc_id") -> Model:
    """Count n-grams and scripts in about ``sample`` texts per language, chosen by a hash of id (if there is one) and text: copies of
    a text under many ids are chosen one by one.

    The driver gets at most ``most_grams`` n-grams and one row per script for each language.
    """
    named = col(id_col).cast("string") if id_col in labelled.columns else F.lit(None).cast("string")
    rows = labelled.select(col(lang_col).alias("lang"), col(text_col).alias("text"), named.alias("id")).filter(
        "lang is not null and text is not null")
    sizes = written(rows.groupBy("lang").agg(F.count("*").alias("n")), "langid-sizes")
    part = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30))
    chosen = rows.join(sizes, "lang").filter(part * F.col("n") < F.lit(sample * (1 << 30))).select("lang", "text")

    def count(batches):
        from collections import Counter
        words: dict[str, Counter] = {}
        for batch in batches:
            for part, texts in arrow.pieces(batch, "text"):
                for lang, text in zip(part.column(0).to_pylist(), texts):
                    words.setdefault(lang, Counter()).update(WORD.findall(text.lower()))
        for lang, counter in words.items():
            found: Counter = Counter()
            scripts = np.bincount(scripts_of(list(counter)), [n * len(w) for w, n in counter.items()], len(NAMES))
            for word, n in counter.items():
                for g in grams(word):
                    found[g] += n
            for kind, items in (("gram", list(found.items())), ("script", list(zip(NAMES, scripts.astype(int).tolist())))):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(items), pa.string()), pa.array([kind] * len(items), pa.string()),
                     pa.array([k for k, _ in items], pa.string()), pa.array([n for _, n in items], pa.int64())],
                    ["lang", "kind", "item", "n"])

    counted = written(arrow.mapped(chosen, count, "lang string, kind string, item string, n long")
                      .groupBy("kind", "item", "lang").agg(F.sum("n").alias("n")), "langid-counts")
    often = F.row_number().over(Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "item"))
    top = counted.withColumn("place", often).filter(F.col("place") <= most_grams).select("kind", "item").distinct()
    kept = (counted.join(top, ["kind", "item"]).groupBy("kind", "item").agg(F.collect_list(F.struct("lang", "n")).alias("ns"))
            .orderBy(F.desc("kind"), "item").collect())
    langs = sorted({x.lang for r in kept if r.kind == "script" for x in r.ns})
    place = {lang: i for i, lang in enumerate(langs)}
    uses = np.zeros((len(NAMES), len(langs)))
    items = [r for r in kept if r.kind == "gram"]
    counts = np.zeros((len(items), len(langs)))
    for r in kept:
        if r.kind == "script":
            for x in r.ns:
                uses[NAMES.index(r.item), place[x.lang]] = x.n
    for i, r in enumerate(items):
        for x in r.ns:
            counts[i, place[x.lang]] = x.n
    uses = uses >= SCRIPT_SHARE * np.maximum(1, uses.sum(axis=0))
    logp = np.log((counts + 0.5) / (counts.sum(axis=0) + 0.5 * max(1, len(items))))
    return Model(langs, {r.item: i for i, r in enumerate(items)}, logp, uses)


# -- prediction --------------------------------------------------------------------------

SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
                                  T.StructField("lang", T.StringType())]))


def _spans(text: str, labels: np.ndarray, langs: list[str]) -> list[dict]:
    """Runs of one language as places in the text; together they cover it."""
    cuts = np.flatnonzero(labels[1:] != labels[:-1]) + 1
    if not len(cuts):
        return [{"start": 0, "end": len(text), "lang": langs[labels[0]]}]
    starts = [m.start() for m in WORD.finditer(text)]
    ends = [starts[min(c, len(starts) - 1)] for c in cuts]
    return [{"start": s, "end": e, "lang": langs[labels[c]]}
            for s, e, c in zip([0, *ends], [*ends, len(text)], [0, *cuts])]


def predict_texts(lexicon: Lexicon, texts: list[str]) -> tuple[list[str], list[float], list[list[dict]]]:
    model = lexicon.model
    split = [WORD.findall(t.lower()) for t in texts]
    lengths = np.array([len(ws) for ws in split], np.int64)
    n = int(lengths.sum())
    if not n or not model.langs:
        return ["und"] * len(texts), [0.0] * len(texts), [[] for _ in texts]
    at = lexicon.numbers(split, n)
    word_scores = lexicon.scores[at]
    labels = viterbi(word_scores, lengths)
    weight = lexicon.letters[at]
    n_langs = len(model.langs)
    held_by = np.repeat(np.arange(len(texts)) * n_langs, lengths) + labels
    held = np.bincount(held_by, weight, len(texts) * n_langs).reshape(-1, n_langs)
    counts = weight * lexicon.read[at]
    sure = np.bincount(held_by, counts * np.exp(np.take_along_axis(word_scores, labels[:, None], axis=1)[:, 0]),
                       len(texts) * n_langs).reshape(-1, n_langs)
    best = held.argmax(axis=1)
    total = np.maximum(1, held.sum(axis=1))
    score = np.minimum(1.0, sure[np.arange(len(texts)), best] / total)
    ends = np.cumsum(lengths)
    langs, scores, spans = [], [], []
    for i, text in enumerate(texts):
        if lengths[i]:
            langs.append(model.langs[best[i]])
            scores.append(float(score[i]))
            spans.append(_spans(text, labels[ends[i] - lengths[i]:ends[i]], model.langs))
        else:
            langs.append("und")
            scores.append(0.0)
            spans.append([])
    return langs, scores, spans


def predict(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None,
            remember: int = MEMORY) -> DataFrame:
    """The kept columns (all by default), with lang_pred, score and lang_spans; ``remember`` bounds a worker's words."""
    own = ("lang_pred", "score", "lang_spans")
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in own]
    extra = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
             T.StructField("lang_spans", SPANS)]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    span_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))

    def run(batches):
        fitted = shared.value
        lexicon = arrow.kept(("langid", id(fitted)), lambda: Lexicon(fitted, remember))
        for batch in batches:
            for part, texts in arrow.pieces(batch, text_col, PIECE_BYTES):
                langs, scores, spans = predict_texts(lexicon, texts)
                kept = [part.column(part.schema.get_field_index(c)) for c in keep]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(spans, span_type)],
                    [*keep, *(f.name for f in extra)])

    rows = docs.select(*[col(c) for c in dict.fromkeys([*keep, text_col])])
    return arrow.mapped(rows, run, T.StructType([*[docs.schema[c] for c in keep], *extra]))


def is_held_out(id_col: str = "doc_id"):
    """One fifth of the ids, by CRC-32 of the id as text (NULL: as empty text)."""
    return F.crc32(F.coalesce(col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0
