"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np

from tests.llm.models import AWKWARD, DOCS
from tidemark.llm import spelling


def near(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(counts: dict[str, int], ratio: int = 5) -> set:
    best, number = {}, {}
    for w in counts:
        found = sorted((-counts[x], x) for x in counts if near(w, x))
        number[w] = len(found)
        best[w] = found[0][1] if found and -found[0][0] >= ratio * counts[w] else None

    def root(w):
        return root(best[w]) if best[w] else w

    return {(w, best[w], root(w), n, number[w], counts.get(best[w])) for w, n in counts.items()}


def words(rnd, n, alphabet, low, high):
    return {"".join(rnd.choice(alphabet) for _ in range(rnd.randint(low, high))) for _ in range(n)}


def test_scan_finds_all_words_one_edit_apart():
    rnd = random.Random(0)
    for alphabet, low, high in (("ab", 0, 6), ("abc", 3, 8), ("aéß中", 1, 5)):
        listed = sorted(words(rnd, 300, alphabet, low, high))
        n = len(listed)
        q, w = spelling.SortedList(listed).scan(listed, np.zeros(n, int), np.full(n, n))
        assert len(set(zip(q.tolist(), w.tolist()))) == len(q)
        assert set(zip(q.tolist(), w.tolist())) == {(i, j) for i in range(n) for j in range(n) if near(listed[i], listed[j])}


def test_routing_reaches_every_block_with_a_near_word():
    rnd = random.Random(1)
    listed = sorted(words(rnd, 600, "abcd", 4, 8) | words(rnd, 100, "ab", 6, 9))
    cuts = [listed[i:i + 9] for i in range(0, len(listed), 9)]
    router = spelling.Router([(i, c[0], c[-1]) for i, c in enumerate(cuts)])
    q, b = router.route(listed)
    sent = set(zip(q.tolist(), b.tolist()))
    for i, w in enumerate(listed):
        for k, c in enumerate(cuts):
            if any(near(w, x) and x.startswith(w[:len(w) // 2]) for x in c):
                assert (i, k) in sent
    assert len(sent) < len(listed) * len(cuts) / 4


def test_variants_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(spelling, "BLOCK", 64)
    rnd = random.Random(2)
    listed = words(rnd, 500, "abc", 3, 7) | words(rnd, 150, "aé", 6, 8) | {"", "a", "prefix" * 40, "prefix" * 40 + "s", "hot" + "a" * 9}
    counts = {w: rnd.choice([1, 2, 5, 6, 30, 150, 1000]) for w in listed}
    rows = [(w, n) for w, n in counts.items()] + [(None, 7)]
    got = spelling.variants(spark.createDataFrame(rows, "word string, n long").repartition(5)).collect()
    assert len(got) == len(counts) and {tuple(r) for r in got} == plain(counts)
    assert sum(r.root not in (r.word, r.form) for r in got) > 5  # chains of forms
    twice = spelling.variants(spark.createDataFrame([("word", 1), ("word", 2), ("words", 15)], "word string, n long"))
    assert {tuple(r) for r in twice.collect()} == {("word", "words", "words", 3, 1, 15), ("words", None, "words", 15, 1, None)}


def test_counts_and_edges(spark):
    odd = [*AWKWARD, (11, "ÀÉcole ÀÉcole naïve×façades ABCdefg abcdefg\x00abcdefg", None, None, 0), (-5, "straße" * 300 + " shorts", "x", "y", 1)]
    for slip in (0, 3):
        want = Counter()
        for doc_id, text, *_ in odd:
            for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
                run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                if slip and h % slip == 0:
                    run = run[:h % len(run)] + run[h % len(run) + 1:]
                if len(run) >= 6:
                    want[run] += 1
        for extra in ("", ", word string, n string, id string"):
            df = spark.createDataFrame([(*r, *["keep"] * extra.count(",")) for r in odd], DOCS + extra)
            got = spelling.count_words(df.repartition(3), slip=slip)
            assert {r.word: r.n for r in got.collect()} == want
        assert {tuple(r) for r in spelling.variants(got).collect()} == plain(want)
    empty = spark.createDataFrame([], DOCS)
    assert spelling.variants(spelling.count_words(empty)).count() == 0
