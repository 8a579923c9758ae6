"""Slow, plain versions of the operators, and tables of awkward rows."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import numpy as np
import regex
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: NULL in every column, empty and long texts, repeated ids and rows, ties, odd characters.
AWKWARD = [
    (1, "one two three four", "en", "a", 18), (2, "one two three four", "en", "a", 18), (2, "one two three four", "en", "a", 18),
    (3, None, None, None, None), (4, "", "en", "b", 0), (None, "one two three four", "en", "b", 18), (None, None, None, None, None),
    (5, " \t\n ", "fr", "b", 4), (6, "Ünïcode Σσς İI ﬁ é 中文 русский 123 !!! <|endoftext|> </s>[INST]", "de", None, 9),
    (7, "the of and " * 20_000, "en", "a", 220_000), (8, "x" * 50_000, None, "c", 50_000), (9, "12345 $$$ ...", None, "c", 13),
    (10, "Released under the MIT License.\nla de et les des un une", "fr", "c", 60), (2, "another text under the same id", "en", "a", 30),
    (11, "# c\n" * 5_000, "en", "c", 20_000), (12, "-".join("a" * 50_000), "en", "b", 99_999),
    (3, "quite another text under an id that is used twice", "en", "a", 49), *[(20 + i, "one two three four", "en", "a", 18) for i in range(5)],
]


def fingerprint(text: str | None, size: int = 3, seed: int = 42) -> int:
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    w = WORD.findall(text)
    shingles = [" ".join(w[i:i + size]) for i in range(len(w) - size + 1)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), seed) for s in shingles]
    if len(h) > 1000:  # the same sum by columns
        ones = np.unpackbits(np.array(h, np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0)
        return sum(1 << b for b in range(64) if 2 * int(ones[b]) > len(h))
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def linked(prints: list[tuple[int | None, int]], most: int = 2) -> dict[int, int | None]:
    """fingerprint -> smallest id of its component."""
    fps = sorted({fp for _, fp in prints})
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, a in enumerate(fps):
        for j in range(i):
            if (a ^ fps[j]).bit_count() <= most:
                root[find(i)] = find(j)
    least: dict[int, int] = {}
    place = {fp: i for i, fp in enumerate(fps)}
    for i, fp in prints:
        if i is not None:
            r = find(place[fp])
            least[r] = min(i, least.get(r, i))
    return {fp: least.get(find(place[fp])) for fp in fps}


def components_of(fps: list[int], most: int = 2) -> dict[int, int]:
    """fingerprint -> a number of its component."""
    return linked([(i, fp) for i, fp in enumerate(fps)], most)


def mix_targets(sizes: dict, weights=(5, 2, 1), most=3) -> dict:
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, free, out = sum(sizes.values()), set(order), {}
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > most * sizes[s]]
        if not over:
            break
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
            free.remove(s)
    return out | {s: left * weight[s] / sum(weight[x] for x in free) for s in free}


def conversations(rows) -> dict:
    """conv -> (turns, digest of the turns, loss characters, digest of the loss)."""
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort()
        said = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss),
                     hashlib.sha256(loss.encode()).hexdigest())
    return out


TOKEN = regex.compile(r"[\p{L}\p{M}]+|\p{N}|[^\s\p{L}\p{M}\p{N}]")


def windows(turns: list[tuple[str, str]], budget: int, history: int, segment: int) -> list[list[tuple[bool, str, str]]]:
    """The windows of one conversation, as (new, role, text) of each turn: a plain walk along its turns."""
    size = [len(TOKEN.findall(t)) + 4 for _, t in turns]
    system = turns[0] if turns[0][0] == "system" else None
    room = max(budget - history - (size[0] if system else 0), max(history, 16))
    if system:
        size[0] = 0
    begin = [sum(size[:i]) for i in range(len(turns))]
    firsts: list[int] = []
    for i in range(len(turns)):
        new_segment = not firsts or begin[i] // (room * segment) != begin[firsts[-1]] // (room * segment)
        if new_segment or begin[i] + size[i] - begin[firsts[-1]] > room:
            firsts.append(i)
    out = []
    for first, after in zip(firsts, [*firsts[1:], len(turns)]):
        old = [i for i in range(first) if begin[i] >= begin[first] - history and not (system and i == 0)]
        lead = [(False, *system)] if system and first > 0 else []
        out.append(lead + [(False, *turns[i]) for i in old] + [(True, *turns[i]) for i in range(first, after)])
    return out


def formatted_chars(turns: list[tuple[str, str]], budget: int, history: int, segment: int) -> int:
    control = regex.compile(r"([<\[])(\\*)(/?s>|/?INST\]|</?SYS>>|\|\w+\|>)")

    def size(role, text):
        role = role.replace("%", "%25").replace("\n", "%0A")
        return sum(len(control.sub(r"\1\\\2\3", x)) for x in (role, text)) + len("<|im_start|>\n<|im_end|>\n")

    return sum(size(r, t) for w in windows(turns, budget, history, segment) for _, r, t in w)


def ordered(rows) -> dict:
    """conv -> its turns as (role, text), in order."""
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {conv: [(r, t) for _, _, r, t in sorted(turns)] for conv, turns in by.items()}
