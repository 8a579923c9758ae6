"""A word-end BPE vocabulary file, and the words it sees in a text.

The file is a ``tokenizers`` JSON: added tokens, a normaliser, a split pattern, a vocabulary with a mark for word ends,
and merges in order of rank. Nothing is trained or copied; the path is a parameter.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable, Iterable
from functools import lru_cache

import regex


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: itself if printable, else the next after 255."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


class Vocabulary:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"]
        steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or not self.suffix or steps != ["NFC", "Replace", "Lowercase"] or spec["decoder"]:
            raise ValueError(f"{path}: not a word-end BPE file of the supported form")
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (1 + max([*self.ids.values(), *self.special.values()]))
        for token, i in [*self.ids.items(), *self.special.items()]:
            self.tokens[i] = token
        self.merges = [(self.ids[a], self.ids[b], self.ids[a + b]) for a, b in model["merges"]]
        letters = byte_letters()
        self.letter = letters
        self.plain = [self.ids[c] for c in letters]
        self.end = [self.ids[c + self.suffix] for c in letters]
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))
                                      + ")")

    def normal(self, text: str) -> str:
        """Composed and lower-cased letter by letter: no rule for a final sigma. White space may stay: no word has any."""
        if text.isascii():
            return text.lower()
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def pieces(self, text: str):
        """(special id or None, list of words) in order; specials stand for themselves."""
        if not any(s in text for s in self.special):
            yield None, self.pattern.findall(self.normal(text))
            return
        for i, part in enumerate(self.specials.split(text)):
            if i % 2:
                yield self.special[part], []
            elif part:
                yield None, self.pattern.findall(self.normal(part))


class Memory:
    """What a worker knows of words, in two generations: a word that is not met for one generation is forgotten."""

    def __init__(self, most: int, make: Callable[[list[str]], Iterable]):
        self.most, self.make = most, make
        self.young: dict = {}
        self.old: dict = {}

    def know(self, words: set[str]) -> dict:
        """A dictionary that holds all these words."""
        missing = words - self.young.keys()
        if len(self.young) + len(missing) > self.most:
            self.old, self.young, missing = self.young, {}, words
        back = missing & self.old.keys()
        self.young.update(zip(back, map(self.old.__getitem__, back)))
        new = list(missing - back)
        self.young.update(zip(new, self.make(new)))
        return self.young


@lru_cache(maxsize=2)
def load(path: str) -> Vocabulary:
    """One copy per Python worker."""
    return Vocabulary(path)
