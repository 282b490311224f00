"""Splitting texts into pre-tokens, and a bounded memory of what was computed per word.

The `regex` module knows the Unicode classes of the tokenizers' patterns. Nearly all texts hold
only characters up to U+017F, where the classes are few ranges and `re` finds the same pieces
several times faster; any other character sends the whole text to the general pattern.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import regex

# White space, letters and numbers by Unicode up to U+017F.
SPACES = "\\t-\\r \\x85\\xa0"
ALL_SPACES = SPACES + "\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
LETTERS = "A-Za-z\\xaa\\xb5\\xba\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\u017f"
NUMBERS = "0-9\\xb2\\xb3\\xb9\\xbc-\\xbe"
BEYOND = re.compile("[^\\x00-\\u017f]")


class Splitter:
    """Finds the matches of a pattern written with {L}, {N} and {S} for the insides of classes."""

    def __init__(self, pattern: str):
        def filled(letters: str, numbers: str, spaces: str) -> str:
            return pattern.replace("{L}", letters).replace("{N}", numbers).replace("{S}", spaces)
        self.general = regex.compile(filled("\\p{L}", "\\p{N}", ALL_SPACES)).findall
        self.narrow = re.compile(filled(LETTERS, NUMBERS, SPACES)).findall

    def __call__(self, text: str) -> list[str]:
        return self.general(text) if BEYOND.search(text) else self.narrow(text)


class Remembered(dict):
    """`compute(word)` by word. Holds at most two generations of `size` words each."""

    def __init__(self, compute: Callable[[str], object], size: int):
        super().__init__()
        self.compute, self.size, self.old = compute, size, {}

    def __missing__(self, word: str):
        value = self.old.get(word)
        if value is None:
            value = self.compute(word)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[word] = value
        return value
