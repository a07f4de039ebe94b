"""Byte-level BPE inside a task: units of text that tokenize alone, and bounded worker caches.

A *safe boundary* is a single space with a non-space character on both sides.
Pre-tokens never cross it (a pre-token with a leading space starts there), so
the pieces between safe boundaries tokenize independently of each other. Texts
that hold an added token's string go to the library whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable

SAFE = re.compile(r"(?<=\S) (?=\S)")
# Entries that a worker's cache holds at most.
CACHE_ENTRIES = 600_000


class UnsafePieceError(Exception):
    """A piece that begins or ends with white space, or is empty."""


def load_tokenizer(path: str):
    """The library's tokenizer, without padding or truncation."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


def splits_at_spaces(tokenizer) -> bool:
    """Whether the pieces between safe boundaries are independent: plain byte-level BPE."""
    import json

    spec = json.loads(tokenizer.to_str())
    pre = spec["pre_tokenizer"] or {}
    return (
        spec["normalizer"] is None
        and spec["model"]["type"] == "BPE"
        and pre.get("type") == "ByteLevel"
        and pre.get("use_regex", False)
        and not pre.get("add_prefix_space", True)
        and not any(t["lstrip"] or t["rstrip"] or t["normalized"] or t["single_word"] for t in spec["added_tokens"])
    )


def byte_alphabet() -> list[str]:
    """The character that shows each byte: 188 show themselves, the others follow from U+0100."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


# Letters that every Unicode version counts as letters, digits, and ASCII marks
# but the apostrophe; texts of these only are split without the library.
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
MARKS = r"!-&(-/:-@\[-`{-~"
PLAIN = re.compile(f" ?[{LETTERS}0-9{MARKS}]+")
PLAIN_PARTS = re.compile(f" ?[{LETTERS}]+| ?[0-9]+| ?[{MARKS}]+")


class PreTokens:
    """Pre-tokens of a string, in the byte alphabet, as the library splits it."""

    def __init__(self, tokenizer) -> None:
        self.split = tokenizer.pre_tokenizer.pre_tokenize_str
        self.shown = dict(enumerate(byte_alphabet()))

    def __call__(self, text: str) -> list[str]:
        if PLAIN.fullmatch(text):
            shown = text.encode().decode("latin-1").translate(self.shown)
            if PLAIN_PARTS.fullmatch(text):
                return [shown]
            return [part.encode().decode("latin-1").translate(self.shown) for part in PLAIN_PARTS.findall(text)]
        return [part for part, _ in self.split(text)]


class Units:
    """Values of a text's units, in order. ``make`` gets a string that tokenizes alone; values can be added up.

    The cache has two generations of half the entries each; a full young one
    becomes the old one, and what is still used moves over again.
    """

    def __init__(self, make: Callable, limit: int = CACHE_ENTRIES) -> None:
        self.plain = Cache(make, limit // 4)
        self.spaced = SpacedCache(self, limit)

    def of(self, text: str) -> list:
        first, *rest = text.split(" ")
        if first and not first[-1].isspace():
            try:
                values = list(map(self.spaced.__getitem__, rest))
            except UnsafePieceError:
                pass
            else:
                return [self.plain.make(first), *values]
        first, *rest = SAFE.split(text)
        values = [self.plain.make(first)] if first else []
        for piece in rest:
            # only the last piece can end with white space, where the text does
            values.append(self.plain.make(" " + piece) if piece[-1].isspace() else self.spaced[piece])
        return values

    def after_space(self, text: str) -> list:
        """The same for a text that begins with the space of a safe boundary and ends with no space."""
        try:
            return list(map(self.spaced.__getitem__, text[1:].split(" ")))
        except UnsafePieceError:
            return [self.spaced[piece] for piece in SAFE.split(text[1:])]


class Cache(dict):
    def __init__(self, make: Callable, limit: int) -> None:
        super().__init__()
        self.make, self.limit, self.old = make, limit // 2, {}

    def __missing__(self, piece: str):
        value = self.old.get(piece)
        if value is None:
            value = self.value(piece)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[piece] = value
        return value

    def value(self, piece: str):
        return self.make(piece)


class SpacedCache(Cache):
    """Values of pieces after a ``split(' ')``: the space is implied and must be safe.

    A single newline between non-spaces is a pre-token of its own, so a piece
    that spans lines is put together from its parts, which are found more often.
    """

    def __init__(self, units: Units, limit: int) -> None:
        super().__init__(units.plain.make, limit)
        self.units = units

    def value(self, piece: str):
        if not piece or piece[0].isspace() or piece[-1].isspace():
            raise UnsafePieceError
        first, *rest = piece.split("\n")
        if not rest or any(not p or p[0].isspace() or p[-1].isspace() for p in (first, *rest)):
            return self.make(" " + piece)
        plain = self.units.plain
        total = self[first]
        for part in rest:
            total = total + plain["\n"] + plain[part]
        return total
