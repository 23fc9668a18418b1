"""Cuts texts where no token can cross, and remembers the ids of what lies between.

Byte-level BPE splits a text before it merges. A single space between two characters that are not
white space always opens a new piece, so what lies between two such spaces (a unit) has the same
ids wherever it stands. Most units recur, so each Python worker encodes a unit once.

Where the tokenizer makes a single line feed between such characters a piece of its own, it is a unit too: the
words on both sides recur far more often than the two of them together.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from itertools import islice

# Python counts a few control characters as white space that the tokenizers do not; that only
# leaves some cuts out.
_CUT = re.compile(r"(?<=\S) (?=\S)")
_LINE = re.compile(r"(?<=\S)\n(?=\S)")
_RARE = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]
_SEGMENT = 1 << 20
_LONG_UNIT = 64
_MARKS = ".,!?;:#$%&*|"


def segments(text: str) -> Iterator[tuple[str, bool]]:
    """``text`` in parts of about a million characters, cut at safe spaces; the flag is true for the first."""
    start, first = 0, True
    while len(text) - start > _SEGMENT:
        cut = _CUT.search(text, start + _SEGMENT)
        if cut is None:
            break
        yield text[start : cut.start()], first
        start, first = cut.end(), False
    yield text[start:], first


def split_units(text: str, first: bool = True, lines: bool = False) -> list[str]:
    """Units of a segment. A unit stands for itself behind a space; one that has no space before it, as the
    opening unit of a text, is written with a leading space to tell it apart. With ``lines`` this holds for the
    opening unit of a line too, and for the line feed before it."""
    odd = "  " in text or " \n" in text or "\n " in text or text[:1] == " " or text[-1:] == " " or any(c in text for c in _RARE)
    if not lines or "\n" not in text:
        units = _CUT.split(text) if odd else text.split(" ")
    elif odd or "\0" in text or "\n\n" in text or text[0] == "\n" or text[-1] == "\n":
        units, *others = [_CUT.split(line) for line in _LINE.split(text)]
        for line in others:
            units += [" \n", " " + line[0], *line[1:]]
    else:
        units = text.replace(" ", "\0").replace("\n", "\0 \n\0 ").split("\0")
    if first:
        units[0] = " " + units[0]
    return units


def spoken(unit: str) -> str:
    """The characters a unit stands for."""
    return unit[1:] if unit[:1] == " " else " " + unit


class UnitCache:
    """Ids of units as little-endian 32-bit values.

    ``encode`` gets texts not yet known and returns the id bytes of each, in order. Beyond twice
    ``limit`` only the first ones seen stay, which are the frequent ones. ``lines`` says that a single line feed
    between characters that are not white space is a piece of its own.
    """

    def __init__(self, encode: Callable[[list[str]], Iterable[bytes]], limit: int = 250_000, lines: bool = False):
        self.encode = encode
        self.lines = lines
        self.limit = limit
        self.known: dict[str, bytes] = {}

    def ids(self, texts: list[str]) -> list[bytes]:
        """Id bytes of each text; the empty text has none. Unknown units are encoded in one call."""
        cut: list[list[str]] = []
        new: set[str] = set()
        for text in texts:
            if not text:
                units = []
            elif len(text) <= _SEGMENT:
                units = split_units(text, lines=self.lines)
            else:
                units = [u for part, first in segments(text) for u in split_units(part, first, self.lines)]
            new.update(units)
            cut.append(units)
        new.difference_update(self.known)
        if new:
            self._learn(new)
        find = self.known.__getitem__
        out = [b"".join(map(find, units)) for units in cut]
        if len(self.known) > 2 * self.limit:
            self.known = {u: ids for u, ids in islice(self.known.items(), self.limit) if len(u) <= _LONG_UNIT}
        return out

    def _learn(self, new: set[str]) -> None:
        known = self.known
        # Marks behind a letter or digit are a piece of their own.
        parts: dict[str, tuple[str, str]] = {}
        wholes: dict[str, str] = {}
        tails: dict[str, bytes] = {}
        for unit in new:
            base = unit.rstrip(_MARKS)
            if base and len(base) < len(unit) and base[-1].isalnum():
                parts[unit] = (base, unit[len(base) :])
                tails[unit[len(base) :]] = b""
                if base not in known:
                    wholes[base] = spoken(base)
            else:
                wholes[unit] = spoken(unit)
        made = iter(self.encode([*wholes.values(), *tails]))
        known.update(zip(wholes, made))
        tails = dict(zip(tails, made, strict=True))
        for unit, (base, tail) in parts.items():
            known[unit] = known[base] + tails[tail]
