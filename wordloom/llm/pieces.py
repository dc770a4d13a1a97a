"""Splitting text into the pieces that byte-level merges never cross.

``public_tokenizers.PATTERN`` uses the classes \\p{L} and \\p{N}. For texts without
supplementary characters they are spelled out from the character database, once per
process, so that the standard engine applies the pattern by table look-up; other texts take
the general engine. ``piece_starts`` applies it to many texts at once, by the class of each
character. All give the same pieces.
"""

from __future__ import annotations

import functools
import re

import numpy as np
import public_tokenizers
import regex

#: The contractions of the pattern, and the code points of Unicode's White_Space.
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
WHITE_SPACE = "\\t\\n\\x0b\\x0c\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def _ranges(pattern: str) -> str:
    """The basic code points of a character class as ranges for the standard engine."""
    basic = "".join(chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000)
    runs = (m.group() for m in regex.finditer(f"{pattern}+", basic))
    return "".join(f"\\u{ord(r[0]):04x}-\\u{ord(r[-1]):04x}" for r in runs)


@functools.cache
def splitter():
    """A function from a text to the list of its pieces, in order and without gaps."""
    letters, numbers = _ranges(r"\p{L}"), _ranges(r"\p{N}")
    basic = re.compile(
        f"{CONTRACTIONS}| ?[{letters}]+| ?[{numbers}]+| ?[^{WHITE_SPACE}{letters}{numbers}]+"
        f"|[{WHITE_SPACE}]+(?![^{WHITE_SPACE}])|[{WHITE_SPACE}]+"
    ).findall
    general = regex.compile(public_tokenizers.PATTERN).findall

    def split(text: str) -> list[str]:
        return basic(text) if len(text.encode("utf-16-le")) == 2 * len(text) else general(text)

    return split


#: Classes of characters.
OTHER, LETTER, NUMBER, WHITE = range(4)


@functools.cache
def _classes() -> np.ndarray:
    """The class of every code point."""
    out = np.zeros(0x110000, np.uint8)
    every = "".join(chr(c) if not 0xD800 <= c < 0xE000 else "." for c in range(0x110000))
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (f"[{WHITE_SPACE}]+", WHITE)):
        for run in regex.finditer(pattern, every):
            out[run.start() : run.end()] = kind
    return out


def piece_starts(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Whether a piece starts at each code point; texts lie one after another and start at ``starts``.

    Pieces are runs of one class, but of white space that others follow the last one is apart: a blank
    goes to what follows. An apostrophe alone takes the letters of a contraction.
    """
    n = len(points)
    kind = np.append(_classes()[points], [WHITE, WHITE])
    fresh = np.zeros(n + 2, bool)  # the two at the end are texts of their own
    fresh[starts] = fresh[n:] = True
    start = fresh.copy()
    start[1:] |= kind[1:] != kind[:-1]
    after = np.flatnonzero((kind[1:] != WHITE) & (kind[:-1] == WHITE) & ~fresh[1:]) + 1
    start[after - 1] = True
    start[after[points[after - 1] == 32]] = False
    quote = np.flatnonzero(points == 39)
    quote = quote[start[quote] & (kind[quote + 1] == LETTER) & ~fresh[quote + 1]]
    first = points[quote + 1]
    second = np.where(fresh[quote + 2], 0, np.append(points, [0, 0])[quote + 2])
    one = np.isin(first, [ord(c) for c in "stmd"])
    two = ((second == ord("e")) & np.isin(first, [ord(c) for c in "rv"])) | ((first == ord("l")) & (second == ord("l")))
    start[quote[one | two] + 1] = False
    for taken, size in ((one, 2), (two, 3)):
        rest = quote[taken] + size
        start[rest[kind[rest] == LETTER]] = True
    return start[:n]
