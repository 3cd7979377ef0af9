"""Texts as arrays of code points, mapped by tables: folding without a Python step per character."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np

SIZE = 0x110000
SPACE, DROP = 32, 0


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def text(points: np.ndarray) -> str:
    return points.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")


def pieces(whole: str, size: int = 1 << 20):
    """Parts of a long text, so that arrays over it stay bounded."""
    for i in range(0, len(whole), size):
        yield whole[i:i + size]


def squeeze(points: np.ndarray) -> np.ndarray:
    """Runs of spaces become one."""
    if not len(points):
        return points
    blank = points == SPACE
    return points[~(blank & np.concatenate([[False], blank[:-1]]))]


@lru_cache(maxsize=1)
def letters_table() -> np.ndarray:
    """Lower-case letters as they are, everything else a space."""
    table = np.full(SIZE, SPACE, np.uint32)
    for i in range(SIZE):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            table[i] = ord(low) if len(low) == 1 else ord(low[0])
    return table


# Letters of other scripts that look like Latin ones, and signs that stand for letters.
LOOKS_LIKE = dict(zip("аеорсухіјѕԁԛԝһӏкмтвнгαβεικνορτυχγωηλ", "aeopcyxijsdqwhlkmtbhrabeiknoptuxywnl"))
SIGNS = dict(zip("0134578@$!|€", "oieastbasiie"))
# Marks in the folding table, above all code points: a sign that stands for a letter, and an exclamation mark.
SIGN, BANG = 1 << 21, 1 << 22


@lru_cache(maxsize=1)
def folding_table() -> np.ndarray:
    """Lower case, accents off, look-alikes and digit substitutions to Latin letters; marks dropped, the rest spaces.

    `l` and `1` both stand for `i`, because they are used for each other. Signs carry the mark SIGN, `!` also BANG.
    """
    table = np.full(SIZE, SPACE, np.uint32)
    for i in range(SIZE):
        c = chr(i)
        if c in SIGNS:
            table[i] = ord(SIGNS[c]) | SIGN | (BANG if c == "!" else 0)
            continue
        kind = unicodedata.category(c)
        if kind in ("Mn", "Cf"):
            table[i] = DROP
        elif kind[0] == "L":
            base = unicodedata.normalize("NFKD", c)[0].lower()[:1]
            base = LOOKS_LIKE.get(base, base)
            table[i] = ord("i" if base == "l" else base)
    return table


def fold(whole: str) -> str:
    """Folded words with one space before, between and after them; exclamation marks are letters only before a letter."""
    table = folding_table()
    parts = [table[codes(p)] for p in pieces(whole)]
    points = np.concatenate([[SPACE], *parts, [SPACE]]).astype(np.uint32)
    points = points[points != DROP]
    bang = (points & BANG) > 0
    if bang.any():
        places = np.arange(len(points))
        follow = points[np.minimum.accumulate(np.where(bang, len(points), places)[::-1])[::-1]]  # the first point after a run of marks
        points[bang & ((follow == SPACE) | (follow & SIGN > 0))] = SPACE
    return text(squeeze(points & (SIGN - 1)))
