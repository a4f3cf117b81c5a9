"""Vectorised pre-tokenizer of the byte-level BPE vocabularies.

The split pattern is

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

Whether a word starts at a character depends on at most ``LOOKBACK``
characters before it and ``LOOKAHEAD`` after it, so the pattern is a finite
automaton that forgets: ``starts`` evaluates it for all characters of a
buffer at once with array operations.
"""

from __future__ import annotations

import numpy as np

LOOKBACK, LOOKAHEAD = 4, 3
LETTER, DIGIT, OTHER, SPACE, UNKNOWN = 0, 1, 2, 3, 255
#: Fixed value: the one special token of the vocabulary; the library matches it inside texts by default.
END_OF_TEXT = "<|endoftext|>"


class CharClasses:
    """Class of each code point as the tokenizer library's own Unicode tables
    have it: a code point is classified the first time it is seen, by how
    the library splits it from a letter, a digit and a mark."""

    def __init__(self) -> None:
        from tokenizers import pre_tokenizers

        self._split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
        self._table = np.full(0x110000, UNKNOWN, np.uint8)

    def _probe(self, char: str) -> int:
        for cls, friend in ((LETTER, "a"), (DIGIT, "1"), (OTHER, "!")):
            if len(self._split(friend + char)) == 1:
                return cls
        return SPACE

    def __call__(self, points: np.ndarray) -> np.ndarray:
        cls = self._table[points]
        new = np.unique(points[cls == UNKNOWN])
        if len(new):
            self._table[new] = [self._probe(chr(p)) for p in new]
            cls = self._table[points]
        return cls


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def starts(points: np.ndarray, classes: CharClasses, piece_starts: np.ndarray) -> np.ndarray:
    """True where a word starts.  ``piece_starts``: offsets at which another
    text begins (0 included); nothing is joined across them."""
    n = len(points)
    if n == 0:
        return np.zeros(0, bool)
    cls = classes(points)
    first = np.zeros(n + 1, bool)
    first[piece_starts[piece_starts < n]] = True
    first[n] = True
    white = cls == SPACE
    out = np.empty(n, bool)
    out[0] = True
    before_white, here_white = white[:-1], white[1:]
    follows = np.zeros(n, bool)  # the next character belongs to the same text and is not white
    follows[:-1] = ~white[1:] & ~first[1:n]
    out[1:] = np.where(
        here_white,
        ~before_white | follows[1:],
        np.where(before_white, points[:-1] != 32, cls[1:] != cls[:-1]),
    )
    out |= first[:n]
    quotes = np.flatnonzero((points == 39) & out)
    if len(quotes):
        def at(shift: int) -> np.ndarray:
            p = quotes + shift
            inside = p < n
            c = np.where(inside, points[np.minimum(p, n - 1)], 0)
            for k in range(1, shift + 1):  # no text begins in between
                c = np.where(first[np.minimum(quotes + k, n)], 0, c)
            return c

        one, two = at(1), at(2)
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        for hit, length in ((short, 2), (long, 3)):
            q = quotes[hit]
            for k in range(1, length):
                out[q + k] = False
            end = q + length
            out[end[end < n]] = True
    return out
