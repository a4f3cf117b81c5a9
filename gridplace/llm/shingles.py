"""Distinct word shingles of texts as sorted 64-bit hashes.

A word's hash is XXH64 of its bytes, remembered up to a bound; a shingle's
hash chains its words' hashes through a full-width finalizer, so it depends
on every word and on their order, and no arithmetic on texts can cancel out.
"""

from __future__ import annotations

import numpy as np
import xxhash

from gridplace.llm.substring_dedup import mix

MEMO_WORDS = 500_000
SEED = 42


class Shingler:
    def __init__(self, words: int) -> None:
        self.words = words
        self.memo: dict[bytes, int] = {}

    def hashes(self, words: list[bytes]) -> np.ndarray:
        memo = self.memo
        if len(memo) > MEMO_WORDS:
            memo.clear()
        for w in set(words).difference(memo):
            memo[w] = xxhash.xxh64_intdigest(w, SEED)
        return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))

    def set_of(self, text: str | None) -> np.ndarray:
        """Sorted distinct shingles of the words ``[^\\x20\\x09-\\x0D]+``, A-Z
        lower-cased; fewer words than a shingle are one shingle; no words: none."""
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        k = min(self.words, len(words))
        h = self.hashes(words)
        n = len(h) - k + 1
        out = np.full(n, k, np.uint64)
        for i in range(k):
            out = mix(out) + h[i : i + n]
        return np.unique(mix(out))
