"""Merge rules of a byte-level BPE vocabulary, and which token pairs can stand
side by side in an encoding.

For BPE by merge rank, a token sequence is the encoding of its bytes exactly
when every adjacent pair of it is the encoding of the pair's bytes.  So each
prefix of a word has one last token, and it follows from the last tokens of
the shorter prefixes: it is the longest vocabulary entry that ends there and
may stand after the last token of what precedes it.
"""

from __future__ import annotations

import json

MEMO_PAIRS = 1_000_000
#: About 600 bytes each.
MAX_STATES = 250_000
NEVER = 1 << 60


def byte_alphabet() -> dict[str, int]:
    """The printable characters that stand for bytes in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    chars = {chr(b): b for b in plain}
    for n, b in enumerate(sorted(set(range(256)) - set(plain))):
        chars[chr(256 + n)] = b
    return chars


class Vocabulary:
    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()

        def raw(token: str) -> bytes:
            return bytes(alphabet[c] for c in token)

        model = spec["model"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = {k: v for k, v in model["vocab"].items() if k not in self.special}
        self.ids = {raw(k): v for k, v in names.items()}
        self.bytes_of = {v: k for k, v in self.ids.items()} | {v: k.encode() for k, v in self.special.items()}
        self.longest = max(map(len, self.ids))
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.rank = {(names[a], names[b]): rank for rank, (a, b) in enumerate(merges)}
        self.halves = {names[a + b]: (rank, names[a], names[b]) for rank, (a, b) in enumerate(merges)}
        self.prefixes = {t[:k]: t[:k] for t in self.ids for k in range(1, len(t) + 1)}  # to itself, so that equal ones are one object
        self._pairs: dict[tuple[int, int], bool] = {}
        self._edges: tuple[dict, dict] = ({}, {})

    def _edge(self, token: int, right: bool) -> list[tuple[int, int]]:
        """The tokens that stand at one edge of ``token`` while its own merges
        run, each with the rank of the merge that ends it."""
        known = self._edges[right].get(token)
        if known is None:
            known, part, end = [], token, NEVER
            while True:
                known.append((part, end))
                if part not in self.halves:
                    break
                end, a, b = self.halves[part]
                part = b if right else a
            self._edges[right][token] = known
        return known

    def may_follow(self, left: int, right: int) -> bool:
        """Whether encoding the joined bytes gives these two tokens again: no
        merge across the seam may come before the merges that use up its two
        sides.  Of equal ranks the leftmost goes first."""
        known = self._pairs.get((left, right))
        if known is None:
            if len(self._pairs) >= MEMO_PAIRS:
                self._pairs.clear()
            known = True
            for x, x_end in self._edge(left, True):
                for y, y_end in self._edge(right, False):
                    rank = self.rank.get((x, y))
                    if rank is not None and rank < x_end and rank <= y_end:
                        known = False
            self._pairs[left, right] = known
        return known


class LastTokens:
    """Deterministic automaton over bytes for the last token of each prefix of
    a word, compiled as texts reach its states.

    A state is all that the future needs: the longest suffix read that still
    begins a vocabulary entry and, for each position in it, the last token of
    the prefix ending there.  With ``counting`` a state also has the token
    counts of those prefixes relative to the current one, and a transition
    emits the change of the count.  States share their suffixes and the entries
    of their windows.
    """

    def __init__(self, vocab: Vocabulary, counting: bool, max_states: int | None = None) -> None:
        self.vocab, self.counting, self.max_states = vocab, counting, max_states
        self.forget()

    def forget(self) -> None:
        start = (b"", ((-1, 0),))
        self.entries: dict[tuple[int, int], tuple[int, int]] = {}
        self.states: list[tuple[bytes, tuple]] = [start]
        self.number: dict[tuple, int] = {start: 0}
        self.moves: list[dict[int, tuple[int, int]]] = [{}]

    def full(self) -> bool:
        return len(self.states) > (self.max_states or MAX_STATES)

    def last(self, state: int) -> int:
        return self.states[state][1][-1][0]

    def move(self, state: int, byte: int) -> tuple[int, int]:
        """Compile a transition: target state and emitted tokens."""
        suffix, window = self.states[state]
        vocab = self.vocab
        read = suffix + bytes((byte,))
        for skip in range(len(read)):  # the longest entry that may stand here
            token = vocab.ids.get(read[skip:])
            if token is not None:
                before, count = window[skip]
                if before == -1 or vocab.may_follow(before, token):
                    break
        else:
            raise ValueError("the vocabulary lacks a byte")
        emitted = count + 1 if self.counting else 0
        drop = 0
        while read[drop:] not in vocab.prefixes:
            drop += 1
        shared = self.entries.setdefault
        kept = window[drop:]
        if emitted:
            kept = tuple([shared(e, e) for e in [(t, c - emitted) for t, c in kept]])
        end = (token, 0)
        key = (vocab.prefixes[read[drop:]], (*kept, shared(end, end)))
        target = self.number.get(key)
        if target is None:
            target = self.number[key] = len(self.states)
            self.states.append(key)
            self.moves.append({})
        found = self.moves[state][byte] = (target, emitted)
        return found
