"""BPE encoding and decoding with prefix sharing.

The distinct new words of a batch are visited in sorted order, which is the
depth-first order of their trie.  Going down one byte adds one last-token
state (``bpe_pairs.LastTokens``); going to the next word drops the states below the
common prefix and keeps those above, so a shared prefix is encoded once.  A
word's encoding is read back along its last tokens.

Defined cases: NULL text is the empty text (no ids, empty decoded text); rows
are independent, so repeated rows, NULL ids and other columns are harmless;
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridplace.llm.bpe_pairs import LastTokens, Vocabulary
from gridplace.llm.common import map_arrow, text_slices
from gridplace.llm.pretokenize import END_OF_TEXT, CharClasses, code_points, starts

SLICE_CHARS = 1 << 18
MEMO_WORDS = 300_000


class Codec:
    def __init__(self, path: str, max_states: int | None = None) -> None:
        self.vocab = Vocabulary(path)
        self.states = LastTokens(self.vocab, False, max_states)
        self.classes = CharClasses()
        self.end_id = self.vocab.special.get(END_OF_TEXT)
        size = max(self.vocab.bytes_of) + 1
        pieces = [self.vocab.bytes_of.get(i, b"") for i in range(size)]
        self.piece_len = np.fromiter(map(len, pieces), np.int64, size)
        self.widths = self.piece_len.tolist()
        self.piece_at = np.concatenate(([0], np.cumsum(self.piece_len)[:-1]))
        self.piece_bytes = np.frombuffer(b"".join(pieces), np.uint8)
        self._forget()

    def _forget(self) -> None:
        self.memo: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.offsets = np.zeros(1 << 16, np.int64)
        self.used = 0

    def _add(self, words: list[str]) -> None:
        """Encode words that are not in the memo yet, through their trie."""
        if self.states.full():
            self.states.forget()
        moves, compile_move, last = self.states.moves, self.states.move, self.states.last
        width = self.widths
        coded = sorted((w.encode("utf-8", "surrogatepass"), w) for w in words)
        path = [0]  # states along the current branch of the trie
        before = b""
        flat: list[int] = []
        ends: list[int] = []
        for data, _ in coded:
            n = min(len(before), len(data))
            depth = n if before[:n] == data[:n] else next(i for i in range(n) if before[i] != data[i])
            del path[depth + 1 :]
            state = path[depth]
            for byte in data[depth:]:
                move = moves[state].get(byte)
                state = move[0] if move is not None else compile_move(state, byte)[0]
                path.append(state)
            d, reverse = len(data), []
            while d:
                token = last(path[d])
                reverse.append(token)
                d -= width[token]
            flat.extend(reversed(reverse))
            ends.append(len(flat))
            before = data
        n_old = len(self.memo)
        start = self.used
        need = start + len(flat)
        if need > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros(max(len(self.ids), need), np.uint32)))
        if n_old + len(words) + 1 > len(self.offsets):
            self.offsets = np.concatenate((self.offsets, np.zeros(max(len(self.offsets), len(words) + 1), np.int64)))
        self.ids[start:need] = flat
        self.offsets[n_old + 1 : n_old + 1 + len(ends)] = np.array(ends, np.int64) + start
        for k, (_, w) in enumerate(coded):
            self.memo[w] = n_old + k
        self.used = need

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and the number of ids of each piece."""
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        begin = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        text = "".join(pieces)
        cuts = np.flatnonzero(starts(code_points(text), self.classes, begin))
        ends = cuts.tolist()
        words = [text[a:b] for a, b in zip(ends, ends[1:] + [len(text)])]
        if len(self.memo) > MEMO_WORDS:
            self._forget()
        new = set(words).difference(self.memo)
        if new:
            self._add(list(new))
        which = np.fromiter(map(self.memo.__getitem__, words), np.int64, len(words))
        first = self.offsets[which]
        sizes = self.offsets[which + 1] - first
        ids = self.ids[ranges(first, sizes)]
        total = np.concatenate(([0], np.cumsum(sizes)))
        per_piece = total[np.searchsorted(cuts, begin + lengths)] - total[np.searchsorted(cuts, begin)]
        return ids, per_piece

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        pieces: list[str] = []
        layout: list[int] = []  # pieces of each text
        for t in texts:
            parts = t.split(END_OF_TEXT) if self.end_id is not None else [t]
            pieces += parts
            layout.append(len(parts))
        ids, sizes = self.encode_pieces(pieces)
        at = np.concatenate(([0], np.cumsum(sizes))).tolist()
        out, p = [], 0
        for n in layout:
            if n == 1:
                out.append(ids[at[p] : at[p + 1]])
            else:
                mark = np.array([self.end_id], np.uint32)
                parts = [x for k in range(n) for x in ((ids[at[p + k] : at[p + k + 1]],) if k == 0 else (mark, ids[at[p + k] : at[p + k + 1]]))]
                out.append(np.concatenate(parts))
            p += n
        return out

    def decode(self, ids: np.ndarray) -> str:
        """Bytes of the ids joined, malformed UTF-8 replaced."""
        sizes = self.piece_len[ids]
        return self.piece_bytes[ranges(self.piece_at[ids], sizes)].tobytes().decode("utf-8", "replace")


def ranges(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices first[0] .. first[0]+sizes[0]-1, first[1] .. and so on."""
    total = int(sizes.sum())
    shift = np.repeat(first - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) if len(sizes) else np.zeros(0, np.int64)
    return np.arange(total) + shift


@cache
def codec(path: str, max_states: int | None = None) -> Codec:
    """One codec per Python worker."""
    return Codec(path, max_states)


def bpe_encode(
    docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True,
    with_decoded: bool = True, max_states: int | None = None,
) -> DataFrame:
    """Per document: doc_id, ids (array<int>), n_tokens, ids_sha256 (ids as
    little-endian unsigned 32-bit), decoded (text) and decoded_sha256.

    ``with_ids=False`` leaves ids and decoded out of the rows,
    ``with_decoded=False`` only decoded.  ``vocab_path`` must be readable on
    every executor.  ``max_states``: after how many states a worker forgets
    them and compiles anew (by default ``bpe_pairs.MAX_STATES``); fewer take
    less memory and more time.  Map-only: no shuffle.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    with_decoded = with_ids and with_decoded
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids + ["decoded"] * with_decoded
    schema = f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids + ", decoded string" * with_decoded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocab_path, max_states)
        for batch in batches:
            for a, texts in text_slices(batch.column(1), SLICE_CHARS):
                coded = c.encode(texts)
                decoded = [c.decode(x) for x in coded]
                cols = [
                    batch.column(0).slice(a, len(texts)),
                    pa.array([len(x) for x in coded], pa.int64()),
                    pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in coded], pa.string()),
                    pa.array([hashlib.sha256(t.encode("utf-8", "replace")).hexdigest() for t in decoded], pa.string()),
                ]
                if with_ids:
                    cols.append(pa.array([x.astype(np.int32) for x in coded], pa.list_(pa.int32())))
                if with_decoded:
                    cols.append(pa.array(decoded, pa.string()))
                yield pa.RecordBatch.from_arrays(cols, names)

    return map_arrow(rows, run, schema)
