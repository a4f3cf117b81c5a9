"""Token counts by a compiled finite-state tokenizer.

Each word of the pre-tokenizer (itself a finite automaton, ``pretokenize``)
is run through a deterministic transducer over bytes whose transitions are
annotated with the number of tokens they emit (``bpe_pairs.LastTokens``).  Its
states and transitions are compiled when a text first reaches them and kept
per Python worker.

A text longer than ``chunk_chars`` is cut into chunks.  The map of a chunk
from entering to leaving states is the same for all entering states after the
first word boundary inside the chunk that no neighbour can move, so it is
held as (head before it, tokens after it, tail after the last such boundary).
These maps compose associatively, and a balanced scan combines them: memory
is bounded by the chunk, and no chunk needs its predecessor's state.  A text
longer than ``task_chars`` is dealt out chunk by chunk: its maps are computed
by many tasks at once, and only the maps meet, in the chunks' order.

Defined cases: NULL text counts as empty and has 0 bytes and 0 tokens; rows
are independent, so repeated rows, NULL ids and other columns are harmless;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridplace.llm.bpe_pairs import LastTokens, Vocabulary
from gridplace.llm.common import map_arrow, materialize, text_slices
from gridplace.llm.pretokenize import END_OF_TEXT, LOOKAHEAD, LOOKBACK, CharClasses, code_points, starts

CHUNK_CHARS = 1 << 18
#: Texts beyond this are counted by several tasks.
TASK_CHARS = 1 << 23
SLICE_CHARS = 1 << 20
MEMO_WORDS = 300_000


class WordCounts(dict):
    """Tokens of a word: run through the transducer once, then remembered up
    to a bound."""

    def __init__(self, states: LastTokens) -> None:
        super().__init__()
        self.states = states

    def __missing__(self, word: str) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        if self.states.full():
            self.states.forget()
        moves, compile_move = self.states.moves, self.states.move
        state = total = 0
        for byte in word.encode("utf-8", "surrogatepass"):
            move = moves[state].get(byte)
            state, emitted = move if move is not None else compile_move(state, byte)
            total += emitted
        if len(word) <= 64:
            self[word] = total
        return total


class Tokenizer:
    def __init__(self, path: str) -> None:
        self.classes = CharClasses()
        self.words = WordCounts(LastTokens(Vocabulary(path), counting=True))

    def _word_counts(self, text: str, cuts: np.ndarray) -> np.ndarray:
        ends = cuts.tolist()
        words = [text[a:b] for a, b in zip(ends, ends[1:] + [len(text)])]
        return np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))

    def count_pieces(self, pieces: list[str]) -> np.ndarray:
        """Tokens of each piece; all pieces are split in one go."""
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        begin = np.concatenate(([0], np.cumsum(lengths)[:-1])) if len(pieces) else np.zeros(0, np.int64)
        text = "".join(pieces)
        cuts = np.flatnonzero(starts(code_points(text), self.classes, begin))
        total = np.concatenate(([0], np.cumsum(self._word_counts(text, cuts))))
        return total[np.searchsorted(cuts, begin + lengths)] - total[np.searchsorted(cuts, begin)]

    def count_between(self, text: str, following: str) -> int:
        """Tokens of ``text``, which starts at a word boundary and ends at one
        before ``following``."""
        mark = starts(code_points(text + following), self.classes, np.zeros(1, np.int64))
        return int(self._word_counts(text, np.flatnonzero(mark[: len(text)])).sum())

    def chunk_map(self, chunk: str) -> tuple:
        """(None, 0, text) of a chunk without a certain boundary, else (head,
        tokens, tail)."""
        mark = starts(code_points(chunk), self.classes, np.zeros(1, np.int64))
        cuts = np.flatnonzero(mark[: max(0, len(chunk) - LOOKAHEAD)])
        cuts = cuts[cuts >= LOOKBACK]
        if not len(cuts):
            return (None, 0, chunk)
        a, b = int(cuts[0]), int(cuts[-1])
        inner = int(self._word_counts(chunk[:b], cuts[:-1]).sum()) if b > a else 0
        return (chunk[:a], inner, chunk[b:]) if a == b else (chunk[:a], inner, chunk[b:], chunk[a])

    def compose(self, x: tuple, y: tuple) -> tuple:
        """The map of two neighbouring chunks.  An element's fourth part is
        the character after its head, which the last word of the head sees."""
        if y[0] is None:
            return (x[0], x[1], x[2] + y[2], *x[3:])
        if x[0] is None:
            return (x[2] + y[0], y[1], y[2], *y[3:])
        following = y[3] if len(y) > 3 else y[2][:1]
        mid = self.count_between(x[2] + y[0], following)
        return (x[0], x[1] + mid + y[1], y[2], x[3] if len(x) > 3 else x[2][:1])

    def apply(self, x: tuple) -> int:
        """Run the map of a whole text from the start state to the end."""
        if x[0] is None:
            return int(self.count_pieces([x[2]])[0])
        following = x[3] if len(x) > 3 else x[2][:1]
        return self.count_between(x[0], following) + x[1] + int(self.count_pieces([x[2]])[0])

    def scan(self, maps: list[tuple]) -> tuple:
        """The map of neighbouring chunks in order, combined pairwise."""
        while len(maps) > 1:
            maps = [self.compose(*maps[i : i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        return maps[0]

    def count_long(self, text: str, chunk_chars: int) -> int:
        return self.apply(self.scan([self.chunk_map(text[i : i + chunk_chars]) for i in range(0, len(text), chunk_chars)]))

    def count(self, texts: list[str], chunk_chars: int = CHUNK_CHARS) -> list[int]:
        out = [0] * len(texts)
        short: list[str] = []
        owner: list[int] = []
        for i, text in enumerate(texts):
            parts = text.split(END_OF_TEXT)
            out[i] += len(parts) - 1
            for p in parts:
                if len(p) > chunk_chars:
                    out[i] += self.count_long(p, chunk_chars)
                elif p:
                    short.append(p)
                    owner.append(i)
        for i, n in zip(owner, self.count_pieces(short).tolist() if short else []):
            out[i] += n
        return out


@cache
def tokenizer(path: str) -> Tokenizer:
    """One compiled tokenizer per Python worker."""
    return Tokenizer(path)


def token_counts(
    docs: DataFrame,
    vocab_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 1024,
    chunk_chars: int = CHUNK_CHARS,
    task_chars: int = TASK_CHARS,
) -> DataFrame:
    """Per document: doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    ``vocab_path`` must be readable on every executor.  One pass over the
    texts; its counts are a table, and texts longer than ``task_chars`` pass
    through it and are counted from there.
    """
    names = ["doc_id", "n_bytes", "n_tokens", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(vocab_path)
        for batch in batches:
            for first, texts in text_slices(batch.column(1), SLICE_CHARS):
                long = [len(t) > task_chars for t in texts]
                counts = iter(tok.count([t for t, x in zip(texts, long) if not x], chunk_chars))
                cols = [batch.column(j).slice(first, len(texts)) for j in (0, 2)]
                yield pa.RecordBatch.from_arrays(
                    [*cols, pa.array([None if x else next(counts) for x in long], pa.int64()), pa.array([t if x else None for t, x in zip(texts, long)], pa.string())], names
                )

    every = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(text_col).alias("text"),
        F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"),
    )
    id_type = every.schema["doc_id"].dataType.simpleString()
    found = materialize(map_arrow(every, run, f"doc_id {id_type}, n_bytes long, n_tokens long, text string"), "token_counts")
    short = found.filter("text IS NULL").drop("text")
    out = short.unionByName(_count_by_chunks(found.filter("text IS NOT NULL").select("doc_id", "text", "n_bytes"), vocab_path, chunk_chars))
    return out.withColumn("over_limit", F.col("n_tokens") > limit)


def _count_by_chunks(texts: DataFrame, vocab_path: str, chunk_chars: int) -> DataFrame:
    """doc_id, n_bytes, n_tokens of very long texts (doc_id, text, n_bytes)."""
    id_type = texts.schema["doc_id"].dataType.simpleString()
    rows = texts.withColumn("uid", F.monotonically_increasing_id())
    names = ["uid", "doc_id", "n_bytes", "part", "chunk", "text"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Special tokens end a part; a part is cut into chunks."""
        for batch in batches:
            for i in range(batch.num_rows):
                for k, part in enumerate(batch.column(1)[i].as_py().split(END_OF_TEXT)):
                    for c, at in enumerate(range(0, max(1, len(part)), chunk_chars)):
                        cols = [batch.column(j).slice(i, 1) for j in (3, 0, 2)] + [pa.array([k], pa.int32()), pa.array([c], pa.int32()), pa.array([part[at : at + chunk_chars]], pa.string())]
                        yield pa.RecordBatch.from_arrays(cols, names)

    def map_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(vocab_path)
        for batch in batches:
            maps = [tok.chunk_map(t) for t in batch.column(5).to_pylist()]
            head, inner, tail, follows = zip(*[(*m, None)[:4] for m in maps])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(j) for j in range(5)), pa.array(head, pa.string()), pa.array(inner, pa.int64()), pa.array(tail, pa.string()), pa.array(follows, pa.string())],
                [*names[:5], "head", "inner", "tail", "follows"],
            )

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(vocab_path)
        uid, row, part, maps, total = None, None, 0, [], 0

        def finished() -> pa.RecordBatch:
            count = total + tok.apply(tok.scan(maps)) + part  # a special token before each part but the first
            return pa.RecordBatch.from_arrays([*row, pa.array([count], pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

        for batch in batches:
            for i in range(batch.num_rows):
                u, p, head, inner, tail, follows = (batch.column(j)[i].as_py() for j in (0, 3, 5, 6, 7, 8))
                if u != uid:
                    if uid is not None:
                        yield finished()
                    uid, row, part, maps, total = u, [batch.column(1).slice(i, 1), batch.column(2).slice(i, 1)], 0, [], 0
                elif p != part:
                    total, part, maps = total + tok.apply(tok.scan(maps)), p, []
                maps.append((head, inner, tail) if follows is None else (head, inner, tail, follows))
                if len(maps) == 64:  # so that the maps of a text without end stay few
                    maps = [tok.scan(maps)]
        if uid is not None:
            yield finished()

    chunk = f"uid long, doc_id {id_type}, n_bytes long, part int, chunk int"
    chunks = map_arrow(rows, cut, f"{chunk}, text string").repartition("uid", "part", "chunk")
    maps = map_arrow(chunks, map_chunks, f"{chunk}, head string, inner long, tail string, follows string")
    ordered = maps.repartition("uid").sortWithinPartitions("uid", "part", "chunk")
    return map_arrow(ordered, compose, f"doc_id {id_type}, n_bytes long, n_tokens long")
