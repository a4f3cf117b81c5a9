"""Repeated passages by relative Lempel-Ziv parsing against all documents.

Every document is both text and reference.  A document is factored greedily
from left to right; a factor is a longest run of words that are covered by
windows which occur elsewhere, and the factors are its duplicate spans.

The reference is indexed by blocks instead of positions.  Each window of
``window`` words is assigned to its smallest k-gram hash, and consecutive
windows with the same smallest k-gram form a block (window + a few words
long).  Blocks are cut by content, so equal passages give equal blocks
wherever they start, and a block that occurs anywhere else puts all its
windows into a factor at once.  At a factor's boundary - where a passage
begins or ends - the blocks differ although they share their k-gram: there
the factor is checked window by window.  Equal windows share their smallest
k-gram, so they lie in equal blocks or in differing blocks of one k-gram, and
the two steps together are exact.  Unlike a parse with a suffix structure,
which no task could hold for all documents, the windows of one factor may
occur in different places; the result only asks whether they do.

Steps, all linear in the input:

1. blocks of all documents (map), equal blocks of one task combined there,
   so a passage that a third of all documents share sends one row per task;
2. blocks meet by k-gram; a sorted stream finds repeated blocks and the
   k-grams whose blocks differ, holding one row at a time; a k-gram with
   several blocks in one task (the edge of a frequent passage) is known to
   differ already, so its blocks are dealt by k-gram and block together;
3. windows of the differing blocks meet the same way;
4. spans are joined back by document, joined to factors, and the words removed.

Blocks and windows are equal when the 128-bit BLAKE2b digests of their words
are: a cryptographic hash of the words themselves, joined by single spaces.
The k-gram hashes only decide which blocks meet.

Defined cases: NULL and empty texts have no words and keep nothing; a text
with fewer words than a window is kept whole; documents repeated with the
same id and text are occurrences of each other; documents that share an id
but not the text stay apart; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridplace.llm.common import map_arrow, materialize, row_key, text_slices

GRAM = 8
SLICE_CHARS = 1 << 20
BLOCK_BYTES = 1 << 20
#: Rows a task combines before it hands them on.
COMBINE_ROWS = 1 << 20
#: Kinds of rows.  p is what rows meet by, (q, r) the digest they are compared
#: by.  A p with several digests in one task is crowded there: its rows are
#: MULTI and dealt by p and q together, and a CROWD row tells p's other rows.
SPAN, BLOCK, BOUNDARY, MULTI, CROWD = range(5)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads all bits of a 64-bit value."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of an odd base modulo 2^64 and of its inverse."""

    def __init__(self, base: int) -> None:
        self.base = base
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            for name, b in (("up", self.base), ("down", pow(self.base, -1, 1 << 64))):
                step = np.full(size, b, np.uint64)
                step[0] = 1
                setattr(self, name, np.cumprod(step, dtype=np.uint64))
        return self.up[:n], self.down[:n]

    def sums(self, values: np.ndarray) -> np.ndarray:
        up, _ = self.upto(len(values) + 1)
        return np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * up[: len(values)], dtype=np.uint64)))

    def parts(self, sums: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of values[first:end], independent of the position."""
        _, down = self.upto(len(sums))
        return mix((sums[end] - sums[first]) * down[first])


@cache
def tables() -> tuple[np.ndarray, np.ndarray, Powers, Powers]:
    white = np.zeros(256, bool)
    white[[9, 10, 11, 12, 13, 32]] = True
    letters = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return white, letters, Powers(0xD1342543DE82EF95), Powers(0xAF251AF3B0F025B5)


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start offsets and hashes of the words of a buffer."""
    white, letters, base, _ = tables()
    all_bytes = np.frombuffer(data, np.uint8)
    starts, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    at = 0
    while at < len(all_bytes):
        end = min(at + BLOCK_BYTES, len(all_bytes))
        while end < len(all_bytes) and not white[all_bytes[end]]:  # cut between words
            step = white[all_bytes[end : end + 4096]]
            end += int(step.argmax()) if step.any() else len(step)
        part = all_bytes[at:end]
        gap = np.concatenate(([True], white[part], [True]))
        first = np.flatnonzero(gap[:-1] & ~gap[1:])
        last = np.flatnonzero(~gap[:-1] & gap[1:])
        # a gap flag at i belongs to the byte before i
        hashes.append(base.parts(base.sums(letters[part]), first, last))
        starts.append(first + at)
        at = end
    return np.concatenate(starts), np.concatenate(hashes)


class Words:
    """The words of several texts in a row: their hashes, the first word of
    each text, and digests of any of their runs."""

    def __init__(self, texts: list[str]) -> None:
        coded = [t.encode("utf-8", "surrogatepass") for t in texts]
        data = b"\n".join(coded)
        starts, self.hashes = word_hashes(data)
        self.begin = np.searchsorted(starts, np.concatenate(([0], np.cumsum([len(c) + 1 for c in coded]))))
        words = data.split()
        self.spaced = b" ".join(words)
        self.end = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)  # one behind each word

    def digests(self, first: np.ndarray, count: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
        """Both halves of the digest of ``count`` words from ``first``."""
        spaced, blake = self.spaced, hashlib.blake2b
        last = self.end[first + count - 1] - 1
        from_ = np.where(first > 0, self.end[first - 1], 0)
        found = b"".join([blake(spaced[a:b], digest_size=16).digest() for a, b in zip(from_.tolist(), last.tolist())])
        halves = np.frombuffer(found, np.uint64).reshape(-1, 2)
        return halves[:, 0].copy(), halves[:, 1].copy()


def blocks_of(texts: list[str], window: int) -> tuple[np.ndarray, ...]:
    """gram hash, digest (two halves), text number, first window and number of
    windows of each block."""
    _, _, _, one = tables()
    words = Words(texts)
    begin = words.begin
    gram = min(GRAM, window)
    n = len(words.hashes)
    none = np.zeros(0, np.uint64)
    if n < window:
        return none, none, none, *(np.zeros(0, np.int64) for _ in range(3))
    sums = one.sums(words.hashes)
    index = np.arange(n - gram + 1)
    grams = one.parts(sums, index, index + gram)
    wide = window - gram + 1
    anchor = sliding_window_view(grams, wide).argmin(axis=1) + np.arange(n - window + 1)
    text = np.searchsorted(begin, np.arange(n - window + 1), "right") - 1
    whole = np.arange(n - window + 1) + window <= begin[text + 1]
    at = np.flatnonzero(whole)
    if not len(at):
        return none, none, none, *(np.zeros(0, np.int64) for _ in range(3))
    new = np.ones(len(at), bool)
    new[1:] = (anchor[at[1:]] != anchor[at[:-1]]) | (at[1:] != at[:-1] + 1) | (text[at[1:]] != text[at[:-1]])
    first = at[new]
    size = np.diff(np.append(np.flatnonzero(new), len(at)))
    return grams[anchor[first]], *words.digests(first, size + window - 1), text[first], first - begin[text[first]], size


def windows_of(text: str, spans: list[tuple[int, int, bool]], window: int) -> tuple[np.ndarray, ...]:
    """Digest (two halves), place and settled flag of each window in the spans."""
    at = np.concatenate([np.arange(s, s + n) for s, n, _ in spans])
    settled = np.repeat([x[2] for x in spans], [x[1] for x in spans])
    return *Words([text]).digests(at, window), at, settled


def schema(id_type: str) -> str:
    return f"kind byte, p long, q long, r long, doc_id {id_type}, key long, at int, n int, settled boolean"


NAMES = ["kind", "p", "q", "r", "doc_id", "key", "at", "n", "settled"]


def rows(kind, p, q, r, doc_id, key, at, n, settled) -> pa.RecordBatch:
    size = len(at)
    cols = [
        pa.array(np.full(size, kind, np.int8)), *(pa.array(np.asarray(x).view(np.int64)) for x in (p, q, r)), doc_id,
        pa.array(np.asarray(key, np.int64)), pa.array(np.asarray(at, np.int32)), pa.array(np.asarray(n, np.int32)), pa.array(np.asarray(settled, bool)),
    ]
    return pa.RecordBatch.from_arrays(cols, NAMES)


class Combiner:
    """Rows of one task, equal (p, q, r) settled where they lie: all but the
    first become spans, the first goes on for the other tasks."""

    def __init__(self) -> None:
        self.parts: list[tuple] = []
        self.size = 0

    def add(self, p, q, r, ids, key, at, n, settled) -> Iterator[pa.RecordBatch]:
        if len(at):
            self.parts.append((p, q, r, ids, key, at, n, settled))
            self.size += len(at)
        if self.size >= COMBINE_ROWS:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.parts:
            return
        p, q, r, key, at, n, settled = (np.concatenate([x[i] for x in self.parts]) for i in (0, 1, 2, 4, 5, 6, 7))
        ids = pa.concat_arrays([x[3] for x in self.parts])
        self.parts, self.size = [], 0
        order = np.lexsort((r, q, p))
        same = (p[order][1:] == p[order][:-1]) & (q[order][1:] == q[order][:-1]) & (r[order][1:] == r[order][:-1])
        later = np.concatenate(([False], same))
        double = later | np.concatenate((same, [False]))
        spans = order[double & ~settled[order]]
        if len(spans):
            # copies of one text share its key, so spans are dealt by their place here
            deal = mix(key[spans].view(np.uint64) + np.arange(len(spans), dtype=np.uint64))
            zero = np.zeros(len(spans), np.int64)
            yield rows(SPAN, deal, zero, zero, ids.take(pa.array(spans)), key[spans], at[spans], n[spans], np.ones(len(spans), bool))
        on = order[~later]
        flags = settled[on] | double[~later]
        same_p = p[on][1:] == p[on][:-1]
        crowded = np.concatenate(([False], same_p)) | np.concatenate((same_p, [False]))
        for kind, pick in ((BLOCK, ~crowded), (MULTI, crowded)):
            i = on[pick]
            if len(i):
                deal = p[i] if kind == BLOCK else spread(p[i], q[i])
                yield rows(kind, deal, q[i], r[i], ids.take(pa.array(i)), key[i], at[i], n[i], flags[pick])
        crowds = np.unique(p[on][crowded])
        if len(crowds):
            zero = np.zeros(len(crowds), np.int64)
            yield rows(CROWD, crowds, np.full(len(crowds), np.iinfo(np.int64).min), zero, pa.nulls(len(crowds), ids.type), zero, zero, zero, zero)


def spread(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Where rows of a crowded p are dealt to: by p and q together."""
    return mix(p ^ (q * np.uint64(0x9E3779B97F4A7C15)))


def settler(kind: int):
    """Rows sorted by (p, q, r) -> spans and boundaries; other kinds pass.

    BLOCK: rows whose (p, q, r) occurs twice become spans; of a p with several
    digests, one row of each is a boundary; rows of a p that is crowded in some
    task (its CROWD row sorts first) go on as MULTI.  MULTI: p is known to have
    several digests, so one row of each is a boundary.  One row is held back,
    so equal rows without end need no memory.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None
        before: tuple | None = None  # of the row before the held one: p, q, r, is its digest the first of its p, is p crowded
        for batch in _with_end(batches):
            last = batch is None
            if last and held is None:
                return
            if last:
                table = held
            else:
                table = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            size = table.num_rows
            ready = size if last else size - 1
            if ready:
                kinds = table.column(0).to_numpy()
                p, q, r = (table.column(i).to_numpy() for i in (1, 2, 3))
                settled = table.column(8).to_numpy(zero_copy_only=False)
                mine = kinds == kind
                same_p = np.empty(size, bool)
                same_p[0] = before is not None and p[0] == before[0]
                same_p[1:] = p[1:] == p[:-1]
                same = same_p.copy()
                same[0] = same_p[0] and q[0] == before[1] and r[0] == before[2]
                same[1:] &= (q[1:] == q[:-1]) & (r[1:] == r[:-1])
                next_p, next_same = np.append(same_p[1:], False), np.append(same[1:], False)

                def from_start(start: np.ndarray, value: np.ndarray, carried: bool) -> np.ndarray:
                    """The value at the start of each row's run."""
                    run = np.cumsum(start) - 1
                    at = np.flatnonzero(start)
                    return np.where(run >= 0, value[at[np.maximum(run, 0)]] if len(at) else carried, carried)

                first = from_start(~same, ~same_p, before[3] if before else True)
                crowded = from_start(~same_p, kinds == CROWD, before[4] if before else False)
                double = same | next_same
                if kind == MULTI:
                    edge = mine & ~next_same
                    onward = np.zeros(size, bool)
                else:
                    edge = mine & ~crowded & ~next_same & (next_p | ~first)
                    onward = mine & crowded
                span = (kinds == SPAN) | (mine & ~onward & double & ~settled)
                onward |= (kinds == MULTI) & ~mine

                def out(what: int, pick: np.ndarray, flags: np.ndarray, hashes: bool = False) -> Iterator[pa.RecordBatch]:
                    at = np.flatnonzero(pick[:ready])
                    if len(at):
                        t = table.take(pa.array(at))
                        u, v = p[at].view(np.uint64), q[at].view(np.uint64)
                        u = np.where(kinds[at] == MULTI, u, spread(u, v)) if hashes else np.zeros(len(at), np.uint64)
                        yield rows(what, u, v, r[at], t.column(4), t.column(5).to_numpy(), t.column(6).to_numpy(), t.column(7).to_numpy(), flags[at])

                yield from out(SPAN, span, np.ones(size, bool))
                yield from out(BOUNDARY, edge, double | settled)
                yield from out(MULTI, onward, settled, hashes=True)
                before = (p[ready - 1], q[ready - 1], r[ready - 1], bool(first[ready - 1]), bool(crowded[ready - 1]))
            held = None if last else table.slice(ready)
            if last:
                return

    return run


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    for b in batches:
        if b.num_rows:
            yield b
    yield None


def meet(found: DataFrame, id_type: str, kind: int = BLOCK) -> DataFrame:
    """Deal rows by p and settle equal ones.  Spans only travel along."""
    return map_arrow(found.repartition("p").sortWithinPartitions("p", "q", "r"), settler(kind), schema(id_type))


def repeated_spans(docs: DataFrame, window: int, id_type: str) -> DataFrame:
    """doc_id, key, at, n: runs of n windows from word ``at`` that also occur
    elsewhere.  ``docs``: doc_id, key, text."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        combine = Combiner()
        for batch in batches:
            keys = batch.column(1).to_numpy()
            for a, texts in text_slices(batch.column(2), SLICE_CHARS):
                gram, q, r, text, at, n = blocks_of(texts, window)
                who = text + a
                yield from combine.add(gram, q, r, batch.column(0).take(pa.array(who)), keys[who], at, n, np.zeros(len(at), bool))
        yield from combine.flush()

    first = materialize(meet(map_arrow(docs, find, schema(id_type)), id_type), "repeated_blocks")
    crowded = materialize(meet(first.filter(F.col("kind") == MULTI), id_type, MULTI), "crowded_blocks")
    first = first.unionByName(crowded)
    edges = first.filter(F.col("kind") == BOUNDARY).groupBy("doc_id", "key").agg(F.collect_list(F.struct("at", "n", "settled")).alias("spans"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        combine = Combiner()
        for batch in batches:
            for i in range(batch.num_rows):
                spans = [(s["at"], s["n"], s["settled"]) for s in batch.column(3)[i].as_py()]
                p, q, at, settled = windows_of(batch.column(2)[i].as_py() or "", spans, window)
                who = pa.array(np.full(len(at), i))
                yield from combine.add(p, q, np.zeros(len(at), np.uint64), batch.column(0).take(who), np.full(len(at), batch.column(1)[i].as_py()), at, np.ones(len(at), np.int64), settled)
        yield from combine.flush()

    second = meet(map_arrow(with_rows(docs, edges, "inner"), compare, schema(id_type)), id_type)
    spans = first.filter(F.col("kind") == SPAN).select("doc_id", "key", "at", "n")
    return spans.unionByName(second.filter(F.col("kind") == SPAN).select("doc_id", "key", "at", "n"))


def with_rows(docs: DataFrame, spans: DataFrame, how: str) -> DataFrame:
    """Documents with their spans: the spans are hashed, texts are not sorted."""
    s = spans.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), "spans").hint("shuffle_hash")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key"))
    return docs.join(s, same, how).select("doc_id", "key", "text", "spans")


def greedy_factors(at: np.ndarray, n: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and number of words of the factors of runs of n windows at
    ``at``: from left to right, each run goes on as long as the next window
    overlaps it or follows it."""
    order = np.argsort(at, kind="stable")
    first, end = at[order].astype(np.int64), np.maximum.accumulate((at + n)[order].astype(np.int64) + window - 1)
    new = np.ones(len(first), bool)
    new[1:] = first[1:] > end[:-1]
    begin = np.flatnonzero(new)
    last = np.append(begin[1:], len(first))[: len(begin)] - 1
    return first[begin], end[last] - first[begin]


def substring_dedup(docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256 and, with
    ``with_text``, kept (the words left, joined by one space) and factors
    (first word and number of words of each duplicate span)."""
    base = docs.select(F.col(id_col).alias("doc_id"), row_key(text_col).alias("key"), F.col(text_col).alias("text"))
    id_type = base.schema["doc_id"].dataType.simpleString()
    spans = repeated_spans(base, window, id_type).groupBy("doc_id", "key").agg(F.collect_list(F.struct("at", "n")).alias("spans"))
    names = ["doc_id", "n_words", "n_removed", "kept_sha256"] + ["kept", "factors"] * with_text
    factor_type = pa.list_(pa.struct([("at", pa.int64()), ("n", pa.int64())]))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                out = []
                part = batch.slice(a, 256)
                for text, spans in zip(part.column(2), part.column(3)):
                    words = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
                    n = len(words)
                    factors: list[tuple[int, int]] = []
                    if spans.is_valid:
                        first, count = greedy_factors(spans.values.field("at").to_numpy(), spans.values.field("n").to_numpy(), window)
                        factors = list(zip(first.tolist(), count.tolist()))
                        edges = [0, *(x for at, k in factors for x in (at, at + k)), n]
                        words = [w for a_, b_ in zip(edges[::2], edges[1::2]) for w in words[a_:b_]]
                    kept = b" ".join(words)
                    shown = (kept.decode("utf-8", "replace"), [{"at": at, "n": k} for at, k in factors]) if with_text else (None, None)
                    out.append((n, n - len(words), hashlib.sha256(kept).hexdigest(), *shown))
                n, removed, digest, kept, factors = zip(*out)
                cols = [part.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest, pa.string())]
                yield pa.RecordBatch.from_arrays(cols + [pa.array(kept, pa.string()), pa.array(factors, factor_type)] * with_text, names)

    more = ", kept string, factors array<struct<at: long, n: long>>" if with_text else ""
    return map_arrow(with_rows(base, spans, "left"), remove, f"doc_id {id_type}, n_words long, n_removed long, kept_sha256 string" + more)
