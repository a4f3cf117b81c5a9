"""Cross-tokenizer alignment by galloping intersection of token ends.

Two tokenizers cut the same bytes.  The sorted ends of the shorter token list
drive an exponential and then a binary search into the longer list; all ends
of a slice of documents search at once, each from the place that its own rank
suggests.  The rank found tells how many longer-list tokens end before; equal
ends are common and cut both lists into groups; and the difference of two
neighbouring ranks is the range of longer-list tokens that overlap one
shorter-list token, so links are never searched for.

Corpus-wide counts: each document lists its linked id pairs once, with how
often it holds them (written once as a table).  Counts of documents per pair
combine on the map side.  The ``hot_pairs`` most frequent pairs, a bounded
table, are broadcast, so the pairs that nearly every document holds are summed
where they lie; the remaining pairs meet their counts by a shuffle.

Tokenizer A is a byte-level BPE vocabulary: new words are encoded by a library
that merges by rank of the merged bytes, and checked pair by pair against the
vocabulary's own merge rules (a word that fails goes through the trie codec).
B is a sentencepiece BPE model without merges across spaces, whose words are
encoded by its library.  Both remember words up to a bound.

Defined cases: NULL and empty texts, and texts whose joined token bytes are
not a space and the text in both tokenizers, have no tokens: zeros and an
empty string; special tokens inside texts are plain text; rows are
independent, so repeated rows each count as a document and NULL ids and other
columns are harmless; a very long text is a slice of its own; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridplace.llm.bpe_codec import Codec, ranges
from gridplace.llm.common import map_arrow, materialize, text_slices

SLICE_BYTES = 1 << 20
MEMO_WORDS, MEMO_IDS = 200_000, 1 << 22
#: Longer words are not remembered.
MEMO_CHARS = 64
#: Most frequent pairs that are broadcast, 17 bytes each.
HOT_PAIRS = 1 << 16
SPACE_MARK = "▁"


class WordCodec(Codec):
    """The codec of a byte-level vocabulary with faster first encounters.

    A token sequence is an encoding exactly when each adjacent pair is
    (``bpe_pairs``), so an answer of the ranking library is checked by its
    pairs, of which there are far fewer than words."""

    def __init__(self, path: str) -> None:
        import tiktoken

        super().__init__(path)
        merged = sorted((rank, token) for token, (rank, _, _) in self.vocab.halves.items())
        ranks = {bytes((b,)): b for b in range(256)} | {self.vocab.bytes_of[token]: 256 + k for k, (_, token) in enumerate(merged)}
        self.ranked = tiktoken.Encoding("ranks", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        self.id_of_rank = np.zeros(len(ranks), np.int64)
        for data, rank in ranks.items():
            self.id_of_rank[rank] = self.vocab.ids[data]
        self.good = np.zeros(0, np.int64)  # pairs known to stand, sorted

    def _standing(self, pairs: np.ndarray) -> np.ndarray:
        """Which of the pairs (left << 32 | right) may stand side by side."""
        at = np.searchsorted(self.good, pairs)
        known = np.zeros(len(pairs), bool)
        inside = at < len(self.good)
        known[inside] = self.good[at[inside]] == pairs[inside]
        new = np.unique(pairs[~known])
        if len(new):
            may = self.vocab.may_follow
            fine = new[[may(int(p >> 32), int(p & 0xFFFFFFFF)) for p in new]]
            if len(self.good) > MEMO_IDS:
                self.good = np.zeros(0, np.int64)
            self.good = np.union1d(self.good, fine)
            known |= np.isin(pairs, fine)
        return known

    def _add(self, words: list[str]) -> None:
        encode = self.ranked.encode_ordinary
        coded = [encode(w) for w in words]
        sizes = np.fromiter(map(len, coded), np.int64, len(coded))
        flat = self.id_of_rank[np.fromiter((i for c in coded for i in c), np.int64, int(sizes.sum()))]
        ends = np.cumsum(sizes)
        within = np.ones(max(0, len(flat) - 1), bool)
        within[ends[:-1] - 1] = False
        stands = np.ones(len(within), bool)
        stands[within] = self._standing((flat[:-1] << 32 | flat[1:])[within])
        if not stands.all():  # the library's rule differs there
            bad = set(np.searchsorted(ends, np.flatnonzero(~stands), "right").tolist())
            keep = [i for i in range(len(words)) if i not in bad]
            super()._add([words[i] for i in sorted(bad)])
            if keep:
                self._add([words[i] for i in keep])
            return
        known, need = len(self.memo), self.used + len(flat)
        if need > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros(max(len(self.ids), need), np.uint32)))
        if known + len(words) + 1 > len(self.offsets):
            self.offsets = np.concatenate((self.offsets, np.zeros(max(len(self.offsets), len(words) + 1), np.int64)))
        self.ids[self.used : need] = flat
        self.offsets[known + 1 : known + 1 + len(words)] = self.used + ends
        self.memo.update(zip(words, range(known, known + len(words))))
        self.used = need


class Pieces:
    """Ids of a sentencepiece BPE model, and the bytes of each id."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(SPACE_MARK in name.lstrip(SPACE_MARK) or "\n" in name for name in names):
            raise ValueError("pieces must not span spaces or line ends")
        self.bytes_of = [
            bytes((int(name[1:-1], 16),)) if self.model.is_byte(i) else name.replace(SPACE_MARK, " ").encode() for i, name in enumerate(names)
        ]
        self.mark = self.model.piece_to_id(SPACE_MARK)
        self.cut = re.compile(r" +[^ \n]*|\n[^ \n]*")
        self._forget()

    def _forget(self) -> None:
        self.memo: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.offsets = np.zeros(1 << 16, np.int64)
        self.used = self.count = 0

    def _encode(self, words: list[str]) -> list[list[int]]:
        """The library puts a space before each word: it stands for the word's
        own first space, and is taken off again before a line end."""
        coded = self.model.encode([w[1:] if w[0] == " " else w for w in words], num_threads=1)
        return [c or [self.mark] if w[0] == " " else c[1:] for w, c in zip(words, coded)]

    def _add(self, words: list[str]) -> None:
        coded = self._encode(words)
        sizes = np.fromiter(map(len, coded), np.int64, len(coded))
        flat = np.fromiter((i for c in coded for i in c), np.uint32, int(sizes.sum()))
        known, need = self.count, self.used + len(flat)
        if need > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros(max(len(self.ids), need), np.uint32)))
        if known + len(words) + 1 > len(self.offsets):
            self.offsets = np.concatenate((self.offsets, np.zeros(max(len(self.offsets), len(words) + 1), np.int64)))
        self.ids[self.used : need] = flat
        self.offsets[known + 1 : known + 1 + len(words)] = self.used + np.cumsum(sizes)
        self.memo.update(zip(words, range(known, known + len(words))))
        self.used, self.count = need, known + len(words)

    def encode_spaced(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts that each begin with a space, and how many each has."""
        words: list[str] = []
        counts = []
        for t in texts:
            found = self.cut.findall(t)
            counts.append(len(found))
            words += found
        if self.count > MEMO_WORDS or self.used > MEMO_IDS:
            self._forget()
        new = set(words).difference(self.memo)
        if new:
            self._add(list(new))
        which = np.fromiter(map(self.memo.__getitem__, words), np.int64, len(words))
        sizes = self.offsets[which + 1] - self.offsets[which]
        ids = self.ids[ranges(self.offsets[which], sizes)]
        total = np.concatenate(([0], np.cumsum(sizes)))
        ends = np.cumsum(np.array(counts, np.int64))
        per_text = total[ends] - total[ends - np.array(counts, np.int64)]
        for w in new:
            if len(w) > MEMO_CHARS:
                del self.memo[w]
        return ids, per_text


class Strings:
    """Byte strings by number, gathered in one go."""

    def __init__(self, parts: list[bytes]) -> None:
        self.size = np.fromiter(map(len, parts), np.int64, len(parts))
        self.at = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(parts), np.uint8)

    def joined(self, numbers: np.ndarray) -> bytes:
        return self.data[ranges(self.at[numbers], self.size[numbers])].tobytes()


def gallop(short: np.ndarray, long: np.ndarray, start: np.ndarray | None = None) -> np.ndarray:
    """How many of ``long`` are less than each of ``short``, both sorted.

    Each search starts at ``start``, by default its rank's share of the longer
    list, doubles its step until it has passed its value, and halves the
    bracket."""
    n = len(long)
    if not n:
        return np.zeros(len(short), np.int64)
    start = np.arange(len(short)) * n // max(1, len(short)) if start is None else np.minimum(start, n - 1)
    upward = long[start] < short
    low, high = np.where(upward, start, -1), np.where(upward, n, start)  # long[low] < value <= long[high]
    todo, step = np.arange(len(short)), 1
    while len(todo):
        up = upward[todo]
        probe = np.where(up, low[todo] + step, high[todo] - step)
        inside = (probe >= 0) & (probe < n)
        todo, up, probe = todo[inside], up[inside], probe[inside]
        less = long[probe] < short[todo]
        low[todo[less]] = probe[less]
        high[todo[~less]] = probe[~less]
        todo = todo[less == up]
        step *= 2
    todo = np.flatnonzero(high - low > 1)
    while len(todo):
        middle = (low[todo] + high[todo]) // 2
        less = long[middle] < short[todo]
        low[todo[less]] = middle[less]
        high[todo[~less]] = middle[~less]
        todo = todo[high[todo] - low[todo] > 1]
    return high


def shares(n_short: np.ndarray, n_long: np.ndarray) -> np.ndarray:
    """Where each token of the shorter lists should be in the longer lists, if
    every text's tokens are spread evenly."""
    first_short, first_long = np.cumsum(n_short) - n_short, np.cumsum(n_long) - n_long
    rank = np.arange(int(n_short.sum())) - np.repeat(first_short, n_short)
    return np.repeat(first_long, n_short) + (rank * np.repeat(n_long / np.maximum(n_short, 1), n_short)).astype(np.int64)


def overlaps(
    ends_a: np.ndarray, ends_b: np.ndarray, n_a: np.ndarray | None = None, n_b: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Common flags of the tokens of A and of B, and the places of all token
    pairs whose byte ranges overlap.  Both lists begin at the same byte and
    end at the same byte.  ``n_a``, ``n_b``: tokens of the texts laid end to
    end."""
    swap = len(ends_b) < len(ends_a)
    short, long = (ends_b, ends_a) if swap else (ends_a, ends_b)
    start = None if n_a is None else shares(n_b, n_a) if swap else shares(n_a, n_b)
    rank = gallop(short, long, start)
    equal = np.zeros(len(short), bool)
    equal[rank < len(long)] = long[rank[rank < len(long)]] == short[rank < len(long)]
    common = np.zeros(len(long), bool)
    common[rank[equal]] = True
    first = np.zeros(len(short), np.int64)
    first[1:] = rank[:-1] + equal[:-1]
    met = rank - first + 1
    mine, other = np.repeat(np.arange(len(short)), met), ranges(first, met)
    return (common, equal, other, mine) if swap else (equal, common, mine, other)


class Aligner:
    def __init__(self, path_a: str, path_b: str) -> None:
        self.a, self.b = WordCodec(path_a), Pieces(path_b)
        bytes_a = self.a.vocab.bytes_of
        self.bytes_a = Strings([bytes_a.get(i, b"") for i in range(max(bytes_a) + 1)])
        self.bytes_b = Strings(self.b.bytes_of)
        self.width = len(self.b.bytes_of)
        # a token's number followed by what stands after it: the same side again, or the end of its side
        self.shown_a = Strings([b"%d%s" % (i, end) for i in range(len(self.bytes_a.size)) for end in (b",", b"|")])
        self.shown_b = Strings([b"%d%s" % (i, end) for i in range(self.width) for end in (b",", b";")])
        self.shown = np.concatenate((self.shown_a.data, self.shown_b.data))

    def tokens(self, texts: list[str]) -> tuple[np.ndarray, list[int], list[int], np.ndarray, np.ndarray]:
        """Places of the texts that both tokenizers keep whole, the numbers of
        their tokens, and all their ids."""
        at = [i for i, t in enumerate(texts) if t and SPACE_MARK not in t]
        spaced = [" " + texts[i] for i in at]
        a, n_a = self.a.encode_pieces(spaced) if at else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
        b, n_b = self.b.encode_spaced(spaced) if at else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
        plain = "".join(spaced).encode("utf-8", "surrogatepass")
        if self.bytes_a.joined(a) != plain or self.bytes_b.joined(b) != plain:  # one at a time
            end_a, end_b = np.cumsum(n_a), np.cumsum(n_b)
            whole = np.array([
                self.bytes_a.joined(a[e - k : e]) == self.bytes_b.joined(b[f - m : f]) == t.encode("utf-8", "surrogatepass")
                for t, k, e, m, f in zip(spaced, n_a, end_a, n_b, end_b)
            ], bool)
            a, b = a[np.repeat(whole, n_a)], b[np.repeat(whole, n_b)]
            at, n_a, n_b = np.array(at)[whole], n_a[whole], n_b[whole]
        return np.array(at, np.int64), n_a, n_b, a.astype(np.int64), b.astype(np.int64)

    def align(self, texts: list[str]) -> list[tuple]:
        """Per text: n_a, n_b, n_groups, n_links, groups, pairs, times."""
        out = [(0, 0, 0, 0, b"", np.zeros(0, np.int64), np.zeros(0, np.int32))] * len(texts)
        at, n_a, n_b, a, b = self.tokens(texts)
        if not len(at):
            return out
        common_a, common_b, link_a, link_b = overlaps(np.cumsum(self.bytes_a.size[a]), np.cumsum(self.bytes_b.size[b]), n_a, n_b)
        # groups as text: each token goes behind the tokens of both sides that stand before it
        group_a, group_b = np.cumsum(common_a) - common_a, np.cumsum(common_b) - common_b
        n_groups = int(common_a.sum())
        before_b = np.concatenate(([0], np.cumsum(np.bincount(group_b, minlength=n_groups))))
        before_a = np.concatenate(([0], np.cumsum(np.bincount(group_a, minlength=n_groups))))
        place_a, place_b = np.arange(len(a)) + before_b[group_a], np.arange(len(b)) + before_a[group_b + 1]
        size, start = np.empty(len(a) + len(b), np.int64), np.empty(len(a) + len(b), np.int64)
        for place, shown, base, number in ((place_a, self.shown_a, 0, 2 * a + common_a), (place_b, self.shown_b, len(self.shown_a.data), 2 * b + common_b)):
            size[place], start[place] = shown.size[number], shown.at[number] + base
        text = self.shown[ranges(start, size)].tobytes()
        end_a, end_b = np.cumsum(n_a), np.cumsum(n_b)
        text_end = np.cumsum(size)[end_a + end_b - 1]
        doc = np.searchsorted(end_a, link_a, "right")
        n_links = np.bincount(doc, minlength=len(at))
        groups_end = np.cumsum(common_a)[end_a - 1]
        span = len(self.bytes_a.size) * self.width
        codes, times = np.unique(doc * span + a[link_a] * self.width + b[link_b], return_counts=True)
        cut = np.searchsorted(codes, np.arange(len(at) + 1) * span)
        codes %= span
        for k, i in enumerate(at.tolist()):
            groups = int(groups_end[k] - (groups_end[k - 1] if k else 0))
            shown = text[text_end[k - 1] if k else 0 : text_end[k] - 1]
            out[i] = (int(n_a[k]), int(n_b[k]), groups, int(n_links[k]), shown, codes[cut[k] : cut[k + 1]], times[cut[k] : cut[k + 1]].astype(np.int32))
        return out


@cache
def aligner(path_a: str, path_b: str) -> Aligner:
    """One pair of tokenizers per Python worker."""
    return Aligner(path_a, path_b)


def token_groups(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", with_groups: bool = False) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs
    (a * width + b of each linked id pair), times (how often each is linked)
    and, with ``with_groups``, groups (``a1,a2|b1;a3|b2``).  Map-only."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"] + ["groups"] * with_groups

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(path_a, path_b)
        for batch in batches:
            for first, texts in text_slices(batch.column(1), SLICE_BYTES):
                n_a, n_b, n_groups, n_links, shown, pairs, times = zip(*both.align(texts))
                digests = [hashlib.sha256(s).hexdigest() if n else "" for s, n in zip(shown, n_a)]
                offsets = pa.array(np.concatenate(([0], np.cumsum([len(p) for p in pairs]))).astype(np.int32))
                cols = [
                    batch.column(0).slice(first, len(texts)), *(pa.array(c, pa.int64()) for c in (n_a, n_b, n_groups, n_links)), pa.array(digests, pa.string()),
                    pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(pairs), pa.int64())), pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(times), pa.int32())),
                ]
                yield pa.RecordBatch.from_arrays(cols + [pa.array([s.decode() for s in shown], pa.string())] * with_groups, names)

    schema = f"doc_id {id_type}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>" + ", groups string" * with_groups
    return map_arrow(rows, run, schema)


def align_tokens(
    docs: DataFrame,
    path_a: str,
    path_b: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_groups: bool = False,
    hot_pairs: int = HOT_PAIRS,
) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best (links whose
    pair has the highest count of its A id), count_sum (counts summed over
    links), groups_sha256 and, with ``with_groups``, groups.

    A pair's count is the number of documents that hold it linked.  The model
    files must be readable on every executor.
    """
    found = materialize(token_groups(docs, path_a, path_b, id_col, text_col, with_groups).withColumn("uid", F.monotonically_increasing_id()), "token_groups")
    width = F.lit(piece_count(path_b))
    counts = materialize(found.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n")), "pair_counts")
    a_id = F.floor(F.col("pair") / width)
    highest = counts.groupBy(a_id.alias("a")).agg(F.max("n").alias("most"))
    rated = materialize(counts.withColumn("a", a_id).join(highest, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "rated_pairs")
    hot = materialize(rated.orderBy(F.desc("n"), "pair").limit(hot_pairs), "hot_pairs")
    links = found.select("uid", F.explode(F.arrays_zip("pairs", "times")).alias("link")).select("uid", F.col("link.pairs").alias("pair"), F.col("link.times").cast("long").alias("times"))
    marked = links.join(F.broadcast(hot), "pair", "left")  # at most hot_pairs rows
    sums = (F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    near = marked.filter(F.col("n").isNotNull()).groupBy("uid").agg(*sums)
    far = marked.filter(F.col("n").isNull()).select("uid", "pair", "times").join(rated, "pair").groupBy("uid").agg(*sums)
    per_doc = near.unionByName(far).groupBy("uid").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    kept = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
    return found.join(per_doc, "uid", "left").select(
        *kept, *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")], "groups_sha256", *["groups"] * with_groups
    )


def piece_count(path: str) -> int:
    """Number of ids of the sentencepiece model."""
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=path).get_piece_size()
