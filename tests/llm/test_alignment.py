"""Token alignment against the libraries and plain loops."""

import hashlib
import json
from collections import Counter

import numpy as np
import pytest

from gridplace.llm.queries import vocab_path
from gridplace.llm.token_alignment import Aligner, align_tokens, gallop, overlaps

from .rows import by_id, frame, hard_rows

A, B = vocab_path(), vocab_path("piece_bpe_32k.model")
ODD = ["ﬁ①Ａ é", "a\x00b​　z", "<s>hi</s> <0x41> <|endoftext|>", "a\tb\r\n\n c", "▁x", "a ▁ b", "  two  spaces ", "\n", "\n\nx", " ", "trailing ", "😀🏽 é", "don't I'll"]


@pytest.fixture(scope="module")
def libraries():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    a.no_truncation()
    a.no_padding()
    alphabet = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    chars = {chr(x): x for x in alphabet} | {chr(256 + n): x for n, x in enumerate(x for x in range(256) if x not in alphabet)}
    with open(A, encoding="utf-8") as f:
        names = {v: k for k, v in json.load(f)["model"]["vocab"].items()}
    return a, SentencePieceProcessor(model_file=B), lambda i: bytes(chars[c] for c in names[i])


def plain(rows, libraries):
    a, b, bytes_a = libraries
    docs = []
    for doc_id, text in rows:
        if not text:
            docs.append((doc_id, [], [], [], []))
            continue
        ia, ib = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        ta = [bytes_a(i) for i in ia]
        tb = [bytes((int(b.id_to_piece(i)[1:-1], 16),)) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ib]
        if b"".join(ta) != (" " + text).encode() or b"".join(tb) != (" " + text).encode():
            docs.append((doc_id, [], [], [], []))
            continue
        ea, eb = np.cumsum([len(t) for t in ta]).tolist(), np.cumsum([len(t) for t in tb]).tolist()
        groups, links, i, j = [], [], 0, 0
        for end in sorted(set(ea) & set(eb)):
            p, q = ea.index(end, i) + 1, eb.index(end, j) + 1
            groups.append(",".join(map(str, ia[i:p])) + "|" + ",".join(map(str, ib[j:q])))
            for x in range(i, p):
                for y in range(j, q):
                    if max(ea[x] - len(ta[x]), eb[y] - len(tb[y])) < min(ea[x], eb[y]):
                        links.append((ia[x], ib[y]))
            i, j = p, q
        docs.append((doc_id, ia, ib, groups, links))
    counts = Counter(pair for d in docs for pair in set(d[4]))
    highest = {}
    for (x, _), n in counts.items():
        highest[x] = max(n, highest.get(x, 0))
    return [
        (doc_id, len(ia), len(ib), len(groups), len(links), sum(counts[p] == highest[p[0]] for p in links), sum(counts[p] for p in links),
         hashlib.sha256(";".join(groups).encode()).hexdigest() if ia else "")
        for doc_id, ia, ib, groups, links in docs
    ]


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("hot_pairs", [1 << 16, 5])
def test_equals_libraries(spark, libraries, hot_pairs):
    rows = [r for r in hard_rows() if r[0] not in (300, 301, 302)] + [(500 + i, t) for i, t in enumerate(ODD)] + [(600, "long words " + "z" * 3000 + " x" * 2000)]
    got = align_tokens(frame(spark, rows), A, B, hot_pairs=hot_pairs, with_groups=True)
    assert got.columns == [*COLUMNS, "groups"]
    found = got.collect()
    assert by_id(tuple(r)[:-1] for r in found) == by_id(plain(rows, libraries))
    assert all(hashlib.sha256(r.groups.encode()).hexdigest() == r.groups_sha256 for r in found if r.n_a)


def test_empty_table(spark):
    assert align_tokens(spark.createDataFrame([], "doc_id long, text string"), A, B).collect() == []


def test_piece_ids_equal_the_library(spark, libraries):
    """Words encoded one by one are the library's encoding of the whole text."""
    texts = [r[0] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect() if r[0]] + [t for t in ODD if "▁" not in t]
    both = Aligner(A, B)
    for _ in range(2):  # remembered words too
        ids, counts = both.b.encode_spaced([" " + t for t in texts])
        assert ids.tolist() == [i for t in texts for i in libraries[1].encode(t)]
        assert counts.tolist() == [len(libraries[1].encode(t)) for t in texts]


def test_gallop_equals_searchsorted():
    rng = np.random.default_rng(0)
    for n, m in [(0, 5), (5, 0), (1, 1), (10, 1000), (1000, 10), (500, 700)]:
        short, long = np.unique(rng.integers(0, 2000, n)), np.unique(rng.integers(0, 2000, m))
        assert gallop(short, long).tolist() == np.searchsorted(long, short).tolist()
    crowded = np.concatenate((np.arange(1000), [10**9]))  # far from where ranks suggest
    assert gallop(np.array([5, 999, 10**9]), crowded).tolist() == [5, 999, 1000]


def test_overlaps_of_either_side():
    a, b = np.array([2, 3, 7, 9]), np.array([1, 2, 9])
    for swap in (False, True):
        x, y = (b, a) if swap else (a, b)
        cx, cy, i, j = overlaps(x, y)
        begin = lambda e: np.concatenate(([0], e[:-1]))
        want = {(p, q) for p in range(len(x)) for q in range(len(y)) if max(begin(x)[p], begin(y)[q]) < min(x[p], y[q])}
        assert set(zip(i.tolist(), j.tolist())) == want and len(i) == len(want)
        assert x[cx].tolist() == y[cy].tolist() == [2, 9]




def test_words_on_which_the_ranking_library_differs(spark):
    """An answer with a pair that may not stand goes through the trie."""
    from gridplace.llm.bpe_codec import Codec
    from gridplace.llm.token_alignment import WordCodec

    class Wrong:
        def __init__(self, right):
            self.right = right

        def encode_ordinary(self, word):
            return list(word.encode()) if len(word) % 2 else self.right.encode_ordinary(word)

    codec = WordCodec(A)
    codec.ranked = Wrong(codec.ranked)
    texts = [r[1] for r in hard_rows() if r[1] and r[0] not in (300, 301)]
    for _ in range(2):
        ids, counts = codec.encode_pieces(texts)
        want, each = Codec(A).encode_pieces(texts)
        assert ids.tolist() == want.tolist() and counts.tolist() == each.tolist()
