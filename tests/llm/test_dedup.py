"""Exact, passage and near-duplicate removal against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from gridplace.llm import simhash as S
from gridplace.llm.exact_dedup import exact_dedup, keep_one_of_each
from gridplace.llm.substring_dedup import substring_dedup

from .rows import WORDS, by_id, frame, hard_rows


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# --- exact ---------------------------------------------------------------------


@pytest.mark.parametrize("counters", [1, 20, 2048])
def test_exact_dedup(spark, counters):
    rows = hard_rows() + [(1000 + i, "hot") for i in range(90)]
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    top = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    got = exact_dedup(frame(spark, rows), counters=counters).collect()
    assert by_id((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == by_id((i, top[t or ""], len(groups[t or ""]), sha(t or "")) for i, t in rows)
    stays = [(r.text_sha256, r.doc_id) for r in got if r.kept]
    assert sorted(stays, key=str) == sorted(((sha(t), i) for t, i in top.items()), key=str)  # one row each, repeated rows included


def test_remaining_digests_are_combined_not_gathered(spark):
    plan = exact_dedup(frame(spark, hard_rows()))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_max" in plan


def test_exact_dedup_keeps_whole_rows(spark):
    rows = hard_rows()
    docs = frame(spark, rows)
    kept = keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.text or "") for r in kept.collect()) == sorted({t or "" for _, t in rows})
    assert set(kept.collect()) <= set(docs.collect())
    assert exact_dedup(frame(spark, [])).collect() == [] and keep_one_of_each(frame(spark, [])).collect() == []


def test_exact_dedup_normalises(spark):
    from pyspark.sql import functions as F

    got = exact_dedup(frame(spark, [(1, "A b"), (2, "a B")]), normalise=F.lower).collect()
    assert {r.keep_id for r in got} == {2}


# --- repeated passages -----------------------------------------------------------


def without_repeats(rows, window):
    words = [WORDS.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (i, _), w in zip(rows, words):
        gone = {k for s in range(len(w) - window + 1) if seen[tuple(w[s : s + window])] > 1 for k in range(s, s + window)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), sha(kept), kept))
    return out


@pytest.mark.parametrize("window, parts", [(35, 1), (35, 7), (9, 3), (4, 30)])
def test_substring_dedup_on_hard_rows(spark, window, parts):
    rows = hard_rows(window)
    got = substring_dedup(frame(spark, rows).repartition(parts), window=window).collect()
    assert by_id(r[:5] for r in got) == by_id(without_repeats(rows, window))
    for r in got:  # factors are whole windows or more, apart from each other, and what is removed
        assert sum(f.n for f in r.factors) == r.n_removed and all(f.n >= window for f in r.factors)
        assert all(a["at"] + a.n < b["at"] for a, b in zip(r.factors, r.factors[1:]))


@pytest.mark.parametrize("seed, parts", [(1, 1), (2, 5), (3, 40)])
def test_substring_dedup_on_edited_passages(spark, seed, parts):
    """Passages with one word changed, and cut at either end."""
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(200)]
    passages = [[rnd.choice(vocab) for _ in range(rnd.randrange(8, 40))] for _ in range(6)]
    rows = []
    for i in range(160):
        w: list[str] = []
        for _ in range(rnd.randrange(0, 5)):
            w += [rnd.choice(vocab) for _ in range(rnd.randrange(0, 15))]
            if rnd.random() < 0.7:
                p = list(rnd.choice(passages))
                if rnd.random() < 0.3:
                    p[rnd.randrange(len(p))] = "edit"
                w += p[rnd.randrange(0, 3) :]
        rows.append((i if i % 50 else None, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    assert by_id(r[:5] for r in substring_dedup(docs, window=12).collect()) == by_id(without_repeats(rows, 12))


def test_substring_dedup_without_rows(spark):
    assert substring_dedup(frame(spark, [])).collect() == []


def test_small_combiner_changes_nothing(spark, monkeypatch):
    from gridplace.llm import substring_dedup as M

    monkeypatch.setattr(M, "BLOCK_BYTES", 64)
    texts = [t or "" for _, t in hard_rows() if len(t or "") < 5000]
    a = M.Words(texts)
    monkeypatch.setattr(M, "BLOCK_BYTES", 1 << 20)
    b = M.Words(texts)
    assert (a.hashes == b.hashes).all() and (a.begin == b.begin).all()


def thue_morse(letters):
    word = letters[0]
    while len(word) < 1024:
        word += word.translate(str.maketrans(letters, letters[::-1]))
    return word


@pytest.mark.parametrize("place", [0, 17, 34])
def test_words_that_only_a_polynomial_takes_as_equal(spark, place):
    """Two words of 1024 letters on which every polynomial hash modulo 2^64
    with an odd base agrees; and the same pattern laid out in words."""
    words = [f"w{i}" for i in range(34)]
    one, two = thue_morse("ab"), thue_morse("ba")
    rows = [(i, " ".join(words[:place] + [w] + words[place:])) for i, w in enumerate((one, two))]
    rows += [(2, " ".join("xy"[c == "a"] for c in one)), (3, " ".join(["other", *("yx"[c == "a"] for c in one)]))]
    got = {r.doc_id: r.n_removed for r in substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = {i: n for i, _, n, _, _ in without_repeats(rows, 35)}
    assert got == want and got[0] == got[1] == 0


# --- near duplicates ---------------------------------------------------------------


def plain_fingerprint(text, k=3):
    words = WORDS.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(fps, bits):
    """Smallest fingerprint reachable, by comparing all pairs."""
    u = np.unique(np.array(fps, np.uint64))
    label = np.arange(len(u))
    left, right = [], []
    for i in range(len(u)):
        j = np.flatnonzero(np.bitwise_count(u[i] ^ u[i + 1 :]) <= bits) + i + 1
        left += [i] * len(j)
        right += j.tolist()
    parent = list(label)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in zip(left, right):
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {int(f): int(u[root(i)]) for i, f in enumerate(u)}


def clusters(seed):
    rnd = random.Random(seed)
    out = {0}
    for _ in range(30):
        base = rnd.getrandbits(64)
        for _ in range(rnd.choice([1, 5, 40])):
            x = base
            for _ in range(rnd.randrange(0, 8)):
                x ^= 1 << rnd.randrange(64)
            out.add(x)
    base = rnd.getrandbits(64)
    for _ in range(400):
        x = base
        for _ in range(rnd.randrange(1, 7)):
            x ^= 1 << rnd.randrange(64)
        out.add(x)
    return sorted(out)


@pytest.mark.parametrize("bits, max_file", [(3, 1024), (3, 16), (3, 3), (1, 8), (0, 4)])
def test_links_connect_what_all_pairs_connect(spark, bits, max_file):
    fps = clusters(bits)
    expected = plain_components(fps, bits)
    df = spark.createDataFrame([(S.signed(f),) for f in fps], "fp long")
    edges = S.links(df, bits, max_file)
    wide = lambda x: x & ((1 << 64) - 1)
    got = {wide(r.node): wide(r.label) for r in S.components(edges).collect()}
    same = defaultdict(set)
    for f in fps:
        same[got.get(f, f)].add(f)
    want = defaultdict(set)
    for f in fps:
        want[expected[f]].add(f)
    assert sorted(map(sorted, same.values())) == sorted(map(sorted, want.values()))
    assert edges.count() < 25 * len(fps)  # a forest per file, not all pairs


def test_simhash_on_hard_rows(spark):
    rows = hard_rows()
    rows += [(400 + i, rows[9][1] + f" tail{i}") for i in range(6)]
    fps = [plain_fingerprint(t) for _, t in rows]
    label = plain_components(fps, 3)
    first = {}
    for (i, _), f in zip(rows, fps):
        if i is not None:
            first[label[f]] = min(i, first.get(label[f], i))
    got = S.simhash_dedup(frame(spark, rows), max_file=4).collect()
    assert by_id(got) == by_id((i, f"{f:016x}", first.get(label[f])) for (i, _), f in zip(rows, fps))
    docs = frame(spark, rows)
    kept = S.keep_one_of_each_component(docs)
    assert kept.columns == docs.columns
    left = kept.collect()
    assert set(left) <= set(docs.collect())
    of = Counter(label[plain_fingerprint(r.text)] for r in left)
    assert set(of) == set(label.values()) and set(of.values()) == {1}
    assert all(r.doc_id == first.get(label[plain_fingerprint(r.text)]) for r in left)
    assert S.simhash_dedup(frame(spark, [])).collect() == [] and S.keep_one_of_each_component(frame(spark, [])).collect() == []


def test_pivot_distances_never_discard_a_link():
    rnd = random.Random(4)
    table = S.pivots()
    for _ in range(300):
        a = rnd.getrandbits(64)
        b = a
        for _ in range(3):
            b ^= 1 << rnd.randrange(64)
        gap = np.abs(np.bitwise_count(np.uint64(a) ^ table).astype(int) - np.bitwise_count(np.uint64(b) ^ table).astype(int))
        assert gap.max() <= 3
