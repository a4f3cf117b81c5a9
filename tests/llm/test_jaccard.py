"""N-gram Jaccard join against all pairs."""

import random

import numpy as np
import pytest

from gridplace.llm.jaccard_join import Cell, Limit, folded, jaccard_join, parity, regions_to_cells, within_bound


def all_pairs(rows, p=9, q=10, k=3):
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        m = min(k, len(words))
        sets.append({tuple(words[j : j + m]) for j in range(len(words) - m + 1)} if words else set())
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and q * len(sets[a] & sets[b]) >= p * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    ids = {}
    for a, (doc_id, _) in enumerate(rows):
        ids.setdefault(find(a), []).append(doc_id)
    least = {r: min((i for i in found if i is not None), default=None) for r, found in ids.items()}
    return sorted(((rows[a][0], len(sets[a]), least[find(a)]) for a in range(len(rows))), key=str)


def near_copies(seed, sizes=(20, 60, 120, 200), copies=(1, 2, 40)):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for _ in range(10):
        base = [rnd.choice(words) for _ in range(rnd.choice(sizes))]
        for c in range(rnd.choice(copies)):
            changed = list(base)
            for _ in range(rnd.randint(0, 4)):
                changed[rnd.randrange(len(changed))] = rnd.choice(words)
            rows.append((len(rows), (" ", "\n", "\t ")[c % 3].join(changed)))
    return rows


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted((tuple(r) for r in jaccard_join(df, **options).collect()), key=str)


ODD = [None, "", " \t", "A", "a", "a b", "A  b", "x" * 5000, "a b c", "a b c a b c", "Ä b c", "ä b c"]


@pytest.mark.parametrize("max_cell", [4096, 6])  # 6: cells are cut by Spark until they fit
def test_equals_all_pairs(spark, max_cell):
    rows = near_copies(max_cell)
    rows += [(len(rows) + i, t) for i, t in enumerate(ODD)]
    rows += [(None, "only one of these here"), (None, rows[0][1]), (None, None), rows[3], rows[3]]
    assert run(spark, rows, max_cell=max_cell) == all_pairs(rows)


def test_other_similarity_and_width(spark):
    rows = near_copies(5, sizes=(15, 40), copies=(1, 3, 12))
    assert run(spark, rows, words=2, similarity=(4, 5)) == all_pairs(rows, 4, 5, 2)


def test_frequent_passage_does_not_link(spark):
    rnd = random.Random(3)
    common = [f"c{i}" for i in range(30)]
    rows = [(i, " ".join(common + [f"{i}-{rnd.random()}" for _ in range(60)])) for i in range(150)]
    assert run(spark, rows) == all_pairs(rows)


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([], "doc_id long, text string, key string")
    assert jaccard_join(df).collect() == []
    df = spark.createDataFrame([(1, "a b c", 1, 2, 3, 4), (2, "a b c", 1, 2, 3, 4)], "doc_id long, text string, key int, n int, digest int, who int")
    assert sorted(map(tuple, jaccard_join(df).collect())) == [(1, 1, 1), (2, 1, 1)]


def sets_of(rnd, groups, copies, n, spread):
    out = []
    for _ in range(groups):
        base = rnd.choice(1 << 40, n, replace=False)
        for _ in range(copies):
            s = base.copy()
            k = rnd.integers(0, spread + 1)
            s[rnd.choice(n, k, replace=False)] = rnd.integers(0, 1 << 40, k)
            out.append(np.unique(s).astype(np.uint64))
    return out


@pytest.mark.parametrize("groups,copies,spread", [(1, 300, 12), (6, 60, 10), (200, 1, 0)])
def test_cell_regions_connect_what_all_links_connect(groups, copies, spread):
    sets = sets_of(np.random.default_rng(groups), groups, copies, 100, spread)
    a, b = Cell(sets, Limit(9, 10)).links()
    plain = [(i, j) for i in range(len(sets)) for j in range(i) if 19 * len(np.setxor1d(sets[i], sets[j])) <= len(sets[i]) + len(sets[j])]

    def parts(pairs):
        label = list(range(len(sets)))
        changed = True
        while changed:
            changed = False
            for i, j in pairs:
                low = min(label[i], label[j])
                if label[i] != low or label[j] != low:
                    label[i] = label[j] = low
                    changed = True
        return label

    assert parts(list(zip(a.tolist(), b.tolist()))) == parts(plain)
    assert len(a) < len(sets)  # a forest, not the pairs


@pytest.mark.parametrize("merge", [True, False])
def test_regions_too_large_to_hold(spark, merge):
    """All pairs in reach of each other meet in a cell, streamed or held."""
    rnd = random.Random(1)
    rows = sorted({(rnd.randrange(4), rnd.randrange(200), 0, 0) for _ in range(300)})
    rows = [(region, who, 20 + who * 3, rnd.randrange(3)) for region, who, _, _ in rows]
    files = spark.createDataFrame(rows, "region long, who long, n int, at int")
    limit = Limit(9, 10)
    found = {}
    for cell, who in regions_to_cells(files, limit, merge, hold=5).collect():
        found.setdefault(cell, set()).add(who)
    for region, x, n, at in rows:
        for region_, y, n_, at_ in rows:
            if region == region_ and x != y and 10 * min(n, n_) >= 9 * max(n, n_) and 19 * (at + at_) <= n + n_:
                assert any({x, y} <= members for members in found.values())


def test_parity_sketches_never_lose_a_link():
    rng = np.random.default_rng(7)
    limit = Limit(9, 10)
    sets = []
    for n in (12, 30, 60, 64, 70, 126, 130, 400, 1000):  # around the sizes at which sketches double
        base = rng.choice(1 << 62, n, replace=False).astype(np.uint64)
        for _ in range(12):
            s = base.copy()
            k = rng.integers(0, max(2, n // 12))
            s[rng.choice(n, k, replace=False)] = rng.integers(0, 1 << 62, k).astype(np.uint64)
            sets.append(np.unique(s[: len(s) - rng.integers(0, 1 + n // 20)]))
    bits, n = [parity(s) for s in sets], np.array([len(s) for s in sets])
    for i in range(len(sets)):
        for j in range(i):
            a, b = sorted((bits[i], bits[j]), key=len)
            while len(b) > len(a):
                b = folded(b)
            assert np.bitwise_count(a ^ b).sum() <= len(np.setxor1d(sets[i], sets[j]))
    kept, name = within_bound(bits, n, limit)
    part = dict(zip(kept.tolist(), name.tolist()))
    links = [(i, j) for i in range(len(sets)) for j in range(i) if 19 * len(np.setxor1d(sets[i], sets[j])) <= n[i] + n[j]]
    assert links and all(i in part and part[i] == part.get(j) for i, j in links)


def test_strangers_leave_a_cell():
    rng = np.random.default_rng(8)
    common = rng.choice(1 << 62, 5, replace=False)
    sets = [np.unique(np.concatenate((common, rng.choice(1 << 62, 200)))).astype(np.uint64) for _ in range(300)]
    kept, _ = within_bound([parity(s) for s in sets], np.array([len(s) for s in sets]), Limit(9, 10))
    assert len(kept) == 0
