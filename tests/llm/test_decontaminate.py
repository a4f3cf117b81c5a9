"""Benchmark decontamination against brute force."""

import hashlib
import random
import re

import pytest

from gridplace.llm.decontaminate import decontaminate, keep_clean

from .rows import by_id, frame, hard_rows

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def plain(rows, items, window=10):
    cut = {}
    for item, text in items:
        w = words(text)
        n = min(len(w), window)
        for i in range(len(w) - n + 1) if n else []:
            cut.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = []
    for i, text in rows:
        w = words(text)
        hit, found = set(), set()
        for n in {len(c) for c in cut}:
            for s in range(len(w) - n + 1):
                who = cut.get(tuple(w[s : s + n]))
                if who:
                    hit.update(range(s, s + n))
                    found |= who
        ids = sorted(str(x) for x in found if x is not None)
        out.append((i, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return out


def contracted(df):
    return by_id(df.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect())


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("seed", [1, 2])
def test_hits_equal_brute_force(spark, seed):
    rnd = random.Random(seed)
    vocab = [f"v{i}" for i in range(40)] + ["Über", "ÉTÉ", "x9"]
    items = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.choice([3, 6, 9, 10, 11, 25])))) for i in range(25)]
    items += [(99, None), (98, ""), (97, "der der der der der der der der der der der der"), (None, items[3][1]), items[4], (11, items[5][1]), (96, "...")]
    rows = hard_rows(seed)
    for i in range(40):
        w = words(rnd.choice(items)[1])
        at = rnd.randrange(0, 4)
        text = [rnd.choice(vocab) for _ in range(5)] + w[at:] + [rnd.choice(vocab) for _ in range(5)]
        rows.append((500 + i, rnd.choice([" ", ", ", "\n", "-"]).join(x.upper() if rnd.random() < 0.2 and x.isascii() else x for x in text)))
    assert contracted(decontaminate(frame(spark, rows), bench(spark, items))) == by_id(plain(rows, items))


def test_every_shared_span_is_found(spark):
    """One ten-word span in periodic and in plain text, at each place."""
    span = [f"s{i}" for i in range(10)]
    rows = [(i, " ".join(["pad"] * i + span + ["pad"] * (30 - i))) for i in range(30)]
    rows.append((77, " ".join(["pad"] * 60)))
    items = [(1, " ".join(span)), (2, " ".join(["pad"] * 10))]
    assert contracted(decontaminate(frame(spark, rows), bench(spark, items))) == by_id(plain(rows, items))


def test_equal_words_meet_in_any_context(spark):
    """The lower case of a capital sigma depends on the letters around it,
    also across separators; words fold A-Z only."""
    items = [(1, "ΟΔΟΣ ΑΒΓ"), (2, "Α Σ Β"), (3, " ".join(f"ΛΌΓΟΣ{i} ΟΔΌΣ" for i in range(6))), (4, "Title ΣΑΣ")]
    rows = [(10 + i, t) for i, t in enumerate(["ΟΔΟΣ.ΑΒΓ", "ΟΔΟΣ:ΑΒΓ", "x ΟΔΟΣ ΑΒΓ", "Α'Σ Β", "Α Σ Β", "Α.Σ.Β", "tITLE`ΣΑΣ:Α", "οδος αβγ", "ΟΔΟς ΑΒΓ"])]
    rows.append((30, ".".join(f"ΛΌΓΟΣ{i}'ΟΔΌΣ" for i in range(6))))
    assert contracted(decontaminate(frame(spark, rows), bench(spark, items))) == by_id(plain(rows, items))
    assert [r[5] for r in plain(rows, items)] == [True] * 7 + [False] * 2 + [True]


def test_nothing_to_compare(spark):
    rows = hard_rows()
    clean = decontaminate(frame(spark, rows), bench(spark, []))
    assert contracted(clean) == by_id(plain(rows, []))
    assert decontaminate(frame(spark, []), bench(spark, [(1, "a b")])).collect() == []


def test_clean_rows_stay_whole(spark):
    rows = hard_rows()
    items = [(1, " ".join(words(rows[9][1])[:12])), (2, "orphan text")]
    docs = frame(spark, rows)
    kept = keep_clean(docs, bench(spark, items))
    assert kept.columns == docs.columns
    dirty = {(r[0], t) for r, (_, t) in zip(plain(rows, items), rows) if r[5]}
    assert by_id((r.doc_id, r.text) for r in kept.collect()) == by_id((i, t) for i, t in rows if (i, t) not in dirty)
    assert set(kept.collect()) <= set(docs.collect())


def test_no_python_in_the_plan(spark):
    plan = decontaminate(frame(spark, hard_rows()), bench(spark, [(1, "a b c")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
