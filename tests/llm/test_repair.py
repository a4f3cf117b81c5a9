"""Conversation repair against all repairs, and segments against whole conversations."""

import hashlib
import random
import zlib
from functools import cache
from itertools import product

import pytest

from gridplace.llm import conversation_repair as C
from gridplace.llm.conversation_repair import damaged, repair_conversations

RESULT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def plain(rows):
    """The result by a table over suffixes of (cost, audit, repaired rows)."""
    rows = sorted(((t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    white = " \t\n\x0b\x0c\r"
    faults, seen = [], set()
    for _, role, text in rows:
        last = text.strip(white)[-1:]
        faults.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else "")
        seen.add((role, text))

    @cache
    def best(i, before, depth=0):
        """before: the initial before this row, '' at the start."""
        out = [(0, "", ())] if i == len(rows) and before in ("", "a") else []
        legal = {"": "su", "s": "u", "u": "a", "a": "u"}[before]
        if depth < 3:
            for role in ("user", "assistant"):
                if role[0] in legal:
                    for c, a, w in best(i, role[0], depth + 1):
                        out.append((c + 2, "I" + a, (role + ":",) + w))
        if i < len(rows):
            _, role, text = rows[i]
            out += [(c + 3, "D" + a, w) for c, a, w in best(i + 1, before)]
            if faults[i] not in ("blank", "duplicate"):
                more = 1 if faults[i] else 0
                for new, price, letter in ((role, 0, "K"), ("user", 2, "R"), ("assistant", 2, "R")):
                    if new[:1] and new[0] in legal:
                        out += [(c + price + more, letter + a, (f"{new}:{text}",) + w) for c, a, w in best(i + 1, new[0])]
        return [min(out)] if out else []

    cost, audit, lines = best(0, "")[0]
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def results(df):
    return {r["conv_id"]: tuple(r[n] for n in RESULT) for r in df.collect()}


def random_rows(seed, n, texts=("Yes.", "No!", "so", "", " ", "What?", None)):
    rnd = random.Random(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", None, "", " "]
    turn = 0
    rows = []
    for _ in range(n):
        turn += rnd.choice([0, 1, 1, 1, 3])
        rows.append((None if rnd.random() < 0.05 else turn, rnd.choice(roles), rnd.choice(texts) if rnd.random() < 0.5 else f"{rnd.random()}."))
    return rows


def test_every_short_conversation():
    """All role sequences of up to six rows."""
    for n in range(6):
        for roles in product("sua", repeat=n):
            rows = [(i, {"s": "system", "u": "user", "a": "assistant"}[r], f"{i}.") for i, r in enumerate(roles)]
            got = C.repaired(rows, True)
            assert tuple(got[k] for k in RESULT) == plain(rows), roles


@pytest.mark.parametrize("segment,hold", [(4096, 1 << 16), (3, 5)])
def test_equals_plain(spark, segment, hold):
    convs = {i: random_rows(i, random.Random(i).randrange(1, 14)) for i in range(40)}
    convs[-5] = random_rows(99, 60)
    convs[None] = random_rows(7, 9)
    convs[300] = [(1, "user", "same.")] * 20
    convs[301] = [(None, "user", "a."), (None, "assistant", "b.")]
    rows = [(c, t, r, x, "-", 1) for c, part in convs.items() for t, r, x in part]
    random.Random(0).shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, segment string, seq int")
    got = repair_conversations(df.repartition(3), segment=segment, hold=hold, with_text=True)
    kept = {r.conv_id: r for r in got.collect()}
    assert set(kept) == set(convs)
    for c, part in convs.items():
        assert tuple(kept[c][n] for n in RESULT) == plain(part), c
        assert hashlib.sha256(kept[c].repaired.encode()).hexdigest() == kept[c].repaired_sha256


def test_one_conversation_over_many_tasks(spark):
    rows = [(1, i, "user" if i % 2 else "assistant", f"turn {i}{'.' if i % 7 else ''}") for i in range(3000)] + [(2, 0, "user", "Hi.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = results(repair_conversations(df, segment=100))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    whole = C.repaired([r[1:] for r in rows[:-1]], False)
    assert got[1] == tuple(whole[n] for n in RESULT)
    assert got[2] == plain([(0, "user", "Hi.")])


def test_absent_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, 0, "user", "Hi.", False), (1, 1, None, None, None), (2, 0, "user", "Hi.", True)], "conv_id long, turn long, role string, text string, ok boolean")
    from pyspark.sql import functions as F

    got = results(repair_conversations(df, present=F.col("ok")))
    assert got[1] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got[2] == plain([(0, "user", "Hi.")])
    assert repair_conversations(df.limit(0)).collect() == []


def test_damage(spark):
    rows = [(c, t, r, "One. Two! Three?") for c in range(60) for t, r in enumerate(("user", "assistant", "user"))] + [(7, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out, present = damaged(df)
    want = []
    for c, t, r, x in rows:
        harm = zlib.crc32(f"{c}:{' ' if t is None else t}".encode()) % 20
        r, x = r if r is not None else " ", x if x is not None else " "
        x = "" if harm == 1 else "".join(ch for ch in x if ch not in ".!?") if harm == 2 else x
        want += [(c, t, "user" if harm == 4 else r, x, harm != 0)] * (2 if harm == 3 else 1)
    assert sorted(map(tuple, out.select("conv_id", "turn", "role", "text", present).collect()), key=str) == sorted(want, key=str)


def test_composed_tables_equal_the_whole():
    rnd = random.Random(4)
    for n in range(40):
        rows = [(rnd.choice(["system", "user", "assistant", "x"]), rnd.choice([C.SOUND, C.SOUND, C.CUT, C.BLANK])) for _ in range(n)]
        cost, audit = C.lightest(rows, C.ACCEPTING, (C.START,))[C.START]
        at = 0
        tables = []
        while at < n:
            end = at + rnd.randrange(1, 6)
            tables.append({(q, e): way for e in C.STATES for q, way in C.lightest(rows[at:end], (e,), C.STATES).items()})
            at = end
        assert C.compose(tables) == (cost, C.compose(tables)[1])
        assert "".join(C.compose(tables)[1]) == audit
