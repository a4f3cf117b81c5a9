"""Rows that every operator must take, and the plain-Python word rules."""

from __future__ import annotations

import random
import re

#: Columns whose names the operators use themselves.
CLASHES = "kept string, key string, digest string, uid string, spans string, fp string, label string, at string, _row string, _digest string, stored string, _kept_id string, _id string, id string"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + CLASHES
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, rows):
    """(doc_id, text) rows with all other columns, some of them NULL."""
    extra = len(CLASHES.split(", "))
    full = [(i, t, None if n % 3 else "en", "src0", None if n % 4 == 0 else len(t or ""), *[f"c{n}"] * extra) for n, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA)


def hard_rows(seed: int = 0) -> list[tuple]:
    """NULL ids and texts, empty and very long texts, ties, repeated rows."""
    rnd = random.Random(seed)
    vocab = ["the", "and", "Ünder", "über", "of", "secret", "日本", "x1", "don't", "Foo"] + [f"word{i}" for i in range(60)]
    say = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    shared = [say(45) for _ in range(4)]
    rows: list[tuple] = []
    for i in range(60):
        parts = [say(rnd.randrange(0, 40))]
        if rnd.random() < 0.5:
            parts.append(rnd.choice(shared)[rnd.randrange(0, 30):])
        parts.append(say(rnd.randrange(0, 30)))
        rows.append((i, rnd.choice([" ", "\n", "  "]).join(parts)))
    rows += [(100, None), (101, ""), (102, " \n\t "), (None, None), (None, "orphan text"), (None, "orphan text"), (103, "a"), (104, "a")]
    rows += [rows[7], rows[7], (7, "the same id but another text"), (200, rows[9][1]), (201, rows[9][1]), (202, rows[9][1] + " end")]
    rows += [(300, say(30_000)), (301, "z" * 70_000), (302, "der " * 3000), (303, "<|endoftext|> a<|endoftext|>")]
    return rows


def by_id(rows) -> list[tuple]:
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is not None, str(type(x)), x if x is not None else 0) for x in r))
