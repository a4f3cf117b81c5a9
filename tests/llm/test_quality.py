"""Factorisation machine: the identity, the held-out rows, accuracy."""

import os
import zlib

import numpy as np
import pytest

from gridplace.llm import quality as Q
from gridplace.llm.common import table

from .rows import frame, hard_rows

SF = "/root/testdata/sf0.01"


def test_linear_time_score_is_the_sum_over_pairs():
    rng = np.random.default_rng(1)
    m = Q.Machine(0.3, rng.normal(size=Q.BUCKETS + Q.N_STATS), rng.normal(size=(Q.BUCKETS + Q.N_STATS, 3)), np.zeros(Q.N_STATS), np.ones(Q.N_STATS))
    row, col, val = m.rows(*Q.features(["a b b c", ""], [7, None]))
    got, _ = m.margin(row, col, val, 2)
    for r in range(2):
        c, x = col[row == r], val[row == r]
        pairs = sum(m.factors[c[i]] @ m.factors[c[j]] * x[i] * x[j] for i in range(len(c)) for j in range(i + 1, len(c)))
        assert got[r] == pytest.approx(0.3 + m.linear[c] @ x + pairs)


def test_vectors_of_long_texts_are_bounded(spark, monkeypatch):
    """Words that share a bucket are one entry, in the fit and in the score."""
    long = " ".join(f"w{i}" for i in range(3 * Q.BUCKETS))
    bucket, value, size, _ = Q.features(["", long, "a b"], [None] * 3)
    assert size[1] <= Q.BUCKETS and size.tolist()[::2] == [0, 2] and len(bucket) == len(value) == size.sum()
    assert len(set(bucket[: size[1]])) == size[1]
    want = np.bincount([zlib.crc32(w.encode()) % Q.BUCKETS for w in long.split()], minlength=Q.BUCKETS).astype(float)
    got = np.zeros(Q.BUCKETS)
    got[bucket[: size[1]]] = value[: size[1]]
    assert got == pytest.approx(want / np.sqrt((want**2).sum()))
    seen = []
    monkeypatch.setattr(Q, "fit", lambda bucket, value, size, *rest: seen.append(size))
    Q.fit_quality(frame(spark, [(i, long) for i in range(8)]), spark.createDataFrame([(i, i % 2) for i in range(8)], "doc_id long, quality int"))
    assert 0 < seen[0].max() <= Q.BUCKETS


def is_held_out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 0


def test_hard_rows_get_a_score(spark):
    rows = hard_rows()
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)] + [(None, 1, 0), (5, None, 1), (9999, 1, 0)], "doc_id long, quality int, toxic int")
    docs = frame(spark, rows)
    got = Q.quality(docs, labels).collect()
    assert len(got) == len(rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) and r.held_out == is_held_out(r.doc_id) for r in got)
    assert Q.quality(frame(spark, []), labels).collect() == []
    none = Q.quality(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}


def test_held_out_labels_and_ids_do_not_matter(spark):
    rows = [(i, f"good text number {i}" if i % 2 else f"BAD!! BAD!! {i}") for i in range(120)]
    docs = frame(spark, rows)
    label = lambda flip: spark.createDataFrame([(i, (i % 2) ^ (flip and is_held_out(i)), 0) for i in range(120)], "doc_id long, quality int, toxic int")
    a = Q.fit_quality(docs, label(False))
    b = Q.fit_quality(docs, label(True))
    assert a.bias == b.bias and (a.linear == b.linear).all() and (a.factors == b.factors).all()
    bound = Q.fit_quality(docs, label(False), max_fit=10)
    assert bound.bias != a.bias


def test_repeated_labelled_ids_give_one_model(spark):
    """Documents that repeat an id, and repeated labels, in any order."""
    rows = [(i, f"good text number {i} of {k}" if i % 2 else f"BAD!! BAD!! {i} {k}") for i in range(60) for k in range(3)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)] * 2, "doc_id long, quality int, toxic int")
    a = Q.fit_quality(frame(spark, rows).repartition(5), labels, max_fit=30)
    b = Q.fit_quality(frame(spark, rows[::-1]).repartition(2), labels, max_fit=30)
    assert a.bias == b.bias and (a.linear == b.linear).all() and (a.factors == b.factors).all()


def test_kept_rows_are_those_predicted_good(spark):
    rows = hard_rows()
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    model = Q.fit_quality(docs, labels)
    kept = Q.keep_good(docs, model, threshold=0.5)
    assert kept.columns == docs.columns and set(kept.collect()) <= set(docs.collect())
    assert kept.count() == Q.score_quality(docs, model, threshold=0.5).filter("predicted = 1").count()


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_held_out_accuracy(spark):
    known = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    rows = [r for r in Q.quality(table(spark, SF, "documents"), table(spark, SF, "labels")).collect() if r.held_out and r.doc_id in known]
    good = [r.score for r in rows if known[r.doc_id] == 1]
    bad = [r.score for r in rows if known[r.doc_id] == 0]
    assert sum(a > b for a in good for b in bad) >= 0.98 * len(good) * len(bad)
    assert sum(r.predicted == known[r.doc_id] for r in rows) >= 0.9 * len(rows)
    assert all(s >= 0.3 for s in good)
