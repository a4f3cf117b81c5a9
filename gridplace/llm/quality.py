"""Quality classifier: a factorisation machine over hashed words, structure
statistics and metadata.

A document is a sparse vector: its distinct words hashed into buckets with
damped counts (unit length), standardised statistics of its structure (marks,
capitals, repetition, line shape, ...) and its stored length.  The score is a
logistic of bias, linear terms and all pairwise interactions at low rank,

    sum_{i<j} <v_i, v_j> x_i x_j = (|sum_i x_i v_i|^2 - sum_i x_i^2 |v_i|^2) / 2,

so it is computed in time linear in the document's words.

The model is fitted on a bounded sample of labelled rows (``max_fit`` rows,
chosen by a hash of the id, never rows that are held out): their features are
computed in tasks, and only those vectors reach the driver.  Equal buckets of
a document are summed in its task, so a vector has at most BUCKETS words of 6
bytes and N_STATS statistics of 8, however long the text: ``MAX_FIT`` of them
are below 0.6 GB.  Scoring is map-only; the model is a broadcast of fixed size.

Defined cases: NULL text is the empty text, all-zero words and finite
statistics, and gets a score like any other; NULL stored length is the
text's own; a NULL id is not held out; without usable labels every score is
the smoothed share of label 1; repeated rows each get a row; an empty table
gives an empty result; labels, language, source and id are never features.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridplace.llm.common import map_arrow, text_slices

BUCKETS = 1 << 14
MARKS = b"#$%&*!|<>{}[]=+~^_\\@"
SLICE_CHARS = 1 << 20
N_STATS = 17
#: Documents of the fit: the bound of what the driver gathers.
MAX_FIT = 6000


def statistics(text: str, words: list[str], counts: Counter, stored: int | None) -> list[float]:
    """Structure of a text and its stored length."""
    n_chars, n = len(text), len(words)
    coded = text.encode("utf-8", "surrogatepass")
    by_byte = np.bincount(np.frombuffer(coded, np.uint8), minlength=256) if coded else np.zeros(256, np.int64)
    size = max(1, len(coded))
    letters = max(1, int(by_byte[65:91].sum() + by_byte[97:123].sum()))
    lines = text.split("\n")
    filled = max(1, len(lines))
    some = max(1, n)
    frequent = counts.most_common(1)[0][1] if counts else 0
    stored = n_chars if stored is None else stored
    return [
        math.log1p(n),
        math.log1p(stored),
        min(8.0, abs(math.log1p(max(0, stored)) - math.log1p(n_chars))),
        by_byte[65:91].sum() / letters,
        by_byte[48:58].sum() / size,
        sum(int(by_byte[b]) for b in MARKS) / size,
        (by_byte[44] + by_byte[46]) / some,
        sum(map(str.isupper, words)) / some,
        sum(map(str.istitle, words)) / some,
        sum(map(eq, words, words[1:])) / some,
        len(counts) / some,
        frequent / some,
        n_chars / some if n else 0.0,
        sum(1 for w in counts if not w[-1].isalnum()) / max(1, len(counts)),
        math.log1p(len(lines)),
        len(set(lines)) / filled,
        math.log1p(n_chars / filled),
    ]


def features(texts: list[str], stored: list[int | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buckets and values of the words of all texts in a row, how many each
    text has (at most BUCKETS: equal buckets of a text are summed), and the
    raw statistics."""
    buckets: list[int] = []
    values: list[int] = []
    sizes, stats = [], []
    crc = zlib.crc32
    for text, s in zip(texts, stored):
        words = text.split()
        counts = Counter(words)
        buckets += [crc(w.encode("utf-8", "surrogatepass")) for w in counts]
        values += counts.values()
        sizes.append(len(counts))
        stats.append(statistics(text, words, counts, s))
    owner = np.repeat(np.arange(len(sizes)), np.array(sizes, np.int64))
    merged, place = np.unique(owner * BUCKETS + np.array(buckets, np.int64) % BUCKETS, return_inverse=True)
    value = np.bincount(place, np.log1p(np.array(values, np.float64)), minlength=len(merged))
    owner = merged // BUCKETS
    size = np.bincount(owner, minlength=len(sizes))
    norm = np.sqrt(np.bincount(owner, value * value, minlength=len(size)))
    value /= np.maximum(norm[owner], 1e-12)
    return merged % BUCKETS, value, size, np.array(stats, np.float64).reshape(-1, N_STATS)


@dataclass
class Machine:
    """Bias, linear weights and factors; the last N_STATS rows belong to the
    statistics, standardised by ``mean`` and ``scale``."""

    bias: float
    linear: np.ndarray
    factors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def rows(self, bucket: np.ndarray, value: np.ndarray, size: np.ndarray, stats: np.ndarray):
        """Words and statistics as one sparse matrix: row, column, value."""
        n = len(size)
        x = np.clip((stats - self.mean) / self.scale, -4, 4) / 2
        row = np.concatenate((np.repeat(np.arange(n), size), np.repeat(np.arange(n), N_STATS)))
        col = np.concatenate((bucket, np.tile(np.arange(BUCKETS, BUCKETS + N_STATS), n)))
        return row, col, np.concatenate((value, x.ravel()))

    def margin(self, row: np.ndarray, col: np.ndarray, val: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Margins, and the sums of factors that the gradient needs too."""
        out = self.bias + np.bincount(row, self.linear[col] * val, minlength=n)
        sums = np.empty((n, self.factors.shape[1]))
        for f in range(self.factors.shape[1]):
            xv = self.factors[col, f] * val
            sums[:, f] = np.bincount(row, xv, minlength=n)
            out += 0.5 * (sums[:, f] ** 2 - np.bincount(row, xv * xv, minlength=n))
        return out, sums

    def score(self, texts: list[str], stored: list[int | None]) -> np.ndarray:
        row, col, val = self.rows(*features(texts, stored))
        margin, _ = self.margin(row, col, val, len(texts))
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def fit(bucket: np.ndarray, value: np.ndarray, size: np.ndarray, stats: np.ndarray, label: np.ndarray, rank: int = 4, steps: int = 1200, batch_rows: int = 64, seed: int = 7) -> Machine:
    """Adaptive-gradient descent on the logistic loss, ``steps`` batches."""
    rng = np.random.default_rng(seed)
    n, width = len(label), BUCKETS + N_STATS
    share = (label.sum() + 1) / (n + 2)
    m = Machine(
        math.log(share / (1 - share)), np.zeros(width), np.zeros((width, rank)),
        stats.mean(axis=0) if n else np.zeros(N_STATS), np.maximum(stats.std(axis=0), 1e-6) if n else np.ones(N_STATS),
    )
    if n == 0 or label.min() == label.max():
        return m
    m.factors = rng.normal(0, 0.02, (width, rank))
    row, col, val = m.rows(bucket, value, size, stats)
    order = np.argsort(row, kind="stable")
    row, col, val = row[order], col[order], val[order]
    at = np.searchsorted(row, np.arange(n + 1))
    g_bias, g_linear, g_factors = 1e-2, np.full(width, 1e-2), np.full((width, rank), 1e-2)
    per_pass = max(1, n // batch_rows)
    for _ in range(math.ceil(steps / per_pass)):
        for batch in np.array_split(rng.permutation(n), per_pass):
            pick = np.concatenate([np.arange(at[i], at[i + 1]) for i in batch])
            r = np.repeat(np.arange(len(batch)), at[batch + 1] - at[batch])
            c, x = col[pick], val[pick]
            margin, sums = m.margin(r, c, x, len(batch))
            wrong = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - label[batch]) / len(batch)
            seen, place = np.unique(c, return_inverse=True)
            grad = np.bincount(place, wrong[r] * x) + 1e-4 * m.linear[seen]
            g_linear[seen] += grad * grad
            m.linear[seen] -= 0.1 * grad / np.sqrt(g_linear[seen])
            for f in range(rank):
                grad = np.bincount(place, wrong[r] * x * (sums[r, f] - m.factors[c, f] * x)) + 1e-4 * m.factors[seen, f]
                g_factors[seen, f] += grad * grad
                m.factors[seen, f] -= 0.05 * grad / np.sqrt(g_factors[seen, f])
            total = float(wrong.sum())
            g_bias += total * total
            m.bias -= 0.1 * total / math.sqrt(g_bias)
    return m


def held_out(id_col: Column) -> Column:
    """Rows that are never learned from."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _input(docs: DataFrame, id_col: str, text_col: str, length_col: str | None) -> DataFrame:
    stored = F.col(length_col).cast("long") if length_col in docs.columns else F.lit(None).cast("long")
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), stored.alias("stored"))


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars", label_col: str = "quality", max_fit: int = MAX_FIT) -> Machine:
    """Fit on at most ``max_fit`` labelled rows that are not held out.

    Of documents that repeat a labelled id, the text with the smallest hash is
    taken; an id with two labels counts with both.
    """
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label")).filter("label is not null and doc_id is not null")
    chosen = known.filter(~held_out(F.col("doc_id"))).distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(max_fit)
    every = _input(docs, id_col, text_col, length_col).join(F.broadcast(chosen), "doc_id")
    first = F.min(F.struct(F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"), "text", "stored")).alias("first")
    rows = every.groupBy("doc_id", "label").agg(first).select("doc_id", "label", "first.text", "first.stored")
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, texts in text_slices(batch.column(2), SLICE_CHARS):
                part = batch.slice(a, len(texts))
                bucket, value, size, stats = features(texts, part.column(3).to_pylist())
                ends = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), part.column(1),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(bucket.astype(np.int16))),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(value.astype(np.float32))),
                        pa.ListArray.from_arrays(pa.array(np.arange(len(size) + 1, dtype=np.int32) * N_STATS), pa.array(stats.ravel())),
                    ],
                    ["doc_id", "label", "bucket", "value", "stats"],
                )

    vectors = map_arrow(rows, run, f"doc_id {id_type}, label int, bucket array<smallint>, value array<float>, stats array<double>")
    got = vectors.limit(max_fit).toArrow().combine_chunks().sort_by([("doc_id", "ascending"), ("label", "ascending")])
    flat = lambda name, kind: got[name].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(kind)
    if got.num_rows == 0:
        none = np.zeros(0, np.int64)
        return fit(none, none.astype(float), none, np.zeros((0, N_STATS)), none)
    size = np.array([len(x) for x in got["bucket"]], np.int64)
    return fit(flat("bucket", np.int64), flat("value", np.float64), size, flat("stats", np.float64).reshape(-1, N_STATS), (got["label"].to_numpy() > 0).astype(np.int64))


def score_quality(docs: DataFrame, model: Machine, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars", threshold: float = 0.3) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    rows = _input(docs, id_col, text_col, length_col)
    id_type = rows.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # (BUCKETS + N_STATS) * (rank + 1) numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stored = batch.column(2).to_pylist()
            scores = [shared.value.score(texts, stored[a : a + len(texts)]) for a, texts in text_slices(batch.column(1), SLICE_CHARS)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(scores) if scores else np.zeros(0))], ["doc_id", "score"])

    out = map_arrow(rows, run, f"doc_id {id_type}, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def quality(docs: DataFrame, labels: DataFrame, **columns) -> DataFrame:
    """Fit on the labelled rows of ``docs`` and score all of them."""
    return score_quality(docs, fit_quality(docs, labels, **columns), **{k: v for k, v in columns.items() if k not in ("label_col", "max_fit")})


def keep_good(docs: DataFrame, model: Machine, text_col: str = "text", length_col: str | None = "n_chars", threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` with a score of at least ``threshold``, all
    columns unchanged: the rows are filtered where they are scored."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)
    length = docs.columns.index(length_col) if length_col in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stored = batch.column(length).to_pylist() if length is not None else [None] * batch.num_rows
            for a, texts in text_slices(batch.column(at), SLICE_CHARS):
                good = shared.value.score(texts, stored[a : a + len(texts)]) >= threshold
                yield batch.slice(a, len(texts)).filter(pa.array(good))

    return map_arrow(docs, run, docs.schema)
