"""Exact duplicate removal with a heavy-hitter split.

A text copied into a large share of all documents would send all its rows to
one shuffle partition.  So the frequent digests are found first, by a
Misra-Gries sketch (``approx_top_k``, the mergeable frequent-items sketch: one
bounded state per task, merged once).  Its candidates are verified by exact
counts, which combine on the map side, and the verified winners - a bounded
number of rows - are broadcast: their copies are decided where they lie,
without a shuffle.  The remaining digests, each at most ``rows / counters``
rows, meet by an ordinary shuffle: their counts and winners are one combining
aggregate, joined back to the rows, so no group is held in one task.

Defined cases: NULL text counts as the empty text; NULL ids sort below all
ids; of repeated rows (same id, same text) exactly one stays; an empty table
gives an empty result; only the id and text columns are read, so any other
column is ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridplace.llm.common import keep_rows, materialize, text_or_empty

#: Slots of the sketch per reported digest: its error is then well below the share that makes a digest hot.
SLOTS_PER_COUNTER = 32


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise: Callable[[Column], Column] | None = None,
    counters: int = 2048,
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after ``normalise`` (none by default).  Of
    equal texts the row with the largest id stays.  A digest is hot when it
    holds more than ``1 / counters`` of all rows; at most ``counters`` digests
    can, and at most that many are broadcast.
    """
    text = text_or_empty(text_col)
    text = normalise(text) if normalise else text
    rows = materialize(
        docs.select(F.col(id_col).alias("doc_id"), F.sha2(text, 256).alias("digest"))
        .withColumn("uid", F.monotonically_increasing_id()),
        "digests",
    )
    n_rows = rows.count()  # from the file footers
    sketch = rows.agg(F.expr(f"approx_top_k(digest, {counters}, {counters * SLOTS_PER_COUNTER})").alias("top"))
    candidates = sketch.select(F.explode("top.item").alias("digest"))
    winner = F.max(F.struct("doc_id", "uid")).alias("winner")
    hot = materialize(
        rows.join(F.broadcast(candidates), "digest")  # at most `counters` rows
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("group_size"), winner)
        .filter(F.col("group_size") * counters > n_rows),
        "hot_digests",
    )
    marked = rows.join(F.broadcast(hot), "digest", "left")
    # counts combine on the map side; the join back is a plain shuffle join that AQE can split
    others = marked.filter(F.col("winner").isNull()).select("doc_id", "uid", "digest")
    rest = others.join(others.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"), winner), "digest").select(
        "doc_id", "uid", "digest", "group_size", "winner"
    )
    decided = marked.filter(F.col("winner").isNotNull()).select("doc_id", "uid", "digest", "group_size", "winner")
    return decided.unionByName(rest).select(
        "doc_id",
        F.col("winner.doc_id").alias("keep_id"),
        "group_size",
        (F.col("uid") == F.col("winner.uid")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``exact_dedup`` keeps, all columns unchanged.

    A kept row is found again by its id and digest; repeated rows share both,
    and one of them stays.
    """
    kept = materialize(
        exact_dedup(docs, id_col, text_col).filter("kept").select(F.col("doc_id").alias("id"), F.col("text_sha256").alias("key")), "kept_digests"
    )
    return keep_rows(docs, kept, id_col, F.sha2(text_or_empty(text_col), 256))
