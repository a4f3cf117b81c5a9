"""Benchmark decontamination by winnowing, in DataFrame operations only.

Of each ``window`` consecutive words (shorter items: of their own length) the
smallest k-gram hash is kept, on both sides, so any shared span of that many
words shares a kept hash: nothing is missed.  Document and benchmark hashes
are joined; around each hit the document's windows are cut out and joined
with the benchmark's windows word for word, which extends the hits and
removes chance agreements of hashes.

The fingerprint pass lays shifted copies of a text's hash array side by side,
so a window is one struct and needs no indexing.
Kept document hashes are a third of the positions; the benchmark's are a
table of its own, so the planner knows its size and broadcasts it only below
the session's threshold, and joins by a shuffle above it.

Defined cases: NULL and empty texts have no words and hit nothing; an item
without words has no window; repeated documents each get a row; repeated
items and windows count once per item id; items with a NULL id hit but are
not listed; an empty benchmark leaves everything clean; other columns are
not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridplace.llm.common import fresh, materialize, row_key, text_or_empty

#: Characters between words, after A-Z are lower-cased.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MAX_K = 5


def exact_words(text: Column) -> Column:
    """The words that are hashed and the words that are compared: ``lower``
    would fold a letter by its context, so equal words could hash apart."""
    return F.array_remove(F.split(F.translate(text, UPPER, LOWER), BETWEEN), "")


def winnow(df: DataFrame, words: Column, length: int, *keep: str) -> DataFrame:
    """``keep`` columns, n_words, first (the first row of its document), at
    (0-based window start), fingerprint (NULL if there is no window).

    A window's smallest k-gram hash is emitted when it is not the previous
    window's, or when the k-gram that enters has the same hash.  So of any
    k = ``min(MAX_K, length)``, each window's hash was emitted at most
    ``length - k`` windows earlier.
    """
    k = min(MAX_K, length)
    many = length - k + 1  # k-grams of a window
    side_by_side = lambda c, n, size: F.arrays_zip(*[F.slice(c, F.lit(j + 1), size).alias(f"x{j}") for j in range(n)])
    parts = lambda x, n: [x[f"x{j}"] for j in range(n)]
    left = lambda c, n: F.greatest(F.size(c) - F.lit(n - 1), F.lit(0))
    rows = df.select(*keep, words.alias("_w"))
    rows = rows.select(*keep, F.size("_w").alias("n_words"), F.transform("_w", lambda w: F.xxhash64(w)).alias("_h"))
    rows = rows.select(*keep, "n_words", F.transform(side_by_side("_h", k, left("_h", k)), lambda x: F.xxhash64(*parts(x, k))).alias("_g"))
    smallest = F.transform(side_by_side("_g", many, left("_g", many)), lambda x: F.least(*parts(x, many))) if many > 1 else F.col("_g")
    rows = rows.select(*keep, "n_words", "_g", smallest.alias("_m"))
    before = F.concat(F.array(F.lit(None).cast("long")), F.slice("_m", F.lit(1), left("_m", 2)))
    entering = F.slice("_g", F.lit(many), F.size("_m"))
    windows = F.arrays_zip(F.col("_m").alias("m"), before.alias("before"), entering.alias("entering"))
    rows = rows.select(*keep, "n_words", F.posexplode_outer(F.when(F.size("_m") > 0, windows)).alias("at", "_s"))
    first = F.coalesce(F.col("at") == 0, F.lit(True))
    m = F.col("_s.m")
    return rows.filter(first | (m != F.col("_s.before")) | (m == F.col("_s.entering"))).select(
        *keep, "n_words", first.alias("first"), "at", m.alias("fingerprint")
    )


def covered(spans: Column) -> Column:
    """Words inside the union of (at, length) spans."""
    step = lambda acc, s: F.struct(
        (acc["n"] + F.greatest(s["at"] + s["length"] - F.greatest(acc["end"], s["at"]), F.lit(0))).alias("n"),
        F.greatest(acc["end"], s["at"] + s["length"]).alias("end"),
    )
    return F.aggregate(F.array_sort(spans), F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), step, lambda acc: acc["n"])


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Per document: doc_id, key (of id and text), n_words, n_hit, n_items, items_sha256 and items
    (sorted ids of items with an occurring window), contaminated."""
    items = benchmark.select(F.col(item_id_col).cast("string").alias("item_id"), text_or_empty(item_text_col).alias("text"))
    sized = materialize(
        items.select("item_id", "text", exact_words(F.col("text")).alias("w"))
        .select("item_id", "text", "w", F.least(F.size("w"), F.lit(window)).alias("length"))
        .filter("length > 0"),
        "benchmark_words",
    )
    lengths = sorted(r[0] for r in sized.select("length").distinct().collect())  # at most `window` numbers
    rows = docs.select(F.col(id_col).alias("doc_id"), row_key(text_col).alias("key"), text_or_empty(text_col).alias("text"))
    if not lengths:
        lengths = [window]

    hits = []
    for length in lengths:
        marks = materialize(
            winnow(sized.filter(F.col("length") == length), exact_words(F.col("text")), length)
            .select("fingerprint").filter("fingerprint is not null").distinct(),
            "benchmark_fingerprints",
        ).withColumn("found", F.lit(True))
        kept = winnow(rows, exact_words(F.col("text")), length, "doc_id", "key").join(marks, "fingerprint", "left")
        one = F.lit(length == lengths[0])  # one row per document is kept for its words
        hits.append(
            kept.filter((F.col("first") & one) | F.col("found")).select(
                "doc_id", "key", "n_words", (F.col("first") & one).alias("first"), F.when(F.col("found"), F.col("at")).alias("at"), F.lit(length).alias("length")
            )
        )
    hits = materialize(reduce(DataFrame.unionByName, hits), "fingerprint_hits")

    # the windows that each hit can stand for, cut out of the documents that have hits
    spread = F.greatest(F.col("length") - F.lit(MAX_K), F.lit(0))
    places = hits.filter("at is not null").groupBy("doc_id", "key").agg(
        F.collect_set(F.struct("at", (F.col("at") + spread).alias("to"), "length")).alias("places")
    ).select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), "places")
    near = rows.join(places.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")))
    cut = near.select("doc_id", "key", exact_words(F.col("text")).alias("w"), "places").select(
        "doc_id", "key",
        F.explode(
            F.transform(
                F.array_distinct(F.flatten(F.transform(
                    "places",
                    lambda p: F.transform(
                        F.sequence(p["at"], F.least(p["to"], F.greatest(p["at"], F.size("w") - p["length"]))),
                        lambda at: F.struct(at.alias("at"), p["length"].alias("length")),
                    ),
                ))),
                lambda s: F.struct(s["at"].alias("at"), s["length"].alias("length"), F.array_join(F.slice("w", s["at"] + 1, s["length"]), " ").alias("span")),
            )
        ).alias("s"),
    ).select("doc_id", "key", "s.*").distinct()
    spans = materialize(
        sized.select(
            "item_id", "length",
            F.explode(F.transform(
                F.sequence(F.lit(0), F.size("w") - F.col("length")),
                lambda at: F.array_join(F.slice("w", at + 1, F.col("length")), " "),
            )).alias("span"),
        ).distinct(),
        "benchmark_windows",
    )
    found = materialize(
        cut.join(spans, ["span", "length"]).groupBy("doc_id", "key").agg(
            F.collect_set(F.struct("at", "length")).alias("spans"),
            F.array_sort(F.collect_set("item_id")).alias("items"),
        ).select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), covered(F.col("spans")).cast("long").alias("n_hit"), "items"),
        "contaminated",
    )
    none = F.array().cast("array<string>")
    return (
        hits.filter("first")
        .join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")), "left")
        .select(
            "doc_id",
            "key",
            F.col("n_words").cast("long").alias("n_words"),
            F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
            F.sha2(F.array_join(F.coalesce("items", none), ","), 256).alias("items_sha256"),
            F.coalesce("items", none).alias("items"),
            (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        )
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that no benchmark window hits, all columns
    unchanged."""
    dirty, dirty_key = fresh(docs, "_dirty"), fresh(docs, "_dirty_key")
    hit = decontaminate(docs, benchmark, window, id_col, text_col).filter("contaminated")
    found = materialize(hit.select(F.col("doc_id").alias(dirty), F.col("key").alias(dirty_key)).distinct(), "dirty_documents")
    same = F.col(id_col).eqNullSafe(F.col(dirty)) & (row_key(text_col) == F.col(dirty_key))
    return docs.join(found.hint("shuffle_hash"), same, "left_anti")
