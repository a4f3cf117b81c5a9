"""SimHash near-duplicates with pivot distance tables.

Fingerprints are 64 bits; two documents link when at most ``max_bits`` bits
differ, and a component is what links reach.  Documents with the same
fingerprint are one class (map-side combine), so the search sees distinct
fingerprints only.

Search: cut the 64 bits into ``max_bits + 3`` blocks.  Two fingerprints that
link agree on at least three blocks, so each fingerprint is filed once under
every choice of three blocks (about 32 key bits) and meets only those that
agree on one.  Inside a file, the table of Hamming distances to the pivots is
computed once per fingerprint.  By the triangle inequality the distances of a
linked pair to any pivot differ by at most ``max_bits``: the file is sorted by
the first pivot's distance and compared only as far as that allows, pairs
with a larger difference at any pivot are discarded, and the survivors are
verified by their exact distance.

Only a spanning forest of each file's links is emitted, so links grow with
the fingerprints, not with the pairs of a dense group.  A file of more than
``max_file`` fingerprints is not gathered: its rows pass through and are filed
again under three of six blocks of their remaining bits.  These second files
agree on at least 46 bits and so cannot hold more than 2^18 distinct
fingerprints, whatever the input; a large one looks up each fingerprint's
neighbours by flipping its free bits instead of comparing pairs.

Components: the smallest label of the neighbours, then the label's own label,
until nothing changes; each round is written to the checkpoint folder.

Defined cases: a text with fewer words than a shingle has one shingle, the
whole sequence; NULL and empty texts have fingerprint zero and link like any
other; NULL ids get a component id but never are one unless all ids of the
component are NULL; repeated rows each get a row; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridplace.llm.common import keep_rows, map_arrow, materialize, row_key, text_or_empty

BITS = 64
N_PIVOTS = 24
AGREE = 3
FIRST_FILE = 1024
LINK, FILE = 0, 1


def pivots() -> np.ndarray:
    """Reference fingerprints: the digests of the numbers 0, 1, ..."""
    return np.array([xxhash.xxh64_intdigest(str(i).encode(), seed=42) for i in range(N_PIVOTS)], np.uint64)


def fingerprint(text: str, words_per_shingle: int) -> int:
    """A bit is set when more than half of the shingles' hashes have it."""
    lowered = text.encode("utf-8", "surrogatepass").lower()  # bytes: A-Z only
    words = lowered.split()  # space and 09-0D
    if not words:
        return 0
    whole = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    first = np.concatenate(([0], ends[:-1])).tolist()
    k = min(words_per_shingle, len(words))
    last = (ends - 1)[k - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(last), 1 << 16):  # bounded memory for very long texts
        block = np.array([digest(whole[a:b], 42) for a, b in zip(first[at : at + (1 << 16)], last[at : at + (1 << 16)])], np.uint64)
        counts += np.unpackbits(block.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(last)).tobytes(), "big")


def fingerprints(docs: DataFrame, words_per_shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, key, fp (the fingerprint as a signed long)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), row_key(text_col).alias("key"), text_or_empty(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py(), words_per_shingle) for t in batch.column(2)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps.view(np.int64))], ["doc_id", "key", "fp"])

    return map_arrow(rows, run, f"doc_id {id_type}, key long, fp long")


def cut_bits(mask: int, parts: int) -> list[int]:
    """Masks of ``parts`` nearly equal runs of the set bits of ``mask``."""
    bits = [b for b in range(BITS) if mask >> b & 1]
    edges = [round(i * len(bits) / parts) for i in range(parts + 1)]
    return [sum(1 << b for b in bits[a:z]) for a, z in zip(edges, edges[1:])]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def long_lit(x: int) -> Column:
    return F.lit(signed(x)).cast("long")


def choices(max_bits: int) -> list[int]:
    """Masks of the bits on which a linked pair agrees for some choice."""
    return [a | b | c for a, b, c in combinations(cut_bits((1 << BITS) - 1, max_bits + AGREE), AGREE)]


def file_under(fps: DataFrame, masks: Column) -> DataFrame:
    """fp filed under each mask: file (mask and the bits under it), near
    (distance to the first pivot)."""
    return fps.select("fp", F.explode(masks).alias("mask")).select(
        "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("bits"), F.bit_count(F.col("fp").bitwiseXOR(long_lit(int(pivots()[0])))).alias("near"), "fp"
    )


def forest(n: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star per component of the links i-j among n things."""
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if (label == before).all():
            break
    other = np.flatnonzero(label != np.arange(n))
    return other, label[other]


def link_near(key: np.ndarray, near: np.ndarray, fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside files.  ``key``: file number, sorted; within a file
    ``near`` is sorted."""
    table = np.bitwise_count(fp[:, None] ^ pivots()[None, :]).astype(np.int8)
    left, right = [], []
    alive = np.arange(len(fp) - 1)
    shift = 1
    while len(alive):
        other = alive + shift
        alive, other = alive[other < len(fp)], other[other < len(fp)]
        open_ = (key[alive] == key[other]) & (near[other] - near[alive] <= max_bits)
        alive, other = alive[open_], other[open_]
        ok = np.abs(table[alive] - table[other]).max(axis=1, initial=0) <= max_bits
        a, b = alive[ok], other[ok]
        real = np.bitwise_count(fp[a] ^ fp[b]) <= max_bits
        left.append(a[real])
        right.append(b[real])
        shift += 1
    a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right))
    return forest(len(fp), a, b)


def link_by_flips(fp: np.ndarray, free: int, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of one file of distinct fingerprints that agree outside ``free``:
    flip up to ``max_bits`` free bits and look the result up."""
    order = np.argsort(fp)
    ranked = fp[order]
    bits = [np.uint64(1 << b) for b in range(BITS) if free >> b & 1]
    left, right = [], []
    for k in range(1, max_bits + 1):
        for chosen in combinations(bits, k):
            want = ranked ^ np.bitwise_or.reduce(np.array(chosen, np.uint64))
            at = np.minimum(np.searchsorted(ranked, want), len(ranked) - 1)
            hit = np.flatnonzero((ranked[at] == want) & (want > ranked))
            left.append(order[hit])
            right.append(order[at[hit]])
    return forest(len(fp), np.concatenate(left), np.concatenate(right))


def linker(max_bits: int, max_file: int | None):
    """Batches sorted by (mask, bits, near) -> links; rows of files larger
    than ``max_file`` pass through as kind FILE (None: no file is too large)."""
    small = max_file or FIRST_FILE

    def out(kind: int, a: np.ndarray, b: np.ndarray, mask: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(a), kind, np.int8)), pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.array(mask.view(np.int64))], ["kind", "a", "b", "mask"]
        )

    def solve(mask: np.ndarray, bits: np.ndarray, near: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Whole files."""
        if not len(fp):
            return
        new = np.concatenate(([True], (mask[1:] != mask[:-1]) | (bits[1:] != bits[:-1])))
        begin = np.flatnonzero(new)
        sizes = np.diff(np.append(begin, len(fp)))
        key = np.cumsum(new) - 1
        big = sizes > small
        use = ~big[key] & (sizes[key] > 1)
        x, y = link_near(key[use], near[use], fp[use], max_bits)
        f = fp[use]
        yield out(LINK, f[x], f[y], np.zeros(len(x), np.uint64))
        for g in np.flatnonzero(big):
            s = slice(begin[g], begin[g] + sizes[g])
            x, y = link_by_flips(fp[s], ~int(mask[begin[g]]) & ((1 << 64) - 1), max_bits)
            yield out(LINK, fp[s][x], fp[s][y], np.zeros(len(x), np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        passing = None  # the file that is too large to gather
        for batch in batches:
            cols = [batch.column(i).to_numpy() for i in range(4)]
            cols = [c.view(np.uint64) if k != 2 else c.astype(np.int64) for k, c in enumerate(cols)]
            if not len(cols[0]):
                continue
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols)]
            mask, bits, near, fp = cols
            if passing is not None:
                same = (mask == passing[0]) & (bits == passing[1])
                if same.any():
                    yield out(FILE, fp[same], bits[same], mask[same])
                    mask, bits, near, fp = (c[~same] for c in cols)
                if not len(fp):
                    held = None
                    continue
                passing = None
            last = (mask == mask[-1]) & (bits == bits[-1])
            done = ~last
            if max_file is not None:
                # files that ended in this batch but are too large pass through as well
                new = np.concatenate(([True], (mask[1:] != mask[:-1]) | (bits[1:] != bits[:-1])))
                sizes = np.diff(np.append(np.flatnonzero(new), len(fp)))
                large = (sizes > max_file)[np.cumsum(new) - 1]
                if large.any():
                    yield out(FILE, fp[large], bits[large], mask[large])
                if large[-1]:
                    passing = (mask[-1], bits[-1])
                done = done & ~large
                last = last & ~large
            yield from solve(mask[done], bits[done], near[done], fp[done])
            held = [c[last] for c in (mask, bits, near, fp)] if last.any() else None
        if held is not None:
            yield from solve(*held)

    return run


def links(fps: DataFrame, max_bits: int, max_file: int = FIRST_FILE) -> DataFrame:
    """Links (a, b) among distinct fingerprints that connect exactly what all
    links connect."""
    schema = "kind byte, a long, b long, mask long"
    by_file = ("mask", "bits")

    def meet(filed: DataFrame, limit: int | None) -> DataFrame:
        dealt = filed.repartition(*by_file).sortWithinPartitions(*by_file, "near")
        return map_arrow(dealt, linker(max_bits, limit), schema)

    first = F.array(*[long_lit(m) for m in choices(max_bits)])
    found = materialize(meet(file_under(fps, first), max_file), "simhash_links")
    second = F.create_map(*[
        x for m in choices(max_bits)
        for x in (long_lit(m), F.array(*[long_lit(m | a | b | c) for a, b, c in combinations(cut_bits(~m & ((1 << BITS) - 1), max_bits + AGREE), AGREE)]))
    ])
    # a fingerprint may come from several crowded files
    crowded = found.filter(F.col("kind") == FILE).select(F.col("a").alias("fp"), "mask")
    refiled = file_under(crowded.withColumn("masks", second[F.col("mask")]).drop("mask"), F.col("masks")).distinct()
    rest = meet(refiled, None)
    return found.filter(F.col("kind") == LINK).select("a", "b").unionByName(rest.select("a", "b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, label: the smallest node reachable over the edges (a, b)."""
    both = materialize(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("label")), "labels")
    while True:
        seen = both.join(labels.select(F.col("node").alias("b"), "label"), "b").select(F.col("a").alias("node"), "label")
        lower = materialize(seen.unionByName(labels).groupBy("node").agg(F.min("label").alias("label")), "labels")
        jump = lower.select(F.col("node").alias("label"), F.col("label").alias("further"))
        jumped = materialize(lower.join(jump, "label").select("node", F.col("further").alias("label")), "labels")
        changed = jumped.join(labels.select("node", F.col("label").alias("was")), "node").filter("label <> was").limit(1).count()
        labels = jumped
        if not changed:
            return labels


def grouped(docs: DataFrame, words_per_shingle: int, max_bits: int, id_col: str, text_col: str, max_file: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, key, fp) of all rows, and (fp, label, least) of all distinct
    fingerprints: ``least`` is the component's first document, by id (NULL
    last) and key."""
    prints = materialize(fingerprints(docs, words_per_shingle, id_col, text_col), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key")).alias("least")
    classes = materialize(prints.groupBy("fp").agg(first), "fingerprint_classes")
    label = components(links(classes.select("fp"), max_bits, max_file))
    linked = classes.join(label.select(F.col("node").alias("fp"), "label"), "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    linked = materialize(linked, "labelled_classes")
    groups = materialize(linked.groupBy("label").agg(F.min("least").alias("least")), "components")
    return prints, materialize(linked.drop("least").join(groups, "label"), "named_classes")


def simhash_dedup(
    docs: DataFrame,
    words_per_shingle: int = 3,
    max_bits: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_file: int = FIRST_FILE,
) -> DataFrame:
    """Per document: doc_id, fingerprint (16 hex digits), component_id (the
    smallest id reachable by links, its own included)."""
    prints, named = grouped(docs, words_per_shingle, max_bits, id_col, text_col, max_file)
    # both sides are plain tables: a fingerprint that a third of all documents share is split by AQE
    return prints.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("least.doc_id").alias("component_id"))


def keep_one_of_each_component(
    docs: DataFrame, words_per_shingle: int = 3, max_bits: int = 3, id_col: str = "doc_id", text_col: str = "text", max_file: int = FIRST_FILE
) -> DataFrame:
    """The row of ``docs`` with the smallest id of each component, all columns
    unchanged; of rows that repeat its id and text one stays."""
    _, named = grouped(docs, words_per_shingle, max_bits, id_col, text_col, max_file)
    stays = materialize(named.select(F.col("least.doc_id").alias("id"), F.col("least.key").alias("key")).distinct(), "component_firsts")
    return keep_rows(docs, stays, id_col, row_key(text_col))
