"""N-gram Jaccard join in the metric space of shingle sets.

Documents with equal sets are one class; classes link when their sets'
Jaccard similarity is at least ``p / q`` (distance at most e = 1 - p/q).  With
D the symmetric difference and n the set sizes that is
``(q + p) * D <= (q - p) * (n_x + n_y)``, so all comparisons are exact
integers.

Nearly all documents are at distance 1 from any pivot, and inside a group of
near copies all distances lie within the window 2e: nearest-pivot regions of
the whole corpus would copy every document to every region.  So the regions
are made in two steps, and each document is copied to the regions in which a
partner can be:

1. *Regions by shared shingle.*  A pair that links shares one of the first
   n * e + 1 shingles of each in any common order.  The order puts frequent
   shingles last, by a sketch of all shingle counts of a fixed size.  Of a
   region only members stay that have another in reach by size (distance to
   the empty set) and position; the first member of each run of sizes names
   the region, so the many regions of a group of near copies become one cell.
   Within a cell a parity sketch of each set - about n / 2 bits, each the
   parity of the shingles that fall on it - bounds distances from below: every
   bit in which two sketches differ stands for a difference.  Members without
   a partner inside the limit leave.  Only then are whole sets fetched, for
   the few documents left.
2. *Voronoi regions inside a cell.*  Pivots are chosen farthest first, each
   member's exact distance to each pivot is known, and a member is copied to
   every region whose pivot is nearer than its own pivot's distance + 2e (by
   the triangle inequality a partner's region is among them).  Regions are
   joined recursively.  A region that pivots cannot cut further - all
   distances inside the window - is joined around its consensus, the set of
   shingles that more than half of its members have: members whose distances
   to the consensus sum to at most the limit link by the triangle inequality,
   through the nearest member; any other pair that links shares a difference
   to the consensus, so only members that share one are compared.

A cell of more than ``max_cell`` classes is not gathered: its consensus is
counted by Spark, its star of links is written, and its members are filed
again under their differences to the consensus.  Fewer than half of the
members have any one difference, so regions halve until they fit.

Only a spanning forest of each region's links is emitted.

Defined cases: NULL, empty and blank texts have no shingles, are linked with
nothing and are their own component; a text with fewer words than a shingle
has one; NULL ids get a component id but never are one unless all ids of the
component are NULL; repeated rows each get a row; very long texts are sets
like others; an empty table gives an empty result; other columns are not
read.  Shingles are compared by 64-bit hashes, classes by SHA-256 of their
sets.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridplace.llm.bpe_codec import ranges
from gridplace.llm.common import map_arrow, materialize, row_key, text_slices
from gridplace.llm.shingles import Shingler
from gridplace.llm.simhash import components, forest

SLICE_BYTES = 1 << 20
#: Counters of the shingle sketch, in parts that are summed separately.
SKETCH, PARTS = 1 << 20, 64
#: Regions up to this size are compared pair by pair; rows held of one region at most.
SMALL, HOLD = 64, 1 << 20
MAX_CELL = 4096
PIVOTS = 8
#: Classes in cells (about a hundred bytes each) up to which their names are
#: broadcast to the scan of the texts; beyond, texts meet them by a shuffle.
FEW = 200_000
#: Entries of one block of co-occurrence counts.
BLOCK = 1 << 22


class Limit:
    """The similarity p / q as integer conditions."""

    def __init__(self, p: int, q: int) -> None:
        self.p, self.q, self.lo, self.hi = p, q, q - p, q + p
        self.radius = 1 - p / q

    def first(self, n: int) -> int:
        """Shingles of which a partner must have one."""
        return n - -(-self.p * n // self.q) + 1

    def differences(self, n: int) -> int:
        """Most differences between a set of n and a partner."""
        return n * self.lo // self.p

    def can_link(self, n: int) -> bool:
        """Whether a set of n and another that differs are ever in reach."""
        return self.lo * (n + n * self.q // self.p) >= self.hi


# ------------------------------------------------------------------ sets


def documents_as_sets(docs: DataFrame, words: int, id_col: str, text_col: str) -> tuple[DataFrame, np.ndarray]:
    """(doc_id, key, n, digest, who) of all rows, and the frequency class of
    each sketch counter (a power of two of its count against the mean)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), row_key(text_col).alias("key"), F.col(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "key", "n", "digest", "who", "part", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        counts = np.zeros(SKETCH, np.uint32)
        id_kind = None
        for batch in batches:
            id_kind = batch.column(0).type
            for a, texts in text_slices(batch.column(2), SLICE_BYTES):
                sets = [shingler.set_of(t) for t in texts]
                counts += np.bincount(bucket(np.concatenate(sets)), minlength=SKETCH).astype(np.uint32)
                digests = [digest(s) for s in sets]
                k = len(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, k), batch.column(1).slice(a, k), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()),
                     pa.array(list(map(handle, digests)), pa.int64()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())], names
                )
        used = [(i, c) for i, c in enumerate(counts.reshape(PARTS, -1)) if c.any()]
        if used and id_kind is not None:
            yield pa.RecordBatch.from_arrays(
                [*(pa.nulls(len(used), kind) for kind in (id_kind, pa.int64(), pa.int64(), pa.binary(), pa.int64())),
                 pa.array([i for i, _ in used], pa.int32()), pa.array([zlib.compress(c.tobytes(), 1) for _, c in used], pa.binary())], names
            )

    found = materialize(map_arrow(rows, run, f"doc_id {id_type}, key long, n long, digest binary, who long, part int, counts binary"), "shingle_sets")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
                c = np.frombuffer(zlib.decompress(packed.as_py()), np.uint32).astype(np.int64)
                sums[part] = sums.get(part, 0) + c
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], ["part", "counts"])

    sketch = found.filter("part IS NOT NULL").select("part", "counts").repartition("part")
    totals = np.zeros((PARTS, SKETCH // PARTS), np.int64)
    for part, counts in map_arrow(sketch, add, "part int, counts binary").collect():  # PARTS rows, SKETCH counters
        totals[part] = np.frombuffer(counts, np.int64)
    totals = totals.reshape(-1)
    share = totals / max(1.0, totals.sum() / SKETCH)
    return found.filter("part IS NULL").drop("part", "counts"), np.minimum(np.log2(np.maximum(share, 1)), 15).astype(np.uint8)


def bucket(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(44)).astype(np.int64)  # the upper 20 bits


def codes(shingles: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Shingles in the common order, rare ones first: class and then hash.
    Two shingles of one code count as one, which only lowers a bound."""
    return np.sort((classes[bucket(shingles)].astype(np.uint64) << np.uint64(60)) | (shingles >> np.uint64(4)))


def parity(shingles: np.ndarray) -> np.ndarray:
    """Bits (64 to a word) that tell whether an odd number of shingles falls on them."""
    bits = 1 << min(16, max(6, (len(shingles) // 2).bit_length()))
    odd = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


def folded(words: np.ndarray) -> np.ndarray:
    """Parity sketches of half as many bits."""
    half = words.shape[-1] // 2
    return words[..., :half] ^ words[..., half:]


def digest(shingles: np.ndarray) -> bytes:
    return hashlib.sha256(shingles.tobytes()).digest()


def handle(digest: bytes) -> int:
    """Short name of a class.  Two classes may share it: they are then
    fetched together and told apart by their digests."""
    return int.from_bytes(digest[:8], "little", signed=True)


def first_shingles(docs: DataFrame, limit: Limit, classes: np.ndarray, words: int, text_col: str) -> DataFrame:
    """(who, n, codes, parity): the first shingles in order and the parity
    sketch of each set that can link with another.  Copies in one task are
    one row."""
    shared = docs.sparkSession.sparkContext.broadcast(classes)  # SKETCH bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        seen: set[bytes] = set()
        for batch in batches:
            for _, texts in text_slices(batch.column(0), SLICE_BYTES):
                out: list[tuple] = []
                for t in texts:
                    s = shingler.set_of(t)
                    name = digest(s)
                    if not limit.can_link(len(s)) or name in seen:
                        continue
                    if len(seen) >= HOLD:
                        seen.clear()
                    seen.add(name)
                    out.append((handle(name), len(s), codes(s, shared.value)[: limit.first(len(s))], parity(s).tobytes()))
                if out:
                    who, n, first, bits = zip(*out)
                    offsets = pa.array(np.concatenate(([0], np.cumsum([len(f) for f in first]))).astype(np.int32))
                    listed = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(first).view(np.int64)))
                    yield pa.RecordBatch.from_arrays([pa.array(who, pa.int64()), pa.array(n, pa.int32()), listed, pa.array(bits, pa.binary())], ["who", "n", "codes", "parity"])

    return materialize(map_arrow(docs.select(text_col), run, "who long, n int, codes array<long>, parity binary"), "first_shingles")


# --------------------------------------------------------------- regions


def within_reach(region: np.ndarray, who: np.ndarray, n: np.ndarray, at: np.ndarray, limit: Limit) -> tuple[np.ndarray, np.ndarray]:
    """Of rows sorted by (region, n, who): the rows that have another member
    in reach, and for each the row that names its cell."""
    count = len(region)
    n, at = n.astype(np.int64), at.astype(np.int64)
    new = np.ones(count, bool)
    new[1:] = region[1:] != region[:-1]
    begin = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    sizes = np.diff(np.append(begin, count))
    kept, cell = [], []
    # small regions: pair by pair, cells are what the pairs connect
    left, right = [], []
    alive = np.flatnonzero((sizes[group] > 1) & (sizes[group] <= SMALL))
    shift = 1
    while len(alive):
        other = alive + shift
        alive, other = alive[other < count], other[other < count]
        open_ = (group[alive] == group[other]) & (limit.q * n[alive] >= limit.p * n[other])
        alive, other = alive[open_], other[open_]
        ok = (limit.hi * (at[alive] + at[other]) <= limit.lo * (n[alive] + n[other])) & (who[alive] != who[other])
        left.append(alive[ok])
        right.append(other[ok])
        shift += 1
    a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right))
    if len(a):
        touched = np.unique(np.concatenate((a, b)))
        i, j = np.searchsorted(touched, a), np.searchsorted(touched, b)
        others, roots = forest(len(touched), i, j)
        name = touched.copy()
        name[others] = touched[roots]
        kept.append(touched)
        cell.append(name)
    # large regions: the best partner in the region, cells are runs of sizes
    for g in np.flatnonzero(sizes > SMALL):
        rows = np.arange(begin[g], begin[g] + sizes[g])
        cost = limit.hi * at[rows] - limit.lo * n[rows]
        best = int(cost.argmin())
        second = np.partition(cost, 1)[1]
        partner = np.full(len(rows), cost[best])
        partner[best] = second
        rows = rows[cost + partner <= 0]
        if len(rows) < 2:
            continue
        k, c = by_runs(rows, who, n, limit)
        kept.append(k)
        cell.append(c)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *kept]), np.concatenate([none, *cell])


def by_runs(rows: np.ndarray, who: np.ndarray, n: np.ndarray, limit: Limit) -> tuple[np.ndarray, np.ndarray]:
    """Cells of runs of sizes without a gap that no pair can span."""
    cut = np.ones(len(rows), bool)
    cut[1:] = limit.q * n[rows[:-1]] < limit.p * n[rows[1:]]
    run = np.cumsum(cut) - 1
    first = rows[cut][run]
    some = np.zeros(run[-1] + 1, bool)  # runs of one class are no region
    np.logical_or.at(some, run, who[rows] != who[first])
    use = some[run]
    return rows[use], first[use]


def regions_to_cells(files: DataFrame, limit: Limit, merge: bool, hold: int = HOLD) -> DataFrame:
    """(cell, who), distinct.  ``merge``: regions named by one member are one
    cell; else each run of a region stays a cell of its own.  Of a region with
    more than ``hold`` rows all members pass, run by run."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        through: tuple | None = None  # the region that is too large to hold: its name, and the last row's n and cell

        def out(region: np.ndarray, who: np.ndarray, kept: np.ndarray, cell: np.ndarray) -> pa.RecordBatch:
            name = who[cell] if merge else (region[cell].view(np.uint64) ^ (who[cell].view(np.uint64) >> np.uint64(1))).view(np.int64)
            pair = np.unique(np.stack((name, who[kept]), 1), axis=0) if len(kept) else np.zeros((0, 2), np.int64)
            return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pair[:, 0])), pa.array(np.ascontiguousarray(pair[:, 1]))], ["cell", "who"])

        for batch in batches:
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols)]
                held = None
            if not len(cols[0]):
                continue
            if through is not None:
                same = cols[0] == through[0]
                if same.any():
                    region, who, n, at = (c[same] for c in cols)
                    rows = np.arange(len(region) + 1)
                    n_all, who_all, region_all = np.append(through[1], n), np.append(through[2], who), np.append(through[0], region)
                    cut = limit.q * n_all[:-1].astype(np.int64) < limit.p * n_all[1:].astype(np.int64)
                    first = np.maximum.accumulate(np.where(np.append(False, cut), rows, 0))
                    yield out(region_all, who_all, rows[1:], first[1:])
                    through = (through[0], n_all[-1], who_all[first[-1]])
                    cols = [c[~same] for c in cols]
                if not len(cols[0]):
                    continue
                through = None
            last = cols[0] == cols[0][-1]
            done = [c[~last] for c in cols]
            if len(done[0]):
                kept, cell = within_reach(*done, limit)
                yield out(done[0], done[1], kept, cell)
            tail = [c[last] for c in cols]
            if len(tail[0]) > hold:
                rows = np.arange(len(tail[0]))
                cut = np.append(True, limit.q * tail[2][:-1].astype(np.int64) < limit.p * tail[2][1:].astype(np.int64))
                first = np.maximum.accumulate(np.where(cut, rows, 0))
                yield out(tail[0], tail[1], rows, first)
                through = (tail[0][-1], tail[2][-1], tail[1][first[-1]])
            else:
                held = tail
        if held is not None and len(held[0]):
            kept, cell = within_reach(*held, limit)
            yield out(held[0], held[1], kept, cell)

    dealt = files.repartition("region").sortWithinPartitions("region", "n", "who")
    return materialize(map_arrow(dealt, run, "cell long, who long").distinct(), "cells")


def within_bound(sketches: list[np.ndarray], n: np.ndarray, limit: Limit) -> tuple[np.ndarray, np.ndarray]:
    """Members of a cell with a partner whose distance the sketches do not
    bound beyond the limit, and for each the member that names its part."""
    m = len(sketches)
    width = np.array([len(s) for s in sketches])
    left, right = [], []
    for w in np.unique(width):
        mine, wider = np.flatnonzero(width == w), np.flatnonzero(width == 2 * w)
        rows = np.stack([sketches[i] for i in mine])
        others, them = rows, mine
        if len(wider):  # sizes in reach differ by one fold at most
            others, them = np.concatenate((rows, folded(np.stack([sketches[i] for i in wider])))), np.concatenate((mine, wider))
        step = max(1, BLOCK // (len(them) * int(w)))
        for at in range(0, len(mine), step):
            x = mine[at : at + step]
            far = np.bitwise_count(rows[at : at + step, None, :] ^ others[None, :, :]).sum(axis=2, dtype=np.int64)
            a, b = n[x][:, None], n[them][None, :]
            ok = (limit.hi * far <= limit.lo * (a + b)) & (limit.q * np.minimum(a, b) >= limit.p * np.maximum(a, b)) & (x[:, None] != them[None, :])
            i, j = np.nonzero(ok)
            some, roots = forest(m, x[i], them[j])
            left.append(some)
            right.append(roots)
    x, y = np.concatenate(left), np.concatenate(right)
    kept = np.unique(np.concatenate((x, y)))
    if not len(kept):
        return kept, kept
    some, roots = forest(len(kept), np.searchsorted(kept, x), np.searchsorted(kept, y))
    name = kept.copy()
    name[some] = kept[roots]
    return kept, name


def prune_cells(cells: DataFrame, first: DataFrame, limit: Limit, max_cell: int) -> DataFrame:
    """(cell, who) without the members that no other is near, cut into what
    the remaining pairs connect.  A cell too large for a task passes."""
    large = materialize(cells.groupBy("cell").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > max_cell).select("cell"), "crowded_cells")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, members = None, []

        def solve() -> Iterator[pa.RecordBatch]:
            if len(members) > 1:
                who = np.array([x[0] for x in members], np.int64)
                kept, name = within_bound([np.frombuffer(x[2], np.uint64) for x in members], np.array([x[1] for x in members], np.int64), limit)
                if len(kept):
                    # a part is named by its cell and its first member
                    salt = np.uint64(cell * 0x9E3779B97F4A7C15 % (1 << 64))
                    yield pa.RecordBatch.from_arrays([pa.array((who[name].view(np.uint64) + salt).view(np.int64)), pa.array(who[kept])], ["cell", "who"])

        for batch in batches:
            for c, *member in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if c != cell:
                    yield from solve()
                    cell, members = c, []
                if not members or members[-1] != member:  # else a copy from another task
                    members.append(member)
        yield from solve()

    sketched = cells.join(large, "cell", "left_anti").join(first.select("who", "n", "parity"), "who").select("cell", "who", "n", "parity")
    kept = map_arrow(sketched.repartition("cell").sortWithinPartitions("cell", "who", "n", "parity"), run, "cell long, who long")
    return materialize(kept.unionByName(cells.join(large, "cell", "left_semi")).distinct(), "pruned_cells")


# ----------------------------------------------------------------- cells


class Cell:
    """The sets of one cell: shingles numbered, members' shingles in a row."""

    def __init__(self, sets: list[np.ndarray], limit: Limit) -> None:
        self.limit = limit
        self.n = np.array([len(s) for s in sets], np.int64)
        self.begin = np.concatenate(([0], np.cumsum(self.n)[:-1])).astype(np.int64)
        names, self.tokens = np.unique(np.concatenate(sets), return_inverse=True)
        self.width = len(names)

    def of(self, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers in the list (0, 1, ...) and shingles of the members."""
        return np.repeat(np.arange(len(members)), self.n[members]), self.tokens[ranges(self.begin[members], self.n[members])]

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        left, right = [], []
        todo = [np.arange(len(self.n))]
        while todo:
            members = todo.pop()
            if len(members) < 2:
                continue
            regions = self.voronoi(members) if len(members) > SMALL else None
            if regions is not None:
                todo += regions
                continue
            a, b = self.around_consensus(members)
            left.append(members[a])
            right.append(members[b])
        a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right))
        return forest(len(self.n), a, b)

    def voronoi(self, members: np.ndarray) -> list[np.ndarray] | None:
        """Regions of the nearest pivot with the copies that the triangle
        inequality asks for; None if they are no smaller than the whole."""
        own, tokens = self.of(members)
        n = self.n[members]
        distance = np.ones((len(members), 0))
        pivot = int(np.abs(n - np.median(n)).argmin())
        for _ in range(PIVOTS):
            mark = np.zeros(self.width, bool)
            mark[tokens[own == pivot]] = True
            common = np.bincount(own, weights=mark[tokens], minlength=len(members))
            distance = np.column_stack((distance, 1 - common / (n + n[pivot] - common)))
            nearest = distance.min(axis=1)
            pivot = int(nearest.argmax())
            if nearest[pivot] <= self.limit.radius:
                break
        inside = distance <= nearest[:, None] + 2 * self.limit.radius + 1e-9
        home = distance.argmin(axis=1)
        inside[:, np.setdiff1d(np.arange(distance.shape[1]), home)] = False
        sizes = inside.sum(axis=0)
        if sizes.sum() > 1.25 * len(members) or sizes.max() > 0.9 * len(members):
            return None
        return [members[inside[:, j]] for j in range(distance.shape[1]) if sizes[j] > 1]

    def differences(self, members: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number, shingle of each difference to the consensus, and how many
        each member has."""
        own, tokens = self.of(members)
        most = np.bincount(tokens, minlength=self.width) * 2 > len(members)
        core = np.flatnonzero(most)
        place = np.full(self.width, -1)
        place[core] = np.arange(len(core))
        extra = ~most[tokens]
        who, what = [own[extra]], [tokens[extra]]
        step = max(1, BLOCK // max(1, len(core)))
        for at in range(0, len(members) if len(core) else 0, step):
            end = min(at + step, len(members))
            part = slice(*np.searchsorted(own, (at, end)))
            has = np.zeros((end - at, len(core)), bool)
            both = ~extra[part]
            has[own[part][both] - at, place[tokens[part][both]]] = True
            row, col = np.nonzero(~has)
            who.append(row + at)
            what.append(core[col])
        who, what = np.concatenate(who), np.concatenate(what)
        return who, what, np.bincount(who, minlength=len(members))

    def around_consensus(self, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Links that connect what all links of the members connect."""
        lim, m = self.limit, len(members)
        n = self.n[members]
        who, what, far = self.differences(members)
        cost = lim.hi * far - lim.lo * n
        near = int(cost.argmin())
        close = cost + cost[near] <= 0  # linked with the nearest one by the triangle inequality
        star = np.setdiff1d(np.flatnonzero(close), near)
        left, right = [star], [np.full(len(star), near)]
        shell = ~close
        order = np.lexsort((who, what))
        listed, shingle = who[order], what[order]
        begin = np.searchsorted(shingle, np.arange(self.width + 1))
        mine = np.flatnonzero(shell[who])
        mine = mine[np.argsort(who[mine], kind="stable")]
        lists = begin[what[mine] + 1] - begin[what[mine]]
        rows = np.flatnonzero(shell)
        total = np.concatenate(([0], np.cumsum(np.bincount(who[mine], weights=lists, minlength=m)[rows])))
        at = 0
        while at < len(rows):
            end = int(max(at + 1, min(np.searchsorted(total, total[at] + BLOCK, "right") - 1, at + max(1, BLOCK // m))))
            part = slice(*np.searchsorted(who[mine], (rows[at], rows[end - 1] + 1)))
            me = mine[part]
            place = np.searchsorted(rows[at:end], who[me])
            met = listed[ranges(begin[what[me]], lists[part])]
            shared = np.bincount(np.repeat(place, lists[part]) * m + met, minlength=(end - at) * m)
            code = np.flatnonzero(shared)
            x, y = rows[at + code // m], code % m
            real = (x != y) & (lim.hi * (far[x] + far[y] - 2 * shared[code]) <= lim.lo * (n[x] + n[y]))
            left.append(x[real])
            right.append(y[real])
            at = end
        return np.concatenate(left), np.concatenate(right)


def join_cells(members: DataFrame, limit: Limit) -> DataFrame:
    """(a, b): links of cells that fit in a task.  ``members``: cell, digest, shingles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, digests, sets = None, [], []

        def solve() -> Iterator[pa.RecordBatch]:
            if len(sets) > 1:
                a, b = Cell(sets, limit).links()
                yield pa.RecordBatch.from_arrays([pa.array([digests[i] for i in a], pa.binary()), pa.array([digests[i] for i in b], pa.binary())], ["a", "b"])

        for batch in batches:
            for cell, digest, shingles in zip(*(batch.column(i) for i in range(3))):
                if cell.as_py() != name:
                    yield from solve()
                    name, digests, sets = cell.as_py(), [], []
                if not digests or digests[-1] != digest.as_py():  # else a repeated row
                    digests.append(digest.as_py())
                    sets.append(np.frombuffer(shingles.as_py(), np.uint64))
        yield from solve()

    return map_arrow(members.repartition("cell").sortWithinPartitions("cell", "digest"), run, "a binary, b binary")


def cut_cells(members: DataFrame, limit: Limit, classes: np.ndarray) -> tuple[DataFrame, DataFrame]:
    """Cells too large for a task: the links through each one's nearest member
    (a, b), and the members filed under their differences to the consensus."""
    spark = members.sparkSession
    shared = spark.sparkContext.broadcast(classes)

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell, shingles in zip(batch.column(0), batch.column(1)):
                s = np.frombuffer(shingles.as_py(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), cell.as_py())), pa.array(s)], ["cell", "shingle"])

    sizes = members.groupBy("cell").agg(F.count(F.lit(1)).alias("size"))
    counts = map_arrow(members.select("cell", "shingles"), spell, "cell long, shingle long").groupBy("cell", "shingle").agg(F.count(F.lit(1)).alias("k"))
    # more than half of the members have each: at most twice the mean set size
    core = counts.join(sizes, "cell").filter("2 * k > size").groupBy("cell").agg(F.collect_list("shingle").alias("core"))
    with_core = members.join(core, "cell", "left").select("cell", "digest", "shingles", F.coalesce("core", F.array().cast("array<long>")).alias("core"))
    names = ["cell", "digest", "who", "n", "cost", "differences"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for cell, digest, shingles, core_ in zip(*(batch.column(i) for i in range(4))):
                s = np.frombuffer(shingles.as_py(), np.uint64)
                diff = np.setxor1d(s, core_.values.to_numpy().view(np.uint64))
                cost = limit.hi * len(diff) - limit.lo * len(s)
                first = codes(diff, shared.value)[: limit.differences(len(s)) + 1]
                out.append((cell.as_py(), digest.as_py(), handle(digest.as_py()), len(s), cost, first.view(np.int64)))
            if out:
                cols = list(zip(*out))
                kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds)], names)

    placed = materialize(map_arrow(with_core, compare, "cell long, digest binary, who long, n int, cost long, differences array<long>"), "placed_members")
    nearest = placed.groupBy("cell").agg(F.min(F.struct("cost", "digest")).alias("near"))
    placed = placed.join(nearest, "cell").withColumn("close", F.col("cost") + F.col("near.cost") <= 0)
    star = placed.filter(F.col("close") & (F.col("digest") != F.col("near.digest"))).select(F.col("digest").alias("a"), F.col("near.digest").alias("b"))
    again = placed.select("cell", "who", "n", "close", F.posexplode("differences").alias("at", "shingle")).select(F.xxhash64("cell", "shingle").alias("region"), "who", "n", "at", "close")
    again = materialize(again, "refiled_members")
    # members that are all close to the nearest one are connected already
    undecided = again.filter(~F.col("close")).select("region").distinct()
    return star, again.drop("close").join(undecided, "region", "left_semi").select("region", "who", "n", "at")


# ------------------------------------------------------------------ join


def jaccard_join(
    docs: DataFrame,
    words: int = 3,
    similarity: tuple[int, int] = (9, 10),
    id_col: str = "doc_id",
    text_col: str = "text",
    max_cell: int = MAX_CELL,
) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (the smallest id
    reachable by links, its own included)."""
    limit = Limit(*similarity)
    prints, classes = documents_as_sets(docs, words, id_col, text_col)
    least = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key")).alias("least")
    named = materialize(prints.filter("n > 0").groupBy("digest", "who").agg(least), "shingle_classes")
    links = class_links(docs, named, limit, classes, words, id_col, text_col, max_cell)
    label = components(links)
    joined = named.join(label.select(F.col("node").alias("digest"), "label"), "digest", "left").withColumn("label", F.coalesce("label", "digest"))
    joined = materialize(joined, "labelled_sets")
    groups = joined.groupBy("label").agg(F.min("least").alias("first"))
    of_class = materialize(joined.join(groups, "label").select("digest", F.col("first.doc_id").alias("component_id")), "named_sets")
    with_words = prints.filter("n > 0").join(of_class, "digest").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return with_words.unionByName(prints.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def class_links(docs: DataFrame, named: DataFrame, limit: Limit, classes: np.ndarray, words: int, id_col: str, text_col: str, max_cell: int) -> DataFrame:
    """(a, b): digests of linked classes, enough to connect what all links connect."""
    first = first_shingles(docs, limit, classes, words, text_col)
    files = first.select(F.posexplode("codes").alias("at", "region"), "who", "n").select("region", "who", "n", "at")
    cells = prune_cells(regions_to_cells(files, limit, merge=True), first, limit, max_cell)
    sets = materialize(fetch(docs, named, cells, words, id_col, text_col), "sets_in_cells")
    links = None
    while True:
        # thin rows go to the sets while they are few, so sets are shuffled once
        meeting = F.broadcast(cells) if cells.count() <= FEW else cells
        members = sets.join(meeting, "who").select("cell", "digest", "shingles")
        large = materialize(cells.groupBy("cell").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > max_cell).select("cell"), "large_cells")
        found = materialize(join_cells(members.join(large, "cell", "left_anti"), limit), "links")
        links = found if links is None else links.unionByName(found)
        if large.isEmpty():
            return links
        star, files = cut_cells(materialize(members.join(large, "cell", "left_semi").dropDuplicates(["cell", "digest"]), "large_members"), limit, classes)
        links = links.unionByName(materialize(star, "links"))
        cells = regions_to_cells(files, limit, merge=False)


def fetch(docs: DataFrame, named: DataFrame, cells: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """(who, digest, shingles) of the classes in cells, from one document of each."""
    wanted = named.join(cells.select("who").distinct(), "who", "left_semi").select("who", "digest", F.col("least.doc_id").alias("its_id"), F.col("least.key").alias("its_key"))
    rows = docs.select(F.col(id_col).alias("doc_id"), row_key(text_col).alias("key"), F.col(text_col).alias("text"))
    same = F.col("doc_id").eqNullSafe(F.col("its_id")) & (F.col("key") == F.col("its_key"))
    wanted = materialize(wanted, "classes_in_cells")
    few = wanted.count() <= FEW  # from the file footers
    texts = rows.join(F.broadcast(wanted) if few else wanted, same).select("who", "digest", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            for a, part in text_slices(batch.column(2), SLICE_BYTES):
                sets = [shingler.set_of(t) for t in part]
                mine = [i for i, s in enumerate(sets) if digest(s) == batch.column(1)[a + i].as_py()]
                at = pa.array([a + i for i in mine], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array([sets[i].tobytes() for i in mine], pa.binary())], ["who", "digest", "shingles"])

    return map_arrow(texts, run, "who long, digest binary, shingles binary")
