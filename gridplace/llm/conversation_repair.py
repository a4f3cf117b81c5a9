"""Conversation structure repair by Knuth's lightest-derivation agenda.

A conversation is legal when its roles' initials read ``(s?(ua)+)?``.  Edits
turn the rows of a conversation, in order, into a legal one:

* K keeps a row (cost 0), R changes its role to user or assistant (2), D
  deletes it (3; blank and repeated rows must go), I inserts an empty user or
  assistant row anywhere (2); a truncated row that stays adds 1.

The cheapest repair is the lightest derivation of a weighted deduction system
whose items are the rows and the suffixes ``(i, q)``: "rows i and on, read
from state q of the automaton, can be made legal".

    Keep, Rerole, Delete:  Row(i), Suffix(i+1, q')  ->  Suffix(i, q)
    Insert:                Suffix(i, q')            ->  Suffix(i, q)

Weights are (cost, audit) where the audit is the edits' initials in order;
a deduction puts its letter in front.  That is monotone, and with the number
of rows used between cost and audit also superior: each deduction adds cost
or uses a row.  So items are popped from an agenda in their final order, and
the search ends when the goal item is popped.  For one item each letter comes
from one deduction only, so comparing (cost, first letter) compares audits.

Conversations are laid out by range of (conversation, turn, role, text), so a
long one is spread over tasks.  A task solves the conversations that lie
within it whole.  The first and last of each task, and any of more than
``hold`` rows, go on in segments of bounded size: repeated rows are found by
an aggregate, each segment's agenda gives the lightest derivation from every
entering to every leaving state (equal costs: audits of the same rows never
are each other's beginning, so they compose), the segments' tables are
composed from the last to the first, and the rows are edited in order.  Only
the audit and the running digest of one conversation, which are single values
of the result, pass through one task.

Defined cases: rows of one turn are ordered by role and text; NULL turns come
first; NULL roles and texts are one space; roles whose initial is not s, u or
a can only be deleted or rewritten; a NULL id is a conversation of its own;
repeated rows are duplicates; an empty table gives an empty result; a
conversation whose rows are all absent gets zeros and the digest of the empty
string; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridplace.llm.common import map_arrow, materialize

#: Costs of the edits, the states of (s?(ua)+)? and what may follow.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
STATES = (START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT)
ACCEPTING = (START, AFTER_ASSISTANT)
MOVES = {
    (START, "s"): AFTER_SYSTEM, (START, "u"): AFTER_USER, (AFTER_SYSTEM, "u"): AFTER_USER,
    (AFTER_USER, "a"): AFTER_ASSISTANT, (AFTER_ASSISTANT, "u"): AFTER_USER,
}
WRITTEN = {START: "user", AFTER_SYSTEM: "user", AFTER_USER: "assistant", AFTER_ASSISTANT: "user"}
LEGAL_PAIRS = {"su", "ua", "au"}
WHITE = " \t\n\x0b\x0c\r"
STOPS = (".", "!", "?")

BLANK, DUPLICATE, CUT, SOUND = range(4)
HOLD, SEGMENT = 1 << 16, 4096

#: state -> states from which a row of the written role leads to it
BY_WRITING = {q: [p for p in STATES if MOVES[p, WRITTEN[p][0]] == q] for q in STATES}
#: (initial, state) -> states from which that initial leads to it
BY_KEEPING: dict[tuple[str, int], list[int]] = {}
for (p, letter), q in MOVES.items():
    BY_KEEPING.setdefault((letter, q), []).append(p)


def fault(text: str, seen_before: bool) -> int:
    """A row's first fault."""
    said = text.rstrip(WHITE)
    if not said:
        return BLANK
    if seen_before:
        return DUPLICATE
    return SOUND if said.endswith(STOPS) else CUT


def lightest(rows: list[tuple[str, int]], ends: tuple[int, ...], goals: tuple[int, ...]) -> dict[int, tuple[int, str]]:
    """Lightest derivations: entering state -> (cost, audit), for rows of
    (role, fault) that must leave in one of the states ``ends``."""
    n = len(rows)
    final: dict[tuple[int, int], tuple] = {}
    wanted = {(0, q) for q in goals}
    agenda = [(0, 0, "", (n, q), None) for q in ends]
    while agenda and wanted:
        cost, used, edit, item, rest = heappop(agenda)
        if item in final:
            continue
        final[item] = (cost, edit, rest)
        wanted.discard(item)
        i, q = item
        for p in BY_WRITING[q]:
            heappush(agenda, (cost + INSERT, used, "I", (i, p), item))
        if not i:
            continue
        role, what = rows[i - 1]
        heappush(agenda, (cost + DELETE, used + 1, "D", (i - 1, q), item))
        if what >= CUT:
            extra = TRUNCATED if what == CUT else 0
            for p in BY_WRITING[q]:
                heappush(agenda, (cost + REROLE + extra, used + 1, "R", (i - 1, p), item))
            for p in BY_KEEPING.get((role[:1], q), ()):
                heappush(agenda, (cost + extra, used + 1, "K", (i - 1, p), item))
    found = {}
    for q in goals:
        item = (0, q)
        if item in final:
            edits = []
            while item is not None:
                _, edit, rest = final[item]
                edits.append(edit)
                item = rest
            found[q] = (final[0, q][0], "".join(edits))
    return found


class Report:
    """Counts, and the repaired rows' digest, of one conversation whose rows
    and edits come in order."""

    def __init__(self, with_text: bool) -> None:
        self.counts = [0, 0, 0, 0]
        self.illegal = self.turns = 0
        self.first = self.last = self.before = None
        self.state = START
        self.digest = hashlib.sha256()
        self.lines: list[str] | None = [] if with_text else None
        self.started = False

    def _write(self, role: str, text: str) -> None:
        line = f"{role}:{text}"
        self.digest.update((("\n" if self.started else "") + line).encode("utf-8", "surrogatepass"))
        self.started = True
        self.state = MOVES[self.state, role[0]]
        if self.lines is not None:
            self.lines.append(line)

    def row(self, turn: int | None, role: str, text: str, what: int) -> None:
        self.counts[what] += 1
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last = turn
            self.turns += 1
        if self.before is not None and self.before + role[:1] not in LEGAL_PAIRS:
            self.illegal += 1
        self.before = role[:1]

    def edit(self, letter: str, role: str = "", text: str = "") -> None:
        if letter == "K":
            self._write(role, text)
        elif letter in "RI":
            self._write(WRITTEN[self.state], text)

    def result(self, cost: int, audit: str) -> dict:
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        out = {
            "gaps": gaps, "blank": self.counts[BLANK], "duplicate": self.counts[DUPLICATE], "truncated": self.counts[CUT],
            "illegal": self.illegal, "cost": cost, "audit": audit, "repaired_sha256": self.digest.hexdigest(),
        }
        return out if self.lines is None else out | {"repaired": "\n".join(self.lines)}


def edited(report: Report, rows: list[tuple], audit: Iterator[str]) -> None:
    """Apply the edits of ``audit`` up to and with each row's own."""
    for turn, role, text, what in rows:
        report.row(turn, role, text, what)
        for letter in audit:
            if letter == "I":
                report.edit("I")
            else:
                report.edit(letter, role, text)
                break


def repaired(rows: list[tuple], with_text: bool) -> dict:
    """The result of one whole conversation of rows (turn, role, text)."""
    seen: set[tuple[str, str]] = set()
    marked = []
    for turn, role, text in rows:
        marked.append((turn, role, text, fault(text, (role, text) in seen)))
        seen.add((role, text))
    cost, audit = lightest([(role, what) for _, role, _, what in marked], ACCEPTING, (START,))[START]
    report = Report(with_text)
    letters = iter(audit)
    edited(report, marked, letters)
    for letter in letters:
        report.edit(letter)
    return report.result(cost, audit)


def before(x: tuple, y: tuple) -> bool:
    """Whether audit x is less than y; both are linked pieces (text, rest)."""
    a = b = ""
    while True:
        while not a and x:
            a, x = x
        while not b and y:
            b, y = y
        if not a or not b or (x is y and a == b):
            return not a and bool(b)
        k = min(len(a), len(b))
        if a[:k] != b[:k]:
            return a[:k] < b[:k]
        a, b = a[k:], b[k:]


def compose(tables: list[dict[tuple[int, int], tuple[int, str]]]) -> tuple[int, list[str]]:
    """Cost and audit pieces of the lightest way through all segments' tables
    (entering, leaving) -> (cost, audit)."""
    best = {q: (0, ()) for q in ACCEPTING}
    ways: list[dict[int, int]] = []
    for table in reversed(tables):
        now: dict[int, tuple[int, tuple]] = {}
        way: dict[int, int] = {}
        for (enter, leave), (cost, audit) in table.items():
            if leave not in best:
                continue
            total, pieces = cost + best[leave][0], (audit, best[leave][1])
            if enter not in now or total < now[enter][0] or (total == now[enter][0] and before(pieces, now[enter][1])):
                now[enter], way[enter] = (total, pieces), leave
        best = now
        ways.append(way)
    state, audits = START, []
    for table, way in zip(tables, reversed(ways)):
        audits.append(table[state, way[state]][1])
        state = way[state]
    return best[START][0], audits


RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
KINDS = [pa.int64()] * 6 + [pa.string()] * 2
NAMES = [field.split()[0] for field in RESULT.split(", ")]


def repair_conversations(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    present: Column | None = None,
    with_text: bool = False,
    hold: int = HOLD,
    segment: int = SEGMENT,
) -> DataFrame:
    """Per conversation: conv_id, gaps, blank, duplicate, truncated, illegal,
    cost, audit, repaired_sha256 and, with ``with_text``, repaired (the rows
    ``role:text``, one a line).

    Rows for which ``present`` is not true only name their conversation.
    """
    here = F.lit(True) if present is None else F.coalesce(present, F.lit(False))
    said = lambda c: F.when(F.col("present"), F.coalesce(c, F.lit(" "))).otherwise("")
    rows = turns.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"), here.alias("present")
    ).withColumns({"role": said(F.col("role")), "text": said(F.col("text"))})
    id_type = rows.schema["conv"].dataType.simpleString()
    result = RESULT + (", repaired string" if with_text else "")
    names, kinds = NAMES + ["repaired"] * with_text, KINDS + [pa.string()] * with_text
    # the row's own number lets a row repeated without end be dealt to several tasks
    order = ("conv", "turn", "role", "text", "present")
    dealt = rows.withColumn("number", F.monotonically_increasing_id()).repartitionByRange(*order, "number").sortWithinPartitions(*order).drop("number")
    head = ["conv", "segment", "seq", "turn", "role", "text", "present"]

    def finished(conv: list, found: list[dict], conv_kind: pa.DataType) -> list[pa.Array]:
        return [pa.array(conv, conv_kind)] + [pa.array([r[n] for r in found], k) for n, k in zip(names, kinds)]

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole conversations are solved, others pass in numbered segments."""
        number = TaskContext.get().partitionId() << 40
        held: list[tuple] = []
        name: list | None = None  # [conversation] of the held or passing rows
        passing = True  # the first conversation of the task may have begun before
        seq = 0

        def on(part: list[tuple], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
            nonlocal number, seq
            while part:
                if seq == segment:
                    number, seq = number + 1, 0
                now, part = part[: segment - seq], part[segment - seq :]
                turn, role, text, there = zip(*now)
                cols = [
                    pa.array(name * len(now), kind), pa.array([number] * len(now), pa.int64()), pa.array(range(seq, seq + len(now)), pa.int32()),
                    pa.array(turn, pa.int64()), pa.array(role, pa.string()), pa.array(text, pa.string()), pa.array(there, pa.bool_()),
                ]
                seq += len(now)
                yield pa.RecordBatch.from_arrays(cols + [pa.nulls(len(now), k) for k in kinds], head + names)

        def whole(done: list[tuple[list, list]], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
            if done:
                found = [repaired([r[:3] for r in part if r[3]], with_text) for _, part in done]
                cols = finished([c[0] for c, _ in done], found, kind)
                fill = [pa.nulls(len(done), k) for k in (pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.bool_())]
                yield pa.RecordBatch.from_arrays([cols[0], *fill, *cols[1:]], head + names)

        kind = None
        for batch in batches:
            kind = batch.column(0).type
            done: list[tuple[list, list]] = []
            for conv, *row in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if name != [conv]:
                    if passing and held:
                        yield from on(held, kind)
                    elif held:
                        done.append((name, held))
                    passing = name is None
                    number, seq, name, held = number + 1, 0, [conv], []
                held.append(tuple(row))
                if len(held) >= hold:
                    passing = True
                if passing and len(held) >= segment:
                    yield from on(held, kind)
                    held = []
            yield from whole(done, kind)
        if held:
            yield from on(held, kind)

    schema = f"conv {id_type}, segment long, seq int, turn long, role string, text string, present boolean, {result}"
    first = materialize(map_arrow(dealt, solve, schema), "conversations")
    whole = first.filter("segment IS NULL").select(F.col("conv").alias("conv_id"), *names)
    open_rows = first.filter("segment IS NOT NULL").select(*head)

    # repeated rows: all but the first of equal role and text in a conversation
    firsts = open_rows.filter("present").groupBy("conv", "role", F.sha2("text", 256)).agg(F.min(F.struct("segment", "seq")).alias("at"))
    firsts = firsts.select(F.col("at.segment").alias("segment"), F.col("at.seq").alias("seq"), F.lit(True).alias("original"))
    marked = materialize(open_rows.join(firsts, ["segment", "seq"], "left"), "open_conversations")

    def tabulate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, conv, part = None, None, []

        def out() -> Iterator[pa.RecordBatch]:
            ways = [(q, e, cost, audit) for e in STATES for q, (cost, audit) in lightest(part, (e,), STATES).items()]
            enter, leave, cost, audit = zip(*ways)
            cols = [pa.array([conv], kind), pa.array([at], pa.int64()), *(pa.array([list(c)], pa.list_(k)) for c, k in zip((enter, leave, cost, audit), (pa.int8(), pa.int8(), pa.int64(), pa.string())))]
            yield pa.RecordBatch.from_arrays(cols, ["conv", "segment", "enter", "leave", "cost", "audit"])

        for batch in batches:
            kind = batch.column(0).type
            for c, s, role, text, there, original in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if s != at:
                    if at is not None:
                        yield from out()
                    at, conv, part = s, c, []
                if there:
                    part.append((role, fault(text, not original)))
        if at is not None:
            yield from out()

    in_segments = marked.select("conv", "segment", "role", "text", "present", "original", "seq").repartition("segment").sortWithinPartitions("segment", "seq")
    tables = map_arrow(in_segments, tabulate, f"conv {id_type}, segment long, enter array<byte>, leave array<byte>, cost array<long>, audit array<string>")

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, numbers, ways = None, [], []

        def out() -> Iterator[pa.RecordBatch]:
            cost, audits = compose(ways)
            k = len(numbers)
            cols = [pa.array(name * k, kind), pa.array(numbers, pa.int64()), pa.array([-1] * k, pa.int32()), pa.array([cost] * k, pa.int64()), pa.nulls(k, pa.string()), pa.array(audits, pa.string()), pa.nulls(k, pa.bool_()), pa.nulls(k, pa.bool_())]
            yield pa.RecordBatch.from_arrays(cols, head + ["original"])

        for batch in batches:
            kind = batch.column(0).type
            for conv, number, enter, leave, cost, audit in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if name != [conv]:
                    if name is not None:
                        yield from out()
                    name, numbers, ways = [conv], [], []
                numbers.append(number)
                ways.append({(q, e): (c, a) for q, e, c, a in zip(enter, leave, cost, audit)})
        if name is not None:
            yield from out()

    open_schema = f"conv {id_type}, segment long, seq int, turn long, role string, text string, present boolean, original boolean"
    chosen = materialize(map_arrow(tables.repartition("conv").sortWithinPartitions("conv", "segment"), choose, open_schema), "chosen_edits")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, report, audits, letters, cost = None, None, [], iter(""), 0

        def out() -> Iterator[pa.RecordBatch]:
            for letter in letters:
                report.edit(letter)
            yield pa.RecordBatch.from_arrays(finished(name, [report.result(cost, "".join(audits))], kind), ["conv_id", *names])

        for batch in batches:
            kind = batch.column(0).type
            for conv, _, seq, turn, role, text, there, original in zip(*(batch.column(i).to_pylist() for i in range(8))):
                if name != [conv]:
                    if name is not None:
                        yield from out()
                    name, report, audits, letters = [conv], Report(with_text), [], iter("")
                if seq < 0:  # the edits of the segment that begins here
                    for letter in letters:
                        report.edit(letter)
                    audits.append(text)
                    letters, cost = iter(text), turn
                elif there:
                    edited(report, [(turn, role, text, fault(text, not original))], letters)
        if name is not None:
            yield from out()

    together = marked.select(*head, "original").unionByName(chosen).repartition("conv").sortWithinPartitions("conv", "segment", "seq")
    rest = map_arrow(together, write, f"conv_id {id_type}, {result}")
    return whole.unionByName(rest)


def damaged(turns: DataFrame) -> tuple[DataFrame, Column]:
    """The rows of a damaged copy of ``turns`` for trials, and the column that
    says which are present.

    By crc32(``conv_id:turn``) % 20: 0 drops the row, 1 empties its text, 2
    removes its full stops and question and exclamation marks, 3 repeats it,
    4 makes it the user's.  NULLs are one space.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = turns.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"))
    rows = rows.withColumn("harm", F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20)
    rows = rows.withColumns({
        "text": F.when(F.col("harm") == 1, "").when(F.col("harm") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")),
        "role": F.when(F.col("harm") == 4, "user").otherwise(F.col("role")),
    })
    twice = F.when(F.col("harm") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.withColumn("copy", F.explode(twice)).drop("copy"), F.col("harm") != 0
