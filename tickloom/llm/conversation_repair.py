"""Cheapest repair of the turn structure of conversations, by weighted interval parsing.

A sound conversation reads `(s?(ua)+)?` in the initials of its roles: nothing, or an optional system turn and then pairs of a user
and an assistant turn. The repair grammar has one non-terminal for each pair (p, q) of the states `BEGIN`, after s, after u and
after a, deriving the stretches of rows that lead from p to q; its rules are binary, [p q] -> [p r] [r q], and a row alone is
kept, given another role, or deleted at its cost. A row's cell is closed under insertions on both sides, after which no
insertion is needed elsewhere. A cell holds for each non-terminal the minimum (cost, audit); equally dear audits of one span are
never prefixes of each other, for only insertions lengthen them and those cost, so the least audit of a span is made of least
audits of its parts.

Since the grammar is regular, all ways to divide a span give the same cell. Spans are therefore combined bottom-up by doubled
length, a cell per span and not one per pair of ends, and a conversation can be divided among tasks: rows without their texts are
spread by ranges of (conversation, turn), each task reduces what it has of a conversation to one cell, and those few cells are
multiplied in order. Copies of a row are counted before they are spread. Texts travel once, to where the audit is carried out
and the result is hashed or handed on row by row; nothing there holds a conversation whole.

Faults, the first of which counts: blank (no character but white space), duplicate (role and text equal those of an earlier row),
truncated (the last character but white space is none of `.!?`).

Edge cases: null roles and texts are one blank; null turns come first and are no part of `gaps`; rows of one turn go by role,
then by the MD5 of the text; null is a conversation of its own; an empty table has no conversations; other columns are
ignored, whatever their names; any role that does not begin with s, u or a cannot be kept. A very long text costs memory for
itself alone.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from .common import SPACE_CLASS, WORD_CLASS

# Costs of edits; a truncated row that stays costs OPEN more.
REROLE, DELETE, INSERT, OPEN = 2, 3, 2, 1
# States between rows, and what a turn's initial leads to.
BEGIN, SYSTEM, USER, ASSISTANT = STATES = range(4)
STEPS = {(BEGIN, "s"): SYSTEM, (BEGIN, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ACCEPTED = (BEGIN, ASSISTANT)
NAMES = {"u": "user", "a": "assistant"}
# Spans of up to so many rows are looked up by their rows' letters.
SHORT = 8

Cell = tuple  # for each pair of states (cost, audit) or None, by rows

COUNTS = ("blank", "duplicate", "truncated", "illegal")


def _product(left: Cell, right: Cell) -> Cell:
    """The cell of two adjacent spans."""
    out = []
    for p in STATES:
        for q in STATES:
            best, ways = None, []
            for r in STATES:
                a, b = left[4 * p + r], right[4 * r + q]
                if a is None or b is None:
                    continue
                cost = a[0] + b[0]
                if best is None or cost < best:
                    best, ways = cost, [(a, b)]
                elif cost == best:
                    ways.append((a, b))
            out.append(None if best is None else (best, min(a[1] + b[1] for a, b in ways)))
    return tuple(out)


def _least(ways: dict) -> Cell:
    return tuple(min(ways[p, q]) if (p, q) in ways else None for p in STATES for q in STATES)


@lru_cache(1)
def insertions() -> Cell:
    """Closure of inserted turns, which is also the cell of no rows."""
    none = {(p, p): [(0, "")] for p in STATES}
    one = {(p, q): [(INSERT, "I")] for (p, role), q in STEPS.items() if role in NAMES}
    cell = _least({**none, **one})
    while (wider := _product(cell, cell)) != cell:
        cell = wider
    return cell


def _leaf(letter: str) -> Cell:
    """A row: its role's initial (o: another one), in upper case if truncated; x has to go."""
    ways: dict = {(p, p): [(DELETE, "D")] for p in STATES}
    if letter != "x":
        extra = OPEN if letter.isupper() else 0
        for (p, role), q in STEPS.items():
            if role == letter.lower():
                ways.setdefault((p, q), []).append((extra, "K"))
            if role in NAMES:
                ways.setdefault((p, q), []).append((REROLE + extra, "R"))
    return _product(_product(insertions(), _least(ways)), insertions())


@lru_cache(1 << 16)
def _short(letters: str) -> Cell:
    if len(letters) < 2:
        return _leaf(letters) if letters else insertions()
    half = 1 << (len(letters) - 1).bit_length() - 1
    return _product(_short(letters[:half]), _short(letters[half:]))


def parsed(letters: str) -> Cell:
    """The cell of a span of rows, from short spans to long ones."""
    cells = [_short(letters[i:i + SHORT]) for i in range(0, len(letters), SHORT)] or [insertions()]
    while len(cells) > 1:
        cells = [_product(*cells[i:i + 2]) if i + 1 < len(cells) else cells[i] for i in range(0, len(cells), 2)]
    return cells[0]


def cheapest(cell: Cell) -> tuple[int, str]:
    """The least (cost, audit) that makes a sound conversation."""
    return min(cell[4 * BEGIN + q] for q in ACCEPTED if cell[4 * BEGIN + q] is not None)


def _keyed(turns: DataFrame) -> DataFrame:
    """The four columns with nulls as blanks, and what rows are ordered by within a conversation."""
    blank = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), blank("role").alias("role"), blank("text").alias("text"))
    return rows.withColumn("digest", F.md5(F.col("text").cast("binary")))


ORDER = ["turn", "role", "digest"]


def judged(turns: DataFrame) -> DataFrame:
    """Distinct rows of each conversation without their texts: what they count for, and their letters for the parser."""
    rows = _keyed(turns).select(
        "conv_id", *ORDER,
        (~F.col("text").rlike(WORD_CLASS)).alias("blank"),
        (~F.col("text").rlike(f"[.!?]{SPACE_CLASS}*\\z")).alias("open"),
    )
    copies = rows.groupBy("conv_id", *ORDER, "blank", "open").agg(F.count("*").alias("copies"))
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = copies.groupBy("conv_id", "role", "digest").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1")
    a, b = copies.alias("a"), first.alias("b")
    same = F.col("a.conv_id").eqNullSafe(F.col("b.conv_id")) & (F.col("a.role") == F.col("b.role")) & (F.col("a.digest") == F.col("b.digest"))
    seen = F.coalesce(F.struct(F.col("a.turn").isNotNull().alias("known"), "a.turn") > F.col("b.first"), F.lit(False))
    rows = a.join(b, same, "left").select("a.*", seen.alias("seen"))
    initial = F.substring("role", 1, 1)
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    gone = F.col("blank") | F.col("seen")
    own = F.when(gone, "x").when(F.col("open"), F.upper(letter)).otherwise(letter)
    more = F.col("copies") - 1
    return rows.select(
        "conv_id", *ORDER, initial.alias("initial"),
        F.when(F.col("blank"), F.col("copies")).otherwise(0).alias("blank"),
        F.when(F.col("blank"), 0).when(F.col("seen"), F.col("copies")).otherwise(more).alias("duplicate"),
        F.when(~gone & F.col("open"), 1).otherwise(0).cast("long").alias("truncated"),
        # copies of a row stand side by side and no role may follow itself
        more.alias("illegal"),
        F.concat(own, F.repeat(F.lit("x"), more.cast("int"))).alias("letters"),
    )


_LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
_SPAN = "part int, first string, last string, low bigint, high bigint, turns bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint"
_CELL = "cell array<struct<cost: bigint, audit: string>>"


class _Span:
    """What adjacent rows of a conversation amount to."""

    def __init__(self, first: str, last: str, low: int | None, high: int | None, turns: int, counts: list[int]):
        self.first, self.last, self.low, self.high, self.turns, self.counts = first, last, low, high, turns, counts

    def add(self, first: str, last: str, low: int | None, high: int | None, turns: int, counts: list[int]) -> None:
        """Rows that follow."""
        self.counts = [x + y for x, y in zip(self.counts, counts, strict=True)]
        self.counts[3] += (self.last, first) not in _LEGAL
        self.turns += turns - (low is not None and self.high == low)
        self.low = low if self.low is None else self.low
        self.high = self.high if high is None else high
        self.last = last

    def fields(self) -> list:
        return [self.first, self.last, self.low, self.high, self.turns, *self.counts]


def _by_conversation(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, tuple]]:
    """Sorted rows, each with whether another conversation begins there."""
    before, any_ = None, False
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            yield not any_ or row[0] != before, row
            before, any_ = row[0], True


def _table(rows: list[list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def _arrow_schema(key: pa.DataType, fields: list[tuple[str, pa.DataType]]) -> pa.Schema:
    return pa.schema([("conv_id", key), *fields])


_LONGS = [(n, pa.int64()) for n in ("low", "high", "turns", *COUNTS)]
_CELL_TYPE = pa.list_(pa.struct([("cost", pa.int64()), ("audit", pa.string())]))


def _batches(rows: Iterator[list], schema: pa.Schema, size: int = 1000) -> Iterator[pa.RecordBatch]:
    held: list[list] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _table(held, schema)
            held = []
    if held:
        yield _table(held, schema)


def _peeked(batches: Iterator[pa.RecordBatch]) -> tuple[pa.DataType | None, Iterator[pa.RecordBatch]]:
    """The type of the first column, and all batches."""
    first = next(batches, None)
    if first is None:
        return None, iter(())

    def every() -> Iterator[pa.RecordBatch]:
        yield first
        yield from batches

    return first.column(0).type, every()


def spans(rows: DataFrame) -> DataFrame:
    """One cell for what each task has of a conversation; tasks are numbered in the order of rows."""

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, every = _peeked(batches)
        if kind is None:
            return
        part = TaskContext.get().partitionId()

        def made() -> Iterator[list]:
            conv, span, letters = None, None, []
            done = lambda: [conv, part, *span.fields(), [None if x is None else {"cost": x[0], "audit": x[1]} for x in parsed("".join(letters))]]
            for new, (key, turn, initial, *counts, own) in _by_conversation(every):
                fields = (initial, initial, turn, turn, int(turn is not None), counts)
                if new:
                    if span:
                        yield done()
                    conv, span, letters = key, _Span(*fields), [own]
                else:
                    span.add(*fields)
                    letters.append(own)
            if span:
                yield done()

        schema = _arrow_schema(kind, [("part", pa.int32()), ("first", pa.string()), ("last", pa.string()), *_LONGS, ("cell", _CELL_TYPE)])
        yield from _batches(made(), schema)

    spread = rows.repartitionByRange("conv_id", *ORDER).sortWithinPartitions("conv_id", *ORDER)
    return spread.select("conv_id", "turn", "initial", *COUNTS, "letters").mapInArrow(reduce, f"conv_id {_type(rows)}, {_SPAN}, {_CELL}")


def _type(rows: DataFrame) -> str:
    kind: DataType = rows.schema["conv_id"].dataType
    return kind.simpleString()


_PLAN = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
PLAN = [part.split()[0] for part in _PLAN.split(", ")]


def plans(turns: DataFrame) -> DataFrame:
    """For each conversation its gaps, faults, illegal neighbours, and the cost and audit of its cheapest repair."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, every = _peeked(batches)
        if kind is None:
            return

        def made() -> Iterator[list]:
            conv, span, cell = None, None, None

            def done() -> list:
                gaps = 0 if span.low is None else span.high - span.low + 1 - span.turns
                return [conv, gaps, *span.counts, *cheapest(cell)]

            for new, (key, _, first, last, low, high, n, *counts, packed) in _by_conversation(every):
                own = tuple(None if x is None else (x["cost"], x["audit"]) for x in packed)
                if new:
                    if span:
                        yield done()
                    conv, span, cell = key, _Span(first, last, low, high, n, counts), own
                else:
                    span.add(first, last, low, high, n, counts)
                    cell = _product(cell, own)
            if span:
                yield done()

        schema = _arrow_schema(kind, [("gaps", pa.int64()), *((n, pa.int64()) for n in COUNTS), ("cost", pa.int64()), ("audit", pa.string())])
        yield from _batches(made(), schema)

    parts = spans(judged(turns))
    return parts.repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(join, f"conv_id {_type(parts)}, {_PLAN}")


def _edits(rows: Iterator[tuple[str, str]], audit: Iterator[str]) -> Iterator[tuple[str, str, str]]:
    """The audit carried out: (edit, role, text) of each turn that stays or is inserted."""
    state = BEGIN

    def named() -> str:
        nonlocal state
        role = "a" if state == USER else "u"
        state = STEPS[state, role]
        return NAMES[role]

    for edit in audit:
        if edit == "I":
            yield edit, named(), ""
            continue
        role, text = next(rows)
        if edit == "K":
            state = STEPS[state, role[0]]
            yield edit, role, text
        elif edit == "R":
            yield edit, named(), text


def _carried_out(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, Iterator[tuple[str, str, str]]]]:
    """For each conversation its plan and its repaired turns, which are to be used up before the next one."""
    flow = _by_conversation(batches)
    row = next(flow, None)
    while row is not None:
        _, plan = row
        ahead: list = [None]

        def own(ahead: list = ahead) -> Iterator[tuple[str, str]]:
            for found in flow:
                if found[0]:
                    ahead[0] = found
                    return
                yield found[1][-2], found[1][-1]

        rows = own()
        yield plan, _edits(rows, iter(plan[len(PLAN)]))
        for _ in rows:  # what stands behind the last edit
            pass
        row = ahead[0]


def _with_plans(turns: DataFrame, planned: DataFrame) -> DataFrame:
    """Plans, each followed by its conversation's rows in order."""
    rows = _keyed(turns)
    head = planned.select("conv_id", *PLAN, F.lit(0).alias("kind"), *(F.lit(None).cast(rows.schema[n].dataType).alias(n) for n in (*ORDER, "text")))
    body = rows.select("conv_id", *(F.lit(None).cast(planned.schema[n].dataType).alias(n) for n in PLAN), F.lit(1).alias("kind"), *ORDER, "text")
    dealt = head.unionByName(body).repartition("conv_id").sortWithinPartitions("conv_id", "kind", *ORDER)
    return dealt.select("conv_id", *PLAN, "role", "text")


def repaired(turns: DataFrame, planned: DataFrame) -> DataFrame:
    """The repaired turns: conv_id, place from 0, edit (K, R or I), role, text; `planned` is the result of `plans`."""

    def carry_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, every = _peeked(batches)
        if kind is None:
            return
        made = ([plan[0], place, *turn] for plan, turns_ in _carried_out(every) for place, turn in enumerate(turns_))
        yield from _batches(made, _arrow_schema(kind, [("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]))

    return _with_plans(turns, planned).mapInArrow(carry_out, f"conv_id {_type(planned)}, place bigint, edit string, role string, text string")


def digests(turns: DataFrame, planned: DataFrame) -> DataFrame:
    """The plans with the SHA-256 of each repaired conversation: lines of `role:text`, joined by newlines."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, every = _peeked(batches)
        if kind is None:
            return

        def made() -> Iterator[list]:
            for plan, turns_ in _carried_out(every):
                digest, mark = hashlib.sha256(), ""
                for _, role, text in turns_:
                    digest.update(f"{mark}{role}:{text}".encode("utf-8", "surrogatepass"))
                    mark = "\n"
                yield [plan[0], *plan[1:len(PLAN) + 1], digest.hexdigest()]

        fields = [("gaps", pa.int64()), *((n, pa.int64()) for n in COUNTS), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())]
        yield from _batches(made(), _arrow_schema(kind, fields))

    return _with_plans(turns, planned).mapInArrow(hashed, f"conv_id {_type(planned)}, {_PLAN}, repaired_sha256 string")


def for_all(ids: DataFrame, found: DataFrame) -> DataFrame:
    """`found` (of `digests`) for every conv_id of `ids`; conversations without rows are sound and empty."""
    keys = ids.select("conv_id").distinct().alias("k")
    joined = keys.join(found.alias("f"), F.col("k.conv_id").eqNullSafe(F.col("f.conv_id")), "left")
    empty: dict[str, Column] = {"audit": F.lit(""), "repaired_sha256": F.lit(hashlib.sha256().hexdigest())}
    return joined.select("k.conv_id", *(F.coalesce(F.col(f"f.{n}"), empty.get(n, F.lit(0).cast("long"))).alias(n) for n in found.columns[1:]))
