"""Cheapest repair of conversations by weighted CYK parsing of their rows.

A repaired conversation is empty or s?(ua)+ by the initials of its roles. The grammar's
nonterminals are pairs of places in that pattern: N(p, q) derives the spans of rows that some edits
turn into what leads from p to q. It is in Chomsky normal form:
    N(p, q) -> N(p, r) N(r, q),
and N(p, q) derives a single row by keeping it, giving it another role or deleting it. Rows
may be inserted anywhere, so cells are closed under insertion: a cell holds the
least (cost, audit) over all insertions before, between and behind its rows. The audit is the
initials of the edits; equal costs go to the audit that is least in ASCII. No audit of a span is
the beginning of another of the same cost, so the least audit of a whole is made of least ones.

Cells are combined bottom-up by span length. The grammar derives a span through every way to
split it, so a span's cell is that of its two halves, and no other splits need be tried: n rows take
n - 1 combinations. Spans of one conversation may thus lie in different tasks: rows are dealt by
ranges of (conversation, place), each task parses what it has of a conversation to one cell, and
these are combined. A conversation of a third of all rows is parsed by many tasks. Its repaired rows
are put out, and hashed, in one pass in order, which keeps a row at a time and the audit.

Defined results: a null role or text is one space. Rows go by turn, null first, then role and text;
equal rows are neighbours. Rows without conversation are one conversation. One without rows, and one
whose rows are all deleted, is empty. Gaps beyond 64 bits are 2^63 - 1. Empty tables give no
rows; other columns don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlake.plans.staging import stage, stacked

RETYPE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3  # costs; the last for a truncated row that stays
BATCH = 2000  # rows put out at once
SPACES = " \t\n\x0b\x0c\r"
# Places: 0 at the beginning, 1 behind s, 2 behind u, 3 behind a; by initial, from which to which.
STEPS = {"s": [(0, 1)], "u": [(0, 2), (1, 2), (3, 2)], "a": [(2, 3)]}
ENDS = [(0, 0), (0, 3)]
LEGAL = {"su", "ua", "au"}

Cell = dict[tuple[int, int], tuple[int, str]]


def combined(one: Cell, two: Cell) -> Cell:
    """The cell of two neighbouring spans together."""
    found: Cell = {}
    for (p, r), (cost, audit) in one.items():
        for (s, q), (more, rest) in two.items():
            if r == s and ((p, q) not in found or (cost + more, audit + rest) < found[p, q]):
                found[p, q] = cost + more, audit + rest
    return found


def _least(*cells: Cell) -> Cell:
    found: Cell = {}
    for cell in cells:
        for pair, value in cell.items():
            found[pair] = min(found.get(pair, value), value)
    return found


def _insertions() -> Cell:
    """The closed cell of no rows."""
    once: Cell = {pair: (INSERT, "I") for i in "ua" for pair in STEPS[i]}
    cell: Cell = {(p, p): (0, "") for p in range(4)}
    while (more := _least(cell, combined(cell, once))) != cell:
        cell = more
    return cell


NO_ROWS = _insertions()


def row_cell(initial: str, fault: str) -> Cell:
    """The closed cell of one row; fault: "", blank, duplicate or truncated."""
    cell: Cell = {(p, p): (DELETE, "D") for p in range(4)}
    if fault not in ("blank", "duplicate"):
        extra = TRUNCATED if fault == "truncated" else 0
        kept: Cell = {pair: (extra, "K") for pair in STEPS.get(initial, [])}
        cell = _least(cell, kept, {pair: (RETYPE + extra, "R") for i in "ua" for pair in STEPS[i]})
    return combined(combined(NO_ROWS, cell), NO_ROWS)


CELLS = {(i, f): row_cell(i, f) for i in "sua?" for f in ("", "blank", "duplicate", "truncated")}


def repeated(cell: Cell, times: int) -> Cell:
    """The cell of so many rows alike, by halves."""
    if times == 1:
        return cell
    half = repeated(cell, times // 2)
    both = combined(half, half)
    return combined(both, cell) if times % 2 else both


def fault_of(text: str, first: bool) -> str:
    """A row's first fault; first: no earlier row has its role and text."""
    rest = text.rstrip(SPACES)
    if not rest:
        return "blank"
    if not first:
        return "duplicate"
    return "" if rest[-1] in ".!?" else "truncated"


@dataclass
class Span:
    """What is known of some neighbouring rows of a conversation."""

    cells: list[tuple[int, Cell]] = field(default_factory=list)  # of parts, longer ones first
    faults: dict[str, int] = field(default_factory=lambda: {"blank": 0, "duplicate": 0, "truncated": 0})
    illegal: int = 0
    ends: tuple[str, str] | None = None  # initials of the first and the last role
    turns: tuple[int, int, int] | None = None  # least, greatest, how many different

    def push(self, rows: int, cell: Cell) -> None:
        """Spans of a length are combined to one of twice that."""
        while self.cells and self.cells[-1][0] <= rows:
            before, left = self.cells.pop()
            rows, cell = rows + before, combined(left, cell)
        self.cells.append((rows, cell))

    def meet(self, one: str, two: str, turns: tuple[int, int, int] | None) -> None:
        """Rows from initial one to initial two come next."""
        self.illegal += self.ends is not None and self.ends[1] + one not in LEGAL
        self.ends = (self.ends[0] if self.ends else one), two
        if turns and self.turns:  # turns ascend: only the last and the next can be the same
            self.turns = self.turns[0], turns[1], self.turns[2] + turns[2] - (self.turns[1] == turns[0])
        else:
            self.turns = turns or self.turns

    def add(self, turn: int | None, role: str, text: str, copies: int, first: bool) -> None:
        """The next row, so many times."""
        initial = role[:1]
        for fault, times in ((fault_of(text, first), 1), (fault_of(text, False), copies - 1)):
            if times:
                self.push(times, repeated(CELLS[initial if initial in STEPS else "?", fault], times))
                if fault:
                    self.faults[fault] += times
        self.meet(initial, initial, None if turn is None else (turn, turn, 1))
        self.illegal += copies - 1

    def extend(self, other: Span) -> None:
        """The rows of another span come next."""
        for rows, cell in other.cells:
            self.push(rows, cell)
        for fault, times in other.faults.items():
            self.faults[fault] += times
        self.illegal += other.illegal
        if other.ends:
            self.meet(*other.ends, other.turns)

    def cell(self) -> Cell:
        """The cell of all rows."""
        found = NO_ROWS
        for _, cell in reversed(self.cells):
            found = combined(cell, found)
        return found

    def gaps(self) -> int:
        return min(self.turns[1] - self.turns[0] + 1 - self.turns[2], 2**63 - 1) if self.turns else 0


SPAN_KIND = (
    "part int, rows bigint, cells array<struct<p:int,q:int,cost:bigint,audit:string>>, blank bigint, duplicate bigint, truncated bigint, "
    "illegal bigint, ends array<string>, turns array<bigint>"
)
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _written(span: Span, part: int) -> dict:
    cell = span.cell() if span.cells else {}
    return {
        "part": part,
        "rows": sum(rows for rows, _ in span.cells),
        "cells": [{"p": p, "q": q, "cost": cost, "audit": audit} for (p, q), (cost, audit) in cell.items()],
        **span.faults,
        "illegal": span.illegal,
        "ends": list(span.ends) if span.ends else None,
        "turns": list(span.turns) if span.turns else None,
    }


def _read(row: dict) -> Span:
    cells = [(row["rows"], {(c["p"], c["q"]): (c["cost"], c["audit"]) for c in row["cells"]})] if row["rows"] else []
    ends, turns = (tuple(row[c]) if row[c] else None for c in ("ends", "turns"))
    return Span(cells, {f: row[f] for f in ("blank", "duplicate", "truncated")}, row["illegal"], ends, turns)


def prepared(rows: DataFrame, copies: Column | None = None) -> DataFrame:
    """(conv_id, turn, role, text, copies, first), written: equal rows are one, none of it where copies is 0.

    first: no row of a smaller turn has this role and text.
    """
    plain = rows.select("conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")], (F.lit(1) if copies is None else copies).alias("copies"))
    plain = plain.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    plain = stage(plain.withColumn("digest", F.sha2(F.concat_ws(":", "role", "text"), 256)), "conversation-rows")
    least = plain.where("copies > 0").groupBy(F.col("conv_id").alias("_conv"), F.col("digest").alias("_digest")).agg(F.min(F.struct(F.col("turn").isNotNull(), "turn")).alias("_least"))
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("digest") == F.col("_digest"))
    found = plain.join(least, same, "left").withColumn("first", F.col("turn").eqNullSafe(F.col("_least.turn")))
    return stage(found.drop("digest", "_conv", "_digest", "_least"), "conversation-rows")


def _order() -> list[Column]:
    return [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("text")]


def spans(rows: DataFrame) -> DataFrame:
    """(conv_id, part, …): what each task has of each conversation, parsed; written."""
    kind = dict(rows.dtypes)["conv_id"]
    schema = f"conv_id {kind}, {SPAN_KIND}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, span, held, names = TaskContext.get().partitionId(), None, [], []
        shape = None
        for batch in batches:
            shape = shape or pa.schema([batch.schema.field("conv_id"), *_SPAN_SHAPE])
            for row in batch.to_pylist():
                if span is None or row["conv_id"] != names[-1]:
                    if span is not None:
                        held.append(_written(span, part))
                    span = Span()
                    names.append(row["conv_id"])
                if row["copies"]:
                    span.add(row["turn"], row["role"], row["text"], row["copies"], row["first"])
            if len(held) >= BATCH:
                done, names = names[:-1], names[-1:]
                yield pa.RecordBatch.from_pylist([{"conv_id": n, **h} for n, h in zip(done, held, strict=True)], shape)
                held = []
        if span is not None:
            held.append(_written(span, part))
            yield pa.RecordBatch.from_pylist([{"conv_id": n, **h} for n, h in zip(names, held, strict=True)], shape)

    dealt = rows.repartitionByRange(*_order()).sortWithinPartitions(*_order())
    return stage(dealt.mapInArrow(run, schema), "conversation-spans")


_SPAN_SHAPE = [
    pa.field("part", pa.int32()),
    pa.field("rows", pa.int64()),
    pa.field("cells", pa.list_(pa.struct([("p", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))),
    *[pa.field(c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal")],
    pa.field("ends", pa.list_(pa.string())),
    pa.field("turns", pa.list_(pa.int64())),
]


class Editor:
    """Applies an audit to rows in order."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.place = audit, 0, 0

    def _step(self, initial: str) -> None:
        self.place = next(q for p, q in STEPS[initial] if p == self.place)

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        """(edit, role, text) of the rows inserted here."""
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            role = "assistant" if self.place == 2 else "user"
            self._step(role[0])
            yield "I", role, ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """(edit, role, text) of what comes of a row and of what is inserted before it."""
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "R":
            role = "assistant" if self.place == 2 else "user"
        if edit != "D":
            self._step(role[0])
            yield edit, role, text


def conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, Span, tuple[int, str], Iterator]]:
    """(conv_id, span, (cost, audit), repaired rows) of sorted batches; the rows must be read before going on."""
    rows = (row for batch in batches for row in batch.to_pylist())
    row = next(rows, None)
    while row is not None:
        name, span = row["conv_id"], Span()
        while row is not None and row["conv_id"] == name and row["kind"] == 0:
            span.extend(_read(row))
            row = next(rows, None)
        cell = span.cell()
        best = min(cell[pair] for pair in ENDS if pair in cell)

        def repaired(audit: str = best[1], name: object = name) -> Iterator[tuple[str, str, str]]:
            nonlocal row
            editor = Editor(audit)
            while row is not None and row["conv_id"] == name and row["kind"] == 1:
                for _ in range(row["copies"]):
                    yield from editor.row(row["role"], row["text"])
                row = next(rows, None)
            yield from editor.inserted()

        yield name, span, best, repaired()


def _together(rows: DataFrame, copies: Column | None) -> DataFrame:
    """The spans of each conversation, then its rows in order."""
    found = prepared(rows, copies)
    heads = spans(found).withColumn("kind", F.lit(0))
    body = found.withColumn("kind", F.lit(1))
    for f in _only_in(heads, body):
        heads = heads.withColumn(f, F.lit(None).cast(dict(body.dtypes)[f]))
    for f in _only_in(body, heads):
        body = body.withColumn(f, F.lit(None).cast(heads.schema[f].dataType))
    order = [F.asc_nulls_first("conv_id"), "kind", "part", F.asc_nulls_first("turn"), "role", "text"]
    return stacked([heads, body]).repartition("conv_id").sortWithinPartitions(*order)


def _only_in(one: DataFrame, two: DataFrame) -> list[str]:
    """Columns that only the second has."""
    return [c for c in two.columns if c not in one.columns]


def repair(rows: DataFrame) -> DataFrame:
    """(conv_id, place, edit, role, text): the rows of the repaired conversations, places from 0."""
    kind = dict(rows.dtypes)["conv_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for name, _, _, repaired in conversations(batches):
            for place, (edit, role, text) in enumerate(repaired):
                held.append((name, place, edit, role, text))
                if len(held) >= BATCH:
                    yield pa.RecordBatch.from_pydict(dict(zip(("conv_id", "place", "edit", "role", "text"), zip(*held, strict=True), strict=True)))
                    held = []
        if held:
            yield pa.RecordBatch.from_pydict(dict(zip(("conv_id", "place", "edit", "role", "text"), zip(*held, strict=True), strict=True)))

    return _together(rows, None).mapInArrow(run, f"conv_id {kind}, place bigint, edit string, role string, text string")


def repair_report(rows: DataFrame, copies: Column | None = None) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256), a row per conversation.

    copies: how many times each row occurs; a conversation with no rows left is empty.
    """
    kind = dict(rows.dtypes)["conv_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, shape = [], None

        def looked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nonlocal shape
            for batch in batches:
                shape = shape or pa.schema([batch.schema.field("conv_id"), *[pa.field(c, pa.int64()) for c in COUNTS], pa.field("audit", pa.string()), pa.field("repaired_sha256", pa.string())])
                yield batch

        for name, span, (cost, audit), repaired in conversations(looked(batches)):
            digest = hashlib.sha256()
            for place, (_, role, text) in enumerate(repaired):
                digest.update(f"{chr(10) if place else ''}{role}:{text}".encode())
            held.append({"conv_id": name, "gaps": span.gaps(), **span.faults, "illegal": span.illegal, "cost": cost, "audit": audit, "repaired_sha256": digest.hexdigest()})
            if len(held) >= BATCH:
                yield pa.RecordBatch.from_pylist(held, shape)
                held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, shape)

    counts = ", ".join(f"{c} bigint" for c in COUNTS)
    return _together(rows, copies).mapInArrow(run, f"conv_id {kind}, {counts}, audit string, repaired_sha256 string")


def damaged(rows: DataFrame) -> tuple[DataFrame, Column]:
    """Rows with faults that a hash of conversation and turn chooses, and how many copies of each are there."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    text = F.when(code == 1, "").when(code == 2, F.translate(space("text"), ".!?", "")).otherwise(space("text"))
    found = rows.select("conv_id", "turn", F.when(code == 4, "user").otherwise(space("role")).alias("role"), text.alias("text"))
    return found, F.when(code == 0, 0).when(code == 3, 2).otherwise(1)


def damaged_and_repaired(rows: DataFrame) -> DataFrame:
    """The report of repairing rows that are damaged first."""
    found, copies = damaged(rows)
    return repair_report(found, copies)
