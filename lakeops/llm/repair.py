"""Conversation structure repair: cheapest edits by a dynamic program with square-root checkpoints."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import accumulate
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lakeops.operators.skew import salted_join
from lakeops.session import written_out

#: Rows and characters of one piece of a conversation, at most; output rows and characters of one batch.
PIECE_ROWS, PIECE_CHARS, BATCH_ROWS, BATCH_CHARS = 4096, 1 << 21, 1024, 1 << 21
#: What edits cost, and a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
ENDS, BLANKS = ".!?", " \t\n\x0b\x0c\r"
LEGAL = ("su", "ua", "au")
LONGEST = (1 << 63) - 1

# States: nothing yet, after a system, a user and an assistant turn. An inserted or rerolled turn goes to this state.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
FREE = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
# Where a turn that keeps its role leads from each state, by the role's initial.
KEPT = {"s": (SYSTEM, None, None, None), "u": (USER, USER, None, USER), "a": (None, None, ASSISTANT, None)}
NEVER = float("inf")

Costs = tuple[float, ...]
#: What a row is to the program: its initial if it can stay (else None), and whether it is truncated.
Code = tuple[str | None, bool]
GONE: Code = (None, False)

REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
TURNS = "place long, role string, text string"


def damage(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows with faults by a checksum of ``conversation:turn``: one in twenty each is dropped, emptied, cut, doubled or rerolled.

    A dropped row stays with ``present`` false, so its conversation is not forgotten. Nulls count as one space.
    """
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col(conv_col).cast("string"), blank), F.lit(":"), F.coalesce(F.col(turn_col).cast("string"), blank))
    fault = F.crc32(key.cast("binary")) % 20
    role, text = F.coalesce(role_col, blank), F.coalesce(text_col, blank)
    copies = F.when(fault == 0, F.array(F.lit(False))).when(fault == 3, F.array(F.lit(True), F.lit(True))).otherwise(F.array(F.lit(True)))
    return rows.select(
        conv_col,
        turn_col,
        F.when(fault == 4, "user").otherwise(role).alias(role_col),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, r"[.!?]", "")).otherwise(text).alias(text_col),
        F.explode(copies).alias("present"),
    )


def _closed(costs: list[float]) -> Costs:
    """Costs with inserted turns allowed before anything else."""
    for _ in range(3):
        costs = [min(c, INSERT + costs[FREE[q]]) for q, c in enumerate(costs)]
    return tuple(costs)


END = _closed([0, NEVER, NEVER, 0])
UNITS = [_closed([0 if q == k else NEVER for q in range(4)]) for k in range(4)]


def _edges(code: Code, after: Costs, q: int) -> Iterator[tuple[str, float, float, int]]:
    """Letter, own cost, cost to the end and next state of what can be done with a row in state ``q``."""
    initial, cut = code
    yield "D", DELETE, DELETE + after[q], q
    if code is GONE or code == GONE:
        return
    extra = TRUNCATED * cut
    to = KEPT[initial][q] if initial in KEPT else None
    if to is not None:
        yield "K", extra, extra + after[to], to
    yield "R", REROLE + extra, REROLE + extra + after[FREE[q]], FREE[q]


@cache
def _before(code: Code, after: Costs) -> tuple[Costs, float]:
    """Costs to the end before a row, less their least one, and that; costs differ by little, so few are worked out."""
    costs = _closed([min(total for _, _, total, _ in _edges(code, after, q)) for q in range(4)])
    least = min(costs)
    return tuple(c - least for c in costs), least


@cache
def _chosen(code: Code, after: Costs, q: int) -> tuple[str, int, int, int | None]:
    """The ASCII-least tight edits in state ``q`` up to and with a row: letters, their cost, the next state, the row's own state.

    An edit is tight if its cost and the rest add up to the least cost. The row's own state is None where it is deleted.
    """
    costs = _closed([min(total for _, _, total, _ in _edges(code, after, s)) for s in range(4)])
    letters, spent = "", 0
    while True:
        tight = [(letter, own, to) for letter, own, total, to in _edges(code, after, q) if total == costs[q]]
        if INSERT + costs[FREE[q]] == costs[q]:
            tight.append(("I", INSERT, FREE[q]))
        letter, own, to = min(tight)
        letters, spent = letters + letter, spent + int(own)
        if letter != "I":
            return letters, spent, to, None if letter == "D" else to
        q = to


def _back(codes: list[Code], after: Costs) -> tuple[Costs, float]:
    """Costs before the first of some rows, given those after the last one; less their least one, and that."""
    total = 0.0
    for code in reversed(codes):
        after, least = _before(code, after)
        total += least
    return after, total


def matrix(codes: list[Code]) -> list[float]:
    """Least cost of some rows from each state to each state, as a list of 16."""
    columns = []
    for unit in UNITS:
        costs, base = _back(codes, unit)
        columns.append([c + base for c in costs])
    return [columns[q][p] for p in range(4) for q in range(4)]


def walk(codes: list[Code], after: Costs, q: int) -> Iterator[tuple[str, int, int, int, int | None]]:
    """For each row the state before it and its :func:`_chosen` edits.

    Backward costs are kept only at every square-root-th row; each block between two is worked out again when the walk
    reaches it.
    """
    size = isqrt(max(0, len(codes) - 1)) + 1
    starts = range(0, len(codes), size)
    ends = {len(codes): after}
    for begin in reversed(starts):
        after, _ = _back(codes[begin : begin + size], after)
        ends[begin] = after
    for begin in starts:
        block = codes[begin : begin + size]
        own = list(accumulate(reversed(block), lambda a, code: _before(code, a)[0], initial=ends[begin + len(block)]))[:-1]
        for code, costs in zip(block, reversed(own)):
            letters, spent, to, row = _chosen(code, costs, q)
            yield letters, spent, q, to, row
            q = to


def blank(text: str) -> bool:
    return not text.strip(BLANKS)


def coded(roles: list[str], texts: list[str], again: set[int]) -> list[Code]:
    """What each row is to the program; ``again`` are the places of rows seen before."""
    return [
        GONE if k in again or blank(text) else (role[:1] if role[:1] in KEPT else "", text.rstrip(BLANKS)[-1] not in ENDS)
        for k, (role, text) in enumerate(zip(roles, texts))
    ]


def repeated(roles: list[str], texts: list[str]) -> set[int]:
    seen: set[tuple[str, str]] = set()
    out = set()
    for k, row in enumerate(zip(roles, texts)):
        if row in seen:
            out.add(k)
        seen.add(row)
    return out


class Conversation:
    """A conversation read in order, piece by piece: what was found, the edits and the digest. Holds no text."""

    def __init__(self) -> None:
        self.state, self.cost, self.letters, self.place = NOTHING, 0, [], 0
        self.first = self.last = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.initial: str | None = None
        self.digest = hashlib.sha256()

    def _put(self, role: str, text: str) -> tuple[int, str, str]:
        if self.place:
            self.digest.update(b"\n")
        self.digest.update(f"{role}:{text}".encode())
        self.place += 1
        return self.place - 1, role, text

    def feed(self, turns: list[int | None], roles: list[str], texts: list[str], again: set[int], after: Costs) -> Iterator[tuple[int, str, str]]:
        """Take the next rows, given the costs after them; yields the repaired turns."""
        codes = coded(roles, texts, again)
        steps = walk(codes, after, self.state)
        for k, (turn, role, text, code, step) in enumerate(zip(turns, roles, texts, codes, steps)):
            if turn is not None and (self.turns == 0 or turn != self.last):
                self.first = turn if self.turns == 0 else self.first
                self.turns, self.last = self.turns + 1, turn
            if blank(text):
                self.blank += 1
            elif k in again:
                self.duplicate += 1
            elif code[1]:
                self.truncated += 1
            if self.initial is not None and self.initial + role[:1] not in LEGAL:
                self.illegal += 1
            self.initial = role[:1]
            letters, spent, q, self.state, own = step
            self.letters.append(letters)
            self.cost += spent
            for letter in letters[:-1]:
                q = FREE[q]
                yield self._put(ROLE[q], "")
            if own is not None:
                yield self._put(role if letters[-1] == "K" else ROLE[own], text)

    def finish(self) -> Iterator[tuple[int, str, str]]:
        """What has to be inserted after the last row."""
        while self.state not in (NOTHING, ASSISTANT):
            self.state = FREE[self.state]
            self.letters.append("I")
            self.cost += INSERT
            yield self._put(ROLE[self.state], "")

    def report(self) -> tuple:
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return min(gaps, LONGEST), self.blank, self.duplicate, self.truncated, self.illegal, self.cost, "".join(self.letters), self.digest.hexdigest()


class _Out:
    """Rows gathered into batches of bounded size."""

    def __init__(self, schema: T.StructType) -> None:
        self.schema, self.rows, self.chars = to_arrow_schema(schema), [], 0

    def add(self, row: tuple, chars: int) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.chars += chars
        if len(self.rows) >= BATCH_ROWS or self.chars >= BATCH_CHARS:
            yield self.flush()

    def flush(self) -> pa.RecordBatch:
        columns = zip(*self.rows) if self.rows else [()] * len(self.schema)
        batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.schema)], schema=self.schema)
        self.rows, self.chars = [], 0
        return batch


def _results(conversation: Conversation, conv: object, turns: bool, made: Iterator[tuple], ended: bool) -> Iterator[tuple[tuple, int]]:
    """Result rows of a step: the repaired turns, or at the end the report."""
    for row in made:
        if turns:
            yield (conv, *row), len(row[2])
    if ended:
        for row in conversation.finish():
            if turns:
                yield (conv, *row), 0
        if not turns:
            yield (conv, *conversation.report()), sum(map(len, conversation.letters))


def _repair(rows: DataFrame, turns: bool, present: str | None, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    blank_ = F.lit(" ")
    is_there = F.col(present) if present else F.lit(True)
    ordered = ("conv", "turn", "role", "text")
    base = rows.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col), blank_).alias("role"), F.coalesce(F.col(text_col), blank_).alias("text"), is_there.alias("there"),
    )
    # Ranges, not hashes of the conversation: a conversation of many rows is spread over tasks, and stays in order.
    base = base.repartitionByRange(*ordered).sortWithinPartitions(*ordered).withColumn("part", F.spark_partition_id())
    conv_field = T.StructField("conv", base.schema["conv"].dataType)
    result = T.StructType.fromDDL(TURNS if turns else REPORT)
    piece = T.StructType.fromDDL("part int, seq long, turns array<long>, roles array<string>, texts array<string>")
    n_result, n_piece = len(result), len(piece)
    both = T.StructType([conv_field, *result, *piece])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Conversations that lie in one task whole and small are repaired here; others become pieces."""
        out = _Out(both)
        conv, open_, whole, seq, part = None, False, False, 0, 0
        held: tuple[list, list, list] = ([], [], [])
        chars = 0

        def give(ended: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, chars, whole, seq
            if ended and whole:
                one = Conversation()
                made = one.feed(*held, repeated(held[1], held[2]), END)
                for row, size in _results(one, conv, turns, made, True):
                    yield from out.add((*row, *[None] * n_piece), size)
            else:
                yield from out.add((conv, *[None] * n_result, part, seq, *held), chars)
                seq, whole = seq + 1, False
            held, chars = ([], [], []), 0

        for batch in batches:
            for c, turn, role, text, there, part in zip(*(col.to_pylist() for col in batch.columns)):
                if not open_ or c != conv or (c is None) != (conv is None):
                    if open_:
                        yield from give(True)
                    # The task's first conversation may have begun in another one.
                    conv, whole, open_ = c, open_, True
                if not there:
                    continue
                if held[0] and (len(held[0]) >= PIECE_ROWS or chars + len(text) > PIECE_CHARS):
                    yield from give(False)
                for values, value in zip(held, (turn, role, text)):
                    values.append(value)
                chars += len(text) + len(role)
        if open_:
            whole = False
            yield from give(True)
        yield out.flush()

    first = written_out(base.mapInArrow(cut, both))
    names = [f.name for f in result]
    done = first.where("part is null").select("conv", *names)
    pieces = first.where("part is not null").select("conv", *[f.name for f in piece])
    out = done.unionByName(_joined_pieces(pieces, conv_field, result, turns))
    return out.withColumnRenamed("conv", conv_col)


def _joined_pieces(pieces: DataFrame, conv_field: T.StructField, result: T.StructType, turns: bool) -> DataFrame:
    """Conversations in several pieces: rows seen before, then costs backward over the pieces, then edits forward.

    Only 16 numbers go from a piece to the backward pass, and four come back. Both passes read a conversation's pieces in
    order and carry a few numbers from one to the next.
    """
    key = F.sha2(F.concat(F.coalesce(F.concat(F.lit("c"), F.col("conv").cast("string")), F.lit("n")), F.lit("\n"), F.length("row.roles"), F.lit(":"), F.col("row.roles"), F.col("row.texts")).cast("binary"), 256)
    each = pieces.select("conv", "part", "seq", F.posexplode(F.arrays_zip("roles", "texts")).alias("pos", "row")).select("part", "seq", "pos", key.alias("key"))
    firsts = each.groupBy("key").agg(F.min(F.struct("part", "seq", "pos")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("key", "first")
    later = salted_join(each, firsts, "key", spread_by="pos", how="inner").where(F.struct("part", "seq", "pos") != F.col("first"))
    again = later.groupBy("part", "seq").agg(F.collect_list("pos").alias("again"))
    marked = written_out(pieces.join(again.hint("merge"), ["part", "seq"], "left"))

    key_fields = [conv_field, *T.StructType.fromDDL("part int, seq long")]
    summary = T.StructType([*key_fields, *T.StructType.fromDDL("cells array<double>")])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out(summary)
        for batch in batches:
            for conv, part, seq, roles, texts, seen in zip(*(col.to_pylist() for col in batch.columns)):
                yield from out.add((conv, part, seq, matrix(coded(roles, texts, set(seen or ())))), 0)
        yield out.flush()

    costs = T.StructType([*T.StructType.fromDDL("part int, seq long, after array<double>")])

    def backward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, now, after = _Out(costs), (), END
        for batch in batches:
            for conv, part, seq, cells in zip(*(col.to_pylist() for col in batch.columns)):
                after, now = (after if now == (conv,) else END), (conv,)
                yield from out.add((part, seq, after), 0)
                before = [min(cells[4 * p + q] + after[q] for q in range(4)) for p in range(4)]
                after = tuple(c - min(before) for c in before)
        yield out.flush()

    summaries = marked.select("conv", "part", "seq", "roles", "texts", "again").mapInArrow(summed, summary)
    descending = (F.col("part").desc(), F.col("seq").desc())
    ahead = summaries.repartition("conv").sortWithinPartitions("conv", *descending).mapInArrow(backward, costs)
    final = T.StructType([conv_field, *result])

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, now, one = _Out(final), (), Conversation()
        for batch in batches:
            for conv, turn, roles, texts, seen, after in zip(*(col.to_pylist() for col in batch.columns)):
                if now != (conv,):
                    if now:
                        for row, size in _results(one, now[0], turns, iter(()), True):
                            yield from out.add(row, size)
                    now, one = (conv,), Conversation()
                for row, size in _results(one, conv, turns, one.feed(turn, roles, texts, set(seen or ()), tuple(after)), False):
                    yield from out.add(row, size)
        if now:
            for row, size in _results(one, now[0], turns, iter(()), True):
                yield from out.add(row, size)
        yield out.flush()

    told = marked.join(ahead.hint("merge"), ["part", "seq"]).repartition("conv").sortWithinPartitions("conv", "part", "seq")
    return told.select("conv", "turns", "roles", "texts", "again", "after").mapInArrow(forward, final)


def repair_report(rows: DataFrame, present: str | None = None, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row for each conversation: its faults, the cheapest edits that give it the form ``(s?(ua)+)?``, and their cost.

    Rows stand by turn, nulls first, then by role and text. A row's first fault counts: blank, duplicate (role and text
    seen earlier) or truncated. ``gaps`` are the turns missing between the least and the greatest, ``illegal`` the
    neighbours whose roles' initials can't follow each other. ``audit`` holds the edits' initials, of the cheapest ones
    the ASCII-least: D(elete), I(nsert), K(eep), R(erole). ``repaired_sha256`` is of the repaired ``role:text`` lines.

    Null roles and texts count as one space, null turns are not counted in ``gaps``, and a null conversation is one.
    Equal rows are duplicates. A ``gaps`` beyond a long is its end. Rows for which the column ``present`` is false only
    name their conversation: with no others it has zeros, no edits and the digest of nothing. An empty table gives an
    empty table; other columns are not looked at.

    A conversation of any length is cut into pieces over many tasks. Costs go backward over one small matrix for each
    piece; within a piece they are kept at square-root checkpoints and worked out again while walking forward. The digest
    is one sequential hash by its nature, so the pieces of one conversation, and only those, pass through one task in
    order; it holds one piece at a time, and the audit.
    """
    return _repair(rows, False, present, conv_col, turn_col, role_col, text_col)


def repaired_turns(rows: DataFrame, present: str | None = None, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The repaired conversations: conversation, place from 0, role and text; see :func:`repair_report`."""
    return _repair(rows, True, present, conv_col, turn_col, role_col, text_col)
