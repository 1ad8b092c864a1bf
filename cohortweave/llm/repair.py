"""Repair of conversation structure: the cheapest edits that give an optional system turn and pairs of user and assistant.

Rows of a conversation, in order, are read by a small automaton. Keeping a row costs 0, giving it the role of user or assistant 1,
deleting it 2, inserting an empty turn 5; an undeleted truncated row costs 5 more, and blank or repeated rows must go.
Of the cheapest edits the ASCII-least string of initials (D, I, K, R) is chosen. A string names its result: each state
has one successor per initial.

The rows are range-sorted, so a conversation may lie in many tasks. A task cuts its rows into segments and reduces each one to
a matrix of costs between states. Walking back over the matrices gives the cost vector at each segment's end: the
checkpoints, the only vectors that are stored. Walking forward, a segment recomputes its vectors from its checkpoint, by
blocks of about the root of its length, and picks the edits.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortweave.llm.blocks import bounded_batches, stored

SEGMENT_ROWS = 4096
SEGMENT_BYTES = 1 << 20  # of text; one row may be larger

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5  # costs
SPACE = " \t\n\x0b\x0c\r"
NEVER = 1 << 40

# States: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
TURN = (USER, USER, ASSISTANT, USER)  # successor by a user or assistant turn, whichever is due
ROLE = {USER: "user", ASSISTANT: "assistant"}
KEPT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
FINE, GONE, CUT = range(3)  # a row may stay, must go, is truncated
INITIALS = "sua?"
LEGAL = ("su", "ua", "au")

SEGMENTS = (
    "conv string, part int, seq long, codes binary, roles array<string>, texts array<string>, costs array<long>, blank long, duplicate long, "
    "truncated long, illegal long, first string, last string, turns long, least long, most long"
)
SUMMARY = "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
TURNS = "conv string, position long, edit string, role string, text string"


def code(initial: str, fault: int) -> int:
    return (INITIALS.find(initial) if initial and initial in "sua" else 3) * 3 + fault


def choices(row: int, state: int) -> list[tuple[str, int, int]]:
    """Edits of a row in a state in ASCII order: initial, cost, next state. Inserts are not among them."""
    initial, fault = INITIALS[row // 3], row % 3
    found = [("D", DELETE, state)]
    if fault != GONE:
        more = TRUNCATED if fault == CUT else 0
        if state in KEPT.get(initial, {}):
            found.append(("K", KEEP + more, KEPT[initial][state]))
        found.append(("R", REROLE + more, TURN[state]))
    return found


CHOICES = [[choices(row, state) for state in range(STATES)] for row in range(12)]


def with_inserts(costs: Sequence[int]) -> list[int]:
    """Costs from each state when turns may be inserted first; two in a row are the most that can help."""
    return [min(costs[q], INSERT + costs[TURN[q]], 2 * INSERT + costs[TURN[TURN[q]]]) for q in range(STATES)]


END = with_inserts([0, NEVER, NEVER, 0])  # costs after the last row


def _plain_before(row: int, after: Sequence[int]) -> list[int]:
    return with_inserts([min(cost + after[to] for _, cost, to in CHOICES[row][q]) for q in range(STATES)])


# STEPS[row][state][next]: least cost of a row between two states.
STEPS = [[[_plain_before(row, [0 if t == to else NEVER for t in range(STATES)])[q] for to in range(STATES)] for q in range(STATES)] for row in range(12)]


# Relative to their least entry, cost vectors take few values, since inserts bound the differences: each step is computed once.
@lru_cache(1 << 16)
def _before(row: int, after: tuple[int, ...]) -> tuple[int, ...]:
    return tuple(min(x, NEVER) for x in _plain_before(row, after))


@lru_cache(1 << 16)
def _behind(row: int, costs: tuple[int, ...]) -> tuple[int, ...]:
    return tuple(min(NEVER, *(costs[q] + STEPS[row][q][to] for q in range(STATES))) for to in range(STATES))


def _moved(step: Callable, row: int, vector: Sequence[int]) -> tuple[int, ...]:
    least = min(vector)
    return tuple([least + x for x in step(row, tuple([min(x - least, NEVER) for x in vector]))])


def before(row: int, after: Sequence[int]) -> tuple[int, ...]:
    """Costs from each state before a row, given those after it."""
    return _moved(_before, row, after)


def matrix(codes: bytes) -> np.ndarray:
    """Least cost from each state before the rows to each state after them."""
    lines = []
    for state in range(STATES):
        costs: Sequence[int] = [0 if q == state else NEVER for q in range(STATES)]
        for row in codes:
            costs = _moved(_behind, row, costs)
        lines.append([min(x, NEVER) for x in costs])
    return np.array(lines, dtype=np.int64)


def walk(codes: bytes, end: Sequence[int], state: int) -> tuple[str, list[int]]:
    """Initials of the edits and the state after each.

    Vectors are kept at the ends of blocks of about the root of the length, and recomputed inside a block on the way
    forward.
    """
    n = len(codes)
    size = max(1, math.isqrt(n))
    kept = {n: list(end)}
    vector = list(end)
    for i in range(n - 1, -1, -1):
        vector = before(codes[i], vector)
        if i % size == 0:
            kept[i] = vector
    edits: list[str] = []
    states: list[int] = []
    for start in range(0, n, size):
        stop = min(start + size, n)
        block = [kept[stop]]
        for i in range(stop - 1, start - 1, -1):
            block.append(before(codes[i], block[-1]))
        block.reverse()
        for i in range(start, stop):
            here, after = block[i - start], block[i - start + 1]
            while True:
                found = next((c for c in CHOICES[codes[i]][state] if c[1] + after[c[2]] == here[state]), None)
                # An insert comes before Keep and Rerole, and after Delete.
                if (found is None or found[0] != "D") and INSERT + here[TURN[state]] == here[state]:
                    state = TURN[state]
                    edits.append("I")
                    states.append(state)
                    continue
                edits.append(found[0])
                state = found[2]
                states.append(state)
                break
    return "".join(edits), states


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows (conv, turn, role, text, digest, copies), in order over all partitions; ``kind`` 0 marks a first occurrence.

    Repeated rows meet before any shuffle. The mark of a first occurrence sorts right before its row, so no join is needed.
    """
    digest = "sha2(concat(octet_length(role), ':', role, text), 256)"
    whole = rows.selectExpr("*", f"{digest} AS digest")
    counted = whole.groupBy("conv", "turn", "role", "digest", "text").agg(F.count(F.lit(1)).alias("copies"))
    seen = whole.groupBy("conv", "role", "digest").agg(F.min("turn").alias("least"), F.expr("bool_or(turn IS NULL) AS untimed"))
    marks = seen.selectExpr("conv", "CASE WHEN NOT untimed THEN least END AS turn", "role", "digest", "cast(null AS string) AS text", "0L AS copies")
    both = counted.unionByName(marks).selectExpr("*", "if(copies = 0, 0, 1) AS kind")
    order = ["conv", "turn", "role", "digest", "kind"]
    return both.repartitionByRange(*order[:4]).sortWithinPartitions(*order)


@dataclass
class _Segment:
    """Rows of one conversation being gathered in a task."""

    conv: str
    codes: bytearray = field(default_factory=bytearray)
    roles: list = field(default_factory=list)
    texts: list = field(default_factory=list)
    size: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    first: str | None = None
    last: str | None = None
    turns: int = 0
    least: int | None = None
    most: int | None = None

    def add(self, turn: int | None, role: str, text: str, again: bool) -> None:
        initial = role[:1]
        shown = text.rstrip(SPACE)
        fault = FINE
        if not shown:
            self.blank += 1
            fault = GONE
        elif again:
            self.duplicate += 1
            fault = GONE
        elif shown[-1] not in ".!?":
            self.truncated += 1
            fault = CUT
        if self.last is None:
            self.first = initial
        elif self.last + initial not in LEGAL:
            self.illegal += 1
        self.last = initial
        if turn is not None and turn != self.most:
            self.turns += 1
            self.most = turn
            self.least = turn if self.least is None else self.least
        self.codes.append(code(initial, fault))
        self.roles.append("" if fault == GONE else role)
        self.texts.append("" if fault == GONE else text)
        self.size += len(self.texts[-1])

    def row(self, part: int, seq: int) -> dict:
        codes = bytes(self.codes)
        return {
            "conv": self.conv, "part": part, "seq": seq, "codes": codes, "roles": self.roles, "texts": self.texts,
            "costs": matrix(codes).ravel().tolist(), "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated,
            "illegal": self.illegal, "first": self.first, "last": self.last, "turns": self.turns, "least": self.least, "most": self.most,
        }


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Segments of one sorted partition."""
    part, seq = TaskContext.get().partitionId(), 0
    held: _Segment | None = None
    mark = None
    for batch in batches:
        for conv, turn, role, digest, text, copies in zip(*(batch.column(c).to_pylist() for c in ("conv", "turn", "role", "digest", "text", "copies"))):
            if copies == 0:
                mark = (conv, turn, role, digest)
                continue
            for copy in range(copies):
                if held and (held.conv != conv or len(held.codes) >= SEGMENT_ROWS or held.size >= SEGMENT_BYTES):
                    yield held.row(part, seq)
                    held, seq = None, seq + 1
                held = held or _Segment(conv)
                held.add(turn, role, text, copy > 0 or mark != (conv, turn, role, digest))
    if held:
        yield held.row(part, seq)


def _batched(rows: Iterator[dict], names: list[str], types: dict, size: str) -> Iterator[pa.RecordBatch]:
    """Arrow batches of about a megabyte of ``size``."""
    schema = pa.schema([(n, types[n]) for n in names])
    held, total = [], 0
    for row in rows:
        held.append(row)
        total += 100 + (len(row[size]) if isinstance(row[size], (str, bytes)) else sum(map(len, row[size] or [])))
        if total >= SEGMENT_BYTES:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, total = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


_ARROW = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<string>": pa.list_(pa.string()), "array<long>": pa.list_(pa.int64())}


def _types(schema: str) -> dict:
    return {name: _ARROW[kind] for name, kind in (item.split(" ") for item in schema.split(", "))}


def _segments(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    bounded_batches(rows.sparkSession)
    named = rows.selectExpr(
        f"{conv_key(conv)} AS conv",
        f"cast(`{turn}` AS bigint) AS turn",
        f"coalesce(cast(`{role}` AS string), ' ') AS role",
        f"coalesce(cast(`{text}` AS string), ' ') AS text",
    )
    types = _types(SEGMENTS)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batched(_gather(batches), list(types), types, "texts")

    return stored(_ordered(named).mapInArrow(build, SEGMENTS), "segments")


def _checkpoints(segments: DataFrame) -> DataFrame:
    """Cost vector at the end of each segment, from the last one of a conversation to its first."""
    schema = "conv string, part int, seq long, ends array<long>"
    types = _types(schema)

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, vector = None, END
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                if row["conv"] != conv:
                    conv, vector = row["conv"], END
                found.append({"conv": conv, "part": row["part"], "seq": row["seq"], "ends": list(map(int, vector))})
                costs = np.array(row["costs"], dtype=np.int64).reshape(STATES, STATES)
                vector = np.minimum((costs + np.asarray(vector)[None]).min(axis=1), NEVER)
            yield pa.RecordBatch.from_pylist(found, schema=pa.schema(list(types.items())))

    small = segments.select("conv", "part", "seq", "costs").repartition("conv")
    return small.sortWithinPartitions("conv", F.desc("part"), F.desc("seq")).mapInArrow(back, schema)


@dataclass
class _Told:
    """A conversation on its way forward through its segments."""

    conv: str
    cost: int
    state: int = START
    audit: list = field(default_factory=list)
    digest: object = field(default_factory=hashlib.sha256)
    position: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    last: str | None = None
    turns: int = 0
    least: int | None = None
    most: int | None = None

    def take(self, row: dict, ends: list[int]) -> Iterator[dict]:
        """Edit the rows of the next segment."""
        for name in ("blank", "duplicate", "truncated", "illegal"):
            setattr(self, name, getattr(self, name) + row[name])
        if self.last is not None and self.last + row["first"] not in LEGAL:
            self.illegal += 1
        self.last = row["last"]
        if row["least"] is not None:
            self.turns += row["turns"] - (row["least"] == self.most)
            self.least = row["least"] if self.least is None else self.least
            self.most = row["most"]
        edits, states = walk(row["codes"], ends, self.state)
        old = iter(zip(row["roles"], row["texts"]))
        for edit, state in zip(edits, states):
            self.audit.append(edit)
            self.state = state
            role, text = next(old) if edit != "I" else ("", "")
            if edit != "D":
                yield self.turn(edit, role if edit == "K" else ROLE[state], text)

    def close(self) -> Iterator[dict]:
        """The turns that must be inserted at the end."""
        while self.state in (SYSTEM, USER):
            self.state = TURN[self.state]
            self.audit.append("I")
            yield self.turn("I", ROLE[self.state], "")

    def turn(self, edit: str, role: str, text: str) -> dict:
        self.digest.update(f"{chr(10) if self.position else ''}{role}:{text}".encode())
        self.position += 1
        return {"conv": self.conv, "position": self.position, "edit": edit, "role": role, "text": text}

    def summary(self) -> dict:
        return {
            "conv": self.conv, "gaps": 0 if self.least is None else self.most - self.least + 1 - self.turns, "blank": self.blank,
            "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal, "cost": self.cost,
            "audit": "".join(self.audit), "repaired_sha256": self.digest.hexdigest(),
        }


def _forward(batches: Iterator[pa.RecordBatch], turns: bool) -> Iterator[dict]:
    """Walk conversations segment by segment; the checkpoint of a segment comes right before it."""
    told: _Told | None = None
    ends: list[int] = []

    def finish() -> Iterator[dict]:
        last = list(told.close())
        yield from last if turns else [told.summary()]

    for batch in batches:
        for row in batch.to_pylist():
            if row["ends"] is not None:
                ends = row["ends"]
                continue
            if told is None or told.conv != row["conv"]:
                if told:
                    yield from finish()
                costs = np.array(row["costs"], dtype=np.int64).reshape(STATES, STATES)[START]
                told = _Told(row["conv"], int((costs + np.array(ends)).min()))
            for turn in told.take(row, ends):
                if turns:
                    yield turn
    if told:
        yield from finish()


def _edited(rows: DataFrame, conv: str, turn: str, role: str, text: str, turns: bool) -> DataFrame:
    segments = _segments(rows, conv, turn, role, text)
    both = segments.unionByName(_checkpoints(segments), allowMissingColumns=True)
    together = both.repartition("conv").sortWithinPartitions("conv", "part", "seq", F.col("ends").isNull())
    schema = TURNS if turns else SUMMARY
    types = _types(schema)

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batched(_forward(batches, turns), list(types), types, "text" if turns else "audit")

    return together.mapInArrow(forward, schema)


def conv_key(conv: str) -> str:
    """SQL: text that tells conversations apart, NULL included; the column ``conv`` of the results."""
    return f"coalesce(concat('=', cast(`{conv}` AS string)), 'none')"


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Per conversation: faults, cost and initials of the cheapest edits, SHA-256 of the repaired ``role:text`` lines.

    * Order is by turn, NULL first; rows of one turn follow by role, then by a hash of role and text, repeated rows adjacent.
    * A NULL role or text counts as one space. Rows with NULL as conversation are one conversation.
    * The first fault of a row counts: blank, duplicate (role and text occurred before), truncated (no ``.``, ``!`` or ``?`` at the end).
    * ``gaps`` are the turn numbers missing between the least and the greatest; 0 where all are NULL.
    * A role of another initial, or an empty one, can't be kept. Such neighbours are illegal.
    * Conversations without rows do not occur; an empty table gives no rows. Other columns are not read.

    Texts may be of any length. No step holds a conversation: its repaired text is hashed as it streams by, in one task,
    since a digest has one order. The string of initials is a cell of the result.
    """
    return _edited(rows, conv, turn, role, text, turns=False)


def repaired_turns(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The repaired turns themselves: ``conv``, ``position`` from 1, ``edit`` (K, R or I), ``role``, ``text``; rules as in ``repair``."""
    return _edited(rows, conv, turn, role, text, turns=True)
