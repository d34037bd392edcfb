"""Conversation structure repair: the cheapest edits that make the roles of a conversation alternate.

A repaired conversation is empty, or an optional system turn and then pairs of user and assistant. Edits are found by
a Viterbi search over four states, turn by turn. Survivors share their past in a tree of
back pointers with reference counts; as soon as all survivors descend from one node, the edits up to it are
final and leave the tree, so memory holds the undecided end of one conversation only. Equal costs are
settled by comparing what the two survivors do not share, whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256
from itertools import product

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    LongType,
    StringType,
    StructField,
    StructType,
)

from anaquel.llm.common import SPACE, ship

REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: No survivor that costs more than this above the cheapest can win: from any state every continuation of any
#: other can be followed for at most so much (insert an assistant, delete one system turn).
CATCH_UP = 5
ROWS = 4096  # rows of an output batch

# States: nothing yet, after the system turn, after a user turn, after an assistant turn.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_NEXT = (_USER, _USER, _ASSISTANT, _USER)
_FINISH = ("", "II", "I", "")
_NAME = {_USER: "user", _ASSISTANT: "assistant"}


def _transitions(initial: str, forced: bool, truncated: bool) -> tuple[tuple[int, int, int, str], ...]:
    """``(state, next state, cost, edits)`` of one turn: inserts before it, then what becomes of it.

    Two inserts reach every state; of edits between the same states only the first in (cost, text) can win.
    """
    best: dict[tuple[int, int], tuple[int, str]] = {}

    def offer(start: int, end: int, cost: int, edits: str) -> None:
        best[start, end] = min(best.get((start, end), (cost, edits)), (cost, edits))

    for start, inserts in product(range(4), range(3)):
        state = start
        for _ in range(inserts):
            state = _NEXT[state]
        cost, edits = inserts * INSERT, "I" * inserts
        offer(start, state, cost + DELETE, edits + "D")
        if forced:
            continue
        cost += TRUNCATED * truncated
        offer(start, _NEXT[state], cost + REROLE, edits + "R")
        if initial == "s" and state == _START:
            offer(start, _SYSTEM, cost, edits + "K")
        elif initial and initial == _NAME[_NEXT[state]][0]:
            offer(start, _NEXT[state], cost, edits + "K")
    return tuple((a, b, cost, edits) for (a, b), (cost, edits) in best.items())


_TRANSITIONS = {
    (initial, forced, truncated): _transitions(initial, forced, truncated)
    for initial, forced, truncated in product(("s", "u", "a", ""), (False, True), (False, True))
}

Turn = tuple[object, str, str]  # turn, role, text
Emit = Callable[[str, "Turn | None", str, str], None]


class _Node:
    """The edits of one turn on a survivor's path."""

    __slots__ = ("parent", "kids", "refs", "edits", "turn")

    def __init__(self, parent: _Node | None, edits: str, turn: Turn | None) -> None:
        self.parent, self.edits, self.turn = parent, edits, turn
        self.kids: list[_Node] = []
        self.refs = 0  # children, and survivors that end here


class Survivors:
    """The search over one conversation; ``emit(edit, turn, role, text)`` gets each edit once it is final."""

    def __init__(self, emit: Emit) -> None:
        self._emit = emit
        self._root = _Node(None, "", None)
        self._root.refs = 1
        self._state = _START  # after the edits that have been emitted
        self._ends: dict[int, tuple[int, _Node]] = {_START: (0, self._root)}

    def undecided(self) -> int:
        """Turns whose edits are still open."""
        node, n = next(iter(self._ends.values()))[1], 0
        while node is not self._root:
            node, n = node.parent, n + 1
        return n

    def push(self, turn: Turn, forced: bool, truncated: bool) -> None:
        """One more turn; ``forced`` ones must go, ``truncated`` ones cost more if they stay."""
        initial = turn[1][:1]
        steps = _TRANSITIONS[initial if initial in ("s", "u", "a") else "", forced, truncated]
        best: dict[int, tuple[int, _Node, str]] = {}
        for start, end, cost, edits in steps:
            if start not in self._ends:
                continue
            total, node = self._ends[start]
            offer = (total + cost, node, edits)
            if end not in best or _first(offer, best[end]):
                best[end] = offer
        least = min(cost for cost, _, _ in best.values())
        ends: dict[int, tuple[int, _Node]] = {}
        for state, (cost, parent, edits) in best.items():
            if cost <= least + CATCH_UP:
                node = _Node(parent, edits, turn)
                node.refs = 1
                parent.kids.append(node)
                parent.refs += 1
                ends[state] = (cost, node)
        for _, node in self._ends.values():
            self._release(node)
        self._ends = ends
        self._coalesce()

    def finish(self) -> int:
        """Emit all that is left; the cost of the whole repair."""
        closing = {s: (c + INSERT * len(_FINISH[s]), node, _FINISH[s]) for s, (c, node) in self._ends.items()}
        cost, node, edits = best = closing.popitem()[1]
        for offer in closing.values():
            if _first(offer, best):
                cost, node, edits = best = offer
        path = []
        while node is not self._root:
            path.append(node)
            node = node.parent
        for node in reversed(path):
            self._apply(node.edits, node.turn)
        self._apply(edits, None)
        return cost

    def _release(self, node: _Node) -> None:
        """One reference less; what nothing refers to leaves the tree, and so on upwards."""
        node.refs -= 1
        while not node.refs and node is not self._root:
            parent = node.parent
            parent.kids.remove(node)
            parent.refs -= 1
            node = parent

    def _coalesce(self) -> None:
        """While the root has one child and no survivor ends at it, the child's edits are final."""
        while self._root.refs == 1 and self._root.kids:
            self._root = self._root.kids[0]
            self._root.parent = None
            self._apply(self._root.edits, self._root.turn)

    def _apply(self, edits: str, turn: Turn | None) -> None:
        """Edits fix the states they pass, and these the roles."""
        for edit in edits:
            if edit == "D":
                self._emit("D", turn, turn[1], turn[2])
            elif edit == "K":
                self._state = _SYSTEM if turn[1][:1] == "s" else _NEXT[self._state]
                self._emit("K", turn, turn[1], turn[2])
            else:
                self._state = _NEXT[self._state]
                self._emit(edit, turn if edit == "R" else None, _NAME[self._state], turn[2] if edit == "R" else "")


def _first(a: tuple[int, _Node, str], b: tuple[int, _Node, str]) -> bool:
    """Whether a is the better way to the same place: cheaper, or as cheap and with the lesser edits.

    Both paths have passed the same turns, so they are followed back side by side to where they part. Neither can be
    a beginning of the other: it would have inserts in addition, and cost more.
    """
    if a[0] != b[0]:
        return a[0] < b[0]
    left, right, x, y = [a[2]], [b[2]], a[1], b[1]
    while x is not y:
        left.append(x.edits)
        right.append(y.edits)
        x, y = x.parent, y.parent
    return "".join(reversed(left)) < "".join(reversed(right))


def damage(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, present``: turns with the defects that a checksum of each row's place plants.

    Of crc32(``conv_id:turn``) modulo 20, 0 drops the row (it stays as one that is not ``present``), 1
    empties its text, 2 takes `.`, `!` and `?` out, 3 repeats it, 4 makes it the user's. Nulls count
    as one space. Other columns are not read.
    """

    def word(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    code = F.crc32(F.concat(word("conv_id"), F.lit(":"), word("turn")).cast("binary")) % 20
    times = F.explode(F.array_repeat(F.lit(True), F.when(F.col("code") == 3, 2).otherwise(1)))
    return (
        conversations.select("conv_id", "turn", word("role").alias("role"), word("text").alias("text"), code.alias("code"))
        .withColumn("copy", times)
        .select(
            "conv_id", "turn",
            F.when(F.col("code") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
            F.when(F.col("code") == 1, F.lit("")).when(F.col("code") == 2, F.translate("text", ".!?", ""))
            .otherwise(F.col("text")).alias("text"),
            (F.col("code") != 0).alias("present"),
        )
    )


def _in_order(turns: DataFrame, present: Column | None) -> DataFrame:
    """Turns with their faults, whole conversations in one partition, in order.

    One exchange: what seeks equal turns is placed by conversation as well. Equal turns of a
    conversation are ordered by role and text, so copies lie side by side.
    """
    rows = turns.select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
        (F.lit(True) if present is None else F.coalesce(present, F.lit(False))).alias("present"),
    ).repartition("conv_id")
    same = Window.partitionBy("conv_id", "role", "text", "present").orderBy(F.col("turn").asc_nulls_first())
    solid = F.btrim("text", F.lit(SPACE))
    fault = (
        F.when(solid == "", "blank").when(F.row_number().over(same) > 1, "duplicate")
        .when(~F.substring(solid, -1, 1).isin(".", "!", "?"), "truncated")
    )
    return rows.withColumn("fault", fault).sortWithinPartitions(
        "conv_id", F.col("turn").asc_nulls_first(), "role", "text"
    )


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, object, Turn, bool, str | None]]:
    """Rows as Python values, with a mark on the first of each conversation."""
    last: object = _turns  # equal to no conv_id
    for batch in batches:
        for conv, turn, role, text, present, fault in zip(*(c.to_pylist() for c in batch.columns)):
            yield conv != last, conv, (turn, role, text), present, fault
            last = conv


class _Report:
    """What ``repair`` says of one conversation, summed up turn by turn."""

    def __init__(self, conv: object) -> None:
        self.conv, self.audit, self.digest, self.empty = conv, [], sha256(), True
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal, self.distinct, self.least, self.most, self.before = 0, 0, None, None, None
        self.search = Survivors(self._edit)

    def _edit(self, edit: str, turn: Turn | None, role: str, text: str) -> None:
        self.audit.append(edit)
        if edit != "D":
            self.digest.update(b"" if self.empty else b"\n")
            self.digest.update(f"{role}:{text}".encode())
            self.empty = False

    def push(self, turn: Turn, fault: str | None) -> None:
        number, initial = turn[0], turn[1][:1]
        if fault:
            self.faults[fault] += 1
        if self.before is not None and self.before + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = initial
        if number is not None and number != self.most:
            self.least = number if self.least is None else self.least
            self.most = number
            self.distinct += 1
        self.search.push(turn, fault in ("blank", "duplicate"), fault == "truncated")

    def row(self) -> tuple:
        cost = self.search.finish()
        gaps = self.most - self.least + 1 - self.distinct if self.distinct else 0
        return (
            self.conv, gaps, *self.faults.values(), self.illegal, cost, "".join(self.audit), self.digest.hexdigest()
        )


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema
        )

    for row in rows:
        held.append(row)
        if len(held) == ROWS:
            yield batch()
            held = []
    if held:
        yield batch()


def _mapped(turns: DataFrame, rows_of, fields: list[StructField]) -> DataFrame:
    ship(turns.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(iter(batches), None)
        if first is None:
            return
        kinds = [pa.int64() if isinstance(f.dataType, LongType) else pa.string() for f in fields]
        schema = pa.schema([("conv_id", first.schema.field(0).type), *((f.name, k) for f, k in zip(fields, kinds))])

        def all_batches() -> Iterator[pa.RecordBatch]:
            yield first
            yield from batches

        yield from _batches(rows_of(_turns(all_batches())), schema)

    return turns.mapInArrow(run, StructType([turns.schema["conv_id"], *fields]))


def repair(turns: DataFrame, present: Column | None = None) -> DataFrame:
    """One row per conversation: its faults, the cheapest repair's cost and edits, and a hash of what it gives.

    Columns: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``. Turns go by
    ``turn`` (null first), then role and text. Null roles and texts count as one space, so such
    a text is blank. Rows for which ``present`` is not true only say that the conversation exists; one without
    others has zeros, no edits and the hash of nothing. Rows without conv_id are one conversation. An
    empty table gives no rows. Other columns are not read. A conversation is searched turn by turn in one
    task, which holds its undecided turns and its edits' letters, not its texts.
    """

    def reports(rows) -> Iterator[tuple]:
        report = None
        for new, conv, turn, there, fault in rows:
            if new:
                if report is not None:
                    yield report.row()
                report = _Report(conv)
            if there:
                report.push(turn, fault)
        if report is not None:
            yield report.row()

    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    fields = [StructField(c, LongType()) for c in numbers]
    fields += [StructField(c, StringType()) for c in ("audit", "repaired_sha256")]
    return _mapped(_in_order(turns, present), reports, fields)


def repaired_turns(turns: DataFrame) -> DataFrame:
    """The edits themselves: ``conv_id, position, edit, turn, role, text``, in the order of the repair.

    ``edit`` is K (kept), R (given another role), D (deleted: not part of the repaired conversation) or I (inserted
    with empty text; turn null). Positions count a conversation's edits from 0. Edits leave the task as
    soon as they are final. Rows are read as by ``repair``.
    """

    def edits(rows) -> Iterator[tuple]:
        out: list[tuple] = []
        conv, search, position = None, None, 0

        def emit(edit: str, turn: Turn | None, role: str, text: str) -> None:
            nonlocal position
            out.append((conv, position, edit, None if turn is None else turn[0], role, text))
            position += 1

        for new, own, turn, _, fault in rows:
            if new:
                if search is not None:
                    search.finish()
                    yield from out
                    out.clear()
                conv, search, position = own, Survivors(emit), 0
            search.push(turn, fault in ("blank", "duplicate"), fault == "truncated")
            yield from out
            out.clear()
        if search is not None:
            search.finish()
            yield from out

    fields = [
        StructField("position", LongType()), StructField("edit", StringType()), StructField("turn", LongType()),
        StructField("role", StringType()), StructField("text", StringType()),
    ]
    return _mapped(_in_order(turns, None), edits, fields)
