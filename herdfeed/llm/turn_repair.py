"""Conversation structure repair (operator 12): survivor-coalescence Viterbi.

A repaired conversation is empty, or an optional system turn and then pairs of a user's and an
assistant's turn. Rows are kept, given another role, or deleted, and empty turns are inserted; the
cheapest edits win, among equally cheap ones the least string of their initials.

The search goes through a conversation's rows in order. For each of the four states that the
repaired part can be in (empty, after a system's, a user's, an assistant's turn) one survivor is
kept: the end of a branch of a tree of edits. A row adds a level; branches that no survivor stands
on are cut off, each node counting the nodes that refer to it. As soon as the root has one child
only, all survivors agree on that edit, and it is emitted and forgotten. Memory holds the rows that
survivors still differ on, never a conversation.

Equal costs are settled by the complete strings of the edits that survivors still differ on. A
piece (what is done at one row: insertions before it, then one edit of the row) never begins
another piece, so the order of two strings is that of the earlier survivors they come from, or of
their last pieces if it is the same one; survivors carry their place in this order from row to row.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Costs of edits, by initial; an undeleted truncated row costs more.
COST = {"K": 0, "R": 3, "I": 3, "D": 4}
TRUNCATED_COST = 3
_SPACE = " \t\n\x0b\x0c\r"
_SOLID = re.compile(r"[^\x20\x09-\x0D]")
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
#: The state that an inserted or renamed turn leads to, and its role.
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: The state that a kept turn leads to, by state and initial of its role.
KEPT = {(EMPTY, "s"): SYSTEM, (EMPTY, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: Insertions before a row from each state; a third one could only lengthen the repair.
_INSERTS = tuple(tuple(("I" * k, COST["I"] * k, s) for k, s in enumerate((state, NEXT[state], NEXT[NEXT[state]]))) for state in range(4))
#: ``LEAD[x][y]``: whatever is done from y on, the same can be done from x for so much more at most.
#: By insertions alone, and 4 where a system's turn that y might still keep is deleted instead.
LEAD = ((0, 0, 3, 0), (10, 0, 3, 6), (7, 3, 0, 3), (4, 0, 3, 0))
#: Insertions that complete the repair from each state.
_CLOSING = ("", "II", "I", "")


def fault_of(text: str, seen: bool) -> str:
    """First fault of a row: ``blank``, ``duplicate``, ``truncated`` or none (empty)."""
    if not _SOLID.search(text):
        return "blank"
    if seen:
        return "duplicate"
    return "" if text.rstrip(_SPACE)[-1] in ".!?" else "truncated"


class _Node:
    __slots__ = ("parent", "piece", "referring")

    def __init__(self, parent: _Node | None, piece: str) -> None:
        self.parent, self.piece = parent, piece
        self.referring: list[_Node] = []
        if parent is not None:
            parent.referring.append(self)


class TurnRepair:
    """Repairs one conversation row by row; ``emit(edit, row, role, text)`` gets each edit when it
    is certain. ``row`` is what :meth:`add` was given, None for an insertion."""

    def __init__(self, emit: Callable[[str, object, str, str], None]) -> None:
        self.emit = emit
        self.root = _Node(None, "")
        #: (cost, node) of each state's survivor, in the order of their strings: least first.
        self.survivors: dict[int, tuple[int, _Node]] = {EMPTY: (0, self.root)}
        self.waiting: deque = deque()
        self.state = EMPTY  # after what was emitted

    def _pieces(self, state: int, role: str, fault: str):
        """(piece, its cost, next state) of everything that can be done at a row."""
        for inserts, cost, at in _INSERTS[state]:
            yield inserts + "D", cost + COST["D"], at
            if fault in ("blank", "duplicate"):
                continue
            extra = TRUNCATED_COST if fault else 0
            kept = KEPT.get((at, role[:1]))
            if kept is not None:
                yield inserts + "K", cost + COST["K"] + extra, kept
            yield inserts + "R", cost + COST["R"] + extra, NEXT[at]

    def add(self, role: str, text: str, fault: str, row: object = None) -> None:
        best: dict[int, tuple] = {}
        for place, (state, (cost, node)) in enumerate(self.survivors.items()):
            for piece, more, then in self._pieces(state, role, fault):
                found = (cost + more, place, piece, node)
                if then not in best or found[:3] < best[then][:3]:
                    best[then] = found
        best = {y: found for y, found in best.items() if all(other[0] + LEAD[x][y] >= found[0] for x, other in best.items())}
        before = [node for _, node in self.survivors.values()]
        ordered = sorted(best.items(), key=lambda x: x[1][1:3])
        self.survivors = {state: (cost, _Node(node, piece)) for state, (cost, _, piece, node) in ordered}
        self.waiting.append((role, text, row))
        for node in before:
            self._cut(node)
        self._agree()

    def _cut(self, node: _Node) -> None:
        """Forget a branch that nothing refers to."""
        while not node.referring and node.parent is not None:
            node.parent.referring.remove(node)
            node = node.parent

    def _agree(self) -> None:
        while self.waiting and len(self.root.referring) == 1:
            self.root = self.root.referring[0]
            self.root.parent = None
            self._emit(self.root.piece)

    def _emit(self, piece: str) -> None:
        for edit in piece:
            if edit == "I":
                self.state = NEXT[self.state]
                self.emit("I", None, ROLE[self.state], "")
                continue
            role, text, row = self.waiting.popleft()
            if edit == "K":
                self.state = KEPT[self.state, role[:1]]
            elif edit == "R":
                self.state = NEXT[self.state]
                role = ROLE[self.state]
            self.emit(edit, row, role, text)

    def finish(self) -> int:
        """Emit what is left; gives the cost of all edits."""
        cost, _, state, node = min((cost + COST["I"] * len(_CLOSING[state]), place, state, node)
                                   for place, (state, (cost, node)) in enumerate(self.survivors.items()))
        pieces = []
        while node is not self.root:
            pieces.append(node.piece)
            node = node.parent
        for piece in reversed(pieces):
            self._emit(piece)
        self._emit(_CLOSING[state])
        return cost


def _in_order(rows: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str, live: Column | None) -> DataFrame:
    """``conv_id, turn, role, text, live, seen``: a conversation's rows one after the other, each
    knowing whether its role and text stood there before."""
    own = rows.select(F.col(id_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                      F.coalesce(F.col(role_col), F.lit(" ")).alias("role"), F.coalesce(F.col(text_col), F.lit(" ")).alias("text"),
                      (F.lit(True) if live is None else F.coalesce(live, F.lit(False))).alias("live"))
    # One shuffle: a conversation's rows come together, equal rows within it need only a sort.
    equal = Window.partitionBy("conv_id", "live", "role", "text").orderBy(F.asc_nulls_first("turn"))
    return (own.repartition("conv_id").withColumn("seen", F.row_number().over(equal) > 1)
            .sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text", "seen"))


class _Report:
    """Figures of one conversation, and its repair."""

    def __init__(self, conv_id, take: Callable) -> None:
        self.conv_id = conv_id
        self.repair = TurnRepair(take)
        self.count = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        self.first = self.last = self.initial = None
        self.turns = self.illegal = 0

    def add(self, turn, role: str, text: str, seen: bool) -> None:
        fault = fault_of(text, seen)
        if fault:
            self.count[fault] += 1
        if turn is not None:
            self.turns += turn != self.last
            self.first = turn if self.first is None else self.first
            self.last = turn
        if self.initial is not None and self.initial + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = role[:1]
        self.repair.add(role, text, fault, turn)

    def figures(self) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return (gaps, *self.count.values(), self.illegal, self.repair.finish())


def _conversations(batches: Iterable[pa.RecordBatch], begin: Callable[[object], _Report]):
    """Runs rows through a report each; yields it when its conversation is over, None after a
    batch."""
    report = None
    for batch in batches:
        for conv_id, turn, role, text, live, seen in zip(*(c.to_pylist() for c in batch.columns)):
            if report is None or conv_id != report.conv_id:
                if report is not None:
                    yield report
                report = begin(conv_id)
            if live:
                report.add(turn, role, text, seen)
        yield None
    if report is not None:
        yield report


def repaired_turns(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                   live: Column | None = None) -> DataFrame:
    """``conv_id, place, edit, turn, role, text``: every edit of every conversation in order, with
    the turn as it stands afterwards; ``edit`` is K, R, I or D (the deleted turn, with no place).

    Rows are taken by turn (NULL first), ties by role and text. NULL roles and texts count as one
    space; a role that is none of the template's can only be renamed or deleted; repeated rows are
    duplicates of the first; rows with a NULL id are one conversation; other columns are not read.
    Rows for which ``live`` isn't true are left out. A conversation streams through one task, sorted
    on disk if need be; memory holds the rows that are not decided yet.
    """
    ordered = _in_order(rows, id_col, turn_col, role_col, text_col, live)
    kind = ordered.schema["conv_id"].dataType.simpleString()

    def work(batches):
        out: list[tuple] = []

        def begin(conv_id):
            place = 0

            def take(edit, turn, role, text):
                nonlocal place
                out.append((conv_id, None if edit == "D" else place, edit, turn, role, text))
                place += edit != "D"

            return _Report(conv_id, take)

        id_type = None

        def drained():
            columns = list(zip(*out))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()))],
                                              names=["conv_id", "place", "edit", "turn", "role", "text"])

        def watched():
            nonlocal id_type
            for batch in batches:
                id_type = batch.column(0).type
                yield batch

        for report in _conversations(watched(), begin):
            if report is not None:
                report.figures()
            elif out:
                yield drained()
        if out:
            yield drained()

    return ordered.mapInArrow(work, f"conv_id {kind}, place long, edit string, turn long, role string, text string")


def repair_report(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                  live: Column | None = None) -> DataFrame:
    """One row per conversation: ``conv_id``, its faults (``gaps, blank, duplicate, truncated,
    illegal``), the ``cost`` of its repair, ``audit`` (the edits' initials) and ``repaired_sha256``
    (of the repaired turns' ``role:text``, a line feed between).

    Rows as in :func:`repaired_turns`; one for which ``live`` isn't true only names its conversation,
    which may have no other.
    """
    ordered = _in_order(rows, id_col, turn_col, role_col, text_col, live)
    kind = ordered.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]

    def work(batches):
        def begin(conv_id):
            audit, digest, some = [], hashlib.sha256(), False

            def take(edit, turn, role, text):
                nonlocal some
                audit.append(edit)
                if edit != "D":
                    digest.update(("\n" * some + f"{role}:{text}").encode())
                    some = True

            report = _Report(conv_id, take)
            report.audit, report.digest = audit, digest
            return report

        id_type, out = None, []

        def drained():
            columns = list(zip(*out))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, id_type if k == 0 else pa.string() if k > 6 else pa.int64()) for k, c in enumerate(columns)], names=names)

        def watched():
            nonlocal id_type
            for batch in batches:
                id_type = batch.column(0).type
                yield batch

        for report in _conversations(watched(), begin):
            if report is not None:
                out.append((report.conv_id, *report.figures(), "".join(report.audit), report.digest.hexdigest()))
            elif out:
                yield drained()
        if out:
            yield drained()

    return ordered.mapInArrow(work, f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")
