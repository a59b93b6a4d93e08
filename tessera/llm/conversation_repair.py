"""Repair of conversation structure by generalised LR parsing.

The roles of a conversation are the tokens of a small grammar: an optional
system turn, then pairs of user and assistant turns, or nothing. Every row may
be kept, get another role (rerole) or go (delete), and turns may be put in
(insert), each at a price. All LR stacks that some choice of edits leads to are
held at once as a graph: stacks share their tails, equal stacks are one node,
and a node holds the least (cost, audit) of the ways into it, the audit being
the initials of the edits. A stack whose cost is more than ``SLACK`` above the
best one can never win and goes.

A conversation's rows stream through one task in order; nothing of it is
collected but the rows whose edit is not settled yet, that is, where the
audits of the stacks left still differ.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator
from functools import cache
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import slices

# Grammar (fixed values): C -> empty | L;  L -> H u a | L u a;  H -> s | empty.
# LR states by what the stack's top is: 0 start, 1 s, 2 H, 3 L, 4 u after H, 5 u after L, 6 a after H u, 7 a after L u.
SHIFT = {(0, "s"): 1, (2, "u"): 4, (3, "u"): 5, (4, "a"): 6, (5, "a"): 7}
#: State: symbol made and how many of the stack's states it takes the place of, whatever comes next.
REDUCE = {1: ("H", 1), 6: ("L", 3), 7: ("L", 3)}
#: The same for a state and the token that comes next.
REDUCE_BEFORE = {(0, "u"): ("H", 0)}
GOTO = {(0, "H"): 2, (0, "L"): 3}
ACCEPT = frozenset({0, 3})

#: Price of each edit, and of a truncated row that is not deleted (fixed values).
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: What any stack can do at most dearer than another one with the same rows to come: two inserts, or one and a deletion.
SLACK = 2 * INSERT
NAMES = {"u": "user", "a": "assistant"}
#: Undecided rows past which settled edits are looked for.
LOOK = 16

EDITS = ("conv_id string, step long, edit string, turn long, role_before string, fault string, cost int, role string, text string")


class Node:
    """The top of a stack; stacks with equal tails share them, so that equal stacks are the same node."""

    __slots__ = ("state", "below")

    def __init__(self, state: int, below: Node | None):
        self.state, self.below = state, below


@cache
def push(state: int, below: Node | None) -> Node:
    return Node(state, below)


def _reduce(top: Node, made: tuple[str, int]) -> Node:
    symbol, size = made
    for _ in range(size):
        top = top.below
    return push(GOTO[top.state, symbol], top)


@cache
def step(top: Node, token: str) -> Node | None:
    """The stack after ``token``, all reductions done; None where the grammar does not allow it."""
    while (top.state, token) in REDUCE_BEFORE:
        top = _reduce(top, REDUCE_BEFORE[top.state, token])
    if (top.state, token) not in SHIFT:
        return None
    top = push(SHIFT[top.state, token], top)
    while top.state in REDUCE:
        top = _reduce(top, REDUCE[top.state])
    return top


@cache
def turn_for(top: Node) -> tuple[str, Node] | None:
    """The token that a rerole or an insert gives after this stack: user or assistant, never both."""
    return next(((x, after) for x in NAMES if (after := step(top, x))), None)


START = push(0, None)
Frontier = dict[Node, tuple[int, str]]


def offer(frontier: Frontier, node: Node, way: tuple[int, str]) -> bool:
    if node in frontier and frontier[node] <= way:
        return False
    frontier[node] = way
    return True


def with_inserts(frontier: Frontier) -> Frontier:
    """All stacks that inserted turns lead to as well; those out of reach of the best go.

    Ways of one cost to one stack hold the same rows, and the cost follows from the audit: none is the other's
    beginning, so that the lesser one stays the lesser whatever comes after both.
    """
    limit = min(way[0] for way in frontier.values()) + SLACK
    todo = list(frontier)
    while todo:
        node = todo.pop()
        cost, audit = frontier[node]
        if cost + INSERT <= limit and (made := turn_for(node)) and offer(frontier, made[1], (cost + INSERT, audit + "I")):
            todo.append(made[1])
    return {n: w for n, w in frontier.items() if w[0] <= limit}


def advance(frontier: Frontier, initial: str, fault: str) -> Frontier:
    """The stacks after one more row."""
    out: Frontier = {}
    extra = TRUNCATED if fault == "truncated" else 0
    for node, (cost, audit) in frontier.items():
        offer(out, node, (cost + DELETE, audit + "D"))
        if fault not in ("blank", "duplicate"):
            if after := step(node, initial):
                offer(out, after, (cost + KEEP + extra, audit + "K"))
            if made := turn_for(node):
                offer(out, made[1], (cost + REROLE + extra, audit + "R"))
    return with_inserts(out)


class Parse:
    """One conversation in work: rows go in, settled edits come out."""

    def __init__(self, conv: str | None):
        self.conv, self.steps = conv, 0
        self.rows: deque = deque()  # rows without a settled edit
        self.settled = START  # the stack after all settled edits
        self.frontier = with_inserts({START: (0, "")})

    def row(self, turn: int | None, role: str, text: str, fault: str) -> list[tuple]:
        self.rows.append((turn, role, text, fault))
        self.frontier = advance(self.frontier, role[:1], fault)
        return self.settle(commonprefix([a for _, a in self.frontier.values()])) if len(self.rows) % LOOK == 0 else []

    def end(self) -> list[tuple]:
        self.frontier = {n: w for n, w in self.frontier.items() if n.state in ACCEPT}
        return self.settle(min(self.frontier.values())[1])

    def settle(self, audit: str) -> list[tuple]:
        """Rows of ``EDITS`` for the edits of ``audit``, which all ways left have in common."""
        out = []
        for edit in audit:
            turn, role, text, fault = self.rows.popleft() if edit != "I" else (None, None, "", None)
            cost = {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}[edit] + (TRUNCATED if fault == "truncated" and edit != "D" else 0)
            new = role
            if edit == "K":
                self.settled = step(self.settled, role[:1])
            elif edit != "D":
                token, self.settled = turn_for(self.settled)
                new = NAMES[token]
            out.append((self.conv, self.steps, edit, turn, role, fault, cost, *((None, None) if edit == "D" else (new, text))))
            self.steps += 1
        if audit:
            self.frontier = {n: (c, a[len(audit):]) for n, (c, a) in self.frontier.items()}
        return out


_KINDS = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.string(), pa.string())
_NAMES = ("conv_id", "step", "edit", "turn", "role_before", "fault", "cost", "role", "text")
_FEW = 2000


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def made(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * len(_KINDS), _KINDS)], names=list(_NAMES))

    now, rows = None, []
    for whole in batches:
        for b in slices(whole, "text"):
            for conv, turn, role, text, fault in zip(*(b.column(c).to_pylist() for c in ("conv", "turn", "role", "text", "fault"))):
                if now is None or now.conv != conv:
                    if now:
                        rows += now.end()
                    now = Parse(conv)
                rows += now.row(turn, role, text, fault)
                if len(rows) >= _FEW:
                    yield made(rows)
                    rows = []
    yield made(rows + now.end() if now else rows)


def fault_of(text: Column, repeated: Column) -> Column:
    """A row's first fault: blank, duplicate, truncated, or null."""
    return (F.when(~text.rlike(r"[^\x20\x09-\x0D]"), "blank").when(repeated, "duplicate")
            .when(~text.rlike(r"[.!?][\x20\x09-\x0D]*\z"), "truncated"))


def repair(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The edits that repair each conversation, one row an edit, in order: conv_id (as string), step (from 0), edit
    (K, R, D or I), turn, role_before and fault of the row (null for I), cost, role and text after it (null for D).

    The rows of a conversation are taken by turn, null turns first, then by
    role and text. Null roles and texts are one space. A null conv_id is a conversation of its own.
    Rows whose role and text came before in their conversation are duplicates, so repeated rows go.
    An empty text is blank. An empty table gives an empty result; other columns are left out.
    The result is partitioned by conversation and ordered by (conv_id, step) within a partition.
    """
    text, role = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")) for c in (text_col, role_col))
    rows = df.select(F.col(f"`{conv_col}`").cast("string").alias("conv"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
                     role.alias("role"), text.alias("text")).repartition("conv")
    # both windows and the order need the rows of a conversation in one partition only: one exchange
    order = [F.col("turn").asc_nulls_first(), "role", "text"]
    repeated = F.row_number().over(Window.partitionBy("conv", "role", "text").orderBy(F.col("turn").asc_nulls_first())) > 1
    rows = rows.withColumn("fault", fault_of(F.col("text"), repeated))
    rows = rows.sortWithinPartitions(F.col("conv").asc_nulls_first(), *order, F.coalesce(F.col("fault") == "duplicate", F.lit(False)))
    return rows.mapInArrow(_parse, EDITS)


SUMMARY = ("conv_id string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
           "repaired_sha256 string")


def _summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = (pa.string(), *(pa.int64(),) * 6, pa.string(), pa.string())
    names = [c.split()[0] for c in SUMMARY.split(", ")]
    rows: list[tuple] = []

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * len(kinds), kinds)], names=names)
        rows.clear()
        return out

    def close() -> None:
        gaps = 0 if first is None else last - first + 1 - turns
        rows.append((now, gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, "".join(audit), digest.hexdigest()))

    now, begun = None, False
    for b in batches:
        for conv, at, edit, turn, before, fault, price, role, text in zip(*(c.to_pylist() for c in b.columns)):
            if at == 0:
                if begun:
                    close()
                    if len(rows) >= _FEW:
                        yield flush()
                now, begun, audit, cost, illegal, turns, first, last = conv, True, [], 0, 0, 0, None, None
                faults, digest, line, ahead = dict.fromkeys(("blank", "duplicate", "truncated"), 0), hashlib.sha256(), False, None
            audit.append(edit)
            cost += price
            if edit != "I":
                if fault:
                    faults[fault] += 1
                illegal += ahead is not None and ahead + before[:1] not in ("su", "ua", "au")
                ahead = before[:1]
                if turn is not None and turn != last:
                    turns, last = turns + 1, turn
                    first = turn if first is None else first
            if edit != "D":
                digest.update(f"{chr(10) * line}{role}:{text}".encode())
                line = True
    if begun:
        close()
    yield flush()


def summaries(edits: DataFrame) -> DataFrame:
    """A row for each conversation of ``repair``'s result: gaps of its turns, counts of faults, adjacent roles that the
    grammar never has side by side, cost, audit, and the digest of the repaired ``role:text`` lines."""
    return edits.mapInArrow(_summarise, SUMMARY)


def damage(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id (as string), turn, role, text after damage that a row's key decides: crc32(``conv_id:turn``) % 20.

    0 drops the row, 1 empties its text, 2 removes ``.!?``, 3 repeats it, 4 makes it the user's. Nulls are one space.
    """
    space = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space(conv_col), F.lit(":"), space(turn_col)).cast("binary")) % 20
    rows = df.select(F.col(f"`{conv_col}`").cast("string").alias("conv_id"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
                     space(role_col).alias("role"), space(text_col).alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                       F.explode(times).alias("copy")).drop("copy")
