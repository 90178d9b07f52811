"""Repairing the order of roles in conversations, by generalised LR parsing with weighted edits.

Repaired roles are an optional system turn and then pairs of a user's and an assistant's turn, or nothing
at all::

    C -> (empty) | H D        H -> (empty) | s        D -> P | D P        P -> u a

An LR parser reads a conversation turn by turn. Each turn may be kept, given another role or deleted, and
turns without text may be inserted before it: every choice is followed at once. The stacks form a graph:
a stack is its top state and the stack below, which others share, and stacks whose tops are equal are one.
It holds the least (cost, audit) of the ways that lead to it, the audit being the initials of the edits.
Two audits of one stack after the same turns cannot be of equal cost with one a beginning of the other,
since the longer one has more inserts; so the lesser of the two stays the lesser whatever follows. A stack that costs
over ``APART`` more than the cheapest can never win: by that much any stack can do what another does.

A conversation is a sequence, and its digest is one of ordered bytes, so its turns pass through one task,
sorted and one at a time. They are not collected: where all stacks agree about a turn it is given out and
dropped, so what is held are the turns that they disagree on. Which turns repeat earlier ones is found before that,
among turns that have role and text in common.

Defined results: null roles and texts are one space. Turns are taken by number, nulls first, and those of
one number by role and text. A role's initial is its first character; only s, u and a can be kept. Null
ids are one conversation. A conversation without turns has zeros, an empty audit and the digest of nothing.
An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Costs of the edits, and the roles that can be given.
RETRUNCATED = 3
REROLE = 3
DELETE = 4
INSERT = 3
ROLES = {"u": "user", "a": "assistant"}
KEPT_PAIRS = ("su", "ua", "au")
BLANKS = " \t\n\x0b\f\r"
ENDS = ".!?"

# From an empty stack: delete a system turn that another keeps, and insert a pair.
APART = DELETE + 2 * INSERT
SETTLE_EVERY = 32
ROWS_OUT = 2000

# The parser's table: what a state does when it sees a terminal, and where it goes after a reduction.
SHIFT = {(0, "s"): 1, (2, "u"): 3, (3, "a"): 6, (4, "u"): 3}
REDUCE = {
    (0, "u"): ("H", 0), (1, "u"): ("H", 1), (5, "u"): ("D", 1), (6, "u"): ("P", 2), (7, "u"): ("D", 2),
    (0, "$"): ("C", 0), (4, "$"): ("C", 2), (5, "$"): ("D", 1), (6, "$"): ("P", 2), (7, "$"): ("D", 2),
}
GOTO = {(0, "H"): 2, (2, "D"): 4, (2, "P"): 5, (4, "P"): 7, (0, "C"): 8}
ACCEPT = 8

SUMMARY = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string"
)
TURNS = "conv_id long, place long, role string, text string"


class Stack:
    """A stack of parser states: its top, and the stack below. Equal stacks are the same object."""

    __slots__ = ("state", "below", "above", "moves")

    def __init__(self, state: int, below: Stack | None) -> None:
        self.state, self.below = state, below
        self.above: dict[int, Stack] = {}
        self.moves: dict[str, Stack | None] = {}

    def push(self, state: int) -> Stack:
        if state not in self.above:
            self.above[state] = Stack(state, self)
        return self.above[state]

    def read(self, terminal: str) -> Stack | None:
        """The stack after a terminal: reductions that it calls for, then the shift."""
        if terminal not in self.moves:
            at: Stack | None = self
            while (at.state, terminal) in REDUCE:
                left, length = REDUCE[at.state, terminal]
                for _ in range(length):
                    at = at.below
                at = at.push(GOTO[at.state, left])
            if terminal != "$":
                to = SHIFT.get((at.state, terminal))
                at = at.push(to) if to is not None else None
            self.moves[terminal] = at
        return self.moves[terminal]

    def accepts(self) -> bool:
        end = self.read("$")
        return end is not None and end.state == ACCEPT


Tops = dict[Stack, tuple[int, str]]


def offer(tops: Tops, stack: Stack | None, value: tuple[int, str]) -> bool:
    """Merge a way into the top it leads to; true if it is the least one so far."""
    if stack is None or (stack in tops and tops[stack] <= value):
        return False
    tops[stack] = value
    return True


def inserted(tops: Tops) -> Tops:
    """The tops after any number of inserts."""
    out, open_ = dict(tops), list(tops)
    while open_:
        stack = open_.pop()
        cost, audit = out[stack]
        for terminal in ROLES:
            to = stack.read(terminal)
            if offer(out, to, (cost + INSERT, audit + "I")):
                open_.append(to)
    return out


def after_turn(tops: Tops, initial: str, must_go: bool, truncated: bool) -> Tops:
    """The tops after one more turn is kept, given a role, or deleted."""
    out: Tops = {}
    more = RETRUNCATED if truncated else 0
    for stack, (cost, audit) in inserted(tops).items():
        offer(out, stack, (cost + DELETE, audit + "D"))
        if must_go:
            continue
        if initial in ("s", "u", "a"):
            offer(out, stack.read(initial), (cost + more, audit + "K"))
        for terminal in ROLES:
            offer(out, stack.read(terminal), (cost + REROLE + more, audit + "R"))
    least = min(out.values())[0]
    return {s: v for s, v in out.items() if v[0] <= least + APART}


ROOT = Stack(0, None)


class Conversation:
    """The turns of one conversation, in order; ``give`` gets the repaired ones."""

    def __init__(self, give: Callable[[str, str], None]) -> None:
        self.give = give
        self.tops: Tops = {ROOT: (0, "")}
        self.waiting: list[tuple[str, str]] = []
        self.audit: list[str] = []
        self.turns_given = 0
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.low = self.high = self.last_turn = None
        self.distinct = 0
        self.initial: str | None = None

    def add(self, turn: int | None, role: str, text: str, seen: bool) -> None:
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.distinct += turn != self.last_turn
            self.high = self.last_turn = turn
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in KEPT_PAIRS:
            self.counts["illegal"] += 1
        self.initial = initial
        body = text.rstrip(BLANKS)
        fault = "blank" if not body else "duplicate" if seen else "truncated" if body[-1] not in ENDS else None
        if fault:
            self.counts[fault] += 1
        self.tops = after_turn(self.tops, initial, fault in ("blank", "duplicate"), fault == "truncated")
        self.waiting.append((role, text))
        if len(self.waiting) % SETTLE_EVERY == 0:
            self.settle(os.path.commonprefix([audit for _, audit in self.tops.values()]))

    def settle(self, edits: str) -> None:
        """Carry out edits that no stack disagrees about."""
        if not edits:
            return
        self.audit.append(edits)
        self.tops = {s: (cost, audit[len(edits) :]) for s, (cost, audit) in self.tops.items()}
        used = 0
        for edit in edits:
            if edit == "I":
                self.give_turn(None, "")
                continue
            role, text = self.waiting[used]
            used += 1
            if edit != "D":
                self.give_turn(role if edit == "K" else None, text)
        del self.waiting[:used]

    def give_turn(self, role: str | None, text: str) -> None:
        """A turn whose role is its own, or the one that its place calls for."""
        if role is not None and role[:1] == "s":
            self.give(role, text)
            return
        self.give(role if role is not None else list(ROLES.values())[self.turns_given % 2], text)
        self.turns_given += 1

    def finish(self) -> tuple:
        ends = {s: v for s, v in inserted(self.tops).items() if s.accepts()}
        cost, edits = min(ends.values())
        self.settle(edits)
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        return (gaps, *self.counts.values(), cost, "".join(self.audit))


def prepared(turns: DataFrame, names: tuple[str, str, str, str], gone: Column) -> DataFrame:
    """Turns with nulls as spaces, whether they repeat an earlier one, and sorted within conversations.

    Turns that are ``gone`` stay as a mark of their conversation, without role and text.
    """
    conv, turn, role, text = names
    space = F.lit(" ")
    rows = turns.select(
        F.col(conv).cast("long").alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        F.when(~gone, F.coalesce(F.col(role), space)).alias("role"),
        F.when(~gone, F.coalesce(F.col(text), space)).alias("text"),
    )
    same = "PARTITION BY conv_id, role, text ORDER BY turn ASC NULLS FIRST"
    rows = rows.select("*", F.expr(f"row_number() OVER ({same}) > 1").alias("seen"))
    # Of equal turns the one that none is seen before comes first.
    return rows.repartition("conv_id").sortWithinPartitions(
        "conv_id", F.col("turn").asc_nulls_first(), "role", "text", "seen"
    )


def conversations(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of sorted batches: whether a conversation begins, and the row."""
    last, first = None, True
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            yield first or row[0] != last, row
            last, first = row[0], False


def batch_of(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string()}
    fields = [f.split() for f in schema.split(", ")]
    columns = zip(*rows) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields)], names=[n for n, _ in fields]
    )


def summaries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each conversation."""
    out: list[tuple] = []
    conv_id, talk, digest, lines = None, None, None, 0

    def give(role: str, text: str) -> None:
        nonlocal lines
        digest.update(("\n" * (lines > 0) + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        lines += 1

    def close() -> None:
        out.append((conv_id, *talk.finish(), digest.hexdigest()))

    for begins, (conv, turn, role, text, seen) in conversations(batches):
        if begins:
            if talk is not None:
                close()
            conv_id, talk, digest, lines = conv, Conversation(give), hashlib.sha256(), 0
        if role is not None:
            talk.add(turn, role, text, seen)
        if len(out) >= ROWS_OUT:
            yield batch_of(out, SUMMARY)
            out.clear()
    if talk is not None:
        close()
    yield batch_of(out, SUMMARY)


def repaired_turns(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each turn of the repaired conversations."""
    out: list[tuple] = []
    conv_id, talk, place = None, None, 0

    def give(role: str, text: str) -> None:
        nonlocal place
        out.append((conv_id, place, role, text))
        place += 1

    for begins, (conv, turn, role, text, seen) in conversations(batches):
        if begins:
            if talk is not None:
                talk.finish()
            conv_id, talk, place = conv, Conversation(give), 0
        if role is not None:
            talk.add(turn, role, text, seen)
        if len(out) >= ROWS_OUT:
            yield batch_of(out, TURNS)
            out.clear()
    if talk is not None:
        talk.finish()
    yield batch_of(out, TURNS)


NAMES = ("conv_id", "turn", "role", "text")


def repair(turns: DataFrame, names: tuple[str, str, str, str] = NAMES, gone: Column | None = None) -> DataFrame:
    """One row for each conversation: faults, the cheapest repair, and the digest of what it gives."""
    none = F.lit(False) if gone is None else gone
    return prepared(turns, names, none).mapInArrow(summaries, SUMMARY)


def repaired(turns: DataFrame, names: tuple[str, str, str, str] = NAMES) -> DataFrame:
    """The repaired conversations: ``conv_id, place, role, text``, places counted from 0."""
    return prepared(turns, names, F.lit(False)).mapInArrow(repaired_turns, TURNS)


def damaged(turns: DataFrame) -> DataFrame:
    """Turns with faults put in by a hash of conversation and number; ``gone`` marks those taken out."""
    space = F.lit(" ")

    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), space)

    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"),
        kind.alias("kind"),
    )
    text = F.when(F.col("kind") == 1, F.lit("")).when(
        F.col("kind") == 2, F.regexp_replace("text", "[.!?]++", "")
    )
    twice = F.when(F.col("kind") == 3, F.array_repeat(F.lit(0), 2)).otherwise(F.array(F.lit(0)))
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.coalesce(text, F.col("text")).alias("text"),
        (F.col("kind") == 0).alias("gone"),
        F.explode(twice).alias("copy"),
    ).drop("copy")


def repair_damaged(turns: DataFrame) -> DataFrame:
    """Damage conversations, then repair them."""
    return repair(damaged(turns), gone=F.col("gone"))
