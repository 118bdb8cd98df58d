"""Conversation structure repair: the cheapest edits that give every conversation a legal order of roles.

Legal are the initials ``(s?(ua)+)?``: nothing, or an optional system turn and
then pairs of user and assistant.  Edits of a row: Keep (0), Rerole to user or
assistant (3), Delete (4; the only one allowed for blank and duplicate rows); Insert
(3) puts an empty user or assistant turn anywhere.  A truncated row that is
not deleted costs 3 more.  Of equally cheap repairs, the one whose initials of edits
(``D I K R``) come first in ASCII wins.

One pass over each conversation's rows, Viterbi over the four states of that
pattern.  A state's survivor is a leaf of a tree of back pointers.  Each node counts the
survivors and children that need it; what nobody needs is cut off, and when the
root is left with one child and no survivor, that edit is common to all survivors
and is given out.  Memory thus holds the unresolved suffix only, which a few legal
turns resolve; a state that another state beats whatever rows follow has no
survivor.  Where costs tie, the whole unresolved suffixes decide: survivors carry
the rank of their suffix.  Two suffixes that end in an edit of the same row
are either equal or differ before their ends, so extending them by equal ranks and by
the inserts and edit that follow keeps the order exact without reading them again.

Spark deals the rows by conversation and sorts them (it spills, if need be); workers read
them as a stream, so a conversation of any length is never held whole.  It
does pass through one task, because a SHA-256 of its text can only be taken in order.
Only the rare conversation that never resolves (say, no role of it is legal)
keeps its rows until its end.

Rows are taken by turn, null turns first, equal turns by role and text.  A role or text
that is null counts as one space; an empty role has no initial and cannot be kept.
Rows of a null conversation id form one conversation.  Repeated rows are duplicates from the
second on.  An empty table gives an empty table.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonality.llm.common import workers_import

KEEP, REROLE, DELETE, INSERT, CUT_SHORT = 0, 3, 4, 3, 3
SPACES = " \t\n\x0b\x0c\r"
#: state -> what an initial leads to (0 nothing yet, 1 after system, 2 after user, 3 after assistant)
STEP = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
#: state -> the role that a rerole or an insert gives there, and where it leads
NEED = (("user", 2), ("user", 2), ("assistant", 3), ("user", 2))
ENDS = (0, 3)
#: (ahead, behind) -> how much more than from ``behind`` the rest can cost from ``ahead``, whatever rows come:
#: bridged by inserts, by deleting the one system turn, or (to end after a system turn) by a pair
GAP = {(3, 0): 4, (2, 0): 7, (1, 0): 6, (0, 1): 0, (2, 1): 3, (3, 1): 0,
       (0, 2): 3, (1, 2): 3, (3, 2): 3, (0, 3): 0, (1, 3): 6, (2, 3): 3}
LEGAL_PAIRS = ("su", "ua", "au")
BATCH_ROWS, BATCH_CHARS = 4096, 8 << 20

Row = tuple  # (turn, role, text)


class Node:
    """An edit in the tree of back pointers."""
    __slots__ = ("parent", "edit", "row", "state", "kids", "held")

    def __init__(self, parent: Node | None, edit: str, row: Row | None, state: int):
        self.parent, self.edit, self.row, self.state = parent, edit, row, state
        self.kids: list[Node] = []
        self.held = 0
        if parent is not None:
            parent.kids.append(self)


class Survivors:
    """The best way into each state, and the tree that they share."""

    def __init__(self):
        self.root = Node(None, "", None, 0)
        # state -> (cost, rank of the suffix without its trailing inserts, trailing inserts, node)
        self.best = self._inserts({0: (0, 0, 0, self.root)})
        for way in self.best.values():
            way[3].held += 1

    @staticmethod
    def _inserts(best: dict[int, tuple]) -> dict[int, tuple]:
        """Adds what inserts reach, cheapest first; their nodes are made when a later edit needs them.  A survivor that
        another one beats whatever follows is none (say, all rows deleted once a few were kept)."""
        todo, done = dict(best), {}
        while todo:
            state = min(todo, key=lambda s: todo[s][:3])
            cost, rank, tail, node = done[state] = todo.pop(state)
            to = NEED[state][1]
            way = (cost + INSERT, rank, tail + 1, node)
            if to not in done and (to not in todo or way[:3] < todo[to][:3]):
                todo[to] = way
        return {s: way for s, way in done.items()
                if all(t == s or done[t][0] + GAP[t, s] >= way[0] for t in done)}

    @staticmethod
    def _grow(node: Node, inserts: int) -> Node:
        for _ in range(inserts):
            role, to = NEED[node.state]
            node = Node(node, "I", (None, role, ""), to)
        return node

    @staticmethod
    def _cut(node: Node) -> None:
        while node.parent is not None and not node.held and not node.kids:
            above = node.parent
            above.kids.remove(node)
            node.parent = None
            node = above

    def feed(self, row: Row, must_go: bool, truncated: bool) -> Iterator[Node]:
        """Takes a row; yields the edits that are now certain."""
        initial, extra = row[1][:1], CUT_SHORT if truncated else 0
        ways: dict[int, tuple] = {}
        for state, (cost, rank, tail, node) in self.best.items():
            moves = [("D", state, cost + DELETE)]
            if not must_go:
                kept = STEP[state].get(initial)
                if kept is not None:
                    moves.append(("K", kept, cost + KEEP + extra))
                moves.append(("R", NEED[state][1], cost + REROLE + extra))
            for edit, to, total in moves:
                way = (total, rank, "I" * tail + edit, node, tail)
                if to not in ways or way[:3] < ways[to][:3]:
                    ways[to] = way
        ranks = {suffix: i for i, suffix in enumerate(sorted({w[1:3] for w in ways.values()}))}
        old = [w[3] for w in self.best.values()]
        new = {}
        for to, (total, rank, suffix, node, tail) in ways.items():
            grown = self._grow(node, tail)
            edit = suffix[-1]
            told = (row[0], NEED[grown.state][0], row[2]) if edit == "R" else row
            new[to] = (total, ranks[rank, suffix], 0, Node(grown, edit, told, to))
        self.best = self._inserts(new)
        for way in self.best.values():
            way[3].held += 1
        for node in old:
            node.held -= 1
        for node in [*old, *[w[3] for w in new.values()]]:
            self._cut(node)
        return self._certain()

    def _certain(self) -> Iterator[Node]:
        while not self.root.held and len(self.root.kids) == 1:
            self.root = self.root.kids[0]
            self.root.parent = None
            yield self.root

    def finish(self) -> tuple[int, list[Node]]:
        """The cost of the cheapest repair and the edits that were not given out yet."""
        cost, _, tail, node = min((self.best[s] for s in ENDS if s in self.best), key=lambda w: w[:3])
        node, path = self._grow(node, tail), []
        while node is not self.root:
            path.append(node)
            node = node.parent
        return cost, path[::-1]


@dataclass
class Report:
    """What a pass over one conversation counted."""
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    turns: int = 0
    first: int | None = None
    last: int | None = None
    cost: int = 0
    unresolved: int = field(default=0, repr=False)    # the most nodes that waited, for tests

    @property
    def gaps(self) -> int:
        return 0 if self.first is None else self.last - self.first + 1 - self.turns


def edits(rows: Iterable[tuple], report: Report) -> Iterator[Node]:
    """Edits of one conversation in order; ``rows`` are ``(turn, role, text, seen before)`` by turn."""
    ways, before, waiting = Survivors(), None, 0
    for turn, role, text, again in rows:
        if turn is not None and turn != report.last:
            report.first = turn if report.first is None else report.first
            report.last, report.turns = turn, report.turns + 1
        said = text.rstrip(SPACES)
        blank, truncated = not said, said[-1:] not in (".", "!", "?")
        if blank:
            report.blank += 1
        elif again:
            report.duplicate += 1
        elif truncated:
            report.truncated += 1
        if before is not None and before + role[:1] not in LEGAL_PAIRS:
            report.illegal += 1
        before = role[:1]
        waiting += 1
        for node in ways.feed((turn, role, text), blank or again, truncated):
            waiting -= node.edit != "I"
            yield node
        report.unresolved = max(report.unresolved, waiting)
    report.cost, rest = ways.finish()
    yield from rest


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows with faults by ``crc32(conv:turn) % 20``: 0 drops (``present`` false), 1 empties, 2 cuts off the ends of
    sentences, 3 repeats, 4 makes the role user.  Nulls count as one space."""
    def plain(c: str) -> Column:
        return F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))

    kind = F.crc32(F.encode(F.concat(plain(conv), F.lit(":"), plain(turn)), "UTF-8")) % 20
    faulty = rows.select(
        F.col(f"`{conv}`").alias(conv), F.col(f"`{turn}`").alias(turn), kind.alias("kind"), plain(role).alias("r"),
        plain(text).alias("t"))
    return faulty.select(
        conv, turn, F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("r")).alias("role"),
        F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("t", "[.!?]", ""))
        .otherwise(F.col("t")).alias("text"),
        (F.col("kind") != 0).alias("present"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")
    ).drop("copy")


def _in_order(rows: DataFrame, conv: str, turn: str, role: str, text: str, present: str | None) -> DataFrame:
    """``(conv, turn, role, text, present, again)`` dealt by conversation and sorted; absent rows only name theirs."""
    here = F.col(f"`{present}`") if present else F.lit(True)

    def plain(c: str) -> Column:
        return F.when(here, F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")))

    base = rows.select(F.col(f"`{conv}`").alias("conv"), F.when(here, F.col(f"`{turn}`").cast("long")).alias("turn"),
                       plain(role).alias("role"), plain(text).alias("text"), F.coalesce(here, F.lit(False)).alias("present"))
    same = Window.partitionBy("conv", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    return (base.repartition(F.col("conv")).withColumn("again", F.row_number().over(same) > 1)
            .sortWithinPartitions(F.col("conv"), F.col("turn").asc_nulls_first(), "role", "text"))


def _stream(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*[b.column(i).to_pylist() for i in range(b.num_columns)], strict=True)


def _conversations(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """``(conv, rows)`` in order; a conversation may run over many batches."""
    for conv, rows in groupby(_stream(batches), key=lambda r: r[0]):
        yield conv, ((r[1], r[2], r[3], r[5]) for r in rows if r[4])


def _batches(rows: Iterable[tuple], schema: pa.Schema, wide: int | None = None) -> Iterator[pa.RecordBatch]:
    """Record batches of a bounded number of rows and of characters in column ``wide``."""
    held, chars = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)],
                                          schema=schema)

    for row in rows:
        held.append(row)
        chars += len(row[wide] or "") if wide is not None else 0
        if len(held) >= BATCH_ROWS or chars >= BATCH_CHARS:
            yield batch()
            held, chars = [], 0
    if held:
        yield batch()


def _arrow_type(kind: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           present: str | None = None) -> DataFrame:
    """Every edit in order: ``(conv, step, edit, turn, role, text)``; the rows but ``edit = 'D'`` are the repaired
    conversation.  ``present`` may name a boolean column; rows where it is false are taken as missing."""
    workers_import(rows.sparkSession)
    kind = dict(rows.dtypes)[conv]
    schema = pa.schema([("conv", _arrow_type(kind)), ("step", pa.int64()), ("edit", pa.string()), ("turn", pa.int64()),
                        ("role", pa.string()), ("text", pa.string())])

    def run(batches):
        told = ((c, i, node.edit, *node.row) for c, turns in _conversations(batches)
                for i, node in enumerate(edits(turns, Report())))
        yield from _batches(told, schema, 5)

    return _in_order(rows, conv, turn, role, text, present).mapInArrow(
        run, f"conv {kind}, step long, edit string, turn long, role string, text string").withColumnRenamed("conv", conv)


def audit(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
          present: str | None = None) -> DataFrame:
    """One row per conversation: its faults, the repair's cost, the initials of its edits and the SHA-256 of the
    repaired rows (``role:text``, joined by newlines), taken from the same stream of edits as ``repair``."""
    workers_import(rows.sparkSession)
    kind = dict(rows.dtypes)[conv]
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    schema = pa.schema([("conv", _arrow_type(kind)), *[(c, pa.int64()) for c in counts], ("audit", pa.string()),
                        ("repaired_sha256", pa.string())])

    def digest(conv_id, turns):
        report, initials, sha, first = Report(), [], hashlib.sha256(), True
        for node in edits(turns, report):
            initials.append(node.edit)
            if node.edit != "D":
                sha.update((("" if first else "\n") + f"{node.row[1]}:{node.row[2]}").encode())
                first = False
        return (conv_id, *[getattr(report, c) for c in counts], "".join(initials), sha.hexdigest())

    def run(batches):
        yield from _batches((digest(c, turns) for c, turns in _conversations(batches)), schema, 7)

    longs = ", ".join(f"{c} long" for c in counts)
    return _in_order(rows, conv, turn, role, text, present).mapInArrow(
        run, f"conv {kind}, {longs}, audit string, repaired_sha256 string").withColumnRenamed("conv", conv)
