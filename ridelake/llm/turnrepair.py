"""Repair of conversation structure by a bidirectional search of the edit lattice.

A repaired conversation is empty or has the roles system? (user assistant)+, by initials. A node
of the lattice is a place between two turns and a state of that pattern; an edge is an edit: keep,
give the role that is due, delete, or insert an empty turn whose role is due. A state has one due
role, so an audit, the edits' initials in order, says all. One heap searches forward from the
start, one backward from the ends; both keep with every node the least audit among the cheapest.
When they have met, all crossings of the same cost are finished and the least joined audit wins.

Rows are sorted by conversation within partitions and stream through Python twice: first as one
letter per turn, which gives faults, cost and audit; then with the audit in front of the turns'
texts, which are written out or hashed one by one. Conversations of more than ``SEGMENT`` turns are
searched a segment at a time, from each state to each state, and what the four paths agree on is
put aside. So a task holds a conversation's audit and never its texts, however long it is.

Defined cases: null role or text is one space, as is a null conv_id or turn where the damage is
drawn; a null conv_id is a conversation of its own; turns go by turn (nulls first), then role,
then text; repeated rows are duplicates; an empty role has no initial and is never kept; very long
texts count as their hash until they are written; a conversation without rows has zeros, an
empty audit and no turn; an empty table gives none. Columns other than conv_id, turn, role and
text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridelake.llm.steps import Scratch

SEGMENT = 128
#: Results of so many short conversations are kept in a worker; the same letters come up often.
REMEMBERED = 1 << 15

BLANKS = " \t\n\x0b\f\r"
ENDINGS = (".", "!", "?")
LEGAL = frozenset(("su", "ua", "au"))

RETYPE, DELETE, INSERT, CUT_SHORT = 2, 3, 2, 1
#: States: nothing yet, after system, after user, after assistant. Where the due role leads, and which it is.
DUE_STATE, DUE_ROLE = (2, 2, 3, 2), ("user", "user", "assistant", "user")
KEPT_STATE = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ENDS = (0, 3)
#: The letter of a turn that must go. Others are s, u, a or o (any other initial), capital if cut short.
MUST_GO = "x"

VERDICT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def sound(conversations: DataFrame) -> DataFrame:
    """Turns as they are: conv_id, turn, role, text and present."""
    filled = (F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text"))
    return conversations.select("conv_id", "turn", *filled, F.lit(True).alias("present"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Turns after a pseudo-random damage; a dropped one stays as a row that is not present."""
    shown = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    drawn = sound(conversations).withColumn("draw", F.crc32(shown.cast("binary")) % 20)
    text = F.when(F.col("draw") == 1, F.lit("")).when(F.col("draw") == 2, F.regexp_replace("text", "[.!?]", ""))
    copies = F.explode(F.when(F.col("draw") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return drawn.select(
        "conv_id",
        "turn",
        F.when(F.col("draw") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        text.otherwise(F.col("text")).alias("text"),
        (F.col("draw") != 0).alias("present"),
        copies.alias("copy"),
    ).drop("copy")


# The lattice


def _onward(letters: str, i: int, state: int) -> Iterator[tuple[tuple[int, int], int, str]]:
    """Edges out of a node: the node they lead to, their cost and their initial."""
    yield (i, DUE_STATE[state]), INSERT, "I"
    if i < len(letters):
        letter = letters[i]
        yield (i + 1, state), DELETE, "D"
        if letter != MUST_GO:
            more = CUT_SHORT if letter.isupper() else 0
            yield (i + 1, DUE_STATE[state]), RETYPE + more, "R"
            if (state, letter.lower()) in KEPT_STATE:
                yield (i + 1, KEPT_STATE[state, letter.lower()]), more, "K"


def _backward(letters: str, i: int, state: int) -> Iterator[tuple[tuple[int, int], int, str]]:
    """Edges into a node, by the node they come from."""
    for origin in range(4):
        for at in (i, i - 1):
            if at >= 0:
                for to, cost, edit in _onward(letters, at, origin):
                    if to == (i, state):
                        yield (at, origin), cost, edit


class _Side:
    """One of the two searches: a heap of nodes by cost and then in the order of its edges without cost."""

    def __init__(self, letters: str, nodes: list[tuple[int, int]], forward: bool):
        self.letters, self.forward = letters, forward
        self.edges = _onward if forward else _backward
        self.label = {node: (0, "") for node in nodes}
        self.settled: set[tuple[int, int]] = set()
        self.heap = [self._entry(0, node) for node in nodes]
        heapify(self.heap)

    def _entry(self, cost: int, node: tuple[int, int]) -> tuple:
        return cost, node[0] if self.forward else -node[0], node

    def joined(self, audit: str, edit: str) -> str:
        return audit + edit if self.forward else edit + audit

    def least(self) -> int | None:
        while self.heap and self.heap[0][2] in self.settled:
            heappop(self.heap)
        return self.heap[0][0] if self.heap else None

    def step(self, other: _Side, best: tuple[int, str] | None) -> tuple[int, str] | None:
        """Settle the next node; the better of ``best`` and the ways that cross from it to the other side."""
        cost, _, node = heappop(self.heap)
        self.settled.add(node)
        audit = self.label[node][1]
        for to, more, edit in self.edges(self.letters, *node):
            label = (cost + more, self.joined(audit, edit))
            if to in other.settled:
                beyond, rest = other.label[to]
                whole = label[1] + rest if self.forward else rest + label[1]
                if best is None or (label[0] + beyond, whole) < best:
                    best = (label[0] + beyond, whole)
            known = self.label.get(to)
            if to not in self.settled and (known is None or label < known):
                self.label[to] = label
                if known is None or label[0] < known[0]:
                    heappush(self.heap, self._entry(label[0], to))
        return best


def cheapest(letters: str, entry: int, ends: tuple[int, ...]) -> tuple[int, str] | None:
    """Least cost, and the least audit of that cost, from state ``entry`` before the turns to one of ``ends`` after them.

    No audit of a node's cheapest ways begins another one, so least parts join to the least whole.
    """
    if not letters and entry in ends:
        return 0, ""
    front, back = _Side(letters, [(0, entry)], True), _Side(letters, [(len(letters), end) for end in ends], False)
    best = front.step(back, None)
    for _ in ends:
        back.least()
        best = back.step(front, best)
    while (a := front.least()) is not None and (b := back.least()) is not None:
        if best is not None and a + b > best[0]:
            break
        best = front.step(back, best) if a <= b else back.step(front, best)
    return best


@lru_cache(REMEMBERED)
def _remembered(letters: str) -> tuple[int, str]:
    return cheapest(letters, 0, ENDS)


class Search:
    """Cost and audit of a conversation whose letters come one by one."""

    def __init__(self, segment: int = SEGMENT):
        self.segment, self.letters = segment, ""
        self.agreed: list[str] = []
        self.ways: dict[int, tuple[int, str]] = {0: (0, "")}  # by state: cost, and audit after what is agreed
        self.begun = False

    def add(self, letter: str) -> None:
        if len(self.letters) == self.segment:
            self._advance()
        self.letters += letter

    def _beyond(self, ends: tuple[int, ...]) -> tuple[int, str] | None:
        found = []
        for entry, (cost, audit) in self.ways.items():
            if (more := cheapest(self.letters, entry, ends)) is not None:
                found.append((cost + more[0], audit + more[1]))
        return min(found, default=None)

    def _advance(self) -> None:
        ways = {end: way for end in range(4) if (way := self._beyond((end,))) is not None}
        common = commonprefix([audit for _, audit in ways.values()])
        self.agreed.append(common)
        self.ways = {end: (cost, audit[len(common) :]) for end, (cost, audit) in ways.items()}
        self.letters, self.begun = "", True

    def result(self) -> tuple[int, str]:
        if not self.begun:
            return _remembered(self.letters) if len(self.letters) <= 32 else cheapest(self.letters, 0, ENDS)
        cost, audit = self._beyond(ENDS)
        return cost, "".join(self.agreed) + audit


# Over rows


def _faults(turns: DataFrame) -> DataFrame:
    """Rows sorted by conversation within partitions, with initial and fault (blank, duplicate, truncated or null)."""
    body = F.rtrim("text", F.lit(BLANKS))
    name = [F.xxhash64(F.lit(k), "role", "text").alias(f"name{k}") for k in (1, 2)]
    named = turns.select("*", *name).repartition("conv_id")
    # Copies are found within the same partitions: equal conv_id are together already.
    copies = Window.partitionBy("conv_id", "name1", "name2", "present").orderBy("turn")
    numbered = named.withColumn("seen", F.row_number().over(copies))
    fault = (
        F.when(body == "", "blank")
        .when(F.col("seen") > 1, "duplicate")
        .when(~F.right(body, F.lit(1)).isin(*ENDINGS), "truncated")
    )
    ordered = numbered.sortWithinPartitions("conv_id", "turn", "role", "text", "seen")
    return ordered.select("conv_id", "turn", "present", F.left("role", F.lit(1)).alias("initial"), fault.alias("fault"))


class _Conversation:
    """Counts of one conversation and the search of its lattice."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.search = conv_id, Search()
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.first = self.last = self.before = None
        self.distinct = 0

    def add(self, turn: int | None, initial: str, fault: str | None) -> None:
        if turn is not None:
            self.first = turn if self.first is None else self.first
            self.distinct += turn != self.last
            self.last = turn
        if fault:
            self.counts[fault] += 1
        if self.before is not None and self.before + initial not in LEGAL:
            self.counts["illegal"] += 1
        self.before = initial
        letter = initial if initial in ("s", "u", "a") else "o"
        self.search.add(MUST_GO if fault in ("blank", "duplicate") else letter.upper() if fault else letter)

    def verdict(self) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.distinct
        return self.conv_id, gaps, *self.counts.values(), *self.search.result()


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


_VERDICT = pa.schema(
    [("conv_id", pa.int64()), *((c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), ("audit", pa.string())]
)
_NEVER = object()


def verdicts(turns: DataFrame) -> DataFrame:
    """One row per conv_id: gaps, blank, duplicate, truncated, illegal, cost and audit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, open_ = None, _NEVER
        for batch in batches:
            done = []
            for conv_id, turn, present, initial, fault in zip(*(c.to_pylist() for c in batch.columns)):
                if open_ is _NEVER or conv_id != open_:
                    if current:
                        done.append(current.verdict())
                    current, open_ = _Conversation(conv_id), conv_id
                if present:
                    current.add(turn, initial, fault)
            yield _batch(done, _VERDICT)
        if current:
            yield _batch([current.verdict()], _VERDICT)

    kinds = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text", "present")
    return _faults(kinds).mapInArrow(run, f"conv_id long, {VERDICT}")


def _with_audits(turns: DataFrame, found: DataFrame) -> DataFrame:
    """Verdicts and turns, sorted so that each conversation's verdict comes before its turns."""
    names = found.columns[1:]
    lead = found.select(
        "conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"),
        *(F.lit(None).cast("string").alias(c) for c in ("role", "text")), *names,
    )
    body = turns.where("present").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.lit(1).alias("kind"), F.col("turn").cast("long").alias("turn"),
        "role", "text", *(F.lit(None).cast(found.schema[c].dataType).alias(c) for c in names),
    )
    both = lead.unionByName(body).repartition("conv_id")
    return both.sortWithinPartitions("conv_id", "kind", "turn", "role", "text").drop("turn")


class _Editor:
    """Applies an audit to the turns it was made for, as they come."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, 0

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            role = DUE_ROLE[self.state]
            self.at, self.state = self.at + 1, DUE_STATE[self.state]
            yield "I", role, ""

    def turn(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """(edit, role, text) of the turns that come out before this one and for it."""
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "R":
            yield edit, DUE_ROLE[self.state], text
            self.state = DUE_STATE[self.state]
        elif edit == "K":
            yield edit, role, text
            self.state = KEPT_STATE[self.state, role[:1]]


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple | None, list[tuple[str, str, str]]]]:
    """Per row of ``_with_audits``: the verdict that begins a conversation, if it does, and the turns that come out."""
    editor = None
    for batch in batches:
        for conv_id, kind, role, text, *verdict in zip(*(c.to_pylist() for c in batch.columns)):
            if kind == 0:
                if editor:
                    yield None, list(editor.inserted())
                editor = _Editor(verdict[-1])
                yield (conv_id, *verdict), []
            else:
                yield None, list(editor.turn(role, text))
    if editor:
        yield None, list(editor.inserted())


_TURN = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
_OUT_BYTES = 1 << 21


def repaired_turns(turns: DataFrame, found: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place (from 0), edit, role and text; ``found`` are the turns' verdicts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size, conv_id, place = [], 0, None, 0
        for verdict, made in _edited(batches):
            if verdict:
                conv_id, place = verdict[0], 0
            for edit, role, text in made:
                rows.append((conv_id, place, edit, role, text))
                place, size = place + 1, size + len(text) + 64
            if size >= _OUT_BYTES:
                yield _batch(rows, _TURN)
                rows, size = [], 0
        yield _batch(rows, _TURN)

    return _with_audits(turns, found).mapInArrow(run, "conv_id long, place long, edit string, role string, text string")


def sealed(turns: DataFrame, found: DataFrame) -> DataFrame:
    """Verdicts with repaired_sha256, a hash of the repaired `role:text` lines, which are not kept."""
    schema = _VERDICT.append(pa.field("repaired_sha256", pa.string()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, verdict, seal, empty = [], None, None, True
        for begun, made in _edited(batches):
            if begun:
                if verdict:
                    rows.append((*verdict, seal.hexdigest()))
                verdict, seal, empty = begun, hashlib.sha256(), True
                if len(rows) >= 4096:
                    yield _batch(rows, schema)
                    rows = []
            for _, role, text in made:
                seal.update(f"{'' if empty else chr(10)}{role}:{text}".encode())
                empty = False
        if verdict:
            rows.append((*verdict, seal.hexdigest()))
        yield _batch(rows, schema)

    return _with_audits(turns, found).mapInArrow(run, f"conv_id long, {VERDICT}, repaired_sha256 string")


def repair(turns: DataFrame) -> DataFrame:
    """One row per conv_id: its verdict and repaired_sha256."""
    found = Scratch(turns.sparkSession, "repair").freeze(verdicts(turns), "verdicts")
    return sealed(turns, found)
