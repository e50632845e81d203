"""Prefix trie of conversations: nodes shared by conversations that begin alike, in double arrays.

A turn is a token of 20 bytes: the MD5 of its role and text, and its text's length. A conversation
is the path of its tokens, so the byte order of paths keeps conversations with a common beginning
side by side. Equal paths become one row (members counted, least member, a hash of all of
them) before anything else; the distinct paths are range-partitioned by their bytes and each
partition is cut into shards of about ``SHARD_TURNS`` turns. A shard gives the tokens it has dense
ids, packs its trie into BASE and CHECK arrays and walks every path through them.

Only nodes on the first or last path of a shard can be in another one too. Every shard is shown
the path before and the path after it, so it knows which nodes these are, which nodes it is the
first to see and which ends are leaves. All it reports is then additive, and the shared upper
nodes of all shards are summed by Spark. A popular first turn is spread over many shards, a popular
conversation is one path; the members that end at a node pass through a task in order, never held.

Defined cases: rows with a null conv_id belong to no conversation and are left out; null role or text
is empty; turns go by turn (nulls first), then role, then text; repeated rows are turns of their own; a
conversation without turns is a member of the root only; very long texts count as their hash and
length; an empty table has no node. A conversation is held as 20 bytes per turn. Columns other than
conv_id, turn, role and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridelake.llm.steps import Scratch

NAME_BYTES, SIZE_BYTES = 16, 4
TOKEN_BYTES = NAME_BYTES + SIZE_BYTES
SHARD_TURNS = 1 << 16
#: So many free slots are tried for the children of a node before they go to the end of the arrays.
TRIES = 64

ROOT = hashlib.md5(b"").digest()
NOBODY = hashlib.sha256(b"").hexdigest()


@dataclass(frozen=True)
class Lending:
    """Which conversation lends its first turns to which, and how many at most (exclusive)."""

    block: int = 100
    most: int = 6


def named_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 1) and token (hex) of every turn."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    read = conversations.where(F.col("conv_id").isNotNull()).select("conv_id", "turn", role.alias("role"), text.alias("text"))
    name = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"))
    size = F.lpad(F.lower(F.hex(F.length("text"))), 2 * SIZE_BYTES, "0")
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    return read.select("conv_id", place.alias("place"), F.concat(name, size).alias("token"))


def paths(turns: DataFrame) -> DataFrame:
    """conv_id and path (the bytes of its tokens) from rows of conv_id, place and token; a null token is no turn."""
    step = F.when(F.col("token").isNotNull(), F.struct("place", "token"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(step)), lambda s: s["token"]), "")
    return turns.groupBy("conv_id").agg(F.unhex(joined).alias("path"))


def lent_beginnings(turns: DataFrame, lending: Lending = Lending()) -> DataFrame:
    """Turns of every conversation rebuilt: the first turns of the conversation its block begins with, then its own after as many.

    Conversations left without turns keep a row with a null token.
    """
    lent = F.crc32(F.col("conv_id").cast("string").cast("binary")) % lending.most
    own = turns.select(
        "conv_id", F.col("place").cast("long").alias("place"), F.when(F.col("place") > lent, F.col("token")).alias("token")
    )
    first = turns.where("place = 1")
    takers = first.select("conv_id", (F.col("conv_id") - F.col("conv_id") % lending.block).alias("from"), lent.alias("lent"))
    lenders = turns.where((F.col("conv_id") % lending.block == 0) & (F.col("place") < lending.most))
    lenders = lenders.select(F.col("conv_id").alias("from"), "place", F.col("token").alias("theirs"))
    borrowed = takers.join(lenders, "from").where("place <= lent")  # up to `most` turns for each taker
    before = (F.col("place") - lending.most).cast("long").alias("place")
    return own.unionByName(borrowed.select("conv_id", before, F.col("theirs").alias("token")))


def grouped(members: DataFrame) -> DataFrame:
    """One row per distinct path: path, n (its members), least and ends (a hash of all members in order).

    Members of a path pass one after the other, so a path that very many share costs no memory.
    """
    hashed = members.select("conv_id", *(F.xxhash64(F.lit(k), "path").alias(f"p{k}") for k in (1, 2)))
    ordered = hashed.repartition("p1", "p2").sortWithinPartitions("p1", "p2", "conv_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, n, least, ids = None, 0, None, None
        for batch in batches:
            done: list[tuple] = []
            for conv_id, *path in zip(*(c.to_pylist() for c in batch.columns)):
                if path != open_:
                    if open_ is not None:
                        done.append((n, least, ids.hexdigest()))
                    open_, n, least, ids = path, 0, conv_id, hashlib.sha256()
                ids.update(b"%d" % conv_id if n == 0 else b",%d" % conv_id)
                n += 1
            yield groups(done)
        if open_ is not None:
            yield groups([(n, least, ids.hexdigest())])

    def groups(done: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*done)) or [(), (), ()]
        kinds = (pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["n", "least", "ends"])

    counted = ordered.mapInArrow(run, "n long, least long, ends string")
    return counted.join(members.withColumnRenamed("conv_id", "least"), "least").select("path", "n", "least", "ends")


class DoubleArray:
    """A trie over sorted token paths: from state s, token id c leads to BASE[s] + c if CHECK there is s.

    States are made breadth first (``order``); a state's children share one base, which is the
    first one tried whose slots are all free.
    """

    def __init__(self, sorted_paths: list[list[bytes]]):
        self.ids: dict[bytes, int] = {}
        self.base, self.check = [0], [-1]  # slot 0 is the root
        self.order, self.token = [0], {0: b""}
        self._free = 1
        level = [(0, 0, len(sorted_paths))]
        depth = 0
        while level:
            below = []
            for state, low, high in level:
                below += self._children(state, sorted_paths, low, high, depth)
            level, depth = below, depth + 1

    def _children(self, state: int, of: list[list[bytes]], low: int, high: int, depth: int) -> list[tuple[int, int, int]]:
        groups: list[list] = []
        for k in range(low, high):
            if len(of[k]) > depth:
                token = of[k][depth]
                if groups and groups[-1][0] == token:
                    groups[-1][2] = k + 1
                else:
                    groups.append([token, k, k + 1])
        if not groups:
            return []
        codes = [self.ids.setdefault(token, len(self.ids)) for token, _, _ in groups]
        base = self.base[state] = self._fit(codes)
        made = []
        for code, (token, begin, end) in zip(codes, groups):
            slot = base + code
            self._reach(slot)
            self.check[slot] = state
            self.token[slot] = token
            self.order.append(slot)
            made.append((slot, begin, end))
        return made

    def _is_free(self, slot: int) -> bool:
        return slot >= len(self.check) or self.check[slot] == -2

    def _reach(self, slot: int) -> None:
        more = slot + 1 - len(self.check)
        if more > 0:
            self.base.extend([0] * more)
            self.check.extend([-2] * more)

    def _fit(self, codes: list[int]) -> int:
        least = min(codes)
        while not self._is_free(self._free):
            self._free += 1
        slot = self._free
        for _ in range(TRIES):
            if all(self._is_free(slot - least + code) for code in codes):
                return slot - least
            slot += 1
            while not self._is_free(slot):
                slot += 1
        return len(self.check) - least

    def walk(self, path: list[bytes]) -> list[int]:
        """The states a path goes through, the root first; it ends where no move is."""
        state, states = 0, [0]
        for token in path:
            to = self.base[state] + self.ids[token] if token in self.ids else 0
            if not 0 < to < len(self.check) or self.check[to] != state:
                break
            state = to
            states.append(state)
        return states


def _tokens(path: bytes) -> list[bytes]:
    return [path[k : k + TOKEN_BYTES] for k in range(0, len(path), TOKEN_BYTES)]


def _common(a: bytes, b: bytes) -> int:
    """Turns that two paths have in common from the start."""
    low, high = 0, min(len(a), len(b)) // TOKEN_BYTES
    while low < high:
        middle = (low + high + 1) // 2
        if a[: middle * TOKEN_BYTES] == b[: middle * TOKEN_BYTES]:
            low = middle
        else:
            high = middle - 1
    return low


_NODE = pa.schema(
    [
        ("part", pa.int64()), ("number", pa.int64()), ("key", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()),
        ("least", pa.int64()), ("parent_least", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
        ("n_leaves", pa.int64()), ("saved", pa.int64()), ("ends", pa.string()), ("shared", pa.bool_()), ("under_shared", pa.bool_()),
    ]
)
_NODE_DDL = (
    "part long, number long, key binary, parent binary, depth long, least long, parent_least long, n_convs long, "
    "n_children long, n_leaves long, saved long, ends string, shared boolean, under_shared boolean"
)


def shard_nodes(rows: list[tuple[bytes, int, int, str]], before: bytes | None, after: bytes | None) -> list[dict]:
    """The nodes of one shard: of sorted distinct paths (path, n, least, ends), next to the paths before and after them.

    Counts are this shard's share: a node counts as its parent's child, and its text as once
    paid for, in the shard that sees it first. ``shared`` nodes are in a shard beside this one too.
    """
    split = [_tokens(path) for path, *_ in rows]
    trie = DoubleArray(split)
    slots = len(trie.check)
    n, least, depth = [0] * slots, [None] * slots, [0] * slots
    leaves, saved, children = [0] * slots, [0] * slots, [0] * slots
    ends: dict[int, str] = {}
    shared, seen = set(), set()
    last = len(rows) - 1
    for k, ((path, count, first, ids), tokens) in enumerate(zip(rows, split)):
        states = trie.walk(tokens)
        for state in states:
            n[state] += count
            if least[state] is None or first < least[state]:
                least[state] = first
        ends[states[-1]] = ids
        following = rows[k + 1][0] if k < last else after
        if following is None or not following.startswith(path):
            leaves[states[-1]] = 1
        if k == 0 and before is not None:
            seen.update(states[: _common(before, path) + 1])
            shared |= seen
        if k == last and after is not None:
            shared.update(states[: _common(path, after) + 1])
    keys = {0: ROOT}
    for state in trie.order[1:]:
        parent = trie.check[state]
        keys[state] = hashlib.md5(keys[parent] + trie.token[state]).digest()
        depth[state] = depth[parent] + 1
        size = int.from_bytes(trie.token[state][NAME_BYTES:], "big")
        saved[state] = n[state] * size
        if state not in seen:
            saved[state] -= size
            children[parent] += 1
    for state in reversed(trie.order[1:]):
        parent = trie.check[state]
        leaves[parent] += leaves[state]
        saved[parent] += saved[state]
    out = []
    for state in trie.order:
        parent = trie.check[state] if state else None
        out.append(
            {
                "key": keys[state], "parent": keys.get(parent), "depth": depth[state], "least": least[state],
                "parent_least": None if parent is None else least[parent], "n_convs": n[state],
                "n_children": children[state], "n_leaves": leaves[state], "saved": saved[state],
                "ends": ends.get(state), "shared": state in shared, "under_shared": parent in shared,
            }
        )
    return out


def _shards(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Nodes of the shards of sorted rows (part, path, n, least, ends); a row with n = 0 only shows a neighbour's path."""
    part, number, before, rows, turns = None, 0, None, [], 0

    def closed(after: bytes | None) -> Iterator[pa.RecordBatch]:
        nonlocal number, before, rows, turns
        if rows:
            nodes = shard_nodes(rows, before, after)
            for node in nodes:
                node.update(part=part, number=number)
            yield pa.RecordBatch.from_pylist(nodes, _NODE)
            number, before, rows, turns = number + 1, rows[-1][0], [], 0

    for batch in batches:
        for of, path, n, least, ends in zip(*(c.to_pylist() for c in batch.columns)):
            if of != part:
                yield from closed(None)
                part, number, before = of, 0, None
            if n == 0:
                yield from closed(path)
                before = path
                continue
            if turns >= limit:
                yield from closed(path)
            rows.append((path, n, least, ends))
            turns += len(path) // TOKEN_BYTES + 1
    yield from closed(None)


def prefix_nodes(members: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """Nodes of the trie over members (conv_id, unique, and path).

    Per node: key, conv_id (its least member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256.
    """
    spark = members.sparkSession
    scratch = Scratch(spark, "trie")
    members = scratch.freeze(members, "members")
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spread = grouped(members).repartitionByRange(parts, "path").withColumn("part", F.spark_partition_id().cast("long"))
    spread = scratch.freeze(spread.select("part", "path", "n", "least", "ends"), "paths")
    scratch.drop("members")

    # One row per partition: the paths at its borders, shown to the partition on the other side.
    borders = spread.groupBy("part").agg(F.min("path").alias("first"), F.max("path").alias("last"))
    along = Window.orderBy("part")
    borders = borders.select("part", F.lag("last").over(along).alias("before"), F.lead("first").over(along).alias("after"))
    shown = borders.select("part", F.explode(F.array("before", "after")).alias("path")).where("path IS NOT NULL")
    shown = shown.select(
        "part", "path", F.lit(0).cast("long").alias("n"), F.lit(None).cast("long").alias("least"),
        F.lit(None).cast("string").alias("ends"),
    )
    ordered = spread.unionByName(shown).repartition("part").sortWithinPartitions("part", "path")
    nodes = scratch.freeze(ordered.mapInArrow(lambda batches: _shards(batches, shard_turns), _NODE_DDL), "nodes")
    scratch.drop("paths")

    above = nodes.where("shared")
    merged = above.groupBy("key").agg(
        F.max("parent").alias("parent"), F.max("depth").alias("depth"), F.min("least").alias("least"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")), F.max("ends").alias("ends"),
    )
    merged = scratch.freeze(merged, "merged")
    of_parent = merged.select(F.col("key").alias("parent"), F.col("least").alias("of_parent"))
    upper = merged.join(of_parent, "parent", "left").withColumn("parent_conv_id", F.col("of_parent"))
    # Below a shared node each shard looks up its own copy of the parent, so no key is met by more rows than a shard has.
    copies = above.select("part", "number", F.col("key").alias("parent")).join(of_parent, "parent")
    lower = nodes.where("NOT shared").join(copies, ["part", "number", "parent"], "left")
    lower = lower.withColumn("parent_conv_id", F.when(F.col("under_shared"), F.col("of_parent")).otherwise(F.col("parent_least")))
    shown = (
        "key", F.col("least").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), F.coalesce("ends", F.lit(NOBODY)).alias("ends_sha256"),
    )
    return upper.select(*shown).unionByName(lower.select(*shown))


def lent_trie(conversations: DataFrame, lending: Lending = Lending(), shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The trie of conversations rebuilt with lent beginnings."""
    turns = Scratch(conversations.sparkSession, "trie-turns").freeze(named_turns(conversations), "turns")
    return prefix_nodes(paths(lent_beginnings(turns, lending)), shard_turns)
