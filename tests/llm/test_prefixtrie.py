"""The prefix trie against one held in a dictionary."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ridelake.llm import prefixtrie
from ridelake.llm.queries import QUERIES
from tests.llm import brute

FIELDS = "conv_id long, turn long, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def by_turn(rows):
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(role, text) for *_, role, text in sorted(turns)] for c, turns in own.items()}


def lent(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return out


def plain_trie(members):
    """Rows of all nodes from {conv_id: turns}."""
    through, ends = defaultdict(list), defaultdict(list)
    for c in sorted(members):
        path = tuple(members[c])
        ends[path].append(c)
        for d in range(len(path) + 1):
            through[path[:d]].append(c)
    below = defaultdict(list)
    children = defaultdict(int)
    for node in through:
        for d in range(len(node) + 1):
            below[node[:d]].append(node)
        if node:
            children[node[:-1]] += 1
    rows = []
    for node, of in through.items():
        saved = sum((len(through[x]) - 1) * len(x[-1][1]) for x in below[node] if x)
        leaves = sum(not children[x] for x in below[node])
        parent = through[node[:-1]][0] if node else None
        done = brute.sha(",".join(map(str, ends[node])))
        rows.append((of[0], len(node), parent, len(of), children[node], leaves, saved, done))
    return sorted(rows, key=repr)


def table(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def conversations(spark, rows):
    clashing = {c: F.lit(c) for c in ("place", "token", "path", "part", "n", "least", "key", "from", "lent")}
    return spark.createDataFrame(rows, FIELDS).withColumns(clashing)


@pytest.mark.parametrize("shard_turns", [1, 5, 40, prefixtrie.SHARD_TURNS])
def test_nodes_match_a_plain_trie_whatever_the_shards(spark, shard_turns):
    random.seed(shard_turns)
    rows = []
    for c in range(0, 700):
        common = random.choice([0, 0, 1, 3, 8])
        turns = [("user", "hello")] * min(1, common) + [("assistant", f"t{k}") for k in range(common)]
        turns += [(random.choice("ua"), random.choice(["x", "yy", "é\U0001f600"])) for _ in range(random.randrange(4))]
        rows += [(c, k, *turn) for k, turn in enumerate(turns or [("user", "only")])]
    found = table(prefixtrie.lent_trie(conversations(spark, rows), shard_turns=shard_turns))
    assert found == plain_trie(lent(by_turn(rows)))


def test_stored_conversations(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select(*FIELDS.replace("long", "").replace("string", "").replace(" ", "").split(",")).collect()]
    df = QUERIES["op13_prefix_trie"](spark, folder)
    assert set(df.columns) == set(COLUMNS) and all(t == "bigint" for c, t in df.dtypes if c != "ends_sha256")
    assert table(df) == plain_trie(lent(by_turn(rows)))


def test_defined_cases(spark):
    long = "ab " * 200_000
    rows = [
        (None, 0, "user", "nobody's"), (1, None, None, None), (1, 0, "", ""), (1, 0, "", ""), (2, 5, "user", long),
        (2, 5, "user", long), (200, 1, "user", "a"), (200, 2, "assistant", "b"), (203, 1, "system", "own"), (205, 7, "user", None),
        (-5, 0, "user", "below zero"), (207, 1, "user", "tied"), (207, 1, "assistant", "tied"), (207, 1, "user", "a"),
    ]
    assert table(prefixtrie.lent_trie(conversations(spark, rows), shard_turns=2)) == plain_trie(
        {c: t for c, t in lent_below_zero(by_turn(rows)).items()}
    )
    assert table(prefixtrie.lent_trie(conversations(spark, rows).where("false"))) == []


def lent_below_zero(own):
    """As `lent`, with the remainder of a negative number taken as SQL does."""
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def test_role_and_text_do_not_run_together(spark):
    rows = [(1, 0, "user", "a"), (101, 0, "use", "ra"), (201, 0, "1:", "x"), (301, 0, "", "1:x")]
    turns = prefixtrie.named_turns(conversations(spark, rows))
    assert turns.select("token").distinct().count() == 4


def test_double_array_holds_its_paths_and_no_other():
    random.seed(7)
    paths = sorted({tuple(random.randbytes(20) if random.random() < 0.3 else bytes([random.randrange(6)]) * 20 for _ in range(random.randrange(7))) for _ in range(500)})
    trie = prefixtrie.DoubleArray([list(p) for p in paths])
    nodes = {p[:d] for p in paths for d in range(len(p) + 1)}
    assert len(trie.order) == len(nodes) == len({trie.walk(list(p))[-1] for p in nodes})
    assert all(len(trie.walk(list(p))) == len(p) + 1 for p in paths)
    assert len(trie.walk([b"?" * 20])) == 1
    taken = sum(c != -2 for c in trie.check)
    assert taken == len(nodes) and len(trie.check) < 4 * len(nodes)
