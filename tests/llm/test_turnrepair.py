"""Conversation repair against a plain pass over the whole lattice."""

from __future__ import annotations

import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ridelake.llm import turnrepair
from ridelake.llm.queries import QUERIES
from tests.llm import brute

FIELDS = "conv_id long, turn long, role string, text string"
COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
DUE, DUE_ROLE = {"": "u", "s": "u", "u": "a", "a": "u"}, {"u": "user", "a": "assistant"}
PATTERN = re.compile(r"(s?(ua)+)?")


def plain_search(turns):
    """(cost, audit, repaired turns) of (role, text, fault) turns: all nodes in order, the least (cost, audit) kept."""
    def insert(best):
        for _ in range(3):
            for last, (cost, audit, out) in list(best.items()):
                to = DUE[last]
                way = (cost + 2, audit + "I", [*out, (DUE_ROLE[to], "")])
                if to not in best or way[:2] < best[to][:2]:
                    best[to] = way
        return best

    best = insert({"": (0, "", [])})
    for role, text, fault in turns:
        after = {}

        def offer(last, way):
            if last not in after or way[:2] < after[last][:2]:
                after[last] = way

        for last, (cost, audit, out) in best.items():
            offer(last, (cost + 3, audit + "D", out))
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                offer(DUE[last], (cost + 2 + more, audit + "R", [*out, (DUE_ROLE[DUE[last]], text)]))
                mine = role[:1]
                if mine == DUE[last] or (mine == "s" and last == ""):
                    offer(mine, (cost + more, audit + "K", [*out, (role, text)]))
        best = insert(after)
    return min((best[last] for last in ("", "a") if last in best), key=lambda way: way[:2])


def damage(rows):
    out = defaultdict(list)
    for conv_id, turn, role, text in rows:
        draw = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        row = (turn is not None, turn or 0, "user" if draw == 4 else role, text)
        out[conv_id] += [row] * (0 if draw == 0 else 2 if draw == 3 else 1)
    return out


def plain(by_conversation):
    rows = []
    for conv_id, turns in by_conversation.items():
        turns, seen, judged = sorted(turns), set(), []
        for _, _, role, text in turns:
            body = text.rstrip(" \t\n\x0b\f\r")
            fault = "blank" if not body else "duplicate" if (role, text) in seen else None if body[-1] in ".!?" else "truncated"
            seen.add((role, text))
            judged.append((role, text, fault))
        numbers = [t for known, t, *_ in turns if known]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        pairs = [a[0][:1] + b[0][:1] for a, b in zip(judged, judged[1:])]
        cost, audit, out = plain_search(judged)
        assert PATTERN.fullmatch("".join(role[0] for role, _ in out))
        counts = [sum(f == kind for *_, f in judged) for kind in ("blank", "duplicate", "truncated")]
        done = brute.sha("\n".join(f"{role}:{text}" for role, text in out))
        rows.append((conv_id, gaps, *counts, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, done))
    return sorted(rows, key=repr)


def table(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def conversations(spark, rows):
    clashing = {c: F.lit(c) for c in ("present", "copy", "draw", "kind", "audit", "cost", "fault", "initial", "seen", "place", "edit")}
    return spark.createDataFrame(rows, FIELDS).withColumns(clashing)


LETTERS = "xsuaoSUAO"
ROLES = {"s": "system", "u": "user", "a": "assistant", "o": "tool"}


def as_turns(letters):
    return [("user" if c == "x" else ROLES[c.lower()], str(k), "blank" if c == "x" else "truncated" if c.isupper() else None) for k, c in enumerate(letters)]


def test_search_finds_the_least_cost_and_audit():
    random.seed(11)
    texts = [""] + [a + b + c for a in LETTERS for b in LETTERS for c in LETTERS]
    texts += ["".join(random.choice(LETTERS) for _ in range(random.randrange(4, 30))) for _ in range(300)]
    for letters in texts:
        assert turnrepair.cheapest(letters, 0, turnrepair.ENDS) == plain_search(as_turns(letters))[:2], letters


@pytest.mark.parametrize("segment", [1, 2, 7])
def test_segments_give_the_same_result(segment):
    random.seed(segment)
    for _ in range(150):
        letters = "".join(random.choice(LETTERS) for _ in range(random.randrange(40)))
        search = turnrepair.Search(segment)
        for letter in letters:
            search.add(letter)
        assert search.result() == plain_search(as_turns(letters))[:2], letters


def test_stored_conversations(spark, folder):
    stored = spark.read.parquet(f"{folder}/conversations.parquet")
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in stored.collect()]
    df = QUERIES["op11_conversation_repair"](spark, folder)
    assert tuple(df.columns) == COLUMNS and {t for c, t in df.dtypes} == {"bigint", "string"}
    assert table(df) == plain(damage(rows)) and df.count() == stored.select("conv_id").distinct().count()


def odd_rows():
    random.seed(5)
    rows = [(None, 0, "user", "a."), (None, None, None, "b"), (1, None, None, None), (1, None, "", "x."), (2, 3, "user", "w " * 300_000)]
    rows += [(3, 7, "user", "tied."), (3, 7, "assistant", "tied."), (3, 7, "user", "tied."), (3, 7, "user", None), (4, 2**40, "user", "?")]
    rows += [(5, k, random.choice(["system", "user", "assistant", "tool", ""]), random.choice(["a.", "b!\n", "c", " ", f"{k}."])) for k in range(700)]
    # conversations of which a dropped turn is all there is
    rows += [(c, 0, "user", "gone.") for c in range(6, 400)]
    return rows


def test_defined_cases(spark):
    rows = odd_rows()
    assert table(turnrepair.repair(turnrepair.damaged(conversations(spark, rows)))) == plain(damage(rows))
    none = (0, 0, 0, 0, 0, 0, "", brute.sha(""))
    assert none in {r[1:] for r in plain(damage(rows))}
    assert table(turnrepair.repair(turnrepair.damaged(conversations(spark, rows).where("false")))) == []


def test_repaired_turns_are_what_the_hash_says(spark):
    turns = turnrepair.sound(conversations(spark, odd_rows()))
    found = turnrepair.verdicts(turns)
    out = defaultdict(list)
    for r in turnrepair.repaired_turns(turns, found).orderBy("conv_id", "place").collect():
        out[r.conv_id].append(r)
    seals = {r.conv_id: (r.audit, r.repaired_sha256) for r in turnrepair.sealed(turns, found).collect()}
    for conv_id, (audit, seal) in seals.items():
        made = out.get(conv_id, [])
        assert [r.place for r in made] == list(range(len(made)))
        assert "".join(r.edit for r in made) == audit.replace("D", "")
        assert PATTERN.fullmatch("".join(r.role[0] for r in made))
        assert brute.sha("\n".join(f"{r.role}:{r.text}" for r in made)) == seal
