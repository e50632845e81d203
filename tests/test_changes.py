from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ridelake.operators import changes, keys
from tests.conftest import plan_of, rows_of


def test_first_per_key_takes_the_earliest_row(frame):
    batch = frame("k int, at int, v string", (1, 5, "late"), (1, 2, "early"), (2, 1, None), (2, 1, "b"), (3, 9, "only"))
    got = changes.first_per_key(batch, ["k"], ["at"])
    assert got.columns == ["k", "at", "v"]
    assert rows_of(got) == [(1, 2, "early"), (2, 1, None), (3, 9, "only")]


def test_first_per_key_combines_before_the_shuffle(frame):
    batch = frame("k int, at int, v string", (1, 5, "x"))
    text = plan_of(changes.first_per_key(batch, ["k"], ["at"]))
    assert "partial_count" in text and "SortAggregate" not in text  # keys alone are hashed and counted
    limit, shuffled = text.index("row_number(), 1, Final"), text.index("row_number(), 1, Partial")
    assert limit < shuffled and "Exchange" in text[limit:shuffled]  # of repeated keys, one row per task travels
    inserted = plan_of(changes.insert_if_absent(batch, batch.where("at > 9"), ["k"], ["at"]))
    assert "SortAggregate" not in inserted


def test_insert_if_absent_skips_known_and_repeated_keys(frame):
    batch = frame("k int, v string", (1, "new"), (2, "known"), (3, "a"), (3, "b"))
    target = frame("k int, v string", (2, "old"), (2, "older"))
    assert rows_of(changes.insert_if_absent(batch, target, ["k"], ["v"])) == [(1, "new"), (3, "a")]


def test_null_keys_conflict_with_nothing(frame):
    batch = frame("k int, v string", (None, "a"), (None, "b"), (1, "c"), (1, "d"))
    target = frame("k int, v string", (None, "old"))
    assert rows_of(changes.insert_if_absent(batch, target, ["k"], ["v"], nullable=True)) == [(1, "c"), (None, "a"), (None, "b")]


def test_inserting_twice_adds_nothing(frame):
    batch = frame("a int, b string, v int", (1, "x", 1), (1, "y", 2), (1, "x", 3))
    once = changes.insert_if_absent(batch, None, ["a", "b"], ["v"])
    assert rows_of(once) == [(1, "x", 1), (1, "y", 2)]
    assert changes.insert_if_absent(batch, once, ["a", "b"], ["v"]).count() == 0


def test_later_update_wins(frame):
    rides = frame("id int, who string, phone string", (1, "anita", None), (2000, "anita", "0"), (3, "other", "keep"))
    theirs = F.col("who") == "anita"
    got = changes.update_where(rides, "phone", [(theirs, F.lit("first")), (theirs & (F.col("id") > 1000), F.lit("later"))])
    assert rows_of(got.select("id", "phone")) == [(1, "first"), (2000, "later"), (3, "keep")]


def test_update_can_set_null(frame):
    got = changes.update_where(frame("id int, v string", (1, "x")), "v", [(F.col("id") == 1, F.lit(None))])
    assert got.first()["v"] is None


def test_delete_keeps_unknown(frame):
    got = changes.delete_where(frame("id int, v int", (1, 5), (2, 1), (3, None)), F.col("v") > 3)
    assert rows_of(got.select("id")) == [(2,), (3,)]


def test_insert_rows_fills_missing_columns(frame):
    got = changes.insert_rows(frame("id int, v string", (1, "x")), frame("id int", 2))
    assert rows_of(got) == [(1, "x"), (2, None)]


def test_defaults_fill_columns_not_nulls(frame):
    trips = frame("id int, tip int", (1, None))
    got = changes.with_defaults(trips, {"tip": F.lit(0), "surge": F.lit(1)})
    assert rows_of(got) == [(1, None, 1)]


def test_null_column(frame):
    got = changes.add_null_column(frame("id int", 1), "phone_number", "string")
    assert got.dtypes == [("id", "int"), ("phone_number", "string")] and got.first()["phone_number"] is None


def test_keys_are_unique_repeatable_and_above_start(spark):
    people = spark.range(500).select(F.concat(F.lit("p"), F.col("id")).alias("name"))
    first = keys.assign_keys(people, "key", "name", 100)
    got = dict((r["name"], r["key"]) for r in first.collect())
    assert len(set(got.values())) == 500 and min(got.values()) > 100
    again = keys.assign_keys(people.repartition(7), "key", "name", 100)
    assert dict((r["name"], r["key"]) for r in again.collect()) == got


def test_next_free_key(frame):
    assert keys.assign_keys(frame("n string", "a"), "key", "n", keys.next_free_key(frame("key bigint", 41), "key")).first()["key"] > 41
    empty = frame("key bigint")
    assert keys.assign_keys(frame("n string", "a"), "key", "n", keys.next_free_key(empty, "key")).first()["key"] >= 1


def test_parallel_keys_need_no_shuffle(spark):
    facts = spark.range(0, 1000, 1, 5).withColumnRenamed("id", "trip")
    keyed = keys.parallel_keys(facts, "key", 10)
    assert "Exchange" not in plan_of(keyed)
    seen = [r["key"] for r in keyed.collect()]
    assert len(set(seen)) == 1000 and min(seen) == 11


@pytest.mark.parametrize("order", [["at"], ["at", "id"]])
def test_timestamps_order_batches(frame, order):
    batch = frame("k int, at timestamp_ntz, id int", (1, datetime(2024, 1, 2), 1), (1, datetime(2024, 1, 1), 2))
    assert changes.first_per_key(batch, ["k"], order).first()["id"] == 2


def test_a_delete_reaches_children_and_their_children(frame):
    tables = {
        "a": frame("id int", 1, 2, 3),
        "b": frame("id int, a int", (10, 1), (11, 2), (12, None)),
        "c": frame("id int, b int", (20, 10), (21, 11), (22, 10)),
        "d": frame("id int, a int", (30, 1), (31, 3), (32, None)),
    }
    pointers = (
        changes.Pointer("b", "a", "a", "id", cascades=True),
        changes.Pointer("c", "b", "b", "id", cascades=True),
        changes.Pointer("d", "a", "a", "id", cascades=False),
        changes.Pointer("absent", "a", "a", "id", cascades=True),
    )
    left = changes.delete_with_children(tables, pointers, "a", F.col("id") == 1)
    found = {name: rows_of(rows) for name, rows in left.items()}
    assert found == {
        "a": [(2,), (3,)],
        "b": [(11, 2), (12, None)],
        "c": [(21, 11)],
        "d": [(30, None), (31, 3), (32, None)],
    }
