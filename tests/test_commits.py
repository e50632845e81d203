"""What readers see while loads fail at every step, overlap, or leave files behind."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from ridelake.operators import quality as q
from ridelake.sources import commits, writers
from ridelake.sources.commits import CommitConflict, Files, Load, Store
from ridelake.sources.readers import read_table
from tests.conftest import plan_of, rows_of


class Stop(Exception):
    pass


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "db"))


def seen(store, *names):
    return {name: rows_of(store.read(name)) for name in names if store.has(name)}


def two_tables(store, frame, number):
    with store.load() as load:
        load.append("drivers", frame("id int, name string", (number, f"d{number}")))
        load.replace("trips", frame("id int, day int", (number, number), (number, 0)), by=("day",))
        load.marks["last"] = number


STEPS = [
    (Load, "_write", 1), (Load, "_write", 2), (Load, "staged", 1), (Load, "staged", 2), (Load, "commit", 1),
    (Files, "publish", 1), (Store, "claim", 1), (Files, "claim", 1),
]


@pytest.mark.parametrize("late", [False, True])
@pytest.mark.parametrize(("owner", "step", "nth"), STEPS)
def test_a_load_that_fails_at_any_step_leaves_the_tables_as_they_were(store, frame, monkeypatch, owner, step, nth, late):
    """Before or after what the step does; what comes last, the record, makes all of it visible."""
    two_tables(store, frame, 1)
    before = seen(store, "drivers", "trips")
    assert before == {"drivers": [(1, "d1")], "trips": [(1, 0), (1, 1)]}
    plain, calls = getattr(owner, step), [0]

    def failing(self, *args, **more):
        calls[0] += 1
        if calls[0] == nth and not late:
            raise Stop
        done = plain(self, *args, **more)
        if calls[0] == nth:
            raise Stop
        return done

    with monkeypatch.context() as patch:
        patch.setattr(owner, step, failing)
        with pytest.raises(Stop):
            two_tables(store, frame, 2)
    committed = late and (owner, step) in ((Load, "commit"), (Files, "publish"))
    after = {"drivers": [(1, "d1"), (2, "d2")], "trips": [(2, 0), (2, 2)]}
    assert seen(store, "drivers", "trips") == (after if committed else before)
    assert store.record().marks == {"last": 2 if committed else 1}
    two_tables(store, frame, 3)
    assert seen(store, "drivers", "trips") == {
        "drivers": [(1, "d1"), *([(2, "d2")] if committed else []), (3, "d3")], "trips": [(3, 0), (3, 3)],
    }


def test_a_failing_query_leaves_the_tables_as_they_were(store, frame):
    two_tables(store, frame, 1)
    broken = frame("id int", 1).select(F.raise_error(F.lit("stop")).cast("int").alias("id"), F.lit("x").alias("name"))
    with pytest.raises(Exception, match="stop"):
        with store.load() as load:
            load.replace("trips", frame("id int, day int", (9, 9)))
            load.append("drivers", broken)
    assert seen(store, "drivers", "trips") == {"drivers": [(1, "d1")], "trips": [(1, 0), (1, 1)]}


def test_the_second_of_two_overlapping_loads_fails_whole(store, frame):
    two_tables(store, frame, 1)
    early, late = Load(store), Load(store)
    early.append("drivers", frame("id int, name string", (2, "early")))
    late.append("drivers", frame("id int, name string", (3, "late")))
    late.commit()
    with pytest.raises(CommitConflict):
        early.commit()
    assert seen(store, "drivers") == {"drivers": [(1, "d1"), (3, "late")]}
    two_tables(store, frame, 4)
    assert seen(store, "drivers") == {"drivers": [(1, "d1"), (3, "late"), (4, "d4")]}


def test_a_record_is_never_written_over(store, frame, monkeypatch):
    """Both loads pass the first look; the file system lets one of them put its record in place."""
    two_tables(store, frame, 1)
    base = store.record()
    early, late = Load(store), Load(store)
    for load, name in ((early, "early"), (late, "late")):
        load.append("drivers", frame("id int, name string", (2, name)))
    late.commit()
    monkeypatch.setattr(Store, "record", lambda self: base)
    with pytest.raises(CommitConflict):
        early.commit()
    monkeypatch.undo()
    assert seen(store, "drivers") == {"drivers": [(1, "d1"), (2, "late")]}
    assert not [name for name in store.files.names("_commits") if name.startswith(".")]


def test_a_reader_keeps_the_tables_it_began_with(store, frame):
    two_tables(store, frame, 1)
    record = store.record()
    old = store.read("trips", record=record)
    two_tables(store, frame, 2)
    assert rows_of(old) == [(1, 0), (1, 1)] and rows_of(store.read("trips")) == [(2, 0), (2, 2)]
    assert rows_of(store.read("drivers", record=record)) == [(1, "d1")]


def test_a_load_reads_what_it_has_staged(store, frame):
    with store.load() as load:
        load.create("drivers", frame("id int, name string", (0, "")).schema)
        assert load.read("drivers").count() == 0
        load.append("drivers", frame("id int, name string", (1, "a")))
        assert rows_of(load.read("drivers")) == [(1, "a")] and not store.has("drivers")
        load.append("drivers", frame("id int, name string", (2, "b")), key="id")
    assert rows_of(store.read("drivers")) == [(1, "a"), (2, "b")]
    table = store.record().tables["drivers"]
    assert (table.rows, table.highest) == (2, 2) and table.bytes == 2 * (16 * 3 + 1)


def test_only_files_of_loads_that_count_are_opened(store, frame):
    for number in (1, 2):
        two_tables(store, frame, number)
    left = Load(store)  # never commits
    left.append("drivers", frame("id int, name string", (8, "left")))
    two_tables(store, frame, 3)
    drivers = store.read("drivers")
    assert "PartitionFilters: [isnotnull(_load" in plan_of(drivers)
    assert rows_of(drivers.select("id")) == [(1,), (2,), (3,)]
    assert store.record().abandoned == (left.number,)


def test_old_records_go(store, frame, monkeypatch):
    monkeypatch.setattr(commits, "KEPT_RECORDS", 2)
    for number in range(1, 5):
        two_tables(store, frame, number)
    assert sorted(store.files.names("_commits")) == ["00000003", "00000004"]
    assert store.files.names("_claims") == [str(store.record().load)]


def test_a_replacement_may_change_columns_and_partitions(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    writers.append(frame("id int, day int", (1, 1)), path)
    writers.replace(frame("id int, day int, more string", (2, 5, "x")), path, by=("day",))
    writers.append(frame("id int, day int, more string", (3, 6, None)), path)
    assert rows_of(read_table(spark, path)) == [(2, 5, "x"), (3, 6, None)]
    assert read_table(spark, path).columns == ["id", "day", "more"]


def test_files_of_others_are_read_as_they_are(spark, frame, tmp_path):
    path = str(tmp_path / "plain")
    frame("id int", 1, 2).write.parquet(path)
    assert read_table(spark, path).count() == 2 and not writers.table_exists(spark, path)
    assert not os.path.exists(tmp_path / "_commits")


@pytest.mark.parametrize("crash", [1, 2])
def test_a_crash_between_two_tables_of_a_batch_leaves_neither(spark, frame, tmp_path, monkeypatch, crash):
    drivers = q.Batch(frame("id int, name string", (1, "a")), str(tmp_path / "drivers"), "id")
    trips = q.Batch(frame("id int, driver int", (1, 1), (2, 1)), str(tmp_path / "trips"), "id")
    plain, calls = q.Batch.stage, [0]

    def staged(self, load):
        calls[0] += 1
        if calls[0] == crash:
            raise Stop
        return plain(self, load)

    with monkeypatch.context() as patch:
        patch.setattr(q.Batch, "stage", staged)
        with pytest.raises(Stop):
            q.load_batches([drivers, trips])
    assert not writers.table_exists(spark, drivers.path) and not writers.table_exists(spark, trips.path)
    assert q.load_batches([drivers, trips]) == 3
    with pytest.raises(ValueError):
        q.load_batches([drivers, q.Batch(trips.rows, str(tmp_path / "elsewhere" / "trips"), "id")])
