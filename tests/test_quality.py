from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ridelake.functions.rules import RIDE_STATUSES
from ridelake.operators import quality as q
from ridelake.sources.readers import read_table
from ridelake.sources.writers import table_exists
from tests.conftest import plan_of, rows_of

TRIP = "trip_id int, driver_id int, fare decimal(10,2), rating decimal(4,1), status string"


def trip(number, driver=1, fare="100.00", rating="4.5", status="completed"):
    return (number, driver, None if fare is None else Decimal(fare), None if rating is None else Decimal(rating), status)


def rules():
    return [q.not_null("fare"), q.above("fare", 0), q.between("rating", 1, 5), q.one_of("status", RIDE_STATUSES)]


def test_null_passes_a_check(frame):
    trips = frame(TRIP, trip(1, rating=None), trip(2, status=None))
    good, bad = q.split_by_rules(trips, rules())
    assert good.count() == 2 and bad.count() == 0


def test_rejected_rows_name_every_broken_rule(frame):
    trips = frame(TRIP, trip(1), trip(2, fare="-1", rating="99"), trip(3, fare=None), trip(4, status="pending"))
    good, bad = q.split_by_rules(trips, rules())
    assert [r["trip_id"] for r in good.collect()] == [1] and good.columns == trips.columns
    assert rows_of(bad.select("trip_id", "failed_rules")) == [
        (2, ["fare_above", "rating_range"]),
        (3, ["fare_not_null"]),
        (4, ["status_enum"]),
    ]


def test_report_counts_in_one_pass(frame):
    trips = frame(TRIP, trip(5, rating="99"), trip(3, rating="0.5"), trip(1))
    report = q.rule_report(trips, rules(), "trip_id")
    assert ("rating_range", 2, 3) in rows_of(report) and ("fare_above", 0, None) in rows_of(report)
    assert plan_of(report).count("Scan ") == 1


def test_width_runs_on_wide_columns(frame):
    rows = frame("id int, name string, v double", (1, "abc", 9.94), (2, "abcd", 99.0), (3, None, None))
    report = q.rule_report(rows, [q.max_length("name", 3), q.fits("v", "decimal(2,1)")], "id")
    assert rows_of(report) == [("name_width", 1, 2), ("v_fits", 1, 2)]


def test_cross_column_checks(frame):
    licences = frame(
        "id int, issued date, expires date",
        (1, date(2024, 1, 1), date(2025, 1, 1)),
        (2, None, date(2025, 1, 1)),
        (3, date(2025, 1, 1), date(2025, 1, 1)),
    )
    in_order = q.check("dates", F.col("issued").isNull() | (F.col("issued") < F.col("expires")))
    _, bad = q.split_by_rules(licences, [in_order])
    assert [r["id"] for r in bad.collect()] == [3]


def test_duplicates_and_one_current(frame):
    licences = frame("driver int, number string, current boolean", (1, "a", True), (1, "b", False), (2, "c", True), (2, "c", True), (None, "d", True), (None, "e", True))
    assert rows_of(q.duplicate_keys(licences, ["number"])) == [("c", 2)]
    assert rows_of(q.duplicate_keys(licences, ["driver"], F.col("current"))) == [(2, 2)]


def test_orphans_ignore_null(frame):
    trips = frame(TRIP, trip(1, 1), trip(4, 9), trip(2, 9), trip(3, None))
    assert rows_of(q.orphan_keys(trips, "driver_id", frame("id int", 1, 2), "id", "trip_id")) == [(9, 2, 2)]


def batch(rows, path, frame, **extra):
    return q.Batch(
        rows, str(path), "trip_id", rules(), (q.Unique(("trip_id",)),),
        (q.References("driver_id", frame("id int", 1), "id"),),
        [F.col("trip_id"), F.col("driver_id"), F.col("fare"), F.col("rating").cast("decimal(2,1)").alias("rating"), F.col("status")],
        **extra,
    )


def stored(spark, path):
    return read_table(spark, str(path)).count() if table_exists(spark, str(path)) else 0


def test_good_batch_loads_whole(spark, frame, tmp_path):
    rows = frame(TRIP, *[trip(i, fare=f"{100 * i}.00") for i in range(1, 6)])
    assert q.load_batch(batch(rows, tmp_path / "trips", frame)) == 5
    kept = read_table(spark, str(tmp_path / "trips"))
    assert kept.count() == 5 and dict(kept.dtypes)["rating"] == "decimal(2,1)"


@pytest.mark.parametrize(
    ("bad", "rule", "row"),
    [
        (trip(3, rating="99"), "rating_range", 3),
        (trip(3, fare="-250"), "fare_above", 3),
        (trip(3, driver=8), "driver_id_reference", 3),
        (trip(2), "trip_id_unique", 2),
    ],
)
def test_bad_batch_writes_nothing_and_names_the_row(spark, frame, tmp_path, bad, rule, row):
    path = tmp_path / "trips"
    q.load_batch(batch(frame(TRIP, trip(100)), path, frame))
    rows = frame(TRIP, trip(1), trip(2), bad, trip(4), trip(5))
    with pytest.raises(q.BatchRejected) as error:
        q.load_batch(batch(rows, path, frame))
    assert (error.value.rule, error.value.row) == (rule, row)
    assert stored(spark, path) == 1


def test_two_tables_load_together_or_not_at_all(spark, frame, tmp_path):
    drivers = q.Batch(frame("driver_id int, name string", (1, "Test Driver")), str(tmp_path / "drivers"), "driver_id", [q.not_null("name")])
    trips = frame(TRIP, trip(1), trip(2), trip(3), trip(4, rating="99"))
    with pytest.raises(q.BatchRejected):
        q.load_batches([drivers, batch(trips, tmp_path / "trips", frame)])
    assert stored(spark, tmp_path / "drivers") == 0 and stored(spark, tmp_path / "trips") == 0
    good = batch(trips.where("rating < 5"), tmp_path / "trips", frame)
    assert q.load_batches([drivers, good]) == 4


def test_rows_can_be_dated(frame):
    """Completion rules on timestamps."""
    trips = frame("id int, status string, at timestamp_ntz", (1, "completed", None), (2, "cancelled", None), (3, "completed", datetime(2024, 1, 1)))
    timed = q.check("timed", ((F.col("status") == "completed") & F.col("at").isNotNull()) | (F.col("status") != "completed"))
    assert rows_of(q.rule_report(trips, [timed], "id")) == [("timed", 1, 1)]


def test_keys_already_stored_are_taken(frame, tmp_path):
    path = str(tmp_path / "people")
    rows = frame("id int, name string", (1, "a"), (2, "b"))
    gate = q.Batch(rows, path, "id", unique=[q.Unique(("id",))])
    assert q.load_batch(gate) == 2
    with pytest.raises(q.BatchRejected) as refused:
        q.load_batch(gate)
    assert (refused.value.rule, refused.value.row, refused.value.violations) == ("id_unique", 1, 2)
    more = frame("id int, name string", (2, "c"), (3, "d"), (3, "e"), (None, "f"), (None, "g"))
    report = q.batch_report(more, "name", unique=[q.Unique(("id",))], stored=rows)
    assert [tuple(row) for row in report.collect()] == [("id_unique", 2, "c")]
    assert q.load_batch(q.Batch(rows, path, "id", unique=[q.Unique(("id",))], replaces=True)) == 2


def test_foreign_keys_are_checked_in_one_pass(frame):
    child = frame("id int, a int, b bigint", (1, 1, 9), (2, 5, None), (3, 5, 8), (4, None, 8))
    references = [
        q.References("a", frame("k int", 1, 2), "k"),
        q.References("b", frame("k bigint", 9), "k"),
        q.References("id", frame("k int", 1, 2, 3, 4), "k"),
    ]
    report = q.batch_report(child, "id", references=references)
    assert {tuple(row) for row in report.collect()} == {("a_reference", 2, 2), ("b_reference", 2, 3), ("id_reference", 0, None)}


def test_many_keys_scan_the_child_once(spark, folder):
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    parents = {"l_partkey": ("part", "p_partkey"), "l_suppkey": ("supplier", "s_suppkey"), "l_orderkey": ("orders", "o_orderkey")}
    references = [q.References(c, spark.read.parquet(f"{folder}/{t}.parquet"), k) for c, (t, k) in parents.items()]
    plan = plan_of(q.reference_report(lines, references, "l_linenumber"))
    assert plan.count("lineitem.parquet") == 1
