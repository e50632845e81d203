from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ridelake import schemas
from ridelake.operators.quality import Batch, BatchRejected, load_batch
from ridelake.plans import flat, normalise, reports
from ridelake.plans.constraints import normalised_trip_constraints
from ridelake.sources.readers import read_table
from tests.conftest import rows_of

AT = datetime(2025, 1, 15, 9)


def ride(number, driver, fare, status="completed", passenger="Maya", pickup="Birgunj", dropoff="Kathmandu", pay="cash", rating="4.5"):
    return (
        number, driver, passenger, pickup, dropoff, Decimal(fare), Decimal("8.50"), status, AT,
        AT if status == "completed" else None, rating and Decimal(rating), pay,
    )


@pytest.fixture
def golden(spark):
    """Seven rides with known totals per driver."""
    names = ("Ramesh", "Sita", "Ramesh", "Bikash", "Sita", "Ramesh", "Bikash")
    fares = ("350", "210", "480", "320", "290", "150", "410")
    rows = [ride(i, n, f, "cancelled" if i == 4 else "completed") for i, (n, f) in enumerate(zip(names, fares), 1)]
    return spark.createDataFrame(rows, schemas.RIDES)


def test_group_by_golden(golden):
    assert rows_of(flat.driver_revenue(golden)) == [
        ("Bikash", 2, Decimal("730.00")),
        ("Ramesh", 3, Decimal("980.00")),
        ("Sita", 2, Decimal("500.00")),
    ]


def test_casing_adds_a_group_until_names_are_cleaned(spark, golden):
    typed = golden.union(spark.createDataFrame([ride(8, " ramesh ", "10")], schemas.RIDES))
    assert flat.driver_revenue(typed).count() == 4
    assert rows_of(flat.count_clean_names(typed, "driver_name")) == [(4, 3)]
    assert flat.clean_names(typed, "driver_name").count() == 3


@pytest.fixture
def typed(spark):
    rows = [
        ride(1, "Ramesh  Shrestha", "100", passenger="maya rai"),
        ride(2, "ramesh shrestha", "0.01", passenger=" MAYA RAI", pickup="Pokhara", pay=None),
        ride(3, "SITA O'BRIEN", "50", "no_show", dropoff="Birgunj", pay="esewa", rating=None),
    ]
    return spark.createDataFrame(rows, schemas.RIDES)


def test_normalised_load(spark, typed, tmp_path):
    root = str(tmp_path / "db")
    added = normalise.load_normalised(spark, typed, root)
    assert added == {"drivers": 2, "passengers": 2, "locations": 3, "payment_methods": 2, "trips": 3}
    tables = {name: read_table(spark, f"{root}/{name}") for name in added}
    assert rows_of(tables["drivers"].select("name")) == [("Ramesh Shrestha",), ("Sita O'Brien",)]
    named = (
        tables["trips"].join(tables["drivers"], "driver_id")
        .join(tables["locations"].withColumnRenamed("location_id", "pickup_location_id"), "pickup_location_id")
        .join(tables["payment_methods"].select("payment_method_id", F.col("name").alias("pay")), "payment_method_id", "left")
    )
    assert rows_of(named.select("trip_id", "name", "city_name", "pay")) == [
        (1, "Ramesh Shrestha", "Birgunj", "cash"),
        (2, "Ramesh Shrestha", "Pokhara", None),
        (3, "Sita O'Brien", "Birgunj", "esewa"),
    ]


def test_second_load_adds_only_what_is_new(spark, typed, tmp_path):
    root = str(tmp_path / "db")
    normalise.load_normalised(spark, typed, root)
    assert set(normalise.load_normalised(spark, typed, root).values()) == {0}
    more = typed.union(spark.createDataFrame([ride(9, "Sita o'brien ", "7"), ride(10, "Hari", "8")], schemas.RIDES))
    added = normalise.load_normalised(spark, more, root)
    assert (added["drivers"], added["passengers"], added["trips"]) == (1, 0, 2)  # Hari is new, Maya is not
    drivers = read_table(spark, f"{root}/drivers")
    assert drivers.count() == drivers.select("driver_id").distinct().count() == 3


def test_a_free_ride_keeps_all_trips_out(spark, typed, tmp_path):
    root = str(tmp_path / "db")
    free = typed.union(spark.createDataFrame([ride(4, "Hari", "0")], schemas.RIDES))
    with pytest.raises(BatchRejected, match="row 4 breaks fare_amount_above"):
        normalise.load_normalised(spark, free, root)
    assert read_table(spark, f"{root}/trips").count() == 0
    assert read_table(spark, f"{root}/drivers").count() == 3


def test_a_name_stored_twice_does_not_multiply_trips(frame):
    drivers = normalise.NAME_TABLES[0]
    spelt = frame("spelling string, name string", ("anita", "Anita"), ("ANITA", "Anita"))
    table = frame("driver_id bigint, name string", (5, "Anita"), (3, "Anita"))
    assert rows_of(normalise.spelling_ids(spelt, drivers, table)) == [("ANITA", 3), ("anita", 3)]


def test_trips_reject_what_rides_accept(spark, typed, tmp_path):
    """A free ride is a valid ride but not a valid trip."""
    root = str(tmp_path / "db")
    normalise.load_normalised(spark, typed, root)
    tables = {name: read_table(spark, f"{root}/{name}") for name in ("drivers", "passengers", "locations", "payment_methods")}
    trips = read_table(spark, f"{root}/trips").withColumn("trip_id", F.col("trip_id") + 100)
    path = str(tmp_path / "loaded")
    assert load_batch(Batch(trips, path, "trip_id", **normalised_trip_constraints(tables))) == 3
    later = trips.withColumn("trip_id", F.col("trip_id") + 100)  # the first batch's ids are taken
    free = later.withColumn("fare_amount", F.when(F.col("trip_id") == 202, 0).otherwise(F.col("fare_amount")))
    with pytest.raises(BatchRejected, match="row 202 breaks fare_amount_above"):
        load_batch(Batch(free, path, "trip_id", **normalised_trip_constraints(tables)))
    lost = later.withColumn("payment_method_id", F.lit(12345))
    with pytest.raises(BatchRejected, match="payment_method_id_reference"):
        load_batch(Batch(lost, path, "trip_id", **normalised_trip_constraints(tables)))
    assert read_table(spark, path).count() == 3


@pytest.fixture
def people(frame):
    return frame("driver_id bigint, name string", (1, "Same Name"), (2, "Same Name"), (3, "No Trips"))


TRIP = "trip_id bigint, driver_id bigint, status string, fare_amount decimal(10,2), rating decimal(2,1)"


@pytest.fixture
def done(frame):
    return frame(
        TRIP,
        (1, 1, "completed", Decimal("10.00"), Decimal("4.0")),
        (2, 1, "cancelled", Decimal("99.00"), None),
        (3, 1, "no_show", Decimal("99.00"), None),
        (4, 2, "completed", Decimal("10.01"), Decimal("4.5")),
        (5, 2, "completed", Decimal("10.02"), None),
    )


def test_namesakes_stay_apart(done, people):
    assert rows_of(reports.driver_summary(done, people)) == [
        (1, "Same Name", 3, 1, 1, Decimal("33.3"), Decimal("10.00"), Decimal("4.0")),
        (2, "Same Name", 2, 2, 0, Decimal("0.0"), Decimal("10.02"), Decimal("4.5")),
    ]


def test_drivers_without_trips_are_reported(done, people):
    assert rows_of(reports.driver_cancellation(done, people))[2] == (3, "No Trips", 0, 0, 0, None)
    assert [tuple(r) for r in reports.driver_completed_rides(done, people).collect()] == [
        (2, "Same Name", 2), (1, "Same Name", 1), (3, "No Trips", 0),
    ]


def test_completed_trip_without_payment_stays(spark, frame):
    trips = spark.createDataFrame(
        [(1, 1, 1, 1, 2, Decimal(5), Decimal(1), "completed", AT, AT, None, None), (2, 1, 1, 1, 2, Decimal(5), Decimal(1), "cancelled", AT, None, None, 1)],
        schemas.NORMALISED_TRIPS,
    )
    named = "id bigint, name string"
    cities = frame("location_id bigint, city_name string", (1, "A"), (2, "B"))
    view = reports.completed_trips(
        trips,
        frame(named, (1, "D")).withColumnRenamed("id", "driver_id"),
        frame(named, (1, "P")).withColumnRenamed("id", "passenger_id"),
        cities,
        frame(named, (1, "cash")).withColumnRenamed("id", "payment_method_id"),
    )
    assert rows_of(view.select("trip_id", "pickup_city", "dropoff_city", "payment_method")) == [(1, "A", "B", None)]


def test_recent_rides_and_empty_totals(golden):
    assert [r["ride_id"] for r in flat.recent_completed(golden, 2).collect()] == [7, 6]
    assert [r["ride_id"] for r in flat.recent_by_completion(golden, 1).collect()] == [7]
    assert flat.latest_row(golden).first()["ride_id"] == 7
    assert flat.completed_fare_total(golden.where("ride_id > 99")).first()["total_fare"] is None
    assert rows_of(flat.having_count(golden, 1)) == [("Ramesh", 3), ("Sita", 2)]


def test_phone_numbers_disagree_after_a_partial_update(golden):
    updated = flat.with_phone_numbers(golden, "%Ramesh%", "987654321", "9876543210", 3)
    assert rows_of(updated.where("driver_name = 'Ramesh'").select("phone_number").distinct()) == [("987654321",), ("9876543210",)]
    assert updated.where("driver_name <> 'Ramesh' AND phone_number IS NOT NULL").count() == 0
