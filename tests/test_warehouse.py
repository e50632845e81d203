from __future__ import annotations

import re
from datetime import datetime, timedelta
from decimal import Decimal
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from ridelake import schemas
from ridelake.functions.temporal import ntz
from ridelake.operators import changes
from ridelake.operators.keys import PLACE
from ridelake.plans import facts, reports, warehouse
from ridelake.sources import operational
from ridelake.sources.commits import Load, Store
from ridelake.sources.readers import read_table
from ridelake.streaming import incremental
from tests.conftest import by_text, plan_of, rows_of

AS_OF = datetime(2024, 7, 1)
CALENDAR = ("2024-01-01", "2024-12-31")


def test_calendar_and_clock(spark):
    days = warehouse.dim_date(spark)
    assert days.count() == 1461 and days.schema.names == schemas.DIM_DATE.names
    first = days.where("date_key = 20230101").first()
    assert (first["week_of_year"], first["day_of_week"], first["day_name"], first["is_weekend"]) == (52, 0, "Sunday", True)
    clock = warehouse.dim_time(spark)
    assert clock.count() == 96 and clock.select("time_key").distinct().count() == 96
    row = clock.where("time_key = 1730").first()
    assert (row["time_label"], row["time_of_day"], row["is_rush_hour"]) == ("17:30", "Evening", True)
    assert clock.where("is_rush_hour").select("hour").distinct().count() == 5


@pytest.fixture
def sources(spark):
    at = datetime(2024, 3, 1, 8)
    return {
        "drivers": spark.createDataFrame([(1, "D", None, None, "active", datetime(2024, 5, 1)), (2, "E", None, None, "inactive", at)], schemas.DRIVERS),
        "passengers": spark.createDataFrame([(1, "P", None, None, "active", at)], schemas.PASSENGERS),
        "locations": spark.createDataFrame([(1, "Austin", "Texas", "USA", None, None), (2, "Pune", None, "India", None, None)], schemas.LOCATIONS),
        "payment_methods": spark.createDataFrame([(1, "cash", "cash", True)], schemas.PAYMENT_METHODS),
        "promo_codes": spark.createDataFrame([(1, "TEN", "percent", Decimal(10), None, None, None, True)], schemas.PROMO_CODES),
        "vehicles": spark.createDataFrame([(1, "PL-1", "m", "x", 2020, "red", "economy", True)], schemas.VEHICLES),
    }


def trip(number, at=datetime(2024, 3, 5, 14, 37), driver=1, passenger=1, vehicle=1, pickup=1, dropoff=2, pay=1, promo=1, status="completed", **money):
    amounts = {"base": "0.10", "tip": "0.00", "off": "0.00", "surge": "1.25", **money}
    base, tip, off, surge = (Decimal(amounts[k]) for k in ("base", "tip", "off", "surge"))
    done = at + timedelta(minutes=12) if status == "completed" else None
    return (number, driver, passenger, vehicle, pickup, dropoff, pay, promo, base, tip, off, surge, Decimal("3.20"), status, at, done, None, None)


@pytest.fixture
def trips(spark):
    def make(*rows):
        return spark.createDataFrame(list(rows), schemas.TRIPS)

    return make


CASES = [
    (trip(1), None),
    (trip(2, at=datetime(2030, 1, 1), driver=9), "date"),
    (trip(3, driver=9, passenger=9), "driver"),
    (trip(4, vehicle=9, passenger=9), "vehicle"),
    (trip(5, vehicle=None), None),
    (trip(6, passenger=9, pickup=9), "passenger"),
    (trip(7, pickup=9, dropoff=9), "pickup"),
    (trip(8, dropoff=9, pay=9), "dropoff"),
    (trip(9, pay=9, promo=9), "payment"),
    (trip(10, promo=9), "promo"),
    (trip(11, pay=None, promo=None), None),
]


@pytest.mark.parametrize("limit", [None, 0])
def test_first_missing_key_is_reported(spark, sources, trips, limit):
    """The same with broadcast and with spread lookups."""
    dims = warehouse.build_dimensions(spark, sources, ntz(AS_OF), *CALENDAR)
    resolved = facts.resolve_keys(trips(*[row for row, _ in CASES]), dims, limit=limit)
    assert dict(rows_of(resolved.select("trip_id", "reject_reason"))) == {row[0]: reason for row, reason in CASES}
    assert rows_of(facts.rejects(resolved).select("trip_id")) == sorted([(row[0],) for row, reason in CASES if reason], key=by_text)


def test_fact_measures(spark, sources, trips):
    dims = warehouse.build_dimensions(spark, sources, ntz(AS_OF), *CALENDAR)
    rows = facts.new_facts(trips(trip(1), trip(2, status="cancelled", tip="1.00"), trip(1)), dims)
    assert rows.schema.names == [name for name in schemas.FACT_TRIPS.names if name != "trip_key"]
    first, second = rows.orderBy("source_trip_id").collect()
    assert (first["date_key"], first["time_key"], first["fare_amount"]) == (20240305, 1430, Decimal("0.12"))
    assert (first["duration_minutes"], second["duration_minutes"]) == (Decimal("12.0"), None)
    assert second["fare_amount"] == Decimal("1.12") and first["trip_count"] == 1


def test_duplicate_dimension_rows_do_not_multiply_trips(spark, sources, trips):
    dims = warehouse.build_dimensions(spark, sources, ntz(AS_OF), *CALENDAR)
    dims["dim_driver"] = dims["dim_driver"].union(dims["dim_driver"].withColumn("driver_key", F.col("driver_key") + 1000))
    resolved = facts.resolve_keys(trips(trip(1)), dims)
    assert resolved.count() == 1 and resolved.first()["driver_key"] > 1000


def stored(spark, root, name):
    return read_table(spark, f"{root}/{name}")


def run(spark, sources, root, rows, as_of=AS_OF, **more):
    return facts.run_etl(spark, {**sources, "trips": rows}, root, as_of=as_of, first=CALENDAR[0], last=CALENDAR[1], **more)


def test_etl_loads_rejects_and_runs_again(spark, sources, trips, tmp_path):
    root = str(tmp_path / "dw")
    every = trips(*[row for row, _ in CASES])
    added = run(spark, sources, root, every)
    assert (added["fact_trips"], added["rejected_trips"]) == (3, 8)
    assert (added["dim_driver"], added["dim_date"], added["dim_time"]) == (2, 366, 96)
    loaded = stored(spark, root, "fact_trips")
    assert loaded.select("trip_key").distinct().count() == 3
    assert dict(loaded.dtypes)["fare_amount"] == "decimal(10,2)"
    again = run(spark, sources, root, every)
    assert sum(n for name, n in again.items() if name != "rejected_trips") == 0


def test_stored_dimension_rows_never_change(spark, sources, trips, tmp_path):
    root = str(tmp_path / "dw")
    run(spark, sources, root, trips(trip(1)))
    later = {**sources, "drivers": sources["drivers"].withColumn("status", F.lit("suspended")).union(
        spark.createDataFrame([(3, "N", None, None, "active", datetime(2024, 5, 1))], schemas.DRIVERS))}
    added = run(spark, later, root, trips(trip(1)), as_of=datetime(2030, 1, 1))
    assert added["dim_driver"] == 1
    dim = stored(spark, root, "dim_driver")
    assert rows_of(dim.select("driver_id", "status", "tenure_bucket")) == [
        (1, "active", "0-6 months"), (2, "inactive", "0-6 months"), (3, "active", "2+ years"),
    ]
    assert dim.select("driver_key").distinct().count() == 3


def test_incremental_load_keeps_ties_and_late_rows(spark, sources, trips, tmp_path):
    root = str(tmp_path / "dw")
    mark = datetime(2024, 3, 5, 14, 37)
    assert run(spark, sources, root, trips(trip(1), trip(2)))["fact_trips"] == 2
    tie, newer, late = trip(3, at=mark), trip(4, at=mark + timedelta(hours=1)), trip(5, at=mark - timedelta(hours=1))
    every = trips(trip(1), trip(2), tie, newer, late)
    assert run(spark, sources, root, every)["fact_trips"] == 2
    assert rows_of(stored(spark, root, "fact_trips").select("source_trip_id")) == [(1,), (2,), (3,), (4,)]
    assert run(spark, sources, root, every, lookback=timedelta(minutes=119))["fact_trips"] == 0
    assert run(spark, sources, root, every, lookback=timedelta(hours=2))["fact_trips"] == 1
    assert stored(spark, root, "fact_trips").count() == 5


def test_arriving_files_load_once(spark, sources, trips, tmp_path):
    root, folder, name = str(tmp_path / "dw"), str(tmp_path / "arriving"), f"test-{uuid4().hex}"
    facts.load_dimensions(spark, sources, root, ntz(AS_OF), *CALENDAR)

    def arrive(*rows):
        trips(*rows).coalesce(1).write.mode("append").parquet(folder)
        incremental.follow_trips(spark, folder, root, name).awaitTermination()
        return sorted(row[0] for row in stored(spark, root, "fact_trips").select("source_trip_id").collect())

    assert arrive(trip(1), trip(2, driver=9)) == [1]
    late = trip(3, at=datetime(2024, 1, 2))
    assert arrive(trip(1), late, trip(4)) == [1, 3, 4]
    assert stored(spark, root, "rejected_arrivals").count() == 1
    incremental.load_arriving(trips(trip(1), late, trip(4)), 1, root)
    assert stored(spark, root, "fact_trips").count() == 3


def test_watermark_reads_the_last_day_only(spark, sources, trips, tmp_path):
    root = str(tmp_path / "dw")
    run(spark, sources, root, trips(trip(1), trip(2, at=datetime(2024, 6, 1))))
    loaded, record = stored(spark, root, "fact_trips"), Store(spark, root).record()
    assert facts.loaded_until(record) == datetime(2024, 6, 1)
    for mark in (facts.high_water_mark(loaded), facts.high_water_mark(loaded, record)):
        assert mark.first()["watermark"] == datetime(2024, 6, 1)
    plan = plan_of(facts.high_water_mark(loaded, record))
    opened = plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "(date_key" in opened and "= 20240601" in opened and "Subquery" not in plan
    assert facts.high_water_mark(loaded.where("date_key < 0")).first()["watermark"] is None
    empty = Store(spark, str(tmp_path / "none")).record()
    assert facts.loaded_until(empty) is None and facts.high_water_mark(loaded, empty).first()["watermark"] is None


def test_keys_and_mark_go_on_from_the_last_record(spark, sources, trips, tmp_path):
    """Keys have no gaps over several loads, whatever the partitions; no load asks the fact table for them."""
    root = str(tmp_path / "dw")
    for load, numbers in enumerate((range(1, 30), range(20, 45), range(1, 45), range(45, 47))):
        rows = [trip(n, at=datetime(2024, 3, 1 + n % 28, n % 24)) for n in numbers]
        added = run(spark, sources, root, trips(*rows).repartition(1 + 2 * load), lookback=timedelta(days=400))
        assert added["fact_trips"] == (29, 15, 0, 2)[load]
    loaded = stored(spark, root, "fact_trips")
    assert sorted(r.trip_key for r in loaded.collect()) == list(range(1, 47))
    record = Store(spark, root).record()
    assert record.tables["fact_trips"].highest == record.tables["fact_trips"].rows == record.tables["trip_ids"].rows == 46
    assert facts.loaded_until(record) == loaded.agg(F.max("requested_at")).first()[0]


def test_stored_ids_stay_where_they_are(spark, sources, trips, tmp_path):
    """The duplicate check shuffles the new trips to the buckets of the stored ids, which have no exchange above them."""
    root = str(tmp_path / "dw")
    run(spark, sources, root, trips(*[trip(n) for n in range(1, 20)]))
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    for more in (1, 3):  # also in a session with more shuffle partitions than the table has buckets
        spark.conf.set("spark.sql.shuffle.partitions", str(more * int(parts)))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            load = Load(Store(spark, root))
            ids = facts.KeyTable(load, "trip_ids", schemas.FACT_TRIPS["source_trip_id"])
            assert ids.buckets == int(parts) and ids.rows().count() == 19
            batch = spark.createDataFrame([(n, AS_OF) for n in range(10, 30)], "source_trip_id long, requested_at timestamp_ntz")
            fresh = facts.unseen(batch, ids.rows())
            assert sorted(r[0] for r in fresh.collect()) == list(range(20, 30))
            plan = plan_of(fresh)
            scan = next(line for line in plan.splitlines() if "trip_ids_" in line)
            assert "Bucketed: true" in scan
            depth = len(scan) - len(scan.lstrip(" :+-"))
            above, last = [], depth
            for line in reversed(plan[: plan.index(scan)].splitlines()):
                indent = len(line) - len(line.lstrip(" :+-"))
                if indent < last:
                    above.append(line)
                    last = indent
                    if "Join" in line:
                        break
            assert "Join" in above[-1] and not any("Exchange" in line for line in above)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_load_that_dies_after_its_facts_adds_nothing(spark, sources, trips, tmp_path, monkeypatch):
    """Facts, ids, sums, rejects, keys and mark are one commit."""
    root = str(tmp_path / "dw")
    run(spark, sources, root, trips(trip(1), trip(2, driver=9)))
    names = ("fact_trips", "daily_sums", "rejected_trips")
    before = {name: rows_of(stored(spark, root, name)) for name in names}

    def dies(*writes):
        for write in writes:
            write()
        raise InterruptedError

    with monkeypatch.context() as patch, pytest.raises(InterruptedError):
        patch.setattr(facts, "at_once", dies)
        facts.load_slice(spark, trips(trip(3), trip(4, driver=9)), root)
    assert {name: rows_of(stored(spark, root, name)) for name in names} == before
    assert facts.load_slice(spark, trips(trip(1), trip(3)), root) == {"fact_trips": 1, "rejected_trips": 0}
    assert rows_of(stored(spark, root, "fact_trips").select("trip_key", "source_trip_id")) == [(1, 1), (2, 3)]


def test_compacting_changes_no_row(spark, sources, trips, tmp_path):
    root = str(tmp_path / "dw")
    for numbers in (range(1, 8), range(5, 12), range(10, 15)):
        run(spark, sources, root, trips(*[trip(n, at=datetime(2024, 3, 1 + n % 3)) for n in numbers]), lookback=timedelta(days=400))
    dims = [stored(spark, root, n) for n in ("dim_location", "dim_date")]
    before = rows_of(reports.city_months(stored(spark, root, "daily_sums"), *dims))
    was, old = Store(spark, root).record(), stored(spark, root, "daily_sums").count()
    done = facts.compact(spark, root)
    assert done["trip_ids"] == 14 and done["daily_sums"] == stored(spark, root, "daily_sums").count() < old
    now = Store(spark, root).record()
    assert (now.tables["fact_trips"], now.marks) == (was.tables["fact_trips"], was.marks) and now.tables["trip_ids"].rows == 14
    assert sorted(r[0] for r in stored(spark, root, "trip_ids").collect()) == list(range(1, 15))
    assert rows_of(reports.city_months(stored(spark, root, "daily_sums"), *dims)) == before
    again = trips(trip(3), trip(14), trip(15))
    assert facts.load_slice(spark, again, root)["fact_trips"] == 1
    assert sorted(r.trip_key for r in stored(spark, root, "fact_trips").collect()) == list(range(1, 16))


def test_reports_from_the_sums_of_all_loads(spark, sources, trips, tmp_path):
    root = str(tmp_path / "dw")
    rows = [trip(i, at=datetime(2024, 1 + i % 3, 5, i % 24), pickup=1 + i % 2, pay=1 if i % 4 else None, base=f"{i}.40") for i in range(1, 40)]
    for part in (rows[:10], rows[5:30], rows):
        run(spark, sources, root, trips(*part), lookback=timedelta(days=400))
    loaded, sums, places, days, methods, clock = (
        stored(spark, root, n) for n in ("fact_trips", "daily_sums", "dim_location", "dim_date", "dim_payment_method", "dim_time")
    )
    assert loaded.count() == 39
    assert rows_of(reports.city_months(sums, places, days)) == rows_of(reports.revenue_by_city_month(loaded, places, days))
    assert rows_of(reports.method_totals(sums, methods)) == rows_of(reports.revenue_by_method(loaded, methods))
    assert rows_of(reports.method_months(sums, methods, days)) == rows_of(reports.avg_fare_by_method_month(loaded, methods, days))
    assert rows_of(reports.hours(sums, clock)) == rows_of(reports.busiest_hour(loaded, clock))
    assert sums.groupBy("by").agg(F.sum("trips").alias("n")).where("n = 39").count() == 3
    assert re.search(r"PartitionFilters: \[[^]]*isnotnull\(by", plan_of(reports.hours(sums, clock)))


def test_star_and_operational_revenue_agree(spark, sources, trips, tmp_path):
    """On fares without a rounding tie both forms give the same revenue."""
    root = str(tmp_path / "dw")
    rows = [trip(i, at=datetime(2024, 1 + i % 3, 5, i % 24), pickup=1 + i % 2, base=f"{i}.40", surge="1.50") for i in range(1, 40)]
    run(spark, sources, root, trips(*rows))
    star = reports.revenue_by_city_month(*(stored(spark, root, n) for n in ("fact_trips", "dim_location", "dim_date")))
    flat = reports.revenue_by_city_month_operational(trips(*rows), sources["locations"])
    assert rows_of(star) == rows_of(flat) and star.count() == 6
    methods = reports.revenue_by_method(stored(spark, root, "fact_trips"), stored(spark, root, "dim_payment_method"))
    assert methods.first()["total_revenue"] == sum(row["total_revenue"] for row in star.collect())
    hours = reports.busiest_hour(stored(spark, root, "fact_trips"), stored(spark, root, "dim_time")).collect()
    assert sum(row["trip_count"] for row in hours) == 39


def test_view_keeps_every_trip(spark, trips, frame):
    cancelled = frame("trip_id bigint, cancelled_at timestamp_ntz, cancelled_by string, cancellation_reason string", (2, AS_OF, "driver", None))
    view = reports.trips_view(trips(trip(1), trip(2, status="cancelled")), cancelled)
    assert rows_of(view.select("trip_id", "fare_amount", "duration_minutes", "cancelled_by")) == [
        (1, Decimal("0.13"), Decimal("12.000000000000000"), None),
        (2, Decimal("0.13"), None, "driver"),
    ]


def test_unused_promos_are_listed(trips, sources):
    used = reports.promo_usage(sources["promo_codes"], trips(trip(1, promo=None)))
    assert rows_of(used.select("code", "times_used")) == [("TEN", 0)]


def test_whole_model_loads_from_stored_tables(spark, folder, tmp_path):
    names = ("drivers", "passengers", "locations", "payment_methods", "promo_codes", "vehicles")
    model = {name: getattr(operational, name)(spark, folder) for name in names}
    every = operational.priced_trips(spark, folder)
    added = facts.run_etl(spark, {**model, "trips": every}, str(tmp_path / "dw"), as_of=AS_OF, first="1995-01-01", last="2001-06-30")
    assert added["fact_trips"] + added["rejected_trips"] == every.count()


def test_a_trip_moved_in_time_is_not_stored_twice(spark, sources, trips, tmp_path):
    root = str(tmp_path / "dw")
    assert run(spark, sources, root, trips(trip(1), trip(2)))["fact_trips"] == 2
    moved = trips(trip(1, at=datetime(2024, 8, 1)), trip(2, at=datetime(2024, 1, 1)), trip(3))
    assert run(spark, sources, root, moved, lookback=timedelta(days=400))["fact_trips"] == 1
    assert rows_of(stored(spark, root, "fact_trips").select("source_trip_id")) == [(1,), (2,), (3,)]
    incremental.load_arriving(trips(trip(2, at=datetime(2024, 9, 1)), trip(4)), 7, root)
    assert stored(spark, root, "fact_trips").count() == 4
    incremental.load_arriving(trips(trip(1)).where("false"), 8, root)


def test_keys_lead_back_to_natural_ids(spark, sources, trips):
    dims = warehouse.build_dimensions(spark, sources, ntz(AS_OF), *CALENDAR)
    dims["dim_driver"] = dims["dim_driver"].withColumn("driver_key", F.col("driver_key") + 70)
    loaded = facts.measures(facts.resolve_keys(trips(trip(1, driver=2), trip(2, pay=None)), dims))
    shown = facts.with_natural_ids(loaded, dims).select("source_trip_id", "driver_key", "passenger_key", "payment_method_key")
    assert rows_of(shown) == [(1, 2, 1, 1), (2, 1, 1, None)]


def test_only_ids_are_moved_to_find_the_facts_that_clash(spark, sources, trips, tmp_path, monkeypatch):
    """The new facts of a load, with clashes or without, are found without a shuffle of whole facts."""
    root, plans = str(tmp_path / "dw"), []
    keep = facts.snapshot

    def planned(df, *name):
        plans.append(plan_of(df))
        return keep(df, *name)

    facts.load_dimensions(spark, sources, root, ntz(AS_OF), *CALENDAR)
    monkeypatch.setattr(facts, "snapshot", planned)
    monkeypatch.setattr(facts, "at_once", lambda *writes: [write() for write in writes])
    later = datetime(2024, 3, 6)
    assert facts.load_slice(spark, trips(*[trip(n) for n in range(1, 20)]), root)["fact_trips"] == 19
    assert facts.load_slice(spark, trips(*[trip(n) for n in range(10, 30)]), root)["fact_trips"] == 10
    assert facts.load_slice(spark, trips(trip(40, at=later), trip(40, base="9.00"), trip(1, at=later)), root)["fact_trips"] == 1
    moves = [plan.count("Exchange hashpartitioning") for plan in plans if PLACE in plan]
    assert moves == [0, 1, 1]  # once ids clash, the rows of repeated ids to be ranked
    loaded = stored(spark, root, "fact_trips")
    assert sorted(row.source_trip_id for row in loaded.collect()) == [*range(1, 30), 40]
    assert str(loaded.where("source_trip_id = 40").first()["base_fare"]) == "9.00"


@pytest.mark.parametrize("sent", [True, False])
def test_settled_facts_match_the_plain_insert(spark, monkeypatch, sent):
    """Repeated, stored and NULL ids, whether the clashing ids are few or many."""
    if not sent:
        monkeypatch.setattr(facts, "BROADCAST_BYTES", 0)
    schema = "source_trip_id long, requested_at timestamp_ntz, base_fare int"
    rows = [(n % 9 if n % 5 else None, AS_OF + timedelta(minutes=n * 7 % 11), n) for n in range(40)] + [(100, AS_OF, 1), (101, AS_OF, 2)]
    batch = spark.createDataFrame(rows, schema)
    held = spark.createDataFrame([(3,), (4,), (100,), (None,)], "source_trip_id long")
    for target in (held, held.where("false"), None):
        clashing = facts.clashes(batch, target)
        got = rows_of(facts.settled(batch, clashing, clashing.count()))
        assert got == rows_of(changes.insert_if_absent(batch, target, ["source_trip_id"], ["requested_at"]))
    unique = batch.where("source_trip_id > 99")
    assert facts.clashes(unique, None).count() == 0 and facts.settled(unique, None, 0) is unique
