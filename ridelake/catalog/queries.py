"""Named queries. Each takes a session and a folder of stored tables and reads whole
tables; decimals leave as doubles and short integers as integers, so that results
compare across engines."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import suppress
from dataclasses import replace
from datetime import datetime, timedelta
from functools import wraps
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, ShortType

from ridelake import schemas
from ridelake.functions import numeric, rules, temporal, text
from ridelake.operators import changes, keys, lookups, quality
from ridelake.plans import constraints, facts, flat, normalise, reports, warehouse
from ridelake.sources import operational, readers, writers
from ridelake.sources.commits import Files, Store
from ridelake.sources import rides as source
from ridelake.sources.stored import stored

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Parameters shared with the SQL check.
AS_OF = datetime(2001, 8, 1)
CALENDAR = ("1995-01-01", "2001-06-30")
LOADED_UNTIL = datetime(2000, 1, 1)


def plain(df: DataFrame) -> DataFrame:
    def column(field):
        if isinstance(field.dataType, DecimalType):
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(field.dataType, ShortType):
            return F.col(field.name).cast("int").alias(field.name)
        return F.col(field.name)

    return df.select(*[column(field) for field in df.schema])


def query(build: Query) -> Query:
    @wraps(build)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return plain(build(spark, folder))

    QUERIES[build.__name__] = run
    return build


def flat_query(name: str, plan: Callable[[DataFrame], DataFrame], *joined: str, status: str | None = None) -> None:
    """Register a plan over flat rides that needs the given joined columns."""

    def build(spark: SparkSession, folder: str) -> DataFrame:
        return plan(source.rides(spark, folder, *joined, status=status))

    build.__name__ = name
    query(build)


BOTH_CITIES = ("pickup_city", "dropoff_city")
NAMES = ("driver_name", "passenger_name")

flat_query("total_rides", flat.total_rides)
flat_query("null_rating_count", flat.null_rating_count)
flat_query("unrated_not_completed", flat.unrated_not_completed)
flat_query("completed_fare_total", flat.completed_fare_total, status="completed")
flat_query("global_stats", flat.global_stats)
flat_query("fare_per_km", flat.fare_per_km, *BOTH_CITIES)
flat_query("status_breakdown", flat.status_breakdown)
flat_query("driver_revenue", flat.driver_revenue, "driver_name")
flat_query("distance_min_max", flat.distance_min_max)
flat_query("status_profile", flat.status_profile, *BOTH_CITIES)
flat_query("having_count", lambda rides: flat.having_count(rides, 50), "driver_name", status="completed")
flat_query("high_value", flat.high_value, "driver_name", "passenger_name", *BOTH_CITIES)
flat_query("recent_completed", flat.recent_completed, status="completed")
flat_query("recent_by_completion", flat.recent_by_completion)
flat_query("latest_row", flat.latest_row, *NAMES, *BOTH_CITIES)
flat_query("same_city", flat.same_city, *BOTH_CITIES)
flat_query("same_city_guarded", flat.same_city_guarded, *BOTH_CITIES)
flat_query("same_city_ci", flat.same_city_ignoring_case, *BOTH_CITIES)
flat_query("same_city_unfulfilled", flat.same_city_unfulfilled, *BOTH_CITIES)
flat_query("like_match", lambda rides: flat.driver_like(rides, "%#00000000%"), "driver_name", "passenger_name")
flat_query("distinct_pickup", flat.distinct_pickup, "pickup_city")
flat_query("distinct_pair", flat.distinct_pair, "driver_name")
flat_query("dim_payment_names", flat.payment_method_names)


# Names and scalar functions


@query
def clean_names(spark, folder):
    return flat.clean_names(source.messy_names(spark, folder), "name")


@query
def count_distinct_clean(spark, folder):
    return flat.count_clean_names(source.messy_names(spark, folder), "name")


@query
def scalar_strings(spark, folder):
    name = F.col("name")
    color = F.col("color")
    return (
        source.messy_names(spark, folder)
        .join(stored(spark, folder, "part"), "p_partkey")
        .withColumn("color", F.when(F.col("p_size") > 25, F.split_part("p_name", F.lit(" "), F.lit(1))))
        .select(
            "p_partkey",
            F.lower(name).alias("lowered"),
            text.title_case(name).alias("titled"),
            F.trim(name).alias("trimmed"),
            text.halve_double_spaces(name).alias("halved"),
            text.squash_spaces(name).alias("squashed"),
            F.split_part(F.trim(name), F.lit(" "), F.lit(2)).alias("second_word"),
            F.split_part(name, F.lit(" "), F.lit(9)).alias("ninth_word"),
            text.concat_skip_null(F.col("p_brand"), color, F.col("p_type")).alias("joined"),
            F.concat(F.col("p_brand"), F.lit(":"), color).alias("piped"),
            text.zero_padded(F.col("p_size"), 4).alias("padded"),
        )
    )


@query
def scalar_dates(spark, folder):
    ts = F.col("ts")
    midnight = ts.cast("date").cast("timestamp_ntz")
    return stored(spark, folder, "events").select(
        "event_id",
        temporal.months_before(ts, 6).alias("half_year_before"),
        temporal.months_before(ts, 24).alias("two_years_before"),
        F.round(temporal.minutes_between(midnight, ts), 6).alias("minutes_today"),
        temporal.date_key(ts).alias("date_key"),
        temporal.year_month(ts).alias("year_month"),
        temporal.month_name(ts).alias("month_name"),
        temporal.day_name(ts).alias("day_name"),
        F.year(ts).alias("year"),
        F.quarter(ts).alias("quarter"),
        F.month(ts).alias("month"),
        temporal.iso_week(ts).alias("iso_week"),
        temporal.day_of_week(ts).alias("day_of_week"),
        temporal.is_weekend(ts).alias("is_weekend"),
        temporal.quarter_hour_key(ts).alias("quarter_hour"),
    )


@query
def scalar_numeric(spark, folder):
    """Both roundings at a true tie, safe division, defaults and casts."""
    total = F.col("o_totalprice").cast("decimal(10,2)")
    half = total / F.lit(2).cast("decimal(1,0)")
    size = (F.col("o_orderkey") % 4).cast("decimal(10,0)")
    paid = F.when(F.col("o_orderstatus") != "P", total)
    return stored(spark, folder, "orders").select(
        "o_orderkey",
        numeric.round_half_up(half, 2).alias("half_up"),
        numeric.round_half_even(half, 2).alias("half_even"),
        (total * F.lit("1.25").cast("decimal(3,2)") + size - F.lit(1)).alias("arithmetic"),
        numeric.percent_of(size, F.lit(4), 2).alias("percent"),
        (total / F.nullif(size, F.lit(0))).cast("decimal(12,2)").isNull().alias("divided_by_zero"),
        numeric.zero_if_null(paid).alias("or_zero"),
        F.when(total > 400000, "high").when(total > 100000, "middle").otherwise("low").alias("band"),
        F.floor(total).cast("int").alias("whole"),
        F.col("o_orderdate").cast("date").alias("day"),
        F.col("o_orderkey").cast("string").alias("as_text"),
    )


@query
def promo_discount(spark, folder):
    trips = operational.priced_trips(spark, folder)
    promos = operational.promo_codes(spark, folder)
    take = {"discount_type": "discount_type", "discount_value": "discount_value"}
    used = lookups.lookup(trips, promos, "promo_code_id", "promo_code_id", take, row_id="trip_id", how="inner")
    worth = rules.promo_discount(F.col("discount_type"), F.col("discount_value"), F.col("base_fare"))
    return used.select("trip_id", "promo_code_id", "base_fare", worth.alias("discount"))


# Set operations


def _city_sides(spark, folder):
    """Passengers' cities against the cities of overdrawn drivers."""
    started = source.rides(spark, folder, "pickup_city").select(F.col("pickup_city").alias("city")).distinct()
    suppliers = stored(spark, folder, "supplier").where(F.col("s_acctbal") < 0)
    reached = suppliers.join(stored(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return started, reached.select(F.col("n_name").alias("city")).distinct()


@query
def union_distinct(spark, folder):
    rides = source.rides(spark, folder, *BOTH_CITIES)
    started = rides.select(F.col("pickup_city").alias("city_name")).distinct()
    return started.union(rides.select("dropoff_city").distinct()).distinct()


@query
def union_all(spark, folder):
    rides = source.rides(spark, folder, *BOTH_CITIES)
    started = rides.select(F.col("pickup_city").alias("city")).distinct()
    return started.union(rides.select("dropoff_city").distinct())


@query
def intersect_cities(spark, folder):
    started, reached = _city_sides(spark, folder)
    return started.intersect(reached)


@query
def except_cities(spark, folder):
    started, reached = _city_sides(spark, folder)
    return started.subtract(reached)


# Normalised trips


@query
def driver_and_status(spark, folder):
    trips = source.trips(spark, folder, places=True, status="completed")
    return trips.where((F.col("driver_id") == 3) & (F.col("status") == "completed"))


@query
def driver_trips(spark, folder):
    return source.trips(spark, folder, places=True).where(F.col("driver_id") == 3)


@query
def status_trips(spark, folder):
    return source.trips(spark, folder, places=True, status="cancelled").where(F.col("status") == "cancelled")


@query
def delete_by_predicate(spark, folder):
    return changes.delete_where(source.trips(spark, folder, places=True), F.col("rating") > 3)


@query
def case_flag(spark, folder):
    """Every driver with every trip, a driver without trips once; the flag comes first."""
    trips, drivers = source.trips(spark, folder, places=True), source.driver_names(spark, folder)
    return reports.flagged_trips(drivers, trips)


@query
def join_inner(spark, folder):
    trips, drivers = source.trips(spark, folder), source.driver_names(spark, folder)
    joined = lookups.lookup(trips, drivers, "driver_id", "driver_id", {"driver_name": "name"}, row_id="trip_id", how="inner")
    return joined.select("trip_id", "driver_id", "driver_name", "status")


@query
def tagged_counts(spark, folder):
    """Row counts of the flat and the normalised side, and of the people behind them."""
    sides = {
        "rides": source.rides(spark, folder),
        "trips": source.trips(spark, folder),
        "drivers": source.driver_names(spark, folder),
        "passengers": source.passenger_names(spark, folder),
    }
    tagged = [df.agg(flat.rows("row_count")).select(F.lit(name).alias("tbl"), "row_count") for name, df in sides.items()]
    first, *others = tagged
    for other in others:
        first = first.union(other)
    return first


@query
def completed_trips_view(spark, folder):
    view = reports.completed_trips(
        source.trips(spark, folder, places=True, status="completed"),
        source.driver_names(spark, folder),
        source.passenger_names(spark, folder),
        source.cities(spark, folder),
        source.payment_names(spark, folder),
    )
    return writers.named_view(view, "completed_trips_view")


@query
def temp_snapshot(spark, folder):
    """A frozen copy of all rides, every column."""
    return writers.snapshot(source.rides(spark, folder, *NAMES, *BOTH_CITIES), "temp_rides")


@query
def inline_values(spark, folder):
    """The payment methods in use plus one entered by hand."""
    known = source.payment_names(spark, folder).select("name")
    entered = readers.inline_rows(spark, [("IME pay5",)], schemas.table(("name", schemas.TEXT)))
    return changes.insert_rows(known.withColumn("payment_method_id", F.substring("name", 1, 1)), entered)


@query
def conditional_update(spark, folder):
    rides = source.rides(spark, folder, "driver_name")
    updated = flat.with_phone_numbers(rides, "%#00000000%", "987654321", "9876543210", 1000)
    return updated.groupBy("driver_name", "phone_number").agg(flat.rows("rides"))


@query
def driver_summary(spark, folder):
    return reports.driver_summary(source.trips(spark, folder), source.driver_names(spark, folder))


@query
def driver_cancellation(spark, folder):
    return reports.driver_cancellation(source.trips(spark, folder), source.driver_names(spark, folder))


@query
def driver_completed_rides(spark, folder):
    return reports.driver_completed_rides(source.trips(spark, folder, status="completed"), source.driver_names(spark, folder))


@query
def running_fare(spark, folder):
    return reports.running_fare(source.trips(spark, folder, status="completed"), source.driver_names(spark, folder))


@query
def anti_not_in(spark, folder):
    done = source.trips(spark, folder, status="completed")
    return lookups.not_in(source.passenger_names(spark, folder), "passenger_id", done, "passenger_id")


@query
def anti_left(spark, folder):
    done = source.trips(spark, folder, status="completed")
    return lookups.without_match(source.passenger_names(spark, folder), "passenger_id", done, "passenger_id")


@query
def scalar_lookup(spark, folder):
    """Passenger ids found by cleaned name, from hand-typed names; each spelling is cleaned and looked up once."""
    rides = source.messy_rides(spark, folder).select("ride_id", "passenger_name")
    (names,) = [names for names in normalise.NAME_TABLES if names.table == "passengers"]
    spelt = normalise.spellings(rides, names)
    known = source.passenger_names(spark, folder).withColumn("name", F.replace("name", F.lit("#"), F.lit(" ")))
    found = lookups.one_value_lookup(spelt, known, "name", "name", "passenger_id", "passenger_id", row_id="spelling")
    found = writers.snapshot(found.select("spelling", "name", "passenger_id"))
    shown = lookups.lookup(
        rides, found, "passenger_name", "spelling", {"clean": "name", "passenger_id": "passenger_id"}, row_id="ride_id"
    )
    return shown.select("ride_id", F.col("clean").alias("passenger_name"), "passenger_id")


@query
def normalize_trips(spark, folder):
    """Hand-typed flat rides, stored once, to trips by id, shown by name again."""
    rides = writers.snapshot(source.messy_rides(spark, folder))
    spelt = {names.table: writers.snapshot(normalise.spellings(rides, names)) for names in normalise.NAME_TABLES}
    tables = {names.table: normalise.name_table(spelt[names.table], names) for names in normalise.NAME_TABLES}
    ids = {names.table: normalise.spelling_ids(spelt[names.table], names, tables[names.table]) for names in normalise.NAME_TABLES}
    sizes = normalise.id_sizes(spelt)
    trips = normalise.normalised_trips(rides, ids, sizes)
    steps = (
        lookups.Step("drivers", "driver_id", "driver_id", {"driver_name": "name"}),
        lookups.Step("passengers", "passenger_id", "passenger_id", {"passenger_name": "name"}),
        lookups.Step("locations", "pickup_location_id", "location_id", {"pickup_city": "city_name"}),
        lookups.Step("locations", "dropoff_location_id", "location_id", {"dropoff_city": "city_name"}),
        lookups.Step("payment_methods", "payment_method_id", "payment_method_id", {"payment_method": "name"}),
    )
    shown = lookups.chain(trips, tables, steps, sizes, "trip_id")
    return shown.drop("driver_id", "passenger_id", "pickup_location_id", "dropoff_location_id", "payment_method_id")


# Sources and sinks


def _scratch(spark: SparkSession, name: str) -> str:
    """A path of its own in a folder of its own, so that no other load has to do with its commits."""
    return f"{writers.own_folder(spark, name)}/{name}"


@query
def csv_load(spark, folder):
    """All rides written as delimited text and loaded again through the checked bulk load."""
    rides = source.rides(spark, folder, *NAMES, *BOTH_CITIES).select(*schemas.RIDES.names)
    text_files, table = _scratch(spark, "rides-csv"), _scratch(spark, "rides")
    rides.write.option("header", True).option("nullValue", "").csv(text_files)
    loaded = constraints.load_rides(spark, text_files, table)
    stored_rides = readers.read_table(spark, table, schemas.RIDES)
    return stored_rides.withColumn("rows_loaded", F.lit(loaded)).orderBy("ride_id")


@query
def csv_empty_text(spark, folder):
    """Empty text and NULL stay apart after a load."""
    part = stored(spark, folder, "part")
    names = part.select("p_partkey", F.when(F.col("p_size") > 25, F.lit("")).when(F.col("p_size") > 5, F.col("p_name")).alias("note"))
    files = _scratch(spark, "notes")
    names.write.option("header", True).option("nullValue", "-").csv(files)
    kinds = schemas.table(("p_partkey", schemas.LONG), ("note", schemas.TEXT))
    loaded = spark.read.schema(kinds).csv(files, header=True, nullValue="-", mode="FAILFAST")
    return loaded.groupBy((F.col("note") == "").alias("is_empty")).agg(F.count(F.lit(1)).alias("parts"))


@query
def append_select(spark, folder):
    """Completed, then cancelled trips appended to a table that is created once; each append tells its rows."""
    trips, path = source.trips(spark, folder), _scratch(spark, "appended")
    added = {}
    for status in ("completed", "cancelled"):
        writers.create_if_absent(spark, path, trips.schema)
        added[status] = writers.append(trips.where(F.col("status") == status), path)
    counted = F.when(F.col("status") == "completed", added["completed"]).otherwise(added["cancelled"])
    return readers.read_table(spark, path, trips.schema).withColumn("rows_added", counted.cast("long"))


@query
def replace_table(spark, folder):
    """A table of all trips replaced by its own completed ones."""
    trips, path = source.trips(spark, folder), _scratch(spark, "replaced")
    writers.replace(trips, path)
    writers.replace(readers.read_table(spark, path, trips.schema).where(F.col("status") == "completed"), path)
    return readers.read_table(spark, path, trips.schema)


def _after_delete(spark, folder, table, condition):
    names = ("vehicles", "drivers", "payment_methods", "promo_codes", "vehicle_assignments", "trip_cancellations")
    tables = {name: getattr(operational, name)(spark, folder) for name in names}
    tables["trips"] = operational.priced_trips(spark, folder)
    return changes.delete_with_children(tables, constraints.ON_DELETE, table, condition)


@query
def delete_set_null(spark, folder):
    """Trips after the payment methods no longer in use were deleted: they stay and lose the method."""
    left = _after_delete(spark, folder, "payment_methods", ~F.col("is_active"))
    return left["trips"]


@query
def delete_cascade(spark, folder):
    """Cancellations after all trips of one driver were deleted, and assignments after all suspended drivers were."""
    trips = _after_delete(spark, folder, "trips", F.col("driver_id") == 3)
    people = _after_delete(spark, folder, "drivers", F.col("status") == "suspended")
    cancelled = trips["trip_cancellations"].select(F.lit("trip_cancellations").alias("tbl"), F.col("trip_id").alias("id"))
    assigned = people["vehicle_assignments"].select(F.lit("vehicle_assignments").alias("tbl"), F.col("driver_id").alias("id"))
    return cancelled.unionByName(assigned).groupBy("tbl", "id").agg(flat.rows("n"))


@query
def defaulted_rows(spark, folder):
    """Trips inserted without their money columns take the declared defaults; every column."""
    bare = operational.priced_trips(spark, folder).drop("tip_amount", "discount_amount", "surge_multiplier")
    return changes.with_defaults(bare, constraints.defaults("trips"))


@query
def inline_lookup(spark, folder):
    """Hand-entered trips whose ids come from scalar lookups by name, next to the passengers' ride counts."""
    entered = readers.inline_rows(
        spark,
        [(1, "Customer#000000001"), (2, "Customer#000000002"), (3, "Nobody")],
        schemas.table(("line", schemas.INT), ("typed", schemas.TEXT)),
    )
    known = source.passenger_names(spark, folder)
    found = lookups.one_value_lookup(entered, known, "typed", "name", "passenger_id", "passenger_id", row_id="line")
    rides = source.trips(spark, folder).groupBy("passenger_id").agg(F.count(F.lit(1)).alias("trips"))
    return found.join(rides, "passenger_id", "left").select("line", "typed", "passenger_id", "trips")


@query
def current_moment(spark, folder):
    """Rides against the clock: how many were requested before now, and how many in the last six months."""
    now = F.current_timestamp().cast("timestamp_ntz")
    past = F.col("requested_at") < now
    recent = past & (F.col("requested_at") >= temporal.months_before(now, 6))
    return source.rides(spark, folder).agg(F.count_if(past).alias("past"), F.count_if(recent).alias("recent"))


@query
def surrogate_keys(spark, folder):
    """Keys of two loads of trips: how many rows, how many keys, and whether any key came twice or below the first load's."""
    rows = source.trips(spark, folder).select("trip_id", "status")
    first = writers.snapshot(keys.assign_keys(rows.where(F.col("status") == "completed"), "trip_key", "trip_id"))
    later = keys.parallel_keys(rows.where(F.col("status") != "completed"), "trip_key", keys.next_free_key(first, "trip_key"))
    tagged = first.withColumn("load", F.lit(1)).unionByName(later.withColumn("load", F.lit(2)))
    highest = first.agg(F.max("trip_key")).scalar()
    clash = F.count_if((F.col("load") == 2) & (F.col("trip_key") <= highest))
    return tagged.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("trip_key").alias("keys"), clash.alias("clashes"))


# Checks


@query
def dq_not_null(spark, folder):
    trips = source.faulty_trips(spark, folder)
    return quality.rule_report(trips, [quality.not_null(c) for c in ("driver_id", "status", "requested_at", "completed_at")], "trip_id")


@query
def dq_ranges(spark, folder):
    trips = source.faulty_trips(spark, folder)
    checks = [quality.above("fare_amount", 0), quality.at_least("distance_km", 0.5), quality.between("rating", 1, 5)]
    return quality.rule_report(trips, checks, "trip_id")


@query
def dq_enum(spark, folder):
    trips = source.faulty_trips(spark, folder)
    return quality.rule_report(trips, [quality.one_of("status", rules.RIDE_STATUSES)], "trip_id")


@query
def dq_completed_at(spark, folder):
    """Trips that break a rule spanning several columns, with the rules' names."""
    status = F.col("status")
    timed = quality.check("completed_has_time", ((status == "completed") & F.col("completed_at").isNotNull()) | (status != "completed"))
    later = quality.check("completed_after_request", F.col("completed_at").isNull() | (F.col("completed_at") > F.col("requested_at")))
    _, broken = quality.split_by_rules(source.faulty_trips(spark, folder), [timed, later])
    return broken.select("trip_id", F.array_join("failed_rules", ",").alias("failed"))


@query
def dq_width(spark, folder):
    part = stored(spark, folder, "part")
    checks = [quality.max_length("p_name", 9), quality.fits("p_retailprice", "decimal(5,2)"), quality.fits("p_size", "decimal(1,0)")]
    return quality.rule_report(part, checks, "p_partkey")


@query
def dq_duplicate_keys(spark, folder):
    return quality.duplicate_keys(stored(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def dq_one_current(spark, folder):
    """Vehicles with more than one open assignment."""
    return quality.duplicate_keys(operational.vehicle_assignments(spark, folder), ["vehicle_id"], F.col("unassigned_at").isNull())


@query
def dq_orphans(spark, folder):
    trips = operational.priced_trips(spark, folder)
    links = (
        ("vehicle_id", operational.vehicles(spark, folder), "vehicle_id"),
        ("pickup_location_id", operational.locations(spark, folder), "location_id"),
        ("promo_code_id", operational.promo_codes(spark, folder), "promo_code_id"),
    )
    first, *others = [
        quality.orphan_keys(trips, column, parent, key, "trip_id").withColumn("foreign_key", F.lit(column))
        for column, parent, key in links
    ]
    for other in others:
        first = first.unionByName(other)
    return first


@query
def dq_state_probe(spark, folder):
    return flat.state_probe(source.faulty_trips(spark, folder))


@query
def batch_gate(spark, folder):
    """What keeps a damaged feed out: every constraint, its violations, the first row."""
    trips = source.faulty_trips(spark, folder)
    return quality.batch_report(
        trips,
        "trip_id",
        [quality.not_null("status"), quality.one_of("status", rules.RIDE_STATUSES), quality.above("fare_amount", 0), quality.between("rating", 1, 5)],
        [quality.Unique(("trip_id",)), quality.Unique(("passenger_id", "requested_at"))],
        [quality.References("driver_id", source.driver_names(spark, folder), "driver_id")],
    )


@query
def batch_gate_stored(spark, folder):
    """What a second feed breaks against the trips stored by the first: their keys are taken."""
    trips = source.trips(spark, folder)
    path = _scratch(spark, "gated")
    writers.append(trips.where(F.col("status") == "completed"), path)
    gate = quality.Batch(trips, path, "trip_id", unique=[quality.Unique(("trip_id",)), quality.Unique(("passenger_id", "requested_at"))])
    return quality.batch_report(gate.rows, gate.row_id, gate.rules, gate.unique, gate.references, gate.stored())


@query
def dq_declared(spark, folder):
    """Declared constraints that the stored trips and vehicles break."""
    sides = _sources(spark, folder)
    tables = {"trips": (operational.priced_trips(spark, folder), "trip_id"), "vehicles": (sides["vehicles"], "vehicle_id")}
    reports_by_table = [
        quality.batch_report(rows, row_id, **constraints.operational_constraints(table, sides)).withColumn("tbl", F.lit(table))
        for table, (rows, row_id) in tables.items()
    ]
    trips, vehicles = reports_by_table
    return trips.unionByName(vehicles).where(F.col("violations") > 0)


@query
def insert_if_absent(spark, folder):
    """Order lines added to those shipped before 1998, first shipment per line winning."""
    lines = stored(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity")
    present = lines.where(F.col("l_shipdate") < temporal.ntz("1998-01-01 00:00:00"))
    return changes.insert_if_absent(lines, present, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


# Warehouse


def _sources(spark, folder):
    return {
        name: getattr(operational, name)(spark, folder)
        for name in ("drivers", "passengers", "locations", "payment_methods", "promo_codes", "vehicles")
    }


#: Warehouses this process has loaded: where, by session, source folder and the state of its files.
_LOADED: dict[tuple, str] = {}
_LOADING = Lock()


def _warehouse(spark: SparkSession, folder: str) -> Store:
    """The warehouse over a folder's tables, loaded through the ETL by the first query of the session that asks for it.

    Two loads: the trips before 2000, then all from the mark on. The calendar ends before
    the last trips on purpose: those are rejected for their date.
    """
    tables = ("orders", "customer", "supplier", "nation", "part")
    files = Files(spark, folder)
    states = [files.system.getFileStatus(files.path(f"{table}.parquet")).getModificationTime() for table in tables]
    key = (spark.sparkContext.applicationId, folder, *states)
    with _LOADING:
        if key not in _LOADED:
            root = _scratch(spark, "warehouse")
            sources = _sources(spark, folder)
            trips = operational.priced_trips(spark, folder)
            facts.load_dimensions(spark, sources, root, temporal.ntz(AS_OF), *CALENDAR)
            facts.load_facts(spark, trips.where(F.col("requested_at") < temporal.ntz(LOADED_UNTIL)), root, batch=1)
            facts.load_facts(spark, trips, root, batch=2)
            _LOADED[key] = root
    return Store(spark, _LOADED[key])


def _dimension_query(dim: warehouse.Dimension) -> None:
    def build(spark: SparkSession, folder: str) -> DataFrame:
        rows = _warehouse(spark, folder).read(dim.table)
        distinct = rows.agg(F.count_distinct(dim.key)).scalar()  # the keys themselves depend on how rows were dealt out
        return rows.select(*[c for c in rows.columns if c != dim.key], distinct.alias("n_keys"))

    build.__name__ = dim.table
    query(build)


for _dim in warehouse.DIMENSIONS:
    _dimension_query(_dim)


@query
def dim_date(spark, folder):
    """The calendar of the days on which rides were ordered, first to last."""
    return warehouse.dates_spanning(stored(spark, folder, "orders"), "o_orderdate")


@query
def dim_time(spark, folder):
    """The clock with the number of events in each quarter hour."""
    events = stored(spark, folder, "events")
    seen = events.groupBy(temporal.quarter_hour_key(F.col("ts")).alias("time_key")).agg(flat.rows("events"))
    return warehouse.dim_time(spark).join(seen, "time_key", "left").fillna(0, ["events"])


@query
def fact_key_resolution(spark, folder):
    """Trips per outcome of the key lookup: the facts that the daily sums count, and every reject once."""
    store = _warehouse(spark, folder)
    accepted = reports.sums_by(store.read("daily_sums"), "time_key").select(F.lit("accepted").alias("outcome"), "trips")
    rejected = store.read("rejected_arrivals").dropDuplicates(["trip_id"])
    rejected = rejected.select(F.col("reject_reason").alias("outcome"), F.lit(1).cast("long").alias("trips"))
    return accepted.unionByName(rejected).groupBy("outcome").agg(F.sum("trips").alias("trips"))


@query
def fact_trips(spark, folder):
    """Stored facts; every surrogate key is traced back to the natural id its dimension row has."""
    store = _warehouse(spark, folder)
    record = store.record()
    dims = {link.table: store.read(link.table, record=record) for link in facts.LINKS}
    loaded = store.read("fact_trips", record=record).drop("trip_key")
    return facts.with_natural_ids(loaded, dims, facts.key_sizes(record))


@query
def v_trips(spark, folder):
    trips, cancelled = operational.priced_trips(spark, folder), operational.trip_cancellations(spark, folder)
    return writers.named_view(reports.trips_view(trips, cancelled), "v_trips")


@query
def promo_usage(spark, folder):
    return reports.promo_usage(operational.promo_codes(spark, folder), operational.priced_trips(spark, folder))


@query
def watermark(spark, folder):
    """The mark of the loaded warehouse, and of one that has only its dimensions."""
    store = _warehouse(spark, folder)
    record = store.record()
    empty = replace(record, marks={})
    mark = facts.high_water_mark(store.read("fact_trips", record=record), record).select(F.lit("loaded").alias("warehouse"), "watermark")
    return mark.union(facts.high_water_mark(store.read("fact_trips", record=record), empty).select(F.lit("empty"), "watermark"))


@query
def incremental_slice(spark, folder):
    """Trips the second load added to a warehouse that held everything before 2000."""
    store = _warehouse(spark, folder)
    fresh = store.added("fact_trips", store.record().load)
    return fresh.select("source_trip_id", "requested_at", "date_key", "fare_amount")


@query
def reloaded_facts(spark, folder):
    """A warehouse after two feeds: two trips of three, then all of them, some moved to a later time and some a year back.

    The second feed, read back over all time, adds the third of the trips that was held back
    and nothing else, whatever time it claims.
    """
    trips, number = operational.priced_trips(spark, folder), F.col("trip_id")
    shift = F.when(number % 5 == 0, temporal.days(40)).when(number % 7 == 0, temporal.days(-365)).otherwise(temporal.days(0))
    again = trips.withColumns({at: F.col(at) + shift for at in ("requested_at", "completed_at")})
    root = _scratch(spark, "reloaded")
    facts.load_dimensions(spark, _sources(spark, folder), root, temporal.ntz(AS_OF), *CALENDAR)
    facts.load_facts(spark, trips.where(number % 3 != 0), root)
    facts.load_facts(spark, again, root, lookback=timedelta(days=36_500))
    return Store(spark, root).read("fact_trips").select("source_trip_id", "requested_at", "date_key", "fare_amount")


@query
def crash_between_tables(spark, folder):
    """Drivers and their trips committed together, then a second load that dies between its two tables: rows per table and load.

    The rows of the second load are staged for one table and never seen.
    """
    trips, people = source.trips(spark, folder), source.driver_names(spark, folder)
    store = Store(spark, _scratch(spark, "two-tables"))
    half = F.col("driver_id") % 2
    with store.load() as load:
        load.append("drivers", people.where(half == 0))
        load.append("trips", trips.where(half == 0))
    with suppress(InterruptedError), store.load() as load:
        load.append("drivers", people.where(half == 1))
        raise InterruptedError("the session is lost")
    seen = [
        store.read(table).groupBy(F.lit(table).alias("tbl"), half.cast("int").alias("half")).agg(flat.rows("n"))
        for table in ("drivers", "trips")
    ]
    return seen[0].unionByName(seen[1])


def _sums(spark, folder, *tables):
    """The daily sums that the loads kept, and some dimensions."""
    store = _warehouse(spark, folder)
    record = store.record()
    return [store.read(table, record=record) for table in ("daily_sums", *tables)]


@query
def revenue_city_month(spark, folder):
    return reports.city_months(*_sums(spark, folder, "dim_location", "dim_date"))


@query
def revenue_city_month_oltp(spark, folder):
    return reports.revenue_by_city_month_operational(operational.priced_trips(spark, folder), operational.locations(spark, folder))


@query
def revenue_by_method(spark, folder):
    return reports.method_totals(*_sums(spark, folder, "dim_payment_method"))


@query
def avg_fare_method_month(spark, folder):
    return reports.method_months(*_sums(spark, folder, "dim_payment_method", "dim_date"))


@query
def busiest_hour(spark, folder):
    return reports.hours(*_sums(spark, folder, "dim_time"))
