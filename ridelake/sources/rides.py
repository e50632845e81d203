"""The flat ride table and its normalised form, projected from the stored tables.

An order is a ride, its customer the passenger, a supplier the driver, and their
nations the two cities. Only the joins a caller asks for are made.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.operators.lookups import lookup
from ridelake.sources.stored import stored, stored_sizes

# Fixed values of the projection.
STATUS_OF = {"F": "completed", "O": "cancelled", "P": "no_show"}
NO_PAYMENT = "4-NOT SPECIFIED"


@dataclass(frozen=True)
class Role:
    """One side of a ride: the stored table of its people and what rides show of them."""

    table: str
    key: str
    name: str
    nation: str
    ride_key: str
    ride_name: str
    ride_city: str
    location: str


ROLES = (
    Role("supplier", "s_suppkey", "s_name", "s_nationkey", "driver_id", "driver_name", "dropoff_city", "dropoff_location_id"),
    Role("customer", "c_custkey", "c_name", "c_nationkey", "passenger_id", "passenger_name", "pickup_city", "pickup_location_id"),
)


def minutes(number: Column) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), number.cast("int"))


def ride_columns(orders: DataFrame, drivers: Column) -> DataFrame:
    """Everything about a ride that its order row alone tells.

    ``drivers`` is how many drivers there are; rides are dealt out among them.
    """
    key = F.col("o_orderkey")
    completed, cancelled = (F.col("o_orderstatus") == code for code in ("F", "O"))
    status = F.when(completed, STATUS_OF["F"]).when(cancelled, STATUS_OF["O"]).otherwise(STATUS_OF["P"])
    requested_at = F.col("o_orderdate") + minutes((key * 37) % 1440)
    return orders.select(
        key.alias("ride_id"),
        (key % drivers).alias("driver_id"),
        F.col("o_custkey").alias("passenger_id"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("fare_amount"),
        ((10 + key % 440) / 10).cast("decimal(6,2)").alias("ride_distance_km"),
        status.alias("ride_status"),
        requested_at.alias("requested_at"),
        F.when(completed, requested_at + minutes(8 + key % 83)).alias("completed_at"),
        F.when(completed & (key % 5 != 0), ((2 + key % 9) / 2).cast("decimal(2,1)")).alias("rating"),
        F.nullif(F.col("o_orderpriority"), F.lit(NO_PAYMENT)).alias("payment_method"),
    )


def counted(table: DataFrame) -> Column:
    """Row count as a scalar subquery: nothing runs unless the value is used."""
    return table.agg(F.count(F.lit(1))).scalar()


def orders_with(spark: SparkSession, folder: str, status: str | None) -> DataFrame:
    """Orders, narrowed by a predicate on the stored code so that it reaches the scan."""
    orders = stored(spark, folder, "orders")
    if status is None:
        return orders
    (code,) = [code for code, name in STATUS_OF.items() if name == status]
    return orders.where(F.col("o_orderstatus") == code)


def rides(spark: SparkSession, folder: str, *joined: str, status: str | None = None) -> DataFrame:
    """Flat rides; ``joined`` names the person and city columns wanted as well.

    Every ride is there whichever columns are asked for: one whose driver, passenger or city is
    not stored has no name for it.
    """
    base = ride_columns(orders_with(spark, folder, status), counted(stored(spark, folder, "supplier")))
    wanted = {role: [c for c in (role.ride_name, role.ride_city) if c in joined] for role in ROLES}
    columns = {role.table: (role.key, role.name, role.nation) for role in ROLES if wanted[role]}
    if {role.ride_city for role in ROLES} & set(joined):
        columns["nation"] = ("n_nationkey", "n_name")
    sides = {table: stored(spark, folder, table).select(*named) for table, named in columns.items()}
    sizes = stored_sizes(spark, folder, columns)

    flat = base
    for role, columns in wanted.items():
        take = {column: role.name if column == role.ride_name else role.nation for column in columns}
        if take:
            flat = lookup(
                flat, sides[role.table], role.ride_key, role.key, take,
                row_id="ride_id", size=sizes[role.table], keys_from=base,
            )
        if role.ride_city in take:
            flat = lookup(
                flat, sides["nation"], role.ride_city, "n_nationkey", {"city": "n_name"},
                row_id="ride_id", size=sizes["nation"],
            ).drop(role.ride_city).withColumnRenamed("city", role.ride_city)
    plain = [c for c in base.columns if c not in ("ride_id", "driver_id", "passenger_id")]
    return flat.select("ride_id", *joined, *plain)


def messy_rides(spark: SparkSession, folder: str) -> DataFrame:
    """Flat rides whose names were typed by hand: case, spacing and padding vary."""
    flat = rides(spark, folder, "driver_name", "passenger_name", "pickup_city", "dropoff_city")
    dirtied = {name: _dirtied(F.replace(F.col(name), F.lit("#"), F.lit(" ")), F.col("ride_id")) for name in ("driver_name", "passenger_name")}
    return flat.withColumns(dirtied)


def messy_names(spark: SparkSession, folder: str) -> DataFrame:
    """Part names spelt three ways, as a name column to clean."""
    part = stored(spark, folder, "part")
    return part.select("p_partkey", _dirtied(F.col("p_name"), F.col("p_partkey")).alias("name"))


def _dirtied(name: Column, number: Column) -> Column:
    return (
        F.when(number % 3 == 0, F.upper(name))
        .when(number % 3 == 1, F.replace(name, F.lit(" "), F.lit("  ")))
        .otherwise(F.concat(F.lit(" "), name, F.lit(" ")))
    )


def driver_names(spark: SparkSession, folder: str) -> DataFrame:
    return stored(spark, folder, "supplier").select(F.col("s_suppkey").alias("driver_id"), F.col("s_name").alias("name"))


def passenger_names(spark: SparkSession, folder: str) -> DataFrame:
    return stored(spark, folder, "customer").select(F.col("c_custkey").alias("passenger_id"), F.col("c_name").alias("name"))


def cities(spark: SparkSession, folder: str) -> DataFrame:
    return stored(spark, folder, "nation").select(
        F.col("n_nationkey").cast("long").alias("location_id"), F.col("n_name").alias("city_name")
    )


def payment_number(name: Column) -> Column:
    """Payment methods are named ``1-…`` to ``5-…``; the digit is their id."""
    return F.substring(name, 1, 1).cast("long")


def payment_names(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct payment methods of all rides, without the missing one."""
    used = stored(spark, folder, "orders").select("o_orderpriority").distinct()
    named = used.where(F.col("o_orderpriority") != NO_PAYMENT)
    return named.select(payment_number(F.col("o_orderpriority")).alias("payment_method_id"), F.col("o_orderpriority").alias("name"))


def trips(spark: SparkSession, folder: str, places: bool = False, status: str | None = None) -> DataFrame:
    """Rides by id instead of by name; location ids only on request (two joins), null for people who are not stored."""
    base = flat = ride_columns(orders_with(spark, folder, status), counted(stored(spark, folder, "supplier")))
    if places:
        columns = {role.table: (role.key, role.nation) for role in ROLES}
        people = {table: stored(spark, folder, table).select(*named) for table, named in columns.items()}
        sizes = stored_sizes(spark, folder, columns)
        for role in ROLES:
            take = {role.location: F.col(role.nation).cast("long")}
            flat = lookup(
                flat, people[role.table], role.ride_key, role.key, take,
                row_id="ride_id", size=sizes[role.table], keys_from=base,
            )
    located = ["pickup_location_id", "dropoff_location_id"] if places else []
    return flat.select(
        F.col("ride_id").alias("trip_id"),
        "driver_id",
        "passenger_id",
        *located,
        "fare_amount",
        F.col("ride_distance_km").alias("distance_km"),
        F.col("ride_status").alias("status"),
        "requested_at",
        "completed_at",
        "rating",
        payment_number(F.col("payment_method")).alias("payment_method_id"),
    )


def faulty_trips(spark: SparkSession, folder: str) -> DataFrame:
    """All trips, some of them damaged in the ways a careless feed damages them."""
    whole = trips(spark, folder)
    number, done = F.col("trip_id"), F.col("status") == "completed"
    return whole.withColumns(
        {
            "rating": F.when(number % 97 == 0, F.lit("99.0").cast("decimal(4,1)")).otherwise(F.col("rating")),
            "fare_amount": F.when(number % 79 == 0, -F.col("fare_amount")).otherwise(F.col("fare_amount")),
            "driver_id": F.when(number % 89 == 0, F.lit(-1)).otherwise(F.col("driver_id")),
            "completed_at": F.when(done & (number % 71 == 0), F.lit(None))
            .when(~done & (number % 73 == 0), F.col("requested_at"))
            .otherwise(F.col("completed_at")),
            "status": F.when(number % 101 == 0, F.lit(None))
            .when(number % 103 == 0, F.lit("pending"))
            .otherwise(F.col("status")),
        }
    )
