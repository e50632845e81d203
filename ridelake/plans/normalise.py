"""From the flat ride table to drivers, passengers, cities, payment methods and trips."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ridelake import schemas
from ridelake.functions.text import clean_name
from ridelake.operators.changes import insert_if_absent
from ridelake.operators.keys import assign_keys, next_free_key
from ridelake.operators.lookups import Size, Step, chain, table_sizes
from ridelake.operators.quality import Batch, load_batch
from ridelake.plans.constraints import NORMALISED_WIDTHS, column_rules, normalised_trip_rules
from ridelake.sources.readers import read_table
from ridelake.sources.writers import create_if_absent, discard, snapshot


@dataclass(frozen=True)
class Names:
    """One name table: its key, its name column, and the ride columns it is fed from."""

    table: str
    key: str
    name: str
    fed_by: tuple[str, ...]
    cleaned: bool
    schema: StructType


NAME_TABLES = (
    Names("drivers", "driver_id", "name", ("driver_name",), True, schemas.DRIVER_NAMES),
    Names("passengers", "passenger_id", "name", ("passenger_name",), True, schemas.PASSENGER_NAMES),
    Names("locations", "location_id", "city_name", ("pickup_city", "dropoff_city"), False, schemas.CITIES),
    Names("payment_methods", "payment_method_id", "name", ("payment_method",), False, schemas.PAYMENT_NAMES),
)


def spellings(rides: DataFrame, names: Names) -> DataFrame:
    """Every spelling that occurs, with the name it stands for.

    Spellings are made distinct first, so cleaning runs once per spelling instead of
    once per ride.
    """
    columns = [rides.select(F.col(column).alias("spelling")) for column in names.fed_by]
    occurring = reduce(DataFrame.union, columns).where(F.col("spelling").isNotNull()).distinct()
    name = clean_name(F.col("spelling")) if names.cleaned else F.col("spelling")
    return occurring.withColumn(names.name, name)


def name_table(spelt: DataFrame, names: Names, existing: DataFrame | None = None) -> DataFrame:
    """Names not stored yet, each with a new id."""
    found = spelt.select(names.name).distinct()
    if existing is None:
        return assign_keys(found, names.key, names.name)
    fresh = insert_if_absent(found, existing, [names.name])
    return assign_keys(fresh, names.key, names.name, next_free_key(existing, names.key))


def spelling_ids(spelt: DataFrame, names: Names, table: DataFrame) -> DataFrame:
    """Spelling to id, the lookup the trips need; a name stored twice keeps its first id."""
    return spelt.join(table.groupBy(names.name).agg(F.min(names.key).alias("id")), names.name).select("spelling", "id")


def id_sizes(spelt: dict[str, DataFrame]) -> dict[str, Size]:
    """What the spelling-to-id tables can measure at most: spelling, name and an id."""
    return table_sizes({table: spellings.withColumn("id", F.lit(0).cast("long")) for table, spellings in spelt.items()})


def normalised_trips(rides: DataFrame, ids: dict[str, DataFrame], sizes: dict[str, Size]) -> DataFrame:
    """Trips by id: four required names, an optional payment method.

    A ride keeps its own id as trip id, which is unique and costs no shuffle.
    """
    roles = (
        ("drivers", "driver_name", "driver_id", "inner"),
        ("passengers", "passenger_name", "passenger_id", "inner"),
        ("locations", "pickup_city", "pickup_location_id", "inner"),
        ("locations", "dropoff_city", "dropoff_location_id", "inner"),
        ("payment_methods", "payment_method", "payment_method_id", "left"),
    )
    steps = [Step(table, column, "spelling", {name: "id"}, how) for table, column, name, how in roles]
    trips = chain(rides, ids, steps, sizes, "ride_id")
    renamed = {"trip_id": "ride_id", "distance_km": "ride_distance_km", "status": "ride_status"}
    return trips.select(*[F.col(renamed.get(name, name)).alias(name) for name in schemas.NORMALISED_TRIPS.names])


def load_normalised(spark: SparkSession, rides: DataFrame, root: str) -> dict[str, int]:
    """Write the name tables, then the trips that point at them; safe to run again.

    Returns the rows added per table. Names are written before trips read them back,
    so the ids a trip carries are the stored ones. A trip that breaks a rule of the
    trips table keeps all trips out.
    """
    added, spelt, ids = {}, {}, {}
    for names in NAME_TABLES:
        path = f"{root}/{names.table}"
        create_if_absent(spark, path, names.schema)
        found = spelt[names.table] = snapshot(spellings(rides, names))
        fresh = schemas.conform(name_table(found, names, read_table(spark, path)), names.schema)
        rules = column_rules(names.schema, NORMALISED_WIDTHS[names.table])
        added[names.table] = load_batch(Batch(fresh, path, names.key, rules))
        ids[names.table] = spelling_ids(found, names, read_table(spark, path))
    path = f"{root}/trips"
    create_if_absent(spark, path, schemas.NORMALISED_TRIPS)
    trips = insert_if_absent(normalised_trips(rides, ids, id_sizes(spelt)), read_table(spark, path), ["trip_id"])
    rows = schemas.conform(trips, schemas.NORMALISED_TRIPS)
    try:
        added["trips"] = load_batch(Batch(rows, path, "trip_id", normalised_trip_rules()))
    finally:
        for found in spelt.values():
            discard(found)
    return added
