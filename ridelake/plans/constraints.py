"""Declared constraints of every table, as checks for a batch load.

Each function returns the keyword arguments of a ``Batch``: row rules, unique keys
and references. Rules that compare a column read it through ``try_cast``, so they hold
for wide or textual input as well; what does not survive the cast breaks its own rule.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ridelake import schemas
from ridelake.functions import rules as model
from ridelake.operators.changes import Pointer
from ridelake.operators.quality import Batch, References, Rule, Unique, check, fits, load_batch, max_length, not_null, one_of
from ridelake.sources.readers import read_delimited_wide

# Declared widths of the text columns.
RIDE_WIDTHS = {
    "driver_name": 100, "passenger_name": 100, "pickup_city": 100, "dropoff_city": 100,
    "ride_status": 50, "payment_method": 50,
}
NORMALISED_WIDTHS = {
    "drivers": {"name": 100}, "passengers": {"name": 100}, "locations": {"city_name": 100},
    "payment_methods": {"name": 30}, "trips": {"status": 50},
}
WIDTHS = {
    "locations": {"city_name": 100, "state_province": 100, "country": 100},
    "drivers": {"name": 100, "email": 150, "phone_number": 20, "status": 20},
    "driver_licenses": {"license_number": 50},
    "passengers": {"name": 100, "email": 150, "phone_number": 20, "status": 20},
    "payment_methods": {"name": 30, "type": 20},
    "vehicles": {"plate_number": 20, "make": 50, "model": 50, "color": 30, "category": 20},
    "vehicle_assignments": {},
    "promo_codes": {"code": 30, "discount_type": 10},
    "trips": {"status": 20},
    "trip_cancellations": {"cancelled_by": 10, "cancellation_reason": 100},
}

SCHEMAS = {
    "locations": schemas.LOCATIONS,
    "drivers": schemas.DRIVERS,
    "driver_licenses": schemas.DRIVER_LICENSES,
    "passengers": schemas.PASSENGERS,
    "payment_methods": schemas.PAYMENT_METHODS,
    "vehicles": schemas.VEHICLES,
    "vehicle_assignments": schemas.VEHICLE_ASSIGNMENTS,
    "promo_codes": schemas.PROMO_CODES,
    "trips": schemas.TRIPS,
    "trip_cancellations": schemas.TRIP_CANCELLATIONS,
}


def column_rules(schema: StructType, widths: Mapping[str, int]) -> list[Rule]:
    """What the column list alone demands: presence, type and width."""
    required = [not_null(field.name) for field in schema if not field.nullable]
    typed = [fits(field.name, field.dataType) for field in schema if not isinstance(field.dataType, StringType)]
    return required + typed + [max_length(name, width) for name, width in widths.items()]


def _value(schema: StructType):
    """A column as its declared type, NULL where it does not fit."""
    return lambda name: F.col(name).try_cast(schema[name].dataType)


def _stars(value: Column) -> Column:
    return value.between(1, 5)


def _both(earlier: Column, later: Column) -> Column:
    """In order if both are known; unknown passes."""
    return earlier < later


def ride_constraints() -> dict:
    value = _value(schemas.RIDES)
    return {
        "rules": [
            *column_rules(schemas.RIDES, RIDE_WIDTHS),
            check("fare_amount_min", value("fare_amount") >= 0),
            check("ride_distance_km_min", value("ride_distance_km") >= 0),
            one_of("ride_status", model.RIDE_STATUSES),
            check("rating_range", _stars(value("rating"))),
        ],
        "unique": [Unique(("ride_id",))],
    }


def normalised_trip_rules() -> list[Rule]:
    """Stricter than for flat rides: a trip's fare is above zero."""
    value = _value(schemas.NORMALISED_TRIPS)
    return [
        *column_rules(schemas.NORMALISED_TRIPS, NORMALISED_WIDTHS["trips"]),
        check("fare_amount_above", value("fare_amount") > 0),
        one_of("status", model.RIDE_STATUSES),
        check("rating_range", _stars(value("rating"))),
    ]


def normalised_trip_constraints(tables: Mapping[str, DataFrame]) -> dict:
    return {
        "rules": normalised_trip_rules(),
        "unique": [Unique(("trip_id",))],
        "references": [
            References("driver_id", tables["drivers"], "driver_id"),
            References("passenger_id", tables["passengers"], "passenger_id"),
            References("pickup_location_id", tables["locations"], "location_id"),
            References("dropoff_location_id", tables["locations"], "location_id"),
            References("payment_method_id", tables["payment_methods"], "payment_method_id"),
        ],
    }


def _model_rules(table: str) -> list[Rule]:
    """Checks of one operational table beyond its column list."""
    value = _value(SCHEMAS[table])
    status, completed_at = F.col("status"), F.col("completed_at")
    by_table = {
        "drivers": lambda: [one_of("status", model.DRIVER_STATUSES)],
        "driver_licenses": lambda: [check("license_dates", _both(value("issued_date"), value("expiry_date")))],
        "passengers": lambda: [one_of("status", model.PASSENGER_STATUSES)],
        "payment_methods": lambda: [one_of("type", model.PAYMENT_TYPES)],
        "vehicles": lambda: [check("year_above", value("year") > 1980), one_of("category", model.VEHICLE_CATEGORIES)],
        "vehicle_assignments": lambda: [check("assignment_dates", _both(value("assigned_at"), value("unassigned_at")))],
        "promo_codes": lambda: [
            one_of("discount_type", model.DISCOUNT_TYPES),
            check("discount_value_above", value("discount_value") > 0),
            check("promo_dates", _both(value("valid_from"), value("valid_until"))),
        ],
        "trips": lambda: [
            *[check(f"{name}_min", value(name) >= 0) for name in ("base_fare", "tip_amount", "discount_amount", "distance_km")],
            check("surge_multiplier_min", value("surge_multiplier") >= 1),
            one_of("status", model.RIDE_STATUSES),
            *[check(f"{name}_range", _stars(value(name))) for name in ("driver_rating", "passenger_rating")],
            check("completed_has_time", completed_at.isNotNull() | (status != "completed")),
            check("discount_within_base", value("discount_amount") <= value("base_fare")),
        ],
        "trip_cancellations": lambda: [one_of("cancelled_by", model.CANCELLED_BY)],
    }
    return by_table.get(table, list)()


def _unique(table: str) -> list[Unique]:
    current, open_ended = F.col("is_current"), F.col("unassigned_at").isNull()
    by_table = {
        "locations": [Unique(("location_id",)), Unique(("city_name", "state_province", "country"))],
        "drivers": [Unique(("driver_id",)), Unique(("email",)), Unique(("phone_number",))],
        "driver_licenses": [Unique(("license_id",)), Unique(("license_number",)), Unique(("driver_id",), current)],
        "passengers": [Unique(("passenger_id",)), Unique(("email",)), Unique(("phone_number",))],
        "payment_methods": [Unique(("payment_method_id",)), Unique(("name",))],
        "vehicles": [Unique(("vehicle_id",)), Unique(("plate_number",))],
        "vehicle_assignments": [Unique(("assignment_id",)), Unique(("vehicle_id",), open_ended)],
        "promo_codes": [Unique(("promo_code_id",)), Unique(("code",))],
        "trips": [Unique(("trip_id",))],
        "trip_cancellations": [Unique(("trip_id",))],
    }
    return by_table[table]


# Which column of which table points where.
POINTERS = {
    "driver_licenses": (("driver_id", "drivers", "driver_id"),),
    "vehicle_assignments": (("vehicle_id", "vehicles", "vehicle_id"), ("driver_id", "drivers", "driver_id")),
    "trips": (
        ("driver_id", "drivers", "driver_id"),
        ("passenger_id", "passengers", "passenger_id"),
        ("vehicle_id", "vehicles", "vehicle_id"),
        ("pickup_location_id", "locations", "location_id"),
        ("dropoff_location_id", "locations", "location_id"),
        ("payment_method_id", "payment_methods", "payment_method_id"),
        ("promo_code_id", "promo_codes", "promo_code_id"),
    ),
    "trip_cancellations": (("trip_id", "trips", "trip_id"),),
}


def operational_constraints(table: str, tables: Mapping[str, DataFrame]) -> dict:
    """All constraints of one operational table; ``tables`` holds those it points at."""
    return {
        "rules": column_rules(SCHEMAS[table], WIDTHS[table]) + _model_rules(table),
        "unique": _unique(table),
        "references": [References(column, tables[parent], key) for column, parent, key in POINTERS.get(table, ())],
    }


#: What deleting a parent does to its children; every parent comes before its own children.
ON_DELETE = (
    Pointer("driver_licenses", "driver_id", "drivers", "driver_id", cascades=True),
    Pointer("vehicle_assignments", "vehicle_id", "vehicles", "vehicle_id", cascades=True),
    Pointer("vehicle_assignments", "driver_id", "drivers", "driver_id", cascades=True),
    Pointer("trips", "payment_method_id", "payment_methods", "payment_method_id", cascades=False),
    Pointer("trip_cancellations", "trip_id", "trips", "trip_id", cascades=True),
)


def defaults(table: str) -> dict[str, Column]:
    """Values for columns an input leaves out altogether."""
    now = F.current_timestamp().cast("timestamp_ntz")
    money = "decimal(8,2)"
    by_table = {
        "drivers": {"status": F.lit("active"), "joined_at": now},
        "driver_licenses": {"is_current": F.lit(True)},
        "passengers": {"status": F.lit("active"), "created_at": now},
        "payment_methods": {"is_active": F.lit(True)},
        "vehicles": {"is_active": F.lit(True)},
        "vehicle_assignments": {"assigned_at": now},
        "promo_codes": {"is_active": F.lit(True)},
        "trips": {
            "tip_amount": F.lit(0).cast(money),
            "discount_amount": F.lit(0).cast(money),
            "surge_multiplier": F.lit(1).cast("decimal(4,2)"),
        },
        "trip_cancellations": {"cancelled_at": now},
    }
    return by_table.get(table, {})


def load_rides(spark: SparkSession, csv: str, path: str) -> int:
    """Replace the flat ride table by a delimited file; all of it or, on any violation,
    none. Returns the rows loaded."""
    wide = read_delimited_wide(spark, csv, schemas.RIDES.names)
    keyed = wide.withColumn("ride_key", F.col("ride_id").try_cast("long"))
    narrowed = [F.col(field.name).cast(field.dataType).alias(field.name) for field in schemas.RIDES]
    declared = {**ride_constraints(), "unique": [Unique(("ride_key",))]}
    return load_batch(Batch(keyed, path, "ride_id", columns=narrowed, replaces=True, **declared))
