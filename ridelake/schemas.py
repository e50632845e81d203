"""Declared schemas; nothing in the library infers a type from data.

Surrogate and natural ids are 64-bit so that they survive table sizes a 32-bit
counter would not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

LONG, INT, SHORT = LongType(), IntegerType(), ShortType()
TEXT, FLAG, DAY, MOMENT = StringType(), BooleanType(), DateType(), TimestampNTZType()
OPTIONAL = True


def table(*columns: tuple[str, DataType] | tuple[str, DataType, bool]) -> StructType:
    """A schema from (name, type) pairs; a third member marks a column that may be NULL."""
    return StructType([StructField(name, kind, bool(nullable)) for name, kind, *nullable in columns])


RIDES = table(
    ("ride_id", LONG),
    ("driver_name", TEXT),
    ("passenger_name", TEXT),
    ("pickup_city", TEXT),
    ("dropoff_city", TEXT),
    ("fare_amount", DecimalType(10, 2)),
    ("ride_distance_km", DecimalType(6, 2)),
    ("ride_status", TEXT),
    ("requested_at", MOMENT),
    ("completed_at", MOMENT, OPTIONAL),
    ("rating", DecimalType(2, 1), OPTIONAL),
    ("payment_method", TEXT, OPTIONAL),
)

# Normalised model
CITIES = table(
    ("location_id", LONG),
    ("city_name", TEXT),
)
DRIVER_NAMES = table(
    ("driver_id", LONG),
    ("name", TEXT),
)
PASSENGER_NAMES = table(
    ("passenger_id", LONG),
    ("name", TEXT),
)
PAYMENT_NAMES = table(
    ("payment_method_id", LONG),
    ("name", TEXT),
)
NORMALISED_TRIPS = table(
    ("trip_id", LONG),
    ("driver_id", LONG),
    ("passenger_id", LONG),
    ("pickup_location_id", LONG),
    ("dropoff_location_id", LONG),
    ("fare_amount", DecimalType(10, 2)),
    ("distance_km", DecimalType(6, 2)),
    ("status", TEXT),
    ("requested_at", MOMENT),
    ("completed_at", MOMENT, OPTIONAL),
    ("rating", DecimalType(2, 1), OPTIONAL),
    ("payment_method_id", LONG, OPTIONAL),
)

# Operational model
LOCATIONS = table(
    ("location_id", LONG),
    ("city_name", TEXT),
    ("state_province", TEXT, OPTIONAL),
    ("country", TEXT, OPTIONAL),
    ("latitude", DecimalType(9, 6), OPTIONAL),
    ("longitude", DecimalType(9, 6), OPTIONAL),
)
DRIVERS = table(
    ("driver_id", LONG),
    ("name", TEXT),
    ("email", TEXT, OPTIONAL),
    ("phone_number", TEXT, OPTIONAL),
    ("status", TEXT),
    ("joined_at", MOMENT),
)
DRIVER_LICENSES = table(
    ("license_id", LONG),
    ("driver_id", LONG),
    ("license_number", TEXT),
    ("issued_date", DAY, OPTIONAL),
    ("expiry_date", DAY),
    ("is_current", FLAG),
)
PASSENGERS = table(
    ("passenger_id", LONG),
    ("name", TEXT),
    ("email", TEXT, OPTIONAL),
    ("phone_number", TEXT, OPTIONAL),
    ("status", TEXT),
    ("created_at", MOMENT),
)
PAYMENT_METHODS = table(
    ("payment_method_id", LONG),
    ("name", TEXT),
    ("type", TEXT, OPTIONAL),
    ("is_active", FLAG),
)
VEHICLES = table(
    ("vehicle_id", LONG),
    ("plate_number", TEXT),
    ("make", TEXT, OPTIONAL),
    ("model", TEXT, OPTIONAL),
    ("year", SHORT, OPTIONAL),
    ("color", TEXT, OPTIONAL),
    ("category", TEXT, OPTIONAL),
    ("is_active", FLAG),
)
VEHICLE_ASSIGNMENTS = table(
    ("assignment_id", LONG),
    ("vehicle_id", LONG),
    ("driver_id", LONG),
    ("assigned_at", MOMENT),
    ("unassigned_at", MOMENT, OPTIONAL),
)
PROMO_CODES = table(
    ("promo_code_id", LONG),
    ("code", TEXT),
    ("discount_type", TEXT),
    ("discount_value", DecimalType(8, 2)),
    ("valid_from", MOMENT, OPTIONAL),
    ("valid_until", MOMENT, OPTIONAL),
    ("max_uses", INT, OPTIONAL),
    ("is_active", FLAG),
)
TRIPS = table(
    ("trip_id", LONG),
    ("driver_id", LONG),
    ("passenger_id", LONG),
    ("vehicle_id", LONG, OPTIONAL),
    ("pickup_location_id", LONG),
    ("dropoff_location_id", LONG),
    ("payment_method_id", LONG, OPTIONAL),
    ("promo_code_id", LONG, OPTIONAL),
    ("base_fare", DecimalType(10, 2)),
    ("tip_amount", DecimalType(8, 2)),
    ("discount_amount", DecimalType(8, 2)),
    ("surge_multiplier", DecimalType(4, 2)),
    ("distance_km", DecimalType(6, 2)),
    ("status", TEXT),
    ("requested_at", MOMENT),
    ("completed_at", MOMENT, OPTIONAL),
    ("driver_rating", DecimalType(2, 1), OPTIONAL),
    ("passenger_rating", DecimalType(2, 1), OPTIONAL),
)
TRIP_CANCELLATIONS = table(
    ("trip_id", LONG),
    ("cancelled_at", MOMENT),
    ("cancelled_by", TEXT),
    ("cancellation_reason", TEXT, OPTIONAL),
)

# Warehouse
DIM_DATE = table(
    ("date_key", INT),
    ("full_date", DAY),
    ("year", SHORT),
    ("quarter", SHORT),
    ("month", SHORT),
    ("month_name", TEXT),
    ("week_of_year", SHORT),
    ("day_of_week", SHORT),
    ("day_name", TEXT),
    ("is_weekend", FLAG),
)
DIM_TIME = table(
    ("time_key", INT),
    ("hour", SHORT),
    ("minute_bucket", SHORT),
    ("time_label", TEXT),
    ("time_of_day", TEXT),
    ("is_rush_hour", FLAG),
)
DIM_DRIVER = table(
    ("driver_key", LONG),
    ("driver_id", LONG),
    ("name", TEXT),
    ("status", TEXT),
    ("joined_at", MOMENT, OPTIONAL),
    ("tenure_bucket", TEXT, OPTIONAL),
)
DIM_PASSENGER = table(
    ("passenger_key", LONG),
    ("passenger_id", LONG),
    ("name", TEXT),
    ("status", TEXT),
    ("cohort_month", TEXT, OPTIONAL),
    ("created_at", MOMENT, OPTIONAL),
)
DIM_LOCATION = table(
    ("location_key", LONG),
    ("location_id", LONG),
    ("city_name", TEXT),
    ("state_province", TEXT, OPTIONAL),
    ("country", TEXT, OPTIONAL),
    ("region", TEXT, OPTIONAL),
    ("latitude", DecimalType(9, 6), OPTIONAL),
    ("longitude", DecimalType(9, 6), OPTIONAL),
)
DIM_PAYMENT_METHOD = table(
    ("payment_method_key", LONG),
    ("payment_method_id", LONG, OPTIONAL),
    ("name", TEXT),
    ("type", TEXT, OPTIONAL),
    ("is_active", FLAG, OPTIONAL),
)
DIM_PROMO_CODE = table(
    ("promo_code_key", LONG),
    ("promo_code_id", LONG, OPTIONAL),
    ("code", TEXT, OPTIONAL),
    ("discount_type", TEXT, OPTIONAL),
    ("discount_value", DecimalType(8, 2), OPTIONAL),
    ("is_active", FLAG, OPTIONAL),
)
DIM_VEHICLE = table(
    ("vehicle_key", LONG),
    ("vehicle_id", LONG),
    ("plate_number", TEXT, OPTIONAL),
    ("make", TEXT, OPTIONAL),
    ("model", TEXT, OPTIONAL),
    ("year", SHORT, OPTIONAL),
    ("color", TEXT, OPTIONAL),
    ("category", TEXT, OPTIONAL),
    ("is_active", FLAG, OPTIONAL),
)
FACT_TRIPS = table(
    ("trip_key", LONG),
    ("source_trip_id", LONG),
    ("date_key", INT),
    ("time_key", INT),
    ("driver_key", LONG),
    ("passenger_key", LONG),
    ("vehicle_key", LONG, OPTIONAL),
    ("pickup_location_key", LONG),
    ("dropoff_location_key", LONG),
    ("payment_method_key", LONG, OPTIONAL),
    ("promo_code_key", LONG, OPTIONAL),
    ("base_fare", DecimalType(10, 2), OPTIONAL),
    ("tip_amount", DecimalType(8, 2)),
    ("discount_amount", DecimalType(8, 2)),
    ("fare_amount", DecimalType(10, 2), OPTIONAL),
    ("distance_km", DecimalType(6, 2), OPTIONAL),
    ("duration_minutes", DecimalType(6, 1), OPTIONAL),
    ("trip_count", SHORT),
    ("driver_rating", DecimalType(2, 1), OPTIONAL),
    ("passenger_rating", DecimalType(2, 1), OPTIONAL),
    ("surge_multiplier", DecimalType(4, 2), OPTIONAL),
    ("requested_at", MOMENT),
)

WAREHOUSE = {
    "dim_date": DIM_DATE,
    "dim_time": DIM_TIME,
    "dim_driver": DIM_DRIVER,
    "dim_passenger": DIM_PASSENGER,
    "dim_location": DIM_LOCATION,
    "dim_payment_method": DIM_PAYMENT_METHOD,
    "dim_promo_code": DIM_PROMO_CODE,
    "dim_vehicle": DIM_VEHICLE,
    "fact_trips": FACT_TRIPS,
}


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Project a frame onto a declared schema: same columns, order and types."""
    present = {field.name: field.dataType for field in df.schema}
    return df.select(
        *[
            field.name if present[field.name] == field.dataType else F.col(field.name).cast(field.dataType).alias(field.name)
            for field in schema
        ]
    )
