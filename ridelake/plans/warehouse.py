"""Dimensions of the star schema."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ridelake import schemas
from ridelake.functions import temporal
from ridelake.functions.rules import is_rush_hour, tenure_bucket, time_of_day, us_region
from ridelake.functions.text import zero_padded
from ridelake.operators.changes import insert_if_absent
from ridelake.operators.keys import assign_keys, next_free_key
from ridelake.sources.readers import day_series, number_series

# The calendar a warehouse starts with.
CALENDAR_FIRST, CALENDAR_LAST = "2023-01-01", "2026-12-31"


def calendar(days: DataFrame) -> DataFrame:
    """Calendar attributes of a frame of ``full_date`` values."""
    day = F.col("full_date")
    return schemas.conform(
        days.select(
            temporal.date_key(day).alias("date_key"),
            day,
            F.year(day).alias("year"),
            F.quarter(day).alias("quarter"),
            F.month(day).alias("month"),
            temporal.month_name(day).alias("month_name"),
            temporal.iso_week(day).alias("week_of_year"),
            temporal.day_of_week(day).alias("day_of_week"),
            temporal.day_name(day).alias("day_name"),
            temporal.is_weekend(day).alias("is_weekend"),
        ),
        schemas.DIM_DATE,
    )


def dim_date(spark: SparkSession, first: str = CALENDAR_FIRST, last: str = CALENDAR_LAST) -> DataFrame:
    return calendar(day_series(spark, first, last))


def dates_spanning(events: DataFrame, ts: str) -> DataFrame:
    """The calendar from the first to the last day that occurs in a column."""
    span = events.agg(F.min(ts).cast("date").alias("first"), F.max(ts).cast("date").alias("last"))
    days = F.sequence("first", "last", F.expr("interval 1 day"))
    return calendar(span.select(F.explode(days).alias("full_date")))


def dim_time(spark: SparkSession) -> DataFrame:
    """The 96 quarter hours of a day: every hour with each of its four starts."""
    hour, minute = F.col("hour"), F.col("minute_bucket")
    starts = F.explode(F.sequence(F.lit(0), F.lit(45), F.lit(15)))
    clock = number_series(spark, 0, 23, 1, "hour").withColumn("minute_bucket", starts)
    return schemas.conform(
        clock.select(
            (hour * 100 + minute).alias("time_key"),
            hour,
            minute,
            F.concat(zero_padded(hour, 2), F.lit(":"), zero_padded(minute, 2)).alias("time_label"),
            time_of_day(hour).alias("time_of_day"),
            is_rush_hour(hour).alias("is_rush_hour"),
        ),
        schemas.DIM_TIME,
    )


@dataclass(frozen=True)
class Dimension:
    """How one dimension is fed: its source table, its keys and its derived columns."""

    table: str
    source: str
    key: str
    natural: str
    schema: StructType
    derived: Callable[[Column], dict[str, Column]] | None = None

    def rows(self, source: DataFrame, as_of: Column) -> DataFrame:
        """Attributes as of a moment, without a surrogate key."""
        attributes = StructType([field for field in self.schema if field.name != self.key])
        return schemas.conform(source.withColumns(self.derived(as_of)) if self.derived else source, attributes)

    def new_rows(self, source: DataFrame, as_of: Column, existing: DataFrame | None = None, start: int | None = None) -> DataFrame:
        """Rows whose natural key is not stored yet, with new surrogate keys above ``start``, or else all stored ones.

        Stored rows never change, so derived columns stay as of their first load.
        """
        fresh = insert_if_absent(self.rows(source, as_of), existing, [self.natural])
        if start is None:
            start = 0 if existing is None else next_free_key(existing, self.key)
        return schemas.conform(assign_keys(fresh, self.key, self.natural, start), self.schema)


DIMENSIONS = (
    Dimension(
        "dim_driver", "drivers", "driver_key", "driver_id", schemas.DIM_DRIVER,
        lambda as_of: {"tenure_bucket": tenure_bucket(F.col("joined_at"), as_of)},
    ),
    Dimension(
        "dim_passenger", "passengers", "passenger_key", "passenger_id", schemas.DIM_PASSENGER,
        lambda as_of: {"cohort_month": temporal.year_month(F.col("created_at"))},
    ),
    Dimension(
        "dim_location", "locations", "location_key", "location_id", schemas.DIM_LOCATION,
        lambda as_of: {"region": us_region(F.col("country"), F.col("state_province"))},
    ),
    Dimension("dim_payment_method", "payment_methods", "payment_method_key", "payment_method_id", schemas.DIM_PAYMENT_METHOD),
    Dimension("dim_promo_code", "promo_codes", "promo_code_key", "promo_code_id", schemas.DIM_PROMO_CODE),
    Dimension("dim_vehicle", "vehicles", "vehicle_key", "vehicle_id", schemas.DIM_VEHICLE),
)


def build_dimensions(
    spark: SparkSession, sources: dict[str, DataFrame], as_of: Column, first: str, last: str
) -> dict[str, DataFrame]:
    """All dimensions of a first load, unstored."""
    built = {dim.table: dim.new_rows(sources[dim.source], as_of) for dim in DIMENSIONS}
    return {**built, "dim_date": dim_date(spark, first, last), "dim_time": dim_time(spark)}
