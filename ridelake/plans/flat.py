"""Questions asked of the flat ride table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelake.functions.numeric import exact_mean
from ridelake.functions.ordering import ascending, descending
from ridelake.functions.text import clean_name
from ridelake.operators.changes import add_null_column, update_where
from ridelake.operators.quality import Rule, rule_report


def completed() -> Column:
    return F.col("ride_status") == "completed"


def within_city() -> Column:
    return F.col("pickup_city") == F.col("dropoff_city")


def rows(name: str = "n") -> Column:
    return F.count(F.lit(1)).alias(name)


# Counting and totals


def total_rides(rides: DataFrame) -> DataFrame:
    return rides.agg(rows("total_rides"))


def null_rating_count(rides: DataFrame) -> DataFrame:
    return rides.where(F.col("rating").isNull()).agg(rows("null_ratings"))


def unrated_not_completed(rides: DataFrame) -> DataFrame:
    return rides.where(F.col("rating").isNull() & (F.col("ride_status") != "completed")).agg(rows("unrated"))


def completed_fare_total(rides: DataFrame) -> DataFrame:
    """Total of completed fares; NULL when there are none."""
    return rides.where(completed()).agg(F.sum("fare_amount").alias("total_fare"))


def global_stats(rides: DataFrame) -> DataFrame:
    return rides.agg(
        rows("rides"),
        F.sum("fare_amount").alias("sum_fare"),
        exact_mean(F.col("fare_amount"), 6).alias("avg_fare"),
        F.min("ride_distance_km").alias("min_distance"),
        F.max("ride_distance_km").alias("max_distance"),
    )


def fare_per_km(rides: DataFrame) -> DataFrame:
    """Mean of the per-ride ratios, over all rides and over same-city rides.

    A ride of zero kilometres is an error, not a NULL. Decimal ratios add up to the
    same mean in whatever order partitions arrive.
    """
    ratio = F.col("fare_amount") / F.col("ride_distance_km")
    return rides.agg(
        F.round(F.avg(ratio), 4).alias("all_rides"),
        F.round(F.avg(F.when(within_city(), ratio)), 4).alias("same_city"),
    )


def status_breakdown(rides: DataFrame) -> DataFrame:
    return rides.groupBy("ride_status").agg(rows("total")).orderBy(descending("total"), ascending("ride_status"))


def driver_revenue(rides: DataFrame) -> DataFrame:
    by_driver = rides.groupBy("driver_name").agg(rows("rides"), F.sum("fare_amount").alias("revenue"))
    return by_driver.orderBy(ascending("driver_name"))


def distance_min_max(rides: DataFrame) -> DataFrame:
    return rides.groupBy("ride_distance_km").agg(
        F.min("fare_amount").alias("min_fare"), F.max("fare_amount").alias("max_fare")
    )


def status_profile(rides: DataFrame) -> DataFrame:
    """Same-city rides by status: count, rounded means and extremes."""
    distance, fare = F.col("ride_distance_km"), F.col("fare_amount")
    return (
        rides.where(within_city())
        .groupBy("ride_status")
        .agg(
            rows("rides"),
            exact_mean(distance, 2).alias("avg_distance"),
            F.min(distance).alias("min_distance"),
            F.max(distance).alias("max_distance"),
            exact_mean(fare, 2).alias("avg_fare"),
            F.min(fare).alias("min_fare"),
            F.max(fare).alias("max_fare"),
        )
    )


def having_count(rides: DataFrame, more_than: int) -> DataFrame:
    """Drivers with more than so many completed rides."""
    busy = rides.where(completed()).groupBy("driver_name").agg(rows("completed_rides"))
    return busy.where(F.col("completed_rides") > more_than).orderBy(ascending("driver_name"))


# Selecting rides


def high_value(rides: DataFrame, above: int = 500) -> DataFrame:
    """Rides above a fare, dearest first; the id keeps equal fares in a fixed order
    and lets the sort spread them."""
    return rides.where(F.col("fare_amount") > above).orderBy(descending("fare_amount"), ascending("ride_id"))


def recent_completed(rides: DataFrame, n: int = 10) -> DataFrame:
    latest = rides.where(completed()).orderBy(descending("requested_at"), descending("ride_id")).limit(n)
    return latest.select("ride_id", F.col("fare_amount").alias("fare"), "requested_at", "completed_at")


def recent_by_completion(rides: DataFrame, n: int = 10) -> DataFrame:
    done = rides.where(F.col("completed_at").isNotNull())
    return done.orderBy(descending("completed_at"), descending("ride_id")).limit(n).select("ride_id", "requested_at", "completed_at")


def latest_row(rides: DataFrame) -> DataFrame:
    return rides.orderBy(descending("ride_id")).limit(1)


def same_city(rides: DataFrame) -> DataFrame:
    return rides.where(within_city()).select("ride_id", "pickup_city", "ride_status")


def same_city_guarded(rides: DataFrame) -> DataFrame:
    """The spelled-out form: equality already drops NULLs, so it equals ``same_city``."""
    known = F.col("pickup_city").isNotNull() & F.col("dropoff_city").isNotNull()
    return same_city(rides.where(known))


def same_city_ignoring_case(rides: DataFrame) -> DataFrame:
    """Served rides inside one city, however it was spelt, that covered some distance."""
    alike = F.lower("pickup_city") == F.lower("dropoff_city")
    moved = (F.col("ride_distance_km") > 0) & (F.col("ride_status") != "cancelled")
    return rides.where(alike & moved).agg(rows("rides"))


def same_city_unfulfilled(rides: DataFrame) -> DataFrame:
    return rides.where(within_city() & F.col("ride_status").isin("cancelled", "no_show")).agg(rows("rides"))


def driver_like(rides: DataFrame, pattern: str) -> DataFrame:
    return rides.where(F.col("driver_name").like(pattern)).select("ride_id", "driver_name", "passenger_name")


# Distinct values and set operations


def distinct_pickup(rides: DataFrame) -> DataFrame:
    return rides.select("pickup_city").distinct().orderBy(ascending("pickup_city"))


def distinct_pair(rides: DataFrame) -> DataFrame:
    return rides.select("driver_name", "payment_method").distinct()


def payment_method_names(rides: DataFrame) -> DataFrame:
    return rides.where(F.col("payment_method").isNotNull()).select("payment_method").distinct()


def clean_names(names: DataFrame, column: str) -> DataFrame:
    """Distinct names behind all spellings, each spelling cleaned once."""
    return names.select(column).distinct().select(clean_name(F.col(column)).alias("name")).distinct()


def count_clean_names(names: DataFrame, column: str) -> DataFrame:
    """How many spellings there are, and how many names are behind them."""
    spelt = names.select(column).distinct()
    return spelt.agg(F.count(column).alias("spellings"), F.countDistinct(clean_name(F.col(column))).alias("names"))


# Changes


def with_phone_numbers(rides: DataFrame, pattern: str, first: str, later: str, after_id: int) -> DataFrame:
    """Give one driver a phone number, and another one from a certain ride on."""
    theirs = F.col("driver_name").like(pattern)
    numbered = add_null_column(rides, "phone_number", "string")
    return update_where(
        numbered,
        "phone_number",
        [(theirs, F.lit(first)), (theirs & (F.col("ride_id") > after_id), F.lit(later))],
    )


def state_probe(trips: DataFrame) -> DataFrame:
    """Three ways status and completion time can contradict each other."""
    status, done = F.col("status"), F.col("completed_at").isNotNull()
    return rule_report(
        trips,
        [
            Rule("status_missing", status.isNotNull()),
            Rule("completed_without_time", ~((status == "completed") & ~done)),
            Rule("time_without_completed", ~(done & (status != "completed"))),
        ],
        "trip_id",
    )
