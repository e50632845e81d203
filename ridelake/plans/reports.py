"""Reports over normalised trips, operational trips and the star schema.

Wherever a report groups by something a dimension names, the fact rows are summed
per key first and the dimension joined to the sums: the join then sees one row per
key instead of every trip, whatever the skew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelake.functions.numeric import percent_of
from ridelake.functions.ordering import ascending, descending
from ridelake.functions.rules import view_fare
from ridelake.functions.temporal import minutes_between
from ridelake.operators.lookups import Step, chain, lookup, table_sizes, without_match
from ridelake.operators.running import running_total, share_of_total


def has_status(status: str) -> Column:
    return F.col("status") == status


def completed_trips(
    trips: DataFrame, drivers: DataFrame, passengers: DataFrame, cities: DataFrame, payments: DataFrame
) -> DataFrame:
    """Completed trips with names for ids; a trip without payment method stays."""
    tables = {"drivers": drivers, "passengers": passengers, "cities": cities, "payments": payments}
    steps = (
        Step("drivers", "driver_id", "driver_id", {"driver_name": "name"}, "inner"),
        Step("passengers", "passenger_id", "passenger_id", {"passenger_name": "name"}, "inner"),
        Step("cities", "pickup_location_id", "location_id", {"pickup_city": "city_name"}, "inner"),
        Step("cities", "dropoff_location_id", "location_id", {"dropoff_city": "city_name"}, "inner"),
        Step("payments", "payment_method_id", "payment_method_id", {"payment_method": "name"}),
    )
    detail = chain(trips.where(has_status("completed")), tables, steps, table_sizes(tables), "trip_id")
    return detail.select(
        "trip_id", "driver_name", "passenger_name", "pickup_city", "dropoff_city",
        "fare_amount", "distance_km", "rating", "payment_method", "requested_at", "completed_at",
    )


def _trips_per_driver(trips: DataFrame) -> DataFrame:
    """Counts and completed sums per driver, combined map-side."""
    fare, rating = F.when(has_status("completed"), F.col("fare_amount")), F.when(has_status("completed"), F.col("rating"))
    return trips.groupBy("driver_id").agg(
        F.count(F.lit(1)).alias("total_trips"),
        F.count_if(has_status("completed")).alias("completed_trips"),
        F.count_if(has_status("cancelled")).alias("cancelled_trips"),
        F.sum(fare).alias("fares"),
        F.count(fare).alias("fare_count"),
        F.sum(rating).alias("ratings"),
        F.count(rating).alias("rating_count"),
    )


def _mean(total: str, count: str, digits: int) -> Column:
    exact = F.col(total).cast("decimal(24,2)") / F.nullif(F.col(count).cast("decimal(14,0)"), F.lit(0))
    return F.round(exact, digits)


def driver_summary(trips: DataFrame, drivers: DataFrame) -> DataFrame:
    """One line per driver with at least one trip; namesakes stay apart."""
    summary = _trips_per_driver(trips).join(drivers, "driver_id")
    return summary.select(
        "driver_id",
        F.col("name").alias("driver_name"),
        "total_trips",
        "completed_trips",
        "cancelled_trips",
        percent_of(F.col("cancelled_trips"), F.col("total_trips"), 1).alias("cancellation_rate"),
        _mean("fares", "fare_count", 2).alias("avg_fare"),
        _mean("ratings", "rating_count", 1).alias("avg_rating"),
    )


def driver_cancellation(trips: DataFrame, drivers: DataFrame) -> DataFrame:
    """Cancellation rate of every driver; NULL for one without trips."""
    counted = drivers.join(_trips_per_driver(trips), "driver_id", "left")
    zero = F.lit(0)
    total, cancelled = (F.coalesce(name, zero) for name in ("total_trips", "cancelled_trips"))
    return counted.select(
        "driver_id",
        F.col("name").alias("driver_name"),
        total.alias("total_trips"),
        F.coalesce("completed_trips", zero).alias("completed_trips"),
        cancelled.alias("cancelled_trips"),
        percent_of(cancelled, total, 2).alias("cancellation_rate"),
    )


def driver_completed_rides(trips: DataFrame, drivers: DataFrame) -> DataFrame:
    """Completed rides of every driver, none included; most first."""
    done = trips.where(has_status("completed")).groupBy("driver_id").agg(F.count("trip_id").alias("n"))
    counted = drivers.join(done, "driver_id", "left")
    named = counted.select("driver_id", F.col("name").alias("driver_name"), F.coalesce("n", F.lit(0)).alias("completed_rides"))
    return named.orderBy(descending("completed_rides"), ascending("driver_id"))


def flagged_trips(drivers: DataFrame, trips: DataFrame) -> DataFrame:
    """Drivers left-joined with their trips, completed ones flagged in front; a driver's own id is ``id``."""
    flag = F.when(has_status("completed"), 1).alias("is_completed")
    people = drivers.select(F.col("driver_id").alias("id"), F.col("name").alias("driver_name"))
    sizes = table_sizes({"drivers": people})
    named = lookup(
        trips, people.withColumn("known", F.col("id")), "driver_id", "id", {"id": "known", "driver_name": "driver_name"},
        row_id="trip_id", size=sizes["drivers"], how="inner",
    )
    idle = without_match(people, "id", trips, "driver_id")
    return named.unionByName(idle, allowMissingColumns=True).select(flag, "id", "driver_name", *trips.columns)


def running_fare(trips: DataFrame, drivers: DataFrame) -> DataFrame:
    """Each completed trip with its driver's takings up to then."""
    done = trips.where(has_status("completed")).select("trip_id", "driver_id", "requested_at", "fare_amount")
    summed = running_total(done, "driver_id", "requested_at", "fare_amount", "running_total_fare")
    named = lookup(summed, drivers, "driver_id", "driver_id", {"driver_name": "name"}, row_id="trip_id", how="inner", keys_from=done)
    return named.select("trip_id", "driver_name", "requested_at", "fare_amount", "running_total_fare").orderBy(
        ascending("driver_name"), ascending("requested_at"), ascending("trip_id")
    )


def trips_view(trips: DataFrame, cancellations: DataFrame) -> DataFrame:
    """Operational trips with fare, minutes and cancellation details."""
    fare = view_fare(F.col("base_fare"), F.col("surge_multiplier"), F.col("tip_amount"), F.col("discount_amount"))
    return (
        trips.join(cancellations, "trip_id", "left")
        .withColumn("fare_amount", fare)
        .withColumn("duration_minutes", minutes_between(F.col("requested_at"), F.col("completed_at")))
        .select(*trips.columns, "fare_amount", "duration_minutes", "cancelled_at", "cancelled_by", "cancellation_reason")
    )


def promo_usage(promos: DataFrame, trips: DataFrame) -> DataFrame:
    """Every promo code with how often it was used."""
    used = trips.where(F.col("promo_code_id").isNotNull()).groupBy("promo_code_id").agg(F.count(F.lit(1)).alias("n"))
    return promos.join(used, "promo_code_id", "left").select(*promos.columns, F.coalesce("n", F.lit(0)).alias("times_used"))


# Star schema


def daily_sums(facts: DataFrame) -> DataFrame:
    """Fares and trips per day by pickup place, by payment method and by quarter hour, from one pass.

    Each row is of one of these, named by ``by``. Sums of such sums are what all reports need, so
    a load adds the rows of its own facts, and no report reads a fact again.
    """
    keys = ("pickup_location_key", "payment_method_key", "time_key")
    sets = [[F.col("date_key"), F.col(key)] for key in keys]
    by = F.coalesce(*[F.when(F.grouping(key) == 0, F.lit(key)) for key in keys]).alias("by")
    return facts.groupingSets(sets, "date_key", *keys).agg(
        by,
        F.sum("fare_amount").cast("decimal(20,2)").alias("fares"),
        F.count("fare_amount").alias("n_fares"),
        F.count(F.lit(1)).alias("trips"),
    )


def merged(sums: DataFrame) -> DataFrame:
    """One row where several loads added sums of the same key and day."""
    keys = [c for c in sums.columns if c not in ("fares", "n_fares", "trips")]
    added = sums.groupBy(*keys).agg(*[F.sum(c).cast(sums.schema[c].dataType).alias(c) for c in ("fares", "n_fares", "trips")])
    return added.select(*sums.columns)


def sums_by(sums: DataFrame, key: str) -> DataFrame:
    """The daily sums of one key; a stored table is only read in that partition."""
    return sums.where(F.col("by") == key)


def revenue_by_city_month(facts: DataFrame, places: DataFrame, days: DataFrame) -> DataFrame:
    return city_months(daily_sums(facts), places, days)


def city_months(sums: DataFrame, places: DataFrame, days: DataFrame) -> DataFrame:
    """Revenue per pickup city and month."""
    per_key = sums_by(sums, "pickup_location_key").groupBy("pickup_location_key", "date_key").agg(F.sum("fares").alias("revenue"))
    named = per_key.join(places.withColumnRenamed("location_key", "pickup_location_key"), "pickup_location_key").join(days, "date_key")
    summed = named.groupBy("city_name", "year", "month").agg(F.sum("revenue").alias("total_revenue"))
    return summed.orderBy(ascending("city_name"), ascending("year"), ascending("month"))


def revenue_by_city_month_operational(trips: DataFrame, places: DataFrame) -> DataFrame:
    """The same question asked of the operational tables."""
    fare = view_fare(F.col("base_fare"), F.col("surge_multiplier"), F.col("tip_amount"), F.col("discount_amount"))
    month = (F.year("requested_at").alias("year"), F.month("requested_at").alias("month"))
    per_key = trips.groupBy(F.col("pickup_location_id").alias("location_id"), *month).agg(F.sum(fare).alias("revenue"))
    summed = per_key.join(places, "location_id").groupBy("city_name", "year", "month").agg(F.sum("revenue").alias("total_revenue"))
    return summed.orderBy(ascending("city_name"), ascending("year"), ascending("month"))


def revenue_by_method(facts: DataFrame, methods: DataFrame) -> DataFrame:
    return method_totals(daily_sums(facts), methods)


def method_totals(sums: DataFrame, methods: DataFrame) -> DataFrame:
    """Revenue per payment method; trips without one are left out."""
    per_key = sums_by(sums, "payment_method_key").groupBy("payment_method_key").agg(F.sum("fares").alias("revenue"))
    named = per_key.join(methods, "payment_method_key").groupBy(F.col("name").alias("payment_method"))
    return named.agg(F.sum("revenue").alias("total_revenue")).orderBy(descending("total_revenue"), ascending("payment_method"))


def avg_fare_by_method_month(facts: DataFrame, methods: DataFrame, days: DataFrame) -> DataFrame:
    return method_months(daily_sums(facts), methods, days)


def method_months(sums: DataFrame, methods: DataFrame, days: DataFrame) -> DataFrame:
    """Average fare per payment method and month."""
    per_key = sums_by(sums, "payment_method_key").groupBy("payment_method_key", "date_key").agg(
        F.sum("fares").alias("fares"), F.sum("n_fares").alias("n")
    )
    named = per_key.join(methods, "payment_method_key").join(days, "date_key")
    summed = named.groupBy(F.col("name").alias("payment_method"), "year", "month").agg(
        F.sum("fares").alias("fares"), F.sum("n").alias("n")
    )
    return summed.select("payment_method", "year", "month", _mean("fares", "n", 2).alias("avg_fare")).orderBy(
        ascending("year"), ascending("month"), ascending("payment_method")
    )


def busiest_hour(facts: DataFrame, clock: DataFrame) -> DataFrame:
    return hours(daily_sums(facts), clock)


def hours(sums: DataFrame, clock: DataFrame) -> DataFrame:
    """Trips per hour of day and each hour's share of all trips."""
    per_key = sums_by(sums, "time_key").groupBy("time_key").agg(F.sum("trips").alias("n"))
    per_hour = per_key.join(clock, "time_key").groupBy("hour").agg(F.sum("n").alias("trip_count"))
    return share_of_total(per_hour, "trip_count", "pct_of_all_trips", 2).orderBy(descending("trip_count"), ascending("hour"))
