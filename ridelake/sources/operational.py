"""The operational ride model (priced trips, vehicles, promos, cancellations),
projected from the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.functions.rules import promo_discount
from ridelake.functions.temporal import ntz
from ridelake.functions.text import zero_padded
from ridelake.sources.rides import counted, minutes, payment_names, payment_number, ride_columns
from ridelake.sources.stored import stored

# Fixed values of the projection.
STATES = ("New York", "Ohio", "Texas", "California", "Vermont", "Iowa", "Florida", "Ontario")
CATEGORY_OF = {"ECONOMY": "economy", "STANDARD": "comfort", "LARGE": "xl", "PROMO": "luxury"}
TYPE_OF = {1: "card", 2: "cash", 3: "wallet", 5: "voucher"}
CANCELLERS = ("driver", "passenger", "system")
FIRST_DAY = "1995-01-01 00:00:00"


def _pick(values, index):
    return F.element_at(F.array(*[F.lit(value) for value in values]), (index % len(values) + 1).cast("int"))


def _mapped(column, mapping):
    table = F.create_map(*[F.lit(part) for pair in mapping.items() for part in pair])
    return F.try_element_at(table, column)


def _days(number):
    return F.make_dt_interval(number.cast("int"))


def drivers(spark: SparkSession, folder: str) -> DataFrame:
    balance = F.col("s_acctbal")
    return stored(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("driver_id"),
        F.col("s_name").alias("name"),
        F.when(balance < 0, "suspended").when(balance < 1000, "inactive").otherwise("active").alias("status"),
        F.when(balance < 9000, ntz(FIRST_DAY) + _days(1400 + F.col("s_suppkey") * 11 % 1000)).alias("joined_at"),
    )


def passengers(spark: SparkSession, folder: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    return stored(spark, folder, "customer").select(
        F.col("c_custkey").alias("passenger_id"),
        F.col("c_name").alias("name"),
        F.when(segment == "MACHINERY", "inactive").when(F.col("c_acctbal") < 0, "banned").otherwise("active").alias("status"),
        (ntz(FIRST_DAY) + _days(F.col("c_custkey") * 7 % 2000)).alias("created_at"),
    )


def locations(spark: SparkSession, folder: str) -> DataFrame:
    region = F.col("n_regionkey")
    key = F.col("n_nationkey")
    return stored(spark, folder, "nation").select(
        key.cast("long").alias("location_id"),
        F.col("n_name").alias("city_name"),
        _pick(STATES, key).alias("state_province"),
        F.when(region < 2, "USA").when(region > 2, F.concat(F.lit("Country "), region.cast("string"))).alias("country"),
        (key * 1.5 - 20).cast("decimal(9,6)").alias("latitude"),
        (key * 2.25 - 30).cast("decimal(9,6)").alias("longitude"),
    )


def payment_methods(spark: SparkSession, folder: str) -> DataFrame:
    number = F.col("payment_method_id")
    return payment_names(spark, folder).select(
        number, "name", _mapped(number.cast("int"), TYPE_OF).alias("type"), (number != 5).alias("is_active")
    )


def promo_codes(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("n_nationkey")
    return stored(spark, folder, "nation").select(
        key.cast("long").alias("promo_code_id"),
        F.concat(F.lit("RIDE-"), F.col("n_name")).alias("code"),
        F.when(key % 2 == 0, "percent").otherwise("flat").alias("discount_type"),
        (key * 4 + 5).cast("decimal(8,2)").alias("discount_value"),
        (key % 7 != 0).alias("is_active"),
    )


def vehicles(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("p_partkey")
    return stored(spark, folder, "part").select(
        key.alias("vehicle_id"),
        F.concat(F.lit("PL-"), zero_padded(key, 9)).alias("plate_number"),
        F.col("p_brand").alias("make"),
        F.col("p_name").alias("model"),
        (1975 + F.col("p_size")).cast("smallint").alias("year"),
        F.split_part(F.col("p_name"), F.lit(" "), F.lit(1)).alias("color"),
        _mapped(F.col("p_type"), CATEGORY_OF).alias("category"),
        (F.col("p_retailprice") > 910).alias("is_active"),
    )


def vehicle_assignments(spark: SparkSession, folder: str) -> DataFrame:
    """Who drove which vehicle from when; lines still open have no end."""
    shipped = F.col("l_shipdate")
    return stored(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("vehicle_id"),
        F.col("l_suppkey").alias("driver_id"),
        shipped.alias("assigned_at"),
        F.when(F.col("l_linestatus") == "F", shipped + _days(F.col("l_quantity"))).alias("unassigned_at"),
    )


def priced_trips(spark: SparkSession, folder: str) -> DataFrame:
    """Operational trips; a few point at vehicles, places and promos that do not exist."""
    drivers, vehicles_known = (counted(stored(spark, folder, name)) for name in ("supplier", "part"))
    flat = ride_columns(stored(spark, folder, "orders"), drivers)
    key, passenger = F.col("ride_id"), F.col("passenger_id")
    done = F.col("ride_status") == "completed"
    base = F.col("fare_amount")
    promo = F.when(done & (passenger % 5 == 0), passenger % 28)
    kind = F.when(promo % 2 == 0, "percent").otherwise("flat")
    worth = (promo * 4 + 5).cast("decimal(8,2)")
    tip_share = (key % 26).cast("decimal(4,0)") / F.lit(100).cast("decimal(3,0)")
    money = "decimal(8,2)"
    none = F.lit("0.00").cast(money)
    return flat.select(
        key.alias("trip_id"),
        "driver_id",
        "passenger_id",
        F.when(key % 7 != 0, (key * 13) % (vehicles_known + 20)).alias("vehicle_id"),
        (passenger % 26).alias("pickup_location_id"),
        (key % 25).alias("dropoff_location_id"),
        F.when(F.col("ride_status") != "no_show", payment_number(F.col("payment_method"))).alias("payment_method_id"),
        promo.alias("promo_code_id"),
        base.alias("base_fare"),
        F.when(done, F.round(base * tip_share, 2).cast(money)).otherwise(none).alias("tip_amount"),
        F.when(promo.isNull(), none).otherwise(promo_discount(kind, worth, base).cast(money)).alias("discount_amount"),
        ((100 + key % 5 * 25) / 100).cast("decimal(4,2)").alias("surge_multiplier"),
        F.col("ride_distance_km").alias("distance_km"),
        F.col("ride_status").alias("status"),
        "requested_at",
        "completed_at",
        F.col("rating").alias("driver_rating"),
        F.when(F.col("rating").isNotNull(), ((10 - key % 9) / 2).cast("decimal(2,1)")).alias("passenger_rating"),
    )


def trip_cancellations(spark: SparkSession, folder: str) -> DataFrame:
    """One record per cancelled trip."""
    flat = ride_columns(stored(spark, folder, "orders").where(F.col("o_orderstatus") == "O"), F.lit(1))
    key = F.col("ride_id")
    return flat.select(
        key.alias("trip_id"),
        (F.col("requested_at") + minutes(1 + key % 15)).alias("cancelled_at"),
        _pick(CANCELLERS, key).alias("cancelled_by"),
        F.when(key % 4 != 0, F.concat(F.lit("reason "), (key % 4).cast("string"))).alias("cancellation_reason"),
    )
