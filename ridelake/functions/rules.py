"""Business rules of the ride model as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ridelake.functions.numeric import round_half_even, round_half_up, zero_if_null
from ridelake.functions.temporal import months_before

# Fixed values of the ride model.
RIDE_STATUSES = ("completed", "cancelled", "no_show")
DRIVER_STATUSES = ("active", "inactive", "suspended")
PASSENGER_STATUSES = ("active", "inactive", "banned")
PAYMENT_TYPES = ("card", "cash", "wallet", "voucher")
VEHICLE_CATEGORIES = ("economy", "comfort", "xl", "luxury")
DISCOUNT_TYPES = ("percent", "flat")
CANCELLED_BY = ("driver", "passenger", "system")
HOME_COUNTRY = "USA"
ELSEWHERE = "International"
US_REGIONS = {
    "Northeast": (
        "Connecticut", "Maine", "Massachusetts", "New Hampshire", "New Jersey",
        "New York", "Pennsylvania", "Rhode Island", "Vermont",
    ),
    "Midwest": (
        "Illinois", "Indiana", "Iowa", "Kansas", "Michigan", "Minnesota",
        "Missouri", "Nebraska", "North Dakota", "Ohio", "South Dakota", "Wisconsin",
    ),
    "South": (
        "Alabama", "Arkansas", "Delaware", "Florida", "Georgia", "Kentucky",
        "Louisiana", "Maryland", "Mississippi", "North Carolina", "Oklahoma",
        "South Carolina", "Tennessee", "Texas", "Virginia", "West Virginia",
    ),
    "West": (
        "Alaska", "Arizona", "California", "Colorado", "Hawaii", "Idaho",
        "Montana", "Nevada", "New Mexico", "Oregon", "Utah", "Washington", "Wyoming",
    ),
}
TENURE_STEPS = ((6, "0-6 months"), (12, "6-12 months"), (24, "1-2 years"))
TENURE_LONGEST = "2+ years"


def us_region(country: Column, state: Column) -> Column:
    """Sales region of a place; a NULL country is judged by its state alone."""
    by_state = [F.when(state.isin(*states), name) for name, states in US_REGIONS.items()]
    return F.coalesce(F.when(country != HOME_COUNTRY, ELSEWHERE), *by_state, F.lit(ELSEWHERE))


def tenure_bucket(joined_at: Column, as_of: Column) -> Column:
    """How long a driver has been with us at ``as_of``; unknown counts as longest."""
    recent = [F.when(joined_at >= months_before(as_of, months), label) for months, label in TENURE_STEPS]
    return F.coalesce(*recent, F.lit(TENURE_LONGEST))


def promo_discount(kind: Column, value: Column, base_fare: Column) -> Column:
    """Percent or flat discount, never above the base fare, to the cent."""
    percent = base_fare * value / F.lit(100).cast("decimal(3,0)")
    return round_half_even(F.least(F.when(kind == "percent", percent).otherwise(value), base_fare), 2)


def _fare(base_fare: Column, surge: Column, tip: Column, discount: Column) -> Column:
    return base_fare * surge + tip - discount


def fact_fare(base_fare: Column, surge: Column, tip: Column, discount: Column) -> Column:
    """Fare stored in the warehouse: NULL parts count as zero, ties go to even."""
    parts = (zero_if_null(part) for part in (base_fare, surge, tip, discount))
    return round_half_even(_fare(*parts), 2)


def view_fare(base_fare: Column, surge: Column, tip: Column, discount: Column) -> Column:
    """Fare shown by the operational view: NULL spreads, ties go up."""
    return round_half_up(_fare(base_fare, surge, tip, discount), 2)


def time_of_day(hour: Column) -> Column:
    return (
        F.when(hour.between(6, 11), "Morning")
        .when(hour.between(12, 16), "Afternoon")
        .when(hour.between(17, 20), "Evening")
        .otherwise("Night")
    )


def is_rush_hour(hour: Column) -> Column:
    return hour.between(7, 8) | hour.between(17, 19)
