from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ridelake.functions import numeric, ordering, rules, temporal, text


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("raw", "clean"),
    [
        (" BISHAL j \n  Rijal", "Bishal J Rijal"),
        ("ramesh shrestha", "Ramesh Shrestha"),
        ("o'brien-smith", "O'Brien-Smith"),
        ("x2y 3rd", "X2y 3rd"),
        ("élodie ÅKE", "Élodie Åke"),
        ("", ""),
        ("   ", ""),
        (None, None),
    ],
)
def test_clean_name(spark, raw, clean):
    assert value(spark, text.clean_name(F.lit(raw).cast("string"))) == clean


def test_title_case_differs_from_initcap_only_after_punctuation(spark):
    assert value(spark, F.initcap(F.lit("o'brien"))) == "O'brien"
    assert value(spark, text.title_case(F.lit("o'brien"))) == "O'Brien"


def test_spaces(spark):
    assert value(spark, text.halve_double_spaces(F.lit("a    b"))) == "a  b"
    assert value(spark, text.squash_spaces(F.lit(" a \t\n b"))) == " a b"
    assert value(spark, F.trim(F.lit(" \ta "))) == "\ta"


def test_concat_skips_null_where_pipes_do_not(spark):
    missing = F.lit(None).cast("string")
    assert value(spark, text.concat_skip_null(F.lit("a"), missing, F.lit("b"))) == "ab"
    assert value(spark, F.concat(F.lit("a"), missing)) is None


def moment(text_):
    return temporal.ntz(text_)


def test_calendar_parts(spark):
    ts = moment("2024-03-10 02:37:59")
    assert value(spark, temporal.date_key(ts)) == 20240310
    assert value(spark, temporal.year_month(ts)) == "2024-03"
    assert value(spark, temporal.month_name(ts)) == "March"
    assert value(spark, temporal.day_name(ts)) == "Sunday"
    assert value(spark, temporal.day_of_week(ts)) == 0
    assert value(spark, temporal.is_weekend(ts)) is True
    assert value(spark, temporal.quarter_hour_key(ts)) == 230
    assert value(spark, temporal.quarter_hour_key(moment("2024-01-01 14:37:00"))) == 1430
    assert value(spark, temporal.iso_week(moment("2023-01-01 00:00:00"))) == 52


def test_time_zone_never_enters(spark):
    """02:30 on a spring-forward day does not exist in New York; wall clocks do not care."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        start, end = moment("2024-03-10 01:30:00"), moment("2024-03-10 03:30:09.5")
        assert float(value(spark, temporal.minutes_between(start, end))) == pytest.approx(120 + 9.5 / 60)
        assert value(spark, temporal.quarter_hour_key(moment("2024-03-10 02:31:00"))) == 230
        assert value(spark, temporal.year_month(moment("2024-03-10 02:31:00"))) == "2024-03"
        assert value(spark, temporal.minute_number(moment("1970-01-02 03:59:00"))) == 27 * 60 + 59
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_months_before_clamps(spark):
    assert value(spark, temporal.months_before(moment("2024-08-31 10:00:00"), 6)) == datetime(2024, 2, 29, 10)


def test_two_roundings(spark):
    tie = F.lit("2.345").cast("decimal(10,4)")
    assert value(spark, numeric.round_half_even(tie, 2)) == Decimal("2.34")
    assert value(spark, numeric.round_half_up(tie, 2)) == Decimal("2.35")


def test_duration_tie_is_decimal(spark):
    """Nine seconds are 0.15 minutes: the tie goes to the even digit, 0.2."""
    took = temporal.minutes_between(moment("2024-01-01 00:00:00"), moment("2024-01-01 00:00:09"))
    assert value(spark, numeric.round_half_even(took, 1)) == Decimal("0.2")


def test_percent_of(spark):
    def percent(part, total, digits=2):
        return value(spark, numeric.percent_of(F.lit(part), F.lit(total), digits))

    assert percent(1, 3) == Decimal("33.33")
    assert percent(2, 3) == Decimal("66.67")
    assert percent(1, 8, 1) == Decimal("12.5")
    assert percent(1, 16, 1) == Decimal("6.3")
    assert percent(0, 0) is None


def test_exact_mean_rounds_once(frame):
    near_tie = frame("v decimal(10,2)", *[Decimal("1.00")] * 99_999, Decimal("501.99"))
    assert near_tie.agg(numeric.exact_mean(F.col("v"), 2).alias("v")).first()["v"] == Decimal("1.01")
    empty = frame("v decimal(10,2)")
    assert empty.agg(numeric.exact_mean(F.col("v"), 2).alias("v")).first()["v"] is None


def test_region(spark, frame):
    places = frame(
        "country string, state string, want string",
        ("USA", "Ohio", "Midwest"),
        ("USA", "Delaware", "South"),
        ("USA", "Wyoming", "West"),
        ("USA", "Maine", "Northeast"),
        ("USA", "Puerto Rico", "International"),
        ("Nepal", "Ohio", "International"),
        (None, "Texas", "South"),
        (None, None, "International"),
        ("USA", None, "International"),
    )
    got = places.withColumn("got", rules.us_region(F.col("country"), F.col("state")))
    assert got.where("got <> want OR got IS NULL").count() == 0


def test_tenure(frame):
    joined = frame(
        "at timestamp_ntz, want string",
        (datetime(2024, 1, 1), "0-6 months"),
        (datetime(2023, 12, 31, 23, 59), "6-12 months"),
        (datetime(2023, 7, 1), "6-12 months"),
        (datetime(2022, 7, 1), "1-2 years"),
        (datetime(2022, 6, 30), "2+ years"),
        (None, "2+ years"),
    )
    as_of = moment("2024-07-01 00:00:00")
    got = joined.withColumn("got", rules.tenure_bucket(F.col("at"), as_of))
    assert got.where("got <> want").count() == 0


def test_discount_is_capped(spark):
    def discount(kind, worth, base):
        money = "decimal(8,2)"
        return value(spark, rules.promo_discount(F.lit(kind), F.lit(worth).cast(money), F.lit(base).cast(money)))

    assert discount("percent", "15", "200.10") == Decimal("30.02")  # 30.015 to even
    assert discount("flat", "50", "200.10") == Decimal("50.00")
    assert discount("flat", "500", "200.10") == Decimal("200.10")
    assert discount("percent", "150", "200.10") == Decimal("200.10")


def test_fares_round_apart_at_a_tie(spark):
    parts = [F.lit(v).cast("decimal(10,2)") for v in ("0.10", "1.25", "0.00", "0.00")]
    assert value(spark, rules.fact_fare(*parts)) == Decimal("0.12")
    assert value(spark, rules.view_fare(*parts)) == Decimal("0.13")
    no_tip = [*parts[:2], F.lit(None).cast("decimal(8,2)"), parts[3]]
    assert value(spark, rules.fact_fare(*no_tip)) == Decimal("0.12")
    assert value(spark, rules.view_fare(*no_tip)) is None


def test_null_order(frame):
    numbers = frame("v int", 2, None, 1)
    assert [r.v for r in numbers.orderBy(ordering.ascending("v")).collect()] == [1, 2, None]
    assert [r.v for r in numbers.orderBy(ordering.descending("v")).collect()] == [None, 2, 1]


def test_date_column_works_for_keys(spark):
    day = F.lit(date(2024, 2, 29))
    assert value(spark, temporal.date_key(day)) == 20240229
    assert value(spark, temporal.day_of_week(day)) == 4


def test_white_space_of_other_scripts(spark):
    names = spark.createDataFrame([("anita\u3000rai",), ("anita\u2003 rai\u00a0",)], "name string")
    assert names.select(text.clean_name(F.col("name"))).distinct().collect() == [("Anita Rai",)]
