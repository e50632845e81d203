from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ridelake import schemas
from ridelake.operators.changes import with_defaults
from ridelake.operators.quality import BatchRejected, batch_report
from ridelake.plans import constraints
from ridelake.sources.readers import read_table
from tests.conftest import rows_of
from tests.test_io import BARE, GOOD, HEADER

AT = datetime(2024, 1, 1)

# One row that keeps every rule, per table, and changes that each break exactly one.
TABLES = {
    "locations": ((1, "Austin", "Texas", "USA", Decimal("30.25"), None), {"city_name": (None, "city_name_not_null"), "country": ("x" * 101, "country_width")}),
    "drivers": ((1, "D", "a@b", "1", "active", AT), {"status": ("banned", "status_enum"), "joined_at": (None, "joined_at_not_null"), "email": ("e" * 151, "email_width")}),
    "driver_licenses": ((1, 1, "L1", None, date(2025, 1, 1), True), {"issued_date": (date(2025, 1, 1), "license_dates"), "driver_id": (9, "driver_id_reference")}),
    "passengers": ((1, "P", None, None, "banned", AT), {"status": ("suspended", "status_enum")}),
    "payment_methods": ((1, "cash", None, True), {"type": ("barter", "type_enum"), "name": ("n" * 31, "name_width")}),
    "vehicles": ((1, "PL", None, None, 1981, None, "xl", True), {"year": (1980, "year_above"), "category": ("bike", "category_enum")}),
    "vehicle_assignments": ((1, 1, 1, AT, None), {"unassigned_at": (AT, "assignment_dates"), "vehicle_id": (9, "vehicle_id_reference")}),
    "promo_codes": ((1, "TEN", "percent", Decimal("10"), None, AT, None, True), {"valid_from": (AT, "promo_dates"), "discount_value": (Decimal("0"), "discount_value_above"), "discount_type": ("half", "discount_type_enum")}),
    "trips": (
        (1, 1, 1, None, 1, 1, None, None, Decimal("10"), Decimal("0"), Decimal("10"), Decimal("1"), Decimal("2"), "completed", AT, AT, None, Decimal("5")),
        {
            "discount_amount": (Decimal("10.01"), "discount_within_base"),
            "completed_at": (None, "completed_has_time"),
            "surge_multiplier": (Decimal("0.99"), "surge_multiplier_min"),
            "passenger_rating": (Decimal("5.1"), "passenger_rating_range"),
            "tip_amount": (Decimal("-1"), "tip_amount_min"),
            "status": ("pending", "status_enum"),
            "vehicle_id": (9, "vehicle_id_reference"),
            "promo_code_id": (9, "promo_code_id_reference"),
        },
    ),
    "trip_cancellations": ((1, AT, "system", None), {"cancelled_by": ("police", "cancelled_by_enum"), "trip_id": (9, "trip_id_reference")}),
}


@pytest.fixture(scope="module")
def model(spark):
    return {
        name: spark.createDataFrame([row], _open(constraints.SCHEMAS[name])).cache() for name, (row, _) in TABLES.items()
    }


def _open(schema):
    return schemas.table(*[(field.name, field.dataType, True) for field in schema])


def broken(df, table, model):
    report = batch_report(df, constraints.SCHEMAS[table].names[0], **constraints.operational_constraints(table, model))
    return [row["rule"] for row in report.where("violations > 0").collect()]


@pytest.mark.parametrize("table", TABLES)
def test_each_declared_rule(spark, model, table):
    row, changes = TABLES[table]
    names = constraints.SCHEMAS[table].names
    assert broken(model[table], table, model) == []
    for column, (value, rule) in changes.items():
        changed = [value if name == column else kept for name, kept in zip(names, row)]
        assert broken(spark.createDataFrame([tuple(changed)], _open(constraints.SCHEMAS[table])), table, model) == [rule]


@pytest.mark.parametrize(
    ("table", "rows", "rule"),
    [
        ("driver_licenses", [(1, 1, "a", None, date(2025, 1, 1), True), (2, 1, "b", None, date(2025, 1, 1), True)], "driver_id_unique"),
        ("vehicle_assignments", [(1, 1, 1, AT, None), (2, 1, 1, AT, None)], "vehicle_id_unique"),
        ("locations", [(1, "A", "S", "C", None, None), (2, "A", "S", "C", None, None)], "city_name_state_province_country_unique"),
    ],
)
def test_conditional_and_composite_keys(spark, model, table, rows, rule):
    schema = _open(constraints.SCHEMAS[table])
    assert broken(spark.createDataFrame(rows, schema), table, model) == [rule]
    loose = [row if i == 0 else tuple(False if v is True else datetime(2025, 1, 1) if v is None and table == "vehicle_assignments" else None if v == "S" else v for v in row) for i, row in enumerate(rows)]
    assert broken(spark.createDataFrame(loose, schema), table, model) == []


def test_defaults_make_a_short_insert_valid(spark, model, frame):
    short = frame("driver_id bigint, name string, email string, phone_number string", (7, "N", None, None))
    filled = schemas.conform(with_defaults(short, constraints.defaults("drivers")), schemas.DRIVERS)
    assert broken(filled, "drivers", model) == []
    assert filled.first()["status"] == "active"


@pytest.fixture
def csv(tmp_path):
    def write(*lines):
        path = tmp_path / "rides.csv"
        path.write_text("\n".join([HEADER, *lines]) + "\n")
        return str(path)

    return write


def test_flat_load_replaces_the_table(spark, csv, tmp_path):
    path = str(tmp_path / "rides")
    assert constraints.load_rides(spark, csv(GOOD), path) == 1
    assert constraints.load_rides(spark, csv(GOOD, BARE), path) == 2
    stored = read_table(spark, path)
    assert stored.count() == 2
    assert stored.dtypes == [(f.name, f.dataType.simpleString()) for f in schemas.RIDES]


@pytest.mark.parametrize(
    ("bad", "rule"),
    [
        (GOOD.replace("4.6", "99"), "rating_fits"),
        (GOOD.replace("4.6", "0.5"), "rating_range"),
        (GOOD.replace("17.96", "-1"), "fare_amount_min"),
        (GOOD.replace("17.96", "free"), "fare_amount_fits"),
        (GOOD.replace("completed", "pending"), "ride_status_enum"),
        (GOOD.replace("Ramesh", ""), "driver_name_not_null"),
        (GOOD.replace("Birgunj", "B" * 101), "pickup_city_width"),
        (BARE.replace("2,S", "02,S"), "ride_key_unique"),
    ],
)
def test_flat_load_is_all_or_nothing(spark, csv, tmp_path, bad, rule):
    path = str(tmp_path / "rides")
    constraints.load_rides(spark, csv(BARE), path)
    with pytest.raises(BatchRejected) as error:
        constraints.load_rides(spark, csv(BARE, bad), path)
    assert error.value.rule == rule
    assert rows_of(read_table(spark, path).select(F.col("ride_id"))) == [(2,)]
