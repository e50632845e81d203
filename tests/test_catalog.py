from __future__ import annotations

import shutil

import pytest

import __spark_entry__ as entry
from ridelake.catalog.oracle import ORACLE
from ridelake.catalog.queries import QUERIES
from ridelake.operators import lookups
from ridelake.sources import rides
from ridelake.sources import stored as stored_tables
from ridelake.sources.stored import TABLES
from tests.compare import difference, sql_session
from tests.conftest import plan_of



@pytest.fixture(scope="module")
def con(folder):
    return sql_session(folder)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, folder, name):
    assert difference(spark, con, QUERIES[name], ORACLE[name], folder) is None


@pytest.mark.parametrize(
    "name", ["completed_trips_view", "fact_trips", "high_value", "normalize_trips", "promo_discount", "running_fare", "scalar_lookup"]
)
def test_query_matches_sql_beyond_the_broadcast_bound(spark, con, folder, name, monkeypatch):
    monkeypatch.setattr(lookups, "BROADCAST_BYTES", 0)
    assert difference(spark, con, QUERIES[name], ORACLE[name], folder) is None


def test_every_query_has_a_check():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_rows_and_no_unbounded_pairs(spark, folder, name):
    """Everything stays in the JVM, and every join has a key."""
    plan = plan_of(QUERIES[name](spark, folder))
    assert not any(bad in plan for bad in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"))


@pytest.mark.parametrize(
    ("name", "pushed", "columns"),
    [
        ("total_rides", None, "struct<>"),
        ("completed_fare_total", "EqualTo(o_orderstatus,F)", "struct<o_orderstatus:string,o_totalprice:double>"),
        ("recent_completed", "EqualTo(o_orderstatus,F)", None),
        ("status_breakdown", None, "struct<o_orderstatus:string>"),
        ("dq_duplicate_keys", None, "struct<l_orderkey:bigint,l_linenumber:int>"),
    ],
)
def test_scans_read_only_what_is_needed(spark, folder, name, pushed, columns):
    plan = plan_of(QUERIES[name](spark, folder))
    if pushed:
        assert pushed in plan
    if columns:
        assert f"ReadSchema: {columns}" in plan


def test_top_k_does_not_sort_everything(spark, folder):
    assert "TakeOrderedAndProject" in plan_of(QUERIES["recent_completed"](spark, folder))


def test_rides_of_people_who_are_not_stored_stay(spark, folder, tmp_path):
    """The same rides whichever columns are asked for; and the queries over them still match their SQL."""
    for name in TABLES:
        rows = spark.read.parquet(f"{folder}/{name}.parquet")
        known = {"customer": "c_custkey % 4 <> 1", "supplier": "s_suppkey <> 2", "nation": "n_nationkey <> 3"}.get(name, "true")
        rows.where(known).coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    few = str(tmp_path)
    every = rides.rides(spark, few)
    named = rides.rides(spark, few, "driver_name", "passenger_name", "pickup_city", "dropoff_city")
    placed = rides.trips(spark, few, places=True)
    assert every.count() == named.count() == placed.count() == spark.read.parquet(f"{folder}/orders.parquet").count()
    assert named.where("passenger_name IS NULL").count() > 0 and placed.where("pickup_location_id IS NULL").count() > 0
    con = sql_session(few)
    con.execute("".join(f"CREATE OR REPLACE VIEW {n} AS SELECT * FROM '{few}/{n}.parquet/*.parquet';" for n in TABLES))
    for name in ("total_rides", "status_breakdown", "same_city", "driver_trips", "temp_snapshot"):
        assert difference(spark, con, QUERIES[name], ORACLE[name], few) is None, name


def test_sizes_of_stored_tables_are_measured_once_for_each_state(spark, folder, tmp_path, monkeypatch):
    """A file that changes is measured again, and so are other columns; nothing else is."""
    measured = []
    monkeypatch.setattr(stored_tables, "table_sizes", lambda frames: measured.append(sorted(frames)) or lookups.table_sizes(frames))
    shutil.copy(f"{folder}/nation.parquet", tmp_path / "nation.parquet")
    shutil.copy(f"{folder}/supplier.parquet", tmp_path / "supplier.parquet")
    both = {"nation": ("n_nationkey", "n_name"), "supplier": ("s_suppkey",)}
    for _ in range(2):
        found = stored_tables.stored_sizes(spark, str(tmp_path), both)
    assert measured == [["nation", "supplier"]]
    assert found == lookups.table_sizes({t: stored_tables.stored(spark, str(tmp_path), t).select(*c) for t, c in both.items()})
    assert stored_tables.stored_sizes(spark, str(tmp_path), {"nation": ("n_name",)})["nation"].bytes < found["nation"].bytes
    stored_tables.stored(spark, folder, "nation").limit(3).toPandas().to_parquet(tmp_path / "nation.parquet")
    assert stored_tables.stored_sizes(spark, str(tmp_path), both)["nation"].rows == 3
    assert measured == [["nation", "supplier"], ["nation"], ["nation"]]
