from __future__ import annotations

import os
import subprocess
import sys
import time
from datetime import datetime
from decimal import Decimal
from pathlib import Path
from unittest import mock

import pytest
from pyspark.sql import functions as F

from ridelake import schemas
from ridelake.operators.quality import between, rule_report
from ridelake.plans import flat
from ridelake.sources import readers, writers
from tests.conftest import plan_of, rows_of

HEADER = ",".join(schemas.RIDES.names)
GOOD = '1,Ramesh,"Dahal, Sita",Birgunj,Kathmandu,17.96,31.75,completed,2024-10-27 12:16:55,2024-10-27 13:26:12.960719,4.6,esewa'
BARE = "2,Sita,Maya,Pokhara,Pokhara,500.00,3.10,no_show,2024-10-28 08:00:00,,,"


@pytest.fixture
def csv(tmp_path):
    def write(*lines):
        path = tmp_path / "rides.csv"
        path.write_text("\n".join([HEADER, *lines]) + "\n")
        return str(path)

    return write


def test_delimited_load(spark, csv, tmp_path):
    rides = readers.read_delimited(spark, csv(GOOD, BARE), schemas.RIDES)
    first, second = rides.orderBy("ride_id").collect()
    assert first["passenger_name"] == "Dahal, Sita"
    assert first["fare_amount"] == Decimal("17.96")
    assert first["completed_at"] == datetime(2024, 10, 27, 13, 26, 12, 960719)
    assert second["completed_at"] is second["rating"] is second["payment_method"] is None
    assert writers.append(rides, str(tmp_path / "rides")) == 2
    assert rows_of(flat.status_breakdown(readers.read_table(spark, str(tmp_path / "rides")))) == [("completed", 1), ("no_show", 1)]


def test_a_malformed_row_stops_the_load(spark, csv):
    rides = readers.read_delimited(spark, csv(GOOD, BARE.replace("500.00", "lots")), schemas.RIDES)
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|lots"):
        rides.collect()


def test_rules_run_before_narrowing(spark, csv):
    wide = readers.read_delimited_wide(spark, csv(GOOD, BARE, GOOD.replace("1,R", "3,R").replace("4.6", "99")), schemas.RIDES.names)
    typed = wide.withColumns({"ride_id": F.col("ride_id").cast("int"), "rating": F.col("rating").cast("decimal(10,2)")})
    assert rows_of(rule_report(typed, [between("rating", 1, 5)], "ride_id")) == [("rating_range", 1, 3)]


def test_empty_text_and_null_stay_apart_in_storage(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    writers.replace(frame("id int, status string", (1, ""), (2, None), (3, "x")), path)
    stored = readers.read_table(spark, path)
    assert rows_of(stored.where(F.col("status") == "").select("id")) == [(1,)]
    assert rows_of(stored.where(F.col("status").isNull()).select("id")) == [(2,)]


def test_append_replace_create(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    rows = frame("id int, day int", (1, 1), (2, 2))
    assert not writers.table_exists(spark, path)
    assert writers.append(rows, path) == 2
    assert writers.append(rows, path) == 2
    assert readers.read_table(spark, path).count() == 4
    assert writers.replace(rows, path, by=("day",)) == 2
    assert readers.read_table(spark, path).where("day = 2").count() == 1
    writers.create_if_absent(spark, path, rows.schema)
    assert readers.read_table(spark, path).count() == 2
    writers.create_if_absent(spark, str(tmp_path / "new"), rows.schema)
    assert readers.read_table(spark, str(tmp_path / "new")).dtypes == rows.dtypes
    assert writers.append(rows.where("id > 9"), path) == 0


def test_bucketed_tables_join_without_a_shuffle(spark, frame):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left, right = frame("k bigint, v int", (1, 1), (2, 2)), frame("k bigint, w int", (1, 5))
        for name, rows in (("bucketed_left", left), ("bucketed_right", right)):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
            writers.replace_bucketed(rows, name, "k", 4)
        joined = spark.table("bucketed_left").join(spark.table("bucketed_right"), "k", "left")
        assert "Exchange" not in plan_of(joined)
        assert rows_of(joined) == [(1, 1, 5), (2, 2, None)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_snapshot_does_not_follow_its_source(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    writers.append(frame("id int", 1), path)
    live = writers.named_view(readers.read_table(spark, path), "live_rides")
    frozen = writers.snapshot(live, "temp_rides")
    writers.append(frame("id int", 2), path)
    assert frozen.count() == 1 and spark.table("temp_rides").count() == 1
    assert readers.read_table(spark, path).count() == 2


def test_database_reads_are_sliced():
    session = mock.MagicMock()
    reader = session.read.format.return_value.options.return_value
    reader.option.return_value = reader
    readers.read_jdbc(session, "jdbc:x", "SELECT 1", split_on="trip_id", low=1, high=9, pieces=4, user="u")
    given = dict(call.args for call in reader.option.call_args_list)
    assert given["dbtable"] == "(SELECT 1) AS source"
    assert (given["partitionColumn"], given["lowerBound"], given["upperBound"], given["numPartitions"]) == ("trip_id", "1", "9", "4")
    reader.load.assert_called_once_with()


def test_series(spark):
    assert [str(r[0]) for r in readers.day_series(spark, "2024-02-28", "2024-03-01").collect()] == ["2024-02-28", "2024-02-29", "2024-03-01"]
    assert [r[0] for r in readers.number_series(spark, 0, 45, 15, "m").collect()] == [0, 15, 30, 45]


def test_inline_rows(spark):
    assert rows_of(readers.inline_rows(spark, [(1, "a"), (2, None)], schemas.table(("id", schemas.LONG), ("v", schemas.TEXT, True)))) == [(1, "a"), (2, None)]


def test_conform_orders_and_narrows(frame):
    got = schemas.conform(frame("name string, x int, driver_id int", ("a", 1, 2)), schemas.DRIVER_NAMES)
    assert got.dtypes == [("driver_id", "bigint"), ("name", "string")]


def test_a_failed_replacement_leaves_the_old_table(spark, frame, tmp_path):
    path = str(tmp_path / "kept")
    writers.replace(frame("id int", 1, 2), path)
    broken = frame("id int", 1).select(F.raise_error(F.lit("stop")).cast("int").alias("id"))
    with pytest.raises(Exception, match="stop"):
        writers.replace(broken, path)
    assert readers.read_table(spark, path).count() == 2
    assert writers.replace(readers.read_table(spark, path).where("id = 1"), path) == 1
    assert rows_of(readers.read_table(spark, path)) == [(1,)]


def test_a_snapshot_can_be_discarded(spark, frame):
    frozen = writers.snapshot(frame("id int", 1, 2))
    (folder,) = {name.rsplit("/", 1)[0].removeprefix("file://") for name in frozen.inputFiles()}
    writers.discard(frozen)
    assert not os.path.exists(folder)
    writers.discard(frame("id int", 1))


LEAVES = """
import sys
from ridelake.catalog.queries import QUERIES
from ridelake.session import local_session
spark = local_session("leaves", 2)
for name in ("temp_snapshot", "replace_table", "scalar_lookup", "csv_empty_text"):
    assert QUERIES[name](spark, sys.argv[1]).count() > 0
spark.stop()
"""


def test_queries_leave_no_folder_behind(folder, tmp_path):
    """What lazy results read goes with the application."""
    shared = tmp_path / "shared"
    shared.mkdir()
    more = f"--conf spark.checkpoint.dir={shared} pyspark-shell"
    root = str(Path(__file__).resolve().parent.parent)
    done = subprocess.run(
        [sys.executable, "-c", LEAVES, folder], cwd=root, env={**os.environ, "PYSPARK_SUBMIT_ARGS": more}, capture_output=True, text=True, timeout=300
    )
    assert done.returncode == 0, done.stderr[-2000:]
    for _ in range(100):  # the session's process ends after ours
        left = [p for p in shared.rglob("*") if p.is_file()]
        if not left:
            break
        time.sleep(0.2)
    assert left == [] and len(list(shared.iterdir())) <= 1  # Spark's own, empty folder
