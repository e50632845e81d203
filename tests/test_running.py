from __future__ import annotations

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ridelake.operators.running import cut_times, running_total, share_of_total
from tests.conftest import plan_of, rows_of

DDL = "id int, driver int, at timestamp_ntz, fare decimal(10,2)"


def test_ties_share_a_total(frame):
    nine = datetime(2024, 1, 1, 9)
    trips = frame(DDL, (1, 1, nine, Decimal(10)), (2, 1, nine, Decimal(5)), (3, 1, nine + timedelta(hours=3), Decimal(1)), (4, 2, nine, Decimal(7)))
    got = running_total(trips, "driver", "at", "fare", "total").select("id", "total")
    assert rows_of(got) == [(1, Decimal("15.00")), (2, Decimal("15.00")), (3, Decimal("16.00")), (4, Decimal("7.00"))]


@pytest.mark.parametrize("seed", range(3))
def test_equals_one_window_over_all(frame, seed):
    rng = random.Random(seed)
    start = datetime(2024, 1, 1, 22)
    rows = []
    for i in range(400):
        driver = 1 if rng.random() < 0.5 else rng.randrange(2, 6)
        at = start + timedelta(minutes=rng.randrange(600))
        rows.append((i, driver, at, None if rng.random() < 0.1 else Decimal(rng.randrange(1, 99999)) / 100))
    trips = frame(DDL, *rows)
    whole = Window.partitionBy("driver").orderBy("at")
    want = trips.select("id", F.sum("fare").over(whole).cast("decimal(38,2)").alias("total"))
    got = running_total(trips, "driver", "at", "fare", "total").select("id", F.col("total").cast("decimal(38,2)"))
    assert rows_of(got) == rows_of(want)


def test_no_task_sees_a_crowded_history(frame):
    """A crowded driver's rows are windowed by range of time; only sums per range meet per driver."""
    crowd = [(i, 1, datetime(2024, 1, 1) + timedelta(minutes=i), Decimal(1)) for i in range(300)]
    text = plan_of(running_total(frame(DDL, *crowd), "driver", "at", "fare", "total"))
    windows = [line for line in text.splitlines() if "Window [" in line]
    assert len(windows) == 2
    assert sum("hashpartitioning(driver" in line and "_cut" in line for line in text.splitlines()) >= 1
    even = [(i, i, datetime(2024, 1, 1), Decimal(1)) for i in range(300)]
    text = plan_of(running_total(frame(DDL, *even), "driver", "at", "fare", "total"))
    assert text.count("Window [") == 1 and "Join" not in text


def test_a_busy_minute_is_cut_too(spark, frame):
    """All rows of one driver in one minute are the work of several tasks, and ties keep one total."""
    crowd = [(i, 1, datetime(2024, 1, 1, 9, 30, i % 7, 1000 * (i % 50)), Decimal(1)) for i in range(600)]
    rows = frame(DDL, *crowd)
    total = running_total(rows, "driver", "at", "fare", "total")
    want = {i: sum(other <= at for _, _, other, _ in crowd) for i, _, at, _ in crowd}
    assert {row["id"]: row["total"] for row in total.collect()} == want
    (_, cuts), = cut_times(rows, "driver", "at", [(1, 4)]).collect()
    assert len(cuts) == 3
    sizes = [sum(a <= at < b for *_, at, _ in crowd) for a, b in zip([datetime.min, *cuts], [*cuts, datetime.max])]
    assert sum(sizes) == 600 and max(sizes) < 250
    one = frame(DDL, *[(i, 1, datetime(2024, 1, 1), Decimal(1)) for i in range(300)])
    assert {row["total"] for row in running_total(one, "driver", "at", "fare", "total").collect()} == {300}


def test_cuts_follow_each_keys_own_times(frame):
    start = datetime(2024, 1, 1)
    rows = [(i, 1, start + timedelta(seconds=i), Decimal(1)) for i in range(800)]
    rows += [(1000 + i, 2, start - timedelta(days=i), Decimal(1)) for i in range(400)]
    cuts = {r.driver: r["_cuts"] for r in cut_times(frame(DDL, *rows), "driver", "at", [(1, 8), (2, 4)]).collect()}
    for driver, pieces in ((1, 8), (2, 4)):
        times = [at for _, d, at, _ in rows if d == driver]
        inner = [datetime.min, *cuts[driver], datetime.max]
        sizes = [sum(a <= at < b for at in times) for a, b in zip(inner, inner[1:])]
        assert len(sizes) == pieces and max(sizes) < 1.4 * len(times) / pieces


def test_share_of_total(frame):
    hours = frame("hour int, n bigint", (0, 1), (1, 2), (2, 5))
    got = share_of_total(hours, "n", "pct", 2).select("hour", "pct")
    assert rows_of(got) == [(0, Decimal("12.50")), (1, Decimal("25.00")), (2, Decimal("62.50"))]
