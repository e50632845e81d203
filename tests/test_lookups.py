from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ridelake.operators import lookups
from tests.conftest import plan_of, rows_of


@pytest.fixture
def facts(spark):
    """A third of the rows share one key, a sixth have none, some keys are unknown."""
    number = F.col("id")
    key = F.when(number % 3 == 0, 7).when(number % 6 == 1, F.lit(None)).otherwise(number % 60)
    return spark.range(6000).select(number, key.cast("long").alias("k"))


@pytest.fixture
def table(spark):
    return spark.range(50).select(F.col("id").alias("key"), F.concat(F.lit("n"), F.col("id").cast("string")).alias("name"))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_spread_join_equals_broadcast_join(facts, table, how):
    small = lookups.lookup(facts, table, "k", "key", {"name": "name"}, row_id="id", how=how)
    large = lookups.lookup(facts, table, "k", "key", {"name": "name"}, row_id="id", how=how, limit=0)
    assert "BroadcastHashJoin" in plan_of(small)
    assert rows_of(small.select("id", "k", "name")) == rows_of(large.select("id", "k", "name"))
    brute = {i: f"n{k}" if k is not None and k < 50 else None for i, k in rows_of(facts)}
    if how == "inner":
        brute = {i: name for i, name in brute.items() if name is not None}
    assert dict(rows_of(large.select("id", "name"))) == brute



def test_crowded_keys_and_their_pieces(facts):
    assert lookups.crowded_keys(facts, "k", 12) == [(7, 4)]  # 2000 of 6000 rows are 4 of 12 shares


def test_no_keys_no_crowd(facts):
    assert lookups.crowded_keys(facts.where("id < 0"), "k", 12) == []
    assert lookups.crowded_keys(facts.where("k IS NULL"), "k", 12) == []
    assert lookups.crowded_keys(facts.select("id"), "id", 12) == []


def test_spread_join_spreads_hot_and_null_keys(spark, facts, table):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lookups.lookup(facts, table, "k", "key", {"name": "name"}, row_id="id", limit=0)
        per_task = joined.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        plain = facts.join(table, facts.k == table.key, "left").groupBy(F.spark_partition_id()).count()
        assert per_task < 1000 < plain.agg(F.max("count")).first()[0]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_sizes_are_measured(spark, table):
    sizes = lookups.table_sizes({"named": table, "keys": table.select("key"), "none": table.where("key < 0")})
    assert sizes["named"].rows == sizes["keys"].rows == 50
    assert sizes["named"].bytes > sizes["keys"].bytes > 0
    assert sizes["none"] == (0, 0)


def test_text_keys_spread_too(spark, facts, table):
    texts = facts.withColumn("k", F.concat(F.lit("n"), F.col("k").cast("string")))
    joined = lookups.lookup(texts, table, "k", "name", {"number": "key"}, row_id="id", limit=0)
    assert joined.where("number IS NOT NULL").count() == facts.where("k < 50").count()


def test_one_value_lookup(frame):
    facts = frame("id int, name string", (1, "a"), (2, "b"), (3, None), (4, "zz"))
    single = frame("key int, name string", (10, "a"), (20, "b"), (30, "c"))
    found = lookups.one_value_lookup(facts, single, "name", "name", "key", "key", row_id="id")
    assert rows_of(found.select("id", "key")) == [(1, 10), (2, 20), (3, None), (4, None)]


def test_one_value_lookup_refuses_a_second_match(frame):
    facts = frame("id int, name string", (1, "a"))
    double = frame("key int, name string", (10, "a"), (11, "a"))
    with pytest.raises(Exception, match="more than one row"):
        lookups.one_value_lookup(facts, double, "name", "name", "key", "key", row_id="id").collect()
    unused = frame("key int, name string", (10, "a"), (20, "b"), (21, "b"))
    assert lookups.one_value_lookup(facts, unused, "name", "name", "key", "key", row_id="id").first()["key"] == 10


DRIVERS = ("id int", 1, 2, None)


@pytest.mark.parametrize(
    ("others", "kept"),
    [
        ([1, 1], [2]),
        ([1, None], []),
        ([None], []),
        ([], [1, 2, None]),
        ([5], [1, 2]),
    ],
)
def test_not_in_follows_null_rules(spark, frame, others, kept):
    drivers, trips = frame(*DRIVERS), frame("driver int", *others)
    got = [r[0] for r in lookups.not_in(drivers, "id", trips, "driver").collect()]
    drivers.createOrReplaceTempView("d")
    trips.createOrReplaceTempView("t")
    native = [r[0] for r in spark.sql("SELECT id FROM d WHERE id NOT IN (SELECT driver FROM t)").collect()]
    assert sorted(got, key=repr) == sorted(kept, key=repr) == sorted(native, key=repr)


def test_without_match_keeps_null_keys(frame):
    got = lookups.without_match(frame(*DRIVERS), "id", frame("driver int", 1, None), "driver")
    assert rows_of(got) == [(2,), (None,)]


def test_tables_broadcast_together_stay_within_the_limit():
    sizes = {"small": lookups.Size(1, 10), "twice": lookups.Size(1, 30), "large": lookups.Size(1, 50)}
    assert lookups.together(sizes, {"twice": 2}, limit=100) == {"small": 10, "twice": 30, "large": -1}
    assert lookups.together(sizes, limit=100) == {"small": 10, "twice": 30, "large": 50}
    assert lookups.together(sizes, limit=0) == {"small": -1, "twice": -1, "large": -1}


def test_one_pass_finds_the_crowded_keys_of_a_whole_chain(spark, facts, table, monkeypatch):
    """However many lookups a chain spreads, their crowded keys are looked for once, in all columns together."""
    wide = facts.withColumns({"j": F.col("id") % 2, "u": F.col("id")})
    steps = [lookups.Step("t", key, "key", {f"name_{key}": "name"}) for key in ("k", "j", "u", "k")]
    sizes = {"t": lookups.Size(50, 5000)}
    plain, seen = lookups.crowds, []

    def counted(*args):
        seen.append(plain(*args))
        return seen[-1]

    monkeypatch.setattr(lookups, "crowds", counted)
    spread = lookups.chain(wide, {"t": table}, steps[:3], sizes, "id", limit=0)
    assert len(seen) == 1 and set(seen[0]) == {"k", "j", "u"} and [k for k, _ in seen[0]["j"]] == [0, 1] and seen[0]["u"] == []
    sent = lookups.chain(wide, {"t": table}, steps[:3], sizes, "id")
    assert len(seen) == 1 and plan_of(sent).count("BroadcastHashJoin") == 3
    assert rows_of(spread.select("id", "name_k", "name_j", "name_u")) == rows_of(sent.select("id", "name_k", "name_j", "name_u"))
