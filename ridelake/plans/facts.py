"""The trip fact: key resolution, measures, idempotent and incremental loading."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import partial

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ridelake import schemas
from ridelake.functions.numeric import round_half_even, zero_if_null
from ridelake.functions.rules import fact_fare
from ridelake.functions.temporal import date_key, minutes_between, ntz, quarter_hour_key
from ridelake.operators.changes import first_ranked, insert_if_absent
from ridelake.operators.keys import dense_keys, placed
from ridelake.operators.lookups import BROADCAST_BYTES, Size, Step, chain, partitions, table_sizes
from ridelake.plans.reports import daily_sums, merged
from ridelake.plans.warehouse import DIMENSIONS, Dimension, dim_date, dim_time
from ridelake.sources.buckets import KeyTable
from ridelake.sources.commits import Record, Store
from ridelake.sources.writers import discard, snapshot

#: The mark that loads keep: the latest request time among the stored facts.
MARK = "fact_trips.requested_at"


@dataclass(frozen=True)
class Link:
    """One key of the fact: where it is looked up, and whether a trip may lack it."""

    reason: str
    table: str
    by: str
    match: str
    take: str
    name: str
    optional: bool = False


# In the order in which a trip's first missing key is reported.
LINKS = (
    Link("date", "dim_date", "date_key", "date_key", "date_key", "known_date"),
    Link("driver", "dim_driver", "driver_id", "driver_id", "driver_key", "driver_key"),
    Link("vehicle", "dim_vehicle", "vehicle_id", "vehicle_id", "vehicle_key", "vehicle_key", optional=True),
    Link("time", "dim_time", "time_key", "time_key", "time_key", "known_time"),
    Link("passenger", "dim_passenger", "passenger_id", "passenger_id", "passenger_key", "passenger_key"),
    Link("pickup", "dim_location", "pickup_location_id", "location_id", "location_key", "pickup_location_key"),
    Link("dropoff", "dim_location", "dropoff_location_id", "location_id", "location_key", "dropoff_location_key"),
    Link("payment", "dim_payment_method", "payment_method_id", "payment_method_id", "payment_method_key", "payment_method_key", optional=True),
    Link("promo", "dim_promo_code", "promo_code_id", "promo_code_id", "promo_code_key", "promo_code_key", optional=True),
)

#: Ids of the source that a fact does not keep once its keys are resolved.
NATURAL_IDS = tuple(link.by for link in LINKS if link.by != link.name and link.match != link.take)


def _one_per_key(dims: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Lookup tables that cannot multiply trips: the newest key of each natural key."""
    single = {}
    for link in LINKS:
        keyed = dims[link.table].groupBy(link.match)
        single[link.table] = dims[link.table] if link.match == link.take else keyed.agg(F.max(link.take).alias(link.take))
    return single


def resolve_keys(
    trips: DataFrame, dims: dict[str, DataFrame], sizes: dict[str, Size] | None = None, limit: int | None = None
) -> DataFrame:
    """Surrogate keys for every trip and, where one is missing, the first reason why.

    A NULL id of an optional link passes; an unknown one does not.
    """
    tables = _one_per_key(dims)
    measured = sizes or table_sizes({link.table: dims[link.table].select(link.match, link.take) for link in LINKS})
    requested = F.col("requested_at")
    timed = trips.withColumns({"date_key": date_key(requested), "time_key": quarter_hour_key(requested)})
    steps = [Step(link.table, link.by, link.match, {link.name: link.take}) for link in LINKS]
    resolved = chain(timed, tables, steps, measured, "trip_id", limit)

    def missing(link: Link) -> Column:
        lost = F.col(link.name).isNull()
        return lost & F.col(link.by).isNotNull() if link.optional else lost

    reason = F.coalesce(*[F.when(missing(link), F.lit(link.reason)) for link in LINKS])
    return resolved.withColumn("reject_reason", reason).drop("known_date", "known_time")


def measures(resolved: DataFrame) -> DataFrame:
    """Fact rows of the trips that resolved, still without a ``trip_key``."""
    took = minutes_between(F.col("requested_at"), F.col("completed_at"))
    money = ("base_fare", "surge_multiplier", "tip_amount", "discount_amount")
    accepted = resolved.where(F.col("reject_reason").isNull())
    fact = accepted.withColumns(
        {
            **{name: zero_if_null(F.col(name)) for name in money},
            "source_trip_id": F.col("trip_id"),
            "fare_amount": fact_fare(*map(F.col, money)),
            "duration_minutes": F.when(F.col("status") == "completed", round_half_even(took, 1)),
            "trip_count": F.lit(1),
        }
    )
    return schemas.conform(fact, StructType([field for field in schemas.FACT_TRIPS if field.name != "trip_key"]))


def rejects(resolved: DataFrame) -> DataFrame:
    return resolved.where(F.col("reject_reason").isNotNull()).select("trip_id", "requested_at", "reject_reason")


def high_water_mark(facts: DataFrame, record: Record | None = None) -> DataFrame:
    """Latest request time already loaded; NULL for an empty warehouse.

    It lies on the last loaded day, which the record of the last load names, so only files of
    that day are opened. Facts that no load recorded are asked for their last day.
    """
    if record is None:
        last_day = facts.agg(F.max("date_key")).scalar()
    else:
        mark = loaded_until(record)
        last_day = F.lit(int(mark.strftime("%Y%m%d")) if mark else None).cast("int")
    return facts.where(F.col("date_key") == last_day).agg(F.max("requested_at").alias("watermark"))


def loaded_until(record: Record) -> datetime | None:
    """The mark as the loads have kept it; no fact is read."""
    mark = record.marks.get(MARK)
    return None if mark is None else datetime.fromisoformat(mark)


def slice_from(trips: DataFrame, since: datetime | None) -> DataFrame:
    """Trips requested at or after a time (all of them without one).

    Trips sharing the mark's own timestamp are read again, since some may be new;
    the keyed insert drops those already stored.
    """
    return trips if since is None else trips.where(F.col("requested_at") >= ntz(since))


def clashes(facts: DataFrame, stored: DataFrame | None) -> DataFrame:
    """Trip ids that several facts have, or that are stored already; only ids are compared.

    The source may move a stored trip to another time, so the whole target counts. ``_held`` tells
    whether the id is stored. A NULL id may be repeated, but is never held.
    """
    number = F.col("source_trip_id").alias("_id")
    counted = facts.groupBy(number).agg(F.count(F.lit(1)).alias("_n"))
    if stored is None:
        found = counted.withColumn("_held", F.lit(False))
    else:
        held = stored.select(number, F.lit(True).alias("_held"))
        loose = counted.coalesce(partitions(facts))  # forgets how it is dealt out, so the stored buckets set the join's partitions
        found = loose.join(held, "_id", "left").withColumn("_held", F.coalesce("_held", F.lit(False)))
    return found.where((F.col("_n") > 1) | F.col("_held")).select("_id", "_held")


def settled(facts: DataFrame, clashing: DataFrame, n: int | None = None) -> DataFrame:
    """Facts without those of stored ids; of an id that only the facts repeat, the earliest.

    ``n`` is how many ids clash, if that was counted: the facts stay where they are without any, and
    as long as the ids are few enough to be sent to them.
    """
    if n == 0:
        return facts
    few = n is not None and Size(n, 16 * 3 * n).bytes <= BROADCAST_BYTES
    same = F.col("source_trip_id").eqNullSafe(F.col("_id"))

    def sent(ids: DataFrame) -> DataFrame:
        return F.broadcast(ids) if few else ids

    repeated = clashing.where(~F.col("_held"))
    best = first_ranked(facts.join(sent(repeated), same, "left_semi"), ["source_trip_id"], ["requested_at"])
    return facts.join(sent(clashing), same, "left_anti").unionByName(best)


def unseen(facts: DataFrame, stored: DataFrame) -> DataFrame:
    """Facts whose trip id is stored nowhere, at whatever time the trip was requested then."""
    return settled(facts, clashes(facts, stored))


def new_facts(trips: DataFrame, dims: dict[str, DataFrame], stored: DataFrame | None = None) -> DataFrame:
    """Facts a load would add, by trip id; loading the same trips twice adds nothing."""
    return insert_if_absent(measures(resolve_keys(trips, dims)), stored, ["source_trip_id"], ["requested_at"])


def key_sizes(record: Record) -> dict[str, Size]:
    """What the key columns of the stored dimensions measure, from the rows that the loads counted."""
    rows = {link.table: record.tables[link.table].rows for link in LINKS}
    return {table: Size(n, 16 * 3 * n) for table, n in rows.items()}  # two numbers a row


def with_natural_ids(facts: DataFrame, dims: dict[str, DataFrame], sizes: dict[str, Size] | None = None) -> DataFrame:
    """Facts with each surrogate key replaced by the natural id of the dimension row it points at."""
    links = [link for link in LINKS if link.match != link.take]
    measured = sizes or table_sizes({link.table: dims[link.table].select(link.match, link.take) for link in links})
    steps = [Step(link.table, link.name, link.take, {f"natural_{link.name}": link.match}) for link in links]
    shown = chain(facts, dims, steps, measured, "source_trip_id")
    natural = {link.name: F.col(f"natural_{link.name}").alias(link.name) for link in links}
    return shown.select(*[natural.get(c, F.col(c)) for c in facts.columns])


def at_once(*writes: Callable[[], int]) -> list[int]:
    """Run writes that do not depend on each other side by side; small ones mostly wait for the scheduler."""
    with ThreadPoolExecutor(len(writes)) as pool:
        return [done.result() for done in [pool.submit(write) for write in writes]]


def load_dimensions(
    spark: SparkSession, sources: dict[str, DataFrame], root: str, as_of: Column, first: str, last: str
) -> dict[str, int]:
    """Add unseen members to every stored dimension, all in one commit; returns the rows added."""
    series = {"dim_date": (dim_date(spark, first, last), "date_key"), "dim_time": (dim_time(spark), "time_key")}
    with Store(spark, root).load() as load:
        for table, schema in schemas.WAREHOUSE.items():
            load.create(table, schema, ("date_key",) if table == "fact_trips" else ())

        def members(dim: Dimension) -> int:
            fresh = dim.new_rows(sources[dim.source], as_of, load.read(dim.table), load.tables[dim.table].highest)
            return load.append(dim.table, fresh, key=dim.key)

        def slots(table: str) -> int:
            rows, key = series[table]
            return load.append(table, insert_if_absent(rows, load.read(table), [key]))

        writes = {dim.table: partial(members, dim) for dim in DIMENSIONS} | {table: partial(slots, table) for table in series}
        return dict(zip(writes, at_once(*writes.values())))


def load_slice(spark: SparkSession, trips: DataFrame, root: str, batch: int | None = None) -> dict[str, int]:
    """Resolve and add the trips of a slice that are not stored yet, all that follows from them in one commit.

    Trip ids are compared with those of all stored facts, which lie bucketed by id and are not
    moved; the ids that clash are frozen and counted, and rows are moved only if these are many.
    Keys go on, without gaps, from the highest that the record of the last load names.
    The resolved slice is frozen and read for facts and rejects; the new facts are frozen and
    read for the fact table by day, the ids and the daily sums. The rebalance sizes the files
    and splits a crowded day over several writers. Rejects take the place of the last load's,
    or join those of ``batch``, once each if it is loaded again.
    """
    with Store(spark, root).load() as load:
        load.create("fact_trips", schemas.FACT_TRIPS, ("date_key",))
        ids = KeyTable(load, "trip_ids", schemas.FACT_TRIPS["source_trip_id"])
        dims = {table: load.read(table) for table in schemas.WAREHOUSE if table != "fact_trips"}
        resolved = snapshot(resolve_keys(trips, dims, key_sizes(load.base)).drop(*NATURAL_IDS))
        checked = measures(resolved)
        counted, seen = Observation(), Observation()
        clashing = clashes(checked, ids.rows() if load.tables["trip_ids"].rows else None)
        clashing = snapshot(clashing.observe(counted, F.count(F.lit(1)).alias("rows")))
        fresh = placed(settled(checked, clashing, counted.get.get("rows") or 0))
        newest = F.max(F.col("requested_at").cast("string")).alias("newest")
        fresh = snapshot(fresh.observe(seen, F.count(F.lit(1)).alias("rows"), newest))
        keyed = dense_keys(fresh, "trip_key", load.tables["fact_trips"].highest)
        keyed = schemas.conform(keyed, schemas.FACT_TRIPS).hint("rebalance", "date_key")
        refused = rejects(resolved)
        if batch is not None:
            refused = refused.withColumn("batch", F.lit(batch).cast("long"))
            load.create("rejected_arrivals", refused.schema, ("batch",))
            before = load.read("rejected_arrivals").where(F.col("batch") == batch)
            refused = insert_if_absent(refused, before, ["trip_id"])
        n = seen.get.get("rows") or 0
        facts_added, _, _, rejected = at_once(
            lambda: load.append("fact_trips", keyed, key="trip_key"),
            lambda: ids.append(fresh.select("source_trip_id"), n),
            lambda: load.append("daily_sums", daily_sums(fresh), by=("by",)),
            lambda: load.replace("rejected_trips", refused) if batch is None else load.append("rejected_arrivals", refused),
        )
        latest = max(filter(None, (loaded_until(load.base), _moment(seen.get.get("newest")))), default=None)
        if latest:
            load.marks[MARK] = latest.isoformat()
    for frozen in (resolved, clashing, fresh):
        discard(frozen)
    return {"fact_trips": facts_added, "rejected_trips" if batch is None else "rejected_arrivals": rejected}


def _moment(shown: str | None) -> datetime | None:
    return datetime.fromisoformat(shown) if shown else None


def load_facts(
    spark: SparkSession, trips: DataFrame, root: str, lookback: timedelta = timedelta(0), batch: int | None = None
) -> dict[str, int]:
    """Load what the high-water mark says is new; everything into an empty warehouse."""
    mark = loaded_until(Store(spark, root).record())
    since = None if mark is None else mark - lookback
    return load_slice(spark, slice_from(trips, since), root, batch)


def compact(spark: SparkSession, root: str) -> dict[str, int]:
    """Make one file set of what many small loads have added to the trip ids and the daily sums; returns their rows.

    The sums of one key add up. Rows, keys and mark of the record stay as they are, and so does
    what anyone reads: the compacted tables take the place of the old ones in one commit.
    """
    key = schemas.FACT_TRIPS["source_trip_id"]
    with Store(spark, root).load() as load:
        before = KeyTable(load, "trip_ids", key)
        ids, n = before.rows(), load.tables["trip_ids"].rows
        sums = load.replace("daily_sums", merged(load.read("daily_sums")), by=("by",))
        load.renew("trip_ids")
        KeyTable(load, "trip_ids", key).append(ids, n)
    return {"trip_ids": n, "daily_sums": sums}


def run_etl(
    spark: SparkSession,
    sources: dict[str, DataFrame],
    root: str,
    *,
    as_of: datetime | None = None,
    first: str,
    last: str,
    lookback: timedelta = timedelta(0),
) -> dict[str, int]:
    """Operational tables to star schema, dimensions first; safe to run again."""
    moment = F.current_timestamp().cast("timestamp_ntz") if as_of is None else ntz(as_of)
    added = load_dimensions(spark, sources, root, moment, first, last)
    return {**added, **load_facts(spark, sources["trips"], root, lookback)}
