"""Surrogate keys without a global sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def next_free_key(table: DataFrame, key: str) -> Column:
    """Highest key in use, 0 for an empty table, as a scalar subquery."""
    return table.agg(F.coalesce(F.max(key), F.lit(0)).cast("long")).scalar()


def assign_keys(df: DataFrame, key: str, natural: str, start: Column | int = 0) -> DataFrame:
    """Number rows that are unique on ``natural``, each lane counting in its own stride.

    Rows are hashed into lanes, a few per shuffle partition, and numbered inside a
    lane: lanes run in parallel, and the same rows get the same keys when a task is
    re-run. Keys are unique and above ``start``; gaps occur as with sequences.
    """
    lanes = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first = start if isinstance(start, Column) else F.lit(start).cast("long")
    lane = F.pmod(F.xxhash64(natural), F.lit(lanes))
    place = F.row_number().over(Window.partitionBy("_lane").orderBy(natural))
    numbered = df.withColumn("_lane", lane).withColumn(key, first + (place - 1) * lanes + F.col("_lane") + 1)
    return numbered.select(key, *df.columns)


PART, PLACE = "_part", "_place"


def placed(df: DataFrame) -> DataFrame:
    """Rows with their partition and their place in it, to be stored before ``dense_keys`` reads them."""
    part = F.spark_partition_id()
    within = F.monotonically_increasing_id() - F.shiftleft(part.cast("long"), 33)
    return df.select("*", part.alias(PART), within.alias(PLACE))


def dense_keys(stored: DataFrame, key: str, start: int) -> DataFrame:
    """Number stored rows of ``placed`` from ``start`` + 1 on, without gaps and without a shuffle of them.

    Only the counts per partition are gathered, one row each.
    """
    before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    counts = stored.groupBy(PART).agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(PART, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    number = F.lit(start).cast("long") + F.col("_offset") + F.col(PLACE) + 1
    columns = [name for name in stored.columns if name not in (PART, PLACE)]
    return stored.join(F.broadcast(offsets), PART).select(number.alias(key), *columns)


def parallel_keys(df: DataFrame, key: str, start: Column | int = 0) -> DataFrame:
    """Unique keys above ``start`` for a large append: no shuffle, gaps allowed."""
    first = start if isinstance(start, Column) else F.lit(start).cast("long")
    return df.select((first + F.monotonically_increasing_id() + 1).alias(key), *df.columns)
