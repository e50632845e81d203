"""The keys of a large stored table, bucketed on disk, so that joins on them leave them where they are."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ridelake.sources.commits import LOAD, Load


class KeyTable:
    """Keys of one column, hashed into buckets that every load adds files to.

    The buckets are those of Spark's own bucketed tables: a join on the key reads a bucket as a
    partition. The session's catalog gets to know the table when it is first used there; which
    loads count is up to the record, as with all tables of the folder. The number of buckets
    is set by the load that creates the table, to its shuffle partitions.
    """

    def __init__(self, load: Load, name: str, key: StructField):
        self.load, self.name, self.key = load, name, key
        self.spark = load.spark
        load.create(name, StructType([key]))
        wanted = max(2, int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        self.buckets = int(load.marks.setdefault(f"{name}.buckets", wanted))
        self.path = load.store.path(name, load.tables[name])
        self.table = f"{name}_{hashlib.md5(self.path.encode()).hexdigest()[:16]}"
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} (`{key.name}` {key.dataType.simpleString()}, `{LOAD}` BIGINT) USING parquet "
            f"PARTITIONED BY (`{LOAD}`) CLUSTERED BY (`{key.name}`) INTO {self.buckets} BUCKETS LOCATION '{self.path}'"
        )

    def rows(self) -> DataFrame:
        """The keys that the record counts."""
        if self.load.store.files.exists(self.name, self.path.rsplit("/", 1)[1]):
            self.spark.sql(f"ALTER TABLE {self.table} RECOVER PARTITIONS")
        return self.spark.table(self.table).where(self.load.store.visible(self.load.base)).select(self.key.name)

    def append(self, keys: DataFrame, rows: int) -> None:
        """Stage the keys of ``rows`` new rows; each bucket is written by one task."""
        placed = keys.select(F.col(self.key.name).cast(self.key.dataType)).repartition(self.buckets, self.key.name)
        placed.withColumn(LOAD, F.lit(self.load.number).cast(LongType())).write.insertInto(self.table)
        self.load.staged(self.name, rows, 16 * 2 * rows)
