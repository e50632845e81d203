"""Tables between the steps of an operator, and running totals over a global order."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Words by white space, what is between them, and what is between words as decontamination sees them; Java patterns.
SOLID_WORD = r"[^\x20\x09-\x0D]+"
BETWEEN_SOLID, BETWEEN_PLAIN = r"[\x20\x09-\x0D]+", r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: While a step is written: its shuffle files go when it is done, and partitions are joined up to the advised size,
#: for many small files cost more than the tasks they save.
_WHILE_WRITING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
}
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def words(text: Column, between: str) -> Column:
    """What lies between runs of separators. Cutting there is several times faster than extracting every word."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), between), "")


def solid_words(text: Column) -> Column:
    return words(text, BETWEEN_SOLID)


def plain_words(text: Column) -> Column:
    return words(lower_ascii(text), BETWEEN_PLAIN)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors and the driver share; only a local session without one gets /tmp/checkpoints."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return named or "/tmp/checkpoints"


def bounded_batches(spark: SparkSession) -> None:
    """Let batches for Python workers hold a few megabytes, unless the session says another size than Spark's own."""
    if spark.conf.get(_BATCH_BYTES) == "67108864b":
        spark.conf.set(_BATCH_BYTES, f"{BATCH_BYTES}b")


class Scratch:
    """Tables an operator writes between its steps.

    A step that is read again is written as Parquet to the shared folder, which cuts its
    lineage: a lost executor costs the tasks it ran and nothing before them. Shuffle files
    of the step are released once it is written. ``drop`` removes a table when the tables
    made from it are written; what a lazy result still reads stays.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        bounded_batches(spark)
        self.folder = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"

    @contextmanager
    def _writing(self):
        before = {key: self.spark.conf.get(key, None) for key in _WHILE_WRITING}
        for key, value in _WHILE_WRITING.items():
            self.spark.conf.set(key, value)
        try:
            yield
        finally:
            for key, value in before.items():
                self.spark.conf.unset(key) if value is None else self.spark.conf.set(key, value)

    def freeze(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        with self._writing():
            df.write.option("compression", "zstd").parquet(path)
        at = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)  # what is not dropped goes with the application
        at.getFileSystem(self.spark._jsc.hadoopConfiguration()).deleteOnExit(at)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def running_total(scratch: Scratch, name: str, df: DataFrame, order: list[str], value: str, out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over all rows before this one in the order of ``order``, ascending, nulls last.

    Rows are range-partitioned by ``order`` and the partitions kept; sums of whole
    partitions, one row each, give every partition its offset, and a window inside each
    partition does the rest. Which of several rows with equal ``order`` comes first is open,
    so ``order`` should tell apart all rows that differ.
    """
    keys = [F.col(c).asc_nulls_last() for c in order]
    parts = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    spread = df.repartitionByRange(parts, *keys).withColumn("__part", F.spark_partition_id())
    spread = scratch.freeze(spread, name)
    sums = spread.groupBy("__part").agg(F.sum(value).alias("__sum"))
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("__part", F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__offset"))
    inside = Window.partitionBy("__part").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    local = spread.withColumn("__local", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return (
        local.join(F.broadcast(offsets), "__part")  # one row per partition
        .withColumn(out, F.col("__offset") + F.col("__local"))
        .drop("__part", "__offset", "__local")
    )
