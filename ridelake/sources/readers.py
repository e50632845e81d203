"""Readers with declared schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ridelake.sources.commits import Store, home


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A stored table as of its last commit, or a folder of Parquet files that no load wrote.

    The stored types are used unless a schema is given.
    """
    root, name = home(path)
    if (record := Store(spark, root).record()).tables and name in record.tables:
        return Store(spark, root).read(name, schema, record)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_delimited(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Delimited file with a header: fixed schema, empty field is NULL, bad row fails."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("nullValue", "")
        .option("emptyValue", "")
        .csv(path)
    )


def read_delimited_wide(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """The same file with every field as text, so rules can run before narrowing."""
    return read_delimited(spark, path, StructType([StructField(name, StringType()) for name in columns]))


def read_jdbc(
    spark: SparkSession,
    url: str,
    query: str,
    *,
    split_on: str,
    low: int | str,
    high: int | str,
    pieces: int,
    **options: str,
) -> DataFrame:
    """A database query read in parallel slices of ``split_on`` (one slice is one task)."""
    return (
        spark.read.format("jdbc")
        .options(**options)
        .option("url", url)
        .option("dbtable", f"({query}) AS source")
        .option("partitionColumn", split_on)
        .option("lowerBound", str(low))
        .option("upperBound", str(high))
        .option("numPartitions", str(pieces))
        .load()
    )


def inline_rows(spark: SparkSession, rows: Sequence[Sequence], schema: StructType) -> DataFrame:
    """Literal rows as a frame."""
    return spark.createDataFrame(list(rows), schema)


def day_series(spark: SparkSession, first: str, last: str) -> DataFrame:
    """One row per calendar day, both ends included."""
    days = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias("full_date"))


def number_series(spark: SparkSession, first: int, last: int, step: int, name: str) -> DataFrame:
    """Whole numbers from ``first`` to ``last`` inclusive."""
    return spark.range(first, last + 1, step).select(F.col("id").cast("int").alias(name))
