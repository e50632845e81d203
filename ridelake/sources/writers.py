"""Sinks: append, replace, create-if-absent, views and lineage-cutting snapshots."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ridelake.sources.commits import Store, home


def append(df: DataFrame, path: str, by: tuple[str, ...] = ()) -> int:
    """Add rows to a stored table; returns how many, counted by the write itself."""
    root, name = home(path)
    with Store(df.sparkSession, root).load() as load:
        return load.append(name, df, by)


def replace(df: DataFrame, path: str, by: tuple[str, ...] = ()) -> int:
    """Put a new table in the place of whatever is stored; returns its rows.

    The rows are written beside the old ones, which readers see until the record that names the
    new ones is in its place: there is no moment without a table, and a write that fails at
    any point leaves it as it was.
    """
    root, name = home(path)
    with Store(df.sparkSession, root).load() as load:
        return load.replace(name, df, by)


def replace_bucketed(df: DataFrame, table: str, by: str, buckets: int) -> None:
    """A catalog table hashed and sorted by a key: two such tables join on it unshuffled."""
    df.write.mode("overwrite").bucketBy(buckets, by).sortBy(by).saveAsTable(table)


def create_if_absent(spark: SparkSession, path: str, schema: StructType, by: tuple[str, ...] = ()) -> None:
    """An empty table under a declared schema; an existing one is left alone."""
    root, name = home(path)
    store = Store(spark, root)
    if not store.has(name):
        with store.load() as load:
            load.create(name, schema, by)


def table_exists(spark: SparkSession, path: str) -> bool:
    root, name = home(path)
    return Store(spark, root).has(name)


def named_view(df: DataFrame, name: str) -> DataFrame:
    """Register a session view and return it as a frame."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints; only a local session gets its own."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="ridelake-"))
    kept_until_exit(spark, context.getCheckpointDir())
    return context.getCheckpointDir()


def snapshot(df: DataFrame, name: str | None = None) -> DataFrame:
    """Freeze a result: later changes of its inputs no longer show.

    The copy is a Parquet table in the shared checkpoint folder. It cuts the lineage,
    outlives any executor, and later steps read only the columns they need from it. It
    goes when ``discard`` says so, or else with the application.
    """
    path = f"{shared_folder(df.sparkSession)}/snapshot-{uuid4().hex}"
    df.write.parquet(path)
    kept_until_exit(df.sparkSession, path)
    frozen = df.sparkSession.read.schema(df.schema).parquet(path)
    return named_view(frozen, name) if name else frozen


def own_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one, which goes with the application."""
    path = f"{shared_folder(spark)}/{name}-{uuid4().hex}"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(at)
    kept_until_exit(spark, path)
    return path


def kept_until_exit(spark: SparkSession, path: str) -> None:
    """Let a folder be deleted when the application ends, if it is still there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)


def discard(frozen: DataFrame) -> None:
    """Delete the files of a snapshot once everything made from it is written."""
    spark = frozen.sparkSession
    shared = shared_folder(spark)
    for file in {name.rsplit("/", 1)[0] for name in frozen.inputFiles()}:
        if "/snapshot-" in file and file.removeprefix("file:").lstrip("/").startswith(shared.removeprefix("file:").lstrip("/")):
            path = spark._jvm.org.apache.hadoop.fs.Path(file)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
