"""The incremental fact load as a stream of arriving trip files.

Which files are new is remembered by the stream's own checkpoint, so trips that arrive
late need no look-back. The insert skips stored trip ids, so a batch that is replayed
after a failure adds nothing twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ridelake import schemas
from ridelake.plans.facts import load_slice
from ridelake.sources.writers import shared_folder


def load_arriving(trips: DataFrame, number: int, root: str) -> None:
    """Load one batch; a batch without trips writes nothing."""
    if not trips.isEmpty():
        load_slice(trips.sparkSession, trips, root, batch=number)


def follow_trips(spark: SparkSession, folder: str, root: str, name: str, files_per_batch: int = 1000) -> StreamingQuery:
    """Load every trip file that arrived in ``folder`` since the last call, then stop.

    ``name`` identifies the stream's progress in the shared checkpoint folder. The
    dimensions must be in the warehouse already.
    """
    arriving = spark.readStream.schema(schemas.TRIPS).option("maxFilesPerTrigger", files_per_batch).parquet(folder)
    return (
        arriving.writeStream.foreachBatch(lambda batch, number: load_arriving(batch, number, root))
        .option("checkpointLocation", f"{shared_folder(spark)}/streams/{name}")
        .trigger(availableNow=True)
        .start()
    )
