"""Session settings for bench and tests, and the settings a cluster run should have."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# AQE sizes shuffle partitions at run time from a generous start, splits skewed join
# partitions, and turns a join whose side proves small into a broadcast join. The JVM
# never compiles a method above 8000 bytes, so such a stage is better run operator by
# operator. Recording a call site for every column only slows building long plans.
ENGINE_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(app: str, cpus: int | str = "*", partitions: int = 8) -> SparkSession:
    """A local session without the web page, for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="ridelake-tables-"))
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for key, value in ENGINE_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
