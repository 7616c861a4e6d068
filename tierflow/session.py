"""A session with the settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: On a cluster only these matter; masters, memory and spark.checkpoint.dir (a
#: folder that all executors share) are the cluster's to set.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
}


def session(master: str | None = None, shuffle_partitions: int | None = None, checkpoints: str | None = None, **settings: str) -> SparkSession:
    """The session; ``master`` and ``shuffle_partitions`` are for single machines.

    ``checkpoints``: the folder that all executors share, where the cluster does not set spark.checkpoint.dir."""
    if checkpoints:
        settings["spark.checkpoint.dir"] = checkpoints
    builder = SparkSession.builder.appName("tierflow").config(map=SETTINGS | settings)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        builder = builder.config("spark.driver.memory", "8g")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", shuffle_partitions)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
