"""Session settings the library is tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(
    app_name: str = "shelfline", master: str | None = None, **conf: str
) -> SparkSession:
    """Start (or reuse) a session.

    Only planner-level settings are fixed here; sizes such as the number of
    shuffle partitions belong to the cluster and come in through ``conf`` with
    dots written as double underscores (``spark__sql__shuffle__partitions="8"``).
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Parquet grows in memory; judge broadcast candidates by more than their file size.
        .config("spark.sql.sources.fileCompressionFactor", "3.0")
        # Do not record a Python call site for every column expression built.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master is not None:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
