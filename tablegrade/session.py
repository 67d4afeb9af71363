"""A Spark session with the settings the operators are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Adaptive execution picks partition counts and splits hot keys at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(name: str = "tablegrade", master: str | None = None, **extra: str) -> SparkSession:
    """A session; on a cluster leave ``master`` out. ``extra`` adds settings, dots as ``__``."""
    builder = SparkSession.builder.appName(name)
    if master is not None:
        builder = builder.master(master)
    settings = SETTINGS | {key.replace("__", "."): value for key, value in extra.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
