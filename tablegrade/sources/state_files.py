"""State frames as parquet, one new directory per run.

A run reads the state of the run before it and writes its own; nothing is ever overwritten, so a failed
run leaves the last good state as it was, and a reader never sees files change. Writing also cuts
lineage between the stages of a run.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tablegrade.schemas import STATE
from tablegrade.sources.local import local_frame


def state_path(root: str, name: str, run: str) -> str:
    """Directory of one state frame of one run."""
    return f"{root.rstrip('/')}/{name}/run={run}"


def write_state(frame: DataFrame, root: str, name: str, run: str) -> DataFrame:
    """Store a state frame for a run and return it read back. Fails if the run has stored it."""
    schema = STATE[name]
    path = state_path(root, name, run)
    frame.select(*schema.fieldNames()).write.mode("errorifexists").parquet(path)
    return frame.sparkSession.read.schema(schema).parquet(path)


def read_state(spark: SparkSession, root: str, name: str, run: str | None) -> DataFrame:
    """A state frame as a run left it; empty when there was no run yet."""
    schema = STATE[name]
    if run is None:
        return local_frame(spark, [], schema)
    return spark.read.schema(schema).parquet(state_path(root, name, run))


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables, from ``spark.checkpoint.dir``.

    Where that is unset, a folder below the warehouse is set, which all machines see as well.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_intermediate"
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def stored_once(frame: DataFrame) -> DataFrame:
    """The frame written to the shared folder and read back, so that it is computed once.

    Unlike cached data it outlives the executors that made it; unlike a checkpoint the last stage runs
    once, and readers can skip columns. The files stay until the folder is cleaned.
    """
    path = f"{shared_folder(frame.sparkSession)}/{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
