"""Operators over the commit history: newest commit, freshness, version as of a day.

All of them are single aggregations by table with map-side partial results, so a table that holds a
large share of all commits costs no more than any other: its commits are folded before the shuffle.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablegrade.functions.expressions import (
    age_text,
    checked_window_seconds,
    instant,
    seconds_before,
    seconds_between,
    window_seconds,
)
from tablegrade.schemas import TABLE_KEYS, WRITE_OPERATIONS


def latest_commit(history: DataFrame) -> DataFrame:
    """Newest commit of every table: its ``timestamp`` and the job that made it (``etl_job``)."""
    newest = F.max_by(
        F.struct("timestamp", F.col("job").alias("etl_job")), F.struct("timestamp", "version")
    )
    return history.groupBy(*TABLE_KEYS).agg(newest.alias("newest")).select(*TABLE_KEYS, "newest.*")


def invalid_windows(config: DataFrame) -> DataFrame:
    """Configuration rows whose freshness or validity window cannot be read."""
    return config.where(
        window_seconds("freshness_window").isNull() | window_seconds("validity_window").isNull()
    )


def history_days(history: DataFrame) -> DataFrame:
    """The commits folded to one row per table and day, from which freshness, versions and pipelines follow.

    A commit counts to the first midnight at which it is in force (one made exactly then already is). A row has the day's ``first`` and
    ``last`` version, the time of its ``last_write`` and ``newest``, which is twice the last version, plus one if a job made it. All are numbers, so the
    fold stays in hash aggregation and happens before the shuffle. A folded history can take the place of the history
    itself in the functions below; it is folded no further.
    """
    if "newest" in history.columns:
        return history
    midnight = F.date_trunc("day", "timestamp").cast("timestamp_ntz")
    in_force = F.when(F.col("timestamp") == midnight, midnight).otherwise(midnight + F.expr("interval 1 day"))
    write = F.col("operation").isin(WRITE_OPERATIONS)
    by_job = F.col("version") * 2 + F.col("job").isNotNull().cast("bigint")
    return history.groupBy(*TABLE_KEYS, in_force.alias("day")).agg(
        F.max("version").alias("last"),
        F.min("version").alias("first"),
        F.max(F.when(write, F.col("timestamp"))).alias("last_write"),
        F.max(by_job).alias("newest"),
    )


def made_by_jobs(history: DataFrame) -> DataFrame:
    """Per table, whether a job made its newest commit (``by_job``)."""
    if "newest" in history.columns:
        return history.groupBy(*TABLE_KEYS).agg((F.max("newest") % 2 == 1).alias("by_job"))
    return latest_commit(history).select(*TABLE_KEYS, F.col("etl_job").isNotNull().alias("by_job"))


def last_writes(history: DataFrame) -> DataFrame:
    """Time of the newest data-changing commit per table, over all tables that have one."""
    if "newest" in history.columns:
        writes = history.where("last_write is not null").withColumnRenamed("last_write", "timestamp")
    else:
        writes = history.where(F.col("operation").isin(WRITE_OPERATIONS))
    return writes.groupBy(*TABLE_KEYS).agg(F.max("timestamp").alias("last_update"))


def freshness(history: DataFrame, config: DataFrame, as_of: datetime | str) -> DataFrame:
    """Whether each configured table was written within its own freshness window.

    A table without any write commit is not fresh and has no age. ``config`` holds one row per table
    with ``freshness_window``; ``as_of`` is the instant the age is measured at.
    """
    now = instant(as_of)
    age = seconds_between(F.col("last_update"), now)
    limit = seconds_before(now, checked_window_seconds("freshness_window"))
    return (
        config.select(*TABLE_KEYS, "freshness_window")
        .join(last_writes(history), TABLE_KEYS, "left")
        .select(
            *TABLE_KEYS,
            "freshness_window",
            "last_update",
            F.coalesce(F.col("last_update") > limit, F.lit(False)).alias("is_fresh"),
            age.alias("age_seconds"),
            age_text(age).alias("time_since_last_update"),
        )
    )


def comparison_day(as_of: datetime | str, window: str | Column) -> Column:
    """Midnight of the day that lies one window before ``as_of``."""
    moment = seconds_before(instant(as_of), checked_window_seconds(window))
    return F.date_trunc("day", moment).cast("timestamp_ntz")


def version_as_of_day(history: DataFrame, targets: DataFrame) -> DataFrame:
    """Version that was current at each table's ``target``, or its earliest one if all are later.

    ``targets`` holds one row per table with a ``target`` that is a midnight. Later versions never have
    earlier timestamps, as table formats see to, so the newest is the highest. Commits are first folded
    to the last and first version of each day, map-side, so that even the busiest table joins with no more
    rows than it has days; all aggregates are on numbers and stay in hash aggregation.
    """
    days = history_days(history)
    known = F.when(F.col("day") <= F.col("target"), F.col("last"))
    return (
        days.join(targets.select(*TABLE_KEYS, "target"), TABLE_KEYS)
        .groupBy(*TABLE_KEYS, "target")
        .agg(F.max(known).alias("current_then"), F.min("first").alias("earliest"))
        .select(*TABLE_KEYS, "target", F.coalesce("current_then", "earliest").alias("version"))
    )
