"""Stewardship, usability and check-coverage signals, for all tables in one job each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegrade.functions.expressions import enforces_retention, full_name, is_filled
from tablegrade.operators.history import made_by_jobs
from tablegrade.schemas import COLUMN_KEYS, PROPERTY_KEYS, TABLE_KEYS


def pivot_properties(properties: DataFrame, keys: list[str] = PROPERTY_KEYS) -> DataFrame:
    """Key/value property rows turned into one column per key, one row per table.

    Conditional maxima fold everything in a single aggregation; a ``pivot`` would aggregate twice
    and shuffle twice.
    """
    cells = [F.max(F.when(F.col("key") == key, F.col("value"))).alias(key) for key in keys]
    return properties.where(F.col("key").isin(keys)).groupBy(*TABLE_KEYS).agg(*cells)


def check_coverage(columns: DataFrame, checks: DataFrame) -> DataFrame:
    """Per table of the inventory: is any check declared, and is every column covered.

    Only filled checks count. A check on a column that no longer exists still means that the table
    declares checks. ``columns`` may list a table once with a null ``column_name`` when it has no
    columns; it is then covered vacuously. Both inputs are folded to one row per column before the
    shuffle, so repeated checks on one column cost nothing.
    """
    marks = columns.select(
        *COLUMN_KEYS, F.lit(True).alias("listed"), F.lit(False).alias("checked")
    ).unionByName(
        checks.where(is_filled("check")).select(
            *COLUMN_KEYS, F.lit(False).alias("listed"), F.lit(True).alias("checked")
        )
    )
    by_column = marks.groupBy(*COLUMN_KEYS).agg(
        F.bool_or("listed").alias("listed"), F.bool_or("checked").alias("checked")
    )
    uncovered = F.col("listed") & F.col("column_name").isNotNull() & ~F.col("checked")
    return (
        by_column.groupBy(*TABLE_KEYS)
        .agg(
            F.bool_or("listed").alias("listed"),
            F.bool_or("checked").alias("table_implement_checks"),
            (~F.bool_or(uncovered)).alias("all_columns_have_checks"),
        )
        .where("listed")
        .drop("listed")
    )


def columns_described(columns: DataFrame) -> DataFrame:
    """Per table, whether every column has a non-blank comment; true for a table without columns."""
    undescribed = F.col("column_name").isNotNull() & ~is_filled("comment")
    return columns.groupBy(*TABLE_KEYS).agg((~F.bool_or(undescribed)).alias("columns_description"))


def steward_signals(
    tables: DataFrame,
    properties: DataFrame,
    history: DataFrame,
    columns: DataFrame,
    checks: DataFrame,
) -> DataFrame:
    """Ownership, format, pipeline, retention, location, description and coverage of every table.

    The four inputs are each reduced to one row per table and then joined by table; a table without
    history or properties is kept and simply lacks the signals those would give.
    """
    facts = pivot_properties(properties, ["Provider", "Owner", "Is_managed_location", "Table Properties"])
    managed = F.lower(F.col("Is_managed_location")) == "true"
    delta = F.col("Provider") == "delta"
    no = F.lit(False)
    return (
        tables.select(*TABLE_KEYS, "id", "description", "created_at", "last_modified")
        .join(facts, TABLE_KEYS, "left")
        .join(made_by_jobs(history), TABLE_KEYS, "left")
        .join(check_coverage(columns, checks), TABLE_KEYS, "left")
        .select(
            *TABLE_KEYS,
            full_name().alias("name"),
            "id",
            "description",
            "created_at",
            "last_modified",
            is_filled("Owner").alias("has_a_valid_owner"),
            F.coalesce(delta, no).alias("is_delta_table"),
            is_filled("description").alias("table_description"),
            F.coalesce("by_job", no).alias("uses_a_production_pipeline"),
            enforces_retention(F.col("Table Properties")).alias("has_enforced_retention_duration"),
            F.coalesce(managed, no).alias("is_managed_location"),
            F.coalesce("table_implement_checks", no).alias("table_implement_checks"),
            F.coalesce("all_columns_have_checks", no).alias("all_columns_have_checks"),
        )
    )
