"""Schema drift: the columns of every table compared with those of a past version."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegrade.operators.history import comparison_day, version_as_of_day
from tablegrade.schemas import COLUMN_KEYS, TABLE_KEYS


def past_columns(
    history: DataFrame, schema_versions: DataFrame, config: DataFrame, as_of: datetime | str
) -> DataFrame:
    """Columns of the version each configured table is compared with.

    The picked versions (one row per table) are joined to the schema snapshots by table and version.
    """
    targets = config.select(
        *TABLE_KEYS, comparison_day(as_of, "validity_window").alias("target")
    )
    picked = version_as_of_day(history, targets)
    return schema_versions.join(
        picked.select(*TABLE_KEYS, "version"), [*TABLE_KEYS, "version"]
    ).select(*COLUMN_KEYS, "data_type")


def _side_by_side(current: DataFrame, past: DataFrame) -> DataFrame:
    """One row per column found on either side, with its type on each.

    A union folded by column needs one shuffle and no join, and the fold happens before it.
    """
    both = current.select(
        *COLUMN_KEYS,
        F.col("data_type").alias("current_type"),
        F.lit(None).cast("string").alias("past_type"),
    ).unionByName(
        past.select(
            *COLUMN_KEYS,
            F.lit(None).cast("string").alias("current_type"),
            F.col("data_type").alias("past_type"),
        )
    )
    return both.groupBy(*COLUMN_KEYS).agg(
        F.max("current_type").alias("current_type"), F.max("past_type").alias("past_type")
    )


def drift_detail(current: DataFrame, past: DataFrame) -> DataFrame:
    """Every column that differs, one row each, with the kind of difference.

    ``kind`` is ``missing_in_current``, ``missing_in_past`` or ``type_changed``. Both inputs carry
    ``data_type`` as text and never null.
    """
    kind = (
        F.when(F.col("current_type").isNull(), "missing_in_current")
        .when(F.col("past_type").isNull(), "missing_in_past")
        .when(F.col("current_type") != F.col("past_type"), "type_changed")
    )
    return (
        _side_by_side(current, past)
        .withColumn("kind", kind)
        .where(F.col("kind").isNotNull())
        .select(*COLUMN_KEYS, "kind", "current_type", "past_type")
    )


def schema_drift(current: DataFrame, past: DataFrame) -> DataFrame:
    """Per table, whether the column sets and the types of common columns agree, with counts."""
    gone, added = F.col("current_type").isNull(), F.col("past_type").isNull()
    changed = F.col("current_type") != F.col("past_type")
    return (
        _side_by_side(current, past)
        .groupBy(*TABLE_KEYS)
        .agg(
            F.count_if(gone).alias("n_missing_in_current"),
            F.count_if(added).alias("n_missing_in_past"),
            F.count_if(changed).alias("n_type_changed"),
        )
        .select(
            *TABLE_KEYS,
            (F.col("n_missing_in_current") + F.col("n_missing_in_past") == 0).alias(
                "columns_match"
            ),
            (F.col("n_type_changed") == 0).alias("datatypes_match"),
            "n_missing_in_current",
            "n_missing_in_past",
            "n_type_changed",
        )
    )


def drift_report(current: DataFrame, past: DataFrame) -> DataFrame:
    """The same comparison in nested form: one row per table with the differing columns inside.

    The lists are bounded by the width of one table's schema. They are null when the column sets
    agree, as no column is missing then.
    """
    gone, added = F.col("current_type").isNull(), F.col("past_type").isNull()
    changed = F.col("current_type") != F.col("past_type")
    name = F.col("column_name")
    types = F.struct(
        F.col("current_type").alias("current"), F.col("past_type").alias("versioned")
    )
    entry = F.struct(name.alias("key"), types.alias("value"))
    lists = (
        _side_by_side(current, past)
        .groupBy(*TABLE_KEYS)
        .agg(
            F.sort_array(F.collect_list(F.when(gone, name))).alias("gone"),
            F.sort_array(F.collect_list(F.when(added, name))).alias("added"),
            F.sort_array(F.collect_list(F.when(changed, entry))).alias("changed"),
        )
    )
    match = (F.size("gone") == 0) & (F.size("added") == 0)
    return lists.select(
        *TABLE_KEYS,
        match.alias("columns_match"),
        (F.size("changed") == 0).alias("datatypes_match"),
        F.map_from_entries("changed").alias("mismatched_datatypes"),
        F.when(~match, F.col("gone")).alias("col_missing_in_current_table"),
        F.when(~match, F.col("added")).alias("col_missing_in_old_table"),
    )
