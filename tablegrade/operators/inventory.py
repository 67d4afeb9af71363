"""Listings and metadata of tables and columns, over inventory frames."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegrade.functions.expressions import full_name
from tablegrade.operators.reconcile import in_scope
from tablegrade.schemas import COLUMN_KEYS, SYSTEM_SCHEMAS, TABLE_KEYS

# --- fixed values: helper tables that are never monitored -----------------------------------------

_HELPER_SUFFIX = "_sqldf"
_HELPER_PARTS = ["table_history", "table_metadata"]

# ------------------------------------------------------------------------------------------------


def list_schemas(schemas: DataFrame, except_schemas: Iterable[str] = ()) -> DataFrame:
    """Schemas to monitor: all but the system's and the caller's exceptions."""
    return schemas.where(~F.col("schema_name").isin([*SYSTEM_SCHEMAS, *except_schemas]))


def list_tables(tables: DataFrame) -> DataFrame:
    """Tables to monitor: all but notebook result views and history or metadata helpers."""
    name = F.col("table_name")
    helper = name.endswith(_HELPER_SUFFIX)
    for part in _HELPER_PARTS:
        helper = helper | name.contains(part)
    return tables.where(~helper)


def table_owners(tables: DataFrame, scope: DataFrame | None = None) -> DataFrame:
    """Owner and description of the tables in scope."""
    return in_scope(tables, scope).select(
        *TABLE_KEYS, "table_owner", F.col("description").alias("comment")
    )


def table_detail(tables: DataFrame) -> DataFrame:
    """Identity, description and times of every table."""
    return tables.select(
        *TABLE_KEYS, full_name().alias("name"), "id", "description", "created_at", "last_modified"
    )


def column_metadata(
    columns: DataFrame, tags: DataFrame, scope: DataFrame | None = None
) -> DataFrame:
    """Columns with their tags as a sorted list of name and value pairs; untagged ones get none.

    Tags are gathered per column before the join, so each side has one row per column there.
    """
    pair = F.struct("tag_name", "tag_value")
    gathered = (
        in_scope(tags, scope)
        .groupBy(*COLUMN_KEYS)
        .agg(F.sort_array(F.collect_list(pair)).alias("tags"))
    )
    no_tags = F.array().cast("array<struct<tag_name:string,tag_value:string>>")
    return (
        in_scope(columns, scope)
        .join(gathered, COLUMN_KEYS, "left")
        .select(
            *COLUMN_KEYS,
            "is_nullable",
            "data_type",
            "comment",
            F.coalesce("tags", no_tags).alias("tags"),
        )
    )


def columns_by_table(requested: DataFrame, metadata: DataFrame) -> DataFrame:
    """Every requested table with the list of its columns, empty if it has none.

    The list is bounded by the table's width.
    """
    fields = [c for c in metadata.columns if c not in TABLE_KEYS]
    # Requested tables take part with one row without a column, which the list then leaves out.
    rows = metadata.select(*TABLE_KEYS, F.struct(*fields).alias("column")).unionByName(
        requested.select(*TABLE_KEYS).distinct(), allowMissingColumns=True
    )
    listed = rows.groupBy(*TABLE_KEYS).agg(
        F.sort_array(F.collect_list("column")).alias("columns"),
        F.bool_or(F.col("column").isNull()).alias("requested"),
    )
    return listed.where("requested").drop("requested")
