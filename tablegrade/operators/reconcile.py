"""Keeping stored checks, column tags and the live columns in agreement."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegrade.functions.expressions import full_name, is_filled
from tablegrade.operators.state import TAG_KEYS, append, delete
from tablegrade.schemas import COLUMN_KEYS, TABLE_KEYS, TAG_CHECK


def in_scope(rows: DataFrame, scope: DataFrame | None) -> DataFrame:
    """Rows of the tables listed in ``scope``; all rows without one."""
    return rows if scope is None else rows.join(scope.select(*TABLE_KEYS), TABLE_KEYS, "left_semi")


def checked_columns(checks: DataFrame) -> DataFrame:
    """Columns that have a filled check, one row each."""
    return checks.where(is_filled("check")).select(*COLUMN_KEYS).distinct()


def columns_with_checks(checks: DataFrame) -> DataFrame:
    """Per table, the sorted list of its columns with a filled check.

    The list is bounded by the table's width; repeated checks are folded before the shuffle.
    """
    return (
        checked_columns(checks)
        .groupBy(*TABLE_KEYS)
        .agg(F.sort_array(F.collect_set("column_name")).alias("columns"))
        .select(full_name().alias("table_name"), "columns")
    )


def _with_live_mark(checks: DataFrame, columns: DataFrame) -> DataFrame:
    """Checks with ``_live``, null where their column is gone.

    The checks stay on the side of the join that can be split when one column has very many.
    """
    live = columns.select(*COLUMN_KEYS).distinct().withColumn("_live", F.lit(True))
    return checks.join(live, COLUMN_KEYS, "left")


def stale_checks(checks: DataFrame, columns: DataFrame, scope: DataFrame | None = None) -> DataFrame:
    """Ids of checks to drop: without text, or on a column that no longer exists.

    ``reason`` is ``blank`` or ``orphaned``.
    """
    reason = F.when(~is_filled("check"), "blank").when(F.col("_live").isNull(), "orphaned")
    return (
        _with_live_mark(in_scope(checks, scope), columns)
        .select("check_id", reason.alias("reason"))
        .where("reason is not null")
    )


def sync_checks(checks: DataFrame, columns: DataFrame, scope: DataFrame | None = None) -> DataFrame:
    """The checks that remain once the stale ones are gone, from one pass over them."""
    if scope is None:
        return checks.where(is_filled("check")).join(
            columns.select(*COLUMN_KEYS), COLUMN_KEYS, "left_semi"
        )
    scoped = scope.select(*TABLE_KEYS).distinct().withColumn("_scoped", F.lit(True))
    stays = is_filled("check") & F.col("_live").isNotNull()
    marked = _with_live_mark(checks, columns).join(scoped, TABLE_KEYS, "left")
    return marked.where(F.col("_scoped").isNull() | stays).select(*checks.columns)


def invalid_check_tags(
    tags: DataFrame, checks: DataFrame, scope: DataFrame | None = None
) -> DataFrame:
    """Check tags on columns that have no filled check, as rows to unset."""
    return (
        in_scope(tags, scope)
        .where(F.col("tag_name") == TAG_CHECK)
        .join(checked_columns(checks), COLUMN_KEYS, "left_anti")
        .select(*TAG_KEYS)
    )


def reconcile_check_tags(
    tags: DataFrame, checks: DataFrame, columns: DataFrame, scope: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Drop stale checks and make the check tags agree with what is left.

    Returns the new ``column_checks`` and ``column_tags``. Within the scope the check tags are exactly
    the columns with a filled check, so they are replaced as a whole rather than compared.
    """
    kept = sync_checks(checks, columns, scope)
    check_tag = F.col("tag_name") == TAG_CHECK
    others = tags.where(~check_tag)
    if scope is not None:
        others = others.unionByName(delete(tags.where(check_tag), scope, TABLE_KEYS))
    # Checks are folded to columns before the joins, so that a column with very many costs nothing.
    checked = in_scope(checked_columns(checks), scope)
    live = checked.join(columns.select(*COLUMN_KEYS), COLUMN_KEYS, "left_semi")
    return kept, append(others, live.withColumn("tag_name", F.lit(TAG_CHECK)))


def pending_columns(columns: DataFrame, tags: DataFrame, tag_name: str) -> DataFrame:
    """Columns that do not carry a tag yet."""
    tagged = tags.where(F.col("tag_name") == tag_name).select(*COLUMN_KEYS)
    return columns.join(tagged, COLUMN_KEYS, "left_anti")
