"""State changes as pure functions: ``(target, changes) -> new target``.

Nothing is written here. The caller stores the result as a new version (see ``sources.state_files``)
or merges it into a catalog table that supports it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tablegrade.schemas import (
    COLUMN_KEYS,
    DEFAULT_THRESHOLD,
    DEFAULT_WINDOW,
    TABLE_KEYS,
    TAG_COMMENT,
)

#: Buckets that new rows are numbered in, by the leading hex digits of a hash.
_BUCKET_DIGITS = 3
_BUCKETS = 16**_BUCKET_DIGITS

TAG_KEYS = [*COLUMN_KEYS, "tag_name"]


def latest_per_key(rows: DataFrame, keys: list[str], order: str | Column) -> DataFrame:
    """The row with the highest ``order`` per key, folded on the map side."""
    rest = [c for c in rows.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.col(order) if isinstance(order, str) else order)
    return rows.groupBy(*keys).agg(newest.alias("_row")).select(*keys, "_row.*")


#: An optional column of changes: later changes of a key have a higher number, and the last one counts.
CHANGE_NUMBER = "change_number"


def settled(changes: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """One row per key: its last change by ``change_number``, where the changes have that column (null is before all).

    Equal changes count once. Changes of one key that differ and have the same number, or none, fail the job. All is folded
    before it is shuffled, so a key may have any number of changes.
    """
    row = F.struct(*columns)
    number = F.lit(None)
    if CHANGE_NUMBER in changes.columns:
        number = F.col(CHANGE_NUMBER)
    number = F.coalesce(number.cast("bigint"), F.lit(-(2**63)))
    folded = changes.groupBy(*keys, number.alias("_number")).agg(F.min(row).alias("_low"), F.max(row).alias("_high"))
    last = F.max_by(F.struct("_low", "_high"), "_number").alias("_last")
    if CHANGE_NUMBER in changes.columns:
        folded = folded.groupBy(*keys).agg(last).select(*keys, "_last.*")
    message = F.concat(F.lit("changes differ for "), F.to_json(F.struct(*keys)))
    one = F.when(F.col("_low").eqNullSafe(F.col("_high")), F.col("_low")).otherwise(F.raise_error(message))
    return folded.select(*keys, one.alias("_row")).select(*keys, "_row.*")


def _bucket(columns: list[str]) -> Column:
    """Bucket number of a row by a hash of some columns."""
    text = F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns))
    digits = F.substring(F.md5(text.cast("binary")), 1, _BUCKET_DIGITS)
    return F.conv(digits, 16, 10).cast("bigint")


def numbered(rows: DataFrame, number: str, keys: list[str]) -> DataFrame:
    """Give every row a different positive number, by its key alone.

    Rows fall into 4,096 buckets by a hash of their key and are counted within each, in parallel; the
    number joins place and bucket, so no step has to see all rows. As with identity columns, numbers
    may have gaps. They do not depend on how rows are spread, so a recomputed task gives the same ones.
    ``keys`` should be unique, or one bucket may grow large.
    """
    place = F.row_number().over(W.partitionBy("_bucket").orderBy(*keys)) - 1
    return (
        rows.withColumn("_bucket", _bucket(keys))
        .withColumn(number, (place * _BUCKETS + F.col("_bucket") + 1).cast("bigint"))
        .drop("_bucket")
    )


def numbered_copies(rows: DataFrame, number: str) -> DataFrame:
    """Like :func:`numbered`, for rows that may be equal to one another.

    Equal rows are folded to one with a count before they are spread over the buckets, and unfolded
    after.
    """
    values = rows.columns
    before = W.partitionBy("_bucket").orderBy(*values).rowsBetween(W.unboundedPreceding, -1)
    copies = F.sequence(F.lit(0).cast("bigint"), F.col("_copies") - 1)
    return (
        rows.groupBy(*values)
        .agg(F.count("*").alias("_copies"))
        .withColumn("_bucket", _bucket(values))
        .withColumn("_before", F.coalesce(F.sum("_copies").over(before), F.lit(0)))
        .withColumn("_copy", F.explode(copies))
        .withColumn(
            number,
            ((F.col("_before") + F.col("_copy")) * _BUCKETS + F.col("_bucket") + 1).cast("bigint"),
        )
        .select(number, *values)
    )


def highest_id(target: DataFrame, id_column: str) -> Column:
    """The highest id in use, as a scalar subquery; zero for an empty target."""
    return target.agg(F.coalesce(F.max(id_column), F.lit(0)).cast("bigint")).scalar()


def upsert(
    target: DataFrame,
    changes: DataFrame,
    keys: list[str],
    update: list[str],
    *,
    id_column: str | None = None,
    keep_missing: bool = False,
) -> DataFrame:
    """Update matching target rows from ``changes`` and add the rest, in one pass over both.

    Keys are unique on both sides (see :func:`latest_per_key`), so no key can be hot. They compare with
    plain equality: a null key part never matches. With ``keep_missing`` a null in ``changes`` means
    "not given" and keeps the old value. Added rows get ids when ``id_column`` is named.
    """
    if id_column:
        changes = numbered(changes, "_number", keys)
    new = [c for c in changes.columns if c not in keys]
    marked = changes.selectExpr(
        *(f"`{k}`" for k in keys), *(f"`{c}` as `_new_{c}`" for c in new), "true as _hit"
    )
    joined = target.withColumn("_old", F.lit(True)).join(marked, keys, "full")

    def merged(column: str) -> Column:
        if column in keys:
            return F.col(column)
        if column == id_column:
            added = highest_id(target, id_column) + F.col("_new__number")
            return F.coalesce(F.col(column), added).alias(column)
        if column not in new:
            return F.col(column)
        if column in update:
            choice = f"coalesce(`_new_{column}`, `{column}`)" if keep_missing else f"if(_hit, `_new_{column}`, `{column}`)"
        else:
            choice = f"if(_old, `{column}`, `_new_{column}`)"
        return F.expr(choice).alias(column)

    return joined.select(*(merged(c) for c in target.columns))


def update(target: DataFrame, changes: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Update matching target rows only; several may match one change.

    The target is the side of the join that adaptive execution can split when one key is hot, and it
    is not shuffled at all while the changes are small.
    """
    marked = changes.selectExpr(
        *(f"`{k}`" for k in keys), *(f"`{c}` as `_new_{c}`" for c in columns), "true as _hit"
    )
    merged = (f"if(_hit, `_new_{c}`, `{c}`) as `{c}`" if c in columns else f"`{c}`" for c in target.columns)
    return target.join(marked, keys, "left").selectExpr(*merged)


def _conformed(rows: DataFrame, target: DataFrame) -> list[Column]:
    """Columns of ``target`` taken from ``rows``, null where ``rows`` has none."""
    return [
        (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in target.schema
    ]


def append(target: DataFrame, rows: DataFrame) -> DataFrame:
    """Add rows without matching; columns they lack become null."""
    return target.unionByName(rows.select(*_conformed(rows, target)))


def append_numbered(target: DataFrame, rows: DataFrame, id_column: str) -> DataFrame:
    """Add rows whose ``id_column`` holds a number from :func:`numbered`, as ids after the highest."""
    ids = highest_id(target, id_column) + F.col(id_column)
    return append(target, rows.withColumn(id_column, ids))


def delete(target: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    """Remove the rows whose key is in ``gone``."""
    return target.join(gone.select(*keys), keys, "left_anti")


# --- configuration ------------------------------------------------------------------------------


def latest_config(config: DataFrame) -> DataFrame:
    """One configuration row per table: the one stored last."""
    return latest_per_key(config, TABLE_KEYS, "_id").select(*config.columns)


_CONFIG_VALUES = ["low_cardinality_threshold", "freshness_window", "validity_window", "tag"]


def _with_config_defaults(changes: DataFrame) -> DataFrame:
    defaults = dict(zip(_CONFIG_VALUES, (DEFAULT_THRESHOLD, DEFAULT_WINDOW, DEFAULT_WINDOW, None)))
    kinds = dict(zip(_CONFIG_VALUES, ("int", "string", "string", "string")))
    for column, default in defaults.items():
        value = F.lit(default)
        if column in changes.columns:
            value = F.coalesce(F.col(column), value)
        changes = changes.withColumn(column, value.cast(kinds[column]))
    return changes


def upsert_config(config: DataFrame, changes: DataFrame) -> DataFrame:
    """Set the parameters of tables; values left out take their defaults, as for a new row.

    Several changes of a table are settled first, so that it keeps one row.
    """
    changes = settled(_with_config_defaults(changes), TABLE_KEYS, _CONFIG_VALUES)
    return upsert(config, changes, TABLE_KEYS, _CONFIG_VALUES, id_column="_id")


def seed_config(config: DataFrame, tables: DataFrame) -> DataFrame:
    """Default rows for the tables that have no configuration yet; customised rows stay."""
    missing = delete(tables.select(*TABLE_KEYS), config, TABLE_KEYS).distinct()
    rows = numbered(_with_config_defaults(missing), "_id", TABLE_KEYS)
    return append_numbered(config, rows, "_id")


# --- checks -------------------------------------------------------------------------------------


def add_checks(checks: DataFrame, rows: DataFrame) -> DataFrame:
    """Append hand-written checks (no tag) with new ids."""
    rows = numbered_copies(rows.select(*COLUMN_KEYS, "check"), "check_id")
    return append_numbered(checks, rows, "check_id")


def upsert_checks(checks: DataFrame, changes: DataFrame) -> DataFrame:
    """Set checks by column and tag. An untagged change never matches and is always added.

    Several stored checks may share a column and tag; all of them are set. Whether a change is new is
    decided against the distinct stored keys, which are folded before they are shuffled. Repeated
    changes of a column and tag count once; if they differ the job fails.
    """
    keys = [*COLUMN_KEYS, "tag"]
    untagged = changes.where("tag is null").select(*keys, "check")
    changes = settled(changes.where("tag is not null"), keys, ["check"])
    stored = checks.where("tag is not null").select(*keys).distinct()
    # Columns with one untagged change are numbered by key; the changes of the others by all their values.
    counted = untagged.groupBy(*keys).agg(F.count("*").alias("n"), F.min("check").alias("check"))
    single = counted.where("n = 1").dropna(subset=COLUMN_KEYS).drop("n")
    repeated = untagged.join(single.select(*COLUMN_KEYS), COLUMN_KEYS, "left_anti")
    new = changes.join(stored, keys, "left_anti").unionByName(single)
    added = numbered(new, "check_id", keys)
    others = numbered_copies(repeated.select(*keys, "check"), "check_id")
    others = others.withColumn("check_id", highest_id(added, "check_id") + F.col("check_id"))
    after = append_numbered(update(checks, changes, keys, ["check"]), added, "check_id")
    ids = highest_id(checks, "check_id") + F.col("check_id")
    return append(after, others.withColumn("check_id", ids))


def update_checks_by_id(checks: DataFrame, changes: DataFrame) -> DataFrame:
    """Set text and tag of existing checks by id, schema, table and column; adds nothing.

    Several changes of a check are settled first, so that it stays one row.
    """
    keys = ["check_id", "schema_name", "table_name", "column_name"]
    return update(checks, settled(changes, keys, ["check", "tag"]), keys, ["check", "tag"])


def drop_checks(checks: DataFrame, ids: DataFrame) -> DataFrame:
    """Remove checks by id."""
    return delete(checks, ids, ["check_id"])


# --- tags and comments --------------------------------------------------------------------------


def set_tags(tags: DataFrame, changes: DataFrame) -> DataFrame:
    """Set or replace column tags. Repeated changes count once; if they differ the job fails."""
    if "tag_value" not in changes.columns:
        changes = changes.withColumn("tag_value", F.lit(None).cast("string"))
    return upsert(tags, settled(changes, TAG_KEYS, ["tag_value"]), TAG_KEYS, ["tag_value"])


def unset_tags(tags: DataFrame, gone: DataFrame) -> DataFrame:
    """Remove column tags."""
    return delete(tags, gone, TAG_KEYS)


def set_comments(
    columns: DataFrame, tags: DataFrame, changes: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Set column comments and mark those columns as described.

    ``changes`` carries ``comment`` per column; several changes of a column are settled first. Returns the new
    ``columns`` and ``column_tags``.
    """
    changes = settled(changes, COLUMN_KEYS, ["comment"])
    described = update(columns, changes, COLUMN_KEYS, ["comment"])
    marks = changes.select(*COLUMN_KEYS, F.lit(TAG_COMMENT).alias("tag_name"))
    return described, set_tags(tags, marks)
