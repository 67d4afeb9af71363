"""Low-cardinality profile of monitored tables and the tag changes it leads to.

The exact result comes in three steps, each reading less than the one before:

1. the first few rows of a table; a column that already shows more values than the threshold there is
   settled, as the whole table can only hold more;
2. one scan of the remaining columns with a constant-size distinct sketch, folded map-side; a column
   above a *proven* bound (:func:`sketch_limit`) is settled too;
3. one scan of the columns still open, collecting their few values exactly.

Steps 1 and 2 return a handful of numbers per column; values never pass through the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegrade.functions.expressions import joined_values
from tablegrade.functions.text import sql_name, sql_struct, sql_text
from tablegrade.operators.state import set_tags, unset_tags
from tablegrade.schemas import (
    COLUMN_KEYS,
    DEFAULT_THRESHOLD,
    TABLE_KEYS,
    TAG_CHECK,
    TAG_COMMENT,
    TAG_LOW_CARDINALITY,
)
from tablegrade.sources.local import local_frame

#: Monitored data by ``catalog.schema.table`` name.
Tables = Mapping[str, DataFrame]

#: Rows looked at before a table is scanned.
_FIRST_ROWS = 200
#: The largest threshold within the sketch's proven range; above it, values are counted exactly.
LARGEST_SKETCHED = 1 << 14
#: Small jobs the driver submits side by side.
_JOBS_AT_ONCE = 16

_PROFILE = T.StructType(
    [T.StructField(k, T.StringType()) for k in [*COLUMN_KEYS, "data_type"]]
    + [
        T.StructField("is_low_cardinality", T.BooleanType()),
        T.StructField("values", T.ArrayType(T.StringType())),
    ]
)


def name_parts(name: str) -> list[str]:
    """The three parts of a dotted table name."""
    parts = name.split(".")
    if len(parts) != 3:
        raise ValueError(f"not a catalog.schema.table name: {name}")
    return parts


def _holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _holds_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_holds_map(f.dataType) for f in kind)
    return isinstance(kind, T.MapType)


def countable_columns(table: DataFrame) -> list[T.StructField]:
    """Columns whose values can be compared: all but maps and what contains them."""
    return [f for f in table.schema if not _holds_map(f.dataType)]


def as_text(field: T.StructField) -> str:
    """SQL for a column's values as text; nested ones as JSON."""
    column = sql_name(field.name)
    nested = isinstance(field.dataType, (T.ArrayType, T.StructType))
    return f"to_json({column})" if nested else f"cast({column} as string)"


def sketch_limit(threshold: int) -> tuple[float, int]:
    """Accuracy to ask of the distinct sketch, and the most it can report for a low column.

    The sketch has ``m = 2**p`` registers and, while few are filled, reports ``m * ln(m / empty)``.
    ``t`` distinct values fill at most ``t`` registers, so at least ``m - t`` stay empty and the
    report is at most ``m * ln(m / (m - t))``, whatever the values are. With ``m >= 4 t`` this lies
    well inside the range where the sketch uses that formula. One is added for rounding and two more
    for values that the sketch tells apart but equality does not (zero and minus zero).
    """
    if threshold > LARGEST_SKETCHED:
        raise ValueError(f"a threshold of {threshold} is beyond the sketch's range")
    p = max(9, math.ceil(math.log2(4 * max(threshold, 1))))
    m = 2**p
    # p = ceil(2 * log2(1.106 / accuracy)); aim just inside so that exactly p registers bits result.
    accuracy = 1.106 / 2 ** (p / 2) * 1.0001
    return accuracy, math.ceil(m * math.log(m / (m - threshold))) + 3


def _open_after_first_rows(table: DataFrame, columns: list[str], threshold: int) -> list[str]:
    """Columns that do not exceed the threshold within the first rows.

    Only 64-bit hashes reach the driver. Unequal hashes prove unequal values, so a column is
    dropped only when it surely exceeds the threshold. Beyond the sketch's range nothing is looked at.
    """
    if not columns or threshold > LARGEST_SKETCHED:
        return columns
    rows = max(_FIRST_ROWS, 4 * threshold)
    hashes = [f"if(isnull({c}), null, xxhash64({c}))" for c in map(sql_name, columns)]
    seen = table.selectExpr(f"array({', '.join(hashes)}) as hashes").limit(rows).collect()
    # One spare value: zero and minus zero hash differently but are equal.
    return [
        column
        for column, found in zip(columns, zip(*(row["hashes"] for row in seen)) if seen else [()] * len(columns))
        if len(set(found) - {None}) <= threshold + 1
    ]


def fold(name: str, table: DataFrame, cells: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """One aggregation over a table, given back as one row per cell.

    ``cells`` maps a label to the aggregates (SQL) it stands for; all cells have the same fields. Each
    row carries the table's name parts, the label as ``column_name`` and the aggregates.
    """
    keys = {k: sql_text(p) for k, p in zip(TABLE_KEYS, name_parts(name))}
    rows = [
        sql_struct(**keys, column_name=sql_text(label), **fields) for label, fields in cells.items()
    ]
    return table.selectExpr(f"inline(array({', '.join(rows)}))")


def union_all(frames: list[DataFrame]) -> DataFrame | None:
    """Union of frames with the same columns, as a balanced tree; None for none."""
    while len(frames) > 1:
        pairs = [frames[i : i + 2] for i in range(0, len(frames), 2)]
        frames = [pair[0].union(pair[1]) if len(pair) == 2 else pair[0] for pair in pairs]
    return frames[0] if frames else None


def at_once(function: Callable, items: list) -> list:
    """Results of a driver-side call for several tables, their small jobs submitted together."""
    with ThreadPoolExecutor(max_workers=_JOBS_AT_ONCE) as pool:
        return list(pool.map(function, items))


def distinct_values(name: str, table: DataFrame, fields: list[T.StructField]) -> DataFrame:
    """The distinct non-null values of several columns as rows, from one scan of just these columns."""
    keys = {k: sql_text(p) for k, p in zip(TABLE_KEYS, name_parts(name))}
    cells = [sql_struct(**keys, column_name=sql_text(f.name), value=as_text(f)) for f in fields]
    return table.selectExpr(f"inline(array({', '.join(cells)}))").where("value is not null").distinct()


def _sketched(tables: Tables, open_columns: Mapping[str, list[str]], thresholds: Mapping[str, int]):
    """Estimated distinct counts of the open columns of all tables, from one job.

    Exact ones where the threshold is beyond the sketch's range; columns without values are missing then.
    """
    frames = []
    for name, columns in open_columns.items():
        if columns and thresholds[name] > LARGEST_SKETCHED:
            asked = [f for f in tables[name].schema if f.name in columns]
            values = distinct_values(name, tables[name], asked)
            frames.append(values.groupBy(*COLUMN_KEYS).agg(F.count("value").alias("estimate")))
        elif columns:
            accuracy, _ = sketch_limit(thresholds[name])
            counts = {
                c: {"estimate": f"approx_count_distinct({sql_name(c)}, {accuracy}D)"} for c in columns
            }
            frames.append(fold(name, tables[name], counts))
    union = union_all(frames)
    rows = union.collect() if union is not None else []
    return {
        (".".join(row[k] for k in TABLE_KEYS), row["column_name"]): row["estimate"] for row in rows
    }


def _tagged_columns(tags: DataFrame | None, tables: Tables) -> set[tuple[str, str]]:
    """``(table, column)`` of the monitored columns already tagged as low cardinality."""
    if tags is None:
        return set()
    name = F.concat_ws(".", *TABLE_KEYS)
    tagged = tags.where((F.col("tag_name") == TAG_LOW_CARDINALITY) & name.isin(list(tables)))
    rows = tagged.select(name.alias("name"), "column_name").distinct().collect()
    return {(row["name"], row["column_name"]) for row in rows}


def low_cardinality(
    spark: SparkSession,
    tables: Tables,
    thresholds: int | Mapping[str, int] = DEFAULT_THRESHOLD,
    tags: DataFrame | None = None,
    *,
    recheck_tagged: bool = False,
) -> DataFrame:
    """Every column of every table: is it of low cardinality, and if so with which values.

    A column is low when it has at most ``threshold`` distinct non-null values (none at all counts).
    Maps, and what contains them, cannot be compared and are never found low. A column already tagged stays low whatever it holds now, unless ``recheck_tagged``; once it has
    outgrown the threshold its values are no longer listed (``values`` is null), as they would not
    fit a tag. :func:`low_cardinality_values` gives them all as rows.
    """
    limits = {
        name: thresholds if isinstance(thresholds, int) else thresholds.get(name, DEFAULT_THRESHOLD)
        for name in tables
    }
    fields = {name: {f.name: f for f in countable_columns(t)} for name, t in tables.items()}
    tagged = set() if recheck_tagged else _tagged_columns(tags, tables)
    looks = at_once(
        lambda name: _open_after_first_rows(tables[name], list(fields[name]), limits[name]),
        list(tables),
    )
    still_open = dict(zip(tables, looks))
    estimates = _sketched(tables, still_open, limits)

    exact, settled = [], []
    for name, table in tables.items():
        exactly = limits[name] > LARGEST_SKETCHED
        low_limit = limits[name] if exactly else sketch_limit(limits[name])[1]
        kept = [c for c in still_open[name] if estimates.get((name, c), 0) <= low_limit]
        if kept:
            exact.append(_exact_values(name, table, [fields[name][c] for c in kept], tagged, limits[name]))
        settled += [
            (*name_parts(name), c, f.dataType.simpleString(), (name, c) in tagged, None)
            for c, f in ((f.name, f) for f in table.schema)
            if c not in kept
        ]
    if settled:
        exact.append(local_frame(spark, settled, _PROFILE))
    result = union_all(exact)
    return result if result is not None else local_frame(spark, [], _PROFILE)


def _exact_values(
    name: str, table: DataFrame, kept: list[T.StructField], tagged: set, threshold: int
) -> DataFrame:
    """The kept columns' distinct values from one scan of just these columns."""
    cells = {
        f.name: {
            "data_type": sql_text(f.dataType.simpleString()),
            "stays": "true" if (name, f.name) in tagged else "false",
            "found": f"sort_array(collect_set({as_text(f)}))",
        }
        for f in kept
    }
    low = f"size(found) <= {threshold}"
    return fold(name, table, cells).selectExpr(
        *COLUMN_KEYS,
        "data_type",
        f"stays or {low} as is_low_cardinality",
        f"if({low}, found, null) as values",
    )


def low_cardinality_values(
    spark: SparkSession,
    tables: Tables,
    thresholds: int | Mapping[str, int] = DEFAULT_THRESHOLD,
    tags: DataFrame | None = None,
) -> DataFrame:
    """Every distinct non-null value of every column that is low or tagged as low, one row per value.

    Tagged columns may have outgrown any threshold: their values are never gathered into a list.
    """
    tagged = _tagged_columns(tags, tables)
    frames, others = [], {}
    for name, table in tables.items():
        held = [f for f in countable_columns(table) if (name, f.name) in tagged]
        if held:
            frames.append(distinct_values(name, table, held))
        others[name] = table.drop(*[f.name for f in held])
    low = low_cardinality(spark, others, thresholds).where("is_low_cardinality")
    return union_all([*frames, low.select(*COLUMN_KEYS, F.explode("values").alias("value"))])


def column_values(table: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values of one column as rows, for columns too varied for a list."""
    field = table.schema[column]
    return table.selectExpr(f"{as_text(field)} as value").where("value is not null").distinct()


def with_value_text(profile: DataFrame) -> DataFrame:
    """The profile with ``distinct_values`` as one text instead of a list."""
    return profile.withColumn("distinct_values", joined_values(F.col("values"))).drop("values")


def column_counts(tables: Tables, columns: Mapping[str, list[str]] | None = None) -> DataFrame:
    """Row and null counts of columns, one scan per table reading only the columns asked for."""
    frames = []
    for name, table in tables.items():
        asked = table.columns if columns is None else columns.get(name, [])
        if asked:
            cells = {
                c: {"row_count": "count(1)", "null_count": f"count(1) - count({sql_name(c)})"}
                for c in asked
            }
            frames.append(fold(name, table, cells))
    union = union_all(frames)
    if union is None:
        raise ValueError("no columns to count")
    return union


def low_cardinality_tag_changes(
    profile: DataFrame, tags: DataFrame, *, every_run: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Tags to set and tags to remove after a profile.

    A low column gets its values as tag; its check and comment tags go so that both are drafted
    again, by default only when the list of values changed. A column that is not low loses the tag.
    """
    held = tags.where(F.col("tag_name") == TAG_LOW_CARDINALITY).select(
        *COLUMN_KEYS, F.col("tag_value").alias("old"), F.lit(True).alias("held")
    )
    compared = with_value_text(profile).join(held, COLUMN_KEYS, "left")
    low = F.col("is_low_cardinality")
    # A tagged column that outgrew the threshold has no list any more and keeps its old tag.
    listed = low & F.col("distinct_values").isNotNull()
    changed = F.col("held").isNull() | ~F.col("old").eqNullSafe(F.col("distinct_values"))
    if every_run:
        changed = F.lit(True)
    to_set = compared.where(listed & changed).select(
        *COLUMN_KEYS,
        F.lit(TAG_LOW_CARDINALITY).alias("tag_name"),
        F.col("distinct_values").alias("tag_value"),
    )
    outdated = F.when(listed & changed, F.array(F.lit(TAG_CHECK), F.lit(TAG_COMMENT))).when(
        ~low, F.array(F.lit(TAG_LOW_CARDINALITY))
    )
    to_unset = compared.select(*COLUMN_KEYS, F.explode(outdated).alias("tag_name"))
    return to_set, to_unset


def update_low_cardinality_tags(
    profile: DataFrame, tags: DataFrame, *, every_run: bool = False
) -> DataFrame:
    """Column tags after a profile; see :func:`low_cardinality_tag_changes`."""
    to_set, to_unset = low_cardinality_tag_changes(profile, tags, every_run=every_run)
    return set_tags(unset_tags(tags, to_unset), to_set)
