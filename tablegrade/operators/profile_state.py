"""A column profile that is kept between runs and reads only the files that came since.

The state has rows per table, file and column: how many rows and nulls the file holds, a mergeable sketch of the column's different
values, and those values themselves while they are few. A later run reads the files that the state doesn't have and drops the
rows of files that are gone; counts add up, and a column is low exactly when the united lists of its files are short.

Sketches settle varied columns without gathering their values. A sketch of ``2**p`` places keeps the hashes it meets one by one
until they fill ``3/32`` of its places, and reports their number up to then (with a correction for equal hashes of less than one in a
million); ``p`` is chosen so that the threshold lies below that. So ``t`` different values are never reported as more than
``t + 1``, and a column reported above is surely varied. All others are settled by their values.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegrade.functions.expressions import full_name
from tablegrade.functions.text import sql_name, sql_struct, sql_text
from tablegrade.operators.profile import Tables, as_text, at_once, countable_columns, name_parts, union_all
from tablegrade.schemas import COLUMN_KEYS, DEFAULT_THRESHOLD, TABLE_KEYS, TAG_LOW_CARDINALITY
from tablegrade.sources.local import local_frame
from tablegrade.sources.state_files import stored_once

#: The largest threshold that a sketch of ``2**21`` places, the largest there is, counts one by one.
LARGEST_KEPT = 3 * 2**21 // 32 - 1

_FILE = [T.StructField(k, T.StringType()) for k in [*TABLE_KEYS, "file", "layout"]]
#: ``layout`` stands for the table's columns with their types; rows made for another one, or another threshold, aren't used again.
FILE_PROFILE = T.StructType(
    [
        *_FILE,
        T.StructField("threshold", T.IntegerType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("data_type", T.StringType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("null_count", T.LongType()),
        T.StructField("sketch", T.BinaryType()),
        T.StructField("values", T.ArrayType(T.StringType())),
    ]
)


def sketch_places(threshold: int) -> int:
    """Base-2 logarithm of the places of a sketch that counts up to ``threshold`` values one by one."""
    if not 0 <= threshold <= LARGEST_KEPT:
        raise ValueError(f"no sketch holds a threshold of {threshold}")
    return max(9, math.ceil(math.log2(32 / 3 * (threshold + 1))))


def layout_of(table: DataFrame) -> str:
    """A short text that stands for the columns and their types."""
    return hashlib.sha256(table.schema.simpleString().encode()).hexdigest()[:16]


class _Table:
    """A monitored table, its threshold and its files."""

    def __init__(self, name: str, table: DataFrame, threshold: int):
        self.name, self.table, self.threshold = name, table, threshold
        # Rows name a file without authority as ``file:/…``, the listing as ``file:///…``.
        self.files = {re.sub(r"^(\w+):///", r"\1:/", file) for file in table.inputFiles()}
        self.layout = layout_of(table)
        self.countable = {f.name for f in countable_columns(table)}
        self.keys = dict(zip(TABLE_KEYS, name_parts(name)))

    def base(self) -> list[tuple]:
        """A row per column without a file, so that tables without rows have their columns too."""
        return [
            (*self.keys.values(), None, self.layout, self.threshold, f.name, f.dataType.simpleString(), 0, 0, None, [] if f.name in self.countable else None)
            for f in self.table.schema
        ]

    def fold(self, files: set[str], cells: list[dict[str, str]]) -> DataFrame:
        """One aggregation over some of the files: a row per file and cell. Fields of a cell are SQL aggregates, but for its name."""
        table = self.table
        named = [(i, field, sql) for i, cell in enumerate(cells) for field, sql in cell.items() if field != "column_name"]
        aggregates = [F.expr(sql).alias(f"{field}_{i}") for i, field, sql in named]
        if self.files:
            path = table.metadataColumn("_metadata").getField("file_path")
            if files != self.files:
                table = table.where(path.isin(sorted(files)))
            folded = table.groupBy(path.alias("file")).agg(*aggregates)
        else:
            folded = table.agg(*aggregates).withColumn("file", F.lit(None).cast("string"))
        keys = {k: sql_text(v) for k, v in self.keys.items()}
        rows = [
            sql_struct(**keys, column_name=cell["column_name"], **{f: f"{f}_{i}" for f in cell if f != "column_name"})
            for i, cell in enumerate(cells)
        ]
        return folded.selectExpr("file", f"inline(array({', '.join(rows)}))")

    def counts(self, files: set[str]) -> DataFrame:
        """Row and null counts and sketches by file and column; what can't be compared has no sketch."""
        cells = []
        for f in self.table.schema:
            sketch = f"hll_sketch_agg({as_text(f)}, {sketch_places(self.threshold)})" if f.name in self.countable else "cast(min(null) as binary)"
            nulls = f"count(1) - count({sql_name(f.name)})"
            cells.append({"column_name": sql_text(f.name), "row_count": "count(1)", "null_count": nulls, "sketch": sketch})
        return self.fold(files, cells)

    def values(self, files: set[str], columns: set[str]) -> DataFrame:
        """The different values, by file, of columns that are known to have few."""
        asked = [f for f in self.table.schema if f.name in columns]
        return self.fold(files, [{"column_name": sql_text(f.name), "values": f"sort_array(collect_set({as_text(f)}))"} for f in asked])


def _few(rows: DataFrame) -> DataFrame:
    """``COLUMN_KEYS`` of the columns whose united sketches are not above the threshold, and ``complete``: are all values there?"""
    united = rows.where("sketch is not null").groupBy(*COLUMN_KEYS).agg(
        F.expr("hll_sketch_estimate(hll_union_agg(sketch, true))").alias("n"),
        F.max("threshold").alias("threshold"),
        F.every(F.col("values").isNotNull()).alias("complete"),
    )
    return united.where("n <= threshold + 1").select(*COLUMN_KEYS, "complete")


def _usable(spark: SparkSession, state: DataFrame, tables: list[_Table]) -> tuple[DataFrame, dict[str, set[str]]]:
    """The rows of the state that still hold, and their files by table."""
    now = [(*t.keys.values(), file, t.layout, t.threshold) for t in tables for file in t.files]
    by_file = local_frame(spark, now, T.StructType([*_FILE, T.StructField("threshold", T.IntegerType())]))
    rows = state.join(by_file, by_file.columns, "left_semi")
    # Where files are gone a column may have few values again, which were never listed: such a table is read anew.
    lost = _few(rows).where("not complete").select(*TABLE_KEYS).distinct()
    rows = stored_once(rows.join(lost, TABLE_KEYS, "left_anti").select(*FILE_PROFILE.fieldNames()))
    files: dict[str, set[str]] = {}
    for row in rows.select(full_name().alias("name"), "file").distinct().toLocalIterator():
        files.setdefault(row["name"], set()).add(row["file"])
    return rows, files


def update_file_profile(
    spark: SparkSession,
    tables: Tables,
    thresholds: int | Mapping[str, int] = DEFAULT_THRESHOLD,
    state: DataFrame | None = None,
) -> DataFrame:
    """The state of these tables after reading the files that ``state`` doesn't have.

    New files are read twice at most: for counts and sketches of all columns, and for the values of those columns that are
    still few with all files united. A table is read whole if its columns or threshold changed, if it isn't read from files, or if
    lost files leave a column few values. Files are known by their paths: tables that rewrite a file in place
    need a state without it. The driver holds the paths, as Spark's own listing does. Tables must be plain reads.
    """
    limits = {n: thresholds if isinstance(thresholds, int) else thresholds.get(n, DEFAULT_THRESHOLD) for n in tables}
    all_ = at_once(lambda name: _Table(name, tables[name], limits[name]), list(tables))
    kept, known = (None, {}) if state is None else _usable(spark, state, all_)
    new = {t.name: t.files - known.get(t.name, set()) for t in all_}
    read = [t for t in all_ if new[t.name] or not t.files]
    result = local_frame(spark, [row for t in all_ for row in t.base()], FILE_PROFILE)
    if kept is not None:
        result = result.union(kept)
    counted = union_all([t.counts(new[t.name]) for t in read])
    if counted is None:
        return result
    facts = local_frame(
        spark,
        [(*t.keys.values(), t.layout, t.threshold, f.name, f.dataType.simpleString()) for t in read for f in t.table.schema],
        T.StructType([f for f in FILE_PROFILE if f.name in [*COLUMN_KEYS, "layout", "threshold", "data_type"]]),
    )
    counted = stored_once(counted.join(facts, COLUMN_KEYS).withColumn("values", F.lit(None).cast("array<string>")).select(*FILE_PROFILE.fieldNames()))
    sketches = counted if kept is None else counted.union(kept)
    few: dict[str, set[str]] = {}
    for row in _few(sketches).select(full_name().alias("name"), "column_name").collect():
        few.setdefault(row["name"], set()).add(row["column_name"])
    listed = union_all([t.values(new[t.name], few[t.name]) for t in read if t.name in few])
    if listed is not None:
        keys = [*TABLE_KEYS, "file", "column_name"]
        found = listed.select(*[F.col(k).alias(f"of_{k}") for k in keys], F.col("values").alias("found"))
        same = [F.col(k).eqNullSafe(F.col(f"of_{k}")) for k in keys]
        counted = counted.join(found, same, "left").withColumn("values", F.col("found")).select(*FILE_PROFILE.fieldNames())
    return result.union(counted)


def profile_of(state: DataFrame, tags: DataFrame | None = None) -> DataFrame:
    """The low-cardinality profile that the state gives, as ``profile.low_cardinality`` does from a scan.

    A column tagged as low in ``tags`` stays low; without values once it outgrew the threshold.
    """
    columns = state.groupBy(*COLUMN_KEYS, "data_type").agg(
        F.max("threshold").alias("threshold"), F.every(F.col("values").isNotNull()).alias("complete")
    )
    values = state.select(*COLUMN_KEYS, F.explode("values").alias("value")).distinct()
    lists = values.groupBy(*COLUMN_KEYS).agg(F.sort_array(F.collect_list("value")).alias("found"))
    profile = columns.join(lists, COLUMN_KEYS, "left").withColumn("found", F.coalesce("found", F.array().cast("array<string>")))
    low = F.col("complete") & (F.size("found") <= F.col("threshold"))
    stays = F.lit(False)
    if tags is not None:
        tagged = tags.where(F.col("tag_name") == TAG_LOW_CARDINALITY).select(*COLUMN_KEYS, F.lit(True).alias("tagged")).distinct()
        profile = profile.join(tagged, COLUMN_KEYS, "left")
        stays = F.coalesce("tagged", F.lit(False))
    return profile.select(*COLUMN_KEYS, "data_type", (low | stays).alias("is_low_cardinality"), F.when(low, F.col("found")).alias("values"))


def counts_of(state: DataFrame) -> DataFrame:
    """Row and null counts of every column, as ``profile.column_counts`` gives them from a scan."""
    return state.groupBy(*COLUMN_KEYS).agg(F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"))
