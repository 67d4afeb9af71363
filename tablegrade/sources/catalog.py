"""Filling the inventory frames from a Spark catalog.

Listing and describing are catalog calls, answered by the driver's catalog client; they move metadata
only. Everything after them works on the frames.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegrade.operators.profile import Tables, name_parts, union_all
from tablegrade.sources.local import local_frame
from tablegrade.schemas import (
    COLUMNS,
    PROPERTY_KEYS,
    SCHEMA_VERSIONS,
    TABLE_HISTORY,
    TABLE_KEYS,
    TABLE_PROPERTIES,
    TABLES,
)


def quoted(name: str) -> str:
    """A dotted name with each part quoted for SQL."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def open_tables(spark: SparkSession, names: Iterable[str]) -> dict[str, DataFrame]:
    """The monitored tables by name; nothing is read yet."""
    return {name: spark.table(quoted(name)) for name in names}


def open_parquet(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    """Monitored parquet data by table name."""
    return {name: spark.read.parquet(path) for name, path in paths.items()}


def schemas_in(spark: SparkSession, catalog: str) -> DataFrame:
    """All schemas of a catalog."""
    rows = spark.sql(f"SHOW SCHEMAS IN {quoted(catalog)}")
    return rows.select(F.lit(catalog).alias("catalog_name"), F.col("namespace").alias("schema_name"))


def tables_in(spark: SparkSession, catalog: str, schema: str) -> DataFrame:
    """All tables of a schema; views without a schema are not among them."""
    rows = spark.sql(f"SHOW TABLES IN {quoted(f'{catalog}.{schema}')}").where("not isTemporary")
    return rows.select(
        F.lit(catalog).alias("catalog_name"),
        F.lit(schema).alias("schema_name"),
        F.col("tableName").alias("table_name"),
    )


def _type_text(kind: T.DataType, with_nullability: bool) -> str:
    return kind.json() if with_nullability else kind.simpleString()


def columns_of(
    spark: SparkSession, tables: Tables, *, with_nullability: bool = False
) -> DataFrame:
    """Column inventory of tables, from their schemas, without a job.

    ``with_nullability`` makes ``data_type`` tell nested nullability apart.
    """
    rows = [
        (
            *name_parts(name),
            field.name,
            "YES" if field.nullable else "NO",
            _type_text(field.dataType, with_nullability),
            field.metadata.get("comment"),
        )
        for name, table in tables.items()
        for field in table.schema
    ]
    return local_frame(spark, rows, COLUMNS)


def _for_each(spark: SparkSession, names: Iterable[str], schema: T.StructType, describe) -> DataFrame:
    """Union of one small described frame per table, each with the table's name parts."""
    frames = [
        describe(quoted(name)).select(
            *(F.lit(p).alias(k) for p, k in zip(name_parts(name), TABLE_KEYS)), "*"
        )
        for name in names
    ]
    union = union_all(frames)
    if union is None:
        return local_frame(spark, [], schema)
    return union.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema))


def properties_of(spark: SparkSession, names: Iterable[str]) -> DataFrame:
    """Extended description of tables as key/value rows, limited to the keys that are scored."""

    def describe(name: str) -> DataFrame:
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where(F.col("col_name").isin(PROPERTY_KEYS))
        return rows.select(F.col("col_name").alias("key"), F.col("data_type").alias("value"))

    return _for_each(spark, names, TABLE_PROPERTIES, describe)


def history_of(spark: SparkSession, names: Iterable[str]) -> DataFrame:
    """Commit history of tables whose format keeps one (``DESCRIBE HISTORY``)."""

    def describe(name: str) -> DataFrame:
        rows = spark.sql(f"DESCRIBE HISTORY {name}")
        return rows.select(
            "version", "timestamp", "operation", F.col("job").cast("string").alias("job")
        )

    return _for_each(spark, names, TABLE_HISTORY, describe)


def detail_of(spark: SparkSession, names: Iterable[str]) -> DataFrame:
    """Detail of tables whose format keeps it (``DESCRIBE DETAIL``)."""

    def describe(name: str) -> DataFrame:
        return spark.sql(f"DESCRIBE DETAIL {name}").select(
            "id",
            F.lit(None).alias("table_owner"),
            "description",
            F.col("createdAt").alias("created_at"),
            F.col("lastModified").alias("last_modified"),
        )

    return _for_each(spark, names, TABLES, describe)


def schema_versions_of(spark: SparkSession, versions: Mapping[str, Iterable[int]]) -> DataFrame:
    """Columns of past versions of tables that can be read as of a version; schemas only, no scan."""
    rows = [
        (*name_parts(name), int(version), field.name, field.dataType.simpleString())
        for name, numbers in versions.items()
        for version in numbers
        for field in spark.sql(f"SELECT * FROM {quoted(name)} VERSION AS OF {int(version)}").schema
    ]
    return local_frame(spark, rows, SCHEMA_VERSIONS)


def write_comments(spark: SparkSession, comments: DataFrame) -> None:
    """Store column comments in the catalog, one bound statement per column.

    Rows are streamed to the driver partition by partition, as the catalog takes them one by one.
    """
    for row in comments.select(*TABLE_KEYS, "column_name", "comment").toLocalIterator():
        table = quoted(".".join(row[k] for k in TABLE_KEYS))
        column = "`" + row["column_name"].replace("`", "``") + "`"
        spark.sql(f"ALTER TABLE {table} ALTER COLUMN {column} COMMENT :text", args={"text": row["comment"]})
