"""Column tags and table owners from a catalog's information schema, and tags back to it.

The listings are read as frames, so filters reach them and nothing passes through the driver. Tags are written by one statement per
column and tag, as catalogs take them; a statement that fails costs that tag alone and is reported.
"""

from __future__ import annotations

from collections.abc import Iterator

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegrade.functions.text import sql_name, sql_text
from tablegrade.schemas import COLUMN_TAGS, TABLE_KEYS
from tablegrade.sources.catalog import quoted
from tablegrade.sources.local import local_frame

#: What became of a statement; ``error`` is null if it succeeded.
OUTCOME = T.StructType(
    [T.StructField(f.name, f.dataType) for f in COLUMN_TAGS]
    + [T.StructField("action", T.StringType()), T.StructField("error", T.StringType())]
)


def tags_of(spark: SparkSession, catalog: str, tables: DataFrame | None = None) -> DataFrame:
    """The column tags of a catalog, or of some of its tables (rows with the table keys)."""
    listed = spark.table(f"{quoted(catalog)}.information_schema.column_tags")
    listed = listed.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in COLUMN_TAGS))
    listed = listed.where(F.col("catalog_name") == catalog)
    return listed if tables is None else listed.join(tables.select(*TABLE_KEYS).distinct(), TABLE_KEYS, "left_semi")


def owners_of(spark: SparkSession, catalog: str) -> DataFrame:
    """``table_owner`` and ``comment`` of all tables of a catalog."""
    listed = spark.table(f"{quoted(catalog)}.information_schema.tables").where(F.col("table_catalog") == catalog)
    return listed.select(
        F.col("table_catalog").alias("catalog_name"), F.col("table_schema").alias("schema_name"), "table_name", "table_owner", "comment"
    )


def with_owners(details: DataFrame, owners: DataFrame) -> DataFrame:
    """Table details with the owner, and the description where they have none, from the information schema."""
    known = owners.select(*TABLE_KEYS, F.col("table_owner").alias("_owner"), F.col("comment").alias("_comment"))
    filled = details.join(known, TABLE_KEYS, "left")
    filled = filled.withColumn("table_owner", F.coalesce("_owner", "table_owner"))
    return filled.withColumn("description", F.coalesce("description", "_comment")).select(*details.columns)


def tag_statement(row: Row, action: str) -> str:
    """The statement that sets or unsets a tag of a column."""
    table = quoted(".".join(row[k] for k in TABLE_KEYS))
    tag = sql_text(row["tag_name"])
    if action == "SET" and row["tag_value"] is not None:
        tag += f" = {sql_text(row['tag_value'])}"
    return f"ALTER TABLE {table} ALTER COLUMN {sql_name(row['column_name'])} {action} TAGS ({tag})"


def tag_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """What turns the tags ``before`` into those ``after``: rows of tags with ``action`` SET or UNSET."""
    keys = [f.name for f in COLUMN_TAGS if f.name != "tag_value"]
    old = before.select(*keys, F.col("tag_value").alias("_old"), F.lit(True).alias("_was"))
    new = after.select(*keys, "tag_value", F.lit(True).alias("_is"))
    both = old.join(new, keys, "full").where("_was is null or _is is null or not (_old <=> tag_value)")
    action = F.when(F.col("_is"), F.lit("SET")).otherwise("UNSET")
    return both.select(*(f.name for f in COLUMN_TAGS), action.alias("action"))


def write_tags(spark: SparkSession, changes: DataFrame) -> DataFrame:
    """Send changes (see :func:`tag_changes`) to the catalog; one row per change with the ``error``, if it failed.

    Changes are streamed to the driver partition by partition, as the catalog takes them one by one.
    """

    def sent() -> Iterator[tuple]:
        for row in changes.toLocalIterator():
            error = None
            try:
                spark.sql(tag_statement(row, row["action"]))
            except (PySparkException, Py4JError, ValueError) as failure:
                error = str(failure).strip().split("\n")[0] or type(failure).__name__
            yield (*(row[f.name] for f in COLUMN_TAGS), row["action"], error)

    return local_frame(spark, list(sent()), OUTCOME)
