from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

KEYS = "catalog_name string, schema_name string, table_name string"


def frame(spark: SparkSession, columns: str, *rows: tuple) -> DataFrame:
    """A frame of named tables: ``rows`` give the table name and then ``columns``."""
    schema = f"{KEYS}, {columns}" if columns else KEYS
    return spark.createDataFrame([("c", "s", *row) for row in rows], schema)


def by_table(found: DataFrame, *columns: str) -> dict:
    """Values of some columns by table name; one column gives plain values."""
    rows = found.select("table_name", *columns).collect()
    return {r[0]: r[1] if len(columns) == 1 else tuple(r[1:]) for r in rows}


def as_set(found: DataFrame, *columns: str) -> set:
    rows = found.select(*columns).collect()
    assert len(rows) == len(set(rows)), "repeated rows"
    return {r[0] if len(columns) == 1 else tuple(r) for r in rows}
