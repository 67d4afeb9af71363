"""The knowledge base of reference checks, read from CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablegrade.operators.state import append
from tablegrade.schemas import KNOWLEDGE_BASE


def read_knowledge_base(spark: SparkSession, path: str) -> DataFrame:
    """Reference checks from CSV files with a header; every field is text."""
    reader = spark.read.schema(KNOWLEDGE_BASE).option("header", True)
    return reader.option("multiLine", True).option("escape", '"').csv(path)


def append_knowledge(knowledge_base: DataFrame, rows: DataFrame) -> DataFrame:
    """Add reference checks that are not stored yet, so that loading twice changes nothing.

    Rows are the same if all their fields are, nulls included: a known id with another text is added
    beside the old row.
    """
    fields = KNOWLEDGE_BASE.fieldNames()
    fresh = rows.select(*fields).subtract(knowledge_base.select(*fields))
    return append(knowledge_base, fresh)
