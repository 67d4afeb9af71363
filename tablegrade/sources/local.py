"""Small frames from values the driver already holds, such as catalog listings."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_ARROW = {
    "string": pa.string(),
    "binary": pa.binary(),
    "bigint": pa.int64(),
    "int": pa.int32(),
    "boolean": pa.bool_(),
    "timestamp_ntz": pa.timestamp("us"),
    "array<string>": pa.list_(pa.string()),
}


def local_frame(spark: SparkSession, rows: list[tuple], schema: T.StructType | str) -> DataFrame:
    """A frame of the given rows, by way of Arrow, so that Spark knows its size when it plans joins."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    columns = zip(*rows) if rows else ([] for _ in schema)
    arrays = [
        pa.array(list(values), _ARROW[field.dataType.simpleString()])
        for values, field in zip(columns, schema)
    ]
    return spark.createDataFrame(pa.table(arrays, names=schema.fieldNames()), schema)
