"""Column layouts of the frames the operators read and write."""

from __future__ import annotations

from pyspark.sql import types as T

#: The three name parts that identify a table in every frame.
TABLE_KEYS = ["catalog_name", "schema_name", "table_name"]
#: The name parts that identify a column.
COLUMN_KEYS = [*TABLE_KEYS, "column_name"]


def _fields(**types: T.DataType) -> list[T.StructField]:
    return [T.StructField(name, kind) for name, kind in types.items()]


def _named(keys: list[str], *fields: T.StructField) -> T.StructType:
    return T.StructType([T.StructField(k, T.StringType()) for k in keys] + list(fields))


_STR, _INT, _LONG, _BOOL = T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType()
_TS = T.TimestampNTZType()

# --- fixed values -------------------------------------------------------------------------------

#: The thirteen metrics in stored order.
METRICS = [
    "table_description",
    "columns_description",
    "has_a_valid_owner",
    "is_delta_table",
    "uses_a_production_pipeline",
    "has_enforced_retention_duration",
    "is_managed_location",
    "is_fresh",
    "columns_valid",
    "columns_datatype_valid",
    "all_columns_have_checks",
    "table_implement_checks",
    "has_check_passed",
]

#: Points per metric, grouped by dimension; they add up to 100.
DIMENSIONS = {
    "stewardship": {
        "has_a_valid_owner": 5,
        "is_delta_table": 5,
        "uses_a_production_pipeline": 5,
        "has_enforced_retention_duration": 5,
        "is_managed_location": 5,
    },
    "usability": {"table_description": 7, "columns_description": 8},
    "freshness": {"is_fresh": 10},
    "validity": {"columns_valid": 10, "columns_datatype_valid": 10},
    "accuracy": {
        "table_implement_checks": 5,
        "all_columns_have_checks": 5,
        "has_check_passed": 20,
    },
}

#: Lowest score of each band, best first; anything below the last is ``LOWEST_BAND``.
BANDS = [("Good", 65), ("Okay", 45)]
LOWEST_BAND = "Poor"

#: Commit operations that count as a write of the table's data.
WRITE_OPERATIONS = [
    "WRITE",
    "CREATE TABLE",
    "CREATE TABLE AS SELECT",
    "CREATE OR REPLACE TABLE",
    "CREATE OR REPLACE TABLE AS SELECT",
    "COPY INTO",
    "STREAMING UPDATE",
    "MERGE",
    "UPDATE",
    "DELETE",
]

#: Keys of the extended table description that are pivoted into columns.
PROPERTY_KEYS = [
    "Catalog",
    "Database",
    "Table",
    "Column Names",
    "Created Time",
    "Last Access",
    "Created By",
    "Location",
    "Provider",
    "Owner",
    "Is_managed_location",
    "Table Properties",
    "name",
]

#: Table properties whose presence means that a retention period is enforced.
RETENTION_PROPERTIES = ["delta.logRetentionDuration", "delta.deletedFileRetentionDuration"]

#: Column tags that carry the engine's own state.
TAG_CHECK = "has_check"
TAG_COMMENT = "has_comment"
TAG_LOW_CARDINALITY = "has_low_cardinality"

#: Mark of a stored check that was generated rather than written by hand.
GENERATED = "ai_generated"

#: Schemas never listed, and those also left out when configuration is seeded.
SYSTEM_SCHEMAS = ["default", "information_schema", "data_quality"]
UNSEEDED_SCHEMAS = ["models", "models_monitoring", "analytics", "curated", "raw"]

#: Per-table defaults.
DEFAULT_THRESHOLD = 10
DEFAULT_WINDOW = "1d"
DEFAULT_TOP_K = 5

# ------------------------------------------------------------------------------------------------

DQ_CONFIG = T.StructType(
    [T.StructField("_id", _LONG)]
    + _named(
        TABLE_KEYS,
        *_fields(
            low_cardinality_threshold=_INT, freshness_window=_STR, validity_window=_STR, tag=_STR
        ),
    ).fields
)

COLUMN_CHECKS = T.StructType(
    [T.StructField("check_id", _LONG)]
    + _named(COLUMN_KEYS, *_fields(check=_STR, tag=_STR)).fields
)

DQ_SUMMARY = T.StructType(
    [T.StructField("table_id", _LONG)]
    + _named(TABLE_KEYS, *(T.StructField(m, _BOOL) for m in METRICS)).fields
)

KNOWLEDGE_BASE = T.StructType(_fields(check_id=_STR, check_syntax=_STR, description=_STR))

COLUMNS = _named(COLUMN_KEYS, *_fields(is_nullable=_STR, data_type=_STR, comment=_STR))

COLUMN_TAGS = _named(COLUMN_KEYS, *_fields(tag_name=_STR, tag_value=_STR))

TABLES = _named(
    TABLE_KEYS,
    *_fields(id=_STR, table_owner=_STR, description=_STR, created_at=_TS, last_modified=_TS),
)

TABLE_PROPERTIES = _named(TABLE_KEYS, *_fields(key=_STR, value=_STR))

TABLE_HISTORY = _named(TABLE_KEYS, *_fields(version=_LONG, timestamp=_TS, operation=_STR, job=_STR))

SCHEMA_VERSIONS = _named(
    TABLE_KEYS, *_fields(version=_LONG, column_name=_STR, data_type=_STR)
)

#: One metric of one table; a row that is absent means "not given".
METRIC_ROWS = _named(TABLE_KEYS, *_fields(metric=_STR, value=_BOOL))

#: State frames that outlive a run, by name.
STATE = {
    "dq_config": DQ_CONFIG,
    "column_checks": COLUMN_CHECKS,
    "dq_summary": DQ_SUMMARY,
    "columns": COLUMNS,
    "column_tags": COLUMN_TAGS,
}
