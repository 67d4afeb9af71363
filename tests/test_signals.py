from __future__ import annotations

from datetime import datetime

from tablegrade.operators import inventory, reconcile, signals
from tablegrade.schemas import PROPERTY_KEYS
from tests.helpers import as_set, by_table, frame

CHECKS = "check_id bigint, column_name string, check string, tag string"
TAGS = "column_name string, tag_name string, tag_value string"


def test_pivot_properties(spark):
    rows = frame(spark, "key string, value string", ("t", "Owner", "me"), ("t", "Provider", "delta"), ("t", "Other", "x"))
    found = signals.pivot_properties(rows)
    assert found.columns[3:] == PROPERTY_KEYS
    assert by_table(found, "Owner", "Provider", "Location") == {"t": ("me", "delta", None)}


def test_check_coverage(spark):
    columns = frame(
        spark, "column_name string",
        ("all", "a"), ("all", "b"), ("some", "a"), ("some", "b"), ("none", "a"), ("blank", "a"),
        ("gone", "a"), ("case", "A"), ("empty", None),
    )
    checks = frame(
        spark, "column_name string, check string",
        ("all", "a", "x"), ("all", "b", "x"), ("all", "b", "y"), ("some", "a", "x"), ("blank", "a", " "),
        ("blank", "a", None), ("gone", "old", "x"), ("case", "a", "x"), ("unlisted", "a", "x"),
    )
    found = signals.check_coverage(columns, checks)
    assert by_table(found, "table_implement_checks", "all_columns_have_checks") == {
        "all": (True, True),
        "some": (True, False),
        "none": (False, False),
        "blank": (False, False),
        "gone": (True, False),
        "case": (True, False),
        "empty": (False, True),
    }


def test_columns_described(spark):
    columns = frame(
        spark, "column_name string, comment string",
        ("all", "a", "x"), ("all", "b", "y"), ("null", "a", "x"), ("null", "b", None), ("blank", "a", " "), ("empty", None, None),
    )
    assert by_table(signals.columns_described(columns), "columns_description") == {
        "all": True, "null": False, "blank": False, "empty": True,
    }


def test_steward_signals_keep_tables_without_facts(spark):
    moment = datetime(2024, 1, 1)
    tables = frame(
        spark, "id string, description string, created_at timestamp_ntz, last_modified timestamp_ntz",
        ("full", "1", "text", moment, moment), ("bare", "2", "", moment, moment),
    )
    properties = frame(
        spark, "key string, value string",
        ("full", "Owner", "me"), ("full", "Provider", "delta"), ("full", "Is_managed_location", "TRUE"),
        ("full", "Table Properties", "[delta.logRetentionDuration=1]"), ("bare", "Owner", " "),
    )
    history = frame(
        spark, "version bigint, timestamp timestamp_ntz, operation string, job string", ("full", 1, moment, "WRITE", "job")
    )
    columns = frame(spark, "column_name string", ("full", "a"), ("bare", "a"))
    checks = frame(spark, "column_name string, check string", ("full", "a", "x"))
    found = signals.steward_signals(tables, properties, history, columns, checks)
    flags = [
        "has_a_valid_owner", "is_delta_table", "table_description", "uses_a_production_pipeline",
        "has_enforced_retention_duration", "is_managed_location", "table_implement_checks", "all_columns_have_checks",
    ]
    assert by_table(found, *flags) == {"full": (True,) * 8, "bare": (False,) * 8}


def test_listings(spark):
    names = ["default", "information_schema", "data_quality", "raw", "sales"]
    schemas = spark.createDataFrame([("c", n) for n in names], ["catalog_name", "schema_name"])
    assert as_set(inventory.list_schemas(schemas), "schema_name") == {"raw", "sales"}
    assert as_set(inventory.list_schemas(schemas, ["raw"]), "schema_name") == {"sales"}
    tables = frame(spark, "", ("t",), ("x_sqldf",), ("x_sqldf_2",), ("a_table_history_b",), ("table_metadata",))
    assert as_set(inventory.list_tables(tables), "table_name") == {"t", "x_sqldf_2"}


def test_column_metadata_and_grouping(spark):
    columns = frame(
        spark, "column_name string, is_nullable string, data_type string, comment string",
        ("t", "b", "YES", "int", None), ("t", "a", "YES", "int", "x"), ("u", "a", "NO", "int", None),
    )
    tags = frame(spark, TAGS, ("t", "a", "has_comment", None), ("t", "a", "has_check", "v"), ("gone", "a", "x", "y"))
    found = inventory.column_metadata(columns, tags)
    tagged = {(r["table_name"], r["column_name"]): [tuple(t) for t in r["tags"]] for r in found.collect()}
    assert tagged == {
        ("t", "a"): [("has_check", "v"), ("has_comment", None)], ("t", "b"): [], ("u", "a"): [],
    }
    grouped = inventory.columns_by_table(frame(spark, "", ("t",), ("none",), ("none",)), found)
    assert {k: [c["column_name"] for c in v] for k, v in by_table(grouped, "columns").items()} == {"t": ["a", "b"], "none": []}


def test_scope_limits_the_inventory(spark):
    columns = frame(
        spark, "column_name string, is_nullable string, data_type string, comment string",
        ("t", "a", "YES", "int", None), ("u", "a", "YES", "int", None),
    )
    tags = frame(spark, TAGS, ("t", "a", "x", None), ("u", "a", "x", None))
    found = inventory.column_metadata(columns, tags, frame(spark, "", ("u",)))
    assert as_set(found, "table_name") == {"u"}


def stored(spark):
    checks = frame(
        spark, CHECKS,
        ("t", 1, "a", "x", None), ("t", 2, "a", "y", None), ("t", 3, "b", None, None), ("t", 4, "b", "  ", None),
        ("t", 5, "old", "x", None), ("u", 6, "a", None, None), ("dropped", 7, "a", "x", None),
    ).select("check_id", "catalog_name", "schema_name", "table_name", "column_name", "check", "tag")
    columns = frame(spark, "column_name string", ("t", "a"), ("t", "b"), ("t", "c"), ("u", "a"))
    tags = frame(
        spark, TAGS, ("t", "b", "has_check", None), ("t", "c", "has_check", None), ("u", "a", "has_check", None), ("t", "a", "mine", "1"),
    )
    return checks, columns, tags


def test_stale_checks(spark):
    checks, columns, _ = stored(spark)
    assert as_set(reconcile.stale_checks(checks, columns), "check_id", "reason") == {
        (3, "blank"), (4, "blank"), (6, "blank"), (5, "orphaned"), (7, "orphaned"),
    }
    assert as_set(reconcile.sync_checks(checks, columns), "check_id") == {1, 2}
    scope = frame(spark, "", ("t",))
    assert as_set(reconcile.sync_checks(checks, columns, scope), "check_id") == {1, 2, 6, 7}


def test_invalid_check_tags(spark):
    checks, _, tags = stored(spark)
    assert as_set(reconcile.invalid_check_tags(tags, checks), "table_name", "column_name") == {("t", "b"), ("t", "c"), ("u", "a")}


def test_reconcile_check_tags(spark):
    checks, columns, tags = stored(spark)
    kept, after = reconcile.reconcile_check_tags(tags, checks, columns)
    assert as_set(kept, "check_id") == {1, 2}
    assert as_set(after, "table_name", "column_name", "tag_name") == {("t", "a", "has_check"), ("t", "a", "mine")}
    _, scoped = reconcile.reconcile_check_tags(tags, checks, columns, frame(spark, "", ("t",)))
    assert as_set(scoped, "table_name", "column_name", "tag_name") == {
        ("t", "a", "has_check"), ("t", "a", "mine"), ("u", "a", "has_check"),
    }


def test_columns_with_checks_and_pending(spark):
    checks, columns, tags = stored(spark)
    assert {r["table_name"]: r["columns"] for r in reconcile.columns_with_checks(checks).collect()} == {
        "c.s.t": ["a", "old"], "c.s.dropped": ["a"],
    }
    assert as_set(reconcile.pending_columns(columns, tags, "has_check"), "table_name", "column_name") == {("t", "a")}
