"""A whole run over a small catalog, stored between the stages, and a second run after a change."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tablegrade.operators import score
from tablegrade.operators.profile_state import update_file_profile
from tablegrade.plans import stages
from tablegrade.schemas import COLUMN_CHECKS, COLUMN_TAGS, DQ_CONFIG, DQ_SUMMARY, SCHEMA_VERSIONS
from tablegrade.sources.catalog import columns_of
from tablegrade.sources.state_files import stored_once
from tests.helpers import as_set, by_table, frame

NOW = "2024-01-31 00:00:00"


def catalog_of(spark):
    orders = spark.range(300).selectExpr("id", "if(id % 2 = 0, 'open', 'done') as state", "if(id = 7, null, id % 50) as amount")
    return {"c.s.orders": orders, "c.s.notes": spark.createDataFrame([("x",), (None,)], "text string")}


def facts(spark):
    at = datetime(2024, 1, 30, 12)
    return stages.TableFacts(
        frame(
            spark, "id string, description string, created_at timestamp_ntz, last_modified timestamp_ntz",
            ("orders", "1", "All orders", at, at), ("notes", "2", None, at, at),
        ),
        frame(
            spark, "key string, value string",
            ("orders", "Owner", "me"), ("orders", "Provider", "delta"), ("orders", "Is_managed_location", "true"),
            ("orders", "Table Properties", "[delta.logRetentionDuration=1]"),
        ),
        frame(
            spark, "version bigint, timestamp timestamp_ntz, operation string, job string",
            ("orders", 1, datetime(2024, 1, 1), "CREATE TABLE", None), ("orders", 2, at, "WRITE", "job"),
        ),
        frame(
            spark, "version bigint, column_name string, data_type string",
            *[("orders", 1, c, k) for c, k in (("id", "bigint"), ("state", "string"), ("amount", "bigint"))],
        ),
    )


def seeded(spark):
    schemas = spark.createDataFrame([("c", "s"), ("c", "raw")], ["catalog_name", "schema_name"])
    tables = frame(spark, "", ("orders",), ("notes",), ("x_sqldf",)).unionByName(
        frame(spark, "", ("hidden",)).withColumn("schema_name", F.lit("raw"))
    )
    return stages.seed(spark.createDataFrame([], DQ_CONFIG), schemas, tables)


def run(spark, tables, config, state, summary):
    state, profile = stages.enrich(spark, tables, config, state)
    state = stages.suggest(tables, profile, config, state.stored()).stored()
    return state, stages.grade(spark, tables, config, facts(spark), state, summary, NOW)


def test_two_runs(spark):
    config = seeded(spark)
    assert as_set(config, "table_name") == {"orders", "notes"}
    tables = catalog_of(spark)
    state = stages.ColumnState(
        columns_of(spark, tables), spark.createDataFrame([], COLUMN_TAGS), spark.createDataFrame([], COLUMN_CHECKS)
    )
    state, summary = run(spark, tables, config, state, spark.createDataFrame([], DQ_SUMMARY))
    assert as_set(state.columns, "column_name", "comment") == {
        ("id", "Id (bigint)."),
        ("state", "State (string). Valid values: done, open."),
        ("amount", "Amount (bigint, may be empty)."),
        ("text", "Text (string, may be empty). Valid values: x."),
    }
    assert as_set(state.checks, "column_name", "check") == {
        ("id", "  - missing_count(id) = 0"),
        ("state", '  - missing_count(state) = 0\n  - invalid_count(state) = 0:\n      valid values: ["done", "open"]'),
        ("text", '  - invalid_count(text) = 0:\n      valid values: ["x"]'),
    }
    tags = as_set(state.tags, "column_name", "tag_name", "tag_value")
    assert ("state", "has_low_cardinality", "done, open") in tags
    assert {c for c, n, _ in tags if n == "has_check"} == {"id", "state", "text"}
    assert {c for c, n, _ in tags if n == "has_comment"} == {"id", "state", "amount", "text"}
    # orders: everything but a check on every column; notes: described, covered and passing.
    scores = by_table(score.score_tables(summary), "stewardship", "usability", "freshness", "validity", "accuracy", "band")
    assert scores == {"orders": (25, 15, 10, 20, 25, "Good"), "notes": (0, 8, 0, 0, 30, "Poor")}

    # A new value appears, a column goes, and one table cannot be opened.
    changed = {"c.s.orders": tables["c.s.orders"].selectExpr("id", "if(id = 5, 'lost', state) as state")}
    later = stages.ColumnState(
        state.columns.where("column_name <> 'amount'"), state.tags.where("column_name <> 'amount'"), state.checks
    )
    again, second = run(spark, changed, config, later, summary)
    tags = as_set(again.tags, "column_name", "tag_name", "tag_value")
    assert ("state", "has_low_cardinality", "done, lost, open") in tags
    checks = dict(as_set(again.checks, "column_name", "check"))
    assert checks["state"].endswith('["done", "lost", "open"]') and len(checks) == 3
    comments = dict(as_set(again.columns, "column_name", "comment"))
    assert comments["state"] == "State (string). Valid values: done, lost, open."
    scores = by_table(score.score_tables(second), "validity", "accuracy")
    # A column is gone, so the schema differs; the unopened table keeps its earlier outcome.
    assert scores == {"orders": (10, 30), "notes": (0, 30)}


def test_a_kept_profile_saves_the_scans(spark):
    """With a kept profile the stages give the same without reading the tables."""
    config, tables = seeded(spark), catalog_of(spark)
    state = stages.ColumnState(
        columns_of(spark, tables), spark.createDataFrame([], COLUMN_TAGS), spark.createDataFrame([], COLUMN_CHECKS)
    )
    kept = stored_once(update_file_profile(spark, tables, stages.thresholds_of(config, tables)))
    ends = []
    for given, read in ((kept, {}), (None, tables)):
        enriched, profile = stages.enrich(spark, read, config, state, kept=given)
        ends.append(stages.suggest(read, profile, config, enriched.stored(), kept=given))
    saved, scanned = ends
    assert as_set(saved.columns, "column_name", "comment") == as_set(scanned.columns, "column_name", "comment")
    assert as_set(saved.tags, "column_name", "tag_name", "tag_value") == as_set(scanned.tags, "column_name", "tag_name", "tag_value")
    assert as_set(saved.checks, "column_name", "check") == as_set(scanned.checks, "column_name", "check")
    assert as_set(saved.checks, "column_name") == {"id", "state", "text"}


def test_a_failing_check_costs_points(spark):
    tables = catalog_of(spark)
    checks = frame(
        spark, "check_id bigint, column_name string, check string, tag string",
        ("orders", 1, "amount", "missing_count(amount) = 0", None), ("notes", 2, "text", "missing_count(text) = 1", None),
    )
    state = stages.ColumnState(columns_of(spark, tables), spark.createDataFrame([], COLUMN_TAGS), checks)
    no_past = stages.TableFacts(*[getattr(facts(spark), f) for f in ("tables", "properties", "history")], spark.createDataFrame([], SCHEMA_VERSIONS))
    summary = stages.grade(spark, tables, seeded(spark), no_past, state, spark.createDataFrame([], DQ_SUMMARY), NOW)
    flags = ("table_implement_checks", "all_columns_have_checks", "has_check_passed", "columns_valid")
    assert by_table(summary, *flags) == {"orders": (True, False, False, False), "notes": (True, True, True, False)}


def test_thresholds(spark):
    rows = frame(spark, "_id bigint, low_cardinality_threshold int", ("orders", 1, 5), ("orders", 2, 7), ("other", 3, 9))
    assert stages.thresholds_of(rows, catalog_of(spark)) == {"c.s.orders": 7, "c.s.notes": 10}


def test_a_failing_table_costs_one_table(spark, monkeypatch):
    """A table that cannot be read keeps its earlier outcome and is named; the others are graded."""
    tables = {f"c.s.t{i}": spark.range(10).selectExpr("id") for i in range(9)}
    state = stages.ColumnState(
        columns_of(spark, tables),
        spark.createDataFrame([], COLUMN_TAGS),
        frame(spark, "check_id bigint, column_name string, check string, tag string", *[(f"t{i}", i, "id", "missing_count(id) = 0", None) for i in range(9)]),
    )
    config = stages.seed(
        spark.createDataFrame([], DQ_CONFIG), spark.createDataFrame([("c", "s")], ["catalog_name", "schema_name"]),
        frame(spark, "", *[(f"t{i}",) for i in range(9)]),
    )
    before = stages.grade(spark, tables, config, facts(spark), state, spark.createDataFrame([], DQ_SUMMARY), NOW)
    broken = tables | {f"c.s.t{i}": spark.range(10).selectExpr("if(id < 0, id, raise_error('no such file')) as id") for i in (2, 7)}
    monkeypatch.setattr(stages, "TABLES_AT_ONCE", 5)
    failures: list[stages.Failure] = []
    enriched, _ = stages.enrich(spark, broken, config, state, failures)
    assert [(f.table, f.stage) for f in failures] == [("c.s.t2", "enrich"), ("c.s.t7", "enrich")]
    failures.clear()
    after = stages.grade(spark, broken, config, facts(spark), state, before, NOW, failures)
    passed = by_table(after, "has_check_passed")
    assert passed == {f"t{i}": True for i in range(9)}
    rows = stages.failure_rows(spark, failures).collect()
    assert [(r["table_name"], r["stage"]) for r in rows] == [("t2", "grade"), ("t7", "grade")]
    assert all("no such file" in r["error"] for r in rows)
    empty = stages.grade(spark, broken, config, facts(spark), state, spark.createDataFrame([], DQ_SUMMARY), NOW, [])
    assert {t for t, value in by_table(empty, "has_check_passed").items() if not value} == {"t2", "t7"}


def test_the_history_is_read_once(spark, tmp_path):
    known = facts(spark)
    known.history.write.parquet(f"{tmp_path}/commits_of_all")
    known = stages.TableFacts(known.tables, known.properties, spark.read.parquet(f"{tmp_path}/commits_of_all"), known.schema_versions)
    state = stages.ColumnState(columns_of(spark, catalog_of(spark)), spark.createDataFrame([], COLUMN_TAGS), spark.createDataFrame([], COLUMN_CHECKS))
    rows = stages.graded_metrics(spark, catalog_of(spark), seeded(spark), known, state, NOW)
    assert "commits_of_all" not in rows._jdf.queryExecution().executedPlan().toString()
    assert rows.where("metric = 'is_fresh' and value").count() == 1


def test_tables_that_cannot_be_opened(spark):
    spark.range(3).createOrReplaceTempView("opened_view")
    failures: list[stages.Failure] = []
    assert stages.open_readable(spark, ["opened_view", "spark_catalog.default.absent"], failures).keys() == {"opened_view"}
    assert [(f.table, f.stage) for f in failures] == [("spark_catalog.default.absent", "open")]
    assert stages.failure_rows(spark, failures).count() == 1
