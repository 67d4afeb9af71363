"""A third of all rows on one column of one table: results against plain Python, with splitting forced."""

from __future__ import annotations

import pytest

from tablegrade.operators import history, reconcile, signals, state
from tablegrade.schemas import COLUMN_CHECKS
from tests.helpers import as_set, by_table

N = 30_000
NAMES = "'c' as catalog_name, 's' as schema_name"


@pytest.fixture
def eager_splitting(spark):
    """Shuffle joins only, and partitions split as soon as they stand out."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def rows_of(spark):
    """Checks: every third one on column ``hot`` of table ``hot``; the rest spread over 500 columns."""
    spread = "cast(id % 500 as string)"
    return spark.range(0, N, 1, 4).selectExpr(
        "id as check_id", NAMES.split(", ")[0], NAMES.split(", ")[1],
        f"if(id % 3 = 0, 'hot', concat('t', {spread})) as table_name",
        f"if(id % 3 = 0, 'hot', concat('k', {spread})) as column_name",
        "case id % 4 when 0 then null when 1 then ' ' else concat('check ', id) end as check",
        "if(id % 5 = 0, 'g', null) as tag",
    )


def python_rows():
    for i in range(N):
        place = ("hot", "hot") if i % 3 == 0 else (f"t{i % 500}", f"k{i % 500}")
        yield i, *place, f"check {i}" if i % 4 > 1 else None, "g" if i % 5 == 0 else None


def live_columns(spark):
    return spark.range(500).where("id % 7 <> 0").selectExpr(
        *NAMES.split(", "), "concat('t', id) as table_name", "concat('k', id) as column_name"
    ).unionByName(spark.range(1).selectExpr(*NAMES.split(", "), "'hot' as table_name", "'hot' as column_name"))


def is_live(table):
    return table == "hot" or int(table[1:]) % 7 != 0


def test_sync_and_stale(spark, eager_splitting):
    checks, columns = rows_of(spark), live_columns(spark)
    kept = {i for i, t, _, text, _ in python_rows() if text and is_live(t)}
    assert as_set(reconcile.sync_checks(checks, columns), "check_id") == kept
    assert as_set(reconcile.stale_checks(checks, columns), "check_id") == set(range(N)) - kept
    scope = spark.range(1).selectExpr(*NAMES.split(", "), "'hot' as table_name")
    scoped = {i for i, t, _, text, _ in python_rows() if t != "hot" or text}
    assert as_set(reconcile.sync_checks(checks, columns, scope), "check_id") == scoped


def test_upsert_of_a_hot_column(spark, eager_splitting):
    checks = rows_of(spark).select(*COLUMN_CHECKS.names)
    changes = live_columns(spark).selectExpr("*", "'new' as check", "'g' as tag")
    after = {r["check_id"]: r["check"] for r in state.upsert_checks(checks, changes).collect()}
    stored = {i: ("new" if g and is_live(t) else text) for i, t, _, text, g in python_rows()}
    assert {i: (v or "").strip() or None for i, v in after.items() if i < N} == stored
    with_g = {t for _, t, _, _, g in python_rows() if g}
    live = {"hot", *(f"t{i}" for i in range(500) if i % 7)}
    assert len(after) == N + len(live - with_g)


def test_coverage_and_tags(spark, eager_splitting):
    checks, columns = rows_of(spark), live_columns(spark)
    filled = {t for _, t, _, text, _ in python_rows() if text}
    found = by_table(signals.check_coverage(columns, checks), "table_implement_checks", "all_columns_have_checks")
    assert found == {t: (t in filled, t in filled) for t in found} and len(found) == columns.count()
    tags = columns.selectExpr("*", "'has_check' as tag_name", "'old' as tag_value")
    _, after = reconcile.reconcile_check_tags(tags, checks, columns)
    assert as_set(after, "table_name", "tag_value") == {(t, None) for t in filled if is_live(t)}


def test_history_of_a_busy_table(spark, eager_splitting):
    commits = spark.range(N).selectExpr(
        *NAMES.split(", "), "if(id % 3 = 0, 'hot', concat('t', id % 100)) as table_name", "id as version",
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(id div 10 as int)) as timestamp",
        "if(id % 2 = 0, 'WRITE', 'OPTIMIZE') as operation", "cast(id as string) as job",
    )
    last = {("hot" if i % 3 == 0 else f"t{i % 100}"): i for i in range(N)}
    assert by_table(history.latest_commit(commits), "etl_job") == {t: str(i) for t, i in last.items()}
    targets = commits.selectExpr("catalog_name", "schema_name", "table_name", "timestamp_ntz'2024-01-02 00:00:00' as target").distinct()
    minutes = 24 * 60
    then = {("hot" if i % 3 == 0 else f"t{i % 100}"): i for i in range(N) if i // 10 <= minutes}
    assert by_table(history.version_as_of_day(commits, targets), "version") == then
