from __future__ import annotations

from datetime import datetime

import pytest

from tablegrade.operators import drift, history
from tests.helpers import as_set, by_table, frame

NOW = "2024-01-31 00:00:00"
COMMITS = "version bigint, timestamp timestamp_ntz, operation string, job string"


def commits(spark, *rows):
    return frame(spark, COMMITS, *[(t, v, datetime.fromisoformat(at), op, job) for t, v, at, op, job in rows])


def test_freshness(spark):
    found = history.freshness(
        commits(
            spark,
            ("fresh", 1, "2024-01-30T00:00:01", "WRITE", None),
            ("edge", 1, "2024-01-30T00:00:00", "MERGE", None),
            ("maintained", 1, "2024-01-01T00:00:00", "DELETE", None),
            ("maintained", 2, "2024-01-30T23:00:00", "OPTIMIZE", None),
            ("unwritten", 1, "2024-01-30T23:00:00", "VACUUM START", None),
            ("future", 1, "2024-02-01T00:00:00", "UPDATE", None),
            ("unconfigured", 1, "2024-01-30T23:00:00", "WRITE", None),
        ),
        frame(
            spark,
            "freshness_window string",
            *[(t, "1d") for t in ("fresh", "edge", "maintained", "unwritten", "future", "unknown")],
        ),
        NOW,
    )
    assert by_table(found, "is_fresh", "time_since_last_update") == {
        "fresh": (True, "0d 23h 59m"),
        "edge": (False, "1d 0h 0m"),
        "maintained": (False, "30d 0h 0m"),
        "unwritten": (False, None),
        "unknown": (False, None),
        "future": (True, "-1d 0h 0m"),
    }


def test_every_write_operation_counts(spark):
    from tablegrade.schemas import WRITE_OPERATIONS

    rows = [(op, 1, "2024-01-30T12:00:00", op, None) for op in WRITE_OPERATIONS]
    config = frame(spark, "freshness_window string", *[(op, "1d") for op in WRITE_OPERATIONS])
    found = by_table(history.freshness(commits(spark, *rows), config, NOW), "is_fresh")
    assert len(found) == 10 and all(found.values())


def test_unreadable_window_stops_the_run(spark):
    config = frame(spark, "freshness_window string, validity_window string", ("t", "soon", "1d"), ("u", "1d", "1d"))
    assert as_set(history.invalid_windows(config), "table_name") == {"t"}
    with pytest.raises(Exception, match="not a window"):
        history.freshness(commits(spark, ("t", 1, "2024-01-01", "WRITE", None)), config, NOW).collect()


def test_latest_commit_breaks_ties_by_version(spark):
    found = history.latest_commit(
        commits(
            spark,
            ("t", 1, "2024-01-02T00:00:00", "WRITE", "old"),
            ("t", 3, "2024-01-03T00:00:00", "WRITE", None),
            ("t", 2, "2024-01-03T00:00:00", "WRITE", "tied"),
        )
    )
    assert by_table(found, "timestamp", "etl_job") == {"t": (datetime(2024, 1, 3), None)}


def test_version_as_of_day(spark):
    rows = [
        ("middle", 1, "2024-01-10T08:00:00"),
        ("middle", 2, "2024-01-10T09:00:00"),
        ("middle", 3, "2024-01-20T00:00:01"),
        ("exact", 1, "2024-01-10T00:00:00"),
        ("exact", 2, "2024-01-20T00:00:00"),
        ("late", 7, "2024-01-20T05:00:00"),
        ("late", 8, "2024-01-20T06:00:00"),
    ]
    found = history.version_as_of_day(
        commits(spark, *[(*r, "WRITE", None) for r in rows]),
        frame(spark, "target timestamp_ntz", *[(t, datetime(2024, 1, 20)) for t in ("middle", "exact", "late", "none")]),
    )
    assert by_table(found, "version") == {"middle": 2, "exact": 2, "late": 7}


def test_comparison_day_is_a_midnight(spark):
    day = history.comparison_day("2024-01-31 10:30:00", "w")
    windows = spark.createDataFrame([("1d",), ("11h",), ("1h",)], ["w"])
    assert [r[0] for r in windows.select(day).collect()] == [
        datetime(2024, 1, 30),
        datetime(2024, 1, 30),
        datetime(2024, 1, 31),
    ]


COLUMNS = "column_name string, data_type string"


def test_drift(spark):
    current = frame(
        spark, COLUMNS, ("same", "a", "int"), ("typed", "a", "int"), ("typed", "b", "int"),
        ("moved", "a", "int"), ("moved", "new", "int"), ("added", "a", "int"),
    )
    past = frame(
        spark, COLUMNS, ("same", "a", "int"), ("typed", "a", "string"), ("typed", "b", "int"),
        ("moved", "a", "bigint"), ("moved", "old", "int"), ("dropped", "a", "int"),
    )
    assert by_table(drift.schema_drift(current, past), "columns_match", "datatypes_match") == {
        "same": (True, True),
        "typed": (True, False),
        "moved": (False, False),
        "added": (False, True),
        "dropped": (False, True),
    }
    assert as_set(drift.drift_detail(current, past), "table_name", "column_name", "kind") == {
        ("typed", "a", "type_changed"),
        ("moved", "a", "type_changed"),
        ("moved", "new", "missing_in_past"),
        ("moved", "old", "missing_in_current"),
        ("added", "a", "missing_in_past"),
        ("dropped", "a", "missing_in_current"),
    }
    report = {r["table_name"]: r for r in drift.drift_report(current, past).collect()}
    assert report["moved"]["mismatched_datatypes"]["a"].asDict() == {"current": "int", "versioned": "bigint"}
    assert report["moved"]["col_missing_in_current_table"] == ["old"]
    assert report["moved"]["col_missing_in_old_table"] == ["new"]
    assert report["typed"]["col_missing_in_old_table"] is None


def test_past_columns_come_from_the_picked_version(spark):
    versions = frame(
        spark, "version bigint, column_name string, data_type string",
        ("t", 1, "a", "int"), ("t", 2, "a", "int"), ("t", 2, "b", "int"), ("u", 1, "z", "int"),
    )
    found = drift.past_columns(
        commits(spark, ("t", 1, "2024-01-01", "WRITE", None), ("t", 2, "2024-01-30T05:00:00", "WRITE", None)),
        versions,
        frame(spark, "validity_window string", ("t", "1d"), ("u", "1d")),
        NOW,
    )
    assert as_set(found, "table_name", "column_name") == {("t", "a")}


def test_folded_days_give_what_the_commits_give(spark):
    rows = []
    for t in range(6):
        for version in range(40):
            moment = f"2024-01-{1 + version // 2:02d} {['00:00:00', '07:30:00', '23:59:59'][version % 2 + t % 2]}"
            rows.append((f"t{t}", version, moment, ["WRITE", "OPTIMIZE", "MERGE"][(version * t) % 3], "job" if (version + t) % 4 else None))
    raw = commits(spark, *rows)
    days = history.history_days(raw)
    assert "SortAggregate" not in days._jdf.queryExecution().executedPlan().toString()
    assert days.count() < raw.count() and history.history_days(days) is days
    config = frame(spark, "freshness_window string", *[(f"t{t}", "15d") for t in range(7)])
    targets = frame(spark, "target timestamp_ntz", *[(f"t{t}", datetime(2024, 1, 3 + 2 * t)) for t in range(6)])
    for result in (
        lambda h: history.freshness(h, config, NOW), lambda h: history.made_by_jobs(h), lambda h: history.version_as_of_day(h, targets),
    ):
        assert sorted(map(str, result(raw).collect())) == sorted(map(str, result(days).collect()))
