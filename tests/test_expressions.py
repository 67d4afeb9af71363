from __future__ import annotations

import json
from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablegrade.functions import expressions as X
from tablegrade.functions.text import sql_name, sql_text


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values()) or (1,)], list(values) or ["x"])
    return row.select(column.alias("found")).collect()[0]["found"]


@pytest.mark.parametrize(
    "text, seconds",
    [
        ("3d", 259_200),
        ("1h", 3_600),
        ("30m", 1_800),
        ("1d6h", 108_000),
        ("1h30m", 5_400),
        ("1d1d", 172_800),
        ("about 2d", 172_800),
        ("6h1d", 108_000),
        ("0d", 0),
        ("12x", None),
        ("not-a-duration", None),
        ("", None),
    ],
)
def test_window_seconds(spark, text, seconds):
    assert one(spark, X.window_seconds("w"), w=text) == seconds


def test_unreadable_window_fails_the_job(spark):
    with pytest.raises(Exception, match="not a window: soon"):
        one(spark, X.checked_window_seconds("w"), w="soon")


def test_age_parts_and_text(spark):
    age = F.lit(2 * 86_400 + 3 * 3_600 + 45 * 60 + 59)
    assert tuple(one(spark, X.age_parts(age))) == (2, 3, 45)
    assert one(spark, X.age_text(age)) == "2d 3h 45m"
    assert one(spark, X.age_text(F.lit(None).cast("bigint"))) is None


def test_ages_agree_with_timedelta(spark):
    now = datetime(2024, 3, 31, 2, 30)
    deltas = [timedelta(seconds=s, microseconds=m) for s in (-90_061, -1, 0, 1, 3_599, 86_399, 200_000) for m in (0, 1)]
    moments = spark.createDataFrame([(i, now - d) for i, d in enumerate(deltas)], "i int, at timestamp_ntz")
    parts = X.age_parts(X.seconds_between(F.col("at"), X.instant(now)))
    found = {r["i"]: tuple(r["p"]) for r in moments.select("i", parts.alias("p")).collect()}
    for i, d in enumerate(deltas):
        assert found[i] == (d.days, d.seconds // 3_600, d.seconds % 3_600 // 60)


def test_ages_do_not_depend_on_the_session_zone(spark):
    age = X.seconds_between(X.instant("2024-03-31 00:00:00"), X.instant("2024-03-31 12:00:00"))
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        assert one(spark, age) == 12 * 3_600
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_names(spark):
    assert one(spark, X.full_name("a", "b", "c"), a="x", b="y", c="z") == "x.y.z"
    assert one(spark, X.base_name("n"), n="a.b.c") == "c"
    assert one(spark, X.base_name("n"), n="c") == "c"


@pytest.mark.parametrize(
    "text, held",
    [
        ("[delta.logRetentionDuration=1]", True),
        ("[delta.deletedFileRetentionDuration=1]", True),
        ("[x=1]", False),
        (None, False),
    ],
)
def test_enforces_retention(spark, text, held):
    assert one(spark, X.enforces_retention(F.lit(text).cast("string"))) is held


@pytest.mark.parametrize("text, filled", [(None, False), ("", False), ("  ", False), (" a ", True)])
def test_is_filled(spark, text, filled):
    assert one(spark, X.is_filled(F.lit(text).cast("string"))) is filled


@pytest.mark.parametrize(
    "text, clean",
    [
        ("  - a(b) = 0\n", "a(b) = 0"),
        ("-a", "a"),
        ("a - b", "a - b"),
        ("- - a", "- a"),
        ("\n a:\n   - b ", "a:\n   - b"),
    ],
)
def test_clean_check(spark, text, clean):
    assert one(spark, X.clean_check(F.col("c")), c=text) == clean


def record(names, values):
    return json.dumps(
        {
            "column_name": "status",
            "is_nullable": "YES",
            "data_type": "string",
            "comment": "order status",
            "tag_names": names,
            "tag_values": values,
        }
    )


@pytest.mark.parametrize(
    "names, values, tag",
    [
        (["has_comment", "has_low_cardinality"], ["", "OPEN, CLOSED"], ("has_low_cardinality", "OPEN, CLOSED")),
        (["has_comment"], ["set"], ("has_comment", "set")),
        ([], [], (None, None)),
    ],
)
def test_summarise_column_json(spark, names, values, tag):
    found = one(spark, X.summarise_column_json(F.col("r")), r=record(names, values))
    assert (found["column_name"], found["comment"]) == ("status", "order status")
    assert (found["tag_name"], found["tag_value"]) == tag


def test_column_json_that_is_not_json(spark):
    assert one(spark, X.summarise_column_json(F.col("r")), r="not json") is None


@settings(max_examples=25, deadline=None)
@given(st.text(max_size=12))
def test_sql_text_round_trips(spark, text):
    assert spark.sql(f"select {sql_text(text)} as t").collect()[0]["t"] == text


@pytest.mark.parametrize("text", ["O'Brien", 'say "x"', "back\\slash\\'", "'); drop table t; --", "${x}", "a\nb\tc\r"])
def test_sql_text_keeps_awkward_values(spark, text):
    assert spark.sql(f"select {sql_text(text)} as t").collect()[0]["t"] == text


def test_sql_name_keeps_awkward_names(spark):
    frame = spark.createDataFrame([(1,)], ["a`b. 'c'"])
    assert frame.selectExpr(f"{sql_name(frame.columns[0])} as x").collect()[0]["x"] == 1
