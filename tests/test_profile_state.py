"""A profile kept between runs gives what a scan of the whole table gives."""

from __future__ import annotations

import random
from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

from tablegrade.operators import profile
from tablegrade.operators.profile_state import counts_of, profile_of, sketch_places, update_file_profile
from tablegrade.sources.state_files import stored_once
from tests.helpers import frame

NAME = "c.s.t"


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path / "a table")


def add(spark, folder, first, last, kinds=3):
    rows = spark.range(first, last, 1, 2).selectExpr(
        "id", f"concat('k', id % {kinds}) as kind", "if(id % 4 = 0, null, id % 2) as bit", "cast(null as string) as void",
        "array(id % 2) as list", "map(id, 1) as pairs", "id % 2 = 0 as `a``b c`",
    )
    rows.write.mode("append").parquet(folder)


def same_as_scan(table, state, threshold=10, tags=None):
    spark = table.sparkSession
    scanned = profile.low_cardinality(spark, {NAME: table}, threshold, tags).collect()
    kept = profile_of(state, tags).collect()
    assert sorted(map(tuple, kept)) == sorted(map(tuple, scanned))
    counted = profile.column_counts({NAME: table}).collect()
    assert sorted(map(tuple, counts_of(state).collect())) == sorted(map(tuple, counted))


def test_only_new_files_are_read(spark, folder, monkeypatch):
    add(spark, folder, 0, 50)
    first = stored_once(update_file_profile(spark, {NAME: spark.read.parquet(folder)}))
    same_as_scan(spark.read.parquet(folder), first)
    old = {r["file"] for r in first.select("file").distinct().collect()} - {None}
    add(spark, folder, 50, 130)
    # What the state says of old files is kept as it is: a false count there shows that they are not read again.
    marked = first.withColumn("row_count", F.when(F.col("file").isNotNull(), F.col("row_count") + 1000).otherwise(F.col("row_count")))
    table = spark.read.parquet(folder)
    second = stored_once(update_file_profile(spark, {NAME: table}, state=marked))
    assert {r["row_count"] for r in counts_of(second).collect()} == {130 + 1000 * len(old)}
    second = stored_once(update_file_profile(spark, {NAME: table}, state=first))
    same_as_scan(table, second)
    files = {r["file"] for r in second.select("file").distinct().collect()} - {None}
    assert old < files and len(files) == len(set(table.inputFiles()))
    # Nothing new: no file is opened.
    monkeypatch.setattr("tablegrade.operators.profile_state._Table.fold", None)
    same_as_scan(table, stored_once(update_file_profile(spark, {NAME: table}, state=second)))


def test_a_column_outgrows_the_threshold_and_comes_back(spark, folder):
    add(spark, folder, 0, 40)
    few = spark.read.parquet(folder)
    first = stored_once(update_file_profile(spark, {NAME: few}, 5))
    add(spark, folder, 40, 400, 100)
    table = spark.read.parquet(folder)
    second = stored_once(update_file_profile(spark, {NAME: table}, 5, first))
    same_as_scan(table, second, 5)
    assert not {r["column_name"]: r for r in profile_of(second).collect()}["kind"]["is_low_cardinality"]
    # The later files are gone: the table is read anew where values were not listed.
    again = spark.read.schema(few.schema).parquet(*map(unquote, few.inputFiles()))
    same_as_scan(again, stored_once(update_file_profile(spark, {NAME: again}, 5, second)), 5)


def test_another_threshold_or_layout_is_read_whole(spark, folder):
    add(spark, folder, 0, 60, 30)
    table = spark.read.parquet(folder)
    state = stored_once(update_file_profile(spark, {NAME: table}, 5))
    same_as_scan(table, stored_once(update_file_profile(spark, {NAME: table}, 40, state)), 40)
    wider = spark.read.schema(f"{table._jdf.schema().toDDL()}, later int").parquet(folder)
    same_as_scan(wider, stored_once(update_file_profile(spark, {NAME: wider}, 5, state)), 5)


def test_tables_without_rows_files_or_state(spark, folder):
    add(spark, folder, 0, 0)
    table = spark.read.parquet(folder)
    same_as_scan(table, update_file_profile(spark, {NAME: table}))
    ranged = spark.range(30).selectExpr("id", "id % 2 as bit", "'' as blank")
    state = stored_once(update_file_profile(spark, {NAME: ranged}))
    same_as_scan(ranged, state)
    same_as_scan(ranged, update_file_profile(spark, {NAME: ranged}, state=state))
    assert update_file_profile(spark, {}).count() == 0


def test_a_tagged_column_stays_low(spark):
    table = spark.range(30).selectExpr("id", "id % 2 as bit")
    tags = frame(spark, "column_name string, tag_name string, tag_value string", ("t", "id", "has_low_cardinality", "1"))
    same_as_scan(table, update_file_profile(spark, {NAME: table}), tags=tags)


@pytest.mark.parametrize("threshold", [0, 1, 10, 47, 48, 500])
def test_sketches_report_no_more_than_there_is(spark, threshold):
    rng = random.Random(threshold)
    rows = [(g, i % 7, f"{rng.random()}-{i}") for g in range(60) for i in range(threshold)]
    sketches = spark.createDataFrame(rows, "g int, part int, v string").groupBy("g", "part").agg(F.expr(f"hll_sketch_agg(v, {sketch_places(threshold)}) as s"))
    united = sketches.groupBy("g").agg(F.expr("hll_sketch_estimate(hll_union_agg(s, true)) as n"))
    assert (united.agg(F.max("n")).collect()[0][0] or 0) <= threshold + 1
    with pytest.raises(ValueError, match="no sketch"):
        sketch_places(1 << 30)
