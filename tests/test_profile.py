from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegrade.operators import profile
from tests.helpers import as_set, frame
from workload.frames import monitored

TAGS = "column_name string, tag_name string, tag_value string"


def found(spark, table, threshold=10, **options):
    rows = profile.low_cardinality(spark, {"c.s.t": table}, threshold, **options).collect()
    return {r["column_name"]: (r["is_low_cardinality"], r["values"]) for r in rows}


def test_agrees_with_exact_counts_on_all_test_tables(spark, tiny):
    tables = monitored(spark, tiny)
    for threshold in (1, 4, 10, 60):
        result = profile.low_cardinality(spark, tables, threshold).collect()
        low = {(r["table_name"], r["column_name"]): r["values"] for r in result if r["is_low_cardinality"]}
        exact = {}
        for name, table in tables.items():
            for field in profile.countable_columns(table):
                text = table.selectExpr(f"{profile.as_text(field)} as v").where("v is not null")
                values = sorted(r["v"] for r in text.distinct().collect())
                if len(values) <= threshold:
                    exact[name.split(".")[-1], field.name] = values
        assert low == exact


@pytest.mark.parametrize("threshold", [1, 3, 10, 100, 128, 129, 300])
def test_the_sketch_never_exceeds_its_limit(spark, threshold):
    accuracy, limit = profile.sketch_limit(threshold)
    assert limit <= 1.2 * threshold + 5
    random.seed(threshold)
    rows = [(g, f"{random.random()}-{g}-{i}") for g in range(200) for i in range(threshold)]
    estimates = (
        spark.createDataFrame(rows, "g int, v string")
        .groupBy("g")
        .agg(F.expr(f"approx_count_distinct(v, {accuracy}D)").alias("n"))
    )
    assert estimates.agg(F.max("n")).collect()[0][0] <= limit


def test_a_threshold_beyond_the_sketch_is_counted_exactly(spark):
    with pytest.raises(ValueError, match="beyond"):
        profile.sketch_limit(20_000)
    table = spark.range(45_000).selectExpr("id % 20000 as low", "id % 20001 as high", "cast(null as int) as void", "id % 2 as few")
    result = found(spark, table, 20_000)
    assert result["high"] == (False, None) and result["void"] == (True, []) and result["few"] == (True, ["0", "1"])
    assert result["low"][0] and sorted(map(int, result["low"][1])) == list(range(20_000))


def test_the_threshold_is_inclusive(spark):
    table = spark.range(1_000).selectExpr("id % 10 as ten", "id % 11 as eleven", "id", "if(id < 990, 0, id) as late")
    result = found(spark, table)
    assert result["ten"] == (True, [str(i) for i in range(10)])
    assert result["eleven"] == result["id"] == result["late"] == (False, None)


def test_a_column_whose_first_rows_look_low(spark):
    table = spark.range(0, 20_000, 1, 4).selectExpr("id div 500 as clustered", "id div 5000 as few")
    assert found(spark, table) == {"clustered": (False, None), "few": (True, ["0", "1", "2", "3"])}


def test_nulls_and_empty_tables(spark):
    table = spark.createDataFrame([(None, "a"), (None, None)], "n string, v string")
    assert found(spark, table) == {"n": (True, []), "v": (True, ["a"])}
    assert found(spark, table.where("false")) == {"n": (True, []), "v": (True, [])}


def test_nested_columns_are_counted_and_maps_never_low(spark):
    schema = T.StructType(
        [
            T.StructField("list", T.ArrayType(T.IntegerType())),
            T.StructField("pair", T.StructType([T.StructField("x", T.IntegerType())])),
            T.StructField("map", T.MapType(T.StringType(), T.StringType())),
            T.StructField("deep", T.ArrayType(T.MapType(T.StringType(), T.StringType()))),
        ]
    )
    table = spark.createDataFrame([([1], (2,), {}, []), ([1], None, {}, [])], schema)
    expected = {"list": (True, ["[1]"]), "pair": (True, ['{"x":2}']), "map": (False, None), "deep": (False, None)}
    assert found(spark, table) == expected


def test_awkward_column_names(spark):
    table = spark.createDataFrame([(1, "x")], ["a`b c", "it's.dotted"])
    assert found(spark, table) == {"a`b c": (True, ["1"]), "it's.dotted": (True, ["x"])}


def test_a_tagged_column_stays_low(spark):
    table = spark.range(500).selectExpr("id as grown", "id % 2 as small", "id as untagged")
    tags = frame(spark, TAGS, ("t", "grown", "has_low_cardinality", "1, 2"), ("t", "small", "has_low_cardinality", "0"))
    result = found(spark, table, tags=tags)
    assert result == {"grown": (True, None), "small": (True, ["0", "1"]), "untagged": (False, None)}
    assert found(spark, table, tags=tags, recheck_tagged=True)["grown"] == (False, None)
    assert profile.column_values(table, "grown").count() == 500
    rows = profile.low_cardinality_values(spark, {"c.s.t": table}, tags=tags).collect()
    assert sorted((r["column_name"], r["value"]) for r in rows) == sorted([("grown", str(i)) for i in range(500)] + [("small", "0"), ("small", "1")])


def test_thresholds_by_table(spark):
    tables = {"c.s.a": spark.range(20), "c.s.b": spark.range(20)}
    rows = profile.low_cardinality(spark, tables, {"c.s.a": 20, "c.s.b": 19})
    assert as_set(rows, "table_name", "is_low_cardinality") == {("a", True), ("b", False)}


def test_tables_without_columns_to_look_at(spark):
    assert profile.low_cardinality(spark, {}).count() == 0
    assert found(spark, spark.range(1).selectExpr("map(1, 2) as m")) == {"m": (False, None)}


def profiled(spark, *rows):
    return frame(spark, "column_name string, data_type string, is_low_cardinality boolean, values array<string>", *rows)


def test_tag_changes(spark):
    result = profiled(
        spark,
        ("t", "new", "string", True, ["b", "a"]),
        ("t", "same", "string", True, ["a", "b"]),
        ("t", "changed", "string", True, ["a", "c"]),
        ("t", "grown", "string", True, None),
        ("t", "high", "string", False, None),
    )
    low = "has_low_cardinality"
    tags = frame(
        spark, TAGS,
        ("t", "same", low, "a, b"), ("t", "same", "has_check", None), ("t", "changed", low, "a, b"),
        ("t", "changed", "has_check", None), ("t", "changed", "has_comment", None), ("t", "grown", low, "x"),
        ("t", "grown", "has_check", None), ("t", "high", low, "x"), ("t", "high", "has_check", None),
        ("t", "new", "has_check", None), ("t", "new", "mine", "kept"),
    )
    after = as_set(profile.update_low_cardinality_tags(result, tags), "column_name", "tag_name", "tag_value")
    assert after == {
        ("new", low, "a, b"), ("new", "mine", "kept"), ("same", low, "a, b"), ("same", "has_check", None),
        ("changed", low, "a, c"), ("grown", low, "x"), ("grown", "has_check", None), ("high", "has_check", None),
    }
    every = as_set(
        profile.update_low_cardinality_tags(result, tags, every_run=True), "column_name", "tag_name"
    )
    assert ("same", "has_check") not in every and ("same", low) in every


def test_column_counts(spark):
    table = spark.createDataFrame([(1, None), (2, None), (None, "x")], "a int, b string")
    rows = profile.column_counts({"c.s.t": table})
    assert as_set(rows, "column_name", "row_count", "null_count") == {("a", 3, 1), ("b", 3, 2)}
    only = profile.column_counts({"c.s.t": table}, {"c.s.t": ["b"]})
    assert as_set(only, "column_name") == {"b"}
