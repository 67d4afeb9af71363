from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tablegrade.operators import score, state
from tablegrade.schemas import COLUMN_CHECKS, COLUMN_TAGS, COLUMNS, DIMENSIONS, DQ_CONFIG, DQ_SUMMARY, METRICS
from tests.helpers import as_set, by_table, frame

CONFIG = "low_cardinality_threshold int, freshness_window string, validity_window string, tag string"


def empty(spark, schema):
    return spark.createDataFrame([], schema)


def test_config_is_inserted_with_defaults_and_then_updated(spark):
    first = state.upsert_config(empty(spark, DQ_CONFIG), frame(spark, "", ("t",), ("u",)))
    values = ("low_cardinality_threshold", "freshness_window", "validity_window", "tag")
    assert by_table(first, *values) == {"t": (10, "1d", "1d", None), "u": (10, "1d", "1d", None)}
    change = frame(spark, CONFIG, ("t", 25, "7d", None, "x"), ("v", None, None, "2d", None))
    second = state.upsert_config(first, change)
    assert by_table(second, *values) == {
        "t": (25, "7d", "1d", "x"), "u": (10, "1d", "1d", None), "v": (10, "1d", "2d", None),
    }
    ids, before = by_table(second, "_id"), by_table(first, "_id")
    assert {t: ids[t] for t in before} == before
    assert ids["v"] > max(before.values()) and min(before.values()) > 0
    assert second.schema.names == DQ_CONFIG.names


def test_latest_config(spark):
    rows = frame(spark, f"_id bigint, {CONFIG}", ("t", 1, 5, "1d", "1d", None), ("t", 3, 7, "3d", "1d", None), ("t", 2, 6, "1d", "1d", None))
    assert by_table(state.latest_config(rows), "low_cardinality_threshold") == {"t": 7}


def test_seeding_keeps_customised_rows(spark):
    stored = state.upsert_config(empty(spark, DQ_CONFIG), frame(spark, "low_cardinality_threshold int", ("t", 99)))
    seeded = state.seed_config(stored, frame(spark, "", ("t",), ("new",), ("new",)))
    assert by_table(seeded, "low_cardinality_threshold") == {"t": 99, "new": 10}
    assert seeded.count() == 2


CHECKS = "column_name string, check string, tag string"


def test_check_upsert(spark):
    first = state.upsert_checks(
        empty(spark, COLUMN_CHECKS),
        frame(spark, CHECKS, ("t", "email", "missing_count(email) = 0", "ai_generated"), ("t", "email", "by hand", None)),
    )
    assert first.count() == 2
    second = state.upsert_checks(
        first,
        frame(spark, CHECKS, ("t", "email", "invalid_count(email) = 0", "ai_generated"), ("t", "email", "again by hand", None)),
    )
    assert as_set(second, "column_name", "check", "tag") == {
        ("email", "invalid_count(email) = 0", "ai_generated"), ("email", "by hand", None), ("email", "again by hand", None),
    }
    assert len(as_set(second, "check_id")) == 3


def test_check_upsert_sets_every_match(spark):
    stored = frame(spark, f"check_id bigint, {CHECKS}", ("t", 1, "a", "x", "g"), ("t", 2, "a", "y", "g")).select(*COLUMN_CHECKS.names)
    after = state.upsert_checks(stored, frame(spark, CHECKS, ("t", "a", "z", "g")))
    assert as_set(after, "check_id", "check") == {(1, "z"), (2, "z")}


def test_update_by_id_adds_nothing(spark):
    stored = frame(spark, f"check_id bigint, {CHECKS}", ("t", 1, "a", "x", None), ("t", 2, "b", "y", "g")).select(*COLUMN_CHECKS.names)
    changes = frame(spark, f"check_id bigint, {CHECKS}", ("t", 1, "a", "new", "r"), ("t", 2, "other", "new", "r"), ("t", 9, "a", "new", "r"))
    after = state.update_checks_by_id(stored, changes.withColumn("catalog_name", F.lit("elsewhere")))
    assert as_set(after, "check_id", "check", "tag", "catalog_name") == {(1, "new", "r", "c"), (2, "y", "g", "c")}


def test_added_checks_get_their_own_ids_even_if_equal(spark):
    stored = frame(spark, f"check_id bigint, {CHECKS}", ("t", 41, "a", "x", "g")).select(*COLUMN_CHECKS.names)
    rows = frame(spark, "column_name string, check string", *[("t", "status", "missing_count(status) = 0")] * 3, ("t", "b", "y"))
    after = state.add_checks(stored, rows)
    assert len(as_set(after, "check_id")) == 5
    assert as_set(after.where("tag is null"), "check_id").isdisjoint({41})
    assert after.where("column_name = 'status'").count() == 3
    assert after.agg(F.min("check_id")).collect()[0][0] == 41
    assert state.drop_checks(after, after.where("column_name = 'status'")).count() == 2
    assert state.drop_checks(after, after.where("false")).count() == 5


def test_numbers_do_not_depend_on_the_layout(spark):
    rows = spark.range(5_000).selectExpr("cast(id as string) as k", "if(id % 7 = 0, null, id % 3) as v")
    one = {r["k"]: r["n"] for r in state.numbered(rows.coalesce(1), "n", ["k"]).collect()}
    many = {r["k"]: r["n"] for r in state.numbered(rows.repartition(13), "n", ["k"]).collect()}
    assert one == many and len(set(one.values())) == 5_000
    assert max(one.values()) < 10 * 5_000
    copies = rows.select("v").unionAll(rows.select("v"))
    numbers = as_set(state.numbered_copies(copies, "n"), "n", "v")
    assert len(numbers) == 10_000 and len({n for n, _ in numbers}) == 10_000


def test_tags(spark):
    changes = frame(spark, "column_name string, tag_name string, tag_value string", ("t", "col", "low", "O'Brien, Smith"), ("t", "col", "has_check", None))
    tags = state.set_tags(empty(spark, COLUMN_TAGS), changes)
    tags = state.set_tags(tags, frame(spark, "column_name string, tag_name string", ("t", "col", "low"), ("u", "col", "low")))
    assert as_set(tags, "table_name", "tag_name", "tag_value") == {("t", "low", None), ("t", "has_check", None), ("u", "low", None)}
    tags = state.unset_tags(tags, frame(spark, "column_name string, tag_name string", ("t", "col", "low"), ("t", "x", "low")))
    assert as_set(tags, "table_name", "tag_name") == {("t", "has_check"), ("u", "low")}


@pytest.mark.parametrize("text", ['a "quoted" text', "O'Brien", "back\\slash \\'", "x'); DROP TABLE t; --"])
def test_comments_are_stored_as_they_are(spark, text):
    columns = frame(spark, "column_name string, comment string", ("t", "a", None), ("t", "b", "kept"))
    changes = frame(spark, "column_name string, comment string", ("t", "a", text), ("t", "unknown", text))
    described, tags = state.set_comments(columns, empty(spark, COLUMN_TAGS), changes)
    assert as_set(described, "column_name", "comment") == {("a", text), ("b", "kept")}
    assert ("a", "has_comment") in as_set(tags, "column_name", "tag_name")


def test_upsert_keeps_columns_it_does_not_set(spark):
    target = spark.createDataFrame([(1, "a", "x")], "k int, v string, extra string")
    changes = spark.createDataFrame([(1, "b", "y"), (2, "c", "z"), (None, "d", "n")], "k int, v string, extra string")
    after = state.upsert(target, changes, ["k"], ["v"])
    assert as_set(after, "k", "v", "extra") == {(1, "b", "x"), (2, "c", "z"), (None, "d", "n")}


def test_a_null_key_never_matches(spark):
    rows = spark.createDataFrame([(None, "a")], "k int, v string")
    assert as_set(state.upsert(rows, rows.withColumn("v", F.lit("b")), ["k"], ["v"]), "v") == {"a", "b"}


# --- summary and score ----------------------------------------------------------------------------

ROWS = "metric string, value boolean"


def test_partial_upsert_keeps_what_is_not_given(spark):
    first = score.upsert_summary(
        empty(spark, DQ_SUMMARY), frame(spark, ROWS, ("t", "is_fresh", True), ("t", "columns_valid", False))
    )
    row = first.collect()[0].asDict()
    assert row["is_fresh"] is True and all(row[m] is False for m in METRICS if m != "is_fresh")
    second = score.upsert_summary(
        first, frame(spark, ROWS, ("t", "has_a_valid_owner", True), ("u", "is_fresh", True), ("t", "columns_valid", None))
    )
    assert by_table(second, "is_fresh", "has_a_valid_owner", "columns_valid") == {
        "t": (True, True, False), "u": (True, False, False),
    }
    third = score.upsert_summary(second, frame(spark, ROWS, ("t", "is_fresh", None)))
    assert by_table(third, "is_fresh", "has_a_valid_owner") == {"t": (False, True), "u": (True, False)}
    assert by_table(third, "table_id") == by_table(second, "table_id")
    assert third.schema.names == DQ_SUMMARY.names


@pytest.mark.parametrize("name", ["is fresh", "is_fresh ", "unknown", None])
def test_unknown_metrics_fail(spark, name):
    rows = frame(spark, ROWS, ("t", name, True))
    with pytest.raises(Exception, match="unknown metric"):
        score.upsert_summary(empty(spark, DQ_SUMMARY), rows).collect()


def test_points_add_up():
    assert {name: sum(points.values()) for name, points in DIMENSIONS.items()} == {
        "stewardship": 25, "usability": 15, "freshness": 10, "validity": 20, "accuracy": 30,
    }
    assert sorted(score.POINTS) == sorted(METRICS)


def test_scores_and_bands(spark):
    def table(name, *metrics):
        return [(name, m, m in metrics) for m in METRICS]

    rows = [
        *table("all", *METRICS),
        *table("none"),
        *table("sixty_five", *[m for m in METRICS if m not in ("has_check_passed", "is_fresh", "is_delta_table")]),
        *table("forty_five", "has_check_passed", "is_fresh", "columns_valid", "is_delta_table"),
        *table("forty_four", "has_check_passed", "columns_description", "table_description", *["is_delta_table"]),
    ]
    scored = score.score_tables(score.pivot_metrics(frame(spark, ROWS, *rows)))
    assert by_table(scored, "score", "band") == {
        "all": (100, "Good"), "none": (0, "Poor"), "sixty_five": (65, "Good"), "forty_five": (45, "Okay"), "forty_four": (40, "Poor"),
    }
    bands = spark.createDataFrame([(s,) for s in (100, 65, 64, 45, 44, 0)], ["s"])
    assert [r[0] for r in bands.select(score.score_band(F.col("s"))).collect()] == ["Good", "Good", "Okay", "Okay", "Poor", "Poor"]


def test_metric_rows(spark):
    signals = frame(spark, "a boolean, b boolean", ("t", True, None))
    rows = score.metric_rows(signals, {"a": "is_fresh", "b": "columns_valid"})
    assert as_set(rows, "table_name", "metric", "value") == {("t", "is_fresh", True), ("t", "columns_valid", None)}


def test_repeated_changes_count_once(spark):
    stored = state.upsert_checks(empty(spark, COLUMN_CHECKS), frame(spark, CHECKS, ("t", "a", "x", "g")))
    repeated = frame(spark, CHECKS, ("t", "a", "y", "g"), ("t", "a", "y", "g"), ("t", "b", "n", "g"), ("t", "b", "n", "g"))
    untagged = frame(spark, CHECKS, *[("t", "a", "u", None)] * 3)
    after = state.upsert_checks(stored, repeated.union(untagged)).collect()
    assert sorted((r["column_name"], r["check"]) for r in after) == [("a", "u")] * 3 + [("a", "y"), ("b", "n")]
    assert len({r["check_id"] for r in after}) == 5
    with pytest.raises(Exception, match="changes differ"):
        state.upsert_checks(stored, frame(spark, CHECKS, ("t", "a", "y", "g"), ("t", "a", "z", "g"))).collect()


def test_several_changes_of_one_key(spark):
    """The last numbered change counts; differing ones without a number, or with the same, fail the job."""
    keys = {k: F.lit("x") for k in ("catalog_name", "schema_name", "table_name")}
    rows = [(1, "a"), (3, "c"), (3, "c"), (2, "b"), (None, "z")]
    numbered = spark.createDataFrame(rows, "change_number int, tag string").withColumns(keys)
    config = state.upsert_config(empty(spark, DQ_CONFIG), numbered)
    assert [r["tag"] for r in config.collect()] == ["c"]
    again = state.upsert_config(config, numbered.withColumn("tag", F.lit("d"))).collect()
    assert [(r["tag"], r["_id"]) for r in again] == [("d", config.first()["_id"])]
    for differing in (numbered.drop("change_number"), numbered.withColumn("change_number", F.lit(1))):
        with pytest.raises(Exception, match="changes differ"):
            state.upsert_config(empty(spark, DQ_CONFIG), differing).collect()
    stored = spark.createDataFrame([(1, "x", "x", "x", "v", "old", None)], COLUMN_CHECKS)
    changes = numbered.select("*", F.lit(1).alias("check_id"), F.lit("v").alias("column_name"), F.col("tag").alias("check"))
    assert [(r["check_id"], r["check"]) for r in state.update_checks_by_id(stored, changes).collect()] == [(1, "c")]
    columns = spark.createDataFrame([("x", "x", "x", "v", "YES", "int", None)], COLUMNS)
    described, tags = state.set_comments(columns, empty(spark, COLUMN_TAGS), changes.withColumnRenamed("check", "comment"))
    assert [r["comment"] for r in described.collect()] == ["c"] and tags.count() == 1
