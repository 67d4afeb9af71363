from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tablegrade.operators import checks, profile, suggest
from tests.helpers import as_set, by_table, frame

COLUMNS = "column_name string, check_id bigint, check string"


def texts(spark, *rows):
    return frame(spark, COLUMNS, *[("t", "c", i, text) for i, text in enumerate(rows, 1)])


def parsed(spark, text):
    rows = checks.parse_checks(texts(spark, text)).collect()
    return [
        (r["metric"], r["argument"], r["comparator"], r["threshold"], r["valid_values"], r["invalid_regex"], r["readable"])
        for r in sorted(rows, key=lambda r: r["item"])
    ]


@pytest.mark.parametrize(
    "text, found",
    [
        ("missing_count(email) = 0", ("missing_count", "email", "=", 0, None, None, True)),
        ("  - missing_count( email )<=12 ", ("missing_count", "email", "<=", 12, None, None, True)),
        ("invalid_count(x) != 3:\n  valid values: [0, 1]", ("invalid_count", "x", "!=", 3, ["0", "1"], None, True)),
        ("invalid_count(x) = 0:\n      invalid regex: (?:XX)", ("invalid_count", "x", "=", 0, None, "(?:XX)", True)),
        ("invalid_count(x) = 0:\n valid values: []\n", ("invalid_count", "x", "=", 0, [], None, True)),
        ("invalid_count(x) > -1:\n valid values: ['a, b', \"c\"]", ("invalid_count", "x", ">", -1, ["a, b", "c"], None, True)),
        ("invalid_count(x) = 0", ("invalid_count", "x", "=", 0, None, None, False)),
        ("invalid_count(x) = 0:\n valid min: 3", ("invalid_count", "x", "=", 0, None, None, False)),
        ("missing_count(x) = 0:\n missing values: [a]", ("missing_count", "x", "=", 0, None, None, False)),
        ("avg(x) > 0", (None, None, None, None, None, None, False)),
        ("missing_count(x) = 0.5", (None, None, None, None, None, None, False)),
    ],
)
def test_parse(spark, text, found):
    assert parsed(spark, text) == [found]


def test_both_settings_are_not_readable(spark):
    text = "invalid_count(x) = 0:\n valid values: [a]\n invalid regex: b"
    assert [p[-1] for p in parsed(spark, text)] == [False]


def test_several_checks_in_one_text(spark):
    text = "  - missing_count(x) = 0\n  - invalid_count(x) = 0:\n      valid values: [- a, b]\n  - odd"
    assert [(p[0], p[4], p[6]) for p in parsed(spark, text)] == [
        ("missing_count", None, True), ("invalid_count", ["- a", "b"], True), (None, None, False),
    ]


@pytest.mark.parametrize("text", [None, "", "  \n "])
def test_blank_texts_hold_no_check(spark, text):
    assert parsed(spark, text) == []


AWKWARD = ["plain", "O'Brien", 'say "x"', "a, b", "[x]", "back\\slash", "ends\\", "line\nbreak", "\\n", "\\\\n", "$1", "${x}", " padded ", "", "- dash", "é"]


def test_suggested_values_survive_the_text(spark):
    table = spark.createDataFrame([(v,) for v in AWKWARD], ["v"])
    tables = {"c.s.t": table}
    drafts = suggest.suggest_checks(
        profile.low_cardinality(spark, tables, 20), profile.column_counts(tables)
    ).selectExpr("1L as check_id", "*")
    values = [r["valid_values"] for r in checks.parse_checks(drafts).collect() if r["metric"] == "invalid_count"]
    assert [sorted(v) for v in values] == [sorted(AWKWARD)]
    results = checks.evaluate_checks(spark, drafts, tables)
    assert as_set(results, "metric", "value", "outcome") == {("missing_count", 0, "pass"), ("invalid_count", 0, "pass")}


def outcomes(spark, table, *rows, name="t"):
    results = checks.evaluate_checks(spark, texts(spark, *rows), {f"c.s.{name}": table})
    return {r["check_id"]: (r["value"], r["outcome"]) for r in results.collect()}


@pytest.mark.parametrize("at_once", [200, 14, 0])
def test_outcomes(spark, monkeypatch, at_once):
    """The same outcomes whether things are counted by one aggregate or joined to counted values."""
    monkeypatch.setattr(checks, "COUNTS_AT_ONCE", at_once)
    monkeypatch.setattr(checks, "_bad_patterns", lambda spark, patterns: {p for p in patterns if p == "("})
    table = spark.createDataFrame([(1, "a", 1.5), (2, "b", 2.0), (None, "b", None), (4, None, -0.0)], "i int, s string, d double")
    assert outcomes(
        spark,
        table,
        "missing_count(i) = 0",
        "missing_count(i) = 1",
        "missing_count(i) != 1",
        "missing_count(i) < 2",
        "missing_count(i) >= 2",
        "missing_count(I) <= 1",
        "invalid_count(s) = 0:\n valid values: [a, b]",
        "invalid_count(s) > 1:\n valid values: [a]",
        "invalid_count(i) = 0:\n valid values: [1, 02, 4, x]",
        "invalid_count(d) = 0:\n valid values: [1.50, 2, 0]",
        "invalid_count(s) = 0:\n invalid regex: ^b",
        "invalid_count(s) = 0:\n valid values: []",
        "invalid_count(s) = 0:\n invalid regex: (",
        "missing_count(absent) = 0",
        "row_count > 0",
    ) == {
        1: (1, "fail"),
        2: (1, "pass"),
        3: (1, "fail"),
        4: (1, "pass"),
        5: (1, "fail"),
        6: (1, "pass"),
        7: (0, "pass"),
        8: (2, "pass"),
        9: (0, "pass"),
        10: (0, "pass"),
        11: (2, "fail"),
        12: (3, "fail"),
        13: (None, "not_evaluated"),
        14: (None, "not_evaluated"),
        15: (None, "not_evaluated"),
    }


KINDS = """select * from values
  (true, 1.50bd, date'2024-01-02', timestamp_ntz'2024-01-02 03:04:05', array(1, 2), map('k', 1), float(0.1), 'x'),
  (false, 2.00bd, date'2024-02-03', timestamp_ntz'2024-01-02 03:04:05.6', array(3), map('k', 2), float(-0.0), ' x '),
  (null, null, null, null, null, null, null, null), (true, 1.50bd, null, null, array(), map(), float('nan'), '')
  as t(b, m, d, t, a, k, f, s)"""


def test_joined_values_compare_as_in_an_aggregate(spark, monkeypatch):
    listed = {
        "b": "[TRUE, 0]", "m": "[1.5, 2.0]", "d": "[2024-01-02, x]", "t": "['2024-01-02 03:04:05.600']", "a": "['[1,2]', '[]']",
        "k": "['k']", "f": "[0, NaN, 0.1]", "s": "['', ' x ']",
    }
    rows = [f"invalid_count({c}) = 0:\n valid values: {v}" for c, v in listed.items()]
    rows += [f"invalid_count({c.upper()}) = 0:\n invalid regex: [1x]" for c in listed] + [f"missing_count({c}) = 0" for c in listed]
    wanted = outcomes(spark, spark.sql(KINDS), *rows)
    assert len({v for v, _ in wanted.values()}) > 2
    monkeypatch.setattr(checks, "COUNTS_AT_ONCE", 1)
    monkeypatch.setattr(checks, "_bad_patterns", lambda spark, patterns: set())
    assert outcomes(spark, spark.sql(KINDS), *rows) == wanted
    assert outcomes(spark, spark.sql(KINDS).limit(0), *rows) == dict.fromkeys(range(1, 25), (0, "pass"))


def test_very_many_checks_of_one_column(spark):
    """No aggregate grows with the checks, and one scan serves them all."""
    data = spark.range(5_000).selectExpr("id % 1000 as v")
    stored = spark.range(3_000).selectExpr(
        "id as check_id", "'c' as catalog_name", "'s' as schema_name", "'t' as table_name", "'v' as column_name",
        "concat('invalid_count(v) = 4995:\n valid values: [', id % 1500, ']') as check",
    )
    found = checks.evaluate_checks(spark, stored, {"c.s.t": data})
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert max(len(line) for line in plan.splitlines()) < 5_000 and plan.count("count_if") == 0
    values = {r["check_id"]: (r["value"], r["outcome"]) for r in found.collect()}
    assert values == {i: (4_995, "pass") if i % 1500 < 1000 else (5_000, "fail") for i in range(3_000)}


def test_a_check_of_very_many_values(spark):
    values = ", ".join(map(str, range(2_000)))
    assert outcomes(spark, spark.range(2_500), f"invalid_count(id) = 0:\n valid values: [{values}]", "missing_count(id) = 0") == {
        1: (500, "fail"), 2: (0, "pass"),
    }


def test_bad_patterns_are_found_among_many(spark, monkeypatch):
    monkeypatch.setattr(checks, "COUNTS_AT_ONCE", 3)
    assert checks._bad_patterns(spark, ["a", "b", "(", "c", "d", "e", "["]) == {"(", "["}
    assert checks._bad_patterns(spark, []) == set()


def test_checks_of_tables_that_are_not_open_are_left_out(spark):
    assert outcomes(spark, spark.range(1), "missing_count(id) = 0", name="other") == {}
    assert outcomes(spark, spark.range(1)) == {}


def test_one_count_serves_many_checks(spark):
    rows = ["missing_count(id) = 0", "missing_count(id) = 1"] * 50
    assert len(outcomes(spark, spark.range(3), *rows)) == 100


def test_a_table_is_scanned_once_for_its_checked_columns(spark, tiny):
    table = spark.read.parquet(f"{tiny}/lineitem.parquet")
    rows = ["missing_count(l_tax) = 0", "invalid_count(l_linestatus) = 0:\n valid values: [O]"]
    plan = checks.evaluate_checks(spark, texts(spark, *rows), {"c.s.t": table})
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan parquet") == 1
    assert "ReadSchema: struct<l_tax:double,l_linestatus:string>" in text


def test_rollup(spark):
    results = frame(
        spark, "outcome string", ("good", "pass"), ("bad", "pass"), ("bad", "fail"), ("odd", "pass"), ("odd", "not_evaluated")
    )
    assert by_table(checks.check_rollup(results), "all_checks_passed", "n_checks", "n_failed", "n_not_evaluated") == {
        "good": (True, 1, 0, 0), "bad": (False, 2, 1, 0), "odd": (False, 2, 0, 1),
    }


def test_render(spark):
    found = checks.render_checks(
        texts(spark, " - missing_count(a) = 0 ", None, "invalid_count(a) = 0:\n  valid values: [x]", "- b\n- c")
    )
    assert by_table(found, "part", "yaml_content") == {
        "t": (
            0,
            "checks for c.s.t:\n  - missing_count(a) = 0\n  - invalid_count(a) = 0:\n      valid values: [x]\n  - b\n  - c",
        )
    }


def test_a_table_with_very_many_checks_gets_several_documents(spark):
    rows = spark.range(10_000).selectExpr(
        "id * 3 as check_id", "'c' as catalog_name", "'s' as schema_name", "if(id < 9000, 'hot', concat('t', id % 50)) as table_name",
        "'x' as column_name", "concat('check ', id) as check",
    )
    found = checks.render_checks(rows, per_document=100).collect()
    hot = sorted((r for r in found if r["table_name"] == "hot"), key=lambda r: r["part"])
    lines = [line for r in hot for line in r["yaml_content"].split("\n")[1:]]
    assert lines == [f"  - check {i}" for i in range(9_000)]
    assert max(r["yaml_content"].count("\n") for r in found) <= 200
    assert {r["part"] for r in found if r["table_name"] != "hot"} == {0}


def test_suggested_checks_hold_on_awkward_columns(spark):
    data = spark.sql(
        "select array(id % 2) as list, named_struct('a', id % 2) as pair, map('k', id) as kept, "
        "concat('x', char(13), id % 2) as broken, concat('x', decode(unhex('E280A8'), 'utf-8'), id % 2) as lines, "
        "id % 2 as `total (usd)`, id % 2 as `a``b` from range(30)"
    )
    tables = {"c.s.awkward": data}
    found = suggest.suggest_checks(profile.low_cardinality(spark, tables), profile.column_counts(tables))
    drafts = found.selectExpr("row_number() over (order by column_name) as check_id", "*")
    results = checks.evaluate_checks(spark, drafts, tables).collect()
    assert {r["outcome"] for r in results} == {"pass"} and len(results) == 13


def test_checks_without_an_id_are_rendered(spark):
    rows = [("c", "s", "t", 1, "a", "missing_count(a) = 0"), ("c", "s", "t", None, "b", "missing_count(b) = 0")]
    rows = spark.createDataFrame(rows, "catalog_name string, schema_name string, table_name string, check_id long, column_name string, check string")
    assert checks.render_checks(rows).first()["yaml_content"].count("  - ") == 2


def test_one_document_of_very_many_checks(spark, tmp_path):
    rows = spark.range(2_500).selectExpr(
        "id * 3 as check_id", "'c' as catalog_name", "'s' as schema_name", "if(id < 2400, 'hot', 'cold') as table_name", "'x' as column_name",
        "concat('check ', id, '\n- more') as check",
    )
    found = {r["table_name"]: r["yaml_content"] for r in checks.render_checks(rows).collect()}
    lines = [line for i in range(2_400) for line in (f"  - check {i}", "  - more")]
    assert found["hot"].split("\n") == ["checks for c.s.hot:", *lines]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        checks.write_documents(rows.unionByName(rows.limit(1).selectExpr("* except (check)", "' ' as check")), f"{tmp_path}/docs")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = sorted((tmp_path / "docs" / "document=c.s.hot").glob("part-*"))
    assert len(files) > 1
    assert "".join(f.read_text() for f in files).rstrip("\n") == found["hot"]


def test_tasks_take_a_bounded_number_of_checks_and_rows(spark, monkeypatch):
    data = spark.range(2_000).selectExpr("id % 1500 as k", "nullif(id % 3, 0) as `b.c`").coalesce(1)
    rows = [f"invalid_count(k) = {2_000 - (2 if i < 500 else 1)}:\n  valid values: [{i}]" for i in range(1_500)]
    rows += ["missing_count(`b.c`) = 667", "invalid_count(`b.c`) = 667:\n  invalid regex: ^1$"]
    stored = texts(spark, *rows).coalesce(1)
    monkeypatch.setattr(checks, "CHECKS_AT_ONCE", 100)
    monkeypatch.setattr(checks, "ROWS_AT_ONCE", 100, raising=False)
    kept, largest = checks.stored_once, []

    def spied(frame):
        frame = kept(frame)
        largest.append(frame.groupBy(F.input_file_name()).count().agg(F.max("count")).head()[0])
        return frame

    monkeypatch.setattr(checks, "stored_once", spied)
    found = checks.evaluate_checks(spark, stored, {"c.s.t": data}).collect()
    assert len(found) == 1_502 and {r["outcome"] for r in found} == {checks.PASS}
    # The parsed checks, and what they count.
    assert max(largest[:2]) < 200
