"""Tags and owners from and to a catalog, with stand-ins for what plain Spark lacks."""

from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException

from tablegrade.schemas import COLUMN_TAGS, TABLES
from tablegrade.sources import tags
from tests.helpers import as_set, by_table, frame

TAG = "column_name string, tag_name string, tag_value string"


@pytest.fixture
def statements(spark, monkeypatch):
    """The statements that would reach the catalog; those about a column named ``broken`` fail."""
    sent = []

    def sql(self, text, *args, **kwargs):
        sent.append(text)
        if "`broken`" in text:
            raise AnalysisException("no permission\nmore")

    monkeypatch.setattr(type(spark), "sql", sql)
    return sent


def test_statements_are_quoted(spark, statements):
    changes = frame(
        spark, f"{TAG}, action string",
        ("t", "col", "has_check", None, "SET"), ("t", "col", "has_low_cardinality", "O'Brien, Smith", "SET"),
        ("t", "odd `name`", "has_comment", "x", "UNSET"), ("t", "a", "k'", "${v} \\ \n", "SET"),
    )
    done = tags.write_tags(spark, changes.coalesce(1))
    assert sorted(statements) == sorted([
        "ALTER TABLE `c`.`s`.`t` ALTER COLUMN `col` SET TAGS ('has_check')",
        "ALTER TABLE `c`.`s`.`t` ALTER COLUMN `col` SET TAGS ('has_low_cardinality' = 'O\\'Brien, Smith')",
        "ALTER TABLE `c`.`s`.`t` ALTER COLUMN `odd ``name``` UNSET TAGS ('has_comment')",
        "ALTER TABLE `c`.`s`.`t` ALTER COLUMN `a` SET TAGS ('k\\'' = '\\u0024{v} \\\\ \\n')",
    ])
    assert done.where("error is not null").count() == 0 and done.count() == 4


def test_a_failing_statement_costs_one_tag(spark, statements):
    changes = frame(spark, f"{TAG}, action string", *[("t", c, "has_check", None, "SET") for c in ("a", "broken", "z", "${x}")])
    done = {r["column_name"]: r["error"] for r in tags.write_tags(spark, changes).collect()}
    assert done["a"] is None and done["z"] is None and done["broken"] == "no permission" and "expand" in done["${x}"]
    assert len(statements) == 3


def test_changes_between_two_states(spark):
    before = frame(spark, TAG, ("t", "a", "k", "1"), ("t", "b", "k", None), ("t", "c", "k", "old"), ("t", "d", "k", "x"))
    after = frame(spark, TAG, ("t", "b", "k", None), ("t", "c", "k", "new"), ("t", "d", "k", None), ("t", "e", "k", "5"))
    found = as_set(tags.tag_changes(before, after), "column_name", "tag_value", "action")
    assert found == {("a", None, "UNSET"), ("c", "new", "SET"), ("d", None, "SET"), ("e", "5", "SET")}
    assert tags.tag_changes(after, after).count() == 0


def test_listings_of_the_information_schema(spark, monkeypatch):
    listed = frame(spark, TAG, ("t", "a", "k", "1"), ("u", "b", "k", None)).selectExpr("*", "'extra' as more")
    owned = spark.createDataFrame([("c", "s", "t", "ann", "All sales"), ("d", "s", "t", "bob", None)], "table_catalog string, table_schema string, table_name string, table_owner string, comment string")
    answers = {"`c`.information_schema.column_tags": listed, "`c`.information_schema.tables": owned}
    monkeypatch.setattr(type(spark), "table", lambda self, name: answers[name])
    found = tags.tags_of(spark, "c")
    assert found.columns == COLUMN_TAGS.names and as_set(found, "table_name", "tag_value") == {("t", "1"), ("u", None)}
    assert as_set(tags.tags_of(spark, "c", frame(spark, "", ("u",), ("u",))), "column_name") == {"b"}
    details = spark.createDataFrame([("c", "s", "t", "1", None, None, None, None), ("c", "s", "u", "2", None, "Own", None, None)], TABLES)
    filled = tags.with_owners(details, tags.owners_of(spark, "c"))
    assert filled.columns == details.columns
    assert by_table(filled, "table_owner", "description") == {"t": ("ann", "All sales"), "u": (None, "Own")}
