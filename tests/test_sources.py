from __future__ import annotations

import pytest

from tablegrade.operators import inventory, signals
from tablegrade.schemas import COLUMNS, DQ_CONFIG, KNOWLEDGE_BASE
from tablegrade.sources import catalog, knowledge_base, state_files
from tests.helpers import as_set, by_table, frame


@pytest.fixture(scope="module")
def shop(spark):
    spark.sql("CREATE SCHEMA shop")
    spark.sql("CREATE TABLE shop.sales (id BIGINT COMMENT 'key', `odd name` ARRAY<INT>) USING parquet TBLPROPERTIES ('k' = 'v')")
    spark.sql("CREATE TABLE shop.x_sqldf (id INT) USING parquet")
    spark.sql("INSERT INTO shop.sales VALUES (1, array(1)), (2, null)")
    spark.range(1).createOrReplaceTempView("a_view")
    yield "spark_catalog.shop"
    spark.sql("DROP SCHEMA shop CASCADE")


def test_listing(spark, shop):
    schemas = inventory.list_schemas(catalog.schemas_in(spark, "spark_catalog"))
    assert as_set(schemas, "catalog_name", "schema_name") == {("spark_catalog", "shop")}
    tables = inventory.list_tables(catalog.tables_in(spark, "spark_catalog", "shop"))
    assert as_set(tables, "catalog_name", "schema_name", "table_name") == {("spark_catalog", "shop", "sales")}


def test_column_inventory(spark, shop):
    tables = catalog.open_tables(spark, [f"{shop}.sales"])
    columns = catalog.columns_of(spark, tables)
    assert columns.schema == COLUMNS
    assert as_set(columns, "table_name", "column_name", "is_nullable", "data_type", "comment") == {
        ("sales", "id", "YES", "bigint", "key"), ("sales", "odd name", "YES", "array<int>", None),
    }
    strict = catalog.columns_of(spark, tables, with_nullability=True)
    assert "containsNull" in {r["data_type"] for r in strict.collect() if r["column_name"] == "odd name"}.pop()


def test_properties(spark, shop):
    names = [f"{shop}.sales", f"{shop}.x_sqldf"]
    found = signals.pivot_properties(catalog.properties_of(spark, names))
    rows = by_table(found, "Provider", "Table", "Table Properties")
    assert rows["sales"][:2] == ("parquet", "sales") and "k=v" in rows["sales"][2]
    assert rows["x_sqldf"][:2] == ("parquet", "x_sqldf")
    assert catalog.properties_of(spark, []).count() == 0


def test_comments_reach_the_catalog(spark, shop):
    text = "it's \"quoted\" \\ and ${x}"
    comments = spark.createDataFrame(
        [("spark_catalog", "shop", "sales", "odd name", text)],
        "catalog_name string, schema_name string, table_name string, column_name string, comment string",
    )
    catalog.write_comments(spark, comments)
    columns = catalog.columns_of(spark, catalog.open_tables(spark, [f"{shop}.sales"]))
    assert ("odd name", text) in as_set(columns, "column_name", "comment")


def test_names_need_three_parts(spark):
    with pytest.raises(ValueError, match="not a catalog.schema.table name"):
        catalog.columns_of(spark, {"short": spark.range(1)})


def test_knowledge_base(spark, tmp_path):
    path = tmp_path / "base.csv"
    path.write_text('check_id,check_syntax,description\n1,"invalid_count(a) = 0:\n  valid values: [x, ""y""]",first\n007,s,second\n')
    base = knowledge_base.read_knowledge_base(spark, str(path))
    assert as_set(base, *KNOWLEDGE_BASE.names) == {
        ("1", 'invalid_count(a) = 0:\n  valid values: [x, "y"]', "first"), ("007", "s", "second"),
    }
    empty = spark.createDataFrame([], KNOWLEDGE_BASE)
    once = knowledge_base.append_knowledge(empty, base.union(base))
    assert once.count() == 2
    assert knowledge_base.append_knowledge(once, base).count() == 2


def test_state_is_versioned_by_run(spark, tmp_path):
    root = str(tmp_path / "state")
    assert state_files.read_state(spark, root, "dq_config", None).schema == DQ_CONFIG
    row = frame(
        spark, "_id bigint, low_cardinality_threshold int, freshness_window string, validity_window string, tag string",
        ("t", 1, 10, "1d", "1d", None),
    )
    first = state_files.write_state(row, root, "dq_config", "1")
    assert first.count() == 1
    state_files.write_state(first.unionByName(first), root, "dq_config", "2")
    assert state_files.read_state(spark, root, "dq_config", "1").count() == 1
    assert state_files.read_state(spark, root, "dq_config", "2").count() == 2
    with pytest.raises(Exception, match="already exists"):
        state_files.write_state(row, root, "dq_config", "2")


def test_intermediate_tables_go_to_the_configured_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    stored = state_files.stored_once(spark.range(3))
    assert stored.count() == 3
    assert all(folder in path for path in stored.inputFiles())


def test_history_detail_and_versions_read_what_the_format_reports(spark, monkeypatch):
    """Stand-ins for the statements of a versioned format, which plain Spark lacks."""
    real = type(spark).sql
    answers = {
        "DESCRIBE HISTORY": "select 1L as version, timestamp'2024-01-02 03:04:05' as timestamp, 'WRITE' as operation, "
        "named_struct('jobId', '7') as job, 'x' as userName",
        "DESCRIBE DETAIL": "select 'i' as id, 'n' as name, 'text' as description, timestamp'2024-01-01' as createdAt, "
        "timestamp'2024-01-02' as lastModified, 3 as numFiles",
        "SELECT * FROM `c`.`s`.`t` VERSION AS OF 4": "select 1 as a, 'x' as b",
    }

    def sql(self, text, *args, **kwargs):
        for start, answer in answers.items():
            if text.startswith(start):
                return real(self, answer)
        return real(self, text, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", sql)
    history = catalog.history_of(spark, ["c.s.t", "c.s.u"])
    assert {(r["table_name"], r["version"], str(r["timestamp"]), r["job"]) for r in history.collect()} == {
        ("t", 1, "2024-01-02 03:04:05", "{7}"), ("u", 1, "2024-01-02 03:04:05", "{7}"),
    }
    assert as_set(catalog.detail_of(spark, ["c.s.t"]), "table_name", "id", "description") == {("t", "i", "text")}
    versions = catalog.schema_versions_of(spark, {"c.s.t": [4]})
    assert as_set(versions, "version", "column_name", "data_type") == {(4, "a", "int"), (4, "b", "string")}
