"""Metadata frames derived from the test tables, for running every operator on data that grows.

Each function maps whole test tables to one of the engine's frames. ``workload.sql`` holds the same
mappings in SQL for the comparison.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablegrade.schemas import COLUMN_KEYS, METRICS, TABLE_KEYS
from tablegrade.sources.catalog import columns_of
from tablegrade.sources.local import local_frame

AS_OF = "2024-01-31 00:00:00"

TEST_TABLES = [
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
]


#: Schemas read from file footers, so that each is looked up once.
_SCHEMAS: dict[str, StructType] = {}


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    path = f"{folder}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def table(catalog: str, schema: str, name: str | Column) -> list[Column]:
    name = F.expr(name) if isinstance(name, str) else name
    return [
        F.lit(catalog).alias("catalog_name"),
        F.lit(schema).alias("schema_name"),
        name.alias("table_name"),
    ]


# --- events: one monitored table per user, every event a commit -----------------------------------

_USER = "concat('u', user_id)"


def user_history(spark: SparkSession, folder: str) -> DataFrame:
    number = "regexp_extract(props, '([0-9]+)', 1)"
    return read(spark, folder, "events").select(
        *table("lake", "ev", _USER),
        F.col("event_id").alias("version"),
        F.col("ts").alias("timestamp"),
        F.expr(
            "case event_type when 'view' then 'OPTIMIZE' when 'signup' then 'CREATE TABLE' "
            "when 'click' then 'WRITE' when 'purchase' then 'MERGE' else 'VACUUM START' end"
        ).alias("operation"),
        F.expr(f"case when cast({number} as int) < 50 then concat('job_', {number}) end").alias("job"),
    )


def user_config(spark: SparkSession, folder: str) -> DataFrame:
    return (
        read(spark, folder, "events")
        .select("user_id")
        .distinct()
        .select(
            *table("lake", "ev", _USER),
            F.expr(
                "case user_id % 3 when 0 then '30m' when 1 then '12h' else '1d6h' end"
            ).alias("freshness_window"),
            F.expr("case user_id % 2 when 0 then '1d' else '2w12d' end").alias("validity_window"),
        )
    )


def user_tables(spark: SparkSession, folder: str) -> DataFrame:
    return (
        read(spark, folder, "events")
        .groupBy("user_id")
        .agg(F.min("ts").alias("created_at"), F.max("ts").alias("last_modified"))
        .select(
            *table("lake", "ev", _USER),
            F.expr("concat('id-', user_id)").alias("id"),
            F.expr("case when user_id % 7 <> 0 then concat('owner_', user_id) end").alias("table_owner"),
            F.expr(
                "case user_id % 4 when 0 then cast(null as string) when 1 then ' ' "
                "else concat('events of user ', user_id) end"
            ).alias("description"),
            "created_at",
            "last_modified",
        )
    )


def user_properties(spark: SparkSession, folder: str) -> DataFrame:
    entries = F.expr(
        """array(
          named_struct('key', 'Owner', 'value',
            case when user_id % 7 = 0 then null when user_id % 11 = 0 then '' else concat('owner_', user_id) end),
          named_struct('key', 'Provider', 'value', case when user_id % 3 = 0 then 'parquet' else 'delta' end),
          named_struct('key', 'Table Properties', 'value',
            case when user_id % 2 = 0 then '[delta.logRetentionDuration=30 days]' else '[k=v]' end),
          named_struct('key', 'Is_managed_location', 'value', case when user_id % 5 <> 0 then 'true' end),
          named_struct('key', 'Comment', 'value', 'not scored'))"""
    )
    return (
        read(spark, folder, "events")
        .select("user_id")
        .distinct()
        .select(*table("lake", "ev", _USER), F.inline(entries))
        .where("value is not null")
    )


def user_columns(spark: SparkSession, folder: str) -> DataFrame:
    return (
        read(spark, folder, "events")
        .select(*table("lake", "ev", _USER), F.col("event_type").alias("column_name"))
        .distinct()
    )


def user_checks(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "events").select(
        F.col("event_id").alias("check_id"),
        *table("lake", "ev", _USER),
        F.col("event_type").alias("column_name"),
        F.expr(
            "case when value > 20 then concat('missing_count(', event_type, ') = 0') "
            "when value > 5 then ' ' end"
        ).alias("check"),
        F.lit(None).cast("string").alias("tag"),
    )


# --- part: tables by brand and size, part names as columns, three past versions -------------------

_PART = "concat(p_brand, '_', p_size)"


def part_columns(spark: SparkSession, folder: str) -> DataFrame:
    return (
        read(spark, folder, "part")
        .where("p_retailprice < 993")
        .groupBy(*table("lake", "parts", _PART), F.col("p_name").alias("column_name"))
        .agg(F.min("p_type").alias("data_type"))
    )


def part_versions(spark: SparkSession, folder: str) -> DataFrame:
    return (
        read(spark, folder, "part")
        .select("*", F.explode(F.expr("array(1L, 2L, 3L)")).alias("version"))
        .where("version = 3 or version = 2 and p_retailprice < 996 or version = 1 and p_retailprice >= 905")
        .groupBy(*table("lake", "parts", _PART), "version", F.col("p_name").alias("column_name"))
        .agg(
            F.expr(
                "min(case when version = 1 and p_retailprice >= 950 and p_retailprice < 958 "
                "then 'LEGACY' else p_type end)"
            ).alias("data_type")
        )
    )


def part_history(spark: SparkSession, folder: str) -> DataFrame:
    day = "make_dt_interval(cast(p_size % 20 + 3 * version as int))"
    return (
        read(spark, folder, "part")
        .select("p_brand", "p_size")
        .distinct()
        .select("*", F.explode(F.expr("array(1L, 2L, 3L)")).alias("version"))
        .select(
            *table("lake", "parts", _PART),
            "version",
            F.expr(f"timestamp_ntz'2024-01-01 00:00:00' + {day}").alias("timestamp"),
            F.lit("WRITE").alias("operation"),
            F.lit(None).cast("string").alias("job"),
        )
    )


def part_config(spark: SparkSession, folder: str) -> DataFrame:
    return (
        read(spark, folder, "part")
        .select("p_brand", "p_size")
        .distinct()
        .select(
            *table("lake", "parts", _PART),
            F.expr(
                "case p_size % 3 when 0 then '1d' when 1 then '7d' else '30d' end"
            ).alias("validity_window"),
        )
    )


# --- customer and orders: five columns per table, orders as tags and as checks --------------------


def crm_columns(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "customer").select(
        *table("lake", "crm", "concat('t', c_custkey div 5)"),
        F.expr("concat('c', c_custkey)").alias("column_name"),
        F.expr("case when c_acctbal < 0 then 'NO' else 'YES' end").alias("is_nullable"),
        F.col("c_mktsegment").alias("data_type"),
        F.expr(
            "case c_nationkey when 0 then cast(null as string) when 1 then '' when 2 then '  ' "
            "else concat('column ', c_custkey) end"
        ).alias("comment"),
    )


def crm_live_columns(spark: SparkSession, folder: str) -> DataFrame:
    """The columns without those of overdrawn customers, which stand for dropped ones."""
    return crm_columns(spark, folder).where("is_nullable = 'YES'")


def _crm_column() -> list[Column]:
    return [
        *table("lake", "crm", "concat('t', o_custkey div 5)"),
        F.expr("concat('c', o_custkey)").alias("column_name"),
    ]


def crm_tags(spark: SparkSession, folder: str) -> DataFrame:
    urgent = "o_orderpriority = '1-URGENT'"
    return (
        read(spark, folder, "orders")
        .select(
            *_crm_column(),
            F.expr(
                "case when o_orderpriority = '3-MEDIUM' and o_orderstatus = 'F' then 'has_check' "
                f"when {urgent} and o_orderstatus = 'O' then 'has_comment' "
                "when o_orderstatus = 'P' and o_orderpriority < '3' then 'has_low_cardinality' "
                "else concat('note_', substring(o_orderpriority, 1, 1)) end"
            ).alias("tag_name"),
            "o_orderstatus",
            "o_orderpriority",
        )
        .groupBy(*COLUMN_KEYS, "tag_name")
        .agg(
            F.expr(
                "max(case when tag_name = 'has_low_cardinality' then o_orderpriority "
                "when tag_name = 'has_comment' then '' when tag_name = 'has_check' then null "
                "else o_orderstatus end)"
            ).alias("tag_value")
        )
    )


def crm_checks(spark: SparkSession, folder: str) -> DataFrame:
    column = "concat('c', o_custkey)"
    return read(spark, folder, "orders").select(
        F.col("o_orderkey").alias("check_id"),
        *_crm_column(),
        F.expr(
            f"case when o_orderpriority = '1-URGENT' then case o_orderstatus "
            f"when 'F' then concat('  - missing_count(', {column}, ') = 0') "
            f"when 'O' then concat('invalid_count(', {column}, ') = 0:\\n    valid values: [A, B]') "
            f"else concat('missing_count(', {column}, ') = 0') end "
            "when o_orderpriority = '2-HIGH' then '  ' end"
        ).alias("check"),
        F.expr("case when o_orderstatus = 'F' then 'ai_generated' end").alias("tag"),
    )


def crm_check_changes(spark: SparkSession, folder: str) -> DataFrame:
    """One new check per customer, tagged as generated for all but one segment."""
    return read(spark, folder, "customer").select(
        *table("lake", "crm", "concat('t', c_custkey div 5)"),
        F.expr("concat('c', c_custkey)").alias("column_name"),
        F.expr("concat('missing_count(c', c_custkey, ') <= ', c_nationkey)").alias("check"),
        F.expr("case when c_mktsegment <> 'MACHINERY' then 'ai_generated' end").alias("tag"),
    )


def crm_checks_by_id(spark: SparkSession, folder: str) -> DataFrame:
    """New texts for the checks of partial orders; urgent ones name a table that does not match."""
    return (
        read(spark, folder, "orders")
        .where("o_orderstatus = 'P'")
        .select(
            F.col("o_orderkey").alias("check_id"),
            *table(
                "other",
                "crm",
                "concat(case when o_orderpriority = '1-URGENT' then 'x' else 't' end, o_custkey div 5)",
            ),
            F.expr("concat('c', o_custkey)").alias("column_name"),
            F.expr("concat('missing_count(c', o_custkey, ') < 7')").alias("check"),
            F.lit("reviewed").alias("tag"),
        )
    )


# --- nation and supplier: listings and configuration ----------------------------------------------


def all_schemas(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "nation").select(
        F.lit("lake").alias("catalog_name"),
        F.expr(
            "case n_nationkey when 0 then 'default' when 1 then 'information_schema' "
            "when 2 then 'data_quality' when 3 then 'raw' when 4 then 'models' else n_name end"
        ).alias("schema_name"),
    )


def all_tables(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "supplier").select(
        F.lit("lake").alias("catalog_name"),
        F.expr(
            "case s_nationkey when 0 then 'default' when 3 then 'raw' "
            "else concat('NATION_', s_nationkey) end"
        ).alias("schema_name"),
        F.expr(
            "case s_nationkey when 5 then concat(s_name, '_sqldf') when 6 then concat('table_history_', s_name) "
            "when 7 then concat(s_name, '_table_metadata') else s_name end"
        ).alias("table_name"),
    )


def stored_config(spark: SparkSession, folder: str) -> DataFrame:
    """Configuration of the suppliers with a positive balance, for some of them stored twice."""
    stored = (
        read(spark, folder, "supplier")
        .where("s_acctbal >= 0")
        .select("*", F.explode(F.expr("case when s_nationkey < 5 then array(0, 1) else array(0) end")).alias("again"))
    )
    return stored.select(
        F.expr("s_suppkey * 2 + again + 1").alias("_id"),
        F.lit("lake").alias("catalog_name"),
        F.expr("concat('NATION_', s_nationkey)").alias("schema_name"),
        F.col("s_name").alias("table_name"),
        F.expr("10 + again").alias("low_cardinality_threshold"),
        F.lit("1d").alias("freshness_window"),
        F.expr("case again when 1 then '3d' else '1d' end").alias("validity_window"),
        F.lit(None).cast("string").alias("tag"),
    )


def config_changes(spark: SparkSession, folder: str) -> DataFrame:
    """New parameters for rich suppliers (mostly stored) and overdrawn ones (new)."""
    return (
        read(spark, folder, "supplier")
        .where("s_acctbal > 5000 or s_acctbal < 0")
        .select(
            F.lit("lake").alias("catalog_name"),
            F.expr("concat('NATION_', s_nationkey)").alias("schema_name"),
            F.col("s_name").alias("table_name"),
            F.expr("case when s_acctbal > 5000 then 25 end").alias("low_cardinality_threshold"),
            F.expr("case when s_nationkey > 10 then '7d' end").alias("freshness_window"),
            F.lit("seen").alias("tag"),
        )
    )


# --- events: metric rows and a stored summary -----------------------------------------------------


def user_metric_rows(spark: SparkSession, folder: str) -> DataFrame:
    """One table per user and event type; its latest event of an hour bucket gives one metric."""
    names = F.array(*(F.lit(m) for m in METRICS))
    return (
        read(spark, folder, "events")
        .groupBy(
            *table("lake", "sum", "concat('u', user_id, '_', event_type)"),
            F.element_at(names, F.expr("cast(hour(ts) % 13 + 1 as int)")).alias("metric"),
        )
        .agg(F.expr("max_by(value > 10, event_id)").alias("value"))
    )


def stored_summary(spark: SparkSession, folder: str) -> DataFrame:
    """A summary of the click, view and error tables from before."""
    return (
        read(spark, folder, "events")
        .where("event_type in ('click', 'view', 'error')")
        .groupBy("user_id", "event_type")
        .agg(F.min("event_id").alias("table_id"))
        .select(
            "table_id",
            *table("lake", "sum", "concat('u', user_id, '_', event_type)"),
            *(F.expr(f"(user_id + {i}) % 3 = 0").alias(m) for i, m in enumerate(METRICS)),
        )
    )


# --- the test tables themselves as monitored tables -----------------------------------------------


def monitored(spark: SparkSession, folder: str, names: list[str] = TEST_TABLES) -> dict[str, DataFrame]:
    return {f"lake.main.{name}": read(spark, folder, name) for name in names}


#: Declared checks: id, table, column, text.
DECLARED_CHECKS = [
    (1, "lineitem", "l_quantity", "missing_count(l_quantity) = 0"),
    (2, "lineitem", "l_returnflag", "- invalid_count(l_returnflag) = 0:\n    valid values: [A, N, R]"),
    (3, "lineitem", "l_linestatus", "invalid_count(l_linestatus) = 0:\n  valid values: ['O']"),
    (4, "orders", "o_orderkey", "  - missing_count(o_orderkey) = 0"),
    (5, "orders", "o_orderstatus", "invalid_count(o_orderstatus) <= 1000000000000:\n  valid values: [F, \"O\"]"),
    (6, "orders", "o_orderpriority", "invalid_count(o_orderpriority) = 0:\n  invalid regex: ^1"),
    (7, "customer", "c_mktsegment",
     "invalid_count(c_mktsegment) = 0:\n  valid values: [AUTOMOBILE, BUILDING, FURNITURE, HOUSEHOLD, MACHINERY]"),
    (8, "customer", "c_name", "invalid_count(c_name) = 0:\n  invalid regex: ^X"),
    (9, "customer", "c_custkey", "- missing_count(c_custkey) = 0\n- missing_count(c_custkey) < 5"),
    (10, "events", "value", "avg(value) > 0"),
    (11, "part", "p_size", "invalid_count(p_size) > 0:\n  valid values: [1, 2, 3]"),
    (12, "labels", "toxic", "invalid_count(toxic) = 0:\n  valid values: [0, 1]"),
    (13, "documents", "text", "invalid_count(text) = 0:\n  invalid regex: (?i)confidential"),
    (14, "orders", "gone", "missing_count(gone) = 0"),
    (15, "labels", "toxic", "  "),
]


def declared_checks(spark: SparkSession) -> DataFrame:
    rows = [(i, "lake", "main", t, c, text, None) for i, t, c, text in DECLARED_CHECKS]
    return local_frame(
        spark, rows,
        "check_id bigint, catalog_name string, schema_name string, table_name string, "
        "column_name string, check string, tag string",
    )


def order_checks(spark: SparkSession, folder: str) -> DataFrame:
    """One check for every order, on the column of their keys."""
    return read(spark, folder, "orders").select(
        F.col("o_orderkey").alias("check_id"),
        *table("lake", "main", F.lit("orders")),
        F.lit("o_orderkey").alias("column_name"),
        F.expr("concat('invalid_count(o_orderkey) > ', o_orderkey % 7, ':\\n  valid values: [', o_orderkey, ']')").alias("check"),
        F.lit(None).cast("string").alias("tag"),
    )


def checked_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All test tables; ``l_quantity`` lacks its largest value, so that nulls exist."""
    tables = monitored(spark, folder)
    lineitem = tables["lake.main.lineitem"]
    tables["lake.main.lineitem"] = lineitem.withColumn(
        "l_quantity", F.expr("nullif(l_quantity, 50D)")
    )
    return tables


def main_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Column inventory of the test tables; all but the fractional columns have comments."""
    return columns_of(spark, monitored(spark, folder)).withColumn(
        "comment", F.expr("case when data_type <> 'double' then concat('about ', column_name) end")
    )


def main_history(spark: SparkSession, folder: str) -> DataFrame:
    """Commits of the dated tables: one per day of data, and one per hour for events."""
    sources = {"orders": ("o_orderdate", "day"), "lineitem": ("l_shipdate", "day"), "events": ("ts", "hour")}
    history = None
    for name, (column, unit) in sources.items():
        commits = (
            read(spark, folder, name)
            .select(F.date_trunc(unit, column).cast("timestamp_ntz").alias("timestamp"))
            .distinct()
            .select(
                *table("lake", "main", F.lit(name)),
                F.expr("datediff(timestamp, date'1990-01-01') * 24L + hour(timestamp)").alias("version"),
                "timestamp",
                F.lit("WRITE").alias("operation"),
                F.lit(None if name == "lineitem" else f"load_{name}").cast("string").alias("job"),
            )
        )
        history = commits if history is None else history.unionByName(commits)
    return history


def main_config(spark: SparkSession) -> DataFrame:
    rows = [
        (i, "lake", "main", t, 10, "10000d" if t == "orders" else "1d", "30d", None)
        for i, t in enumerate(TEST_TABLES, 1)
    ]
    return local_frame(
        spark, rows,
        "_id bigint, catalog_name string, schema_name string, table_name string, "
        "low_cardinality_threshold int, freshness_window string, validity_window string, tag string",
    )


def main_tables(spark: SparkSession) -> DataFrame:
    rows = [
        ("lake", "main", t, f"id-{t}", "ops", None if t in ("pages", "labels") else f"The {t} table", None, None)
        for t in TEST_TABLES
    ]
    return local_frame(
        spark, rows,
        "catalog_name string, schema_name string, table_name string, id string, table_owner string, "
        "description string, created_at timestamp_ntz, last_modified timestamp_ntz",
    )


def main_properties(spark: SparkSession) -> DataFrame:
    rows = []
    for t in TEST_TABLES:
        rows.append(("lake", "main", t, "Owner", "ops"))
        rows.append(("lake", "main", t, "Provider", "delta" if t in ("orders", "events") else "parquet"))
        if t == "orders":
            rows.append(("lake", "main", t, "Table Properties", "[delta.deletedFileRetentionDuration=7 days]"))
            rows.append(("lake", "main", t, "Is_managed_location", "true"))
    return local_frame(
        spark, rows, "catalog_name string, schema_name string, table_name string, key string, value string"
    )


def main_versions(spark: SparkSession, folder: str, history: DataFrame) -> DataFrame:
    """Past schemas of the dated tables at every commit: lineitem lacked its tax, events had text values."""
    commits = history.select(*TABLE_KEYS, "version")
    columns = columns_of(spark, monitored(spark, folder)).select(*COLUMN_KEYS, "data_type")
    then = columns.where("not (table_name = 'lineitem' and column_name = 'l_tax')").withColumn(
        "data_type",
        F.expr("case when table_name = 'events' and column_name = 'value' then 'string' else data_type end"),
    )
    return commits.join(F.broadcast(then), TABLE_KEYS)


# --- embeddings and benchmark: retrieval ----------------------------------------------------------


def vector_queries(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "embeddings").select(
        F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector")
    )


def all_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector as a document."""
    return vector_queries(spark, folder).withColumnRenamed("query_id", "doc_id")


def vector_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The reference checks with a vector each, by equal number."""
    vectors = read(spark, folder, "embeddings").select(
        F.col("vec_id").alias("doc_id"), F.col("embedding").alias("vector")
    )
    items = read(spark, folder, "benchmark").select(F.col("item_id").alias("doc_id"))
    return vectors.join(items, "doc_id", "left_semi")


def reference_checks(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "benchmark").select(
        F.expr("cast(item_id as string)").alias("check_id"),
        F.expr("concat('missing_count(c', item_id, ') = 0')").alias("check_syntax"),
        F.col("text").alias("description"),
    )
