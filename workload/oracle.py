"""The queries' results in SQL, for comparison on the same tables in DuckDB."""

from __future__ import annotations

from workload.frames import AS_OF, DECLARED_CHECKS, TEST_TABLES

ORACLE: dict[str, str] = {}

METRIC_POINTS = [
    ("table_description", "usability", 7),
    ("columns_description", "usability", 8),
    ("has_a_valid_owner", "stewardship", 5),
    ("is_delta_table", "stewardship", 5),
    ("uses_a_production_pipeline", "stewardship", 5),
    ("has_enforced_retention_duration", "stewardship", 5),
    ("is_managed_location", "stewardship", 5),
    ("is_fresh", "freshness", 10),
    ("columns_valid", "validity", 10),
    ("columns_datatype_valid", "validity", 10),
    ("all_columns_have_checks", "accuracy", 5),
    ("table_implement_checks", "accuracy", 5),
    ("has_check_passed", "accuracy", 20),
]
ALL_METRICS = [m for m, _, _ in METRIC_POINTS]
DIMENSION_NAMES = ["stewardship", "usability", "freshness", "validity", "accuracy"]

#: Columns of the test tables with their types as Spark names them.
TEST_COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}
COLUMNS = [
    (t, *entry.split(" ")) for t in TEST_TABLES for entry in TEST_COLUMNS[t].split(", ")
]

# --- the frames of ``workload.frames`` ------------------------------------------------------------

_N = "regexp_extract(props, '([0-9]+)', 1)"
_NAME3 = "catalog_name || '.' || schema_name || '.' || table_name"

FRAMES = {
    "user_history": f"""
SELECT 'lake.ev.u' || user_id AS table_name, event_id AS version, ts AS moment,
  CASE event_type WHEN 'view' THEN 'OPTIMIZE' WHEN 'signup' THEN 'CREATE TABLE' WHEN 'click' THEN 'WRITE'
    WHEN 'purchase' THEN 'MERGE' ELSE 'VACUUM START' END AS operation,
  CASE WHEN CAST({_N} AS INT) < 50 THEN 'job_' || {_N} END AS job
FROM events""",
    "user_config": """
SELECT DISTINCT 'lake.ev.u' || user_id AS table_name,
  CASE user_id % 3 WHEN 0 THEN '30m' WHEN 1 THEN '12h' ELSE '1d6h' END AS freshness_window,
  CASE user_id % 3 WHEN 0 THEN 1800 WHEN 1 THEN 43200 ELSE 108000 END AS fresh_seconds,
  CASE user_id % 2 WHEN 0 THEN '1d' ELSE '2w12d' END AS validity_window,
  CASE user_id % 2 WHEN 0 THEN 1 ELSE 12 END AS valid_days
FROM events""",
    "user_freshness": f"""
SELECT c.table_name, c.freshness_window, w.last_update,
  coalesce(w.last_update > TIMESTAMP '{AS_OF}' - to_seconds(c.fresh_seconds), false) AS is_fresh,
  CAST(floor((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(w.last_update)) / 1000000) AS BIGINT) AS age
FROM user_config c LEFT JOIN (
  SELECT table_name, max(moment) AS last_update FROM user_history
  WHERE operation IN ('CREATE TABLE', 'WRITE', 'MERGE') GROUP BY table_name) w USING (table_name)""",
    "user_tables": """
SELECT 'lake.ev.u' || user_id AS table_name, 'id-' || user_id AS id,
  CASE WHEN user_id % 7 <> 0 THEN 'owner_' || user_id END AS table_owner,
  CASE user_id % 4 WHEN 0 THEN NULL WHEN 1 THEN ' ' ELSE 'events of user ' || user_id END AS description,
  strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS created_at, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_modified,
  user_id
FROM events GROUP BY user_id""",
    "part_columns": """
SELECT 'lake.parts.' || p_brand || '_' || p_size AS table_name, p_name AS column_name, min(p_type) AS data_type
FROM part WHERE p_retailprice < 993 GROUP BY 1, 2""",
    "part_versions": """
SELECT 'lake.parts.' || p_brand || '_' || p_size AS table_name, v AS version, p_name AS column_name,
  min(CASE WHEN v = 1 AND p_retailprice >= 950 AND p_retailprice < 958 THEN 'LEGACY' ELSE p_type END) AS data_type
FROM part, (VALUES (1), (2), (3)) versions(v)
WHERE v = 3 OR v = 2 AND p_retailprice < 996 OR v = 1 AND p_retailprice >= 905
GROUP BY 1, 2, 3""",
    "part_picked": f"""
SELECT table_name, coalesce(
  arg_max(version, moment) FILTER (moment <= target), arg_min(version, moment)) AS version
FROM (
  SELECT DISTINCT 'lake.parts.' || p_brand || '_' || p_size AS table_name, v AS version,
    TIMESTAMP '2024-01-01' + to_days(CAST(p_size % 20 + 3 * v AS INT)) AS moment,
    date_trunc('day', TIMESTAMP '{AS_OF}' - to_days(CASE p_size % 3 WHEN 0 THEN 1 WHEN 1 THEN 7 ELSE 30 END)) AS target
  FROM part, (VALUES (1), (2), (3)) versions(v))
GROUP BY table_name""",
    "part_past": """
SELECT table_name, column_name, data_type FROM part_versions JOIN part_picked USING (table_name, version)""",
    "part_compared": """
SELECT table_name, column_name, c.data_type AS current_type, p.data_type AS past_type
FROM part_columns c FULL JOIN part_past p USING (table_name, column_name)""",
    "crm_columns": """
SELECT 'lake.crm.t' || (c_custkey // 5) AS table_name, 'c' || c_custkey AS column_name,
  CASE WHEN c_acctbal < 0 THEN 'NO' ELSE 'YES' END AS is_nullable, c_mktsegment AS data_type,
  CASE c_nationkey WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '  ' ELSE 'column ' || c_custkey END AS comment
FROM customer""",
    "live": "SELECT * FROM crm_columns WHERE is_nullable = 'YES'",
    "crm_tags": """
SELECT table_name, column_name, tag_name,
  max(CASE tag_name WHEN 'has_low_cardinality' THEN o_orderpriority WHEN 'has_comment' THEN ''
    WHEN 'has_check' THEN NULL ELSE o_orderstatus END) AS tag_value
FROM (SELECT 'lake.crm.t' || (o_custkey // 5) AS table_name, 'c' || o_custkey AS column_name,
    CASE WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'F' THEN 'has_check'
      WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'O' THEN 'has_comment'
      WHEN o_orderstatus = 'P' AND o_orderpriority < '3' THEN 'has_low_cardinality'
      ELSE 'note_' || substr(o_orderpriority, 1, 1) END AS tag_name, o_orderstatus, o_orderpriority
  FROM orders)
GROUP BY ALL""",
    "crm_checks": """
SELECT o_orderkey AS check_id, 'lake.crm.t' || (o_custkey // 5) AS table_name, 'c' || o_custkey AS column_name,
  CASE WHEN o_orderpriority = '1-URGENT' THEN CASE o_orderstatus
      WHEN 'F' THEN '  - missing_count(c' || o_custkey || ') = 0'
      WHEN 'O' THEN 'invalid_count(c' || o_custkey || ') = 0:' || chr(10) || '    valid values: [A, B]'
      ELSE 'missing_count(c' || o_custkey || ') = 0' END
    WHEN o_orderpriority = '2-HIGH' THEN '  ' END AS "check",
  CASE WHEN o_orderstatus = 'F' THEN 'ai_generated' END AS tag, o_custkey, o_orderstatus
FROM orders""",
    "filled": "SELECT * FROM crm_checks WHERE trim(\"check\") <> ''",
    "kept": "SELECT f.* FROM filled f SEMI JOIN live l ON f.table_name = l.table_name AND f.column_name = l.column_name",
    "changes": """
SELECT 'lake' AS catalog_name, 'crm' AS schema_name, 't' || (c_custkey // 5) AS table_name,
  'c' || c_custkey AS column_name, 'missing_count(c' || c_custkey || ') <= ' || c_nationkey AS "check",
  CASE WHEN c_mktsegment <> 'MACHINERY' THEN 'ai_generated' END AS tag
FROM customer""",
    "all_schemas": """
SELECT 'lake' AS catalog_name, CASE n_nationkey WHEN 0 THEN 'default' WHEN 1 THEN 'information_schema'
  WHEN 2 THEN 'data_quality' WHEN 3 THEN 'raw' WHEN 4 THEN 'models' ELSE n_name END AS schema_name
FROM nation""",
    "all_tables": """
SELECT 'lake' AS catalog_name, CASE s_nationkey WHEN 0 THEN 'default' WHEN 3 THEN 'raw'
    ELSE 'NATION_' || s_nationkey END AS schema_name,
  CASE s_nationkey WHEN 5 THEN s_name || '_sqldf' WHEN 6 THEN 'table_history_' || s_name
    WHEN 7 THEN s_name || '_table_metadata' ELSE s_name END AS table_name
FROM supplier""",
    "monitorable": """
SELECT * FROM all_tables WHERE NOT ends_with(table_name, '_sqldf') AND NOT contains(table_name, 'table_history')
  AND NOT contains(table_name, 'table_metadata')""",
    "config": """
SELECT s_suppkey * 2 + CASE WHEN s_nationkey < 5 THEN 1 ELSE 0 END + 1 AS _id, 'lake' AS catalog_name,
  'NATION_' || s_nationkey AS schema_name, s_name AS table_name,
  10 + CASE WHEN s_nationkey < 5 THEN 1 ELSE 0 END AS low_cardinality_threshold, '1d' AS freshness_window,
  CASE WHEN s_nationkey < 5 THEN '3d' ELSE '1d' END AS validity_window, CAST(NULL AS VARCHAR) AS tag
FROM supplier WHERE s_acctbal >= 0""",
    "metric_rows": f"""
SELECT 'lake.sum.u' || user_id || '_' || event_type AS table_name, user_id, event_type,
  list_extract([{", ".join(f"'{m}'" for m in ALL_METRICS)}], CAST(hour(ts) % 13 + 1 AS INT)) AS metric,
  arg_max(value > 10, event_id) AS value
FROM events GROUP BY 1, 2, 3, 4""",
    "summary": f"""
SELECT table_name, coalesce(o.table_id, n.new_id + (SELECT max(event_min) FROM (
    SELECT min(event_id) AS event_min FROM events WHERE event_type IN ('click', 'view', 'error')
    GROUP BY user_id, event_type))) AS table_id,
  {", ".join(f"coalesce(n.{m}, o.{m}, false) AS {m}" for m in ALL_METRICS)}
FROM (
  SELECT 'lake.sum.u' || user_id || '_' || event_type AS table_name, min(event_id) AS table_id,
    {", ".join(f"(user_id + {i}) % 3 = 0 AS {m}" for i, m in enumerate(ALL_METRICS))}
  FROM events WHERE event_type IN ('click', 'view', 'error') GROUP BY user_id, event_type) o
FULL JOIN (
  SELECT *, (row_number() OVER (PARTITION BY bucket ORDER BY table_name) - 1) * 4096 + bucket + 1 AS new_id
  FROM (SELECT table_name, CAST('0x' || substr(md5('lake|sum|' || substr(table_name, 10)), 1, 3) AS BIGINT) AS bucket,
      {", ".join(f"bool_or(value) FILTER (metric = '{m}') AS {m}" for m in ALL_METRICS)}
    FROM metric_rows GROUP BY table_name)) n USING (table_name)""",
    "scored": f"""
SELECT *, stewardship + usability + freshness + validity + accuracy AS score FROM (SELECT table_name, {", ".join(
    "CAST(" + " + ".join(f"CASE WHEN {m} THEN {p} ELSE 0 END" for m, k, p in METRIC_POINTS if k == d) + f" AS INT) AS {d}"
    for d in DIMENSION_NAMES)} FROM summary)""",
    "matches": """
SELECT query_id, rank, doc_id, score FROM (
  SELECT query_id, doc_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank
  FROM (SELECT q.vec_id AS query_id, d.vec_id AS doc_id, round(list_cosine_similarity(
      CAST(q.embedding AS DOUBLE[]), CAST(d.embedding AS DOUBLE[])), 6) + 0.0 AS score
    FROM embeddings q, embeddings d WHERE d.vec_id IN (SELECT item_id FROM benchmark)))
WHERE rank <= 5""",
    "all_matches": """
SELECT query_id, rank, doc_id, score FROM (
  SELECT query_id, doc_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank
  FROM (SELECT q.vec_id AS query_id, d.vec_id AS doc_id, round(list_cosine_similarity(
      CAST(q.embedding AS DOUBLE[]), CAST(d.embedding AS DOUBLE[])), 6) + 0.0 AS score FROM embeddings q, embeddings d))
WHERE rank <= 5""",
    "contexts": """
SELECT query_id, string_agg('+check_syntax: ' || chr(10) || ' missing_count(c' || item_id || ') = 0' || chr(10)
    || 'check_description: ' || text || chr(10) || chr(10), '' ORDER BY rank) AS context
FROM matches JOIN benchmark ON doc_id = item_id GROUP BY query_id""",
    "last_turns": "SELECT conv_id, arg_max(text, turn) AS content, arg_max(role, turn) AS role, max(turn) AS turn FROM conversations GROUP BY conv_id",
    "checked_lineitem": "SELECT * REPLACE (nullif(l_quantity, 50) AS l_quantity) FROM lineitem",
}

_DEPENDS = {
    "user_freshness": ["user_history", "user_config"],
    "part_past": ["part_versions", "part_picked"],
    "part_compared": ["part_columns", "part_past"],
    "live": ["crm_columns"],
    "filled": ["crm_checks"],
    "kept": ["filled", "live"],
    "monitorable": ["all_tables"],
    "summary": ["metric_rows"],
    "scored": ["summary"],
    "contexts": ["matches"],
}


def _ordered(names: list[str], done: list[str]) -> list[str]:
    for name in names:
        _ordered(_DEPENDS.get(name, []), done)
        if name not in done:
            done.append(name)
    return done


def sql(name: str, frames: str, select: str) -> None:
    """Register the SQL of a query over some of the frames, extra ones given as ``name: sql``."""
    parts = [f"{f} AS ({FRAMES[f].strip()})" for f in _ordered(frames.split(), [])]
    head = f"WITH {', '.join(parts)} " if parts else ""
    ORACLE[name] = head + select.strip()


def _number(keys: str) -> str:
    """Number of a row: its place in a hash bucket of its key, and the bucket."""
    names = keys.split(", ")
    text = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in names)
    bucket = f"CAST('0x' || substr(md5(concat_ws('|', {text})), 1, 3) AS BIGINT)"
    order = ", ".join(f"{c} NULLS FIRST" for c in names)
    return f"(row_number() OVER (PARTITION BY {bucket} ORDER BY {order}) - 1) * 4096 + {bucket} + 1"


def numbered(rows: str, keys: str, after: str, id_column: str) -> str:
    """Rows with ids after ``after``, in hash buckets of their key."""
    return f"SELECT *, {after} + {_number(keys)} AS {id_column} FROM ({rows})"


# --- commit history -------------------------------------------------------------------------------

_TEXT = "strftime({}, '%Y-%m-%d %H:%M:%S')"

sql(
    "freshness",
    "user_freshness",
    f"SELECT table_name, freshness_window, {_TEXT.format('last_update')} AS last_update, is_fresh FROM user_freshness",
)
sql(
    "freshness_age_text",
    "user_freshness",
    """SELECT table_name, CASE WHEN age IS NOT NULL THEN
  CAST(floor(age / 86400) AS BIGINT) || 'd ' || (age - CAST(floor(age / 86400) AS BIGINT) * 86400) // 3600 || 'h '
  || (age - CAST(floor(age / 3600) AS BIGINT) * 3600) // 60 || 'm' END AS time_since_last_update FROM user_freshness""",
)
sql(
    "age_parts",
    "",
    """SELECT o_orderkey, CAST(floor(s / 86400) AS BIGINT) AS days,
  CAST(floor(s / 3600) - floor(s / 86400) * 24 AS BIGINT) AS hours,
  CAST(floor(s / 60) - floor(s / 3600) * 60 AS BIGINT) AS minutes
FROM (SELECT o_orderkey, (epoch_us(TIMESTAMP '1998-06-15 13:45:10') - epoch_us(o_orderdate)) / 1000000 AS s FROM orders)""",
)
sql(
    "parse_windows",
    "",
    """SELECT event_id, (user_id % 5) || 'd' || (event_id % 24) || 'h' || CASE WHEN value > 20 THEN '30m' ELSE 'x1d' END
  AS "window", (user_id % 5) * 86400 + (event_id % 24) * 3600 + CASE WHEN value > 20 THEN 1800 ELSE 86400 END AS seconds
FROM events""",
)
sql(
    "invalid_windows",
    "user_config",
    """SELECT table_name, 'half a day' AS freshness_window, validity_window FROM user_config
WHERE freshness_window = '12h'""",
)
sql(
    "latest_commit",
    "user_history",
    """SELECT table_name, strftime(moment, '%Y-%m-%d %H:%M:%S') AS "timestamp", job AS etl_job FROM (
  SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY moment DESC, version DESC) AS n FROM user_history) WHERE n = 1""",
)
sql(
    "asof_version",
    "user_history user_config",
    f"""SELECT table_name, {_TEXT.format('target')} AS target, version FROM (
  SELECT h.table_name, target, version, row_number() OVER (PARTITION BY h.table_name ORDER BY moment <= target DESC,
    CASE WHEN moment <= target THEN -epoch_us(moment) ELSE epoch_us(moment) END) AS n
  FROM user_history h JOIN (SELECT table_name,
    date_trunc('day', TIMESTAMP '{AS_OF}' - to_days(valid_days)) AS target FROM user_config) USING (table_name))
WHERE n = 1""",
)

# --- schema drift ---------------------------------------------------------------------------------

sql("past_columns", "part_past", "SELECT table_name, column_name, data_type FROM part_past")
_COUNTS = """count(*) FILTER (current_type IS NULL) AS n_missing_in_current,
  count(*) FILTER (past_type IS NULL) AS n_missing_in_past,
  count(*) FILTER (current_type <> past_type) AS n_type_changed"""
sql(
    "schema_drift",
    "part_compared",
    f"""SELECT table_name, n_missing_in_current + n_missing_in_past = 0 AS columns_match,
  n_type_changed = 0 AS datatypes_match, n_missing_in_current, n_missing_in_past, n_type_changed
FROM (SELECT table_name, {_COUNTS} FROM part_compared GROUP BY table_name)""",
)
sql(
    "drift_detail",
    "part_compared",
    """SELECT table_name, column_name, CASE WHEN current_type IS NULL THEN 'missing_in_current'
  WHEN past_type IS NULL THEN 'missing_in_past' ELSE 'type_changed' END AS kind, current_type, past_type
FROM part_compared WHERE current_type IS DISTINCT FROM past_type""",
)
sql(
    "drift_report",
    "part_compared",
    f"""SELECT table_name, n_missing_in_current + n_missing_in_past = 0 AS columns_match,
  n_type_changed = 0 AS datatypes_match, mismatched,
  CASE WHEN n_missing_in_current + n_missing_in_past > 0 THEN gone END AS missing_in_current,
  CASE WHEN n_missing_in_current + n_missing_in_past > 0 THEN added END AS missing_in_old
FROM (SELECT table_name, {_COUNTS},
  coalesce(string_agg(column_name || ':' || past_type || '>' || current_type, ', ' ORDER BY column_name)
    FILTER (current_type <> past_type), '') AS mismatched,
  coalesce(string_agg(column_name, ', ' ORDER BY column_name) FILTER (current_type IS NULL), '') AS gone,
  coalesce(string_agg(column_name, ', ' ORDER BY column_name) FILTER (past_type IS NULL), '') AS added
  FROM part_compared GROUP BY table_name)""",
)

# --- inventory ------------------------------------------------------------------------------------

sql(
    "column_names",
    "crm_columns",
    "SELECT table_name || '.' || column_name AS full_name, column_name AS base_name FROM crm_columns",
)
sql(
    "list_schemas",
    "all_schemas",
    "SELECT * FROM all_schemas WHERE schema_name NOT IN ('default', 'information_schema', 'data_quality', 'models')",
)
sql("list_tables", "monitorable", "SELECT * FROM monitorable")
sql(
    "table_detail",
    "user_tables",
    "SELECT table_name, id, description, created_at, last_modified FROM user_tables",
)
sql(
    "table_owners",
    "user_tables",
    """SELECT table_name, table_owner, description AS comment FROM user_tables
WHERE user_id IN (SELECT user_id FROM events WHERE event_type = 'purchase')""",
)
sql(
    "column_tags_grouped",
    "crm_columns crm_tags",
    """SELECT c.table_name, c.column_name, is_nullable, data_type, comment, coalesce(tags, '') AS tags
FROM crm_columns c LEFT JOIN (SELECT table_name, column_name,
  string_agg(tag_name || '=' || coalesce(tag_value, 'null'), ';' ORDER BY tag_name) AS tags
  FROM crm_tags GROUP BY ALL) t USING (table_name, column_name)""",
)
sql(
    "columns_by_table",
    "live crm_tags",
    """SELECT table_name, coalesce(string_agg(column_name || ' ' || n, ', ' ORDER BY column_name), '') AS columns
FROM (SELECT table_name FROM crm_columns UNION SELECT 'lake.crm.' || s_name FROM supplier)
LEFT JOIN (SELECT l.table_name, l.column_name, count(t.tag_name) AS n FROM live l
  LEFT JOIN crm_tags t USING (table_name, column_name) GROUP BY ALL) USING (table_name)
GROUP BY table_name""",
)
_PRIMARY = """SELECT table_name, column_name, tag_name, tag_value FROM (
  SELECT *, row_number() OVER (PARTITION BY table_name, column_name
    ORDER BY tag_name = 'has_low_cardinality' DESC, tag_name) AS n FROM crm_tags) WHERE n = 1"""
sql(
    "primary_tag",
    "crm_columns crm_tags",
    f"""SELECT table_name, column_name, tag_name, tag_value FROM crm_columns
LEFT JOIN ({_PRIMARY}) USING (table_name, column_name)""",
)
sql(
    "column_json_summary",
    "crm_columns crm_tags",
    f"""SELECT table_name, column_name, NOT bad AS is_json, CASE WHEN NOT bad THEN data_type END AS data_type,
  CASE WHEN NOT bad THEN comment END AS comment, CASE WHEN NOT bad THEN tag_name END AS tag_name,
  CASE WHEN NOT bad AND tag_name IS NOT NULL THEN coalesce(tag_value, '') END AS tag_value
FROM (SELECT *, coalesce(comment LIKE '%7', false) AS bad FROM crm_columns
  LEFT JOIN ({_PRIMARY}) USING (table_name, column_name))""",
)
_OWNER = "CASE WHEN user_id % 7 = 0 THEN NULL WHEN user_id % 11 = 0 THEN '' ELSE 'owner_' || user_id END"
sql(
    "table_properties_pivot",
    "",
    f"""SELECT DISTINCT 'lake.ev.u' || user_id AS table_name, {_OWNER} AS "Owner",
  CASE WHEN user_id % 3 = 0 THEN 'parquet' ELSE 'delta' END AS "Provider",
  CASE WHEN user_id % 5 <> 0 THEN 'true' END AS "Is_managed_location",
  CASE WHEN user_id % 2 = 0 THEN '[delta.logRetentionDuration=30 days]' ELSE '[k=v]' END AS table_properties,
  CAST(NULL AS VARCHAR) AS "Location" FROM events""",
)

# --- signals --------------------------------------------------------------------------------------

sql(
    "steward_signals",
    "user_tables user_history",
    f"""SELECT t.table_name, id, description, created_at, last_modified,
  coalesce(trim({_OWNER.replace("user_id", "t.user_id")}) <> '', false) AS has_a_valid_owner,
  t.user_id % 3 <> 0 AS is_delta_table, coalesce(trim(description) <> '', false) AS table_description,
  job IS NOT NULL AS uses_a_production_pipeline, t.user_id % 2 = 0 AS has_enforced_retention_duration,
  t.user_id % 5 <> 0 AS is_managed_location, any_check AS table_implement_checks, every_column AS all_columns_have_checks
FROM user_tables t
JOIN (SELECT table_name, arg_max(coalesce(job, ''), version) AS newest FROM user_history GROUP BY 1) USING (table_name)
JOIN (SELECT user_id, bool_or(checked) AS any_check, bool_and(checked) AS every_column FROM (
  SELECT user_id, event_type, bool_or(value > 20) AS checked FROM events GROUP BY ALL) GROUP BY 1) k ON k.user_id = t.user_id
CROSS JOIN LATERAL (SELECT nullif(newest, '') AS job)""",
)
sql(
    "columns_described",
    "crm_columns",
    """SELECT table_name, bool_and(coalesce(trim(comment) <> '', false)) AS columns_description
FROM crm_columns GROUP BY 1""",
)
sql(
    "check_coverage",
    "live filled",
    """SELECT table_name, bool_or(table_name IN (SELECT table_name FROM filled)) AS table_implement_checks,
  bool_and(column_name IN (SELECT column_name FROM filled)) AS all_columns_have_checks FROM live GROUP BY 1""",
)

# --- reconciliation -------------------------------------------------------------------------------

sql(
    "columns_with_checks",
    "filled",
    """SELECT table_name, string_agg(DISTINCT column_name, ', ' ORDER BY column_name) AS columns
FROM filled GROUP BY 1""",
)
_STALE = """SELECT check_id, 'blank' AS reason FROM crm_checks WHERE "check" IS NULL OR trim("check") = ''
UNION ALL SELECT check_id, 'orphaned' FROM filled f WHERE NOT EXISTS (
  SELECT 1 FROM live l WHERE l.table_name = f.table_name AND l.column_name = f.column_name)"""
_CHECK_FIELDS = 'table_name, check_id, column_name, "check", tag'
sql("stale_checks", "crm_checks filled live", _STALE)
sql("sync_checks", "kept", f"SELECT {_CHECK_FIELDS} FROM kept")
sql(
    "sync_checks_in_scope",
    "crm_checks filled live",
    f"""SELECT {_CHECK_FIELDS} FROM crm_checks WHERE NOT (check_id IN (SELECT check_id FROM ({_STALE}))
  AND table_name IN (SELECT table_name FROM crm_columns WHERE data_type = 'BUILDING'))""",
)
sql(
    "invalid_check_tags",
    "crm_tags filled",
    """SELECT table_name, column_name, tag_name FROM crm_tags
WHERE tag_name = 'has_check' AND column_name NOT IN (SELECT column_name FROM filled)""",
)
sql(
    "reconciled_tags",
    "crm_tags kept",
    """SELECT table_name, column_name, tag_name, tag_value FROM crm_tags WHERE tag_name <> 'has_check'
UNION ALL SELECT DISTINCT table_name, column_name, 'has_check', CAST(NULL AS VARCHAR) FROM kept""",
)
_PENDING = """SELECT * FROM crm_columns c WHERE NOT EXISTS (SELECT 1 FROM crm_tags t
  WHERE t.tag_name = 'has_check' AND t.column_name = c.column_name)"""
sql("pending_columns", "crm_columns crm_tags", f"SELECT table_name, column_name FROM ({_PENDING})")

# --- profile --------------------------------------------------------------------------------------


def _source(table: str) -> str:
    return "(SELECT * REPLACE (nullif(l_quantity, 50) AS l_quantity) FROM lineitem)" if table == "lineitem" else table


def _profile(source=lambda t: t) -> str:
    """Every column with its distinct values if there are at most ten."""
    return " UNION ALL ".join(
        f"""SELECT 'lake.main.{t}' AS table_name, '{c}' AS column_name, '{k}' AS data_type, n <= 10 AS low,
  CASE WHEN n <= 10 THEN (SELECT coalesce(list(DISTINCT CAST({c} AS VARCHAR) ORDER BY CAST({c} AS VARCHAR))
    FILTER ({c} IS NOT NULL), []) FROM {source(t)}) END AS vals, total, nulls
FROM (SELECT count(DISTINCT {c}) AS n, count(*) AS total, count(*) - count({c}) AS nulls FROM {source(t)})"""
        for t, c, k in COLUMNS
    )


_JOINED = "array_to_string(vals, ', ')"
sql(
    "low_cardinality",
    "",
    f"""SELECT table_name, column_name, data_type, low AS is_low_cardinality,
  CASE WHEN low THEN {_JOINED} END AS distinct_values FROM ({_profile()})""",
)
sql(
    "column_counts",
    "",
    f"SELECT table_name, column_name, total AS row_count, nulls AS null_count FROM ({_profile(_source)})",
)
sql(
    "profile_from_files",
    "",
    f"""SELECT table_name, column_name, data_type, low AS is_low_cardinality,
  CASE WHEN low THEN {_JOINED} END AS distinct_values, total AS row_count, nulls AS null_count FROM ({_profile()})""",
)
sql(
    "low_cardinality_tags",
    "",
    f"""WITH p AS ({_profile()})
SELECT table_name, column_name, 'has_low_cardinality' AS tag_name, {_JOINED} AS tag_value FROM p WHERE low
UNION ALL SELECT table_name, column_name, tag_name, tag_value FROM p,
  (VALUES ('has_check', NULL), ('has_comment', '')) held(tag_name, tag_value)
WHERE data_type = 'string' AND (NOT low OR {_JOINED} = 'F, O, P')""",
)
_KEY_VALUES = " UNION ALL ".join(
    f"SELECT DISTINCT 'lake.main.{t}' AS table_name, '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM {t} WHERE {c} IS NOT NULL"
    for t, c, _ in COLUMNS
    if c.endswith("key")
)
sql(
    "low_cardinality_values",
    "",
    f"""SELECT table_name, column_name, unnest(vals) AS value FROM ({_profile()})
WHERE low AND NOT ends_with(column_name, 'key') UNION ALL {_KEY_VALUES}""",
)
sql("column_values", "", "SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS value FROM orders")

# --- checks ---------------------------------------------------------------------------------------

sql(
    "parse_checks",
    "filled",
    """SELECT check_id, CAST(0 AS BIGINT) AS item,
  CASE o_orderstatus WHEN 'O' THEN 'invalid' ELSE 'missing' END || '_count(c' || o_custkey || ') = 0' AS check_name,
  CASE o_orderstatus WHEN 'O' THEN 'invalid_count' ELSE 'missing_count' END AS metric, 'c' || o_custkey AS argument,
  '=' AS comparator, CAST(0 AS BIGINT) AS threshold, CASE o_orderstatus WHEN 'O' THEN 'A, B' END AS valid_values,
  true AS readable FROM filled""",
)


def _documents(per_document: int) -> str:
    return f"""SELECT table_name, part, 'checks for ' || table_name || ':' || chr(10) || string_agg('  - '
    || regexp_replace(regexp_replace("check", '^\\s*(- )?', ''), '\\n\\s*', chr(10) || '      '), chr(10) ORDER BY check_id)
    AS yaml_content
FROM (SELECT *, CAST(floor(coalesce(sum(1) OVER (PARTITION BY table_name ORDER BY check_id // {per_document}
    RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / {per_document}) AS BIGINT) AS part FROM filled)
GROUP BY table_name, part"""


sql("render_checks", "filled", _documents(1000))
sql("render_checks_in_parts", "filled", _documents(2))


def _in_list(column: str, *values: str) -> str:
    return f"{column} IS NOT NULL AND {column} NOT IN ({', '.join(values)})"


#: Per declared check: its parts as (name, counted condition or none, comparison).
_EXPECTED = {
    1: [("missing_count(l_quantity) = 0", "l_quantity IS NULL", "= 0")],
    2: [("invalid_count(l_returnflag) = 0", _in_list("l_returnflag", "'A'", "'N'", "'R'"), "= 0")],
    3: [("invalid_count(l_linestatus) = 0", _in_list("l_linestatus", "'O'"), "= 0")],
    4: [("missing_count(o_orderkey) = 0", "o_orderkey IS NULL", "= 0")],
    5: [("invalid_count(o_orderstatus) <= 1000000000000", _in_list("o_orderstatus", "'F'", "'O'"), "<= 1000000000000")],
    6: [("invalid_count(o_orderpriority) = 0", "regexp_matches(o_orderpriority, '^1')", "= 0")],
    7: [("invalid_count(c_mktsegment) = 0",
         _in_list("c_mktsegment", "'AUTOMOBILE'", "'BUILDING'", "'FURNITURE'", "'HOUSEHOLD'", "'MACHINERY'"), "= 0")],
    8: [("invalid_count(c_name) = 0", "regexp_matches(c_name, '^X')", "= 0")],
    9: [("missing_count(c_custkey) = 0", "c_custkey IS NULL", "= 0"),
        ("missing_count(c_custkey) < 5", "c_custkey IS NULL", "< 5")],
    10: [("avg(value) > 0", None, None)],
    11: [("invalid_count(p_size) > 0", _in_list("p_size", "1", "2", "3"), "> 0")],
    12: [("invalid_count(toxic) = 0", _in_list("toxic", "0", "1"), "= 0")],
    13: [("invalid_count(text) = 0", "regexp_matches(text, '(?i)confidential')", "= 0")],
    14: [("missing_count(gone) = 0", None, None)],
}


def _check_rows() -> str:
    rows = []
    for number, table, _, text in DECLARED_CHECKS:
        definitions = text.strip().removeprefix("- ").split("\n- ")
        for (name, condition, comparison), definition in zip(_EXPECTED.get(number, []), definitions):
            literal = "'" + definition.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"
            value, passed = "CAST(NULL AS BIGINT)", "false"
            if condition:
                value = f"(SELECT count(*) FROM {_source(table)} WHERE {condition})"
                passed = f"{value} {comparison}"
            rows.append(
                f"SELECT 'lake.main.{table}' AS table_name, CAST({number} AS BIGINT) AS check_id, '{name}' AS check_name, "
                f"{passed} AS is_passed, {literal} AS check_definition, {value} AS n"
            )
    return " UNION ALL ".join(rows)


sql(
    "check_results",
    "",
    f"SELECT * EXCLUDE (n), CAST(n AS VARCHAR) AS failed_value_count FROM ({_check_rows()})",
)
sql(
    "check_results_per_order",
    "",
    """SELECT 'lake.main.orders' AS table_name, o_orderkey AS check_id,
  'invalid_count(o_orderkey) > ' || (o_orderkey % 7) AS check_name, n > o_orderkey % 7 AS is_passed,
  'invalid_count(o_orderkey) > ' || (o_orderkey % 7) || ':' || chr(10) || '  valid values: [' || o_orderkey || ']' AS check_definition,
  n AS failed_value_count
FROM (SELECT o_orderkey, count(*) OVER () - count(*) OVER (PARTITION BY o_orderkey) AS n FROM orders)""",
)
sql(
    "check_results_beside_failures",
    "",
    f"""SELECT table_name, check_id, check_name, is_passed, false AS failed FROM ({_check_rows()})
WHERE table_name NOT IN ('lake.main.orders', 'lake.main.labels')
UNION ALL SELECT 'lake.main.' || t, 0, '', false, true FROM (VALUES ('orders'), ('labels')) v(t)""",
)
sql(
    "check_rollup",
    "",
    f"""SELECT table_name, bool_and(is_passed) AS all_checks_passed, count(*) AS n_checks,
  count(*) FILTER (n IS NOT NULL AND NOT is_passed) AS n_failed, count(*) FILTER (n IS NULL) AS n_not_evaluated
FROM ({_check_rows()}) GROUP BY 1""",
)

# --- state ----------------------------------------------------------------------------------------

_CONFIG = f"{_NAME3} AS table_name, _id, low_cardinality_threshold, freshness_window, validity_window, tag"
_CONFIG_COLUMNS = (
    "catalog_name, schema_name, table_name, low_cardinality_threshold, freshness_window, validity_window, tag"
)
sql("config_latest", "config", f"SELECT {_CONFIG} FROM config")
_LAST_ID = "(SELECT max(_id) FROM config)"
_NEW_CONFIG = """SELECT 'lake' AS catalog_name, 'NATION_' || s_nationkey AS schema_name, s_name AS table_name,
  CASE WHEN s_acctbal > 5000 THEN 25 ELSE 10 END AS low_cardinality_threshold,
  CASE WHEN s_nationkey > 10 THEN '7d' ELSE '1d' END AS freshness_window, '1d' AS validity_window, 'seen' AS tag
FROM supplier WHERE s_acctbal > 5000 OR s_acctbal < 0"""
_KEYS = "catalog_name, schema_name, table_name"
sql(
    "config_upsert",
    "config",
    f"""SELECT {_CONFIG} FROM (
  SELECT _id, {_CONFIG_COLUMNS} FROM config WHERE table_name NOT IN (SELECT table_name FROM ({_NEW_CONFIG}))
  UNION ALL SELECT coalesce(c._id, n._id), n.* EXCLUDE (_id)
  FROM ({numbered(_NEW_CONFIG, _KEYS, _LAST_ID, "_id")}) n LEFT JOIN config c USING (table_name))""",
)
sql(
    "seed_config",
    "config all_schemas monitorable",
    f"SELECT {_CONFIG} FROM (SELECT _id, {_CONFIG_COLUMNS} FROM config UNION ALL "
    f"SELECT _id, {_CONFIG_COLUMNS} FROM ("
    + numbered(
        """SELECT DISTINCT catalog_name, schema_name, table_name, 10 AS low_cardinality_threshold,
  '1d' AS freshness_window, '1d' AS validity_window, CAST(NULL AS VARCHAR) AS tag
FROM monitorable m WHERE schema_name IN (SELECT schema_name FROM all_schemas) AND schema_name NOT IN ('default',
  'information_schema', 'data_quality', 'models', 'models_monitoring', 'analytics', 'curated', 'raw')
  AND NOT EXISTS (SELECT 1 FROM config c WHERE c.schema_name = m.schema_name AND c.table_name = m.table_name)""",
        _KEYS, _LAST_ID, "_id")
    + "))",
)
_LAST_CHECK = "(SELECT max(o_orderkey) FROM orders)"
_STORED = "SELECT table_name, check_id, column_name, \"check\", tag FROM crm_checks"
_FULL = f"{_NAME3} AS table_name, check_id, column_name, \"check\""
sql(
    "add_checks",
    "crm_checks changes",
    f"{_STORED} UNION ALL SELECT {_FULL}, NULL FROM ("
    + numbered("SELECT * FROM changes", 'catalog_name, schema_name, table_name, column_name, "check"', _LAST_CHECK, "check_id")
    + ")",
)
sql(
    "checks_upsert",
    "crm_checks changes",
    f"""SELECT c.table_name, c.check_id, c.column_name, CASE WHEN n.tag IS NOT NULL THEN n."check" ELSE c."check" END AS "check", c.tag
FROM crm_checks c LEFT JOIN changes n ON c.column_name = n.column_name AND c.tag = n.tag
UNION ALL SELECT {_FULL}, tag FROM ("""
    + numbered(
        """SELECT * FROM changes n WHERE NOT EXISTS (SELECT 1 FROM crm_checks c
  WHERE c.column_name = n.column_name AND c.tag = n.tag)""",
        'catalog_name, schema_name, table_name, column_name, tag', _LAST_CHECK, "check_id")
    + ")",
)
sql(
    "checks_update_by_id",
    "",
    """WITH crm_checks AS (""" + FRAMES["crm_checks"].replace("o_orderstatus\nFROM", "o_orderstatus, o_orderpriority\nFROM").strip() + """)
SELECT table_name, check_id, column_name,
  CASE WHEN o_orderstatus = 'P' AND o_orderpriority <> '1-URGENT' THEN 'missing_count(c' || o_custkey || ') < 7'
    ELSE "check" END AS "check",
  CASE WHEN o_orderstatus = 'P' AND o_orderpriority <> '1-URGENT' THEN 'reviewed' ELSE tag END AS tag FROM crm_checks""",
)
sql("drop_checks", "crm_checks", f"{_STORED} WHERE o_orderstatus <> 'P'")
sql(
    "kb_append",
    "",
    """SELECT CAST(item_id AS VARCHAR) AS check_id, 'missing_count(c' || item_id || ') = 0' AS check_syntax,
  text AS description FROM benchmark""",
)
sql("kb_from_csv", "", ORACLE["kb_append"])
sql("stored_tags", "crm_tags", "SELECT table_name, column_name, tag_name, tag_value FROM crm_tags")
_CHANGED_TAGS = "SELECT column_name FROM crm_columns WHERE is_nullable = 'NO' OR data_type = 'BUILDING'"
_OTHER_TAGS = f"""SELECT table_name, column_name, tag_name, tag_value FROM crm_tags
WHERE NOT (tag_name = 'has_low_cardinality' AND column_name IN ({_CHANGED_TAGS}))"""
sql(
    "tag_set",
    "crm_tags crm_columns",
    f"""{_OTHER_TAGS} UNION ALL SELECT table_name, column_name, 'has_low_cardinality', 'O''Brien, Smith'
FROM crm_columns WHERE column_name IN ({_CHANGED_TAGS})""",
)
sql("tag_unset", "crm_tags crm_columns", _OTHER_TAGS)
_NO_COMMENT = "comment IS NULL OR trim(comment) = ''"
sql(
    "comment_update",
    "crm_columns",
    f"""SELECT table_name, column_name, is_nullable, data_type, CASE WHEN {_NO_COMMENT}
  THEN 'say "x", \\ O''Brien ' || column_name ELSE comment END AS comment FROM crm_columns""",
)
sql(
    "comment_update_tags",
    "crm_columns crm_tags",
    f"""SELECT table_name, column_name, tag_name, tag_value FROM crm_tags WHERE NOT (tag_name = 'has_comment'
  AND column_name IN (SELECT column_name FROM crm_columns WHERE {_NO_COMMENT}))
UNION ALL SELECT table_name, column_name, 'has_comment', NULL FROM crm_columns WHERE {_NO_COMMENT}""",
)

# --- summary and score ----------------------------------------------------------------------------

sql(
    "summary_pivot",
    "metric_rows",
    "SELECT table_name, "
    + ", ".join(f"CAST(bool_or(value) FILTER (metric = '{m}') AS VARCHAR) AS {m}" for m in ALL_METRICS)
    + " FROM metric_rows GROUP BY table_name",
)
sql("summary_partial_upsert", "summary", f"SELECT table_name, table_id, {', '.join(ALL_METRICS)} FROM summary")
_BAND = "CASE WHEN score >= 65 THEN 'Good' WHEN score >= 45 THEN 'Okay' ELSE 'Poor' END"
sql("dimension_scores", "scored", f"SELECT *, {_BAND} AS band FROM scored")
sql(
    "band_counts",
    "scored",
    f"SELECT {_BAND} AS band, count(*) AS n_tables, CAST(sum(score) AS BIGINT) AS points FROM scored GROUP BY 1",
)

# --- retrieval and drafting -----------------------------------------------------------------------

sql("similar_topk", "all_matches", "SELECT * FROM all_matches")
sql("similar_topk_in_blocks", "all_matches", "SELECT * FROM all_matches")
sql("similar_topk_indexed", "all_matches", "SELECT * FROM all_matches")
sql(
    "retrieved_documents",
    "matches",
    """SELECT m.*, 'missing_count(c' || item_id || ') = 0' AS check_syntax, text AS description
FROM matches m JOIN benchmark ON doc_id = item_id""",
)
sql("retrieval_context", "contexts", "SELECT * FROM contexts")
sql("last_message", "last_turns", "SELECT conv_id, content FROM last_turns")
sql(
    "message_comment",
    "last_turns",
    "SELECT conv_id, CASE WHEN turn % 2 = 0 THEN content END AS comment FROM last_turns",
)
_QUOTED = """array_to_string(list_transform(vals, lambda v: '"' || replace(replace(replace(v, '\\', '\\\\'), '"', '\\"'),
  chr(10), '\\n') || '"'), ', ')"""
_COMPLETE, _CLOSED = "nulls = 0 AND total > 0", "low AND len(vals) > 0"
sql(
    "suggest_checks",
    "",
    f"""SELECT table_name, column_name, concat_ws(chr(10),
  CASE WHEN {_COMPLETE} THEN '  - missing_count(' || column_name || ') = 0' END,
  CASE WHEN {_CLOSED} THEN '  - invalid_count(' || column_name || ') = 0:' || chr(10) || '      valid values: ['
    || {_QUOTED} || ']' END) AS "check", 'ai_generated' AS tag
FROM ({_profile(_source)}) WHERE {_COMPLETE} OR {_CLOSED}""",
)
sql(
    "suggested_check_results",
    "",
    f"""WITH p AS ({_profile(_source)})
SELECT table_name, column_name, CAST(0 AS BIGINT) AS item, 'missing_count' AS metric, CAST(0 AS BIGINT) AS value,
  'pass' AS outcome FROM p WHERE {_COMPLETE}
UNION ALL SELECT table_name, column_name, CASE WHEN {_COMPLETE} THEN 1 ELSE 0 END, 'invalid_count', 0, 'pass'
FROM p WHERE {_CLOSED}""",
)
sql(
    "draft_descriptions",
    "",
    f"""SELECT table_name, column_name, CASE WHEN data_type <> 'double' THEN 'about ' || column_name
    ELSE upper(substr(column_name, 1, 1)) || substr(replace(column_name, '_', ' '), 2) || ' (double, may be empty)' END
  || CASE WHEN {_CLOSED} THEN '. Valid values: ' || {_JOINED} ELSE '' END || '.' AS comment FROM ({_profile()})""",
)
_RECORD = """'{"column_name":"' || p.column_name || '","is_nullable":"' || is_nullable || '","data_type":"' || data_type
  || '","comment":' || coalesce('"' || comment || '"', 'null') || ',"tag_names":[' || coalesce(names, '')
  || '],"tag_values":[' || coalesce(vals, '') || ']}' AS "user\""""
_TAG_LISTS = """SELECT table_name, column_name, string_agg('"' || tag_name || '"', ',' ORDER BY tag_name) AS names,
  string_agg('"' || coalesce(tag_value, '') || '"', ',' ORDER BY tag_name) AS vals FROM crm_tags GROUP BY ALL"""
sql(
    "build_prompts",
    "crm_columns crm_tags contexts",
    f"""SELECT p.table_name, p.column_name, coalesce(context, '') AS system, {_RECORD}
FROM ({_PENDING}) p LEFT JOIN contexts ON p.column_name = 'c' || query_id
LEFT JOIN ({_TAG_LISTS}) t USING (table_name, column_name)""",
)
sql(
    "build_description_prompts",
    "crm_columns crm_tags",
    f"""SELECT p.table_name, p.column_name, '' AS system, {_RECORD}
FROM ({_PENDING.replace("has_check", "has_comment")}) p LEFT JOIN ({_TAG_LISTS}) t USING (table_name, column_name)""",
)

# --- whole runs -----------------------------------------------------------------------------------


def _scoreboard(described: str, implemented: str, covered: str, passed: str) -> str:
    """Scores of the test tables; the arguments are conditions on ``t``, the table's short name."""
    metrics = {
        "table_description": "t NOT IN ('pages', 'labels')",
        "columns_description": described,
        "has_a_valid_owner": "true",
        "is_delta_table": "t IN ('orders', 'events')",
        "uses_a_production_pipeline": "t IN ('orders', 'events')",
        "has_enforced_retention_duration": "t = 'orders'",
        "is_managed_location": "t = 'orders'",
        "is_fresh": f"""CASE t WHEN 'orders' THEN (SELECT max(o_orderdate) FROM orders) > TIMESTAMP '{AS_OF}' - to_days(10000)
      WHEN 'events' THEN date_trunc('hour', (SELECT max(ts) FROM events)) > TIMESTAMP '{AS_OF}' - to_days(1)
      WHEN 'lineitem' THEN (SELECT max(l_shipdate) FROM lineitem) > TIMESTAMP '{AS_OF}' - to_days(1) ELSE false END""",
        "columns_valid": "t IN ('orders', 'events')",
        "columns_datatype_valid": "t IN ('orders', 'lineitem')",
        "table_implement_checks": implemented,
        "all_columns_have_checks": covered,
        "has_check_passed": passed,
    }
    summary = ", ".join(f"coalesce({metrics[m]}, false) AS {m}" for m in ALL_METRICS)
    tables = ", ".join(f"('{t}')" for t in TEST_TABLES)
    return f"""WITH checked AS ({_check_rows()}), profile AS ({_profile(_source)}),
summary AS (SELECT 'lake.main.' || t AS table_name, {summary} FROM (VALUES {tables}) names(t)),
scored AS ({FRAMES["scored"].strip()})
SELECT *, {_BAND} AS band FROM scored"""


_PASSED = "(SELECT bool_and(is_passed) FROM checked WHERE table_name = 'lake.main.' || t)"
sql(
    "scoreboard",
    "",
    _scoreboard(
        "(SELECT bool_and(data_type <> 'double') FROM profile WHERE table_name = 'lake.main.' || t)",
        "EXISTS (SELECT 1 FROM checked WHERE table_name = 'lake.main.' || t)",
        "false",
        _PASSED,
    ),
)
_SUGGESTED = f"({_COMPLETE} OR {_CLOSED})"
_DECLARED = ", ".join(f"'{c}'" for _, _, c, text in DECLARED_CHECKS if text.strip() and c != "gone")
sql(
    "scoreboard_after_enrichment",
    "",
    _scoreboard(
        "true",
        "true",
        f"(SELECT bool_and({_SUGGESTED} OR column_name IN ({_DECLARED})) FROM profile WHERE table_name = 'lake.main.' || t)",
        f"coalesce({_PASSED}, true)",
    ),
)

# --- several changes of one key: the last counts ---------------------------------------------------

for _name in ("config_upsert", "checks_update_by_id", "comment_update"):
    ORACLE[f"{_name}_in_order"] = ORACLE[_name]
