"""One query per operator, over the frames of ``workload.frames``."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablegrade.functions import expressions as X
from tablegrade.operators import (
    checks as C,
    drift as D,
    history as H,
    inventory as I,
    metric_index as V,
    profile as P,
    reconcile as R,
    retrieval as T,
    score as S,
    signals as G,
    state as K,
    suggest as U,
)
from tablegrade.operators.profile_state import counts_of, profile_of, update_file_profile
from tablegrade.plans import stages
from tablegrade.schemas import (
    COLUMN_CHECKS,
    COLUMN_KEYS,
    COLUMN_TAGS,
    DQ_SUMMARY,
    METRICS,
    TABLE_KEYS,
    TAG_CHECK,
    TAG_COMMENT,
)
from tablegrade.sources.catalog import columns_of
from tablegrade.sources.local import local_frame
from tablegrade.sources.knowledge_base import append_knowledge, read_knowledge_base
from tablegrade.sources.state_files import read_state, shared_folder, stored_once, write_state
from workload import frames as W

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def flat(frame: DataFrame) -> DataFrame:
    """The three name parts as one dotted ``table_name``, timestamps as text."""
    rest = []
    for field in frame.schema:
        if field.name in TABLE_KEYS:
            continue
        column = F.col(f"`{field.name}`")
        if field.dataType.typeName() == "timestamp_ntz":
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(field.name)
        rest.append(column)
    return frame.select(X.full_name().alias("table_name"), *rest)


def listed(values: str | Column) -> Column:
    return F.array_join(values, ", ")


# --- commit history -------------------------------------------------------------------------------


@query
def freshness(spark, folder):
    found = H.freshness(W.user_history(spark, folder), W.user_config(spark, folder), W.AS_OF)
    return flat(found.drop("age_seconds", "time_since_last_update"))


@query
def freshness_age_text(spark, folder):
    found = H.freshness(W.user_history(spark, folder), W.user_config(spark, folder), W.AS_OF)
    return flat(found.select(*TABLE_KEYS, "time_since_last_update"))


@query
def age_parts(spark, folder):
    """Ages of all orders at a moment in the middle of them, so that some are negative."""
    age = X.seconds_between(F.col("o_orderdate"), X.instant("1998-06-15 13:45:10"))
    parts = X.age_parts(age)
    return W.read(spark, folder, "orders").select(
        "o_orderkey", *(parts[p].alias(p) for p in ("days", "hours", "minutes"))
    )


@query
def parse_windows(spark, folder):
    text = F.expr(
        "concat(user_id % 5, 'd', event_id % 24, 'h', case when value > 20 then '30m' else 'x1d' end)"
    )
    return W.read(spark, folder, "events").select(
        "event_id", text.alias("window"), X.window_seconds(text).alias("seconds")
    )


@query
def invalid_windows(spark, folder):
    config = W.user_config(spark, folder).withColumn(
        "freshness_window",
        F.expr("case when freshness_window = '12h' then 'half a day' else freshness_window end"),
    )
    return flat(H.invalid_windows(config))


@query
def latest_commit(spark, folder):
    return flat(H.latest_commit(W.user_history(spark, folder)))


@query
def asof_version(spark, folder):
    targets = W.user_config(spark, folder).select(
        *TABLE_KEYS, H.comparison_day(W.AS_OF, "validity_window").alias("target")
    )
    return flat(H.version_as_of_day(W.user_history(spark, folder), targets))


# --- schema drift ---------------------------------------------------------------------------------


def _past(spark, folder):
    return D.past_columns(
        W.part_history(spark, folder),
        W.part_versions(spark, folder),
        W.part_config(spark, folder),
        W.AS_OF,
    )


@query
def past_columns(spark, folder):
    return flat(_past(spark, folder))


@query
def schema_drift(spark, folder):
    return flat(D.schema_drift(W.part_columns(spark, folder), _past(spark, folder)))


@query
def drift_detail(spark, folder):
    return flat(D.drift_detail(W.part_columns(spark, folder), _past(spark, folder)))


@query
def drift_report(spark, folder):
    report = D.drift_report(W.part_columns(spark, folder), _past(spark, folder))
    changed = F.transform(
        F.array_sort(F.map_entries("mismatched_datatypes")),
        lambda e: F.concat(
            e["key"], F.lit(":"), e["value"]["versioned"], F.lit(">"), e["value"]["current"]
        ),
    )
    return flat(
        report.select(
            *TABLE_KEYS,
            "columns_match",
            "datatypes_match",
            listed(changed).alias("mismatched"),
            listed("col_missing_in_current_table").alias("missing_in_current"),
            listed("col_missing_in_old_table").alias("missing_in_old"),
        )
    )


# --- inventory ------------------------------------------------------------------------------------


@query
def column_names(spark, folder):
    """Full and base names of all columns."""
    full = X.full_name(*COLUMN_KEYS)
    return W.crm_columns(spark, folder).select(
        full.alias("full_name"), X.base_name(full).alias("base_name")
    )


@query
def list_schemas(spark, folder):
    return I.list_schemas(W.all_schemas(spark, folder), ["models"])


@query
def list_tables(spark, folder):
    return I.list_tables(W.all_tables(spark, folder))


@query
def table_detail(spark, folder):
    return flat(I.table_detail(W.user_tables(spark, folder)).drop("name"))


@query
def table_owners(spark, folder):
    """Owners of the tables with a purchase among their commits."""
    scope = W.user_history(spark, folder).where("operation = 'MERGE'").select(*TABLE_KEYS)
    return flat(I.table_owners(W.user_tables(spark, folder), scope))


def _tag_text(tags):
    return F.array_join(
        F.transform(tags, lambda t: F.concat(t["tag_name"], F.lit("="), F.coalesce(t["tag_value"], F.lit("null")))),
        ";",
    )


def _column_metadata(spark, folder):
    return I.column_metadata(W.crm_columns(spark, folder), W.crm_tags(spark, folder))


@query
def column_tags_grouped(spark, folder):
    found = _column_metadata(spark, folder)
    return flat(found.withColumn("tags", _tag_text(F.col("tags"))))


@query
def columns_by_table(spark, folder):
    """Columns still live, of every customer table and of one table per supplier that has none."""
    requested = W.crm_columns(spark, folder).select(*TABLE_KEYS).unionByName(
        W.read(spark, folder, "supplier").select(*W.table("lake", "crm", "s_name"))
    )
    metadata = I.column_metadata(W.crm_live_columns(spark, folder), W.crm_tags(spark, folder))
    found = I.columns_by_table(requested, metadata)
    names = F.transform("columns", lambda c: F.concat(c["column_name"], F.lit(" "), F.size(c["tags"])))
    return flat(found.withColumn("columns", listed(names)))


@query
def primary_tag(spark, folder):
    tag = X.primary_tag(F.col("tags"))
    return flat(
        _column_metadata(spark, folder).select(
            *COLUMN_KEYS, tag["tag_name"].alias("tag_name"), tag["tag_value"].alias("tag_value")
        )
    )


@query
def column_json_summary(spark, folder):
    """Column records as JSON and back; the text of every seventh nation's columns is cut short."""
    record = U.column_record(F.col("tags"))
    summary = X.summarise_column_json(
        F.when(F.col("comment").endswith("7"), F.concat(F.lit("x"), record)).otherwise(record)
    )
    fields = ("data_type", "comment", "tag_name", "tag_value")
    return flat(
        _column_metadata(spark, folder)
        .select(*COLUMN_KEYS, summary.alias("summary"))
        .select(*COLUMN_KEYS, F.expr("summary is not null").alias("is_json"), *(f"summary.{f}" for f in fields))
    )


@query
def table_properties_pivot(spark, folder):
    keys = ["Owner", "Provider", "Is_managed_location", "Table Properties", "Location"]
    return flat(G.pivot_properties(W.user_properties(spark, folder), keys)).withColumnRenamed(
        "Table Properties", "table_properties"
    )


# --- signals --------------------------------------------------------------------------------------


@query
def steward_signals(spark, folder):
    found = G.steward_signals(
        W.user_tables(spark, folder),
        W.user_properties(spark, folder),
        W.user_history(spark, folder),
        W.user_columns(spark, folder),
        W.user_checks(spark, folder),
    )
    return flat(found.drop("name"))


@query
def columns_described(spark, folder):
    return flat(G.columns_described(W.crm_columns(spark, folder)))


@query
def check_coverage(spark, folder):
    return flat(G.check_coverage(W.crm_live_columns(spark, folder), W.crm_checks(spark, folder)))


# --- reconciliation -------------------------------------------------------------------------------


@query
def columns_with_checks(spark, folder):
    found = R.columns_with_checks(W.crm_checks(spark, folder))
    return found.withColumn("columns", listed("columns"))


@query
def stale_checks(spark, folder):
    return R.stale_checks(W.crm_checks(spark, folder), W.crm_live_columns(spark, folder))


@query
def sync_checks(spark, folder):
    return flat(R.sync_checks(W.crm_checks(spark, folder), W.crm_live_columns(spark, folder)))


def _urgent_scope(spark, folder):
    return W.crm_columns(spark, folder).where("data_type = 'BUILDING'").select(*TABLE_KEYS)


@query
def sync_checks_in_scope(spark, folder):
    """Stale checks dropped only for the tables with a column of one segment."""
    return flat(
        R.sync_checks(
            W.crm_checks(spark, folder),
            W.crm_live_columns(spark, folder),
            _urgent_scope(spark, folder),
        )
    )


@query
def invalid_check_tags(spark, folder):
    return flat(R.invalid_check_tags(W.crm_tags(spark, folder), W.crm_checks(spark, folder)))


@query
def reconciled_tags(spark, folder):
    _, tags = R.reconcile_check_tags(
        W.crm_tags(spark, folder), W.crm_checks(spark, folder), W.crm_live_columns(spark, folder)
    )
    return flat(tags)


@query
def pending_columns(spark, folder):
    found = R.pending_columns(W.crm_columns(spark, folder), W.crm_tags(spark, folder), TAG_CHECK)
    return flat(found.select(*COLUMN_KEYS))


# --- profile --------------------------------------------------------------------------------------


def _profile(spark, folder):
    return P.low_cardinality(spark, W.monitored(spark, folder))


@query
def low_cardinality(spark, folder):
    return flat(P.with_value_text(_profile(spark, folder)))


@query
def column_counts(spark, folder):
    return flat(P.column_counts(W.checked_tables(spark, folder)))


@query
def profile_from_files(spark, folder):
    """Profile and counts of all columns from a kept state; every second table's files were read in an earlier run."""
    tables = W.monitored(spark, folder)
    earlier = update_file_profile(spark, dict(list(tables.items())[::2]))
    state = stored_once(update_file_profile(spark, tables, state=stored_once(earlier)))
    return flat(P.with_value_text(profile_of(state)).join(counts_of(state), COLUMN_KEYS))


def _main_tags(spark, folder):
    """Tags from before: every text column has all three, with an outdated list of values."""
    columns = columns_of(spark, W.monitored(spark, folder)).where("data_type = 'string'")
    names = "inline(array(named_struct('tag_name', 'has_check', 'tag_value', cast(null as string)), "
    names += "named_struct('tag_name', 'has_comment', 'tag_value', ''), "
    names += "named_struct('tag_name', 'has_low_cardinality', 'tag_value', 'F, O, P')))"
    return columns.selectExpr(*COLUMN_KEYS, names)


@query
def low_cardinality_tags(spark, folder):
    """Tags after a profile that looks again at tagged columns."""
    tags = _main_tags(spark, folder)
    tables = W.monitored(spark, folder)
    profile = stored_once(P.low_cardinality(spark, tables, tags=tags, recheck_tagged=True))
    return flat(P.update_low_cardinality_tags(profile, tags))


@query
def low_cardinality_values(spark, folder):
    """All values of the columns that are low, and of all key columns, which are tagged from before."""
    tables = W.monitored(spark, folder)
    keys = columns_of(spark, tables).where("column_name like '%key'").select(*COLUMN_KEYS)
    tags = keys.withColumns({"tag_name": F.lit("has_low_cardinality"), "tag_value": F.lit("1, 2")})
    return flat(P.low_cardinality_values(spark, tables, tags=tags))


@query
def column_values(spark, folder):
    """Distinct values of a column too varied to be listed, as rows."""
    return P.column_values(W.read(spark, folder, "orders"), "o_custkey")


# --- checks ---------------------------------------------------------------------------------------


@query
def parse_checks(spark, folder):
    parsed = C.parse_checks(W.crm_checks(spark, folder))
    return parsed.select(
        "check_id",
        F.col("item").cast("bigint").alias("item"),
        "check_name",
        "metric",
        "argument",
        "comparator",
        "threshold",
        listed("valid_values").alias("valid_values"),
        "readable",
    )


@query
def render_checks(spark, folder):
    return flat(C.render_checks(W.crm_checks(spark, folder)))


@query
def render_checks_in_parts(spark, folder):
    """Documents kept to about two checks, so that most tables need several."""
    return flat(C.render_checks(W.crm_checks(spark, folder), per_document=2))


def _results(spark, folder):
    return C.evaluate_checks(spark, W.declared_checks(spark), W.checked_tables(spark, folder))


@query
def check_results(spark, folder):
    found = C.check_summaries(_results(spark, folder))
    return found.withColumn("failed_value_count", F.col("failed_value_count").cast("string"))


@query
def check_results_per_order(spark, folder):
    """One check for every order, all on one column."""
    results = C.evaluate_checks(spark, W.order_checks(spark, folder), W.checked_tables(spark, folder))
    return C.check_summaries(results)


@query
def check_results_beside_failures(spark, folder):
    """The declared checks while two tables cannot be read: the others are evaluated, the two are named."""
    tables = W.checked_tables(spark, folder)
    for name, column in (("orders", "o_orderkey"), ("labels", "toxic")):
        broken = F.expr(f"if(isnull({column}), {column}, raise_error('unreadable file'))")
        tables[f"lake.main.{name}"] = tables[f"lake.main.{name}"].withColumn(column, broken)
    failures: list[stages.Failure] = []
    run = lambda some: C.evaluate_checks(spark, W.declared_checks(spark), some)
    found = C.check_summaries(stages.in_batches(tables, run, failures, "checks"))
    failed = stages.failure_rows(spark, failures)
    named = F.col("error").contains("unreadable file")
    none = F.lit(0).cast("bigint").alias("check_id"), F.lit("").alias("check_name"), F.lit(False).alias("is_passed")
    failed = failed.select(X.full_name().alias("table_name"), *none, named.alias("failed"))
    done = found.select("table_name", "check_id", "check_name", "is_passed", F.lit(False).alias("failed"))
    return done.unionByName(failed)


@query
def check_rollup(spark, folder):
    return flat(C.check_rollup(_results(spark, folder)))


# --- state ----------------------------------------------------------------------------------------


@query
def config_latest(spark, folder):
    return flat(K.latest_config(W.stored_config(spark, folder)))


@query
def config_upsert(spark, folder):
    stored = K.latest_config(W.stored_config(spark, folder))
    return flat(K.upsert_config(stored, W.config_changes(spark, folder)))


def _twice(changes, **stale):
    """Each change twice, and an earlier one with stale values before it."""
    last = changes.withColumn("change_number", F.lit(2))
    first = changes.withColumns({c: F.lit(v) for c, v in stale.items()}).withColumn("change_number", F.lit(1))
    return last.unionByName(first).unionByName(last)


@query
def config_upsert_in_order(spark, folder):
    """Several changes for each table, of which the last counts."""
    stored = K.latest_config(W.stored_config(spark, folder))
    return flat(K.upsert_config(stored, _twice(W.config_changes(spark, folder), tag="stale")))


@query
def seed_config(spark, folder):
    stored = K.latest_config(W.stored_config(spark, folder))
    return flat(stages.seed(stored, W.all_schemas(spark, folder), W.all_tables(spark, folder)))


@query
def add_checks(spark, folder):
    return flat(K.add_checks(W.crm_checks(spark, folder), W.crm_check_changes(spark, folder)))


@query
def checks_upsert(spark, folder):
    return flat(K.upsert_checks(W.crm_checks(spark, folder), W.crm_check_changes(spark, folder)))


@query
def checks_update_by_id(spark, folder):
    return flat(
        K.update_checks_by_id(W.crm_checks(spark, folder), W.crm_checks_by_id(spark, folder))
    )


@query
def checks_update_by_id_in_order(spark, folder):
    """Several changes for each check, of which the last counts."""
    changes = _twice(W.crm_checks_by_id(spark, folder), check="stale", tag="stale")
    return flat(K.update_checks_by_id(W.crm_checks(spark, folder), changes))


@query
def drop_checks(spark, folder):
    """All checks but those of partial orders."""
    gone = W.crm_checks_by_id(spark, folder).select("check_id")
    return flat(K.drop_checks(W.crm_checks(spark, folder), gone))


@query
def kb_append(spark, folder):
    """The reference checks loaded into a knowledge base that holds those of short texts already."""
    rows = W.reference_checks(spark, folder)
    return append_knowledge(rows.where("length(description) < 150"), rows)


@query
def kb_from_csv(spark, folder):
    """The reference checks written as CSV and read back; their texts hold line breaks and commas."""
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    rows = W.reference_checks(spark, folder)
    rows.write.option("header", True).option("escape", '"').csv(path)
    return read_knowledge_base(spark, path)


@query
def stored_tags(spark, folder):
    """Column tags stored as the state of a run and read by the next one."""
    root = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    write_state(W.crm_tags(spark, folder), root, "column_tags", "1")
    return flat(read_state(spark, root, "column_tags", "1"))


def _tag_changes(spark, folder):
    return (
        W.crm_columns(spark, folder)
        .where("is_nullable = 'NO' or data_type = 'BUILDING'")
        .select(
            *COLUMN_KEYS,
            F.lit("has_low_cardinality").alias("tag_name"),
            F.lit("O'Brien, Smith").alias("tag_value"),
        )
    )


@query
def tag_set(spark, folder):
    return flat(K.set_tags(W.crm_tags(spark, folder), _tag_changes(spark, folder)))


@query
def tag_unset(spark, folder):
    return flat(K.unset_tags(W.crm_tags(spark, folder), _tag_changes(spark, folder)))


def _comments(spark, folder):
    return (
        W.crm_columns(spark, folder)
        .where("comment is null or trim(comment) = ''")
        .select(*COLUMN_KEYS, F.concat(F.lit('say "x", \\ O\'Brien '), "column_name").alias("comment"))
    )


@query
def comment_update(spark, folder):
    columns, _ = K.set_comments(
        W.crm_columns(spark, folder), W.crm_tags(spark, folder), _comments(spark, folder)
    )
    return flat(columns)


@query
def comment_update_in_order(spark, folder):
    """Several comments for each column, of which the last counts."""
    changes = _twice(_comments(spark, folder), comment="stale")
    columns, _ = K.set_comments(W.crm_columns(spark, folder), W.crm_tags(spark, folder), changes)
    return flat(columns)


@query
def comment_update_tags(spark, folder):
    _, tags = K.set_comments(
        W.crm_columns(spark, folder), W.crm_tags(spark, folder), _comments(spark, folder)
    )
    return flat(tags)


# --- summary and score ----------------------------------------------------------------------------


@query
def summary_pivot(spark, folder):
    found = S.pivot_metrics(W.user_metric_rows(spark, folder))
    return flat(found.select(*TABLE_KEYS, *(F.col(m).cast("string").alias(m) for m in METRICS)))


def _summary(spark, folder):
    return S.upsert_summary(W.stored_summary(spark, folder), W.user_metric_rows(spark, folder))


@query
def summary_partial_upsert(spark, folder):
    return flat(_summary(spark, folder))


@query
def dimension_scores(spark, folder):
    return flat(S.score_tables(_summary(spark, folder)))


@query
def band_counts(spark, folder):
    scored = S.score_tables(_summary(spark, folder))
    return scored.groupBy("band").agg(F.count("*").alias("n_tables"), F.sum("score").alias("points"))


# --- retrieval and drafting -----------------------------------------------------------------------


@query
def similar_topk(spark, folder):
    return T.top_k_similar(W.vector_queries(spark, folder), W.all_vectors(spark, folder))


@query
def similar_topk_in_blocks(spark, folder):
    """The same with nothing broadcast, as for a document set of any size."""
    return T.top_k_similar(
        W.vector_queries(spark, folder),
        W.all_vectors(spark, folder),
        broadcast_bytes=0,
        block_rows=512,
    )


@query
def similar_topk_indexed(spark, folder):
    """The same over an index of rings around pivots, of which each query opens those that can hold its best."""
    documents = W.all_vectors(spark, folder)
    index = V.build_index(documents, pivots=16, block_rows=128)
    return V.search(W.vector_queries(spark, folder), index, documents)


@query
def retrieved_documents(spark, folder):
    """The reference checks that are nearest to each vector, with their texts."""
    found = T.top_k_similar(W.vector_queries(spark, folder), W.vector_documents(spark, folder))
    return T.documents_of(found, W.reference_checks(spark, folder))


@query
def retrieval_context(spark, folder):
    return T.format_context(retrieved_documents(spark, folder))


@query
def last_message(spark, folder):
    return T.last_messages(W.read(spark, folder, "conversations"))


@query
def message_comment(spark, folder):
    """The comment field of last messages that hold a column record, and of those that do not."""
    record = F.to_json(F.struct(F.col("role").alias("column_name"), F.col("text").alias("comment")))
    turns = W.read(spark, folder, "conversations").withColumn(
        "text", F.when(F.col("turn") % 2 == 0, record).otherwise(F.col("text"))
    )
    return T.last_messages(turns).select(
        "conv_id", T.comment_of(F.col("content")).alias("comment")
    )


@query
def suggest_checks(spark, folder):
    counts = P.column_counts(W.checked_tables(spark, folder))
    profile = P.low_cardinality(spark, W.checked_tables(spark, folder))
    return flat(U.suggest_checks(profile, counts))


@query
def suggested_check_results(spark, folder):
    """Checks drafted from the data, run on the data: each of them holds."""
    tables = W.checked_tables(spark, folder)
    drafts = U.suggest_checks(P.low_cardinality(spark, tables), P.column_counts(tables))
    stored = stored_once(K.upsert_checks(local_frame(spark, [], COLUMN_CHECKS), drafts))
    return flat(
        C.evaluate_checks(spark, stored, tables).select(
            *COLUMN_KEYS, F.col("item").cast("bigint").alias("item"), "metric", "value", "outcome"
        )
    )


@query
def draft_descriptions(spark, folder):
    return flat(U.draft_descriptions(W.main_columns(spark, folder), _profile(spark, folder)))


@query
def build_prompts(spark, folder):
    """Prompts for the columns without a check, each with the context of its customer's vector."""
    pending = R.pending_columns(
        W.crm_columns(spark, folder), W.crm_tags(spark, folder), TAG_CHECK
    )
    columns = I.column_metadata(pending, W.crm_tags(spark, folder))
    contexts = retrieval_context(spark, folder).select(
        *W.table("lake", "crm", "concat('t', query_id div 5)"),
        F.expr("concat('c', query_id)").alias("column_name"),
        "context",
    )
    found = U.build_prompts(columns, contexts, U.CHECK_PROMPT)
    # The fixed part of the template is left out of the comparison.
    return flat(
        found.withColumn("system", F.regexp_replace("system", r"(?s)^.*?\n\nContext: ", ""))
    )


@query
def build_description_prompts(spark, folder):
    """Prompts for the columns without a comment tag; these have no context."""
    tags = W.crm_tags(spark, folder)
    pending = R.pending_columns(W.crm_columns(spark, folder), tags, TAG_COMMENT)
    found = U.build_prompts(I.column_metadata(pending, tags), None, U.DESCRIPTION_PROMPT)
    return flat(found.withColumn("system", F.substring_index("system", "Context: ", -1)))


# --- whole runs -----------------------------------------------------------------------------------


def _facts(spark, folder) -> stages.TableFacts:
    """What a catalog would know; the history is drawn from the data by one scan of its dates."""
    history = stored_once(W.main_history(spark, folder))
    return stages.TableFacts(
        W.main_tables(spark),
        W.main_properties(spark),
        history,
        W.main_versions(spark, folder, history),
    )


@query
def scoreboard(spark, folder):
    """Score and band of all test tables, with checks run on their data."""
    state = stages.ColumnState(
        W.main_columns(spark, folder),
        local_frame(spark, [], COLUMN_TAGS),
        W.declared_checks(spark),
    )
    summary = stages.grade(
        spark,
        W.checked_tables(spark, folder),
        W.main_config(spark),
        _facts(spark, folder),
        state,
        local_frame(spark, [], DQ_SUMMARY),
        W.AS_OF,
    )
    return flat(S.score_tables(summary))


@query
def scoreboard_after_enrichment(spark, folder):
    """The same after all stages: described, tagged and checked from the data itself."""
    tables = W.checked_tables(spark, folder)
    config = W.main_config(spark)
    state = stages.ColumnState(
        columns_of(spark, tables),
        local_frame(spark, [], COLUMN_TAGS),
        W.declared_checks(spark),
    )
    state, profile = stages.enrich(spark, tables, config, state)
    state = stages.suggest(tables, profile, config, state.stored()).stored()
    summary = stages.grade(
        spark,
        tables,
        config,
        _facts(spark, folder),
        state,
        local_frame(spark, [], DQ_SUMMARY),
        W.AS_OF,
    )
    return flat(S.score_tables(summary))
