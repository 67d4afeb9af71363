"""The four stages of a grading run, each a function from frames to frames.

``seed → enrich → suggest → grade``. A stage returns the new state; store it with
``sources.state_files.write_state``, or within one run with ``ColumnState.stored``, and hand the stored
frames to the next stage.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, replace
from datetime import datetime

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegrade.functions.expressions import full_name
from tablegrade.operators.checks import check_rollup, evaluate_checks
from tablegrade.operators.drift import past_columns, schema_drift
from tablegrade.operators.history import freshness, history_days
from tablegrade.operators.inventory import list_schemas, list_tables
from tablegrade.operators.profile import (
    Tables,
    at_once,
    column_counts,
    low_cardinality,
    name_parts,
    union_all,
    update_low_cardinality_tags,
)
from tablegrade.operators.profile_state import counts_of, profile_of
from tablegrade.operators.reconcile import in_scope, pending_columns, reconcile_check_tags
from tablegrade.operators.score import metric_rows, upsert_summary
from tablegrade.operators.signals import columns_described, steward_signals
from tablegrade.operators.state import (
    latest_config,
    seed_config,
    set_comments,
    set_tags,
    upsert_checks,
)
from tablegrade.operators.suggest import draft_descriptions, suggest_checks
from tablegrade.schemas import (
    COLUMN_KEYS,
    DEFAULT_THRESHOLD,
    TABLE_KEYS,
    TAG_CHECK,
    TAG_COMMENT,
    UNSEEDED_SCHEMAS,
)
from tablegrade.sources.catalog import open_tables
from tablegrade.sources.local import local_frame
from tablegrade.sources.state_files import stored_once


#: Tables whose scans go into one query plan.
TABLES_AT_ONCE = 200


@dataclass(frozen=True)
class Failure:
    """A table that a stage could not work on."""

    table: str
    stage: str
    error: str


def failure_rows(spark: SparkSession, failures: list[Failure]) -> DataFrame:
    """The failures as rows ``(table, stage, error)``."""
    rows = [(*name_parts(f.table), f.stage, f.error) for f in failures]
    kinds = [T.StructField(k, T.StringType()) for k in [*TABLE_KEYS, "stage", "error"]]
    return local_frame(spark, rows, T.StructType(kinds))


def open_readable(spark: SparkSession, names: Iterable[str], failures: list[Failure]) -> dict[str, DataFrame]:
    """The monitored tables that the catalog can open; the others are added to ``failures``."""
    opened: dict[str, DataFrame] = {}
    for name in names:
        try:
            opened |= open_tables(spark, [name])
        except PySparkException as error:
            failures.append(Failure(name, "open", _reason(error)))
    return opened


def _reason(error: Exception) -> str:
    """The first line of an error that says something."""
    return next((line.strip() for line in str(error).splitlines() if line.strip()), type(error).__name__)


def in_batches(
    tables: Tables,
    run: Callable[[Tables], DataFrame],
    failures: list[Failure] | None = None,
    stage: str = "",
) -> DataFrame:
    """What ``run`` gives for all tables, a limited number of tables per plan.

    With more than one batch each result is stored, so that no plan grows with the catalog. With ``failures``
    every batch is stored, and one that fails is halved until the tables that fail stand alone; those are added to
    ``failures`` and give no rows. If all tables fail, the last error is raised.
    """
    names = list(tables)
    batches = [names[i : i + TABLES_AT_ONCE] for i in range(0, len(names), TABLES_AT_ONCE)]
    if failures is None and len(batches) <= 1:
        return run(tables)
    done, left, failed = [], batches[::-1], 0
    while left:
        batch = left.pop()
        try:
            done.append(stored_once(run({n: tables[n] for n in batch})))
        except (PySparkException, Py4JError) as error:
            if failures is None:
                raise
            if len(batch) > 1:
                half = len(batch) // 2
                left += [batch[half:], batch[:half]]
                continue
            failures.append(Failure(batch[0], stage, _reason(error)))
            failed += 1
            if failed == len(names) > 1:
                raise
    return union_all(done) if done else run({})


@dataclass(frozen=True)
class ColumnState:
    """What is stored about columns: their inventory, tags and checks."""

    columns: DataFrame
    tags: DataFrame
    checks: DataFrame

    def stored(self) -> ColumnState:
        """The same frames, each written to the shared folder once; for use between stages."""
        frames = at_once(stored_once, [self.columns, self.tags, self.checks])
        return ColumnState(*frames)


def seed(config: DataFrame, schemas: DataFrame, tables: DataFrame) -> DataFrame:
    """Default configuration for every monitored table that has none."""
    wanted = list_schemas(schemas, UNSEEDED_SCHEMAS)
    keys = ["catalog_name", "schema_name"]
    return seed_config(config, list_tables(tables).join(wanted.select(*keys), keys, "left_semi"))


def thresholds_of(config: DataFrame, tables: Tables) -> dict[str, int]:
    """Low-cardinality threshold of each table that is open, from its newest configuration."""
    rows = (
        latest_config(config)
        .select(full_name().alias("name"), "low_cardinality_threshold")
        .where(F.col("name").isin(list(tables)))
        .collect()
    )
    given = {row["name"]: row["low_cardinality_threshold"] for row in rows if row["low_cardinality_threshold"] is not None}
    return {name: given.get(name, DEFAULT_THRESHOLD) for name in tables}


def enrich(
    spark: SparkSession,
    tables: Tables,
    config: DataFrame,
    state: ColumnState,
    failures: list[Failure] | None = None,
    kept: DataFrame | None = None,
) -> tuple[ColumnState, DataFrame]:
    """Reconcile checks and tags, tag low-cardinality columns, and describe pending columns.

    With ``failures``, tables that cannot be read are added there and keep their tags; else they fail the stage. With ``kept``, a
    profile by file of these tables (``update_file_profile``), nothing is scanned.

    Returns the new state and the profile, which the next stage needs too. The profile and the tags
    are used several times and rest on scans of the data, so they are stored once each.
    """
    checks, tags = reconcile_check_tags(state.tags, state.checks, state.columns, config)
    if kept is not None:
        profile = stored_once(profile_of(kept, tags))
    else:
        limits = thresholds_of(config, tables)
        profile = stored_once(
            in_batches(tables, lambda some: low_cardinality(spark, some, limits, tags), failures, "enrich")
        )
    before, tags = tags, stored_once(update_low_cardinality_tags(profile, tags))
    pending = in_scope(pending_columns(state.columns, tags, TAG_COMMENT), config)
    drafts = draft_descriptions(pending, profile, before)
    columns, tags = set_comments(state.columns, tags, drafts)
    return replace(state, columns=columns, tags=tags, checks=checks), profile


def suggest(
    tables: Tables,
    profile: DataFrame,
    config: DataFrame,
    state: ColumnState,
    failures: list[Failure] | None = None,
    kept: DataFrame | None = None,
) -> ColumnState:
    """Generate checks for the columns without any, and tag those columns.

    Only pending columns of open tables are scanned. With ``kept``, a profile by file of these tables, nothing is scanned or
    collected.
    """
    pending = in_scope(pending_columns(state.columns, state.tags, TAG_CHECK), config)
    if kept is not None:
        return _with_checks(state, profile, counts_of(kept).join(pending.select(*COLUMN_KEYS).distinct(), COLUMN_KEYS, "left_semi"))
    names = pending.select(full_name().alias("name"), "column_name").where(
        F.col("name").isin(list(tables))
    )
    asked: dict[str, list[str]] = {}
    for row in names.distinct().collect():
        asked.setdefault(row["name"], []).append(row["column_name"])
    if not asked:
        return state
    columns = {name: sorted(found) for name, found in asked.items()}
    pending_tables = {name: tables[name] for name in columns}
    counts = in_batches(pending_tables, lambda some: column_counts(some, columns), failures, "suggest")
    return _with_checks(state, profile, counts)


def _with_checks(state: ColumnState, profile: DataFrame, counts: DataFrame) -> ColumnState:
    """The state with checks suggested for the counted columns."""
    drafts = stored_once(suggest_checks(profile, counts))
    marks = drafts.select(*COLUMN_KEYS, F.lit(TAG_CHECK).alias("tag_name"))
    return replace(
        state,
        checks=upsert_checks(state.checks, drafts),
        tags=set_tags(state.tags, marks),
    )


@dataclass(frozen=True)
class TableFacts:
    """What the catalog knows about tables."""

    tables: DataFrame
    properties: DataFrame
    history: DataFrame
    schema_versions: DataFrame


def graded_metrics(
    spark: SparkSession,
    tables: Tables,
    config: DataFrame,
    facts: TableFacts,
    state: ColumnState,
    as_of: datetime | str,
    failures: list[Failure] | None = None,
) -> DataFrame:
    """All metrics of all configured tables as ``(table, metric, value)`` rows.

    A table that was not scanned, or has no past version, gives no row for the metric concerned, so
    that an earlier value stays. The history is read once, folded to days and stored.
    """
    config = latest_config(config)
    history = stored_once(history_days(facts.history))
    # Columns are folded to one row per table first and limited to the configured tables after.
    signals = steward_signals(
        in_scope(facts.tables, config),
        facts.properties,
        history,
        state.columns,
        state.checks,
    )
    described = in_scope(columns_described(state.columns), config)
    past = past_columns(history, facts.schema_versions, config, as_of)
    drift = schema_drift(in_scope(state.columns, past.select(*TABLE_KEYS).distinct()), past)
    checks = in_scope(state.checks, config)
    evaluated = in_batches(tables, lambda some: evaluate_checks(spark, checks, some), failures, "grade")
    passed = check_rollup(evaluated)
    return union_all(
        [
            metric_rows(
                signals,
                [
                    "has_a_valid_owner",
                    "is_delta_table",
                    "uses_a_production_pipeline",
                    "has_enforced_retention_duration",
                    "is_managed_location",
                    "table_description",
                    "table_implement_checks",
                    "all_columns_have_checks",
                ],
            ),
            metric_rows(described, ["columns_description"]),
            metric_rows(freshness(history, config, as_of), ["is_fresh"]),
            metric_rows(
                drift,
                {"columns_match": "columns_valid", "datatypes_match": "columns_datatype_valid"},
            ),
            metric_rows(passed, {"all_checks_passed": "has_check_passed"}),
        ]
    )


def grade(
    spark: SparkSession,
    tables: Tables,
    config: DataFrame,
    facts: TableFacts,
    state: ColumnState,
    summary: DataFrame,
    as_of: datetime | str,
    failures: list[Failure] | None = None,
) -> DataFrame:
    """The summary with this run's metrics of every configured table, from a single upsert.

    The metric rows rest on scans of the data, so they are stored once before they are merged. With ``failures``, tables whose
    checks cannot be run are added there and keep their earlier outcome; else they fail the stage.
    """
    rows = stored_once(graded_metrics(spark, tables, config, facts, state, as_of, failures))
    return upsert_summary(summary, rows)

