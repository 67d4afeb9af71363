"""Every registered query against its SQL, and what its plan must not contain."""

from __future__ import annotations

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import normal
from workload.frames import TEST_TABLES
from workload.oracle import ORACLE
from workload.queries import QUERIES

#: Queries whose similarity search runs numpy inside tasks.
IN_PYTHON = {"similar_topk", "similar_topk_in_blocks", "similar_topk_indexed", "retrieved_documents", "retrieval_context", "build_prompts"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TEST_TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '/root/testdata/sf0.001/{table}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, tiny, duck, name):
    result = QUERIES[name](spark, tiny)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert name in IN_PYTHON or not any(word in plan for word in ("ArrowEval", "BatchEvalPython", "MapInArrow", "MapInPandas"))
    found, wanted = result.toPandas(), duck.execute(ORACLE[name]).fetchdf()
    assert sorted(found.columns) == sorted(wanted.columns)
    assert normal(found) == normal(wanted)
    assert len(found) > 0


def test_entry(spark):
    rows = entry(spark).collect()
    assert len(rows) == len(TEST_TABLES) and {r["band"] for r in rows} <= {"Good", "Okay", "Poor"}
