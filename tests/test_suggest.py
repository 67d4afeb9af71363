from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablegrade.operators import retrieval, suggest
from tests.helpers import as_set, by_table, frame

PROFILE = "column_name string, is_low_cardinality boolean, values array<string>"
COUNTS = "column_name string, row_count bigint, null_count bigint"


def test_suggestions(spark):
    rows = [("full", True, ["a", "b"], 5, 0), ("gaps", True, ["a"], 5, 1), ("many", False, None, 5, 0),
            ("wild", False, None, 5, 2), ("void", True, [], 5, 5), ("none", True, [], 0, 0), ("tagged", True, None, 5, 1)]
    found = suggest.suggest_checks(
        frame(spark, PROFILE, *[("t", c, low, v) for c, low, v, _, _ in rows]),
        frame(spark, COUNTS, *[("t", c, n, nulls) for c, _, _, n, nulls in rows]),
    )
    assert {r["column_name"]: (r["check"], r["tag"]) for r in found.collect()} == {
        "full": ('  - missing_count(full) = 0\n  - invalid_count(full) = 0:\n      valid values: ["a", "b"]', "ai_generated"),
        "gaps": ('  - invalid_count(gaps) = 0:\n      valid values: ["a"]', "ai_generated"),
        "many": ("  - missing_count(many) = 0", "ai_generated"),
    }


def test_descriptions(spark):
    columns = frame(
        spark, "column_name string, is_nullable string, data_type string, comment string",
        ("t", "order_status", "YES", "string", None), ("t", "id", "NO", "bigint", " "), ("t", "kept", "NO", "int", "Already told."),
        ("t", "again", "NO", "int", "Told. Valid values: x, y."), ("t", "unprofiled", "NO", "map", None),
        ("t", "told", "NO", "string", "Order state. Valid values: see wiki. Owned by ops."), ("t", "same", "NO", "int", "Held. Valid values: z."),
    )
    profile = frame(
        spark, PROFILE, ("t", "order_status", True, ["F", "O"]), ("t", "id", False, None), ("t", "kept", True, []), ("t", "again", True, ["z"]),
        ("t", "told", True, ["a"]), ("t", "same", True, ["z"]),
    )
    tags = frame(
        spark, "column_name string, tag_name string, tag_value string",
        ("t", "again", "has_low_cardinality", "x, y"), ("t", "again", "has_check", None), ("t", "told", "has_low_cardinality", "b"),
    )
    assert as_set(suggest.draft_descriptions(columns, profile, tags), "column_name", "comment") == {
        ("order_status", "Order status (string, may be empty). Valid values: F, O."),
        ("id", "Id (bigint)."),
        ("kept", "Already told."),
        ("again", "Told. Valid values: z."),
        ("unprofiled", "Unprofiled (map)."),
        ("told", "Order state. Valid values: see wiki. Owned by ops. Valid values: a."),
        ("same", "Held. Valid values: z."),
    }


@pytest.mark.parametrize("template", [suggest.DESCRIPTION_PROMPT, suggest.CHECK_PROMPT])
def test_templates_have_one_slot(template):
    assert template.count("{context}") == 1


def test_the_check_template_asks_for_the_stored_form():
    assert '"  -"' in suggest.CHECK_PROMPT


def test_prompts(spark):
    columns = frame(
        spark, "column_name string, is_nullable string, data_type string, comment string, tags array<struct<tag_name:string,tag_value:string>>",
        ("t", "a", "YES", "int", None, [("x", None)]), ("t", "b", "NO", "int", 'say "b"', []),
    )
    contexts = frame(spark, "column_name string, context string", ("t", "b", "about $1 {context} \\1"))
    found = {r["column_name"]: r for r in suggest.build_prompts(columns, contexts, "Do. {context}").collect()}
    assert found["a"]["system"] == "Do. " and found["b"]["system"] == "Do. about $1 {context} \\1"
    assert found["a"]["user"] == '{"column_name":"a","is_nullable":"YES","data_type":"int","comment":null,"tag_names":["x"],"tag_values":[""]}'
    assert '\\"b\\"' in found["b"]["user"]
    assert {r["system"] for r in suggest.build_prompts(columns, None, "Do. {context}").collect()} == {"Do. "}


def vectors(spark, name, rows):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], f"{name} bigint, vector array<float>")


def brute_force(queries, documents, k):
    best = set()
    for q, v in queries:
        scores = []
        for d, w in documents:
            v32, w32 = np.float32(v).astype(float), np.float32(w).astype(float)
            norm = np.linalg.norm(v32) * np.linalg.norm(w32)
            scores.append((-round(float(v32 @ w32 / norm), 6) if norm else 0.0, d))
        best |= {(q, rank, d) for rank, (_, d) in enumerate(sorted(scores)[:k], 1)}
    return best


@pytest.mark.parametrize("k", [1, 5, 80])
def test_top_k_agrees_with_brute_force(spark, k):
    random.seed(k)
    # Few directions, so that many scores tie.
    def rows(n, offset):
        return [(i + offset, [random.choice([-1, 0, 0, 1]) for _ in range(3)]) for i in range(n)]

    queries, documents = rows(90, 0), rows(70, 500)
    expected = brute_force(queries, documents, k)
    q, d = vectors(spark, "query_id", queries), vectors(spark, "doc_id", documents)
    assert as_set(retrieval.top_k_similar(q, d, k), "query_id", "rank", "doc_id") == expected
    blocks = retrieval.top_k_similar(q, d, k, broadcast_bytes=0, block_rows=16)
    assert as_set(blocks, "query_id", "rank", "doc_id") == expected


def test_slices_of_queries_change_nothing(spark, monkeypatch):
    rng = np.random.default_rng(1)
    queries, documents = rng.normal(size=(50, 8)), rng.normal(size=(40, 8))
    whole = retrieval._best(queries, documents, 3, 6)
    monkeypatch.setattr(retrieval, "_SCORES_AT_ONCE", 100)
    assert all((a == b).all() for a, b in zip(whole, retrieval._best(queries, documents, 3, 6)))


def test_nothing_to_search(spark):
    q, d = vectors(spark, "query_id", [(1, [1, 0])]), vectors(spark, "doc_id", [(1, [1, 0])])
    assert retrieval.top_k_similar(q, d.where("false")).collect() == []
    assert retrieval.top_k_similar(q.where("false"), d).collect() == []
    assert retrieval.top_k_similar(q.where("false"), d, broadcast_bytes=0).collect() == []


def test_text_ids(spark):
    q = vectors(spark, "query_id", [(1, [1, 0])]).withColumn("query_id", F.lit("t.a"))
    d = vectors(spark, "doc_id", [(1, [1, 0]), (2, [0, 1])]).withColumn("doc_id", F.concat(F.lit("check-"), "doc_id"))
    expected = {("t.a", 1, "check-1"), ("t.a", 2, "check-2")}
    assert as_set(retrieval.top_k_similar(q, d), "query_id", "rank", "doc_id") == expected
    assert as_set(retrieval.top_k_similar(q, d, broadcast_bytes=0), "query_id", "rank", "doc_id") == expected


def test_context(spark):
    matches = spark.createDataFrame([("q", 2, "x"), ("q", 1, "7"), ("r", 1, "gone")], "query_id string, rank bigint, doc_id string")
    base = spark.createDataFrame([("7", "s7", "seven"), ("x", None, "ex")], "check_id string, check_syntax string, description string")
    found = retrieval.format_context(retrieval.documents_of(matches, base))
    assert as_set(found, "query_id", "context") == {
        ("q", "+check_syntax: \n s7\ncheck_description: seven\n\n+check_syntax: \n None\ncheck_description: ex\n\n"),
        ("r", "+check_syntax: \n None\ncheck_description: None\n\n"),
    }


def test_last_message(spark):
    rows = spark.createDataFrame(
        [(1, 0, "first"), (1, 1, '{"comment": "customer email address"}'), (2, 0, "only")], "conv_id int, turn int, text string"
    )
    last = retrieval.last_messages(rows)
    assert as_set(last, "conv_id", "content") == {(1, '{"comment": "customer email address"}'), (2, "only")}
    found = last.select("conv_id", retrieval.comment_of(F.col("content")).alias("comment"))
    assert as_set(found, "conv_id", "comment") == {(1, "customer email address"), (2, None)}


def test_by_table_helper(spark):
    assert by_table(frame(spark, "x int", ("t", 1)), "x") == {"t": 1}


def test_null_vectors_leave_the_others_alone(spark):
    q = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.0, 1.0]), (4, [None, 1.0])], "query_id bigint, vector array<float>")
    d = spark.createDataFrame([(10, None), (11, [1.0, 0.0]), (12, [0.0, 1.0])], "doc_id bigint, vector array<float>")
    for size in (0, 1 << 20):
        found = retrieval.top_k_similar(q, d, 1, broadcast_bytes=size)
        assert as_set(found, "query_id", "doc_id") == {(1, 11), (3, 12)}
    with pytest.raises(ValueError, match="lengths"):
        retrieval.top_k_similar(q, d.union(vectors(spark, "doc_id", [(13, [1])])), 1)


def test_vectors_move_no_more_often_with_more_blocks(spark, monkeypatch):
    found = np.random.default_rng(2).normal(size=(300, 6)).tolist()
    q, d = vectors(spark, "query_id", list(enumerate(found))), vectors(spark, "doc_id", list(enumerate(found)))
    moved, dealt = [], retrieval.dealt_in_strips

    def counted(*sides):
        frame, pairs = dealt(*sides)
        moved.append(frame.agg(F.sum(F.size(F.coalesce("query_ids", "doc_ids")))).head()[0])
        return frame, pairs

    monkeypatch.setattr(retrieval, "dealt_in_strips", counted)
    expected = as_set(retrieval.top_k_similar(q, d, 4), "query_id", "rank", "doc_id", "score")
    for block_rows in (2, 64):
        blocks = retrieval.top_k_similar(q, d, 4, broadcast_bytes=0, block_rows=block_rows)
        assert as_set(blocks, "query_id", "rank", "doc_id", "score") == expected
    monkeypatch.setattr(retrieval, "HELD_BYTES", 6 * 8 * 25)  # twelve strips of queries
    blocks = retrieval.top_k_similar(q, d, 4, broadcast_bytes=0, block_rows=2)
    assert as_set(blocks, "query_id", "rank", "doc_id", "score") == expected
    assert max(moved[:2]) <= 300 * 2 * retrieval.STRIPS and moved[2] <= 300 * (12 + 5)
