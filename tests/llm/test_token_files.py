"""Token files and their index against the tokenizers library."""

from __future__ import annotations

import os
import uuid
import zlib
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tablegrade.llm import token_files
from tablegrade.llm.queries import QUERIES

os.environ["TOKENIZERS_PARALLELISM"] = "false"


@cache
def plain(path: str) -> Tokenizer:
    made = Tokenizer.from_file(path)
    made.encode_special_tokens = True
    return made


def plain_rows(docs: list[tuple], end_id: int = 2) -> dict:
    """Start, length and checksum of all documents, in order of their ids; every id occurs once."""
    tokenizer, start, out = plain(token_files.default_tokenizer()), 0, {}
    for doc_id, text in sorted(docs, key=lambda r: (r[0] is not None, r[0])):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, end_id], "<u4")
        out[doc_id] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    return out


@pytest.fixture
def folder(spark):
    return f"{spark.conf.get('spark.sql.warehouse.dir')}/tokens-{uuid.uuid4().hex}"


odd = st.sampled_from(["<|endoftext|> it's  \n\n 12 é ß", "a" * 5000, "", "İΣ ΑΣ é ́x", "a\x0bb\x0cc\x1cd\x85e f\x00g\x7f'S 've", "日本語 テキスト"])


@given(st.text(max_size=80) | st.text(st.characters(max_codepoint=127), max_size=80) | st.text(st.characters(max_codepoint=255), max_size=80) | odd)
@settings(max_examples=500, deadline=None)
def test_ids_are_those_of_the_tokenizers_library(text):
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        path = public_tokenizers.path(name)
        assert token_files.encoder(path).encode(text).tolist() == plain(path).encode(text, add_special_tokens=False).ids
    assert token_files.encoder(token_files.default_tokenizer()).quick and not token_files.encoder(path).quick


def test_very_long_chunks():
    for text in ("a" * 300_000, "x" + " " * 1_000_000 + "y", "!" * 100_000, "word " * 100_000):
        ids = plain(token_files.default_tokenizer()).encode(text, add_special_tokens=False).ids
        assert token_files.encoder(token_files.default_tokenizer()).encode(text).tolist() == ids


@given(st.sets(st.integers(-(2**63), 2**63 - 1), max_size=300))
@settings(max_examples=60, deadline=None)
def test_perfect_hash(keys):
    h1 = np.array(sorted(keys), np.int64)
    h2 = h1 ^ np.int64(0x5DEECE66D)
    slots = np.zeros(len(h1), token_files.SLOT)
    slots["print"], slots["shard"] = token_files.prints(h2), np.arange(len(h1))
    function, stored = token_files.read_index(token_files.index_file(h1, h2, slots) + b"\n")
    numbers = function.numbers(h1, h2)
    assert sorted(numbers.tolist()) == list(range(len(h1)))
    assert stored["shard"][numbers].tolist() == list(range(len(h1)))


def test_keys_with_the_same_bits_are_refused():
    same = np.zeros(2, np.int64)
    with pytest.raises(ValueError, match="128 bits"):
        token_files.PerfectHash.of(same, same)


def test_op12_by_brute_force(spark, tiny):
    docs = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{tiny}/documents.parquet").to_pylist()]
    found = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in QUERIES["op12_token_files"](spark, tiny).collect()}
    assert found == plain_rows(docs)


def test_keyed_access(spark, folder, monkeypatch):
    docs = [(i, f"text number {i} " * (i % 7)) for i in range(500)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").select("*", F.lit(1).alias("shard"), F.lit(1).alias("a.b"))
    monkeypatch.setattr(token_files, "BUCKET_KEYS", 64)
    token_files.write_tokens(frame, folder)
    token_files.build_index(spark, folder)
    wanted = plain_rows(docs)
    keys = spark.createDataFrame([(3,), (499,), (10_000,), (None,), (-3,)], "k int")
    found = token_files.fetch(spark, folder, keys, with_ids=True).collect()
    assert {r["k"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in found} == {k: wanted[k] for k in (3, 499)}
    tokenizer = plain(token_files.default_tokenizer())
    assert all(r["ids"] == [*tokenizer.encode(docs[r["k"]][1], add_special_tokens=False).ids, 2] for r in found)
    absent = token_files.locate(spark, folder, spark.range(10_000, 60_000))
    assert absent.count() == 0


def test_awkward_rows(spark, folder):
    rows = [(1, "b"), (1, "b"), (1, None), (None, "x y"), (None, ""), (2, ""), (3, " \n"), (4, "word " * 50_000), (5, "é" * 3000)]
    token_files.write_tokens(spark.createDataFrame(rows, "doc_id long, text string"), folder)
    token_files.build_index(spark, folder)
    keys = spark.createDataFrame([(1,), (None,), (2,), (3,), (4,), (5,)], "doc_id long")
    found = sorted((r["start"], r["n_tokens"], r["doc_id"]) for r in token_files.fetch(spark, folder, keys).collect())
    assert [doc for _, _, doc in found] == [None, None, 1, 1, 1, 2, 3, 4, 5]
    assert all(a[0] + a[1] == b[0] for a, b in zip(found, found[1:], strict=False)) and found[0][0] == 0
    assert sorted(n for _, n, doc in found if doc is None) == [1, 3] and sorted(n for _, n, doc in found if doc == 1) == [1, 2, 2]


def test_a_key_in_many_shards(spark, folder, monkeypatch):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        docs = spark.range(2000).select((F.col("id") % 10 / 9).cast("int").alias("doc_id"), F.concat(F.lit("w"), "id").alias("text"))
        token_files.write_tokens(docs.repartition(4), folder)
        token_files.build_index(spark, folder)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    places = token_files.locate(spark, folder, spark.createDataFrame([(0,), (1,), (2,)], "k int")).collect()
    assert len({r["shard"] for r in places if r["key"] == "0"}) >= 3
    found = sorted((r["start"], r["n_tokens"], r["k"]) for r in token_files.fetch(spark, folder, spark.createDataFrame([(0,), (1,)], "k int")).collect())
    assert len(found) == 2000 and [k for _, _, k in found] == [0] * 1800 + [1] * 200
    assert all(a[0] + a[1] == b[0] for a, b in zip(found, found[1:], strict=False))


def test_empty_table(spark, folder):
    token_files.write_tokens(spark.createDataFrame([], "doc_id long, text string"), folder)
    token_files.build_index(spark, folder)
    assert token_files.fetch(spark, folder, spark.createDataFrame([(1,)], "doc_id long")).count() == 0
