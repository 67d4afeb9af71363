"""Periodic runs against all periods tried one by one."""

from __future__ import annotations

import hashlib
import re
import zlib

import pyarrow.parquet as pq
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablegrade.llm import runs
from tablegrade.llm.queries import QUERIES


def plain_runs(words: list, least: int) -> list[tuple[int, int, int]]:
    """Every stretch in which words one period apart are equal, if no smaller period does."""
    found, n = [], len(words)
    for period in range(1, n // 2 + 1):
        start = 0
        while start + period < n:
            end = start
            while end + period < n and words[end] == words[end + period]:
                end += 1
            length = end - start + period
            if length >= max(least, 2 * period) and not any(
                words[start : start + length - p] == words[start + p : start + length] for p in range(1, period)
            ):
                found.append((start, length, period))
            start = end + 1
    return sorted(found, key=lambda run: (run[0], run[2]))


def plain_row(doc_id: int | None, text: str | None) -> tuple:
    """The row of ``op13`` for one document, word by word."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain_runs(words, 12)
    gone = {w for start, length, period in found for w in range(start + period, start + length)}
    best = min(found, key=lambda run: (-run[1], run[0], run[2]), default=None)
    lines = "".join(f"{start},{length},{period}\n" for start, length, period in found)
    rest = " ".join(w for i, w in enumerate(words) if i not in gone)
    longest = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *longest, *[hashlib.sha256(x.encode()).hexdigest() for x in (lines, rest)])


texts = st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=40) | st.builds(
    lambda head, part, times, tail: head + part * times + tail,
    *[st.lists(st.sampled_from([b"a", b"b"]), max_size=7)] * 2,
    st.integers(0, 9),
    st.lists(st.sampled_from([b"a", b"b"]), max_size=5),
)


@given(st.lists(texts, min_size=1, max_size=4), st.sampled_from([12, 12, 4, 5, 7, 20]))
@settings(max_examples=400, deadline=None)
def test_runs_by_brute_force(several, least):
    assert runs.runs_of_texts(several, least) == [plain_runs(words, least) for words in several]


def test_tests_are_done_in_parts(monkeypatch):
    monkeypatch.setattr(runs, "TESTS", 3)
    words = [b"a", b"b", b"a", b"a", b"b"] * 8 + [b"a"] * 15 + [b"b", b"c"] * 9
    assert runs.runs_of_texts([words, words], 12) == [plain_runs(words, 12)] * 2


def test_one_word_a_million_times():
    assert runs.runs_of_texts([[b"a"] * 1_000_000], 12) == [[(0, 1_000_000, 1)]]


def test_op13_by_brute_force(spark, tiny):
    rows = pq.read_table(f"{tiny}/documents.parquet").to_pylist()
    rows = [r for r in rows if len(r["text"] or "") < 4000]
    wanted = {r["doc_id"]: plain_row(r["doc_id"], r["text"]) for r in rows}
    found = {r["doc_id"]: tuple(r) for r in QUERIES["op13_periodic_runs"](spark, tiny).collect()}
    assert len(found) == pq.read_metadata(f"{tiny}/documents.parquet").num_rows and len(wanted) > 100
    assert all(found[i] == row for i, row in wanted.items())
    assert sum(row[1] > 0 for row in wanted.values()) > 5


def test_awkward_rows(spark):
    rows = [(1, "x " * 30), (1, "x " * 30), (None, "a b " * 9), (2, None), (3, ""), (4, " \n\t"), (5, "a b c " * 12), (30, "w " * 20_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("*", F.lit(0).alias("_text"), F.lit(0).alias("n_runs"), F.lit(0).alias("a.b"))
    found = sorted(map(tuple, runs.periodic_runs(docs, damaged=True).collect()), key=str)
    long = [row for row in found if row[0] == 30]
    assert len(long) == 1 and long[0][1:5] == (1, 0, 20_000, 1)
    assert [row for row in found if row[0] != 30] == sorted((plain_row(*row) for row in rows[:-1]), key=str)
    texts = {r["doc_id"]: (r["runs"], r["collapsed"]) for r in runs.periodic_runs(docs, with_runs=True).collect()}
    assert texts[5] == ("0,24,2\n", "a b c") and texts[2] == ("", "")
    assert runs.periodic_runs(docs.limit(0)).count() == 0
    renamed = docs.select(F.col("text").alias("body.x"), F.col("doc_id").cast("string").alias("key"))
    assert runs.periodic_runs(renamed, "key", "body.x").count() == len(rows)
