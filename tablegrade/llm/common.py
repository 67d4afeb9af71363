"""Helpers shared by the operators of this package."""

from __future__ import annotations

import re
from functools import cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The largest table that an operator hands to every executor; larger ones are joined by shuffling.
BROADCAST_BYTES = 32 << 20

#: Words: runs of letters and digits, lower-cased first.
WORD = re.compile(r"\w+")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, megabytes: int = 4) -> None:
    """Bound what a Python worker holds at a time: batches are cut by bytes, not only by rows."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(megabytes << 20))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")


def fresh(frame: DataFrame, stem: str) -> str:
    """A column name that the frame doesn't have, whatever its case."""
    taken = {name.lower() for name in frame.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def col(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def for_all(frame: DataFrame, row_bytes: int, rows: int | None = None) -> DataFrame:
    """The frame marked for broadcast if its counted size allows; otherwise as it is, to be joined by shuffling."""
    rows = frame.count() if rows is None else rows
    return F.broadcast(frame) if rows * row_bytes <= BROADCAST_BYTES else frame


def remainder(doc_id: Column, divisor: int) -> Column:
    """``crc32`` of the id as text modulo ``divisor``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % divisor


def content_key(doc_id: Column, text: Column) -> list[Column]:
    """Columns ``key_id`` and ``key_text``, equal for rows with the same id and text. Compare them null-safely."""
    return [doc_id.alias("key_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("key_text")]


@cache
def _word_letters() -> np.ndarray:
    """Which code points are parts of words, as in ``WORD``."""
    return np.fromiter((chr(i).isalnum() or i == 95 for i in range(0x110000)), bool, 0x110000)


@cache
def _powers() -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.full(4096, 0xD6E8FEB86659FD93, np.uint64))


def hashed_words(text: str | None) -> np.ndarray:
    """A 64-bit hash of every word of the lower-cased text, in order."""
    letters = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), "<u4")
    inside = _word_letters()[letters]
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
    if not len(edges):
        return np.empty(0, np.uint64)
    lengths = edges[1::2] - edges[::2]
    first = np.cumsum(lengths) - lengths
    places = np.arange(lengths.sum()) - np.repeat(first, lengths)
    with np.errstate(over="ignore"):
        out = np.add.reduceat((letters[inside].astype(np.uint64) + np.uint64(1)) * _powers()[places & 4095], first)
        for shift in (32, 29):
            out = (out ^ (out >> np.uint64(shift)) ^ lengths.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        return out ^ (out >> np.uint64(32))
