"""Sharding by a reproducible shuffle: a Feistel permutation with cycle walking over global row numbers.

A row's number depends on the rows alone, not on files or partitions. The permutation sends number ``n`` to a place, and
``place % shards`` and ``place div shards`` are shard and slot, so both can be computed for any row number, and
``row_at`` goes back from shard and slot to the row number. Shards differ by one row at most.

The permutation's domain is ``a * b >= rows`` with ``a = ceil(sqrt(rows))``, so fewer than ``a`` places are not taken. A walk
visits each of them once at most. ``WALK`` steps are thus always enough for up to ``WALK ** 2`` rows; beyond, a step leaves
the domain of rows with probability below ``rows ** -0.5``, and a longer walk has probability below ``rows ** -31``. It
would raise an error, never a wrong place.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablegrade.llm.common import col, table

ROUNDS = 4
WALK = 64
#: Buckets that rows are numbered in, at least.
LEAST_BUCKETS = 64
#: Rows with equal keys are written out in blocks of so many.
BLOCK = 4096


def sides(rows: int) -> tuple[int, int]:
    """The two sides of the permutation's domain."""
    a = max(1, math.isqrt(max(0, rows - 1)) + 1)
    return a, max(1, -(-rows // a))


def _mixed(half: Column, turn: int, seed: int, side: int) -> Column:
    return F.pmod(F.xxhash64(half, F.lit(turn), F.lit(seed)), F.lit(side).cast("long"))


def _sent(place: Column, rows: int, seed: int, back: bool) -> Column:
    """One application of the permutation of ``0 … a * b - 1``, or of its inverse."""
    a, b = sides(rows)
    left, right, sign = place % F.lit(a), F.floor(place / F.lit(a)).cast("long"), -1 if back else 1
    for turn in reversed(range(ROUNDS)) if back else range(ROUNDS):
        if turn % 2 == 0:
            left = F.pmod(left + sign * _mixed(right, turn, seed, a), F.lit(a).cast("long"))
        else:
            right = F.pmod(right + sign * _mixed(left, turn, seed, b), F.lit(b).cast("long"))
    return left + F.lit(a) * right


def permuted(number: Column, rows: int, seed: int = 0, back: bool = False) -> Column:
    """The place of a row number among ``rows`` (or the number at a place), walking on from places beyond the last row."""
    first = _sent(number.cast("long"), rows, seed, back)
    total = F.lit(rows).cast("long")
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALK)),
        first,
        lambda place, _: F.when(place < total, place).otherwise(_sent(place, rows, seed, back)),
    )
    walked = F.when(walked < total, walked).otherwise(F.raise_error(F.lit("a walk took too long")).cast("long"))
    return F.when(first < total, first).otherwise(walked)


def row_at(shard: Column, slot: Column, rows: int, shards: int, seed: int = 0) -> Column:
    """The row number that stands in a slot of a shard."""
    return permuted(slot * shards + shard, rows, seed, back=True)


def numbered(keys: DataFrame, rows: int, name: str = "row") -> DataFrame:
    """All rows with global numbers from 0, gapless, that depend on the rows' values alone: not on the
    files, partitions or settings of the session.

    Equal rows are counted first and written out last, so a key that holds a third of all rows is one row between. Rows
    are dealt to buckets by a hash of all columns, counted by bucket, and numbered in the bucket after all earlier ones.
    """
    columns = [col(c) for c in keys.columns]
    buckets = max(LEAST_BUCKETS, rows // 200_000)
    counted = keys.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    counted = counted.withColumn("_bucket", F.pmod(F.xxhash64(*columns), F.lit(buckets)))
    sizes = counted.groupBy("_bucket").agg(F.sum("_n").alias("_size"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("_bucket").orderBy(*columns).rowsBetween(Window.unboundedPreceding, -1)
    ranked = counted.withColumn("_within", F.coalesce(F.sum("_n").over(within), F.lit(0)))
    first = ranked.join(starts, "_bucket").withColumn("_first", F.col("_start") + F.col("_within"))
    last = F.col("_first") + F.col("_n") - 1
    blocks = first.select(*columns, last.alias("_last"), F.explode(F.sequence("_first", last, F.lit(BLOCK).cast("long"))).alias("_from"))
    upto = F.least(F.col("_from") + BLOCK - 1, F.col("_last"))
    return blocks.select(*columns, F.explode(F.sequence(F.col("_from"), upto)).alias(name))


def shard(
    docs: DataFrame, shards: int = 8, seed: int = 0, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document: id, ``size`` (UTF-8 bytes and 1), ``text_crc32``, ``row`` (its number), ``shard`` and ``slot``.

    A null text counts as empty. Ids may be null or repeat: rows are told apart by id, size and checksum, and rows alike in
    all three are interchangeable. No text is shuffled. Other columns are not read. An empty table gives no rows.
    """
    text = F.coalesce(col(text_column).cast("string"), F.lit(""))
    keys = docs.select(
        col(id_column).alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    rows = docs.count()
    place = permuted(F.col("row"), rows, seed)
    placed = numbered(keys, rows).withColumn("_place", place)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        "row",
        (F.col("_place") % shards).cast("int").alias("shard"),
        F.floor(F.col("_place") / shards).cast("long").alias("slot"),
    )


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 7; the law is ``rows``: counts at most one apart."""
    placed = shard(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
