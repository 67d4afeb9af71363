"""Benchmark decontamination: SimHash windows found by multi-index Hamming blocks, verified by weighted shingles.

Documents are cut into windows of as many words as benchmark items have, at every word; a window is compared with items of its
size. A window and an item are bags of five-word shingles, weighted by how rare a shingle is among items; their similarity is the weighted Jaccard index. A window's SimHash
fingerprint has 64 bits in the blocks of ``WIDTHS``. If two fingerprints differ in at most ``RADIUS`` bits, some block differs in at
most ``FLIPS``; so items are entered under all values that close to their blocks, and every pair within the radius meets in a
join on block and value. That join carries no shingles: they are stored once per stretch of a text and looked up for the pairs within
the radius, which are then verified. Of pairs of similarity 0.8, with equal weights, fewer than 1 in
1,000 differ in more bits (simulated for 9 to 108 shingles: at most 0.08 %; with a radius of 15 it was up to 2.4 %). Where most of an
item's shingles stand in all items, the few others weigh most and more is lost (0.15 % if it is 80 % of them, 2.2 % if 95 %).

Only windows that can be similar get fingerprints: as a shingle that no item has weighs most, at least four fifths of
a similar window's shingles must be shingles of items. A table of fixed size tells, by hash, which may be.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablegrade.llm.common import col, content_key, for_all, fresh, hashed_words, small_batches, table
from tablegrade.llm.lsh_forest import runs
from tablegrade.sources.state_files import stored_once

SHINGLE, SIMILAR = 5, 0.8
BITS, RADIUS = 64, 19
#: Bits of the blocks of a fingerprint, the lowest first, and how many bits differ at most in the block that differs least.
WIDTHS = (13, 13, 13, 13, 12)
BLOCKS, FLIPS = len(WIDTHS), RADIUS // len(WIDTHS)
SHIFTS = tuple(sum(WIDTHS[:i]) for i in range(BLOCKS))
#: Bytes of the table of items' shingles, at least and at most. A full table only makes more windows candidates.
LEAST_TABLE, LARGEST_TABLE = 1 << 16, 1 << 24
#: A shingle's weight is ``log(1 + items / items with it)``; the table keeps it in so many steps.
STEPS = 254


def bag(hashes: np.ndarray, length: int = SHINGLE) -> np.ndarray:
    """Hashes of the shingles of a passage of hashed words in order; a shorter passage is one shingle."""
    return runs(hashes, min(length, len(hashes))) if len(hashes) else np.empty(0, np.uint64)


def bits_of(hashes: np.ndarray) -> np.ndarray:
    """A row of -1 and 1 per hash."""
    return np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).astype(np.float64) * 2 - 1


def fingerprints(sums: np.ndarray) -> np.ndarray:
    """The signs of weighted sums of bits, as signed numbers."""
    return np.packbits(sums > 1e-9, axis=1).view(">u8").ravel().astype(np.uint64).view(np.int64)


def near_values(width: int, most: int) -> np.ndarray:
    """All numbers of ``width`` bits with at most ``most`` bits set."""
    numbers = np.arange(1 << width)
    return numbers[np.array([int(n).bit_count() <= most for n in numbers])]


def similarity(window: list[int], item: list[int], weights: list[float], foreign: float) -> float:
    """Weighted Jaccard index of two bags; ``weights`` go with the item's shingles, ``foreign`` is that of all others."""
    a, b, weight = Counter(window), Counter(item), dict(zip(item, weights, strict=True))
    both = sum(min(n, b[s]) * weight[s] for s, n in a.items() if s in b)
    all_ = sum(n * weight.get(s, foreign) for s, n in a.items()) + sum(n * weight[s] for s, n in b.items()) - both
    return both / all_ if all_ else 0.0


def item_bags(items: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``item_id``, ``words`` (how many) and ``shingles`` of every item with words."""

    @F.pandas_udf("words int, shingles array<long>")
    def found(texts: pd.Series) -> pd.DataFrame:
        words = [hashed_words(text) for text in texts]
        return pd.DataFrame({"words": [len(w) for w in words], "shingles": [bag(w).view(np.int64) for w in words]})

    rows = items.select(col(id_column).alias("item_id"), found(col(text_column)).alias("b")).select("item_id", "b.*")
    return rows.filter("words > 0")


def least_run(n: int) -> int:
    """How many neighbouring shingles, at least, are all items' in a similar window of ``n``."""
    hits = math.ceil(SIMILAR * n - 1e-9)
    return -(-hits // (n - hits + 1))


class Index:
    """What every task knows of the benchmark: the lengths of items, and a table of the weights of shingles by hash."""

    def __init__(self, lengths: list[int], places: np.ndarray, steps: np.ndarray, size: int, items: int):
        self.lengths, self.items = lengths, items
        self.top = math.log(1 + items)
        self.runs: dict[int, int] = {}  # by the length of shingles
        for words in lengths:
            k = min(SHINGLE, words)
            self.runs[k] = min(self.runs.get(k, words), least_run(words - k + 1))
        self.table = np.zeros(size, np.uint8)
        self.mask = np.uint64(size - 1)
        np.maximum.at(self.table, places, steps)

    def weights(self, shingles: np.ndarray) -> np.ndarray:
        """The weight of every shingle."""
        step = self.table[(shingles & self.mask).astype(np.int64)]
        return np.where(step > 0, step * (self.top / STEPS), self.top)

    def windows(self, text: str | None) -> list[tuple[int, np.ndarray, list[tuple[np.ndarray, int, np.ndarray]]]]:
        """Stretches of the text that may hold items: ``start``, shingles, and their windows (places in the stretch, words,
        fingerprints), one entry per length of windows."""
        hashes = hashed_words(text)
        out = []
        for k, least in self.runs.items():
            shingles = runs(hashes, k)
            hit = self.table[(shingles & self.mask).astype(np.int64)] > 0
            run = hit
            for i in range(1, least):
                run = run[:-1] & hit[i:]
            if not run.any():
                continue
            hits = np.concatenate(([0], np.cumsum(hit)))
            found = {}
            for words in self.lengths:
                n = words - k + 1
                if min(SHINGLE, words) == k and n <= len(shingles) and hits[-1] >= SIMILAR * n:
                    at = np.flatnonzero(hits[n:] - hits[:-n] >= SIMILAR * n - 1e-9)
                    if len(at):
                        found[words] = at
            if not found:
                continue
            ends = np.concatenate([np.column_stack((at, at + words - k + 1)) for words, at in found.items()])
            for first, last in _stretches(ends[np.argsort(ends[:, 0], kind="stable")]):
                part = shingles[first:last]
                sums = np.concatenate((np.zeros((1, BITS)), np.cumsum(bits_of(part) * self.weights(part)[:, None], axis=0)))
                cut = []
                for words, at in found.items():
                    own = at[(at >= first) & (at < last)] - first
                    if len(own):
                        cut.append((own, words, fingerprints(sums[own + words - k + 1] - sums[own])))
                out.append((first, part, cut))
        return out


def _stretches(windows: np.ndarray) -> Iterator[tuple[int, int]]:
    """The stretches that windows (start, end; by start) cover without a gap."""
    reach = np.maximum.accumulate(windows[:, 1])
    gaps = np.flatnonzero(windows[1:, 0] > reach[:-1]) + 1
    for rows in np.split(np.arange(len(windows)), gaps):
        yield int(windows[rows[0], 0]), int(reach[rows[-1]])


def index_of(bags: DataFrame) -> Index:
    """The index; to the driver come the distinct lengths and the table's places, bounded by the table's largest size."""
    items = bags.count()
    lengths = sorted(r["words"] for r in bags.select("words").distinct().collect())
    each = bags.select(F.explode(F.array_distinct("shingles")).alias("shingle")).groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
    size = LEAST_TABLE
    total = each.count()
    while size < min(64 * total, LARGEST_TABLE):
        size *= 2
    step = F.greatest(F.lit(1), F.ceil(F.log1p(F.lit(items) / F.col("n")) / math.log1p(max(items, 1)) * STEPS)).cast("int")
    by_place = each.select(F.col("shingle").bitwiseAND(F.lit(size - 1).cast("long")).cast("int").alias("place"), step.alias("step"))
    rows = by_place.groupBy("place").agg(F.max("step").alias("step")).toPandas()
    return Index(lengths, rows["place"].to_numpy(np.int64), rows["step"].to_numpy(np.uint8), size, items)


def entered(bags: DataFrame, index: Index) -> DataFrame:
    """``place``, ``item``, ``item_print``: every item under all values close to its blocks; a place is the item's number of words, a
    block and a value."""
    flips = [near_values(width, FLIPS) for width in WIDTHS]

    def spread(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for item, words, shingles in zip(frame["item"], frame["words"], frame["shingles"], strict=True):
                hashes = np.array(shingles, np.int64).view(np.uint64)
                sums = (bits_of(hashes) * index.weights(hashes)[:, None]).sum(axis=0, keepdims=True)
                own = fingerprints(sums)[0]
                parts = [(int(own) >> shift) & ((1 << width) - 1) for shift, width in zip(SHIFTS, WIDTHS, strict=True)]
                yield pd.DataFrame({
                    "place": np.concatenate([(flips[i] ^ part) | ((int(words) * BLOCKS + i) << WIDTHS[0]) for i, part in enumerate(parts)]),
                    "item": item,
                    "item_print": own,
                })

    return bags.select("item", "words", "shingles").mapInPandas(spread, "place long, item long, item_print long")


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_id_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """One row per document and item found in it: keys of the document, ``item_id``, ``similarity`` (of the best window), and that
    window's ``start`` and ``words`` (in words).

    Null texts and texts without words hold nothing and are never found; an item of fewer than five words is one shingle. Ids may be
    null or repeat: rows alike in id and text are one document here. Other columns are not read. Entered items go to every
    executor if their counted size allows, and are joined by shuffling beyond that.
    """
    spark = docs.sparkSession
    small_batches(spark)
    # Items are numbered by their content: several with the same words are found together and named one by one at the end.
    bags = item_bags(items, item_id_column, item_text_column).withColumn("item", F.xxhash64("words", "shingles"))
    bags = stored_once(bags)
    unique = bags.dropDuplicates(["item"]).select("item", "words", "shingles")
    index = index_of(unique)
    shared = spark.sparkContext.broadcast(index)
    top = index.top

    stretch = "struct<start: int, shingles: array<long>, windows: array<struct<at: int, words: int, print: long>>>"

    @F.pandas_udf(f"array<{stretch}>")
    def windows(texts: pd.Series) -> pd.Series:
        found = []
        for text in texts:
            stretches = []
            for start, shingles, cut in shared.value.windows(text):
                rows = [{"at": a, "words": words, "print": p} for own, words, prints in cut for a, p in zip(own.tolist(), prints.tolist(), strict=True)]
                stretches.append({"start": start, "shingles": shingles.view(np.int64), "windows": rows})
            found.append(stretches)
        return pd.Series(found)

    text = col(text_column)
    held = docs.select(*content_key(col(id_column), text), F.explode(windows(text)).alias("s"))
    held = stored_once(held.select("key_id", "key_text", "s.*", F.monotonically_increasing_id().alias("stretch")))
    cut = held.select("stretch", F.explode("windows").alias("w")).select("stretch", "w.*")
    part = lambda value, i: F.shiftrightunsigned(value, SHIFTS[i]).bitwiseAND(F.lit((1 << WIDTHS[i]) - 1).cast("long"))
    places = F.array(*[part(F.col("print"), i) + ((F.col("words").cast("long") * BLOCKS + i) * (1 << WIDTHS[0])) for i in range(BLOCKS)])
    blocks = cut.select("*", F.explode(places).alias("place"))
    entries = stored_once(entered(unique, index))
    near = blocks.join(for_all(entries, 32), "place")
    differ = F.col("print").bitwiseXOR(F.col("item_print"))
    # A pair meets in several blocks; it goes on from the first in which it is close.
    close = [F.when(F.bit_count(part(differ, i)) <= FLIPS, F.lit(i)) for i in range(BLOCKS)]
    first = F.coalesce(*close) == F.shiftright("place", WIDTHS[0]) % BLOCKS
    near = near.filter((F.bit_count(differ) <= RADIUS) & first).select("stretch", "item", "at", "words")
    size = F.greatest(F.col("words") - SHINGLE + 1, F.lit(1))
    near = near.join(held.drop("windows"), "stretch").select(
        "key_id", "key_text", "item", (F.col("start") + F.col("at")).alias("start"), "words",
        F.slice("shingles", F.col("at") + 1, size).alias("shingles"),
    )
    facts = unique.join(
        unique.select("item", F.explode("shingles").alias("s")).join(_spread(unique), "s").groupBy("item").agg(F.map_from_entries(F.collect_set(F.struct("s", "weight"))).alias("by")),
        "item",
    ).select("item", F.col("shingles").alias("theirs"), F.transform("shingles", lambda s: F.col("by")[s]).alias("weights"))
    facts = stored_once(facts)

    @F.pandas_udf("double")
    def alike(window: pd.Series, item: pd.Series, weights: pd.Series) -> pd.Series:
        return pd.Series([similarity(a.tolist(), b.tolist(), w.tolist(), top) for a, b, w in zip(window, item, weights, strict=True)], dtype="float64")

    scored = near.join(for_all(facts, 2048), "item").withColumn("similarity", alike("shingles", "theirs", "weights"))
    scored = scored.filter(F.col("similarity") >= SIMILAR - 1e-9)
    best = scored.groupBy("key_id", "key_text", "item").agg(F.max(F.struct("similarity", (-F.col("start")).alias("s"), "words")).alias("w"))
    named = best.join(for_all(bags.select("item", "item_id"), 32), "item")
    return named.select("key_id", "key_text", "item_id", "w.similarity", (-F.col("w.s")).alias("start"), "w.words")


def _spread(unique: DataFrame) -> DataFrame:
    """``s`` and ``weight`` of every shingle of the items."""
    items = unique.count()
    each = unique.select("item", F.explode(F.array_distinct("shingles")).alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("n"))
    return each.select("s", F.log1p(F.lit(items) / F.col("n")).alias("weight"))


def clean(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents in which no item is found, all columns as they are. Rows alike in id and text share their fate."""
    found = stored_once(contaminated(docs, items, id_column, text_column).select("key_id", "key_text").distinct())
    keys = content_key(col(id_column), col(text_column))
    names = fresh(docs, "_id"), fresh(docs, "_text")
    marked = for_all(found.select(F.col("key_id").alias(names[0]), F.col("key_text").alias(names[1])), 32)
    return docs.join(marked, keys[0].eqNullSafe(F.col(names[0])) & (keys[1] == F.col(names[1])), "left_anti")


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item that is found in it."""
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("key_id").alias("doc_id"), "item_id", "similarity", "start", "words")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that hold no benchmark item."""
    return clean(docs, table(spark, sf_dir, "benchmark"))
