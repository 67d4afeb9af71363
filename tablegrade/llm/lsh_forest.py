"""N-gram Jaccard join by a MinHash LSH forest.

A document is its set of five-word shingles. Documents with the same set form a class; links join different classes whose sets are
similar. Every class has ``TREES`` signatures of ``DEEPEST`` minima each: paths in as many prefix tries. Classes that share a
prefix in any tree are candidates. A link of similarity ``s`` is found with probability ``1 - (1 - s ** depth) ** TREES``. Prefixes
are the longest for which even the weakest link, of similarity ``SIMILAR``, is found with the target's probability; so the
target holds for every link, however many strong ones there are.

Candidates are verified on whole sets, inside tasks: a task compares members of at most two blocks of one prefix and returns a row per
member, never the pairs. A pair that shares several trees counts in the first of them only. Large prefixes are split into
blocks that meet in different tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablegrade.llm.common import col, content_key, for_all, fresh, hashed_words, small_batches, table
from tablegrade.sources.state_files import stored_once

SHINGLE, SIMILAR = 5, 0.8
TREES, DEEPEST = 24, 9
RECALL = 0.99
#: Members of a prefix that are compared in one task with as many others.
BLOCK = 256

_MASK = (1 << 64) - 1
_MIX = 0x9E3779B97F4A7C15


def runs(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash of every run of so many words, in order."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, length, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(length):
            out = (out ^ hashes[i : n + i]) * np.uint64(_MIX)
            out ^= out >> np.uint64(29)
    return out


def shingles(text: str | None) -> np.ndarray:
    """The sorted set of hashed shingles. A text with fewer words than a shingle is one shingle; one without words has none."""
    hashes = hashed_words(text)
    return np.unique(runs(hashes, min(SHINGLE, len(hashes)))) if len(hashes) else np.empty(0, np.uint64)


def class_of(found: np.ndarray) -> bytes:
    """The name of the class of documents with this set."""
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


def _factors() -> tuple[np.ndarray, np.ndarray]:
    numbers = np.random.default_rng(20240229).integers(0, _MASK, (2, TREES * DEEPEST), np.uint64, endpoint=True)
    return numbers[0] | np.uint64(1), numbers[1]


_A, _B = _factors()


def signature(found: np.ndarray) -> np.ndarray:
    """The minima of all hash functions over a set, tree by tree."""
    low = np.full(TREES * DEEPEST, np.iinfo(np.uint32).max, np.uint32)
    with np.errstate(over="ignore"):
        for at in range(0, len(found), 1024):
            part = found[at : at + 1024]
            mixed = ((part[None, :] * _A[:, None] + _B[:, None]) >> np.uint64(32)).astype(np.uint32)
            low = np.minimum(low, mixed.min(axis=1))
    return low.view(np.int32)


def sketches(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``key_id``, ``key_text``, ``class``, ``n`` (shingles) and ``signature`` of every row, written once."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("class binary, n long, signature array<int>")
    def sketched(texts: pd.Series) -> pd.DataFrame:
        sets = [shingles(text) for text in texts]
        return pd.DataFrame({"class": [class_of(x) for x in sets], "n": [len(x) for x in sets], "signature": [signature(x) for x in sets]})

    text = col(text_column)
    rows = docs.select(*content_key(col(id_column), text), sketched(text).alias("s"))
    return stored_once(rows.select("key_id", "key_text", "s.*"))


def classes(sketched: DataFrame, depth: int) -> DataFrame:
    """One row per class: its smallest ``key_id``, a ``key_text`` of it, and its prefix in every tree.

    Rows of a class have equal prefixes, so the largest is the prefix.
    """
    prefix = [
        F.max(F.xxhash64(F.lit(tree), F.slice("signature", tree * DEEPEST + 1, depth))).alias(f"p{tree}") for tree in range(TREES)
    ]
    found = sketched.groupBy("class").agg(F.min("key_id").alias("class_id"), F.min("key_text").alias("key_text"), F.max("n").alias("n"), *prefix)
    return found.select("class", "class_id", "key_text", "n", F.array(*[f"p{tree}" for tree in range(TREES)]).alias("prefixes"))


def members(found: DataFrame) -> DataFrame:
    """Places where a class meets others: ``tree``, ``prefix``, two blocks ``low`` and ``high``, and its own ``block``."""
    entries = found.filter("n > 0").select("class", F.posexplode("prefixes").alias("tree", "prefix"))
    sizes = entries.groupBy("tree", "prefix").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    # Stored first, so that a prefix with many classes can be split in the join.
    met = entries.join(for_all(stored_once(sizes), 48), ["tree", "prefix"]).withColumn("blocks", blocks)
    met = met.withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return met.select("class", "tree", "prefix", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))


def sets_of(docs: DataFrame, wanted: DataFrame, text_column: str) -> DataFrame:
    """``class`` and ``shingles`` of the wanted classes, read again from the texts whose hashes ``wanted`` has."""
    hashes = wanted.select("key_text").distinct()
    text = col(text_column)
    texts = docs.select(F.xxhash64(F.coalesce(text, F.lit(""))).alias("key_text"), text.alias("text"))
    texts = texts.join(for_all(hashes, 16), "key_text", "left_semi").select("text")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()  # copies come once from every task
        for batch in batches:
            names, sets = [], []
            for value in batch.column(0).to_pylist():
                found = shingles(value)
                name = class_of(found)
                if name not in seen:
                    seen.add(name)
                    names.append(name)
                    sets.append(found.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(sets, pa.list_(pa.int64()))], ["class", "shingles"])

    return texts.mapInArrow(read, "class binary, shingles array<long>").groupBy("class").agg(F.any_value("shingles").alias("shingles"))


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """How many elements each two sets share."""
    values, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    common = counts > 1
    place = np.cumsum(common) - 1
    keep = common[inverse]
    owner, place = owner[keep], place[inverse[keep]]
    shared = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    for start in range(0, int(place[-1]) + 1 if len(place) else 0, 8192):
        low, high = np.searchsorted(place, [start, start + 8192])
        part = np.zeros((len(sets), 8192), np.float32)
        part[owner[low:high], place[low:high] - start] = 1
        shared += part @ part.T
    return shared


def compared(rows: list[tuple], tree: int, cross: bool) -> list[tuple]:
    """The verified links of one meeting: for each member with links, its class, their number, and the smallest class among those it
    is joined with."""
    names, blocks = [r[0] for r in rows], np.array([r[1] for r in rows])
    sets = [r[3] for r in rows]
    prefixes = np.array([r[2] for r in rows])
    sizes = np.array([len(x) for x in sets], np.float32)
    shared = overlaps(sets)
    similar = shared / (sizes[:, None] + sizes[None, :] - shared)
    a, b = np.nonzero(np.triu(similar >= SIMILAR - 1e-6, 1))
    if cross:
        differ = blocks[a] != blocks[b]
        a, b = a[differ], b[differ]
    first = np.argmax(prefixes[a] == prefixes[b], axis=1) == tree if len(a) else np.empty(0, bool)
    a, b = a[first], b[first]
    if not len(a):
        return []
    root = list(range(len(rows)))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in zip(a.tolist(), b.tolist(), strict=True):
        x, y = top(i), top(j)
        if x != y:
            root[max(x, y, key=lambda k: names[k])] = min(x, y, key=lambda k: names[k])
    links = np.zeros(len(rows), np.int64)
    for side in (a, b):
        np.add.at(links, side, 1)
    return [(names[i], int(links[i]), names[top(i)]) for i in np.flatnonzero(links).tolist()]


def verified(met: DataFrame, payload: DataFrame) -> DataFrame:
    """``class``, ``links``, ``lead`` for every meeting in which a class has links."""
    place = ["tree", "prefix", "low", "high"]
    rows = met.join(payload, "class").select(*place, "class", "block", "prefixes", "shingles")
    rows = rows.repartition(*place).sortWithinPartitions(*place, "class")

    def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, out = None, [], []

        def ready() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [[]] * 3
            out.clear()
            kinds = (pa.binary(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["class", "links", "lead"])

        for batch in batches:
            columns = [batch.column(i) for i in range(8)]
            keys = list(zip(*(c.to_pylist() for c in columns[:4]), strict=True))
            for i, key in enumerate(keys):
                if key != now:
                    if len(held) > 1:
                        out.extend(compared(held, now[0], now[2] != now[3]))
                    now, held = key, []
                prefixes = columns[6][i].values.to_numpy(zero_copy_only=False)
                found = columns[7][i].values.to_numpy(zero_copy_only=False)
                held.append((columns[4][i].as_py(), columns[5][i].as_py(), prefixes, np.array(found)))
            if len(out) > 10_000:
                yield ready()
        if len(held) > 1:
            out.extend(compared(held, now[0], now[2] != now[3]))
        yield ready()

    return rows.mapInArrow(streamed, "class binary, links long, lead binary")


def chance(similarity: float, depth: int) -> float:
    """The probability that a link is found with prefixes of so many minima."""
    return 1 - (1 - similarity**depth) ** TREES


def depth_for(target: float) -> int:
    """The longest prefixes with which the weakest link is found with the target's probability; an error if none are."""
    for depth in range(DEEPEST, 0, -1):
        if chance(SIMILAR, depth) >= target:
            return depth
    raise ValueError(f"{TREES} trees don't reach a recall of {target}")


def joined(docs: DataFrame, sketched: DataFrame, text_column: str = "text", target: float = RECALL) -> tuple[DataFrame, DataFrame]:
    """Classes and verified links at the longest prefixes that find every link with the target's probability."""
    depth = depth_for(target)
    found = stored_once(classes(sketched, depth))
    met = stored_once(members(found))
    wanted = found.join(met.select("class").distinct(), "class", "left_semi")
    payload = sets_of(docs, wanted, text_column).join(found.select("class", "prefixes"), "class")
    return found, stored_once(verified(met, payload))


def components(edges: DataFrame) -> DataFrame:
    """``class`` and ``root``, the smallest class that it is connected with, of every class in ``edges`` (``class``, ``lead``).

    Alternating large and small stars, each round written to the shared folder, until nothing changes. What a round joins is
    stored first: a join of stored tables can be split where a class has many neighbours.
    """
    pairs = stored_once(edges.filter("class != lead").select(F.greatest("class", "lead").alias("u"), F.least("class", "lead").alias("v")).distinct())
    seen = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = stored_once(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")))
        large = both.filter("v > u").join(for_all(low, 64), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored_once(large.filter("u != v").distinct())
        low = stored_once(large.groupBy("u").agg(F.min("v").alias("m")))
        moved = large.join(for_all(low, 64), "u")
        small = moved.select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")).unionByName(moved.select("u", F.col("m").alias("v")))
        pairs = stored_once(small.filter("u != v").distinct())
        state = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            return pairs.select(F.col("u").alias("class"), F.col("v").alias("root"))
        seen = state


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", target: float = RECALL) -> DataFrame:
    """One row per document: keys, ``class`` and ``class_id`` (copies: documents with the same shingles; the smallest id among them),
    ``n_links`` (other classes at similarity 0.8 or more), ``group`` and ``group_id`` (connected classes; the smallest id).

    Documents without words form a class without links. Null ids are larger than all; a class without any other has a null
    ``class_id``. Ids and rows may repeat. Other columns are not read. Shingles are compared by 64-bit hashes.
    """
    sketched = sketches(docs, id_column, text_column)
    found, links = joined(docs, sketched, text_column, target)
    counts = links.groupBy("class").agg(F.sum("links").alias("n_links"))
    roots = components(links.select("class", "lead"))
    named = found.select("class", "class_id").join(counts, "class", "left").join(roots, "class", "left")
    named = named.select("class", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("root", "class").alias("group"))
    named = stored_once(named)
    smallest = stored_once(named.groupBy("group").agg(F.min("class_id").alias("group_id")))
    named = stored_once(named.join(for_all(smallest, 48), "group"))
    return sketched.select("key_id", "key_text", "class").join(named, "class")


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents of which one stays in every group: the one with the smallest id, then the smallest hash of its text.

    All columns stay as they are. Null ids come last; of rows alike in id and text one stays.
    """
    rows = stored_once(near_duplicates(docs, id_column, text_column).select("key_id", "key_text", "group"))
    order = F.struct(F.col("key_id").isNull().alias("last"), "key_id", "key_text")
    # The one that stays is counted together with its own rows, so that no group meets in one place.
    kept = rows.groupBy("group").agg(F.min(order).alias("kept"))
    kept = kept.select("group", "kept.key_id", "kept.key_text", F.lit(0).alias("times"), F.lit(True).alias("stays"))
    every = rows.select("group", "key_id", "key_text", F.lit(1).alias("times"), F.lit(False).alias("stays")).unionByName(kept)
    counted = every.groupBy("group", "key_id", "key_text").agg(F.sum("times").alias("times"), F.bool_or("stays").alias("stays"))
    marked = stored_once(counted.select("key_id", "key_text", "times", "stays").filter("NOT stays OR times > 1"))
    texts = content_key(col(id_column), col(text_column))

    def matched(source: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        names = fresh(source, "_id"), fresh(source, "_text")
        same = texts[0].eqNullSafe(F.col(names[0])) & (texts[1] == F.col(names[1]))
        return source.join(for_all(keys.select(F.col("key_id").alias(names[0]), F.col("key_text").alias(names[1])), 32), same, how)

    left = matched(docs, marked, "left_anti")
    again = matched(docs, marked.filter("stays"), "left_semi").dropDuplicates([id_column, text_column])
    return left.unionByName(again)


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's class of copies, the number of other classes it is linked with, and its group of linked classes."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("key_id").alias("doc_id"), "class_id", "n_links", "group_id")


def deduplication_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of every group."""
    return one_of_each(docs)
