"""Periodic runs: stretches of words that repeat with a period, found by the branching-tandem test on suffix arrays.

A square ``ww`` at word ``i`` with ``|w| = d`` *branches* if the word after it breaks the period. Then the suffixes at
``i`` and ``i + d`` share exactly ``d`` words, so they lie in different children of the LCP interval of depth ``d``.
Of every interval, the suffixes of all children but the largest look whether the suffix ``d`` words further or before is
in the same interval (a comparison of its place in the suffix array, ``ISA[i ± d]``, with the interval's ends). Every suffix is in a
smaller child at most ``log n`` times. No tree is built; intervals are known by their ends.

Every run ends with a branching square of its period, and of every multiple of the period that fits twice. Rotating that square to
the left as long as the words agree gives the run's start; squares that end up at the same place are one run.
A run of at least ``least`` words has a multiple of its period that fits twice and is no less than
``least_depth(least)``, so shallower intervals, which hold most suffixes of ordinary prose, are never opened.

The suffix array comes from prefix doubling. The ranks of all doublings are kept, for they tell the common length
of any two suffixes, forwards and backwards, without hashing. Several texts are done at a time, each with word numbers
of its own, so that copies of a text in one batch don't meet.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tablegrade.llm.common import col, small_batches, table

#: Words that a task works on at a time; a longer text is done by itself.
BATCH_WORDS = 1 << 16

#: Membership tests done at a time.
TESTS = 1 << 20

LONGS = ["n_runs", "start", "length", "period", "exponent_milli"]
HASHES = ["runs_sha256", "collapsed_sha256"]
TEXTS = ["runs", "collapsed"]


def least_depth(least: int) -> int:
    """The smallest depth at which every run of ``least`` words or more has a branching square.

    >>> least_depth(12)
    4
    """
    fitting = [least // (2 * period) * period for period in range(1, least // 2 + 1)]
    return min(fitting)


class Suffixes:
    """Ranks of all substrings of a power-of-two length, and the suffix array of what repeats at length ``depth``."""

    def __init__(self, words: np.ndarray, depth: int):
        """``words`` are numbers below their count; every text in it ends with a number that occurs once."""
        n = len(words)
        self.levels = [words.astype(np.int32)]
        places = np.arange(n)
        while True:
            length = 1 << (len(self.levels) - 1)
            ranks = self.levels[-1]
            if length < depth:
                # all places are sorted anew; what reaches over the end holds a word that occurs once
                key = ranks.astype(np.int64) * n
                key[: n - length] += ranks[length:]
            else:
                # only places that aren't alone; none of them reaches over the end
                places = places[np.bincount(ranks, minlength=n)[ranks[places]] > 1]
                if not len(places):
                    break
                key = ranks[places].astype(np.int64) * n + ranks[places + length]
            order = np.argsort(key, kind="stable")
            ordered = key[order]
            new = np.concatenate(([True], ordered[1:] != ordered[:-1]))
            at = np.arange(len(order))
            heads = np.maximum.accumulate(np.where(new, at, 0))
            if length >= depth:
                # the rank of a group is the place of its first suffix in the array
                group = np.maximum.accumulate(np.where(np.concatenate(([True], ordered[1:] // n != ordered[:-1] // n)), at, 0))
                heads = heads - group + ordered // n
            following = ranks.copy()
            following[places[order]] = heads
            self.levels.append(following)
        self.isa = self.levels[-1]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words the suffixes at ``a`` and ``b`` share; no two places are equal."""
        a, b = a.copy(), b.copy()
        total = np.zeros(len(a), np.int64)
        for level in range(len(self.levels) - 2, -1, -1):
            ranks = self.levels[level]
            step = (ranks[a] == ranks[b]) * (1 << level)
            total += step
            a += step
            b += step
        return total

    def common_before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words before ``a`` and ``b`` agree; ``a < b``."""
        a, b = a.copy(), b.copy()
        total = np.zeros(len(a), np.int64)
        for level in range(len(self.levels) - 2, -1, -1):
            ranks, length = self.levels[level], 1 << level
            step = ((a >= length) & (ranks[np.maximum(a - length, 0)] == ranks[np.maximum(b - length, 0)])) * length
            total += step
            a -= step
            b -= step
        return total


def smaller_children(lcp: list[int], offset: int) -> Iterator[tuple[int, int, int, int, int]]:
    """Of all LCP intervals, the children but the largest: ``(child's first, its end, depth, first, end)``.

    ``lcp[k]`` is what the suffixes ``offset + k`` and ``offset + k + 1`` of the array share.
    """
    open_: list[tuple[int, list[int]]] = []
    for k, depth in enumerate([*lcp, 0]):
        left = k
        while open_ and open_[-1][0] > depth:
            found, bounds = open_.pop()
            bounds.append(k + 1)
            left = bounds[0]
            sizes = [b - a for a, b in zip(bounds, bounds[1:], strict=False)]
            largest = sizes.index(max(sizes))
            for child in range(len(sizes)):
                if child != largest:
                    yield offset + bounds[child], offset + bounds[child + 1], found, offset + left, offset + k + 1
        if depth:
            if open_ and open_[-1][0] == depth:
                open_[-1][1].append(k + 1)
            else:
                open_.append((depth, [left, k + 1]))


def branching_squares(suffixes: Suffixes, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and half length of every branching square whose half has ``depth`` words or more, a power of two."""
    top = depth.bit_length() - 1
    grams, isa = suffixes.levels[top], suffixes.isa
    repeated = np.flatnonzero(np.bincount(grams, minlength=len(grams))[grams] > 1) if top < len(suffixes.levels) - 1 else np.empty(0, int)
    if not len(repeated):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    repeated = repeated[np.argsort(isa[repeated])]
    array = np.full(len(isa), -1, np.int64)
    array[isa[repeated]] = repeated
    same = grams[repeated[1:]] == grams[repeated[:-1]]
    edges = np.flatnonzero(~same) + 1
    lcp = np.zeros(len(repeated) - 1, np.int64)
    lcp[same] = suffixes.common(repeated[:-1][same], repeated[1:][same])
    starts, halves = [], []
    children: list[tuple[int, int, int, int, int]] = []
    waiting = 0

    def test() -> None:
        first, end, half, low, high = np.array(children, np.int64).T
        sizes = end - first
        owner = np.repeat(np.arange(len(sizes)), sizes)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + first[owner]
        place, half, low, high, first, end = array[at], half[owner], low[owner], high[owner], first[owner], end[owner]
        for other in (place + half, place - half):
            inside = (other >= 0) & (other < len(isa))
            rank = isa[np.where(inside, other, 0)]
            inside &= (rank >= low) & (rank < high) & ((rank < first) | (rank >= end))
            starts.append(np.minimum(place, other)[inside])
            halves.append(half[inside])
        children.clear()

    for a, b in zip(np.concatenate(([0], edges)), np.concatenate((edges, [len(repeated)])), strict=True):
        for child in smaller_children(lcp[a : b - 1].tolist(), int(isa[repeated[a]])):
            children.append(child)
            waiting += child[1] - child[0]
            if waiting >= TESTS:
                test()
                waiting = 0
    if children:
        test()
    return np.concatenate(starts), np.concatenate(halves)


def runs_of(words: np.ndarray, least: int = 12) -> np.ndarray:
    """Rows ``(start, length, period)`` of all runs, sorted; ``words`` as for ``Suffixes``.

    A run is a stretch of at least ``least`` words, and of two periods, that no neighbouring word extends.
    """
    depth = 1 << (least_depth(least).bit_length() - 1)
    suffixes = Suffixes(words, depth)
    place, half = branching_squares(suffixes, depth)
    if not len(place):
        return np.empty((0, 3), np.int64)
    start = place - suffixes.common_before(place, place + half)
    found = np.stack([start, place + 2 * half - start, half], axis=1)
    found = found[found[:, 1] >= least]
    found = found[np.lexsort(found.T[::-1])]
    found = found[np.concatenate(([True], (found[1:, :2] != found[:-1, :2]).any(axis=1)))] if len(found) else found
    for row in found:
        begin, length, period = row.tolist()
        for shorter in range(1, min(depth, period)):
            # a smaller period than the depth is only known by its multiples
            if period % shorter == 0 and (words[begin : begin + length - shorter] == words[begin + shorter : begin + length]).all():
                row[2] = shorter
                break
    return found


def planted(doc_id: object, words: list[bytes]) -> list[bytes]:
    """The words with a periodic end in one of ten documents, by the checksum of the id; a null id has none."""
    n = len(words)
    checksum = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if checksum % 10 or not n:
        return words
    g = checksum // 10
    first = g % n
    period = 1 + (n - first) // (3 + g % 8)
    repeats = -(-(n - first) // period)
    return words[:first] + (words[first : first + period] * repeats)[: n - first]


def numbered(texts: list[list[bytes]]) -> np.ndarray:
    """All words as numbers, each text with numbers of its own and one more at its end."""
    parts, taken = [], 0
    for words in texts:
        numbers: dict[bytes, int] = {}
        found = [numbers.setdefault(word, len(numbers)) for word in words]
        found.append(len(numbers))
        parts.append(np.array(found, np.int64) + taken)
        taken += len(numbers) + 1
    return np.concatenate(parts)


def listed(runs: list[tuple[int, int, int]]) -> str:
    """Runs as text, one per line."""
    return "".join(f"{start},{length},{period}\n" for start, length, period in runs)


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The text without the words that lie in a run, but not in its first period."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int32)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return b" ".join([words[k] for k in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()])


def summary(words: list[bytes], runs: list[tuple[int, int, int]], with_runs: bool) -> tuple:
    """The columns ``LONGS``, ``HASHES`` and perhaps ``TEXTS`` of a text and its runs, sorted by start and period."""
    longest: tuple = (None,) * 4
    if runs:
        start, length, period = min(runs, key=lambda run: (-run[1], run[0], run[2]))
        longest = (start, length, period, 1000 * length // period)
    lines, rest = listed(runs).encode(), collapsed(words, runs)
    texts = (lines.decode(), rest.decode()) if with_runs else ()
    return (len(runs), *longest, hashlib.sha256(lines).hexdigest(), hashlib.sha256(rest).hexdigest(), *texts)


def runs_of_texts(texts: list[list[bytes]], least: int) -> list[list[tuple[int, int, int]]]:
    """The runs of each text."""
    ends = np.cumsum([len(words) + 1 for words in texts])
    found = runs_of(numbered(texts), least)
    owner = np.searchsorted(ends, found[:, 0], side="right")
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for text, (start, length, period) in zip(owner.tolist(), found.tolist(), strict=True):
        out[text].append((start - (int(ends[text - 1]) if text else 0), length, period))
    return [sorted(runs, key=lambda run: (run[0], run[2])) for runs in out]


def periodic_runs(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    least: int = 12,
    damaged: bool = False,
    with_runs: bool = False,
) -> DataFrame:
    """One row per document with its id: ``n_runs``, the longest run (``start`` in words from 0, ``length``, ``period``,
    ``exponent_milli``; nulls if there is none), ``runs_sha256`` and ``collapsed_sha256``, hashes of the list of runs and of
    the text without what every run repeats. ``with_runs`` adds ``runs`` (``start,length,period`` per line) and ``collapsed``.

    Words are runs of characters other than ASCII white space. A null or empty text has no words and no runs. Ids may be null or
    repeat: every row is judged by itself. Other columns are not read, nothing is shuffled, and a task holds one batch of texts.
    Ranks take 4 bytes per word and doubling, so the longest text sets the memory.
    ``damaged`` first plants periodic ends (see ``planted``).
    """
    if least < 4:
        raise ValueError("runs of fewer than 4 words are not looked for")
    small_batches(docs.sparkSession)
    source = docs.select(col(id_column).alias(id_column), col(text_column).alias("_text"))
    strings = HASHES + (TEXTS if with_runs else [])
    fields = [(name, LongType()) for name in LONGS] + [(name, StringType()) for name in strings]
    schema = StructType([StructField(id_column, source.schema[0].dataType), *[StructField(*field) for field in fields]])
    kinds = [pa.int64()] * len(LONGS) + [pa.string()] * len(strings)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        id_type = None

        def rows(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
            found = runs_of_texts(texts, least)
            out = [summary(words, runs, with_runs) for words, runs in zip(texts, found, strict=True)]
            columns = [pa.array(column, kind) for column, kind in zip(zip(*out, strict=True), kinds, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(ids, id_type), *columns], schema.fieldNames())

        for batch in batches:
            id_type = batch.column(0).type
            ids, texts, held = [], [], 0
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = (text.as_py() or "").encode().split()
                if texts and held + len(words) > BATCH_WORDS:
                    yield rows(ids, texts)
                    ids, texts, held = [], [], 0
                ids.append(doc)
                texts.append(planted(doc, words) if damaged else words)
                held += len(words) + 1
            if ids:
                yield rows(ids, texts)

    return source.mapInArrow(judged, schema)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of all documents, after periodic ends were planted in one of ten."""
    return periodic_runs(table(spark, sf_dir, "documents"), damaged=True)
