"""Toxic passages: maximal scoring segments over token log-odds.

A token's score is its log-odds of standing in a toxic document, against the share of all tokens that do, less a fixed drift.
Counts are of documents. Odds have Dirichlet priors that go up a chain: a word's prior mean is the odds of its first six
letters, theirs those of the first five, and so on to the share of all tokens. So a rare or new form of a known
word is scored by its relatives, and an unknown token by the share of all. Counts are kept in a hashed table of fixed size.
Counts of documents serve learning only; in a text a token has its score at every place.

All maximal segments (in the sense of Ruzzo and Tompa) of a text are found in one pass. Their scores are set against what the best segment
of a clean text of that length would score, by extreme-value statistics (Karlin and Altschul): a segment of score ``S``
among ``n`` tokens is expected ``K n exp(-lambda S)`` times. The surprise of all significant segments is added up, and a
logistic curve fitted to labelled documents turns it into a probability.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablegrade.llm.common import WORD, col, for_all, remainder, small_batches, table
from tablegrade.sources.state_files import stored_once

#: Places of the hashed table; prior weight in documents; drift subtracted from every token's score.
PLACES, WEIGHT, DRIFT = 1 << 18, 16.0, 1.0
#: Letters of the prefixes that a word's prior goes through, longest first.
PREFIXES = (6, 5, 4)
#: Labelled documents expected in the sample on which calibration is fitted.
CALIBRATION_SAMPLE = 20_000
#: A segment counts if fewer than this many as good are expected in a clean text of the same length.
EXPECTED = 0.3
THRESHOLD = 0.3
_KEPT_WORDS = 300_000


def tokens(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def chain(word: str) -> list[int]:
    """Places of a word's prefixes, shortest first, and of the word itself."""
    kinds = [word[:n] + "*" for n in sorted(PREFIXES) if len(word) > n] + [word]
    return [zlib.crc32(kind.encode("utf-8", "surrogatepass")) % PLACES for kind in kinds]


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments ``(start, end, score)``, end excluded, by Ruzzo and Tompa's linear-time scan."""
    if not len(scores):
        return []
    total = np.concatenate(([0.0], np.cumsum(scores, dtype=np.float64)))
    found: list[list] = []  # start, end, total before, total after, nearest earlier one with a smaller total before
    for i in np.flatnonzero(scores > 0).tolist():
        start, end, before, after = i, i + 1, total[i], total[i + 1]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= before:
                j = found[j][4]
            if j < 0 or found[j][3] >= after:
                found.append([start, end, before, after, j])
                break
            start, before = found[j][0], found[j][2]
            del found[j:]
    return [(start, end, float(after - before)) for start, end, before, after, _ in found]


@dataclass
class Toxicity:
    """The learned model: document counts by place, the share of toxic ones, and the calibration."""

    toxic: np.ndarray
    clean: np.ndarray
    share: float
    scale: float = 1.0
    expected: float = 1.0
    slope: float = 1.0
    shift: float = 0.0

    def __post_init__(self) -> None:
        self._scores: dict[str, float] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_scores": {}}

    def odds(self, word: str, less: tuple[int, int] = (0, 0)) -> float:
        """A token's score. ``less`` leaves one document's own counts out, toxic or clean."""
        mean = self.share
        for place in chain(word):
            bad, good = self.toxic[place] - less[0], self.clean[place] - less[1]
            mean = (max(bad, 0) + WEIGHT * mean) / (max(bad, 0) + max(good, 0) + WEIGHT)
        mean = min(max(mean, 1e-9), 1 - 1e-9)
        return math.log(mean / (1 - mean)) - math.log(self.share / (1 - self.share)) - DRIFT

    def scores(self, words: list[str]) -> np.ndarray:
        kept = self._scores
        if len(kept) > _KEPT_WORDS:
            kept.clear()
        for word in set(words).difference(kept):
            kept[word] = self.odds(word)
        return np.fromiter(map(kept.__getitem__, words), np.float64, len(words))

    def surprise(self, found: list[tuple[int, int, float]], length: int) -> float:
        """Summed surprise of the significant segments of a text."""
        usual = math.log(max(self.expected * length, 1.0)) - math.log(EXPECTED)
        return sum(max(0.0, self.scale * score - usual) for _, _, score in found)

    def passages(self, text: str | None) -> list[tuple[int, int, float]]:
        """The significant segments of a text: first word, word after the last, expected number in a clean text."""
        words = tokens(text)
        found = [(a, b, self.expected * len(words) * math.exp(-self.scale * s)) for a, b, s in segments(self.scores(words))]
        return [x for x in found if x[2] <= EXPECTED]

    def probability(self, surprise: float) -> float:
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, self.slope * math.log1p(surprise) + self.shift))))

    def score(self, text: str | None) -> float:
        words = tokens(text)
        return self.probability(self.surprise(segments(self.scores(words)), len(words)))


def _solved(scores: np.ndarray, counts: np.ndarray) -> float:
    """The positive root of ``sum p exp(x s) = 1``, for scores of negative mean; 1 where there is none."""
    p = counts / counts.sum()
    if scores.max() <= 0 or (p * scores).sum() >= 0:
        return 1.0
    low, high = 1e-6, 1.0
    while (p * np.exp(np.minimum(high * scores, 700))).sum() < 1 and high < 50:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if (p * np.exp(np.minimum(middle * scores, 700))).sum() < 1 else (low, middle)
    return (low + high) / 2


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve, by Newton's method with a weak pull towards 1 and 0."""
    w = np.array([1.0, 0.0])
    design = np.column_stack([x, np.ones(len(x))])
    pull = np.array([0.1, 0.01])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        slope = design.T @ (p - y) + pull * (w - np.array([1.0, 0.0]))
        bend = (design * (p * (1 - p))[:, None]).T @ design + np.diag(pull)
        step = np.linalg.solve(bend, slope)
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(w[0], 0.0)), float(w[1])


def labelled_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and ``toxic`` of labelled documents, one for each text, so that copies don't weigh more.

    Several labels of an id or of a text: toxic if one is. Copies are found by a hash of the text, without moving it.
    """
    known = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    hashes = docs.filter("text IS NOT NULL").select("doc_id", F.xxhash64("text").alias("hash")).join(known, "doc_id")
    chosen = hashes.groupBy("hash").agg(F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic"))
    chosen = stored_once(chosen)
    texts = docs.filter("text IS NOT NULL").select("doc_id", "text", F.xxhash64("text").alias("hash"))
    return texts.join(for_all(chosen, 32), ["doc_id", "hash"]).select("doc_id", "text", "toxic")


def learn(training: DataFrame, sample: int = CALIBRATION_SAMPLE) -> Toxicity:
    """A model from all rows of ``text`` and ``toxic`` (0 or 1).

    Counts cover all rows; to the driver come the fixed table's places and figures of about ``sample`` documents, chosen by a
    hash of the text, whose own counts are left out when they are scored. Without rows of both kinds nothing is toxic.
    """
    small_batches(training.sparkSession)
    rows = training.select("text", (F.col("toxic") > 0).cast("int").alias("toxic"))

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((4, PLACES), np.int64)  # documents, clean and toxic, with the feature; last rows hold sums
        docs = np.zeros((2, 3), np.int64)
        for frame in frames:
            for text, toxic in zip(frame["text"], frame["toxic"], strict=True):
                words = set(tokens(text))
                places = np.unique(np.array([p for word in words for p in chain(word)], np.int64))
                total[toxic, places] += 1
                docs[toxic] += (1, len(words), 0)
        at = np.flatnonzero(total[0] + total[1])
        yield pd.DataFrame({"place": at, "clean": total[0, at], "toxic": total[1, at]})
        yield pd.DataFrame({"place": [-1, -2], "clean": docs[0, :2], "toxic": docs[1, :2]})

    sums = rows.mapInPandas(counted, "place long, clean long, toxic long").groupBy("place")
    table_ = sums.agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toPandas().to_numpy(np.int64).reshape(-1, 3)
    by_place = {int(r[0]): r for r in table_[table_[:, 0] < 0]} if len(table_) else {}
    good, bad = (by_place[-1][1], by_place[-1][2]) if by_place else (0, 0)
    clean, toxic = np.zeros(PLACES, np.float32), np.zeros(PLACES, np.float32)
    used = table_[table_[:, 0] >= 0] if len(table_) else table_
    clean[used[:, 0]], toxic[used[:, 0]] = used[:, 1], used[:, 2]
    if not good or not bad:
        return Toxicity(toxic, clean, 0.5, shift=-20.0, slope=0.0)
    model = Toxicity(toxic, clean, float(by_place[-2][2] / (by_place[-2][1] + by_place[-2][2])))
    return calibrated(model, rows, min(1.0, sample / float(good + bad)))


def calibrated(model: Toxicity, rows: DataFrame, fraction: float) -> Toxicity:
    """The model with scale, expected number and curve fitted to a fraction of the labelled rows."""
    edges = np.round(np.arange(-8, 12.01, 0.1), 1)
    chosen = rows.filter(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < fraction * (1 << 20))

    def looked_at(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: tuple[dict, dict] = ({}, {})
        histogram = np.zeros(len(edges) + 1, np.int64)
        for frame in frames:
            out = []
            for text, toxic in zip(frame["text"], frame["toxic"], strict=True):
                words, own = tokens(text), kept[toxic]
                if len(own) > _KEPT_WORDS:
                    own.clear()
                for word in set(words).difference(own):
                    own[word] = model.odds(word, (toxic, 1 - toxic))
                scores = np.fromiter(map(own.__getitem__, words), np.float64, len(words))
                if not toxic:
                    histogram += np.bincount(np.searchsorted(edges, scores), minlength=len(edges) + 1)
                out.append((toxic, len(words), [s for _, _, s in segments(scores)], -1, 0))
            yield pd.DataFrame(out, columns=["toxic", "length", "found", "bin", "n"])
        at = np.flatnonzero(histogram)
        yield pd.DataFrame({"toxic": 0, "length": 0, "found": pd.Series([[] for _ in at], dtype=object), "bin": at, "n": histogram[at]})

    # The sample is bounded, so the segment scores of its documents may be collected.
    seen = stored_once(chosen.mapInPandas(looked_at, "toxic int, length long, found array<double>, bin int, n long"))
    rows_ = seen.filter("bin < 0").select("toxic", "length", "found").toPandas().to_dict("records")
    bins = seen.filter("bin >= 0").groupBy("bin").agg(F.sum("n").alias("n")).toPandas()
    clean = [r for r in rows_ if not r["toxic"] and r["length"]]
    if clean:
        counts = np.zeros(len(edges) + 1)
        counts[bins["bin"].to_numpy(np.int64)] = bins["n"]
        middles = np.concatenate((edges[:1], (edges[:-1] + edges[1:]) / 2, edges[-1:]))
        model.scale = _solved(middles[counts > 0], counts[counts > 0])
        best = np.array([max(r["found"], default=0.0) for r in clean])
        length = np.array([r["length"] for r in clean], float)
        # The mean of the largest of n: (log(K n) + Euler's constant) / scale.
        model.expected = float(np.exp(np.mean(model.scale * best - np.log(length)) - 0.5772156649))
    x = np.array([math.log1p(model.surprise([(0, 0, s) for s in r["found"]], r["length"])) for r in rows_])
    y = np.array([float(r["toxic"]) for r in rows_])
    if len(set(y.tolist())) == 2:
        model.slope, model.shift = _curve(x, y)
    return model


def toxicity_of(text: Column, model: Toxicity, spark: SparkSession) -> Column:
    """The probability that a text is toxic; the model has a fixed size."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def probability(texts: pd.Series) -> pd.Series:
        return pd.Series([shared.value.score(x) for x in texts], dtype="float64")

    return probability(text)


def toxic_passages(docs: DataFrame, model: Toxicity, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per significant passage: id, first word, word after the last, expected number in a clean text."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("array<struct<first_word: long, end_word: long, expected: double>>")
    def found(texts: pd.Series) -> pd.Series:
        return pd.Series([[dict(zip(("first_word", "end_word", "expected"), x, strict=True)) for x in shared.value.passages(t)] for t in texts])

    rows = docs.select(col(id_column).alias("doc_id"), F.explode(found(col(text_column))).alias("passage"))
    return rows.select("doc_id", "passage.*")


def score(docs: DataFrame, model: Toxicity, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, ``score`` (0 to 1), ``predicted``.

    A null text counts as empty; an empty one gets what the curve says of no surprise. Ids may be null or repeat; other
    columns are not read.
    """
    small_batches(docs.sparkSession)
    said = docs.select(col(id_column).alias("doc_id"), toxicity_of(col(text_column), model, docs.sparkSession).alias("score"))
    return said.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by what is learned from labelled ones that are not held out. A null id is not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(remainder(F.col("doc_id"), 4) != 2)
    found = score(docs, learn(labelled_texts(docs, labels)))
    held_out = F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that are not predicted toxic, learned from the labels of the documents given."""
    small_batches(spark)
    model = learn(labelled_texts(docs, table(spark, sf_dir, "labels")))
    return docs.filter(toxicity_of(F.col("text"), model, spark) < THRESHOLD)
