"""Language identification by rank-order profiles.

A language's profile is the list of its most frequent letter n-grams in order. A document's own most frequent n-grams are compared
with each profile by the out-of-place distance: how many ranks each n-gram stands from its rank in the profile, or the
whole length of the profile where it isn't listed. The nearest profile wins.

N-grams lie within words, with the blank before and after a word as one more letter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablegrade.llm.common import col, fresh, remainder, small_batches, table
from tablegrade.sources.state_files import stored_once

#: Length of the longest n-grams, and of the profiles.
LONGEST, RANKS = 3, 400
#: Documents of each language that ``sampled`` is expected to choose.
SAMPLE = 3000
#: Distinct n-grams of all languages that a task counts before it passes the counts on.
HELD_GRAMS = 500_000
UNKNOWN = "und"
#: Of the score of labelled documents, what a document must reach to be kept by the pipeline (see ``least_score``).
MARGIN = 0.8


@cache
def _letters() -> np.ndarray:
    """Which code points are letters. Number signs such as ``²`` are none here, although they belong to words elsewhere."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def grams(text: str | None, longest: int = LONGEST) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of a text as numbers (code points in base 2^21), most frequent first, ties by number; and how often."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), "<u4")
    inside = _letters()[points]
    if not inside.any():
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    # One blank before the first word, and one for whatever follows a word.
    ends = np.diff(inside.view(np.int8), append=0) < 0
    code = np.insert(points[inside].astype(np.uint64), np.cumsum(inside)[ends], np.uint64(32))
    code = np.concatenate([np.array([32], np.uint64), code])
    blank = code == 32
    found, run, inner = [code[~blank]], code, np.zeros(len(code), bool)
    for n in range(2, longest + 1):
        run = (run[:-1] << np.uint64(21)) | code[n - 1 :]
        inner = inner[:-1] | (blank[n - 2 : -1] if n > 2 else False)
        found.append(run[~inner])
    values, counts = np.unique(np.concatenate(found), return_counts=True)
    order = np.argsort(-counts, kind="stable")
    return values[order], counts[order]


@dataclass
class Profiles:
    """Sorted n-grams of all profiles, and every language's rank of each (``ranks`` where it isn't listed)."""

    languages: list[str]
    known: np.ndarray
    places: np.ndarray
    ranks: int

    def nearest(self, text: str | None) -> tuple[str, float]:
        """The nearest language, and 1 minus its distance as a share of the largest possible. Ties go to the first name."""
        own = grams(text)[0][: self.ranks]
        if not len(own) or not self.languages:
            return UNKNOWN, 0.0
        at = np.minimum(np.searchsorted(self.known, own), len(self.known) - 1)
        theirs = np.where(self.known[at] == own, self.places[:, at], self.ranks)
        far = np.where(theirs == self.ranks, self.ranks, np.abs(theirs - np.arange(len(own)))).sum(axis=1)
        best = int(np.argmin(far))
        return self.languages[best], float(1 - far[best] / (self.ranks * len(own)))


def sampled(labelled: DataFrame, text_column: str = "text", lang_column: str = "lang", sample: int = SAMPLE) -> DataFrame:
    """``text`` and ``lang`` of about ``sample`` labelled documents of each language, chosen by a hash of the text.

    To the driver come the numbers of rows by language.
    """
    rows = labelled.select(col(text_column).alias("text"), col(lang_column).alias("lang")).filter("lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return rows.limit(0)
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, sample / n))])
    return rows.filter(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20))


def least_score(chosen: DataFrame, profiles: Profiles) -> float:
    """The score below which a text is taken for none of the languages: ``MARGIN`` of the score that all but one in a thousand
    of the given labelled texts reach, short ones included. 0 where nothing was learned."""
    return _least_of(chosen.select(language_of(F.col("text"), profiles).alias("said")), "said")


def _least_of(scored: DataFrame, said: str) -> float:
    """``least_score`` of labelled texts whose language and score are in the column ``said``."""
    scored = scored.filter(F.col(f"{said}.lang") != UNKNOWN)
    return MARGIN * (scored.agg(F.percentile_approx(f"{said}.score", 0.001, 10_000).alias("low")).first()["low"] or 0.0)


def learn(
    labelled: DataFrame, text_column: str = "text", lang_column: str = "lang", sample: int | None = None, ranks: int = RANKS
) -> Profiles:
    """Profiles from all labelled documents, or from about ``sample`` of each language (see ``sampled``).

    Rows without a language are not used. To the driver come ``ranks`` n-grams per language.
    """
    small_batches(labelled.sparkSession)
    if sample is None:
        chosen = labelled.select(col(text_column).alias("text"), col(lang_column).alias("lang")).filter("lang IS NOT NULL AND text IS NOT NULL")
    else:
        chosen = sampled(labelled, text_column, lang_column, sample)

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for frame in frames:
            for lang, texts in frame.groupby("lang", sort=False)["text"]:
                parts = [total[lang]] if lang in total else []
                found = [*parts, *(grams(text) for text in texts)]
                values, places = np.unique(np.concatenate([v for v, _ in found]), return_inverse=True)
                counts = np.zeros(len(values), np.int64)
                np.add.at(counts, places, np.concatenate([n for _, n in found]))
                total[lang] = values, counts
            if sum(len(values) for values, _ in total.values()) > HELD_GRAMS:
                yield from passed(total)
                total = {}
        yield from passed(total)

    def passed(total: dict[str, tuple[np.ndarray, np.ndarray]]) -> Iterator[pd.DataFrame]:
        for lang, (values, counts) in total.items():
            yield pd.DataFrame({"lang": lang, "gram": values.astype(np.int64), "n": counts})

    top = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    counts = chosen.mapInPandas(counted, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    listed = counts.withColumn("rank", F.row_number().over(top)).filter(F.col("rank") <= ranks).collect()
    if not listed:
        return Profiles([], np.empty(0, np.uint64), np.empty((0, 0), np.int64), ranks)
    languages = sorted({r["lang"] for r in listed})
    known = np.array(sorted({r["gram"] for r in listed}), np.uint64)
    places = np.full((len(languages), len(known)), ranks, np.int64)
    for r in listed:
        places[languages.index(r["lang"]), np.searchsorted(known, np.uint64(r["gram"]))] = r["rank"] - 1
    return Profiles(languages, known, places, ranks)


def language_of(text: Column, profiles: Profiles) -> Column:
    """A struct of ``lang`` and ``score`` for a text."""

    @F.pandas_udf("lang string, score double")
    def nearest(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([profiles.nearest(x) for x in texts], columns=["lang", "score"])

    return nearest(text)


def identify(docs: DataFrame, profiles: Profiles, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, ``lang_pred`` and ``score`` (0 to 1).

    ``und`` with score 0 for a null text, one without a letter, or where no language was learned. Ids may be null or repeat;
    other columns are not read.
    """
    small_batches(docs.sparkSession)
    said = docs.select(col(id_column).alias("doc_id"), language_of(col(text_column), profiles).alias("said"))
    return said.select("doc_id", F.col("said.lang").alias("lang_pred"), F.col("said.score").alias("score"))


def _scored(docs: DataFrame, profiles: Profiles, text_column: str = "text") -> tuple[DataFrame, str]:
    """The documents with language and score in one more column, and its name."""
    small_batches(docs.sparkSession)
    said = fresh(docs, "said")
    return docs.withColumn(said, language_of(col(text_column), profiles)), said


def _known(found: DataFrame, said: str, least: float) -> DataFrame:
    return found.filter((F.col(f"{said}.lang") != UNKNOWN) & (F.col(f"{said}.score") >= least)).drop(said)


def keep_known(docs: DataFrame, profiles: Profiles, text_column: str = "text", least: float = 0.0) -> DataFrame:
    """The documents in a learned language, all columns as they are.

    Rejected are null texts, texts without a letter, and texts with a score below ``least``, which resemble no profile.
    """
    return _known(*_scored(docs, profiles, text_column), least)


def _learnable(docs: DataFrame) -> DataFrame:
    return docs.filter(F.coalesce(remainder(F.col("doc_id"), 3) != 1, F.lit(False)))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from the documents that are not held out. A null id is not held out, nor
    learned from."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = identify(docs, learn(_learnable(docs)))
    held_out = F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose language is known: those that score like labelled documents do.

    Every document is scored once, and stored with its score; the least score comes from all labelled ones.
    """
    found, said = _scored(docs, learn(docs))
    found = stored_once(found)
    return _known(found, said, _least_of(found.filter("lang IS NOT NULL"), said))
