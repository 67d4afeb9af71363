"""Quality rules by weak supervision: rules vote or abstain, and a label model weighs them.

Every rule votes good, bad or nothing on a document. Nobody says which rules are right: expectation-maximisation
estimates, from how the rules agree over all documents, how often each votes either way on good and on bad documents, and how
many documents are good. A document stays if its posterior probability of being good is high enough, instead of having
to pass every rule.

The estimation needs only how often each combination of votes occurs, at most ``3 ** len(RULES)`` numbers whatever the table's size.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablegrade.llm.common import col, small_batches, table
from tablegrade.sources.state_files import stored_once

_WORD = re.compile("[^\x20\x09-\x0d]+")
_SYMBOL = re.compile(r"[#*$%&|<>]")

GOOD, BAD, NONE = 1, -1, 0
#: A document stays if it is good with at least this probability.
LEAST = 0.5
#: How often a rule is right on good documents, at least.
SURE = 0.98


@dataclass
class Measures:
    """What the rules look at."""

    n_words: int = 0
    word_chars: int = 0
    n_symbols: int = 0
    n_dup_lines: int = 0
    n_repeat_words: int = 0
    n_lines: int = 0
    n_letters: int = 0
    n_upper: int = 0
    n_plain: int = 0
    n_ended: int = 0
    n_distinct: int = 0


def measure(text: str | None) -> Measures:
    """All measures of a whole text; a null text has no words."""
    text = text or ""
    words = _WORD.findall(text)
    lines = [line for line in text.split("\n") if _WORD.search(line)]
    windows = list(zip(words, words[1:], words[2:], strict=False))
    often = Counter(windows)
    repeated = np.zeros(len(words), bool)
    if len(often) < len(windows):
        at = np.flatnonzero(np.fromiter(map(often.__getitem__, windows), np.int64, len(windows)) > 1)
        repeated[at] = repeated[at + 1] = repeated[at + 2] = True
    letters = sum(map(str.isalpha, text)) if not text.isascii() else len(re.findall("[A-Za-z]", text))
    return Measures(
        n_words=len(words),
        word_chars=sum(map(len, words)),
        n_symbols=len(_SYMBOL.findall(text)),
        n_dup_lines=len(lines) - len(set(lines)),
        n_repeat_words=int(repeated.sum()),
        n_lines=len(lines),
        n_letters=letters,
        n_upper=len(re.findall(r"[A-ZÀ-ÖØ-Þ]", text)),
        n_plain=sum(word.strip(".,;:!?'\"()").isalpha() for word in words),
        n_ended=sum(line.rstrip().endswith((".", "!", "?", '"', ":")) for line in lines),
        n_distinct=len(set(words)),
    )


def _share(good: Callable[[float], bool], bad: Callable[[float], bool], part: str, whole: str) -> Callable[[Measures], int]:
    def rule(m: Measures) -> int:
        total = getattr(m, whole)
        if not total:
            return NONE
        value = getattr(m, part) / total
        return GOOD if good(value) else BAD if bad(value) else NONE

    return rule


#: The rules; each votes on a clear case and abstains between.
RULES: dict[str, Callable[[Measures], int]] = {
    "length": lambda m: GOOD if m.n_words >= 80 else BAD if m.n_words < 30 else NONE,
    "word_length": _share(lambda x: 3 <= x <= 9, lambda x: x < 2.5 or x > 12, "word_chars", "n_words"),
    "symbols": _share(lambda x: x <= 0.02, lambda x: x > 0.1, "n_symbols", "n_words"),
    "repeated_words": _share(lambda x: x <= 0.1, lambda x: x > 0.3, "n_repeat_words", "n_words"),
    "repeated_lines": _share(lambda x: x <= 0.05, lambda x: x > 0.3, "n_dup_lines", "n_lines"),
    "capitals": _share(lambda x: x <= 0.15, lambda x: x > 0.4, "n_upper", "n_letters"),
    "plain_words": _share(lambda x: x >= 0.9, lambda x: x < 0.7, "n_plain", "n_words"),
    "line_ends": _share(lambda x: x >= 0.6, lambda x: x < 0.2, "n_ended", "n_lines"),
    "variety": _share(lambda x: x >= 0.2, lambda x: x < 0.1, "n_distinct", "n_words"),
}


def pattern(m: Measures) -> int:
    """All votes as one number in base 3, the first rule first; digit 0 is bad, 1 none, 2 good."""
    code = 0
    for rule in RULES.values():
        code = 3 * code + rule(m) + 1
    return code


def votes_of(codes: np.ndarray) -> np.ndarray:
    """A row of votes (-1, 0, 1) per code."""
    digits = 3 ** np.arange(len(RULES) - 1, -1, -1)
    return codes[:, None] // digits % 3 - 1


@dataclass
class LabelModel:
    """Share of good documents; ``rates[c, j, v]``: how often rule ``j`` votes ``v`` (bad, none, good) on documents of class ``c``
    (bad, good)."""

    good: float
    rates: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        logs = np.log(np.array([1 - self.good, self.good]))[:, None] + sum(
            np.log(self.rates[:, j, votes[:, j] + 1]) for j in range(votes.shape[1])
        )
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def fit(codes: np.ndarray, counts: np.ndarray, steps: int = 200) -> LabelModel:
    """Expectation-maximisation over the combinations of votes.

    Rules vote bad only on clear cases, so on good documents they are held to be right at least ``SURE`` of the time. On bad
    documents they may be right rarely: each kind of bad text is seen by few of them. A weak prior keeps a rule that never votes
    defined. Abstaining says nothing about the class: its rate is shared by both classes.
    """
    rules, votes = len(RULES), votes_of(codes)
    none = np.array([(counts * (votes[:, j] == 0)).sum() for j in range(rules)]) / max(1, counts.sum())
    none = np.clip(none, 1e-6, 1 - 1e-6)

    def rates(right: np.ndarray) -> np.ndarray:
        """``right[c, j]``: the share of right votes among votes."""
        out = np.empty((2, rules, 3))
        out[:, :, 1] = none
        out[0, :, 0], out[0, :, 2] = (1 - none) * right[0], (1 - none) * (1 - right[0])
        out[1, :, 2], out[1, :, 0] = (1 - none) * right[1], (1 - none) * (1 - right[1])
        return out

    model, strength = LabelModel(0.9, rates(np.array([[0.4] * rules, [0.99] * rules]))), 10.0
    for _ in range(steps if len(codes) else 0):
        p = model.posterior(votes)
        right = np.empty((2, rules))
        for j in range(rules):
            for c, weight in enumerate((counts * (1 - p), counts * p)):
                hit = (weight * (votes[:, j] == (GOOD if c else BAD))).sum()
                cast = (weight * (votes[:, j] != NONE)).sum()
                right[c, j] = (hit + (0.99 if c else 0.4) * strength) / (cast + strength)
        right[1] = np.maximum(right[1], SURE)
        share = (float((counts * p).sum()) + 9) / (float(counts.sum()) + 10)
        new = LabelModel(min(max(share, 1e-6), 1 - 1e-6), rates(np.clip(right, 1e-4, 1 - 1e-4)))
        done = np.abs(new.rates - model.rates).max() < 1e-7
        model = new
        if done:
            break
    return model


def measured(text: Column) -> Column:
    """A struct of the base measures and the combination of votes."""

    @F.pandas_udf("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, votes long")
    def found(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            m = measure(text)
            rows.append((m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words, pattern(m)))
        return pd.DataFrame(rows, columns=["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "votes"])

    return found(text)


def judge(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: float = LEAST) -> DataFrame:
    """One row per document: id, measures, ``base_failed``, ``posterior`` (of being good) and ``kept``.

    ``base_failed``: fewer than 50 words, or more than half of the words in repeated windows of three; such documents are not kept.
    A null or empty text has no words. Ids may be null or repeat; other columns are not read. An empty table gives no rows.
    The measures are written once to the shared folder, as they are counted and then joined.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(col(id_column).alias("doc_id"), measured(col(text_column)).alias("m")).select("doc_id", "m.*")
    rows = stored_once(rows)
    seen = rows.groupBy("votes").count().collect()  # at most 3 ** len(RULES) rows
    codes = np.array([r["votes"] for r in seen], np.int64)
    counts = np.array([r["count"] for r in seen], np.float64)
    good = fit(codes, counts).posterior(votes_of(codes)) if len(codes) else []
    by_votes = docs.sparkSession.createDataFrame(
        [(int(c), float(p)) for c, p in zip(codes, good, strict=True)], "votes long, posterior double"
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    judged = rows.join(F.broadcast(by_votes), "votes").withColumn("base_failed", failed)
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= least)).drop("votes")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document judged by the base rules and the label model."""
    return judge(table(spark, sf_dir, "documents"))
