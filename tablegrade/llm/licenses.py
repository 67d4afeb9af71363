"""License scans by diagonal voting.

Every pair of neighbouring words of a document is joined, by its hash, with the places of the same pair in license templates. A pair
at word ``d`` of the document and ``t`` of the template votes for the diagonal ``d - t``: words that stand in the same order
vote for one diagonal. Votes are added up by diagonal; within a window of twice the template's length, diagonals a few words apart
(words put in or left out) are merged; and a merged span is verified by the share of the template's own words that stand in it in order.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablegrade.llm.common import col, content_key, for_all, small_batches, table

#: Words of a hashed run, and how many words apart diagonals may be to be merged.
RUN, APART = 2, 3
#: A span of the method's templates counts if at least this share of the template's runs stands in it.
LEAST = 0.8

#: Phrases that count wherever their words stand consecutively.
PHRASES = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)

#: Public license notices, lower-cased, and their labels.
TEMPLATES = (
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("you may not use this file except in compliance with the license you may obtain a copy of the license at", "apache-2.0"),
    ("released under the mit license", "mit"),
    ("licensed under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("licensed under cc by nc 4 0", "cc-by-nc-4.0"),
    ("licensed under cc by sa 4 0", "cc-by-sa-4.0"),
    ("creative commons attribution 4 0 international license", "cc-by-4.0"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3.0"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("mozilla public license version 2 0", "mpl-2.0"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words of a text, A-Z lower-cased."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), F.lit(_WORD), F.lit(0))


def runs_of(words: Column, run: int) -> Column:
    """Hashes of all runs of so many neighbouring words, in order."""
    ends = F.size(words) - run + 1
    places = F.when(ends > 0, F.sequence(F.lit(1), ends)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.xxhash64(F.array_join(F.slice(words, i, run), " ")))


def template_places(spark: SparkSession, templates: Sequence[tuple[str, str]], base: bool, run: int) -> DataFrame:
    """``hash``, ``template``, ``label``, ``base``, ``t`` (place) and ``runs`` (in all) of every run of every template."""
    rows = [(i, text, label, base) for i, (text, label) in enumerate(templates)]
    frame = spark.createDataFrame(rows, "template int, text string, label string, base boolean")
    words = frame.select("template", "label", "base", runs_of(words_of(F.col("text")), run).alias("hashes"))
    return words.select("template", "label", "base", F.size("hashes").alias("runs"), F.posexplode("hashes").alias("t", "hash"))


def votes(docs: DataFrame, places: DataFrame, id_column: str, text_column: str, run: int) -> DataFrame:
    """Every place where a document's run is a template's run: keys of the row, template, its figures, ``t`` and ``d``.

    The templates' places are broadcast if they are small enough by count.
    """
    words = docs.select(*content_key(col(id_column), col(text_column)), words_of(col(text_column)).alias("words"))
    hashes = words.select("key_id", "key_text", F.posexplode(runs_of(F.col("words"), run)).alias("d", "hash"))
    found = hashes.join(for_all(places, 64), "hash")
    # Rows alike in id and text would vote twice for one place.
    return found.select("key_id", "key_text", "base", "template", "label", "runs", "t", "d").distinct()


def chained(voted: list[tuple[int, int]], runs: int, least: float = LEAST, apart: int = APART) -> list[tuple[int, int, float]]:
    """Spans ``(first, last, share)`` of a template among its votes ``(d, t)`` in a document, the best first, none overlapping.

    A window starts at every vote and is twice as long as the template; diagonals are chained within it, so what stands elsewhere
    in the document cannot lengthen a span.
    """
    voted, found, end = sorted(voted), set(), 0
    for at, (start, _) in enumerate(voted):
        while end < len(voted) and voted[end][0] < start + 2 * runs:
            end += 1
        if len({t for _, t in voted[at:end]}) / runs < least:
            continue
        chain: list[tuple[int, int]] = []
        for d, t in [*sorted(voted[at:end], key=lambda v: v[0] - v[1]), (None, None)]:
            if chain and (d is None or d - t - (chain[-1][0] - chain[-1][1]) > apart):
                share = len({x for _, x in chain}) / runs
                if share >= least:
                    found.add((min(x for x, _ in chain), max(x for x, _ in chain), share))
                chain = []
            chain.append((d, t))
    kept: list[tuple[int, int, float]] = []
    for first, last, share in sorted(found, key=lambda x: (-x[2], x[1] - x[0], x[0])):
        if all(last < x[0] or first > x[1] for x in kept):
            kept.append((first, last, share))
    return kept


def spans(found: DataFrame, least: float = LEAST) -> DataFrame:
    """Verified spans: keys, ``base``, ``label``, ``first_word``, ``last_word`` (start of the last run), ``share`` of the template's runs."""
    # A phrase must stand whole, on one diagonal; the method's templates may have words put in or left out.
    span = ["key_id", "key_text", "base", "template", "label", "runs"]
    diagonal = F.when(F.col("base"), F.col("d") - F.col("t")).alias("diagonal")
    voted = found.groupBy(*span, diagonal).agg(
        F.collect_list("d").alias("ds"), F.collect_list("t").alias("ts"), F.size(F.collect_set("t")).alias("covered")
    )
    share = F.col("covered") / F.col("runs")
    voted = voted.filter(share >= F.when(F.col("base"), 1.0).otherwise(least))

    @F.pandas_udf("array<struct<first_word: int, last_word: int, share: double>>")
    def verified(ds: pd.Series, ts: pd.Series, runs: pd.Series, base: pd.Series) -> pd.Series:
        out = []
        for d, t, n, phrase in zip(ds, ts, runs, base, strict=True):
            rows = [(int(d.min()), int(d.max()), 1.0)] if phrase else chained(list(zip(d.tolist(), t.tolist(), strict=True)), n, least)
            out.append([dict(zip(("first_word", "last_word", "share"), row, strict=True)) for row in rows])
        return pd.Series(out, dtype=object)

    rows = voted.select("key_id", "key_text", "base", "label", F.explode(verified("ds", "ts", "runs", "base")).alias("s"))
    return rows.select("key_id", "key_text", "base", "label", "s.*")


def scan(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    phrases: Sequence[tuple[str, str]] = PHRASES,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    least: float = LEAST,
) -> DataFrame:
    """One row per verified span: keys of the row, ``base`` (a phrase), ``label``, ``first_word``, ``last_word``, ``share``.

    Phrases count only whole. A template's span counts if it covers ``least`` of the template and is not longer than twice the
    template. Phrases and templates have two words at least.
    """
    spark = docs.sparkSession
    places = template_places(spark, phrases, True, RUN).unionByName(template_places(spark, templates, False, RUN))
    small_batches(spark)
    return spans(votes(docs, places, id_column, text_column, RUN), least)


def licenses(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels``, ``score``.

    The score is the largest share found, 0 without a label. A null text is empty; without words all lists are empty. Ids may be null or
    repeat: rows alike in id and text get equal results. Other columns are not read. Only short rows are shuffled, never texts.
    """
    found = scan(docs, id_column, text_column)
    listed = lambda column: F.array_join(F.array_sort(F.collect_set(column)), ",")
    base = F.col("base")
    by_row = found.groupBy("key_id", "key_text").agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("first_word"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("first_word"))).cast("long").alias("last_word"),
        listed(F.when(base, F.col("label"))).alias("base_labels"),
        listed("label").alias("labels"),
        F.max("share").alias("score"),
    )
    rows = docs.select(
        *content_key(col(id_column), col(text_column)), F.size(words_of(col(text_column))).cast("long").alias("n_words")
    )
    same = rows["key_id"].eqNullSafe(by_row["key_id"]) & (rows["key_text"] == by_row["key_text"])
    return rows.join(by_row, same, "left").select(
        rows["key_id"].alias("doc_id"),
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def op7_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's license phrases and templates."""
    return licenses(table(spark, sf_dir, "documents"))
