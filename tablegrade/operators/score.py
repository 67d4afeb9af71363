"""From metric rows to the stored summary, and from the summary to scores and bands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablegrade.operators.state import upsert
from tablegrade.schemas import BANDS, DIMENSIONS, LOWEST_BAND, METRICS, TABLE_KEYS

POINTS = {metric: points for dimension in DIMENSIONS.values() for metric, points in dimension.items()}


def metric_rows(signals: DataFrame, names: dict[str, str] | list[str]) -> DataFrame:
    """Boolean signal columns as ``(table, metric, value)`` rows.

    ``names`` lists the metrics to take, or maps a signal column to the metric it stands for.
    """
    renamed = names if isinstance(names, dict) else {n: n for n in names}
    cells = [f"named_struct('metric', '{metric}', 'value', {c})" for c, metric in renamed.items()]
    return signals.selectExpr(*TABLE_KEYS, f"inline(array({', '.join(cells)}))")


def _known_metric() -> Column:
    message = F.concat(F.lit("unknown metric: "), F.coalesce("metric", F.lit("NULL")))
    return F.when(F.col("metric").isin(METRICS), True).otherwise(
        F.raise_error(message).cast("boolean")
    )


def pivot_metrics(rows: DataFrame) -> DataFrame:
    """Metric rows as one row per table; a metric that was not given is null.

    A row with a null value is given and means False. A metric name that is not known fails the job.
    """
    cells = [F.expr(f"bool_or(if(metric = '{m}', coalesce(value, false), null)) as {m}") for m in METRICS]
    return rows.where(_known_metric()).groupBy(*TABLE_KEYS).agg(*cells)


def upsert_summary(summary: DataFrame, rows: DataFrame) -> DataFrame:
    """Store the given metrics; the others keep their value, or are False for a new table."""
    merged = upsert(
        summary, pivot_metrics(rows), TABLE_KEYS, METRICS, id_column="table_id", keep_missing=True
    )
    return merged.select(
        "table_id", *TABLE_KEYS, *(F.expr(f"coalesce({m}, false) as {m}") for m in METRICS)
    )


def _points(metrics: dict[str, int]) -> Column:
    return F.expr(" + ".join(f"if({metric}, {points}, 0)" for metric, points in metrics.items()))


def score_tables(summary: DataFrame) -> DataFrame:
    """Points per dimension, total score and band of every summary row; a projection only."""
    scored = summary.select(
        *TABLE_KEYS, *(_points(metrics).alias(name) for name, metrics in DIMENSIONS.items())
    )
    total = F.lit(0)
    for name in DIMENSIONS:
        total = total + F.col(name)
    return scored.withColumn("score", total).withColumn("band", score_band(F.col("score")))


def score_band(score: Column) -> Column:
    """Name of the band a score falls in."""
    (first, limit), *others = BANDS
    band = F.when(score >= limit, first)
    for name, lowest in others:
        band = band.when(score >= lowest, name)
    return band.otherwise(LOWEST_BAND)
